"""Page numbers, mapping strategies, and the alignment of entries against exhaustive search."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from lexigrove.operators import page_map as M

BLOCKS = "book string, pdf_page int, text string, x0 double, y0 double, x1 double, y1 double, width double, height double, page_count int"


def block(page, text, x0=40.0, y0=30.0, book="b", count=300):
    return (book, page, text, x0, y0, x0 + 20, y0 + 12, 600.0, 800.0, count)


def test_margin_numbers(spark):
    rows = [
        block(1, "12"), block(1, "13", x0=300.0), block(2, "14", x0=300.0, y0=760.0), block(2, "15", x0=320.0, y0=20.0), block(3, "16", y0=400.0), block(4, "no 17"), block(5, "18\n19"), block(6, "301"), block(7, "0"),
        block(8, " 20 \n\n"), block(9, "1234"), block(10, None), block(11, "21", x0=450.0, y0=82.0), block(12, "22", y0=705.9), block(13, "23", y0=706.0),
    ]
    got = sorted((r.pdf_page, r.book_page, r.outer) for r in M.margin_numbers(spark.createDataFrame(rows, BLOCKS)).collect())
    assert got == [(1, 12, True), (2, 14, False), (2, 15, False), (8, 20, True), (11, 21, True), (13, 23, True)]


def test_edge_numbers_stand_in_where_margins_have_none(spark):
    pages = spark.createDataFrame([("b", 1, "a\n7\nb", 300), ("c", 1, "a\nb\nc\n9\nd\ne\nf", 300), ("c", 2, "a\n\n8\nb\n9", 300), ("c", 3, "301\n5", 300), ("c", 4, None, 300), ("c", 5, "6", 300)], "book string, pdf_page int, text string, page_count int")
    blocks = spark.createDataFrame([block(3, "5")], BLOCKS)
    got = sorted((r.book, r.pdf_page, r.book_page, r.source) for r in M.page_numbers(blocks, pages).collect())
    assert got == [("b", 3, 5, "margin"), ("c", 2, 8, "edge"), ("c", 3, 5, "edge"), ("c", 5, 6, "edge")]


def numbers(spark, books):
    return spark.createDataFrame([(b, p, n) for b, pairs in books.items() for p, n in pairs], "book string, pdf_page int, book_page int")


def test_strategies_and_pages(spark):
    books = {
        "offset": [(p, p - 12) for p in range(15, 60)] + [(20, 90), (61, 48)],
        "drawn": [(10, 3), (20, 23), (30, 43), (31, 9)],
        "single": [(40, 30)],
        "low": [(5, 1), (6, 2)],
    }
    strategy, observations = M.mapping_strategy(numbers(spark, books))
    got = {r.book: (r.mode, r.offset, r.observations) for r in strategy.collect()}
    assert got == {"offset": ("global_offset", 12, 46), "drawn": ("observation_interpolation", -13, 3), "single": ("observation_interpolation", 10, 1), "low": ("observation_interpolation", None, 2)}
    wanted = spark.createDataFrame([(b, n) for b in (*books, "none") for n in (1, 13, 23, 60)], "book string, book_page int")
    placed = {(r.book, r.book_page): r.pdf_page for r in M.mapped_pages(strategy, observations, wanted, 45).collect()}
    assert [placed["offset", n] for n in (1, 13, 23, 60)] == [13, 25, 35, 72]
    assert [placed["drawn", n] for n in (1, 13, 23, 60)] == [9, 15, 20, 38]
    assert [placed["single", n] for n in (1, 13, 23, 60)] == [11, 23, 33, 45]
    assert [placed["low", n] for n in (1, 13, 23, 60)] == [5, 17, 27, 45]
    assert {placed["none", n] for n in (1, 13)} == {None}


@pytest.mark.parametrize(
    "title, want",
    [
        ("3. The Old Mill", ["3theoldmill", "theoldmill"]), ("A. The Old Mill", ["atheoldmill", "theoldmill"]), ("iv. The Old Mill", ["ivtheoldmill", "theoldmill"]), ("The Old Mill 27", ["theoldmill27", "theoldmill"]),
        ("VVinter in the vvest", ["vvinterinthevvest", "winterinthewest"]), ("Mill", []), ("The Old Mill", ["theoldmill"]), (None, []),
    ],
)
def test_title_variants(spark, title, want):
    found = spark.createDataFrame([(title,)], "t string").select(M.title_variants(F.col("t"))).first()[0]
    assert sorted(found or []) == sorted(want)


PAGES, ENTRIES = "book string, page int, text string", "book string, seq int, kind string, title string, expected int"


def aligned(spark, entries, pages, reach=12):
    found = M.aligned_entries(spark.createDataFrame(entries, ENTRIES), spark.createDataFrame(pages, PAGES), reach)
    return {(r.book, r.seq): (r.page, r.score, r.distance) for r in found.collect()}


def test_alignment_keeps_the_order(spark):
    """The better page of the second entry lies before the first one, so its weaker page is taken."""
    pages = [("b", p, {10: "The second title", 12: "The first heading", 15: "see the second title here"}.get(p, "words")) for p in range(1, 31)]
    entries = [("b", 1, "chapter", "The First Heading", 12), ("b", 2, "section", "The Second Title", 11), ("b", 3, "part", "The First Heading", 11), ("b", 4, "chapter", "Nowhere to be found", 20)]
    assert aligned(spark, entries, pages) == {("b", 1): (12, 100, 0), ("b", 2): (15, 85, 4), ("b", 3): (15, 0, 4), ("b", 4): (20, 0, 0)}


def test_entries_without_a_page_stand_between_their_neighbours(spark):
    pages = [("b", p, "The middle chapter" if p in (5, 14, 28) else "x") for p in range(1, 31)]
    entries = [("b", 1, "chapter", "Opening words", 10), ("b", 2, "chapter", "The Middle Chapter", None), ("b", 3, "chapter", "Closing words", 20), ("b", 4, "chapter", "The Middle Chapter", None), ("b", 5, "section", "Unknown heading", None)]
    assert aligned(spark, entries, pages) == {("b", 1): (10, 0, 0), ("b", 2): (14, 100, 4), ("b", 3): (20, 0, 0), ("b", 4): (28, 100, 8), ("b", 5): (28, 0, 8)}


def test_alignment_equals_exhaustive_search(spark):
    rng, titles = random.Random(5), ["the red mill", "the blue mill", "the green mill", "the grey mill"]
    entries, pages, want = [], [], {}
    for b in range(25):
        book, last = f"b{b}", 7
        texts = {p: "\n".join(rng.choice([t, f"see {t} there", "other words"]) for t in rng.sample(titles, 2)) for p in range(1, last + 1)}
        pages += [(book, p, t) for p, t in texts.items()]
        own = [(rng.choice(titles), rng.randrange(1, last + 1)) for _ in range(4)]
        entries += [(book, i, "chapter", t, e) for i, (t, e) in enumerate(own)]

        def score(i, p, own=own, texts=texts):
            key = own[i][0].replace(" ", "")
            lines = [x.replace(" ", "") for x in texts[p].split("\n")]
            return 0 if abs(p - own[i][1]) > 2 else 100 if key in lines else 85 if any(key in x for x in lines) else 70 if key in "".join(lines) else 0

        rising = [ps for ps in itertools.product(*(range(max(1, e - 2), last + 1) for _, e in own)) if list(ps) == sorted(ps)]
        best = min(rising, key=lambda ps: (-sum(score(i, p) for i, p in enumerate(ps)), sum(abs(p - own[i][1]) for i, p in enumerate(ps)), ps))
        want |= {(book, i): (p, score(i, p), abs(p - own[i][1])) for i, p in enumerate(best)}
    assert aligned(spark, entries, pages, reach=2) == want


def test_edges(spark):
    assert aligned(spark, [], [("b", 1, "x")]) == {}
    assert aligned(spark, [("b", 1, "chapter", "The Old Mill", None), ("b", 2, None, None, None), ("c", 1, "chapter", "", 4)], [("b", 1, None)]) == {("b", 1): (1, 0, 0), ("b", 2): (1, 0, 0), ("c", 1): (4, 0, 0)}
