import itertools
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lexigrove.operators import structure as S


def longest(points):
    """The sizes of the longest strictly rising choices of points, by trying all."""
    points = sorted(points)
    for k in range(len(points), 0, -1):
        for chosen in itertools.combinations(points, k):
            if all(a[0] < b[0] and a[1] < b[1] for a, b in zip(chosen, chosen[1:], strict=False)):
                return k
    return 0


def test_chain(spark):
    pick = random.Random(1)
    books = {f"b{i}": list({p: pick.randrange(12) for p in pick.sample(range(20), 8)}.items()) for i in range(6)}
    df = spark.createDataFrame([(b, p, k) for b, seen in books.items() for p, k in seen], "book string, pdf_page int, book_page int")
    got = {b: [] for b in books}
    for r in S.monotonic_chain(df, "book").collect():
        got[r.book].append((r.pdf_page, r.book_page))
    for b, seen in books.items():
        assert len(got[b]) == longest(seen) == longest(got[b]) and set(got[b]) <= set(seen)


def test_interpolation(spark):
    books = {"a": [(3, 1), (8, 5), (20, 12)], "b": [(40, 30), (41, 35)], "one": [(7, 7)]}
    chain = spark.createDataFrame([(b, *x) for b, seen in books.items() for x in seen], "book string, pdf_page int, book_page int")
    wanted = spark.createDataFrame([(b, w) for b in books for w in (-90, 1, 2, 3, 5, 6, 12, 31, 33, 40, 900, 900)], "book string, book_page int")

    def place(seen, want):
        pairs = list(zip(seen, seen[1:], strict=False))
        (p, b), (q, c) = next((x for x in pairs if want <= x[1][1]), pairs[-1])
        return max(1, min(100, round(Fraction(p) + Fraction((want - b) * (q - p), max(1, c - b)))))

    got = sorted(map(tuple, S.interpolate_pages(chain, wanted, 100).collect()))
    assert got == sorted((b, w, place(books[b], w)) for b, w in map(tuple, wanted.collect()) if len(books[b]) > 1)


def test_interpolation_of_exact_halves(spark):
    chain = spark.createDataFrame([("a", 3, 1), ("a", 10, 7)], "book string, pdf_page int, book_page int")
    wanted = spark.createDataFrame([("a", 52)], "book string, book_page int")
    assert [r.pdf_page for r in S.interpolate_pages(chain, wanted, 100).collect()] == [62]  # 3 + 51 * 7 / 6 = 62.5


def test_contents_of_many_books_pass_in_batches(spark):
    lines = spark.createDataFrame([("a", 2, "1. Start 4"), ("a", 1, "Part i: One"), ("a", 3, None), ("a", 4, "Some . . . 9"), ("b", 1, None), (None, 1, "Preface ix")], "book string, line_no long, text string")
    found = S.parse_contents(lines)
    assert {tuple(r) for r in found.collect()} == {
        ("a", 1, "part", 1, "Part i: One", None, "none", None), ("a", 2, "chapter", 2, "1. Start", "4", "arabic", 1), ("a", 3, "section", 3, "Some", "9", "arabic", 2), (None, 1, "frontmatter", 1, "Preface", "ix", "roman", None)
    }
    assert "FlatMapGroups" not in found._jdf.queryExecution().executedPlan().toString()


def test_offsets(spark):
    votes = [9] * 120 + [-3, 44, 45]
    df = spark.createDataFrame([("b", v) for v in votes] + [("weak", 1), ("weak", 2)], "book string, offset int")
    got = {r.book: r for r in S.offset_votes(df, "book", "offset").collect()}
    assert (got["b"].offset, got["b"].is_strong, got["b"].second_count) == (9, True, 1)
    assert (got["weak"].offset, got["weak"].is_strong, got["weak"].confidence) == (1, False, 0.5)


def test_regions(spark):
    lines = [(1, 1, "main", "left", "a", 10.0, 10.0, 90.0, 20.0), (1, 2, "main", "left", "b", 12.0, 25.0, 95.0, 35.0), (1, 3, "main", "left", "far", 12.0, 80.0, 95.0, 90.0), (1, 4, "aside", "right", "c", 12.0, 91.0, 95.0, 99.0)]
    df = spark.createDataFrame(lines, "page int, line_no int, role string, zone string, text string, x0 double, y0 double, x1 double, y1 double")
    got = S.group_lines(df).orderBy("island").collect()
    assert [r.text for r in got] == ["a\nb", "far", "c"] and (got[0].x0, got[0].y1) == (10.0, 35.0)


def test_packing(spark):
    df = spark.createDataFrame([("d", i, n) for i, n in enumerate([60, 30, 200, 10, 0, 80])], "doc string, i int, n_tokens long")
    got = [(r.n_tokens, r.n_blocks) for r in S.pack(df, "doc", "i", 100).orderBy("chunk").collect()]
    assert got == [(90, 2), (200, 1), (90, 3)]


def test_passages(spark):
    rows = [(0, "commentary", "before"), (1, "reference", "1a)"), (2, "citation", "quote"), (3, "commentary", " one \n two"), (4, "reference", ""), (5, "commentary", None)]
    df = spark.createDataFrame([("e", *r) for r in rows], "entry string, ord int, bucket string, text string")
    got = S.assemble_passages(df, "entry", "ord", F.col("bucket") == "reference").orderBy("passage").collect()
    assert [(r.passage, r.citation, r.commentary, r.reference, r.n_tokens) for r in got] == [(0, "", "before", "", 1), (1, "quote", "one two", "1a)", 4)]


def test_segments(spark):
    text = "\n\n".join(["w " * 50] * 5 + ["x " * 300])
    parts = spark.range(1).select(S.segment_text(F.lit(text), 120)).first()[0]
    assert [len(p.split()) for p in parts] == [100, 100, 50, 300]
    assert spark.range(1).select(S.segment_text(F.lit(" \n\n "), 120)).first()[0] == []


def test_contents(spark):
    lines = ["Table of Contents", "Foreword ... ix", "Introduction 3", "Part II: Rivers", "4) Springs and Wells   17", "A Dry Year  20", "Chapter 5", "Floods  44", "Afterword 90", "Notes . . 95"]
    df = spark.createDataFrame([("b", i, t) for i, t in enumerate(lines)], "book string, line_no int, text string")
    got = [(r.kind, r.level, r.title, r.page_label, r.numbering, r.parent) for r in S.parse_contents(df).orderBy("sequence").collect()]
    assert got == [
        ("frontmatter", 1, "Foreword", "ix", "roman", None), ("introduction", 1, "Introduction", "3", "arabic", None), ("part", 1, "Part II: Rivers", None, "none", None),
        ("chapter", 2, "4) Springs and Wells", "17", "arabic", 3), ("section", 3, "A Dry Year", "20", "arabic", 4), ("chapter", 2, "Chapter 5: Floods", "44", "arabic", 3),
        ("epilogue", 1, "Afterword", "90", "arabic", None), ("index", 1, "Notes", "95", "arabic", None),
    ]


def test_metadata(spark):
    pages = [("b", 1, "Of Words\nJane Q. Doe\n"), ("b", 2, "Translated with an introduction by John Roe.\nThe Old University Press\n12 High Street\nCopyright © 1974, 1997 by the Press")]
    got = S.harvest_metadata(spark.createDataFrame(pages, "book string, page_no int, text string")).first()
    assert (got.title, got.author, got.translator, got.publisher, got.year) == ("Of Words", "Jane Q. Doe", "John Roe", "The Old University Press", 1974)


def test_state_and_anchors(spark):
    df = spark.createDataFrame([("p", i, k, i * 2.0) for i, k in enumerate("xsxexax")], "page string, i int, kind string, y double")
    got = [r.in_state for r in S.spread_state(df, "page", "i", F.col("kind") == "s", F.col("kind") == "e").orderBy("i").collect()]
    assert got == [False, True, True, False, False, False, False]
    near = S.next_anchor(df, "page", "i", F.col("kind") == "a", "y").orderBy("i").collect()
    assert [(r.previous_anchor, r.next_anchor, r.next_distance) for r in near][4:] == [(None, 5, 2.0), (None, None, None), (5, None, None)]


@pytest.mark.parametrize("depth", [3, 4])
def test_ancestors(spark, depth):
    df = spark.createDataFrame([("a", None, "A"), ("b", "a", "B"), ("c", "b", "C")], "node_id string, parent_id string, name string")
    assert {r.path for r in S.ancestor_paths(df, depth).collect()} == {"A", "A > B", "A > B > C"}


def test_end_pages(spark):
    df = spark.createDataFrame([("b", 1, 5), ("b", 2, 5), ("b", 3, 9)], "book string, sequence int, start_page int")
    assert [r.end_page for r in S.end_pages(df, "book").orderBy("sequence").collect()] == [5, 8, 9]


def test_paths_of_any_depth(spark):
    rows = [(i, i - 1 if i else None, f"n{i}") for i in range(7)] + [(20, 99, "lost"), (21, 20, "below")]
    df = spark.createDataFrame(rows, "node_id int, parent_id int, name string")
    got = {r.node_id: r.path for r in S.ancestor_paths(df).collect()}
    assert got == {i: " > ".join(f"n{k}" for k in range(i + 1)) for i in range(7)} | {20: "lost", 21: "lost > below"}
    with pytest.raises(ValueError):
        S.ancestor_paths(spark.createDataFrame([(1, 2, "a"), (2, 1, "b")], df.schema), deepest=4)
