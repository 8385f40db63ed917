"""Region joins and repair on literal cases, and the operators on nulls, empty tables and clashing columns."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lexigrove.operators import continuity as C
from lexigrove.operators import paging as P
from lexigrove.operators import projection as J
from lexigrove.operators import quality as Q


REGIONS = "book int, page int, ord int, zone string, text string, x0 double, y0 double, x1 double, y1 double"


def pair(i, left, right, zone="center", x=(100, 300), y=(60, 72, 90), pages=(1, 1)):
    """Two regions of a book, the second with its own zone, edges, top and page."""
    return [(i, pages[0], 0, "center", left, 100.0, float(y[0]), 300.0, float(y[1])), (i, pages[1], 1, zone, right, float(x[0]), float(y[2]), float(x[1]), float(y[2]) + 12)]


#: What two regions say, where the second stands, and how it joins the first, worked out by hand.
JOINS = [
    (("It goes on and", "so it ends."), {}, "space"),
    (("It goes on and", "So it ends here and nowhere else at all."), {}, "no-continuation-signal"),
    (("It goes on and", "So it ends at once here."), {}, "space"),
    (("It goes on and", "“So it ends here and nowhere else at all."), {}, "space"),
    (("It has ended.", "so it goes."), {}, "no-continuation-signal"),
    (("It goes with-", "out end"), {}, "hyphen"),
    (("It goes with-", "“out” end"), {}, "space"),
    (("That was for you", "You went on with many more words than seven."), {}, "duplicate"),
    (("This is what the", "The rest of it has many more words than seven."), {}, "duplicate"),
    (("This is the.", "The rest of it has many more words than seven."), {}, "no-continuation-signal"),
    (("This is what was", "Was it so with many more words than these."), {}, "no-continuation-signal"),
    (("", "so it ends."), {}, "empty-fragment"),
    (("It goes on and", None), {}, "empty-fragment"),
    (("NOTES", "so it ends."), {}, "non-prose-fragment"),
    (("cf.", "so it ends."), {}, "non-prose-fragment"),
    (("It goes on and", "12"), {}, "non-prose-fragment"),
    (("It goes on and", ".. 7"), {}, "non-prose-fragment"),
    (("It goes on and", "12) a note on this"), {}, "non-prose-fragment"),
    (("It goes on and", "xiv"), {}, "non-prose-fragment"),
    (("It goes on and", "see Derrida, who says so: on page 7"), {}, "non-prose-fragment"),
    (("It goes on and", "so it ends."), {"zone": "right", "x": (400, 600)}, "x-incompatible"),
    (("It goes on and", "so it ends."), {"zone": "right", "x": (160, 600)}, "space"),
    (("It goes on and", "so it ends."), {"zone": "right", "x": (400, 420)}, "space"),
    (("It goes on and", "so it ends."), {"y": (60, 72, 101)}, "y-incompatible"),
    (("It goes on and", "so it ends."), {"y": (60, 72, 69)}, "y-incompatible"),
    (("It goes on and", "so it ends."), {"y": (60, 72, 70)}, "space"),
    (("It goes on and", "so it ends."), {"pages": (1, 2), "y": (500, 512, 60)}, "space"),
    (("It goes on and", "so it ends."), {"pages": (1, 2), "y": (400, 412, 60)}, "y-incompatible"),
    (("It goes on and", "so it ends."), {"pages": (1, 2), "y": (500, 512, 95)}, "y-incompatible"),
    (("It goes on and", "so it ends."), {"pages": (1, 3), "y": (500, 512, 60)}, "page-gap"),
]


def test_adjacent_joins(spark):
    rows = [r for i, (texts, where, _) in enumerate(JOINS) for r in pair(i, *texts, **where)]
    found = C.adjacent_joins(spark.createDataFrame(rows, REGIONS)).collect()
    assert {r.book: r.verdict for r in found if r.ord == 1} == {i: want for i, (*_, want) in enumerate(JOINS)}
    assert all(r.verdict is None for r in found if r.ord == 0)


def test_join_modes_widen(spark):
    """What a stricter mode joins, a looser one joins as well."""
    rows = [r for i, gap in enumerate(range(0, 60, 4)) for r in pair(i, "It goes on and", "so it ends.", zone="right", x=(100 + 3 * gap, 420 + 4 * gap), y=(60, 72, 72 + gap))]
    df = spark.createDataFrame(rows, REGIONS)
    joined = {m: {r.book for r in C.adjacent_joins(df, m).filter("verdict = 'space'").collect()} for m in C.LIMITS}
    assert joined["conservative"] < joined["balanced"] < joined["aggressive"]


def test_pages_that_hold_no_prose_join_nothing(spark):
    df = spark.createDataFrame(pair(1, "It goes on and", "so it ends."), REGIONS)
    assert [r.verdict for r in C.adjacent_joins(df.withColumn("content_mode", F.lit("index"))).orderBy("ord").collect()] == [None, "non-prose-page"]


@pytest.mark.parametrize(
    "left, right, mode, want",
    [
        ("It goes with-", "out end", "hyphen", "It goes without end"), ("at the", "The mill", "duplicate", "at the mill"), ("at the", "“The mill", "duplicate", "at the “The mill"),
        ("at the", "the", "duplicate", "at the"), ("one", "two", "space", "one two"), ("at the", "theory", "duplicate", "at the theory"),
    ],
)
def test_joined_text(spark, left, right, mode, want):
    df = spark.createDataFrame([(left, right, mode)], "a string, b string, m string")
    assert df.select(C.joined_text(F.col("a"), F.col("b"), F.col("m"))).first()[0] == want


def test_repair(spark):
    """A page of five regions, three of which are one; the pages apart."""
    rows = [
        (1, 1, 0, "center", "It goes on and", 100.0, 60.0, 300.0, 72.0), (1, 1, 1, "right", "so it goes with-", 120.0, 80.0, 340.0, 92.0), (1, 1, 2, "center", "out any end.", 90.0, 100.0, 300.0, 112.0),
        (1, 1, 3, "center", "Another sentence stands here by itself, and it is long.", 100.0, 120.0, 300.0, 132.0), (1, 1, 4, "center", None, 100.0, 140.0, 300.0, 152.0),
        (1, 2, 0, "center", "lower case again", 100.0, 60.0, 300.0, 72.0),
    ]
    got = [tuple(r)[1:] for r in C.repair_pages(spark.createDataFrame(rows, REGIONS)).orderBy("page", "ord").collect()]
    assert got == [
        (1, 0, "It goes on and so it goes without any end.", 90.0, 60.0, 340.0, 112.0, 3), (1, 3, rows[3][4], 100.0, 120.0, 300.0, 132.0, 1), (1, 4, "", 100.0, 140.0, 300.0, 152.0, 1),
        (2, 0, "lower case again", 100.0, 60.0, 300.0, 72.0, 1),
    ]


def test_boundary_words_are_those_of_a_whole_search(spark):
    """Whatever marks stand about them; the texts' ends alone are searched."""
    rng, word = random.Random(4), "[A-Za-z][A-Za-z'’-]*"
    parts = ["the", "The", "and", "mill", "é", "to", " ", " ", "'", "’", "-", ".", ") ", "12", "x"]
    texts = ["", "the", "'the", "x'the", "the-", "the -", "the'’ 12", *("".join(rng.choices(parts, k=rng.randrange(1, 7))) for _ in range(400))]
    want = []
    for t in texts:
        last, first = re.search(f"({word})[^A-Za-z]*$", t), re.search(word, t)
        want.append(tuple(w.lower() if w and w.lower() in C.BOUNDARY_WORDS else None for w in (last and last[1], first and first[0])))
    found = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", C.last_boundary_word(F.col("t")), C.first_boundary_word(F.col("t")))
    assert [tuple(r)[1:] for r in found.orderBy("i").collect()] == want
    assert {True, False} == {a is None for a, _ in want}


def test_a_fold_over_a_page_asks_little_of_texts(spark):
    """Facts of texts are found before it; it had 72 patterns and 248 replacements and extractions for every region."""
    plan = C.repair_pages(spark.createDataFrame([], REGIONS))._jdf.queryExecution().optimizedPlan()
    fold = plan.toString().partition("Aggregate [book")[0] + plan.toString().partition("Aggregate [book")[2].partition("\n")[0]
    assert fold.count("RLIKE") < 30 and fold.count("regexp_") < 40


def test_content_modes(spark):
    notes = ["12", "cf.", "NOTES", "[3]", "a short one", "another"]
    rows = [("b", p, i, t) for p in range(1, 8) for i, t in enumerate(notes)] + [("b", 8, 0, "A page with one long sentence of many words."), ("b", 9, 0, None)]
    regions = spark.createDataFrame(rows, "book string, page int, ord int, text string")
    pages = [(1, "chapter", "One", "simple"), (2, "index", "Index", "simple"), (3, "chapter", "One", "table"), (4, "chapter", " Nótes ", "simple"), (5, "chapter", "One", "aside"), (6, None, None, None), (7, "index", "", "table"), (8, "chapter", "Notes", "aside"), (9, "x", "Notes", "aside")]
    df = spark.createDataFrame([("b", *p) for p in pages], "book string, page int, entry_kind string, entry_title string, layout_kind string")
    got = {r.page: r.content_mode for r in C.content_modes(regions, df).collect()}
    assert got == {1: "prose", 2: "index", 3: "table", 4: "index", 5: "index", 6: "prose", 7: "index", 8: "prose", 9: "prose"}


def test_heading_is_searched_near_its_page_only(spark):
    pages = spark.createDataFrame([("b", i, "line\nThe Old Mill\nmore" if i in (3, 40) else "see the old mill today" if i == 22 else None) for i in range(1, 60)], "book string, page int, text string")
    entries = spark.createDataFrame([(1, "b", "theoldmill", 24), (2, "b", "theoldmill", 31), (3, "b", "theoldmill", 12), (4, "b", "", 9), (5, None, "theoldmill", 3)], "entry_id int, book string, key string, expected int")
    got = {r.entry_id: (r.page, r.score) for r in P.heading_pages(entries, pages).collect()}
    assert got == {1: (22, 85), 2: (40, 100), 3: (3, 100), 4: (9, None), 5: (3, None)}


def test_labels_get_their_digits_back(spark):
    df = spark.createDataFrame([("b", i, x) for i, x in enumerate([3, 12, 140, 52, 61, 210, 9, None, 300])], "book string, i int, label int")
    assert [r.repaired for r in P.repaired_labels(df, "book", "i").orderBy("i").collect()] == [3, 12, 140, 152, 161, 210, 309, 400]


@pytest.mark.parametrize(
    "line, heading, rest",
    [("The Mill", "the  mill", None), ("The Mill: a view", "The Mill", "a view"), ("A mill", "The Mill", "A mill"), ("", "x", ""), ("text", "", "text"), ("text", None, "text"), (None, "x", None)],
)
def test_heading_suppression(spark, line, heading, rest):
    df = spark.createDataFrame([(line, heading)], "a string, b string")
    found = df.select(P.without_heading(F.col("a"), F.coalesce("b", F.lit("")))).first()[0]
    assert found == rest


def test_projection_drops_what_is_no_text(spark):
    text = "# Head\n\nContext: a\n- one  two\n<!-- x -->\n_Source page 4_\nSource reference: y\nTable-like content from source page 3\nlast line"
    df = spark.createDataFrame([(text,), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(J.embedding_text(F.col("t"))).collect()] == ["one two last line", None, ""]


def test_boundaries_need_slices_on_both_sides(spark):
    ranges = spark.createDataFrame([("b", 1, 1, 5), ("b", 2, 5, 9), ("b", 3, 9, 9), ("b", 4, None, 3)], "book string, id int, start int, end int")
    overlaps = Q.adjacent_overlaps(ranges, "book")
    ids = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    assert [(r.left_id, r.right_id) for r in Q.intentional_boundaries(overlaps, ids, ids).collect()] == [(1, 2)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], REGIONS)
    assert C.adjacent_joins(none).count() == C.repair_pages(none).count() == C.note_lines(none, F.lit(True)).count() == 0
    files = spark.createDataFrame([(1, "b", None), (1, "a", "x"), (None, None, None)], "folder int, path string, text string")
    assert {(r.folder, r.n_files) for r in Q.folder_digests(files, "folder", "path", "text").collect()} == {(1, 2), (None, 1)}
    assert Q.first_seen(files, "folder", "path", "text").collect()[0].seen == "x"
