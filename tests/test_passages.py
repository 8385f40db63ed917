"""Passages from literal pages, the machine against single steps, and what no rule may do."""

import random

import pytest
from pyspark.sql import functions as F

from lexigrove.operators import passages as G
from lexigrove.operators import scan
from lexigrove.plans.queries import QUERIES

SCHEMA = "book string, page int, page_label string, ord int, role string, zone string, layout_kind string, content_mode string, text string, x0 double, y0 double, x1 double, y1 double"


def region(page, ord_, text, zone="center", y0=None, role="main", mode="prose", book="b"):
    x0 = {"left": 40.0, "center": 150.0, "right": 330.0}[zone]
    top = 60.0 + 40 * ord_ if y0 is None else float(y0)
    return (book, page, f"p{page}", ord_, role, zone, "simple", mode, text, x0, top, x0 + 150, top + 12)


def book(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def buckets(spark, rows):
    found = G.bucketed(G.flatten(book(spark, rows)))
    return [(r.passage, r.bucket, r.inherited) for r in found.orderBy("page", "seq").collect()]


def built(spark, rows, repaired=True):
    found = G.passages(book(spark, rows)) if repaired else G.assembled(G.bucketed(G.flatten(book(spark, rows))))
    return {r.passage_id: (r.citation, r.commentary, r.reference) for r in found.orderBy("passage").collect()}


# the machine


@pytest.mark.parametrize("fan", [2, 3, 64])
def test_prefix_states_equal_single_steps(spark, fan):
    rng = random.Random(fan)
    groups = {"long": 700, "one": 1, None: 40}
    rows, want = [], {}
    for g, n in groups.items():
        state = 2
        for pos in sorted(rng.sample(range(-50, 5000), n)):
            step = [rng.randrange(4) for _ in range(4)]
            rows.append((g, pos, step))
            want[g, pos] = state
            state = step[state]
    rng.shuffle(rows)
    maps = spark.createDataFrame(rows, "book string, pos long, map array<int>")
    got = {(r.book, r.pos): r.state for r in scan.prefix_states(maps, "book", 4, start=2, fan=fan).collect()}
    assert got == want
    assert scan.prefix_states(maps.limit(0), "book", 4).collect() == []


def test_a_fold_never_holds_more_than_the_fan(spark):
    maps = spark.range(1000).select(F.lit("b").alias("book"), F.col("id").alias("pos"), F.array(F.lit(1), F.lit(0)).alias("map"))
    level = scan._folded(maps, "book", 2, 8)
    assert level.select(F.max(F.size("members"))).first()[0] == 8
    assert {(r.pos % 2, r.state) for r in scan.prefix_states(maps, "book", 2, fan=8).collect()} == {(0, 0), (1, 1)}


# texts


@pytest.mark.parametrize(
    "text, want",
    [
        ("- A list\n* of  lines", "A list of lines"),
        ("a com-\nmon word", "a common word"),
        ("at the\nThe mill", "at the mill"),
        ("one\n\n two", "one two"),
        ("see you\nyou there", "see you there"),
        (" \n", ""),
        (None, ""),
    ],
)
def test_region_text(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(G.region_text(F.col("t"))).first()[0] == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("3b) [Old Source 12] The words", ("3b", "[Old Source 12]", "The words")),
        ("- 10A)The words stand here in full.", ("10a", "", "The words stand here in full.")),
        ("2c)", ("2c", "", "")),
        ("2c) Miller Tales", ("2c", "Miller Tales", "")),
        ("2c) Miller tales", ("2c", "", "Miller tales")),
        ("2c) Derrida 1967 33 as he says", ("2c", "Derrida 1967 33", "as he says")),
        ("2c) [unclosed words", ("2c", "", "[unclosed words")),
        ("22) no letter", None),
        ("see 2c) inside", None),
        ("", None),
    ],
)
def test_anchor(spark, text, want):
    found = spark.createDataFrame([(text,)], "t string").select(G.anchor_of(F.col("t")).alias("a")).first().a
    assert (tuple(found) if found else None) == want


def test_fragments_begin_at_embedded_anchors(spark):
    df = spark.createDataFrame([("before it 2a) first 3b) second",), ("1a) only",), ("x2a) not one",), ("",)], "t string")
    assert [r[0] for r in df.select(G.fragments_of(F.col("t"))).collect()] == [["before it", "2a) first", "3b) second"], ["1a) only"], ["x2a) not one"], []]


# buckets


def test_zones_decide_after_an_anchor(spark):
    rows = [
        region(1, 0, "Words before any anchor stand here."), region(1, 1, "Words at the side.", role="aside"), region(1, 2, "1a) The cited words are these.", "left"),
        region(1, 3, "More of the cited words.", "left"), region(1, 4, "What is said of them in full.", "right"), region(1, 5, "[Source 3]", "right"),
    ]
    assert buckets(spark, rows) == [(0, "commentary", False), (0, "reference", False), (1, "citation", False), (1, "citation", False), (1, "commentary", False), (1, "reference", False)]


def test_a_bucket_is_inherited_over_the_page(spark):
    rows = [region(1, 0, "1a) The cited words.", "left"), region(1, 1, "A comment that has not come to", "right", y0=500), region(2, 0, "its end yet.", "left", y0=50), region(2, 1, "Cited again in full.", "left", y0=200)]
    far = [region(1, 0, "1a) The cited words.", "left"), region(1, 1, "A comment that has not come to", "left", y0=500), region(2, 0, "its end yet.", "left", y0=50)]
    assert built(spark, far, repaired=False) == {"1a": (["The cited words.", "A comment that has not come to its end yet."], [], [])}
    # columns too far apart don't go on in each other
    assert [b for _, b, _ in buckets(spark, rows)] == ["citation", "commentary", "citation", "citation"]


def test_a_fragment_moves_behind_the_next_anchor(spark):
    rows = [region(1, 0, "1a) The cited words.", "left", y0=60), region(1, 1, "what the next one says", "right", y0=150), region(1, 2, "2b) Other words.", "left", y0=160), region(1, 3, "More words here.", "left", y0=200)]
    assert buckets(spark, rows) == [(1, "citation", False), (2, "citation", False), (2, "commentary", False), (2, "citation", False)]
    assert built(spark, rows, repaired=False)["2b"] == (["Other words.", "More words here."], ["what the next one says"], [])


def test_a_short_lead_is_a_citation(spark):
    rows = [region(1, 0, "1a)", "left"), region(1, 1, "A short lead."), region(1, 2, "Another short one."), region(1, 3, "[12]"), region(1, 4, "2b)", "left"), region(1, 5, "[12]"), region(1, 6, "Short lead now")]
    assert [b for _, b, _ in buckets(spark, rows)] == [None, "citation", "commentary", "reference", None, "reference", "commentary"]


def test_a_centred_anchor_takes_the_zone_beside_it(spark):
    beside = [region(1, 0, "1a)", y0=100), region(1, 1, "[9]", "left", y0=104), region(1, 2, "These are the words that are cited here.", "right", y0=106), region(1, 3, "More of the words that are cited.", "right", y0=150)]
    below = [region(1, 0, "1a)", y0=100), region(1, 1, "These are the words that stand too low.", "right", y0=120)]
    assert [b for _, b, _ in buckets(spark, beside)] == [None, "reference", "citation", "citation"]
    assert [b for _, b, _ in buckets(spark, below)] == [None, "commentary"]


def test_notes_at_the_foot_go_on(spark):
    rows = [region(1, 0, "1a) Words.", "left"), region(1, 1, "[12]", "right", y0=530), region(1, 2, "what the note goes on to say about it all.", "right", y0=545), region(2, 0, "A sentence of the comment.", "right")]
    assert [b for _, b, _ in buckets(spark, rows)] == ["citation", "reference", "reference", "commentary"]


def test_passages_stay_open_over_pages_and_books_apart(spark):
    rows = [region(p, 0, "Cited words of this page.", "left") for p in range(2, 150)] + [region(1, 0, "1a) Words.", "left"), region(1, 0, "A book without anchors.", book="c")]
    found = {(r.book, r.passage_id): len(r.citation) + len(r.commentary) for r in G.passages(book(spark, rows)).collect()}
    assert found == {("b", "1a"): 149, ("c", "preamble-01"): 1}


# repairs


def boundary(name, first, second, label, pages):
    """Two passages of a book, with the parts of their commentaries."""
    rows = [region(pages[0], 0, "1a) Cited words.", "left", y0=60), *(region(pages[0], 1 + i, t, "right", y0=120 + 40 * i) for i, t in enumerate(first))]
    rows += [region(pages[1], 20, f"{label}) Other cited words.", "left", y0=600), *(region(pages[1], 21 + i, t, "right", y0=680 + 60 * i) for i, t in enumerate(second))]
    return [(name, *r[1:]) for r in rows]


LONG = "Here are very many words that make up a sentence of a comment which has already come to its end before the next begins. Then a tail of it"


BOUNDARIES = [
    (["All of it is said.", "a tail without"], ["its end here."], "2b", (1, 1), [["All of it is said."], ["a tail without its end here."]]),
    (["All is said. Then the"], ["the end of it."], "2b", (1, 2), [[], ["All is said. Then the end of it."]]),
    (["a broken wo-"], ["rd here."], "2b", (1, 1), [[], ["a broken word here."]]),
    (["a tail without"], ["Its end here."], "2b", (1, 1), [["a tail without"], ["Its end here."]]),
    (["All of it is said."], ["its end here."], "2b", (1, 1), [["All of it is said."], ["its end here."]]),
    (["a tail without"], ["its end here."], "2b", (1, 3), [["a tail without"], ["its end here."]]),
    ([LONG + " and more" * 12], ["its end here."], "2b", (1, 1), [[LONG + " and more" * 12], ["its end here."]]),
    ([LONG + " and more" * 12], ["its end here."], "1a", (1, 1), [[LONG.rpartition(". ")[0] + "."], ["Then a tail of it" + " and more" * 12 + " its end here."]]),
    (["All said. Then a"], ["its end here."], "1a", (1, 1), [["All said."], ["Then a its end here."]]),
]


def test_commentary_boundaries(spark):
    rows = [r for i, case in enumerate(BOUNDARIES) for r in boundary(f"b{i}", *case[:4])]
    got = {}
    for r in G.passages(book(spark, rows)).orderBy("book", "passage").collect():
        got.setdefault(r.book, []).append(r.commentary)
    assert got == {f"b{i}": case[4] for i, case in enumerate(BOUNDARIES)}


def test_moves_follow_each_other(spark):
    rows = []
    for k, text in enumerate(["the first part of", "a long sentence which", "goes on in the third of", "these passages."]):
        rows += [region(1, 10 * k, f"{k + 1}a) Cited words.", "left", y0=100 + 200 * k), region(1, 10 * k + 1, text, "right", y0=200 + 200 * k)]
    got = [(r.commentary, r.pages) for r in G.passages(book(spark, rows)).orderBy("passage").collect()]
    assert got == [([], [1]), ([], [1]), ([], [1]), (["the first part of a long sentence which goes on in the third of these passages."], [1])]


def test_bibliography_moves_to_the_references(spark):
    parts = [(["A comment.", "Miller, Anna, wrote it.", "See Baker, Tom, Old Tales (North Press)."], ["[1]"]), (["Miller, Anna, wrote it."], []), (["Miller, Anna, wrote it.", "A comment."], ["[1]"]), ([], ["[1]"]), (["Miller, Anna."], ["[1]"])]
    df = spark.createDataFrame([(i, c, r) for i, (c, r) in enumerate(parts)], "i int, commentary array<string>, reference array<string>")
    got = [(r.commentary, r.reference) for r in G.bibliography_moved(df).orderBy("i").collect()]
    assert got == [(["A comment."], ["Miller, Anna, wrote it.", "See Baker, Tom, Old Tales (North Press).", "[1]"]), *parts[1:4], ([], ["Miller, Anna.", "[1]"])]


def test_page_labels_move_with_the_text(spark):
    rows = [region(1, 0, "1a) Cited.", "left"), region(1, 1, "a tail without", "right", y0=500), region(2, 0, "2b) Cited.", "left"), region(2, 1, "its end.", "right", y0=300)]
    assert [(r.page_labels, r.pages) for r in G.passages(book(spark, rows)).orderBy("passage").collect()] == [(["p1"], [1]), (["p1", "p2"], [1, 2])]


def test_merged(spark):
    df = spark.createDataFrame([(["One is said.", "Two is not quite", "done yet.", "At the", "the end"],), (["a com-", "mon word"],), ([],), (["first\n\n\n\nSecond is a sentence of its own that has many words."],)], "p array<string>")
    assert [r[0] for r in df.select(G.merged(F.col("p"))).collect()] == ["One is said.\n\nTwo is not quite done yet.\n\nAt the end", "a common word", "", "first\n\nSecond is a sentence of its own that has many words."]


def test_edges(spark):
    none = book(spark, [])
    assert G.passages(none).collect() == [] and G.bucketed(G.flatten(none)).collect() == []
    rows = [region(1, 0, None), region(1, 1, " "), (None, 1, None, 0, None, None, None, None, "1a) words", None, None, None, None), ("b", 1, None, 2, None, "left", None, None, "words", None, None, None, None)]
    assert {(r.book, r.passage_id) for r in G.passages(book(spark, rows)).collect()} == {(None, "1a"), ("b", "preamble-01")}


def test_nothing_is_lost(spark):
    """Every passage with a bucket is built, once, and none without."""
    key = lambda df: [(r.book, r.passage) for r in df.select("book", "passage").collect()]
    found = key(QUERIES["passages_repaired"](spark, "/root/testdata/sf0.001"))
    assert len(found) == len(set(found)) > 500
    assert set(found) == set(key(QUERIES["passage_buckets"](spark, "/root/testdata/sf0.001").filter("bucket IS NOT NULL")))


def test_fragments_are_shuffled_once(spark):
    """By book; neither the buckets nor the repairs meet the fragments with themselves again."""
    regions = book(spark, [region(1, 0, "1a) Words.", "left"), region(1, 1, "a tail without", "right")])
    for found in (G.bucketed(G.flatten(regions)), G.passages(regions)):
        plan = found._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_fragments_are_sorted_twice(spark):
    """As they are read and as passages hold them; texts stand in one column each time, and facts of them elsewhere."""
    plan = G.bucketed(G.flatten(book(spark, [region(1, 0, "1a) Words.", "left")])))._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    assert plan.count("Sort [") == 2 and plan.count("Window [") <= 8


def test_forced_fragments_go_on_in_each_other(spark):
    """The first behind an anchor begins a part, even if it goes on in what stands before the anchor; a second may be joined to it."""
    rows = [
        region(1, 0, "1a) The cited words.", "left", y0=60), region(1, 1, "A comment that goes", "right", y0=100), region(1, 2, "on and on to", "right", y0=114),
        region(1, 3, "what comes", "right", y0=126), region(1, 4, "2b) Other words.", "left", y0=130),
    ]
    assert built(spark, rows, repaired=False)["2b"][1] == ["on and on to what comes"]


def test_an_anchor_without_a_page_keeps_its_fragments(spark):
    rows = [("b", None, *region(1, 0, "1a) Words.", "left")[2:]), ("b", None, *region(1, 1, "Cited words stand here in full.", "left")[2:])]
    assert [(r.passage, r.bucket) for r in G.bucketed(G.flatten(book(spark, rows))).orderBy("seq").collect()] == [(1, "citation"), (1, "citation")]
