"""Spans of a line, and heading bands against all runs of lines."""

import pytest
from pyspark.sql import functions as F

from lexigrove.operators import spans as N

SPANS = "book string, page int, ord int, text string, x0 double, y0 double, x1 double, y1 double"


def line(texts, gaps=None, y=None, page=1):
    """Spans of 50 points, with gaps between them and their baselines."""
    rows, x = [], 10.0
    for i, text in enumerate(texts):
        x += (gaps or [5] * len(texts))[i]
        top = 100.0 + (y or [0] * len(texts))[i]
        rows.append(("b", page, i, text, x, top, x + 50, top + 12))
        x += 50
    return rows


@pytest.mark.parametrize(
    "rows, titles, want",
    [
        (line(["One", "two", "Three"]), False, ["One two", "Three"]),
        (line(["a com-", "Mon word"]), False, ["a com-Mon word"]),
        (line(["a com-", "3a) note"]), False, ["a com-", "3a) note"]),
        (line(["a", "“b", "(c", "7"]), False, ["a “b (c 7"]),
        (line(["a", "b"], gaps=[0, 16]), False, ["a b"]),
        (line(["a", "b"], gaps=[0, 17]), False, ["a", "b"]),
        (line(["a", "b"], gaps=[0, -1]), False, ["a", "b"]),
        (line(["a", "b"], y=[0, 1.5]), False, ["a b"]),
        (line(["a", "b"], y=[0, 1.6]), False, ["a", "b"]),
        (line(["a", "b", "c"], y=[0, 1, 2]), False, ["a b", "c"]),
        (line(["A.", "Mill"]), False, ["A.", "Mill"]),
        (line(["A.", "Mill"]), True, ["A. Mill"]),
        (line(["PART", "Two"]), True, ["PART Two"]),
        (line(["PART OF IT", "Two"]), True, ["PART OF IT", "Two"]),
        (line(["PART", "XIV"]), True, ["PART XIV"]),
        (line(["a", " ", "b"]), False, ["a", " ", "b"]),
        (line(["a", None, "b"]), False, ["a", "", "b"]),
        ([], False, []),
    ],
)
def test_collapsed(spark, rows, titles, want):
    found = N.collapsed(spark.createDataFrame(rows, SPANS), titles).orderBy("ord").collect()
    assert [r.text for r in found] == want
    assert sum(r.spans for r in found) == len(rows)


def test_boxes_hold_their_spans(spark):
    rows = line(["One", "two", "three", "Four"], y=[0, 1, 0.5, 0])
    found = N.collapsed(spark.createDataFrame(rows, SPANS)).orderBy("ord").collect()
    assert [(r.x0, r.y0, r.x1, r.y1, r.spans) for r in found] == [(15.0, 100.0, 175.0, 113.0, 3), (180.0, 100.0, 230.0, 112.0, 1)]


@pytest.mark.parametrize(
    "text, want",
    [("The Old Mill of the North", True), ("The old mill", False), ("2. The Old Mill", True), ("iv. Of the Mill", True), ("", False), ("12", False), ("Barn " * 15, False), ("The Mill and a Tale of it all", True)],
)
def test_title_style(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(N.title_style(F.col("t"))).first()[0] is want


LINES = "book string, page int, text string, x0 double, y0 double, x1 double, y1 double"


def page(texts, x=None, step=14.0):
    return [("b", 1, t, (x or [20.0] * len(texts))[i], 50.0 + i * step, 300.0, 60.0 + i * step) for i, t in enumerate(texts)]


def bands(spark, rows, variants, prefer="last"):
    entries = spark.createDataFrame([(1, "b", 1, variants)], "entry_id int, book string, page int, variants array<string>")
    found = N.heading_bands(entries, spark.createDataFrame(rows, LINES), prefer).collect()
    return [(r.top, r.bottom, r.match_type) for r in found]


def test_bands(spark):
    body = "and some words of the text that go on"
    assert bands(spark, page([body, "The Old Mill", body]), ["The Old Mill"]) == [(62.0, 76.0, "exact")]
    two = page([body, "The Old Mill of", "the Northern Shore", body, "The Old Mill"])
    assert bands(spark, two, ["The Old Mill of the Northern Shore"]) == [(62.0, 90.0, "exact")]
    assert bands(spark, two, ["The Old Mill of the Northern Shore", "The Old Mill"]) == [(104.0, 118.0, "exact")]
    assert bands(spark, two, ["The Old Mill of the Northern Shore", "The Old Mill"], "first") == [(62.0, 90.0, "exact")]
    assert bands(spark, page(["The Old Mill of", "the Northern Shore"], x=[20.0, 80.0]), ["The Old Mill of the Northern Shore"]) == []
    assert bands(spark, page(["The Old Mill of", "the Northern Shore"], step=30.0), ["The Old Mill of the Northern Shore"]) == []
    assert bands(spark, page([body]), ["The Old Mill"]) == bands(spark, page([None, ""]), ["The Old Mill"]) == []
    with pytest.raises(ValueError):
        bands(spark, page([body]), ["The Old Mill"], "any")


def test_every_run_of_lines_is_tried(spark):
    """Runs are just those that an exhaustive look over the page allows."""
    texts = ["The First", "Part of It", "and Some", "More Words Than Are Allowed In One Line Of It", "Last Words", "of a Page"]
    rows = page(texts, x=[20.0, 30.0, 80.0, 20.0, 20.0, 72.0])
    found = {(r.first, r.n_lines): r.text for r in N.heading_runs(spark.createDataFrame(rows, LINES)).collect()}
    styled = {t: spark.createDataFrame([(t,)], "t string").select(N.title_style(F.col("t"))).first()[0] for k in (1, 2, 3) for i in range(6) for t in [" ".join(texts[i : i + k])]}
    want = {(i + 1, 1): t for i, t in enumerate(texts)}
    for i in range(6):
        for k in (2, 3):
            run = rows[i : i + k]
            fits = len(run) == k and len(run[0][2].split()) <= 5 and all(len(r[2].split()) <= 6 and abs(r[3] - run[0][3]) <= 52 for r in run[1:])
            if fits and styled[texts[i]] and styled[" ".join(r[2] for r in run)]:
                want[i + 1, k] = " ".join(r[2] for r in run)
    assert found == want and len(want) > 7


def test_headings_are_prepared_before_they_meet(spark):
    """Keys of lines and variants are made once for each, not for each pair of them."""
    entries = spark.createDataFrame([(1, "b", 1, ["A Title"])], "entry_id int, book string, page int, variants array<string>")
    lines = spark.createDataFrame([("b", 1, "A Title", 0.0, 40.0, 300.0, 50.0)], LINES)
    plan = N.heading_bands(entries, lines)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("Join") < plan.index("ArrowEvalPython")
