import pytest
from pyspark.sql import functions as F

from lexigrove.operators import gate as G
from lexigrove.operators import layout as L


@pytest.mark.parametrize("text, y0, want", [
    ("The rain had come down for days on end, and nobody in the valley remembered a spring so wet.", 37.34, False), ("Part IV: Bread, Salt, Honey", 19.8, True),
    ("Part IV: Bread, Salt, Honey", 35.08, True), ("xiv", 40.0, True), ("12", 43.0, False), ("", 10.0, False), ("y" * 121, 10.0, False), ("Plain words in a row here", 41.0, True), ("Plain words in a row here that go on for ten", 41.0, False), ("PLAIN WORDS", 41.0, False),
])
def test_margin(spark, text, y0, want):
    assert spark.range(1).select(L.top_margin(F.lit(text), F.lit(y0))).first()[0] is want


@pytest.mark.parametrize("x0, x1, want", [(0.0, 100.0, "left"), (200.0, 400.0, "center"), (500.0, 600.0, "right")])
def test_zone(spark, x0, x1, want):
    assert spark.range(1).select(L.zone(F.lit(x0), F.lit(x1), F.lit(600.0))).first()[0] == want


def test_slices(spark):
    lines = spark.createDataFrame([(1, float(y)) for y in (10, 20, 30)], "page int, y0 double")
    slices = spark.createDataFrame([("a", 1, None, 20.0), ("b", 1, 20.0, None)], "entry_id string, page int, min_y double, max_y double")
    assert sorted((r.entry_id, r.y0) for r in L.sliced(lines, slices).collect()) == [("a", 10.0), ("b", 20.0), ("b", 30.0)]


def test_profiles(spark):
    long, short = "a line of text that is long enough", "short"
    rows = [("simple", long, 50.0, 60.0 + i, 10.0) for i in range(9)]
    rows += [("table", "TABLE 2. Yields", 50.0, 60.0, 10.0)]
    rows += [("aside", long, 200.0, 60.0 + i, 8.0 if i < 2 else 10.0) for i in range(9)]
    rows += [("columns", short, x, 60.0 + i, 10.0) for x in (10.0, 60.0, 110.0) for i in range(2)]
    df = spark.createDataFrame(rows + [("top", long, 50.0, 10.0, 10.0), ("simple", " ", 1.0, 1.0, 1.0)], "page string, text string, x0 double, y0 double, size double")
    got = {r.page: (r.kind, r.body_lines) for r in L.page_profiles(df, "page").collect()}
    assert got == {"simple": ("simple", 9), "table": ("table", 1), "aside": ("aside", 9), "columns": ("multi-column", 6), "top": ("simple", 1)}


def test_gate(spark):
    codes = spark.createDataFrame([("a",), ("b",), ("b",)], "code string")
    allowed = spark.createDataFrame([("a",)], "code string")
    verdicts = spark.createDataFrame([("r", "mrr", "ok"), ("r", "hit", "regressed")], "run string, metric string, verdict string")
    report = G.gate_report(G.unexpected_codes(codes, allowed, "probe", "new code"), G.too_many(codes, 2, "probe"), G.metric_failures(verdicts, "retrieval"))
    got = {r.gate: (r.failures, r.messages) for r in report.collect()}
    assert got == {"probe": (2, ["more than 2 issues: 3", "new code: b"]), "retrieval": (1, ["r hit regressed"])}


def test_runtime_hides_instability(spark):
    attempts = spark.createDataFrame([(1, 1, False), (1, 2, True), (2, 1, True)], "run int, attempt int, success boolean")
    signatures = spark.createDataFrame([(1, "x"), (2, "y")], "run int, signature string")
    assert [r.gate for r in G.runtime_failures(attempts, signatures).collect()] == ["stability"]
    assert [r.gate for r in G.runtime_failures(attempts.filter("attempt = 1"), signatures).collect()] == ["runtime"]
    assert G.runtime_failures(attempts, signatures.filter("run = 1")).count() == 0


def test_manual_sample(spark):
    sample = spark.createDataFrame([("a", "pass"), ("b", "fail"), ("c", None)], "scope_id string, verdict string")
    assert sorted(r.message for r in G.manual_failures(sample, 2).collect()) == ["fewer than 2 passed", "not passed: b", "not passed: c"]
