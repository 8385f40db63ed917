import json
import random
import shutil

import pytest

from lexigrove.operators import dense as D
from lexigrove.operators import quality as Q
from lexigrove.operators import retrieval as R
from lexigrove.sources import sinks, tables
from lexigrove.streaming.probe import stream_event_counts, stream_issues


@pytest.mark.parametrize("left, right, kind", [((5, 12), (5, 12), "identical"), ((5, 12), (7, 11), "nested"), ((5, 12), (12, 15), "boundary"), ((5, 12), (10, 15), "overlap"), ((5, 12), (13, 15), None)])
def test_overlaps(spark, left, right, kind):
    df = spark.createDataFrame([("b", 1, *left), ("b", 2, *right)], "book string, id int, start int, end int")
    assert [r.kind for r in Q.adjacent_overlaps(df, "book").collect()] == ([kind] if kind else [])


def test_edges(spark):
    rows = [("a", 0, "lower start here."), ("a", 1, "ends in regard-"), ("b", 0, "Fine"), ("b", 1, ""), ("b", 2, "goes on with the"), ("c", 0, "said “so of.”"), ("d", 0, None)]
    got = {(r.id, r.code) for r in Q.block_edge_issues(spark.createDataFrame(rows, "id string, ord int, text string")).collect()}
    assert got == {("a", "block_lowercase_start"), ("a", "block_hyphen_end"), ("b", "block_dangling_end"), ("c", "block_lowercase_start")}


def test_assertions(spark):
    texts = spark.createDataFrame([("p", "one\nTwo")], "path string, text string")
    checks = spark.createDataFrame([("c", "p", ["one", "x"], ["Two"], ["^Two$"], ["^o"]), ("n", "q", None, None, None, None)], "check_id string, path string, must_contain array<string>, must_not_contain array<string>, must_match array<string>, must_not_match array<string>")
    assert {(r.check_id, r.code, r.detail) for r in Q.check_assertions(texts, checks).collect()} == {
        ("c", "missing_required_substring", "x"), ("c", "forbidden_substring_present", "Two"), ("c", "forbidden_pattern_present", "^o"), ("n", "missing_target_file", "q"),
    }


def test_gate(spark):
    schema = "run string, metric string, value double"
    base = spark.createDataFrame([("r", "mrr", 0.9), ("r", "hit", 1.0), ("r", "old", 1.0)], schema)
    now = spark.createDataFrame([("r", "mrr", 0.8995), ("r", "hit", 0.99), ("r", "new", 1.0)], schema)
    assert {r.metric: r.verdict for r in Q.gate_metrics(now, base, 0.001).collect()} == {"mrr": "ok", "hit": "regressed", "old": "missing_current", "new": "new_metric"}


def test_backend(spark):
    rows = [("a", True, True, 5.0, 1.0, 0.9, 0.9), ("b", True, True, 4.0, 1.0, 0.9, 0.9), ("c", True, False, 1.0, 1.0, 1.0, 1.0), ("d", False, True, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "backend_id string, success boolean, manifest_hash_match boolean, runtime_seconds double, twin_hit_at_1 double, twin_mrr double, mean_twin_cosine double")
    assert [r.backend_id for r in Q.select_backend(df).collect()] == ["b"]


def test_signature_ignores_order(spark):
    df = spark.createDataFrame([(i, f"t{i % 3}") for i in range(50)], "a int, b string")
    one = Q.run_signature(df).first()[0]
    assert one == Q.run_signature(df.orderBy("b").select("b", "a")).first()[0] != Q.run_signature(df.union(df.limit(1))).first()[0]


def test_worst(spark):
    schema = "severity string"
    assert [Q.worst(spark.createDataFrame([(s,) for s in x], schema)).first()[0] for x in ([], ["warn"], ["warn", "fail"])] == ["pass", "warn", "fail"]


def test_fusion_ranks_unscored_documents(spark):
    schema = "probe_id int, doc_id int, score double"
    a, b = spark.createDataFrame([(1, 3, 2.0), (1, 2, 1.0)], schema), spark.createDataFrame([(1, 4, 1.0)], schema)
    ordinal = spark.createDataFrame([(i, i) for i in range(1, 6)], "doc_id int, ord int")
    got = {r.doc_id: r.score for r in R.fuse([a, b], ordinal).collect()}
    # behind the scored ones: run a ranks 3, 2, 1, 4, 5 and run b ranks 4, 1, 2, 3, 5
    want = {3: 1 / 61 + 1 / 64, 2: 1 / 62 + 1 / 63, 4: 1 / 64 + 1 / 61}
    assert got == {k: round(v, 6) for k, v in want.items()}


def test_neighbours_in_blocks(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(30)], "vec_id long, embedding array<double>")
    one, many = (sorted(map(tuple, D.neighbours(df, df.filter("vec_id % 5 = 0"), 3, block=b).collect())) for b in (100, 2))
    assert one == many and len(one) == 18


def test_containing(spark):
    docs = spark.createDataFrame([(1, "a needle here"), (2, None), (3, "hay"), (4, "sineedles hereafter"), (5, "a  needle here")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "needle"), (8, "ha"), (9, ""), (10, "needle"), (11, None), (12, "a needle h"), (13, "no such words here"), (14, "eedle her")], "item_id long, text string")
    assert sorted(map(tuple, R.containing(docs, items).collect())) == [(7, 1), (7, 4), (7, 5), (8, 3), (10, 1), (10, 4), (10, 5), (12, 1), (14, 1), (14, 5)]
    assert R.containing(docs, items.limit(0)).collect() == R.containing(docs.limit(0), items).collect() == []


def test_containing_equals_plain_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect() if r.text}
    pick = random.Random(1)
    items = []
    for i in range(60):
        text = pick.choice(list(texts.values()))
        at = pick.randrange(len(text))
        items.append((i, text[at : at + pick.choice((1, 3, 12, 40, 200))] + pick.choice(("", "", "x"))))
    got = {tuple(r) for r in R.containing(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(i, d) for i, item in items for d, text in texts.items() if item in text}


def test_metrics_rank_all_documents(spark):
    """Gold documents without a score stand behind the scored ones, in the order of their ids."""
    scores = spark.createDataFrame([(1, 3, 2.0), (1, 5, 2.0), (1, 1, 1.0), (2, 4, 1.0)], "probe_id int, doc_id int, score double")
    gold = spark.createDataFrame([(1, 5), (1, 2), (2, 3), (3, 6), (2, 3)], "probe_id int, doc_id int")
    ordinal = spark.createDataFrame([(i, i) for i in range(1, 7)], "doc_id int, ord long")
    got = {r.probe_id: (r.n_gold, r.best_rank, r.mrr, r.hit_at_1, r.recall_at_3, r.recall_at_5, r.margin) for r in R.probe_metrics(scores, gold, ordinal).collect()}
    # probe 1: 3, 5, 1, 2, 4, 6; probe 2: 4, 1, 2, 3, 5, 6; probe 3: in order
    assert got == {1: (2, 2, 0.5, 0.0, 0.5, 1.0, 0.0), 2: (1, 4, 0.25, 0.0, 0.0, 1.0, -1.0), 3: (1, 6, 0.1667, 0.0, 0.0, 0.0, 0.0)}
    alone = R.probe_metrics(scores.limit(0), spark.createDataFrame([(1, 1)], "probe_id int, doc_id int"), ordinal.limit(1)).first()
    assert (alone.best_rank, alone.mrr, alone.margin) == (1, 1.0, None)


def test_names_are_checked(spark):
    assert R.profile("body_bm25") == R.PROFILES["body_bm25"]
    with pytest.raises(ValueError, match="unknown profile"):
        R.profile("other")
    corpora = spark.createDataFrame([("a",), ("b",), (None,)], "corpus string")
    assert R.known_only(["b", "none", "a"], corpora) == ["b", "a"]


def test_bundle(spark, tmp_path):
    folder = f"file://{tmp_path}/bundle"
    texts = spark.createDataFrame([("body/a.md", "alpha é"), ("body/b.md", "beta")], "path string, text string")
    assert sinks.write_files(texts, folder).count() == 2
    (tmp_path / "bundle/metadata.json").write_text(json.dumps({"file_manifest": [{"entry_id": "1", "output_path": "body/a.md", "pdf_page_start": 3}, {"entry_id": "2", "output_path": "body/none.md"}]}))
    back = tables.read_texts(spark, f"{tmp_path}/bundle")
    assert sorted(map(tuple, back.collect())) == [("body/a.md", "alpha é"), ("body/b.md", "beta")]
    joined = tables.manifest_texts(tables.read_manifest(spark, folder), back).orderBy("manifest_ord").collect()
    assert [(r.entry_id, r.text, r.pdf_page_start) for r in joined] == [("1", "alpha é", 3), ("2", None, None)]
    assert tables.file_digests(spark, f"{tmp_path}/bundle/body").count() == 2


def test_streams(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    shutil.copy(f"{folder}/documents.parquet", tmp_path)
    schema = spark.read.parquet(f"{folder}/documents.parquet").schema
    stream = stream_issues(spark, str(tmp_path), schema)
    q = stream.writeStream.format("memory").queryName("issues").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    want = Q.repeated_word_issues(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id", "text").count()
    assert spark.table("issues").count() == want
    assert stream_event_counts(spark.read.parquet(f"{folder}/events.parquet")).count() > 0


def test_alike_issues_stay_apart(spark):
    issues = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id int, code string")
    scopes = spark.createDataFrame([(1, "target", "a"), (2, "holdout", None)], "scope_ord int, `group` string, code string")
    assert sorted((r.id, r.group) for r in Q.scope_matches(issues, scopes, ["code"]).collect()) == [(1, "target"), (1, "target"), (2, "holdout")]
