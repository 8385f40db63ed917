from lexigrove.operators import dense as D
from lexigrove.operators import retrieval as R

TEXTS = ["alpha beta gamma", "alpha alpha delta", "", "beta walking walked", "gamma delta epsilon alpha", None]
WEIGHTS = {"title": 2.0, "body": 1.0}


def corpus(spark, texts=TEXTS):
    rows = [(i, field, t) for i, text in enumerate(texts) for field, t in (("title", text), ("body", texts[i - 1]), ("other", "alpha"))]
    return spark.createDataFrame(rows, "doc_id long, field string, text string")


def probes(spark):
    return spark.createDataFrame([(7, "alpha walks"), (3, "beta delta beta"), (4, "zzz"), (5, "")], "probe_id long, query string")


def rows(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


def test_scores_are_made_where_rows_are_read(spark, monkeypatch):
    for f in (R.bm25, R.bm25_components, R.chargram_tfidf):
        got = rows(f(corpus(spark), probes(spark), WEIGHTS))
        with monkeypatch.context() as m:
            m.setattr(R, "BROADCAST_TERMS", 0)
            m.setattr(R, "BROADCAST_GRAMS", 0)
            assert got and got == rows(f(corpus(spark), probes(spark), WEIGHTS))
    plan = R.bm25_components(corpus(spark), probes(spark), WEIGHTS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_repeated_documents_score_once(spark):
    twice = corpus(spark).unionByName(corpus(spark))
    for f in (R.bm25, R.chargram_tfidf):
        keys = [r[:2] for r in rows(f(twice, probes(spark), WEIGHTS))]
        assert keys and len(keys) == len(set(keys))


def test_ranks_of_many_gold_documents(spark):
    scores = [("p", i, float(1 + i % 7)) for i in range(0, 40, 2)] + [("q", 3, 1.0)]
    gold = [("p", i) for i in range(0, 40, 3)] + [("q", i) for i in range(1, 9)] + [("r", 5)]
    got = {r.probe_id: r for r in R.probe_metrics(
        spark.createDataFrame(scores, "probe_id string, doc_id long, score double"),
        spark.createDataFrame(gold, "probe_id string, doc_id long"),
        spark.createDataFrame([(i, i + 1) for i in range(40)], "doc_id long, ord long"),
    ).collect()}
    for probe in "pqr":
        held = {d: s for p, d, s in scores if p == probe}
        order = sorted(range(40), key=lambda d: (-held.get(d, 0.0), d))
        mine = [d for p, d in gold if p == probe]
        ranks = [order.index(d) + 1 for d in mine]
        r = got[probe]
        assert (r.n_gold, r.best_rank) == (len(mine), min(ranks))
        assert (r.recall_at_3, r.recall_at_5) == tuple(round(sum(x <= k for x in ranks) / len(mine), 4) for k in (3, 5))
        assert r.margin == max(held.get(d, 0.0) for d in mine) - max(held.get(d, 0.0) for d in range(40) if d not in mine)


def test_neighbours_in_slices(spark, monkeypatch):
    vectors = [(i, [float(i % 5), float(i % 3), float("nan") if i == 17 else 1.0]) for i in range(60)]
    monkeypatch.setattr(D, "SCORES", 70)  # sent to the tasks with the function's globals
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in D.neighbours(df, df.filter("vec_id % 10 = 7"), 5, 40).collect())
    want = []
    for q, a in vectors:
        if q % 10 == 7 and q != 17:
            order = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in vectors if i not in (q, 17))
            want += [(q, k + 1, i) for k, (_, i) in enumerate(order[:5])]
    assert got == want


def test_scores_of_a_block_are_made_in_slices(spark):
    assert D.SCORES <= 1_000_000 < D.BLOCK * D.BLOCK
