import hashlib

import pytest
from helpers import edge_docs, empty_docs

from lexigrove.llm.exact_dedup import digest_runs, exact_dedup, merge_runs


@pytest.mark.parametrize("keep, best", [("largest", max), ("smallest", min)])
def test_edges(spark, keep, best):
    docs = edge_docs(spark)
    groups = {}
    for r in docs.collect():
        groups.setdefault(r.text or "", []).append(r.doc_id)
    got = exact_dedup(docs, keep).collect()
    assert len(got) == docs.count()
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): (best(ids, key=lambda x: (x is not None, x or 0)), len(ids)) for t, ids in groups.items()}
    for r in got:
        assert (r.keep_id, r.group_size) == by_hash[r.text_sha256]
    assert sum(r.kept for r in got) == len(groups)


def test_empty(spark):
    assert exact_dedup(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("runs, fan_in", [(1, 2), (5, 2), (16, 4), (7, 3)])
def test_tree_shapes_agree(spark, runs, fan_in):
    docs = spark.createDataFrame([(i, f"t{i % 7}") for i in range(200)], "doc_id long, text string")
    got = exact_dedup(docs, "smallest", runs, fan_in).collect()
    assert {(r.doc_id, r.keep_id) for r in got} == {(i, i % 7) for i in range(200)}
    assert {r.doc_id for r in got if r.kept} == set(range(7))


def test_native(spark):
    plan = exact_dedup(edge_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas"))


def test_rounds_merge_sorted_runs(spark):
    rows = digest_runs(edge_docs(spark), 4)
    plan = merge_runs(rows, 4, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 3 and "FullOuter" in plan and "Aggregate" not in plan
