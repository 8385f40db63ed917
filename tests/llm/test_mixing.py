import itertools
import re

import pytest
from helpers import SMALL, edge_docs, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from lexigrove.llm import mixing as M
from lexigrove.llm.queries import op7_mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights, total, cap):
    """Reshare the excess until nobody is above the cap."""
    out = dict.fromkeys(sizes, 0.0)
    done = set()
    while True:
        left = total - sum(out[s] for s in done)
        rest = [s for s in sizes if s not in done]
        w = sum(weights[s] for s in rest)
        for s in rest:
            out[s] = left * weights[s] / w
        over = [s for s in rest if out[s] > cap * sizes[s]]
        if not over:
            return out
        for s in over:
            out[s] = cap * sizes[s]
            done.add(s)


def test_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = op7_mixing(spark, SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, op7_mixing(spark, SMALL).collect()))
    assert len(got) == len(docs)
    sizes = {}
    for r in docs.values():
        sizes[r.source] = sizes.get(r.source, 0) + len(WORD.findall(r.text or ""))
    order = sorted(sizes)
    want = targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, sum(sizes.values()), 3)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        source = docs[r.doc_id].source
        assert r.size == len(WORD.findall(docs[r.doc_id].text or "")) and 0 <= r.taken <= 3 * r.size
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        taken[source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(0.02 * want[s], 30), (s, taken[s], want[s])


def test_edges(spark):
    docs = edge_docs(spark)
    got = M.mix_report(docs).collect()
    assert len(got) == docs.count()
    assert {r.size for r in got if r.doc_id == 0} == {0} and all(r.taken <= 3 * r.size for r in got)
    assert M.mix_report(empty_docs(spark)).count() == 0
    out = M.mix_documents(docs)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} <= {*range(20), None}


@given(st.lists(st.integers(0, 1000), min_size=1, max_size=6), st.sampled_from([1, 2, 3]))
def test_capped_targets(sizes, cap):
    named = {f"s{i}": n for i, n in enumerate(sizes)}
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(named)}
    got = M.capped_targets(named, weights, sum(sizes), cap)
    assert got == pytest.approx(targets(named, weights, sum(sizes), cap))


def best_cost(patterns, quotas, cap):
    """The least cost of whole-word routings that serve as much as possible, by trying all."""
    slots = [(p, s) for p, _ in patterns for s in p]
    best = None
    for flow in itertools.product(*[range(min(cap * dict(patterns)[p], quotas[s]) + 1) for p, s in slots]):
        got, used = dict.fromkeys(quotas, 0), {p: 0 for p, _ in patterns}
        for (p, s), n in zip(slots, flow, strict=True):
            got[s] += n
            used[p] += n
        if any(got[s] > quotas[s] for s in quotas) or any(used[p] > cap * n for p, n in patterns):
            continue
        cost = sum(k * max(0, min(n, used[p] - k * n)) for p, n in patterns for k in range(cap))
        key = (-sum(got.values()), cost)
        best = key if best is None else min(best, key)
    return best


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=3, max_size=3), st.tuples(st.integers(0, 5), st.integers(0, 5)))
def test_flow_is_optimal(sizes, wanted):
    patterns = list(zip([("a",), ("a", "b"), ("b",)], sizes, strict=True))
    quotas = {"a": wanted[0], "b": wanted[1]}
    given_ = M.route(patterns, quotas, 2)
    used = {p: sum(x.values()) for p, x in given_.items()}
    cost = sum(k * max(0.0, min(n, used[p] - k * n)) for p, n in patterns for k in range(2))
    assert (-sum(used.values()), cost) == pytest.approx(best_cost(patterns, quotas, 2))


def test_overlapping_sources(spark):
    rows = [(i, "w " * 10, ["a"] if i < 50 else ["a", "b"]) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    picked, target, _ = M.mix(docs, "sources", M.cycling((1, 1)), max_epochs=2)
    assert target == {"a": 500.0 * 1.5, "b": 750.0} or sum(target.values()) <= 1500
    assert sum(r["size"] * r.epochs for r in picked.collect()) == pytest.approx(1000, abs=20)


@given(st.lists(st.integers(0, 40), max_size=8), st.integers(0, 200))
def test_nearest_subset(sizes, goal):
    taken = M.nearest_subset(sizes, goal)
    best = min(abs(goal - sum(c)) for k in range(len(sizes) + 1) for c in itertools.combinations(sizes, k))
    got = abs(goal - sum(n for n, t in zip(sizes, taken, strict=True) if t))
    assert got == best


def test_many_patterns_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(M, "MAX_PATTERNS", 2)
    names = ["a", "b", "c", "d"]
    rows = [(i, "w " * 10, [names[i % 4], names[i // 4 % 4], names[i // 16 % 4]]) for i in range(128)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    picked, target, _ = M.mix(docs, "sources", M.cycling((1, 1, 1)), max_epochs=2)
    got = picked.collect()
    assert len(got) == 128 and sum(r["size"] * r.epochs for r in got) == pytest.approx(1280, abs=60)
    docs = spark.createDataFrame([(1, "a b c", "x", i) for i in range(7)] + [(2, "d " * 30, "y", 9)], "doc_id long, text string, source string, n int")
    report = {r.doc_id: r.taken for r in M.mix_report(docs.limit(0).union(docs)).groupBy("doc_id").agg({"taken": "sum"}).withColumnRenamed("sum(taken)", "taken").collect()}
    out = M.mix_documents(docs).collect()
    assert {d: 3 * sum(r.doc_id == d for r in out) if d == 1 else 30 * sum(r.doc_id == 2 for r in out) for d in (1, 2)} == report
