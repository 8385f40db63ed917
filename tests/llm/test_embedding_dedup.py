import math

import numpy as np
import pytest

from lexigrove.llm import embedding_dedup as E
from lexigrove.llm.queries import op11_embedding_dedup
from tests.llm.helpers import SMALL

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.9):
    """(vec_id, n_links, component_id, kept) by all pairs; ids are unique here."""
    sound = {i: np.array(v, np.float64) for i, v, *_ in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    ids = sorted(sound)
    linked = {i: set() for i, *_ in rows}
    for dim in {len(v) for v in sound.values()}:
        own = [i for i in ids if len(sound[i]) == dim]
        m = np.array([sound[i] / np.linalg.norm(sound[i]) for i in own])
        for a, b in zip(*np.nonzero(np.triu(m @ m.T >= cosine, 1)), strict=True):
            linked[own[a]].add(own[b])
            linked[own[b]].add(own[a])
    out = {}
    for i in linked:
        seen, todo = {i}, [i]
        while todo:
            for k in linked[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        out[i] = (len(linked[i]), min(seen), min(seen) == i)
    return out


def found(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def clusters(seed, sizes, noise, single=300, dim=24):
    rng = np.random.default_rng(seed)
    parts = [rng.standard_normal((single, dim))]
    for n in sizes:
        centre = rng.standard_normal(dim)
        centre /= np.linalg.norm(centre)
        parts.append((centre + noise * rng.standard_normal((n, dim)) / np.sqrt(dim)) * rng.uniform(0.5, 3, (n, 1)))
    m = np.concatenate(parts)
    return [(int(i), [float(x) for x in np.float32(v)], None) for i, v in zip(rng.permutation(len(m)), m, strict=True)]


@pytest.mark.parametrize("noise", [0.1, 0.33])
def test_balls_and_blocks(spark, noise):
    """A third of the rows in one group, tight or with an edge that leaves the ball."""
    rows = clusters(1, [250, 60, 20, 2, 2], noise)
    got = found(E.embedding_components(spark.createDataFrame(rows, SCHEMA), leaf=32, sample=400))
    want = brute(rows)
    assert set(got) == set(want)
    assert all(got[i][0] <= want[i][0] for i in want)  # no false link
    assert sum(g[0] for g in got.values()) >= 0.97 * sum(w[0] for w in want.values())
    if noise == 0.1:
        assert got == want


def test_without_balls(spark):
    """Cells that don't split are compared by pairs of blocks, each pair once."""
    rows = clusters(2, [150, 40, 10], 0.2, single=100)
    got = found(E.embedding_components(spark.createDataFrame(rows, SCHEMA), leaf=16, dense=10**6))
    want = brute(rows)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(g[0] for g in got.values()) >= 0.99 * sum(w[0] for w in want.values())


def test_recall_at_the_threshold(spark):
    """Single pairs of cosine 0.9 to 0.92 in deep trees."""
    rng, dim, n = np.random.default_rng(3), 32, 1500
    a, b = rng.standard_normal((n, dim)), rng.standard_normal((n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    angle = np.arccos(rng.uniform(0.9005, 0.92, (n, 1)))
    m = np.concatenate([a, a * np.cos(angle) + b * np.sin(angle)])
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(m)]
    got = found(E.embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), leaf=48))
    want = brute(rows)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(g[0] for g in got.values()) >= 0.97 * sum(w[0] for w in want.values())


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert found(op11_embedding_dedup(spark, SMALL)) == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [1.0, 0.0], 1, -1), (3, [1.0, 0.0], 2, -1), (9, [2.0, 0.0], 1, -1), (4, [1.0, 0.1], None, -1), (8, [-1.0, 0.0], 1, -1),
        (10, [0.0, 0.0], 1, -1), (11, None, 1, -1), (12, [nan, 1.0], 1, -1), (13, [inf, 1.0], 1, -1), (14, [None, 1.0], 1, -1), (15, [], 1, -1),
        (16, [1.0], 1, -1), (17, [3.0], 1, -1), (18, [1.0, 0.0, 0.0], 1, -1), (19, [0.0, -0.0, 1e-30], 1, -1), (20, [-0.0, 0.0, 3e30], 1, -1),
        (21, [-0.0, 0.0], 1, -1),
    ]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, node int")
    assert found(E.embedding_components(docs)) == brute(rows)
    repeated = docs.unionByName(spark.createDataFrame([(None, [1.0, 0.0], 1, 1), (None, [0.0, 5.0], 1, 1), (3, [1.0, 0.0], 1, 1), (None, None, 1, 1)], docs.schema))
    out = E.embedding_components(repeated)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in out.collect())
    assert [r for r in got if r[0] in (0, 3)] == [(0, 0, None, True), (0, 0, None, True), (0, 5, 3, False), (3, 5, 3, True), (3, 5, 3, True)]
    assert E.embedding_components(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        E.embedding_components(docs, cosine=1.2)
