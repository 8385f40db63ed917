import re
from collections import defaultdict

import numpy as np
import pytest
from helpers import SMALL, edge_docs, empty_docs

from lexigrove.llm import near_dedup as N
from lexigrove.llm.queries import op9_near_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=5):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute(rows, percent=75):
    """(doc_id, n_shingles, component_id) from all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    posted = defaultdict(list)
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for j in posted[x]:
                shared[j] += 1
            posted[x].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert got(op9_near_dedup(spark, SMALL)) == brute(rows)


def test_shared_passages_and_chains(spark, monkeypatch):
    """Copies, chains of copies and one passage in many documents, with every path taken."""
    rng = np.random.default_rng(5)
    words = lambda n: [f"w{x}" for x in rng.integers(0, 100000, n)]
    passage, rows = words(70), []
    for i in range(60):
        rows.append((1000 - i, " ".join(words(20) + passage + words(int(rng.integers(5, 40))))))
    base = words(120)
    for i in range(60):
        copy = list(base)
        for at in rng.integers(0, 120, int(rng.integers(1, 9))):
            copy[at] = f"x{rng.integers(0, 100000)}"
        rows.append((2000 + i, " ".join(copy)))
        base = copy if i % 3 == 0 else base
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert len({c for _, _, c in want}) < len(rows) - 20
    assert got(N.near_components(df)) == want
    monkeypatch.setattr(N, "DIRECT", 2)
    monkeypatch.setattr(N, "BLOCK", 7)
    assert got(N.near_components(df)) == want


def test_edges(spark):
    docs = edge_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(N.near_components(docs)) == brute(rows)
    assert N.near_components(empty_docs(spark)).count() == 0
    kept = N.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and 7 not in {r.doc_id for r in kept.collect()}


def test_rows_of_one_id_and_of_none(spark):
    text = " ".join(f"w{i}" for i in range(40))
    other, third = " ".join(f"x{i}" for i in range(40)), " ".join(f"y{i}" for i in range(40))
    rows = [(1, text, 1), (5, text, 2), (5, other, 3), (None, text, 4), (None, third, 5), (None, third + " end", 6), (None, third, 7)]
    rows += [(8, other + " end", 8), (5, other, 9), (None, None, 10), (None, "", 11), (3, " ", 12), (3, " ", 13)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_hash int")
    kept = {r.text_hash for r in N.drop_near_duplicates(docs).collect()}
    assert {1, 10, 11, 12, 13} < kept and len(kept & {3, 9}) == len(kept & {5, 6, 7}) == 1 and len(kept) == 7
    report = {(r.doc_id, r.component_id, r.kept) for r in N.near_components(docs).collect()}
    assert report == {(1, 1, True), (5, 1, False), (5, 5, True), (None, 1, False), (None, None, True), (8, 5, False), (3, 3, True)}


def test_shingles_are_words():
    texts = ["a b c d e f A B c d e F", "", " x ", "é \x0b ü\tA b", "one"]
    elements, counts = N.shingle_sets([t.encode() for t in texts])
    assert counts.tolist() == [len(shingles(t)) for t in texts]
    assert len(elements) == counts.sum()


@pytest.mark.parametrize("share", [0.3, 0.75, 0.9])
def test_super_minhash_estimates_jaccard(share):
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(30):
        common, n = rng.integers(0, 2**63, 2000, dtype=np.uint64), 400
        k = round(2 * n * share / (1 + share))
        a, b = common[:n], common[n - k : 2 * n - k]
        both = np.concatenate([a, b])
        ranks = N.super_minhash(both, np.repeat([0, 1], n), 2, 128)
        errors.append((ranks[0] == ranks[1]).mean() - k / (2 * n - k))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_short_sets_fill_every_slot():
    ranks = N.super_minhash(np.arange(1, 4, dtype=np.uint64), np.array([0, 1, 1]), 2, 128)
    assert (ranks >> np.uint64(32)).max() < 128
    # slots of one element are a permutation: every rank once
    assert sorted((ranks[0] >> np.uint64(32)).tolist()) == list(range(128))
