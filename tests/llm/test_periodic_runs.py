import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexigrove.llm import periodic_runs as P
from tests.llm.helpers import SMALL, edge_docs, empty_docs


def plain_runs(words):
    """Every stretch of equal words q apart, for each q, that has no smaller period."""
    n, found = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, length = i, j - i + q
            smaller = any(all(words[x] == words[x + r] for x in range(start, start + length - r)) for r in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                found.add((start, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(text, doc_id):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            n, g, original = len(words), h // 10, list(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            for i in range(a, n):
                words[i] = original[a + (i - a) % p]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[1] * 1000 // best[2] if runs else None, sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60))
def test_runs_of_short_alphabets(words):
    assert P.runs_of(words) == plain_runs(words)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(1, 9)), max_size=7))
def test_runs_of_repeated_phrases(parts):
    words = [w for phrase, times in parts for w in phrase * times]
    assert P.runs_of(words) == plain_runs(words)


def test_runs_of_nested_repeats():
    a, b = [0, 1] * 4 + [2], [3]
    for words in ((a * 5 + b) * 4, a * 9 + a[:3], [0] * 40 + [1] + [0] * 40, [0, 0, 1] * 20 + [0, 0, 0, 1] * 20):
        assert P.runs_of(words) == plain_runs(words)


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_hashes_that_collide(monkeypatch, bits):
    """Words decide where hashes can't."""
    monkeypatch.setattr(P, "_MASK", (1 << bits) - 1)
    monkeypatch.setattr(P, "_DIRECT", 1)
    rng = random.Random(bits)
    for _ in range(60):
        words = [w for _ in range(4) for w in [rng.randrange(3) for _ in range(rng.randrange(1, 6))] * rng.randrange(1, 8)]
        assert P.runs_of(words) == plain_runs(words)


def test_long_repeats_take_linear_time():
    for words in ([0] * 200_000, [0, 1, 2] * 70_000, list(range(50_000)) * 4):
        period = len(set(words))
        assert P.runs_of(words) == [(0, len(words), period)]


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = sorted(map(tuple, P.periodic_runs(docs, plant=True).collect()))
    want = sorted(plain_row(r.text, r.doc_id) for r in docs.filter("length(text) < 6000").collect())
    kept = {r[0] for r in want}
    assert len(got) == docs.count()
    assert [r for r in got if r[0] in kept] == want
    assert sum(r[1] > 0 for r in want) >= 5


def test_edges(spark):
    docs = edge_docs(spark)
    out = P.periodic_runs(docs, plant=True)
    held = [(r.text if len(r.text or "") < 9000 else "", r.doc_id) for r in docs.collect()]
    long_ids = {r.doc_id for r in docs.collect() if len(r.text or "") >= 9000}
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    got = order(tuple(r) for r in out.collect())
    assert [r for r in got if r[0] not in long_ids] == order(plain_row(t, i) for t, i in held if i not in long_ids)
    assert [r[1:6] for r in got if r[0] in long_ids] == [(1, 0, 30000, 1, 30_000_000)]
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert P.periodic_runs(empty_docs(spark)).collect() == []
