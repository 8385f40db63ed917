import hashlib
import re

import pytest
from helpers import SMALL, edge_docs, empty_docs

from lexigrove.llm.decontamination import decontamination_report, remove_contaminated
from lexigrove.llm.queries import op5_decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, size=10):
    windows = []
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        windows += [(item, w[i : i + n]) for i in range(len(w) - n + 1) if n]
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, g in windows:
            for i in range(len(w) - len(g) + 1):
                if w[i : i + len(g)] == g:
                    hit |= set(range(i, i + len(g)))
                    found.add(str(item))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    got = op5_decontamination(spark, SMALL).select(COLUMNS).collect()
    want = brute(docs, items)
    assert sorted(map(tuple, got), key=str) == want and any(r[-1] for r in want)


@pytest.fixture
def items(spark):
    rows = [(1, "one two"), (2, "text here twice over the lazy dog again and then more of it"), (3, None), (4, "..."), (12, "same TEXT here, twice over the lazy dog again"), (12, "one two")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("block", [1, 8_000_000])
def test_edges(spark, items, block):
    from lexigrove.llm import decontamination as D

    docs = edge_docs(spark)
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()])
    got = decontamination_report(docs, items).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == want
    found = D.find_contamination(docs, items, block_chars=block).collect()
    assert sorted((r.doc_id, sum(s["end"] - s["begin"] for s in r.hit_spans), len(r.item_ids)) for r in found if r.doc_id is not None) == sorted((w[0], w[2], w[3]) for w in want if w[0] is not None)


def test_empty(spark, items):
    assert decontamination_report(empty_docs(spark), items).count() == 0
    assert not any(r.contaminated for r in decontamination_report(edge_docs(spark), items.limit(0)).collect())


def test_removal(spark, items):
    docs = edge_docs(spark)
    kept = remove_contaminated(docs, items)
    assert kept.columns == docs.columns and {5, 6, 7} & {r.doc_id for r in kept.collect()} == set()
    cut = {r.doc_id: r.text for r in remove_contaminated(docs, items, mode="spans").collect()}
    assert cut[5] == " three" and cut[6] == "." and cut[4] == "one" and cut[0] is None
