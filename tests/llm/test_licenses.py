import math
import random
import re

import pytest
from helpers import SMALL, edge_docs, empty_docs

from lexigrove.llm import licenses as L
from lexigrove.llm.queries import op10_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    words = WORD.findall((text or "").translate(LOWER))
    found = [(i, lab) for p, lab in L.BASE_PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in found]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({lab for _, lab in found}))


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in df.collect()), key=str)


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert rows_of(op10_licenses(spark, SMALL)) == sorted(((r.doc_id, *base(r.text)) for r in docs), key=str)


TEXTS = [
    "Released under the MIT License.", "UNDER--the\nmit LICENSE under the MIT license", "xunder the mit license", "Apache License, Version 2.0 and cc-by-nc",
    "This work is licensed under the GNU General Public License, version 3.", "the GNU General Public version License 3", "mit license", "words " * 20000 + "CC BY NC",
    "permission is hereby granted, free of charge, to any person obtaining a copy of this software", "underÉ the mit license", "Cc By Ncx cc by nc",
]


def test_methods_labels(spark):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words int, labels string")
    got = {r.doc_id: r for r in L.license_report(docs).collect()}
    assert rows_of(L.license_report(docs)) == sorted(((i, *base(t)) for i, t in enumerate(TEXTS)), key=str)
    assert [got[i].labels for i in (0, 4, 5, 6, 8)] == ["mit", "gpl-3", "", "", "mit"]
    assert got[3].labels == "apache-2,cc-by-nc" and got[5].score == 0 and got[4].score == 1
    for r in got.values():
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_all_notices_of_a_file(spark):
    pairs = [(a, b) for a in L.TEMPLATES for b in L.TEMPLATES if a != b] + [tuple(L.TEMPLATES)]
    words = " ".join(L.VOCABULARY)
    texts = ["\n\n".join(notice for _, notice, _ in p) for p in pairs]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *(f"{words}\n\n{t}" for t in texts)])], "doc_id long, text string")
    got = {r.doc_id: set(r.labels.split(",")) for r in L.license_report(docs).collect()}
    for i, p in enumerate([*pairs, *pairs]):
        assert {label for label, *_ in p} <= got[i], p


def test_edges(spark):
    docs = edge_docs(spark)
    assert rows_of(L.license_report(docs)) == sorted(((r.doc_id, *base(r.text)) for r in docs.collect()), key=str)
    assert L.license_report(empty_docs(spark)).count() == 0


def test_native(spark):
    plan = L.license_report(edge_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas"))


def labels_and_score(texts):
    """What the positional index finds, by trying every start of every notice."""
    split = [WORD.findall((t or "").translate(LOWER)) for t in texts]
    df = {w: sum(w in words for words in split) for w in L.VOCABULARY}
    idf = {w: math.log((len(texts) + 1) / (n + 1)) for w, n in df.items()}
    for words in split:
        labels, best = set(), 0.0
        for p, lab in L.BASE_PHRASES.items():
            if any(words[i : i + len(p.split())] == p.split() for i in range(len(words))):
                labels.add(lab)
                best = 1.0
        for lab, notice, phrase in L.TEMPLATES:
            own, must = notice.split(), phrase.split()
            rare = sorted({(w, own.index(w)) for w in own if w in idf}, key=lambda x: (-idf[x[0]], x))[:3]
            at = next(i for i in range(len(own)) if own[i : i + len(must)] == must)
            for start in range(-len(own), len(words)):
                held = lambda i: words[i] if 0 <= i < len(words) else None
                if all(held(start + o) == w for w, o in rare) and start + at >= 0 and words[start + at : start + at + len(must)] == must:
                    labels.add(lab)
                    best = max(best, sum(held(start + i) == w for i, w in enumerate(own)) / len(own))
        yield ",".join(sorted(labels)), best


def test_labels_and_scores_equal_a_plain_search(spark):
    pick = random.Random(4)
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").limit(60).collect()] + [None, ""]
    for _ in range(80):
        parts = []
        for _, notice, _ in pick.sample(L.TEMPLATES, 3):
            words = notice.split()
            for _ in range(pick.randrange(3)):
                words[pick.randrange(len(words))] = pick.choice(["other", "license", "the", words[0]])
            parts.append(" ".join(words[pick.randrange(3) :]))
        texts.append(pick.choice(["", "Some text. "]) + "\n".join(parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in L.license_report(docs).collect()}
    for i, (labels, score) in enumerate(labels_and_score(texts)):
        assert got[i] == (labels, pytest.approx(score)), texts[i]
