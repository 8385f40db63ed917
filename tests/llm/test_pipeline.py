import hashlib  # noqa: F401
import zlib

import numpy as np
from helpers import SMALL
from test_decontamination import brute as leaks
from test_near_dedup import brute as groups
from tokenizers import Tokenizer

import corpus_pipeline as P
from lexigrove.llm.queries import tokenizer_path


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, held = docs.columns, {}
    for name, stage in P.STAGES:
        before = docs
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        held[name] = before, docs
        if name != "token_ids":
            assert docs.columns == columns
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    before, after = map(rows, held["toxicity"])
    assert 0.8 * len(before) <= len(after) < len(before)
    before, after = map(rows, held["near_dedup"])
    assert sorted(d for d, _ in after) == sorted(d for d, _, c in groups(before) if d == c)
    before, after = map(rows, held["decontamination"])
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    assert sorted(d for d, _ in after) == sorted(d for d, *_, bad in leaks(before, items) if not bad)
    before, after = map(rows, held["mixing"])
    assert {d for d, _ in after} <= {d for d, _ in before} and all([d for d, _ in after].count(d) <= 3 for d, _ in after)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want, start = [], 0
    for d, t in sorted(after):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in held["token_ids"][1].collect()) == want


def test_run(spark):
    got = P.run(spark, SMALL)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 50
