import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import SMALL, edge_docs, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexigrove.llm import token_ids as T
from lexigrove.llm.queries import op3_token_ids, tokenizer_path


def brute(rows):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    start = 0
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        yield doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_query_equals_plain_encoding(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, op3_token_ids(spark, SMALL).select("doc_id", "start", "n_tokens", "ids_crc32").collect()))
    assert got == list(brute(sorted(map(tuple, docs))))


def test_edges(spark):
    docs = edge_docs(spark)
    got = T.token_table(docs, tokenizer_path(), special_as_text=False).select("doc_id", "n_tokens", "ids_crc32").collect()
    want = [(d, n, c) for d, _, n, c in brute([(r.doc_id, r.text) for r in docs.collect()])]
    key = lambda r: (r[0] is not None, r)
    assert sorted(map(tuple, got), key=lambda r: (r[0] or -1, r[1:])) == sorted(want, key=lambda r: (r[0] or -1, r[1:])), key
    assert T.token_table(empty_docs(spark), tokenizer_path()).count() == 0


def test_special_strings(spark):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y  z", "none of them", "<|endoftext", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for as_text in (False, True):
        tokenizer = Tokenizer.from_file(tokenizer_path())
        tokenizer.encode_special_tokens = as_text
        want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
        got = T.token_table(docs, tokenizer_path(), special_as_text=as_text).collect()
        assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in got} == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want.items()}


ENCODERS: list = []
PIECES = ["word", "Ñandú", "x", "12", "...", "%%%", "'s", "'", "_", " ", " ", " ", "\n", "\t", "\u00a0", "\u2003", "\x1c", "日本", "é", "</s>"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), min_size=1, max_size=8))
def test_chunks_equal_whole_texts(texts):
    if not ENCODERS:
        ENCODERS.extend((Tokenizer.from_file(tokenizer_path()), T._Encoder(tokenizer_path())))
    plain, encoder = ENCODERS
    for _ in range(2):  # learned, and remembered
        assert [x.tolist() for x in encoder.encode(pa.array(texts))] == [plain.encode(t, add_special_tokens=False).ids for t in texts]

def test_words_are_forgotten_by_generations(monkeypatch):
    monkeypatch.setattr(T, "_REMEMBERED", 20)
    encoder, plain = T._Encoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    for i in range(30):
        text = " ".join(f"w{chr(97 + (i + k) % 26)}{k}.\nthe" for k in range(15))
        assert encoder.encode(pa.array([text]))[0].tolist() == plain.encode(text).ids
        assert all(len(new) + len(old) <= 120 for new, old in encoder._known.values())


def test_random_access(spark, tmp_path):
    folder = f"file://{tmp_path}/ids"
    docs = spark.createDataFrame([(i, "word " * i) for i in range(50)], "doc_id long, text string")
    T.write_token_files(docs, tokenizer_path(), folder)
    (ids,) = T.load_ids(spark, folder, 30)
    assert ids.tolist() == Tokenizer.from_file(tokenizer_path()).encode("word " * 30).ids + [2]


@given(st.integers(1, 32), st.data())
def test_packing_round_trip(width, data):
    ids = np.array(data.draw(st.lists(st.integers(0, 2**width - 1), max_size=100)), np.uint32)
    assert T.unpack(T.pack(ids, width), width, len(ids)).tolist() == ids.tolist()
    assert len(T.pack(ids, width)) == -(-len(ids) * width // 8)


@pytest.mark.parametrize("vocabulary, bits", [(2, 1), (3, 2), (256, 8), (257, 9), (50257, 16), (65537, 17)])
def test_width(vocabulary, bits):
    assert T.bit_width(vocabulary) == bits


def test_an_encoder_with_less_memory_gives_the_same_ids(spark):
    docs = edge_docs(spark)
    got = [sorted(map(str, T.token_table(docs, tokenizer_path(), **less).collect())) for less in ({}, {"remembered": 1, "at_once": 10})]
    assert got[0] == got[1]
