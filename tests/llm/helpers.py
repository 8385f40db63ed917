"""Rows that every operator must survive: nulls, empty and long texts, ties, repeats, clashing columns."""

from collections import Counter

from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"

#: Names that the operators use or return.
CLASHING = "n_words hit_spans item_ids pattern text_hash toxicity_score toxicity_hits epochs size n_shingles kept row_no __text __copy".split()

EDGE_TEXTS = [
    None,
    "",
    " ",
    "\n\t ",
    "one",
    "one two three",
    "Same text here, twice over the lazy dog again.",
    "Same text here, twice over the lazy dog again.",
    "ÀÉ über naïve 日本語 text with odd   spaces \n  and  ends  ",
    "<|endoftext|> [INST] </s> 'quoted' \"idiot\" | a | b",
    "long " * 30000,
]


def edge_docs(spark):
    """documents with nulls in every column, a repeated row and extra columns of clashing names."""
    rows = [(i, t, "en", f"s{i % 3}" if i else None, len(t or ""), "x", i, t) for i, t in enumerate(EDGE_TEXTS)]
    rows += [rows[6], (None, "no id", None, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n int, digest long, words string"
    docs = spark.createDataFrame([(*r[:5], 1, r[6], r[7]) for r in rows], schema)
    return docs.withColumns({c: F.lit(-7) for c in CLASHING})


def same_rows(out, docs, times=1):
    """Whether each row of ``out`` is one of ``docs`` with all its columns, at most ``times`` as often."""
    held = Counter(map(tuple, docs.collect()))
    return out.columns == docs.columns and all(n <= times * held[r] for r, n in Counter(map(tuple, out.collect())).items())


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
