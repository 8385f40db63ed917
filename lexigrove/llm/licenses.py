"""License scans with a positional rare-token index, in DataFrame functions only."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrove.llm.common import ALNUM_WORD, materialise

#: Phrases whose places are counted, and their labels (fixed values).
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: (label, notice, phrase that the notice must have), lower-case words (fixed values).
TEMPLATES = [
    ("agpl-3", "licensed under the gnu affero general public license version 3", "gnu affero general public license"),
    ("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("bsd-3", "released under the bsd 3 clause license", "bsd 3 clause"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0"),
    ("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute this software"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("mit", "released under the mit license", "mit license"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
]

#: Words of the notices that are too common to be looked up (fixed values).
COMMON = "0 1 2 3 4 a and any are by for in into is of or the this to under use with without".split()

VOCABULARY = sorted({w for _, notice, _ in TEMPLATES for w in notice.split()} - {*COMMON})
_NOT_WORD = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
_LOOKUP = rf"(?i)(?<![^{_NOT_WORD}])(?:{'|'.join(VOCABULARY)})(?![^{_NOT_WORD}])"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def licence_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, found, text): all words counted, distinct licence words, and the text where it has any."""
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", "text", F.regexp_count("text", F.lit(ALNUM_WORD)).cast("long").alias("n_words"), F.regexp_extract_all("text", F.lit(_LOOKUP), F.lit(0)).alias("found"))
    return rows.select(
        "doc_id",
        "n_words",
        F.array_distinct(F.transform("found", _lower)).alias("found"),
        F.when(F.size("found") > 0, F.col("text")).alias("text"),
    )


def inverse_frequencies(rows: DataFrame) -> dict[str, float]:
    """The IDF of each licence word over all documents; as many rows as the notices have words."""
    counted = rows.select(F.explode("found").alias("word")).groupBy("word").count()
    total = rows.count()
    seen = {r["word"]: r["count"] for r in counted.collect()}
    return {w: math.log((total + 1) / (seen.get(w, 0) + 1)) for w in VOCABULARY}


def _words(words: list[str]) -> Column:
    """A literal array."""
    return F.split(F.lit(" ".join(words)), " ")


def _stands(phrase: Column, at: Column) -> Column:
    """Whether a phrase stands at a word position."""
    return (at >= 0) & (F.get("words", at) == F.get(phrase, F.lit(0))) & (F.slice(F.col("words"), F.greatest(at, F.lit(0)) + 1, F.size(phrase)) == phrase)


def _base_places() -> Column:
    """(label, pos) of all places of the base phrases."""

    def places(phrase: str, label: str) -> Column:
        found = F.filter("at", lambda i: _stands(_words(phrase.split()), i))
        return F.transform(found, lambda i: F.struct(F.lit(label).alias("label"), i.alias("pos")))

    return F.flatten(F.array(*[places(p, label) for p, label in BASE_PHRASES.items()]))


def _index(idf: dict[str, float], rare_words: int) -> Column:
    """The templates with their postings, as one literal."""
    entries = []
    for label, notice, phrase in TEMPLATES:
        words, must = notice.split(), phrase.split()
        first = {w: words.index(w) for w in words if w in idf}
        rare = sorted(first.items(), key=lambda x: (-idf[x[0]], x))[:rare_words]
        at = next(i for i in range(len(words)) if words[i : i + len(must)] == must)
        entries.append({"label": label, "notice": words, "phrase": must, "at": at, "rare": [{"word": w, "offset": o} for w, o in rare]})
    kind = "array<struct<label:string,notice:array<string>,phrase:array<string>,at:int,rare:array<struct<word:string,offset:int>>>>"
    return F.from_json(F.lit(json.dumps(entries)), kind)


def _matches(idf: dict[str, float], rare_words: int) -> Column:
    """The verified places of the templates, (label, start, share)."""

    def starts(rare: Column) -> Column:
        """Where the notice would begin by each place of one of its words."""
        return F.transform(F.filter("hits", lambda h: h["word"] == rare["word"]), lambda h: h["pos"] - rare["offset"])

    def aligned(t: Column) -> Column:
        """The beginnings on which all rare words agree."""
        return F.aggregate(F.slice(t["rare"], 2, rare_words), starts(t["rare"][0]), lambda left, r: F.array_intersect(left, starts(r)))

    def place(t: Column, start: Column) -> Column:
        n = F.size(t["notice"])
        same = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", start + i) == F.get(t["notice"], i))
        return F.struct(t["label"].alias("label"), start.alias("start"), (F.size(same) / n).alias("share"))

    def of(t: Column) -> Column:
        found = F.filter(aligned(t), lambda start: _stands(t["phrase"], start + t["at"]))
        return F.transform(found, lambda start: place(t, start))

    possible = F.filter(_index(idf, rare_words), lambda t: F.array_contains("found", t["rare"][0]["word"]))
    return F.flatten(F.transform(possible, of))


def scan_licenses(docs: DataFrame, rare_words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, base_places, base_labels, labels, matches, score.

    A template is tried if its licence word of highest IDF is among all licence words of a
    file.  Of such a template, the postings of its `rare_words` highest-IDF words are
    intersected by relative position, and at each start that is left its mandatory phrase
    must stand word by word.  `matches` are (label, start, share): the share of the notice's
    words that stand in place; `score` is the highest share, 1 with a base phrase, else 0.

    A null text counts as empty: no words, no labels, score 0.  Repeated rows are scanned each
    on its own, long texts whole; further columns are ignored; an empty table gives an empty
    result.  The IDF counts cover all documents.
    """
    rows, _ = materialise(licence_words(docs, id_col, text_col), "licence-words")
    idf = inverse_frequencies(rows)
    words = F.when(F.col("text").isNotNull(), F.regexp_extract_all(_lower(F.col("text")), F.lit(ALNUM_WORD), F.lit(0))).otherwise(F.array().cast("array<string>"))
    vocabulary = _words(VOCABULARY)
    seen = rows.withColumn("words", words)
    seen = seen.withColumn("at", F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1)).otherwise(F.array().cast("array<int>")))
    seen = seen.withColumn(
        "hits",
        F.when(
            F.size("words") > 0,
            F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("pos"))), lambda h: F.array_contains(vocabulary, h["word"])),
        ).otherwise(F.array().cast("array<struct<word:string,pos:int>>")),
    )
    base, found = _base_places(), _matches(idf, rare_words)
    none_base, none_found = F.array().cast("array<struct<label:string,pos:int>>"), F.array().cast("array<struct<label:string,start:int,share:double>>")
    some = F.size("words") > 0
    seen = seen.select("doc_id", "n_words", F.when(some, base).otherwise(none_base).alias("base"), F.when(some, found).otherwise(none_found).alias("matches"))
    base_labels = F.array_sort(F.array_distinct("base.label"))
    best = F.coalesce(F.array_max("matches.share"), F.lit(0.0))
    return seen.select(
        "doc_id",
        "n_words",
        F.col("base.pos").alias("base_places"),
        base_labels.alias("base_labels"),
        F.array_sort(F.array_distinct(F.concat("base.label", "matches.label"))).alias("labels"),
        "matches",
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )


def license_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score; labels comma-joined."""
    return scan_licenses(docs).select(
        "doc_id",
        "n_words",
        F.size("base_places").cast("long").alias("n_base"),
        F.array_min("base_places").cast("long").alias("first_word"),
        F.array_max("base_places").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )
