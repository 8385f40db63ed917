"""Benchmark decontamination with a broadcast set of test n-grams."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrove.llm.common import frugal, small_batches, unused

#: Lower-cases A-Z and makes a space of every byte that stands in no word.  The bytes of
#: characters beyond ASCII are all above 0x7F, so they stay whole.
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """The lower-cased words of a text."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _rolled(ids: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit number for the window of ``width`` ids at each place of ``at``."""
    out = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = out * _PRIME + ids[at + k]
            out ^= out >> np.uint64(29)
    return out


class NgramSet:
    """The windows of a block of benchmark items, as sorted 64-bit numbers of each width.

    A number that matches is verified word by word, so equal numbers of different windows do
    no harm.
    """

    def __init__(self, items: list[tuple[object, str | None]], size: int):
        self.vocabulary: dict[bytes, int] = {}
        grams: dict[int, dict[tuple[bytes, ...], set]] = {}
        for item, text in items:
            words = words_of(text)
            width = min(size, len(words))
            for i in range(len(words) - width + 1 if words else 0):
                grams.setdefault(width, {}).setdefault(tuple(words[i : i + width]), set()).add(item)
                for w in words[i : i + width]:
                    self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.grams = grams
        self.keys = {}
        for width, of in grams.items():
            ids = np.array([[self.vocabulary[w] for w in g] for g in of], np.uint64).ravel()
            self.keys[width] = np.unique(_rolled(ids, np.arange(0, len(ids), width), width))

    def scan(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, set]]:
        """For each text: its words, a mask of those that are hit, the items that hit it."""
        split = [words_of(t) for t in texts]
        known = self.vocabulary.get
        ids = np.fromiter((known(w, 0) for words in split for w in words), np.uint64, sum(map(len, split)))
        ends = np.cumsum([len(w) for w in split])
        candidates: dict[int, list[tuple[int, int]]] = {}
        for width, keys in self.keys.items():
            if len(ids) < width:
                continue
            # a window with a word that no item has can't match
            gaps = np.concatenate(([0], np.cumsum(ids == 0)))
            at = np.flatnonzero(gaps[width:] == gaps[:-width])
            if not len(at):
                continue
            rolled = _rolled(ids, at, width)
            near = np.minimum(np.searchsorted(keys, rolled), len(keys) - 1)
            at = at[keys[near] == rolled]
            for i, doc in zip(at.tolist(), np.searchsorted(ends, at, "right").tolist(), strict=True):
                candidates.setdefault(doc, []).append((i, width))
        for doc, words in enumerate(split):
            mask, items, base = np.zeros(len(words), bool), set(), int(ends[doc]) - len(words)
            for i, width in candidates.get(doc, ()):
                found = self.grams[width].get(tuple(words[i - base : i - base + width])) if i - base + width <= len(words) else None
                if found:
                    mask[i - base : i - base + width] = True
                    items |= found
            yield len(words), mask, items


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, limit: int) -> Iterator[list[tuple]]:
    """The items in blocks of at most ``limit`` characters (or a single longer item)."""
    block, held = [], 0
    for row in benchmark.select(benchmark[item_col].cast("string").alias("i"), benchmark[text_col].alias("t")).toLocalIterator():
        size = len(row.t or "")
        if block and held + size > limit:
            yield block
            block, held = [], 0
        block.append((row.i, row.t))
        held += size
    yield block


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, item_col: str = "item_id", text_col: str = "text", block_chars: int = 8_000_000, out: tuple[str, str, str] = ("n_words", "hit_spans", "item_ids")
) -> DataFrame:
    """The columns of ``docs``, and `n_words`, `hit_spans`, `item_ids` (or the names of `out`) as the scan finds them.

    A window is `size` consecutive words of an item, or all words of a shorter item; a span
    is (first word, word after the last) of touching or overlapping occurrences.  The items
    are broadcast in blocks of `block_chars`, whose n-gram set takes some hundred MB at the
    most; a larger benchmark takes several scans over the same rows, each with its own block,
    and their spans are merged.

    Null and empty texts have no words and are never hit; an item without words has no
    window; an item with a null id marks words but is not listed.  Repeated items count once.
    Columns of ``docs`` stay as they are, but one of a name in `out` is replaced.
    """
    small_batches(docs.sparkSession)
    n_words, spans, items = out
    found, name = docs, unused(docs, "scan")
    for k, block in enumerate(_blocks(benchmark, item_col, text_col, block_chars)):
        shared = docs.sparkSession.sparkContext.broadcast((block, size))
        found = _scan(found, shared, text_col, name)
        part = F.col(name)
        if k:
            found = found.withColumns({spans: F.concat(spans, part["spans"]), items: F.array_union(items, part["items"])}).drop(name)
        else:
            found = found.withColumns({n_words: part["n_words"], spans: part["spans"], items: part["items"]}).drop(name)
    return found.withColumns({spans: _merged(F.col(spans)), items: F.array_sort(items)})


def _merged(spans):
    """Spans joined where they touch or overlap."""
    ordered = F.array_sort(spans)

    def step(held, span):
        last = F.try_element_at(held, F.lit(-1))
        joined = F.concat(F.slice(held, 1, F.size(held) - 1), F.array(F.struct(last["begin"].alias("begin"), F.greatest(last["end"], span["end"]).alias("end"))))
        return F.when((F.size(held) > 0) & (last["end"] >= span["begin"]), joined).otherwise(F.concat(held, F.array(span)))

    empty = F.array().cast("array<struct<begin:int,end:int>>")
    return F.when(F.size(spans) > 1, F.aggregate(ordered, empty, step)).otherwise(spans)


_sets: dict[str, NgramSet] = {}


def _scan(docs: DataFrame, shared, text_col: str, name: str) -> DataFrame:
    token = uuid.uuid4().hex  # a worker builds the set of a block once

    @F.arrow_udf("n_words long, spans array<struct<begin:int,end:int>>, items array<string>")
    @frugal
    def scan(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if token not in _sets:
            _sets.clear()
            _sets[token] = NgramSet(*shared.value)
        grams = _sets[token]
        for batch in texts:
            values = []
            for i in range(0, len(batch), 512):
                for n, mask, items in grams.scan(batch[i : i + 512].to_pylist()):
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0])))).tolist() if items else []
                    values.append({"n_words": n, "spans": [{"begin": a, "end": b} for a, b in zip(edges[::2], edges[1::2], strict=True)], "items": sorted(x for x in items if x is not None)})
            yield pa.array(values, pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.string()))]))

    return docs.withColumn(name, scan(docs[text_col]))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10, mode: str = "documents", **more) -> DataFrame:
    """``docs`` without contaminated documents, or with the hit spans cut from their texts.

    In mode "spans" a text loses the characters from the first to the last word of each span;
    texts without a hit stay as they are, and so do all other columns.
    """
    out = tuple(unused(docs, x) for x in ("n_words", "hit_spans", "item_ids"))
    found, spans = find_contamination(docs, benchmark, size, out=out, **more), out[1]
    if mode == "documents":
        return found.filter(F.size(spans) == 0).select(*docs.columns)
    if mode != "spans":
        raise ValueError(f"mode: {mode}")

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([_without(t, s) for t, s in zip(texts.to_pylist(), spans.to_pylist(), strict=True)], pa.string())

    text = more.get("text_col", "text")
    return found.withColumn(text, F.when(F.size(spans) > 0, cut(F.col(text), F.col(spans))).otherwise(F.col(text))).select(*docs.columns)


def _without(text: str | None, spans: list[dict]) -> str | None:
    if not text or not spans:
        return text
    folded = np.frombuffer(b" " + (raw := text.encode("utf-8", "surrogatepass")).translate(_FOLD) + b" ", np.uint8) != 0x20
    begins, ends = np.flatnonzero(folded[1:] & ~folded[:-1]), np.flatnonzero(folded[:-1] & ~folded[1:])
    out, at = [], 0
    for s in spans:
        out.append(raw[at : begins[s["begin"]]])
        at = int(ends[s["end"] - 1])
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def decontamination_report(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["begin"]))
    found = find_contamination(docs.select(docs["doc_id"], docs["text"]), benchmark, size)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )
