"""Periodic runs of words: a stack of Lyndon words, scanned from right to left under both orders.

A run is a maximal stretch of words that has a period.  Every run of two periods or more has a
Lyndon root, which is the longest Lyndon word at its place under one of the two orders of the
words.  So the longest Lyndon words of all places, under an order and its reverse, name all
periods that can matter, one for each place and order.

Suffixes are compared, and runs extended, by the longest common extension of two places: some
words directly, then a binary search over rolling hashes, then a direct comparison of what the
hashes call equal.  A stretch that was compared on the same distance is known and isn't
compared again, so a text of one repeated phrase takes linear time.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexigrove.llm.common import frugal, slices, small_batches

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Words that two places have in common before hashes are asked.
_DIRECT = 8
_MASK = (1 << 64) - 1
_STEP = 0x9E3779B97F4A7C15


class Places:
    """Common extensions of the places of one sequence of word numbers."""

    def __init__(self, words: list[int]):
        self.words, self.n = words, len(words)
        self._sums: list[int] | None = None
        self._known: dict[int, tuple[int, int]] = {}

    def _hashes(self) -> tuple[list[int], list[int]]:
        """Prefix sums of word value times power of an odd step, modulo 2**64, and the powers."""
        if self._sums is None:
            values = np.array(self.words, np.uint64) + np.uint64(1)
            values = (values * np.uint64(0xBF58476D1CE4E5B9)) ^ (values << np.uint64(31))
            values = (values ^ (values >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            powers = np.full(self.n + 1, _STEP, np.uint64)
            powers[0] = 1
            powers = np.multiply.accumulate(powers)
            self._sums = [0, *np.cumsum(values * powers[:-1], dtype=np.uint64).tolist()]
            self._powers = powers.tolist()
        return self._sums, self._powers

    def _equal(self, i: int, j: int, length: int) -> bool:
        """Whether hashes call the stretches at i < j equal."""
        sums, powers = self._hashes()
        return ((sums[i + length] - sums[i]) * powers[j - i] - sums[j + length] + sums[j]) & _MASK == 0

    def right(self, i: int, j: int) -> int:
        """Number of words that the places i < j have in common, to the right."""
        words, n, distance = self.words, self.n, j - i
        known = self._known.get(distance)
        if known is not None and known[0] <= i <= known[1]:
            return known[1] - i
        near = min(n - j, _DIRECT)
        for k in range(near):
            if words[i + k] != words[j + k]:
                return k
        low, high = near, n - j
        if low < high:
            step = 2 * _DIRECT  # gallop, then halve
            while low + step < high and self._equal(i, j, low + step):
                low += step
                step *= 2
            high = min(high, low + step)
            while low < high:
                middle = (low + high + 1) // 2
                if self._equal(i, j, middle):
                    low = middle
                else:
                    high = middle - 1
            low = self._checked(i, j, low)
        if low >= _DIRECT:
            self._known[distance] = (i, i + low)
        return low

    def _checked(self, i: int, j: int, length: int) -> int:
        """`length`, unless words differ where hashes don't: then the number of equal ones."""
        end = i + length
        known = self._known.get(j - i)
        if known is not None and i <= known[0] <= end <= known[1]:
            end = known[0]  # the rest was compared before
        if self.words[i:end] == self.words[j : j + end - i]:
            return length
        return next(k for k in range(length) if self.words[i + k] != self.words[j + k])

    def left(self, i: int, j: int, most: int) -> int:
        """Number of words, at most `most`, that stand before both i < j and are equal, to the left."""
        low, high = 0, min(most, i)
        while low < high:
            middle = (low + high + 1) // 2
            if self._equal(i - middle, j - middle, middle):
                low = middle
            else:
                high = middle - 1
        if self.words[i - low : i] == self.words[j - low : j]:
            return low
        return next(k for k in range(low) if self.words[i - 1 - k] != self.words[j - 1 - k])


def lyndon_ends(places: Places, sign: int) -> list[int]:
    """End of the longest Lyndon word at each place, under the order of word numbers (`sign` 1) or its reverse (-1).

    The end is the next place whose suffix is smaller; the stack holds the places to the right
    that are still such ends.
    """
    words, n, right = places.words, places.n, places.right
    ends, stack = [n] * n, [n]
    for i in range(n - 1, -1, -1):
        own = words[i] * sign
        j = stack[-1]
        while j < n:
            other = words[j] * sign
            if own == other:
                k = right(i, j)
                if j + k == n:
                    break  # the suffix at j is a prefix, so it is smaller
                if words[i + k] * sign > words[j + k] * sign:
                    break
            elif own > other:
                break
            stack.pop()
            j = stack[-1]
        ends[i] = j
        stack.append(i)
    return ends


def runs_of(words: list[int], least: int = 6, periods: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least `least` words and `periods` periods (two or more), by start and period."""
    places, found = Places(words), set()
    numbers = np.array(words, np.int64)
    for sign in (1, -1):
        ends = np.array(lyndon_ends(places, sign), np.int64)
        at = np.flatnonzero(ends < len(words))
        # a run has its root again behind its first root
        at = at[numbers[at] == numbers[ends[at]]]
        done: dict[int, int] = {}
        for i, j in zip(at.tolist(), ends[at].tolist(), strict=True):
            period = j - i
            if j < done.get(period, 0):
                continue  # a later root of a run that was extended before
            end = j + places.right(i, j)
            done[period] = end
            if end - i + period <= max(least, periods * period):
                continue  # its first root would reach further
            start = i - places.left(i, j, period)
            if end - start >= max(least, periods * period):
                found.add((start, end - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(words: list, doc_id: int | None) -> list:
    """The words, of which those of one document in ten (by crc32 of its id) repeat a phrase from some place on."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _report(text: str, doc_id: int | None, plant: bool) -> tuple:
    words = _WORD.findall(text)
    if plant:
        words = planted(words, doc_id)
    numbers: dict[str, int] = {}
    found = runs_of([numbers.setdefault(w, len(numbers)) for w in words])
    kept = words
    if found:
        change = np.zeros(len(words) + 1, np.int64)
        for start, length, period in found:
            change[start + period] += 1
            change[start + length] -= 1
        kept = [w for w, covered in zip(words, np.cumsum(change).tolist(), strict=False) if not covered]
    longest = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else (None, None, None)
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in found)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    milli = 1000 * longest[1] // longest[2] if found else None
    return doc_id, len(found), *longest, milli, digest(lines), digest(" ".join(kept))


def periodic_runs(docs: DataFrame, plant: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_runs, the longest run (start, length, period, exponent_milli), and two digests.

    Words stand between ASCII white space.  A run has at least six words and four of its
    smallest periods, and no neighbouring word extends it.  Of the longest runs the one with
    the smallest start, then period, is given; without a run there are four nulls.
    `runs_sha256` is of the lines ``start,length,period`` of all runs, `collapsed_sha256` of the
    words that stay when each run keeps its first period, joined by a space.

    With ``plant``, documents repeat phrases as `planted` says.  Null and empty texts have no
    words; a null id plants nothing; rows that repeat an id have rows of their own; further
    columns are ignored; an empty table gives an empty result.  A task holds one document at
    a time.
    """
    small_batches(docs.sparkSession)
    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, texts in slices(batch.column(1), 4 << 20):
                rows = [_report(text, doc_id, plant) for text, doc_id in zip(texts.to_pylist(), ids[at : at + len(texts)], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return source.mapInArrow(frugal(run), schema)
