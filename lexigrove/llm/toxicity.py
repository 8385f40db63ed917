"""Toxicity: Levenshtein automata over a lexicon trie, with context windows."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrove.llm.common import frugal, materialise, remove, small_batches, unused

#: Labelled rows that the lexicon is learned from, at most.
SAMPLE = 20_000
#: Labelled toxic documents that a lexicon entry must stand in.
LEAST_COUNT = 3
#: Share of the entries that may owe their place to chance.
CHANCE = 0.05
#: Share of an entry's labelled documents, both classes weighted alike, that must be toxic.
LEAST_PRECISION = 0.9
#: Terms whose counts a task holds before it passes them on; some 20 MB.
COUNTED = 100_000
#: Words up to which a text is a message that several people may write; longer ones that recur are copies.
MESSAGE = 20
STEM_LENGTHS = (4, 5, 6, 7)
THRESHOLD = 0.3

#: Factors of a hit's weight (fixed values).
MISSPELLED, QUOTED, REPORTED, ADDRESSED = 0.4, 0.25, 0.5, 1.25
#: Words that report speech or address the reader, looked for beside a hit (fixed values).
REPORTS = frozenset("called insult insults quote quoted said says slur term word wrote".split())
ADDRESSES = frozenset("are du eres es tu u vous you your".split())
WINDOW_WORDS, WINDOW_CHARS = 4, 60

#: Words: everything but ASCII marks and those of Latin-1, general and CJK punctuation.
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\xBF\u2000-\u206F\u3000-\u303F]+")
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: The same on UTF-8 bytes, with a space for each byte that stands in no word.
_BYTES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
#: Digits that stand for letters.
_LEET = str.maketrans("013457", "oieast")
_DIGIT = re.compile("[0-9]")
_QUOTES = {'"': '"', "“": "”", "„": "“", "«": "»", "‘": "’"}
#: Texts that are scored together.
TOGETHER = 256
#: Words that a task remembers; some 60 MB.
_REMEMBERED = 150_000
#: Bits of the mark table of shortened entries, 2 MB.
_MARKS = 24
_BASE, _GOLDEN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def byte_words(text: str) -> list[bytes]:
    """The lower-cased runs of a text between ASCII marks, in UTF-8; one may hold several words."""
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split()


def decoded(runs: Iterable[bytes]) -> list[str]:
    """The words of such runs."""
    out = []
    for run in runs:
        word = run.decode("utf-8", "surrogatepass")
        out += [word] if run.isascii() or word.isalnum() else WORD.findall(word)
    return out


def distinct_words(text: str) -> set[str]:
    """The lower-cased words of a text."""
    return set(decoded(set(byte_words(text))))


def _plain(word: str) -> str:
    """A word with letters in place of digits."""
    return word.translate(_LEET) if _DIGIT.search(word) else word


def _place(sums: np.ndarray) -> np.ndarray:
    return ((sums * _GOLDEN) >> np.uint64(64 - _MARKS)).astype(np.int64)


def shortened(words: list[str], k: int) -> np.ndarray:
    """Mark places of words of one length without up to ``k`` letters (2 at most), one column for each way.

    A word's polynomial sum less some letters is put together from the sums of its openings.
    """
    n = len(words[0])
    codes = np.array(words).view(np.uint32).reshape(len(words), n).astype(np.uint64)
    codes = (codes + np.uint64(1)) * _GOLDEN
    power = np.ones(n + 1, np.uint64)
    power[1:] = np.multiply.accumulate(np.full(n, _BASE, np.uint64))
    opening = np.zeros((n + 1, len(words)), np.uint64)  # sums of the first letters
    for i in range(n):
        opening[i + 1] = opening[i] * _BASE + codes[:, i]
    between = lambda a, b: opening[b] - opening[a] * power[b - a]
    sums = [opening[n]]
    for i in range(n if k else 0):
        sums.append(opening[i] * power[n - 1 - i] + between(i + 1, n))
        for j in range(i + 1, n if k > 1 else 0):
            sums.append(opening[i] * power[n - 2 - i] + between(i + 1, j) * power[n - 1 - j] + between(j + 1, n))
    return np.stack([_place(x) for x in sums], axis=1)


def allowed(length: int) -> int:
    """Edits within which a word of the lexicon is still met."""
    return 0 if length < 5 else 1 if length < 9 else 2


class Lexicon:
    """Weighted words, in a trie, and stems.

    A word is met within `allowed` edits, a stem by any word that opens with it; both also by
    digits in place of letters, but for whole numbers.  `search` walks the trie and the
    Levenshtein automaton of the looked-up word together: the automaton's state is the row of
    edit distances, and a branch is left as soon as no entry beneath it can be near enough.
    Words of ``exactly`` and of up to four letters are met as they are only; words of
    ``ordinary`` are no misspellings.
    """

    def __init__(self, words: dict[str, float], stems: dict[str, float], ordinary: Iterable[str] = (), exactly: Iterable[str] = ()):
        self.words, self.stems, self.ordinary, self.exactly = words, stems, frozenset(ordinary), frozenset(exactly)
        fuzzy = [w for w in words if allowed(len(w)) and w not in self.exactly]
        self.trie: dict = {}
        for entry in fuzzy:
            node = self.trie
            for c in entry:
                node = node.setdefault(c, {})
            node["word"] = entry
        self._bound(self.trie)
        # two words within k edits are alike without k letters of each
        self._marks = {k: np.zeros(1 << _MARKS >> 3, np.uint8) for k in (1, 2)}
        self._longest = {1: 0, 2: 0}
        by_length: dict[int, list[str]] = {}
        for w in fuzzy:
            by_length.setdefault(len(w), []).append(w)
        for n, alike in by_length.items():
            k = allowed(n)
            at = shortened(alike, k).ravel()
            np.bitwise_or.at(self._marks[k], at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
            self._longest[k] = max(self._longest[k], n)
        self._stem_lengths = sorted({len(x) for x in stems})
        self._known: dict[str, tuple[str, float, bool] | None] = {}
        self._plain: set[bytes] = set()
        self._met: set[bytes] = set()
        self._words: set[str] = set()  # that meet an entry, of the runs in `_met`

    def forget(self) -> None:
        """Drops what was looked up: a worker waits for other tasks, which need the room."""
        self._known.clear()
        self._plain, self._met, self._words = set(), set(), set()

    def _bound(self, node: dict) -> int:
        """Notes at each node the most edits that an entry beneath it allows."""
        own = allowed(len(node["word"])) if "word" in node else -1
        node["most"] = max([own, *(self._bound(below) for c, below in node.items() if len(c) == 1)])
        return node["most"]

    def _possible(self, words: list[str]) -> list[str]:
        """Those of some words that may be within an entry's edits."""
        by_length: dict[int, list[str]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        found = []
        for n, alike in by_length.items():
            near = np.zeros(len(alike), bool)
            for k, least in ((1, 4), (2, 7)):
                if least <= n <= self._longest[k] + k:
                    for i in range(0, len(alike), 8192):
                        at = shortened(alike[i : i + 8192], k)
                        near[i : i + 8192] |= ((self._marks[k][at >> 3] >> (at & 7).astype(np.uint8)) & 1).any(axis=1)
            found += [alike[i] for i in np.flatnonzero(near)]
        return found

    def meeting(self, words: Iterable[str]) -> set[str]:
        """Those of many words that meet an entry."""
        plain = {w: _plain(w) for w in words if not w.isdigit()}
        possible = set(self._possible(list({*plain.values()})))
        known = lambda w: w in self.words or self._stem(w)
        return {w for w, p in plain.items() if (p in possible or known(w) or (p != w and known(p))) and self.search(w)}

    def _note(self, runs: set[bytes]) -> None:
        """Looks up many runs at once and remembers those with and without a hit."""
        if len(self._plain) + len(self._met) > _REMEMBERED:
            self._plain, self._met, self._words = set(), set(), set()
        new = list(runs - self._plain - self._met)
        if not new:
            return
        held = [decoded([run]) for run in new]
        met = self.meeting({w for words in held for w in words})
        self._words |= met
        for run, words in zip(new, held, strict=True):
            (self._plain if met.isdisjoint(words) else self._met).add(run)

    def __reduce__(self):
        return Lexicon, (self.words, self.stems, self.ordinary, self.exactly)

    def search(self, word: str) -> tuple[str, float, bool] | None:
        """(entry, weight, misspelled) of the entry that a word meets, or None."""
        if word not in self._known:
            if len(self._known) > _REMEMBERED:
                self._known.clear()
            self._known[word] = self._search(word)
        return self._known[word]

    def _search(self, word: str) -> tuple[str, float, bool] | None:
        if word in self.words:
            return word, self.words[word], False
        if stem := self._stem(word):
            return stem, self.stems[stem], False
        if word in self.ordinary or word.isdigit():
            return None
        plain = _plain(word)
        if plain != word:
            if plain in self.words:
                return plain, self.words[plain], True
            if stem := self._stem(plain):
                return stem, self.stems[stem], True
        found = self._near(plain)
        return (found, self.words[found], True) if found else None

    def _stem(self, word: str) -> str | None:
        return next((word[:k] for k in self._stem_lengths if word[:k] in self.stems), None)

    def _near(self, word: str) -> str | None:
        best: tuple[int, str] | None = None
        stack = [(self.trie, list(range(len(word) + 1)))]
        while stack:
            node, row = stack.pop()
            if (entry := node.get("word")) and row[-1] <= allowed(len(entry)) and (best is None or (row[-1], entry) < best):
                best = row[-1], entry
            for c, below in node.items():
                if len(c) > 1:
                    continue
                state = [row[0] + 1]
                for i, w in enumerate(word):
                    state.append(min(state[i] + 1, row[i + 1] + 1, row[i] + (w != c)))
                if min(state) <= below["most"]:
                    stack.append((below, state))
        return best[1] if best else None

    def hits(self, text: str) -> list[tuple[str, float]]:
        """(entry, weight in its context) of each word of a text that meets the lexicon."""
        return self.hits_of([text])[0]

    def hits_of(self, texts: list[str]) -> list[list[tuple[str, float]]]:
        """The hits of each of some texts."""
        runs = [set(byte_words(text)) for text in texts]
        self._note(set().union(*runs))
        return [[] if self._met.isdisjoint(own) else self._weighed(text) for text, own in zip(texts, runs, strict=True)]

    def _weighed(self, text: str) -> list[tuple[str, float]]:
        found = list(WORD.finditer(text.translate(_FOLD)))
        words = [m[0] for m in found]
        out = []
        for i, w in enumerate(words):
            if w in self._words:
                entry, weight, misspelled = self.search(w)
                near = words[max(0, i - WINDOW_WORDS) : i] + words[i + 1 : i + 1 + WINDOW_WORDS]
                factor = MISSPELLED if misspelled else 1.0
                if quoted(text, *found[i].span()):
                    factor *= QUOTED
                elif not REPORTS.isdisjoint(near):
                    factor *= REPORTED
                elif not ADDRESSES.isdisjoint(near):
                    factor *= ADDRESSED
                out.append((entry, weight * factor))
        return out


def quoted(text: str, begin: int, end: int) -> bool:
    """Whether quotation marks open before a word and close after it, on its line and near it."""
    before = text[max(0, begin - WINDOW_CHARS) : begin].rpartition("\n")[2]
    after = text[end : end + WINDOW_CHARS].partition("\n")[0]
    for opening, closing in _QUOTES.items():
        if opening == closing:
            if before.count(opening) % 2 and closing in after:
                return True
        elif before.rfind(opening) > before.rfind(closing) and closing in after:
            return True
    return False


def split_of(doc_id) -> F.Column:
    """CRC-32 of the id as text, modulo 4; remainder 2 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """(text, toxic) of at most ``limit`` labelled rows that aren't held out, by a hash of their ids, and where they are written."""
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(split_of(F.col("doc_id")) != 2)
    picked = known.select(F.col("doc_id").alias("__label_id"), F.col("toxic").alias("__toxic")).distinct().orderBy(F.xxhash64("__label_id"), "__label_id", "__toxic").limit(limit)
    # at most `limit` rows of two numbers
    found = docs.select(docs[id_col].alias("__id"), docs[text_col].alias("text")).join(F.broadcast(picked), F.col("__id") == F.col("__label_id"))
    return materialise(found.filter("text IS NOT NULL").select("text", (F.col("__toxic") == 1).alias("toxic")), "toxicity-rows")


def chances(bad: np.ndarray, good: np.ndarray, n_bad: int, n_good: int) -> np.ndarray:
    """The chance that a term of `bad` + `good` documents stands in `bad` toxic ones or more, if labels mean nothing (hypergeometric)."""
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n_bad + n_good + 1)))])
    choose = lambda n, k: logs[n] - logs[k] - logs[n - k]
    out = np.ones(len(bad))
    for i, (b, g) in enumerate(zip(np.asarray(bad).tolist(), np.asarray(good).tolist(), strict=True)):
        if b * n_good > g * n_bad:  # others are no likelier in toxic documents
            x = np.arange(b, min(n_bad, b + g) + 1)
            out[i] = min(1.0, float(np.exp(choose(n_bad, x) + choose(n_good, b + g - x) - choose(n_bad + n_good, b + g)).sum()))
    return out


def bar(chance: np.ndarray, times: np.ndarray, share: float = CHANCE) -> float:
    """The largest chance of a term that is admitted, of terms with these chances, each so many times.

    Terms that stand out among all that are tested (Bonferroni) are certain.  Of the others as
    many are admitted as keep the share of false ones (Benjamini and Hochberg); the certain
    ones don't count there, so many of them make no room for doubtful ones.
    """
    order = np.argsort(chance, kind="stable")
    chance, times = np.asarray(chance)[order], np.asarray(times)[order]
    total = int(times.sum())
    certain = chance * total <= share
    rest = total - int(times[certain].sum())
    ranks = np.cumsum(np.where(certain, 0, times))
    admitted = certain | (chance * max(rest, 1) <= share * ranks)
    return float(chance[admitted].max()) if admitted.any() else -1.0


def _terms(word: str) -> list[str]:
    """A word and its openings."""
    return [word, *(word[:k] + "*" for k in STEM_LENGTHS if len(word) > k)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and clean documents of each term, in parts; of the term "", all documents."""
    seen: dict[bool, Counter] = {False: Counter(), True: Counter()}

    def held() -> pa.RecordBatch:
        terms = list(dict.fromkeys([*seen[True], *seen[False]]))
        columns = [pa.array([seen[x][t] for t in terms], pa.int64()) for x in (True, False)]
        for c in seen.values():
            c.clear()
        return pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *columns], names=["term", "bad", "good"])

    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            seen[toxic].update({t for w in distinct_words(text) for t in _terms(w)} | {""})
            if len(seen[True]) + len(seen[False]) > COUNTED:
                yield held()
    yield held()


def _places(rows: DataFrame, terms: set[str]) -> dict[str, int]:
    """In how many different places of the toxic documents each of some terms stands.

    Places are told by the two words beside them, but each short message is a place of its own.
    """
    shared = rows.sparkSession.sparkContext.broadcast(terms)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            found = set()
            for n, text in enumerate(batch.column(0).to_pylist(), n + 1):
                words = ["", *decoded(byte_words(text)), ""]
                own = f"{part}.{n}" if len(words) <= MESSAGE + 2 else None
                found |= {(t, own or f"{a} {c}") for a, b, c in zip(words, words[1:], words[2:]) for t in _terms(b) if t in shared.value}
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.string()) for i in (0, 1)], names=["term", "place"])

    seen = rows.filter(F.col("toxic").cast("boolean")).select("text").mapInArrow(frugal(find), "term string, place string").distinct()
    return {r.term: r["count"] for r in seen.groupBy("term").count().collect()}


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Learn words and stems that stand in toxic documents alone, as good as.

    A term needs `LEAST_COUNT` toxic documents, the precision, and counts that chance hardly
    gives: words, and stems of each length, are tested together, and `bar` says what is enough.  Copies of a text say nothing of
    misspellings and other words, so a stem must pass, and a word be met with edits, by its
    toxic documents counted at most as often as it stands in different places.  Counts are
    taken on the executors; what reaches the driver is the entries that pass and the ordinary
    words that are few edits away from one, which the sample bounds.  Without clean documents
    nothing is learned.
    """
    spark = rows.sparkSession
    parts = rows.mapInArrow(frugal(_count), "term string, bad long, good long")
    counts, path = materialise(parts.groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "toxicity-terms")
    total = counts.filter("term = ''").first()
    if total is None or not total.bad or not total.good:
        remove(spark, path)
        return Lexicon({}, {})
    n_bad, n_good = total.bad, total.good
    share, rest = F.col("bad") / n_bad, F.col("good") / n_good
    able = counts.filter("term <> ''").filter((F.col("bad") >= LEAST_COUNT) & (share >= LEAST_PRECISION * (share + rest)))
    family = F.when(F.endswith("term", F.lit("*")), F.length("term") - 1).otherwise(0)
    # pairs of counts are few: the sample bounds them
    pairs = counts.filter("term <> '' AND bad > 0").groupBy(family.alias("family"), "bad", "good").agg(F.count(F.lit(1)).alias("times")).toPandas()
    pairs["chance"] = chances(pairs.bad.to_numpy(), pairs.good.to_numpy(), n_bad, n_good)
    bars = {int(f): bar(part.chance.to_numpy(), part.times.to_numpy()) for f, part in pairs.groupby("family")}
    enough = pairs[pairs.chance <= pairs.family.map(bars)][["family", "bad", "good"]]
    enough = spark.createDataFrame(list(enough.itertuples(index=False, name=None)), "family int, bad long, good long")
    likely = able.withColumn("family", family).join(F.broadcast(enough), ["family", "bad", "good"]).collect()
    places = _places(rows, {r.term for r in likely})
    apart = [(r.term, min(r.bad, places.get(r.term, 0)), r.good, bars[r.family]) for r in likely]
    precise = lambda bad, good: bad / n_bad >= LEAST_PRECISION * (bad / n_bad + good / n_good)
    again = chances(np.array([x[1] for x in apart]), np.array([x[2] for x in apart]), n_bad, n_good)
    wide = {t: bad for (t, bad, good, most), c in zip(apart, again.tolist(), strict=True) if bad >= LEAST_COUNT and precise(bad, good) and c <= most}
    # log-likelihood ratios; 1 stands for a hundred times likelier in toxic documents
    weight = {r.term: min(1.5, math.log((r.bad + 0.5) / (n_bad + 1) * (n_good + 1) / (r.good + 0.5)) / math.log(100)) for r in likely}
    exact = {r.term: r.bad for r in likely if not r.term.endswith("*")}
    most: Counter = Counter()
    for w, n in exact.items():
        for k in STEM_LENGTHS:
            most[w[:k]] = max(most[w[:k]], n)
    stems: dict[str, float] = {}
    for term in sorted((t[:-1] for t in wide if t.endswith("*")), key=lambda t: (len(t), t)):
        alone = most[term] >= 0.9 * wide[term + "*"]
        if not alone and not any(term[:k] in stems for k in STEM_LENGTHS):
            stems[term] = weight[term + "*"]
    words = {w: weight[w] for w in exact}
    exactly = {w for w in words if w not in wide and not any(w[:k] in stems for k in STEM_LENGTHS)}
    if stems:
        # words under a stem are met by it; they stand here for their misspellings, rarer ones with the stem's weight
        under = able.filter(~F.endswith("term", F.lit("*"))).select("term", *(F.substring("term", 1, k).alias(f"s{k}") for k in STEM_LENGTHS))
        opening = [F.col(f"s{k}").isin([s for s in stems if len(s) == k]) for k in STEM_LENGTHS]
        for r in under.filter(reduce(or_, opening)).collect():
            words.setdefault(r.term, next(stems[s] for k in STEM_LENGTHS if (s := r.term[:k]) in stems))
    shared = spark.sparkContext.broadcast(Lexicon(words, stems, (), exactly))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = shared.value.meeting(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([t for t in met if shared.value.search(t)[2]], pa.string())], names=["term"])
        shared.value.forget()

    clean = counts.filter("good > 0 AND term <> '' AND NOT endswith(term, '*')").select("term")
    ordinary = sorted(r.term for r in clean.mapInArrow(frugal(near), "term string").collect())
    remove(spark, path)
    return Lexicon(words, stems, ordinary, exactly)


def mass(lexicon: Lexicon, text: str | None) -> float:
    return sum(w for _, w in lexicon.hits(text)) if text else 0.0


def learn_half(rows: DataFrame, lexicon: Lexicon) -> float:
    """The mass that scores 0.5, such that `THRESHOLD` parts the labels with the best F1."""
    grid = (0.45, 0.6, 0.75, 0.9, 1.2, 1.6, 2.0, 3.0)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for i in range(0, batch.num_rows, TOGETHER):
                part = batch[i : i + TOGETHER]
                for hits, toxic in zip(lexicon.hits_of(part.column(0).to_pylist()), part.column(1).to_pylist(), strict=True):
                    m = sum(w for _, w in hits)
                    counts.update((k, toxic) for k, cut in enumerate(grid) if m >= cut)
                    counts["all"] += toxic
        lexicon.forget()
        keys = [(k, sum(v for c, v in counts.items() if c == (k, True)), sum(v for c, v in counts.items() if c == (k, False))) for k in range(len(grid))]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in keys] , pa.int64()) for i in range(3)] + [pa.array([counts["all"]] * len(keys), pa.int64())], names=["k", "hit", "wrong", "bad"])

    tallied = rows.mapInArrow(frugal(tally), "k long, hit long, wrong long, bad long").groupBy("k").agg(*(F.sum(c).alias(c) for c in ("hit", "wrong", "bad"))).collect()
    best = max(tallied, key=lambda r: (2 * r.hit / max(1, r.hit + r.wrong + r.bad), -r.k), default=None)
    cut = grid[best.k] if best else grid[0]
    return cut * (1 - THRESHOLD) / THRESHOLD


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", score_col: str = "toxicity_score", hits_col: str = "toxicity_hits") -> DataFrame:
    """``docs`` with `score_col` (0 to 1) and `hits_col` (entries met).

    The score is m / (m + half), where m is the summed weight of all hits of the whole text
    in their contexts.  It is learned from at most `sample` labelled rows and uses the text
    alone.  Null and empty texts score 0, repeated rows alike; without labels nothing is met;
    other columns stay as they are, but a column of one of the two names is replaced; an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows, path = training_rows(docs, labels, sample, id_col, text_col)
    lexicon = learn_lexicon(rows)
    half = learn_half(rows, lexicon)
    remove(spark, path)
    shared = spark.sparkContext.broadcast(lexicon)
    kind = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("hits", T.ArrayType(T.StringType()))])

    @F.arrow_udf(kind)
    @frugal
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lexicon = shared.value
        for batch in texts:
            scores, met = [], []
            for i in range(0, len(batch), TOGETHER):
                for hits in lexicon.hits_of([x or "" for x in batch[i : i + TOGETHER].to_pylist()]):
                    m = sum(w for _, w in hits)
                    scores.append(m / (m + half))
                    met.append(sorted({e for e, _ in hits}))
            yield pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(met, pa.list_(pa.string()))], ["score", "hits"])
        lexicon.forget()

    own = unused(docs, "toxicity")
    scored = docs.withColumn(own, score(docs[text_col]))
    return scored.withColumns({score_col: F.col(own)["score"], hits_col: F.col(own)["hits"]}).drop(own)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.  A null id is not held out."""
    scored = score_toxicity(docs.select("doc_id", "text"), labels)
    return scored.select(
        "doc_id",
        F.coalesce(split_of(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"),
        F.col("toxicity_score").alias("score"),
        (F.col("toxicity_score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that score `THRESHOLD` or more; all columns stay as they are."""
    score, hits = unused(docs, "score"), unused(docs, "hits")
    return score_toxicity(docs, labels, score_col=score, hits_col=hits).filter(F.col(score) < THRESHOLD).select(*docs.columns)
