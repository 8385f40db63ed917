"""Ranking: fielded BM25, character n-gram TF-IDF, reciprocal rank fusion, and their metrics.

Corpora are long tables (doc_id, field, text); probes are (probe_id, query).  Documents meet
probes on shared terms only, so a query costs what its postings hold.  `doc_id` breaks ties.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrove.functions.text import SPACE, terms

#: Fixed values of the two rankings and of their fusion.
K1, B, FUSION = 1.5, 0.75, 60

#: Field weights of the ranking profiles (fixed values).
PROFILES: dict[str, dict[str, float]] = {
    "body_bm25": {"body": 1.0, "supplement": 0.2},
    "fielded_bm25": {"title": 3.0, "context": 2.0, "path": 2.4, "kind": 0.4, "body": 1.0, "supplement": 0.45},
    "structure_bm25": {"title": 3.2, "context": 2.7, "path": 3.1, "kind": 0.5, "pages": 0.15},
    "chargram_tfidf": {"title": 2.4, "context": 1.8, "path": 2.2, "body": 1.0, "supplement": 0.5},
}


#: Documents and probes of a block in which n-gram vectors are multiplied.
DOCS_BLOCK, PROBES_BLOCK = 2048, 64
#: Longest run of characters by which items of one or two words are looked up.
GRAM = 8


def profile(name: str) -> dict[str, float]:
    """The field weights of a profile; an unknown name is an error."""
    if name not in PROFILES:
        raise ValueError(f"unknown profile: {name}; known are {', '.join(PROFILES)}")
    return PROFILES[name]


def known_only(wanted: Sequence[str], corpora: DataFrame) -> list[str]:
    """Those of some corpora that there are, in the order asked for; unknown ones are dropped.  ``corpora`` is (corpus)."""
    found = {r.corpus for r in corpora.filter(F.col("corpus").isin(list(wanted))).select("corpus").distinct().collect()}
    return [c for c in wanted if c in found]


def long_fields(docs: DataFrame, id_col: str, fields: Mapping[str, Column]) -> DataFrame:
    """(doc_id, field, text) from one expression per field."""
    pairs = F.array(*[F.struct(F.lit(name).alias("field"), F.coalesce(text, F.lit("")).alias("text")) for name, text in fields.items()])
    return docs.select(docs[id_col].alias("doc_id"), F.explode(pairs).alias("x")).select("doc_id", "x.field", "x.text")


#: Query terms up to which their table is broadcast (some 100 bytes each); beyond, it is shuffled.
BROADCAST_TERMS = 200_000
#: Distinct n-grams of all fields, and of all probes, that are broadcast at most (some 32 bytes each).
BROADCAST_GRAMS, BROADCAST_PROBED = 2_000_000, 2_000_000
#: Grams that a task holds before it adds up equal ones, and scores that it sums at a time.
GRAMS_HELD, SCORES = 1_000_000, 1_000_000


def postings(corpus: DataFrame, tokens=terms, wanted: DataFrame | None = None) -> DataFrame:
    """(doc_id, field, term, tf, n_terms), of the terms in ``wanted`` (term) if it is given.

    Other terms leave before anything is shuffled.
    """
    split = corpus.select("doc_id", "field", tokens(F.col("text")).alias("terms"))
    each = split.select("doc_id", "field", F.size("terms").alias("n_terms"), F.explode("terms").alias("term"))
    if wanted is not None:
        few = wanted.count() <= BROADCAST_TERMS
        each = each.join(F.broadcast(wanted) if few else wanted, "term", "left_semi")
    return each.groupBy("doc_id", "field", "n_terms", "term").agg(F.count(F.lit(1)).alias("tf"))


def query_terms(probes: DataFrame, tokens=terms) -> DataFrame:
    """(probe_id, term, qtf, n_query)."""
    split = probes.select("probe_id", tokens(F.col("query")).alias("terms"))
    return split.select("probe_id", F.size("terms").alias("n_query"), F.explode("terms").alias("term")).groupBy("probe_id", "n_query", "term").agg(F.count(F.lit(1)).alias("qtf"))


def weight_of(weights: Mapping[str, float]) -> Column:
    out = F.when(F.lit(False), F.lit(0.0))
    for field, weight in weights.items():
        out = out.when(F.col("field") == field, F.lit(float(weight)))
    return out.otherwise(0.0)


def _repeats(corpus: DataFrame) -> bool:
    """Whether a document has several texts of one field."""
    return not corpus.groupBy("doc_id", "field").count().filter("count > 1").isEmpty()


def _collected(df: DataFrame, most: int) -> pa.Table | None:
    """The rows of a small table, or None if it has more than ``most``."""
    held = df.limit(most + 1).toArrow()
    return held if held.num_rows <= most else None


def bm25_components(corpus: DataFrame, probes: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """(probe_id, doc_id, field, part): the weighted score of each field that shares a term with the probe.

    Lengths average over all documents, empty fields included.
    """
    return _bm25(corpus, probes, weights, "field")


def bm25(corpus: DataFrame, probes: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """(probe_id, doc_id, score) of the documents that share a term with the probe."""
    return _bm25(corpus, probes, weights).groupBy("probe_id", "doc_id").agg(F.round(F.sum("part"), 6).alias("score"))


def _bm25(corpus: DataFrame, probes: DataFrame, weights: Mapping[str, float], *by: str) -> DataFrame:
    """(probe_id, doc_id, *by, part): scores of the rows of ``corpus``, those of a document that stand together summed but for ``by``.

    Up to `BROADCAST_TERMS` terms of probes go to every task with their document counts, so a
    row is scored where it is read and only its scores leave the task.  With more terms, or
    with several texts in a field, postings are joined.
    """
    wanted = query_terms(probes)
    own = corpus.filter(F.col("field").isin(list(weights)))
    pairs = _collected(wanted, BROADCAST_TERMS)
    if pairs is None or _repeats(own):
        return _bm25_joined(corpus, probes, weights, wanted)
    pairs = pairs.sort_by([("term", "ascending"), ("probe_id", "ascending")])
    terms_of, fields = pc.unique(pairs["term"]).cast(pa.string()), pa.array(list(weights))
    sc = corpus.sparkSession.sparkContext
    shared = sc.broadcast((terms_of, fields))
    split = own.select("doc_id", "field", terms(F.col("text")).alias("terms"))

    def codes(batch: pa.RecordBatch, known: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms of each row; and row, code and count of those that are asked for."""
        lists = batch.column("terms")
        n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        code = pc.fill_null(pc.index_in(lists.flatten(), value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        key = np.repeat(np.arange(len(n)), n) * max(1, len(known)) + code
        key, tf = np.unique(key[code >= 0], return_counts=True)
        return n, key // max(1, len(known)), key % max(1, len(known)), tf

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, kinds = shared.value
        df = np.zeros((len(kinds), len(known)), np.int64)
        docs, words, filled = (np.zeros(len(kinds), np.int64) for _ in range(3))
        for batch in batches:
            kind = pc.index_in(batch.column("field"), value_set=kinds).to_numpy(zero_copy_only=False)
            n, row, code, _ = codes(batch, known)
            np.add.at(df, (kind[row], code), 1)
            docs += np.bincount(kind, minlength=len(kinds))
            np.add.at(words, kind, n)
            np.add.at(filled, kind, batch.column("terms").is_valid().to_numpy(zero_copy_only=False))
        kind, code = np.nonzero(df)
        every = np.arange(len(kinds))
        columns = [np.concatenate(c) for c in ((kind, every, every, every), (code, every * 0 - 1, every * 0 - 2, every * 0 - 3), (df[kind, code], docs, words, filled))]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["kind", "code", "n"])

    # a row for each term and field, and three for each field
    counted = split.mapInArrow(count, "kind long, code long, n long").groupBy("kind", "code").agg(F.sum("n").alias("n")).toArrow()
    kind, code, n = (counted[c].to_numpy() for c in ("kind", "code", "n"))
    df = np.zeros((len(fields), len(terms_of)))
    docs, words, filled = (np.zeros(len(fields)) for _ in range(3))
    df[kind[code >= 0], code[code >= 0]] = n[code >= 0]
    for held, mark in ((docs, -1), (words, -2), (filled, -3)):
        held[kind[code == mark]] = n[code == mark]
    idf = np.log(1.0 + (docs[:, None] - df + 0.5) / (df + 0.5))
    mean = np.where(words == 0, 1.0, words / np.maximum(filled, 1))
    ids = pc.unique(pairs["probe_id"])
    at = np.searchsorted(pc.index_in(pairs["term"].combine_chunks(), value_set=terms_of).to_numpy(), np.arange(len(terms_of) + 1))
    who = pc.index_in(pairs["probe_id"].combine_chunks(), value_set=ids).to_numpy().astype(np.int64)
    scoring = sc.broadcast((idf, mean, np.array([float(w) for w in weights.values()]), at, who, pairs["qtf"].to_numpy(), ids))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, kinds = shared.value
        idf, mean, weight, at, who, qtf, ids = scoring.value
        rows = max(1, SCORES // max(1, len(ids)))
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                kind = pc.index_in(batch.column("field"), value_set=kinds).to_numpy(zero_copy_only=False)
                n, row, code, tf = codes(batch, known)
                gain = weight[kind[row]] * idf[kind[row], code] * (tf * (K1 + 1.0)) / (tf + K1 * (1.0 - B + B * n[row] / mean[kind[row]]))
                times = at[code + 1] - at[code]
                place = np.arange(times.sum()) + np.repeat(at[code] - (np.cumsum(times) - times), times)
                key = np.repeat(row, times) * len(ids) + who[place]
                yield _summed(batch, key, np.repeat(gain, times) * qtf[place], ids, by)

    types = {f.name: f.dataType.simpleString() for f in [*split.schema, *wanted.schema]}
    return split.mapInArrow(score, ", ".join([*(f"{c} {types[c]}" for c in ("probe_id", "doc_id", *by)), "part double"]))


def _summed(batch: pa.RecordBatch, key: np.ndarray, part: np.ndarray, ids: pa.Array, by: Sequence[str]) -> pa.RecordBatch:
    """(probe_id, doc_id, *by, part) of parts keyed by row times probes plus probe; rows of one document in turn are one unless ``by`` parts them."""
    first = np.arange(batch.num_rows)
    if not by and batch.num_rows:
        docs = batch.column("doc_id")
        same = pc.fill_null(pc.equal(docs[1:], docs[:-1]), False).to_numpy(zero_copy_only=False)
        first = np.maximum.accumulate(np.where(np.concatenate([[False], same]), 0, first))
    key = first[key // len(ids)] * len(ids) + key % len(ids) if len(key) else key
    size = batch.num_rows * len(ids)
    some = np.flatnonzero(np.bincount(key, minlength=size))
    sums = np.bincount(key, weights=part, minlength=size)[some]
    columns = [ids.take(pa.array(some % max(1, len(ids)))), *(batch.column(c).take(pa.array(some // max(1, len(ids)))) for c in ("doc_id", *by)), pa.array(sums, pa.float64())]
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
    return pa.RecordBatch.from_arrays(columns, names=["probe_id", "doc_id", *by, "part"])


def _bm25_joined(corpus: DataFrame, probes: DataFrame, weights: Mapping[str, float], wanted: DataFrame) -> DataFrame:
    """The same by joins of postings, for terms without number."""
    # only postings of probed terms are counted and scored
    hit = postings(corpus.filter(F.col("field").isin(list(weights))), wanted=wanted.select("term").distinct())
    sizes = corpus.groupBy("field").agg(F.count(F.lit(1)).alias("n_docs"), F.avg(F.size(terms(F.col("text")))).alias("mean_terms"))
    df = hit.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.ln(1.0 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    length = 1.0 - B + B * F.col("n_terms") / F.when(F.col("mean_terms") == 0, 1.0).otherwise(F.col("mean_terms"))
    gain = F.col("qtf") * idf * (F.col("tf") * (K1 + 1.0)) / (F.col("tf") + K1 * length)
    scored = hit.join(df, ["field", "term"]).join(F.broadcast(sizes), "field").join(wanted, "term")  # a row per field
    return scored.groupBy("probe_id", "doc_id", "field").agg(F.sum(gain * weight_of(weights)).alias("part"))


def explained_share(components: DataFrame) -> DataFrame:
    """(probe_id, doc_id, explained_share): what the strongest field gives of the best document's score."""
    totals = components.groupBy("probe_id", "doc_id").agg(F.round(F.sum("part"), 6).alias("score"), F.max("part").alias("most"), F.sum("part").alias("sum"))
    return ranked(totals, 1).select("probe_id", "doc_id", F.round(F.col("most") / F.col("sum"), 4).alias("explained_share"))


def _letters(text: Column) -> Column:
    """Lower-case ASCII words with single spaces between them."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))


def _grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text of `_letters` as numbers, rising, and how often each stands in it."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    letters = np.frombuffer(f" {text} ".encode(), np.uint8).astype(np.int64)
    each = []
    for size in (3, 4, 5):
        n = max(0, len(letters) - size + 1)
        code = np.zeros(n, np.int64)
        for k in range(size):
            code = code * 256 + letters[k : k + n]
        each.append(code)
    return np.unique(np.concatenate(each), return_counts=True)


def gram_counts(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, gram, tf, n): how often each character n-gram of `text` stands in a row, and how many it has.

    Grams are those of `char_ngrams`; up to five ASCII letters are one number, so nothing
    collides.  They are counted within the row, so a row leaves a task with its distinct grams.
    """
    typed = rows.select(*keys, _letters(F.col("text")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, counts, totals = [], [], []
            for text in batch.column("text").to_pylist():
                own, times = _grams(text)
                grams.append(own)
                counts.append(times)
                totals.append(int(times.sum()))
            ends = np.cumsum([0, *map(len, grams)]).astype(np.int32)
            flat = lambda parts: pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), flat(grams), flat(counts), pa.array(totals, pa.int64())], names=[*keys, "gram", "tf", "n"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in typed.schema if f.name in keys)
    counted = typed.mapInArrow(count, f"{kinds}, gram array<long>, tf array<long>, n long")
    return counted.select(*keys, "n", F.explode(F.arrays_zip("gram", "tf")).alias("x")).select(*keys, "x.gram", "x.tf", "n")


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Counts of numbers, added up."""
    numbers, at = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
    return [(numbers, np.bincount(at, weights=np.concatenate([n for _, n in held])).astype(np.int64))]


def chargram_tfidf(corpus: DataFrame, probes: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """(probe_id, doc_id, score): weighted cosine of character n-gram TF-IDF vectors of each field.

    All grams of a document count for its norm.  Up to `BROADCAST_GRAMS` grams and
    `BROADCAST_PROBED` of them in probes go to every task with their document counts, so a row
    is weighed and compared where it is read and only its scores leave the task.  With more, or
    with several texts in a field, blocks of documents meet blocks of probes.
    """
    own = corpus.filter(F.col("field").isin(list(weights)))
    fields = pa.array(list(weights))
    typed = own.select("doc_id", "field", _letters(F.col("text")).alias("text"))
    asked = _collected(gram_counts(probes.select("probe_id", F.col("query").alias("text")), "probe_id"), BROADCAST_PROBED)
    if asked is None or _repeats(own):
        return _chargram_blocks(corpus, probes, weights)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in fields]
        size, docs = np.zeros(len(fields), np.int64), np.zeros(len(fields), np.int64)
        for batch in batches:
            for kind, text in zip(pc.index_in(batch.column("field"), value_set=fields).to_pylist(), batch.column("text").to_pylist(), strict=True):
                docs[kind] += 1
                grams, _ = _grams(text)
                if len(grams):
                    held[kind].append((grams, np.ones(len(grams), np.int64)))
                    size[kind] += len(grams)
                if size[kind] > GRAMS_HELD + 2 * len(held[kind][0][0]) if held[kind] else False:
                    held[kind] = _merged(held[kind])
                    size[kind] = len(held[kind][0][0])
        for kind, found in enumerate(held):
            grams, n = _merged(found)[0] if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            grams, n = np.append(grams, -1), np.append(n, docs[kind])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int64)), pa.array(grams), pa.array(n)], names=["kind", "gram", "n"])

    df = _collected(typed.mapInArrow(count, "kind long, gram long, n long").groupBy("kind", "gram").agg(F.sum("n").alias("n")), BROADCAST_GRAMS)
    if df is None:
        return _chargram_blocks(corpus, probes, weights)
    df = df.sort_by([("kind", "ascending"), ("gram", "ascending")])
    kinds, ids = df["kind"].to_numpy(), pc.unique(asked["probe_id"])
    asked = asked.sort_by([("gram", "ascending"), ("probe_id", "ascending")])
    theirs, who = asked["gram"].to_numpy(), pc.index_in(asked["probe_id"].combine_chunks(), value_set=ids).to_numpy().astype(np.int64)
    share = asked["tf"].to_numpy() / asked["n"].to_numpy()
    tables = []
    for kind in range(len(fields)):
        grams, n = df["gram"].to_numpy()[kinds == kind], df["n"].to_numpy()[kinds == kind]
        docs, grams, n = n[:1].sum(), grams[1:], n[1:]
        idf = np.log((1.0 + docs) / (1.0 + n)) + 1.0
        # grams that the field lacks count in no probe
        at = np.searchsorted(grams, theirs)
        has = np.append(grams, -1)[at] == theirs
        w = share[has] * idf[at[has]]
        norm = np.sqrt(np.bincount(who[has], weights=w * w, minlength=len(ids)))
        tables.append((grams, idf, np.searchsorted(at[has], np.arange(len(grams) + 1)), who[has], w / norm[who[has]]))
    shared = corpus.sparkSession.sparkContext.broadcast((tables, [float(w) for w in weights.values()], ids))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, weight, ids = shared.value
        rows = max(1, SCORES // max(1, len(ids)))
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                keys, parts = [np.zeros(0, np.int64)], [np.zeros(0)]
                for row, (kind, text) in enumerate(zip(pc.index_in(batch.column("field"), value_set=fields).to_pylist(), batch.column("text").to_pylist(), strict=True)):
                    grams, tf = _grams(text)
                    if not len(grams):
                        continue
                    known, idf, at, who, w = tables[kind]
                    place = np.searchsorted(known, grams)
                    own = tf / tf.sum() * idf[place]
                    first, times = at[place], at[place + 1] - at[place]
                    pairs = np.arange(times.sum()) + np.repeat(first - (np.cumsum(times) - times), times)
                    sums = np.bincount(who[pairs], weights=np.repeat(own, times) * w[pairs], minlength=len(ids))
                    some = np.flatnonzero(sums)
                    keys.append(row * len(ids) + some)
                    parts.append(sums[some] * (weight[kind] / np.sqrt(own @ own)))
                yield _summed(batch, np.concatenate(keys), np.concatenate(parts), ids, ())

    types = {f.name: f.dataType.simpleString() for f in [*typed.schema, *probes.schema]}
    scored = typed.mapInArrow(score, f"probe_id {types['probe_id']}, doc_id {types['doc_id']}, part double")
    return scored.groupBy("probe_id", "doc_id").agg(F.round(F.sum("part"), 6).alias("score"))


def _chargram_blocks(corpus: DataFrame, probes: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """The same for grams without number.

    Only grams of some probe leave the pass that weighs them.  Blocks of documents then meet
    blocks of probes, and a task multiplies the two as matrices.
    """
    found = gram_counts(corpus.filter(F.col("field").isin(list(weights))), "doc_id", "field")
    sizes = corpus.groupBy("field").agg(F.count(F.lit(1)).alias("n_docs"))
    df = found.groupBy("field", "gram").agg(F.count(F.lit(1)).alias("df"))
    terms_of = gram_counts(probes.select("probe_id", F.col("query").alias("text")), "probe_id")
    marked = df.join(terms_of.select("gram").distinct().withColumn("asked", F.lit(True)), "gram", "left")
    idf = F.ln((1.0 + F.col("n_docs")) / (1.0 + F.col("df"))) + 1.0
    idf = marked.join(F.broadcast(sizes), "field").select("field", "gram", "asked", idf.alias("idf"))  # a row per field
    weight = F.col("tf") / F.col("n") * F.col("idf")
    one = F.struct("gram", weight.alias("w"))
    collected = [F.sqrt(F.sum(weight * weight)).alias("norm"), F.collect_list(F.when(F.col("asked"), one)).alias("x")]
    names = ("field", "i", "j", "id", "gram", "w", "norm")

    def dealt(rows: DataFrame, id_col: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        placed = rows.withColumns({own: F.pmod(F.xxhash64(id_col), F.lit(n_own)), other: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long")))})
        return placed.select("field", "i", "j", F.col(id_col).alias("id"), F.col("x.gram").alias("gram"), F.col("x.w").alias("w"), "norm").toDF(*names)

    n_docs, n_probes = (max(1, -(-df.select(c).distinct().count() // size)) for df, c, size in ((corpus, "doc_id", DOCS_BLOCK), (probes, "probe_id", PROBES_BLOCK)))
    docs = dealt(found.join(idf, ["field", "gram"]).groupBy("field", "doc_id").agg(*collected).filter(F.size("x") > 0), "doc_id", "i", n_docs, "j", n_probes)
    asked = dealt(terms_of.join(idf.filter("asked"), "gram").groupBy("field", "probe_id").agg(*collected), "probe_id", "j", n_probes, "i", n_docs)

    def meet(own: pa.Table, wanted: pa.Table) -> pa.Table:
        out = {"field": [], "probe_id": [], "doc_id": [], "cosine": []}
        if own.num_rows and wanted.num_rows:
            field, lists = own["field"][0].as_py(), [np.asarray(x) for x in wanted["gram"].to_numpy(zero_copy_only=False)]
            known = np.unique(np.concatenate(lists))
            matrix = np.zeros((len(known), len(lists)))
            for c, (grams, w, norm) in enumerate(zip(lists, wanted["w"].to_numpy(zero_copy_only=False), wanted["norm"].to_pylist(), strict=True)):
                matrix[np.searchsorted(known, grams), c] = np.asarray(w) / norm
            ids = wanted["id"].to_numpy()
            for doc, grams, w, norm in zip(own["id"].to_pylist(), own["gram"].to_numpy(zero_copy_only=False), own["w"].to_numpy(zero_copy_only=False), own["norm"].to_pylist(), strict=True):
                at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
                hit = known[at] == grams
                cosines = (np.asarray(w)[hit] / norm) @ matrix[at[hit]]
                some = np.flatnonzero(cosines)
                out["probe_id"] += ids[some].tolist()
                out["doc_id"] += [doc] * len(some)
                out["cosine"] += cosines[some].tolist()
            out["field"] = [field] * len(out["doc_id"])
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), (pa.string(), pa.int64(), pa.int64(), pa.float64()), strict=True)})

    key = ["field", "i", "j"]
    cosines = docs.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(meet, "field string, probe_id long, doc_id long, cosine double")
    return cosines.groupBy("probe_id", "doc_id").agg(F.round(F.sum(weight_of(weights) * F.col("cosine")), 6).alias("score"))


def ranked(scores: DataFrame, k: int | None = None) -> DataFrame:
    """``scores`` with `rank` per probe, best first; with ``k``, the first ``k`` only."""
    out = scores.withColumn("rank", F.row_number().over(Window.partitionBy("probe_id").orderBy(F.desc("score"), "doc_id")).cast("long"))
    return out.filter(F.col("rank") <= k) if k else out


def fuse(runs: Sequence[DataFrame], ordinal: DataFrame) -> DataFrame:
    """(probe_id, doc_id, score): reciprocal rank fusion of score tables.

    A document that a run didn't score stands behind all that it scored, in the order of
    ``ordinal`` (doc_id, ord from 1); its place follows from how many scored ones stand before it.
    """
    every = None
    for k, run in enumerate(runs):
        one = ranked(run.filter("score > 0")).select("probe_id", "doc_id", F.col("rank").alias(f"rank_{k}"))
        every = one if every is None else every.join(one, ["probe_id", "doc_id"], "full")
    placed = every.join(ordinal, "doc_id")
    by_ord = Window.partitionBy("probe_id").orderBy("ord")
    total = Window.partitionBy("probe_id")
    score = F.lit(0.0)
    for k in range(len(runs)):
        rank = F.col(f"rank_{k}")
        behind = F.count(rank).over(total) + F.col("ord") - F.count(rank).over(by_ord)
        score = score + 1.0 / (FUSION + F.coalesce(rank, behind))
    return placed.select("probe_id", "doc_id", F.round(score, 6).alias("score"))


def containing(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(item_id, doc_id) of the documents whose text contains the item's, as it stands.

    The words inside an item, all but its first and last, stand whole in each document that
    contains it.  So an item is looked up by the one of them that the fewest documents have, and
    confirmed on the texts.  An item of fewer words is looked up by its rarest run of up to
    `GRAM` characters; runs are made of the documents only where there are such items.  An
    empty item is contained nowhere.
    """
    own = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).filter("text IS NOT NULL")
    asked = items.filter("text <> ''").select("item_id", F.col("text").alias("item"))
    words = asked.select("item_id", "item", F.split("item", SPACE + "+").alias("w"))
    inner = words.filter(F.size("w") >= 3).select("item_id", "item", F.explode(F.array_distinct(F.slice("w", F.lit(2), F.size("w") - 2))).alias("key"))
    found = _looked_up(own, inner, F.array_distinct(F.split("text", SPACE + "+")))
    short = words.filter(F.size("w") < 3)
    least = short.agg(F.min(F.length("item")).alias("n")).first()["n"]
    if least is None:
        return found
    size = min(GRAM, least)
    runs = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - size + 1), lambda i: F.col(c).substr(i, F.lit(size))))
    grams = short.select("item_id", "item", F.explode(runs("item")).alias("key"))
    return found.unionByName(_looked_up(own.filter(F.length("text") >= size), grams, runs("text")))


def _looked_up(docs: DataFrame, keyed: DataFrame, keys: Column) -> DataFrame:
    """(item_id, doc_id) of the documents that have an item's rarest key and contain the item."""
    held = docs.select("doc_id", F.explode(keys).alias("key")).join(keyed.select("key").distinct(), "key", "left_semi")
    df = held.groupBy("key").agg(F.count(F.lit(1)).alias("df"))
    # an item with a key that no document has is nowhere
    counted = keyed.join(df, "key", "left").groupBy("item_id", "item").agg(F.min_by("key", F.struct(F.coalesce("df", F.lit(0)), "key")).alias("key"))
    met = held.join(counted, "key").select("item_id", "item", "doc_id")
    return met.join(docs, "doc_id").filter(F.contains("text", F.col("item"))).select("item_id", "doc_id").distinct()


def probe_metrics(scores: DataFrame, gold: DataFrame, ordinal: DataFrame) -> DataFrame:
    """(probe_id, n_gold, best_rank, mrr, hit_at_1, recall_at_3, recall_at_5, margin), each rounded to 4, the margin to 6.

    All documents of ``ordinal`` (doc_id, ord from 1) are ranked: those without a score stand
    behind the others, in the order of their ids, with a score of 0.  The ranks of the first
    five gold documents of a probe are counted from the documents before them; no later one
    bears on a figure.  The margin is null where there is no document but gold ones.
    """
    run = scores.filter("score > 0").select("probe_id", F.col("doc_id").alias("other"), F.col("score").alias("other_score"))
    mine = gold.select("probe_id", "doc_id").distinct().join(scores, ["probe_id", "doc_id"], "left").join(ordinal, "doc_id").withColumn("score", F.coalesce("score", F.lit(0.0)))
    better = (F.col("other_score") > F.col("score")) | ((F.col("other_score") == F.col("score")) & (F.col("other") < F.col("doc_id")))
    earlier = F.col("other") < F.col("doc_id")
    kept = Window.partitionBy("probe_id").orderBy(F.desc(F.greatest("score", F.lit(0.0))), "doc_id")
    first = mine.withColumn("place", F.row_number().over(kept)).filter("place <= 5").drop("place")
    met = run.join(F.broadcast(first), "probe_id")  # five rows a probe
    counts = met.groupBy("probe_id", "doc_id").agg(F.count_if(better).alias("better"), F.count_if(earlier).alias("earlier"), F.count(F.lit(1)).alias("scored"))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("better", "earlier", "scored")}
    counted = first.join(counts, ["probe_id", "doc_id"], "left").withColumns(zero)
    rank = F.when(F.col("score") > 0, F.col("better") + 1).otherwise(F.col("scored") + F.col("ord") - F.col("earlier"))
    ranks = counted.withColumn("rank", rank).groupBy("probe_id").agg(F.min("rank").alias("best_rank"), F.count_if(F.col("rank") <= 3).alias("in_3"), F.count_if(F.col("rank") <= 5).alias("in_5"))
    best = mine.groupBy("probe_id").agg(F.count(F.lit(1)).alias("n_gold"), F.max("score").alias("best_gold")).join(ranks, "probe_id")
    others = run.join(gold.select("probe_id", F.col("doc_id").alias("other")).distinct(), ["probe_id", "other"], "left_anti").groupBy("probe_id").agg(F.max("other_score").alias("best_other"))
    total = ordinal.agg(F.count(F.lit(1)).alias("n_docs"))
    out = best.join(others, "probe_id", "left").crossJoin(F.broadcast(total))  # one row
    other = F.coalesce("best_other", F.when(F.col("n_docs") > F.col("n_gold"), 0.0))
    return out.select(
        "probe_id",
        "n_gold",
        "best_rank",
        F.round(1.0 / F.col("best_rank"), 4).alias("mrr"),
        (F.col("best_rank") == 1).cast("double").alias("hit_at_1"),
        F.round(F.col("in_3") / F.col("n_gold"), 4).alias("recall_at_3"),
        F.round(F.col("in_5") / F.col("n_gold"), 4).alias("recall_at_5"),
        F.round(F.col("best_gold") - other, 6).alias("margin"),
    )


def miss_class(hit_at_1: Column, recall_at_3: Column, mrr: Column) -> Column:
    """What a probe misses, "pass" if nothing."""
    return (
        F.when((hit_at_1 < 1) & (recall_at_3 < 1), "top1_and_recall_miss").when(hit_at_1 < 1, "top1_miss").when(mrr < 1, "rank_drop").otherwise("pass")
    )
