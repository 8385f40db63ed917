"""Dense vectors: exact neighbours of a stated query set, overlaps, twins.

Queries and rows are dealt into blocks.  A task meets one block of each and keeps its best `k` of
every query; the best of those are ranked per query.  Nothing passes through the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows and queries of a block, and scores that a task makes at a time.
BLOCK, SCORES = 4096, 1_000_000


def _matrix(table: pa.Table) -> np.ndarray:
    return np.stack(table["embedding"].to_numpy(zero_copy_only=False)).astype(np.float64)


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = BLOCK) -> DataFrame:
    """(query_id, vec_id, rank, score) of each query's `k` nearest rows by dot product, itself left out.

    ``vectors`` and ``queries`` are (vec_id, embedding).  Scores are rounded to 6 before they
    are ranked and ties go by vec_id.  A task holds `block` rows of either side, more or less.
    """
    n_rows, n_queries = (max(1, -(-df.count() // block)) for df in (vectors, queries))
    deal = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    names = ("i", "j", "vec_id", "embedding")
    rows = vectors.select("vec_id", "embedding", deal(n_rows).alias("i"), every(n_queries).alias("j")).select(*names).toDF(*names)
    asked = queries.select("vec_id", "embedding", deal(n_queries).alias("j"), every(n_rows).alias("i")).select(*names).toDF(*names)

    def meet(own: pa.Table, wanted: pa.Table) -> pa.Table:
        if not own.num_rows or not wanted.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        ids, asks = own["vec_id"].to_numpy(), wanted["vec_id"].to_numpy()
        own_t, theirs = _matrix(own).T, _matrix(wanted)
        parts, size = [], max(1, SCORES // len(ids))
        for start in range(0, len(asks), size):
            some = asks[start : start + size]
            scores = np.round(theirs[start : start + size] @ own_t, 6)
            scores[np.isnan(scores) | (some[:, None] == ids[None, :])] = -np.inf
            # whatever reaches a query's k-th best score, ties included, is ranked
            least = np.partition(scores, -k, axis=1)[:, -k] if 0 < k < len(ids) else np.full(len(some), -np.inf)
            q, r = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
            order = np.lexsort((ids[r], -scores[q, r], q))
            q, r = q[order], r[order]
            first = (np.arange(len(q)) - np.searchsorted(q, q) < k) & np.isfinite(scores[q, r])
            parts.append((some[q[first]], ids[r[first]], scores[q[first], r[first]]))
        return pa.table(dict(zip(("query_id", "vec_id", "score"), (np.concatenate(c) for c in zip(*parts, strict=True)), strict=True)))

    found = rows.groupBy("i", "j").cogroup(asked.groupBy("i", "j")).applyInArrow(meet, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= k)


def neighbour_overlap(left: DataFrame, right: DataFrame, k: int) -> DataFrame:
    """(query_id, overlap): the share of ``k`` neighbours that two runs have in common."""
    both = left.select("query_id", "vec_id").join(right.select("query_id", "vec_id"), ["query_id", "vec_id"])
    n = both.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    return left.select("query_id").distinct().join(n, "query_id", "left").select("query_id", F.round(F.coalesce("n", F.lit(0)) / k, 4).alias("overlap"))


def dot(a, b):
    """Dot product of two arrays, in double precision."""
    pairs = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)


def label_votes(found: DataFrame, vectors: DataFrame) -> DataFrame:
    """(query_id, same): the share of neighbours that have the query's label."""
    labels = vectors.select("vec_id", "label")
    joined = found.join(labels, "vec_id").join(labels.select(F.col("vec_id").alias("query_id"), F.col("label").alias("own")), "query_id")
    return joined.groupBy("query_id").agg(F.round(F.avg((F.col("label") == F.col("own")).cast("double")), 4).alias("same"))
