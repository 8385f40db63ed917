"""Shared helpers: the cluster's shared folder, written intermediates, word patterns."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words between ASCII white space, as a Java regular expression.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
#: Runs of ASCII letters, digits and all characters beyond ASCII, either case.
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the setting is absent, a local session gets a temporary folder of its own;
    a cluster without the setting is an error, as executors couldn't see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _own:
        _own[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="lexigrove-")
    return _own[sc.applicationId]


def small_batches(spark: SparkSession) -> None:
    """Pass texts to Python tasks by 1,000 rows instead of Spark's 10,000.

    Texts of some KB would else stand by tens of MB in each task, in the JVM's buffers and in
    the worker.  A setting that the caller has made stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, "1000")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it again, which cuts its lineage."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def unused(df: DataFrame, label: str) -> str:
    """A column name that ``df`` doesn't have, in any case of letters."""
    held, name = {c.lower() for c in df.columns}, f"__{label}"
    while name in held:
        name += "_"
    return name


#: Keys up to which a counted table is broadcast (some 100 bytes each at the most); beyond, it is shuffled.
BROADCAST_KEYS = 100_000
#: Keys that have more than a so-manieth of all rows are joined apart, without a shuffle of their
#: rows; there are at most so many.
HOT_KEYS = 10_000


def few(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it was counted to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_KEYS else df


def join_facts(rows: DataFrame, facts: DataFrame, keys: list[str], n: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` with the facts of their keys, of which ``facts`` has one row and counts the rows as ``n``.

    Few facts are broadcast.  Of more, rows of hot keys meet a broadcast of at most `HOT_KEYS`
    facts, so no task gets them all.  ``facts`` is written already, as it is read several times.
    """
    if facts.count() <= BROADCAST_KEYS:
        return rows.join(F.broadcast(facts), keys, how)
    least = max(1, total // HOT_KEYS)
    hot = F.broadcast(facts.filter(F.col(n) > least))
    others = rows.join(hot.select(*keys), keys, "left_anti").join(facts.filter(F.col(n) <= least), keys, how)
    return rows.join(hot, keys).unionByName(others)


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """Wraps a function over batches: when its task ends, freed memory goes back to the system.

    A worker waits for further tasks, and would else hold the most that any task has needed
    beside the executor's heap.
    """

    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        if trim is not None:
            trim(0)

    return wrapped


def slices(texts: pa.Array, limit: int) -> Iterator[tuple[int, pa.Array]]:
    """Cuts a column into runs of at most ``limit`` bytes of text (or a single longer text).

    Yields the place of each run's first text, and the texts, nulls as empty ones.
    """
    filled = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(filled).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(filled):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield at, filled[at:stop]
        at = stop

