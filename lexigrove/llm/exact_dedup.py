"""Exact deduplication by a tree of digest runs, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrove.llm.common import join_facts, materialise, remove


def digest_runs(docs: DataFrame, runs: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, a unique row number, its run, and what its text is told by.

    A run is made of whole partitions, whose number stands in the row number's upper bits.

    Texts are equal if SHA-256, the length in characters and an independent 64-bit hash all
    agree; the last two verify each agreement of digests at every level of the tree.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row_no"),
        F.sha2(text, 256).alias("digest"),
        F.length(text).alias("n_chars"),
        F.xxhash64(text).alias("check"),
    ).withColumn("run", F.pmod(F.shiftright("row_no", 33), F.lit(runs)).cast("int"))


def merge_runs(rows: DataFrame, fan_in: int, runs: int, keep: str = "smallest") -> DataFrame:
    """Merge the runs, ``fan_in`` at a time, in rounds until one is left.

    A run holds each of its verified texts once, with the winning identifier and the count.  In
    a round, each run meets its ``fan_in`` - 1 neighbours: tasks exchange their digests by hash,
    sort them, and a full outer sort-merge join passes over two sorted runs at a time, keeping
    the winner and the sum of counts where both hold the text.  So no run stands in one task,
    and a text of very many copies is one row of each run at the most.  The result of a round
    is written, which the next one reads.
    """
    best, of_two = (F.max, F.greatest) if keep == "largest" else (F.min, F.least)
    key = ["run", "digest", "n_chars", "check"]
    level = rows.groupBy(key).agg(best(F.struct("doc_id", "row_no")).alias("best"), F.count(F.lit(1)).alias("n"))
    spark, written = rows.sparkSession, None
    while runs > 1:
        level, path = materialise(level, "digest-level")
        if written:
            remove(spark, written)
        runs, written = -(-runs // fan_in), path

        def sides(level: DataFrame = level) -> Iterator[DataFrame]:
            for i in range(fan_in):
                run = level.filter(F.pmod("run", F.lit(fan_in)) == i)
                yield run.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))

        level, *others = sides()
        for side in others:
            side = side.withColumnsRenamed({"best": "other_best", "n": "other_n"})
            met = level.hint("merge").join(side.hint("merge"), key, "full_outer")
            level = met.select(*key, of_two("best", "other_best").alias("best"), (F.coalesce("n", F.lit(0)) + F.coalesce("other_n", F.lit(0))).alias("n"))
    return level.select(*key[1:], F.col("best.doc_id").alias("keep_id"), F.col("best.row_no").alias("keep_row"), F.col("n").alias("group_size"))


def exact_dedup(docs: DataFrame, keep: str = "smallest", runs: int = 16, fan_in: int = 4) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    `keep` names the identifier that stays of equal texts, "smallest" or "largest".  Null
    texts count as empty and equal each other.  Where rows repeat an id and its text, one of
    them stays.  A null id is below every other id.  Further columns are ignored, and an empty
    table gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep: {keep}")
    rows, _ = materialise(digest_runs(docs, runs), "digest-runs")
    groups, _ = materialise(merge_runs(rows, fan_in, runs, keep).filter("group_size > 1"), "digest-groups")
    total = groups.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    # a text without copies needs no partner
    found = join_facts(rows, groups, ["digest", "n_chars", "check"], "group_size", total, "left")
    alone = F.col("group_size").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row_no") == F.col("keep_row"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
