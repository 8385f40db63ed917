"""Bundles: written, read, failed, written again; filters reach the reader."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lexigrove.sources import bundle as B

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def entries(spark):
    """Conversations as books: turns are entries, the first of each is the parent of the others."""
    B.register(spark)
    c = spark.read.parquet(f"{SMALL}/conversations.parquet")
    turn = F.col("turn").cast("int")
    return c.select(
        F.concat(F.lit("b"), "conv_id").alias("book"), turn.alias("seq"), F.concat(F.lit("e"), turn).alias("entry_id"), F.when(turn == 0, "chapter").otherwise("section").alias("kind"),
        F.when(turn == 0, 1).otherwise(2).alias("level"), F.when(turn > 0, "e0").alias("parent_id"), F.initcap("role").alias("title"), (turn + 5).cast("string").alias("page_label"),
        F.concat(F.lit("chapter-0/"), turn, F.lit(".md")).alias("output_path"), "text", F.when(turn % 2 == 0, F.col("text")).alias("rag_text"), F.when(turn == 1, F.lit('{"pages": []}')).alias("spatial"),
    )


def rows(df):
    return sorted(map(str, df.select(*(p.split()[0] for p in B.ENTRY.split(", "))).collect()))


def test_round_trip(spark, entries, tmp_path):
    path = f"{tmp_path}/bundles"
    B.write_bundles(entries, path)
    back = spark.read.format("bundle").load(path)
    assert rows(back) == rows(entries.withColumn("text", F.coalesce("text", F.lit(""))))
    book = entries.groupBy("book").count().orderBy(F.desc("count")).first()
    folder = f"{path}/{book.book}"
    metadata = json.load(open(f"{folder}/metadata.json"))
    assert len(metadata["file_manifest"]) == book["count"] and len(metadata["toc"]) == 1 and len(metadata["toc"][0]["children"]) == book["count"] - 1
    toc = open(f"{folder}/toc.md").read().splitlines()
    assert toc[0] == "# Table of Contents" and toc[2].startswith("- [") and toc[3].startswith("  - [") and toc[3].endswith("(chapter-0/1.md) (6)")
    assert f"- File count: {book['count']}" in open(f"{folder}/index.md").read()
    assert json.load(open(f"{folder}/run-manifest.json"))["files"] == book["count"]
    assert not [f for _, _, files in os.walk(path) for f in files if f.startswith(".") or f.endswith(".part")]


def test_filters_reach_the_reader(spark, entries, tmp_path):
    path = f"{tmp_path}/bundles"
    B.write_bundles(entries, path)
    back = spark.read.format("bundle").load(path)
    some = [r.book for r in entries.select("book").distinct().limit(3).collect()]
    asked = back.filter(F.col("book").isin(some) & (F.col("kind") == "section") & (F.length("text") > 3))
    want = entries.filter(F.col("book").isin(some) & (F.col("kind") == "section") & (F.length("text") > 3))
    assert rows(asked) == rows(want)
    reader = B.BundleReader(path, ["book"], True)
    left = list(reader.pushFilters([B.In(("book",), tuple(some)), B.EqualTo(("kind",), "section"), B.EqualTo(("seq",), 1), B.EqualTo(("a", "b"), 1)]))
    assert [f.attribute for f in left] == [("seq",), ("a", "b")]
    assert sorted(b for p in reader.partitions() for b in p.names) == sorted(some)
    # a book that isn't asked for isn't opened
    os.remove(f"{path}/{some[0]}/chapter-0/0.md")
    assert rows(back.filter(F.col("book") == some[1])) == rows(entries.filter(F.col("book") == some[1]))
    assert back.filter(F.col("kind") == "section").count() == entries.filter("kind = 'section'").count()
    assert spark.read.format("bundle").option("texts", "false").load(path).filter("text IS NOT NULL").count() == 0


def test_a_lost_task_publishes_nothing(spark, entries, tmp_path):
    path = f"{tmp_path}/bundles"
    first = entries.filter("seq = 0")
    B.write_bundles(first, path)
    last = entries.agg(F.max("book")).first()[0]
    broken = entries.withColumn("output_path", F.when((F.col("book") == last) & (F.col("seq") == 1), "../outside.md").otherwise(F.col("output_path")))
    with pytest.raises(Exception, match="no path within a bundle"):
        B.write_bundles(broken, path)
    assert rows(spark.read.format("bundle").load(path)) == rows(first.withColumn("text", F.coalesce("text", F.lit(""))))
    B.write_bundles(entries, path)
    assert rows(spark.read.format("bundle").load(path)) == rows(entries.withColumn("text", F.coalesce("text", F.lit(""))))


def test_a_book_in_two_tasks_is_an_error(spark, entries, tmp_path):
    path = f"{tmp_path}/bundles"
    split = entries.select(*(p.split()[0] for p in B.ENTRY.split(", "))).repartition(4, "seq")
    with pytest.raises(Exception, match="use write_bundles"):
        split.write.format("bundle").mode("append").save(path)
    assert not [f for _, _, files in os.walk(path) for f in files if f == "metadata.json"]


def test_empty(spark, entries, tmp_path):
    path = f"{tmp_path}/bundles"
    os.makedirs(path)
    B.write_bundles(entries.limit(0), path)
    assert spark.read.format("bundle").load(path).count() == 0
    assert B.tree([]) == [] and B.contents([]) == "# Table of Contents\n"
