"""How five filters of a corpus interact, over all orders in which they can run.

1.  One pass over the texts leaves a narrow row per document: which of the filters A to D it
    fails, its length, and hashes of successive blocks of its text (256, 768, 3072, ... code
    points, so that a long text has few of them).
2.  Equal texts are found by refining a partition: documents are split by length, then by the
    hash of the first block, the next, and so on.  A class of one document is dropped as soon
    as it arises.  Copies of a text stay together to the end, so rows of a class are counted
    before a shuffle, and rows of a hot class meet its count without one.
3.  Texts of the classes that are left are compared whole, as keys of an aggregate that first
    collapses copies within a task.  A class that holds several texts (equal hashes, other
    text) is split by the texts themselves.
4.  A document with a smaller id in its class fails filter E.  Documents are then counted by
    the set of filters they fail, and all 120 orders are read off these counts.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrove.llm.common import join_facts, materialise, remove

#: White space of the word pattern [^\x20\x09-\x0D]+.
_GAP = r"[\x20\x09-\x0D]+"
FILTERS = "ABCDE"
#: Code points of the first block; the text up to the end of each further block is four times as long.
BLOCK = 256


def failed_filters(text: Column) -> Column:
    """Bits of the filters A to D that a text fails: A is 1, B 2, C 4, D 8.

    A: under 200 words.  B: under half as many distinct words as words.  C: over 3 % of the code
    points are A-Z.  D: holds one of ``#$%&*|``.  A null text counts as empty.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, _GAP), lambda w: w != "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = [n < 200, 100 * F.size(F.array_distinct(words)) < 50 * n, 100 * capitals > 3 * F.length(text), text.rlike(r"[#$%&*|]")]
    bits = [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def _blocks(text: Column, bits: int) -> Column:
    """Hashes of the text's blocks; the last one ends with the text."""
    end = lambda k: F.least(F.lit(float(2**31 - 1)), BLOCK * F.pow(F.lit(4.0), k)).cast("int")
    count = F.greatest(F.lit(0), F.ceil(F.log(4.0, F.greatest(F.length(text), F.lit(1)) / BLOCK)).cast("int"))
    hashed = lambda k: F.xxhash64(F.when(k == 0, F.substring(text, 1, BLOCK)).otherwise(text.substr(end(k - 1) + 1, end(k) - end(k - 1))))
    return F.transform(F.sequence(F.lit(0), count), lambda k: F.shiftrightunsigned(hashed(k), 64 - bits) if bits < 64 else hashed(k))


def _refined(rows: DataFrame) -> tuple[DataFrame, str]:
    """Rows of `rows` (with `length` and `blocks`) whose class has several; `class` is the hash of length and all blocks."""
    spark = rows.sparkSession
    alive, path = rows.withColumn("class", F.col("length").cast("long")), None
    level, total = 0, rows.count()
    while True:
        key = F.col("class") if level == 0 else F.when(F.size("blocks") >= level, F.xxhash64("class", F.get("blocks", F.lit(level - 1)))).otherwise(F.col("class"))
        split = alive.withColumn("class", key)
        sizes, sizes_path = materialise(split.groupBy("class").agg(F.count(F.lit(1)).alias("class_rows")).filter("class_rows > 1"), "classes")
        kept, kept_path = materialise(join_facts(split, sizes, ["class"], "class_rows", total).drop("class_rows"), "class-rows")
        remove(spark, sizes_path)
        if path is not None:
            remove(spark, path)
        alive, path, level = kept, kept_path, level + 1
        if alive.filter(F.size("blocks") >= level).isEmpty():
            return alive, path


def _labelled(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """``rows`` with `good` and `toxic`; rows without an id are never labelled and take no part in the join."""
    known = rows.filter("doc_id IS NOT NULL").join(marks, "doc_id", "left").fillna(False, ["good", "toxic"])
    return known.unionByName(rows.filter("doc_id IS NULL").withColumns({"good": F.lit(False), "toxic": F.lit(False)}))


def _copies(docs: DataFrame, marks: DataFrame, alive: DataFrame, bits: int) -> DataFrame:
    """(part, failed, good, toxic, copies): counts of the rows that have a smaller id with the same text."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    chained = F.aggregate(_blocks(text, bits), F.length(text).cast("long"), lambda c, h: F.xxhash64(c, h))
    rows = docs.select("doc_id", text.alias("text"), F.length(text).alias("length"), chained.alias("class"))
    key = ["length", "class"]
    classes, classes_path = materialise(alive.groupBy(*key).agg(F.count(F.lit(1)).alias("class_rows")), "class-sizes")
    # copies of a text collapse within each task before any text moves
    texts = join_facts(rows, classes, key, "class_rows", alive.count()).groupBy(*key, "text").agg(F.min("doc_id").alias("least"))
    texts, texts_path = materialise(texts, "class-texts")
    verdict, verdict_path = materialise(texts.groupBy(*key).agg(F.count(F.lit(1)).alias("n_texts"), F.min("least").alias("least")).join(classes, key), "class-verdicts")
    marked = join_facts(alive, verdict.filter("n_texts = 1"), key, "class_rows", alive.count()).filter("doc_id > least")
    several = verdict.filter("n_texts > 1")
    if not several.isEmpty():  # other texts with all the same hashes: the texts themselves decide
        of = spark.read.schema(texts.schema).parquet(texts_path).join(several.select(*key), key)
        again = docs.select("doc_id", "part", text.alias("text"), F.length(text).alias("length"), chained.alias("class"))
        again = again.join(of, [*key, "text"]).filter("doc_id > least")
        again = _labelled(again.select("doc_id", "part", failed_filters(F.col("text")).alias("failed")), marks)
        columns = ("part", "failed", "good", "toxic")
        marked = marked.select(*columns).unionByName(again.select(*columns))
    counts, _ = materialise(marked.groupBy("part", "failed", "good", "toxic").agg(F.count(F.lit(1)).alias("copies")), "copies")
    for path in (classes_path, texts_path, verdict_path):
        remove(spark, path)
    return counts


def interactions(counts: DataFrame) -> DataFrame:
    """All orders of the filters over ``counts`` (part, failed, n, n_good, n_toxic), where `failed` has bits A to E."""
    places = [(F.lit("".join(o)), F.lit(k + 1), F.lit(1 << FILTERS.index(f)), F.lit(sum(1 << FILTERS.index(x) for x in o[:k]))) for o in permutations(FILTERS) for k, f in enumerate(o)]
    named = [F.struct(*(c.alias(n) for c, n in zip(place, ("filter_order", "step", "own", "before"), strict=True))) for place in places]
    every = counts.withColumn("place", F.explode(F.array(*named))).select("*", "place.*")
    fails, earlier = F.col("failed").bitwiseAND(F.col("own")) != 0, F.col("failed").bitwiseAND(F.col("before")) != 0
    total = lambda n, when: F.sum(F.when(when, F.col(n)).otherwise(0)).cast("long")
    # of the orders, a document falls to each of its k filters in one k-th
    share = F.sum(F.when(fails, F.col("n") * 120 / F.bit_count("failed")).otherwise(0)).cast("long")
    return every.groupBy("part", "filter_order", "step").agg(
        total("n", ~fails & ~earlier).alias("kept"),
        total("n", fails & ~earlier).alias("removed"),
        total("n", fails & earlier).alias("redundant"),
        total("n", F.col("failed") == F.col("own")).alias("unique_fails"),
        total("n_good", fails & ~earlier).alias("good_lost"),
        total("n_toxic", fails & ~earlier).alias("toxic_lost"),
        share.alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, hash_bits: int = 64) -> DataFrame:
    """One row per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A part is a value of `lang`, a null one an empty string.  A document fails E if its text is
    that of a smaller doc_id anywhere in the table; null texts are empty ones, a null doc_id
    is neither smaller nor larger, and rows that repeat an id are rows of their own.  A document
    is good (toxic) if any of its labels says so.  Further columns are ignored, and an
    empty table gives an empty result.  ``hash_bits`` shortens the block hashes, for tests.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.coalesce("lang", F.lit("")).alias("part"))
    narrow = docs.select("doc_id", "part", failed_filters(F.col("text")).alias("failed"), F.length(text).alias("length"), _blocks(text, hash_bits).alias("blocks"))
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    rows, rows_path = materialise(_labelled(narrow, marks), "audit-rows")
    key = ["part", "failed", "good", "toxic"]
    alive, alive_path = _refined(rows)
    copies = _copies(docs, marks, alive, hash_bits)
    plain = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    moved = copies.select(*key, (-F.col("copies")).alias("n")).unionByName(copies.select("part", (F.col("failed") + 16).alias("failed"), "good", "toxic", F.col("copies").alias("n")))
    good, toxic = F.when(F.col("good"), F.col("n")).otherwise(0), F.when(F.col("toxic"), F.col("n")).otherwise(0)
    counts = plain.unionByName(moved).groupBy("part", "failed").agg(F.sum("n").alias("n"), F.sum(good).alias("n_good"), F.sum(toxic).alias("n_toxic"))
    counts, _ = materialise(counts, "audit-counts")
    remove(spark, rows_path)
    remove(spark, alive_path)
    return interactions(counts)
