"""Where entries of a contents list stand in the pages of their book."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrove.functions.text import squeeze

#: Pages on either side of the expected one in which a heading is searched (fixed value).
REACH = 12
#: Scores of a heading that is a line, stands in a line, or in the lines run together (fixed values).
IS_LINE, IN_LINE, IN_PAGE, PAGE_LINES = 100, 85, 70, 160
#: Pages in which the contents are looked for, and lines that make a page one of them (fixed values).
FRONT, WITH_WORD, ALONE = 40, 4, 8


def key_of(text: Column) -> Column:
    """Lower-case ASCII letters and digits of a text that is normalised already."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9]+", "")


def heading_pages(entries: DataFrame, pages: DataFrame, reach: int = REACH) -> DataFrame:
    """(entry_id, page, score): the best page of each entry (entry_id, book, key, expected) among pages (book, page, text).

    Each entry meets only the `reach` pages on either side of the expected one, by an equality
    join on their numbers; the best score wins, then the nearest page, then the first.  An
    entry found nowhere stays on its expected page with a null score.
    """
    lines = F.filter(F.transform(F.split("text", "\n"), squeeze), lambda x: x != "")
    keys = F.transform(lines, key_of)
    held = pages.select("book", "page", keys.alias("keys"), F.array_join(F.slice(keys, 1, PAGE_LINES), "").alias("run"))
    near = F.explode(F.sequence(F.col("expected") - reach, F.col("expected") + reach))
    asked = entries.filter("key <> ''").select("entry_id", "book", "key", "expected", near.alias("page"))
    score = (
        F.when(F.array_contains("keys", F.col("key")), IS_LINE)
        .when(F.exists("keys", lambda k: F.contains(k, F.col("key"))), IN_LINE)
        .when(F.contains(F.col("run"), F.col("key")), IN_PAGE)
    )
    met = asked.join(held, ["book", "page"]).withColumn("score", score).filter("score IS NOT NULL")
    order = F.struct(F.col("score"), -F.abs(F.col("page") - F.col("expected")), -F.col("page"))
    best = met.groupBy("entry_id").agg(F.max_by(F.struct("page", "score"), order).alias("x"))
    return entries.join(best, "entry_id", "left").select("entry_id", F.coalesce("x.page", "expected").alias("page"), F.col("x.score").alias("score"))


def contents_range(pages: DataFrame, with_word: int = WITH_WORD, alone: int = ALONE) -> DataFrame:
    """(book, first_page, last_page): the first run of contents pages among the first pages (book, page, text) of a book.

    A page is one of them if enough lines end in a page label, fewer if it names the contents.
    """
    lines = F.transform(F.split("text", "\n"), squeeze)
    labelled = F.size(F.filter(lines, lambda x: x.rlike("(?i) ([ivxlcdm]+|[0-9]( ?[0-9]){0,3})$")))
    looks = ((labelled >= with_word) & F.contains(key_of(F.col("text")), F.lit("contents"))) | (labelled >= alone)
    front = pages.filter(F.col("page") <= FRONT).filter(looks).select("book", "page")
    run = F.col("page") - F.row_number().over(Window.partitionBy("book").orderBy("page"))
    runs = front.withColumn("run", run).groupBy("book", "run").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"))
    return runs.groupBy("book").agg(F.min(F.struct("first_page", "last_page")).alias("x")).select("book", "x.first_page", "x.last_page")


def repaired_labels(entries: DataFrame, book: str, order: str) -> DataFrame:
    """(book, order, label, repaired): Arabic page labels that never fall, whose lost leading digits are given back.

    A label below the one before it grows by the power of ten of that one's first digit until it
    is none.  A fold holds one book.
    """
    kind = "array<struct<label:bigint,repaired:bigint>>"

    def step(held: Column, label: Column) -> Column:
        last = F.coalesce(F.try_element_at(held, F.lit(-1))["repaired"], label)
        digits = F.greatest(F.length(last.cast("string")) - 1, F.lit(1))
        carry = F.pow(F.lit(10.0), digits).cast("bigint")
        lacking = F.greatest(last - label, F.lit(0).cast("bigint"))
        repaired = label + F.ceil(lacking / carry).cast("bigint") * carry
        return F.concat(held, F.array(F.struct(label.alias("label"), repaired.alias("repaired"))))

    rows = entries.filter("label IS NOT NULL").select(book, F.struct(F.col(order).alias("at"), F.col("label").cast("bigint").alias("label")).alias("x"))
    lists = rows.groupBy(book).agg(F.array_sort(F.collect_list("x")).alias("xs"))
    folded = F.aggregate(F.transform("xs", lambda x: x["label"]), F.array().cast(kind), step)
    both = lists.select(book, F.explode(F.arrays_zip(F.col("xs.at").alias("at"), folded.alias("r"))).alias("z"))
    return both.select(book, F.col("z.at").alias(order), F.col("z.r.label").alias("label"), F.col("z.r.repaired").alias("repaired"))


def numbered_paths(entries: DataFrame, path: str, order: str) -> DataFrame:
    """``entries`` with `ordinal` among equal paths and `unique_path`, which has it from the second on."""
    ordinal = F.row_number().over(Window.partitionBy(path).orderBy(order)).cast("long")
    out = entries.withColumn("ordinal", ordinal)
    return out.withColumn("unique_path", F.when(F.col("ordinal") > 1, F.concat(F.col(path), F.lit("-"), F.col("ordinal"))).otherwise(F.col(path)))


def without_heading(line: Column, heading: Column) -> Column:
    """A line without the heading it opens with: null if nothing else stands on it, else the rest."""
    flat, wanted = squeeze(line), squeeze(heading)
    opens = (wanted != "") & F.startswith(F.lower(flat), F.lower(wanted))
    rest = F.regexp_replace(F.substring(flat, F.length(wanted) + 1, F.length(flat)), "^[ .:;,!?)\\]}\"'’\\[-]+", "")
    same = (key_of(flat) != "") & (key_of(flat) == key_of(wanted))
    return F.when(same, F.lit(None)).when(opens, F.nullif(rest, F.lit(""))).otherwise(flat)
