"""What of a document is embedded, and how embeddings of it fail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrove.functions.text import squeeze

#: Openings of lines that are no text of a document (fixed values).
METADATA = ("Context:", "Source pages:", "Representation:", "Label:", "Source reference:", "Source page labels:")
MATERIAL = ("Supplementary side material from source page ", "Table-like content from source page ")
#: Largest share of a supplement that is shown, its characters, and those of a body excerpt (fixed values).
SUPPLEMENT_SHARE, SUPPLEMENT_CHARS = 0.25, 180
#: Characters of a body in a contextual view, and least of a supplement that isn't normalised (fixed values).
BODY_CHARS, RAW_SUPPLEMENT = 1600, 350
#: Views of a document that are embedded (fixed values).
VIEWS = ("body", "contextual")
#: Mismatches that a report shows (fixed value).
WORST = 10


def embedding_text(markdown: Column) -> Column:
    """Markdown without headings, comments, notes of pages and metadata, blank lines and list marks, white space squeezed."""
    lines = F.transform(F.split(markdown, "\n"), squeeze)
    opening = "|".join([*METADATA, *MATERIAL])
    noise = rf"^(<!--.*-->|_Source page .*_|#{{1,6}} .*|({opening}).*)$"
    kept = F.filter(lines, lambda x: (x != "") & ~x.rlike(noise))
    return squeeze(F.array_join(F.transform(kept, lambda x: F.regexp_replace(x, "^- ", "")), " "))


def excerpt(text: Column, limit: int) -> Column:
    """The first ``limit`` characters of a text, ended at a word."""
    flat = squeeze(text)
    cut = F.substring(flat, 1, limit)
    return F.when(F.length(flat) <= limit, flat).otherwise(F.trim(F.regexp_replace(cut, " [^ ]*$", "")))


def embedded_view(view: str, title: Column, context: Column, kind: Column, body: Column, supplement: Column, limit: int = BODY_CHARS, normalised: bool = True) -> Column:
    """The text of a view: the whole body, or title, context, kind, the body's excerpt and the supplement's, parted by blank lines.

    Of texts that are normalised, a supplement is shown if it is small against the body.  An
    unknown view is an error; null texts count as empty.
    """
    if view not in VIEWS:
        raise ValueError(f"unknown view: {view}")
    title, context, kind, body, supplement = (squeeze(F.coalesce(x, F.lit(""))) for x in (title, context, kind, body, supplement))
    if view == "body":
        return body
    small = F.length(supplement) <= F.greatest(F.length(body), F.lit(1)) * SUPPLEMENT_SHARE
    shown = F.when(small, excerpt(supplement, SUPPLEMENT_CHARS)).otherwise("") if normalised else excerpt(supplement, max(RAW_SUPPLEMENT, limit // 4))
    parts = F.array(title, context, kind, excerpt(body, limit), F.when(shown != "", F.concat(F.lit("Supplement: "), shown)).otherwise(""))
    return F.trim(F.array_join(F.filter(parts, lambda p: p != ""), "\n\n"))


def projection_facts(docs: DataFrame, body: Column, supplement: Column) -> DataFrame:
    """``docs`` with sizes of both texts, the supplement's share, and whether a preview of it is shown."""
    sized = docs.withColumns({"body_chars": F.length(body).cast("long"), "supplement_chars": F.length(supplement).cast("long")})
    words = lambda x: F.regexp_count(x, F.lit("[A-Za-z0-9]+")).cast("long")
    share = F.when(F.col("supplement_chars") > 0, F.col("supplement_chars") / F.greatest("body_chars", F.lit(1))).otherwise(0.0)
    shown = (F.col("supplement_chars") > 0) & (share <= SUPPLEMENT_SHARE)
    return sized.withColumns({"body_tokens": words(body), "supplement_tokens": words(supplement), "supplement_ratio": F.round(share, 6), "supplement_shown": shown, "preview_chars": F.when(shown, F.least("supplement_chars", F.lit(SUPPLEMENT_CHARS))).otherwise(0)})


def collisions(projections: DataFrame, text: Column, group: str) -> DataFrame:
    """(group, texts, colliding): distinct projected texts of a group and the rows that share theirs with another."""
    same = projections.groupBy(group, F.sha2(text, 256).alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    return same.groupBy(group).agg(F.count(F.lit(1)).alias("texts"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("colliding"))


def worst_mismatches(runs: DataFrame, run: str, item: str, k: int = WORST) -> DataFrame:
    """The ``k`` worst items of each run (run, item, hit_at_1, rr, margin, cosine) with `rank`; null margins stand last among equals."""
    by = Window.partitionBy(run).orderBy("hit_at_1", "rr", F.col("margin").asc_nulls_last(), "cosine", item)
    return runs.withColumn("rank", F.row_number().over(by).cast("long")).filter(F.col("rank") <= k)


def centroids(vectors: DataFrame, group: str, vector: str = "embedding") -> DataFrame:
    """(group, dim, mean): the mean vector of each group, one row per dimension, rounded to 6."""
    each = vectors.select(group, F.posexplode(vector).alias("dim", "x"))
    return each.groupBy(group, "dim").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("mean"))
