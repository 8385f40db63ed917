"""Positioned lines of pages: margins, slices, zones, profiles, reading order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrove.functions.text import squeeze, title_case

#: Bands and limits of page geometry, in points (fixed values).
TOP_BAND, HEADER_BAND, BODY_TOP, GRID, RIGHT_FROM = 30.0, 42.0, 45.0, 24, 180.0
SHORT_LINE, SHORT_SHARE, SMALL_BY, SMALL_SHARE, RIGHT_LINES, CLUSTERS = 26, 0.35, 0.7, 0.10, 8, 3


def top_margin(text: Column, y0: Column) -> Column:
    """Whether a line is a running header or page number: at the very top if it isn't long, below it if it looks like one."""
    flat = squeeze(text)
    words = F.regexp_count(flat, F.lit("[^ ]+"))
    number = flat.rlike("(?i)^([0-9]+|[ivxlcdm]+)$")
    opening = flat.rlike(r"(?i)^(part|chapter|contents|translator'?s preface|preface)\b") & (words <= 10)
    titled = (words <= 8) & (flat == title_case(flat))
    high = (y0 < TOP_BAND) & (number | (F.length(flat) <= 120))
    header = (y0 >= TOP_BAND) & (y0 <= HEADER_BAND) & (number | opening | (~opening & titled))
    return (flat != "") & (high | header)


def zone(x0: Column, x1: Column, width: Column) -> Column:
    """Left, center or right third of the page, by the middle of the line."""
    middle = (x0 + x1) / 2
    return F.when(middle <= width * 0.33, "left").when(middle >= width * 0.67, "right").otherwise("center")


def sliced(lines: DataFrame, slices: DataFrame) -> DataFrame:
    """Lines (page, y0, ...) within the slices (entry_id, page, min_y, max_y) of entries; null bounds are open, the lower one counts."""
    joined = slices.join(lines, "page")
    return joined.filter((F.col("min_y").isNull() | (F.col("y0") >= F.col("min_y"))) & (F.col("max_y").isNull() | (F.col("y0") < F.col("max_y"))))


def reading_order(lines: DataFrame, page: str) -> DataFrame:
    """``lines`` with `line_no`: from top to bottom, then from left to right."""
    return lines.withColumn("line_no", F.row_number().over(Window.partitionBy(page).orderBy("y0", "x0", "text")))


def page_profiles(lines: DataFrame, page: str) -> DataFrame:
    """(page, kind, complex, body_lines, clusters) of positioned lines (page, text, x0, y0, size).

    A page with a table's caption is a table; eight lines or more on the right with a tenth in
    smaller type make an aside; three columns of line beginnings with many short lines make it
    multi-column.  Ties of the main type size go to the smaller one.
    """
    own = lines.withColumn("text", squeeze("text")).filter("text <> ''")
    sizes = own.groupBy(page, F.round("size", 1).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy(page).agg(F.max_by("s", F.struct("n", -F.col("s"))).alias("main"))
    has_body = F.max((F.col("y0") >= BODY_TOP).cast("int")).over(Window.partitionBy(page)) == 1
    body = own.withColumn("has_body", has_body).filter(~F.col("has_body") | (F.col("y0") >= BODY_TOP)).withColumn("cluster", F.bround(F.col("x0") / GRID, 0) * GRID)
    columns = body.groupBy(page, "cluster").agg(F.count(F.lit(1)).alias("n")).groupBy(page).agg(F.count_if(F.col("n") >= 2).alias("clusters"))
    counted = body.join(main, page).groupBy(page).agg(
        F.count(F.lit(1)).alias("body_lines"),
        F.avg((F.length("text") < SHORT_LINE).cast("double")).alias("short"),
        F.avg((F.col("size") < F.col("main") - SMALL_BY).cast("double")).alias("small"),
        F.count_if(F.col("x0") >= RIGHT_FROM).alias("right"),
    )
    tables = own.groupBy(page).agg(F.bool_or(F.contains(F.lower("text"), F.lit("table "))).alias("has_table"))
    kind = (
        F.when(F.col("has_table"), "table")
        .when((F.col("right") >= RIGHT_LINES) & (F.col("small") >= SMALL_SHARE), "aside")
        .when((F.col("clusters") >= CLUSTERS) & (F.col("short") >= SHORT_SHARE), "multi-column")
        .otherwise("simple")
    )
    return counted.join(columns, page).join(tables, page).select(page, kind.alias("kind"), (kind != "simple").alias("complex"), "body_lines", "clusters")
