"""Where the pages of a book stand in its file, and its contents' entries on these pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrove.functions.text import squeeze
from lexigrove.operators.paging import IN_LINE, IN_PAGE, IS_LINE, PAGE_LINES, REACH, key_of
from lexigrove.operators.structure import interpolate_pages, monotonic_chain, offset_votes

#: Points from the top and the bottom in which a page number stands, and the outer parts of the width (fixed values).
MARGIN, OUTER_LEFT, OUTER_RIGHT = 82.0, 0.24, 0.76
#: First book page that votes, and pages by which an observation may miss the dominant offset (fixed values).
FIRST_VOTE, TOLERANCE = 3, 1
#: Lines at the top and the bottom of a page that may hold its number where no margin does (fixed value).
EDGE_LINES = 3
#: Least letters and digits of a title that is searched (fixed value).
LEAST_KEY = 8
#: Kinds of entries whose titles are searched (fixed values).
SEARCHED = ("chapter", "section")


# page numbers


def margin_numbers(blocks: DataFrame) -> DataFrame:
    """(book, pdf_page, book_page, outer) of the numbers in the margins of pages.

    Blocks are rows (book, pdf_page, text, x0, y0, x1, y1, width, height, page_count).  A number
    is a block of one line with one to three digits, within the book, near the top or the
    bottom.  Where a page has numbers at its outer edges, only those count.
    """
    lines = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), squeeze), lambda x: x != "")
    line = F.get(lines, F.lit(0))
    number = F.when((F.size(lines) == 1) & line.rlike("^[0-9]{1,3}$"), line.cast("int"))
    edge = (F.col("y0") <= MARGIN) | (F.col("y1") >= F.col("height") - MARGIN)
    outer = (F.col("x0") <= F.col("width") * OUTER_LEFT) | (F.col("x1") >= F.col("width") * OUTER_RIGHT)
    found = blocks.select("book", "pdf_page", number.alias("book_page"), outer.alias("outer"), (edge & number.between(1, F.col("page_count"))).alias("fits")).filter("fits")
    some = F.bool_or("outer").over(Window.partitionBy("book", "pdf_page"))
    return found.withColumn("some", some).filter("outer = some").select("book", "pdf_page", "book_page", "outer")


def edge_numbers(pages: DataFrame) -> DataFrame:
    """(book, pdf_page, book_page): the first number among the outermost lines of pages (book, pdf_page, text, page_count)."""
    lines = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), squeeze), lambda x: x != "")
    n = F.size("lines")
    edges = F.concat(F.slice("lines", 1, EDGE_LINES), F.slice("lines", F.greatest(n - EDGE_LINES + 1, F.lit(1)), EDGE_LINES))
    fits = F.filter(edges, lambda x: x.rlike("^[0-9]{1,3}$") & F.when(x.rlike("^[0-9]{1,3}$"), x.cast("int")).between(1, F.col("page_count")))
    found = pages.select("book", "pdf_page", "page_count", lines.alias("lines")).select("book", "pdf_page", F.get(fits, F.lit(0)).cast("int").alias("book_page"))
    return found.filter("book_page IS NOT NULL")


def page_numbers(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """(book, pdf_page, book_page, source): a book's margin numbers, or where it has none the numbers of outermost lines."""
    margin = margin_numbers(blocks).drop("outer")
    edge = edge_numbers(pages).join(margin.select("book").distinct(), "book", "left_anti")
    return margin.withColumn("source", F.lit("margin")).unionByName(edge.withColumn("source", F.lit("edge")))


def mapping_strategy(numbers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """How book pages map to file pages: (book, mode, offset, count, second_count, total, confidence), and the observations.

    Numbers (book, pdf_page, book_page) vote for their offset.  A strong offset holds for the
    whole book (`global_offset`) if the longest rising chain of numbers has any beside it;
    only those are observations then.  Else the chain is interpolated.
    """
    stats = offset_votes(numbers.filter(F.col("book_page") >= FIRST_VOTE).withColumn("offset", F.col("pdf_page") - F.col("book_page")), "book", "offset")
    chain = monotonic_chain(numbers.select("book", "pdf_page", "book_page"), "book")
    voted = chain.join(stats.select("book", "offset", "is_strong"), "book", "left")
    near = F.abs(F.col("pdf_page") - F.col("book_page") - F.col("offset")) <= TOLERANCE
    held = F.coalesce(F.bool_or(near).over(Window.partitionBy("book")), F.lit(False))
    voted = voted.withColumn("global", F.coalesce("is_strong", F.lit(False)) & held)
    mode = F.when(F.bool_or("global"), "global_offset").otherwise("observation_interpolation")
    modes = voted.groupBy("book").agg(mode.alias("mode"), F.count_if(~F.col("global") | near).alias("observations"))
    observations = voted.filter(~F.col("global") | near).select("book", "pdf_page", "book_page")
    return modes.join(stats.drop("is_strong"), "book", "left"), observations


def mapped_pages(strategy: DataFrame, observations: DataFrame, wanted: DataFrame, page_count: int) -> DataFrame:
    """(book, book_page, pdf_page) of the wanted book pages (book, book_page), by the strategy of their book.

    In an interpolated book, a page on an observation stands there; a book of one observation
    has the slope of one; a book without observations falls back to its offset, or to nothing.
    """
    asked = wanted.select("book", "book_page").distinct().join(strategy.select("book", "mode", "offset"), "book", "left")
    by = Window.partitionBy("book").orderBy("pdf_page")
    first = observations.withColumns({"n": F.count(F.lit(1)).over(Window.partitionBy("book")), "i": F.row_number().over(by)})
    single = first.filter("n = 1").select("book", (F.col("pdf_page") - F.col("book_page")).alias("shift"))
    exact = observations.groupBy("book", "book_page").agg(F.min("pdf_page").alias("seen"))
    drawn = interpolate_pages(observations, asked.filter("mode = 'observation_interpolation'"), page_count).withColumnRenamed("pdf_page", "drawn")
    out = asked.join(exact, ["book", "book_page"], "left").join(drawn, ["book", "book_page"], "left").join(single, "book", "left")
    shifted = F.when(F.col("shift").isNotNull(), F.greatest(F.lit(1), F.least(F.lit(page_count), F.col("book_page") + F.col("shift"))))
    placed = F.when(F.col("mode") == "global_offset", F.col("book_page") + F.col("offset")).otherwise(F.coalesce("seen", "drawn", shifted, F.col("book_page") + F.col("offset")))
    return out.select("book", "book_page", placed.cast("int").alias("pdf_page"))


# entries


def title_variants(title: Column) -> Column:
    """Keys under which a title is searched: whole, without its number, letter or Roman numeral, without a number at its end, and with "vv" read as "w"."""
    title = squeeze(title)
    cuts = [title, F.regexp_replace(title, r"^\d+\s*[.)]\s+", ""), F.regexp_replace(title, r"^[A-Z]\.\s+", ""), F.regexp_replace(title, r"^(?i)[IVXLCDM]+\.\s+", ""), F.regexp_replace(title, r"\s+\d+$", ""), F.regexp_replace(title, r"(?i)\bvv(?=[a-z])", "w")]
    return F.array_distinct(F.filter(F.array(*map(key_of, cuts)), lambda k: F.length(k) >= LEAST_KEY))


def candidate_pages(entries: DataFrame, pages: DataFrame, reach: int = REACH) -> DataFrame:
    """``entries`` (book, seq, kind, title, expected) with `low`, `high`, `at` and `found`, the pages that hold a title.

    An entry is searched `reach` pages around its expected page, one without an expected page
    between those of its neighbours; `at` is the page from which distances count.  Evidence is
    rows (page, score, variant); entries meet pages by an equality join on their numbers.
    """
    order = Window.partitionBy("book").orderBy("seq")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    last = pages.groupBy("book").agg(F.max("page").alias("last_page"))
    asked = entries.join(last, "book", "left").withColumn("last_page", F.coalesce("last_page", F.lit(1)))
    low, high = F.coalesce(F.last("expected", ignorenulls=True).over(before), F.lit(1)), F.coalesce(F.first("expected", ignorenulls=True).over(after), F.col("last_page"))
    asked = asked.withColumns({"low": F.coalesce(F.col("expected") - reach, low), "high": F.coalesce(F.col("expected") + reach, F.greatest(low, high)), "at": F.coalesce("expected", low)})
    asked = asked.withColumns({"low": F.greatest("low", F.lit(1)), "high": F.least(F.greatest("high", "low", F.lit(1)), F.greatest("last_page", "at"))})
    asked = asked.withColumn("high", F.greatest("low", "high"))

    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: key_of(squeeze(x))), lambda x: x != "")
    held = pages.select("book", "page", lines.alias("lines"), F.array_join(F.slice(lines, 1, PAGE_LINES), "").alias("whole"))
    searched = asked.filter(F.col("kind").isin(*SEARCHED)).select("book", "seq", title_variants(F.col("title")).alias("variants"), F.explode(F.sequence("low", "high")).alias("page")).filter(F.size("variants") > 0)
    scored = lambda v: F.when(F.array_contains("lines", v), IS_LINE).when(F.exists("lines", lambda k: F.contains(k, v)), IN_LINE).when(F.contains("whole", v), IN_PAGE)
    # of equal scores the first variant is the evidence
    best = F.array_max(F.transform("variants", lambda v, i: F.struct(scored(v).alias("score"), (-i).alias("i"), v.alias("variant"))))
    met = searched.join(held, ["book", "page"]).withColumn("best", best).filter("best.score IS NOT NULL")
    found = met.groupBy("book", "seq").agg(F.array_sort(F.collect_list(F.struct("page", "best.score", "best.variant"))).alias("found"))
    return asked.join(found, ["book", "seq"], "left").withColumn("found", F.coalesce("found", F.array().cast("array<struct<page:int,score:int,variant:string>>")))


def aligned_entries(entries: DataFrame, pages: DataFrame, reach: int = REACH) -> DataFrame:
    """(book, seq, page, score, variant, distance): the pages of all entries of a book together, never falling along them.

    Entries are rows (book, seq, kind, title, expected), pages rows (book, page, text).  Of all
    assignments that keep the order, the one with the largest sum of scores is taken, then
    with the smallest sum of distances from the expected pages, then with the earlier pages.
    No entry stands before the pages in which it is searched; earlier entries may push it
    behind them.  An entry without evidence on its page has a score of 0.

    One pass over a book's entries keeps, for each page an entry may stand on, the best
    assignment of the entries before it; a row holds the contents of one book.
    """
    asked = candidate_pages(entries.withColumn("expected", F.col("expected").cast("int")), pages.withColumn("page", F.col("page").cast("int")), reach)
    own = F.struct("seq", "low", "high", "at", "found")
    books = asked.groupBy("book").agg(F.array_sort(F.collect_list(own)).alias("xs"))
    kind = "struct<score:bigint,near:bigint,back:array<int>>"

    def better(held: Column, page: Column) -> Column:
        """The best assignment so far that ends on a page up to this one; null if there is none."""
        return F.array_max(F.filter(held, lambda h: -F.get(h["back"], F.size(h["back"]) - 1) <= page))

    def step(held: Column, x: Column) -> Column:
        far = F.filter(F.array_distinct(F.transform(held, lambda h: -F.get(h["back"], F.size(h["back"]) - 1))), lambda p: p > x["high"])
        places = F.concat(F.sequence(x["low"], x["high"]), far)

        def ended(page: Column) -> Column:
            score = F.coalesce(F.get(F.filter(x["found"], lambda f: f["page"] == page), F.lit(0))["score"], F.lit(0)).cast("bigint")
            best = better(held, page)
            sums = F.struct((best["score"] + score).alias("score"), (best["near"] - F.abs(page - x["at"])).cast("bigint").alias("near"), F.concat(best["back"], F.array(-page)).alias("back"))
            return F.when(best.isNotNull(), sums)

        return F.filter(F.transform(places, ended), lambda h: h.isNotNull())

    start = F.array(F.struct(F.lit(0).cast("bigint").alias("score"), F.lit(0).cast("bigint").alias("near"), F.array(F.lit(0)).alias("back")).cast(kind))
    best = F.array_max(F.aggregate("xs", start, step))["back"]
    each = books.select("book", F.col("xs"), F.transform(F.slice(best, 2, F.size(best)), lambda p: -p).alias("placed"))
    each = each.select("book", F.explode(F.arrays_zip("xs", "placed")).alias("z")).select("book", "z.xs.*", F.col("z.placed").alias("page"))
    hit = F.get(F.filter("found", lambda f: f["page"] == F.col("page")), F.lit(0))
    return each.select("book", "seq", "page", F.coalesce(hit["score"], F.lit(0)).alias("score"), hit["variant"].alias("variant"), F.abs(F.col("page") - F.col("at")).alias("distance"))
