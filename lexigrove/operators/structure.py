"""Document structure: page maps, trees, regions, anchors, passages, contents."""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrove.functions.text import squeeze, token_count

#: Limits of passages in tokens (fixed values).
TARGET_TOKENS, CAP_TOKENS = 1200, 1600


def offset_votes(votes: DataFrame, group: str, offset: str) -> DataFrame:
    """(group, offset, count, second_count, total, confidence, is_strong): the dominant offset of each group.

    Ties go to the smaller offset.  It is strong with 25 votes, 85 of 100 of all, and four
    times as many as the next.
    """
    counts = votes.groupBy(group, F.col(offset).alias("offset")).agg(F.count(F.lit(1)).alias("count"))
    by = Window.partitionBy(group).orderBy(F.desc("count"), "offset")
    ranked = counts.withColumns({"place": F.row_number().over(by), "second_count": F.lead("count", 1, 0).over(by), "total": F.sum("count").over(Window.partitionBy(group))})
    share = F.col("count") / F.col("total")
    strong = (F.col("count") >= 25) & (share >= 0.85) & (F.col("count") >= F.greatest(F.lit(10), F.col("second_count") * 4))
    return ranked.filter("place = 1").select(group, "offset", "count", "second_count", "total", F.round(share, 4).alias("confidence"), strong.alias("is_strong"))


def monotonic_chain(observations: DataFrame, group: str) -> DataFrame:
    """The longest chain of observations (group, pdf_page, book_page) in which both pages rise.

    A step may skip at most 18 pdf pages or five for each book page, whichever is more; of
    chains of equal length the one over more book pages stays, then the one that ends later.
    A group is one book.
    """

    def longest(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["pdf_page", "book_page"], ignore_index=True)
        pdf, book = rows.pdf_page.to_numpy(), rows.book_page.to_numpy()
        chains: list[tuple[int, int, int]] = []  # length, span, previous
        for i in range(len(rows)):
            best = (1, 0, -1)
            steps = (pdf[:i] < pdf[i]) & (book[:i] < book[i]) & (pdf[i] - pdf[:i] <= (5 * (book[i] - book[:i])).clip(min=18))
            for j in steps.nonzero()[0]:
                length, span = chains[j][0] + 1, chains[j][1] + int(book[i] - book[j])
                if (length, span) > best[:2]:
                    best = (length, span, int(j))
            chains.append(best)
        at = max(range(len(rows)), key=lambda i: (*chains[i][:2], pdf[i]))
        kept = []
        while at >= 0:
            kept.append(at)
            at = chains[at][2]
        return rows.iloc[sorted(kept)]

    return observations.groupBy(group).applyInPandas(longest, observations.schema)


def interpolate_pages(chain: DataFrame, wanted: DataFrame, page_count: int, book: str = "book") -> DataFrame:
    """(book, book_page, pdf_page): where wanted book pages stand, on straight lines between a book's observations.

    Outside the chain the slope of its first or last two observations goes on; halves round to
    even; results stay within the book; a book of one observation places nothing.  Every
    wanted page finds the segment of its book by a window over both, not by pairs.
    """
    by = Window.partitionBy(book).orderBy("book_page")
    ends = chain.select(book, "book_page", "pdf_page", F.lead("book_page").over(by).alias("next_book"), F.lead("pdf_page").over(by).alias("next_pdf"))
    segments = ends.filter("next_book IS NOT NULL").select(book, F.col("book_page").alias("at"), F.struct(F.col("book_page").alias("b"), F.col("pdf_page").alias("p"), F.col("next_book").alias("nb"), F.col("next_pdf").alias("np")).alias("s"))
    asked = wanted.select(book, F.col("book_page").alias("at"), F.lit(None).cast(segments.schema["s"].dataType).alias("s"), F.lit(True).alias("asked"))
    # a page on an observation belongs to the segment that ends there, so segments stand behind the pages of equal number
    line = Window.partitionBy(book).orderBy("at", F.col("s").isNotNull())
    before, after = F.last("s", ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, 0)), F.first("s", ignorenulls=True).over(line.rowsBetween(1, Window.unboundedFollowing))
    placed = segments.withColumn("asked", F.lit(False)).unionByName(asked).withColumn("x", F.coalesce(before, after)).filter("asked AND x IS NOT NULL")
    x = F.col("x")
    # a whole product is divided once: a slope that is rounded already would miss exact halves
    rise = (F.col("at") - x["b"]) * (x["np"] - x["p"]).cast("double") / F.greatest(x["nb"] - x["b"], F.lit(1))
    estimate = F.bround(x["p"] + rise, 0).cast("int")
    return placed.select(book, F.col("at").alias("book_page"), F.greatest(F.lit(1), F.least(F.lit(page_count), estimate)).alias("pdf_page"))


def end_pages(entries: DataFrame, book: str) -> DataFrame:
    """``entries`` (book, sequence, start_page) with `end_page`: the page before the next entry, its own page at least."""
    following = F.lead("start_page").over(Window.partitionBy(book).orderBy("sequence"))
    return entries.withColumn("end_page", F.greatest(F.col("start_page"), following - 1))


def islands(lines: DataFrame, group: str, order: str, breaks: Column) -> DataFrame:
    """``lines`` with `island`: a number that goes up at each line where ``breaks`` holds against the line before."""
    by = Window.partitionBy(group).orderBy(order)
    starts = F.coalesce(breaks, F.lit(True)).cast("int")
    return lines.withColumn("__starts", starts).withColumn("island", F.sum("__starts").over(by.rowsBetween(Window.unboundedPreceding, 0))).drop("__starts")


def group_lines(lines: DataFrame, y_gap: float = 18.0, x_shift: float = 36.0) -> DataFrame:
    """Regions of positioned lines (page, line_no, role, zone, text, x0, y0, x1, y1), with bounding boxes and texts in order."""
    by = Window.partitionBy("page").orderBy("line_no")
    same = (F.lag("role").over(by) == F.col("role")) & (F.lag("zone").over(by) == F.col("zone"))
    near = (F.col("y0") - F.lag("y1").over(by) <= y_gap) & (F.abs(F.col("x0") - F.lag("x0").over(by)) <= x_shift)
    marked = islands(lines, "page", "line_no", ~(same & near))
    box = [F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")]
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), "\n")
    return marked.groupBy("page", "island").agg(F.first("role").alias("role"), F.first("zone").alias("zone"), *box, text.alias("text"))


def spread_state(rows: DataFrame, group: str, order: str, seed: Column, stop: Column) -> DataFrame:
    """``rows`` with `in_state`: true from a seed row on, until a stop row."""
    by = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    state = F.last(F.when(seed, True).when(stop, False), ignorenulls=True).over(by)
    return rows.withColumn("in_state", F.coalesce(state, F.lit(False)))


def next_anchor(rows: DataFrame, group: str, order: str, is_anchor: Column, position: str) -> DataFrame:
    """``rows`` with the nearest anchor row before and after in its group, and the distance to the next."""
    before = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(group).orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    here = F.when(is_anchor, F.struct(F.col(order).alias("at"), F.col(position).alias("pos")))
    both = rows.withColumns({"__before": F.last(here, ignorenulls=True).over(before), "__after": F.first(here, ignorenulls=True).over(after)})
    return both.withColumns({"previous_anchor": F.col("__before.at"), "next_anchor": F.col("__after.at"), "next_distance": F.col("__after.pos") - F.col(position)}).drop("__before", "__after")


def pack(blocks: DataFrame, group: str, order: str, limit: int) -> DataFrame:
    """(group, chunk, n_tokens, n_blocks): consecutive blocks packed greedily up to ``limit`` tokens.

    A block above the limit is a chunk of its own.  A group is one document.
    """
    sizes = F.transform(F.array_sort(F.collect_list(F.struct(order, "n_tokens"))), lambda x: x["n_tokens"])
    zero = F.struct(F.array().cast("array<struct<n_tokens:bigint,n_blocks:bigint>>").alias("done"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("k"))

    def step(held: Column, size: Column) -> Column:
        full = (held["n"] > 0) & (held["n"] + size > limit)
        done = F.when(full, F.concat(held["done"], F.array(F.struct(held["n"].alias("n_tokens"), held["k"].alias("n_blocks"))))).otherwise(held["done"])
        one = F.lit(1).cast("bigint")
        return F.struct(done.alias("done"), F.when(full, size).otherwise(held["n"] + size).alias("n"), F.when(full, one).otherwise(held["k"] + one).alias("k"))

    def finish(held: Column) -> Column:
        return F.when(held["n"] > 0, F.concat(held["done"], F.array(F.struct(held["n"].alias("n_tokens"), held["k"].alias("n_blocks"))))).otherwise(held["done"])

    chunks = blocks.groupBy(group).agg(sizes.alias("sizes")).select(group, F.posexplode(F.aggregate("sizes", zero, step, finish)).alias("chunk", "x"))
    return chunks.select(group, F.col("chunk").cast("long").alias("chunk"), "x.n_tokens", "x.n_blocks")


def assemble_passages(fragments: DataFrame, group: str, order: str, is_anchor: Column) -> DataFrame:
    """Passages of ordered fragments (group, order, bucket, text).

    An anchor opens a passage; fragments before the first anchor belong to passage 0.  Texts
    of a bucket are joined in order; passages without text are left out.
    """
    body = squeeze(F.coalesce(F.col("text"), F.lit("")))
    by = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    placed = fragments.withColumns({"body": body, "passage": F.sum(F.coalesce(is_anchor, F.lit(False)).cast("int")).over(by).cast("long")}).filter("body <> ''")

    def joined(bucket: str) -> Column:
        parts = F.array_sort(F.collect_list(F.when(F.col("bucket") == bucket, F.struct(F.col(order).alias("o"), F.col("body").alias("t")))))
        return F.array_join(F.transform(parts, lambda x: x["t"]), "\n\n")

    out = placed.groupBy(group, "passage").agg(joined("citation").alias("citation"), joined("commentary").alias("commentary"), joined("reference").alias("reference"), F.count(F.lit(1)).alias("n_fragments"))
    return out.withColumn("n_tokens", token_count(F.concat_ws(" ", "citation", "commentary", "reference")))


def segment_text(text: Column, limit: int) -> Column:
    """Paragraphs packed greedily into segments of up to ``limit`` tokens; a longer paragraph stands alone."""
    parts = F.filter(F.split(text, r"\n\s*\n"), lambda p: F.trim(p) != "")
    zero = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"), F.lit(0).cast("bigint").alias("n"))

    def step(held: Column, part: Column) -> Column:
        size = F.size(F.regexp_extract_all(part, F.lit(r"\S+"), F.lit(0))).cast("bigint")
        full = (held["n"] > 0) & (held["n"] + size > limit)
        done = F.when(full, F.concat(held["done"], F.array(held["open"]))).otherwise(held["done"])
        open_ = F.when(full | (held["n"] == 0), part).otherwise(F.concat(held["open"], F.lit("\n\n"), part))
        return F.struct(done.alias("done"), open_.alias("open"), F.when(full, size).otherwise(held["n"] + size).alias("n"))

    return F.aggregate(parts, zero, step, lambda h: F.when(h["open"] != "", F.concat(h["done"], F.array(h["open"]))).otherwise(h["done"]))


def ancestor_paths(nodes: DataFrame, deepest: int = 64) -> DataFrame:
    """(node_id, path): names from the root down to each node (node_id, parent_id, name).

    A round joins every open path with the parents, until all paths begin at a root; a parent
    that isn't a node ends a path.  A tree of more than ``deepest`` levels, or nodes in a circle,
    are an error.  Contents whose entries stand in order need no rounds: see `outline.nested_sets`.
    """
    parents = nodes.select(F.col("node_id").alias("up"), F.col("parent_id").alias("above"), F.col("name").alias("above_name"))
    open_ = nodes.select("node_id", F.col("parent_id").alias("up"), F.col("name").alias("path"))
    done = open_.filter("up IS NULL").select("node_id", "path")
    open_ = open_.filter("up IS NOT NULL")
    for _ in range(deepest):
        if open_.isEmpty():
            return done
        joined = open_.join(parents, "up", "left").select("node_id", F.col("above").alias("up"), F.concat_ws(" > ", "above_name", "path").alias("path"))
        done = done.unionByName(joined.filter("up IS NULL").select("node_id", "path"))
        open_ = joined.filter("up IS NOT NULL")
    raise ValueError(f"a tree of more than {deepest} levels, or a circle")


_ENTRY = re.compile(r"^(?P<title>.*?\S)[ .·…]*\s(?P<page>\d{1,4}|[ivxlcdm]+)\s*$")
_PART = re.compile(r"^part\s+([ivxlcdm]+|\d+|one|two|three|four|five)\b", re.IGNORECASE)
_NUMBERED = re.compile(r"^chapter\s+(\d+|[ivxlcdm]+)$", re.IGNORECASE)
_CHAPTER = re.compile(r"^(chapter\s+)?(\d+|[ivxlcdm]+)[.:)]?\s+\S", re.IGNORECASE)


def parse_contents(lines: DataFrame) -> DataFrame:
    """Entries of tables of contents (book, line_no, text): kind, level, title, page label, numbering, parent.

    Parts stand at level 1, chapters at 2 below a part and 1 else, sections one below their
    chapter; a line without a page label is carried into the next one.  A group is one book.
    """
    entry = "struct<sequence:bigint,kind:string,level:bigint,title:string,page_label:string,numbering:string,parent:bigint>"

    @F.arrow_udf(f"array<{entry}>")
    def parsed(texts: pa.Array) -> pa.Array:
        return pa.array([_entries(x) for x in texts.to_pylist()], pa.list_(pa.struct(_ENTRY_FIELDS)))

    texts = F.transform(F.array_sort(F.collect_list(F.struct("line_no", F.coalesce("text", F.lit("")).alias("text")))), lambda x: x["text"])
    books = lines.groupBy("book").agg(texts.alias("texts"))
    return books.select(F.col("book").cast("string").alias("book"), F.explode(parsed("texts")).alias("x")).select("book", "x.*")


_ENTRY_FIELDS = [("sequence", pa.int64()), ("kind", pa.string()), ("level", pa.int64()), ("title", pa.string()), ("page_label", pa.string()), ("numbering", pa.string()), ("parent", pa.int64())]


def _entries(texts: list[str]) -> list[tuple]:
    """The entries of one book's lines, in order."""
    out, carried, part, chapter = [], "", None, None
    for text in texts:
        line = (carried + " " + re.sub(r"\s+", " ", text).strip()).strip()
        carried = ""
        if not line or line.lower() in ("contents", "table of contents"):
            continue
        if _NUMBERED.match(line):
            carried = line + ":"
            continue
        found = _ENTRY.match(line)
        title, page = (found["title"].rstrip(" ."), found["page"]) if found else (line, None)
        low, n = title.lower(), len(out) + 1
        if _PART.match(title):
            kind, level, parent, part, chapter = "part", 1, None, n, None
        elif page is None:
            carried = line
            continue
        elif re.match(r"^(preface|foreword|acknowledge?ments?|abbreviations|translator.s)", low):
            kind, level, parent = "frontmatter", 1, None
        elif low.startswith("introduction"):
            kind, level, parent = "introduction", 1, None
        elif re.match(r"^(epilogue|afterword|conclusion)", low):
            kind, level, parent, part, chapter = "epilogue", 1, None, None, None
        elif re.match(r"^(index|notes|bibliography)", low):
            kind, level, parent, part, chapter = "index", 1, None, None, None
        elif _CHAPTER.match(title):
            kind, level, parent, chapter = "chapter", 2 if part else 1, part, n
        else:
            kind, parent = "section", chapter or part
            level = 1 if parent is None else out[parent - 1][2] + 1
        numbering = "none" if page is None else "arabic" if page.isdigit() else "roman"
        out.append((n, kind, level, title, page, numbering, parent))
    return out


def harvest_metadata(pages: DataFrame) -> DataFrame:
    """(book, title, author, translator, publisher, year) from front matter pages (book, page_no, text).

    The title is the first line in title or upper case, the author the line after it that is a
    name; publisher and year come from the imprint, the earliest year of a copyright line first.
    """
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "text"))), lambda x: x["text"]), "\n")
    books = pages.groupBy("book").agg(text.alias("text"))
    lines = F.filter(F.transform(F.split("text", "\n"), squeeze), lambda x: x != "")
    rows = books.select("book", "text", lines.alias("lines"))
    named = F.filter("lines", lambda x: x.rlike(r"^(?U)\p{Lu}[\p{L}.'’-]+( \p{Lu}[\p{L}.'’-]*){1,3}$") & ~x.rlike(r"(?i)press|university|street|contents|publish|translated|edition"))
    title = F.try_element_at("lines", F.lit(1))
    year = F.coalesce(F.try_element_at(F.regexp_extract_all("text", F.lit(r"(?i)(?:copyright|©)[^\n]{0,40}?((?:1[6-9]|20)[0-9]{2})"), F.lit(1)), F.lit(1)), F.try_element_at(F.regexp_extract_all("text", F.lit(r"\b((?:1[6-9]|20)[0-9]{2})\b"), F.lit(1)), F.lit(1)))
    return rows.select(
        "book",
        title.alias("title"),
        F.try_element_at(F.filter(named, lambda x: x != title), F.lit(1)).alias("author"),
        F.nullif(F.regexp_extract("text", r"(?i)translated[^\n]*? by ([^\n.,;]+)", 1), F.lit("")).alias("translator"),
        F.try_element_at(F.filter("lines", lambda x: x.rlike(r"(?i)\b(press|routledge|verlag|publishers?)\b")), F.lit(1)).alias("publisher"),
        year.cast("int").alias("year"),
    )
