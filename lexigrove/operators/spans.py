"""Spans of a line that belong together, and the bands of pages in which headings stand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrove.functions.text import squeeze
from lexigrove.operators.matching import heading_parts, parts_match

#: How far edges of spans on one baseline differ, and the widest gap between them, in points (fixed values).
BASELINE, SPAN_GAP = 1.5, 16.0
#: Lines of a heading, most words of its first and further lines, gap and shift of the lines, room about a band (fixed values).
HEADING_LINES, FIRST_WORDS, NEXT_WORDS, LEAST_GAP, MOST_GAP, SHIFT, ROOM = 3, 5, 6, -2.0, 18.0, 52.0, 2.0
#: Most words of a heading and least share of them in title case (fixed values).
TITLE_WORDS, TITLE_SHARE = 14, 0.7
#: Words that a heading has in lower case (fixed values).
CONNECTORS = "a an and as at by for from in into is not of on or that the to with".split()

_WORD = "[A-Za-z][A-Za-z'’-]*"
_MARKER = r"^(?i)(([0-9]+|[A-Z]|[IVXLCDM]+)\s*[.):]?\s+)+"
_SPAN = "struct<ord:bigint,text:string,x0:double,y0:double,x1:double,y1:double,spans:int>"


def absorbs(held: Column, span: Column, titles: bool = False) -> Column:
    """Whether a span goes on in the line that is held: close behind it on its baseline, after a hyphen or in lower case.

    With ``titles``, a letter with a full stop takes a word in upper case, and one or two words of
    capitals take a word in title case or a number.
    """
    a, b = squeeze(held["text"]), squeeze(span["text"])
    level = (F.abs(span["y0"] - held["y0"]) <= BASELINE) & (F.abs(span["y1"] - held["y1"]) <= BASELINE)
    beside = (span["x0"] - held["x1"]).between(0.0, SPAN_GAP)
    hyphen = a.endswith("-")
    goes_on = F.when(hyphen, ~b.rlike("^[0-9]+[a-z]?\\)")).otherwise(b.rlike("^[(\"“‘\\[]?[a-z0-9]"))
    if titles:
        letter = a.rlike(r"^[A-Za-z]\.$") & b.rlike(r"^\p{Lu}")
        capitals = (a == F.upper(a)) & (a != F.lower(a)) & ~a.rlike("^[^ ]+ [^ ]+ ") & b.rlike("^([A-Z][a-z]+|[IVXLC0-9]+)$")
        goes_on = goes_on | (~hyphen & (letter | capitals))
    return F.coalesce(level & beside & (a != "") & (b != "") & goes_on, F.lit(False))


def collapsed(spans: DataFrame, titles: bool = False) -> DataFrame:
    """(book, page, ord, text, x0, y0, x1, y1, spans): spans (book, page, ord, text, x0, y0, x1, y1) of a page joined along their lines.

    A line is a cluster: spans whose edges follow each other from left to right, within twice
    the tolerance of the baseline from one to the next.  What a span joins depends on the text
    before it, so a fold runs over a cluster, which is a line of print, never over a page.
    """
    by = Window.partitionBy("book", "page").orderBy("ord")
    near = (F.abs(F.col("y0") - F.lag("y0").over(by)) <= 2 * BASELINE) & (F.col("x0") >= F.lag("x1").over(by))
    run = F.sum(F.when(F.coalesce(near, F.lit(False)), 0).otherwise(1)).over(by.rowsBetween(Window.unboundedPreceding, 0))
    own = F.struct(F.col("ord").cast("bigint").alias("ord"), F.coalesce("text", F.lit("")).alias("text"), *(F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")), F.lit(1).alias("spans")).cast(_SPAN)
    lines = spans.withColumn("run", run).groupBy("book", "page", "run").agg(F.array_sort(F.collect_list(own)).alias("xs"))

    def step(done: Column, span: Column) -> Column:
        held = F.element_at(done, -1)
        between = F.when(squeeze(held["text"]).endswith("-"), "").otherwise(" ")
        text = F.trim(F.concat(F.rtrim(held["text"]), between, F.ltrim(span["text"])))
        whole = held.withField("text", text).withField("x1", F.greatest(held["x1"], span["x1"])).withField("y1", F.greatest(held["y1"], span["y1"])).withField("spans", held["spans"] + 1)
        return F.when(absorbs(held, span, titles), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(whole))).otherwise(F.concat(done, F.array(span)))

    joined = F.aggregate(F.slice("xs", 2, F.size("xs")), F.slice("xs", 1, 1), step)
    return lines.select("book", "page", F.explode(joined).alias("x")).select("book", "page", "x.*")


def title_style(text: Column) -> Column:
    """Whether a line is set like a heading: few words, most of them in title case, but for connecting words."""
    bare = squeeze(F.regexp_replace(squeeze(text), _MARKER, ""))
    words = F.regexp_extract_all(F.when(bare == "", text).otherwise(bare), F.lit(_WORD), F.lit(0))
    titled = F.size(F.filter(words, lambda w: w.rlike("^[A-Z]") | F.lower(w).isin(CONNECTORS)))
    return F.size(words).between(1, TITLE_WORDS) & (titled >= TITLE_SHARE * F.size(words))


def heading_runs(lines: DataFrame) -> DataFrame:
    """(book, page, first, n_lines, text, y0, y1): what may be a heading on a page.

    Every line of lines (book, page, text, x0, y0, x1, y1), its spans joined, is one; so are up to
    `HEADING_LINES` lines under each other, if they are short, stand in one column, and are
    set like a heading together.  `first` is the place of the first line on its page.
    """
    by = Window.partitionBy("book", "page").orderBy("y0", "x0", "y1", "text")
    flat = lines.withColumn("text", squeeze(F.coalesce("text", F.lit("")))).filter("text <> ''").withColumn("ord", F.row_number().over(by).cast("long"))
    single = collapsed(flat, titles=True).select("book", "page", F.col("ord").alias("first"), F.lit(1).alias("n_lines"), squeeze("text").alias("text"), "y0", "y1")
    words = lambda c: F.regexp_count(c, F.lit("[^ ]+"))
    at = lambda k, c: F.lead(c, k).over(Window.partitionBy("book", "page").orderBy("ord"))
    rows = flat
    for k in range(1, HEADING_LINES):
        rows = rows.withColumns({f"{c}_{k}": at(k, c) for c in ("text", "x0", "y0", "y1")})
    fits, texts, runs = (words(F.col("text")) <= FIRST_WORDS) & title_style(F.col("text")), [F.col("text")], []
    last_y1 = F.col("y1")
    for k in range(1, HEADING_LINES):
        gap = F.col(f"y0_{k}") - last_y1
        fits = fits & gap.between(LEAST_GAP, MOST_GAP) & (F.abs(F.col(f"x0_{k}") - F.col("x0")) <= SHIFT) & (words(F.col(f"text_{k}")) <= NEXT_WORDS)
        texts.append(F.col(f"text_{k}"))
        last_y1 = F.col(f"y1_{k}")
        whole = F.concat_ws(" ", *texts)
        runs.append(F.when(fits & title_style(whole), F.struct(F.lit(k + 1).alias("n_lines"), whole.alias("text"), "y0", last_y1.alias("y1"))))
    several = rows.select("book", "page", F.col("ord").alias("first"), F.explode(F.array_compact(F.array(*runs))).alias("r")).select("book", "page", "first", "r.*")
    return single.unionByName(several)


def heading_bands(entries: DataFrame, lines: DataFrame, prefer: str = "last") -> DataFrame:
    """(entry_id, top, bottom, cutoff, match_type, heading): where the heading of each entry stands on its page.

    Entries are rows (entry_id, book, page, variants); they meet the lines and runs of lines of
    their page alone.  Of several bands the lowest (`last`) or highest (`first`) is taken, of
    equal ones the one of more lines.  What is above the cutoff belongs to the entry before.
    Entries without a band are left out.
    """
    if prefer not in ("first", "last"):
        raise ValueError("prefer must be first or last")
    asked = entries.select("entry_id", "book", "page", F.explode("variants").alias("variant")).withColumn("wanted", heading_parts(F.col("variant")))
    runs = heading_runs(lines).withColumn("own", heading_parts(F.col("text")))
    met = asked.join(runs, ["book", "page"]).withColumn("match_type", parts_match(F.col("own"), F.col("wanted"))).filter("match_type IS NOT NULL")
    top = F.col("y0") if prefer == "last" else -F.col("y0")
    place = F.struct(top.alias("top"), "n_lines", F.col("y1"), F.when(F.col("match_type") == "exact", 1).otherwise(0).alias("exact"), "match_type", "text")
    best = met.groupBy("entry_id").agg(F.max_by(F.struct("y0", "y1", "match_type", "text"), place).alias("b"))
    return best.select("entry_id", (F.col("b.y0") - ROOM).alias("top"), (F.col("b.y1") + ROOM).alias("bottom"), (F.col("b.y1") + ROOM).alias("cutoff"), "b.match_type", F.col("b.text").alias("heading"))
