"""Whether neighbouring regions of a page go on in each other, and what they become when joined.

Regions are rows (book, page, ord, zone, text, x0, y0, x1, y1).  All rules are expressions over one row; only the repair of a
page folds, over the regions of that page.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lexigrove.functions.text import slug, squeeze

#: Words whose repetition across a boundary is an artifact (fixed values).
BOUNDARY_WORDS = "a also an and he i in it of on or she the they this those to we you".split()
#: How far left and right edges may shift, the widest gap, where the foot of a page begins and
#: its head ends, in points, by how readily regions are joined (fixed values).
LIMITS = {"conservative": (48.0, 96.0, 20.0, 470.0, 72.0), "balanced": (60.0, 120.0, 28.0, 430.0, 90.0), "aggressive": (84.0, 156.0, 40.0, 395.0, 110.0)}
LEAST_GAP, FEW_WORDS = -2.0, 7
#: Authors whose names mark a source reference (fixed values).
CITED = ("Levinas", "Derrida")
#: Region texts that are apparatus by themselves (fixed values).
APPARATUS = ("chapter", "wn", "cf.", "supra", "infra", "op. cit.")
#: Short regions: characters or words; how many of them, and how many notes among them, make a list of notes (fixed values).
MICRO_CHARS, MICRO_WORDS, TITLED_MICRO, TITLED_NOTES, ASIDE_MICRO, ASIDE_NOTES = 24, 4, 4, 3, 6, 4
#: Where notes at the foot of a page begin, and how their lines may shift (fixed values).
NOTE_FOOT, NOTE_GAP, NOTE_X0, NOTE_X1, NOTE_LINE, NOTE_WIDER = 520.0, 20.0, 18.0, 48.0, 8.0, 120.0

_CAPITALS = "^[A-Z][A-Z .&/-]*$"
_WORD = "[A-Za-z][A-Za-z'’-]*"
_ENDED = "[.!?][\"”')\\]]?$"
_GOES_ON = "^(?U)[\\p{Ll},;:)\\]}’\"'-]"
_BOX = ("zone", "x0", "y0", "x1", "y1")
#: Columns for a row's region and the one before it, while they are compared.
_HERE, _LAST = "__continuity_here", "__continuity_last"


def unfinished(text: Column) -> Column:
    """Whether a text must go on: it isn't empty and no closing mark ends it."""
    flat = squeeze(text)
    return (flat != "") & ~flat.rlike(_ENDED)


def goes_on(text: Column) -> Column:
    """Whether a text opens in lower case or with a mark that follows something."""
    return squeeze(text).rlike(_GOES_ON)


def reference_note(text: Column, cited: tuple[str, ...] = CITED) -> Column:
    """Whether a short text is a reference: capitals, numbers, an author with a number, or a bracket."""
    return squeezed_note(squeeze(text), cited)


def note_apparatus(text: Column) -> Column:
    """Whether a text is part of the apparatus of notes and not of a sentence: references, numerals, short capitals."""
    return _apparatus(squeeze(text))


def running_prose(text: Column) -> Column:
    """Whether a text may be a part of a sentence: no apparatus, no note marker before it, no line of capitals."""
    return _prose(squeeze(text))


# the same of texts whose white space is squeezed already


def squeezed_note(flat: Column, cited: tuple[str, ...] = CITED) -> Column:
    digit = (F.length(flat) <= 50) & flat.rlike("[0-9]")
    numbers = (F.length(flat) <= 40) & flat.rlike("^[\\[\\]0-9A-Za-z .,/–—-]+$")
    named = (F.length(flat) <= 50) & flat.rlike(rf"\b({'|'.join(cited)})\b") if cited else F.lit(False)
    bracket = (F.length(flat) <= 24) & flat.startswith("[") & flat.endswith("]")
    return (flat != "") & (((F.length(flat) <= 16) & flat.rlike(_CAPITALS)) | (digit & (numbers | named)) | bracket)


def _apparatus(flat: Column) -> Column:
    numeral = flat.rlike("(?i)^([ivxlcdm]+|[0-9]+[.)]?)$")
    dotted = flat.startswith(".") & (F.length(flat) <= 24)
    capitals = ~flat.rlike("^[^ ]+ [^ ]+ ") & (flat == F.upper(flat)) & (flat != F.lower(flat))
    numbered = (F.length(flat) <= 18) & flat.rlike("[0-9]")
    return (flat != "") & (squeezed_note(flat) | ((F.length(flat) <= max(map(len, APPARATUS))) & F.lower(flat).isin(*APPARATUS)) | numeral | dotted | capitals | numbered)


def _prose(flat: Column) -> Column:
    return (flat != "") & ~_apparatus(flat) & ~flat.rlike("^[0-9]+[a-z]?\\)") & ~((F.length(flat) <= 32) & flat.rlike(_CAPITALS))


def _boundary_word(word: Column) -> Column:
    return F.when(F.lower(word).isin(BOUNDARY_WORDS), F.lower(word))


def last_boundary_word(text: Column) -> Column:
    """The boundary word that ends a text, whatever marks follow it, in lower case, or null; read backwards, so only the end is searched."""
    token = F.substring_index(text, " ", -1)
    end = F.when(token.rlike("[A-Za-z]"), token).otherwise(text)
    return _boundary_word(F.reverse(F.regexp_extract(F.reverse(end), "^(?:[^A-Za-z]*[^A-Za-z'’-])?([A-Za-z]+)['’-]*(?:[^A-Za-z'’-]|$)", 1)))


def first_boundary_word(text: Column) -> Column:
    """The boundary word that opens a text, whatever marks stand before it, in lower case, or null."""
    return _boundary_word(F.regexp_extract(text, _WORD, 0))


def repeated_word(left: Column, right: Column) -> Column:
    """The word that ends the left text and opens the right one again, in lower case, or null."""
    first = first_boundary_word(right)
    # few texts open with such a word
    return F.when(first.isNotNull() & (last_boundary_word(left) == first), first)


def aligned(last: dict[str, Column], own: dict[str, Column], page_gap: Column, mode: str = "balanced") -> tuple[Column, Column]:
    """Whether two regions stand in one column, and whether the second follows the first on its page or the next."""
    x0_shift, x1_shift, gap, foot, head = LIMITS[mode]
    beside = (last["zone"] == own["zone"]) | (F.abs(last["x0"] - own["x0"]) <= x0_shift) | (F.abs(last["x1"] - own["x1"]) <= x1_shift)
    below = (own["y0"] - last["y1"]).between(LEAST_GAP, gap)
    over_page = (last["y1"] >= foot) & (own["y0"] <= head)
    return beside, F.when(page_gap == 0, below).when(page_gap == 1, over_page).otherwise(False)


def closed(flat: Column) -> Column:
    """Whether a closing mark ends a squeezed text; its last two characters tell."""
    return F.substring(flat, -2, 2).rlike(_ENDED)


def text_end(flat: Column) -> dict[str, Column]:
    """What `text_verdict` asks of the end of a squeezed text."""
    return {"dash": flat.endswith("-"), "last_word": last_boundary_word(flat), "open": (flat != "") & ~closed(flat)}


def text_opening(flat: Column, opening: str = "") -> dict[str, Column]:
    """What `text_verdict` asks of a squeezed text that may go on in another; ``opening`` has further marks that it may open with."""
    first = F.substring(flat, 1, 1)
    goes, opens = first.rlike(_GOES_ON), first.rlike(f"[{opening}]") if opening else F.lit(False)
    few = ~flat.rlike(f"^([^ ]+ +){{{FEW_WORDS}}}[^ ]")
    return {"letter": first.rlike("[A-Za-z0-9]"), "first_word": first_boundary_word(flat), "goes": goes, "may_follow": goes | opens | few}


def text_verdict(before: dict[str, Column], after: dict[str, Column]) -> Column:
    """How the second of two texts goes on in the first, or null, by `text_end` of the first and `text_opening` of the second."""
    return (
        F.when(before["dash"] & after["letter"], "hyphen")
        .when((before["last_word"] == after["first_word"]) & (before["open"] | after["goes"]), "duplicate")
        .when(before["open"] & after["may_follow"], "space")
    )


def join_verdict(last: dict[str, Column], own: dict[str, Column], page_gap: Column, mode: str = "balanced", content: Column | None = None) -> Column:
    """How a region joins the one before it ("hyphen", "duplicate", "space"), or why it doesn't.

    The regions are given by their columns zone, x0, y0, x1 and y1 and `text_facts`; ``content``
    is the content mode of the page, prose where it isn't given.
    """
    beside, follows = aligned(last, own, page_gap, mode)
    return (
        F.when(F.coalesce(content, F.lit("prose")) != "prose" if content is not None else F.lit(False), "non-prose-page")
        .when(last["empty"] | own["empty"], "empty-fragment")
        .when(~page_gap.isin(0, 1), "page-gap")
        .when(~last["prose"] | ~own["prose"], "non-prose-fragment")
        .when(~beside, "x-incompatible")
        .when(~follows, "y-incompatible")
        .otherwise(F.coalesce(text_verdict(last, own), F.lit("no-continuation-signal")))
    )


def text_facts(flat: Column) -> dict[str, Column]:
    """All that `join_verdict` asks of a region's squeezed text, so that texts needn't meet."""
    return {"empty": flat == "", "prose": _prose(flat)} | text_end(flat) | text_opening(flat, "\"'“(\\[")


def joined_text(left: Column, right: Column, mode: Column) -> Column:
    """Both texts as one: without the hyphen, without the repeated word if the right text opens with it, or with a space between."""
    return joined_flat(squeeze(left), squeeze(right), mode)


def joined_flat(a: Column, b: Column, mode: Column) -> Column:
    """`joined_text` of texts whose white space is squeezed already."""
    rest = F.ltrim(F.regexp_replace(b, rf"^(?i)({'|'.join(BOUNDARY_WORDS)})\b", ""))
    return F.when(mode == "hyphen", F.concat(F.regexp_replace(a, "-$", ""), b)).when((mode == "duplicate") & repeated_word(a, b).isNotNull(), F.rtrim(F.concat(a, F.lit(" "), rest))).otherwise(F.trim(F.concat(a, F.lit(" "), b)))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is found once, as a lambda's variable, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def adjacent_joins(regions: DataFrame, mode: str = "balanced") -> DataFrame:
    """``regions`` with `verdict` of `join_verdict` against the region before in the book, null for the first.

    A column `content_mode` says what a page holds; without it, all pages hold prose.
    """
    by = Window.partitionBy("book").orderBy("page", "ord")
    facts = text_facts(squeeze(F.coalesce("text", F.lit(""))))
    fields = ("page", *_BOX, *facts)
    own = F.struct("page", *_BOX, *(v.alias(c) for c, v in facts.items()))
    seen = regions.withColumn(_HERE, own).withColumn(_LAST, F.lag(_HERE).over(by))
    last, here = ({c: F.col(f"{side}.{c}") for c in fields} for side in (_LAST, _HERE))
    content = F.col("content_mode") if "content_mode" in regions.columns else None
    verdict = join_verdict(last, here, here["page"] - last["page"], mode, content)
    return seen.withColumn("verdict", F.when(F.col(_LAST).isNotNull(), verdict)).drop(_LAST, _HERE)


def content_modes(regions: DataFrame, pages: DataFrame) -> DataFrame:
    """(book, page, content_mode): index, table or prose, of pages (book, page, entry_kind, entry_title, layout_kind).

    A page of an index entry is an index, a page with a table's layout a table.  Else a page is
    an index if its entry is called notes or index and it holds short regions and notes among
    them, or if it is set as an aside and at least half of its many short regions are notes.
    """
    flat = squeeze(F.coalesce("text", F.lit("")))
    short = (F.length(flat) <= MICRO_CHARS) | (F.regexp_count(flat, F.lit("[^ ]+")) <= MICRO_WORDS)
    counts = regions.filter(flat != "").groupBy("book", "page").agg(F.count_if(short).alias("micro"), F.count_if(_apparatus(flat)).alias("notes"))
    kind, layout = F.coalesce("entry_kind", F.lit("")), F.coalesce("layout_kind", F.lit(""))
    titled = slug(F.coalesce("entry_title", F.lit(""))).isin("notes", "index") & (F.col("micro") >= TITLED_MICRO) & (F.col("notes") >= TITLED_NOTES)
    aside = (layout == "aside") & (F.col("micro") >= ASIDE_MICRO) & (F.col("notes") >= F.greatest(F.lit(ASIDE_NOTES), F.floor(F.col("micro") / 2)))
    mode = F.when(kind == "index", "index").when(layout == "table", "table").when(F.coalesce(titled | aside, F.lit(False)), "index").otherwise("prose")
    return pages.join(counts, ["book", "page"], "left").select("book", "page", mode.alias("content_mode"))


def repair_pages(regions: DataFrame) -> DataFrame:
    """(book, page, ord, text, x0, y0, x1, y1, parts): regions of a page, those that go on in each other as one.

    A joined region keeps the zone of its first part, and its box holds all parts; the next
    region is tried against that.  What the rules ask of a text is found once, before the fold,
    and again only for texts that were joined.  One row's fold holds one page.
    """
    text = F.coalesce("text", F.lit(""))
    facts = text_facts(F.col(_LAST))
    own = F.struct(
        F.col("ord").cast("bigint").alias("ord"), "zone", text.alias("text"), *(F.col(c).cast("double").alias(c) for c in _BOX[1:]), F.lit(1).alias("parts"), *(v.alias(c) for c, v in facts.items())
    )
    # columns of their own: an aggregate would find the squeezed text anew for every fact
    rows = regions.withColumn(_LAST, squeeze(text)).select("book", "page", own.alias(_HERE))

    def whole(last: Column, region: Column, mode: Column) -> Column:
        box = (f(last[c], region[c]).alias(c) for c, f in zip(_BOX[1:], (F.least, F.least, F.greatest, F.greatest)))
        fields = (last["ord"].alias("ord"), last["zone"].alias("zone"), *box, (last["parts"] + 1).alias("parts"))
        return bound(joined_text(last["text"], region["text"], mode), lambda t: F.struct(*fields[:2], t.alias("text"), *fields[2:], *(v.alias(c) for c, v in text_facts(t).items())))

    def step(held: Column, region: Column) -> Column:
        def tried(last: Column) -> Column:
            mode = join_verdict(*({c: x[c] for c in (*_BOX, *facts)} for x in (last, region)), F.lit(0))
            kept = F.slice(held, 1, F.size(held) - 1)
            return bound(mode, lambda m: F.when(m.isin("hyphen", "duplicate", "space"), F.concat(kept, F.array(whole(last, region, m)))).otherwise(F.concat(held, F.array(region))))

        return bound(F.element_at(held, -1), tried)

    pages = rows.groupBy("book", "page").agg(F.sort_array(F.collect_list(_HERE)).alias("r"))
    repaired = F.aggregate(F.slice("r", 2, F.size("r")), F.slice("r", 1, 1), step)
    return pages.select("book", "page", F.explode(repaired).alias("x")).select("book", "page", "x.ord", "x.text", "x.x0", "x.y0", "x.x1", "x.y1", "x.parts")


def note_lines(regions: DataFrame, is_note: Column) -> DataFrame:
    """``regions`` with `seed` and `continues`: notes at the foot of a page and the lines that go on in them.

    A line goes on in a note if it stands at the foot, close below the line before it, in the
    same zone or column, and that line is a note or goes on in one.
    """
    own = "__"
    while any(c.startswith(own) for c in regions.columns):
        own += "_"
    tied, row = f"{own}tied", f"{own}row"
    by = Window.partitionBy("book", "page").orderBy("ord")
    last = {c: F.lag(c).over(by) for c in _BOX}
    close = note_tie({c: F.col(f"{own}{c}") for c in last})
    marked = regions.withColumns({row: F.row_number().over(by)} | {f"{own}{c}": v for c, v in last.items()}).withColumns({"seed": is_note & (F.col("y0") >= NOTE_FOOT), tied: close})
    continues = note_continues(F.col("seed"), F.col(tied), F.col(row), by)
    return marked.withColumn("continues", continues).drop(*(f"{own}{c}" for c in last), tied, row)


def note_tie(last: dict[str, Column]) -> Column:
    """Whether a line would go on in the line ``last`` of its page, if that is part of a note."""
    shift = F.abs(last["x0"] - F.col("x0")) <= NOTE_X0
    same_line = (F.abs(last["y0"] - F.col("y0")) <= NOTE_LINE) & shift & (F.col("x1") - last["x1"] >= NOTE_WIDER)
    band = (last["zone"] == F.col("zone")) | (shift & (F.abs(last["x1"] - F.col("x1")) <= NOTE_X1)) | same_line
    return F.coalesce(band & (F.col("y0") >= NOTE_FOOT) & (F.col("y0") - last["y1"] <= NOTE_GAP), F.lit(False))


def note_continues(seed: Column, tied: Column, row: Column, by: WindowSpec) -> Column:
    """Whether a line goes on in a note: one stands before it in its run of tied lines; ``row`` rises in the order of the page, ``by``."""
    seeds = F.max(F.when(seed, row)).over(by.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.max(F.when(~tied, row)).over(by.rowsBetween(Window.unboundedPreceding, 0))
    return tied & F.coalesce(seeds >= begins, F.lit(False))
