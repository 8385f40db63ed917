"""Passages of a book: cited text, its commentary and references, from the regions of its pages.

Regions are rows (book, page, page_label, ord, role, zone, layout_kind, content_mode, text, x0,
y0, x1, y1).  A region such as "3b) [Source] opening words" is an anchor: it opens a passage.
All other fragments go to a bucket of the passage that is open: citation, commentary or
reference.  The bucket depends on the fragments before it in the passage; windows over books,
pages and passages tell it, so rows are shuffled once, by book, and never met with themselves.

What a rule looks at is on one page, but for the first fragment of a page, which may go on
in the last one of the page before, and for the passage that is open where a page begins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrove.functions.text import squeeze
from lexigrove.operators.continuity import CITED, NOTE_FOOT, aligned, bound, closed, joined_flat, joined_text, note_continues, note_tie, repeated_word, squeezed_note, text_end, text_opening, text_verdict
from lexigrove.operators.matching import ATTACH_WORDS, attach_verdict, marker_only

BUCKETS = ("citation", "commentary", "reference")
#: Points below a centred anchor in which the column of its citation is looked for, and most words of a citation's lead (fixed values).
ZONE_POINTS, LEAD_WORDS = 12.0, 4
#: Most characters of a source reference that stands alone (fixed value).
SOURCE_CHARS = 42
#: Longest commentary, in characters and words, that moves to the next passage whole (fixed values).
TAIL_CHARS, TAIL_WORDS = 160, 24
#: Words of an imprint (fixed values).
IMPRINT = ("Press", "University", "Companion", r"Trans\.", r"ed\.", "Routledge", "Minuit", "SUNY", "MIT")

_ANCHOR = r"(?i)^([-*]\s*)?([0-9]+[a-z])\)\s*(.*)$"
_BREAK = r"[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"
_ENDED = "[.!?][\"”')\\]]?$"
_NAMES = "[A-Z][A-Za-z'’.-]+,\\s+[A-Z][A-Za-z'’.-]+"


# text of a region


def region_text(text: Column) -> Column:
    """Lines of a region as one text: list marks go, words broken by a hyphen are joined, repeated words stand once."""
    marked = lambda line: F.when(F.substring(line, 1, 1).isin(*"-*•"), F.regexp_replace(line, r"^[-*•]\s*", "")).otherwise(line)
    bare = F.transform(F.split(text, rf"\r\n|{_BREAK}"), lambda x: squeeze(marked(F.trim(x))))
    lines = F.filter(bare, lambda x: x != "")

    def step(held: Column, line: Column) -> Column:
        mode = F.when(held.endswith("-") & line.rlike("^[A-Za-z0-9]"), "hyphen").when(repeated_word(held, line).isNotNull(), "duplicate").otherwise("space")
        return F.when(held == "", line).otherwise(joined_flat(held, line, mode))

    # most regions are one line, and nothing is folded for them
    whole = F.when(text.rlike(_BREAK), F.aggregate(lines, F.lit(""), step)).otherwise(squeeze(marked(F.trim(text))))
    return F.coalesce(whole, F.lit(""))


def words_of(flat: Column) -> Column:
    """How many words a squeezed text has, which isn't empty."""
    return F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + 1


def fragments_of(text: Column) -> Column:
    """The pieces of a region's text: every anchor inside it begins a new one."""
    inner = r"\s([0-9]+[A-Za-z]\))"
    pieces = F.filter(F.transform(F.split(F.regexp_replace(text, inner, "\u0001$1"), "\u0001"), lambda x: F.trim(x)), lambda x: x != "")
    one = F.when(F.trim(text) == "", F.array().cast("array<string>")).when(text.isNotNull(), F.array(F.trim(text)))
    return F.when(text.rlike(rf"{inner}|\u0001"), pieces).otherwise(one)


def anchor_of(text: Column, cited: tuple[str, ...] = CITED) -> Column:
    """struct(label, source_ref, seed) of an anchor, or null: its label, its source reference and the words of the citation after it."""
    flat = F.trim(text)
    author = rf"^((?:{'|'.join(cited)})\s+\S+\s+\S+)(?:\s+(.*))?$" if cited else "^(?!)()()"
    alone = rf"^(\[[^\]]+\]{''.join(rf'|{name}\b.*' for name in cited)}|[A-Z][A-Za-z]+(\s+[A-Z][A-Za-z0-9.]+){{0,4}})$"

    def source(rest: Column) -> Column:
        bracket = rest.startswith("[") & F.contains(rest, F.lit("]"))
        return (
            F.when(bracket, F.regexp_extract(rest, r"^([^\]]*\])", 1))
            .when(rest.rlike(author), F.regexp_extract(rest, author, 1))
            .when((F.length(rest) <= SOURCE_CHARS) & rest.rlike(alone), rest)
            .otherwise("")
        )

    def parsed(rest: Column) -> Column:
        label = F.lower(F.regexp_extract(flat, _ANCHOR, 2)).alias("label")
        return bound(source(rest), lambda ref: F.struct(label, ref.alias("source_ref"), F.trim(F.substring(rest, F.length(ref) + 1, F.length(rest))).alias("seed")))

    return F.when(F.substring(flat, 1, 1).rlike("[-*0-9]") & flat.rlike(_ANCHOR), bound(squeeze(F.regexp_extract(flat, _ANCHOR, 3)), parsed))


# fragments


def flatten(regions: DataFrame, mode: str = "balanced") -> DataFrame:
    """Fragments of ``regions`` with what the passages need of their surroundings.

    Adds `frag` (the place in the region), `rag_text`, `anchor`, `note`, `note_continues`,
    `page_anchor` (label of the page's first anchor), `before_anchor`, `attach` (why the
    fragment belongs to the next anchor), `join_mode` (how it goes on in the fragment before),
    `opened` (anchors of the book up to here), `cited` (the zone of an anchor's citation) and `words`.
    """
    pieces = regions.select("*", F.posexplode(bound(region_text(F.coalesce("text", F.lit(""))), fragments_of)).alias("frag", "rag_text"))
    text = F.col("rag_text")
    ends, opens = text_end(text), text_opening(text)
    facts = {"ends": F.struct(*(v.alias(c) for c, v in ends.items())), "opens": F.struct(*(v.alias(c) for c, v in opens.items())), "words": words_of(text)}
    at = F.struct(F.col("ord").cast("long").alias("ord"), F.col("frag"))
    pieces = pieces.withColumn("ord", F.col("ord").cast("long"))
    rows = pieces.withColumns({"anchor": anchor_of(text), "note": squeezed_note(text), "at": at} | facts)
    is_anchor = F.col("anchor").isNotNull()

    # in reading order: the fragment before, on the page or at the end of the page before; texts don't meet, only facts of them
    book, box = Window.partitionBy("book").orderBy("page", "at"), ("zone", "x0", "y0", "x1", "y1")
    plain = (F.col("content_mode") == "prose") & ~is_anchor & ~F.col("note")
    last = F.col("last")
    here = F.struct("page", *box, plain.alias("plain"), "ends")
    rows = rows.withColumns({"last": F.lag(here).over(book), "row": F.row_number().over(book), "opened": F.count_if(is_anchor).over(book.rowsBetween(Window.unboundedPreceding, 0))})
    held = {c: last[c] for c in box}
    same_page = F.col("page").eqNullSafe(last["page"])
    beside, follows = aligned(held, {c: F.col(c) for c in box}, F.when(same_page, 0).otherwise(F.col("page") - last["page"]), mode)
    verdict = text_verdict({c: last["ends"][c] for c in ends}, {c: F.col(f"opens.{c}") for c in opens})
    # what is known of the fragment before is said at once, so that later windows hold little
    rows = rows.withColumns(
        {
            "join_mode": F.when(last.isNotNull() & last["plain"] & plain & beside & follows, verdict),
            "tied": F.coalesce(last.isNotNull() & same_page, F.lit(False)) & note_tie(held),
            "hangs": (F.col("words") <= ATTACH_WORDS) & F.col("ends.open") & ~F.col("note") & ~is_anchor,
            "next_at": F.when(is_anchor, F.struct("zone", "ord", "y0", marker_only(text).alias("bare"))),
        }
    ).drop("last", "ends", "opens")

    page = Window.partitionBy("book", "page").orderBy("at")
    upto, before, whole = (page.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1, Window.unboundedFollowing))
    # `lead` of the DataFrame functions can't pass over nulls
    ahead = lambda c: F.expr(f"lead({c}) IGNORE NULLS OVER (PARTITION BY book, page ORDER BY at)")
    rows = rows.withColumns(
        {
            "page_anchor": F.first("anchor.label", ignorenulls=True).over(whole),
            "seen": F.coalesce(F.bool_or(is_anchor).over(before), F.lit(False)),
            "under": F.last(F.when(is_anchor, F.struct("zone", "y0")), ignorenulls=True).over(upto),
            "note_continues": note_continues(F.col("note") & (F.col("y0") >= NOTE_FOOT), F.col("tied"), F.col("row"), page),
            "next_at": ahead("next_at"),
        }
    ).drop("tied", "row")

    # what ends the search for the zone of an anchor's citation
    low = F.col("y0") - F.col("under.y0") > ZONE_POINTS
    hit = ~low & (F.col("zone") != F.col("under.zone")) & ~F.col("note")
    stop = F.when(is_anchor | F.coalesce(low | hit, F.lit(True)), F.struct(F.when(~is_anchor & hit, F.col("zone")).alias("zone")))
    near = attach_verdict(F.col("hangs") & F.col("next_at").isNotNull(), F.col("zone"), F.col("ord"), F.col("next_at.bare"), F.col("next_at.zone"), F.col("next_at.ord"), F.col("next_at.y0") - F.col("y0"))
    rows = rows.withColumns({"next_stop": stop, "attach": near, "before_anchor": F.col("page_anchor").isNotNull() & ~F.col("seen")}).drop("next_at", "under", "seen", "hangs")
    # a centred anchor without words cites what stands beside it
    cited = F.when((F.col("zone") == "center") & (F.col("anchor.seed") == ""), F.coalesce("next_stop.zone", "zone")).otherwise(F.col("zone"))
    return rows.withColumn("next_stop", ahead("next_stop")).withColumn("cited", F.when(is_anchor, cited)).drop("next_stop")


# buckets


def bucketed(fragments: DataFrame) -> DataFrame:
    """Fragments of `flatten` with `passage` (0 before the first anchor), `seq`, `label`, `bucket`, `inherited` and `part`.

    `seq` is the order within the book after fragments that belong to the next anchor have
    moved behind it; anchors have a bucket where words of the citation follow their label.
    Fragments of a bucket that go on in each other have one `part`, and parts rise with the order.

    Fragments that don't inherit head a run with one bucket.  A short lead heads a citation if no
    citation or reference stands in the passage before it.  As such a lead makes one itself, the
    first lead and all heads that follow plain rules are known row by row.
    """
    is_anchor, forced = F.col("anchor").isNotNull(), F.col("attach").isNotNull()
    seeded = is_anchor & (F.col("anchor.seed") != "")
    rank = F.when(is_anchor, 0).when(forced, 1).otherwise(2)
    rows = fragments.withColumns({"passage": (F.col("opened") + forced.cast("int")).cast("long"), "rank": rank})
    # both have the same order: a book's passages follow each other, as do the pages of one
    book = Window.partitionBy("book").orderBy("passage", "page", "rank", "at")
    passage = Window.partitionBy("book", "passage").orderBy("page", "rank", "at")
    upto, before = (passage.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    rows = rows.withColumn("seq", F.row_number().over(book))
    opening = F.when(is_anchor, F.struct(F.col("anchor.label").alias("label"), F.col("cited").alias("zone")))
    rows = rows.withColumns({"open": F.first(opening).over(upto), "follows": F.lag(~is_anchor | seeded).over(passage), "leads": F.coalesce(F.lag(is_anchor).over(passage), F.lit(True))})

    elsewhere = F.col("before_anchor") & ~F.col("page_anchor").eqNullSafe(F.col("open.label"))
    plain = (
        F.when(F.col("note") | F.col("note_continues"), 3)
        .when(F.col("open").isNull(), F.when(F.col("role").isin("main", "table"), 2).otherwise(3))
        .when(elsewhere, 2)
        .when(F.col("zone") == F.col("open.zone"), 1)
        .otherwise(2)
    )
    inherits = ~is_anchor & F.col("join_mode").isNotNull() & F.coalesce("follows", F.lit(False))
    short = (F.col("zone") == "center") & (F.col("words") <= LEAD_WORDS) & ~F.col("note")
    rows = rows.withColumns({"plain": plain, "inherited": inherits, "lead": F.coalesce(short & F.col("open").isNotNull(), F.lit(False))})
    heads = ~is_anchor & ~forced & ~F.col("inherited")
    fills = seeded | (heads & (F.col("lead") | F.col("plain").isin(1, 3)))
    rows = rows.withColumns({"filled": F.coalesce(F.bool_or(fills).over(before), F.lit(False))})
    own = F.when(seeded, 1).when(forced, 2).when(heads & F.col("lead") & ~F.col("filled"), 1).when(heads, F.col("plain"))
    placed = ~is_anchor | seeded
    # what is forced behind an anchor goes on in the fragment before it, unless that is the anchor
    starts = seeded | heads | (forced & (~F.col("inherited") | F.col("leads")))
    # as rows, so that one window finds both
    rows = rows.withColumns({"own": own, "head": F.when(starts, F.col("seq"))})
    rows = rows.withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in ("own", "head")})
    bucket = F.get(F.array(*(F.lit(b) for b in BUCKETS)), F.when(placed, F.col("own")) - 1)
    return rows.withColumns({"label": F.col("open.label"), "bucket": bucket, "part": F.when(placed, F.col("head"))}).drop(
        "opened", "cited", "rank", "open", "follows", "leads", "plain", "lead", "filled", "own", "head", "words"
    )


# passages


def assembled(rows: DataFrame) -> DataFrame:
    """(book, passage, passage_id, label, source_ref, citation, commentary, reference, page_labels, pages).

    The buckets are lists of parts: a fragment that inherits its bucket is joined to the last
    part of it.  Passages without any part are left out.  A row holds one passage.
    """
    piece = F.when(F.col("anchor").isNotNull(), F.col("anchor.seed")).otherwise(F.col("rag_text"))
    own = F.struct("page", "seq", "bucket", "part", piece.alias("piece"), "join_mode", "page_label")
    out = rows.groupBy("book", "passage").agg(
        F.max("label").alias("label"), F.max("anchor.source_ref").alias("source_ref"), F.count("bucket").alias("n"), F.sort_array(F.collect_list(own)).alias("places")
    )

    def joined(pieces: Column) -> Column:
        first = F.get(pieces, F.lit(0))["piece"]
        whole = F.aggregate(F.slice(pieces, 2, F.size(pieces)), first, lambda held, x: joined_flat(held, x["piece"], x["join_mode"]))
        return F.when(F.size(pieces) == 1, first).otherwise(whole)

    def parts(bucket: str) -> Column:
        # a part's fragments follow each other among those of its bucket
        def cut(held: Column) -> Column:
            heads = F.filter(F.transform(held, lambda x, i: F.when((i == 0) | (x["part"] != F.get(held, i - 1)["part"]), i)), lambda i: i.isNotNull())
            return bound(heads, lambda hs: F.transform(hs, lambda h, k: bound(F.slice(held, h + 1, F.coalesce(F.get(hs, k + 1), F.size(held)) - h), joined)))

        return bound(F.filter("places", lambda x: x["bucket"] == bucket), cut).alias(bucket)

    labels = F.array_distinct(F.filter(F.transform("places", lambda x: x["page_label"]), lambda x: F.coalesce(x != "", F.lit(False))))
    pages = F.array_distinct(F.transform("places", lambda x: x["page"]))
    return out.filter("n > 0").select(
        "book", "passage", F.coalesce("label", F.lit("preamble-01")).alias("passage_id"), "label", F.coalesce("source_ref", F.lit("")).alias("source_ref"), *map(parts, BUCKETS), labels.alias("page_labels"), pages.alias("pages")
    )


def sentence_tail(text: Column) -> Column:
    """What follows the last finished sentence of a text that stops in the middle of one; null where there is no such sentence."""
    flat = F.trim(text)
    tail = F.regexp_extract(flat, r"(?s)^.*[.!?][\"”')\]]?\s+(.+)$", 1)
    return F.when((flat != "") & ~flat.rlike(_ENDED), F.nullif(F.trim(tail), F.lit("")))


def boundaries_repaired(passages: DataFrame) -> DataFrame:
    """``passages`` of `assembled` whose unfinished commentary has moved to the next passage that goes on in it.

    The last part of a commentary moves before the first part of the next one if it stops in
    mid-sentence, the next opens in lower case or with a bracket or quotation mark, pages
    follow each other, and it is short.  In a book with a label that repeats, only what
    follows its last finished sentence moves, whatever its length.  Bibliography at the end of a
    commentary then moves to the references.

    What can move is seen row by row; only where a commentary is a single part can one move
    bear on the next.  So a fold holds a run of passages that may all move, never a book.
    """
    book = Window.partitionBy("book")
    by = book.orderBy("passage")
    again = passages.withColumn("again", F.col("label").isNotNull() & (F.count(F.lit(1)).over(Window.partitionBy("book", "label")) > 1))
    rows = again.withColumn("repeats", F.bool_or("again").over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).drop("again")
    tail, head = squeeze(F.element_at(F.lag("commentary").over(by), -1)), squeeze(F.get("commentary", F.lit(0)))
    gap = F.get("pages", F.lit(0)) - F.element_at(F.lag("pages").over(by), -1)
    both = (F.lag(F.size("commentary")).over(by) > 0) & (F.size("commentary") > 0)
    may = F.when(both, (F.coalesce(gap, F.lit(0)) <= 1) & head.rlike('^[a-z(\\["“]') & (tail != "") & ~tail.rlike(_ENDED))
    rows = rows.withColumn("follows", F.coalesce(may, F.lit(False)))
    rows = rows.withColumn("run", F.sum((~F.col("follows")).cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    own = F.struct("passage", *(c for c in passages.columns if c not in ("book", "passage")))
    runs = rows.groupBy("book", "run").agg(F.sort_array(F.collect_list(own)).alias("xs"), F.first("repeats").alias("repeats"))

    def step(held: Column, x: Column) -> Column:
        last, rest = F.element_at(held, -1), F.slice(held, 1, F.size(held) - 1)
        tail = F.element_at(last["commentary"], -1)
        flat = squeeze(tail)
        short = (F.length(flat) <= TAIL_CHARS) & (F.regexp_count(flat, F.lit("[^ ]+")) <= TAIL_WORDS)
        cut = F.when(F.col("repeats"), sentence_tail(tail))
        moves = (F.size(last["commentary"]) > 0) & (flat != "") & ~flat.rlike(_ENDED) & (short | cut.isNotNull())
        moved = F.coalesce(cut, tail)
        left = F.when(cut.isNotNull(), F.array(F.rtrim(F.substring(F.trim(tail), F.lit(1), F.length(F.trim(tail)) - F.length(cut))))).otherwise(F.array().cast("array<string>"))
        opening = F.get(x["commentary"], F.lit(0))
        left_flat, right_flat = squeeze(moved), squeeze(opening)
        how = (
            F.when(left_flat.endswith("-") & right_flat.rlike("^[A-Za-z0-9]"), "hyphen")
            .when(repeated_word(left_flat, right_flat).isNotNull(), "duplicate")
            .otherwise("space")
        )
        fewer = last.withField("commentary", F.concat(F.slice(last["commentary"], 1, F.size(last["commentary"]) - 1), left))
        more = x.withField("commentary", F.concat(F.array(joined_text(moved, opening, how)), F.slice(x["commentary"], 2, F.size(x["commentary"]))))
        more = more.withField("page_labels", F.concat(F.reverse(F.array_except(last["page_labels"], x["page_labels"])), x["page_labels"]))
        more = more.withField("pages", F.concat(F.reverse(F.array_except(last["pages"], x["pages"])), x["pages"]))
        return F.when(moves, F.concat(rest, F.array(fewer, more))).otherwise(F.concat(held, F.array(x)))

    folded = F.aggregate(F.slice("xs", 2, F.size("xs")), F.slice("xs", 1, 1), step)
    rows = runs.select("book", F.explode(F.when(F.size("xs") > 1, folded).otherwise(F.col("xs"))).alias("x")).select("book", "x.*")
    return bibliography_moved(rows.select(*passages.columns))


def bibliography(part: Column) -> Column:
    """Whether a part is an entry of a bibliography: it opens with "Name, Name", or has such names and an imprint."""
    imprint = "|".join(IMPRINT)
    return F.contains(part, F.lit(",")) & bound(squeeze(part), lambda flat: flat.rlike(f"^{_NAMES}") | (flat.rlike(rf"\b({imprint})\b") & flat.rlike(rf"\b{_NAMES}")))


def bibliography_moved(passages: DataFrame) -> DataFrame:
    """``passages`` whose bibliography at the end of the commentary stands before their other references."""
    size, last = F.size("commentary"), F.element_at("commentary", -1)

    def last_other(entries: Column) -> Column:
        return (size - F.coalesce(F.nullif(F.array_position(F.reverse(entries), False), F.lit(0).cast("long")) - 1, size)).cast("int")

    # mostly the last part is none, so no other is looked at
    kept = F.when((F.size("reference") > 0) & (size > 0) & bibliography(last), bound(F.transform("commentary", bibliography), last_other)).otherwise(size)
    rows = passages.withColumn("kept", kept)
    return rows.withColumns({"reference": F.concat(F.slice("commentary", F.col("kept") + 1, size), F.col("reference")), "commentary": F.slice("commentary", F.lit(1), F.col("kept"))}).drop("kept")


def merged(parts: Column) -> Column:
    """A bucket's text: blank lines stand between its parts, but parts that obviously go on are joined."""
    split = lambda p: F.filter(F.transform(F.split(p, "\n\n"), lambda c: F.trim(c)), lambda c: c != "")
    cut = F.flatten(F.transform(parts, lambda p: F.when(F.contains(p, F.lit("\n\n")), split(p)).otherwise(F.array(F.trim(p)))))
    chunks = F.filter(cut, lambda c: c != "")
    # each text as it is shown, and squeezed
    texts = F.transform(chunks, lambda c: F.struct(c.alias("text"), squeeze(c).alias("flat")))

    def step(held: Column, chunk: Column) -> Column:
        b = chunk["flat"]
        few = ~b.rlike("^([^ ]+ +){7}[^ ]")
        goes = F.substring(b, 1, 1).rlike("(?U)[\\p{Ll},;:)\\]}’\"'-]")

        def tried(a: Column) -> Column:
            mode = F.when(a.endswith("-") & b.rlike("^[A-Za-z0-9]"), "hyphen").when(repeated_word(a, b).isNotNull(), "duplicate").when((goes | few) & ~closed(a), "space")
            return bound(mode, lambda m: put(a, m))

        def put(a: Column, m: Column) -> Column:
            whole = bound(joined_flat(a, b, m), lambda t: F.array(F.struct(t.alias("text"), t.alias("flat"))))
            return F.when(m.isNotNull(), F.concat(F.slice(held, 1, F.size(held) - 1), whole)).otherwise(F.concat(held, F.array(chunk)))

        return bound(F.element_at(held, -1)["flat"], tried)

    return F.array_join(F.transform(F.aggregate(F.slice(texts, 2, F.size(texts)), F.slice(texts, 1, 1), step), lambda x: x["text"]), "\n\n")


def passages(regions: DataFrame, mode: str = "balanced") -> DataFrame:
    """All passages of all books, repaired; `BUCKETS` are lists of parts."""
    return boundaries_repaired(assembled(bucketed(flatten(regions, mode))))
