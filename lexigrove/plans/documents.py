"""Queries over regions, pages, projections and manifests that are made of the tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexigrove.functions.text import DANGLING, SPACE, html_field, html_text, squeeze
from lexigrove.operators import continuity as C
from lexigrove.operators import layout as L
from lexigrove.operators import paging as P
from lexigrove.operators import passages as G
from lexigrove.operators import projection as J
from lexigrove.operators import quality as Q
from lexigrove.operators import structure as S
from lexigrove.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _lines(spark, sf):
    """Each line of a document as a region: 40 lines a page of a book, every fifth in the right zone."""
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("book"), F.posexplode(F.split("text", "\n")).alias("ord", "text"))
    i = F.col("ord")
    return rows.select(
        "book", F.floor(i / 40).cast("int").alias("page"), "ord", "text", F.when(i % 5 == 4, "right").otherwise("center").alias("zone"),
        ((F.col("book") + i * 53) % 300).cast("double").alias("x0"), ((F.col("book") + i * 53) % 300 + 200).cast("double").alias("x1"),
        (40 + i % 40 * 14).cast("double").alias("y0"), (52 + i % 40 * 14).cast("double").alias("y1"),
    )


_SQ = lambda x: f"trim(regexp_replace({x}, '{SPACE}+', ' ', 'g'))"
_KEY = lambda x: f"regexp_replace(lower({x}), '[^a-z0-9]+', '', 'g')"
_N = lambda x: f"length(regexp_extract_all({x}, '[^ ]+'))"
_LINES = """lines AS MATERIALIZED (SELECT book, i // 40 AS page, i AS ord, text, CASE WHEN i % 5 = 4 THEN 'right' ELSE 'center' END AS zone, ((book + i * 53) % 300)::DOUBLE AS x0,
  ((book + i * 53) % 300 + 200)::DOUBLE AS x1, (40 + i % 40 * 14)::DOUBLE AS y0, (52 + i % 40 * 14)::DOUBLE AS y1
  FROM (SELECT doc_id AS book, unnest(string_split(text, chr(10))) AS text, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents))"""


# regions


@query
def region_joins(spark, sf):
    return C.adjacent_joins(_lines(spark, sf)).groupBy("book", F.coalesce("verdict", F.lit("first")).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


_WORD = "[A-Za-z][A-Za-z''’-]*"
_DIGIT = lambda x: f"regexp_matches({x}, '[0-9]')"
_NOTE = lambda x: f"({x} <> '' AND ((length({x}) <= 16 AND regexp_matches({x}, '^[A-Z][A-Z .&/-]*$')) OR (length({x}) <= 40 AND regexp_matches({x}, '^[\\[\\]0-9A-Za-z .,/–—-]+$') AND {_DIGIT(x)}) OR (length({x}) <= 50 AND regexp_matches({x}, '\\b(Levinas|Derrida)\\b') AND {_DIGIT(x)}) OR (length({x}) <= 24 AND {x}[1] = '[' AND {x}[-1] = ']')))"
_APPARATUS = lambda x: f"({_NOTE(x)} OR lower({x}) IN ('chapter', 'wn', 'cf.', 'supra', 'infra', 'op. cit.') OR regexp_matches(lower({x}), '^([ivxlcdm]+|[0-9]+[.)]?)$') OR ({x}[1] = '.' AND length({x}) <= 24) OR ({x} = upper({x}) AND {x} <> lower({x}) AND {_N(x)} <= 2) OR (length({x}) <= 18 AND {_DIGIT(x)}))"
_PROSE = lambda x: f"({x} <> '' AND NOT {_APPARATUS(x)} AND NOT regexp_matches({x}, '^[0-9]+[a-z]?\\)') AND NOT (regexp_matches({x}, '^[A-Z][A-Z .&/-]*$') AND length({x}) <= 32))"
_OPEN_END = "NOT regexp_matches(b, '[.!?][\"”'')\\]]?$')"
_GOES_ON = "regexp_matches(a, '^[\\p{Ll},;:)\\]}’\"''-]')"
_LAST_WORD, _FIRST_WORD = f"lower(list_extract(regexp_extract_all(b, '{_WORD}'), -1))", f"lower(list_extract(regexp_extract_all(a, '{_WORD}'), 1))"
_REPEATED = f"{_LAST_WORD} = {_FIRST_WORD} AND {_LAST_WORD} IN ('a', 'also', 'an', 'and', 'he', 'i', 'in', 'it', 'of', 'on', 'or', 'she', 'the', 'they', 'this', 'those', 'to', 'we', 'you')"
SQL["region_joins"] = f"""WITH {_LINES}, flat AS (SELECT *, {_SQ('text')} AS a FROM lines),
  pairs AS (SELECT *, lag(a) OVER w AS b, page - lag(page) OVER w AS gap, lag(zone) OVER w AS lz, lag(x0) OVER w AS lx0, lag(x1) OVER w AS lx1, lag(y1) OVER w AS ly1 FROM flat WINDOW w AS (PARTITION BY book ORDER BY page, ord))
  SELECT book, verdict, count(*) AS n FROM (SELECT book, CASE WHEN b IS NULL THEN 'first' WHEN a = '' OR b = '' THEN 'empty-fragment' WHEN gap NOT IN (0, 1) THEN 'page-gap'
    WHEN NOT {_PROSE('a')} OR NOT {_PROSE('b')} THEN 'non-prose-fragment' WHEN NOT (zone = lz OR abs(x0 - lx0) <= 60 OR abs(x1 - lx1) <= 120) THEN 'x-incompatible'
    WHEN NOT (CASE WHEN gap = 0 THEN y0 - ly1 BETWEEN -2 AND 28 ELSE ly1 >= 430 AND y0 <= 90 END) THEN 'y-incompatible'
    WHEN ends_with(b, '-') AND regexp_matches(a, '^[A-Za-z0-9]') THEN 'hyphen'
    WHEN {_REPEATED} AND ({_OPEN_END} OR {_GOES_ON}) THEN 'duplicate'
    WHEN {_OPEN_END} AND ({_GOES_ON} OR {_N('a')} <= 7 OR regexp_matches(a, '^["''“(\\[]')) THEN 'space' ELSE 'no-continuation-signal' END AS verdict FROM pairs) GROUP BY ALL"""


# passages


def _book_regions(spark, sf):
    """Sentences of a document as regions, twenty a page, some of which become anchors, notes or unfinished ones."""
    # books are dealt whole, before they are cut, so their many fragments stay where they are made
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("book"), "text").repartition("book")
    found = docs.select("book", F.posexplode(F.regexp_extract_all("text", F.lit(r"[^.!?\n]+[.!?]?"), F.lit(0))).alias("i", "t"))
    i, t, no = F.col("i"), F.trim(F.regexp_replace("t", r"^[-*•\s]+", "")), (F.floor(F.col("i") / 17) + 1).cast("string")
    text = (
        F.when(i % 17 == 3, F.concat(no, F.lit("a) "), t)).when(i % 17 == 9, F.concat(no, F.lit("b)"))).when(i % 23 == 7, F.concat(F.lit("["), i.cast("string"), F.lit("]")))
        .when(i % 29 == 11, F.concat(t, F.lit(" "), i.cast("string"), F.lit("c) "), t)).when(i % 3 == 0, F.regexp_replace(t, "[.!?]$", "")).otherwise(t)
    )
    zone = F.when(i % 5 == 4, "right").when(i % 7 == 6, "left").otherwise("center")
    x0 = F.when(zone == "left", 50).when(zone == "right", 310).otherwise(180) + (i * 53 + F.col("book")) % 40
    y0 = 40 + i % 20 * 27 - F.when((i % 17).isin(4, 10), 19).otherwise(0)
    page = F.floor(i / 20).cast("int")
    return found.select(
        "book", page.alias("page"), F.concat(F.lit("p"), page.cast("string")).alias("page_label"), i.alias("ord"), F.when(i % 31 == 30, "aside").otherwise("main").alias("role"), zone.alias("zone"),
        F.lit("simple").alias("layout_kind"), F.when(page % 9 == 8, "table").otherwise("prose").alias("content_mode"), text.alias("text"),
        x0.cast("double").alias("x0"), y0.cast("double").alias("y0"), (x0 + 120).cast("double").alias("x1"), (y0 + 12).cast("double").alias("y1"),
    )


@query
def passage_buckets(spark, sf):
    """Each fragment of a book with its passage and bucket, by the machine over all pages."""
    found = G.bucketed(G.flatten(_book_regions(spark, sf)))
    return found.select("book", "page", "ord", "frag", "passage", "label", "bucket", "inherited", "attach", "join_mode")


_REASON = f"""CASE WHEN NOT note AND NOT is_anchor AND n_y0 - y0 <= 18 AND {_N('a')} <= 10 AND NOT regexp_matches(a, '[.!?][\"”'')\\]]?$')
    THEN CASE WHEN ord = n_ord THEN 'embedded-anchor-fragment' WHEN zone <> n_zone THEN 'cross-zone-next-anchor' WHEN regexp_matches(n_text, '(?i)^([-*]\\s*)?[0-9]+[a-z]\\)\\s*$') THEN 'marker-only-next-anchor' END END"""
SQL["passage_buckets"] = f"""WITH RECURSIVE src AS (SELECT doc_id AS book, unnest(s) AS t, unnest(range(len(s)))::INT AS i FROM (SELECT doc_id, regexp_extract_all(text, '[^.!?\\n]+[.!?]?') AS s FROM documents)),
  named AS (SELECT book, i, trim(regexp_replace(t, '^[-*•\\s]+', '')) AS t, i // 17 + 1 AS no, i // 20 AS page, CASE WHEN i % 5 = 4 THEN 'right' WHEN i % 7 = 6 THEN 'left' ELSE 'center' END AS zone FROM src),
  regions AS (SELECT book, page, i AS ord, CASE WHEN i % 31 = 30 THEN 'aside' ELSE 'main' END AS role, zone, CASE WHEN page % 9 = 8 THEN 'table' ELSE 'prose' END AS content_mode,
    CASE WHEN i % 17 = 3 THEN no || 'a) ' || t WHEN i % 17 = 9 THEN no || 'b)' WHEN i % 23 = 7 THEN '[' || i || ']' WHEN i % 29 = 11 THEN t || ' ' || i || 'c) ' || t WHEN i % 3 = 0 THEN regexp_replace(t, '[.!?]$', '') ELSE t END AS text,
    (CASE zone WHEN 'left' THEN 50 WHEN 'right' THEN 310 ELSE 180 END + (i * 53 + book) % 40)::DOUBLE AS x0, (40 + i % 20 * 27 - CASE WHEN i % 17 IN (4, 10) THEN 19 ELSE 0 END)::DOUBLE AS y0 FROM named),
  pieces AS (SELECT *, string_split(regexp_replace({_SQ("regexp_replace(trim(text), '^[-*•]\\s*', '')")}, '\\s([0-9]+[A-Za-z]\\))', chr(1) || '\\1', 'g'), chr(1)) AS cut FROM regions),
  frags AS (SELECT book, page, ord, role, zone, content_mode, x0, y0, trim(unnest(cut)) AS a, unnest(range(len(cut)))::INT AS frag FROM pieces),
  f AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY page, ord, frag) AS n, regexp_matches(a, '(?i)^([-*]\\s*)?[0-9]+[a-z]\\)') AS is_anchor, {_NOTE('a')} AS note,
    lower(regexp_extract(a, '(?i)^([-*]\\s*)?([0-9]+[a-z])\\)', 2)) AS own_label, {_SQ("regexp_extract(a, '(?i)^([-*]\\s*)?[0-9]+[a-z]\\)\\s*(.*)$', 2)")} AS rest FROM frags WHERE a <> ''),
  seeds AS (SELECT *, is_anchor AND NOT (rest = '' OR regexp_matches(rest, '^\\[[^\\]]*\\]$') OR regexp_matches(rest, '^(Levinas|Derrida)\\s+\\S+\\s+\\S+$')
      OR (length(rest) <= 42 AND regexp_matches(rest, '^([A-Z][A-Za-z]+(\\s+[A-Z][A-Za-z0-9.]+){{0,4}}|(Levinas|Derrida)\\b.*)$'))) AS seeded FROM f),
  near AS (SELECT *, lead(n) OVER p AS n2, first_value(CASE WHEN is_anchor THEN own_label END IGNORE NULLS) OVER (PARTITION BY book, page ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS page_anchor,
      coalesce(bool_or(is_anchor) OVER (PARTITION BY book, page ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS seen,
      first_value(CASE WHEN is_anchor THEN {{'y0': y0, 'zone': zone, 'ord': ord, 'a': a}} END IGNORE NULLS) OVER (PARTITION BY book, page ORDER BY n ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nx,
      lag({{'page': page, 'zone': zone, 'x0': x0, 'y0': y0, 'a': a, 'note': note, 'mode': content_mode, 'is_anchor': is_anchor}}) OVER p AS pv FROM seeds WINDOW p AS (PARTITION BY book ORDER BY n)),
  ties AS (SELECT *, nx.y0 AS n_y0, nx.zone AS n_zone, nx.ord AS n_ord, nx.a AS n_text, pv.a AS b,
      coalesce(pv.page = page AND y0 >= 520 AND y0 - (pv.y0 + 12) <= 20 AND (pv.zone = zone OR (abs(pv.x0 - x0) <= 18) ), false) AS tied FROM near),
  runs AS (SELECT *, sum((NOT tied)::INT) OVER (PARTITION BY book, page ORDER BY n ROWS UNBOUNDED PRECEDING) AS run FROM ties),
  facts AS (SELECT *, tied AND coalesce(bool_or(note AND y0 >= 520) OVER (PARTITION BY book, page, run ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS note_goes, {_REASON} AS attach,
      CASE WHEN NOT is_anchor AND NOT pv.is_anchor AND NOT note AND NOT pv.note AND content_mode = 'prose' AND pv.mode = 'prose' AND (zone = pv.zone OR abs(x0 - pv.x0) <= 60 OR abs((x0 + 120) - (pv.x0 + 120)) <= 120)
          AND CASE page - pv.page WHEN 0 THEN y0 - (pv.y0 + 12) BETWEEN -2 AND 28 WHEN 1 THEN pv.y0 + 12 >= 430 AND y0 <= 90 ELSE false END
        THEN CASE WHEN ends_with(b, '-') AND regexp_matches(a, '^[A-Za-z0-9]') THEN 'hyphen' WHEN {_REPEATED} AND ({_OPEN_END} OR {_GOES_ON}) THEN 'duplicate' WHEN {_OPEN_END} AND ({_GOES_ON} OR {_N('a')} <= 7) THEN 'space' END END AS join_mode FROM runs),
  stops AS (SELECT x.book, x.n, min(y.n) FILTER (y.is_anchor OR y.y0 - x.y0 > 12) AS stop FROM facts x JOIN facts y ON x.book = y.book AND x.page = y.page AND y.n > x.n WHERE x.is_anchor AND x.zone = 'center' AND NOT x.seeded GROUP BY ALL),
  cited AS (SELECT x.book, x.n, arg_min(y.zone, y.n) AS zone FROM facts x JOIN stops USING (book, n) JOIN facts y ON x.book = y.book AND x.page = y.page AND y.n > x.n AND y.n < coalesce(stop, y.n + 1) AND y.zone <> x.zone AND NOT y.note GROUP BY ALL),
  anchors AS (SELECT f.book, f.n, own_label AS label, seeded, CASE WHEN f.zone = 'center' AND NOT seeded THEN coalesce(c.zone, f.zone) ELSE f.zone END AS czone, row_number() OVER (PARTITION BY f.book ORDER BY f.n) AS passage FROM facts f LEFT JOIN cited c USING (book, n) WHERE is_anchor),
  upto AS (SELECT *, sum(is_anchor::INT) OVER (PARTITION BY book ORDER BY n ROWS UNBOUNDED PRECEDING) + (attach IS NOT NULL)::INT AS passage FROM facts),
  placed AS (SELECT u.*, p.label AS label, p.czone, row_number() OVER (PARTITION BY u.book ORDER BY u.passage, CASE WHEN is_anchor THEN 0 WHEN attach IS NOT NULL THEN 1 ELSE 2 END, u.n) AS m FROM upto u LEFT JOIN anchors p ON p.book = u.book AND p.passage = u.passage),
  ready AS (SELECT *, CASE WHEN note OR note_goes THEN 'reference' WHEN label IS NULL THEN CASE WHEN role = 'main' THEN 'commentary' ELSE 'reference' END
      WHEN page_anchor IS NOT NULL AND NOT seen AND page_anchor <> label THEN 'commentary' WHEN zone = czone THEN 'citation' ELSE 'commentary' END AS plain, label IS NOT NULL AND zone = 'center' AND {_N('a')} <= 4 AND NOT note AS lead FROM placed),
  machine(book, m, bucket, inherited, cit, ref) AS (
    SELECT book, 0::BIGINT, NULL::VARCHAR, false, false, false FROM (SELECT DISTINCT book FROM ready)
    UNION ALL
    SELECT r.book, r.m, nb, NOT r.is_anchor AND r.join_mode IS NOT NULL AND s.bucket IS NOT NULL, CASE WHEN r.is_anchor THEN r.seeded ELSE s.cit OR nb = 'citation' END, CASE WHEN r.is_anchor THEN false ELSE s.ref OR nb = 'reference' END
    FROM (SELECT s.*, r.m AS next_m, CASE WHEN r.is_anchor THEN CASE WHEN r.seeded THEN 'citation' END WHEN r.attach IS NOT NULL THEN 'commentary' WHEN r.join_mode IS NOT NULL AND s.bucket IS NOT NULL THEN s.bucket
        WHEN r.lead AND NOT s.cit AND NOT s.ref THEN 'citation' ELSE r.plain END AS nb FROM machine s JOIN ready r ON r.book = s.book AND r.m = s.m + 1) s JOIN ready r ON r.book = s.book AND r.m = s.next_m)
  SELECT book, page, ord, frag, passage::BIGINT AS passage, label, bucket, inherited, attach, join_mode FROM machine JOIN ready USING (book, m)"""


@query
def passages_repaired(spark, sf):
    """Passages with commentary and bibliography where they belong.  No SQL: parts are joined by rules over texts; the tests fold in plain Python."""
    found = G.passages(_book_regions(spark, sf))
    digest = lambda c: F.sha2(F.array_join(c, "\u0001"), 256).alias(f"{c}_sha256")
    return found.select("book", "passage", "passage_id", "source_ref", *map(digest, G.BUCKETS), F.sha2(G.merged(F.col("commentary")), 256).alias("merged_sha256"), F.array_join("page_labels", ",").alias("page_labels"))


@query
def regions_repaired(spark, sf):
    """No SQL: what a region is joined to is itself joined already; the tests fold in plain Python."""
    found = C.repair_pages(_lines(spark, sf))
    return found.select("book", "page", "ord", "parts", "x0", "x1", "y0", "y1", F.sha2("text", 256).alias("text_sha256"))


@query
def note_lines(spark, sf):
    found = C.note_lines(_lines(spark, sf), C.reference_note(F.col("text")) | (F.length(squeeze(F.col("text"))) % 3 == 0))
    return found.groupBy("book").agg(F.count_if("seed").alias("seeds"), F.count_if("continues").alias("continued"))


SQL["note_lines"] = f"""WITH {_LINES}, flat AS (SELECT *, {_SQ('text')} AS a FROM lines),
  n AS (SELECT *, y0 >= 520 AND ((a <> '' AND ((length(a) <= 16 AND regexp_matches(a, '^[A-Z][A-Z .&/-]*$')) OR (length(a) <= 40 AND regexp_matches(a, '^[\\[\\]0-9A-Za-z .,/–—-]+$') AND regexp_matches(a, '[0-9]'))
      OR (length(a) <= 24 AND regexp_matches(a, '^\\[.*\\]$')))) OR length(a) % 3 = 0) AS seed,
    coalesce(((lag(zone) OVER w = zone) OR (abs(lag(x0) OVER w - x0) <= 18 AND abs(lag(x1) OVER w - x1) <= 48) OR (abs(lag(y0) OVER w - y0) <= 8 AND abs(lag(x0) OVER w - x0) <= 18 AND x1 - lag(x1) OVER w >= 120))
      AND y0 >= 520 AND y0 - lag(y1) OVER w <= 20, false) AS tied FROM flat WINDOW w AS (PARTITION BY book, page ORDER BY ord)),
  r AS (SELECT *, sum((NOT tied)::INT) OVER (PARTITION BY book, page ORDER BY ord ROWS UNBOUNDED PRECEDING) AS run FROM n),
  c AS (SELECT book, seed, tied AND coalesce(bool_or(seed) OVER (PARTITION BY book, page, run ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS goes FROM r)
  SELECT book, count(*) FILTER (seed) AS seeds, count(*) FILTER (goes) AS continued FROM c GROUP BY book"""


@query
def line_regions(spark, sf):
    """Lines of a page that follow each other, in columns that shift every fourth line."""
    i = F.col("ord")
    lines = _lines(spark, sf).select(F.concat_ws("/", "book", "page").alias("page"), i.alias("line_no"), F.lit("body").alias("role"), F.when(i % 11 == 10, "right").otherwise("center").alias("zone"), "text", (F.floor(i / 4) % 2 * 100.0).alias("x0"), "y0", (F.floor(i / 4) % 2 * 100.0 + 90).alias("x1"), "y1")
    return S.group_lines(lines).select("page", "island", "zone", "x0", "y0", "x1", "y1", F.sha2("text", 256).alias("text_sha256"))


SQL["line_regions"] = f"""WITH {_LINES}, p AS (SELECT book || '/' || page AS page, ord, text, CASE WHEN ord % 11 = 10 THEN 'right' ELSE 'center' END AS zone, ord // 4 % 2 * 100.0::DOUBLE AS x0, y0, ord // 4 % 2 * 100.0::DOUBLE + 90 AS x1, y1 FROM lines),
  b AS (SELECT *, CASE WHEN lag(zone) OVER w = zone AND y0 - lag(y1) OVER w <= 18 AND abs(x0 - lag(x0) OVER w) <= 36 THEN 0 ELSE 1 END AS s FROM p WINDOW w AS (PARTITION BY page ORDER BY ord)),
  g AS (SELECT *, (sum(s) OVER (PARTITION BY page ORDER BY ord ROWS UNBOUNDED PRECEDING))::BIGINT AS island FROM b)
  SELECT page, island, min(zone) AS zone, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, sha256(string_agg(text, chr(10) ORDER BY ord)) AS text_sha256 FROM g GROUP BY page, island"""


@query
def sliced_lines(spark, sf):
    """Lines within a slice of each book's first page; every third has no lower bound, every fourth no upper one."""
    lines = _lines(spark, sf).filter("page = 0").select(F.col("book").alias("page"), "y0", "text")
    book = F.col("doc_id")
    bound = lambda least, skip: F.when(book % skip != 0, (F.lit(least) + book % 7 * 28).cast("double"))
    slices = table(spark, sf, "documents").select(book.alias("entry_id"), book.alias("page"), bound(54, 3).alias("min_y"), bound(200, 4).alias("max_y"))
    return L.sliced(lines, slices).groupBy("entry_id").agg(F.count(F.lit(1)).alias("lines"), F.min("y0").alias("first_y"))


SQL["sliced_lines"] = f"""WITH {_LINES} SELECT book AS entry_id, count(*) AS lines, min(y0) AS first_y FROM lines
  WHERE page = 0 AND (book % 3 = 0 OR y0 >= 54 + book % 7 * 28) AND (book % 4 = 0 OR y0 < 200 + book % 7 * 28) GROUP BY book"""


@query
def margin_lines(spark, sf):
    """Lines of a page that are running headers, by the third of the page in which they stand; every fourth line is in capitals, every seventh a number."""
    lines = _lines(spark, sf)
    i = F.col("ord")
    text = F.when(i % 7 == 3, F.concat(F.lit(" "), (i + 1).cast("string"))).when(i % 11 == 5, F.concat(F.lit("Chapter "), "text")).when(i % 2 == 1, F.substring("text", 1, 30)).otherwise(F.col("text"))
    placed = lines.select("book", text.alias("text"), (20.0 + (i * 7) % 30).alias("y0"), L.zone(F.col("x0") * 2, F.col("x0") * 2 + 20, F.lit(600.0)).alias("zone"))
    return placed.groupBy("book", "zone").agg(F.count_if(L.top_margin(F.col("text"), F.col("y0"))).alias("headers"), F.count(F.lit(1)).alias("lines"))


_TITLED = """CASE WHEN a = upper(a) AND a <> lower(a) THEN list_aggregate(list_transform(string_split(lower(a), ' '), lambda w, i: CASE WHEN i > 1 AND w IN ('a','an','and','as','at','for','in','of','on','or','the','to') THEN w
    ELSE upper(substr(w, 1, 1)) || substr(w, 2) END), 'string_agg', ' ') ELSE a END"""
SQL["margin_lines"] = f"""WITH {_LINES}, t AS (SELECT book, (20 + (ord * 7) % 30)::DOUBLE AS y0, (x0 * 2 + 10) / 600 AS m,
    {_SQ("CASE WHEN ord % 7 = 3 THEN ' ' || (ord + 1) WHEN ord % 11 = 5 THEN 'Chapter ' || text WHEN ord % 2 = 1 THEN substr(text, 1, 30) ELSE text END")} AS a FROM lines),
  h AS (SELECT book, CASE WHEN m <= 0.33 THEN 'left' WHEN m >= 0.67 THEN 'right' ELSE 'center' END AS zone, a <> '' AND CASE WHEN y0 < 30 THEN regexp_matches(a, '(?i)^([0-9]+|[ivxlcdm]+)$') OR length(a) <= 120 WHEN y0 > 42 THEN false
    WHEN regexp_matches(a, '(?i)^([0-9]+|[ivxlcdm]+)$') THEN true WHEN regexp_matches(a, '(?i)^(part|chapter|contents|translator''?s preface|preface)\\b') THEN {_N('a')} <= 10 ELSE {_N('a')} <= 8 AND a = {_TITLED} END AS header FROM t)
  SELECT book, zone, count(*) FILTER (header) AS headers, count(*) AS lines FROM h GROUP BY ALL"""


@query
def reading_order(spark, sf):
    """Lines that stand in seven rows of a page, read from top to bottom and left to right."""
    lines = _lines(spark, sf).select("book", "text", (F.col("ord") % 7 * 14.0).alias("y0"), "x0")
    ordered = L.reading_order(lines, "book")
    texts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), "\n")
    return ordered.groupBy("book").agg(F.sha2(texts, 256).alias("text_sha256"))


SQL["reading_order"] = f"WITH {_LINES} SELECT book, sha256(string_agg(text, chr(10) ORDER BY ord % 7, x0, encode(text))) AS text_sha256 FROM lines GROUP BY book"


# pages


@query
def heading_pages(spark, sf):
    """First lines of documents searched near a shifted page of the book that their language makes."""
    docs = table(spark, sf, "documents").filter("lang IS NOT NULL AND text IS NOT NULL")
    key = F.substring(P.key_of(F.substring_index("text", "\n", 1)), 1, 60)
    entries = docs.select(F.col("doc_id").alias("entry_id"), F.col("lang").alias("book"), key.alias("key"), (F.col("doc_id") + F.col("doc_id") % 25 - 12).alias("expected"))
    return P.heading_pages(entries, docs.select(F.col("lang").alias("book"), F.col("doc_id").alias("page"), "text"))


SQL["heading_pages"] = f"""WITH d AS (SELECT doc_id, lang, text, substr({_KEY('split_part(text, chr(10), 1)')}, 1, 60) AS key, doc_id + doc_id % 25 - 12 AS expected FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL),
  k AS MATERIALIZED (SELECT doc_id, lang, list_transform(list_filter(list_transform(string_split(text, chr(10)), lambda x: {_SQ('x')}), lambda x: x <> ''), lambda x: {_KEY('x')}) AS keys FROM d),
  s AS (SELECT d.doc_id AS entry_id, k.doc_id AS page, expected, CASE WHEN list_contains(keys, key) THEN 100 WHEN len(list_filter(keys, lambda x: contains(x, key))) > 0 THEN 85
      WHEN contains(array_to_string(keys[1:160], ''), key) THEN 70 END AS score FROM d JOIN k ON k.lang = d.lang AND k.doc_id BETWEEN expected - 12 AND expected + 12 WHERE key <> ''),
  b AS (SELECT * FROM s WHERE score IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entry_id ORDER BY score DESC, abs(page - expected), page) = 1)
  SELECT d.doc_id AS entry_id, coalesce(b.page, d.expected) AS page, b.score FROM d LEFT JOIN b ON b.entry_id = d.doc_id"""


@query
def contents_ranges(spark, sf):
    """Forty documents make a book.  Three pages in a row list entries, eight or, on one that names the contents, four; others have one too few, or follow later."""
    page, n = F.col("doc_id") % 40 + 1, F.floor(F.col("doc_id") / 40) % 5 + 3
    entry = F.lit("\nAn entry of the list 12")
    listed = (
        F.when(page == n, F.concat(F.lit("Contents"), F.repeat(entry, 4))).when(page.between(n + 1, n + 2) | (page == n + 6), F.repeat(entry, 8))
        .when(page == n - 1, F.concat(F.lit("Contents"), F.repeat(entry, 3))).when(page == n + 4, F.repeat(entry, 7)).otherwise("")
    )
    pages = table(spark, sf, "documents").select(F.floor(F.col("doc_id") / 40).alias("book"), page.alias("page"), F.concat_ws("\n", listed, F.regexp_replace("text", "[0-9]+", "")).alias("text"))
    return P.contents_range(pages)


SQL["contents_ranges"] = f"""WITH d AS (SELECT doc_id // 40 AS book, doc_id % 40 + 1 AS page, doc_id // 40 % 5 + 3 AS n, text, chr(10) || 'An entry of the list 12' AS e FROM documents),
  t AS (SELECT book, page, concat_ws(chr(10), CASE WHEN page = n THEN 'Contents' || repeat(e, 4) WHEN page BETWEEN n + 1 AND n + 2 OR page = n + 6 THEN repeat(e, 8) WHEN page = n - 1 THEN 'Contents' || repeat(e, 3)
    WHEN page = n + 4 THEN repeat(e, 7) ELSE '' END, regexp_replace(text, '[0-9]+', '', 'g')) AS text FROM d),
  c AS (SELECT *, len(list_filter(list_transform(string_split(text, chr(10)), lambda x: {_SQ('x')}), lambda x: regexp_matches(x, '(?i) ([ivxlcdm]+|[0-9]( ?[0-9]){{0,3}})$'))) AS k, contains({_KEY('text')}, 'contents') AS named FROM t),
  p AS (SELECT book, page FROM c WHERE page <= 40 AND (k >= 8 OR (named AND k >= 4))),
  r AS (SELECT book, min(page) AS first_page, max(page) AS last_page FROM (SELECT *, page - row_number() OVER (PARTITION BY book ORDER BY page) AS run FROM p) GROUP BY book, run)
  SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY book ORDER BY first_page) = 1"""


@query
def repaired_labels(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") * 37 % 500).alias("label"))
    return P.repaired_labels(orders, "o_custkey", "o_orderkey")


SQL["repaired_labels"] = """WITH RECURSIVE o AS MATERIALIZED (SELECT o_custkey, o_orderkey, o_orderkey * 37 % 500 AS label, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders),
  w AS (SELECT o_custkey, o_orderkey, label, i, label AS repaired FROM o WHERE i = 1
    UNION ALL SELECT o.o_custkey, o.o_orderkey, o.label, o.i, (o.label + ceil(greatest(w.repaired - o.label, 0)::DOUBLE / pow(10, greatest(length(w.repaired::VARCHAR) - 1, 1))) * pow(10, greatest(length(w.repaired::VARCHAR) - 1, 1)))::BIGINT
      FROM w JOIN o ON o.o_custkey = w.o_custkey AND o.i = w.i + 1)
  SELECT o_custkey, o_orderkey, label, repaired FROM w"""


@query
def numbered_paths(spark, sf):
    host = F.regexp_replace("url", r"^[a-z]+://([^/?#]*).*$", "$1")
    return P.numbered_paths(table(spark, sf, "pages").filter("url IS NOT NULL").select("page_id", host.alias("path")), "path", "page_id")


SQL["numbered_paths"] = """SELECT page_id, path, n AS ordinal, CASE WHEN n > 1 THEN path || '-' || n ELSE path END AS unique_path
  FROM (SELECT page_id, path, row_number() OVER (PARTITION BY path ORDER BY page_id) AS n FROM (SELECT page_id, regexp_replace(url, '^[a-z]+://([^/?#]*).*$', '\\1') AS path FROM pages WHERE url IS NOT NULL))"""


@query
def heading_suppressed(spark, sf):
    """Texts of pages without the title that they open with."""
    pages = table(spark, sf, "pages").select("page_id", html_field(F.col("html"), "title").alias("title"), html_text(F.col("html")).alias("text"))
    rest = P.without_heading(F.col("text"), F.col("title"))
    return pages.select("page_id", rest.isNull().alias("dropped"), F.coalesce(F.length(rest), F.lit(0)).cast("long").alias("chars"))


_HTML = _SQ("regexp_replace(regexp_replace(regexp_replace(html, '<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'gis'), '<[^>]*>', ' ', 'gs'), ' +', ' ', 'g')")
_TITLE = _SQ("regexp_replace(regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'is'), '<[^>]*>', ' ', 'gs')")
SQL["heading_suppressed"] = f"""WITH p AS (SELECT page_id, {_TITLE} AS t, {_HTML} AS x FROM pages),
  r AS (SELECT *, CASE WHEN {_KEY('x')} <> '' AND {_KEY('x')} = {_KEY('t')} THEN NULL WHEN t <> '' AND starts_with(lower(x), lower(t)) THEN nullif(regexp_replace(substr(x, length(t) + 1), '^[ .:;,!?)\\]}}"''’\\[-]+', ''), '') ELSE x END AS rest FROM p)
  SELECT page_id, rest IS NULL AS dropped, coalesce(length(rest), 0) AS chars FROM r"""


@query
def page_interpolation(spark, sf):
    """Each customer is a book: its orders give the observations, and every seventh page is wanted."""
    by = F.row_number().over(S.Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("book"), "o_orderkey", by.alias("n"))
    chain = orders.select("book", (F.col("n") * 11 + F.col("o_orderkey") % 6).cast("int").alias("pdf_page"), (F.col("n") * 9 + F.col("o_orderkey") % 5).cast("int").alias("book_page"))
    wanted = orders.select("book").distinct().select("book", F.explode(F.sequence(F.lit(1), F.lit(120), F.lit(7))).alias("book_page"))
    return S.interpolate_pages(chain, wanted, 150)


SQL["page_interpolation"] = """WITH c AS (SELECT o_custkey AS book, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, o_orderkey FROM orders),
  o AS (SELECT book, n * 11 + o_orderkey % 6 AS p, n * 9 + o_orderkey % 5 AS b FROM c),
  s AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY b) AS i, count(*) OVER (PARTITION BY book) AS k FROM (SELECT book, b, p, lead(b) OVER w AS nb, lead(p) OVER w AS np FROM o WINDOW w AS (PARTITION BY book ORDER BY b)) WHERE nb IS NOT NULL),
  q AS (SELECT DISTINCT book, unnest(range(1, 121, 7)) AS w FROM c)
  SELECT q.book, w::INT AS book_page, greatest(1, least(150, min_by(round_even(p + (w - b) * (np - p)::DOUBLE / greatest(nb - b, 1), 0), i)::INT)) AS pdf_page
  FROM q JOIN s ON q.book = s.book AND (w BETWEEN b AND nb OR (i = 1 AND w < b) OR (i = k AND w > nb)) GROUP BY q.book, w"""


# projections


@query
def embedding_projection(spark, sf):
    """Texts among headings, metadata and notes that aren't embedded, and their first lines as supplements."""
    docs = table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    markdown = F.concat(F.lit("# Title\nContext: x\nSource pages: 3\n"), F.regexp_replace("text", "\n", "\n- "), F.lit("\n_Source page 2_\n<!-- note -->\nTable-like content from source page 3"))
    parts = docs.select("doc_id", J.embedding_text(markdown).alias("body"), squeeze(F.substring_index("text", "\n", 1)).alias("supplement"))
    return J.projection_facts(parts, F.col("body"), F.col("supplement")).withColumn("body_sha256", F.sha2("body", 256)).drop("body", "supplement")


_EMBEDDED = f"""list_aggregate(list_transform(list_filter(list_transform(string_split(replace(coalesce(text, ''), chr(10), chr(10) || '- '), chr(10)), lambda x: {_SQ('x')}),
    lambda x: x <> '' AND NOT regexp_matches(x, '^(<!--.*-->|_Source page .*_|#{{1,6}} .*|({'|'.join([*J.METADATA, *J.MATERIAL])}).*)$')), lambda x: regexp_replace(x, '^- ', '')), 'string_agg', ' ')"""
_SUPPLEMENT = _SQ("split_part(coalesce(text, ''), chr(10), 1)")
SQL["embedding_projection"] = f"""WITH p AS (SELECT doc_id, coalesce({_SQ(_EMBEDDED)}, '') AS body, {_SUPPLEMENT} AS sup FROM documents),
  s AS (SELECT *, CASE WHEN sup = '' THEN 0 ELSE length(sup)::DOUBLE / greatest(length(body), 1) END AS share FROM p)
  SELECT doc_id, length(body) AS body_chars, length(sup) AS supplement_chars, len(regexp_extract_all(body, '[A-Za-z0-9]+')) AS body_tokens, len(regexp_extract_all(sup, '[A-Za-z0-9]+')) AS supplement_tokens,
    round(share, 6) AS supplement_ratio, sup <> '' AND share <= 0.25 AS supplement_shown, CASE WHEN sup <> '' AND share <= 0.25 THEN least(length(sup), 180) ELSE 0 END AS preview_chars, sha256(body) AS body_sha256 FROM s"""


@query
def embedded_views(spark, sf):
    """Both views of documents, with first lines as titles and last lines as supplements."""
    docs = table(spark, sf, "documents")
    args = [F.substring_index("text", "\n", 1), F.col("source"), F.lit("section"), F.col("text"), F.substring_index("text", "\n", -1)]
    view = lambda name, **kw: F.sha2(J.embedded_view(name, *args, **kw), 256)
    return docs.select("doc_id", view("body").alias("body"), view("contextual").alias("contextual"), view("contextual", normalised=False).alias("raw"))


_CUT = lambda x, n: f"CASE WHEN length({x}) <= {n} THEN {x} ELSE trim(regexp_replace(substr({x}, 1, {n}), ' [^ ]*$', '')) END"
_JOIN_PARTS = lambda side: f"array_to_string(list_filter([title, coalesce(source, ''), 'section', {_CUT('body', 1600)}, CASE WHEN {side} <> '' THEN 'Supplement: ' || {side} ELSE '' END], lambda x: x <> ''), chr(10) || chr(10))"
SQL["embedded_views"] = f"""WITH t AS (SELECT doc_id, source, {_SQ("split_part(coalesce(text, ''), chr(10), 1)")} AS title, {_SQ("coalesce(text, '')")} AS body, {_SQ("split_part(coalesce(text, ''), chr(10), -1)")} AS sup FROM documents),
  s AS (SELECT *, CASE WHEN length(sup) <= greatest(length(body), 1) * 0.25 THEN {_CUT('sup', 180)} ELSE '' END AS small, {_CUT('sup', 400)} AS large FROM t)
  SELECT doc_id, sha256(body) AS body, sha256({_JOIN_PARTS('small')}) AS contextual, sha256({_JOIN_PARTS('large')}) AS raw FROM s"""


@query
def projection_collisions(spark, sf):
    return J.collisions(table(spark, sf, "documents").filter("text IS NOT NULL"), J.embedding_text(F.col("text")), "lang")


SQL["projection_collisions"] = f"""WITH p AS (SELECT lang, coalesce({_SQ(_EMBEDDED.replace("replace(coalesce(text, ''), chr(10), chr(10) || '- ')", "text"))}, '') AS body FROM documents WHERE text IS NOT NULL)
  SELECT lang, count(*) AS texts, sum(CASE WHEN n > 1 THEN n ELSE 0 END)::BIGINT AS colliding FROM (SELECT lang, body, count(*) AS n FROM p GROUP BY ALL) GROUP BY lang"""


def _mismatches(spark, sf):
    v = F.col("vec_id")
    part = lambda i: F.round(F.col("embedding")[i].cast("double"), 2) + 0.0
    return table(spark, sf, "embeddings").select("label", "vec_id", (v % 3 != 0).cast("double").alias("hit_at_1"), (1.0 / (1 + v % 4)).alias("rr"), F.when(v % 7 != 0, part(0)).alias("margin"), part(1).alias("cosine"))


@query
def worst_mismatches(spark, sf):
    return J.worst_mismatches(_mismatches(spark, sf), "label", "vec_id")


SQL["worst_mismatches"] = """WITH m AS (SELECT label, vec_id, (vec_id % 3 <> 0)::INT::DOUBLE AS hit_at_1, 1.0::DOUBLE / (1 + vec_id % 4) AS rr, CASE WHEN vec_id % 7 <> 0 THEN round(embedding[1]::DOUBLE, 2) + 0.0 END AS margin, round(embedding[2]::DOUBLE, 2) + 0.0 AS cosine FROM embeddings)
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY hit_at_1, rr, margin NULLS LAST, cosine, vec_id) AS rank FROM m QUALIFY rank <= 10"""


@query
def label_centroids(spark, sf):
    rounded = table(spark, sf, "embeddings").select("label", F.transform("embedding", lambda x: F.round(x.cast("decimal(20,4)"), 3)).alias("embedding"))
    return J.centroids(rounded, "label").withColumn("mean", F.round("mean", 4))


SQL["label_centroids"] = """SELECT label, (i - 1)::INT AS dim, round(round(avg(x::DOUBLE), 6), 4) AS mean
  FROM (SELECT label, unnest(list_transform(embedding, lambda e: round(e::DECIMAL(20,4), 3))) AS x, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY label, i"""


# probes, audits, manifests


@query
def probe_blocks(spark, sf):
    """Turns as commentary, without their first letters and last words; every ninth conversation is no prose, pages of others are sliced."""
    turn = table(spark, sf, "conversations").filter("role <> 'user'")
    mode = F.when(F.col("conv_id") % 9 == 8, "table").otherwise("prose")
    found = Q.probe_blocks(turn.select(F.col("conv_id").alias("id"), F.col("turn").alias("ord"), F.concat(F.lit("<!-- p\n1 -->"), F.regexp_replace(F.substring("text", 2, 10**6), "[^ ]+ *$", ""), F.when(F.col("conv_id") % 13 == 0, "-").otherwise("")).alias("text"), mode.alias("mode"), (F.col("conv_id") % 4 == 0).alias("sliced_start"), (F.col("conv_id") % 5 == 0).alias("sliced_end")))
    return found.select("id", "ord", "code", F.sha2("snippet", 256).alias("snippet_sha256"))


SQL["probe_blocks"] = f"""WITH t AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord) = 1 AS f, row_number() OVER (PARTITION BY id ORDER BY ord DESC) = 1 AS l
    FROM (SELECT conv_id AS id, turn AS ord, {_SQ("coalesce(regexp_replace(substr(text, 2), '[^ ]+ *$', '') || CASE WHEN conv_id % 13 = 0 THEN '-' ELSE '' END, '')")} AS b FROM conversations WHERE role <> 'user')),
  p AS (SELECT *, sha256(substr(b, 1, 180)) AS opening, sha256(substr(b, greatest(length(b) - 179, 1))) AS closing FROM t WHERE b <> '' AND id % 9 <> 8)
  SELECT id, ord, 'block_lowercase_start' AS code, opening AS snippet_sha256 FROM p WHERE f AND id % 4 <> 0 AND regexp_matches(substr(regexp_extract(b, '([A-Za-z]+)', 1), 1, 1), '^[a-z]$')
  UNION ALL SELECT id, ord, 'block_hyphen_end', closing FROM p WHERE l AND id % 5 <> 0 AND ends_with(b, '-')
  UNION ALL SELECT id, ord, 'block_dangling_end', closing FROM p WHERE l AND id % 5 <> 0 AND NOT ends_with(b, '-') AND NOT regexp_matches(b, '[.!?:"”'')\\]]$')
    AND list_extract(regexp_extract_all(lower(b), '[a-z]+'), -1) IN ({', '.join(f"'{w}'" for w in DANGLING)})"""


@query
def capped_issue_counts(spark, sf):
    """The first 200 issues in order of their places, counted by code."""
    return Q.first_issues(probe_blocks(spark, sf), 200, "id", "ord", "code").groupBy("code").agg(F.count(F.lit(1)).alias("n"))


SQL["capped_issue_counts"] = f"SELECT code, count(*) AS n FROM (SELECT code FROM ({SQL['probe_blocks']}) ORDER BY id, ord, code LIMIT 200) GROUP BY code"


@query
def intentional_boundaries(spark, sf):
    """Orders of a customer a day apart as ranges of pages; odd ones are sliced at their ends, every third at its start."""
    orders = table(spark, sf, "orders")
    by = S.Window.partitionBy("o_custkey").orderBy("o_orderkey")
    n = F.row_number().over(by) * 3
    ranges = orders.select("o_custkey", F.col("o_orderkey").alias("id"), n.alias("start"), (n + 3).alias("end"))
    overlaps = Q.adjacent_overlaps(ranges, "o_custkey")
    ids = orders.select(F.col("o_orderkey").alias("id"))
    return Q.intentional_boundaries(overlaps, ids.filter("id % 2 = 1"), ids.filter("id % 3 = 0")).select("o_custkey", "left_id", "right_id")


SQL["intentional_boundaries"] = """SELECT o_custkey, l AS left_id, r AS right_id FROM (SELECT o_custkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS l, o_orderkey AS r FROM orders) WHERE l % 2 = 1 AND r % 3 = 0"""


def _manifest(spark, sf):
    page = F.col("page_id")
    return table(spark, sf, "pages").select(page, F.concat(F.lit("p/"), page).alias("output"), F.col("url").alias("flat"), F.regexp_replace("url", r"^[a-z]+://([^/?#]*).*$", "$1").alias("rag"), F.concat(F.lit("s/"), page % 50).alias("spatial"))


@query
def entries_by_path(spark, sf):
    return Q.entries_by_path(_manifest(spark, sf).withColumn("ord", F.col("page_id")), ["output", "flat", "rag", "spatial"], "page_id", "ord")


SQL["entries_by_path"] = """WITH e AS (SELECT page_id, 0 AS i, 'output' AS "column", 'p/' || page_id AS path FROM pages UNION ALL SELECT page_id, 1, 'flat', url FROM pages
  UNION ALL SELECT page_id, 2, 'rag', regexp_replace(url, '^[a-z]+://([^/?#]*).*$', '\\1') FROM pages UNION ALL SELECT page_id, 3, 'spatial', 's/' || page_id % 50 FROM pages)
  SELECT path, page_id, "column" FROM e WHERE path <> '' QUALIFY row_number() OVER (PARTITION BY path ORDER BY page_id, i) = 1"""


@query
def leaf_entries(spark, sf):
    kinds = ["frontmatter", "part", "chapter", "section", "epilogue", "index", "auxiliary"]
    kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("doc_id") % 7 + 1).cast("int"))
    docs = table(spark, sf, "documents").select("doc_id", kind.alias("kind"), F.concat_ws("/", "lang", "source", "doc_id").alias("path"))
    return Q.leaf_entries(docs, "1")


SQL["leaf_entries"] = """SELECT * FROM (SELECT doc_id, ['frontmatter', 'part', 'chapter', 'section', 'epilogue', 'index', 'auxiliary'][doc_id % 7 + 1] AS kind, concat_ws('/', lang, source, doc_id) AS path FROM documents)
  WHERE kind NOT IN ('part', 'chapter') AND contains(path, '1')"""


@query
def conditional_means(spark, sf):
    return Q.means_where(table(spark, sf, "events").withColumn("shard", F.col("user_id") % 10), "shard", "value", F.col("event_type") == "purchase")


SQL["conditional_means"] = """SELECT user_id % 10 AS shard, count(value) AS n, round(avg(value), 4) AS mean, count(value) FILTER (event_type = 'purchase') AS n_where, round(avg(value) FILTER (event_type = 'purchase'), 4) AS mean_where FROM events GROUP BY 1"""


@query
def first_seen_types(spark, sf):
    return Q.first_seen(table(spark, sf, "events"), "user_id", "event_id", "event_type")


SQL["first_seen_types"] = """SELECT user_id, string_agg(event_type, ' ' ORDER BY first) AS seen FROM (SELECT user_id, event_type, min(event_id) AS first FROM events WHERE event_type IS NOT NULL GROUP BY ALL) GROUP BY user_id"""


@query
def key_union(spark, sf):
    """Keys that either of two counters has."""
    a, b = table(spark, sf, "customer").select(F.col("c_nationkey").alias("key")), table(spark, sf, "supplier").select(F.col("s_nationkey").alias("key"))
    return a.distinct().union(b.distinct()).distinct()


SQL["key_union"] = "SELECT c_nationkey AS key FROM customer UNION SELECT s_nationkey FROM supplier"


@query
def folder_digests(spark, sf):
    turns = table(spark, sf, "conversations").withColumn("path", F.concat(F.lpad(F.col("turn").cast("string"), 4, "0"), F.lit(".md")))
    return Q.folder_digests(turns, "conv_id", "path", "text")


SQL["folder_digests"] = """SELECT conv_id, count(*) AS n_files, sha256(string_agg(lpad(turn::VARCHAR, 4, '0') || '.md' || chr(0) || coalesce(text, '') || chr(0), '' ORDER BY turn)) AS sha256 FROM conversations GROUP BY conv_id"""
