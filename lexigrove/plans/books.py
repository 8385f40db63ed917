"""Queries over books that are made of the tables: page numbers, entries, spans, headings and outlines, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexigrove.operators import credits as K
from lexigrove.operators import outline as O
from lexigrove.operators import page_map as M
from lexigrove.operators import spans as N
from lexigrove.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


# pages


def _blocks(spark, sf):
    """A hundred documents are a book; a page's number is twelve below its place, but for some pages and every third book."""
    i, page = F.col("doc_id"), (F.col("doc_id") % 100 + 1).cast("int")
    book = F.floor(i / 100).cast("int")
    number = F.when((i % 13 == 5) | ((book % 3 == 2) & (i % 4 != 0)), page - i % 11).otherwise(page - 12)
    text = F.when(i % 17 == 3, F.substring(F.coalesce("text", F.lit("")), 1, 30)).when(i % 19 == 4, F.concat(number.cast("string"), F.lit("\n"), number.cast("string"))).otherwise(F.concat(F.lit(" "), number.cast("string")))
    blocks = table(spark, sf, "documents").select(
        book.alias("book"), page.alias("pdf_page"), text.alias("text"), (i % 7 * 90.0).alias("x0"), (i % 5 * 40.0).alias("y0"), (i % 7 * 90.0 + 20).alias("x1"), (i % 5 * 40.0 + 12).alias("y1"),
        F.lit(600.0).alias("width"), F.lit(800.0).alias("height"), F.lit(100).alias("page_count"),
    )
    return blocks


@query
def margin_numbers(spark, sf):
    return M.margin_numbers(_blocks(spark, sf))


_NUMBERS = """blocks AS (SELECT doc_id // 100 AS book, doc_id % 100 + 1 AS pdf_page, doc_id, (doc_id % 7 * 90)::DOUBLE AS x0, (doc_id % 5 * 40)::DOUBLE AS y0,
    CASE WHEN doc_id % 13 = 5 OR (doc_id // 100 % 3 = 2 AND doc_id % 4 <> 0) THEN doc_id % 100 + 1 - doc_id % 11 ELSE doc_id % 100 - 11 END AS number, text FROM documents),
  lines AS (SELECT *, CASE WHEN doc_id % 17 = 3 THEN trim(substr(coalesce(text, ''), 1, 30)) WHEN doc_id % 19 = 4 THEN number || chr(10) || number ELSE number::VARCHAR END AS line FROM blocks),
  fits AS (SELECT book, pdf_page, line::INT AS book_page, x0 <= 144 OR x0 + 20 >= 456 AS outside FROM lines WHERE regexp_full_match(line, '[0-9]{1,3}') AND (y0 <= 82 OR y0 + 12 >= 718) AND line::INT BETWEEN 1 AND 100),
  numbers AS (SELECT book, pdf_page, book_page, outside FROM (SELECT *, bool_or(outside) OVER (PARTITION BY book, pdf_page) AS has_outer FROM fits) WHERE outside = has_outer)"""
SQL["margin_numbers"] = f'WITH {_NUMBERS} SELECT book::INT AS book, pdf_page::INT AS pdf_page, book_page, outside AS "outer" FROM numbers'


@query
def page_strategies(spark, sf):
    return M.mapping_strategy(M.margin_numbers(_blocks(spark, sf)))[0].select("book", "mode", "offset", "count", "second_count", "total", "confidence")


SQL["page_strategies"] = f"""WITH {_NUMBERS}, votes AS (SELECT book, pdf_page - book_page AS shift, count(*) AS n FROM numbers WHERE book_page > 2 GROUP BY ALL),
  ranked AS (SELECT *, row_number() OVER w AS place, coalesce(lead(n) OVER w, 0) AS next_n, sum(n) OVER (PARTITION BY book) AS total FROM votes WINDOW w AS (PARTITION BY book ORDER BY n DESC, shift))
  SELECT b.book::INT AS book, CASE WHEN n >= 25 AND n / total >= 0.85 AND n >= greatest(10, next_n * 4) THEN 'global_offset' ELSE 'observation_interpolation' END AS mode,
    shift::INT AS offset, n AS count, next_n AS second_count, total::BIGINT AS total, round(n / total, 4) AS confidence FROM (SELECT DISTINCT book FROM numbers) b LEFT JOIN ranked r ON r.book = b.book AND place = 1"""


@query
def label_pages(spark, sf):
    """File pages of the book pages 1, 8, 15 ... of each book.  No SQL: the longest chain of numbers is found by a search over pairs; the tests have cases."""
    numbers = M.margin_numbers(_blocks(spark, sf))
    strategy, observations = M.mapping_strategy(numbers)
    wanted = numbers.select("book").distinct().select("book", F.explode(F.sequence(F.lit(1), F.lit(99), F.lit(7))).alias("book_page"))
    return M.mapped_pages(strategy, observations, wanted, 100)


@query
def entries_aligned(spark, sf):
    """First lines of every fifth document, searched near a shifted page of a book of fifty.  No SQL: the tests search exhaustively."""
    docs = table(spark, sf, "documents").select(F.floor(F.col("doc_id") / 50).cast("int").alias("book"), (F.col("doc_id") % 50 + 1).cast("int").alias("page"), "doc_id", "text")
    shifted = F.greatest(F.lit(1), F.col("page") + (F.col("doc_id") * 7 % 9).cast("int") - 4)
    title = F.substring(F.substring_index("text", "\n", 1), 1, 60)
    entries = docs.filter("doc_id % 5 = 0").select("book", F.col("page").alias("seq"), F.when(F.col("doc_id") % 45 == 0, "part").otherwise("chapter").alias("kind"), title.alias("title"), F.when(F.col("doc_id") % 35 != 0, shifted).alias("expected"))
    return M.aligned_entries(entries, docs.select("book", "page", "text"))


# lines


def _spans(spark, sf):
    """Pieces of six words of each line of a document, one behind the other, some of them off the baseline or apart."""
    lines = table(spark, sf, "documents").select(F.col("doc_id").alias("book"), F.posexplode(F.split("text", "\n")).alias("page", "t"))
    words = F.filter(F.split("t", " "), lambda w: w != "")
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / 6).cast("int")), lambda k: F.array_join(F.slice("w", k * 6 + 1, 6), " "))
    spans = lines.withColumn("w", words).filter(F.size("w") > 0).select("book", "page", F.posexplode(pieces).alias("ord", "text"))
    k = F.col("ord")
    text = F.when(k % 7 == 3, F.concat("text", F.lit("-"))).when(k % 11 == 5, F.concat(F.lit("X "), "text")).otherwise(F.col("text"))
    x0 = k * 50 + F.when(k % 13 == 9, 30).otherwise(0)
    return spans.select("book", "page", "ord", text.alias("text"), x0.cast("double").alias("x0"), (100.0 + k % 9 * 0.5).alias("y0"), (x0 + 40).cast("double").alias("x1"), (112.0 + k % 5 * 0.5).alias("y1"))


@query
def spans_collapsed(spark, sf):
    found = N.collapsed(_spans(spark, sf))
    return found.select("book", F.col("page").cast("long").alias("page"), "ord", "x0", "y0", "x1", "y1", F.col("spans").cast("long").alias("spans"), F.sha2("text", 256).alias("text_sha256"))


SQL["spans_collapsed"] = r"""WITH RECURSIVE ls AS (SELECT doc_id AS book, unnest(string_split(text, chr(10))) AS t, unnest(range(len(string_split(text, chr(10))))) AS page FROM documents),
  w AS (SELECT book, page, list_filter(string_split(t, ' '), lambda x: x <> '') AS w FROM ls),
  p AS (SELECT book, page, unnest(list_transform(range((len(w) + 5) // 6), lambda k: array_to_string(w[k * 6 + 1:k * 6 + 6], ' '))) AS text, unnest(range((len(w) + 5) // 6)) AS ord FROM w WHERE len(w) > 0),
  s AS MATERIALIZED (SELECT book, page, ord, CASE WHEN ord % 7 = 3 THEN text || '-' WHEN ord % 11 = 5 THEN 'X ' || text ELSE text END AS text,
    (ord * 50 + CASE WHEN ord % 13 = 9 THEN 30 ELSE 0 END)::DOUBLE AS x0, (100 + ord % 9 * 0.5)::DOUBLE AS y0, (ord * 50 + CASE WHEN ord % 13 = 9 THEN 30 ELSE 0 END + 40)::DOUBLE AS x1, (112 + ord % 5 * 0.5)::DOUBLE AS y1 FROM p),
  m AS (SELECT book, page, ord AS first, ord, text, x0, y0, x1, y1, 1 AS spans FROM s WHERE ord = 0
    UNION ALL SELECT s.book, s.page, CASE WHEN takes THEN h.first ELSE s.ord END, s.ord, CASE WHEN takes THEN trim(rtrim(h.text) || CASE WHEN ends_with(trim(h.text), '-') THEN '' ELSE ' ' END || ltrim(s.text)) ELSE s.text END,
      CASE WHEN takes THEN h.x0 ELSE s.x0 END, CASE WHEN takes THEN h.y0 ELSE s.y0 END, CASE WHEN takes THEN greatest(h.x1, s.x1) ELSE s.x1 END, CASE WHEN takes THEN greatest(h.y1, s.y1) ELSE s.y1 END, CASE WHEN takes THEN h.spans + 1 ELSE 1 END
    FROM m h JOIN s ON s.book = h.book AND s.page = h.page AND s.ord = h.ord + 1, LATERAL (SELECT abs(s.y0 - h.y0) <= 1.5 AND abs(s.y1 - h.y1) <= 1.5 AND s.x0 - h.x1 BETWEEN 0 AND 16
      AND CASE WHEN ends_with(trim(h.text), '-') THEN NOT regexp_matches(trim(s.text), '^[0-9]+[a-z]?\)') ELSE regexp_matches(trim(s.text), '^[("“‘\[]?[a-z0-9]') END AS takes))
  SELECT book, page, first AS ord, x0, y0, x1, y1, spans::BIGINT AS spans, sha256(text) AS text_sha256 FROM m QUALIFY row_number() OVER (PARTITION BY book, page, first ORDER BY ord DESC) = 1"""


@query
def heading_bands(spark, sf):
    """First lines of documents, cut in two, on their pages.  No SQL: the tests try all runs of lines."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("book"), F.transform(F.split("text", "\n"), lambda t: F.substring(t, 1, 40)).alias("lines")).repartition("book")
    lines = docs.select("book", F.posexplode("lines").alias("i", "t")).select("book", F.lit(1).alias("page"), F.initcap("t").alias("text"), (F.col("i") % 3 * 10.0).alias("x0"), (40.0 + F.col("i") * 14).alias("y0"), F.lit(300.0).alias("x1"), (50.0 + F.col("i") * 14).alias("y1"))
    first = F.initcap(F.get("lines", F.lit(0)))
    entries = docs.select(F.col("book").alias("entry_id"), "book", F.lit(1).alias("page"), F.array(first, F.concat_ws(" ", first, F.initcap(F.get("lines", F.lit(1))))).alias("variants"))
    return N.heading_bands(entries, lines)


# outlines


@query
def outlines(spark, sf):
    """Lines of a document as entries of a book whose levels rise and fall."""
    lines = table(spark, sf, "documents").select(F.col("doc_id").alias("book"), F.posexplode(F.split("text", "\n")).alias("seq", "t"))
    level = ((F.col("book") * 7 + F.col("seq") * F.col("seq") * 5 + F.col("seq") * 3) % 9 + 1).cast("int")
    found = O.nested_sets(lines.select("book", "seq", level.alias("level"), F.concat(F.lit("t"), F.col("seq").cast("string")).alias("title")))
    return found.select("book", F.col("left").cast("long").alias("left"), F.col("right").cast("long").alias("right"), F.col("parent").cast("long").alias("parent"), F.col("depth").cast("long").alias("depth"), "path")


SQL["outlines"] = """WITH RECURSIVE l AS (SELECT doc_id AS book, unnest(range(len(string_split(text, chr(10))))) AS seq FROM documents),
  e AS MATERIALIZED (SELECT book, seq + 1 AS n, (book * 7 + seq * seq * 5 + seq * 3) % 9 + 1 AS level, 't' || seq AS title FROM l),
  p AS MATERIALIZED (SELECT e.book, e.n, any_value(e.title) AS title, max(a.n) FILTER (a.n < e.n AND a.level < e.level) AS parent, min(a.n) FILTER (a.n > e.n AND a.level <= e.level) - 1 AS ends, max(a.n) AS last FROM e JOIN e a USING (book) GROUP BY e.book, e.n),
  t AS (SELECT book, n, 1 AS depth, title AS path FROM p WHERE parent IS NULL UNION ALL SELECT p.book, p.n, depth + 1, path || ' > ' || title FROM t JOIN p ON p.book = t.book AND p.parent = t.n)
  SELECT book, n AS left, coalesce(ends, last) AS right, parent, depth::BIGINT AS depth, path FROM t JOIN p USING (book, n)"""


@query
def outline_children(spark, sf):
    lines = table(spark, sf, "documents").select(F.col("doc_id").alias("book"), F.posexplode(F.split("text", "\n")).alias("seq", "t"))
    level = ((F.col("book") * 7 + F.col("seq") * F.col("seq") * 5 + F.col("seq") * 3) % 9 + 1).cast("int")
    nested = O.nested_sets(lines.select("book", "seq", level.alias("level"), F.lit("").alias("title")))
    joined = F.array_join(F.transform("children", lambda c: c.cast("string")), ",")
    return O.children(nested).select("book", F.col("parent").cast("long").alias("parent"), joined.alias("children"))


SQL["outline_children"] = """WITH l AS (SELECT doc_id AS book, unnest(range(len(string_split(text, chr(10))))) AS seq FROM documents),
  e AS MATERIALIZED (SELECT book, seq + 1 AS n, (book * 7 + seq * seq * 5 + seq * 3) % 9 + 1 AS level FROM l),
  p AS (SELECT e.book, e.n, max(a.n) FILTER (a.n < e.n AND a.level < e.level) AS parent FROM e JOIN e a USING (book) GROUP BY ALL)
  SELECT book, parent, string_agg(n::VARCHAR, ',' ORDER BY n) AS children FROM p GROUP BY ALL"""


# front pages


def _front(spark, sf):
    """Ten documents are the front pages of a book; their first lines name people and years by turns."""
    docs = table(spark, sf, "documents").select(F.floor(F.col("doc_id") / 10).cast("int").alias("book"), (F.col("doc_id") % 10 + 1).cast("int").alias("page"), "doc_id", F.slice(F.split("text", "\n", 7), 1, 6).alias("lines"))
    lines = docs.repartition("book").select("book", "page", "doc_id", F.posexplode("lines").alias("line_no", "t"))
    words = F.filter(F.split(F.initcap(F.regexp_replace(F.col("t"), "[^A-Za-z ]", "")), " "), lambda w: F.length(w) > 1)
    name = F.array_join(F.slice(words, 1, 2), " ")
    k, year = (F.col("doc_id") + F.col("line_no")) % 11, (1900 + F.col("doc_id") % 100).cast("string")
    text = (
        F.when(k == 0, F.concat(F.lit("By "), name)).when(k == 1, F.concat(F.lit("Translated by "), name)).when(k == 2, F.upper(name)).when(k == 3, F.concat(F.lit("Copyright "), year, F.lit(", 1899")))
        .when(k == 4, F.concat(F.lit("First published "), year)).when(k == 5, F.concat(F.lit("Originally published in "), year)).when((k == 6) & (F.col("doc_id") % 3 == 0), F.concat(F.lit("Corrected edition "), year)).otherwise(F.substring("t", 1, 60))
    )
    return lines.select("book", "page", "line_no", text.alias("text"))


@query
def book_contributors(spark, sf):
    """People of each book's front pages with their roles.  No SQL: names are merged by what they abbreviate; the tests have cases."""
    found = K.contributors(K.evidence(_front(spark, sf)))
    return found.select("book", "person", "name", F.array_join("roles", ",").alias("roles"), "weight", "mentions", "first_page", "rank")


@query
def publication_years(spark, sf):
    return K.year_candidates(_front(spark, sf)).select("book", "page", F.col("line_no").cast("long").alias("line_no"), "year", "priority", F.col("rank").cast("long").alias("rank"))


SQL["publication_years"] = """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))[1:6]) AS t, unnest(range(least(6, len(string_split(text, chr(10)))))) AS i FROM documents),
  k AS (SELECT doc_id // 10 AS book, doc_id % 10 + 1 AS page, i, (doc_id + i) % 11 AS k, 1900 + doc_id % 100 AS y, doc_id FROM l),
  c AS (SELECT book, page, i, CASE k WHEN 3 THEN greatest(y, 1899) ELSE y END AS year, CASE k WHEN 3 THEN 80 WHEN 4 THEN 90 WHEN 5 THEN 70 ELSE 100 END AS priority FROM k WHERE k IN (3, 4, 5) OR (k = 6 AND doc_id % 3 = 0))
  SELECT book::INT AS book, page::INT AS page, i AS line_no, year::INT AS year, priority, row_number() OVER (PARTITION BY book ORDER BY priority DESC, year DESC, page, i) AS rank FROM c"""


@query
def book_citations(spark, sf):
    """Author, publisher and year of each book.  No SQL, as of contributors."""
    return K.citations(_front(spark, sf))
