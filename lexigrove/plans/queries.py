"""Registered queries over the parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexigrove.functions import text as X
from lexigrove.operators import dense as D
from lexigrove.operators import gate as G
from lexigrove.operators import layout as L
from lexigrove.operators import matching as M
from lexigrove.operators import quality as Q
from lexigrove.operators import retrieval as R
from lexigrove.operators import structure as S
from lexigrove.plans import books, documents
from lexigrove.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# text

@query
def token_stats_by_lang(spark, sf):
    docs = table(spark, sf, "documents").select("lang", X.token_count(F.col("text")).alias("n_tokens"))
    return Q.token_stats(docs, "lang")


@query
def stemmed_term_df(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.explode(X.terms(F.col("text"))).alias("term"))
    per_doc = docs.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    return per_doc.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


@query
def chargram_df(spark, sf):
    items = table(spark, sf, "benchmark").select("item_id", F.explode(F.array_distinct(X.char_ngrams(F.col("text")))).alias("gram"))
    return items.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))


@query
def slug_keys(spark, sf):
    first = F.substring_index(F.col("text"), "\n", 1)
    return table(spark, sf, "documents").select("doc_id", X.slug(first).alias("slug"), X.match_key(first).alias("match_key"))


@query
def title_case_norm(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.title_case(F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(F.upper("p_name"))).alias("title"))


@query
def roman_labels(spark, sf):
    sizes = table(spark, sf, "part").select(F.col("p_size").alias("number")).distinct()
    return sizes.withColumn("label", X.roman_numeral(F.col("number"))).withColumn("value", X.roman_value(F.col("label")))


@query
def html_clean(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", X.html_text(F.col("html")).alias("text"))
    return pages.select("page_id", F.length("text").cast("long").alias("n_chars"), X.token_count(F.col("text")).alias("n_tokens"), F.sha2("text", 256).alias("text_sha256"))


@query
def retrieval_cleaning(spark, sf):
    """Each line of a document as a list item under comments that must go."""
    body = F.concat(F.lit("<!-- note -->\nSource pages: 1\n- "), F.regexp_replace("text", "\n", "\n- "), F.lit("\n_Source page 2_"))
    return table(spark, sf, "documents").select("doc_id", F.sha2(X.retrieval_text(body), 256).alias("text_sha256"))


# retrieval

def _body(spark, sf):
    return R.long_fields(table(spark, sf, "documents"), "doc_id", {"body": F.col("text")})


def _fields(spark, sf):
    return R.long_fields(table(spark, sf, "documents"), "doc_id", {"title": F.substring_index(F.col("text"), "\n", 1), "context": F.col("source"), "path": F.col("lang"), "body": F.col("text")})


def _pages(spark, sf):
    html = F.col("html")
    return R.long_fields(table(spark, sf, "pages"), "page_id", {"title": X.html_field(html, "title"), "path": F.col("url"), "body": X.html_text(html)})


def _probes(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("probe_id"), F.col("text").alias("query"))


def _gold(spark, sf):
    return R.containing(table(spark, sf, "documents"), table(spark, sf, "benchmark")).select(F.col("item_id").alias("probe_id"), "doc_id")


def _ordinals(ids):
    """Places of documents in the order of their ids, counted in ranges of ids."""
    ranged = ids.withColumn("range", F.floor(F.col("doc_id") / 100_000))
    sizes = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    own = F.row_number().over(Window.partitionBy("range").orderBy("doc_id"))
    return ranged.withColumn("own", own).join(F.broadcast(before), "range").select("doc_id", (F.col("before") + F.col("own")).alias("ord"))  # a row for each 100,000 documents


def _metrics(spark, sf, profile):
    corpus = _body(spark, sf) if profile == "body_bm25" else _fields(spark, sf)
    ordinal = _ordinals(table(spark, sf, "documents").select("doc_id"))
    return R.probe_metrics(R.bm25(corpus, _probes(spark, sf), R.PROFILES[profile]), _gold(spark, sf), ordinal)


@query
def bm25_topk(spark, sf):
    return R.ranked(R.bm25(_body(spark, sf), _probes(spark, sf), R.PROFILES["body_bm25"]), 5)


@query
def fielded_bm25_topk(spark, sf):
    return R.ranked(R.bm25(_fields(spark, sf), _probes(spark, sf), R.PROFILES["fielded_bm25"]), 5)


@query
def chargram_tfidf_topk(spark, sf):
    return R.ranked(R.chargram_tfidf(_pages(spark, sf), _probes(spark, sf), R.PROFILES["chargram_tfidf"]), 5)


@query
def rrf_topk(spark, sf):
    pages, probes = _pages(spark, sf), _probes(spark, sf)
    ordinal = table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), (F.col("page_id") + 1).alias("ord"))
    runs = [R.bm25(pages, probes, R.PROFILES["fielded_bm25"]), R.chargram_tfidf(pages, probes, R.PROFILES["chargram_tfidf"])]
    return R.ranked(R.fuse(runs, ordinal), 5)


@query
def retrieval_gold(spark, sf):
    return _gold(spark, sf)


@query
def retrieval_metrics(spark, sf):
    return _metrics(spark, sf, "body_bm25")


@query
def retrieval_grouping_sets(spark, sf):
    langs = _gold(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").groupBy("probe_id").agg(F.min("lang").alias("lang"))
    both = None
    for profile in ("body_bm25", "fielded_bm25"):
        one = _metrics(spark, sf, profile).withColumn("profile", F.lit(profile))
        both = one if both is None else both.unionByName(one)
    rows = both.join(langs, "probe_id")
    sums = rows.groupingSets([["profile", "lang"], ["profile"], ["lang"]], "profile", "lang")
    return sums.agg(F.count(F.lit(1)).alias("probes"), *[F.round(F.avg(m), 4).alias(m) for m in ("mrr", "hit_at_1", "recall_at_3", "recall_at_5")])


@query
def retrieval_tag_slices(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    labels = table(spark, sf, "labels")
    tags = F.array_compact(F.array(F.concat(F.lit("lang-"), F.col("lang")), F.when(F.col("quality") == 1, "good"), F.when(F.col("toxic") == 1, "toxic")))
    of = _gold(spark, sf).join(docs, "doc_id").join(labels, "doc_id", "left").select("probe_id", F.explode(tags).alias("tag")).distinct()
    rows = _metrics(spark, sf, "body_bm25").join(of, "probe_id")
    return rows.groupBy("tag").agg(F.count(F.lit(1)).alias("probes"), F.round(F.avg("mrr"), 4).alias("mrr"), F.round(F.avg("hit_at_1"), 4).alias("hit_at_1"))


@query
def miss_diagnostics(spark, sf):
    kind = R.miss_class(F.col("hit_at_1"), F.col("recall_at_3"), F.col("mrr"))
    return _metrics(spark, sf, "fielded_bm25").withColumn("miss_class", kind).filter("miss_class <> 'pass'").select("probe_id", "miss_class", "best_rank", "mrr")


@query
def explained_shares(spark, sf):
    return R.explained_share(R.bm25_components(_fields(spark, sf), _probes(spark, sf), R.PROFILES["fielded_bm25"]))


# dense

def _coarse(vectors):
    return vectors.withColumn("embedding", F.transform("embedding", lambda x: F.round(x.cast("double"), 1)))


@query
def dense_topk(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return D.neighbours(vectors, vectors.filter("vec_id % 20 = 0"), 5)


@query
def dense_label_votes(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return D.label_votes(D.neighbours(vectors, vectors.filter("vec_id % 20 = 0"), 5), vectors)


@query
def neighbor_overlap(spark, sf):
    vectors = table(spark, sf, "embeddings")
    coarse, asked = _coarse(vectors), vectors.filter("vec_id % 20 = 0")
    return D.neighbour_overlap(D.neighbours(vectors, asked, 5), D.neighbours(coarse, _coarse(asked), 5), 5)


@query
def twin_metrics(spark, sf):
    vectors = table(spark, sf, "embeddings")
    twins = _coarse(vectors).select("vec_id", F.col("embedding").alias("twin"))
    cosine = D.dot(F.col("embedding"), F.col("twin")) / F.sqrt(D.dot(F.col("embedding"), F.col("embedding")) * D.dot(F.col("twin"), F.col("twin")))
    return vectors.join(twins, "vec_id").select("label", F.round(cosine, 6).alias("cosine")).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("cosine"), 4).alias("mean_cosine"), F.min("cosine").alias("least_cosine"))


# quality

def _turns(spark, sf):
    return table(spark, sf, "conversations").filter("role = 'assistant'").select(F.col("conv_id").alias("id"), F.col("turn").alias("ord"), "text")


@query
def repeated_words(spark, sf):
    found = Q.repeated_word_issues(table(spark, sf, "documents"), "doc_id", "text")
    return found.groupBy(F.col("id").alias("doc_id"), "word").agg(F.count(F.lit(1)).alias("n"))


@query
def block_edge_issues(spark, sf):
    return Q.block_edge_issues(_turns(spark, sf))


@query
def micro_region_pages(spark, sf):
    return Q.micro_region_issues(table(spark, sf, "documents"), "doc_id", "text")


@query
def issue_summary(spark, sf):
    edges = Q.block_edge_issues(_turns(spark, sf)).select("id", "code")
    micro = Q.micro_region_issues(table(spark, sf, "documents"), "doc_id", "text").select("id", F.lit("boundary_page_many_micro_regions").alias("code"))
    words = Q.repeated_word_issues(table(spark, sf, "documents"), "doc_id", "text").select("id", "code")
    return Q.issue_summary(edges.unionByName(micro).unionByName(words))


@query
def scope_classification(spark, sf):
    events = table(spark, sf, "events").select(F.col("event_id").alias("id"), "event_type", (F.col("user_id") % 10).cast("string").alias("shard"))
    scopes = spark.sql("SELECT * FROM VALUES (1, 'target', 'purchase', '3'), (2, 'holdout', 'purchase', NULL), (3, 'negative', NULL, '7') AS t(scope_ord, `group`, event_type, shard)")
    found = Q.scope_matches(events, scopes, ["event_type", "shard"])
    return found.groupBy("group").agg(F.count(F.lit(1)).alias("n"))


@query
def assertions(spark, sf):
    texts = table(spark, sf, "documents").select(F.concat(F.lit("doc/"), F.col("doc_id")).alias("path"), "text")
    checks = texts.select(F.col("path").alias("check_id"), "path").withColumns(
        {"must_contain": F.array(F.lit("e")), "must_not_contain": F.array(F.lit("License"), F.lit("token = ")), "must_match": F.array(F.lit("^[A-Z]")), "must_not_match": F.array(F.lit("[0-9]{4}"), F.lit(r"\|$"))}
    )
    gone = spark.sql("SELECT 'none' AS check_id, 'doc/none' AS path, array('x') AS must_contain, array('x') AS must_not_contain, array('x') AS must_match, array('x') AS must_not_match")
    return Q.check_assertions(texts, checks.unionByName(gone))


@query
def anchor_catalog(spark, sf):
    heads = F.regexp_extract_all("html", F.lit(r"(?i)<h[1-3][^>]*>([^<]*)</h[1-3]>"), F.lit(1))
    rows = table(spark, sf, "pages").select("page_id", F.posexplode(heads).alias("ordinal", "heading"))
    return rows.select("page_id", (F.col("ordinal") + 1).cast("long").alias("ordinal"), X.slug(F.col("heading")).alias("anchor"))


@query
def manifest_audit(spark, sf):
    docs = table(spark, sf, "documents")
    manifest = docs.select(F.concat(F.lit("doc/"), F.col("doc_id")).alias("path"), "text", F.lit(1).alias("start"), F.lit(1).alias("end"))
    return Q.manifest_issues(manifest)


@query
def audit_status(spark, sf):
    return Q.worst(manifest_audit(spark, sf))


@query
def duplicate_paths(spark, sf):
    pages = table(spark, sf, "pages").select(F.regexp_replace("url", r"^[a-z]+://([^/?#]*).*$", "$1").alias("path"))
    return Q.duplicate_paths(pages, "path")


def _spans(spark, sf):
    shipped = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("end"))
    orders = table(spark, sf, "orders").join(shipped, F.col("o_orderkey") == F.col("l_orderkey"))
    day = lambda c: F.datediff(c, F.lit("1970-01-01")).cast("long")
    return orders.select("o_custkey", F.col("o_orderkey").alias("id"), day("o_orderdate").alias("start"), day("end").alias("end"))


@query
def adjacent_range_overlap(spark, sf):
    return Q.adjacent_overlaps(_spans(spark, sf), "o_custkey")


@query
def counter_diff(spark, sf):
    events = table(spark, sf, "events")
    return Q.counter_diff(events.filter("event_id % 2 = 0"), events.filter("event_id % 2 = 1"), "event_type")


@query
def metric_gate(spark, sf):
    orders = table(spark, sf, "orders")
    values = lambda rows: rows.groupBy(F.col("o_orderpriority").alias("run")).agg((F.avg("o_totalprice") / 1000).alias("price")).select("run", F.lit("price").alias("metric"), F.round("price", 4).alias("value"))
    return Q.gate_metrics(values(orders.filter("o_orderkey % 2 = 0")), values(orders.filter("o_orderkey % 2 = 1")), 0.001)


@query
def percentile_timeout(spark, sf):
    return Q.suggested_timeout(table(spark, sf, "events"), "event_type", "value")


@query
def chunk_windows(spark, sf):
    blocks = table(spark, sf, "conversations").select("conv_id", "turn", X.token_count(F.col("text")).alias("n_tokens"))
    out = None
    for limit in (70, 100, 140):
        one = S.pack(blocks, "conv_id", "turn", limit).withColumn("window", F.lit(limit))
        out = one if out is None else out.unionByName(one)
    return out


@query
def chunk_window_stats(spark, sf):
    return Q.token_stats(chunk_windows(spark, sf), "window")


@query
def largest_atomic_blocks(spark, sf):
    return Q.largest_blocks(table(spark, sf, "conversations").select("conv_id", F.col("turn").alias("ord"), X.token_count(F.col("text")).alias("n_tokens")), "conv_id")


@query
def probe_limits(spark, sf):
    limits = spark.sql("SELECT * FROM VALUES ('repeated_adjacent_word', 3), ('block_hyphen_end', 0), ('boundary_page_many_micro_regions', 100000) AS t(code, most)")
    return Q.over_limits(issue_summary(spark, sf).select("code", "n"), limits)


@query
def run_manifest_errors(spark, sf):
    """Manifests made of events: the properties' keys stand for those of the run."""
    kinds = F.element_at(F.array(*[F.lit(k) for k in (*Q.MANIFEST_KEYS, "other")]), (F.col("user_id") % 5 + 1).cast("int"))
    payload = F.create_map(F.lit("generated_at"), F.col("ts").cast("string"), F.lit("variant_id"), F.lit("v"), F.lit("artifact_status"), F.col("event_type"), F.lit("freshness"), F.when(F.col("event_id") % 3 == 0, "old").otherwise("fresh"))
    runs = table(spark, sf, "events").select(F.col("event_id").alias("run_id"), kinds.alias("kind"), payload.alias("payload"))
    return Q.run_manifest_errors(runs).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query
def run_determinism_hash(spark, sf):
    return Q.run_signature(stemmed_term_df(spark, sf))


@query
def backend_choice(spark, sf):
    runs = table(spark, sf, "supplier").select(
        F.concat(F.lit("b"), F.col("s_suppkey")).alias("backend_id"), (F.col("s_acctbal") > 0).alias("success"), (F.col("s_suppkey") % 2 == 0).alias("manifest_hash_match"),
        F.col("s_acctbal").alias("runtime_seconds"), (F.col("s_nationkey") / 25).alias("twin_hit_at_1"), (F.col("s_suppkey") % 7 / 7).alias("twin_mrr"), (F.col("s_suppkey") % 3 / 3).alias("mean_twin_cosine"),
    )
    return Q.select_backend(runs).select("backend_id", "runtime_seconds")


# structure

@query
def offset_votes(spark, sf):
    items = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return S.offset_votes(items.select("l_returnflag", F.datediff("l_shipdate", "o_orderdate").alias("offset")), "l_returnflag", "offset")


@query
def monotonic_chain(spark, sf):
    nations = table(spark, sf, "nation").select(F.col("n_regionkey").alias("book"), F.col("n_nationkey").alias("pdf_page"), (F.col("n_nationkey") * 7 % 11).cast("int").alias("book_page"))
    return S.monotonic_chain(nations, "book")


@query
def entry_end_pages(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("sequence"), F.datediff("o_orderdate", F.lit("1990-01-01")).alias("start_page"))
    return S.end_pages(orders, "o_custkey")


@query
def line_regions_islands(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", F.unix_timestamp("ts").alias("at"))
    by = Window.partitionBy("user_id").orderBy("event_id")
    marked = S.islands(events, "user_id", "event_id", F.col("at") - F.lag("at").over(by) > 3600)
    return marked.groupBy("user_id", "island").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


@query
def note_state_propagation(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    marked = S.spread_state(events, "user_id", "event_id", F.col("event_type") == "click", F.col("event_type") == "purchase")
    return marked.groupBy("event_type").agg(F.count_if("in_state").alias("inside"), F.count(F.lit(1)).alias("n"))


@query
def anchor_asof(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", F.unix_timestamp("ts").alias("at"))
    return S.next_anchor(events, "user_id", "event_id", F.col("event_type") == "purchase", "at").select("event_id", "previous_anchor", "next_anchor", "next_distance")


@query
def passages_assembled(spark, sf):
    bucket = F.when(F.col("role") == "system", "citation").when(F.col("role") == "assistant", "commentary").otherwise("reference")
    turns = table(spark, sf, "conversations").select("conv_id", "turn", bucket.alias("bucket"), "text")
    out = S.assemble_passages(turns, "conv_id", "turn", F.col("bucket") == "reference")
    return out.select("conv_id", "passage", F.sha2("citation", 256).alias("citation_sha256"), F.sha2("commentary", 256).alias("commentary_sha256"), F.sha2("reference", 256).alias("reference_sha256"), "n_fragments", "n_tokens")


@query
def passages_segmented(spark, sf):
    turns = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\n\n").alias("text"))
    return turns.select("conv_id", F.posexplode(S.segment_text(F.col("text"), 120)).alias("segment", "part")).select("conv_id", "segment", X.token_count(F.col("part")).alias("n_tokens"))


@query
def fragment_attachment(spark, sf):
    """Each turn against the next of its conversation; two points lie between the words of a fragment."""
    by = Window.partitionBy("conv_id").orderBy("turn")
    after = lambda c: F.lead(c).over(by)
    turns = table(spark, sf, "conversations").withColumns({"next_text": after("text"), "next_role": after("role"), "next_turn": after("turn")})
    words = X.token_count(F.col("text"))
    reason = M.attach_reason(F.col("text"), F.col("role"), F.col("turn"), F.col("next_text"), F.col("next_role"), F.col("next_turn"), words * 2)
    return turns.select("conv_id", "turn", reason.alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def page_profiles(spark, sf):
    """Documents as pages: lines stand below each other, words of a line are apart by their number."""
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "text"))
    place = lines.select("doc_id", "text", ((F.col("doc_id") + F.col("i") * 53) % 300).cast("double").alias("x0"), (F.lit(40) + F.col("i") * 14).cast("double").alias("y0"), F.when(F.col("i") % 5 == 4, 8.0).otherwise(10.0).alias("size"))
    return L.page_profiles(place, "doc_id")


@query
def gate_failures(spark, sf):
    """Issues of this corpus against a gate that allows repeated words and few issues."""
    edges = Q.block_edge_issues(_turns(spark, sf)).select("id", "code")
    words = Q.repeated_word_issues(table(spark, sf, "documents"), "doc_id", "text").select("id", "code")
    issues = edges.unionByName(words)
    allowed = spark.sql("SELECT 'repeated_adjacent_word' AS code")
    report = G.gate_report(G.unexpected_codes(issues, allowed, "probe", "new code"), G.too_many(issues, 10, "probe"), G.metric_failures(metric_gate(spark, sf), "prices"))
    return report.select("gate", "failures", F.array_join("messages", "; ").alias("messages"), "status")


@query
def heading_matches(spark, sf):
    """Titles of pages against their first headings, whole; a page without a heading has an empty one."""
    pages = table(spark, sf, "pages").select("page_id", X.html_field(F.col("html"), "title").alias("title"), X.html_field(F.col("html"), "h[1-3]").alias("heading"))
    return pages.select("page_id", M.heading_match(F.col("heading"), F.col("title")).alias("match_type"))


@query
def ancestor_paths(spark, sf):
    node = lambda df, i, p, n: df.select(i.alias("node_id"), p.alias("parent_id"), n.alias("name"))
    region, nation, customer = (table(spark, sf, t) for t in ("region", "nation", "customer"))
    key = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    nodes = node(region, key("r", "r_regionkey"), F.lit(None).cast("string"), F.col("r_name"))
    nodes = nodes.unionByName(node(nation, key("n", "n_nationkey"), key("r", "n_regionkey"), F.col("n_name")))
    nodes = nodes.unionByName(node(customer, key("c", "c_custkey"), key("n", "c_nationkey"), F.col("c_name")))
    return S.ancestor_paths(nodes)


@query
def toc_entries_parsed(spark, sf):
    """Contents of a book per customer: front matter, then its orders as parts, chapters and sections by their numbers."""
    key, page = F.col("o_orderkey"), F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) * 4
    line = (
        F.when(key % 5 == 0, F.concat(F.lit("Part "), X.roman_numeral(key % 90 + 1), F.lit(": "), "o_orderpriority"))
        .when(key % 5 == 1, F.concat((key % 30).cast("string"), F.lit(". "), "o_orderpriority", F.lit("  "), page.cast("string")))
        .otherwise(F.concat("o_orderpriority", F.lit(" . . . "), page.cast("string")))
    )
    orders = table(spark, sf, "orders").select(F.concat(F.lit("c"), "o_custkey").alias("book"), key.alias("line_no"), line.alias("text"))
    front = table(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("book"), F.lit(-1).cast("long").alias("line_no"), F.lit("Preface  ix").alias("text"))
    return S.parse_contents(orders.unionByName(front))


QUERIES |= documents.QUERIES | books.QUERIES
