"""Quality of document bundles: artifact checks, scopes, assertions, manifests, gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrove.functions.text import DANGLING, first_word, repeated_words, squeeze, trailing_words

#: Limits of the checks (fixed values).
MICRO_CHARS, MICRO_REGIONS, SHORT_CHARS, SNIPPET = 18, 6, 80, 180
#: Kinds of entries that have pages of their own (fixed values).
LEAF_KINDS = ("frontmatter", "section", "epilogue", "index", "auxiliary")


def repeated_word_issues(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, code, word): one row for each suspicious repetition."""
    words = F.explode(repeated_words(F.col(text_col)))
    return texts.select(F.col(id_col).alias("id"), F.lit("repeated_adjacent_word").alias("code"), words.alias("word"))


def block_edge_issues(blocks: DataFrame) -> DataFrame:
    """(id, ord, code) of blocks (id, ord, text) whose first or last block of an id is cut.

    The first block may not open in lower case; the last may not end in a hyphen, nor, without
    closing punctuation, in a word that must be followed by another.
    """
    body = squeeze(F.coalesce(F.col("text"), F.lit("")))
    by = Window.partitionBy("id").orderBy("ord")
    back = Window.partitionBy("id").orderBy(F.desc("ord"))
    marked = blocks.withColumns({"body": body, "first": F.row_number().over(by) == 1, "last": F.row_number().over(back) == 1}).filter("body <> ''")
    opening = F.substring(first_word(F.col("body")), 1, 1)
    tail = F.try_element_at(trailing_words(F.col("body"), 1), F.lit(-1))
    lower = F.when(F.col("first") & opening.rlike("^[a-z]$"), F.lit("block_lowercase_start"))
    hyphen = F.when(F.col("last") & F.col("body").endswith("-"), F.lit("block_hyphen_end"))
    open_end = F.col("last") & ~F.col("body").endswith("-") & ~F.col("body").rlike("[.!?:\"”')\\]]$")
    dangling = F.when(open_end & tail.isin(DANGLING), F.lit("block_dangling_end"))
    codes = F.explode(F.array_compact(F.array(lower, hyphen, dangling)))
    return marked.select("id", "ord", codes.alias("code"))


def probe_blocks(blocks: DataFrame) -> DataFrame:
    """(id, ord, code, snippet) of commentary blocks (id, ord, text, mode, sliced_start, sliced_end).

    Comments are no text; only prose is checked.  The first block of an id may open in lower
    case, and the last one stop anywhere, where the page is sliced there.  Snippets show up to
    180 characters of the end in question.
    """
    body = squeeze(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), "(?s)<!--.*?-->", " "))
    by = Window.partitionBy("id").orderBy("ord")
    back = Window.partitionBy("id").orderBy(F.desc("ord"))
    placed = blocks.withColumns({"body": body, "first": F.row_number().over(by) == 1, "last": F.row_number().over(back) == 1}).filter((F.col("mode") == "prose") & (F.col("body") != ""))
    start, end = F.substring("body", 1, SNIPPET), F.substring(F.col("body"), F.greatest(F.length("body") - SNIPPET + 1, F.lit(1)), F.length("body"))
    issue = lambda on, code, snippet: F.when(F.coalesce(on, F.lit(False)), F.struct(F.lit(code).alias("code"), snippet.alias("snippet")))
    opening = F.substring(first_word(F.col("body")), 1, 1)
    closes = F.col("last") & ~F.col("sliced_end")
    hyphen = F.col("body").endswith("-")
    tail = F.try_element_at(trailing_words(F.col("body"), 1), F.lit(-1))
    found = [
        issue(F.col("first") & ~F.col("sliced_start") & opening.rlike("^[a-z]$"), "block_lowercase_start", start),
        issue(closes & hyphen, "block_hyphen_end", end),
        issue(closes & ~hyphen & ~F.col("body").rlike("[.!?:\"”')\\]]$") & tail.isin(DANGLING), "block_dangling_end", end),
    ]
    return placed.select("id", "ord", F.explode(F.array_compact(F.array(*found))).alias("x")).select("id", "ord", "x.code", "x.snippet")


def intentional_boundaries(overlaps: DataFrame, sliced_ends: DataFrame, sliced_starts: DataFrame) -> DataFrame:
    """The boundary overlaps (left_id, right_id, kind) whose page is sliced on both sides (tables of `id`)."""
    left = overlaps.filter("kind = 'boundary'").join(sliced_ends.select(F.col("id").alias("left_id")), "left_id", "left_semi")
    return left.join(sliced_starts.select(F.col("id").alias("right_id")), "right_id", "left_semi")


def entries_by_path(manifest: DataFrame, columns: Sequence[str], entry: str, order: str) -> DataFrame:
    """(path, entry, column): the first manifest row that has a path in any of some columns, as the columns stand."""
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("column"), F.col(c).alias("path")) for i, c in enumerate(columns)])
    each = manifest.select(order, entry, F.explode(pairs).alias("x")).filter("x.path IS NOT NULL AND x.path <> ''")
    first = F.min(F.struct(F.col(order).alias("at"), F.col("x.i").alias("i"), F.col(entry).alias("entry"), F.col("x.column").alias("column")))
    return each.groupBy(F.col("x.path").alias("path")).agg(first.alias("f")).select("path", F.col("f.entry").alias(entry), F.col("f.column").alias("column"))


def leaf_entries(manifest: DataFrame, part: str = "") -> DataFrame:
    """The manifest rows (kind, path) that have pages of their own, and a path that contains ``part``."""
    return manifest.filter(F.col("kind").isin(*LEAF_KINDS) & F.contains(F.col("path"), F.lit(part)))


def means_where(rows: DataFrame, group: str, value: str, condition: Column) -> DataFrame:
    """(group, n, mean, n_where, mean_where): a mean of all rows, and of those that a condition holds for."""
    some = F.when(condition, F.col(value))
    return rows.groupBy(group).agg(F.count(value).alias("n"), F.round(F.avg(value), 4).alias("mean"), F.count(some).alias("n_where"), F.round(F.avg(some), 4).alias("mean_where"))


def first_seen(rows: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """(group, seen): the distinct values of a group by their first place, joined by spaces.

    Each value is reduced to its first place before the group is put together.
    """
    places = rows.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.min(order).alias("at"))
    ordered = F.array_sort(F.collect_list(F.struct("at", F.col(value).alias("v"))))
    return places.groupBy(group).agg(F.array_join(F.transform(ordered, lambda x: x["v"]), " ").alias("seen"))


def folder_digests(files: DataFrame, folder: str, path: str, text: str) -> DataFrame:
    """(folder, n_files, sha256): the digest of a folder's files in the order of their paths: path, NUL, contents, NUL of each.

    The digest is of one stream of bytes, so a row holds the texts of a folder.
    """
    one = F.struct(F.col(path).alias("p"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    stream = F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda f: F.concat(F.coalesce(f["p"], F.lit("")), F.lit("\0"), f["t"], F.lit("\0"))), "")
    return files.groupBy(folder).agg(F.count(F.lit(1)).alias("n_files"), F.sha2(stream, 256).alias("sha256"))


def micro_region_issues(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, region_count) of texts with many very short lines; numbered anchors don't count."""
    lines = F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), squeeze)
    micro = F.filter(lines, lambda x: (x != "") & (F.length(x) <= MICRO_CHARS) & ~x.rlike(r"^[0-9]+[a-z]\)"))
    return texts.select(F.col(id_col).alias("id"), F.size(micro).cast("long").alias("region_count")).filter(F.col("region_count") >= MICRO_REGIONS)


def first_issues(issues: DataFrame, limit: int, *order: str) -> DataFrame:
    """The first ``limit`` issues in a stated order; counts are taken after this cap."""
    return issues.orderBy(*order).limit(limit)


def issue_summary(issues: DataFrame) -> DataFrame:
    """(code, n, ids)."""
    return issues.groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"))


def scope_matches(issues: DataFrame, scopes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each issue with the first scope (scope_ord, group, keys...) all of whose present keys it has.

    Scopes are a spec of a few rows, so the inequality join broadcasts them; keys compare as text.
    Issues that are alike stay rows of their own.
    """
    issue, scope = issues.withColumn("__row", F.monotonically_increasing_id()).alias("i"), scopes.alias("s")
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"s.{k}").isNull() | (F.col(f"i.{k}").cast("string") == F.col(f"s.{k}").cast("string")))
    best = issue.join(F.broadcast(scope), on, "left").groupBy("i.__row", "i.id", *[F.col(f"i.{k}") for k in keys])
    return best.agg(F.min(F.struct(F.col("s.scope_ord"), F.col("s.group"))).alias("x")).select("id", *keys, F.coalesce("x.group", F.lit("unclassified")).alias("group"))


def check_assertions(texts: DataFrame, checks: DataFrame) -> DataFrame:
    """(check_id, code, detail): failures of text assertions.

    ``checks`` is (check_id, path, must_contain, must_not_contain, must_match, must_not_match),
    arrays of strings each; patterns are multi-line.  A path without text fails as missing.
    """
    joined = checks.join(texts, "path", "left")
    missing = F.col("text").isNull()

    def failing(column: str, code: str, bad) -> Column:
        found = F.filter(F.coalesce(F.col(column), F.array().cast("array<string>")), bad)
        return F.transform(found, lambda x: F.struct(F.lit(code).alias("code"), x.alias("detail")))

    none = F.array(F.struct(F.lit("missing_target_file").alias("code"), F.col("path").alias("detail")))
    every = F.concat(
        failing("must_contain", "missing_required_substring", lambda x: ~F.contains(F.col("text"), x)),
        failing("must_not_contain", "forbidden_substring_present", lambda x: F.contains(F.col("text"), x)),
        failing("must_match", "required_pattern_missing", lambda x: ~F.rlike(F.col("text"), F.concat(F.lit("(?m)"), x))),
        failing("must_not_match", "forbidden_pattern_present", lambda x: F.rlike(F.col("text"), F.concat(F.lit("(?m)"), x))),
    )
    return joined.select("check_id", F.explode(F.when(missing, none).otherwise(every)).alias("x")).select("check_id", "x.code", "x.detail")


def manifest_issues(manifest: DataFrame) -> DataFrame:
    """(path, severity, code) of manifest rows (path, text, start, end)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    paged = F.col("start").isNotNull() & F.col("end").isNotNull() & (F.col("end") >= F.col("start"))
    rules = [
        (F.col("path").isNull() | (F.col("path") == ""), "fail", "manifest_missing_output_path"),
        (F.col("text").isNull(), "fail", "missing_output_file"),
        (F.contains(text, F.lit("TODO")), "fail", "todo_marker_left_in_output"),
        (F.contains(text, F.lit("```text")), "warn", "layout_code_block_in_semantic_markdown"),
        (F.col("text").isNotNull() & paged & (F.length(F.trim(text)) < SHORT_CHARS), "warn", "suspiciously_short_output"),
    ]
    codes = F.array_compact(F.array(*[F.when(F.coalesce(on, F.lit(False)), F.struct(F.lit(s).alias("severity"), F.lit(c).alias("code"))) for on, s, c in rules]))
    return manifest.select("path", F.explode(codes).alias("x")).select("path", "x.severity", "x.code")


def duplicate_paths(manifest: DataFrame, col: str) -> DataFrame:
    """(path, n) of paths that stand more than once."""
    return manifest.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("path")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def adjacent_overlaps(ranges: DataFrame, group: str) -> DataFrame:
    """Neighbouring ranges (group, id, start, end) of a group, by start, end and id, that overlap, with the kind."""
    by = Window.partitionBy(group).orderBy("start", "end", "id")
    left = {c: F.lag(c).over(by) for c in ("id", "start", "end")}
    rows = ranges.filter("start IS NOT NULL AND end IS NOT NULL").withColumns({f"left_{c}": v for c, v in left.items()})
    kind = (
        F.when(F.col("left_start").isNull() | (F.col("start") > F.col("left_end")), F.lit(None))
        .when((F.col("left_start") == F.col("start")) & (F.col("left_end") == F.col("end")), "identical")
        .when(F.col("start") == F.col("left_end"), "boundary")
        .when((F.col("left_start") <= F.col("start")) & (F.col("end") <= F.col("left_end")), "nested")
        .otherwise("overlap")
    )
    severity = F.when(F.col("kind").isin("identical", "nested"), "fail").otherwise("warn")
    return rows.withColumn("kind", kind).filter("kind IS NOT NULL").select(group, "left_id", F.col("id").alias("right_id"), "kind", severity.alias("severity"))


def worst(issues: DataFrame) -> DataFrame:
    """(status): fail before warn before pass."""
    rank = F.max(F.when(F.col("severity") == "fail", 2).when(F.col("severity") == "warn", 1).otherwise(0))
    return issues.agg(F.coalesce(rank, F.lit(0)).alias("r")).select(F.element_at(F.array(F.lit("pass"), F.lit("warn"), F.lit("fail")), F.col("r") + 1).alias("status"))


def counter_diff(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, left_n, right_n, delta) of the counts that differ."""
    a = left.groupBy(key).agg(F.count(F.lit(1)).alias("left_n"))
    b = right.groupBy(key).agg(F.count(F.lit(1)).alias("right_n"))
    out = a.join(b, key, "full").select(key, F.coalesce("left_n", F.lit(0)).alias("left_n"), F.coalesce("right_n", F.lit(0)).alias("right_n"))
    return out.withColumn("delta", F.col("right_n") - F.col("left_n")).filter("delta <> 0")


def gate_metrics(current: DataFrame, baseline: DataFrame, tolerance: float) -> DataFrame:
    """(run, metric, verdict): each baseline value (run, metric, value) against the current one."""
    joined = baseline.withColumnRenamed("value", "frozen").join(current, ["run", "metric"], "full")
    verdict = (
        F.when(F.col("value").isNull(), "missing_current")
        .when(F.col("frozen").isNull(), "new_metric")
        .when(F.col("value") < F.col("frozen") - tolerance, "regressed")
        .otherwise("ok")
    )
    return joined.select("run", "metric", verdict.alias("verdict"))


def token_stats(sizes: DataFrame, *groups: str) -> DataFrame:
    """Count, extremes, mean, median and p90 of `n_tokens`; percentiles interpolate."""
    return sizes.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("count"),
        F.min("n_tokens").alias("min_tokens"),
        F.max("n_tokens").alias("max_tokens"),
        F.round(F.avg("n_tokens"), 2).alias("mean_tokens"),
        F.round(F.percentile("n_tokens", F.lit(0.5)), 2).alias("median_tokens"),
        F.round(F.percentile("n_tokens", F.lit(0.9)), 2).alias("p90_tokens"),
    )


def nearest_rank(col: str, q: float) -> Column:
    """The nearest-rank percentile."""
    return F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {col})")


def suggested_timeout(attempts: DataFrame, group: str, col: str) -> DataFrame:
    """(group, runs, p95, p99, timeout): twice the 95th percentile, or the 99th and 30, whichever is more."""
    out = attempts.groupBy(group).agg(F.count(F.lit(1)).alias("runs"), nearest_rank(col, 0.95).alias("p95"), nearest_rank(col, 0.99).alias("p99"))
    return out.withColumn("timeout", F.greatest(F.col("p95") * 2, F.col("p99") + 30))


def run_signature(df: DataFrame) -> DataFrame:
    """(signature): a digest of a table that doesn't depend on row order; rows count as often as they stand."""
    text = F.to_json(F.struct(*sorted(df.columns)))
    sums = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(text).cast("decimal(38,0)")).alias("a"), F.bit_xor(F.xxhash64(F.lit(1), text)).alias("b"))
    return sums.select(F.sha2(F.concat_ws(":", "n", "a", "b"), 256).alias("signature"))


def select_backend(results: DataFrame, order: Sequence[str] = ("twin_hit_at_1", "twin_mrr", "mean_twin_cosine")) -> DataFrame:
    """The best successful backend whose manifest agrees: highest metrics in order, then the quickest, then by name."""
    usable = results.filter("success AND manifest_hash_match")
    return usable.orderBy(*[F.desc(c) for c in order], "runtime_seconds", "backend_id").limit(1)


#: Keys that a run's manifest must have, by kind, and the values of two of them (fixed values).
MANIFEST_KEYS = {
    "quality_gate": ("generated_at", "variant_id", "input_pdf", "converter_version", "gate_config"),
    "challenge_corpus": ("generated_at", "variant_id", "baseline_dir", "entry_count"),
    "backend_comparison": ("generated_at", "variant_id", "bundle", "benchmark", "backend"),
    "bundle_generation": ("generated_at", "book_id", "source", "converter_version", "output_dir"),
}
STATUSES, FRESHNESS = ("generated", "failed", "skipped", "dry_run"), ("fresh", "stale", "unknown")


def run_manifest_errors(manifests: DataFrame) -> DataFrame:
    """(run_id, error) of run manifests (run_id, kind, payload map): missing keys, unknown kinds and values."""
    keys, payload = F.map_keys("payload"), F.col("payload")
    required = F.when(F.lit(False), F.array().cast("array<string>"))
    for kind, names in MANIFEST_KEYS.items():
        required = required.when(F.col("kind") == kind, F.array(*[F.lit(n) for n in names]))
    status = F.coalesce(F.try_element_at(payload, F.lit("artifact_status")), F.lit("generated"))
    fresh = F.coalesce(F.try_element_at(payload, F.lit("freshness")), F.lit("fresh"))
    errors = F.concat(
        F.coalesce(F.array_except(required, keys), F.array(F.concat(F.lit("unknown kind: "), F.col("kind")))),
        F.array_compact(F.array(F.when(~status.isin(*STATUSES), F.concat(F.lit("invalid artifact_status: "), status)), F.when(~fresh.isin(*FRESHNESS), F.concat(F.lit("invalid freshness: "), fresh)))),
    )
    return manifests.select("run_id", F.explode(errors).alias("error"))


def largest_blocks(blocks: DataFrame, group: str) -> DataFrame:
    """The largest block (group, ord, n_tokens) of each group, the first of equal ones."""
    best = F.max(F.struct("n_tokens", (-F.col("ord")).alias("back")))
    return blocks.groupBy(group).agg(best.alias("x")).select(group, (-F.col("x.back")).alias("ord"), "x.n_tokens")


def over_limits(counts: DataFrame, limits: DataFrame) -> DataFrame:
    """(code, actual, most) of the codes that stand more often than their limit; codes without a count stand 0 times."""
    joined = limits.join(counts, "code", "left").select("code", F.coalesce("n", F.lit(0)).alias("actual"), "most")
    return joined.filter("actual > most")
