"""URL filters: fixed rules, and association rules that FP-growth mines from labels."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrove.llm.common import materialise, remove

#: Least log-likelihood ratio (G2) of a rule's counts; chance reaches it once in ten million rules.
LEAST_RATIO = 28.4
#: Mined rules that are broadcast, at most; more are joined.
MAX_BROADCAST = 50_000
RULES = "sets array<array<string>>, confidence double, support double"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = re.compile(r"[^0-9a-z\x80-\U0010ffff]+")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: behind the first "://" up to "/", "?" or "#", A-Z lower-cased; path: up to "?" or "#"."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def tokens_of(host: str, path: str) -> set[str]:
    """Labels of the host, each pair of neighbours of them, and words of the path with digits as one shape."""
    labels = [x for x in host.split(".") if x]
    pairs = {f"h:{a}.{b}" for a, b in zip(labels, labels[1:], strict=False)}
    words = {f"p:{re.sub('[0-9]+', '0', w)}" for w in _SPLIT.split(path.translate(str.maketrans(_UPPER, _LOWER))) if w}
    return {f"h:{x}" for x in labels} | pairs | words


@F.arrow_udf(T.ArrayType(T.StringType()))
def _tokens(host: pa.Array, path: pa.Array) -> pa.Array:
    return pa.array([sorted(tokens_of(h, p)) for h, p in zip(host.to_pylist(), path.to_pylist(), strict=True)], pa.list_(pa.string()))


#: A mined rule: tokens, or sets of interchangeable tokens, of each of which a URL must have one; and its confidence.
Rule = tuple[Sequence[str | Sequence[str]], float]


def _set(x: str | Sequence[str]) -> Sequence[str]:
    return (x,) if isinstance(x, str) else x


class RuleSet:
    """Fixed rules by host, and mined rules in an inverted index by the tokens of their rarest set."""

    def __init__(self, fixed: Sequence[tuple[str, str]], mined: Sequence[Rule]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for action, rule in fixed:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, action, rule))
        uses: dict[str, int] = {}
        mined = [([_set(x) for x in sets], confidence) for sets, confidence in mined]
        for sets, _ in mined:
            for x in sets:
                uses[x[0]] = uses.get(x[0], 0) + 1
        self.by_token: dict[str, list[tuple[list[frozenset], float]]] = {}
        for sets, confidence in mined:
            anchor = min(sets, key=lambda x: (uses[x[0]], x[0]))
            need = [frozenset(x) for x in sets if x is not anchor]
            for token in anchor:
                self.by_token.setdefault(token, []).append((need, confidence))

    def fixed_rule(self, host: str, path: str) -> tuple[str, str] | None:
        """(action, rule) of the longest fixed rule that fits."""
        best, suffix = None, host
        while True:
            for start, action, rule in self.by_host.get(suffix, ()):
                if path.startswith(start) and (best is None or len(rule) > len(best[1])):
                    best = action, rule
            _, dot, suffix = suffix.partition(".")
            if not dot:
                return best

    def confidence(self, host: str, path: str) -> float:
        """The highest confidence of a mined rule whose tokens a URL has all, or 0."""
        if not self.by_token:
            return 0.0
        tokens = tokens_of(host, path)
        return max((c for t in tokens for need, c in self.by_token.get(t, ()) if not any(map(tokens.isdisjoint, need))), default=0.0)


def ratio(bad: Column, good: Column, n_bad: int, n_good: int) -> Column:
    """The log-likelihood ratio (G2) of a combination's counts against equal shares of both classes."""
    n, having = n_bad + n_good, bad + good
    cells = [(bad, having * n_bad), (good, having * n_good), (n_bad - bad, (n - having) * n_bad), (n_good - good, (n - having) * n_good)]
    return 2 * sum((F.when(seen > 0, seen * F.log(seen * n / met)).otherwise(0.0) for seen, met in cells), F.lit(0.0))


def mine_rule_sets(pages: DataFrame, labels: DataFrame, min_support: float = 0.0, min_count: int = 20, min_confidence: float = 0.5, min_lift: float = 1.5) -> DataFrame:
    """(sets, confidence, support): rules for unwanted URLs.

    A labelled page, whose `page_id` is a `doc_id` of ``labels``, is a transaction of its URL's
    tokens, unwanted if a label calls it toxic or of low quality.  FP-growth finds the
    combinations that stand in at least `min_count` unwanted ones, however many there are in
    all; rules stay if their confidence and lift over all transactions reach the least and
    both classes differ significantly.

    Tokens that stand in the same transactions, all of them, can replace each other in any
    combination.  Such a set is one item of FP-growth, and of each set of a rule a URL needs
    one token; that gives the verdicts of all their combinations without listing them.
    """
    spark = pages.sparkSession
    bad = labels.groupBy("doc_id").agg(F.max(F.coalesce((F.col("toxic") == 1) | (F.col("quality") == 0), F.lit(False))).alias("bad"))
    host, path = host_and_path(pages["url"])
    seen = pages.select(pages["page_id"], host.alias("host"), path.alias("path")).join(bad, F.col("page_id") == F.col("doc_id"))
    baskets, baskets_path = materialise(seen.select(F.monotonically_increasing_id().alias("t"), _tokens("host", "path").alias("items"), "bad"), "url-baskets")
    total = baskets.agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad")).first()
    n, n_bad = total.n, total.n_bad
    least = max(min_support * n, min_count)
    if n_bad < least:
        remove(spark, baskets_path)
        return spark.createDataFrame([], RULES)
    each = baskets.select("t", "bad", F.explode("items").alias("token"))
    # the transactions of a token, told by their number and two sums of hashes
    places = each.groupBy("token").agg(
        F.count_if("bad").alias("n_bad"), F.count("*").alias("n"), *(F.sum(F.xxhash64(F.lit(k), "t").cast("decimal(38,0)")).alias(f"sum{k}") for k in (1, 2))
    )
    sets, sets_path = materialise(places.filter(F.col("n_bad") >= least).groupBy("n_bad", "n", "sum1", "sum2").agg(F.array_sort(F.collect_list("token")).alias("set")).select(F.col("set")[0].alias("item"), "set", "n"), "url-sets")
    merged, merged_path = materialise(each.join(sets.select(F.col("item").alias("token"), F.col("n").alias("uses")), "token").groupBy("t", "bad").agg(F.collect_list("token").alias("items")), "url-items")
    # half a count less, as the share is rounded up to a count again
    share = (least - 0.5) / max(1, merged.filter("bad").count())
    found = FPGrowth(itemsCol="items", minSupport=min(1.0, share), minConfidence=1.0).fit(merged.filter("bad").select("items")).freqItemsets
    found, found_path = materialise(found.filter(F.col("freq") >= least).select(F.array_sort("items").alias("items"), F.col("freq").alias("joint")), "url-itemsets")
    # counts over all transactions, met by the rarest item of each combination
    known = found.select("items", "joint", F.explode("items").alias("item")).join(sets, "item")
    rarest = known.groupBy("items", "joint").agg(F.min_by("item", F.struct("n", "item")).alias("item"), F.array_sort(F.collect_list("set")).alias("sets"))
    having = merged.select(F.col("items").alias("held"), F.explode("items").alias("item"))
    met = having.join(rarest, "item").filter(F.size(F.array_except("items", "held")) == 0)
    counted = met.groupBy("sets", "joint").agg(F.count("*").alias("single")).withColumn("confidence", F.col("joint") / F.col("single"))
    sure = ratio(F.col("joint"), F.col("single") - F.col("joint"), n_bad, n - n_bad) >= LEAST_RATIO
    rules = counted.filter(sure & (F.col("confidence") >= min_confidence) & (F.col("confidence") * n / n_bad >= min_lift))
    out, _ = materialise(rules.select("sets", "confidence", (F.col("joint") / n).alias("support")), "url-rules")
    for path in (baskets_path, sets_path, merged_path, found_path):
        remove(spark, path)
    return out


def mine_rules(pages: DataFrame, labels: DataFrame, **mining) -> DataFrame:
    """(tokens, confidence, support): the rules of `mine_rule_sets`, one for each choice of tokens."""
    chosen = F.aggregate("sets", F.array(F.array().cast("array<string>")), lambda held, s: F.flatten(F.transform(held, lambda h: F.transform(s, lambda t: F.concat(h, F.array(t))))))
    return mine_rule_sets(pages, labels, **mining).select(F.explode(chosen).alias("tokens"), "confidence", "support").withColumn("tokens", F.array_sort("tokens"))


def minimal(rules: Sequence[Rule]) -> list[Rule]:
    """The rules that no rule with fewer of the same sets and as much confidence makes needless."""
    kept: dict[str, list[tuple[frozenset, float]]] = {}
    out = []
    for sets, confidence in sorted(((tuple(sorted(sets, key=_set)), c) for sets, c in rules), key=lambda r: (len(r[0]), [_set(x)[0] for x in r[0]])):
        own = frozenset(_set(x)[0] for x in sets)
        if not any(c >= confidence and need <= own for t in own for need, c in kept.get(t, ())):
            out.append((sets, confidence))
            kept.setdefault(min(own), []).append((own, confidence))
    return out


def _joined_confidence(parts: DataFrame, rules: DataFrame) -> DataFrame:
    """``parts`` (with `row_no`, host, path) and `confidence`, by a join of tokens and rules: for rules without number."""
    rows = parts.select("row_no", _tokens("host", "path").alias("tokens"))
    anchored = rules.select("confidence", "sets", F.explode(F.col("sets")[0]).alias("token"))
    met = rows.select("row_no", "tokens", F.explode("tokens").alias("token")).join(anchored, "token")
    best = met.filter(F.forall("sets", lambda s: F.arrays_overlap(s, F.col("tokens")))).groupBy("row_no").agg(F.max("confidence").alias("confidence"))
    return parts.join(best, "row_no", "left").fillna({"confidence": 0.0})


def filter_urls(pages: DataFrame, labels: DataFrame, fixed: Sequence[tuple[str, str]], **mining) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, confidence.

    The longest fixed rule (action, "host/path") that fits gives the verdict; else the page is
    blocked if a mined rule matches, and allowed if none does.  Null urls and such without
    "://" have an empty host and path and are allowed; repeated rows are judged alike; further
    columns are ignored; without labels there are no mined rules; an empty table gives an
    empty result.
    """
    rules = mine_rule_sets(pages, labels, **mining)
    host, path = host_and_path(pages["url"])
    parts = pages.select(pages["page_id"], host.alias("host"), path.alias("path"))
    few = rules.count() <= MAX_BROADCAST
    mined = minimal([(r.sets, r.confidence) for r in rules.collect()]) if few else []
    if not few:
        numbered, _ = materialise(parts.withColumn("row_no", F.monotonically_increasing_id()), "url-parts")
        parts = _joined_confidence(numbered, rules)
    shared = pages.sparkSession.sparkContext.broadcast((list(fixed), mined))
    kind = T.StructType([T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType()), T.StructField("confidence", T.DoubleType())])
    built: list[RuleSet] = []

    @F.arrow_udf(kind)
    def judge(host: pa.Array, path: pa.Array, joined: pa.Array) -> pa.Array:
        if not built:
            built.append(RuleSet(*shared.value))
        rules, verdicts, confidences = [], [], []
        for h, p, c in zip(host.to_pylist(), path.to_pylist(), joined.to_pylist(), strict=True):
            hit, confidence = built[0].fixed_rule(h, p), max(c, built[0].confidence(h, p))
            rules.append(hit[1] if hit else None)
            verdicts.append(hit[0] if hit else "block" if confidence else "allow")
            confidences.append(confidence)
        return pa.StructArray.from_arrays([pa.array(rules, pa.string()), pa.array(verdicts, pa.string()), pa.array(confidences, pa.float64())], ["rule", "verdict", "confidence"])

    joined = F.lit(0.0) if few else F.col("confidence")
    return parts.withColumn("x", judge("host", "path", joined)).select("page_id", "host", "path", "x.rule", "x.verdict", "x.confidence")
