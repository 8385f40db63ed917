"""Mixing sources to target weights by min-cost flow over membership patterns."""

from __future__ import annotations

import heapq
import json
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexigrove.llm.common import SPACED_WORD, materialise, unused

#: Patterns that the driver routes each on its own; documents of further, smaller ones supply one of their sources.
MAX_PATTERNS = 200_000
#: Hash ranges of a pattern's documents, between which one is cut.
BUCKETS = 4096


def capped_targets(sizes: Mapping[object, int], weights: Mapping[object, float], total: float, max_epochs: float) -> dict[object, float]:
    """Shares of ``total`` by weight; none above ``max_epochs`` times its source's size.

    What a capped source can't take is shared again among the others by weight, until none
    is above its cap.
    """
    target, open_, left = {}, set(sizes), float(total)
    while open_:
        weight = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / weight > max_epochs * sizes[s]}
        if not over:
            target.update({s: left * weights[s] / weight for s in open_})
            break
        for s in over:
            target[s] = float(max_epochs * sizes[s])
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def route(patterns: Sequence[tuple[tuple, int]], quotas: Mapping[object, float], max_epochs: int) -> dict[tuple, dict[object, float]]:
    """Min-cost flow from membership patterns to source quotas.

    A pattern supplies its size once for each epoch; epoch ``k`` costs ``k`` a word, so that
    repetition is spread before any document is repeated further (convex costs).  Successive
    cheapest augmenting paths over the residual network give the optimum.  Returns the words
    that each pattern gives to each of its sources.
    """
    supply = dict(patterns)
    given = {p: dict.fromkeys(p, 0.0) for p in supply}
    members: dict[object, list[tuple]] = {}
    for p in supply:
        for s in p:
            members.setdefault(s, []).append(p)
    used = dict.fromkeys(supply, 0.0)

    def next_epoch(p: tuple) -> tuple[float, float] | None:
        """Cost and room of the cheapest epoch of a pattern that isn't full."""
        for k in range(max_epochs):
            if used[p] < (k + 1) * supply[p] - 1e-9:
                return float(k), (k + 1) * supply[p] - used[p]
        return None

    for target in sorted(quotas, key=lambda s: (len(members.get(s, ())), str(s))):
        need = quotas[target]
        while need > 1e-6:
            # from this source over patterns that can give more; a pattern that serves another
            # source may be taken over if that source finds another pattern
            best, back, heap = {target: 0.0}, {}, [(0.0, 0, target)]
            end, tick = None, 0
            while heap:
                cost, _, s = heapq.heappop(heap)
                if cost > best.get(s, float("inf")):
                    continue
                if end is not None and cost >= end[0]:
                    break
                for p in members.get(s, ()):
                    if (epoch := next_epoch(p)) is not None and (end is None or cost + epoch[0] < end[0]):
                        end = (cost + epoch[0], p, s, epoch[1])
                    for other, words in given[p].items():
                        if other != s and words > 1e-9 and cost < best.get(other, float("inf")):
                            best[other], back[other] = cost, (p, s)
                            tick += 1
                            heapq.heappush(heap, (cost, tick, other))
            if end is None:
                break
            _, p, s, room = end
            path, at = [], s
            while at != target:
                via, before = back[at]
                path.append((via, at, before))
                room = min(room, given[via][at])
                at = before
            moved = min(room, need)
            used[p] += moved
            given[p][s] += moved
            for via, gave, takes in path:
                given[via][gave] -= moved
                given[via][takes] += moved
            need -= moved
    return given


def mix(docs: DataFrame, sources_col: str, weights, id_col: str = "doc_id", text_col: str = "text", share: float = 1.0, max_epochs: int = 3, seed: int = 17, keep: Sequence[str] = (), heavy: float = 1 / 64, few: int = 64) -> tuple[DataFrame, dict, dict]:
    """(per row: row_no, doc_id, pattern, size, epochs, and the columns of `keep`; target of each source; size of each source).

    `sources_col` holds the array of a document's sources.  `weights` maps the sorted list of
    all sources (by code point, null last) to their weights.  Documents are aggregated by
    pattern and the pattern's words routed to the sources' quotas; of a pattern that gives
    `r` times its size, every document is taken floor(r) times and seeded ones once more.

    Within a pattern, documents stand by a seeded hash of their id, and the place where the
    further words are reached is found from sums of hash ranges, then within one range: no
    task holds a pattern.  Documents of more than the share `heavy` of their pattern (a 64th),
    and all of a pattern of up to `few` documents (64), are chosen first, so that the last
    document taken is a small one.

    Of more than `MAX_PATTERNS` patterns of several sources, the largest are routed as they
    are, and the documents of all others supply the first of their sources alone; every
    document is still taken into account, and quotas hold.
    """
    if few > 64 or heavy < 1 / 64:
        raise ValueError("a task chooses among 64 documents at most: few <= 64, heavy >= 1/64")
    size = F.coalesce(F.regexp_count(docs[text_col], F.lit(SPACED_WORD)), F.lit(0)).cast("long")
    key = unused(docs, "key")
    rows, _ = materialise(
        docs.withColumn(key, F.array_sort(F.array_distinct(docs[sources_col]))).select(
            F.monotonically_increasing_id().alias("row_no"),
            docs[id_col].alias("doc_id"),
            F.to_json(key).alias("pattern"),
            F.to_json(F.slice(key, 1, 1)).alias("first_source"),
            F.coalesce(F.size(key) > 1, F.lit(False)).alias("several"),
            size.alias("size"),
            F.xxhash64(F.lit(seed), docs[id_col]).alias("place"),
            *[docs[c] for c in keep],
        ),
        "mix-sizes",
    )
    # the patterns of several sources that are routed as they are: MAX_PATTERNS rows at most
    joint = rows.filter("several").groupBy("pattern").agg(F.sum("size").alias("size"))
    if joint.count() > MAX_PATTERNS:
        largest = joint.orderBy(F.desc("size"), "pattern").limit(MAX_PATTERNS).select("pattern", F.lit(True).alias("own"))
        rows = rows.join(F.broadcast(largest), "pattern", "left").withColumn("pattern", F.when(F.col("own") | ~F.col("several"), F.col("pattern")).otherwise(F.col("first_source"))).drop("own")
    # one row per pattern: a source each, and the above
    found = rows.groupBy("pattern").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    keys = {tuple(json.loads(r.pattern or "[]")): r.pattern for r in found}
    patterns = [(tuple(json.loads(r.pattern or "[]")), r["size"]) for r in found]
    sizes: dict[object, int] = {}
    for p, n in patterns:
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    total = share * sum(n for _, n in patterns)
    targets = capped_targets(sizes, dict(zip(order, weights(order), strict=True)), total, max_epochs)
    given = route([x for x in patterns if x[0]], targets, max_epochs)
    count = {r.pattern: r.n for r in found}
    rates = [(keys[p], count[keys[p]], int(n), min(float(max_epochs), sum(given.get(p, {}).values()) / n) if n else 0.0) for p, n in patterns]
    rate = docs.sparkSession.createDataFrame(rates, "pattern string, n_docs long, pattern_size long, rate double")
    return _select(rows, rate, max_epochs, keep, heavy, few), targets, sizes


def choose_heavy(sizes: Sequence[int], fair: float, least: float, most: float) -> list[bool]:
    """Which of a few documents, in seeded order, to take once more.

    With light documents to fill up with, `fair` words are taken at most, but `least` where
    that is possible.  With none (`least` equals `most`), the subset nearest to it is.
    """
    if least >= most:
        return nearest_subset(sizes, most)
    taken, held = [False] * len(sizes), 0
    goal = min(max(fair, least), most)
    for i, n in enumerate(sizes):
        if held + n <= goal or (held < least and held + n <= most):
            taken[i], held = True, held + n
    return taken


def nearest_subset(sizes: Sequence[int], goal: float) -> list[bool]:
    """The subset whose sum is nearest to ``goal``; sums are rounded above a million."""
    unit = int(goal) // 1_000_000 + 1
    scaled, at = [round(n / unit) for n in sizes], max(0, round(goal / unit))
    reach = [1]  # bit s: the sum s can be had from the first documents
    for n in scaled:
        reach.append((reach[-1] | reach[-1] << n) & ((1 << (2 * at + 2)) - 1))
    low = (reach[-1] & ((1 << (at + 1)) - 1)).bit_length() - 1
    high = reach[-1] >> (at + 1)
    best = low if not high or at - low <= (high & -high).bit_length() else at + (high & -high).bit_length()
    taken = [False] * len(sizes)
    for i in range(len(sizes) - 1, -1, -1):
        if not reach[i] >> best & 1:
            taken[i], best = True, best - scaled[i]
    return taken


def _heavy(rows: DataFrame) -> DataFrame:
    """(row_no, one) of the documents chosen one by one; a group has 64 at most."""

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["place", "doc_id", "row_no"])
        extra, light, heavy = float(group.extra.iloc[0]), int(group.light.iloc[0]), int(group["size"].sum())
        fair = extra * heavy / max(1, heavy + light)
        one = choose_heavy(group["size"].tolist(), fair, extra - light, extra)
        return pd.DataFrame({"pattern": group.pattern, "row_no": group.row_no, "size": group["size"], "one": np.array(one, np.int32)})

    return rows.groupBy("pattern").applyInPandas(choose, "pattern string, row_no long, size long, one int")


def _select(rows: DataFrame, rate: DataFrame, max_epochs: int, keep: Sequence[str], heavy_share: float, few: int) -> DataFrame:
    """The epochs of each row, from the rate of its pattern."""
    # a row of a few words for each source, and at most MAX_PATTERNS more, here and below
    whole = F.floor("rate")
    placed = rows.join(F.broadcast(rate), "pattern").withColumns(
        {"whole": whole.cast("int"), "extra": (F.col("rate") - whole) * F.col("pattern_size"), "heavy": (F.col("size") > F.col("pattern_size") * heavy_share) | (F.col("n_docs") <= few)}
    )
    light = placed.groupBy("pattern").agg(F.sum(F.when(F.col("heavy"), 0).otherwise(F.col("size"))).alias("light"))
    chosen, _ = materialise(_heavy(placed.filter("heavy").join(F.broadcast(light), "pattern")), "mix-heavy")
    spent = chosen.groupBy("pattern").agg(F.sum(F.col("size") * F.col("one")).alias("spent"))
    unit = (F.shiftrightunsigned("place", 11) * F.lit(2.0**-53)).cast("double")
    rest = placed.filter("NOT heavy").join(F.broadcast(spent), "pattern", "left")
    rest = rest.withColumns({"extra": F.col("extra") - F.coalesce("spent", F.lit(0)), "bucket": F.floor(unit * BUCKETS).cast("int")})
    sums = rest.groupBy("pattern", "extra", "bucket").agg(F.sum("size").alias("n"))
    # the range in which the further words of a pattern are reached, and what is left for it
    cuts = (
        sums.withColumn("upto", F.sum("n").over(Window.partitionBy("pattern").orderBy("bucket")))
        .filter((F.col("upto") >= F.col("extra")) & (F.col("upto") - F.col("n") < F.col("extra")))
        .groupBy("pattern")
        .agg(F.min(F.struct("bucket", (F.col("extra") - F.col("upto") + F.col("n")).alias("left"))).alias("cut"))
        .select("pattern", F.col("cut.bucket").alias("cut_bucket"), F.col("cut.left").alias("left"))
    )
    at = rest.join(F.broadcast(cuts), "pattern", "left")
    inside = F.col("bucket").eqNullSafe(F.col("cut_bucket"))
    run = F.sum("size").over(Window.partitionBy("pattern").orderBy("place", "doc_id", "row_no"))
    # a document that reaches over the end is taken if that leaves the sum nearer to it
    last = at.filter(inside).withColumn("one", (F.col("left") - (run - F.col("size")) > F.col("size") / 2).cast("int"))
    others = at.filter(~inside).withColumn("one", (F.coalesce(F.col("bucket") < F.col("cut_bucket"), F.lit(True)) & (F.col("extra") > 0)).cast("int"))
    heavy = placed.filter("heavy").join(chosen.select("row_no", "one"), "row_no")
    columns = ["row_no", "doc_id", "pattern", "size", *keep, "whole", "one"]
    every = last.select(columns).unionByName(others.select(columns)).unionByName(heavy.select(columns))
    return every.select("row_no", "doc_id", "pattern", "size", *keep, F.least(F.col("whole") + F.col("one"), F.lit(max_epochs)).alias("epochs"))


def cycling(weights: Sequence[float]):
    """Weights that repeat along the sorted sources."""
    return lambda order: [weights[i % len(weights)] for i in range(len(order))]


def mix_report(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """Per row: doc_id, size, source_size, target (its source's), taken.

    A null text has size 0, a null source is a source of its own (the last), rows that repeat
    an id are documents of their own, and an empty table gives an empty result.
    """
    named = docs.select("doc_id", "text", F.array(docs["source"]).alias("sources"))
    picked, targets, sizes = mix(named, "sources", cycling(weights), max_epochs=max_epochs, seed=seed)
    facts = docs.sparkSession.createDataFrame([(s, int(sizes[s]), float(targets[s])) for s in sizes], "source string, source_size long, target double")
    # one row per source
    first = F.from_json("pattern", "array<string>")[0]
    joined = picked.join(F.broadcast(facts), first.eqNullSafe(facts["source"]), "left")
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("epochs")).cast("long").alias("taken"))


def mix_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it is taken; all columns as they are.

    Rows that repeat an id, a text and a source share their copies evenly; what doesn't
    divide goes to one of them.
    """
    names = {x: unused(docs, f"mix_{x}") for x in ("id", "hash", "source", "copy", "of_id", "of_hash", "of_source", "each", "more")}
    named = docs.select("doc_id", F.array(docs["source"]).alias("sources"), "text", F.xxhash64("text").alias("text_hash"))
    picked, _, _ = mix(named, "sources", cycling(weights), max_epochs=max_epochs, seed=seed, keep=("text_hash",))
    taken = picked.groupBy("doc_id", "text_hash", "pattern").agg(F.sum("epochs").alias("m"), F.count(F.lit(1)).alias("n")).filter("m > 0")
    shares = {"of_id": F.col("doc_id"), "of_hash": F.col("text_hash"), "of_source": F.col("pattern"), "each": F.expr("m div n"), "more": F.col("m") % F.col("n")}
    chosen, _ = materialise(taken.select(*(c.alias(names[x]) for x, c in shares.items())), "mix-taken")
    rows = docs.withColumns({names["id"]: F.col("doc_id"), names["hash"]: F.xxhash64("text"), names["source"]: F.to_json(F.array("source"))})
    on = [F.col(names[x]).eqNullSafe(F.col(names[f"of_{x}"])) for x in ("id", "hash", "source")]

    def repeated(found: DataFrame, times: str) -> DataFrame:
        return found.withColumn(names["copy"], F.explode(F.sequence(F.lit(1), F.col(names[times]).cast("int")))).select(*docs.columns)

    more = chosen.filter(F.col(names["more"]) > 0)
    whole = repeated(rows.join(chosen.filter(F.col(names["each"]) > 0), on), "each")
    once = rows.join(more, on).dropDuplicates([names["id"], names["hash"], names["source"]])
    return whole if more.isEmpty() else whole.unionByName(repeated(once, "more"))
