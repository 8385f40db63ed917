"""Near-duplicate vectors by a forest of random-projection trees.

1.  Equal vectors become one node; nodes are scaled to length one.
2.  Large tight groups are taken out first.  A bounded sample shows where at least a few
    thousandths of all nodes stand within half the link angle of one centre.  Members of such
    a ball are all linked with each other, by the triangle inequality, so they are counted
    and never compared.  Nodes beyond a ball that could still reach a member are compared
    with the ball's members, in blocks.
3.  All other nodes go down several trees.  A level projects each cell's nodes on a random
    direction and splits the cell at the median; nodes near the median go to both sides.
    Splitting goes on until a cell has at most `LEAF` nodes, or its nodes stand so close
    that a split would part many pairs.
4.  Nodes are compared within leaves, leaves of more nodes in blocks.  A pair that stands
    together in several leaves counts in the first of them.  Only counts and the links of a
    spanning forest leave a task, never pairs.
5.  Union-find joins the links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrove.llm.common import few, join_facts, materialise, remove
from lexigrove.llm.near_dedup import components

COSINE = 0.9
#: Nodes up to which a cell is compared whole.
LEAF = 1024
#: Overlap of a split: so many standard deviations, by which projections of a pair at the threshold differ.
SPILL = 0.4
#: Rows of the sample that shows dense balls, and how many of them make one.
SAMPLE, DENSE = 4096, 16
#: Share of the pairs just at the threshold that all trees together may miss, and the share that one split parts.
MISSED, PARTED = 0.01, 0.043
#: A tree's leaves have numbers below this.
_TREE = 1 << 48


def _rows(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(whole):
        return np.zeros((0, 0))
    flat = whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(whole), -1)


def _unit(m: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first so that squares neither overflow nor vanish."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _forest_of(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest place that each of `n` places reaches by the links (i, j)."""
    label = np.arange(n)
    while True:
        least = label.copy()
        np.minimum.at(least, i, label[j])
        np.minimum.at(least, j, label[i])
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _nodes(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame, str]:
    """Per row (vec_id, vec), per node (node, vec, n, least), written; `vec` is null where a row links with nothing."""
    vec = vectors[vector_col]
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    sound = vec.isNotNull() & ~F.exists(vec, bad) & F.exists(vec, lambda x: x != 0)
    # a negative zero is a zero: equal vectors have equal bits
    plain = F.transform(vec, lambda x: F.when(x == 0, F.abs(x)).otherwise(x))
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), F.when(sound, plain).alias("vec"))
    grouped = rows.filter("vec IS NOT NULL").groupBy("vec").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    nodes, path = materialise(grouped.select(F.monotonically_increasing_id().alias("node"), "vec", "n", "least"), "vector-nodes")
    return rows, nodes, path


def _centres(nodes: DataFrame, dim: int, cosine: float, sample: int, dense: int) -> np.ndarray:
    """Centres of the balls that hold at least `dense` of `sample` nodes, fullest first."""
    taken = nodes.filter(F.size("vec") == dim).orderBy(F.xxhash64("vec")).limit(sample).select("vec").toArrow()
    if taken.num_rows < dense:
        return np.zeros((0, dim))
    m = _unit(_rows(taken["vec"]))
    near = (m @ m.T) >= cosine
    free, found, inner = np.ones(len(m), bool), [], math.cos(math.acos(cosine) / 2)
    while True:
        degree = near[:, free].sum(axis=1) * free
        best = int(degree.argmax())
        if degree[best] < dense:
            return np.array(found).reshape(-1, dim)
        centre = _unit(m[near[best] & free].mean(axis=0, keepdims=True))[0]
        inside = free & (m @ centre >= inner)
        if inside.sum() >= dense:
            found.append(centre)
        free &= ~inside
        free[best] = False


def _placed(nodes: DataFrame, centres: dict[int, np.ndarray], cosine: float) -> DataFrame:
    """Nodes with their ball (null: none) and the balls before it whose members they could reach (`near`)."""
    spark = nodes.sparkSession
    held = spark.sparkContext.broadcast(centres)  # at most SAMPLE / DENSE rows for each length of vectors
    angle = math.acos(cosine)
    inner, outer = math.cos(angle / 2 - 1e-9), math.cos(min(math.pi, 1.5 * angle + 1e-9))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("vec").value_lengths().to_numpy(zero_copy_only=False)
            ball, near = np.full(len(sizes), -1), [[] for _ in sizes]
            for dim, c in held.value.items():
                at = np.flatnonzero(sizes == dim)
                if len(c) and len(at):
                    cos = _unit(_rows(batch.column("vec").take(pa.array(at)))) @ c.T
                    best = cos.argmax(axis=1)
                    own = np.where(cos.max(axis=1) >= inner, best, -1)
                    ball[at] = np.where(own >= 0, dim * 4096 + own, -1)
                    for r, b in zip(*np.nonzero(cos >= outer), strict=True):
                        if own[r] < 0 or b < own[r]:
                            near[at[r]].append(int(dim * 4096 + b))
            mine = pa.array([None if b < 0 else int(b) for b in ball], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("vec"), batch.column("n"), mine, pa.array(near, pa.list_(pa.int64()))], names=["node", "vec", "n", "ball", "near"])

    kind = nodes.schema["vec"].dataType.simpleString()
    return nodes.select("node", "vec", "n").mapInArrow(run, f"node long, vec {kind}, n long, ball long, near array<long>")


_FOUND = "node long, links long, other long"


def _found(nodes: np.ndarray, links: np.ndarray, other: np.ndarray) -> pa.Table:
    some = (links > 0) | (nodes != other)
    return pa.table({"node": nodes[some], "links": links[some].astype(np.int64), "other": other[some]})


def _ball_links(placed: DataFrame, again: DataFrame, cosine: float, block: int) -> tuple[DataFrame, str]:
    """Links within balls, and between balls and the nodes about them: (node, links, other).

    ``again`` is the same written table, read another time.
    """
    balls, balls_path = materialise(placed.filter("ball IS NOT NULL").groupBy("ball").agg(F.sum("n").alias("rows"), F.min("node").alias("head"), F.count(F.lit(1)).alias("n_nodes")), "balls")
    inside = placed.filter("ball IS NOT NULL").join(F.broadcast(balls), "ball")  # one row for each centre
    certain = inside.select("node", (F.col("rows") - F.col("n")).alias("links"), F.col("head").alias("other"))
    about = again.select("node", "vec", "n", F.explode("near").alias("ball"))
    n_about = about.groupBy("ball").agg(F.count(F.lit(1)).alias("n_about"))
    shape = F.broadcast(balls.join(n_about, "ball").select("ball", "head", F.ceil(F.col("n_nodes") / block).alias("n_i"), F.ceil(F.col("n_about") / block).alias("n_o")))
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    columns = ("ball", "i", "o", "node", "vec", "n", "head")
    members = placed.select("node", "vec", "n", "ball").join(shape, "ball").withColumn("i", own("n_i")).withColumn("o", every("n_o")).select(*columns)
    others = about.join(shape, "ball").withColumn("o", own("n_o")).withColumn("i", every("n_i")).select(*columns).toDF(*columns)

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("node", "links", "other")})
        hit = _unit(_rows(a["vec"])) @ _unit(_rows(b["vec"])).T >= cosine
        u, v = a["node"].to_numpy(), b["node"].to_numpy()
        head = a["head"].to_numpy()[:1]
        of_a, of_b = hit @ b["n"].to_numpy(), a["n"].to_numpy() @ hit
        return pa.concat_tables([_found(u, of_a, u), _found(v, of_b, np.where(of_b > 0, head, v))])

    key = ["ball", "i", "o"]
    between = members.groupBy(*key).cogroup(others.groupBy(*key)).applyInArrow(compare, _FOUND)
    return certain.unionByName(between), balls_path


def _leaves(loose: DataFrame, dim: int, trees: int, depth: int, cosine: float, leaf: int, spill: float, seed: int) -> tuple[DataFrame, list[str]]:
    """(node, leaf): the leaves of each node of one length in all trees; `leaf` numbers the tree and the path."""
    apart = math.sqrt(2 - 2 * cosine) / math.sqrt(dim)  # standard deviation between the ends of a pair at the threshold
    margin = spill * apart

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plane = np.random.default_rng([seed, dim]).standard_normal((dim, trees * depth))
        plane /= np.sqrt((plane * plane).sum(axis=0))
        for batch in batches:
            if batch.num_rows:
                x = (_unit(_rows(batch.column("vec"))) @ plane).astype(np.float32).reshape(-1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) + 1, depth), pa.int32()), pa.array(x))
                node = np.repeat(batch.column("node").to_numpy(), trees)
                cell = np.tile(np.arange(trees) * _TREE + 1, batch.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(cell), lists], names=["node", "cell", "x"])

    cells, path = materialise(loose.select("node", "vec").mapInArrow(project, "node long, cell long, x array<float>"), "tree-cells")
    done, paths = [], [path]
    for level in range(depth):
        at = F.element_at("x", level + 1)
        # a cell is dense if its nodes stand hardly farther apart than such a pair: a split would part too many
        stats = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(at, [0.2, 0.5, 0.8], 1000).alias("q"))
        spread = F.col("q")[2] - F.col("q")[0] >= 1.68 * apart  # 1.68 deviations lie between these quantiles
        stats, stats_path = materialise(stats.select("cell", "n", F.when((F.col("n") > leaf) & spread, F.col("q")[1]).alias("cut")), "tree-cuts")
        known = join_facts(cells, stats, ["cell"], "n", cells.count())
        path_of = F.col("cell") % _TREE
        below = F.col("cell") - path_of + path_of * 2
        sides = F.when(at < F.col("cut") - margin, F.array(below)).when(at > F.col("cut") + margin, F.array(below + 1)).otherwise(F.array(below, below + 1))
        split = known.select("node", F.col("cut").isNull().alias("whole"), F.explode(F.when(F.col("cut").isNull(), F.array("cell")).otherwise(sides)).alias("cell"), "x")
        split, split_path = materialise(split, "tree-cells")
        done.append(split.filter("whole").select("node", F.col("cell").alias("leaf")))
        paths += [stats_path, split_path]
        cells = split.filter("NOT whole").drop("whole")
        if cells.isEmpty():
            break
    done.append(cells.select("node", F.col("cell").alias("leaf")))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out, paths


def _tree_links(loose: DataFrame, leaves: DataFrame, cosine: float, leaf: int) -> DataFrame:
    """Links of nodes that stand in a leaf together: (node, links, other)."""
    lists = leaves.groupBy("node").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))  # as many as a node has leaves
    sizes = leaves.groupBy("leaf").agg(F.count(F.lit(1)).alias("n_leaf")).filter("n_leaf > 1")
    member = loose.select("node", "vec", "n").join(lists, "node").withColumn("leaf", F.explode("leaves"))
    member = member.join(few(sizes), "leaf")
    # cells of up to two leaves' nodes are compared whole, larger ones by pairs of blocks
    blocks = F.when(F.col("n_leaf") <= 2 * leaf, 1).otherwise(F.ceil(F.col("n_leaf") / leaf)).cast("long")
    member = member.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    rows = member.select("leaf", "node", "vec", "n", "leaves", "block", other)
    rows = rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other")

    def compare(t: pa.Table) -> pa.Table:
        here, first = t["leaf"][0].as_py(), t["block"].to_numpy() == t["i"][0].as_py()
        m, node, n = _unit(_rows(t["vec"])), t["node"].to_numpy(), t["n"].to_numpy()
        if t["i"][0].as_py() == t["j"][0].as_py():
            i, j = np.nonzero(np.triu(m @ m.T >= cosine, 1))
        else:
            x, y = np.flatnonzero(first), np.flatnonzero(~first)
            i, j = np.nonzero(m[x] @ m[y].T >= cosine)
            i, j = x[i], y[j]
        lists = t["leaves"].to_pylist()
        earlier = np.repeat(-1 - np.arange(len(node))[:, None], max(map(len, lists)), axis=1)
        for r, of in enumerate(lists):
            for c, key in enumerate(of):
                if key < here:
                    earlier[r, c] = key
        links = np.zeros(len(node), np.int64)
        for at in range(0, len(i), 50_000):
            a, b = i[at : at + 50_000], j[at : at + 50_000]
            seen = np.zeros(len(a), bool)
            for c in range(earlier.shape[1]):
                seen |= (earlier[b] == earlier[a, c][:, None]).any(axis=1)
            a, b = a[~seen], b[~seen]
            np.add.at(links, a, n[b])
            np.add.at(links, b, n[a])
        return _found(node, links, node[_forest_of(i, j, len(node))])

    return rows.groupBy("leaf", "i", "j").applyInArrow(compare, _FOUND)


def depth_and_trees(n: int, leaf: int) -> tuple[int, int]:
    """Levels until `n` nodes stand in leaves, and trees that together miss at most `MISSED` of the pairs at the threshold."""
    depth = max(0, math.ceil(math.log2(max(1, n) / leaf)))
    if depth == 0:
        return 0, 1
    kept = (1 - PARTED) ** depth
    return depth + 3, max(3, math.ceil(math.log(MISSED) / math.log(1 - kept)))


def embedding_components(
    vectors: DataFrame, cosine: float = COSINE, leaf: int = LEAF, spill: float = SPILL, sample: int = SAMPLE, dense: int = DENSE, seed: int = 0, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per vector: vec_id, n_links (other rows linked directly), component_id, kept.

    Rows are linked if their cosine, in double precision, is at least `cosine`.  No link is
    false; of the pairs just at the threshold the trees miss about one in a hundred, of closer
    ones less.  Equal vectors, and rows of a dense ball, miss none.

    Vectors that are null, empty or zero, or hold null or non-finite components, link with
    nothing and are their own components.  Vectors of different lengths aren't linked.
    `component_id` is the smallest vec_id reachable; a null id is never the smallest, unless
    all ids of the component are null.  Rows that repeat an id count each; other columns
    are ignored; an empty table gives an empty result.  ``cosine`` must lie in (0.5, 1).
    """
    if not 0.5 < cosine < 1:
        raise ValueError("cosine must lie between 0.5 and 1")
    spark = vectors.sparkSession
    rows, nodes, nodes_path = _nodes(vectors, id_col, vector_col)
    counts = {r.dim: r.n for r in nodes.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}
    # the groups of lengths are few; a table of very many lengths is no table of embeddings
    centres = {dim: _centres(nodes, dim, cosine, sample, dense) if n > leaf else np.zeros((0, dim)) for dim, n in counts.items()}
    placed, placed_path = materialise(_placed(nodes, centres, cosine), "vector-balls")
    parts, balls_path = _ball_links(placed, spark.read.schema(placed.schema).parquet(placed_path), cosine, 4 * leaf)
    loose = placed.filter("ball IS NULL")
    loose_counts = {r.dim: r.n for r in loose.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}
    spare = []
    for dim, n in loose_counts.items():
        depth, trees = depth_and_trees(n, leaf)
        these = loose.filter(F.size("vec") == dim)
        if depth:
            leaves, used = _leaves(these, dim, trees, depth, cosine, leaf, spill, seed)
            spare += used
        else:
            leaves = these.select("node", F.lit(1).cast("long").alias("leaf"))
        parts = parts.unionByName(_tree_links(these, leaves, cosine, leaf))
    parts, parts_path = materialise(parts, "vector-links")
    roots = components(parts.select(F.col("node").alias("a"), F.col("other").alias("b")))
    linked = parts.groupBy("node").agg(F.sum("links").alias("links"))
    known, known_path = materialise(nodes.select("node", "n", "least").join(linked, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "vector-roots")
    least, least_path = materialise(known.groupBy("root").agg(F.min("least").alias("component"), F.count(F.lit(1)).alias("m")), "vector-least")
    named = join_facts(known, least, ["root"], "m", known.count()).select("node", F.coalesce("links", F.lit(0)).alias("links"), "component")
    facts, facts_path = materialise(nodes.select("node", "vec", "n").join(named, "node"), "vector-facts")
    sound = join_facts(rows.filter("vec IS NOT NULL"), facts, ["vec"], "n", rows.count())
    sound = sound.select("vec_id", (F.col("links") + F.col("n") - 1).alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.filter("vec IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out, _ = materialise(sound.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))), "vector-components")
    for path in (nodes_path, *spare, placed_path, balls_path, parts_path, known_path, least_path, facts_path):
        remove(spark, path)
    return out
