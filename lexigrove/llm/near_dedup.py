"""Near-duplicate grouping: SuperMinHash signatures, banding, verification, union-find.

1.  Every document becomes its set of word shingles; equal sets become one node.
2.  A node's SuperMinHash signature is cut into bands; nodes that share a band share a bucket.
3.  In a bucket, every node is paired with the bucket's smallest node only.
4.  Pairs are filtered by their sizes and signatures, and confirmed on the full sets.
5.  Confirmed pairs are united.  Where a bucket of up to `DIRECT` nodes still has several
    components, the pairs across components are tried as well.
6.  Larger buckets of several components come of passages that very many documents share.
    Their nodes are bucketed anew by an exact prefix filter: similar sets share one of their
    rarest shingles, and shared passages are not among those.  Steps 3 to 5 follow for
    these buckets.  So no pair that shares a band goes untried unless its ends are united.
7.  What is left are groups about one large component: many copies of one text, and copies
    too far from most of them.  Those are tried in blocks against the group's nodes, each
    block with an inverted index, and only confirmed links leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrove.llm.common import few, frugal, join_facts, materialise, remove, slices, small_batches, unused

WORDS, PERCENT, BANDS, ROWS = 5, 75, 32, 4
#: Share of equal signature bytes below which a pair is not verified: over five standard
#: deviations below the least similarity that counts.
LEAST_AGREEMENT = 0.55
#: Nodes of a bucket up to which its pairs are tried directly.
DIRECT = 24
#: Nodes on either side of a block in which a large group's outsiders are tried.
BLOCK = 512
#: A shingle is common if more nodes have it than are tried directly.  Only the order in which
#: the prefix filter takes shingles rests on this, never what it finds.
COMMON = DIRECT + 1
#: Common shingles are marked in 2^26 bits, 8 MB, whatever their number.
_MARKS = 1 << 26
#: Bytes of text that a task holds as numpy arrays at a time.
_SLICE = 1_000_000

_SPACES = bytes.maketrans(b"\x09\x0a\x0b\x0c\x0dABCDEFGHIJKLMNOPQRSTUVWXYZ", b"     abcdefghijklmnopqrstuvwxyz")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2^64
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, below ``n``."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def shingle_sets(texts: list[bytes], width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of all texts in a row, and how many each text has.

    Words are hashed from differences of one running polynomial sum over all bytes, shingles
    from the hashes of their words and their number.
    """
    raw = b" ".join(texts) + b" "
    folded = np.frombuffer(raw.translate(_SPACES), np.uint8)
    ends_of = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    space = folded == 0x20
    before = np.concatenate(([True], space[:-1]))
    begin, end = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    up, down = _power(len(folded))
    summed = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[folded] * up[: len(folded)], dtype=np.uint64)))
    words = _mix((summed[end] - summed[begin]) * down[begin] + (end - begin).astype(np.uint64))
    n_words = np.diff(np.concatenate(([0], np.searchsorted(begin, ends_of))))
    first = np.cumsum(n_words) - n_words

    rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        rolled = rolled * _GOLDEN + words[k : k + len(rolled)]
        rolled ^= rolled >> np.uint64(32)
    rolled = _mix(rolled + np.uint64(width))
    counts = np.where(n_words >= width, n_words - width + 1, (n_words > 0).astype(np.int64))
    stops = np.cumsum(counts)
    out = np.empty(int(stops[-1]) if len(stops) else 0, np.uint64)
    for i in range(len(texts)):
        n, a, b = int(n_words[i]), int(stops[i] - counts[i]), int(stops[i])
        if n >= width:
            out[a:b] = np.sort(rolled[first[i] : first[i] + b - a])
        elif n:
            h = np.zeros(1, np.uint64)
            for w in words[first[i] : first[i] + n]:
                h = h * _GOLDEN + w
                h ^= h >> np.uint64(32)
            out[a] = _mix(h + np.uint64(n))[0]
    owner = np.repeat(np.arange(len(texts)), counts)
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return out[new], np.bincount(owner[new], minlength=len(texts))


def super_minhash(elements: np.ndarray, owner: np.ndarray, sets: int, size: int) -> np.ndarray:
    """SuperMinHash signatures, one row of ``size`` ranks for each set.

    Element by element, a random permutation of the slots is drawn step by step, and step j
    offers the rank j + u, u in [0, 1), to its slot.  As the ranks of an element are spread
    over one permutation, slots are correlated and the variance is below MinHash's.  A set
    stops as soon as step j exceeds each rank it holds: no later offer can be smaller.  Ranks
    are 64-bit, j above and u below.
    """
    ranks = np.full(sets * size, np.iinfo(np.uint64).max, np.uint64)
    low = np.uint64(0xFFFFFFFF)
    order = None
    for j in range(size):
        x = _mix(elements + np.uint64((j + 1) * int(_GOLDEN) % 2**64))
        k = (j + (((x & low) * np.uint64(size - j)) >> np.uint64(32))).astype(np.int64)
        if j == 0:
            slot, first = k, k
        elif j == 1:
            slot = np.where(k == first, 0, k)
            second = k
        else:
            at = np.arange(len(elements))
            if order is None:  # few short sets come so far
                order = np.tile(np.arange(size, dtype=np.uint16), (len(elements), 1))
                for i, past in enumerate((first, second)):
                    order[at, i], order[at, past] = order[at, past], order[at, i].copy()
            slot = order[at, k].astype(np.int64)
            order[at, k] = order[at, j]
            order[at, j] = slot
        np.minimum.at(ranks, owner * size + slot, np.uint64(j << 32) | (x >> np.uint64(32)))
        active = (ranks.reshape(sets, size).max(axis=1) >> np.uint64(32)) > j
        keep = active[owner]
        if not keep.any():
            break
        if not keep.all():
            elements, owner, first = elements[keep], owner[keep], first[keep]
            second = second[keep] if j else None
            order = order[keep] if order is not None else None
    return ranks.reshape(sets, size)


def _signatures(width: int, bands: int, rows: int):
    size = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in slices(batch.column(2), _SLICE):
                texts = part.cast(pa.binary()).to_pylist()
                elements, counts = shingle_sets(texts, width)
                owner = np.repeat(np.arange(len(texts)), counts)
                ranks = np.empty((len(texts), size), np.uint64)
                # sets that need many steps hold a permutation for each element: few at a time
                cuts = np.searchsorted(np.cumsum(counts), np.arange(40_000, int(counts.sum()), 40_000))
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)], strict=True):
                    if a < b:
                        lo, hi = int(counts[:a].sum()), int(counts[:b].sum())
                        ranks[a:b] = super_minhash(elements[lo:hi], owner[lo:hi] - a, b - a, size)
                mixed = _mix(ranks + _GOLDEN)
                key = np.zeros((len(texts), bands), np.uint64)
                for r in range(rows):
                    key = _mix(key * _GOLDEN + mixed.reshape(len(texts), bands, rows)[:, :, r])
                key = _mix(key + np.arange(bands, dtype=np.uint64)[None, :]).view(np.int64)
                sums = [np.zeros(len(texts), np.uint64), counts.astype(np.uint64)]
                for k, salt in enumerate((np.uint64(0x1234567), np.uint64(0x7654321))):
                    np.add.at(sums[k], owner, _mix(elements ^ salt))
                node = np.stack([_mix(s) for s in sums], axis=1).tobytes()
                some = counts > 0
                offsets = np.concatenate(([0], np.cumsum(np.where(some, bands, 0)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[at : at + len(texts)],
                        batch.column(1)[at : at + len(texts)],
                        pa.array(counts, pa.int64()),
                        pa.array([node[16 * i : 16 * i + 16] if s else None for i, s in enumerate(some)], pa.binary()),
                        pa.array([r.tobytes() if s else None for r, s in zip(mixed.astype(np.uint8), some, strict=True)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(key[some].ravel())),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "node", "signature", "bands"],
                )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in slices(batch.column(1), _SLICE):
                texts = part.cast(pa.binary()).to_pylist()
                elements, counts = shingle_sets(texts, width)
                stops = np.cumsum(counts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[at : at + len(texts)], pa.array([elements[b - n : b].tobytes() for b, n in zip(stops, counts, strict=True)], pa.binary())],
                    names=["node", "elements"],
                )

    return run


@F.arrow_udf(T.BooleanType())
def _agrees(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether the signatures leave a pair possible."""
    if not len(a):
        return pa.array([], pa.bool_())
    x, y = (np.frombuffer(b"".join(v.to_pylist()), np.uint8).reshape(len(v), -1) for v in (a, b))
    return pa.array((x == y).mean(axis=1) >= LEAST_AGREEMENT)


@F.arrow_udf(T.LongType())
def _shared(a: pa.Array, b: pa.Array) -> pa.Array:
    """Size of the intersection of two sorted sets."""
    found = [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)]
    return pa.array(found, pa.int64())


def _wanted_sets(wanted: DataFrame, source: DataFrame, width: int, label: str) -> tuple[DataFrame, str]:
    """(node, elements) of the nodes of ``wanted`` (node, doc_id, text_hash), from one text of each."""
    names = few(wanted.select("node", F.col("doc_id").alias("want_id"), F.col("text_hash").alias("want_hash")))
    found = source.join(names, (source["text_hash"] == names["want_hash"]) & source["doc_id"].eqNullSafe(names["want_id"])).select("node", "text")
    return materialise(found.mapInArrow(frugal(_sets(width)), "node binary, elements binary").dropDuplicates(["node"]), label)


def _confirm(pairs: DataFrame, nodes: DataFrame, source: DataFrame, width: int, percent: int, label: str) -> DataFrame:
    """The pairs (a, b) of ``pairs`` whose full sets are similar enough."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("signature").alias(f"signature_{x}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b")
    # sets of too different sizes can't be similar enough, whatever they share
    sized = sized.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    near, near_path = materialise(sized.filter(_agrees("signature_a", "signature_b")).select("a", "b", "n_a", "n_b"), f"{label}-near")
    ends = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted, wanted_path = materialise(ends.join(nodes, "node").select("node", "doc_id", "text_hash"), f"{label}-wanted")
    sets, sets_path = _wanted_sets(wanted, source, width, f"{label}-sets")
    one = lambda x: sets.select(F.col("node").alias(x), F.col("elements").alias(f"elements_{x}"))
    both = near.join(one("a"), "a").join(one("b"), "b").withColumn("shared", _shared("elements_a", "elements_b"))
    links, _ = materialise(both.filter(100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))).select("a", "b"), f"{label}-links")
    for path in (near_path, wanted_path, sets_path):
        remove(source.sparkSession, path)
    return links


def _bucketed(members: DataFrame, label: str) -> tuple[DataFrame, str]:
    """(band, node, leader, n) of the buckets with several nodes."""
    counted, path = materialise(members.groupBy("band").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1"), f"{label}-counts")
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = materialise(join_facts(members, counted, ["band"], "n", total), label)
    remove(members.sparkSession, path)
    return found


def _stars(buckets: DataFrame) -> DataFrame:
    """Each node with its bucket's smallest."""
    return buckets.filter("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()


def _mixed(buckets: DataFrame, found: DataFrame, label: str) -> tuple[DataFrame, str]:
    """(band, node, root, main, n) of the buckets of more than two nodes with several components, without
    their smallest nodes; `main` is the component of those."""
    spark = buckets.sparkSession
    grouped, path = materialise(buckets.filter("n > 2").join(found, "node", "left").withColumn("root", F.coalesce("root", "node")), f"{label}-grouped")
    main = F.max(F.when(F.col("node") == F.col("leader"), F.col("root")))
    facts = grouped.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), main.alias("main"), F.max("n").alias("n"))
    several, several_path = materialise(facts.filter("low <> high").select("band", "main", "n"), f"{label}-several")
    total = several.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    mixed = join_facts(grouped.filter("node <> leader").drop("n"), several, ["band"], "n", total)
    out = materialise(mixed.select("band", "node", "root", "main", "n"), label)
    remove(spark, path)
    remove(spark, several_path)
    return out


def _across(mixed: DataFrame) -> DataFrame:
    """The pairs across components: each node outside its bucket's main component with those of other components."""
    outside = mixed.filter("root <> main").select("band", F.col("node").alias("a"), F.col("root").alias("root_a"))
    inside = mixed.select("band", F.col("node").alias("b"), F.col("root").alias("root_b"), "main")
    return outside.join(inside, "band").filter("root_a <> root_b AND (root_b = main OR a < b)").select("a", "b").distinct()


def _common_marks(sets: DataFrame) -> bytes:
    """A bit for each common shingle, at its number modulo the bits."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(raw, np.int64))], names=["shingle"])

    common = sets.select("elements").mapInArrow(frugal(spread), "shingle long").groupBy("shingle").count().filter(F.col("count") >= COMMON)
    place = F.pmod("shingle", F.lit(_MARKS))
    pages = common.groupBy(F.bitmap_bucket_number(place).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    marks = np.zeros(_MARKS // 8, np.uint8)
    for row in pages.collect():  # 4 KB a row, 8 MB at the most
        # places count from 1, so place 0 is alone on a page of its own; it may go unmarked
        if row.page > 0:
            at = (row.page - 1) * 4096
            held = np.frombuffer(row.bits, np.uint8)[: len(marks) - at]
            marks[at : at + len(held)] = held
    return marks.tobytes()


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(band, node): the rarest shingles of each set, as many as any similar set must share one of."""
    shared = sets.sparkSession.sparkContext.broadcast(_common_marks(sets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            nodes, bands = [], []
            for node, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                elements = np.frombuffer(raw, np.int64)
                place = elements % _MARKS - 1  # bit p - 1 stands for place p
                is_common = (marks[place >> 3] >> (place & 7).astype(np.uint8)) & 1
                length = len(elements) - -(-percent * len(elements) // 100) + 1
                bands.append(elements[np.lexsort((elements, is_common))[:length]])
                nodes += [node] * length
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(bands) if bands else [], pa.int64()), pa.array(nodes, pa.binary())], names=["band", "node"])

    return sets.mapInArrow(frugal(run), "band long, node binary")


def _blockwise(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) between the components of large buckets.

    Buckets with the same main component form a group.  Its nodes outside that component are
    tried with all its nodes, both cut into blocks of some `BLOCK` nodes; of an outsider, one
    link to each other component leaves a block.
    """
    members = mixed.select(F.col("main").alias("g"), "node", "root").distinct()
    counts = members.groupBy("g").agg(F.count(F.lit(1)).alias("n_in"), F.count_if(F.col("root") != F.col("g")).alias("n_out"))
    blocks = counts.select("g", F.ceil(F.col("n_in") / BLOCK).cast("int").alias("n_in"), F.ceil(F.col("n_out") / BLOCK).cast("int").alias("n_out"))
    rows, path = materialise(members.join(blocks, "g").join(sets, "node"), "group-rows")
    again = rows.sparkSession.read.schema(rows.schema).parquet(path)
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    inside = rows.withColumn("i", own("n_in")).withColumn("o", every("n_out")).select("g", "i", "o", "node", "root", "elements")
    outside = again.filter("root <> g").withColumn("o", own("n_out")).withColumn("i", every("n_in")).select("g", "i", "o", "node", "root", "elements")

    def link(members: pa.Table, outsiders: pa.Table) -> pa.Table:
        a, b = [], []
        if members.num_rows and outsiders.num_rows:
            nodes, roots = members["node"].to_pylist(), members["root"].to_pylist()
            held = [np.frombuffer(x, np.uint64) for x in members["elements"].to_pylist()]
            sizes = np.array([len(x) for x in held])
            flat, owner = np.concatenate(held), np.repeat(np.arange(len(held)), sizes)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            for node, root, raw in zip(*(outsiders[c].to_pylist() for c in ("node", "root", "elements")), strict=True):
                own = np.frombuffer(raw, np.uint64)
                begin = np.searchsorted(flat, own, "left")
                n = np.searchsorted(flat, own, "right") - begin
                at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
                shared = np.bincount(owner[at], minlength=len(held))
                seen = {root}
                for k in np.flatnonzero(100 * shared >= percent * (sizes + len(own) - shared)):
                    if roots[k] not in seen:
                        seen.add(roots[k])
                        a.append(node)
                        b.append(nodes[k])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    key = ["g", "i", "o"]
    links, _ = materialise(inside.groupBy(*key).cogroup(outside.groupBy(*key)).applyInArrow(link, "a binary, b binary"), "blocks")
    remove(rows.sparkSession, path)
    return links


def components(links: DataFrame) -> DataFrame:
    """Union-find over links (a, b): (node, root) of every linked node, `root` its component's smallest.

    A round hooks each node to its smallest neighbour below it, halves all paths until they
    are flat, and contracts the links to the roots; it ends when no link is left between
    roots.  Every step is a pre-aggregated join over all tasks, written to the shared folder.
    """
    spark = links.sparkSession
    flat = lambda e: e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges, edges_path = materialise(flat(links), "edges")
    total, total_path = None, None
    while not edges.isEmpty():
        parents, path = materialise(edges.groupBy("a").agg(F.min("b").alias("p")), "parents")
        while True:
            up = parents.select(F.col("a").alias("p"), F.col("p").alias("higher"))
            moved, new_path = materialise(parents.join(up, "p", "left").select("a", F.coalesce("higher", "p").alias("p"), F.col("higher").isNotNull().alias("moved")), "parents")
            remove(spark, path)
            parents, path, changed = moved.select("a", "p"), new_path, not moved.filter("moved").isEmpty()
            if not changed:
                break
        of = parents.select(F.col("a").alias("x"), F.col("p").alias("root"))
        lifted = edges.join(of.withColumnRenamed("x", "a"), "a", "left").select(F.coalesce("root", "a").alias("a"), "b")
        lifted = lifted.join(of.withColumnRenamed("x", "b"), "b", "left").select("a", F.coalesce("root", "b").alias("b"))
        edges, new_edges_path = materialise(flat(lifted), "edges")
        remove(spark, edges_path)
        edges_path = new_edges_path
        if total is None:
            total, total_path = parents, path
        else:
            joined = total.join(parents.select(F.col("a").alias("p"), F.col("p").alias("higher")), "p", "left").select("a", F.coalesce("higher", "p").alias("p"))
            total, new_total_path = materialise(joined.unionByName(parents).distinct(), "roots")
            remove(spark, total_path)
            remove(spark, path)
            total_path = new_total_path
    remove(spark, edges_path)
    if total is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    roots = total.select(F.col("p").alias("node"), F.col("p").alias("root")).distinct()
    return total.select(F.col("a").alias("node"), F.col("p").alias("root")).unionByName(roots)


def _components(docs: DataFrame, width: int, percent: int, bands: int, rows: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Per row (doc_id, text_hash, n_shingles, node), per node (node, component), and the folders that hold them.

    `component` is the least (no_id, doc_id, text_hash) of the component's rows.  Rows without
    shingles have a null node.
    """
    spark = docs.sparkSession
    small_batches(spark)
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(docs[text_col]).alias("text_hash"), docs[text_col].alias("text"))
    schema = "doc_id long, text_hash long, n_shingles long, node binary, signature binary, bands array<long>"
    signed, signed_path = materialise(source.mapInArrow(frugal(_signatures(width, bands, rows)), schema), "signed")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    some = signed.filter("node IS NOT NULL")
    best = some.groupBy("node").agg(F.min(row).alias("row"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"), F.first("bands").alias("bands"))
    nodes, nodes_path = materialise(best.select("node", "row", "row.doc_id", "row.text_hash", "n_shingles", "signature", "bands"), "nodes")

    buckets, buckets_path = _bucketed(nodes.select("node", F.explode("bands").alias("band")), "buckets")
    links = _confirm(_stars(buckets), nodes, source, width, percent, "star")
    found = components(links)
    mixed, mixed_path = _mixed(buckets, found, "mixed")
    pairs = _across(mixed.filter(F.col("n") <= DIRECT))
    crowd = mixed.filter(F.col("n") > DIRECT).select("node")
    leaders = buckets.filter(F.col("n") > DIRECT).join(mixed.select("band").distinct(), "band", "left_semi").select(F.col("leader").alias("node"))
    wanted, wanted_path = materialise(crowd.union(leaders).distinct().join(nodes, "node").select("node", "doc_id", "text_hash"), "crowd")
    crowded = not wanted.isEmpty()
    if crowded:
        sets, sets_path = _wanted_sets(wanted, source, width, "crowd-sets")
        prefixes, prefixes_path = materialise(_prefixes(sets, percent), "prefixes")
        lists, lists_path = _bucketed(prefixes, "lists")
        remove(spark, prefixes_path)
        pairs = pairs.union(_stars(lists)).distinct()
    found, links = _united(links, found, _confirm(pairs, nodes, source, width, percent, "across"))
    if crowded:
        left, left_path = _mixed(lists, found, "left")
        direct = _confirm(_across(left.filter(F.col("n") <= DIRECT)), nodes, source, width, percent, "lists")
        blocks = _blockwise(left.filter(F.col("n") > DIRECT), sets, percent)
        found, links = _united(links, found, direct.unionByName(blocks))
        for path in (sets_path, lists_path, left_path):
            remove(spark, path)

    rooted, rooted_path = materialise(nodes.select("node", "row").join(found, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    least, least_path = materialise(rooted.groupBy("root").agg(F.min("row").alias("component"), F.count(F.lit(1)).alias("n")), "least")
    labelled, labelled_path = materialise(join_facts(rooted.drop("row"), least, ["root"], "n", nodes.count()).select("node", "component"), "labelled")
    for path in (nodes_path, buckets_path, mixed_path, wanted_path, rooted_path, least_path):
        remove(spark, path)
    return signed.drop("signature", "bands"), labelled, [signed_path, labelled_path]


def near_components(docs: DataFrame, width: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * |intersection| >= `percent` * |union| of their sets of
    `width`-word shingles (all words, if there are fewer); A-Z is lower-cased and ASCII white
    space parts words.  `component_id` is the smallest doc_id of the component, and `kept`
    says whether a document has it.

    With 32 bands of 4 rows, a pair of similarity 0.75 shares no band with probability below
    1e-5, of 0.8 below 1e-7.  Null and empty texts have no shingles and are linked with
    nothing.  Equal sets need no link.  A null id is no component's smallest and isn't kept,
    unless all ids of the component are null: then its `component_id` is null and all its rows
    are kept.  Rows that repeat an id are nodes by their texts; further columns are ignored;
    an empty table gives an empty result.
    """
    signed, labelled, _ = _components(docs, width, percent, bands, rows, id_col, text_col)
    out = signed.select("doc_id", "n_shingles", "node").join(labelled, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component.doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _united(links: DataFrame, found: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Components and links with ``more`` links."""
    if more.isEmpty():
        return found, links
    every = links.unionByName(more)
    return components(every), every


def drop_near_duplicates(docs: DataFrame, width: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with exactly one row of each component, all columns as they are.

    It is a row with the component's smallest id, of those the one with the least text hash;
    null ids come last.  Of rows that repeat id and text, any one stays.  Rows whose texts
    have no shingles all stay, whatever their ids.
    """
    spark = docs.sparkSession
    signed, labelled, paths = _components(docs, width, percent, bands, rows, id_col, text_col)
    key, some = ["doc_id", "text_hash"], signed.filter("node IS NOT NULL")
    first = F.col("component.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("component.text_hash") == F.col("text_hash"))
    # a text of an id is a member of one component; it goes, or stays once
    held = some.groupBy(*key, "node").agg(F.count(F.lit(1)).alias("n")).join(labelled, "node")
    names = {x: unused(docs, f"near_{x}") for x in ("id", "hash", "of_id", "of_hash", "once")}
    decided = held.filter(~first | (F.col("n") > 1)).select(F.col("doc_id").alias(names["of_id"]), F.col("text_hash").alias(names["of_hash"]), first.alias(names["once"]))
    decided, _ = materialise(decided, "near-copies")
    for path in paths:
        remove(spark, path)
    rows_of = docs.withColumns({names["hash"]: F.xxhash64(docs[text_col]), names["id"]: docs[id_col].cast("long")})
    on = [F.col(names[x]).eqNullSafe(F.col(names[f"of_{x}"])) for x in ("id", "hash")]
    whole = rows_of.join(few(decided), on, "left_anti").select(*docs.columns)
    repeated = decided.filter(names["once"])
    if repeated.isEmpty():
        return whole
    once = rows_of.join(few(repeated), on, "left_semi").dropDuplicates([names["id"], names["hash"]])
    return whole.unionByName(once.select(*docs.columns))
