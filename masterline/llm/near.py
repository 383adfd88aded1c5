"""Near-duplicates by the exact likeness of shingle sets; blocks of SimHashes and prefixes of the sets find what to compare."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masterline.llm import simhash
from masterline.llm.common import join_skewed, small, stage, text_of
from masterline.llm.components import components

SHINGLE = 5
#: Least Jaccard likeness of near-duplicates, as a fraction of integers: 0.8.
LIKE = (4, 5)
#: Bits of 128 in which SimHashes of sets that share a prefix key may differ to be compared: at 0.8, 19.4 are
#: expected (24 between 4 and 5 shingles) with a deviation of 4, between unrelated sets 64. By the binomial law more
#: than 42 differ in 5 of 100,000 pairs of 4 and 5 shingles, which are then not compared, and in less than one of a
#: million pairs of any more.
FAR = 42
#: Texts in which common shingles are counted, and the number of these: they come last in prefixes. Any order
#: finds all pairs; this one keeps blocks small.
SAMPLE, COMMON = 5_000, 50_000
#: Rows of a block, and shingles of a group, that one task compares; larger ones are dealt as pairs of parts.
BLOCK_ROWS = 32_768
GROUP_SHINGLES = 20_000
SEEN = 100_000
#: One in so many nodes is counted to tell which blocks are large. That decides how rows are dealt, not what links.
COUNTED = 64
#: Bytes of pivots' texts up to which they are broadcast.
PIVOT_BYTES = 16 << 20


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Different XXH64 of a text's word shingles, sorted; fewer words than a shingle are one. Words as in simhash."""
    import xxhash

    words = text.encode().lower().split()
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words or [b""]]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    stops = ends[min(shingle, len(ends)) - 1 :].tolist()
    return np.unique(np.array([xxhash.xxh64_intdigest(joined[a:b]) for a, b in zip(starts, stops, strict=False)], dtype="<u8"))


def sketch(found: np.ndarray) -> np.ndarray:
    """128-bit SimHash (two uint64) of a set of shingles."""
    mixed = (found ^ (found >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    both = np.stack([found, mixed ^ (mixed >> np.uint64(31))], axis=1)
    counts = np.zeros(128, dtype=np.int64)
    for i in range(0, len(both), 1 << 15):
        counts += np.unpackbits(both[i : i + (1 << 15)].view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(2 * counts > len(both), bitorder="little").view("<u8")


def prefix(found: np.ndarray, common: tuple[np.ndarray, np.ndarray], like: tuple[int, int] = LIKE) -> np.ndarray:
    """The first shingles of a set in one order for all sets, rare ones first.

    Sets as like as `like` share over all but this many of either, so they share one of these.
    """
    hashes, ranks = common
    rank = np.zeros(len(found), dtype=np.int64)
    if len(hashes):
        at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
        rank = np.where(hashes[at] == found, ranks[at], 0)
    n = len(found) + 1 - -(-like[0] * len(found) // like[1])
    return found[np.lexsort((found, rank))[:n]]


def alike(sets: list[np.ndarray], like: tuple[int, int] = LIKE) -> list[tuple[int, int]]:
    """Edges (member, first of its group) of the groups that likeness makes among sets; every pair counts, exactly."""
    sizes = np.array([len(s) for s in sets])
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
    ends = np.cumsum(sizes)
    own = [flat[b - n : b] for b, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
    taken, marked = np.zeros(len(sets), dtype=bool), np.zeros(flat.max() + 1, dtype=bool)
    left, here, at, edges = np.arange(len(sets)), flat, ends - sizes, []
    for first in range(len(sets)):
        if taken[first]:
            continue
        taken[first], todo = True, [first]
        while todo:
            i = todo.pop()
            free = ~taken[left]
            if not free.any():
                return edges
            if 2 * np.count_nonzero(free) < len(left):
                left = left[free]
                here, at, free = np.concatenate([own[k] for k in left]), np.cumsum(sizes[left]) - sizes[left], free[free]
            marked[own[i]] = True
            both = np.add.reduceat(marked[here], at, dtype=np.int64)
            marked[own[i]] = False
            near = left[free & (like[1] * both >= like[0] * (sizes[left] + sizes[i] - both))]
            taken[near] = True
            todo.extend(near.tolist())
            edges.extend((k, first) for k in near.tolist())
    return edges


def close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64) <= FAR


def stars(nodes: np.ndarray, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Members and firsts of the groups that close fingerprints make: at most one edge for each node."""
    left = np.arange(len(nodes))
    while len(left) > 1:
        first, left = left[0], left[1:]
        todo = [first]
        while todo and len(left):
            near = close(fps[left], fps[todo.pop()])
            if near.any():
                todo.extend(left[near])
                yield nodes[left[near]], np.broadcast_to(nodes[first], np.count_nonzero(near))
                left = left[~near]


def in_parts(df: DataFrame, key: str, parts: DataFrame, n: int) -> DataFrame:
    """df with `pair`: rows of the n keys in parts(key, parts) come once for each pair of parts that they are in."""
    if not n:
        return df.withColumn("pair", F.lit(0))
    df = df.join(small(parts, n), key, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    df = df.withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return df.withColumn("pair", F.least("own", "other") * F.col("parts") + F.greatest("own", "other")).drop("parts", "own", "other")


def common_shingles(texts: DataFrame, sample: int = SAMPLE, most: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that come in several of a sample of texts, sorted, and their ranks from 1 by frequency."""
    share = max(1, texts.count() // sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text.as_py()).view(np.int64))], names=["h"])

    drawn = texts.filter(F.pmod(F.xxhash64("row"), F.lit(share)) == 0).select("text")
    counts = drawn.mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = counts.orderBy(F.col("n").desc(), "h").limit(most).collect()
    found = np.array([r["h"] for r in rows], dtype=np.int64).view(np.uint64)
    order = np.argsort(found)
    return found[order], np.arange(len(found), 0, -1)[order]


def sketches(texts: DataFrame, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """row, d0, d1 (hash of the set), f0, f1 (SimHash), n (shingles) and keys (its prefix) of texts(row, text)."""
    shared = texts.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        longs = pa.list_(pa.int64())
        for batch in batches:
            fixed, keys = [], []
            for text in batch.column(1):
                found = shingles(text.as_py())
                digest = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), dtype=np.int64)
                fixed.append([*digest.tolist(), *sketch(found).view(np.int64).tolist(), len(found)])
                keys.append(prefix(found, shared.value).view(np.int64))
            columns = np.array(fixed, dtype=np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(columns[:, i]) for i in range(5)), pa.array(keys, longs)], names=["row", "d0", "d1", "f0", "f1", "n", "keys"])

    return texts.mapInArrow(run, "row long, d0 long, d1 long, f0 long, f1 long, n long, keys array<long>")


def simhash_candidates(nodes: DataFrame) -> DataFrame:
    """Edges a, b that connect the nodes(node, f0) whose SimHashes f0 differ in at most simhash.DISTANCE bits: pigeonhole
    blocks of the bits, and the Hamming distance verified, as in op6. Nodes of one SimHash link to the least of them."""
    firsts = stage(nodes.groupBy("f0").agg(F.min("node").alias("first")), "simhashes")
    of = lambda c: firsts.select(F.col("f0").alias(c), F.col("first").alias(f"_{c}"))
    across = simhash.links(firsts.select("f0")).join(of("a"), "a").join(of("b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    return across.unionByName(nodes.join(firsts, "f0").filter("node != first").select(F.col("node").alias("a"), F.col("first").alias("b")))


def candidates(nodes: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Edges a, b that connect what shares a prefix key and has close SimHashes, of nodes(node, f0, f1, keys)."""
    share = max(1, min(COUNTED, block_rows // 256))
    drawn = nodes.filter(F.pmod(F.xxhash64("node"), F.lit(share)) == 0).select(F.explode("keys").alias("key"))
    sizes = stage(drawn.groupBy("key").agg((F.count(F.lit(1)) * share).alias("n")).filter(F.col("n") > block_rows), "large-keys")
    parts = sizes.select("key", F.ceil(2 * F.col("n") / block_rows).cast("int").alias("parts"))
    large = sizes.count()
    keyed = in_parts(nodes.select("node", "f0", "f1", F.explode("keys").alias("key")), "key", parts, large)
    keys = ["key", "pair"] if large else ["key"]
    k = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = np.empty((0, k + 3), dtype=np.int64), set()
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)])
            last = np.flatnonzero((rows[:, :k] == rows[-1, :k]).all(axis=1))[0]  # the last block may go on in the next batch
            yield from edges_of(rows[:last], seen)
            held = rows[last:]
        yield from edges_of(held, seen)

    def edges_of(rows: np.ndarray, seen: set) -> Iterator[pa.RecordBatch]:
        if len(rows) < 2:
            return
        border = np.concatenate([[0], np.flatnonzero((rows[1:, :k] != rows[:-1, :k]).any(axis=1)) + 1, [len(rows)]])
        size = np.diff(border)
        fps = rows[:, k + 1 :].astype(np.uint64)
        two = border[:-1][size == 2]
        two = two[close(fps[two], fps[two + 1])]
        a, b = [rows[two + 1, k]], [rows[two, k]]
        for x in np.flatnonzero(size > 2).tolist():
            i, j = border[x], border[x + 1]
            members = rows[i:j, k].copy()
            if (name := members.tobytes() if len(members) < 64 else None) in seen:
                continue
            if name and len(seen) < SEEN:
                seen.add(name)
            for member, first in stars(members, fps[i:j]):
                a.append(member)
                b.append(first)
        pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0)
        if len(pairs):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    dealt = keyed.select(*keys, "node", "f0", "f1").repartition(*keys).sortWithinPartitions(*keys, "node")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def likeness(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return LIKE[1] * both >= LIKE[0] * (len(a) + len(b) - both)


def near_pivot(members: DataFrame) -> DataFrame:
    """node, near: whether each of members(node, text, pivot_text) is as like its group's pivot as LIKE."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pivot = None, None
        for batch in batches:
            out = []
            for text, other in zip(batch.column(1), batch.column(2), strict=True):
                if (given := other.as_py()) != last:
                    last, pivot = given, shingles(given)
                out.append(likeness(shingles(text.as_py()), pivot))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.bool_())], names=["node", "near"])

    return members.select("node", "text", "pivot_text").mapInArrow(run, "node long, near boolean")


def verified(members: DataFrame, group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """Edges a, b that connect exactly the sets at least as like as LIKE within each root, of members(root, node, n, text).

    A group of more shingles than a task should hold is first compared with one of its members, the pivot: what is
    like it hangs together through it, however much that is, and is spread over tasks. Only what is left is
    compared with everything else, and with itself, in pairs of parts.
    """
    sizes = stage(members.groupBy("root").agg(F.sum("n").alias("n"), F.min("node").alias("pivot")).filter(F.col("n") > group_shingles), "large-groups")
    large = sizes.count()
    whole = members.withColumn("pair", F.lit(0).cast("long"))
    if not large:
        return compared(whole)
    few = small(sizes.select("root"), large)
    of_large = members.join(small(sizes.select("root", "pivot"), large), "root")
    pivots = of_large.filter("node = pivot").select("root", F.col("text").alias("pivot_text"))
    held = pivots.agg(F.coalesce(F.sum(F.octet_length("pivot_text")), F.lit(0))).first()[0]
    near = stage(near_pivot(of_large.join(F.broadcast(pivots) if held <= PIVOT_BYTES else pivots, "root")), "near-pivot")
    known = stage(of_large.select("root", "node", "n", "pivot").join(near, "node"), "large-members")
    # parts of a group are the larger the larger it is, as every part meets every part of what is left
    unit = F.greatest(F.lit(group_shingles / 2), F.least(F.lit(group_shingles * 50.0), F.col("n") / 32))
    plan = known.groupBy("root").agg(F.sum(F.when(~F.col("near"), F.col("n")).otherwise(0)).alias("far"), F.sum("n").alias("n"))
    plan = stage(plan.filter("far > 0").select("root", F.ceil(F.col("far") / unit).alias("p"), F.greatest(F.lit(1), F.ceil((F.col("n") - F.col("far")) / unit)).alias("q")), "large-plan")
    dealt = of_large.join(known.select("node", "near"), "node").join(small(plan), "root")
    own, all_parts = F.pmod(F.xxhash64("node"), F.when(F.col("near"), F.col("q")).otherwise(F.col("p"))), F.col("p") + F.col("q")
    dealt = dealt.withColumn("own", own).withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("near"), F.col("p")).otherwise(all_parts) - 1)))
    pair = F.when(F.col("near"), F.col("o") * all_parts + F.col("p") + F.col("own")).when(F.col("o") < F.col("p"), F.least("own", "o") * all_parts + F.greatest("own", "o")).otherwise(F.col("own") * all_parts + F.col("o"))
    rest = dealt.withColumn("pair", pair.cast("long"))
    stars_ = known.filter("near AND node != pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    columns = ["root", "pair", "node", "text"]
    return compared(whole.join(few, "root", "left_anti").select(*columns).unionByName(rest.select(*columns))).unionByName(stars_)


def compared(dealt: DataFrame) -> DataFrame:
    """Edges a, b of dealt(root, pair, node, text): what comes together is compared, exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, nodes, sets = None, [], []
        for batch in batches:
            for root, pair, node, text in zip(*(batch.column(c) for c in range(4)), strict=True):
                if (root.as_py(), pair.as_py()) != group:
                    yield from edges_of(nodes, sets)
                    group, nodes, sets = (root.as_py(), pair.as_py()), [], []
                nodes.append(node.as_py())
                sets.append(shingles(text.as_py()))
        yield from edges_of(nodes, sets)

    def edges_of(nodes: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if len(sets) > 1 and (edges := alike(sets)):
            yield pa.RecordBatch.from_arrays([pa.array([nodes[e[k]] for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"])

    dealt = dealt.select("root", "pair", "node", "text")
    return dealt.repartition("root", "pair").sortWithinPartitions("root", "pair", "node").mapInArrow(run, "a long, b long").distinct()


def near_groups(docs: DataFrame, block_rows: int = BLOCK_ROWS, group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """row, group (the row of one member) of docs(row long, all different, text): documents are linked by a
    Jaccard likeness of 0.8 or more of their sets of five-word shingles, and links go on.

    SimHashes within 4 bits are found by pigeonhole blocks of the bits, as in op6. These see few of the pairs at 0.8, so
    the rest is found by blocks of the shingle sets: sets as like share one of the rarest shingles of each, whatever
    else differs, and those that share one have the Hamming distance of longer SimHashes verified. What either finds
    makes candidate groups, inside each of which likeness is computed from the texts. Equal sets are
    one node, so copies are never paired. Null and blank texts have one shingle, the empty one, so they are
    copies of each other; fewer than five words are one shingle; very long texts pass whole, one at a time; an
    empty table gives an empty result.
    """
    texts = docs.select("row", text_of("text").alias("text"))
    sketched = stage(sketches(texts, common_shingles(texts)), "sketches")
    firsts = stage(sketched.groupBy("d0", "d1").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("copies")), "sets")
    copies = stage(sketched.select("row").join(firsts.select(F.col("node").alias("row")), "row", "left_anti"), "copies")
    nodes = sketched.join(small(copies), "row", "left_anti").withColumnRenamed("row", "node")
    found = simhash_candidates(nodes).unionByName(candidates(nodes, block_rows)).distinct()
    loose = components(stage(found, "candidates"))
    sizes = sketched.select(F.col("row").alias("node"), "n")
    members = stage(texts.withColumnRenamed("row", "node").join(small(stage(loose.join(sizes, "node"), "loose")), "node"), "members")
    exact = components(stage(verified(members, group_shingles), "links"))
    of = stage(firsts.join(exact, "node", "left").select("d0", "d1", "copies", F.coalesce("root", "node").alias("group")), "groups")
    return join_skewed(sketched.select("row", "d0", "d1"), of, ["d0", "d1"], "copies", sketched.count()).select("row", "group")
