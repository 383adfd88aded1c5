"""SimHash near-duplicate groups through pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from masterline.llm.common import join_skewed, scope, small, stage, text_of
from masterline.llm.components import components

SHINGLE = 4
SEED = 42
DISTANCE = 4
#: Rows of a block that one task compares; a larger block is dealt out as pairs of parts.
BLOCK_ROWS = 32_768
#: Blocks beyond the distance, all of which make a key: of 7 blocks every 3, so 35 keys of 27 bits, at any size.
EXTRA = 3
#: One in so many nodes is counted to tell which blocks are large. That decides how rows are dealt, not what links.
COUNTED = 64


def fingerprint(text: str, shingle: int = SHINGLE, seeds: tuple[int, ...] = (SEED,)) -> list[int]:
    """64-bit SimHashes (one for each seed) of a text's word shingles, repeats included; 0 without words.

    A-Z are lowered; words lie between ASCII white space; fewer words than a shingle are one shingle. A bit
    is 1 if set in over half of the shingles' XXH64.
    """
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return [0] * len(seeds)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    out = []
    for seed in seeds:
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, stops, strict=False)], dtype="<u8")
        counts = np.zeros(64, dtype=np.int64)
        for i in range(0, len(hashes), 1 << 16):
            part = hashes[i : i + (1 << 16)]
            counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out.append(int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0]))
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seeds: tuple[int, ...] = (SEED,)) -> DataFrame:
    """id and f0, f1, ... (64 bits as a signed long for each seed) of every document; null text is empty."""
    names = [f"f{i}" for i in range(len(seeds))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle, seeds) for t in batch.column(1)], dtype=np.uint64).reshape(-1, len(seeds)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[:, i]) for i in range(len(seeds)))], names=["id", *names])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(run, f"id {kind}, " + ", ".join(f"{n} long" for n in names))


def block_keys(fps: list[Column], distance: int, extra: int) -> Column:
    """Keys of a row of fingerprints: each is cut into distance + extra blocks, and every choice of `extra`
    blocks is a key. Fingerprints within the distance leave that many blocks equal, so share a key."""
    n = distance + extra
    edges = [64 * i // n for i in range(n + 1)]
    keys = []
    for fp in fps:
        for blocks in combinations(range(n), extra):
            mask = sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in blocks)
            keys.append(F.struct(F.lit(len(keys)).alias("choice"), fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)).alias("bits")))
    return F.array(*keys)


def linked(a: np.ndarray, b: np.ndarray, distance: int, total: int) -> np.ndarray:
    """Whether rows of fingerprints link: some one within distance, all together within total."""
    differ = np.bitwise_count(a ^ b)
    return (differ.min(-1) <= distance) & (differ.sum(-1, dtype=np.int64) <= total)


def grouped(fps: np.ndarray, distance: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, first of its group) of the groups that links make among different rows of fps."""
    if len(fps) <= 256 and np.count_nonzero(linked(fps[:, None], fps[None], distance, total)) == len(fps):
        return fps[:0], fps[:0]
    left, members, firsts = fps, [], []
    while len(left) > 1:
        first, left = left[0], left[1:]
        todo = [first]
        while todo and len(left):
            near = linked(left, todo.pop(), distance, total)
            if near.any():
                todo.extend(left[near])
                members.append(left[near])
                firsts.append(np.broadcast_to(first, left[near].shape))
                left = left[~near]
    return (np.concatenate(members), np.concatenate(firsts)) if members else (fps[:0], fps[:0])


def node_of(fps: list[Column]) -> Column:
    """One comparable value for a row of fingerprints."""
    return fps[0] if len(fps) == 1 else F.concat(*(F.lpad(F.hex(f), 16, "0") for f in fps))


def links(nodes: DataFrame, distance: int = DISTANCE, total: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Edges a, b (as node_of) that connect exactly what the links among nodes(f0, ...), all different, do.

    Rows with one key come together sorted, and each run is grouped in memory; a run gives at most one edge
    per member (to the first of its group), never all pairs. A key with more than block_rows rows is cut
    into parts, and each pair of parts is a run of its own, so every link is still seen and no task holds
    more.
    """
    names = sorted(nodes.columns)
    total = 64 * len(names) if total is None else total
    keyed = nodes.select(*names, F.explode(block_keys([F.col(c) for c in names], distance, EXTRA)).alias("key")).select(*names, "key.choice", "key.bits")
    share = max(1, min(COUNTED, block_rows // 256))
    counted = keyed.filter(F.pmod(F.xxhash64(*names), F.lit(share)) == 0).groupBy("choice", "bits").agg((F.count(F.lit(1)) * share).alias("n"))
    sizes = stage(counted.filter(F.col("n") > block_rows), "large-blocks")
    large = sizes.count()
    if large:
        parts = sizes.withColumn("parts", F.ceil(2 * F.col("n") / block_rows).cast("int")).drop("n")
        keyed = keyed.join(small(parts, large), ["choice", "bits"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        own = F.pmod(F.xxhash64(*names), F.col("parts")).cast("int")
        keyed = keyed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        keyed = keyed.withColumn("pair", F.least("own", "other") * F.col("parts") + F.greatest("own", "other"))
    else:
        keyed = keyed.withColumn("pair", F.lit(0))
    keys = ["choice", "bits", "pair"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 3 + len(names)), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.concatenate([held, np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (*keys, *names)], axis=1)])
            last = np.flatnonzero((rows[:, :3] == rows[-1, :3]).all(axis=1))[0]  # the last run may go on in the next batch
            yield from edges_of(rows[:last])
            held = rows[last:]
        yield from edges_of(held)

    def edges_of(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        border = [0, *(np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1).tolist(), len(rows)]
        a, b = [], []
        for i, j in zip(border, border[1:], strict=False):
            if j - i > 1:
                members, firsts = grouped(rows[i:j, 3:].view(np.uint64), distance, total)
                if len(members):
                    a.append(members)
                    b.append(firsts)
        if a:
            columns = [x[:, k].copy().view(np.int64) for x in (np.concatenate(a), np.concatenate(b)) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[f"{x}{k}" for x in "ab" for k in range(len(names))])

    dealt = keyed.select(*keys, *names).repartition(*keys).sortWithinPartitions(*keys, *names)
    edges = dealt.mapInArrow(run, ", ".join(f"{x}{k} long" for x in "ab" for k in range(len(names))))
    a, b = (node_of([F.col(f"{x}{k}") for k in range(len(names))]) for x in "ab")
    return edges.select(a.alias("a"), b.alias("b")).filter("a != b").distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE, seeds: tuple[int, ...] = (SEED,), total: int | None = None) -> DataFrame:
    """id, f0, ..., component_id: the least id reachable through links.

    Documents link if the SimHashes of some seed differ in at most `distance` bits, and those of all seeds
    together in at most `total`. Rows with equal fingerprints are one node, so copies cost one row each and
    are never paired. Null or empty texts have fingerprint 0 and link like any other; a row with a null id
    takes part, and a component of null ids only has a null component_id; an empty table gives an empty
    result.
    """
    rows = stage(fingerprints(docs, id_col, text_col, shingle, seeds), "fingerprints")
    names = [c for c in rows.columns if c != "id"]
    with scope(docs.sparkSession):
        found, n = components_of(rows, names, distance, total)
    return join_skewed(rows, found, names, "copies", n).select(F.col("id").alias(id_col), *names, "component_id")


def components_of(rows: DataFrame, names: list[str], distance: int, total: int | None) -> tuple[DataFrame, int]:
    """names, copies, component_id of the different fingerprints of rows(id, names), written, and the number of rows."""
    nodes = stage(rows.groupBy(*names).agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")), "fingerprint-nodes")
    roots = components(stage(links(nodes.select(*names), distance, total), "links"))
    rooted = nodes.withColumn("node", node_of([F.col(c) for c in names])).join(roots, "node", "left")
    rooted = stage(rooted.select(*names, "least", "copies", F.coalesce("root", "node").alias("root")), "roots")
    sizes = rooted.agg(F.coalesce(F.sum("copies"), F.lit(0)), F.count(F.lit(1))).first()
    ids = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members")), "component-ids")
    found = stage(join_skewed(rooted.select(*names, "copies", "root"), ids, ["root"], "members", sizes[1]).drop("root"), "component-of", outer=True)
    return found, sizes[0]


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and component: see near_groups for nulls, empty texts and copies."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_groups(docs).select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")
