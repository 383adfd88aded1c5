"""Sharding by best-fit-decreasing bin packing of indivisible groups."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masterline.llm.common import join_skewed, ranked, stage, text_of

SHARDS = 40
ROW_BYTES = 16

#: A run of equal groups: their size, the rank of the first among groups of that size, how many, and their bin.
Run = tuple[int, int, int, int]


class Remaining:
    """Ordered set of (remaining capacity, bin) as a B+ tree of two levels: leaves split when full, so they stay
    balanced, and both levels are searched by halving."""

    LEAF = 16

    def __init__(self) -> None:
        self.leaves: list[list[tuple[int, int]]] = []
        self.tops: list[tuple[int, int]] = []

    def add(self, entry: tuple[int, int]) -> None:
        if not self.leaves:
            self.leaves, self.tops = [[entry]], [entry]
            return
        i = min(bisect_left(self.tops, entry), len(self.leaves) - 1)
        leaf = self.leaves[i]
        insort(leaf, entry)
        if len(leaf) > self.LEAF:
            self.leaves[i : i + 1] = [leaf[: len(leaf) // 2], leaf[len(leaf) // 2 :]]
            self.tops[i : i + 1] = [x[-1] for x in self.leaves[i : i + 2]]
        else:
            self.tops[i] = leaf[-1]

    def pop_at_least(self, size: int) -> tuple[int, int] | None:
        """Remove and return the tightest entry with room for size."""
        i = bisect_left(self.tops, (size, -1))
        if i == len(self.leaves):
            return None
        leaf = self.leaves[i]
        entry = leaf.pop(bisect_left(leaf, (size, -1)))
        if leaf:
            self.tops[i] = leaf[-1]
        else:
            del self.leaves[i], self.tops[i]
        return entry


def best_fit_decreasing(counts: list[tuple[int, int]], capacity: int, most: int | None = None) -> tuple[list[Run], int]:
    """Runs of equal groups with their bins, and the number of bins, of (size, how many) by falling size.

    Each group enters the bin with the tightest remaining capacity that holds it, else a new bin. A bin that
    took a group of some size stays the tightest for that size until it is too full, so a whole run is placed
    in one step: the result is that of placing groups one by one, at the cost of one step or two for each
    size. Ends early, short of groups, beyond `most` bins.
    """
    tree, runs, n = Remaining(), [], 0
    for size, left in counts:
        rank = 0
        while left:
            found = tree.pop_at_least(size)
            if found is None:
                if n == most:
                    return runs, n + 1
                found, n = (max(capacity, size), n), n + 1
            take = min(left, found[0] // size)
            runs.append((size, rank, take, found[1]))
            tree.add((found[0] - take * size, found[1]))
            rank, left = rank + take, left - take
    return runs, n


def balanced(counts: list[tuple[int, int]], shards: int) -> list[Run]:
    """Runs with their shard, of (size, how many): best fit at the least capacity, searched from the fair share
    up, at which it needs no more than `shards` bins.

    A group above the fair share of what is left can't be divided, so it gets a shard of its own first.
    """
    runs, rest, taken, own, total = [], [], {}, 0, sum(s * n for s, n in counts)
    for size, n in sorted(counts, reverse=True):
        alone = 0
        while alone < n and own < shards - 1 and size * (shards - own) > total:
            runs.append((size, alone, 1, own))
            alone, own, total = alone + 1, own + 1, total - size
        taken[size] = alone
        if alone < n:
            rest.append((size, n - alone))
    if not rest:
        return runs
    k = shards - own
    low = high = max(-(-total // k), rest[0][0])
    step = 1
    while best_fit_decreasing(rest, high, k)[1] > k:
        low, high, step = high + 1, high + step, 2 * step
    while low < high:
        middle = (low + high) // 2
        if best_fit_decreasing(rest, middle, k)[1] <= k:
            high = middle
        else:
            low = middle + 1
    return runs + [(size, rank + taken[size], n, own + b) for size, rank, n, b in best_fit_decreasing(rest, high, k)[0]]


def placed(groups: DataFrame, runs: list[Run]) -> DataFrame:
    """groups(bytes, _rank, ...) with their shard, from the runs, which are broadcast as one sorted array."""
    table = np.array(sorted(runs), dtype=np.int64).reshape(-1, 4)
    sizes, at = np.unique(table[:, 0], return_inverse=True)
    plan = groups.sparkSession.sparkContext.broadcast((sizes, at << 40 | table[:, 1], table[:, 3]))
    columns = [c for c in groups.columns if c != "_rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, keys, shards = plan.value
        for batch in batches:
            size, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("bytes", "_rank"))
            found = shards[np.searchsorted(keys, np.searchsorted(sizes, size) << 40 | rank, "right") - 1] if len(keys) else size
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(found.astype("int32"))], names=[*columns, "shard"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in groups.schema if f.name in columns)
    return groups.mapInArrow(run, f"{fields}, shard int")


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, shard, slot: rows with equal texts stay together, shards are near equal in bytes.

    Groups of equal texts are summed where the rows are. Every group is packed by its own size: groups of one
    size are interchangeable, so what reaches the driver is how many there are of each size. Sizes that differ
    add up, so k of them take at least k * k / 2 bytes: at most the root of twice the corpus's bytes come, some
    250,000 numbers at 30 GB. The plan, a run or two for each size, is broadcast, and a group finds its shard
    by its rank among groups of its size. Rows find their group's shard in a join that broadcasts the groups
    with most copies. Null text counts as empty (16 bytes); null and repeated ids keep a row each; ties in size
    go by the text's digest; an empty table gives none.
    """
    text = text_of(text_col)
    rows = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("group"),
        ),
        "shard-rows",
    )
    groups = stage(rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("copies")), "shard-groups")
    sizes = stage(groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("rows")), "shard-sizes").collect()
    n = sum(r["rows"] for r in sizes)
    runs = balanced([(r["bytes"], r["n"]) for r in sizes], shards)
    numbered = ranked(groups, "bytes", [F.col("group")], "_rank", sum(r["n"] for r in sizes))
    of = stage(placed(numbered.select("group", "bytes", "copies", "_rank"), runs), "shard-of")
    found = join_skewed(rows, of.drop("bytes"), ["group"], "copies", n)
    return ranked(found, "shard", [F.col("doc_id"), F.col("group")], "slot", n).drop("group")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shard and slot under the law of near-equal bytes: see shard for edge cases."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
