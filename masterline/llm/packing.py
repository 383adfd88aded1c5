"""Best-fit packing of token sequences by minimum bin slack."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masterline.llm.common import ranked, stage, text_of

CAPACITY = 2048
END_ID = 0
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def encoder(ranks: bytes, pattern: str):
    """text -> ids, as the tokenizers library gives them for the .json of the same vocabulary.

    tiktoken holds that vocabulary as ranks and is several times as fast; the special string is cut out
    first, since the .json's added token matches it inside texts.
    """
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def encode(text: str) -> list[int]:
        if SPECIAL not in text:
            return coder.encode_ordinary(text)
        out: list[int] = []
        for i, part in enumerate(text.split(SPECIAL)):
            out += [SPECIAL_ID] * (i > 0) + coder.encode_ordinary(part)
        return out

    return encode


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: one if it fits, else full ones after a shorter first one."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return [(0, first)] * (first > 0) + [(s, capacity) for s in range(first, n, capacity)]


def tokenize(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, if asked) of every document.

    A document is its ids and then END_ID, so an empty or null text is one token. Texts pass one at a time,
    whole; only documents longer than capacity are cut. ids is binary, two bytes an id, little-endian: the
    vocabulary has fewer than 65,536, and half the bytes are moved. Null ids of documents stay null, repeated
    rows are documents each, an empty table gives no pieces.
    """
    import public_tokenizers

    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(Path(public_tokenizers.path("byte_bpe_50k.tiktoken")).read_bytes())
    pattern = public_tokenizers.PATTERN
    schema = PIECES + (", ids binary" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks.value, pattern)
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py()), END_ID], dtype="<u4")
                for i, (start, length) in enumerate(cuts(len(ids), capacity)):
                    part = ids[start : start + length]
                    for column, value in zip(columns, (doc_id, i, start, length, zlib.crc32(part.tobytes()), part.astype("<u2").tobytes() if with_ids else None), strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            n = 5 + with_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[:n], kinds, strict=False)], names=names[:n])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(run, schema)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """length -> copies of the combination of available lengths with the greatest sum within room.

    Subset sums are bits of an integer; lengths enter from the longest, their copies in powers of two, and
    the first exact fill ends the search, so short lengths are saved for later bins.
    """
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, copies = min(counts[length], room // length), 1
        while left:
            take = min(copies, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, copies = left - take, copies * 2
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    at, out = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            out[length] = out.get(length, 0) + take
    return out


def minimum_bin_slack(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(length -> copies, bins) patterns that use up the histogram of lengths.

    Each bin takes the longest length left and then the fullest combination for its slack. The pattern is
    repeated while every count lasts, so the work depends on the number of lengths (at most capacity), not
    of pieces.
    """
    left, out = {k: n for k, n in histogram.items() if n > 0}, []
    while left:
        longest = max(left)
        rest = {**left, longest: left[longest] - 1}
        if not rest[longest]:
            del rest[longest]
        pattern = fullest(rest, capacity - longest)
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(left[k] // n for k, n in pattern.items())
        out.append((pattern, times))
        for k, n in pattern.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return out


def places(patterns: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, first bin, copies, offset): where the pieces of a length go, by their rank."""
    rows, rank, bins = [], {}, 0
    for pattern, times in patterns:
        offset = 0
        for length in sorted(pattern, reverse=True):
            n = pattern[length]
            rows.append((length, rank.get(length, 0), bins, n, offset))
            rank[length] = rank.get(length, 0) + n * times
            offset += n * length
        bins += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset: bins of at most capacity tokens, gapless from 0.

    Needs doc_id, piece, length (1 to capacity); other columns pass. Only the histogram of lengths (at most
    capacity rows) comes to the driver; the plan it gives (a few rows per length and pattern) is broadcast.
    Pieces of one length are interchangeable: their rank, found by salted counts, tells their place. Equal
    ids and repeated rows are pieces of their own; no pieces give no sequences; columns of pieces named like the
    added ones are replaced.
    """
    spark, pieces = pieces.sparkSession, pieces.drop("sequence_id", "offset", "_rank")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.sparkContext.broadcast(places(minimum_bin_slack(histogram, capacity)))
    order = [F.col(c) for c in ("doc_id", "piece", *(c for c in ("start", "ids_crc32") if c in pieces.columns))]
    numbered = ranked(pieces, "length", order, "_rank", sum(histogram.values()))
    columns = pieces.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = plan.value
        key = table[:, 0] << 44 | table[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            at = table[np.searchsorted(key, length << 44 | rank, "right") - 1] if len(table) else table
            within = rank - at[:, 1]
            found = [pa.array(at[:, 2] + within // at[:, 3]), pa.array(at[:, 4] + within % at[:, 3] * length)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *found], names=[*columns, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return numbered.select(*columns, "_rank").mapInArrow(run, f"{fields}, sequence_id long, offset long")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place: see tokenize and pack for edge cases."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(stage(tokenize(docs), "pieces"))
