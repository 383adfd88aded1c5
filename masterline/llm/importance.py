"""Importance resampling: documents drawn towards a target distribution of hashed word runs."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from masterline.llm.common import stage, text_of
from masterline.llm.words import CRC_TABLE, LOWER, UPPER, crc32_sql

#: Bytes to bytes: A-Z lowered, everything else in ASCII but digits and letters to a space; others are of non-ASCII letters.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
#: Remainders of CRC-32, to go on over one byte in a whole array.
REMAINDERS = np.array([zlib.crc32(bytes([255 ^ b])) ^ 0xFF000000 for b in range(256)], dtype=np.uint32)
BUCKETS = 10_000
LONGEST = 2
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: Scores of a block of the histogram. Gains are logarithms of counts and the noise is of 32 bits, so scores lie
#: within some 60,000 of zero: a histogram has at most 120,000 rows, and as many blocks as that makes, at any size.
SCORE_BLOCK = 1_024


def spaced(crcs: np.ndarray) -> np.ndarray:
    """CRC-32 of what crcs are of, with a space behind."""
    state = ~crcs
    return ~(REMAINDERS[(state ^ 32) & 255] ^ (state >> 8))


def feature_buckets(text: bytes, longest: int = LONGEST, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """How many words a text has, and the bucket of every run of 1 to `longest` of them in a row, repeats included.

    A run's CRC-32 goes on from that of its words but the last, so each word's bytes are read once per length.
    """
    words = text.translate(PLAIN).split()
    crcs, out = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words)), []
    for k in range(1, longest + 1):
        if k > 1:
            crcs = np.fromiter(map(zlib.crc32, words[k - 1 :], spaced(crcs[: max(0, len(words) - k + 1)]).tolist()), dtype=np.uint32)
        out.append(crcs % buckets)
    return len(words), np.concatenate(out)


def bytes_of(texts: DataFrame, text_col: str, *others: str) -> DataFrame:
    return texts.select(*others, text_of(text_col).cast("binary").alias("_text"))


def bucket_counts(texts: DataFrame, text_col: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> list[int]:
    """Features of all texts in each bucket: a task hands on one array of sums, and one sum a bucket comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                sums += np.bincount(feature_buckets(text.as_py(), longest, buckets)[1], minlength=buckets)
        full = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(sums[full])], names=["bucket", "n"])

    rows = bytes_of(texts, text_col).mapInArrow(run, "bucket long, n long")
    found = dict(rows.groupBy("bucket").agg(F.sum("n")).collect())
    return [found.get(b, 0) for b in range(buckets)]


def bucket_gains(own: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln) of each bucket's share of the target over its share of the corpus, one count added to both."""
    own_all, target_all = sum(own) + len(own), sum(target) + len(own)
    return [math.floor(1000 * math.log((t + 1) * own_all / ((s + 1) * target_all))) for s, t in zip(own, target, strict=True)]


def noise(id_: Column, seed: int = SEED) -> Column:
    """Standard Gumbel noise times 1000, floored, of a hash of seed and id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(F.ln(-F.ln(uniform)) * -1000.0)


def score(docs: DataFrame, gains: list[int], id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """id, n_words, n_features, weight (floored mean gain of the features, 0 without any), score (weight and noise).

    The gains are one array, looked up by the buckets of a whole text at a time: nothing is shuffled.
    """
    array = np.array(gains, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.zeros((len(batch), 3), dtype=np.int64)
            for i, text in enumerate(batch.column(1)):
                n, found = feature_buckets(text.as_py(), longest, len(array))
                rows[i] = n, len(found), int(array[found].sum()) // max(1, len(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(rows[:, k]) for k in range(3))], names=[id_col, "n_words", "n_features", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    weighted = bytes_of(docs, text_col, id_col).mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_features long, weight long")
    return weighted.withColumn("score", F.col("weight") + noise(F.col(id_col), seed))


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, id_col: str = "doc_id") -> DataFrame:
    """scored with rank (1, 2, ... by score, ties by id) of the drawn rows, null for the rest.

    Drawn are percent in a hundred, rounded down, of the rows of least_words words or more. Integer scores make an
    exact histogram; sums from its upper end say how many rows stand above each score, so the score at which the draw
    ends is known, and only rows of the scores from there up are numbered, each score by itself.
    """
    fit = F.col("n_words") >= least_words
    counts = stage(scored.filter(fit).groupBy("score").agg(F.count(F.lit(1)).alias("_n")).withColumn("_block", F.floor(F.col("score") / SCORE_BLOCK)), "scores")
    most = (counts.agg(F.sum("_n")).first()[0] or 0) * percent // 100
    above = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = counts.groupBy("_block").agg(F.sum("_n").alias("_n"))
    blocks = blocks.select("_block", above(Window.orderBy(F.desc("_block"))).alias("_blocks"))
    inside = counts.select("score", "_block", above(Window.partitionBy("_block").orderBy(F.desc("score"))).alias("_inside"))
    offsets = inside.join(F.broadcast(blocks), "_block").select("score", (F.col("_blocks") + F.col("_inside")).alias("_above")).filter(F.col("_above") < most)
    placed = scored.join(F.broadcast(offsets), "score", "left").withColumn("_above", F.when(fit, F.col("_above")))
    order = Window.partitionBy("score").orderBy(F.col(id_col).asc_nulls_last(), "n_features")
    numbered = placed.filter("_above IS NOT NULL").withColumn("rank", (F.col("_above") + F.row_number().over(order)).cast("long"))
    numbered = numbered.withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")))
    rest = placed.filter("_above IS NULL").withColumn("rank", F.lit(None).cast("long"))
    return numbered.unionByName(rest).select(*scored.columns, "rank")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """id, n_words, n_features, weight, score, rank of every document, drawn towards the texts of target.

    Null text has no words, so weight 0, and is never drawn; a null id hashes as an empty one and comes last among
    ties; rows with equal ids get equal noise and are ranked apart; without documents the result is empty, without
    target texts all gains come from the documents alone. Columns of docs but id and text are not read, so none clash.
    """
    gains = bucket_gains(bucket_counts(docs, text_col), bucket_counts(target, text_col))
    scored = stage(score(docs, gains, id_col, text_col, seed=seed), "weighted")
    return draw(scored, percent, least_words, id_col)


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its weight, score and rank in a draw of a quarter towards the benchmark's texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text")
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


SQL = rf"""
WITH {CRC_TABLE}, docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), wanted AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), own AS (
  SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM docs
), other AS (
  SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM wanted
), known AS (
  SELECT feature, {crc32_sql("feature")} % 10000 AS bucket FROM (SELECT feature FROM own UNION SELECT feature FROM other) f, crc_table
), s AS (
  SELECT bucket, count(*) AS n FROM own JOIN known USING (feature) GROUP BY bucket
), t AS (
  SELECT bucket, count(*) AS n FROM other JOIN known USING (feature) GROUP BY bucket
), gains AS (
  SELECT b.bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1) * ((SELECT count(*) FROM own) + 10000))::DOUBLE
                                 / ((coalesce(s.n, 0) + 1) * ((SELECT count(*) FROM other) + 10000))::DOUBLE))::BIGINT AS gain
  FROM range(10000) b(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)
), weighted AS (
  SELECT doc_id, count(*) AS n_features, sum(gain) AS total FROM own JOIN known USING (feature) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(floor(total::DOUBLE / n_features), 0)::BIGINT AS weight,
         ('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT AS h
  FROM docs LEFT JOIN weighted USING (doc_id)
), noisy AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM noisy WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM ranked) * 25 // 100 THEN rank END AS rank
FROM noisy LEFT JOIN ranked USING (doc_id)
"""
