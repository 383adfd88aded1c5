"""Mixing sources to target weights: repetition rates per source, then whole copies of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from masterline.llm.common import WORD, small, stage, text_of
from masterline.operators.ids import row_numbers

#: Weights by the rank of a source, repeating.
WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST_COPIES = 2
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def uniform(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on key and seed alone: 52 bits of an MD5, exact in a double."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(16**13))


def source_targets(sized: DataFrame, weights=WEIGHTS, share_percent: int = SHARE_PERCENT, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target of every source of sized(source, size).

    Sources by code point, null last, take the weights in turn and share share_percent % of all sizes. A
    target stops at `most` times its source's size; the excess goes to the others by weight until none is
    above. Each round is one sum over sources: what the stopped ones take off, and the weights of the rest,
    give the next level, which only rises. Numbers alone reach the driver; sources are numbered in ranges.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (row_numbers(sums, [F.col("source").asc_nulls_last()], "_turn")).withColumn("_turn", (F.col("_turn") - 1) % len(weights))
    t = stage(turn.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), F.col("_turn").cast("int") + 1).cast("long")), "mix-sources")
    full, level = most * F.col("source_size"), None
    total = t.agg(F.sum("source_size")).first()[0] or 0
    while True:
        above = F.lit(False) if level is None else full < F.lit(level) * F.col("_weight")
        stopped, free = t.agg(F.sum(F.when(above, full)), F.sum(F.when(~above, F.col("_weight")))).first()
        found = (total * (share_percent / 100) - (stopped or 0)) / free if free else level
        if found == level or found is None:
            break
        level = found
    target = F.when(full < F.lit(level) * F.col("_weight"), full.cast("double")).otherwise(F.lit(level) * F.col("_weight"))
    return t.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share_percent: int = SHARE_PERCENT, most: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """docs with size, source_size, target and copies (int): how often the mix takes each document whole.

    copies = floor(rate) plus one with probability equal to rate's fraction, drawn from a hash of the id,
    so a rerun agrees; rate = target / source_size. Null text has size 0; a source without words has rate
    0; null is a source of its own, ranked last; rows with equal ids draw alike and are kept apart; an
    empty table gives an empty result. Columns of docs named like the added ones are replaced.
    """
    added = ("size", "source_size", "target", "copies")
    sized = docs.drop(*added).withColumn("size", word_count(text_of(text_col)))
    targets = stage(source_targets(sized.select(F.col(source_col).alias("source"), "size"), weights, share_percent, most), "mix")
    targets = small(targets).withColumnsRenamed({"source": "_source"})
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    copies = F.floor("_rate").cast("int") + (uniform(F.col(id_col), seed) < F.col("_rate") - F.floor("_rate")).cast("int")
    joined = sized.join(targets, sized[source_col].eqNullSafe(F.col("_source")), "left").drop("_source")
    return joined.withColumn("_rate", rate).withColumn("copies", copies).drop("_rate")


def repeat(mixed: DataFrame) -> DataFrame:
    """Every row `copies` times, without the columns that mix() adds."""
    times = F.explode(F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies"))))
    return mixed.withColumn("_copy", times).drop("_copy", "size", "source_size", "target", "copies")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it: see mix for edge cases."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, (2 * source_size)::DOUBLE / weight AS fill,
         ((sum(source_size) OVER ())::DOUBLE * 1.5 - coalesce(sum(2 * source_size) OVER before, 0)::DOUBLE)
           / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM sums WINDOW before AS (ORDER BY (2 * source_size)::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), water AS (
  SELECT level AS first FROM levels WHERE fill > level ORDER BY fill, source NULLS LAST LIMIT 1
), targets AS (
  SELECT source, source_size, CASE WHEN fill > (SELECT first FROM water) THEN (SELECT first FROM water) * weight ELSE (2 * source_size)::DOUBLE END AS target
  FROM levels
), rates AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size = 0 THEN 0.0 ELSE target / source_size::DOUBLE END AS rate,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target, (size * (floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM rates
"""
