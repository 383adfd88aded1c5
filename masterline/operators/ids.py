"""Dense numbers and sequential ids without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from masterline.operators.tables import lookup
from masterline.sources.scratch import kept

ROWS_PER_RANGE = 50_000


def row_numbers(df: DataFrame, order: list[Column], out: str = "row_number") -> DataFrame:
    """df with 1, 2, ... in order: rows are dealt into ranges, written, numbered there, and shifted by the ranges before.

    order must tell all rows apart for the numbers to be reproducible. Up to ROWS_PER_RANGE rows are one range.
    """
    ranges = max(1, -(-df.count() // ROWS_PER_RANGE))
    if ranges == 1:
        return df.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("long"))
    dealt = kept(df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = dealt.withColumn("_in", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    return numbered.join(F.broadcast(shifts), "_range").withColumn(out, (F.col("_before") + F.col("_in")).cast("long")).drop("_range", "_in", "_before")


def format_id(number: Column, prefix: str = "G", width: int = 5) -> Column:
    return F.format_string(f"{prefix}%0{width}d", number.cast("long"))


def id_number(id_: Column, prefix: str = "G") -> Column:
    """The number of an id; null if it isn't one."""
    return F.when(id_.rlike(f"^{prefix}[0-9]+$"), F.substring(id_, F.lit(len(prefix) + 1), F.length(id_)).cast("bigint"))


def max_id(df: DataFrame, column: str, base: int = 10_000) -> int:
    """The greatest number among the ids, as a number; base if there is none."""
    return df.agg(F.max(id_number(F.col(column)))).first()[0] or base


def batches(df: DataFrame, group: list[str], order: list[Column], size: int, out: str = "batch") -> DataFrame:
    """df with the number, from 0, of its batch of `size` rows inside its group.

    Rows are numbered over all groups and counted from the first of each, so a large group is many tasks' work.
    """
    numbered = kept(row_numbers(df, [*(F.col(g) for g in group), *order], "_row"), "numbered")
    starts = numbered.groupBy(*group).agg(F.min("_row").alias("_start"))
    key = F.struct(*group)
    placed = lookup(numbered.withColumn("_key", key), "_key", starts.select(key.alias("_key"), "_start"))
    return placed.withColumn(out, F.floor((F.col("_row") - F.col("_start")) / size).cast("int")).select(*df.columns, out)
