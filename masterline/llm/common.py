"""Shared pieces: word syntax, scratch tables, size-checked joins and distributed ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from masterline.functions.text import once
from masterline.sources.scratch import kept as stage
from masterline.sources.scratch import scope, scratch_path, scratch_root

__all__ = ["once", "scope", "scratch_path", "scratch_root", "stage"]

#: A word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"

#: Rows up to which a per-group table may be broadcast (checked by counting it).
BROADCAST_ROWS = 100_000


def text_of(col: str | Column = "text") -> Column:
    """The text with null as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text; an empty array if it has none."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def small(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most `limit` rows, else as it is (Spark then shuffles)."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= limit else df


def join_skewed(left: DataFrame, right: DataFrame, keys: list[str], count: str, total: int, most: int = 10_000) -> DataFrame:
    """left inner-joined with right on keys; right has a row per key, and in `count` how many rows of left hold it.

    Keys that hold at least 1/most of left's `total` rows, so at most `most` of them, are broadcast; the rows
    of all others are shuffled. However many copies a key has, no task gets them all.
    """
    hot = F.col(count) * most >= total
    often = right.filter(hot).drop(count)
    rest = left.join(F.broadcast(often.select(*keys)), keys, "left_anti").join(right.filter(~hot).drop(count), keys)
    return left.join(F.broadcast(often), keys).unionByName(rest)


def ranked(df: DataFrame, group: str, order: list[Column], out: str, rows: int, per_bucket: int = 50_000) -> DataFrame:
    """df with `out`: a gapless long from 0 within each `group`, without sorting any group in one task.

    Rows are dealt by (group, salt), numbered there, and shifted by the sizes of the salts before; the
    only per-group work in one task is over one row per salt.
    """
    salts = max(8, -(-rows // per_bucket))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    sizes = salted.groupBy(group, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(group, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = salted.withColumn("_row", F.row_number().over(Window.partitionBy(group, "_salt").orderBy(*order)))
    return numbered.join(shifts, [group, "_salt"]).withColumn(out, (F.col("_before") + F.col("_row") - 1).cast("long")).drop("_salt", "_row", "_before")
