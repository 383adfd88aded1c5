"""Keeping one row per key, set-based upserts, membership and constraints."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masterline.sources.scratch import kept

#: Rows up to which a table that is looked up is broadcast whole.
BROADCAST_ROWS = 100_000

def keep_one(df: DataFrame, keys: list[str], order: Column, last: bool = False) -> DataFrame:
    """The first (or last) row of each key by order; reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    pick = (F.max_by if last else F.min_by)(F.struct(*rest), order)
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest)).select(*df.columns)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], replace: list[str] | None = None) -> DataFrame:
    """old with new's rows: where a key is in both, the columns in replace (all others of new) take new's value."""
    replace = [c for c in new.columns if c not in keys] if replace is None else replace
    n = new.select(*keys, F.lit(True).alias("_new"), *(F.col(c).alias(f"_n_{c}") for c in new.columns if c not in keys))
    both = old.withColumn("_old", F.lit(True)).join(n, keys, "full")
    taken = lambda c: F.when(F.col("_new") & (F.lit(c in replace) | F.col("_old").isNull()), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c)
    return both.select(*(taken(c) if c in new.columns and c not in keys else F.col(c) for c in old.columns))


def upsert_coalesce(old: DataFrame, new: DataFrame, keys: list[str], new_first: bool = True) -> DataFrame:
    """old with new's rows, each column the first of (new, old) that isn't null, or of (old, new)."""
    n = new.select(*keys, *(F.col(c).alias(f"_n_{c}") for c in new.columns if c not in keys))
    both = old.join(n, keys, "full")
    pair = lambda c: [F.col(f"_n_{c}"), F.col(c)] if new_first else [F.col(c), F.col(f"_n_{c}")]
    return both.select(*(F.coalesce(*pair(c)).alias(c) if c in new.columns and c not in keys else F.col(c) for c in old.columns))


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.unionByName(new.join(old, keys, "left_anti"), allowMissingColumns=True)


def replace_where(old: DataFrame, new: DataFrame, predicate: Column) -> DataFrame:
    """old without the rows that meet the predicate (unknown counts as no), then new."""
    return old.filter(~F.coalesce(predicate, F.lit(False))).unionByName(new, allowMissingColumns=True)


def absent(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key other lacks: resume, unchanged rows, orphans."""
    return df.join(other.select(*keys), keys, "left_anti")


def flag_existing(df: DataFrame, other: DataFrame, key: Column, other_key: Column, out: str = "is_existing") -> DataFrame:
    """df with whether its key is in other, in one join."""
    known = other.select(other_key.alias("_key")).distinct().withColumn("_known", F.lit(True))
    return df.withColumn("_key", key).join(known, "_key", "left").withColumn(out, F.coalesce("_known", F.lit(False))).drop("_key", "_known")


def lookup(df: DataFrame, key: str, table: DataFrame, most: int = 10_000, broadcast_rows: int = BROADCAST_ROWS, rows: int | None = None) -> DataFrame:
    """df left-joined with table, which has a row per key at most; rows with a null key find nothing.

    A table of broadcast_rows rows at most is broadcast. Of a larger one, the keys that hold at least 1/most of the
    rows of df, so at most that many, are broadcast, and all others shuffled. However often a key comes, no task gets
    all its rows. rows: how many table has at most, where that is known.
    """
    if (table.limit(broadcast_rows + 1).count() if rows is None else rows) <= broadcast_rows:
        return df.join(F.broadcast(table), key, "left")
    counts = kept(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), "counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = F.broadcast(counts.filter((F.col("_n") * most >= total) & F.col(key).isNotNull()).select(key))
    often = table.join(hot, key)
    rest = df.join(hot, key, "left_anti").join(table, key, "left")
    return df.join(hot, key, "left_semi").join(F.broadcast(often), key, "left").unionByName(rest)


def violations(tables: Mapping[str, DataFrame], keys: Mapping[str, list[str]], not_null: Mapping[str, list[str]], foreign: list[tuple[str, str, str, str]]) -> DataFrame:
    """constraint, target, n of every broken rule: keys, not-null columns, and (table, column, parent, column) references."""
    found = []
    for t, k in keys.items():
        repeated = tables[t].groupBy(*k).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        found.append(repeated.agg(F.count(F.lit(1)).alias("n")).select(F.lit("primary_key").alias("constraint"), F.lit(t).alias("target"), "n"))
    for t, columns in not_null.items():
        counts = tables[t].agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
        found.append(counts.select(F.explode(F.array(*(F.struct(F.lit("not_null").alias("constraint"), F.lit(f"{t}.{c}").alias("target"), F.col(c).alias("n")) for c in columns)))).select("col.*"))
    for t, c, parent, pc in foreign:
        lost = tables[t].filter(F.col(c).isNotNull()).join(tables[parent].select(F.col(pc).alias(c)), c, "left_anti")
        found.append(lost.agg(F.count(F.lit(1)).alias("n")).select(F.lit("foreign_key").alias("constraint"), F.lit(f"{t}.{c}").alias("target"), "n"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out
