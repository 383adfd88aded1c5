"""Aggregation, matching and spend of supplier rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from masterline.functions import text as T
from masterline.operators.ids import format_id, max_id, row_numbers
from masterline.operators.tables import keep_one, lookup


def cleaned_forms(forms: DataFrame, raw: str, n: str, out: str, clean: Callable[[Column], Column] = T.clean_name) -> DataFrame:
    """forms, grouped by raw with their number of rows in n, with the cleaned form in out.

    It hangs on n, which is always positive, so that a filter on it stays above the grouping: else it would be
    pushed below, and every row cleaned.
    """
    return forms.withColumn(out, F.when(F.col(n) > 0, clean(F.col(raw))))


def by_distinct(df: DataFrame, column: str, f: Callable[[Column], Column], out: str) -> DataFrame:
    """df with f of a column in out, computed once for each different value; null counts as one."""
    key = F.struct(column)
    forms = cleaned_forms(df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")), column, "_n", out, f)
    return lookup(df.withColumn("_key", key), "_key", forms.select(key.alias("_key"), out)).drop("_key")


def aggregate_suppliers(rows: DataFrame, name: str = "supplier_name_normalized", clean: Callable[[Column], Column] | None = None) -> DataFrame:
    """Per name: sorted sets of raw forms, supplier ids and currencies, row count, and the sum of amounts.

    clean: makes the name of the raw one, once for each different raw form, id and currency.
    """
    forms = ["supplier_name_raw", "supplier_id", "currency", *([] if clean else [name])]
    sums = rows.groupBy(*forms).agg(F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_amount"))
    named = cleaned_forms(sums, "supplier_name_raw", "_n", name, clean) if clean else sums
    return named.groupBy(name).agg(
        F.array_sort(F.collect_set("supplier_name_raw")).alias("raw_names"),
        F.array_sort(F.collect_set("supplier_id")).alias("supplier_ids"),
        F.array_sort(F.collect_set("currency")).alias("currencies"),
        F.sum("_n").alias("n_rows"),
        F.sum("_amount").alias("total_amount"),
    )


def name_histogram(rows: DataFrame, raw: str, index: str, clean: Callable[[Column], Column] = T.clean_name) -> DataFrame:
    """cleaned, best_original, n_forms, n_rows, first_index: raw forms are counted first, each is cleaned once, and
    they are ranked by count, earliest first. Blank forms, and those that cleaning empties, are left out."""
    forms = rows.filter(F.trim(F.coalesce(raw, F.lit(""))) != "").groupBy(raw).agg(F.count(F.lit(1)).alias("_n"), F.min(index).alias("_first"))
    return cleaned_forms(forms, raw, "_n", "cleaned", clean).filter("cleaned != ''").groupBy("cleaned").agg(
        F.max_by(raw, F.struct(F.col("_n"), -F.col("_first"))).alias("best_original"),
        F.count(F.lit(1)).alias("n_forms"),
        F.sum("_n").alias("n_rows"),
        F.min("_first").alias("first_index"),
    )


def match_or_assign(names: DataFrame, master: DataFrame, name: str, order: list[Column], base: int = 10_000) -> DataFrame:
    """name, global_supplier_id, is_new: by lower-cased name in master (of duplicates the greatest id), else the next ids in order."""
    known = master.groupBy(F.lower(F.trim("normalized_supplier_name")).alias("_key")).agg(F.max("global_supplier_id").alias("_known"))
    probed = names.withColumn("_key", F.lower(F.trim(name))).join(known, "_key", "left")
    start = max_id(master, "global_supplier_id", base)
    missed = probed.filter("_known IS NULL").groupBy("_key").agg(F.min(F.struct(*order)).alias("_order"))
    given = row_numbers(missed, [F.col("_order")], "_n").select("_key", format_id(F.col("_n") + start).alias("_given"))
    return probed.join(given, "_key", "left").select(*names.columns, F.coalesce("_known", "_given").alias("global_supplier_id"), F.col("_known").isNull().alias("is_new"))


def crosswalk(rows: DataFrame, ids: DataFrame, client: Column, name: str, first_index: str) -> DataFrame:
    """One row per client and supplier id: the global id of the name seen first latest, with constant match metadata.

    Ids stay whole. A blank one, or a name without any, goes by the first 100 characters of the name.
    """
    given = rows.select(client.alias("client_id"), F.col("supplier_id").alias("_id"), F.col(name).alias("_name"), F.col(first_index).alias("_first"))
    names = given.groupBy("client_id", "_name").agg(F.min("_first").alias("_first"), F.count("_id").alias("_ids"))
    short = F.substring("_name", 1, 100)
    by_id = given.filter("_id IS NOT NULL").select("client_id", "_name", F.coalesce(F.nullif(T.strip(F.col("_id")), F.lit("")), short).alias("supplier_id")).distinct().join(names.drop("_ids"), ["client_id", "_name"])
    by_name = names.filter("_ids = 0").select("client_id", "_name", short.alias("supplier_id"), "_first")
    pairs = by_id.unionByName(by_name).join(ids.select(F.col(name).alias("_name"), "global_supplier_id"), "_name")
    last = keep_one(pairs, ["client_id", "supplier_id"], F.struct("_first", "_name"), last=True)
    return last.select("client_id", "supplier_id", "global_supplier_id", F.lit("exact_name_key").alias("match_method"), F.lit(1.0).alias("match_confidence"), F.lit("name_key").alias("matched_on"))


def client_totals(rows: DataFrame, keys: list[str], amount: str, quantity: str, date: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum(amount).alias("total_spend"), F.sum(quantity).alias("total_quantity"), F.min(date).alias("window_start_date"), F.max(date).alias("window_end_date"), F.count(F.lit(1)).alias("n_lines")
    )


def rolling_spend(rows: DataFrame, keys: list[str], amount: str, date: str, months: int = 12) -> DataFrame:
    """Per key and month with spend: that month's, and the sum of the calendar months up to it."""
    monthly = rows.groupBy(*keys, F.year(date).alias("spend_year"), F.month(date).alias("spend_month")).agg(F.sum(amount).alias("month_spend"))
    over = Window.partitionBy(*keys).orderBy(F.col("spend_year") * 12 + F.col("spend_month")).rangeBetween(-(months - 1), 0)
    return monthly.withColumn("rolling_spend", F.sum("month_spend").over(over))


def quality_by_supplier(rows: DataFrame, supplier: str, description: str, threshold: float = 0.5, n: str | None = None) -> DataFrame:
    """Per supplier: lines, good ones, pass rate (0 without lines) and the flow that the rate routes to.

    n: the column that says how many lines a row stands for, where equal ones have been counted.
    """
    lines, good = F.lit(1) if n is None else F.col(n), T.good_description(F.col(description))
    count = lambda which: F.coalesce(F.sum(F.when(which, lines)), F.lit(0)).cast("long")
    out = rows.groupBy(supplier).agg(count(F.col(description).isNotNull()).alias("n_lines"), count(good).alias("n_good"))
    rate = F.coalesce(F.try_divide(F.col("n_good").cast("double"), F.col("n_lines").cast("double")), F.lit(0.0))
    return out.withColumn("pass_rate", rate).withColumn("flow", F.when(F.col("pass_rate") < threshold, "description").otherwise("po_line"))


def cluster_summary(results: DataFrame) -> DataFrame:
    """Per normalized name with more than one result: any individual, variants, their list, rows."""
    return (
        results.groupBy("normalized")
        .agg(
            F.bool_or("individual").alias("individual"),
            F.count(F.lit(1)).alias("n_variants"),
            F.array_join(F.array_sort(F.collect_list("original")), " | ").alias("variants"),
            F.sum("count").alias("n_rows"),
        )
        .filter("n_variants > 1")
    )
