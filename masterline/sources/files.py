"""Reading and writing of delimited and JSON files, publishing, and the run log."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from masterline.functions import wordlists as W
from masterline.functions.text import clean_loaded, clean_name_lenient, clean_value, parse_amount, yes_no
from masterline.operators.columns import find_column, name_like_column, named_column, quoted
from masterline.operators.suppliers import cleaned_forms
from masterline.operators.tables import keep_one, lookup
from masterline.sources.scratch import kept

LOG_SCHEMA = "run_id string, stage string, status string, row_count long, error_message string, timestamp timestamp"
POINTER = "at long, version string"
#: Different names up to which their cleaned forms are broadcast: some 50 MB.
BROADCAST_FORMS = 500_000


def read_csv(spark: SparkSession, path: str, encoding: str = "UTF-8", header: bool = True, multiline: bool = True) -> DataFrame:
    """Every column as text: quoted fields may hold quotes, separators and line ends; bad bytes are replaced.

    multiline: a quoted field may hold line ends, for which a file is read whole by one task; without it large
    files are split.
    """
    options = {"header": header, "inferSchema": False, "quote": '"', "escape": '"', "multiLine": multiline, "mode": "PERMISSIVE", "encoding": encoding}
    return spark.read.options(**options).csv(path)


def read_csv_any(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """As UTF-8, or as Latin-1 if that leaves replacement characters; the check stops at the first one."""
    df = read_csv(spark, path, multiline=multiline)
    broken = F.exists(F.array(*map(quoted, df.columns)), lambda x: F.coalesce(x, F.lit("")).contains("�"))
    return read_csv(spark, path, "ISO-8859-1", multiline=multiline) if df.filter(broken).limit(1).count() else df


def read_word_list(spark: SparkSession, path: str) -> list[str]:
    """A list of words, one a line, folded to lower case: the caller's long list of first names, for one."""
    return sorted({r["value"].strip().lower() for r in spark.read.text(path).collect()} - {""})


def file_ordinals(df: DataFrame, out: str = "row_index") -> DataFrame:
    """df, as a reader of files gives it, with 0, 1, ... in order of file path and of rows inside each file.

    A task counts the rows of each of its splits; a split's rows go on from the counts of the splits before it, by path
    and start, so numbers don't depend on how files are split or dealt to tasks. Rows themselves are not moved. What
    isn't read from files, or has been shuffled since, is numbered by partition, with gaps.
    """
    by_partition = df.withColumn(out, F.monotonically_increasing_id())
    try:
        rows = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    except AnalysisException:
        return by_partition
    splits = kept(rows.groupBy("_file", "_block").agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.count(F.lit(1)).alias("_n")), "splits")
    if splits.filter("_last - _first >= _n").limit(1).count():
        return by_partition
    before = lambda *by, order: F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = splits.groupBy("_file").agg(F.sum("_n").alias("_n")).select("_file", before(order="_file").alias("_files"))
    starts = splits.select("_file", "_block", "_first", before("_file", order="_block").alias("_splits")).join(files, "_file")
    key = F.struct("_file", "_block")
    placed = lookup(rows.withColumn("_key", key), "_key", starts.select(key.alias("_key"), (F.col("_files") + F.col("_splits") - F.col("_first")).alias("_shift")))
    return placed.withColumn(out, F.col("_at") + F.col("_shift")).select(*(quoted(c) for c in df.columns), out)


def read_names(spark: SparkSession, path: str, column: str | None = None, index: int | None = None, encoding: str = "UTF-8") -> DataFrame:
    """The column of names (by name, place, or the header that looks like one) as row_index, name; short rows are ''."""
    df = read_csv(spark, path, encoding)
    c = df.columns[index] if index is not None else named_column(df.columns, column) if column else name_like_column(df.columns)
    return file_ordinals(df, "_row").select(F.col("_row").alias("row_index"), F.coalesce(quoted(c), F.lit("")).alias("name"))


def read_transactions(df: DataFrame, name_column: str | None = None, id_column: str | None = None) -> DataFrame:
    """Canonical transaction rows from a free-header frame; rows without a name are dropped.

    row_index, supplier_name_raw, supplier_name_normalized (the raw name where cleaning leaves nothing),
    supplier_id, amount, currency, item_description. Each different name is cleaned once, and its form looked up.
    """
    name = name_column or find_column(df.columns, W.NAME_COLUMNS)
    if name is None:
        raise ValueError(f"no supplier name among {df.columns}")
    of = lambda candidates, c=None: clean_value(quoted(f)) if (f := c or find_column(df.columns, candidates)) else F.lit(None).cast("string")
    rows = file_ordinals(df, "_row").select(
        F.col("_row").alias("row_index"),
        of((), name).alias("supplier_name_raw"),
        of(W.SUPPLIER_ID_COLUMNS, id_column).alias("supplier_id"),
        parse_amount(F.replace(of(W.AMOUNT_COLUMNS), F.lit(","), F.lit(""))).alias("amount"),
        of(W.CURRENCY_COLUMNS).alias("currency"),
        of(W.ITEM_COLUMNS).alias("item_description"),
    ).filter("supplier_name_raw IS NOT NULL")
    forms = df.select(of((), name).alias("supplier_name_raw")).filter("supplier_name_raw IS NOT NULL").groupBy("supplier_name_raw").agg(F.count(F.lit(1)).alias("_n"))
    cleaned = kept(cleaned_forms(forms, "supplier_name_raw", "_n", "_clean", clean_name_lenient).select("supplier_name_raw", "_clean"), "name-forms")
    found = lookup(rows, "supplier_name_raw", cleaned, broadcast_rows=BROADCAST_FORMS, rows=cleaned.count())
    return found.select(*rows.columns, F.coalesce(F.nullif("_clean", F.lit("")), "supplier_name_raw").alias("supplier_name_normalized"))


def read_bulk(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct clients, and the first row of each supplier name in file order with its attributes."""
    rename = {
        "Normalized_Supplier_Name": "normalized_supplier_name", "Supplier_Description": "supplier_description", "Employee_Count": "employee_count", "Revenue": "revenue", "Year_Established": "year_established",
        "LI": "l1_category", "L2": "l2_category", "L3": "l3_category", "Product_Service_Tags": "product_service_tags", "Ship_To_Countries": "ship_to_countries", "Country_Codes": "country_codes",
    }
    columns = [clean_loaded(quoted(a) if a in df.columns else F.lit(None)).alias(b) for a, b in rename.items()]
    rows = file_ordinals(df, "_row").select(F.col("_row").alias("row_index"), clean_value(quoted("client #")).alias("client_id"), *columns).filter("normalized_supplier_name IS NOT NULL")
    clients = rows.select("client_id").filter("client_id IS NOT NULL").distinct()
    return clients, keep_one(rows.drop("client_id"), ["normalized_supplier_name"], F.col("row_index"))


def read_config(spark: SparkSession, path: str) -> dict:
    """A JSON configuration file, through Spark's readers."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def read_uploads(spark: SparkSession, root: str) -> DataFrame:
    """All files under root/<client_id>/, with client_id and file_name from the path."""
    df = spark.read.options(header=True, quote='"', escape='"', multiLine=True, recursiveFileLookup=True).csv(root)
    path = F.col("_metadata.file_path")
    return df.select("*", F.regexp_extract(path, r"([^/]+)/[^/]+$", 1).alias("upload_client_id"), F.regexp_extract(path, r"([^/]+)$", 1).alias("file_name"))


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    (df.coalesce(1) if single else df).write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


def full_export(results: DataFrame) -> DataFrame:
    return results.select("original", "normalized", yes_no(F.col("individual")).alias("individual"), "cluster", "confidence", "method", "count")


def mapping_export(results: DataFrame) -> DataFrame:
    return results.select("original", "normalized", "confidence")


def export_tables(tables: dict[str, DataFrame], root: str) -> None:
    """Each table as CSV, with a header, in a folder of its name under root."""
    for name, df in tables.items():
        write_csv(df, f"{root}/{name}")


def replace_partitions(new: DataFrame, path: str, keys: list[str], emptied: list[tuple] = ()) -> None:
    """Put new in place of the partitions, by keys, that it has rows for; all other files of the table at path stay.

    emptied: further partitions, as values of keys, that lose their rows: an upload that has none left. A partition's
    files appear together when the job ends, so one that is run again leaves the same. new must not read from path.
    """
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    spark = new.sparkSession
    for values in emptied:
        escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        at = spark._jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *(escape(k, None if v is None else str(v)) for k, v in zip(keys, values, strict=True))]))
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def publish(tables: dict[str, DataFrame], root: str) -> str:
    """Write all tables under a new version of root, then add a pointer to it: readers see all of a version or none.

    Pointers are only added, each as one file that appears whole, and the latest counts: each gets the number after
    those it finds, whatever the clock says; of two written at once the one with the greater version.
    """
    spark = next(iter(tables.values())).sparkSession
    version = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.parquet(f"{root}/versions/{version}/{name}")
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/current")
    there = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
    last = spark.read.schema(POINTER).json(f"{root}/current").agg(F.max("at")).first()[0] if there else None
    spark.createDataFrame([((last or 0) + 1, version)], POINTER).coalesce(1).write.mode("append").json(f"{root}/current")
    return version


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    version = spark.read.schema(POINTER).json(f"{root}/current").agg(F.max_by("version", F.struct("at", "version"))).first()[0]
    return spark.read.parquet(f"{root}/versions/{version}/{name}")


def append_logs(rows: DataFrame, path: str) -> None:
    """Append rows of LOG_SCHEMA as JSON lines; a missing timestamp is the present one."""
    stamped = rows.withColumn("timestamp", F.coalesce("timestamp", F.current_timestamp()) if "timestamp" in rows.columns else F.current_timestamp())
    stamped.select("run_id", "stage", "status", F.col("row_count").cast("long").alias("row_count"), "error_message", "timestamp").write.mode("append").json(path)


def append_log(spark: SparkSession, path: str, run_id: str, stage: str, status: str, row_count: int | None = None, error: str | None = None) -> None:
    row = spark.createDataFrame([(run_id, stage, status, row_count, error)], "run_id string, stage string, status string, row_count long, error_message string")
    append_logs(row.coalesce(1), path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).json(path)
