"""Registered queries over files, exports, uploads, models and streams: tables are written in the scratch folder in
the form that an operator reads or writes, and come back through it. Each has its SQL counterpart beside it."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masterline.functions import text as T
from masterline.functions import wordlists as W
from masterline.functions.entity import classify_entity
from masterline.functions.udfs import is_abbreviation, name_similarity, packed, repair_json, sequence_ratio, unpacked, vector_literal
from masterline.operators import clusters, columns, models, suppliers, tables, taxonomy, vector_index, vectors
from masterline.operators.columns import conform
from masterline.plans import catalogue as C
from masterline.plans import pipelines as P
from masterline.plans.catalogue import PO, _lines, _names, _seed_master, po_lines, query, sql_clean, sql_clean_lenient, sql_list, table
from masterline.plans.schemas import MASTER_FILE, TABLES, empty
from masterline.sources import files
from masterline.sources.scratch import kept, scratch_path
from masterline.streaming import ingest


def written(df: DataFrame, name: str, single: bool = False, **options: str) -> str:
    """df as CSV in the scratch folder; its path."""
    path = scratch_path(df.sparkSession, name)
    (df.coalesce(1) if single else df).write.options(header=True, quote='"', escape='"', **options).csv(path)
    return path


# scans


@query("""SELECT CAST(c_custkey AS VARCHAR) AS key, c_name || ', "' || c_mktsegment || '"' || chr(10) || 'second line' AS name, CAST(c_nationkey AS VARCHAR) AS nation FROM customer""")
def csv_scan(spark, d):
    """Quotes, separators and line ends inside fields."""
    name = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"\nsecond line'))
    df = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("key"), name.alias("name"), F.col("c_nationkey").cast("string").alias("nation"))
    return files.read_csv(spark, written(df, "csv-scan"))


@query("""
WITH n AS (SELECT c_name AS name, c_mktsegment AS note FROM customer)
SELECT 'like' AS by, name, count(*) AS n FROM n GROUP BY name UNION ALL SELECT 'name', note, count(*) FROM n GROUP BY note UNION ALL SELECT 'place', note, count(*) FROM n GROUP BY note
""")
def names_scan(spark, d):
    """The column of names: by a header that looks like one, by header in any case, by place."""
    df = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("Main Vendor"), F.col("c_mktsegment").alias(" Note "))
    path = written(df, "names-scan")
    ways = {"like": {}, "name": {"column": "NOTE"}, "place": {"index": 2}}
    parts = [files.read_names(spark, path, **how).groupBy("name").agg(F.count(F.lit(1)).alias("n")).select(F.lit(by).alias("by"), "name", "n") for by, how in ways.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT CAST(s_suppkey AS VARCHAR) AS key, 'Société Générale ' || s_name || ' Ñandú' AS name FROM supplier")
def latin1_scan(spark, d):
    """A file that isn't UTF-8 is read as Latin-1."""
    df = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("key"), F.concat(F.lit("Société Générale "), "s_name", F.lit(" Ñandú")).alias("name"))
    return files.read_csv_any(spark, written(df, "latin1", encoding="ISO-8859-1"))


_FILE = """
file AS (SELECT line_id, CASE line_id % 11 WHEN 0 THEN 'N/A' WHEN 1 THEN ' None ' ELSE supplier_name_raw END AS name, CASE line_id % 7 WHEN 0 THEN 'nan' ELSE supplier_id END AS sid,
  CASE line_id % 5 WHEN 0 THEN 'abc' ELSE CAST(amount AS VARCHAR) END AS amount, currency FROM po)"""


def _transaction_file(spark: SparkSession, d: str) -> str:
    n = F.col("line_id")
    name = F.when(n % 11 == 0, "N/A").when(n % 11 == 1, " None ").otherwise(F.col("supplier_name_raw"))
    amount = F.when(n % 5 == 0, "abc").otherwise(F.col("amount").cast("string"))
    df = po_lines(spark, d).select(name.alias(" VENDOR NAME "), F.when(n % 7 == 0, "nan").otherwise(F.col("supplier_id")).alias("Vendor ID"), amount.alias("Invoice Amount"), F.col("currency").alias("CURRENCY"), n.alias("Memo"))
    return written(df, "transactions")


@query(f"""
WITH {PO}, {_FILE}
SELECT line_id, trim(name) AS supplier_name_raw, coalesce(nullif({sql_clean_lenient("trim(name)")}, ''), trim(name)) AS supplier_name_normalized, nullif(sid, 'nan') AS supplier_id, try_cast(amount AS DOUBLE) AS amount, currency
FROM file WHERE lower(trim(name)) NOT IN ('n/a', 'none')
""")
def transactions_scan(spark, d):
    """A transaction file with loosely named headers: candidates, null words, amounts, fallback of the cleaned name."""
    rows = files.read_transactions(files.read_csv(spark, _transaction_file(spark, d), multiline=False))
    return rows.select(F.col("item_description").cast("long").alias("line_id"), "supplier_name_raw", "supplier_name_normalized", "supplier_id", F.col("amount").cast("double").alias("amount"), "currency")


_BULK = """
bulk AS (SELECT p_partkey AS k, 'client ' || (p_size % 3) AS client, CASE p_partkey % 10 WHEN 0 THEN 'Unknown' ELSE p_brand || ' ' || (p_partkey % 40) END AS name, CASE p_partkey % 3 WHEN 0 THEN p_name || 'NaN' ELSE p_name END AS description,
  CASE p_partkey % 4 WHEN 0 THEN 'NaN' ELSE CAST(p_size AS VARCHAR) END AS employees, split_part(p_type, ' ', 1) AS l1, p_type AS l3 FROM part)"""


def _bulk_file(spark: SparkSession, d: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    name = F.when(k % 10 == 0, "Unknown").otherwise(F.concat_ws(" ", "p_brand", (k % 40).cast("string")))
    df = table(spark, d, "part").orderBy("p_partkey").select(
        F.concat(F.lit("client "), (size % 3).cast("string")).alias("client #"), name.alias("Normalized_Supplier_Name"), F.when(k % 3 == 0, F.concat("p_name", F.lit("NaN"))).otherwise(F.col("p_name")).alias("Supplier_Description"),
        F.when(k % 4 == 0, "NaN").otherwise(size.cast("string")).alias("Employee_Count"), F.substring_index("p_type", " ", 1).alias("LI"), F.col("p_type").alias("L3"),
    )
    return files.read_csv(spark, written(df, "bulk", single=True))


@query(f"WITH {_BULK} SELECT name AS normalized_supplier_name, arg_min(description_, k) AS supplier_description, arg_min(employees_, k) AS employee_count, arg_min(l1, k) AS l1_category, arg_min(l3, k) AS l3_category FROM (SELECT *, coalesce(nullif(regexp_replace(description, 'NaN$', ''), ''), '~') AS description_, CASE WHEN employees = 'NaN' THEN '~' ELSE employees END AS employees_ FROM bulk) WHERE name <> 'Unknown' GROUP BY name")
def bulk_scan(spark, d):
    """A prepared master file: exact null words, one NaN cut off, the first row of a name."""
    first = files.read_bulk(_bulk_file(spark, d))[1]
    return first.select("normalized_supplier_name", "supplier_description", F.coalesce("employee_count", F.lit("~")).alias("employee_count"), "l1_category", "l3_category")


@query(f"WITH {_BULK} SELECT DISTINCT client AS client_id FROM bulk WHERE name <> 'Unknown'")
def bulk_clients(spark, d):
    return files.read_bulk(_bulk_file(spark, d))[0]


@query("SELECT 'upload' AS source, n_name AS client_id, count(*) AS n_rows, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1 GROUP BY n_name")
def uploads_scan(spark, d):
    """Upload folders, one a client; the client is in the path."""
    c, n = table(spark, d, "customer"), table(spark, d, "nation").filter("n_regionkey = 1")
    root = scratch_path(spark, "uploads")
    rows = c.join(n, c.c_nationkey == n.n_nationkey).select("n_name", "c_custkey", "c_name")
    for r in n.select("n_name").collect():
        files.write_csv(rows.filter(F.col("n_name") == r[0]).drop("n_name"), f"{root}/{r[0]}")
    up = files.read_uploads(spark, root)
    return up.groupBy(F.col("upload_client_id").alias("client_id")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("c_custkey").cast("long")).alias("keys")).select(F.lit("upload").alias("source"), "client_id", "n_rows", "keys")


@query("SELECT r_regionkey, r_name, upper(r_name) AS title, CAST(r_regionkey * 10 AS BIGINT) AS per_minute FROM region")
def config_scan(spark, d):
    """A JSON configuration file through Spark's readers."""
    region = table(spark, d, "region")
    entry = F.struct(F.col("r_name").alias("key"), F.struct((F.col("r_regionkey") * 10).alias("per_minute")).alias("value"))
    path = scratch_path(spark, "config")
    region.agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")).coalesce(1).write.text(path)
    config = files.read_config(spark, path)
    per_minute = F.create_map(*(F.lit(x) for k, v in config.items() for x in (k, v["per_minute"])))
    return region.select(F.col("r_regionkey").cast("int").alias("r_regionkey"), "r_name", F.upper("r_name").alias("title"), F.get(F.map_values(F.map_filter(per_minute, lambda k, _: k == F.col("r_name"))), F.lit(0)).cast("long").alias("per_minute"))


@query("SELECT 'master' AS name, count(*) AS n FROM supplier WHERE s_suppkey % 3 = 0 UNION ALL SELECT 'nothing yet', 0")
def master_or_empty(spark, d):
    """The published master, or an empty one of its columns where nothing has been published."""
    from masterline.cli import state_of

    root = scratch_path(spark, "published")
    state = {**{n: empty(spark, n) for n in ("supplier_attributes", "client_master", "supplier_crosswalk")}, "supplier_master": P._stamp(_seed_master(spark, d), "supplier_master")}
    files.publish({n: empty(spark, n) for n in state}, root)
    files.publish(state, root)
    counted = lambda name, r: state_of(spark, r)["supplier_master"].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
    return counted("master", root).unionByName(counted("nothing yet", scratch_path(spark, "published")))


@query("SELECT p_partkey, split_part(p_type, ' ', 1) AS l1, coalesce(nullif(split_part(p_type, ' ', 2), ''), '-') AS l2, p_type AS l3 FROM part")
def taxonomy_scan(spark, d):
    """Category columns by words that their headers contain."""
    part = table(spark, d, "part")
    word = lambda i: F.coalesce(F.get(F.split("p_type", " "), F.lit(i)), F.lit("-"))
    df = files.read_csv(spark, written(part.select(F.col("p_partkey").alias("row"), word(0).alias("Category Level 1"), word(1).alias("L2 name"), F.col("p_type").alias("Third (l3)")), "taxonomy"))
    at = lambda words: columns.quoted(df.columns[columns.containing_index(df.columns, words)])
    return df.select(F.col("row").cast("long").alias("p_partkey"), at(["l1", "level 1"]).alias("l1"), at(["l2", "level 2"]).alias("l2"), at(["l3", "level 3"]).alias("l3"))


# uploads

_UPLOAD = """
raw_upload AS (SELECT 'c' || (l_orderkey % 3) AS client_id, CASE WHEN l_linenumber = 3 THEN ' ' ELSE CAST(l_suppkey AS VARCHAR) END AS supplier_id, CASE WHEN l_linenumber = 5 THEN NULL ELSE s_name END AS name,
  CASE WHEN l_linenumber = 6 THEN 'n.a.' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS VARCHAR) END AS amount, CAST(CAST(l_quantity AS DECIMAL(18,4)) AS VARCHAR) AS quantity FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
upload AS (SELECT *, concat_ws(', ', CASE WHEN trim(supplier_id) = '' THEN 'supplier_id' END, CASE WHEN name IS NULL THEN 'supplier_name_normalized' END, CASE WHEN amount = 'n.a.' THEN 'amount' END) AS missing FROM raw_upload)"""
_MAPPING = {"VENDOR NAME": "supplier_name_normalized", "supplier name": "supplier_name_normalized", "Vendor No": "supplier_id", "Client": "client_id", "Total": "amount", "Qty": "quantity"}
_REQUIRED = ["client_id", "supplier_id", "supplier_name_normalized", "amount"]


def _upload(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    item, s = table(spark, d, "lineitem"), table(spark, d, "supplier")
    n, line = F.col("l_orderkey"), F.col("l_linenumber")
    rows = item.join(s, item.l_suppkey == s.s_suppkey).select(
        (n * 10 + line).alias("k"), F.concat(F.lit("c"), (n % 3).cast("string")).alias("client"), F.when(line == 3, " ").otherwise(F.col("l_suppkey").cast("string")).alias("Vendor No"),
        F.when((line != 5) & (n % 2 == 0), F.col("s_name")).alias("Vendor Name"), F.when((line != 5) & (n % 2 == 1), F.col("s_name")).alias("Supplier Name"),
        F.when(line == 6, "n.a.").otherwise(F.col("l_extendedprice").cast("decimal(18,4)").cast("string")).alias("total"), F.col("l_quantity").cast("decimal(18,4)").cast("string").alias("qty"),
    )
    state = {"suppliers": spark.createDataFrame([], "canonical_supplier_id string, normalized_supplier_name string, name_key string")}
    read = kept(files.read_csv(spark, written(rows, "upload"), multiline=False), "upload-rows")
    named = columns.rename_by_map(read, _MAPPING)
    state["transactions"] = named.withColumn("upload_id", F.lit("u1")).withColumn("amount", T.parse_amount(F.col("amount"))).withColumn("quantity", T.parse_amount(F.col("quantity"))).limit(0)
    return {**P.staged_upload(read, _MAPPING, _REQUIRED, state, "u1"), "named": named}


@query(f"WITH {_UPLOAD} SELECT client_id, supplier_id, max(name) AS supplier_name_normalized, CAST(sum(CAST(amount AS DECIMAL(18,4))) AS DOUBLE) AS total_spend, CAST(sum(CAST(quantity AS DECIMAL(18,4))) AS DOUBLE) AS total_quantity FROM upload WHERE missing = '' GROUP BY 1, 2")
def upload_totals(spark, d):
    """An upload under mapped headers, two of them for one column: valid rows, summed by client and supplier."""
    return _upload(spark, d)["supplier_totals"].select("client_id", "supplier_id", "supplier_name_normalized", F.col("total_spend").cast("double").alias("total_spend"), F.col("total_quantity").cast("double").alias("total_quantity"))


@query(f"WITH {_UPLOAD} SELECT 'missing required columns: ' || missing AS error_message, count(*) AS n FROM upload WHERE missing <> '' GROUP BY 1")
def upload_rejects(spark, d):
    return _upload(spark, d)["rejects"].groupBy("error_message").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_UPLOAD}, valid AS (SELECT DISTINCT client_id, supplier_id, trim(lower(name)) AS name_key FROM upload WHERE missing = '') SELECT client_id, supplier_id, name_key, 'exact_name_key' AS match_method FROM valid")
def upload_crosswalk(spark, d):
    out = _upload(spark, d)
    return out["crosswalk"].join(out["suppliers"], "canonical_supplier_id").select("client_id", "supplier_id", "name_key", "match_method")


@query("SELECT 'u' || (o_orderkey % 2) AS upload_client_id, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def upload_stream(spark, d):
    """Folders as a stream: what is there is taken once, in one batch, however often the stream is started."""
    root, target, checkpoint = (scratch_path(spark, f"stream-{x}") for x in ("in", "out", "checkpoint"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    for i in range(2):
        files.write_csv(orders.filter(F.col("o_orderkey") % 2 == i), f"{root}/u{i}")
    for _ in range(2):
        ingest.ingest(ingest.upload_stream(spark, root, "o_orderkey long, o_orderpriority string"), target, checkpoint, log=f"{checkpoint}-log").awaitTermination()
    return spark.read.parquet(target).groupBy("upload_client_id", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


# exports

_RESULTS = "results AS (SELECT s_name AS original, upper(s_name) || ', \"Co\"' AS normalized, s_suppkey % 3 = 0 AS individual, 'C-' || s_nationkey AS cluster, 'high' AS confidence, 'resolver-cluster' AS method, s_suppkey AS n FROM supplier)"


def _results(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    return s.select(F.col("s_name").alias("original"), F.concat(F.upper("s_name"), F.lit(', "Co"')).alias("normalized"), (F.col("s_suppkey") % 3 == 0).alias("individual"), F.concat(F.lit("C-"), F.col("s_nationkey").cast("string")).alias("cluster"), F.lit("high").alias("confidence"), F.lit("resolver-cluster").alias("method"), F.col("s_suppkey").alias("count"))


@query(f"""WITH {_RESULTS} SELECT original, normalized, CASE WHEN individual THEN 'Yes' ELSE 'No' END AS individual, cluster, confidence, method, CAST(n AS VARCHAR) AS "count" FROM results""")
def full_export(spark, d):
    return files.read_csv(spark, written(files.full_export(_results(spark, d)), "full-export"))


@query(f"WITH {_RESULTS} SELECT original, normalized, confidence FROM results")
def mapping_export(spark, d):
    return files.read_csv(spark, written(files.mapping_export(_results(spark, d)), "mapping-export"))


@query("SELECT p_name || ' ' || p_partkey AS Normalized_Supplier_Name, p_brand AS Category_Name, p_size AS Total_PO_Items, 17 AS n_columns FROM part")
def master_export(spark, d):
    """The master file's columns, in order, as CSV and back."""
    from pyspark.sql.types import StructType

    part = table(spark, d, "part").select(F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("Normalized_Supplier_Name"), F.col("p_brand").alias("Category_Name"), F.col("p_size").alias("Total_PO_Items"), F.col("p_type").alias("not in the file"))
    path = scratch_path(spark, "master-export")
    files.write_csv(conform(part, StructType.fromDDL(MASTER_FILE), F.lit("")), path)
    back = files.read_csv(spark, path)
    return back.select("Normalized_Supplier_Name", "Category_Name", F.col("Total_PO_Items").cast("int").alias("Total_PO_Items"), F.lit(len(back.columns)).alias("n_columns"))


@query("SELECT 'client_master' AS name, count(*) AS n, 4 AS n_columns FROM nation UNION ALL SELECT 'supplier_master', count(*), 3 FROM supplier WHERE s_suppkey % 3 = 0 UNION ALL SELECT 'supplier_crosswalk', count(*), 7 FROM supplier")
def reference_exports(spark, d):
    """Reference tables as CSV folders, read back."""
    nation, s = table(spark, d, "nation"), table(spark, d, "supplier")
    frames = {
        "client_master": P._stamp(nation.select(F.col("n_nationkey").alias("client_id"), F.col("n_name").alias("client_name")), "client_master"),
        "supplier_master": P._stamp(_seed_master(spark, d), "supplier_master"),
        "supplier_crosswalk": P._stamp(s.select(F.lit("acme").alias("client_id"), F.col("s_suppkey").alias("supplier_id")), "supplier_crosswalk"),
    }
    root = scratch_path(spark, "reference")
    files.export_tables(frames, root)
    back = {n: files.read_csv(spark, f"{root}/{n}") for n in frames}
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n", F.lit(len(df.columns)).alias("n_columns")) for n, df in back.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"WITH {PO}, {C._IDS} SELECT CASE WHEN is_new THEN 'new_suppliers_proposed' ELSE 'matches_proposed' END AS file, name, gid AS global_supplier_id FROM matched")
def proposal_exports(spark, d):
    """What a match proposes, as two files for review."""
    matched = kept(suppliers.match_or_assign(_names(spark, d), _seed_master(spark, d), "name", [F.col("first_line"), F.col("name")]), "matched")
    both = dict(zip(("matches_proposed", "new_suppliers_proposed"), P.proposals(matched.select("name", "global_supplier_id", "is_new")), strict=True))
    root = scratch_path(spark, "proposals")
    files.export_tables(both, root)
    back = [spark.read.schema("name string, global_supplier_id string").options(header=True, quote='"', escape='"').csv(f"{root}/{n}").withColumn("file", F.lit(n)) for n in both]
    return back[0].unionByName(back[1]).select("file", "name", "global_supplier_id")


@query("SELECT event_type AS stage, CASE WHEN value < 5 THEN 'error' ELSE 'ok' END AS status, count(*) AS n_rows, count(DISTINCT user_id) AS n_runs, max(CAST(ts AS VARCHAR)[1:10]) AS last_day FROM events GROUP BY 1, 2")
def run_log_rollup(spark, d):
    """Log rows appended as JSON lines, read back and counted by stage and status."""
    path = scratch_path(spark, "runs")
    e = table(spark, d, "events")
    status = F.when(F.col("value") < 5, "error").otherwise("ok")
    files.append_logs(e.select(F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("stage"), status.alias("status"), F.col("event_id").alias("row_count"), F.when(status == "error", "failed").alias("error_message"), F.col("ts").alias("timestamp")), path)
    return files.read_log(spark, path).groupBy("stage", "status").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("run_id").alias("n_runs"), F.date_format(F.max("timestamp"), "yyyy-MM-dd").alias("last_day"))


@query(f"WITH {PO}, {C._IDS}, c AS (SELECT count(*) AS r, count(DISTINCT supplier_name_raw) AS w, (SELECT count(*) FROM names) AS u, (SELECT count(*) FROM matched WHERE is_new) AS n, (SELECT count(*) FROM matched WHERE NOT is_new) AS e FROM po) SELECT printf('{{\"rows_read\":%d,\"raw_names\":%d,\"unique_suppliers\":%d,\"new_suppliers\":%d,\"existing_suppliers\":%d}}', r, w, u, n, e) AS summary FROM c")
def load_summary(spark, d):
    """The summary of a dry run as JSON text."""
    return P.load_summary(C.load_counts(spark, d))


@query(f"""
WITH {PO}, {_FILE}, good AS (SELECT *, trim(name) AS raw, coalesce(nullif({sql_clean_lenient("trim(name)")}, ''), trim(name)) AS norm FROM file WHERE lower(trim(name)) NOT IN ('n/a', 'none'))
SELECT 'supplier_master' AS name, count(DISTINCT lower(norm)) AS n FROM good UNION ALL SELECT 'client_master', 1 UNION ALL SELECT 'supplier_attributes', count(DISTINCT lower(norm)) FROM good
UNION ALL SELECT 'supplier_crosswalk', count(DISTINCT CASE WHEN sid = 'nan' THEN NULL ELSE sid END) FROM good
""")
def load_flow(spark, d):
    """A transaction file through to the four reference tables, published and read again: rows of each."""
    rows = kept(files.read_transactions(files.read_csv(spark, _transaction_file(spark, d), multiline=False)), "load-rows")
    state = {n: empty(spark, n) for n in ("supplier_master", "supplier_attributes", "client_master", "supplier_crosswalk")}
    root = scratch_path(spark, "load")
    files.publish(P.load_transactions(rows, "acme", "Acme", state), root)
    parts = [files.published(spark, root, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n in state]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# names and clusters


def _one_cluster(names: list[str]) -> list[dict]:
    """A resolver that takes each batch for one company, named by its first name in order."""
    return [{"canonical": min(names), "members": list(range(len(names))), "confidence": "high"}]


@query(f"""
WITH people AS (SELECT c_custkey AS k, c_mktsegment || ' ' || split_part(c_name, '#', 2) AS raw FROM customer UNION ALL SELECT 100000000 + s_suppkey, 'Zed' || s_suppkey FROM supplier),
forms AS (SELECT {sql_clean("raw")} AS cleaned, raw, count(*) AS n, min(k) AS first FROM people GROUP BY 1, 2),
entries AS (SELECT cleaned, arg_max(raw, n * 10000000000 - first) AS best, CAST(sum(n) AS BIGINT) AS n FROM forms WHERE cleaned <> '' GROUP BY cleaned),
blocked AS (SELECT *, {C.sql_key("cleaned")} AS block FROM entries),
sized AS (SELECT *, count(*) OVER (PARTITION BY block) AS members, floor((row_number() OVER (PARTITION BY block ORDER BY cleaned) - 1) / 50) AS batch FROM blocked),
batched AS (SELECT *, count(*) OVER (PARTITION BY block, batch) AS together, min(best) OVER (PARTITION BY block, batch) AS least FROM sized)
SELECT best AS original, CASE WHEN members >= 2 AND together > 1 THEN least ELSE best END AS normalized, CASE WHEN members < 2 THEN 'singleton' WHEN together > 1 THEN 'resolver-cluster' ELSE 'resolver-singleton' END AS method, n AS "count" FROM batched
""")
def normalizer_batches(spark, d):
    """The name flow with a resolver that SQL can follow: blocks, batches of 50, singletons, their union."""
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    rows = c.select(F.col("c_custkey").alias("k"), F.concat_ws(" ", "c_mktsegment", F.substring_index("c_name", "#", -1)).alias("raw")).unionByName(s.select((F.col("s_suppkey") + 100_000_000).alias("k"), F.concat(F.lit("Zed"), F.col("s_suppkey").cast("string")).alias("raw")))
    return P.normalize_names(rows, "raw", "k", resolver=_one_cluster).select("original", "normalized", "method", "count")


@query("WITH r AS (" + C.SQL["normalizer_batches"] + """) SELECT count(*) AS names, CAST(sum("count") AS BIGINT) AS rows, count(DISTINCT normalized) AS canonical_names, count(*) FILTER (method = 'resolver-cluster') AS clustered, 0 AS errors FROM r""")
def normalizer_stats(spark, d):
    """What the name flow reports at its end."""
    return P.normalization_stats(normalizer_batches(spark, d).withColumn("individual", F.lit(False))).select("names", "rows", "canonical_names", "clustered", F.col("errors").cast("int").alias("errors"))


@query(f"WITH {PO}, {C._FORMS}, best AS (SELECT cleaned, arg_max(raw, n * 10000000000 - first) AS best FROM forms GROUP BY cleaned) SELECT line_id, {sql_clean('supplier_name_raw')} AS cleaned, best AS best_original FROM po JOIN best ON {sql_clean('supplier_name_raw')} = best.cleaned")
def name_rows(spark, d):
    """Every row beside its cleaned name and the best form of it: the row indices of a name, as rows."""
    po = po_lines(spark, d).select("line_id", "supplier_name_raw")
    forms = po.select("supplier_name_raw").distinct().withColumn("cleaned", T.clean_name(F.col("supplier_name_raw")))
    best = suppliers.name_histogram(po, "supplier_name_raw", "line_id").select("cleaned", "best_original")
    return po.join(forms.join(best, "cleaned"), "supplier_name_raw").select("line_id", "cleaned", "best_original")


@query("""
SELECT s_suppkey, 17.0::DOUBLE / 18 AS ratio, round(0.35 / 3 + 0.5 * 17.0 / 18, 9)::DOUBLE AS another, 0.85::DOUBLE AS subset, 0.8::DOUBLE AS longest, round(2 * 18.0 / (18 + 23), 9)::DOUBLE AS longer
FROM supplier WHERE s_suppkey % 10 < 9
""")
def likeness_known(spark, d):
    """Likeness of names whose common parts are known: numbered suppliers that differ in their last digit share 17 of 18
    letters and one of three words; words added make a subset; the longest word alone is worth 0.8."""
    s = table(spark, d, "supplier").filter("s_suppkey % 10 < 9").select("s_suppkey", F.col("s_name").alias("name"))
    s = s.withColumn("other", F.concat(F.substring("name", 1, 17), F.substring("name", -1, 1).cast("int") + 1)).withColumn("more", F.concat(F.col("name"), F.lit(" Depot"))).withColumn("far", F.concat(F.lit("Xyz "), F.substring("name", -9, 9)))
    like = lambda a, b: name_similarity(a, b, T.comparison_name(F.col(a)), T.comparison_name(F.col(b)))
    return s.select("s_suppkey", sequence_ratio("name", "other").alias("ratio"), F.round(like("name", "other"), 9).alias("another"), like("name", "more").alias("subset"), like("name", "far").alias("longest"), F.round(sequence_ratio("name", F.concat("name", F.lit("#####"))), 9).alias("longer"))


@query(f"WITH {PO}, {C._COMPARE} SELECT DISTINCT supplier_name_raw, array_to_string(list_sort(string_split(comparison, ' ')), ' ') AS sorted_tokens FROM compared")
def sorted_tokens(spark, d):
    names = po_lines(spark, d).select("supplier_name_raw").distinct()
    return names.select("supplier_name_raw", F.array_join(F.array_sort(F.split(T.comparison_name(F.col("supplier_name_raw")), " ")), " ").alias("sorted_tokens"))


@query("""
WITH names AS (SELECT DISTINCT p_name AS n, upper(substr(split_part(p_name, ' ', 1), 1, 1) || substr(split_part(p_name, ' ', 2), 1, 1)) AS two, substr(p_name, 1, 3) AS three FROM part WHERE contains(p_name, ' '))
SELECT n AS name, true AS by_initials, true AS by_start, false AS by_other, 1.0::DOUBLE AS same, 1.0::DOUBLE AS ratio FROM names
""")
def name_measures(spark, d):
    """Likeness where SQL knows the answer: a name's initials and start abbreviate it, 'qq' doesn't, and it is like itself."""
    names = table(spark, d, "part").select(F.col("p_name").alias("name")).filter(F.col("name").contains(" ")).distinct()
    word = lambda i: F.get(F.split("name", " "), F.lit(i))
    initials = F.upper(F.concat(F.substring(word(0), 1, 1), F.substring(word(1), 1, 1)))
    clean = T.comparison_name(F.col("name"))
    return names.select("name", is_abbreviation(initials, "name").alias("by_initials"), is_abbreviation(F.substring("name", 1, 3), "name").alias("by_start"), is_abbreviation(F.lit("qq"), "name").alias("by_other"), name_similarity("name", "name", clean, clean).alias("same"), sequence_ratio("name", F.upper("name")).alias("ratio"))


def _sql_entity_short(c: str) -> str:
    t = rf"string_split(trim(regexp_replace(regexp_replace(lower(trim({c})), '[^a-z0-9_\s&]', ' ', 'g'), '\s+', ' ', 'g')), ' ')"
    has = lambda words: f"list_has_any({t}, [{', '.join(repr(w) for w in words)}])"
    return rf"""CASE WHEN {has(W.STRONG_SUFFIXES)} THEN 'organization/high/legal_suffix' WHEN {t}[1] IN {sql_list(W.PERSON_TITLES)} THEN 'individual/high/title_prefix'
  WHEN {t}[-1] IN {sql_list(W.PERSON_TITLE_SUFFIXES)} THEN 'individual/high/title_suffix' WHEN {has(W.CORPORATE_WORDS_SHORT)} THEN 'organization/high/corp_keyword'
  WHEN regexp_matches({c}, '[&+]') AND len({t}) >= 3 THEN 'organization/medium/ampersand' WHEN regexp_matches({c}, '\d') THEN 'organization/medium/has_numbers'
  WHEN len({t}) = 1 THEN 'organization/low/single_word' WHEN len({t}) >= 4 THEN 'organization/low/long_name' WHEN {t}[1] IN ('james', 'john', 'maria', 'olivia') THEN 'individual/medium/firstname_match' ELSE 'unknown/low/no_signal' END"""


@query(f"WITH {C._PEOPLE}, more AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'Olivia ' || c_mktsegment ELSE name END AS name FROM people JOIN customer USING (c_custkey)) SELECT c_custkey, name, {_sql_entity_short('name')} AS entity FROM more")
def entity_class_short(spark, d):
    """The smaller rule set, with first names that the caller gives."""
    segment = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    more = C.people(spark, d).join(segment, "c_custkey").select("c_custkey", F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("Olivia "), "c_mktsegment")).otherwise(F.col("name")).alias("name"))
    e = classify_entity(F.col("name"), ["james", "john", "maria", "olivia"], short=True)
    return more.select("c_custkey", "name", F.concat_ws("/", e["type"], e["confidence"], e["reason"]).alias("entity"))


@query("SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'individual/medium/firstname_match' WHEN 1 THEN 'individual/medium/firstname_match' WHEN 2 THEN 'individual/high/last_comma_first' ELSE 'unknown/low/no_signal' END AS entity FROM supplier")
def entity_listed_names(spark, d):
    """First names from a list of the caller's, read from a file: names outside the default list count."""
    path = scratch_path(spark, "first-names")
    spark.createDataFrame([("Olivia",), (" nikhil ",), ("",)], "value string").write.text(path)
    listed = files.read_word_list(spark, path)
    k = F.col("s_suppkey") % 4
    name = F.when(k == 0, "Olivia Brown").when(k == 1, "Nikhil Verma").when(k == 2, "Verma, Nikhil").otherwise("Nobody Brown")
    e = classify_entity(name, listed)
    return table(spark, d, "supplier").select("s_suppkey", F.concat_ws("/", e["type"], e["confidence"], e["reason"]).alias("entity"))


@query("SELECT s_suppkey, 1 AS n_clusters, CASE WHEN s_suppkey % 2 = 0 THEN 'Acme ' ELSE 'it ' END || s_suppkey AS canonical, '0 ' || s_suppkey AS members FROM supplier")
def cluster_salvage(spark, d):
    """Answers cut off after a whole cluster, and answers in single quotes."""
    k = F.col("s_suppkey").cast("string")
    cut = F.concat(F.lit('{"clusters": [{"canonical": "Acme '), k, F.lit('", "members": [0, '), k, F.lit('], "confidence": "high"}, {"canonical": "Lost'))
    single = F.concat(F.lit("{'clusters': [{'canonical': 'it "), k, F.lit("', 'members': [0, "), k, F.lit("], 'confidence': 'low',}"))
    found = F.from_json(repair_json(F.when(F.col("s_suppkey") % 2 == 0, cut).otherwise(single)), "clusters array<struct<canonical: string, members: array<int>>>")
    return table(spark, d, "supplier").withColumn("c", found).select("s_suppkey", F.size("c.clusters").alias("n_clusters"), F.col("c.clusters")[0]["canonical"].alias("canonical"), F.array_join(F.col("c.clusters")[0]["members"].cast("array<string>"), " ").alias("members"))


# refresh, categories and models


@query(f"""
WITH {PO}, lines AS (SELECT line_id, CASE line_id % 9 WHEN 0 THEN ' ' ELSE supplier_name_raw END AS name, supplier_id FROM po),
countries AS (SELECT CASE s_suppkey % 8 WHEN 0 THEN 'nan' ELSE CAST(s_suppkey AS VARCHAR) END AS supplier_id, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE n_name END AS country FROM supplier JOIN nation ON s_nationkey = n_nationkey),
known AS (SELECT * FROM countries WHERE supplier_id <> 'nan' AND country <> '')
SELECT coalesce(country, '-') AS country, count(*) AS n_lines, count(DISTINCT name) AS n_names FROM lines LEFT JOIN known USING (supplier_id) WHERE trim(name) <> '' GROUP BY 1
""")
def located_lines(spark, d):
    """Purchase lines with the country of their supplier number; blank names, numbers and countries are left out."""
    s, n, k = table(spark, d, "supplier"), table(spark, d, "nation"), F.col("s_suppkey")
    twice = s.join(n, s.s_nationkey == n.n_nationkey).select(F.when(k % 8 == 0, "nan").otherwise(k.cast("string")).alias("supplier_number"), F.when(k % 5 == 0, "").otherwise(F.col("n_name")).alias("country"), k.alias("row_index"))
    older = twice.withColumn("row_index", F.col("row_index") - 1_000_000).withColumn("country", F.lit("older"))
    countries = twice.unionByName(older.join(twice.filter("country != ''").select("supplier_number"), "supplier_number", "left_semi"))
    lines = po_lines(spark, d).select(F.when(F.col("line_id") % 9 == 0, " ").otherwise(F.col("supplier_name_raw")).alias("supplier_name"), F.col("supplier_id").alias("supplier_number"))
    return P.located(lines, countries).groupBy(F.coalesce("country", F.lit("-")).alias("country")).agg(F.count(F.lit(1)).alias("n_lines"), F.countDistinct("supplier_name").alias("n_names"))


@query(f"""
WITH {PO}, lines AS (SELECT supplier_name_raw AS raw, CASE WHEN CAST(supplier_id AS BIGINT) % 3 = 0 THEN 'Canon ' || supplier_id ELSE supplier_name_raw END AS canonical_name, CASE line_id % 3 WHEN 0 THEN 'France' WHEN 1 THEN 'Germany' ELSE 'Unknown' END AS place FROM po)
SELECT canonical_name, string_agg(DISTINCT raw, '; ' ORDER BY raw) AS variants, count(*) AS n_items, string_agg(DISTINCT place, ', ' ORDER BY place) AS places FROM lines GROUP BY 1
""")
def supplier_facts(spark, d):
    """Lines under their canonical names: variants, lines and countries of each."""
    po = po_lines(spark, d).select(F.col("supplier_name_raw").alias("supplier_name"), "supplier_id", "line_id")
    names = po.filter(F.col("supplier_id").cast("long") % 3 == 0).select("supplier_name", F.concat(F.lit("Canon "), "supplier_id").alias("canonical_name")).distinct()
    n = F.col("line_id") % 3
    rows = P.renamed(po, names).withColumn("country", F.when(n == 0, "fr").when(n == 1, "GERMANY").otherwise(" "))
    return P.supplier_facts(rows).select("canonical_name", F.array_join("variants", "; ").alias("variants"), "n_items", F.array_join("names", ", ").alias("places"))


@query(f"{C._LINES} SELECT supplier_id, count(DISTINCT l1 || '|' || l2 || '|' || l3) AS n_categories, count(*) FILTER (confidence < 0.6::DOUBLE) AS n_low FROM lines GROUP BY supplier_id")
def classification_counts(spark, d):
    return taxonomy.classification_counts(_lines(spark, d), "supplier_id")


def _move_even(row: dict) -> dict:
    """A reviewer that SQL can follow: every other item goes to the category with its number, counted around."""
    return {"reassignments": [{"item_id": x["item_id"], "to_category_id": x["item_id"] % len(row["established"])} for x in row["items"] if x["item_id"] % 2 == 0] + [{"item_id": 999, "to_category_id": 0}, {"item_id": 1, "to_category_id": -1}]}


@query("""
WITH lines AS (SELECT o_orderkey AS line_id, o_custkey % 40 AS supplier_id, o_orderstatus AS l1, o_orderpriority AS l2, o_orderstatus || ' ' || o_orderpriority AS l3, CAST(o_orderkey % 100 AS DOUBLE) / 128 AS confidence FROM orders),
high AS (SELECT supplier_id, l1, l2, l3, min(line_id) AS first FROM lines WHERE confidence >= 0.6::DOUBLE GROUP BY 1, 2, 3, 4),
numbered AS (SELECT *, row_number() OVER (PARTITION BY supplier_id ORDER BY first) - 1 AS c, count(*) OVER (PARTITION BY supplier_id) AS n FROM high),
low AS (SELECT line_id, supplier_id, row_number() OVER (PARTITION BY supplier_id ORDER BY line_id) - 1 AS i FROM lines WHERE confidence < 0.6::DOUBLE),
moved AS (SELECT line_id, m.l1, m.l2, m.l3 FROM low JOIN numbered m USING (supplier_id) WHERE i < 50 AND i % 2 = 0 AND c = i % n)
SELECT supplier_id, coalesce(m.l3, l.l3) AS l3, count(*) AS n_lines, round(avg(confidence), 9) AS avg_confidence FROM lines l LEFT JOIN moved m USING (line_id) GROUP BY 1, 2
""")
def consolidated(spark, d):
    """Low-confidence lines reviewed beside a supplier's established categories, the first 50 of each supplier."""
    n = F.col("o_orderkey")
    lines = table(spark, d, "orders").select(n.alias("line_id"), (F.col("o_custkey") % 40).alias("supplier_id"), F.col("o_orderstatus").alias("l1"), F.col("o_orderpriority").alias("l2"), F.concat_ws(" ", "o_orderstatus", "o_orderpriority").alias("l3"), F.col("o_orderpriority").alias("item_description"), ((n % 100).cast("double") / 128).alias("confidence"))
    out = models.consolidate(lines, "supplier_id", "line_id", "item_description", _move_even)
    return out.groupBy("supplier_id", "l3").agg(F.count(F.lit(1)).alias("n_lines"), F.round(F.avg("confidence"), 9).alias("avg_confidence"))


@query(f"""
WITH {PO}, d AS (SELECT DISTINCT supplier_id, trim(item_description) AS x FROM po),
drawn AS (SELECT *, row_number() OVER (PARTITION BY supplier_id ORDER BY md5(x), x) AS r FROM d)
SELECT supplier_id, count(*) FILTER (r <= 100) AS n_drawn, string_agg(x, '|' ORDER BY r) FILTER (r <= 3) AS tags, greatest(0, count(*) FILTER (r <= 100) - 50) AS n_hidden FROM drawn GROUP BY supplier_id
""")
def product_tags(spark, d):
    """Up to 100 descriptions of a supplier are drawn, 50 of them shown to the model."""
    tags = models.product_tags(po_lines(spark, d), "supplier_id", "item_description", lambda row: {"tags": [*row["shown"][:3], str(row["n_drawn"] - len(row["shown"]))]})
    n = F.size("tags")
    return tags.select("supplier_id", "n_drawn", F.array_join(F.slice("tags", F.lit(1), n - 1), "|").alias("tags"), F.element_at("tags", -1).cast("long").alias("n_hidden"))


def _about(row: dict) -> dict | None:
    """A model that answers, leaves blanks, gives nothing, and fails, by the supplier's number."""
    k = row["s_suppkey"] % 4
    if k == 3:
        raise ValueError("no answer")
    return None if k == 2 else {"description": f"about {row['s_name']}", "employee_count": "" if k else 10, "confidence": "0.5"}


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 < 2 THEN 'about ' || s_name ELSE 'Not available' END AS description, CASE WHEN s_suppkey % 4 = 0 THEN '10' ELSE 'Unknown' END AS employee_count, 'Unknown' AS revenue, 'Unknown' AS year_established, CASE WHEN s_suppkey % 4 < 2 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS confidence FROM supplier")
def enrichment(spark, d):
    return models.enrich(table(spark, d, "supplier").select("s_suppkey", "s_name"), _about).drop("s_name")


@query(f"WITH best AS ({C.SQL['taxonomy_topk'].strip().removeprefix('WITH ').replace('SELECT * FROM ranked WHERE rank <= 25', '')}".replace("WITH best AS (", "WITH ", 1) + " SELECT description, l1, l2, l3, round(least(1.0::DOUBLE, score / len(list_distinct(regexp_split_to_array(lower(description), '\\s+')))), 9) AS confidence FROM ranked WHERE rank = 1")
def line_category(spark, d):
    """One category for each different description, out of its candidates."""
    part = table(spark, d, "part")
    head = lambda c: F.substring_index(c, " ", 1)
    cats = part.select(F.col("p_brand").alias("l1"), head("p_type").alias("l2"), F.concat_ws(" ", "p_type", head("p_name")).alias("l3"))
    return models.classify(part, "p_name", cats).select("description", "l1", "l2", "l3", F.round("confidence", 9).alias("confidence"))


@query("""
WITH names AS (SELECT DISTINCT p_brand AS block, CAST(p_size % 7 AS INT) AS cluster, p_brand || ' ' || p_name || ' ' || p_size AS name FROM part),
sized AS (SELECT block, cluster, count(*) AS n, row_number() OVER (ORDER BY block, cluster) - 1 AS i FROM names GROUP BY 1, 2)
SELECT block, cluster, n AS n_names, CASE WHEN n > 1 AND (i % 10) % 2 = 0 THEN true ELSE false END AS one_company FROM sized
""")
def confirmed_clusters(spark, d):
    """Ambiguous clusters in batches of ten; the model takes every other one of a batch for one company."""
    names = table(spark, d, "part").select(F.col("p_brand").alias("block"), (F.col("p_size") % 7).cast("int").alias("cluster"), F.concat_ws(" ", "p_brand", "p_name", F.col("p_size").cast("string")).alias("name")).distinct()
    status = names.select("block", "cluster").distinct().withColumn("status", F.lit("ambiguous"))
    model = lambda row: {"results": [{"cluster_id": c["cluster_id"], "same_company": c["cluster_id"] % 2 == 0} for c in row["clusters"]]}
    out = models.confirm_clusters(names, status, model).join(names, "name")
    sizes = out.groupBy("block", "cluster").agg(F.countDistinct("name").alias("n_names"), F.countDistinct("canonical_name").alias("n_canonical"))
    return sizes.select("block", "cluster", "n_names", ((F.col("n_names") > 1) & (F.col("n_canonical") == 1)).alias("one_company"))


# vectors


def _vector_table(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    client = F.when(F.col("label") % 5 == 0, "other").otherwise("global")
    return e.select(client.alias("client_id"), F.concat(F.lit("G"), F.col("vec_id").cast("string")).alias("global_supplier_id"), F.lit("0").alias("chunk_id"), "embedding", F.repeat(F.concat(F.lit("supplier "), F.col("vec_id").cast("string"), F.lit(" ")), 20).alias("source_text"))


@query("""
WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 3), v AS (SELECT vec_id, 'G' || vec_id AS gid, list_cosine_similarity(embedding::DOUBLE[], (SELECT e FROM q)::DOUBLE[]) AS s FROM embeddings WHERE label % 5 <> 0)
SELECT gid AS global_supplier_id, round(s, 6) AS similarity, substr(repeat('supplier ' || vec_id || ' ', 20), 1, 100) AS preview FROM v ORDER BY s DESC, gid LIMIT 5
""")
def vector_search(spark, d):
    """The nearest of a client's vectors, with the start of their texts."""
    e = table(spark, d, "embeddings")
    found = vectors.search(_vector_table(spark, d), e.filter("vec_id = 3").first()["embedding"])
    return found.withColumn("similarity", F.round("similarity", 6))


@query("SELECT 'G' || s_suppkey AS global_supplier_id, CASE WHEN s_suppkey % 3 = 0 THEN 'old' ELSE substr(s_name || CASE WHEN s_suppkey % 2 = 0 THEN ' ' || n_name ELSE '' END, 1, 10000) END AS source_text, CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 64 END AS width, CASE WHEN s_suppkey % 3 = 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS squares FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def vector_upsert(spark, d):
    """Suppliers without a vector are embedded, from their name and attributes, and come into the table."""
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    gid = F.concat(F.lit("G"), F.col("s_suppkey").cast("string")).alias("global_supplier_id")
    blank = [F.lit(None).cast("string").alias(c) for c in ("l1_category", "l2_category", "l3_category", "product_service_tags")]
    attributes = s.join(n, s.s_nationkey == n.n_nationkey, "left").select(gid, F.when(F.col("s_suppkey") % 2 == 0, F.col("n_name")).otherwise(" ").alias("supplier_description"), *blank)
    old = s.filter("s_suppkey % 3 = 0").select(F.lit("global").alias("client_id"), gid, F.lit("0").alias("chunk_id"), F.array(F.lit(0.5), F.lit(0.5)).cast("array<float>").alias("embedding"), F.lit("old").alias("source_text"), F.current_timestamp().alias("indexed_at"))
    new = vectors.embed_suppliers(s.select(gid, F.col("s_name").alias("normalized_supplier_name")), attributes, old)
    good, _ = vectors.checked(new, 64)
    squares = F.round(vectors.dot(F.col("embedding"), F.col("embedding")), 5)
    return vectors.load_vectors(old, good).select("global_supplier_id", "source_text", F.size("embedding").alias("width"), squares.alias("squares"))


@query("SELECT CASE WHEN vec_id % 3 = 0 THEN 'embedding length 63, expected 64' ELSE '' END AS error_message, count(*) AS n FROM embeddings GROUP BY 1")
def vector_checks(spark, d):
    """Vectors of another width than the table's are reported."""
    v = _vector_table(spark, d).withColumn("embedding", F.when(F.substring("global_supplier_id", 2, 20).cast("long") % 3 == 0, F.slice("embedding", 1, 63)).otherwise(F.col("embedding")))
    good, bad = vectors.checked(v, 64)
    both = good.select(F.lit("").alias("error_message")).unionByName(bad.select("error_message"))
    return both.groupBy("error_message").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT vec_id, 4 * len(embedding) AS n_bytes, embedding[1]::DOUBLE AS first, embedding[64]::DOUBLE AS last FROM embeddings")
def packed_vectors(spark, d):
    """Vectors as little-endian float32, and back."""
    e = table(spark, d, "embeddings").select("vec_id", packed("embedding").alias("b")).withColumn("v", unpacked("b"))
    return e.select("vec_id", F.length("b").cast("long").alias("n_bytes"), F.col("v")[0].cast("double").alias("first"), F.col("v")[63].cast("double").alias("last"))


@query("SELECT vec_id, replace(CAST(embedding::DOUBLE[] AS VARCHAR), ', ', ',') AS literal FROM embeddings")
def vector_literals(spark, d):
    return table(spark, d, "embeddings").select("vec_id", vector_literal("embedding").alias("literal"))


# tables


_COLUMNS = {t: len(c.replace("decimal(18,4)", "decimal").replace("map<string,string>", "map").split(", ")) for t, c in TABLES.items()}


@query(f"SELECT t.name, t.n_columns, CASE t.name WHEN 'supplier_master' THEN (SELECT count(*) FROM supplier) WHEN 'client_master' THEN (SELECT count(*) FROM customer) ELSE 0 END AS n_rows FROM (VALUES {', '.join(f'({chr(39)}{t}{chr(39)}, {n})' for t, n in _COLUMNS.items())}) AS t(name, n_columns)")
def table_ddl(spark, d):
    """Every logical table created in a database, two of them filled: columns and rows as the catalog has them."""
    from masterline.sources.database import create_tables

    database = f"masterline_{uuid.uuid4().hex}"
    at = F.current_timestamp()
    rows = {
        "supplier_master": table(spark, d, "supplier").select(F.concat(F.lit("G"), "s_suppkey"), "s_name", at),
        "client_master": table(spark, d, "customer").select(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment", at),
    }
    create_tables(spark, database)
    try:
        for name, df in rows.items():
            df.write.insertInto(f"{database}.{name}")
        made = [spark.table(f"{database}.{t}") for t in TABLES]
        counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("name"), F.lit(len(df.columns)).alias("n_columns"), "n_rows") for t, df in zip(TABLES, made, strict=True)]
        return kept(reduce(DataFrame.unionByName, counts), "ddl")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


@query("SELECT 'database' AS kind, 'no_such_database' AS name, false AS known UNION ALL SELECT 'table', r_name, r_regionkey < 2 FROM region UNION ALL SELECT 'nation', n_name, n_nationkey IN (SELECT s_nationkey FROM supplier) FROM nation")
def existence_checks(spark, d):
    """Whether the catalog has a database or a table, and whether a table has a row for a key."""
    region = table(spark, d, "region")
    prefix = f"masterline_{uuid.uuid4().hex}_"
    names = [r["r_name"] for r in region.select("r_name").distinct().collect()]
    made = [r["r_name"] for r in region.filter("r_regionkey < 2").collect()]
    for name in made:
        region.createOrReplaceTempView(f"`{prefix}{name}`")
    found = F.array(*(F.lit(n) for n in names if spark.catalog.tableExists(f"`{prefix}{n}`")))
    for name in made:
        spark.catalog.dropTempView(f"{prefix}{name}")
    in_catalog = region.select(F.lit("table").alias("kind"), F.col("r_name").alias("name"), F.array_contains(found, F.col("r_name")).alias("known"))
    database = region.limit(1).select(F.lit("database").alias("kind"), F.lit("no_such_database").alias("name"), F.lit(spark.catalog.databaseExists("no_such_database")).alias("known"))
    rows = tables.flag_existing(table(spark, d, "nation"), table(spark, d, "supplier"), F.col("n_nationkey"), F.col("s_nationkey"), "known")
    return database.unionByName(in_catalog).unionByName(rows.select(F.lit("nation").alias("kind"), F.col("n_name").alias("name"), "known"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS stamp, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS instant, o_orderdate >= TIMESTAMP '1995-01-01 00:00:00' AS is_late FROM orders")
def date_stamps(spark, d):
    """Dates and times as the files have them, and a comparison with a time literal."""
    at = F.col("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", F.date_format(at, "yyyy-MM-dd").alias("stamp"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("instant"), (at >= F.to_timestamp(F.lit("1995-01-01 00:00:00"))).alias("is_late"))


@query("SELECT r, s_suppkey, s_name FROM (SELECT *, CAST(row_number() OVER (ORDER BY s_name, s_suppkey) AS BIGINT) AS r FROM supplier) WHERE r <= 10")
def ordered_preview(spark, d):
    """The start of a listing in name order."""
    from masterline.operators.ids import row_numbers

    first = table(spark, d, "supplier").select("s_suppkey", "s_name").orderBy("s_name", "s_suppkey").limit(10)
    return row_numbers(first, [F.col("s_name"), F.col("s_suppkey")], "r").select("r", "s_suppkey", "s_name")


@query()
def master_refresh(spark, d):
    """The whole refresh of the master file; its likeness of names has no form in SQL."""
    po = po_lines(spark, d)
    lines = po.filter("line_id % 3 = 0").select(F.col("supplier_id").alias("supplier_number"), F.col("p_brand").alias("supplier_name"), "item_description", F.col("line_id").alias("row_index"))
    # by number and country first: least texts alone are found by sorting
    places = po.groupBy(F.col("supplier_id").alias("supplier_number"), "country").agg(F.min("line_id").alias("row_index"))
    countries = places.groupBy("supplier_number").agg(F.min("country").alias("country"), F.min("row_index").alias("row_index"))
    cats = table(spark, d, "part").select(F.col("p_brand").alias("l1"), F.substring_index("p_type", " ", 1).alias("l2"), F.col("p_type").alias("l3")).distinct()
    old = spark.createDataFrame([("Brand#11", "Brand#11", *[""] * 11, 5, "", "", "2024-01-01")], MASTER_FILE)
    return P.refresh_master(lines, countries, cats, old, today=F.lit("2026-01-01").cast("date"))


@query("SELECT p_partkey AS k, p_name AS name, row_number() OVER (ORDER BY p_partkey) - 1 AS row_index FROM part")
def file_ordinals(spark, d):
    """Rows of many delimited files numbered in file order, whatever their splits."""
    part = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"))
    files_ = part.repartitionByRange(7, "k").sortWithinPartitions("k")
    rows = files.file_ordinals(files.read_csv(spark, written(files_, "ordinals"), multiline=False))
    return rows.select(F.col("k").cast("long").alias("k"), "name", "row_index")


@query("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 'again' ELSE o_orderpriority END AS priority FROM orders WHERE o_orderstatus <> 'P' AND (o_orderstatus <> 'F' OR o_orderkey % 2 = 0)")
def partition_replace(spark, d):
    """An upload replaced in place, and another left without rows: only their partitions are rewritten."""
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("priority"), "o_orderstatus")
    path = scratch_path(spark, "partitions")
    files.replace_partitions(orders, path, ["o_orderstatus"])
    again = orders.filter("o_orderstatus = 'F' AND o_orderkey % 2 = 0").withColumn("priority", F.lit("again"))
    files.replace_partitions(again, path, ["o_orderstatus"], emptied=[("P",)])
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "priority")


_NEAREST = """
WITH found AS (SELECT q.vec_id AS query, e.vec_id AS key, 1 - list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS distance FROM embeddings q, embeddings e WHERE q.vec_id % 50 = 0)
SELECT query, key, round(distance, 6) AS distance, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, key) AS rank FROM found) WHERE rank <= 5"""


def _vector_index(spark: SparkSession, d: str, lists: int) -> tuple[str, DataFrame, DataFrame]:
    rows, path = table(spark, d, "embeddings").select("vec_id", "embedding"), scratch_path(spark, "vector-index")
    vector_index.build_index(rows, path, lists, "vec_id")
    return path, rows, rows.filter("vec_id % 50 = 0")


@query(_NEAREST)
def vector_index_search(spark, d):
    """The nearest five of a query set in an inverted file, with all its lists probed: the exact answer."""
    path, _, asked = _vector_index(spark, d, 16)
    return vector_index.search_many(spark, path, asked, 5, 16, "vec_id", "vec_id").withColumn("distance", F.round("distance", 6))


@query()
def vector_index_recall(spark, d):
    """How many of the exact nearest five of each of a query set 12 of 16 probed lists find."""
    path, _, asked = _vector_index(spark, d, 16)
    near = lambda probes: vector_index.search_many(spark, path, asked, 5, probes, "vec_id", "vec_id").select("query", "key")
    found = near(16).join(near(12).withColumn("_found", F.lit(1)), ["query", "key"], "left")
    return found.groupBy("query").agg(F.count(F.lit(1)).alias("n_exact"), F.count("_found").alias("n_found"))
