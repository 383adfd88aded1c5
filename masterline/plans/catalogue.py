"""Registered queries over the test tables, each beside its ANSI-SQL counterpart.

The supplier domain has no columns of its own in those tables: po_lines derives purchase lines from
lineitem, supplier, part and nation, alike on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from masterline.functions import text as T
from masterline.functions import wordlists as W
from masterline.functions.countries import normalize_country
from masterline.functions.entity import classify_entity
from masterline.functions.udfs import repaired_json, sequence_ratio
from masterline.operators import clusters, suppliers, tables, taxonomy, vectors
from masterline.operators.columns import conform
from masterline.operators.ids import batches, format_id, row_numbers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PO = """
po AS (
  SELECT l_orderkey * 10 + l_linenumber AS line_id, CAST(l_suppkey AS VARCHAR) AS supplier_id,
    CASE (l_orderkey + l_linenumber) % 6 WHEN 0 THEN s_name WHEN 1 THEN upper(s_name) || ' INC.' WHEN 2 THEN 'The ' || s_name || ', LLC'
      WHEN 3 THEN s_name || ' & Co' WHEN 4 THEN '  ' || s_name || ' dba 12 Ltd' ELSE lower(s_name) || ' Holdings Group' END AS supplier_name_raw,
    CASE WHEN l_linenumber % 5 = 0 THEN CAST(l_partkey AS VARCHAR) ELSE p_name END AS item_description,
    CAST(l_extendedprice AS DECIMAL(18,4)) AS amount, CAST(l_quantity AS DECIMAL(18,4)) AS quantity,
    CASE n_regionkey WHEN 0 THEN 'ZAR' WHEN 1 THEN 'USD' WHEN 2 THEN 'JPY' WHEN 3 THEN 'EUR' ELSE 'AED' END AS currency,
    CAST(l_shipdate AS DATE) AS spend_date, n_name AS country, p_brand, p_type, l_discount
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey JOIN nation ON s_nationkey = n_nationkey
)"""


def po_lines(spark: SparkSession, d: str) -> DataFrame:
    item, s, p, n = (table(spark, d, t) for t in ("lineitem", "supplier", "part", "nation"))
    joined = item.join(s, item.l_suppkey == s.s_suppkey).join(p, item.l_partkey == p.p_partkey).join(n, s.s_nationkey == n.n_nationkey)
    form, name = (F.col("l_orderkey") + F.col("l_linenumber")) % 6, F.col("s_name")
    raw = (
        F.when(form == 0, name)
        .when(form == 1, F.concat(F.upper(name), F.lit(" INC.")))
        .when(form == 2, F.concat(F.lit("The "), name, F.lit(", LLC")))
        .when(form == 3, F.concat(name, F.lit(" & Co")))
        .when(form == 4, F.concat(F.lit("  "), name, F.lit(" dba 12 Ltd")))
        .otherwise(F.concat(F.lower(name), F.lit(" Holdings Group")))
    )
    region = F.col("n_regionkey")
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"),
        F.col("l_suppkey").cast("string").alias("supplier_id"),
        raw.alias("supplier_name_raw"),
        F.when(F.col("l_linenumber") % 5 == 0, F.col("l_partkey").cast("string")).otherwise(F.col("p_name")).alias("item_description"),
        F.col("l_extendedprice").cast("decimal(18,4)").alias("amount"),
        F.col("l_quantity").cast("decimal(18,4)").alias("quantity"),
        F.when(region == 0, "ZAR").when(region == 1, "USD").when(region == 2, "JPY").when(region == 3, "EUR").otherwise("AED").alias("currency"),
        F.to_date("l_shipdate").alias("spend_date"),
        F.col("n_name").alias("country"),
        "p_brand",
        "p_type",
        "l_discount",
    )


def _alt(words) -> str:
    return "|".join(words)


def sql_list(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def sql_clean(c: str) -> str:
    t = f"replace(lower(trim({c})), '&', ' and ')"
    t = rf"regexp_replace({t}, '\b(?:{_alt(T.MARKERS)})\b', '', 'g')"
    t = rf"regexp_replace({t}, '[^a-z0-9_\s-]', ' ', 'g')"
    t = rf"trim(regexp_replace(regexp_replace({t}, '\b\d{{1,3}}\b', ' ', 'g'), '\s+', ' ', 'g'))"
    t = rf"regexp_replace({t}, '(?: (?:{_alt(W.CLEAN_SUFFIXES)}))+$', '')"
    t = rf"trim(regexp_replace({t}, '^(?:(?:{_alt(W.PREFIX_WORDS)}) )+', ''))"
    return rf"CASE WHEN regexp_full_match(trim({c}), '\d+') OR length(trim({c})) < 2 THEN '' ELSE {t} END"


def sql_clean_lenient(c: str) -> str:
    t = f"replace(lower(trim({c})), '&', ' and ')"
    t = rf"regexp_replace({t}, '\b(?:{_alt(T.MARKERS)})\b', '', 'g')"
    t = rf"regexp_replace({t}, '^\W+\s-', '')"
    t = rf"trim(regexp_replace(regexp_replace({t}, '\b\d{{1,3}}\b', '', 'g'), '\s+', ' ', 'g'))"
    t = rf"trim(regexp_replace({t}, '^(?:(?:{_alt(W.PREFIX_WORDS)}) )+', ''))"
    return rf"CASE WHEN regexp_full_match(trim({c}), '\W+\d+') OR length(trim({c})) < 2 THEN '' ELSE {t} END"


def sql_key(c: str) -> str:
    t = f"string_split({c}, ' ')"
    key = f"CASE WHEN len({t}) > 1 AND (length({t}[1]) <= 2 OR {t}[1] IN {sql_list(W.COMMON_FIRST_WORDS)}) THEN {t}[1] || '_' || {t}[2] ELSE {t}[1] END"
    return f"CASE WHEN {c} = '' THEN '_empty_' WHEN len({t}) > 2 AND length({key}) <= 5 THEN ({key}) || '_' || {t}[3] ELSE {key} END"


@query(f"""
WITH {PO}, cleaned AS (SELECT *, {sql_clean("supplier_name_raw")} AS supplier_name FROM po),
names AS (SELECT supplier_name, count(*) AS n_lines, count(DISTINCT supplier_name_raw) AS n_forms, sum(amount) AS total, min(line_id) AS first_line FROM cleaned GROUP BY supplier_name)
SELECT printf('G%05d', 10000 + row_number() OVER (ORDER BY first_line, supplier_name)) AS global_supplier_id, supplier_name, n_lines, n_forms, CAST(total AS DOUBLE) AS total_spend
FROM names ORDER BY supplier_name
""")
def supplier_master(spark: SparkSession, d: str) -> DataFrame:
    forms = po_lines(spark, d).groupBy("supplier_name_raw").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"), F.min("line_id").alias("first"))
    names = suppliers.cleaned_forms(forms, "supplier_name_raw", "n", "supplier_name").groupBy("supplier_name").agg(F.sum("n").alias("n_lines"), F.count(F.lit(1)).alias("n_forms"), F.sum("amount").alias("total"), F.min("first").alias("first_line"))
    numbered = row_numbers(names, [F.col("first_line"), F.col("supplier_name")], "n")
    return numbered.select(format_id(F.col("n") + 10_000).alias("global_supplier_id"), "supplier_name", "n_lines", "n_forms", F.col("total").cast("double").alias("total_spend")).orderBy("supplier_name")


@query(f"WITH {PO} SELECT line_id, {sql_clean('supplier_name_raw')} AS cleaned FROM po")
def clean_name_norm(spark, d):
    return suppliers.by_distinct(po_lines(spark, d).select("line_id", "supplier_name_raw"), "supplier_name_raw", T.clean_name, "cleaned").select("line_id", "cleaned")


@query(f"WITH {PO} SELECT line_id, {sql_clean_lenient('supplier_name_raw')} AS cleaned FROM po")
def clean_name_etl(spark, d):
    return suppliers.by_distinct(po_lines(spark, d).select("line_id", "supplier_name_raw"), "supplier_name_raw", T.clean_name_lenient, "cleaned").select("line_id", "cleaned")


@query(r"SELECT c_custkey, trim(regexp_replace(lower(c_name || '  ' || c_mktsegment), '\s+', ' ', 'g')) AS name_key FROM customer")
def name_key(spark, d):
    return table(spark, d, "customer").select("c_custkey", T.name_key(F.concat_ws("  ", "c_name", "c_mktsegment")).alias("name_key"))


_COMPARE = rf"""
tokens AS (SELECT *, list_filter(regexp_split_to_array(regexp_replace(regexp_replace(regexp_replace(trim(lower(supplier_name_raw)), '\([^)]*\)', '', 'g'), '[^a-z0-9_\s&]', ' ', 'g'), '\s+&\s+', ' and ', 'g'), '\s+'), lambda x: x <> '') AS t FROM po),
fewer AS (SELECT *, list_filter(t, lambda x: x NOT IN {sql_list(W.COMPARE_SUFFIXES)}) AS s FROM tokens),
compared AS (SELECT *, array_to_string(CASE WHEN len(list_filter(s, lambda x: x NOT IN {sql_list(W.LOCATION_WORDS)} AND (length(x) <> 1 OR x = '&'))) > 0
  THEN list_filter(s, lambda x: x NOT IN {sql_list(W.LOCATION_WORDS)} AND (length(x) <> 1 OR x = '&')) WHEN len(s) > 0 THEN s ELSE t END, ' ') AS comparison FROM fewer)"""


@query(f"WITH {PO}, {_COMPARE} SELECT line_id, comparison AS comparison_name FROM compared")
def comparison_name(spark, d):
    return suppliers.by_distinct(po_lines(spark, d).select("line_id", "supplier_name_raw"), "supplier_name_raw", T.comparison_name, "comparison_name").select("line_id", "comparison_name")


def _sql_bare(c: str) -> str:
    t = rf"regexp_replace({c}, '\s*\([^)]*\)\s*', ' ', 'g')"
    for p in W.OUTPUT_SUFFIX_PATTERNS:
        t = f"regexp_replace({t}, '{p}', ' ', 'gi')"
    return t


_CANONICAL = rf"""
own AS (SELECT supplier_name_raw, trim(supplier_name_raw) AS own FROM po GROUP BY ALL),
bared AS (SELECT *, {_sql_bare("own")} AS bare FROM own),
kept AS (SELECT *, list_filter(regexp_split_to_array(bare, '\s+'), lambda x: regexp_replace(lower(x), '[^a-z0-9_]', '', 'g') <> '' AND regexp_replace(lower(x), '[^a-z0-9_]', '', 'g') NOT IN {sql_list(W.LOCATION_WORDS)}) AS k FROM bared),
tries AS (SELECT *, trim(regexp_replace(regexp_replace(array_to_string(k, ' '), '[\s,-]+$', ''), '^[\s,-]+', '')) AS one, regexp_replace(trim(regexp_replace(bare, '\s+', ' ', 'g')), '[\s,-]+$', '') AS two FROM kept),
best AS (SELECT *, CASE WHEN length(one) >= 2 THEN one WHEN length(two) >= 2 THEN two ELSE own END AS b FROM tries),
canon AS (SELECT supplier_name_raw, CASE WHEN b = upper(b) OR b = lower(b) THEN array_to_string(list_transform(list_filter(regexp_split_to_array(b, '\s+'), lambda w: w <> ''),
  lambda w: CASE WHEN regexp_full_match(w, '[A-Z0-9&]{{1,4}}') OR contains(w, '&') THEN upper(w) ELSE upper(w[1]) || lower(w[2:]) END), ' ') ELSE b END AS canonical_name FROM best)"""


@query(f"WITH {PO}, {_CANONICAL} SELECT * FROM canon")
def canonical_name(spark, d):
    return po_lines(spark, d).select("supplier_name_raw").distinct().select("supplier_name_raw", T.canonical_name(F.col("supplier_name_raw")).alias("canonical_name"))


_SCORE = (
    "100.0::DOUBLE"
    + "".join(f" - CASE WHEN regexp_matches(lower(n), '{p}') THEN 30 ELSE 0 END" for p in W.REGIONAL_PATTERNS)
    + r" - CASE WHEN length(n) > 40 THEN 15 WHEN length(n) > 30 THEN 10 WHEN length(n) > 25 THEN 5 ELSE 0 END + CASE WHEN n <> upper(n) AND n <> lower(n) THEN 10 ELSE 0 END"
    + r" + CASE WHEN regexp_matches(n, '\b(?:Inc|Corp|Corporation)\b', 'i') THEN 5 ELSE 0 END - CASE WHEN regexp_matches(lower(n), '\bpvt\s*ltd\b') OR regexp_matches(lower(n), '\bprivate\s*limited\b') THEN 25 ELSE 0 END - length(n) * 0.5::DOUBLE"
)


@query(f"""
WITH {PO}, {_CANONICAL}, members AS (SELECT DISTINCT {sql_clean("supplier_name_raw")} AS cleaned, supplier_name_raw AS n FROM po),
scored AS (SELECT cleaned, n, {_SCORE} AS score, count(*) OVER (PARTITION BY cleaned) AS size FROM members),
picked AS (SELECT *, row_number() OVER (PARTITION BY cleaned ORDER BY score DESC, n) AS r FROM scored)
SELECT cleaned, CASE WHEN size > 1 AND length(canonical_name) >= 2 THEN canonical_name ELSE n END AS canonical_name FROM picked JOIN canon ON n = supplier_name_raw WHERE r = 1
""")
def pick_canonical(spark, d):
    members = po_lines(spark, d).select(F.col("supplier_name_raw").alias("name")).distinct().select(T.clean_name(F.col("name")).alias("cleaned"), "name")
    return clusters.canonical_names(members, ["cleaned"])


@query(f"SELECT p_partkey, {sql_key('lower(p_name)')} AS block_key FROM part")
def block_keys(spark, d):
    return table(spark, d, "part").select("p_partkey", T.block_key(F.lower("p_name")).alias("block_key"))


@query(f"SELECT {sql_key('lower(p_name)')} AS block_key, count(*) AS n_names FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def block_sizes_topk(spark, d):
    return block_keys(spark, d).groupBy("block_key").agg(F.count(F.lit(1)).alias("n_names")).orderBy(F.desc("n_names"), "block_key").limit(5)


def sql_entity(c: str) -> str:
    t = rf"string_split(trim(regexp_replace(regexp_replace(lower(trim({c})), '[^a-z0-9_\s&]', ' ', 'g'), '\s+', ' ', 'g')), ' ')"
    has = lambda words: f"list_has_any({t}, [{', '.join(repr(w) for w in words)}])"
    first = sql_list(W.FIRST_NAMES)
    return rf"""CASE WHEN coalesce({c}, '') = '' THEN 'unknown/low/empty' WHEN {has(W.STRONG_SUFFIXES)} THEN 'organization/high/legal_suffix'
  WHEN {t}[1] IN {sql_list(W.PERSON_TITLES)} THEN 'individual/high/title_prefix' WHEN {t}[-1] IN {sql_list(W.PERSON_TITLE_SUFFIXES)} THEN 'individual/high/title_suffix'
  WHEN {has(W.CORPORATE_WORDS)} THEN 'organization/high/corp_keyword' WHEN regexp_matches({c}, '[&+]') AND len({t}) >= 3 THEN 'organization/medium/ampersand'
  WHEN regexp_matches({c}, '\d') THEN 'organization/medium/has_numbers'
  WHEN regexp_matches(regexp_replace(trim({c}), '[^A-Za-z0-9_\s,]', '', 'g'), '^[A-Za-z]+\s*,\s*[A-Za-z]+') AND string_split(trim(lower(string_split({c}, ',')[2])), ' ')[1] IN {first} THEN 'individual/high/last_comma_first'
  WHEN len({t}) BETWEEN 2 AND 3 AND {t}[1] IN {first} AND {t}[-1] NOT IN {sql_list(W.CORPORATE_WORDS + W.CLEAN_SUFFIXES)} THEN 'individual/medium/firstname_match'
  WHEN len({t}) = 1 THEN 'organization/low/single_word' WHEN len({t}) >= 4 THEN 'organization/low/long_name' ELSE 'unknown/low/no_signal' END"""


_PEOPLE = """
people AS (SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN c_name WHEN 1 THEN 'Dr ' || c_mktsegment WHEN 2 THEN 'Smith, John' WHEN 3 THEN 'Maria ' || c_mktsegment WHEN 4 THEN c_mktsegment || ' Bank'
  WHEN 5 THEN 'A & B ' || c_mktsegment WHEN 6 THEN lower(c_mktsegment) WHEN 7 THEN 'One Two Three ' || c_mktsegment ELSE 'Zed ' || c_mktsegment END AS name FROM customer)"""


def people(spark: SparkSession, d: str) -> DataFrame:
    form, segment = F.col("c_custkey") % 9, F.col("c_mktsegment")
    made = {0: F.col("c_name"), 1: F.concat(F.lit("Dr "), segment), 2: F.lit("Smith, John"), 3: F.concat(F.lit("Maria "), segment), 4: F.concat(segment, F.lit(" Bank")), 5: F.concat(F.lit("A & B "), segment), 6: F.lower(segment), 7: F.concat(F.lit("One Two Three "), segment)}
    name = F.concat(F.lit("Zed "), segment)
    for k, v in made.items():
        name = F.when(form == k, v).otherwise(name)
    return table(spark, d, "customer").select("c_custkey", name.alias("name"))


@query(f"WITH {_PEOPLE} SELECT c_custkey, name, {sql_entity('name')} AS entity FROM people")
def entity_class(spark, d):
    e = classify_entity(F.col("name"))
    return people(spark, d).select("c_custkey", "name", F.concat_ws("/", e["type"], e["confidence"], e["reason"]).alias("entity"))


@query(f"WITH {PO}, {_PEOPLE}, names AS (SELECT name FROM people UNION ALL SELECT supplier_name_raw FROM po) SELECT {sql_entity('name')} AS entity, count(*) AS n FROM names GROUP BY 1")
def entity_counts(spark, d):
    names = people(spark, d).select("name").unionByName(po_lines(spark, d).select(F.col("supplier_name_raw").alias("name")))
    named = names.groupBy("name").agg(F.count(F.lit(1)).alias("n")).withColumn("e", classify_entity(F.col("name")))
    return named.groupBy(F.concat_ws("/", "e.type", "e.confidence", "e.reason").alias("entity")).agg(F.sum("n").alias("n"))


@query(f"""
WITH {PO} SELECT {sql_clean("supplier_name_raw")} AS supplier_name_normalized, string_agg(DISTINCT supplier_name_raw, '|' ORDER BY supplier_name_raw) AS raw_names, string_agg(DISTINCT supplier_id, '|' ORDER BY supplier_id) AS supplier_ids,
string_agg(DISTINCT currency, '|' ORDER BY currency) AS currencies, count(*) AS n_rows, CAST(sum(amount) AS DOUBLE) AS total_amount FROM po GROUP BY 1
""")
def supplier_aggregate(spark, d):
    joined = lambda c: F.array_join(c, "|").alias(c)
    return suppliers.aggregate_suppliers(po_lines(spark, d), clean=T.clean_name).select("supplier_name_normalized", joined("raw_names"), joined("supplier_ids"), joined("currencies"), "n_rows", F.col("total_amount").cast("double").alias("total_amount"))


_FORMS = f"forms AS (SELECT {sql_clean('supplier_name_raw')} AS cleaned, supplier_name_raw AS raw, count(*) AS n, min(line_id) AS first FROM po GROUP BY 1, 2)"


@query(f"WITH {PO}, {_FORMS} SELECT cleaned, arg_max(raw, n * 10000000000 - first) AS best_original, count(*) AS n_forms, CAST(sum(n) AS BIGINT) AS n_rows, min(first) AS first_index FROM forms GROUP BY cleaned")
def best_original(spark, d):
    return suppliers.name_histogram(po_lines(spark, d), "supplier_name_raw", "line_id")


@query(f"""
WITH {PO}, {_FORMS} SELECT cleaned AS normalized, bool_or({sql_entity("raw")} LIKE 'individual%') AS individual, count(*) AS n_variants, string_agg(raw, ' | ' ORDER BY raw) AS variants, CAST(sum(n) AS BIGINT) AS n_rows
FROM forms GROUP BY cleaned HAVING count(*) > 1
""")
def cluster_summary(spark, d):
    forms = po_lines(spark, d).groupBy(F.col("supplier_name_raw").alias("original")).agg(F.count(F.lit(1)).alias("count")).withColumn("normalized", T.clean_name(F.col("original")))
    return suppliers.cluster_summary(forms.withColumn("individual", classify_entity(F.col("original"))["type"] == "individual"))


_IDS = f"""
names AS (SELECT {sql_clean('supplier_name_raw')} AS name, min(line_id) AS first_line FROM po GROUP BY 1),
master AS (SELECT 'G' || CAST(20000 + s_suppkey AS VARCHAR) AS gid, lower(s_name) AS mname FROM supplier WHERE s_suppkey % 3 = 0),
known AS (SELECT mname, max(gid) AS gid FROM master GROUP BY 1),
probed AS (SELECT name, first_line, gid FROM names LEFT JOIN known ON lower(trim(name)) = mname),
matched AS (SELECT name, first_line, coalesce(gid, 'G' || CAST((SELECT max(CAST(substr(gid, 2) AS BIGINT)) FROM master) + row_number() OVER (PARTITION BY gid IS NULL ORDER BY first_line, name) AS VARCHAR)) AS gid, gid IS NULL AS is_new FROM probed)"""


def _names(spark: SparkSession, d: str) -> DataFrame:
    forms = po_lines(spark, d).groupBy("supplier_name_raw").agg(F.count(F.lit(1)).alias("n"), F.min("line_id").alias("first_line"))
    return suppliers.cleaned_forms(forms, "supplier_name_raw", "n", "name").groupBy("name").agg(F.min("first_line").alias("first_line"))


def _seed_master(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").filter("s_suppkey % 3 = 0").select(F.concat(F.lit("G"), (F.col("s_suppkey") + 20_000).cast("string")).alias("global_supplier_id"), F.lower("s_name").alias("normalized_supplier_name"))


@query(f"WITH {PO}, {_IDS} SELECT name, printf('G%05d', row_number() OVER (ORDER BY first_line, name)) AS global_supplier_id FROM names")
def assign_ids(spark, d):
    return row_numbers(_names(spark, d), [F.col("first_line"), F.col("name")], "n").select("name", format_id(F.col("n")).alias("global_supplier_id"))


@query(f"WITH {PO}, {_IDS} SELECT name, gid AS global_supplier_id, is_new FROM matched")
def match_or_assign(spark, d):
    return suppliers.match_or_assign(_names(spark, d), _seed_master(spark, d), "name", [F.col("first_line"), F.col("name")]).select("name", "global_supplier_id", "is_new")


_ODD_ID = "CASE CAST(supplier_id AS BIGINT) % 5 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN repeat('x', 120) || supplier_id ELSE supplier_id END"


@query(f"""
WITH {PO}, {_IDS}, given AS (SELECT {_ODD_ID} AS sid, {sql_clean("supplier_name_raw")} AS name, line_id FROM po),
seen AS (SELECT name, min(line_id) AS first, count(sid) AS n_ids FROM given GROUP BY name),
pairs AS (SELECT DISTINCT coalesce(nullif(trim(sid), ''), substr(name, 1, 100)) AS supplier_id, name FROM given WHERE sid IS NOT NULL UNION SELECT substr(name, 1, 100), name FROM seen WHERE n_ids = 0),
linked AS (SELECT supplier_id, gid, row_number() OVER (PARTITION BY supplier_id ORDER BY s.first DESC, s.name DESC) AS r FROM pairs JOIN seen s USING (name) JOIN matched USING (name))
SELECT 'acme' AS client_id, supplier_id, gid AS global_supplier_id, 'exact_name_key' AS match_method, 1.0::DOUBLE AS match_confidence, 'name_key' AS matched_on FROM linked WHERE r = 1
""")
def crosswalk(spark, d):
    """Over ids of which a fifth each are null, blank, and longer than 100 characters."""
    forms = po_lines(spark, d).groupBy("supplier_id", "supplier_name_raw").agg(F.count(F.lit(1)).alias("n"), F.min("line_id").alias("first_line"))
    rows = suppliers.cleaned_forms(forms, "supplier_name_raw", "n", "name").select(F.expr(_ODD_ID).alias("supplier_id"), "name", "first_line")
    ids = suppliers.match_or_assign(_names(spark, d), _seed_master(spark, d), "name", [F.col("first_line"), F.col("name")])
    return suppliers.crosswalk(rows, ids, F.lit("acme"), "name", "first_line")


_OLD = "old AS (SELECT s_suppkey AS k, s_name AS name, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'o' || s_nationkey END AS note, 'd0' AS added FROM supplier WHERE s_suppkey % 3 <> 0)"
_NEW = "fresh AS (SELECT s_suppkey AS k, upper(s_name) AS name, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 'n' || s_nationkey END AS note, 'd1' AS added FROM supplier WHERE s_suppkey % 2 = 0)"


def _old_new(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    s, k, nation = table(spark, d, "supplier"), F.col("s_suppkey"), F.col("s_nationkey").cast("string")
    make = lambda name, off, mark, added: [k.alias("k"), name.alias("name"), F.when(k % off != 0, F.concat(F.lit(mark), nation)).alias("note"), F.lit(added).alias("added")]
    return s.filter(k % 3 != 0).select(*make(F.col("s_name"), 4, "o", "d0")), s.filter(k % 2 == 0).select(*make(F.upper("s_name"), 5, "n", "d1"))


@query(f"WITH {_OLD}, {_NEW} SELECT k, CASE WHEN f.k IS NOT NULL THEN f.name ELSE o.name END AS name, CASE WHEN o.k IS NULL THEN f.note ELSE o.note END AS note, coalesce(o.added, f.added) AS added FROM old o FULL JOIN fresh f USING (k)")
def upsert_overwrite(spark, d):
    return tables.upsert(*_old_new(spark, d), ["k"], ["name"])


@query(f"WITH {_OLD}, {_NEW} SELECT k, coalesce(f.name, o.name) AS name, coalesce(f.note, o.note) AS note, coalesce(f.added, o.added) AS added FROM old o FULL JOIN fresh f USING (k)")
def upsert_coalesce_new(spark, d):
    return tables.upsert_coalesce(*_old_new(spark, d), ["k"])


@query(f"WITH {_OLD}, {_NEW} SELECT k, coalesce(o.name, f.name) AS name, coalesce(o.note, f.note) AS note, coalesce(o.added, f.added) AS added FROM old o FULL JOIN fresh f USING (k)")
def upsert_coalesce_old(spark, d):
    return tables.upsert_coalesce(*_old_new(spark, d), ["k"], new_first=False)


@query(f"WITH {_OLD}, {_NEW} SELECT * FROM old UNION ALL SELECT * FROM fresh WHERE k NOT IN (SELECT k FROM old)")
def insert_if_absent(spark, d):
    return tables.insert_absent(*_old_new(spark, d), ["k"])


@query(f"WITH {_OLD}, {_NEW} SELECT * FROM old WHERE note IS NULL OR note NOT LIKE 'o1%' UNION ALL SELECT * FROM fresh")
def delete_insert(spark, d):
    return tables.replace_where(*_old_new(spark, d), F.col("note").like("o1%"))


@query("SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY o_custkey")
def first_wins(spark, d):
    return tables.keep_one(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], F.col("o_orderkey"))


@query("SELECT o_custkey, arg_max(o_orderkey, o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY o_custkey")
def last_wins(spark, d):
    return tables.keep_one(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], F.col("o_orderkey"), last=True)


_COUNTRY_ROWS = ", ".join(f"({i}, '{c}', '{n}')" for i, (c, n) in enumerate(W.COUNTRIES.items()))


@query(f"""
WITH places AS (SELECT * FROM (VALUES {_COUNTRY_ROWS}) AS t(ord, code, name)),
asked AS (SELECT s_suppkey, upper(trim(CASE s_suppkey % 4 WHEN 0 THEN 'us' WHEN 1 THEN ' ' ELSE n_name END)) AS v FROM supplier JOIN nation ON s_nationkey = n_nationkey),
by_name AS (SELECT upper(name) AS name, arg_max(code, ord) AS code FROM places GROUP BY 1),
near AS (SELECT v, arg_min(name, ord) AS name, arg_min(code, ord) AS code FROM (SELECT DISTINCT v FROM asked WHERE v <> '') JOIN places ON contains(upper(name), v) OR contains(v, upper(name)) GROUP BY v)
SELECT s_suppkey, CASE WHEN a.v = '' THEN 'Unknown' WHEN c.code IS NOT NULL THEN c.name WHEN b.code IS NOT NULL THEN (SELECT p.name FROM places p WHERE p.code = b.code) WHEN n.code IS NOT NULL THEN n.name
  ELSE array_to_string(list_transform(string_split(a.v, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') END AS country,
  CASE WHEN a.v = '' THEN 'XX' ELSE coalesce(c.code, b.code, n.code, 'XX') END AS code
FROM asked a LEFT JOIN places c ON a.v = c.code LEFT JOIN by_name b ON a.v = b.name LEFT JOIN near n ON a.v = n.v
""")
def country_lookup(spark, d):
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    value = F.when(F.col("s_suppkey") % 4 == 0, "us").when(F.col("s_suppkey") % 4 == 1, " ").otherwise(F.col("n_name"))
    place = normalize_country(value)
    return s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", place["name"].alias("country"), place["code"].alias("code"))


@query(f"WITH {PO}, {_IDS} SELECT name, lower(name) IN (SELECT mname FROM master) AS is_existing FROM names")
def new_vs_existing(spark, d):
    return tables.flag_existing(_names(spark, d), _seed_master(spark, d), F.lower("name"), F.lower("normalized_supplier_name")).select("name", "is_existing")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def skip_existing(spark, d):
    return tables.absent(table(spark, d, "customer").select("c_custkey", "c_name"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


def sql_good(c: str) -> str:
    return rf"length(trim(coalesce({c}, ''))) >= 5 AND NOT regexp_full_match(regexp_replace(trim(coalesce({c}, '')), '[\s.\-/\\,()]+', '', 'g'), '\d+')"


@query(f"WITH {PO} SELECT line_id, item_description, {sql_good('item_description')} AS good FROM po")
def po_quality(spark, d):
    return po_lines(spark, d).select("line_id", "item_description", T.good_description(F.col("item_description")).alias("good"))


@query(f"""
WITH {PO} SELECT supplier_id, count(item_description) AS n_lines, count(*) FILTER ({sql_good("item_description")}) AS n_good, (count(*) FILTER ({sql_good("item_description")}))::DOUBLE / count(item_description) AS pass_rate,
CASE WHEN (count(*) FILTER ({sql_good("item_description")}))::DOUBLE / count(item_description) < 0.8 THEN 'description' ELSE 'po_line' END AS flow FROM po GROUP BY supplier_id
""")
def pass_rate_flow(spark, d):
    return suppliers.quality_by_supplier(po_lines(spark, d), "supplier_id", "item_description", 0.8)


_TOKENS = lambda c: f"list_distinct(regexp_split_to_array(lower({c}), '[^a-z0-9_]+'))"


@query(f"""
WITH cats AS (SELECT DISTINCT p_brand AS l1, split_part(p_type, ' ', 1) AS l2, p_type || ' ' || split_part(p_name, ' ', 1) AS l3 FROM part),
descs AS (SELECT DISTINCT p_name AS description FROM part),
pairs AS (SELECT description, l1, l2, l3, list_filter({_TOKENS("description")}, lambda x: length(x) > 2) AS d, {_TOKENS("concat_ws(' ', l1, l2, l3)")} AS c FROM descs, cats),
scored AS (SELECT description, l1, l2, l3, CAST(len(list_filter(d, lambda x: list_contains(c, x))) + 0.5 * coalesce(list_sum(list_transform(d, lambda x: len(list_filter(c, lambda y: length(y) > 2 AND (contains(y, x) OR contains(x, y)))))), 0) AS DOUBLE) AS score FROM pairs),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY description ORDER BY score DESC, l1, l2, l3) AS INT) AS rank FROM scored)
SELECT * FROM ranked WHERE rank <= 25
""")
def taxonomy_topk(spark, d):
    part = table(spark, d, "part")
    head = lambda c: F.substring_index(c, " ", 1)
    cats = part.select(F.col("p_brand").alias("l1"), head("p_type").alias("l2"), F.concat_ws(" ", "p_type", head("p_name")).alias("l3"))
    return taxonomy.top_categories(part, "p_name", cats)


_LINES = f"WITH {PO}, lines AS (SELECT line_id, supplier_id, p_brand AS l1, split_part(p_type, ' ', 1) AS l2, p_type AS l3, item_description, CAST(line_id % 100 AS DOUBLE) / 128 AS confidence, CAST(line_id % 64 AS DOUBLE) / 64 AS l3_probability, CASE WHEN line_id % 7 = 0 THEN ' ' ELSE 'r' || (line_id % 9) END AS reasoning FROM po)"


def _lines(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("line_id")
    return po_lines(spark, d).select(
        n, "supplier_id", F.col("p_brand").alias("l1"), F.substring_index("p_type", " ", 1).alias("l2"), F.col("p_type").alias("l3"), "item_description",
        ((n % 100).cast("double") / 128).alias("confidence"), ((n % 64).cast("double") / 64).alias("l3_probability"), F.when(n % 7 == 0, " ").otherwise(F.concat(F.lit("r"), (n % 9).cast("string"))).alias("reasoning"),
    )


@query(f"""
{_LINES} SELECT supplier_id, l1, l2, l3, count(*) AS n_lines, round(avg(confidence), 9) AS avg_confidence, round(avg(l3_probability), 9) AS avg_l3_probability,
coalesce(array_to_string(list_sort(list_distinct(list(reasoning) FILTER (trim(reasoning) <> '')))[1:5], ' | '), '') AS reasoning FROM lines GROUP BY supplier_id, l1, l2, l3
""")
def category_groups(spark, d):
    g = taxonomy.category_groups(_lines(spark, d), "supplier_id")
    return g.withColumn("avg_confidence", F.round("avg_confidence", 9)).withColumn("avg_l3_probability", F.round("avg_l3_probability", 9))


@query(f"{_LINES}, parts AS (SELECT *, CASE WHEN confidence >= 0.6::DOUBLE THEN 'high' ELSE 'low' END AS part FROM lines) SELECT supplier_id, part, count(*) AS n_lines, max(confidence) AS most FROM parts GROUP BY 1, 2")
def consolidation_split(spark, d):
    return taxonomy.consolidation_split(_lines(spark, d)).groupBy("supplier_id", "part").agg(F.count(F.lit(1)).alias("n_lines"), F.max("confidence").alias("most"))


@query(f"""
{_LINES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY supplier_id, l1, l2, l3 ORDER BY line_id, item_description) AS r FROM lines)
SELECT supplier_id, l1, l2, l3, round(avg(confidence), 9) AS avg_confidence, string_agg(item_description, '|' ORDER BY r) FILTER (r <= 5) AS samples FROM ranked GROUP BY 1, 2, 3, 4
""")
def category_samples(spark, d):
    s = taxonomy.category_samples(_lines(spark, d), "supplier_id", "item_description", "line_id")
    return s.select("supplier_id", "l1", "l2", "l3", F.round("avg_confidence", 9).alias("avg_confidence"), F.array_join("samples", "|").alias("samples"))


@query(f"""
WITH {PO} SELECT currency, supplier_id, CAST(sum(amount) AS DOUBLE) AS total_spend, CAST(sum(quantity) AS DOUBLE) AS total_quantity, CAST(min(spend_date) AS VARCHAR) AS window_start_date, CAST(max(spend_date) AS VARCHAR) AS window_end_date, count(*) AS n_lines
FROM po GROUP BY currency, supplier_id
""")
def client_totals(spark, d):
    t = suppliers.client_totals(po_lines(spark, d), ["currency", "supplier_id"], "amount", "quantity", "spend_date")
    return t.select("currency", "supplier_id", *(F.col(c).cast("double").alias(c) for c in ("total_spend", "total_quantity")), *(F.col(c).cast("string").alias(c) for c in ("window_start_date", "window_end_date")), "n_lines")


@query(f"""
WITH {PO}, monthly AS (SELECT supplier_id, year(spend_date) AS y, month(spend_date) AS m, sum(amount) AS month_spend FROM po GROUP BY 1, 2, 3)
SELECT supplier_id, CAST(y AS INT) AS spend_year, CAST(m AS INT) AS spend_month, CAST(month_spend AS DOUBLE) AS month_spend, CAST(sum(month_spend) OVER (PARTITION BY supplier_id ORDER BY y * 12 + m RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS DOUBLE) AS rolling_spend FROM monthly
""")
def rolling_12m(spark, d):
    r = suppliers.rolling_spend(po_lines(spark, d), ["supplier_id"], "amount", "spend_date")
    return r.withColumn("month_spend", F.col("month_spend").cast("double")).withColumn("rolling_spend", F.col("rolling_spend").cast("double"))


@query(r"""
WITH names AS (SELECT DISTINCT p_name AS n, list_distinct(string_split(p_name, ' ')) AS t FROM part)
SELECT a.n AS name_a, b.n AS name_b, len(list_intersect(a.t, b.t))::DOUBLE / len(list_distinct(list_concat(a.t, b.t))) AS jaccard FROM names a JOIN names b ON a.n < b.n WHERE len(list_intersect(a.t, b.t)) > 0
""")
def jaccard_pairs(spark, d):
    names = table(spark, d, "part").select(F.col("p_name").alias("n")).distinct().withColumn("t", F.array_distinct(F.split("n", " ")))
    side = lambda s: names.select(F.col("n").alias(f"name_{s}"), F.col("t").alias(f"t_{s}"), F.explode("t").alias("token"))
    pairs = side("a").join(side("b"), "token").filter("name_a < name_b").dropDuplicates(["name_a", "name_b"])
    return pairs.select("name_a", "name_b", clusters.token_jaccard(F.col("t_a"), F.col("t_b")).alias("jaccard"))


@query()
def similarity_pairs(spark, d):
    names = table(spark, d, "part").select("p_name").distinct()
    return clusters.pair_scores(names, "p_name", F.substring_index("p_name", " ", 1)).withColumn("ratio", sequence_ratio("name_a", "name_b"))


@query()
def leader_clusters(spark, d):
    return clusters.leader_clusters(table(spark, d, "part"), "p_name")


@query()
def cluster_status(spark, d):
    return clusters.confirm(clusters.leader_clusters(table(spark, d, "part"), "p_name"))


@query()
def normalizer(spark, d):
    from masterline.plans.pipelines import normalize_names

    return normalize_names(po_lines(spark, d), "supplier_name_raw", "line_id")


@query("""
WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 0)
SELECT vec_id, round(1 - list_cosine_similarity(embedding::DOUBLE[], (SELECT e FROM q)::DOUBLE[]), 6) AS distance FROM embeddings ORDER BY 1 - list_cosine_similarity(embedding::DOUBLE[], (SELECT e FROM q)::DOUBLE[]), vec_id LIMIT 10
""")
def vector_topk(spark, d):
    e = table(spark, d, "embeddings")
    return vectors.top_k(e, e.filter("vec_id = 0").first()["embedding"], 10, "vec_id").select("vec_id", F.round("distance", 6).alias("distance"))


@query("""
WITH units AS (SELECT label, vec_id, list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS u FROM embeddings)
SELECT a.label, count(*) AS n_pairs, round(avg(list_dot_product(a.u, b.u)), 6) AS mean_similarity FROM units a JOIN units b ON a.label = b.label AND a.vec_id < b.vec_id GROUP BY a.label
""")
def vector_pairs_within_label(spark, d):
    """Mean cosine of all pairs of a label without making any: the squared length of the sum of unit vectors is n plus twice their sum."""
    e = table(spark, d, "embeddings").withColumn("_norm", F.sqrt(vectors.dot(F.col("embedding"), F.col("embedding")))).filter("_norm > 0")
    parts = e.select("label", "_norm", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.sum(F.col("x") / F.col("_norm")).alias("s"), F.count(F.lit(1)).alias("n"))
    sums = parts.groupBy("label").agg(F.sum(F.col("s") * F.col("s")).alias("square"), F.max("n").alias("n")).filter("n > 1")
    return sums.select("label", F.expr("n * (n - 1) div 2").alias("n_pairs"), F.round((F.col("square") - F.col("n")) / (F.col("n") * (F.col("n") - 1)), 6).alias("mean_similarity"))


@query("SELECT s_suppkey, substr(concat_ws(' ', nullif(trim(s_name), ''), nullif(trim(CASE WHEN s_suppkey % 3 = 0 THEN ' ' ELSE n_name END), ''), nullif(trim(r_name), '')), 1, 8000) AS source_text FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def source_text(spark, d):
    s, n, r = (table(spark, d, t) for t in ("supplier", "nation", "region"))
    joined = s.join(n, s.s_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
    text = T.source_text(F.col("s_name"), F.when(F.col("s_suppkey") % 3 == 0, " ").otherwise(F.col("n_name")), F.col("r_name"))
    return joined.select("s_suppkey", F.substring(text, 1, vectors.EMBED_CHARS).alias("source_text"))


@query("""
WITH given AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'Urgent, bulk' ELSE o_orderpriority || ', ' || o_orderstatus END AS old, [lower(o_orderpriority), ' Urgent ', ''] AS new FROM orders),
parts AS (SELECT o_orderkey, list_filter(list_transform(string_split(coalesce(old, ''), ','), lambda x: trim(x)), lambda x: x <> '') AS o, list_filter(list_transform(new, lambda x: trim(x)), lambda x: x <> '') AS n FROM given)
SELECT o_orderkey, array_to_string(list_concat(o, list_filter(n, lambda x: NOT list_contains(list_transform(o, lambda y: lower(y)), lower(x)))), ', ') AS tags FROM parts
""")
def merge_tags(spark, d):
    k = F.col("o_orderkey") % 3
    old = F.when(k == 1, "Urgent, bulk").when(k == 2, F.concat_ws(", ", "o_orderpriority", "o_orderstatus"))
    return table(spark, d, "orders").select("o_orderkey", T.merge_tags(old, F.array(F.lower("o_orderpriority"), F.lit(" Urgent "), F.lit(""))).alias("tags"))


@query("""
WITH given AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'Unknown' ELSE 'US, ' || o_orderstatus END AS old, CASE WHEN o_orderkey % 2 = 0 THEN ['Unknown', ''] ELSE ['FR', o_orderstatus] END AS new FROM orders),
parts AS (SELECT o_orderkey, list_sort(list_distinct(list_filter(list_transform(list_concat(string_split(coalesce(old, ''), ','), new), lambda x: trim(x)), lambda x: x <> '' AND x <> 'Unknown'))) AS p FROM given)
SELECT o_orderkey, CASE WHEN len(p) > 0 THEN array_to_string(p, ', ') ELSE 'Unknown' END AS locations FROM parts
""")
def merge_locations(spark, d):
    k = F.col("o_orderkey")
    old = F.when(k % 3 == 1, "Unknown").when(k % 3 == 2, F.concat(F.lit("US, "), "o_orderstatus"))
    new = F.when(k % 2 == 0, F.array(F.lit("Unknown"), F.lit(""))).otherwise(F.array(F.lit("FR"), F.col("o_orderstatus")))
    return table(spark, d, "orders").select("o_orderkey", T.merge_locations(old, new).alias("locations"))


@query("""
WITH t AS (SELECT p_partkey, list_distinct(string_split(lower(p_name), ' ')) AS a, list_distinct(string_split(lower(p_type), ' ')) AS b FROM part)
SELECT p_partkey, len(list_intersect(a, b)) AS n_common, len(list_distinct(list_concat(a, b))) AS n_all, array_to_string(list_sort(list_filter(a, lambda x: NOT list_contains(b, x))), ' ') AS only_name, len(list_filter(a, lambda x: NOT list_contains(b, x))) = 0 AS is_subset,
list_sort(list_transform(a, lambda x: lpad(length(x)::VARCHAR, 4, '0') || x))[-1][5:] AS longest FROM t
""")
def token_set_ops(spark, d):
    t = table(spark, d, "part").select("p_partkey", F.array_distinct(F.split(F.lower("p_name"), " ")).alias("a"), F.array_distinct(F.split(F.lower("p_type"), " ")).alias("b"))
    only = F.array_except("a", "b")
    longest = F.array_max(F.transform("a", lambda x: F.struct(F.length(x).alias("n"), x.alias("w"))))["w"]
    return t.select("p_partkey", F.size(F.array_intersect("a", "b")).cast("long").alias("n_common"), F.size(F.array_union("a", "b")).cast("long").alias("n_all"), F.array_join(F.array_sort(only), " ").alias("only_name"), (F.size(only) == 0).alias("is_subset"), longest.alias("longest"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_salvage(spark, d):
    """Damaged answers around the events' JSON: fenced, with talk around, or cut off."""
    n, p = F.col("event_id") % 4, F.col("props")
    broken = F.when(n == 0, F.concat(F.lit("```json\n"), p, F.lit("\n```"))).when(n == 1, F.concat(F.lit("Sure: "), p, F.lit(" done"))).when(n == 2, F.regexp_replace(p, r"\}$", ",")).otherwise(p)
    return table(spark, d, "events").select("event_id", F.get_json_object(repaired_json(broken), "$.k").cast("long").alias("k"))


@query("SELECT p_partkey, p_brand, CAST(floor((row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) / 50) AS INT) AS batch FROM part")
def batching(spark, d):
    return batches(table(spark, d, "part").select("p_partkey", "p_brand"), ["p_brand"], [F.col("p_partkey")], 50)


@query(f"WITH {_OLD}, {_NEW} SELECT k, name, note, added, '' AS extra, 'unchanged' AS part FROM old WHERE k NOT IN (SELECT k FROM fresh) UNION ALL SELECT k, name, note, added, '', 'updated' FROM fresh WHERE k IN (SELECT k FROM old) UNION ALL SELECT k, name, note, added, 'x', 'new' FROM fresh WHERE k NOT IN (SELECT k FROM old) ORDER BY name, k")
def union_assemble(spark, d):
    from pyspark.sql.types import StructType

    old, fresh = _old_new(spark, d)
    unchanged = tables.absent(old, fresh, ["k"]).withColumn("part", F.lit("unchanged"))
    updated = fresh.join(old.select("k"), "k", "left_semi").withColumn("part", F.lit("updated"))
    new = tables.absent(fresh, old, ["k"]).withColumn("part", F.lit("new")).withColumn("extra", F.lit("x"))
    schema = StructType.fromDDL("k long, name string, note string, added string, extra string, part string")
    whole = unchanged.unionByName(updated).unionByName(new, allowMissingColumns=True).withColumn("extra", F.coalesce("extra", F.lit("")))
    return conform(whole, schema).orderBy("name", "k")


@query("""
SELECT 'primary_key' AS "constraint", 'orders' AS target, (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS n
UNION ALL SELECT 'not_null', 'orders.o_orderdate', (SELECT count(*) FROM orders WHERE o_orderdate IS NULL)
UNION ALL SELECT 'foreign_key', 'orders.o_custkey', (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0))
""")
def constraint_violations(spark, d):
    t = {"orders": table(spark, d, "orders"), "customer": table(spark, d, "customer").filter("c_custkey % 7 <> 0")}
    return tables.violations(t, {"orders": ["o_custkey"]}, {"orders": ["o_orderdate"]}, [("orders", "o_custkey", "customer", "c_custkey")])


_MESSY = "messy AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN ' N/A ' WHEN 1 THEN 'None' WHEN 2 THEN p_name || 'NaN' WHEN 3 THEN '' WHEN 4 THEN '  ' || p_name || ' ' ELSE 'Unknown' END AS v FROM part)"


@query(rf"""
WITH {_MESSY} SELECT p_partkey, CASE WHEN lower(trim(v)) IN ('', 'nan', 'none', 'n/a') THEN NULL ELSE trim(v) END AS cleaned,
CASE WHEN trim(v) IN ('', 'Unknown', 'NaN', 'None') THEN NULL ELSE nullif(trim(regexp_replace(trim(v), 'NaN$', '')), '') END AS loaded FROM messy
""")
def null_markers(spark, d):
    k, name = F.col("p_partkey") % 6, F.col("p_name")
    v = F.when(k == 0, " N/A ").when(k == 1, "None").when(k == 2, F.concat(name, F.lit("NaN"))).when(k == 3, "").when(k == 4, F.concat(F.lit("  "), name, F.lit(" "))).otherwise("Unknown")
    return table(spark, d, "part").select("p_partkey", T.clean_value(v).alias("cleaned"), T.clean_loaded(v).alias("loaded"))


@query("""
SELECT l_orderkey, l_linenumber, CAST(CAST(round_even(l_discount * 100 * 1.25::DOUBLE, 0) AS INT) AS VARCHAR) || '%' AS percent, CAST(l_quantity * 100 AS BIGINT) AS parsed, CASE WHEN l_returnflag = 'R' THEN 'Yes' ELSE 'No' END AS returned FROM lineitem
""")
def formats(spark, d):
    grouped = F.format_number((F.col("l_quantity") * 100).cast("long"), 0)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", T.percent(F.col("l_discount") * 1.25).alias("percent"), T.parse_count(grouped).alias("parsed"), T.yes_no(F.col("l_returnflag") == "R").alias("returned"))


@query("SELECT CAST(date_trunc('day', ts) AS VARCHAR)[1:10] AS day, event_type, count(*) AS n_events FROM events GROUP BY 1, 2")
def stage_counts(spark, d):
    from masterline.streaming.ingest import stage_counts as counts

    return counts(table(spark, d, "events"), "ts", "event_type").select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n_events")


@query(f"WITH {PO}, {_IDS} SELECT count(*) AS rows_read, count(DISTINCT supplier_name_raw) AS raw_names, (SELECT count(*) FROM names) AS unique_suppliers, (SELECT count(*) FROM matched WHERE is_new) AS new_suppliers, (SELECT count(*) FROM matched WHERE NOT is_new) AS existing_suppliers FROM po")
def load_counts(spark, d):
    from masterline.plans.pipelines import load_counts as counts

    return counts(po_lines(spark, d), {"supplier_master": _seed_master(spark, d)}, clean=T.clean_name)


@query(f"WITH {PO}, s AS (SELECT DISTINCT item_description AS x FROM po) SELECT x AS item_description FROM s ORDER BY md5(x), x LIMIT 100")
def description_sample(spark, d):
    """The sampling operator: 100 descriptions in the order of a hash, so that a rerun draws alike."""
    return po_lines(spark, d).select("item_description").distinct().orderBy(F.md5("item_description"), "item_description").limit(100)


@query(f"WITH {PO} SELECT DISTINCT currency, country FROM po ORDER BY 1, 2")
def distinct_clients(spark, d):
    return po_lines(spark, d).select("currency", "country").distinct().orderBy("currency", "country")


@query("SELECT 'G' || s_suppkey AS global_supplier_id, s_name FROM supplier WHERE s_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 12) ORDER BY global_supplier_id LIMIT 20")
def embedding_resume(spark, d):
    """Suppliers still to be embedded, in id order, up to the limit of a run."""
    s = table(spark, d, "supplier")
    rows = s.select(F.concat(F.lit("G"), F.col("s_suppkey").cast("string")).alias("global_supplier_id"), "s_name")
    done = s.filter("s_nationkey < 12").select(F.concat(F.lit("G"), F.col("s_suppkey").cast("string")).alias("global_supplier_id"))
    return tables.absent(rows, done, ["global_supplier_id"]).orderBy("global_supplier_id").limit(20)


@query("SELECT doc_id, substr(text, 1, 20) AS cluster_part, substr(text, 1, 100) AS preview, length(substr(text, 1, 8000)) AS n_embedded FROM documents")
def truncations(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.substring(t, 1, 20).alias("cluster_part"), F.substring(t, 1, 100).alias("preview"), F.length(F.substring(t, 1, vectors.EMBED_CHARS)).cast("long").alias("n_embedded"))


@query("SELECT c_mktsegment, CAST(c_nationkey AS INT) AS c_nationkey, count(*) AS n, min(c_custkey) AS first_key FROM customer GROUP BY 1, 2 HAVING count(*) >= 2")
def group_size_split(spark, d):
    """Blocks of at least two members, found by a window over the block."""
    sized = table(spark, d, "customer").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("c_mktsegment", "c_nationkey")))
    return sized.filter("n >= 2").groupBy("c_mktsegment", "c_nationkey").agg(F.max("n").alias("n"), F.min("c_custkey").alias("first_key"))
