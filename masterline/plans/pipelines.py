"""Whole flows: transaction load, name normaliser, bulk load, staged upload, master refresh."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masterline.functions import text as T
from masterline.functions.countries import normalize_country
from masterline.functions.entity import classify_entity
from masterline.operators import clusters, models, suppliers, tables, taxonomy
from masterline.operators.columns import missing_columns, rename_by_map
from masterline.operators.ids import format_id, id_number, max_id, row_numbers
from masterline.plans.schemas import MASTER_FILE, TABLES
from masterline.sources.files import file_ordinals, read_bulk
from masterline.sources.scratch import kept


def _stamp(df: DataFrame, table: str) -> DataFrame:
    """df with the table's columns, null where it lacks one, and the present time as date_added."""
    kinds = [c.split(" ") for c in TABLES[table].replace("decimal(18,4)", "decimal(18#4)").split(", ")]
    now = {"date_added": F.current_timestamp()}
    return df.select(*((F.col(n) if n in df.columns else now.get(n, F.lit(None))).cast(k.replace("#", ",")).alias(n) for n, k in kinds))


def load_transactions(rows: DataFrame, client_id: str, client_name: str | None, state: Mapping[str, DataFrame], base: int = 10_000, enrich=None) -> dict[str, DataFrame]:
    """New states of supplier_master, supplier_attributes, client_master and supplier_crosswalk after a file.

    rows as from sources.files.read_transactions. Names that fold to one lower-case key share an id, and the
    one seen last names it; known names keep their id; running a file twice changes nothing. enrich, if
    given, maps the named suppliers to attribute columns; blanks never overwrite.
    """
    names = rows.groupBy("supplier_name_normalized").agg(F.min("row_index").alias("first_index"))
    ids = suppliers.match_or_assign(names, state["supplier_master"], "supplier_name_normalized", [F.col("first_index")], base)
    latest = tables.keep_one(ids.select("global_supplier_id", F.col("supplier_name_normalized").alias("normalized_supplier_name"), "first_index"), ["global_supplier_id"], F.struct("first_index", "normalized_supplier_name"), last=True).drop("first_index")
    master = tables.upsert(state["supplier_master"], _stamp(latest, "supplier_master"), ["global_supplier_id"], ["normalized_supplier_name"])
    facts = enrich(latest) if enrich else latest.select("global_supplier_id")
    blank = facts.select(*(F.nullif(F.col(c), F.lit("")).alias(c) if c != "global_supplier_id" else F.col(c) for c in facts.columns))
    attributes = tables.upsert_coalesce(state["supplier_attributes"], _stamp(blank, "supplier_attributes").drop("date_added"), ["global_supplier_id"])
    client = rows.sparkSession.createDataFrame([(client_id, client_name)], "client_id string, client_name string")
    clients = tables.upsert_coalesce(state["client_master"], client, ["client_id"]).withColumn("client_name", F.coalesce("client_name", F.lit("Unknown")))
    links = suppliers.crosswalk(rows, ids, F.lit(client_id), "supplier_name_normalized", "row_index")
    known = [c for c in links.columns if c not in ("client_id", "supplier_id")]
    crosswalk = tables.upsert(state["supplier_crosswalk"], _stamp(links, "supplier_crosswalk"), ["client_id", "supplier_id"], known)
    return {"supplier_master": master, "supplier_attributes": attributes, "client_master": clients, "supplier_crosswalk": crosswalk}


def load_counts(rows: DataFrame, state: Mapping[str, DataFrame], clean=None) -> DataFrame:
    """rows_read, raw_names, unique_suppliers, new_suppliers, existing_suppliers in one row, without writing: a dry run.

    clean: makes the normalized name of the raw one, once for each different raw name.
    """
    keys = ["supplier_name_raw", *([] if clean else ["supplier_name_normalized"])]
    forms = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    forms = suppliers.cleaned_forms(forms, "supplier_name_raw", "_n", "supplier_name_normalized", clean) if clean else forms
    known = tables.flag_existing(forms.select("supplier_name_normalized").distinct(), state["supplier_master"], F.lower(F.trim("supplier_name_normalized")), F.lower(F.trim("normalized_supplier_name")))
    counts = known.agg(F.count(F.lit(1)).alias("unique_suppliers"), F.count_if(~F.col("is_existing")).alias("new_suppliers"), F.count_if("is_existing").alias("existing_suppliers"))
    return forms.agg(F.sum("_n").alias("rows_read"), F.countDistinct("supplier_name_raw").alias("raw_names")).join(F.broadcast(counts))


def normalize_names(rows: DataFrame, name: str = "name", index: str = "row_index", resolver=clusters.similar_resolver, least_group: int = 2, size: int = 50) -> DataFrame:
    """One result per distinct cleaned name: original, normalized, individual, cluster, confidence, method, count."""
    entries = suppliers.name_histogram(rows, name, index)
    tagged = entries.withColumn("individual", classify_entity(F.col("best_original"))["type"] == "individual").withColumn("block", T.block_key(F.col("cleaned")))
    tagged = kept(tagged, "name-entries")
    sizes = tagged.groupBy("block").agg(F.count(F.lit(1)).alias("_n"))
    sized = tables.lookup(tagged.withColumn("_key", F.struct("block")), "_key", sizes.select(F.struct("block").alias("_key"), "_n")).drop("_key")
    alone = clusters.singletons(sized.filter(F.col("_n") < least_group))
    return alone.unionByName(clusters.resolve(sized.filter(F.col("_n") >= least_group).drop("_n"), resolver, size))


def normalization_stats(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("names"), F.sum("count").alias("rows"), F.count_if("individual").alias("individuals"), F.countDistinct("normalized").alias("canonical_names"),
        F.count_if(F.col("method") == "resolver-cluster").alias("clustered"), F.count_if(F.col("method") == "fallback").alias("errors"),
    )


def bulk_load(df: DataFrame, state: Mapping[str, DataFrame], base: int = 10_000) -> dict[str, DataFrame]:
    """States after a prepared master file: known names keep their id, new ones are numbered in file order."""
    clients, first = read_bulk(df)
    ids = suppliers.match_or_assign(first, state["supplier_master"], "normalized_supplier_name", [F.col("row_index")], base).drop("is_new", "row_index")
    one = tables.keep_one(ids, ["global_supplier_id"], F.col("normalized_supplier_name"))
    master = tables.upsert(state["supplier_master"], _stamp(one, "supplier_master"), ["global_supplier_id"], ["normalized_supplier_name"])
    facts = _stamp(one, "supplier_attributes").drop("date_added")
    named = clients.withColumn("client_name", F.lit("Unknown"))
    return {
        "client_master": tables.upsert_coalesce(state["client_master"], named, ["client_id"], new_first=False),
        "supplier_master": master,
        "supplier_attributes": tables.upsert_coalesce(state["supplier_attributes"], facts, ["global_supplier_id"]),
    }


def staged_upload(df: DataFrame, mapping: Mapping[str, str], required: list[str], state: Mapping[str, DataFrame], upload_id: str, prefix: str = "SUP-") -> dict[str, DataFrame]:
    """transactions, rejects, supplier_totals, crosswalk, suppliers of an upload: rename, validate, total, match.

    An upload replaces the rows it wrote before; canonical ids go on from those in state["suppliers"], in
    order of first appearance.
    """
    renamed = rename_by_map(file_ordinals(df, "_row"), mapping)
    rows = renamed.withColumn("upload_id", F.coalesce("upload_id", F.lit(upload_id)) if "upload_id" in renamed.columns else F.lit(upload_id)).withColumn("row_index", F.col("_row")).drop("_row")
    for c in ("amount", "quantity"):
        rows = rows.withColumn(c, T.parse_amount(F.col(c)) if c in renamed.columns else F.lit(None).cast("decimal(18,4)"))
    checked = rows.withColumn("missing", missing_columns([c for c in required if c in rows.columns])).withColumn("missing", F.concat("missing", F.array(*(F.lit(c) for c in required if c not in rows.columns)).cast("array<string>")))
    rejects = checked.filter(F.size("missing") > 0).select("row_index", F.concat(F.lit("missing required columns: "), F.array_join("missing", ", ")).alias("error_message"))
    good = checked.filter(F.size("missing") == 0).drop("missing")
    names = good.select("row_index", T.name_key(F.col("supplier_name_normalized")).alias("name_key"), "supplier_name_normalized").groupBy("name_key").agg(F.min("row_index").alias("first_index"), F.min_by("supplier_name_normalized", "row_index").alias("normalized_supplier_name"))
    old = state["suppliers"]
    start = max_id(old, "canonical_supplier_id", 0) if prefix == "G" else old.agg(F.max(id_number(F.col("canonical_supplier_id"), prefix))).first()[0] or 0
    probed = names.join(old.select("name_key", "canonical_supplier_id"), "name_key", "left")
    new = row_numbers(probed.filter("canonical_supplier_id IS NULL"), [F.col("first_index")], "_n").select(format_id(F.col("_n") + start, prefix).alias("canonical_supplier_id"), "normalized_supplier_name", "name_key")
    all_suppliers = old.unionByName(new)
    links = good.select("client_id", "supplier_id", T.name_key(F.col("supplier_name_normalized")).alias("name_key"), "row_index").join(all_suppliers.select("name_key", "canonical_supplier_id"), "name_key")
    cross = tables.keep_one(links.drop("name_key"), ["client_id", "supplier_id"], F.col("row_index"), last=True).drop("row_index")
    transactions = tables.replace_where(state["transactions"], good.drop("row_index"), F.col("upload_id") == upload_id)
    totals = transactions.groupBy("client_id", "supplier_id").agg(F.max("supplier_name_normalized").alias("supplier_name_normalized"), F.sum("amount").alias("total_spend"), F.sum("quantity").alias("total_quantity"))
    return {
        "transactions": transactions, "rejects": rejects, "suppliers": all_suppliers, "supplier_totals": totals,
        "crosswalk": cross.select("*", F.lit("exact_name_key").alias("match_method"), F.lit(1.0).alias("match_confidence"), F.lit("name_key").alias("matched_on")),
    }


def proposals(matched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """matches_proposed and new_suppliers_proposed, for review, from the result of match_or_assign."""
    return matched.filter(~F.col("is_new")).drop("is_new"), matched.filter("is_new").drop("is_new")


def located(lines: DataFrame, countries: DataFrame) -> DataFrame:
    """lines with a name, and the country of their supplier number: of repeated numbers the last, of blank ones none."""
    known = countries.filter(~F.lower(F.trim("supplier_number")).isin("", "nan") & ~F.lower(F.trim("country")).isin("", "nan"))
    lookup = tables.keep_one(known, ["supplier_number"], F.col("row_index"), last=True).select("supplier_number", "country")
    return lines.filter(~F.lower(F.trim("supplier_name")).isin("", "nan")).join(lookup, "supplier_number", "left")


def renamed(rows: DataFrame, names: DataFrame) -> DataFrame:
    """rows with canonical_name: that of names(supplier_name, canonical_name), or their own."""
    return rows.join(names, "supplier_name", "left").withColumn("canonical_name", F.coalesce("canonical_name", "supplier_name"))


def supplier_facts(rows: DataFrame, n: str | None = None) -> DataFrame:
    """Per canonical name of rows(canonical_name, supplier_name, country): variants, lines, countries and their codes, as sorted sets.

    Lines are counted by name and country first, and each different country is normalized once. n: the column that says
    how many lines a row stands for, where equal ones have been counted.
    """
    every = lambda c, name: F.array_sort(F.collect_set(c)).alias(name)
    counts = kept(rows.groupBy("canonical_name", "supplier_name", "country").agg(F.sum(F.lit(1) if n is None else n).alias("_lines")), "countries")
    placed = suppliers.by_distinct(counts, "country", normalize_country, "place")
    return placed.groupBy("canonical_name").agg(every("supplier_name", "variants"), F.sum("_lines").alias("n_items"), every("place.name", "names"), every("place.code", "codes"))


def refresh_master(lines: DataFrame, countries: DataFrame, categories: DataFrame, master: DataFrame, threshold: float = clusters.THRESHOLD, least_rate: float = 0.5, today=None, confirm=models.same_company, classifier=models.first_candidate, reviewer=models.shared_words) -> DataFrame:
    """The master file after purchase lines: known suppliers merged, new ones classified, in name order.

    lines: supplier_number, supplier_name, item_description, row_index (all different); countries:
    supplier_number, country, row_index. Names are clustered, and a model confirms ambiguous clusters; a
    classifier chooses a category for each different description, and a reviewer looks at a supplier's lines of
    low confidence beside its established categories. All three have offline defaults, see operators.models.

    What doesn't differ between lines is found for their different names, countries and texts; the lines themselves are
    written once as they come and once with their categories.
    """
    today = F.date_format(F.current_date() if today is None else today, "yyyy-MM-dd")
    good = kept(located(lines, countries).select("row_index", "supplier_name", "item_description", "country"), "refresh-rows")
    found = kept(clusters.leader_clusters(good, "supplier_name", threshold=threshold), "refresh-clusters")
    named = kept(models.confirm_clusters(found, clusters.confirm(found), confirm).withColumnRenamed("name", "supplier_name"), "refresh-names")
    counted = lambda *keys: renamed(good.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), named)
    facts = kept(supplier_facts(counted("supplier_name", "country"), "_n"), "refresh-facts")
    existing = master.select(F.lower("Normalized_Supplier_Name").alias("_key"), "*")
    now = facts.withColumn("_key", F.lower("canonical_name"))
    both = existing.join(now, "_key", "left")
    merged = lambda c, new: F.when(F.col("canonical_name").isNotNull(), new).otherwise(F.col(c)).alias(c)
    old_variants = F.filter(F.split(F.coalesce("Original_Name_Variants", F.lit("")), "; "), lambda v: v != "")
    changes = {
        "Original_Name_Variants": F.array_join(F.array_sort(F.array_union(old_variants, "variants")), "; "),
        "Total_PO_Items": F.coalesce("Total_PO_Items", F.lit(0)) + F.col("n_items"),
        "Ship_To_Countries": T.merge_locations(F.col("Ship_To_Countries"), F.col("names")),
        "Country_Codes": T.merge_locations(F.col("Country_Codes"), F.col("codes")),
        "Last_Updated": today,
    }
    updated = both.select(*(merged(c, changes[c]) if c in changes else F.col(c) for c in master.columns))
    new = now.join(existing.select("_key").distinct(), "_key", "left_anti")
    forms = kept(counted("supplier_name", "item_description"), "refresh-forms")
    quality = suppliers.quality_by_supplier(forms, "canonical_name", "item_description", least_rate, "_n")
    flows = kept(quality.select("canonical_name", "flow").join(new.select("canonical_name"), "canonical_name", "left_semi"), "refresh-flows")
    text = F.when(F.col("flow") == "po_line", F.col("item_description")).otherwise(F.col("canonical_name"))
    described = forms.join(flows, "canonical_name").withColumn("_text", text).filter((F.col("flow") != "po_line") | T.good_description(F.col("item_description")))
    texts = kept(described.select("_text").distinct(), "refresh-texts")
    paths = models.classify(texts, "_text", categories, classifier).withColumnRenamed("description", "_text")
    known = texts.join(paths, "_text", "left").withColumn("confidence", F.coalesce("confidence", F.lit(0.0))).withColumn("l3_probability", F.coalesce("l3_probability", F.lit(0.0))).withColumn("reasoning", F.coalesce("reasoning", F.lit("")))
    known = kept(known.withColumn("_good", T.good_description(F.col("_text"))), "refresh-paths")
    fresh = renamed(good, named).join(flows, "canonical_name").select("canonical_name", "row_index", "flow", text.alias("_text"))
    lined = fresh.join(known, "_text").filter("flow != 'po_line' OR _good").drop("flow", "_good")
    classified = models.consolidate(kept(lined, "refresh-lines"), "canonical_name", "row_index", "_text", reviewer)
    groups = taxonomy.category_groups(classified, "canonical_name").join(new, "canonical_name")
    kinds = dict(x.split(" ") for x in MASTER_FILE.split(", "))
    made = {
        "Normalized_Supplier_Name": F.col("canonical_name"), "Original_Name_Variants": F.array_join("variants", "; "), "Overall_Category": F.concat_ws(" > ", "l1", "l2", "l3"), "Category_Name": F.col("l3"),
        "Category_Confidence": T.percent(F.col("avg_confidence")), "L3_Token_Probability": T.percent(F.col("avg_l3_probability")), "Confidence_Reasoning": F.col("reasoning"), "Total_PO_Items": F.col("n_lines"),
        "Ship_To_Countries": F.array_join("names", ", "), "Country_Codes": F.array_join("codes", ", "), "Last_Updated": today, "Supplier_Description": F.lit("Not available"), "Employee_Count": F.lit("Unknown"), "Revenue": F.lit("Unknown"), "Year_Established": F.lit("Unknown"),
    }
    added = groups.select(*(made.get(c, F.lit("")).cast(k).alias(c) for c, k in kinds.items()))
    return updated.unionByName(added, allowMissingColumns=True).orderBy(F.col("Normalized_Supplier_Name").cast("string"), "Overall_Category")


def run_staged(spark: SparkSession, log: str, run_id: str, stages: list, progress=None) -> dict:
    """Run (name, function) stages in order with one log row each; a failing stage is logged and ends the run.

    A frame is written once, then counted and handed on as written. progress, if given, is called with the share
    done and the name of each stage before it starts, and with 1.0 and "done" at the end.
    """
    from masterline.sources.files import append_log

    out: dict = {}
    tell = progress or (lambda share, name: None)
    for i, (name, function) in enumerate(stages):
        tell(i / len(stages), name)
        try:
            made = function(out)
            out[name] = kept(made, f"stage-{name}") if isinstance(made, DataFrame) else made
            append_log(spark, log, run_id, name, "ok", out[name].count() if isinstance(made, DataFrame) else None)
        except Exception as failure:
            append_log(spark, log, run_id, name, "error", 0, str(failure)[:500])
            raise
    tell(1.0, "done")
    return out


def load_summary(counts: DataFrame) -> DataFrame:
    """What a load counted, as one row of JSON text."""
    return counts.select(F.to_json(F.struct(*counts.columns)).alias("summary"))


def summary_lines(counts: Mapping[str, int]) -> list[str]:
    """The same for reading, a line for each count."""
    return [f"{name.replace('_', ' ').capitalize()}: {n:,}" for name, n in counts.items()]
