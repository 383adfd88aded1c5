"""Command lines: load a transaction file or a prepared master file, normalize a list of names, embed suppliers, search them by a phrase."""

from __future__ import annotations

import argparse
import importlib
import importlib.util
import json
import sys
from collections.abc import Callable, Sequence

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masterline.functions.udfs import hash_embedding
from masterline.operators import models, suppliers, tables, vectors
from masterline.operators.budget import CallBudget
from masterline.plans import pipelines
from masterline.plans.schemas import TABLES, empty
from masterline.sources import files
from masterline.sources.scratch import kept

STATE = ("supplier_master", "supplier_attributes", "client_master", "supplier_crosswalk")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="masterline", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    load = commands.add_parser("load", help="transaction file into the reference tables")
    load.add_argument("path")
    load.add_argument("--root", help="where the published tables are; needed unless --dry-run")
    load.add_argument("--client-id", default="global")
    load.add_argument("--client-name")
    load.add_argument("--supplier-column")
    load.add_argument("--supplier-id-column")
    load.add_argument("--dry-run", action="store_true", help="count, write nothing")
    load.add_argument("--json", action="store_true", help="the summary as JSON only")
    load.add_argument("--enrich-module", help="a module, or the path of a file, with a function of a supplier's row that answers with attributes")
    load.add_argument("--enrich-function", default="enrich_supplier")
    load.add_argument("--skip-enrich", action="store_true")
    load.add_argument("--calls-per-minute", type=int, default=30, help="of the function, by all tasks together")
    bulk = commands.add_parser("bulk", help="prepared master file into the reference tables")
    bulk.add_argument("path")
    bulk.add_argument("--root", help="where the published tables are; needed unless --dry-run")
    bulk.add_argument("--dry-run", action="store_true")
    bulk.add_argument("--json", action="store_true")
    embed = commands.add_parser("embed", help="vectors of the published suppliers that have none yet")
    embed.add_argument("--root", required=True)
    embed.add_argument("--vectors", required=True, help="Parquet table of vectors, appended to")
    embed.add_argument("--client-id", default="global")
    embed.add_argument("--limit", type=int, help="so many suppliers at most, in id order")
    embed.add_argument("--dry-run", action="store_true")
    embed.add_argument("--json", action="store_true")
    normalize = commands.add_parser("normalize", help="names of a file into canonical ones, as three CSV folders")
    normalize.add_argument("path")
    normalize.add_argument("--column")
    normalize.add_argument("--column-index", type=int)
    normalize.add_argument("--encoding", default="UTF-8")
    normalize.add_argument("--batch-size", type=int, default=50)
    normalize.add_argument("--min-group-size", type=int, default=2)
    normalize.add_argument("--output-dir", default=".")
    normalize.add_argument("--json", action="store_true")
    search = commands.add_parser("search", help="suppliers nearest to a phrase")
    search.add_argument("query", nargs="?", default="", help="a phrase; without one it is read from the input")
    search.add_argument("--vectors", required=True, help="Parquet table of vectors")
    search.add_argument("--top", type=int, default=5)
    return top


def query_text(given: str, source=None) -> str:
    """The phrase given, or what the input holds; an error if both are blank."""
    text = given.strip() or (source or sys.stdin).read().strip()
    if not text:
        raise ValueError("no query")
    return text


def state_of(spark: SparkSession, root: str | None) -> dict[str, DataFrame]:
    """The published tables, or empty ones where nothing has been published."""
    try:
        return {n: files.published(spark, root, n) for n in STATE} if root else {n: empty(spark, n) for n in STATE}
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return {n: empty(spark, n) for n in STATE}


def loaded_function(module: str, name: str) -> Callable[[dict], dict | None]:
    """A function of a module, given by its name or by the path of its file."""
    if module.endswith(".py"):
        spec = importlib.util.spec_from_file_location("masterline_enrichment", module)
        found = importlib.util.module_from_spec(spec)
        sys.modules[spec.name] = found
        spec.loader.exec_module(found)
        cloudpickle.register_pickle_by_value(found)  # tasks can't import a file that only the driver has
    else:
        found = importlib.import_module(module)
    function = getattr(found, name, None)
    if not callable(function):
        raise ValueError(f"{module} has no function {name}")
    return function


def run_load(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    rows = files.read_transactions(files.read_csv_any(spark, args.path), args.supplier_column, args.supplier_id_column)
    state = state_of(spark, args.root)
    counts = pipelines.load_counts(rows, state).first().asDict()
    if not args.dry_run:
        if not args.root:
            raise ValueError("--root is needed to write")
        name = (args.client_id, args.client_name or args.client_id)
        if args.enrich_module and not args.skip_enrich:
            model = models.Transport(loaded_function(args.enrich_module, args.enrich_function))
            fields = {c: ("string", "") for c in empty(spark, "supplier_attributes").columns if c not in ("global_supplier_id", "date_added")}
            with CallBudget(spark, args.calls_per_minute) as budget:
                after = pipelines.load_transactions(rows, *name, state, enrich=lambda df: kept(models.answered(df, model, fields, budget=budget), "enriched"))
            files.publish(after, args.root)
        else:
            files.publish(pipelines.load_transactions(rows, *name, state), args.root)
        counts |= {f"{n}_rows": files.published(spark, args.root, n).count() for n in STATE}
    return counts


def run_bulk(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    state = state_of(spark, args.root)
    df = files.read_csv_any(spark, args.path)
    clients, first = files.read_bulk(df)
    known = tables.flag_existing(first, state["supplier_master"], F.lower(F.trim("normalized_supplier_name")), F.lower(F.trim("normalized_supplier_name")))
    counts = known.agg(F.count(F.lit(1)).alias("unique_suppliers"), F.count_if(~F.col("is_existing")).alias("new_suppliers"), F.count_if("is_existing").alias("existing_suppliers")).first().asDict()
    counts["clients"] = clients.count()
    if not args.dry_run:
        if not args.root:
            raise ValueError("--root is needed to write")
        files.publish(state | pipelines.bulk_load(df, state), args.root)
        counts |= {f"{n}_rows": files.published(spark, args.root, n).count() for n in STATE}
    return counts


def run_embed(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    schema = TABLES["vector_embeddings"]
    try:
        existing = spark.read.schema(schema).parquet(args.vectors)
    except AnalysisException:
        existing = empty(spark, "vector_embeddings")
    state = state_of(spark, args.root)
    new = vectors.embed_suppliers(state["supplier_master"], state["supplier_attributes"].drop("date_added"), existing, args.client_id, args.limit)
    counts = {"existing_vectors": existing.count(), "suppliers": state["supplier_master"].count()}
    if args.dry_run:
        return counts | {"new_vectors": new.count()}
    new = kept(new, "vectors")
    new.write.mode("append").parquet(args.vectors)
    return counts | {"new_vectors": new.count()}


def run_normalize(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    rows = files.read_names(spark, args.path, args.column, args.column_index, args.encoding)
    results = kept(pipelines.normalize_names(rows, least_group=args.min_group_size, size=args.batch_size), "normalized")
    files.export_tables({"supplier_normalization_full": files.full_export(results), "supplier_name_mapping": files.mapping_export(results), "supplier_clusters_summary": suppliers.cluster_summary(results)}, args.output_dir)
    return {k: v or 0 for k, v in pipelines.normalization_stats(results).first().asDict().items()}


def run_search(spark: SparkSession, args: argparse.Namespace, source=None) -> list[dict]:
    text = query_text(args.query, source)
    wanted = spark.createDataFrame([(text,)], "t string").select(hash_embedding("t")).first()[0]
    found = vectors.search(spark.read.schema(TABLES["vector_embeddings"]).parquet(args.vectors), wanted, args.top)
    return [{**r.asDict(), "similarity": round(r["similarity"], 4)} for r in found.orderBy(F.desc("similarity"), "global_supplier_id").collect()]


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("masterline").getOrCreate()
    try:
        out = {"load": run_load, "bulk": run_bulk, "normalize": run_normalize, "embed": run_embed, "search": run_search}[args.command](spark, args)
    except ValueError as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    if args.command == "search":
        for i, r in enumerate(out, 1):
            print(f"{i}. {r['global_supplier_id']}  {r['similarity']:.4f}  {r['preview']}")
    else:
        print(json.dumps(out) if args.json else "\n".join(pipelines.summary_lines(out)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
