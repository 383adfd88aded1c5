"""A training corpus from documents: rules, near-duplicates, secrets, mix, sequences.

Each stage takes all that the one before kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masterline.llm import mixing, near, packing, quality, secrets
from masterline.llm.common import scope, scratch_path, small, stage


def whole(docs: DataFrame) -> DataFrame:
    """doc_id, text, source, and _doc with all columns: whatever else documents have can't clash with an operator's names."""
    return docs.select("doc_id", "text", "source", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; the verdict on a source only adds stricter rules.

    Null and empty texts have too few words, so they go; a null source is one source; repeated rows are judged
    each; all other columns pass, null or not; an empty table stays empty.
    """
    return quality.judge(whole(docs), keep=("_doc",)).filter("kept").select("_doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (see near.near_groups) stays: that with the least id.

    A null id is less than any other; of equal ids, as of repeated rows, one row stays; null and blank texts
    are one group. Texts are shuffled only where those that go, or those to compare, are many.
    """
    named = stage(whole(docs).select("_doc", F.monotonically_increasing_id().alias("_row")), "dedup-docs")
    with scope(spark):
        groups = stage(near.near_groups(named.select(F.col("_row").alias("row"), F.col("_doc.text").alias("text"))), "dedup-groups")
        keys = named.select(F.col("_row").alias("row"), F.struct(F.col("_doc.doc_id").alias("doc_id"), F.col("_row").alias("row")).alias("_key"))
        kept = groups.join(keys, "row").groupBy("group").agg(F.min("_key").alias("_key")).select(F.col("_key.row").alias("row"))
        gone = stage(groups.select("row").join(kept, "row", "left_anti"), "dedup-gone", outer=True).withColumnRenamed("row", "_row")
    return named.join(small(gone), "_row", "left_anti").select("_doc.*")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials are masked, and n_chars follows; every document stays.

    A null text stays null, and a text without a live credential, with its n_chars, as it is; repeated rows are
    masked alike; an empty table stays empty.
    """
    found = secrets.scan(whole(docs), keep=("_doc",))
    masked = secrets.redact(F.col("_doc.text"), F.col("spans"))
    n_chars = F.when(F.exists("spans", lambda s: s["live"]), F.length(masked).cast("long")).otherwise(F.col("_doc.n_chars"))
    changed = F.col("_doc").withField("text", masked).withField("n_chars", n_chars)
    return found.select(changed.alias("_doc")).select(*(F.col(f"_doc.`{c}`") for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, each as often as its source's rate says.

    A null source is a source, ranked last; a source without words, so one of null texts, has rate 0; rows with
    equal ids draw alike; an empty table stays empty.
    """
    return mixing.repeat(mixing.mix(whole(docs))).select("_doc.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed corpus: pieces of the documents with their ids, sequence and place.

    A null or empty text is its end token; only documents longer than a sequence are cut; copies that mixing
    made are pieces of their own, with equal doc_id and piece; no documents give no sequences.
    """
    return packing.pack(stage(packing.tokenize(docs, with_ids=True), "pieces"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scans", secret_scans),
    ("mixing", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

#: Tokenizing, SimHash and bin packing have no form in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written in the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
