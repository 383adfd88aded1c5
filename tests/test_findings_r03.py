"""What the findings of round 3 showed."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from masterline.functions.countries import normalize_country
from masterline.functions.text import clean_name_lenient
from masterline.functions.udfs import hash_embedding
from masterline.operators import clusters as G
from masterline.operators import models as M
from masterline.operators import suppliers as S
from masterline.operators import taxonomy as X
from masterline.operators import vector_index as VI
from masterline.operators.vectors import cosine_distance
from masterline.plans import pipelines as P
from masterline.plans.schemas import MASTER_FILE
from masterline.sources import files


def test_words_that_cancel_have_a_vector(spark):
    texts = [("Supplier#000000418 NATION_7",), ("nation_7  SUPPLIER#000000418",)]
    a, b = (r[0] for r in spark.createDataFrame(texts, "t string").select(hash_embedding("t")).collect())
    assert a == b and abs(sum(x * x for x in a) - 1) < 1e-6


@pytest.mark.parametrize(("part_rows", "part_queries"), [(7, 3), (10_000, 10_000)])
def test_search_of_many_meets_in_parts(spark, tmp_path, part_rows, part_queries):
    """Whatever the parts, the answer of all pairs: with copies, multiples of a vector, string keys, nulls inside, NaN."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 6))
    x[20:60] = x[5]
    x[60:80] = x[6] * np.arange(1, 21)[:, None]
    rows = [(f"k{i}", v) for i, v in enumerate(x.tolist())] + [("zero", [0.0] * 6), ("null", [None] + [1.0] * 5), ("nan", [float("nan")] * 6), (None, x[5].tolist())]
    df = spark.createDataFrame(rows, "id string, embedding array<double>").repartition(3)
    asked = df.filter("id IS NOT NULL").sample(0.4, 1).unionByName(df.filter("id IN ('k5', 'zero', 'null')"))
    asked = spark.createDataFrame(asked.distinct().collect(), df.schema)
    at = f"file://{tmp_path}/index"
    VI.build_index(df, at, 4, "id")
    found = VI.search_many(spark, at, asked, 9, 4, "id", "id", part_rows=part_rows, part_queries=part_queries)
    got = sorted((r["query"], r["rank"], r["key"], repr(r["distance"])) for r in found.collect() if r["key"]), found.filter("key IS NULL").count()
    pairs = df.crossJoin(asked.select(F.col("id").alias("query"), F.col("embedding").alias("_q"))).withColumn("distance", cosine_distance(F.col("embedding"), F.col("_q"))).filter("distance IS NOT NULL AND query != 'zero'")
    best = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))).filter("rank <= 9")
    want = sorted((r["query"], r["rank"], r["id"], repr(r["distance"])) for r in best.collect() if r["id"]), best.filter("id IS NULL").count()
    assert got == want and want[1] > 0


def test_search_of_many_makes_no_row_for_a_pair(spark, sf, tmp_path):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    at = f"file://{tmp_path}/index"
    VI.build_index(rows, at, 4, "vec_id")
    plan = VI.search_many(spark, at, rows.filter("vec_id % 50 = 0"), 5, 4, "vec_id", "vec_id")._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroups" in plan and "SortMergeJoin" not in plan and "zip_with" not in plan


def test_resolver_batches_are_several_tasks(spark):
    """Few bytes are much work, so batches must not be put together into one task; and one block has many."""
    rows = [(f"acme{i:04d}", f"acme{i:04d}", "acme", False, 1) for i in range(400)]
    entries = spark.createDataFrame(rows, "cleaned string, best_original string, block string, individual boolean, n_rows long")
    got = G.resolve(entries, lambda names: [{"canonical": min(names), "members": list(range(len(names)))}])
    assert got.select(F.spark_partition_id()).distinct().count() > 2
    assert sorted({r["normalized"] for r in got.collect()}) == [f"acme{i:04d}" for i in range(0, 400, 50)]


def test_transaction_names_are_cleaned_once(spark, tmp_path):
    rows = [("Acme Inc. & Co", "1"), (" n/a ", "2"), ("12", "3"), ("The Acme, LLC", "4")] * 50
    spark.createDataFrame(rows, "`VENDOR NAME` string, amount string").coalesce(1).write.option("header", True).csv(f"file://{tmp_path}/t")
    got = files.read_transactions(files.read_csv(spark, f"file://{tmp_path}/t", multiline=False))
    plan = got._jdf.queryExecution().optimizedPlan().toString().lower()
    assert r"\b(?:" not in plan and "nfkd" not in plan
    assert got.columns == ["row_index", "supplier_name_raw", "supplier_id", "amount", "currency", "item_description", "supplier_name_normalized"]
    want = dict(spark.createDataFrame([(n,) for n in ("Acme Inc. & Co", "12", "The Acme, LLC")], "n string").select("n", F.coalesce(F.nullif(clean_name_lenient(F.col("n")), F.lit("")), "n")).collect())
    assert sorted((r["row_index"], r["supplier_name_normalized"]) for r in got.collect()) == [(i, want[n.strip()]) for i, (n, _) in enumerate(rows) if n != " n/a "]


def test_a_country_is_trimmed_once_a_value(spark):
    """Not once for every country that it is compared with."""
    plan = spark.range(9).select(normalize_country(F.col("id").cast("string")).alias("place"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1


def test_refresh_reads_each_country_once(spark, monkeypatch):
    """3,000 lines of two suppliers have two countries; what isn't found for each line is still counted for it."""
    asked = spark.sparkContext.accumulator(0)

    @F.udf("struct<name:string,code:string>")
    def slow(value):
        asked.add(1)
        return (value.title(), value[:2].upper())

    monkeypatch.setattr(P, "normalize_country", slow)
    rows = [(i, str(i % 2), f"{'Acme' if i % 2 else 'Globex'} Tools", "12345" if i % 10 == 0 else "steel hammer" if i % 3 else "odd crane") for i in range(3000)]
    lines = spark.createDataFrame(rows, "row_index long, supplier_number string, supplier_name string, item_description string")
    countries = spark.createDataFrame([("0", "france", 0), ("1", "spain", 1)], "supplier_number string, country string, row_index int")
    cats = spark.createDataFrame([("Goods", "Hardware", "Steel hammer"), ("Aid", "Sea", "Rope")], "l1 string, l2 string, l3 string")
    got = P.refresh_master(lines, countries, cats, spark.createDataFrame([], MASTER_FILE), today=F.lit("2026-01-02").cast("date"), confirm=lambda row: {"results": []}).collect()
    seen = [(r["Normalized_Supplier_Name"], r["Overall_Category"], r["Total_PO_Items"], r["Ship_To_Countries"], r["Country_Codes"]) for r in got]
    # Globex has the even lines, of which every fifth is digits only and drops out
    n = lambda even, text: sum((i % 2 == 0) == even and r[3] == text for i, r in enumerate(rows))
    assert seen == [
        ("Acme Tools", "Aid > Sea > Rope", n(False, "odd crane"), "Spain", "SP"), ("Acme Tools", "Goods > Hardware > Steel hammer", n(False, "steel hammer"), "Spain", "SP"),
        ("Globex Tools", "Aid > Sea > Rope", n(True, "odd crane"), "France", "FR"), ("Globex Tools", "Goods > Hardware > Steel hammer", n(True, "steel hammer"), "France", "FR"),
    ]
    assert 2 <= asked.value <= 100


def test_counted_rows_have_the_quality_of_their_lines(spark):
    rows = spark.createDataFrame([("a", "steel"), ("a", "steel"), ("a", "12"), ("b", None), ("b", None), ("c", "x"), ("c", "paper")], "s string, d string")
    counted = rows.groupBy("s", "d").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(S.quality_by_supplier(counted, "s", "d", n="n").collect()) == sorted(S.quality_by_supplier(rows, "s", "d").collect())


def test_samples_and_reviews_are_cut_before_the_shuffle(spark):
    """A category of any size sends a few lines, and a null in its path doesn't lose it."""
    rows = [(i, "s", f"pen {i:03d}", "O", None, "Pens", 0.75) for i in range(400)] + [(500 + i, "s", "x", None, None, None, 0.25) for i in range(400)]
    lines = spark.createDataFrame(rows, "id long, s string, d string, l1 string, l2 string, l3 string, confidence double").repartition(3)
    samples = X.category_samples(lines, "s", "d", "id")
    assert "WindowGroupLimit" in samples._jdf.queryExecution().executedPlan().toString()
    got = {r["l1"]: (r["avg_confidence"], r["samples"]) for r in samples.collect()}
    assert got == {"O": (0.75, [f"pen {i:03d}" for i in range(5)]), None: (0.25, ["x"] * 5)}
    calls = spark.sparkContext.accumulator(0)

    def every(row):
        calls.add(1)
        return {"reassignments": [{"item_id": i, "to_category_id": 0} for i in range(len(row["items"]))]}

    out = M.consolidate(lines, "s", "id", "d", every)
    assert sorted(r["id"] for r in out.filter("l1 = 'O' AND id >= 500").collect()) == list(range(500, 550)) and out.count() == 800
    assert calls.value == 1
