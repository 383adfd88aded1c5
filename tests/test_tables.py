"""Upsert laws, numbering, matching and constraints."""

from pyspark.sql import functions as F

from masterline.operators import columns as C
from masterline.operators import ids as I
from masterline.operators import suppliers as S
from masterline.operators import tables as U


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "c", "z")], "k int, v string, d string")
    new = spark.createDataFrame([(2, "B", "n"), (3, None, "n"), (4, "D", "n")], "k int, v string, d string")
    once = U.upsert(old, new, ["k"], ["v"])
    assert rows(once) == rows(spark.createDataFrame([(1, "a", "x"), (2, "B", None), (3, None, "z"), (4, "D", "n")], old.schema))
    assert rows(U.upsert(once, new, ["k"], ["v"])) == rows(once)
    mixed = U.upsert_coalesce(old, new, ["k"])
    assert rows(mixed) == rows(spark.createDataFrame([(1, "a", "x"), (2, "B", "n"), (3, "c", "n"), (4, "D", "n")], old.schema))
    assert rows(U.upsert_coalesce(mixed, new, ["k"])) == rows(mixed)
    assert rows(U.upsert_coalesce(old, new, ["k"], new_first=False))[1] == (2, "b", "n")
    absent = U.insert_absent(old, new, ["k"])
    assert rows(absent) == rows(spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "c", "z"), (4, "D", "n")], old.schema)) and rows(U.insert_absent(absent, new, ["k"])) == rows(absent)
    replaced = U.replace_where(old, new, F.col("d") == "x")
    assert replaced.count() == 5
    none = old.limit(0)
    assert rows(U.upsert(none, new, ["k"])) == rows(new) and rows(U.upsert(old, new.limit(0), ["k"])) == rows(old)


def test_keep_one(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), ("b", 5, "y"), (None, 1, "n")], "k string, o int, v string")
    assert rows(U.keep_one(df, ["k"], F.col("o"))) == rows(spark.createDataFrame([("a", 1, "x"), ("b", 5, "y"), (None, 1, "n")], df.schema))
    assert ("a", 2, None) in rows(U.keep_one(df, ["k"], F.col("o"), last=True))


def test_row_numbers_in_ranges(spark, monkeypatch):
    monkeypatch.setattr(I, "ROWS_PER_RANGE", 30)
    df = spark.range(200).selectExpr("id", "(id * 7919) % 211 AS o")
    got = {r["id"]: r["row_number"] for r in I.row_numbers(df, [F.col("o")]).collect()}
    assert [got[i] for i in sorted(got, key=lambda i: i * 7919 % 211)] == list(range(1, 201))


def test_ids(spark):
    df = spark.createDataFrame([("G9999",), ("G10001",), ("X1",), (None,)], "g string")
    assert I.max_id(df, "g") == 10001 and I.max_id(df.limit(0), "g") == 10000
    assert df.select(I.format_id(F.lit(7))).first()[0] == "G00007"


def test_match_or_assign_is_stable(spark):
    master = spark.createDataFrame([("G10001", "Acme"), ("G10005", " ACME "), ("G9999", "old")], "global_supplier_id string, normalized_supplier_name string")
    names = spark.createDataFrame([("acme", 5), ("Zed", 1), ("zed", 2), ("Bob", 3)], "name string, i int")
    got = {r["name"]: (r["global_supplier_id"], r["is_new"]) for r in S.match_or_assign(names, master, "name", [F.col("i")]).collect()}
    assert got == {"acme": ("G10005", False), "Zed": ("G10006", True), "zed": ("G10006", True), "Bob": ("G10007", True)}


def test_columns(spark):
    assert C.find_column(["vendor name ", "Amount", "AMOUNT"], ["Supplier", "Vendor Name"]) == "vendor name " and C.find_column(["Amount", "AMOUNT"], ["amount"]) == "AMOUNT" and C.find_column(["a"], ["b"]) is None
    assert C.named_column(["Name", "name"], "name") == "name" and C.name_like_column(["x", "Vendor"]) == "Vendor" and C.name_like_column(["x"]) == "x" and C.containing_index(["po", "Supplier Name"], ["name"]) == 1
    df = spark.createDataFrame([(None, "b", "c")], "Amt string, Amount string, Other string")
    assert C.rename_by_map(df, {"amt": "amount", "amount": "amount"}).collect()[0].asDict() == {"amount": "b", "Other": "c"}
    got = df.select(C.missing_columns(["Amt", "Amount"])).first()[0]
    assert got == ["Amt"]


def test_rolling_and_totals(spark):
    df = spark.sql("SELECT 's' AS s, CAST(v AS DECIMAL(18,4)) AS a, CAST(d AS DATE) AS d FROM VALUES (1, '2024-01-05'), (2, '2024-12-31'), (4, '2025-01-01'), (8, NULL) AS t(v, d)")
    got = {(r["spend_year"], r["spend_month"]): float(r["rolling_spend"]) for r in S.rolling_spend(df.filter("d IS NOT NULL"), ["s"], "a", "d").collect()}
    assert got == {(2024, 1): 1, (2024, 12): 3, (2025, 1): 6}
    assert float(S.client_totals(df, ["s"], "a", "a", "d").first()["total_spend"]) == 15


def test_violations(spark):
    a, b = spark.createDataFrame([(1, None), (1, 5)], "k int, f int"), spark.createDataFrame([(4,)], "k int")
    got = {(r["constraint"], r["target"]): r["n"] for r in U.violations({"a": a, "b": b}, {"a": ["k"], "b": ["k"]}, {"a": ["f"]}, [("a", "f", "b", "k")]).collect()}
    assert got == {("primary_key", "a"): 1, ("primary_key", "b"): 0, ("not_null", "a.f"): 1, ("foreign_key", "a.f"): 1}


def test_lookup_by_counts_finds_what_a_left_join_finds(spark):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(["hot"] * 50 + ["a", "b", None, "c", "c"])], "key string, i long").repartition(3)
    table = spark.createDataFrame([("hot", 1), ("a", 2), ("c", None), ("z", 9)], "key string, v long")
    want = sorted(map(repr, df.join(table, "key", "left").collect()))
    for rows, most in ((10, 10_000), (0, 10_000), (0, 5), (0, 1)):
        assert sorted(map(repr, U.lookup(df, "key", table, most, rows).collect())) == want
