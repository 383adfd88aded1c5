"""Command lines, databases, lists, vectors and publishing."""

import io
import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from masterline import cli
from masterline.functions.udfs import hash_embedding, packed, repair, unpacked, vector_literal
from masterline.operators import vectors as V
from masterline.plans.schemas import TABLES, empty
from masterline.sources import database as D
from masterline.sources import files

FILE = "Vendor,Vendor ID,Amount\nAcme Ltd,1,5\nACME LTD,1,6\nGlobex,,7\n"


@pytest.fixture
def path(tmp_path):
    (tmp_path / "t.csv").write_text(FILE)
    return f"file://{tmp_path}/t.csv"


def test_load_command(spark, path, tmp_path, capsys):
    assert cli.main(["load", path, "--dry-run", "--json"], spark) == 0
    assert json.loads(capsys.readouterr().out) == {"rows_read": 3, "raw_names": 3, "unique_suppliers": 2, "new_suppliers": 2, "existing_suppliers": 0}
    root = f"file://{tmp_path}/root"
    for new, old in ((2, 0), (0, 2)):
        assert cli.main(["load", path, "--root", root, "--client-id", "acme", "--json"], spark) == 0
        got = json.loads(capsys.readouterr().out)
        assert (got["new_suppliers"], got["existing_suppliers"], got["supplier_master_rows"], got["supplier_crosswalk_rows"]) == (new, old, 2, 2)
    assert {r["supplier_id"] for r in files.published(spark, root, "supplier_crosswalk").collect()} == {"1", "globex"}
    assert cli.main(["load", path], spark) == 1 and "--root" in capsys.readouterr().err


def test_normalize_command(spark, path, tmp_path, capsys):
    assert cli.main(["normalize", path, "--output-dir", f"file://{tmp_path}/out"], spark) == 0
    assert "Names: 2" in capsys.readouterr().out
    assert files.read_csv(spark, f"file://{tmp_path}/out/supplier_name_mapping").count() == 2


def test_search_command(spark, tmp_path, capsys, monkeypatch):
    rows = spark.createDataFrame([("global", "G1", "0", "steel pipes"), ("global", "G2", "0", "legal advice")], "client_id string, global_supplier_id string, chunk_id string, source_text string")
    at = f"file://{tmp_path}/v"
    rows.select("*", hash_embedding("source_text").alias("embedding"), F.current_timestamp().alias("indexed_at")).write.parquet(at)
    assert cli.main(["search", "pipes of steel", "--vectors", at, "--top", "1"], spark) == 0
    assert capsys.readouterr().out.startswith("1. G1")
    monkeypatch.setattr("sys.stdin", io.StringIO("legal advice\n"))
    assert cli.main(["search", "--vectors", at], spark) == 0 and capsys.readouterr().out.startswith("1. G2")
    assert cli.query_text(" x ") == "x"
    with pytest.raises(ValueError, match="no query"):
        cli.query_text(" ", io.StringIO(" \n"))


def test_jdbc_round_trip(spark):
    url = "jdbc:derby:memory:masterline;create=true"
    jvm = spark.sparkContext._jvm.java.sql.DriverManager
    connection = jvm.getConnection(url)
    connection.createStatement().execute(D.create_statement("transactions"))
    columns = dict(D.columns("transactions"))
    df = spark.createDataFrame([(i, f"c{i % 2}", "u", f"G{i}") for i in range(1, 41)], "row_id long, client_id string, upload_id string, global_supplier_id string")
    blank = lambda k: F.lit("") if k == "string" else F.lit(None).cast(k)  # noqa: E731  Spark gives Derby null strings as CLOB
    whole = df.select(*(F.col(c) if c in df.columns else blank(k).alias(c) for c, k in columns.items()))
    D.write_table(whole, url, '"transactions"', {"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    back = D.read_table(spark, url, '"transactions"', key='"row_id"', parts=4)
    assert back.rdd.getNumPartitions() == 4 and back.count() == 40 and {r["client_id"] for r in back.collect()} == {"c0", "c1"}
    connection.close()


def test_statements():
    assert D.create_statement("client_master", 'client_a"b').startswith('CREATE TABLE "client_a""b"."client_master" ("client_id" VARCHAR(8000) NOT NULL')
    assert "PRIMARY KEY (\"client_id\", \"supplier_id\")" in D.create_statement("supplier_crosswalk")
    assert all(len(D.columns(t)) == len(set(n for n, _ in D.columns(t))) for t in TABLES)


def test_create_tables_twice(spark, tmp_path):
    spark.sql(f"CREATE DATABASE masterline_test LOCATION 'file://{tmp_path}/db'")
    try:
        assert set(D.create_tables(spark, "masterline_test")) == set(TABLES) and D.create_tables(spark, "masterline_test") == []
        assert spark.table("masterline_test.supplier_master").schema.names == empty(spark, "supplier_master").schema.names
    finally:
        spark.sql("DROP DATABASE masterline_test CASCADE")


def test_publish_is_all_or_none(spark, tmp_path):
    root = f"file://{tmp_path}/p"
    files.publish({"a": spark.range(1), "b": spark.range(2)}, root)
    with pytest.raises(Exception):  # noqa: B017, PT011
        files.publish({"a": spark.range(5), "b": spark.range(2).select(F.raise_error(F.lit("late")).alias("id"))}, root)
    assert files.published(spark, root, "a").count() == 1
    files.publish({"a": spark.range(7), "b": spark.range(2)}, root)
    assert files.published(spark, root, "a").count() == 7


def test_vectors_as_bytes_and_text(spark):
    df = spark.createDataFrame([([0.5, -1.25e-5, 3.0],), (None,), ([],)], "v array<float>")
    got = df.select(packed("v").alias("b"), unpacked(packed("v")).alias("v"), vector_literal("v").alias("t")).collect()
    assert len(got[0]["b"]) == 12 and got[0]["v"][0] == 0.5 and got[0]["t"].startswith("[0.5,-1.24999") and got[1]["b"] is None and got[2]["t"] == "[]"
    rows = spark.createDataFrame([("G1", [1.0, 2.0]), ("G2", [1.0]), ("G3", None)], "global_supplier_id string, embedding array<float>")
    good, bad = V.checked(rows, 2)
    assert good.count() == 1 and {tuple(r) for r in bad.collect()} == {("G2", "embedding length 1, expected 2"), ("G3", "embedding length 0, expected 2")}


def test_answers_that_are_cut_off():
    whole = '{"canonical": "A", "members": [0, 1], "confidence": "high"}'
    assert json.loads(repair(f'{{"clusters": [{whole}, {{"canonical": "B", "mem')) == {"clusters": [{"canonical": "A", "members": [0, 1], "confidence": "high"}]}
    assert json.loads(repair("{'a': 'b', 'c': [1, 2,")) == {"a": "b", "c": [1, 2]}
    assert json.loads(repair('{"a": "it\'s"')) == {"a": "it's"} and repair("no json") is None and repair(None) is None
    assert json.loads(repair('[1, {"x": 2}]')) == {"x": 2}


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from masterline.sources.scratch import scratch_root

    session = lambda master: SimpleNamespace(conf=SimpleNamespace(get=lambda k, v: v), sparkContext=SimpleNamespace(master=master))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_root(session(master))
    assert scratch_root(session("local[8]")).startswith("file:///")


def test_a_scope_deletes_what_was_written_inside(spark):
    from masterline.sources.scratch import kept, scope

    with scope(spark):
        gone, stays = kept(spark.range(3), "in"), kept(spark.range(4), "out", outer=True)
        with scope(spark):
            middle = kept(spark.range(5), "middle", outer=True)
            assert gone.count() == 3
        assert middle.count() == 5
    assert stays.count() == 4
    for df in (gone, middle):
        with pytest.raises(Exception):  # noqa: B017, PT011
            df.count()


def test_ordinals_follow_files_whatever_the_splits(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = {"b.csv": 400, "a.csv": 3, "c.csv": 150, "empty.csv": 0}
    for name, n in rows.items():
        (tmp_path / "in" / name).write_text("k,Supplier\n" + "".join(f"{name}{i:05},x{i % 7}\n" for i in range(n)))
    want = [f"{name}{i:05}" for name in sorted(rows) for i in range(rows[name])]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "900", "200"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = files.read_csv(spark, f"file://{tmp_path}/in", multiline=False)
            got = {r["k"]: r["row_index"] for r in files.file_ordinals(df).collect()}
            assert got == {k: i for i, k in enumerate(want)}
            names = files.read_names(spark, f"file://{tmp_path}/in", "k")
            assert [r["name"] for r in names.orderBy("row_index").collect()] == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    shuffled = files.read_csv(spark, f"file://{tmp_path}/in", multiline=False).repartition(3)
    assert shuffled.count() == files.file_ordinals(shuffled).select("row_index").distinct().count()
    plain = spark.createDataFrame([("a",)], "k string")
    assert files.file_ordinals(plain).columns == ["k", "row_index"]


def test_partitions_are_replaced_in_place(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    first = spark.createDataFrame([(u, i, u) for u in ("u 1", "u2", "u3") for i in range(3)], "upload string, i long, v string")
    files.replace_partitions(first, path, ["upload"])
    listed = lambda: {str(x.relative_to(tmp_path)) for x in (tmp_path / "t").rglob("*.parquet")}
    before = listed()
    again = spark.createDataFrame([("u2", 9, "new")], "upload string, i long, v string")
    for _ in range(2):
        files.replace_partitions(again, path, ["upload"], emptied=[("u 1",), ("absent",)])
        got = sorted(map(tuple, spark.read.parquet(path).select("upload", "i", "v").collect()))
        assert got == [("u2", 9, "new")] + [("u3", i, "u3") for i in range(3)]
    assert {x for x in before if "u3" in x} == {x for x in listed() if "u3" in x} and not any("u%201" in x or "u 1" in x for x in listed())


OLD = {1: ("a", "x"), 2: (None, "y"), 3: ("c", None)}
NEW = {2: ("n", None), 3: (None, "z"), 4: ("d", None)}
MERGED = {
    "replace": {1: ("a", "x"), 2: ("n", None), 3: (None, "z"), 4: ("d", None)},
    "new_first": {1: ("a", "x"), 2: ("n", "y"), 3: ("c", "z"), 4: ("d", None)},
    "old_first": {1: ("a", "x"), 2: ("n", "y"), 3: ("c", "z"), 4: ("d", None)},
    "keep": {1: ("a", "x"), 2: (None, "y"), 3: ("c", None), 4: ("d", None)},
}


@pytest.mark.parametrize("policy", D.POLICIES)
def test_conflict_policies(policy):
    con = sqlite3.connect(":memory:")
    con.execute('CREATE TABLE "t" ("k" INTEGER, "a" TEXT, "b" TEXT, PRIMARY KEY ("k"))')
    con.execute('CREATE TABLE "t_stage" ("k" INTEGER, "a" TEXT, "b" TEXT)')
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", [(k, *v) for k, v in OLD.items()] + [(9, "old", "old")])
    con.executemany("INSERT INTO t_stage VALUES (?, ?, ?)", [(k, *v) for k, v in NEW.items()] * 2 + [(9, "new", "new")])
    for _ in range(2):
        con.execute(D.conflict_statement("t", "t_stage", ["k", "a", "b"], ["k"], policy))
    last = ("new", "new") if policy in ("replace", "new_first") else ("old", "old")
    assert {k: (a, b) for k, a, b in con.execute("SELECT * FROM t")} == MERGED[policy] | {9: last}
    with pytest.raises(ValueError, match="policy"):
        D.conflict_statement("t", "s", ["k"], ["k"], "other")


@pytest.mark.parametrize("policy", D.POLICIES)
def test_database_upserts_survive_reruns(spark, policy):
    url, driver, t = "jdbc:derby:memory:masterline;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}, f"up_{policy}"
    D.execute(spark, url, [f'CREATE TABLE "{t}" ("k" BIGINT NOT NULL, "a" VARCHAR(100), "b" VARCHAR(100), PRIMARY KEY ("k"))', D.index_statement(t, ["a"])], driver)
    frame = lambda rows: spark.createDataFrame([(k, *v, i) for i, (k, v) in enumerate(rows)], "k long, a string, b string, at long").repartition(3)
    read = lambda: {r["k"]: (r["a"], r["b"]) for r in D.read_table(spark, url, f'"{t}"', driver).collect()}
    D.upsert_table(frame(list(OLD.items())), url, t, ["k"], "replace", "at", driver, on_conflict=False)
    assert read() == OLD
    new = frame([(3, ("lost", "lost")), (None, ("no", "key")), *NEW.items()])
    for _ in range(2):
        D.upsert_table(new, url, t, ["k"], policy, "at", driver, on_conflict=False)
        assert read() == MERGED[policy]
    half = spark.createDataFrame([(k, *v) for k, v in NEW.items()], "k long, a string, b string")
    D.stage_rows(half, url, f"{t}_stage", driver, marked=True)
    D.stage_rows(half.filter("k < 4"), url, f"{t}_stage", driver, "append", marked=True)
    D.execute(spark, url, [f'DELETE FROM "{t}_once"', *D.merge_statements(t, f"{t}_stage", f"{t}_once", ["k", "a", "b"], ["k"], policy, ["a", "b"])], driver)
    assert read() == MERGED[policy]
    with pytest.raises(Exception, match="(?i)column|token|syntax"):
        D.execute(spark, url, [f'DELETE FROM "{t}"', "UPDATE nothing SET"], driver)
    assert read() == MERGED[policy]


def test_load_command_with_an_enrichment_module(spark, path, tmp_path, capsys):
    (tmp_path / "mine.py").write_text("KNOWN = {'Acme Ltd': '12'}\n\n\ndef facts(row):\n    name = row['normalized_supplier_name']\n    return {'employee_count': KNOWN.get(name, ''), 'supplier_description': 'maker of ' + name}\n")
    root = f"file://{tmp_path}/root"
    asked = ["load", path, "--root", root, "--json", "--enrich-module", str(tmp_path / "mine.py"), "--enrich-function", "facts"]
    assert cli.main([*asked, "--skip-enrich"], spark) == 0
    assert files.published(spark, root, "supplier_attributes").filter("supplier_description IS NOT NULL").count() == 0
    assert cli.main(asked, spark) == 0
    names = files.published(spark, root, "supplier_master").select("global_supplier_id", "normalized_supplier_name")
    got = {r["normalized_supplier_name"]: r["supplier_description"] for r in files.published(spark, root, "supplier_attributes").join(names, "global_supplier_id").collect()}
    assert len(got) == 2 and all(v == f"maker of {k}" for k, v in got.items())
    capsys.readouterr()
    assert cli.main([*asked[:-1], "absent"], spark) == 1 and "no function absent" in capsys.readouterr().err


def test_bulk_and_embed_commands(spark, tmp_path, capsys):
    (tmp_path / "m.csv").write_text("client #,Normalized_Supplier_Name,Supplier_Description\n1,Acme,Steel pipes\n2,Globex,Legal advice\n1,Acme,Later\n")
    path, root, at = f"file://{tmp_path}/m.csv", f"file://{tmp_path}/root", f"file://{tmp_path}/v"
    said = lambda *args: (cli.main([*args, "--json"], spark), json.loads(capsys.readouterr().out))[1]
    assert said("bulk", path, "--dry-run") == {"unique_suppliers": 2, "new_suppliers": 2, "existing_suppliers": 0, "clients": 2}
    for new in (2, 0):
        got = said("bulk", path, "--root", root)
        assert (got["new_suppliers"], got["supplier_master_rows"], got["client_master_rows"]) == (new, 2, 2)
    assert said("embed", "--root", root, "--vectors", at, "--dry-run")["new_vectors"] == 2
    assert [said("embed", "--root", root, "--vectors", at, "--limit", "1")["new_vectors"] for _ in range(3)] == [1, 1, 0]
    assert cli.main(["search", "pipes of steel", "--vectors", at, "--top", "1"], spark) == 0
    assert capsys.readouterr().out.startswith("1. G10001")
