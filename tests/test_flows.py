"""Whole flows: files to tables, uploads with known results, refresh, publishing, streams."""

import os

import pytest
from pyspark.sql import functions as F

from masterline.functions.udfs import hash_embedding
from masterline.plans import pipelines as P
from masterline.plans.schemas import MASTER_FILE, empty
from masterline.sources import files
from masterline.streaming import ingest

MAPPING = {"Vendor Name": "supplier_name_normalized", "Supplier Name": "supplier_name_normalized", "Supplier ID": "supplier_id", "PO Number": "po_number", "Amount": "amount", "Quantity": "quantity", "Currency": "currency", "Client ID": "client_id"}
REQUIRED = ["client_id", "supplier_id", "supplier_name_normalized", "amount"]


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return f"file://{path}"


def state(spark):
    return {n: empty(spark, n) for n in ("supplier_master", "supplier_attributes", "client_master", "supplier_crosswalk")}


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


FILE = """Vendor Name,Supplier ID,Invoice Amount,Currency,Memo
"Acme ""Best"", Inc",S1,"1,234.56",USD,"paper
towels"
N/A,S2,5,USD,x
ACME "best" inc,S1, 12 ,EUR,
12,S3,abc,USD,y
,S4,1,USD,z
Globex,S5,7
"""


def test_transaction_file(spark, tmp_path):
    df = files.read_csv(spark, write(tmp_path / "t.csv", FILE))
    got = files.read_transactions(df)
    assert rows(got, "supplier_name_raw", "supplier_name_normalized", "supplier_id", "currency") == [
        ("12", "12", "S3", "USD"), ('ACME "best" inc', 'acme "best" inc', "S1", "EUR"), ('Acme "Best", Inc', 'acme "best", inc', "S1", "USD"), ("Globex", "globex", "S5", None),
    ]
    assert {r["supplier_name_raw"]: None if r["amount"] is None else float(r["amount"]) for r in got.collect()} == {"12": None, 'ACME "best" inc': 12, 'Acme "Best", Inc': 1234.56, "Globex": 7}
    with pytest.raises(ValueError, match="no supplier name"):
        files.read_transactions(df.select("Currency"))


def test_load_twice_changes_nothing(spark, tmp_path):
    lines = files.read_transactions(files.read_csv(spark, write(tmp_path / "t.csv", FILE)))
    assert P.load_counts(lines, state(spark)).first().asDict() == {"rows_read": 4, "raw_names": 4, "unique_suppliers": 4, "new_suppliers": 4, "existing_suppliers": 0}
    first = P.load_transactions(lines, "acme", None, state(spark))
    keep = {n: spark.createDataFrame(df.collect(), df.schema) for n, df in first.items()}
    assert rows(keep["supplier_master"], "global_supplier_id", "normalized_supplier_name") == [("G10001", 'acme "best", inc'), ("G10002", 'acme "best" inc'), ("G10003", "12"), ("G10004", "globex")]
    assert rows(keep["supplier_crosswalk"], "supplier_id", "global_supplier_id") == [("S1", "G10002"), ("S3", "G10003"), ("S5", "G10004")]
    assert rows(keep["client_master"], "client_id", "client_name") == [("acme", "Unknown")]
    again = P.load_transactions(lines, "acme", "Acme Client", keep)
    for n in ("supplier_master", "supplier_crosswalk"):
        assert sorted(map(repr, again[n].collect())) == sorted(map(repr, keep[n].collect()))
    assert rows(again["client_master"], "client_name") == [("Acme Client",)]
    assert P.load_counts(lines, keep).first()["existing_suppliers"] == 4
    matches, new = P.proposals(__import__("masterline.operators.suppliers", fromlist=["x"]).match_or_assign(lines.select("supplier_name_normalized", "row_index"), keep["supplier_master"].limit(1), "supplier_name_normalized", [F.col("row_index")]))
    assert matches.count() + new.count() == 4


def test_enrichment_never_erases(spark):
    lines = spark.createDataFrame([(0, "A", "a", "1", None, None, None)], "row_index long, supplier_name_raw string, supplier_name_normalized string, supplier_id string, amount decimal(18,4), currency string, item_description string")
    with_text = lambda text: lambda named: named.select("global_supplier_id", F.lit(text).alias("supplier_description"))
    one = P.load_transactions(lines, "c", "C", state(spark), enrich=with_text("tools"))
    one = {n: spark.createDataFrame(df.collect(), df.schema) for n, df in one.items()}
    two = P.load_transactions(lines, "c", None, one, enrich=with_text(""))
    assert rows(two["supplier_attributes"], "supplier_description") == [("tools",)] and rows(two["client_master"], "client_name") == [("C",)]


def test_bulk_load(spark, tmp_path):
    text = "client #,Normalized_Supplier_Name,Supplier_Description,LI,L2,L3\nacme,Globex,firstNaN,IT,,x\nacme,Acme,Unknown,,,\nbeta,Globex,second,,,\nacme,NaN,q,,,\n"
    df = files.read_csv(spark, write(tmp_path / "b.csv", text))
    s = state(spark)
    s["supplier_master"] = spark.createDataFrame([("G10007", "acme", None)], s["supplier_master"].schema)
    s["client_master"] = spark.createDataFrame([("acme", "Known", None, None)], s["client_master"].schema)
    out = P.bulk_load(df, s)
    assert rows(out["supplier_master"], "global_supplier_id", "normalized_supplier_name") == [("G10007", "Acme"), ("G10008", "Globex")]
    assert rows(out["supplier_attributes"], "global_supplier_id", "supplier_description", "l1_category") == [("G10007", None, None), ("G10008", "first", "IT")]
    assert rows(out["client_master"], "client_id", "client_name") == [("acme", "Known"), ("beta", "Unknown")]


OLD = """client_id,po_number,supplier_id,amount,currency,Vendor Name
client_acme,PO-1,S100782,15000.00,USD,Staples Inc
client_acme,PO-2,S100783,8200.50,USD,International Business Machines
client_acme,PO-3,S100782,3200.00,USD,Staples Inc
"""
NEW = """client_id,po_number,supplier_id,amount,currency,quantity,supplier_name_normalized
acme,PO-1,100782,15000.00,USD,40,Staples Inc
acme,PO-2,100782,20000.00,USD,50,Staples Inc
acme,PO-3,100782,10000.00,USD,30,Staples Inc
acme,PO-4,100891,28000.00,USD,50,Amazon Business
acme,PO-5,,1,USD,1,Lost
"""


def test_two_uploads(spark, tmp_path):
    none = {"transactions": spark.createDataFrame([], "upload_id string"), "suppliers": spark.createDataFrame([], "canonical_supplier_id string, normalized_supplier_name string, name_key string")}
    one = P.staged_upload(files.read_csv(spark, write(tmp_path / "o.csv", OLD)), MAPPING, REQUIRED, none, "u1")
    kept = {n: spark.createDataFrame(one[n].collect(), one[n].schema) for n in ("transactions", "suppliers")}
    two = P.staged_upload(files.read_csv(spark, write(tmp_path / "n.csv", NEW)), MAPPING, REQUIRED, kept, "u2")
    assert rows(two["suppliers"], "canonical_supplier_id", "normalized_supplier_name") == [("SUP-00001", "Staples Inc"), ("SUP-00002", "International Business Machines"), ("SUP-00003", "Amazon Business")]
    assert rows(two["crosswalk"], "client_id", "supplier_id", "canonical_supplier_id", "match_method", "match_confidence", "matched_on") == [("acme", "100782", "SUP-00001", "exact_name_key", 1.0, "name_key"), ("acme", "100891", "SUP-00003", "exact_name_key", 1.0, "name_key")]
    totals = two["supplier_totals"].filter("client_id = 'acme'").withColumn("s", F.col("total_spend").cast("double")).withColumn("q", F.col("total_quantity").cast("double"))
    assert rows(totals, "supplier_id", "supplier_name_normalized", "s", "q") == [("100782", "Staples Inc", 45000.0, 120.0), ("100891", "Amazon Business", 28000.0, 50.0)]
    assert rows(two["rejects"], "error_message") == [("missing required columns: supplier_id",)]
    assert two["transactions"].count() == 7
    kept = {n: spark.createDataFrame(two[n].collect(), two[n].schema) for n in ("transactions", "suppliers")}
    again = P.staged_upload(files.read_csv(spark, f"file://{tmp_path}/n.csv"), MAPPING, REQUIRED, kept, "u2")
    assert again["transactions"].count() == 7 and again["suppliers"].count() == 3
    lost = P.staged_upload(files.read_csv(spark, write(tmp_path / "l.csv", "client_id,amount\nacme,1\n")).withColumn("supplier_name_normalized", F.lit("x")).withColumn("supplier_id", F.lit(None).cast("string")), MAPPING, [*REQUIRED, "po_date"], none, "u3")
    assert rows(lost["rejects"], "error_message") == [("missing required columns: supplier_id, po_date",)]


def test_refresh_master(spark):
    lines = [("1", "Acme Tools", "steel hammer"), ("1", "Acme Tools Inc", "steel nails"), ("2", "Globex", "123"), ("2", "Globex", "software licence"), ("2", "Globex", "456-7"), ("3", "nan", "x"), ("4", "Initech", "software support")]
    lines = spark.createDataFrame([(i, *r) for i, r in enumerate(lines)], "row_index long, supplier_number string, supplier_name string, item_description string")
    countries = spark.createDataFrame([("1", "US", 0), ("1", "France", 1), ("2", "nan", 2)], "supplier_number string, country string, row_index int")
    cats = spark.createDataFrame([("Goods", "Hardware", "Steel hammer"), ("IT", "Software", "Licence")], "l1 string, l2 string, l3 string")
    old = {"Normalized_Supplier_Name": "Acme Tools", "Original_Name_Variants": "ACME", "Overall_Category": "Goods", "Total_PO_Items": 5, "Ship_To_Countries": "Unknown", "Country_Codes": ""}
    names = [x.split(" ")[0] for x in MASTER_FILE.split(", ")]
    master = spark.createDataFrame([tuple(old.get(n, "keep" if n != "Total_PO_Items" else 0) for n in names)], MASTER_FILE)
    got = {r["Normalized_Supplier_Name"]: r for r in P.refresh_master(lines, countries, cats, master, today=F.lit("2026-01-02").cast("date")).collect()}
    assert list(got) == ["Acme Tools", "Globex", "Initech"]
    acme = got["Acme Tools"]
    assert (acme["Total_PO_Items"], acme["Ship_To_Countries"], acme["Country_Codes"], acme["Original_Name_Variants"], acme["Supplier_Description"], acme["Last_Updated"]) == (7, "France", "FR", "ACME; Acme Tools; Acme Tools Inc", "keep", "2026-01-02")
    assert got["Initech"]["Overall_Category"] == "IT > Software > Licence" and got["Globex"]["Total_PO_Items"] == 3 and got["Globex"]["Country_Codes"] == "XX"


def test_encodings_and_names(spark, tmp_path):
    assert files.read_csv_any(spark, write(tmp_path / "l.csv", "Name\nCafé\n", "latin-1")).first()[0] == "Café"
    assert files.read_csv_any(spark, write(tmp_path / "u.csv", "Name\nCafé\n")).first()[0] == "Café"
    path = write(tmp_path / "n.csv", "id,Vendor\n1,Acme\n2\n")
    assert [r["name"] for r in files.read_names(spark, path).collect()] == ["Acme", ""] == [r["name"] for r in files.read_names(spark, path, index=1).collect()]
    with pytest.raises(ValueError, match="no column"):
        files.read_names(spark, path, column="zzz")


def test_publish_and_log(spark, tmp_path):
    root = f"file://{tmp_path}/db"
    files.publish({"t": spark.range(3)}, root)
    now = files.published(spark, root, "t")
    files.publish({"t": now.filter("id > 0")}, root)
    assert files.published(spark, root, "t").count() == 2
    log = f"file://{tmp_path}/log"

    def fail(_):
        raise ValueError("disk")

    with pytest.raises(ValueError, match="disk"):
        P.run_staged(spark, log, "r1", [("parse", lambda _: spark.range(4)), ("write", fail), ("later", lambda _: spark.range(1))])
    assert rows(files.read_log(spark, log), "stage", "status", "row_count", "error_message") == [("parse", "ok", 4, None), ("write", "error", 0, "disk")]
    assert files.read_config(spark, write(tmp_path / "c.json", '{"a":\n 1}')) == {"a": 1}


def test_exports(spark, tmp_path):
    r = spark.createDataFrame([('a "x"', "a", True, "C-1", "high", "m", 2)], "original string, normalized string, individual boolean, cluster string, confidence string, method string, count long")
    path = f"file://{tmp_path}/out"
    files.write_csv(files.full_export(r), path, single=True)
    assert files.read_csv(spark, path).first().asDict() == {"original": 'a "x"', "normalized": "a", "individual": "Yes", "cluster": "C-1", "confidence": "high", "method": "m", "count": "2"}
    assert files.mapping_export(r).columns == ["original", "normalized", "confidence"]


def test_upload_folder_and_stream(spark, tmp_path):
    root = tmp_path / "up"
    write(root / "acme" / "a.csv", "po,amount\n1,5\n2,6\n")
    write(root / "beta" / "b.csv", "po,amount\n3,7\n")
    assert rows(files.read_uploads(spark, f"file://{root}"), "po", "upload_client_id", "file_name") == [("1", "acme", "a.csv"), ("2", "acme", "a.csv"), ("3", "beta", "b.csv")]
    for _ in range(2):
        ingest.ingest(ingest.upload_stream(spark, f"file://{root}", "po string, amount string"), f"file://{tmp_path}/t", f"file://{tmp_path}/cp").awaitTermination()
    assert rows(spark.read.parquet(f"file://{tmp_path}/t"), "po", "upload_client_id") == [("1", "acme"), ("2", "acme"), ("3", "beta")]
    write(root / "beta" / "c.csv", "po,amount\n4,7\n")
    ingest.ingest(ingest.upload_stream(spark, f"file://{root}", "po string, amount string"), f"file://{tmp_path}/t", f"file://{tmp_path}/cp").awaitTermination()
    assert spark.read.parquet(f"file://{tmp_path}/t").count() == 4


def test_hash_embedding_is_unit_or_zero(spark):
    got = [r[0] for r in spark.createDataFrame([("a b c",), ("",), (None,)], "t string").select(hash_embedding("t")).collect()]
    assert [round(sum(x * x for x in v), 4) for v in got] == [1, 0, 0]


def test_ids_go_on_from_batch_to_batch(spark, tmp_path):
    schema, parts = "vendor string, po string", {"acme/a.csv": ["Zeta", "alpha ", "", "Zeta"], "acme/b.csv": ["ALPHA", "Mid", "Beta"], "beta/c.csv": ["beta", "New", "zeta"]}
    for name, vendors in parts.items():
        write(tmp_path / "up" / name, "vendor,po\n" + "".join(f"{v},{name}{i}\n" for i, v in enumerate(vendors)))

    def run(name, files_at_once):
        at = [f"file://{tmp_path}/{name}-{x}" for x in ("state", "target", "cp")]
        stream = ingest.upload_stream(spark, f"file://{tmp_path}/up", schema, "file", files_at_once)
        ingest.assign_ids(stream, *at, "vendor", "file").awaitTermination()
        return at, {r["po"]: (r["global_supplier_id"], r["is_new"]) for r in spark.read.parquet(at[1]).collect()}

    _, whole = run("one", None)
    assert {po: g for po, (g, _) in whole.items()} == {
        "acme/a.csv0": "G10002", "acme/a.csv1": "G10001", "acme/a.csv2": None, "acme/a.csv3": "G10002", "acme/b.csv0": "G10001", "acme/b.csv1": "G10004", "acme/b.csv2": "G10003",
        "beta/c.csv0": "G10003", "beta/c.csv1": "G10005", "beta/c.csv2": "G10002",
    }
    for mtime, name in enumerate(parts):
        os.utime(tmp_path / "up" / name, (1_700_000_000 + 100 * mtime,) * 2)
    at, cut = run("cut", 1)
    assert {po: g for po, (g, _) in cut.items()} == {po: g for po, (g, _) in whole.items()}
    assert spark.read.parquet(at[1]).select("batch_id").distinct().count() == 3
    assert {po for po, (_, new) in cut.items() if new} == {"acme/a.csv0", "acme/a.csv1", "acme/a.csv3", "acme/b.csv1", "acme/b.csv2", "beta/c.csv1"}
    # the last batch is run again, as after a failure before it was committed
    commits = sorted((tmp_path / "cut-cp" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for x in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        x.unlink(missing_ok=True)
    assert run("cut", 1)[1] == cut and spark.read.parquet(at[0]).count() == 5


def test_run_log_of_streams_without_calls(spark, tmp_path):
    write(tmp_path / "up" / "acme" / "a.csv", "po\n1\n2\n")
    log = f"file://{tmp_path}/log"
    stream = ingest.upload_stream(spark, f"file://{tmp_path}/up", "po string")
    with ingest.RunLogListener(spark, log):
        ingest.ingest(stream, f"file://{tmp_path}/t", f"file://{tmp_path}/cp").awaitTermination()
        failing = stream.writeStream.foreachBatch(lambda batch, _: batch.select(F.raise_error(F.lit("broken"))).collect()).option("checkpointLocation", f"file://{tmp_path}/cp2").trigger(availableNow=True).start()
        with pytest.raises(Exception, match="broken"):
            failing.awaitTermination()
    got = files.read_log(spark, log).collect()
    by_run = {}
    for r in got:
        by_run.setdefault(r["run_id"], []).append((r["stage"], r["status"], r["row_count"]))
    assert sorted(map(sorted, by_run.values())) == [[("batch 0", "ok", 2), ("end", "ok", None), ("start", "ok", None)], [("end", "error", None), ("start", "ok", None)]]
    assert any("broken" in (r["error_message"] or "") for r in got)
