"""External models, the rate limiter, confirmation and consolidation."""

import time

import pytest
from pyspark.sql import functions as F

from masterline.operators import budget as B
from masterline.operators import clusters as G
from masterline.operators import models as M
from masterline.operators import taxonomy as X
from masterline.operators.budget import CallBudget


def test_rate_limiter_allows_so_many_in_any_minute():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    limiter = M.RateLimiter(3, lambda: now[0], sleep)
    for at in (0, 10, 20):
        now[0] = at
        limiter.wait()
    assert slept == []
    now[0] = 30
    limiter.wait()  # the first call was 30 seconds ago
    assert slept == [30] and now[0] == 60
    now[0] = 200
    limiter.wait()
    assert slept == [30]


def test_enrich_takes_defaults_for_blank_missing_and_failing(spark):
    def model(row):
        return {"a": {"description": "good", "employee_count": 5, "confidence": "x"}, "b": {"description": " ", "revenue": ""}, "c": None, "d": ["odd"]}[row["name"]]

    df = spark.createDataFrame([(x,) for x in "abcde"], "name string")
    got = {r["name"]: tuple(r)[1:] for r in M.enrich(df, model, per_minute=1000).collect()}
    none = ("Not available", "Unknown", "Unknown", "Unknown", 0.0)
    assert got["a"] == ("good", "5", "Unknown", "Unknown", 0.0) and got["c"] == got["d"] == got["e"] == none
    assert M.enrich(df.limit(0)).count() == 0


def test_product_tags_draws_and_shows_a_bounded_number(spark):
    lines = [("s", f" item {i} ") for i in range(130)] * 2 + [("t", "nan"), ("t", None), ("u", "copy paper"), ("u", "paper clips")]
    df = spark.createDataFrame(lines, "supplier string, d string")
    got = {r["supplier"]: r for r in M.product_tags(df, "supplier", "d").collect()}
    assert set(got) == {"s", "u"} and got["s"]["n_drawn"] == 100 and got["u"]["tags"] == ["paper", "clips", "copy"]


def test_classify_refuses_invented_paths(spark):
    cats = spark.createDataFrame([("Office", "Paper", "Copy paper"), ("IT", "Software", "Licences")], "l1 string, l2 string, l3 string")
    df = spark.createDataFrame([("copy paper",), ("soft licences",), (None,)], "d string")
    got = {r["description"]: (r["l3"], r["confidence"]) for r in M.classify(df, "d", cats).collect()}
    assert got["copy paper"] == ("Copy paper", 1.0) and got["soft licences"][0] == "Licences"
    odd = {r["description"]: r for r in M.classify(df, "d", cats, lambda row: {"l1": "x", "l2": "y", "l3": "z", "confidence": 1.0}).collect()}
    assert odd["copy paper"]["l3"] == "Unclassified" and odd["copy paper"]["confidence"] == 0


LINES = [(1, "s", "blue pen", "O", "P", "Pens", 0.9), (2, "s", "red pen", "O", "P", "Pens", 0.8), (3, "s", "pen blue", "X", "Y", "Odd", 0.2), (4, "s", "crane hire", "X", "Y", "Odd", 0.1), (5, "t", "pen", "X", "Y", "Odd", 0.1), (6, "s", None, "X", "Y", "Odd", None)]
SCHEMA = "id long, supplier string, d string, l1 string, l2 string, l3 string, confidence double"


def test_consolidate(spark):
    df = spark.createDataFrame(LINES, SCHEMA)
    got = {r["id"]: r["l3"] for r in M.consolidate(df, "supplier", "id", "d").collect()}
    assert got == {1: "Pens", 2: "Pens", 3: "Pens", 4: "Odd", 5: "Odd", 6: "Odd"}

    def broken(row):
        raise ValueError

    assert sorted(map(str, M.consolidate(df, "supplier", "id", "d", broken).collect())) == sorted(map(str, df.collect()))
    assert {r["supplier"]: (r["n_categories"], r["n_low"]) for r in X.classification_counts(df, "supplier").collect()} == {"s": (2, 3), "t": (1, 1)}


def test_only_the_first_low_lines_are_reviewed(spark):
    rows = [(0, "s", "x", "a", "b", "c", 1.0)] + [(i, "s", "y", "d", "e", "f", 0.1) for i in range(1, 61)]
    every = lambda row: {"reassignments": [{"item_id": i, "to_category_id": 0} for i in range(len(row["items"]))]}
    got = M.consolidate(spark.createDataFrame(rows, SCHEMA), "supplier", "id", "d", every)
    assert got.filter("l3 = 'c' AND id > 0").count() == 50 and got.filter("l3 = 'c'").agg(F.max("id")).first()[0] == 50


def test_confirmation_of_ambiguous_clusters(spark):
    found = spark.createDataFrame([("b", 0, "Acme Ltd"), ("b", 0, "Acme Pvt Ltd India"), ("b", 1, "Globex"), ("b", 1, "Initech"), ("b", 2, "Solo")], "block string, cluster int, name string")
    status = spark.createDataFrame([("b", 0, "ambiguous"), ("b", 1, "ambiguous"), ("b", 2, "singleton")], "block string, cluster int, status string")
    got = {r["name"]: r["canonical_name"] for r in M.confirm_clusters(found, status).collect()}
    assert got == {"Acme Ltd": "Acme", "Acme Pvt Ltd India": "Acme", "Globex": "Globex", "Initech": "Initech", "Solo": "Solo"}
    unanswered = {r["name"]: r["canonical_name"] for r in M.confirm_clusters(found, status, lambda row: {"results": []}).collect()}
    assert unanswered["Acme Ltd"] == "Acme Ltd"

    def broken(row):
        raise ValueError

    failed = {r["name"]: r["canonical_name"] for r in M.confirm_clusters(found, status, broken).collect()}
    assert failed["Initech"] == failed["Globex"] == "Globex"


def test_singletons_that_begin_alike_have_keys_of_their_own(spark):
    df = spark.createDataFrame([(f"international widgets {x}", f"International Widgets {x}", False, 1) for x in "ab"], "cleaned string, best_original string, individual boolean, n_rows long")
    got = G.singletons(df).collect()
    assert len({r["cluster"] for r in got}) == 1 and len({r["cluster_key"] for r in got}) == 2


@pytest.mark.parametrize("model", [lambda row: None, lambda row: {"tags": "one"}])
def test_odd_answers(spark, model):
    df = spark.createDataFrame([("u", "x")], "supplier string, d string")
    assert M.product_tags(df, "supplier", "d", model).count() == 1


def test_one_budget_for_all_tasks(spark):
    with CallBudget(spark, 6, 2.0) as budget:
        def model(row):
            return {"at": time.time()}

        rows = M.answered(spark.range(16).repartition(4), model, {"at": ("double", 0.0), "error": ("string", "")}, budget=budget)
        got = rows.collect()
    at = sorted(r["at"] for r in got)
    assert len(at) == 16 and all(r["error"] == "" for r in got)
    assert all(b - a > 1.5 for a, b in zip(at, at[6:], strict=False)) and at[-1] - at[0] < 12


def test_budget_grants_times_in_order():
    grants = B._Grants(3, 10.0, b"key")
    assert [grants.next_wait(t) for t in (0.0, 1.0, 1.0, 1.0, 2.0, 30.0)] == [0.0, 0.0, 0.0, 9.0, 9.0, 0.0]
    grants.listener.close()
    with pytest.raises(ValueError, match="one call"):
        CallBudget(None, 0)


def test_transport_limits_and_repeats():
    calls = []

    def model(row):
        calls.append(row["n"])
        if row["n"] == 1 and len(calls) < 3:
            raise RuntimeError("busy")
        if row["n"] == 2:
            time.sleep(1)
        return {"x": row["n"]}

    ask = M.Transport(model, seconds=0.2, retries=3, pause=0.01)
    assert ask({"n": 0}) == {"x": 0} and ask({"n": 1}) == {"x": 1} and calls == [0, 1, 1]
    with pytest.raises(TimeoutError, match="0.2 s"):
        M.Transport(model, 0.2, 2, 0.01)({"n": 2})
    assert calls[3:] == [2, 2]


def test_failures_are_told(spark):
    def model(row):
        raise RuntimeError("no network")

    got = M.answered(spark.range(1), model, {"x": ("string", "none"), "error": ("string", "")}).first()
    assert (got["x"], got["error"]) == ("none", "RuntimeError: no network")
