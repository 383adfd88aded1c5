"""Clusters, canonical names, resolvers, categories and vectors."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from masterline.functions.udfs import similarity
from masterline.operators import clusters as G
from masterline.operators import leaders as L
from masterline.operators import taxonomy as X
from masterline.operators import vector_index as VI
from masterline.operators import vectors as V
from masterline.plans.pipelines import normalization_stats, normalize_names

NAMES = ["Acme Tools", "Acme Tools Inc", "ACME TOOLS (India) Pvt Ltd", "Globex", "Globex Corporation", "Zed Foods", "", None, "  "]


def test_leader_clusters_partition_the_names(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    found = G.leader_clusters(df, "n")
    groups = {}
    for r in found.collect():
        groups.setdefault(r["cluster"], set()).add(r["name"])
    assert sorted(map(sorted, groups.values())) == [["ACME TOOLS (India) Pvt Ltd", "Acme Tools", "Acme Tools Inc"], ["Globex", "Globex Corporation"], ["Zed Foods"]]
    status = {r["n_names"]: r["status"] for r in G.confirm(found).collect()}
    assert status == {3: "confirmed", 2: "confirmed", 1: "singleton"}
    names = {r["canonical_name"] for r in G.canonical_names(found, ["block", "cluster"]).collect()}
    assert names == {"Acme Tools", "Globex", "Zed Foods"}
    by_block = G.leader_clusters(df, "n", F.lower(F.substring("name", 1, 1)))
    assert by_block.count() == found.count()


def test_pairs_stay_in_blocks(spark):
    df = spark.createDataFrame([("aa x",), ("aa y",), ("bb x",)], "n string")
    assert [(r["name_a"], r["name_b"]) for r in G.pair_scores(df, "n", F.substring("n", 1, 2)).collect()] == [("aa x", "aa y")]


def test_normalizer_gives_one_result_per_name(spark):
    raw = [*NAMES[:6], "Acme Tools", "12345", "Dr Jane Roe", "Zed Wug"]
    df = spark.createDataFrame(list(enumerate(raw)), "row_index long, name string")
    out = normalize_names(df)
    got = {r["original"]: r for r in out.collect()}
    assert sum(r["count"] for r in got.values()) == 9 and got["Acme Tools"]["count"] == 3 and got["Dr Jane Roe"]["individual"]
    assert got["Globex"]["method"] == "singleton" and got["Globex"]["cluster"] == "S-globex"
    assert got["Zed Foods"]["method"].startswith("resolver")
    assert normalization_stats(out).first()["rows"] == 9


def test_resolver_answers_are_checked(spark):
    df = spark.createDataFrame([(f"zed {c}", f"Zed {c}", False, "zed", 1) for c in "abcd"], "cleaned string, best_original string, individual boolean, block string, n_rows long")
    answer = lambda names: [{"canonical": "Zed", "members": [0, 1, 9], "confidence": "high"}, {"canonical": "No", "members": [1, 2]}]
    got = {r["original"]: (r["normalized"], r["method"]) for r in G.resolve(df, answer).collect()}
    assert got == {"Zed a": ("Zed", "resolver-cluster"), "Zed b": ("Zed", "resolver-cluster"), "Zed c": ("Zed c", "resolver-singleton"), "Zed d": ("Zed d", "resolver-missed")}

    def broken(names):
        raise RuntimeError("model is down")

    assert {(r["normalized"] == r["original"], r["cluster"], r["method"]) for r in G.resolve(df, broken).collect()} == {(True, "ERR", "fallback")}


def test_top_categories(spark):
    cats = spark.createDataFrame([("Office", "Paper", "Copy paper"), ("IT", "Software", "Licences"), ("IT", None, "Laptops")], "l1 string, l2 string, l3 string")
    lines = spark.createDataFrame([("copy paper A4",), ("soft",), (None,)], "d string")
    got = [(r["description"], r["l3"], r["score"], r["rank"]) for r in X.top_categories(lines, "d", cats, 2).orderBy("description", "rank").collect()]
    assert got == [("copy paper A4", "Copy paper", 3.0, 1), ("copy paper A4", "Laptops", 0.0, 2), ("soft", "Licences", 0.5, 1), ("soft", "Laptops", 0.0, 2)]


def test_reassign_takes_the_first_answer(spark):
    lines = spark.createDataFrame([(1, "a", "b", "c"), (2, "a", "b", "c")], "id int, l1 string, l2 string, l3 string")
    answers = spark.createDataFrame([(1, 2, "x", "y", "z"), (1, 1, "p", "q", "r")], "id int, answer int, l1 string, l2 string, l3 string")
    assert sorted(map(tuple, X.reassign(lines, answers, "id").collect())) == [(1, "p", "q", "r"), (2, "a", "b", "c")]


def test_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [0.0, 0.0]), (4, None), (5, [3.0, 0.0])], "k long, embedding array<float>")
    got = [(r["k"], round(r["distance"], 6)) for r in V.top_k(df, [1.0, 0.0], 3, "k").collect()]
    assert got == [(1, 0.0), (5, 0.0), (2, 1.0)]


def test_embed_skips_existing(spark):
    master = spark.createDataFrame([("G1", "Acme"), ("G2", "Globex"), ("G3", " ")], "global_supplier_id string, normalized_supplier_name string")
    facts = spark.createDataFrame([("G1", "tools", None, "", " ", "t")], "global_supplier_id string, supplier_description string, l1_category string, l2_category string, l3_category string, product_service_tags string")
    old = spark.createDataFrame([("global", "G2", "0")], "client_id string, global_supplier_id string, chunk_id string")
    new = V.embed_suppliers(master, facts, old)
    got = {r["global_supplier_id"]: r for r in new.collect()}
    assert set(got) == {"G1", "G3"} and got["G1"]["source_text"] == "Acme tools t" and sum(got["G3"]["embedding"]) == 0
    hit = V.search(new, got["G1"]["embedding"], 1).first()
    assert hit["global_supplier_id"] == "G1" and abs(hit["similarity"] - 1) < 1e-6
    assert V.embed_suppliers(master, facts, new.select("client_id", "global_supplier_id", "chunk_id").unionByName(old)).count() == 0


def test_clusters_do_not_depend_on_parts(spark):
    names = [*NAMES[:6], "The Acme Tools", "Tools Acme", "Globex Corp", "A Globex Corporation", "Zed Food", "The Zed Foods"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    cleaned = sorted((r["n"], r["c"]) for r in df.select("n", G.T.comparison_name(F.col("n")).alias("c")).collect())
    expected = dict(zip([n for n, _ in cleaned], G.lead([n for n, _ in cleaned], [c for _, c in cleaned]), strict=True))
    assert len(set(expected.values())) < len(expected)
    for part in (2, 5, 1000):
        assert {r["name"]: r["cluster"] for r in G.leader_clusters(df, "n", part=part).collect()} == expected


def test_more_than_5000_names_are_compared_across_blocks(spark):
    df = spark.createDataFrame([(f"{k} longestword{i}",) for i in range(2501) for k in ("alpha", "zeta")], "n string")
    found = G.leader_clusters(df, "n")
    assert found.count() == 5002 and found.select("cluster").distinct().count() == 2501


def test_top_categories_by_postings_equal_scoring_all(spark):
    rng = random.Random(4)
    words = "steel steels stainless pipe pipes piping pip office paper papers a of ab abc abcd xyz é日本語 日本語".split()
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    cats = [(text(1), None if i % 5 == 0 else text(2), text(rng.randrange(0, 4))) for i in range(60)] * 2
    lines = [(text(rng.randrange(0, 6)),) for _ in range(40)] + [("none",), (None,), ("",), ("Steel-Pipes, PAPER",)]
    taxonomy = spark.createDataFrame(cats, "l1 string, l2 string, l3 string")
    tokens = lambda t: set(re.split(r"[^\w]+", t.lower()))

    def score(d, c):
        c = tokens(" ".join(x or "" for x in c))
        return 0.0 + sum(float(x in c) + 0.5 * sum(len(y) > 2 and (x in y or y in x) for y in c) for x in tokens(d) if len(x) > 2)

    for k in (3, 25, 100):
        want = []
        for (d,) in set(lines) - {(None,)}:
            best = sorted(set(cats), key=lambda c: (-score(d, c), *((x is not None, x or "") for x in c)))[:k]
            want += [(d, *c, score(d, c), r) for r, c in enumerate(best, 1)]
        got = X.top_categories(spark.createDataFrame(lines, "d string"), "d", taxonomy, k)
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and "Cartesian" not in plan
    assert X.top_categories(spark.createDataFrame([], "d string"), "d", taxonomy).count() == 0
    assert X.top_categories(spark.createDataFrame(lines, "d string"), "d", taxonomy.limit(0)).count() == 0


def test_repeated_rows_do_not_count_against_the_taxonomy(spark):
    cats = spark.range(50_001).selectExpr("'Office' AS l1", "'Paper' AS l2", "concat('kind', id % 3) AS l3")
    lines = spark.createDataFrame([("paper kind1",)], "d string")
    assert [r["l3"] for r in X.top_categories(lines, "d", cats, 1).collect()] == ["kind1"]


def made_names(seed, n):
    """Names of few words, so that all ways to be alike come up: overlap, subsets, longest words, abbreviations, ties."""
    rng = random.Random(seed)
    words = "acme global steel works tools trading mumbai northern southern industrial in co ab cd ef io ibm international business machines food foods zed zeta a b".split()
    made = {" ".join(rng.choice(words) + rng.choice(["", "", "", "s", "x"]) for _ in range(rng.randrange(1, 6))) for _ in range(n)}
    made |= {x.upper() for x in rng.sample(sorted(made), n // 10)} | {f"{x} Inc." for x in rng.sample(sorted(made), n // 10)}
    return sorted(made | {"I.B.M.", "i b m", "AB CD", "Ab-Ce", "ab, ce", "GE", "General Electric", "Gen Elec", "É É", "..."})


def led(spark, names):
    cleans = {r["n"]: r["c"] for r in spark.createDataFrame([(n,) for n in names], "n string").select("n", G.T.comparison_name(F.col("n")).alias("c")).collect()}
    return cleans, dict(zip(names, G.lead(names, [cleans[n] for n in names]), strict=True))


@pytest.mark.parametrize("seed,n,part", [(1, 300, 50_000), (2, 500, 7)])
def test_leader_clusters_equal_all_pairs(spark, seed, n, part):
    names = made_names(seed, n)
    cleans, want = led(spark, names)
    df = spark.createDataFrame([(x,) for x in names], "n string").repartition(3)
    assert {r["name"]: r["cluster"] for r in G.leader_clusters(df, "n", part=part).collect()} == want
    reps = L.representatives(L.classes(df.select(F.lit("all").alias("block"), F.col("n").alias("name"))))
    assert all(r["clean"] == cleans[r["name"]] for r in reps.collect())


def test_leader_clusters_in_blocks_equal_all_pairs(spark):
    names = made_names(5, 250)
    df = spark.createDataFrame([(x,) for x in names], "n string")
    got = G.leader_clusters(df, "n", F.substring("name", 1, 1)).collect()
    assert len(got) == len(names)
    for block in {r["block"] for r in got}:
        assert {r["name"]: r["cluster"] for r in got if r["block"] == block} == led(spark, [n for n in names if n[0] == block])[1]


def test_bounds_of_likeness_hold():
    names = made_names(9, 120)
    for a in names:
        for b in names:
            c, d = (" ".join(x.lower().replace(".", " ").replace(",", " ").split()) for x in (a, b))
            if c and d and c != d:
                score = similarity(a, b, c, d)
                for floor in (0.65, 0.8):
                    assert L.bounded_similarity(a, b, c, d, floor)[0] == (score if score >= floor else 0.0)
                if score >= 0.65:
                    assert {t for t in c.split() if len(t) > 1} & {t for t in d.split() if len(t) > 1}


def test_pointer_forest_of_long_chains_and_ties(spark):
    n = 300
    reps = spark.createDataFrame([(i, i, "all", "even" if i % 2 == 0 and i > 250 else None) for i in range(1, n + 1)], "id long, first long, block string, longest string")
    chain = [(i, i - 1, 0.9) for i in range(3, 201)] + [(i, i - 1, 0.9) for i in range(203, 250)] + [(249, 5, 0.9), (249, 7, 0.7), (260, 150, 0.8), (270, 202, 0.8)]
    scored = spark.createDataFrame(chain, "x long, p long, score double")
    for part in (4,):
        got = {r["first"]: r["leader"] for r in L.leaders(reps, scored, part, 0.65).collect()}
        assert all(got[i] == 2 for i in range(2, 201)) and got[1] == 1 and got[201] == 201 and all(got[i] == 202 for i in range(202, 249))
        assert got[249] == 2 and got[252] == 252 and got[254] == got[258] == 252 and all(got[i] == 2 for i in range(260, 301, 2)) and got[251] == 251


def test_mean_likeness_of_a_large_cluster_in_parts(spark):
    names = made_names(11, 60)
    cleans, _ = led(spark, names)
    rows = [("all", 0, x) for x in names] + [("all", 1, "alone"), ("b", 0, "Acme"), ("b", 0, "Acme Ltd")]
    scores = [similarity(a, b, cleans[a], cleans[b]) for i, a in enumerate(names) for b in names[i + 1 :]]
    for part in (7, 1000):
        got = {(r["block"], r["cluster"]): r["mean_similarity"] for r in G.mean_similarities(spark.createDataFrame(rows, "block string, cluster int, name string"), part).collect()}
        assert set(got) == {("all", 0), ("b", 0)} and abs(got["all", 0] - sum(scores) / len(scores)) < 1e-12 and got["b", 0] == 1.0


def test_vector_index(spark, sf, tmp_path):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").repartition(3)
    odd = spark.createDataFrame([(-1, None), (-2, [0.0] * 64), (-3, [1.0, 2.0])], "vec_id long, embedding array<float>")
    at, lists = f"file://{tmp_path}/index", 8
    VI.build_index(rows.unionByName(odd), at, lists, "vec_id")
    stored = spark.read.parquet(f"{at}/lists")
    assert stored.count() == rows.count() + 1 and stored.select("list").distinct().count() == lists
    queries = rows.filter("vec_id % 10 = 0").unionByName(odd)
    exact = {}
    for q in queries.collect():
        if q["embedding"] is not None and len(q["embedding"]) == 64 and any(q["embedding"]):
            exact[q["vec_id"]] = [r["vec_id"] for r in V.top_k(rows, q["embedding"], 5, "vec_id").collect()]

    def found(probes):
        out = {}
        for r in VI.search_many(spark, at, queries, 5, probes, "vec_id", "vec_id").orderBy("query", "rank").collect():
            out.setdefault(r["query"], []).append(r["key"])
        return out

    assert found(lists) == exact
    recall = lambda some: sum(len(set(some[q]) & set(exact[q])) for q in exact) / (5 * len(exact))
    assert recall(found(7)) >= 0.95
    one = rows.filter("vec_id = 0").first()["embedding"]
    near = VI.search_index(spark, at, one, 5, 2, "vec_id")
    assert near.first()["vec_id"] == 0 and "PartitionFilters: [list" in near._jdf.queryExecution().executedPlan().toString()
    assert [r["vec_id"] for r in VI.search_index(spark, at, one, 5, lists, "vec_id").collect()] == exact[0]
    VI.build_index(rows.limit(0), f"{at}-none", lists, "vec_id")


def test_vector_index_finds_groups_in_few_lists(spark, tmp_path):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(20, 16))
    x = np.repeat(centers, 30, axis=0) + rng.normal(scale=0.2, size=(600, 16))
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(3)
    VI.build_index(rows, f"file://{tmp_path}/index", 20, "vec_id", sample=300)
    near = lambda probes: {(r["query"], r["key"]) for r in VI.search_many(spark, f"file://{tmp_path}/index", rows.filter("vec_id % 20 = 0"), 5, probes, "vec_id", "vec_id").collect()}
    exact, some = near(20), near(2)
    assert len(exact) == 150 and len(exact & some) >= 0.95 * len(exact)
