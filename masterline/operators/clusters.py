"""Similar names: pairs inside blocks, leader clusters, canonical names, resolver batches."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masterline.functions import text as T
from masterline.functions.udfs import name_similarity, similarity
from masterline.operators.ids import batches
from masterline.operators.leaders import cluster_numbers
from masterline.operators.tables import lookup
from masterline.sources.scratch import kept

THRESHOLD = 0.65
CONFIRMED = 0.85
#: Names of a range, over which the least leader of a group is taken by one task.
PART = 50_000
#: Names of a part of a cluster; each pair of parts is one task's work where all its names are compared.
MEAN_PART = 500
#: Most tasks that the batches of a resolver are dealt to.
BATCH_TASKS = 1_000


def token_jaccard(a: Column, b: Column) -> Column:
    """Share of common tokens; 0 if either has none."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)).cast("double") / union).otherwise(0.0)


def pair_scores(names: DataFrame, name: str, block: Column) -> DataFrame:
    """name_a < name_b with their likeness, for pairs that share a block: an equi-join, no cross join."""
    side = lambda s: names.select(F.col(name).alias(f"name_{s}"), T.comparison_name(F.col(name)).alias(f"clean_{s}"), block.alias("block"))
    pairs = side("a").join(side("b"), "block").filter("name_a < name_b")
    return pairs.select("block", "name_a", "name_b", name_similarity("name_a", "name_b", "clean_a", "clean_b").alias("similarity"))


def lead(names: list[str], cleans: list[str], threshold: float = THRESHOLD) -> list[int]:
    """Cluster number of each name, in order: that of the most similar earlier name if similar enough, else a new one."""
    of: list[int] = []
    for i, (n, c) in enumerate(zip(names, cleans, strict=True)):
        best, score = -1, 0.0
        for j in range(i):
            s = similarity(n, names[j], c, cleans[j])
            if s > score or s == score and best >= 0 and of[j] < of[best]:
                best, score = j, s
        of.append(of[best] if best >= 0 and score >= threshold else max(of, default=-1) + 1)
    return of


def leader_clusters(names: DataFrame, name: str, block: Column | None = None, threshold: float = THRESHOLD, part: int = PART) -> DataFrame:
    """block, cluster, name: names sorted, each joins the cluster of its most similar predecessor in the block.

    The same clusters, numbered alike, as lead() gives block by block; without a block column all names are one. Only
    pairs that can reach the threshold, 0.65 or more, are scored, and no task gets a block whole, see operators.leaders.
    Null and blank names are left out.
    """
    of = F.lit("all") if block is None else block
    return cluster_numbers(names.select(F.col(name).alias("name")).filter(T.strip(F.coalesce("name", F.lit(""))) != "").select(of.alias("block"), "name"), threshold, part)


def mean_similarities(clusters: DataFrame, part: int = MEAN_PART) -> DataFrame:
    """block, cluster, mean_similarity of all pairs of clusters(block, cluster, name) with two names or more.

    A cluster is dealt into parts of about `part` names, each two of which meet in a task that hands on a sum.
    """
    sizes = clusters.groupBy("block", "cluster").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    sizes = sizes.select(F.struct("block", "cluster").alias("_key"), F.ceil(F.col("_n") / part).cast("int").alias("_parts"))
    dealt = lookup(clusters.select(F.struct("block", "cluster").alias("_key"), "name", T.comparison_name(F.col("name")).alias("clean")), "_key", sizes).filter("_parts IS NOT NULL")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("name"), "_parts").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    kind = clusters.select("block", "cluster").schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("name", kind="stable")
        rows = list(group[["name", "clean", "own"]].itertuples(index=False, name=None))
        across = bool((group["own"] != group["other"]).any())
        scores = [similarity(a, b, c, d) for i, (a, c, p) in enumerate(rows) for b, d, q in rows[i + 1 :] if not across or p != q]
        key = group["_key"].iloc[0]
        return pd.DataFrame([(key["block"], key["cluster"], sum(scores), len(scores))], columns=["block", "cluster", "total", "pairs"])

    sums = dealt.groupBy("_key", F.least("own", "other"), F.greatest("own", "other")).applyInPandas(run, f"{kind}, total double, pairs long")
    return sums.groupBy("block", "cluster").agg((F.sum("total") / F.sum("pairs")).alias("mean_similarity"))


def confirm(clusters: DataFrame, confirmed: float = CONFIRMED) -> DataFrame:
    """block, cluster, n_names, mean_similarity, status: singleton, confirmed or ambiguous."""
    clusters = kept(clusters.select("block", "cluster", "name"), "clusters")
    sizes = clusters.groupBy("block", "cluster").agg(F.count(F.lit(1)).alias("n_names"))
    status = F.when(F.col("n_names") == 1, "singleton").when(F.col("mean_similarity") >= confirmed, "confirmed").otherwise("ambiguous")
    return sizes.join(mean_similarities(clusters), ["block", "cluster"], "left").withColumn("status", status)


def canonical_names(clusters: DataFrame, keys: list[str], name: str = "name") -> DataFrame:
    """keys, canonical_name: the name with the best score, cleaned for output unless it stands alone."""
    order = F.struct(-T.canonical_score(F.col(name)), F.col(name))
    best = clusters.groupBy(*keys).agg(F.min_by(name, order).alias("_best"), F.count(F.lit(1)).alias("_n"))
    clean = T.canonical_name(F.col("_best"))
    return best.select(*keys, F.when((F.col("_n") > 1) & (F.length(clean) >= 2), clean).otherwise(F.col("_best")).alias("canonical_name"))


def singletons(entries: DataFrame) -> DataFrame:
    """Results of names that are alone in their block. cluster is for reading; names that begin alike share it, so
    cluster_key has part of a hash of the whole name behind it."""
    cluster = F.concat(F.lit("S-"), F.substring("cleaned", 1, 20))
    return entries.select(
        F.col("best_original").alias("original"), F.col("best_original").alias("normalized"), "individual", cluster.alias("cluster"),
        F.concat(cluster, F.lit("-"), F.substring(F.sha2("cleaned", 256), 1, 12)).alias("cluster_key"), F.lit("auto").alias("confidence"), F.lit("singleton").alias("method"), F.col("n_rows").alias("count"),
    )


Resolver = Callable[[list[str]], list[dict]]


def similar_resolver(names: list[str]) -> list[dict]:
    """Offline resolver: leader clusters by likeness; the member with the shortest name is canonical."""
    cleans = [" ".join(n.lower().split()) for n in names]
    of = lead(names, cleans)
    groups: dict[int, list[int]] = {}
    for i, c in enumerate(of):
        groups.setdefault(c, []).append(i)
    return [{"canonical": min((names[i] for i in g), key=lambda n: (len(n), n)), "members": g, "confidence": "medium"} for g in groups.values()]


def resolve(entries: DataFrame, resolver: Resolver = similar_resolver, size: int = 50, retries: int = 3) -> DataFrame:
    """Results of names that share a block: batches of `size` names go to the resolver.

    Its answer names members by place; the first claim of a place counts, places out of range don't, places
    left over are results of their own; a resolver that fails `retries` times leaves the names as they are.
    """
    batched = kept(batches(entries, ["block"], [F.col("cleaned")], size), "batches")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("cleaned", kind="stable").reset_index(drop=True)
        names, key = group["best_original"].tolist(), f"{group['block'][0]}-{group['batch'][0]}"
        answer = None
        for _ in range(retries):
            try:
                answer = resolver(names)
                break
            except Exception as failure:  # noqa: BLE001  an external model may fail in any way
                error = failure
        rows = {}
        for k, cluster in enumerate(answer or []):
            mine = [m for m in cluster.get("members", []) if isinstance(m, int) and 0 <= m < len(names) and m not in rows]
            for m in mine:
                single = len(mine) == 1
                rows[m] = (names[m] if single else cluster["canonical"], f"C-{key}-{k}", cluster.get("confidence", "medium"), "resolver-singleton" if single else "resolver-cluster")
        if answer is None:
            print(f"resolver gave up on {key}: {error}")
        rest = ("ERR", "error", "fallback") if answer is None else (f"S-{key}", "low", "resolver-missed")
        out = [(n, *rows.get(i, (n, *rest))) for i, n in enumerate(names)]
        frame = pd.DataFrame(out, columns=["original", "normalized", "cluster", "confidence", "method"])
        frame["individual"], frame["count"] = group["individual"], group["n_rows"]
        alone = frame["cluster"].eq("ERR") | frame["cluster"].str.startswith("S-")
        frame["cluster_key"] = frame["cluster"] + [f"-{key}-{i}" if x else "" for i, x in enumerate(alone)]
        return frame[["original", "normalized", "individual", "cluster", "cluster_key", "confidence", "method", "count"]]

    # a batch is few bytes and much work, so the number of tasks goes by batches
    tasks = min(BATCH_TASKS, batched.select("block", "batch").distinct().count()) or 1
    return batched.repartition(tasks, "block", "batch").groupBy("block", "batch").applyInPandas(run, "original string, normalized string, individual boolean, cluster string, cluster_key string, confidence string, method string, count long")
