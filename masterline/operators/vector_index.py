"""Approximate vector search: an inverted file of lists around centroids, with exact ranking of what is probed."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from masterline.operators.vectors import top_k
from masterline.sources.scratch import kept

#: Vectors that centroids are fitted on, at any size of the table, and rounds of the fit.
SAMPLE = 20_000
ROUNDS = 10
#: Files of a list; rows are dealt to them by a hash of their key, so one large list is several tasks' work.
FILES = 4
#: Rows and queries of a list that meet in one task, about; more of either are dealt into parts.
PART_ROWS, PART_QUERIES = 16_384, 4_096
#: Products that a task holds at once, and pairs that it measures at once.
PRODUCTS, MEASURED = 4_000_000, 100_000


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Arrays of one width as rows of doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1 if len(flat) else 0)


def unit_rows(rows: Sequence) -> np.ndarray:
    """Vectors of one width as rows of unit length; a zero vector stays zero."""
    x = np.array(rows, dtype=np.float64).reshape(len(rows), len(rows[0]) if len(rows) else 0)
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norms, out=np.zeros_like(x), where=norms > 0)


def fit_centroids(vectors: DataFrame, lists: int, key: str, vector: str = "embedding", sample: int = SAMPLE, rounds: int = ROUNDS) -> np.ndarray:
    """At most `lists` unit vectors: spherical k-means of the `sample` vectors whose keys hash least, so a rerun agrees.

    A center without vectors takes the one that is farthest from its own. Null vectors, and those that haven't the width
    of most, are left out.
    """
    some = vectors.filter(F.col(vector).isNotNull()).select(F.xxhash64(key).alias("_h"), F.col(key).alias("_key"), vector).orderBy("_h", "_key").limit(sample)
    rows = [r[vector] for r in some.collect()]
    width = max((n, -w) for w, n in Counter(map(len, rows)).items())[1] if rows else 0
    x = unit_rows([r for r in rows if len(r) == -width])
    centers = x[: min(lists, len(x))].copy()
    for _ in range(rounds if len(centers) else 0):
        near = x @ centers.T
        of, best = near.argmax(1), near.max(1)
        for k in range(len(centers)):
            if (of == k).any():
                centers[k] = x[of == k].sum(0)
            else:
                far = int(best.argmin())
                centers[k], best[far] = x[far], 2.0
        centers = unit_rows(centers)
    return centers


def nearest_lists(vectors: DataFrame, centroids: np.ndarray, probes: int, vector: str = "embedding", out: str = "lists") -> DataFrame:
    """vectors with the numbers of the `probes` lists whose centroids are nearest, nearest first, ties by number; null
    vectors, and those of another width, have none."""
    width = centroids.shape[1] if centroids.size else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index(vector))
            good = pc.fill_null(pc.equal(pc.list_value_length(rows), width), False)
            found: list = [[]] * len(rows)
            if good.true_count:
                near = unit_rows(matrix(rows.filter(good))) @ centroids.T
                for i, order in zip(np.flatnonzero(good.to_numpy(zero_copy_only=False)).tolist(), np.argsort(-near, axis=1, kind="stable")[:, :probes].tolist(), strict=True):
                    found[i] = order
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], names=[*batch.schema.names, out])

    plain = vectors.drop(out)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)
    return plain.mapInArrow(run, f"{fields}, {out} array<int>")


def build_index(vectors: DataFrame, path: str, lists: int, key: str, vector: str = "embedding", sample: int = SAMPLE) -> None:
    """Every vector under the list of its nearest centroid, as Parquet partitioned by list, and the centroids beside it.

    Centroids are fitted on a bounded sample; all vectors of their width are indexed. Null vectors and those of another
    width, which no search finds, are left out.
    """
    spark = vectors.sparkSession
    centroids = fit_centroids(vectors, lists, key, vector, sample)
    spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centroids)], "list int, centroid array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
    assigned = nearest_lists(vectors, centroids, 1, vector, "_lists").filter("size(_lists) = 1").withColumn("list", F.get("_lists", F.lit(0))).drop("_lists")
    file = F.pmod(F.xxhash64(key), F.lit(FILES))
    assigned.repartition(max(1, min(len(centroids) * FILES, 10_000)), "list", file).write.mode("overwrite").partitionBy("list").parquet(f"{path}/lists")


def read_centroids(spark: SparkSession, path: str) -> np.ndarray:
    """The centroids, in order of their lists: as many rows as there are lists."""
    rows = spark.read.schema("list int, centroid array<double>").parquet(f"{path}/centroids").orderBy("list").collect()
    return np.array([r["centroid"] for r in rows])


def search_index(spark: SparkSession, path: str, query: Sequence[float], k: int, probes: int, key: str, vector: str = "embedding") -> DataFrame:
    """The k rows nearest to the query among those of the `probes` nearest lists; Spark reads only these partitions.

    With as many probes as lists it is the exact search.
    """
    near = unit_rows([list(query)])[0] @ read_centroids(spark, path).T
    chosen = np.argsort(-near, kind="stable")[:probes].tolist()
    return top_k(spark.read.parquet(f"{path}/lists").filter(F.col("list").isin(chosen)), query, k, key, vector)


def search_many(spark: SparkSession, path: str, queries: DataFrame, k: int, probes: int, query_key: str, key: str, vector: str = "embedding", part_rows: int = PART_ROWS, part_queries: int = PART_QUERIES) -> DataFrame:
    """query, key, distance, rank: the k nearest of every row of queries(query_key, vector), by `probes` lists each.

    Queries go to their lists and meet the rows there: a list is dealt into parts of about part_rows rows, its queries
    into parts of about part_queries, and each two of these parts are one task's work, which hands on the k best of
    each query. Ties go by key; zero, null and other-width vectors find nothing.
    """
    asked = kept(nearest_lists(queries.select(F.col(query_key).alias("query"), F.col(vector).alias("_q")), read_centroids(spark, path), probes, "_q", "_lists"), "asked")
    rows = spark.read.parquet(f"{path}/lists").select("list", F.col(key).alias("key"), F.col(vector).alias("_v"))
    whole = lambda c: ~F.exists(c, lambda x: x.isNull())
    asked, rows = asked.filter(whole("_q")).withColumn("list", F.explode("_lists")).drop("_lists"), rows.filter(whole("_v"))
    counts = lambda df, n, of: df.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / n).cast("int").alias(of))
    plan = kept(counts(rows, part_rows, "_parts").join(counts(asked, part_queries, "_blocks"), "list"), "parts")
    parts, tasks = F.broadcast(plan), max(1, min(2 * (plan.agg(F.sum(F.col("_parts") * F.col("_blocks"))).first()[0] or 0), 10_000))
    own = lambda c, n: F.pmod(F.xxhash64(*c), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.join(parts, "list").withColumn("part", own(["key", "_v"], "_parts")).withColumn("block", every("_blocks"))
    right = asked.join(parts, "list").withColumn("block", own(["query", "_q"], "_blocks")).withColumn("part", every("_parts"))
    by = ["list", "part", "block"]
    kinds = [f"{c} {t.schema[c].dataType.simpleString()}" for c, t in (("query", asked), ("key", rows))]
    dealt = lambda df, *c: df.select(*by, *c).repartition(tasks, *by).groupBy(*by)  # noqa: E731  few bytes are much work here
    found = dealt(left, "key", "_v").cogroup(dealt(right, "query", "_q")).applyInArrow(partial(nearest_of, k=k), f"{', '.join(kinds)}, distance double")
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("distance", "key"))).filter(F.col("rank") <= k).select("query", "key", "distance", "rank")


def nearest_of(rows: pa.Table, asked: pa.Table, k: int) -> pa.Table:
    """query, key, distance: the k nearest of rows(key, _v) of each of asked(query, _q), as cosine_distance has them.

    Products in single precision rule out what is farther than the k-th by more than their error; the rest, k rows and
    a few as a rule, is measured like cosine_distance and ranked. Of equal vectors only the k least keys can count.
    """
    order = np.argsort(pc.rank(rows["key"].combine_chunks(), "ascending", null_placement="at_start", tiebreaker="first").to_numpy(), kind="stable")
    v, q = matrix(rows["_v"])[order], matrix(asked["_q"])
    first = pd.Series([x.tobytes() for x in v]).groupby(pd.Series([x.tobytes() for x in v])).cumcount().to_numpy() < k
    v, order = v[first], order[first]
    v_norms, q_norms = (np.sqrt(sums(x * x)) for x in (v, q))
    v, order, v_norms = v[v_norms != 0], order[v_norms != 0], v_norms[v_norms != 0]
    # a product of unit vectors of d numbers is off by less than d + 8 roundings
    error = (v.shape[1] + 8) * float(np.finfo(np.float32).eps)
    near, units = min(k, len(v)), unit_rows(v).astype(np.float32).T
    out_q, out_v, out_d = [], [], []
    step = max(1, PRODUCTS // max(1, len(v)))
    for at in range(0, len(q) if near else 0, step):
        some = np.flatnonzero(q_norms[at : at + step] != 0) + at
        likeness = np.nan_to_num(unit_rows(q[some]).astype(np.float32) @ units, copy=False, nan=-2.0)
        least = np.partition(likeness, len(v) - near, axis=1)[:, len(v) - near] - 2 * error
        i, j = np.nonzero(likeness >= least[:, None])
        i = some[i]
        distance = np.concatenate([1.0 - sums(v[j[b : b + MEASURED]] * q[i[b : b + MEASURED]]) / (v_norms[j[b : b + MEASURED]] * q_norms[i[b : b + MEASURED]]) for b in range(0, len(i), MEASURED)] or [np.empty(0)])
        ranked = np.lexsort((j, distance, i))
        i, j, distance = i[ranked], j[ranked], distance[ranked]
        best = np.arange(len(i)) - np.searchsorted(i, i) < k
        out_q.append(i[best])
        out_v.append(order[j[best]])
        out_d.append(distance[best])
    of = lambda x, kind: np.concatenate(x) if x else np.empty(0, dtype=kind)
    return pa.table({"query": asked["query"].take(pa.array(of(out_q, np.int64))), "key": rows["key"].take(pa.array(of(out_v, np.int64))), "distance": pa.array(of(out_d, np.float64))})


def sums(x: np.ndarray) -> np.ndarray:
    """The sum of each row, from left to right, as Spark adds an array up; so equal vectors have equal sums."""
    return np.cumsum(x, axis=1)[:, -1] if x.shape[1] else np.zeros(len(x))
