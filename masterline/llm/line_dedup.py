"""Lines that repeat across documents, through levelled sorted runs of line hashes."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from masterline.llm.common import SPACE_CHARS, once, scope, scratch_path, stage, text_of
from masterline.llm.words import lower_ascii

LEAST_CHARS = 20
LEAST_DOCS = 3
BATCHES = 4
FANOUT = 2
#: Keys or rows that hold at least 1/MOST_HOT of all rows, so at most MOST_HOT of them, are joined by broadcasting.
MOST_HOT = 10_000
KEY = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    """The lines of a text; null or empty is one empty line."""
    return F.split(text_of(text), "\n")


def line_hash(line: Column, least_chars: int = LEAST_CHARS) -> Column:
    """128 bits of a line's key (ASCII white space stripped at both ends, A-Z lowered); null if the key is short."""
    pair = lambda k: F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit("2"), k).alias("h2"))
    return once(F.btrim(line, F.lit(SPACE_CHARS)), lambda k: F.when(F.length(k) >= least_chars, pair(lower_ascii(k))))


def line_hashes(text: Column, least_chars: int = LEAST_CHARS) -> Column:
    """For every line of a text, in order, its hash or null."""
    return F.transform(lines_of(text), lambda line: line_hash(line, least_chars))


class LineRuns:
    """Line hashes of the documents seen so far: how many documents hold each, and the largest id among these.

    A run is a table of hashes, bucketed and sorted by hash, so merge joins read runs without shuffling them. A
    batch adds one run at level 0; `fanout` runs of a level are compacted into one of the next, so there are never
    more than fanout - 1 a level, and a hash is rewritten once a level. Hashes that some run already knows in
    `least_docs` documents are settled: nothing more is to be learnt of them, as long as batches come in descending
    order of ids, and a batch leaves them out. What is kept of runs outside the tables is their names.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None, least_docs: int = LEAST_DOCS, fanout: int = FANOUT):
        self.spark, self.least_docs, self.fanout = spark, least_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        sorted_rows = rows.repartition(self.buckets, *KEY).sortWithinPartitions(*KEY)
        writer = sorted_rows.write.format("parquet").option("path", scratch_path(self.spark, name)).option("compression", "zstd")
        writer.bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name)
        return name

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def tables(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def merged(self, names: list[str]) -> DataFrame:
        """h1, h2, n, holder over several runs, by merge joins."""

        def merge(one: DataFrame, other: DataFrame) -> DataFrame:
            both = one.join(other.withColumnsRenamed({"n": "_n", "holder": "_holder"}).hint("merge"), KEY, "full")
            count = F.coalesce("n", F.lit(0).cast("long")) + F.coalesce("_n", F.lit(0).cast("long"))
            return both.select(*KEY, count.alias("n"), F.greatest("holder", "_holder").alias("holder"))

        return reduce(merge, map(self.spark.table, names))

    def add(self, docs: DataFrame, id_col: str, hashes_col: str) -> None:
        """Take in a batch of documents, given with the hashes of their lines; all ids below those of earlier batches."""
        held = docs.select(F.col(id_col).alias("holder"), F.explode(F.array_distinct(F.filter(hashes_col, lambda h: h.isNotNull()))).alias("_h"))
        new = held.select("holder", "_h.*").groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.max("holder").alias("holder"))
        for name in self.tables():
            settled = self.spark.table(name).filter(F.col("n") >= self.least_docs).select(*KEY)
            new = new.join(settled.hint("merge"), KEY, "left_anti")
        self._keep(0, self._write(new))

    def _keep(self, level: int, name: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            done, self.levels[level] = self.levels[level], []
            self._keep(level + 1, self._write(self.merged(done)))
            self._drop(done)

    def repeated(self) -> DataFrame:
        """h1, h2, n, holder of the hashes that least_docs documents or more hold: the last compaction, written for
        outside the open scope."""
        if not self.tables():
            return self.spark.createDataFrame([], "h1 long, h2 long, n long, holder long")
        rows = stage(self.merged(self.tables()).filter(F.col("n") >= self.least_docs), "repeated", outer=True)
        self._drop(self.tables())
        self.levels = []
        return rows


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS, batches: int = BATCHES) -> DataFrame:
    """id, n_lines, n_dropped, kept: the text without lines that it shares, and that a larger id keeps.

    A key of least_chars code points or more, in least_docs documents or more, loses all its lines but those of the
    largest id that holds it; a line of that document stays as often as it stands there. Null and empty texts are one
    empty line, which stays. Rows with one id are documents of their own, decided alike. A null id is smaller than all
    others; where only null ids hold a key, its lines stay. An empty table gives an empty result. Columns of docs but
    id and text are not read, so none clash.

    Ids are numbers. Documents come to the runs in batches, from the largest ids down, in about equal shares.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    cuts = rows.agg(F.percentile_approx("id", [(batches - k) / batches for k in range(1, batches)], F.lit(10_000))).first()[0] or []
    hashed = rows.select("id", line_hashes(F.col("text"), least_chars).alias("hashes"))
    with scope(spark):
        runs, upper = LineRuns(spark, least_docs=least_docs), F.lit(True)
        for cut in dict.fromkeys(cuts):
            runs.add(hashed.filter(upper & (F.col("id") > cut)), "id", "hashes")
            upper = F.col("id") <= cut
        runs.add(hashed.filter(F.coalesce(upper, F.lit(True))), "id", "hashes")
        repeated = runs.repeated()
    return without_lines(rows, dropped_lines(rows, repeated, least_chars)).select(F.col("id").alias(id_col), "n_lines", "n_dropped", "kept")


def row_key() -> list[Column]:
    """128 bits of a row's id and text: rows that agree in both have the same lines, and lose the same."""
    return [F.xxhash64("id", text_of("text")).alias("r1"), F.xxhash64(F.lit("2"), "id", text_of("text")).alias("r2")]


def dropped_lines(rows: DataFrame, repeated: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """r1, r2, places, copies: places of the lines that a row loses, and how many rows are the same in id and text."""
    found = rows.select("id", *row_key(), F.posexplode(line_hashes(F.col("text"), least_chars)).alias("place", "_h")).filter("_h IS NOT NULL")
    found = found.select("id", "r1", "r2", "place", "_h.*")
    total = repeated.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * MOST_HOT >= total
    often, seldom = repeated.filter(hot), repeated.filter(~hot)
    lost = ~F.col("id").eqNullSafe(F.col("holder"))
    by_hot = found.join(F.broadcast(often), KEY).filter(lost)
    by_rest = found.join(F.broadcast(often.select(*KEY)), KEY, "left_anti").join(seldom, KEY).filter(lost)
    both = by_hot.select("r1", "r2", "place").unionByName(by_rest.select("r1", "r2", "place"))
    sets = both.groupBy("r1", "r2").agg(F.collect_set("place").alias("places"), F.count(F.lit(1)).alias("_n"))
    return sets.select("r1", "r2", "places", F.expr("_n div size(places)").alias("copies"))


def without_lines(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """id, n_lines, n_dropped, kept of every row; rows that are alike many times over are joined by broadcasting."""
    dropped = stage(dropped, "dropped")
    total = dropped.agg(F.sum("copies")).first()[0] or 0
    hot = F.col("copies") * MOST_HOT >= total
    often, seldom = dropped.filter(hot).drop("copies"), dropped.filter(~hot).drop("copies")
    keyed = rows.select("id", text_of("text").alias("text"), *row_key())
    keys = ["r1", "r2"]
    by_hot = keyed.join(F.broadcast(often), keys)
    by_rest = keyed.join(F.broadcast(often.select(*keys)), keys, "left_anti").join(seldom, keys, "left")

    def cut(lines: Column) -> Column:
        n, gone = F.size(lines), F.coalesce("places", F.array().cast("array<int>"))
        left = F.array_except(F.sequence(F.lit(0), n - 1), gone)
        return F.struct(n.cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_dropped"), F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n").alias("kept"))

    every = by_hot.unionByName(by_rest)
    return every.select("id", once(F.split("text", "\n"), cut).alias("_cut")).select("id", "_cut.*")


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its lines counted and the digest of what is left of its text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), held AS (
  SELECT k, max(doc_id) AS holder FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT doc_id, line, place, held.k IS NOT NULL AND doc_id <> holder AS gone FROM keyed LEFT JOIN held USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
