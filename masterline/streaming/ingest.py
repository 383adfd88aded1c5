"""Upload folders as a stream: each file is taken once, and each batch is an idempotent upsert."""

from __future__ import annotations

import queue
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from masterline.operators.ids import format_id, row_numbers
from masterline.operators.tables import lookup
from masterline.sources.files import append_log, append_logs, replace_partitions
from masterline.sources.scratch import kept

#: Of a failed query's error, which holds the whole trace, so much goes to the log.
ERROR_CHARS = 4_000


def upload_stream(spark: SparkSession, root: str, schema: str, file_column: str | None = None, files_at_once: int | None = None) -> DataFrame:
    """Rows of the CSV files under root/<client_id>/ as they arrive, with the client in the path.

    file_column: gets the path below root. files_at_once: how many files a batch takes at most.
    """
    limit = {"maxFilesPerTrigger": files_at_once} if files_at_once else {}
    rows = spark.readStream.schema(schema).options(header=True, recursiveFileLookup=True, **limit).csv(root)
    if file_column:
        rows = rows.withColumn(file_column, F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+/[^/]+)$", 1))
    return rows.withColumn("upload_client_id", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1))


def ingest(stream: DataFrame, target: str, checkpoint: str, key: str = "batch_id", log: str | None = None) -> StreamingQuery:
    """Append each batch to target under its number; a batch that is run again replaces itself.

    log: a run log that gets a row for each batch, with its rows or its error.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        try:
            batch.withColumn(key, F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(target)
        except Exception as failure:
            if log:
                append_log(spark, log, str(number), "ingest", "error", 0, str(failure)[:500])
            raise
        if log:
            append_log(spark, log, str(number), "ingest", "ok", spark.read.parquet(target).filter(F.col(key) == number).count())

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def assign_ids(stream: DataFrame, state: str, target: str, checkpoint: str, name: str, order: str, prefix: str = "G", base: int = 10_000) -> StreamingQuery:
    """Append each batch to target with global_supplier_id and is_new, ids going on from batch to batch.

    state is a table of the names known so far: batch_id, name_key, number. A batch looks its names up among those of
    earlier batches; the others get the next numbers, by the least value of `order` they come with, then by name, and
    are written under the batch's number, as are its rows. Names compare trimmed and in lower case; rows without a name
    get no id. A batch that is run again sees the same earlier batches and replaces what it wrote, so every name gets
    one id, whatever fails in between, and however the files are cut into batches that come in the same order.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = kept(batch.withColumn("name_key", F.nullif(F.lower(F.trim(name)), F.lit(""))), "batch")
        empty = spark.createDataFrame([], "name_key string, number long, batch_id long")
        earlier = (spark.read.schema(empty.schema).parquet(state) if number and exists(spark, state) else empty).filter(F.col("batch_id") < number)
        start = earlier.agg(F.max("number")).first()[0] or base
        asked = rows.filter("name_key IS NOT NULL").groupBy("name_key").agg(F.min(order).alias("_order"))
        new = row_numbers(asked.join(earlier.select("name_key"), "name_key", "left_anti"), [F.col("_order"), F.col("name_key")], "_n")
        new = kept(new.select("name_key", (F.col("_n") + start).alias("number"), F.lit(number).cast("long").alias("batch_id")), "new-names")
        replace_partitions(new, state, ["batch_id"])
        known = earlier.select("name_key", "number", F.lit(False).alias("is_new")).unionByName(new.select("name_key", "number", F.lit(True).alias("is_new")))
        numbered = lookup(rows, "name_key", known).withColumn("global_supplier_id", F.when(F.col("number").isNotNull(), format_id(F.col("number"), prefix))).drop("name_key", "number")
        replace_partitions(numbered.withColumn("batch_id", F.lit(number).cast("long")), target, ["batch_id"])

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


class RunLogListener(StreamingQueryListener):
    """A run log of every streaming query of a session: rows for its start, each batch with its input rows, and its end,
    with the error if it failed. Nothing has to be called in the query's own functions.

    Events wait in memory and are appended by a thread, so that a query never waits for the log; stop() appends what
    is left. Register it with `with RunLogListener(spark, path):` or start() and stop().
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.rows: queue.Queue = queue.Queue()
        self.thread = threading.Thread(target=self._append, daemon=True)

    def start(self) -> RunLogListener:
        self.spark.streams.addListener(self)
        self.thread.start()
        return self

    def stop(self) -> None:
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        self.spark.streams.removeListener(self)
        self.rows.put(None)
        self.thread.join()

    __enter__ = start

    def __exit__(self, *_: object) -> None:
        self.stop()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.rows.put((str(event.runId), "start", "ok", None, None))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.rows.put((str(p.runId), f"batch {p.batchId}", "ok", p.numInputRows, None))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        failure = event.exception
        self.rows.put((str(event.runId), "end", "error" if failure else "ok", None, failure and failure[:ERROR_CHARS]))

    def _append(self) -> None:
        over = False
        while not over:
            rows = [self.rows.get()]
            while not self.rows.empty():
                rows.append(self.rows.get())
            over = None in rows
            if rows := [r for r in rows if r is not None]:
                frame = self.spark.createDataFrame(rows, "run_id string, stage string, status string, row_count long, error_message string")
                append_logs(frame.coalesce(1), self.path)


def stage_counts(events: DataFrame, time: str, kind: str, late: str = "1 hour", window: str = "1 day") -> DataFrame:
    """Events per window and kind, with a watermark; of a batch or a stream."""
    return events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), kind).agg(F.count(F.lit(1)).alias("n_events")).select(F.col("w.start").alias("window_start"), kind, "n_events")
