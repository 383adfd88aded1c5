"""Scratch tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where that is unset, a local master (tests) gets a
    temporary folder, removed at exit; a cluster, whose machines would not see it, an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark.sparkContext, "_masterline_scratch", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        made = tempfile.mkdtemp(prefix="masterline-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        root = f"file://{made}"
        spark.sparkContext._masterline_scratch = root
    return root.rstrip("/")


#: Paths made inside each open scope of a thread, the innermost last.
_open = threading.local()


def _scopes() -> list[list[str]]:
    if not hasattr(_open, "scopes"):
        _open.scopes = []
    return _open.scopes


def scratch_path(spark: SparkSession, name: str, outer: bool = False) -> str:
    """A new path; it goes with the innermost open scope or, if outer, with the one around that."""
    path = f"{scratch_root(spark)}/masterline/{name}-{uuid.uuid4().hex}"
    if len(_scopes()) > outer:
        _scopes()[-1 - outer].append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the tables written inside, but for those written for outside (outer). Frames that read
    the others must not be used after it."""
    _scopes().append([])
    try:
        yield
    finally:
        for path in _scopes().pop():
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def kept(df: DataFrame, name: str, outer: bool = False) -> DataFrame:
    """df written as Parquet and read back: its lineage ends there, and a lost executor costs a reread."""
    path = scratch_path(df.sparkSession, name, outer)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
