"""Loads that are resolved by their log entry.

Every load writes below a folder of its own (``load_id=...``), counts what it wrote by file, and appends one log entry a file; the entries of
a load are one file, so they appear all at once. Readers take a file's rows from the last load that was logged for it. So a load that
is lost on the way leaves nothing that anybody reads, a file that no longer covers a partition has no rows left there, and nothing
that is being read is overwritten.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from .dedupe import latest_by_key
from .load import read_log

#: The file log, with the load whose rows count.
LOAD_LOG = T.StructType([*schemas.INGEST_LOG.fields, T.StructField("load_id", T.StringType())])


def last_loads(log: DataFrame) -> DataFrame:
    """The last entry of each file; entries of one time are in the order of their loads."""
    return latest_by_key(log, ["file_path"], ["loaded_at", "load_id"])


def new_load() -> str:
    """A load's id: later ones sort behind."""
    return f"l{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def write_load(rows: DataFrame, table: str, parts: list[str], load_id: str, *, file_col: str = "file_path") -> DataFrame:
    """Write the rows of a load below its folder and return file_path and row_count of what is there."""
    path = f"{table}/load_id={load_id}"
    rows.write.mode("overwrite").partitionBy(*parts).parquet(path)
    back = rows.sparkSession.read.schema(rows.schema).parquet(path)
    return back.groupBy(F.col(file_col).alias("file_path")).agg(F.count(F.lit(1)).alias("row_count"))


def commit_load(files: DataFrame, counts: DataFrame, log_path: str, load_id: str, *, elapsed_ms: int, host: str = "", now: Column | None = None) -> None:
    """Log the files (file_path, file_size) of a load: the rows counted, and the load's time dealt to them by their rows. This is the
    load's commit; one file holds all its entries."""
    rows = F.coalesce("row_count", F.lit(0)).cast("long")
    entries = files.join(counts, "file_path", "left").select("file_path", "file_size", rows.alias("row_count"))
    total = counts.agg(F.sum("row_count")).first()[0] or 1
    entries = entries.select(
        "*",
        (now if now is not None else F.current_timestamp()).alias("loaded_at"),
        F.round(F.col("row_count") * F.lit(elapsed_ms / total)).cast("long").alias("elapsed_ms"),
        F.lit(host).alias("hostname"),
        F.lit(load_id).alias("load_id"),
    )
    entries.coalesce(1).write.mode("append").parquet(log_path)


def load_files(
    plan: DataFrame, table: str, log_path: str, read: Callable[[list[str]], DataFrame], parts: list[str], *, file_col: str = "file_path", batch_files: int = 10_000, host: str = "", now: Column | None = None
) -> int:
    """Load the files of ``plan`` (file_path, file_size) in batches of at most ``batch_files``, each a load of its own. ``read`` gets a batch's
    names (which go through the driver) and returns rows with their file in ``file_col``. The plan is computed once and stored beside the log. Returns the number of files."""
    spark, stored = plan.sparkSession, f"{log_path}-plans/{uuid.uuid4().hex}"
    plan.select("file_path", "file_size").distinct().sort("file_path").write.parquet(stored)
    plan = spark.read.schema("file_path string, file_size long").parquet(stored)
    total, after = 0, ""
    while True:
        names = [r[0] for r in plan.where(F.col("file_path") > after).orderBy("file_path").limit(batch_files).select("file_path").collect()]
        if not names:
            return total
        load_id, began = new_load(), time.monotonic()
        counts = write_load(read(names), table, parts, load_id, file_col=file_col).cache()
        files = plan.where(F.col("file_path").between(names[0], names[-1]))
        commit_load(files, counts, log_path, load_id, elapsed_ms=round(1000 * (time.monotonic() - began)), host=host, now=now)
        counts.unpersist()
        total, after = total + len(names), names[-1]


def current_rows(spark: SparkSession, table: str, log_path: str, schema: T.StructType, *, file_col: str = "file_path") -> DataFrame:
    """Rows of the table (columns of ``schema``), each file's from the last load logged for it. Primed files, whose entries name no load, have none."""
    whole = T.StructType([*schema.fields, T.StructField("load_id", T.StringType())])
    log = read_log(spark, log_path, LOAD_LOG)
    last = last_loads(log).where("load_id is not null").select(F.col("file_path").alias(file_col), "load_id")
    return spark.read.schema(whole).parquet(table).join(last, [file_col, "load_id"], "left_semi").select(*schema.names)


def vacuum(spark: SparkSession, table: str, log_path: str, *, running: Iterable[str] = ()) -> list[str]:
    """Delete the folders of loads that no file's last entry names, but for those of ``running`` loads; returns their ids. Loads are as many as batches, so
    their ids go through the driver."""
    root = spark._jvm.org.apache.hadoop.fs.Path(table)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    there = {s.getPath().getName().removeprefix("load_id=") for s in store.listStatus(root) if s.getPath().getName().startswith("load_id=")}
    used = {r[0] for r in last_loads(read_log(spark, log_path, LOAD_LOG)).select("load_id").distinct().collect()}
    gone = sorted(there - used - set(running))
    for load_id in gone:
        store.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{table}/load_id={load_id}"), True)
    return gone
