"""Rotated files of closed hours, put together into few.

A trigger a minute leaves a file for each task and hour. Hours that are over are rewritten to a table beside the rotated one, by hour, in
files of about a target size; a log holds what each hour was made of. Readers take the hours of the log from there and the others from the rotated
files. An hour whose files have changed since (late spots) is read from these and planned again, and a run that is lost is simply run again: it
overwrites its hours, and they count only once they are logged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import latest_by_key
from ..operators.load import read_log
from ..schemas import _schema
from ..shared import stored

#: Bytes of a file that compaction makes, about.
TARGET_BYTES = 128 << 20
PARTS = ("yyyy", "mm", "dd", "hh")
COMPACT_LOG = _schema("hour string, files long, bytes long, bins long, run long")
ROTATED = _schema("ts string, sc string, sg string, rc string, rg string, f long, band int, mode string, snr int, yyyy string, mm string, dd string, hh string")


def _hour() -> Column:
    return F.concat_ws("-", *PARTS)


def rotated_hours(spark: SparkSession, path: str) -> DataFrame:
    """hour (yyyy-mm-dd-hh), files and bytes of the rotated files below ``path``."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json.gz").load(path)
    part = lambda p: F.regexp_extract("path", rf"/{p}=([^/]*)/", 1)
    return found.groupBy(F.concat_ws("-", *[part(p) for p in PARTS]).alias("hour")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def plan_compaction(hours: DataFrame, log: DataFrame, before: str, *, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """hour, files, bytes and bins (files to make) of the hours earlier than ``before`` that no log entry has, or that have changed since theirs."""
    last = latest_by_key(log, ["hour"], ["run"]).select("hour", F.col("files").alias("_files"), F.col("bytes").alias("_bytes"))
    due = hours.where(F.col("hour") < before).join(last, "hour", "left").where("_bytes is null or _bytes <> bytes or _files <> files")
    return due.select("hour", "files", "bytes", F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_bytes)).cast("long").alias("bins"))


def compact(spark: SparkSession, src: str, dst: str, before: str, *, target_bytes: int = TARGET_BYTES) -> int:
    """Rewrite the closed hours of ``src`` that are due to ``dst`` and log them; returns their number."""
    log = read_log(spark, f"{dst}/log", COMPACT_LOG)
    run = log.agg(F.coalesce(F.max("run"), F.lit(0))).first()[0] + 1
    path = f"{dst}/plans/run={run}"
    plan_compaction(rotated_hours(spark, src), log, before, target_bytes=target_bytes).write.mode("overwrite").parquet(path)
    plan = spark.read.schema("hour string, files long, bytes long, bins long").parquet(path)
    n = plan.count()
    if not n:
        return 0
    # Every spot's bin is a hash of it, so an hour of any size is spread over its bins; a bin is one task and one file.
    rows = spark.read.schema(ROTATED).json(src).withColumn("hour", _hour()).join(plan.select("hour", "bins"), "hour")
    bin_of = F.pmod(F.xxhash64(*[c for c in ROTATED.names if c not in PARTS]), F.col("bins"))
    tasks = plan.agg(F.sum("bins")).first()[0]
    dealt = rows.withColumn("_bin", bin_of).repartition(min(tasks, 10_000), "hour", "_bin").drop("hour", "bins", "_bin")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip").partitionBy(*PARTS).json(f"{dst}/spots")
    plan.select("*", F.lit(run).alias("run")).coalesce(1).write.mode("append").parquet(f"{dst}/log")
    return n


def compacted_spots(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """All spots: those of logged hours from the compacted table, the others from the rotated files. An hour that has got
    files since its entry is read from the rotated ones until it is compacted again; one whose rotated files are gone, from the compacted table."""
    log = latest_by_key(read_log(spark, f"{dst}/log", COMPACT_LOG), ["hour"], ["run"])
    rotated = spark.read.schema(ROTATED).json(src)
    if log.isEmpty():
        return rotated
    now = rotated_hours(spark, src).select("hour", F.col("files").alias("_files"), F.col("bytes").alias("_bytes"))
    same = F.coalesce((F.col("files") == F.col("_files")) & (F.col("bytes") == F.col("_bytes")), F.lit(True))
    closed_hours = stored(log.join(now, "hour", "left").where(same).select("hour"))
    open_spots = rotated.withColumn("hour", _hour()).join(closed_hours, "hour", "left_anti").drop("hour")
    closed = spark.read.schema(ROTATED).json(f"{dst}/spots").withColumn("hour", _hour()).join(closed_hours, "hour", "left_semi").drop("hour")
    return closed.unionByName(open_spots)
