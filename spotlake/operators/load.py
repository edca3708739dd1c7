"""Idempotent loading into partitioned Parquet, and the file log that it is planned by.

A load replaces whole partitions and is logged only afterwards, so that a load that was lost
on the way is simply run again."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shared import stored
from .dedupe import latest_by_key
from .ranges import place


def latest_log(log: DataFrame, order: str = "loaded_at") -> DataFrame:
    """The last entry of each file."""
    return latest_by_key(log, ["file_path"], [order])


def plan_full(listing: DataFrame) -> DataFrame:
    """Every file, to load again."""
    return listing.withColumn("action", F.lit("load"))


def plan_incremental(listing: DataFrame, log: DataFrame) -> DataFrame:
    """Files that the log doesn't have. Neither side is bounded, so Spark chooses how to join."""
    return listing.join(log.select("file_path").distinct(), "file_path", "left_anti")


def plan_growth(listing: DataFrame, log: DataFrame, *, order: str = "loaded_at") -> DataFrame:
    """file_path, file_size, was_size and action (``new`` or ``grown``) of files that are new, or larger than
    their last log entry says; files that shrank are left alone."""
    known = latest_log(log, order).select("file_path", F.col("file_size").alias("was_size"))
    out = listing.join(known, "file_path", "left").where("was_size is null or file_size > was_size")
    return out.select("file_path", "file_size", F.coalesce("was_size", F.lit(0).cast("long")).alias("was_size"), F.when(F.col("was_size").isNull(), "new").otherwise("grown").alias("action"))


def dry_run(plan: DataFrame) -> DataFrame:
    """The plan with a note for each file, as a run would take it."""
    note = F.when(F.col("action") == "new", "new").otherwise(F.concat(F.lit("was "), F.col("was_size").cast("string"), F.lit(" bytes")))
    return plan.select("file_path", "file_size", note.alias("note"))


def log_entries(files: DataFrame, *, rows: Column | None = None, elapsed_ms: Column | None = None, host: str = "", now: Column | None = None) -> DataFrame:
    """Log rows of files that were loaded."""
    return files.select(
        "file_path",
        "file_size",
        (rows if rows is not None else F.lit(0)).cast("long").alias("row_count"),
        (now if now is not None else F.current_timestamp()).alias("loaded_at"),
        (elapsed_ms if elapsed_ms is not None else F.lit(0)).cast("long").alias("elapsed_ms"),
        F.lit(host).alias("hostname"),
    )


def prime(listing: DataFrame, log: DataFrame, **entry) -> DataFrame:
    """Log rows, of no data rows, of the files that the log doesn't have: they count as loaded from here on."""
    return log_entries(plan_incremental(listing, log), **entry)


def append(df: DataFrame, path: str, parts: list[str] | None = None) -> None:
    """Append to a table, partitioned by ``parts``."""
    df.write.mode("append").partitionBy(*(parts or [])).parquet(path)


def append_log(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").parquet(path)


def append_run(rows: DataFrame, path: str, run: str) -> None:
    """Add the rows of a run (such as its rejects) to the table at ``path``, as partition ``run``. A run that is repeated replaces its own
    rows, also where there are none left."""
    rows.write.mode("overwrite").parquet(f"{path}/run={run}")


def _exists(spark: SparkSession, path: str) -> bool:
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file)


def read_log(spark: SparkSession, path: str, schema) -> DataFrame:
    """The log at ``path``; an empty one if nothing was logged yet."""
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def replace_partitions(df: DataFrame, path: str, parts: list[str]) -> None:
    """Overwrite the partitions that ``df`` has rows in; the others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Overwrite the whole table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def replace_files(df: DataFrame, path: str, parts: list[str], file_col: str = "file") -> None:
    """Overwrite the rows of the files that ``df`` holds in partitions that several files share: rows of other
    files in the touched partitions are read, kept and written with the new ones."""
    spark = df.sparkSession
    try:
        old = spark.read.schema(df.schema).parquet(path)
    except Exception as e:  # the table's first load
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return replace_partitions(df, path, parts)
    kept = old.join(df.select(*parts).distinct(), parts, "left_semi").join(df.select(file_col).distinct(), file_col, "left_anti")
    replace_partitions(df.unionByName(kept.select(*df.columns)), path, parts)


def clustered(df: DataFrame, parts: list[str], order: list[str], files: int | None = None) -> DataFrame:
    """``df`` dealt by ``parts`` and sorted inside each task, so that files have narrow ranges of ``order``."""
    dealt = df.repartition(files, *parts) if files else df.repartition(*parts)
    return dealt.sortWithinPartitions(*parts, *order)


def range_clustered(df: DataFrame, parts: list[str], order: list[str], *, file_rows: int = 1_000_000, spread_rows: int | None = None) -> DataFrame:
    """``df`` dealt by ranges of ``order`` inside each of its ``parts``, a range a task, and sorted there: a partition has as many files of about
    ``file_rows`` rows as it needs, and two at least where it has more than ``spread_rows`` rows. Ranges don't overlap: rows that are equal in all of ``order`` stay together.

    The rows' keys alone are sorted and counted first: those at equal steps of their rank in the partition are the cuts between its files."""
    keys, same = df.select(*parts, *order), lambda a, b: F.expr(" and ".join(f"{a}.`{p}` <=> {b}.`{p}`" for p in parts))
    dealt = keys.repartitionByRange(*parts, *order).sortWithinPartitions(*parts, *order)
    # Sorted over all tasks: the rows of a partition in a task stand side by side, and tasks follow each other.
    placed = stored(dealt.withColumn("_id", F.monotonically_increasing_id())).withColumns({"_task": F.shiftright("_id", 33), "_at": F.struct(*order)})
    whole = Window.partitionBy(*parts)
    pieces = placed.groupBy(*parts, "_task").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_start"), F.min("_at").alias("_low"), F.max("_at").alias("_high"))
    ahead = F.coalesce(F.sum("_n").over(whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = pieces.withColumns({"_ahead": ahead, "_rows": F.sum("_n").over(whole), "_low": F.min("_low").over(whole), "_high": F.max("_high").over(whole)})
    files = F.ceil(F.col("_rows") / file_rows)
    pieces = stored(pieces.withColumn("_files", files if spread_rows is None else F.greatest(files, F.when(F.col("_rows") > spread_rows, 2).otherwise(1))))
    # A row for each partition and task.
    ranked = placed.alias("a").join(F.broadcast(pieces.select(*parts, "_task", "_start", "_ahead", "_rows", "_files")).alias("b"), same("a", "b") & F.expr("a._task = b._task"))
    ranked = ranked.select(*[f"a.{p}" for p in parts], "_at", F.expr("_ahead + _id - _start").alias("_rank"), "_rows", "_files")
    cuts = ranked.where("_rank > 0 and _rank * _files div _rows > (_rank - 1) * _files div _rows").groupBy(*parts).agg(F.collect_set("_at").alias("_cuts"))
    ends = pieces.groupBy(*parts).agg(F.first("_files").alias("_files"), F.first("_low").alias("_low"), F.first("_high").alias("_high"))
    held = ends.alias("a").join(cuts.alias("b"), same("a", "b"), "left").select(*[f"a.{p}" for p in parts], "_files", "_low", "_high", F.coalesce("_cuts", F.array()).alias("_cuts"))
    # A cut at the lowest row has nothing before it.
    inner = F.array_sort(F.filter("_cuts", lambda c: c > F.col("_low")))
    last = (F.col("_files") > 1) & (F.size("_cuts") == 0) & (F.col("_low") < F.col("_high"))
    held = held.withColumn("_cuts", inner).withColumn("_cuts", F.when(last, F.array("_high")).otherwise(F.col("_cuts")))
    before = Window.orderBy(*parts).rowsBetween(Window.unboundedPreceding, -1)
    held = stored(held.select(*parts, "_cuts", F.coalesce(F.sum(F.size("_cuts") + 1).over(before), F.lit(0)).cast("int").alias("_first")))
    total, most = held.agg(F.coalesce(F.sum(F.size("_cuts") + 1), F.lit(1)), F.coalesce(F.max(F.size("_cuts")), F.lit(0))).first()
    # A row for each partition.
    met = df.alias("a").join(F.broadcast(held).alias("b"), same("a", "b")).select("a.*", "_cuts", "_first")
    met = met.withColumn("_file", (F.col("_first") + place(F.col("_cuts"), F.struct(*order), most)).cast("int"))
    return met.repartitionById(total, "_file").select(*df.columns).sortWithinPartitions(*parts, *order)


def csv_to_parquet(spark: SparkSession, src: str, dst: str, schema, *, delimiter: str = ",", again: bool = False) -> bool:
    """Typed, zstd-compressed Parquet of CSV files; malformed rows are dropped. An output that was finished (by its
    ``_SUCCESS``) is skipped unless it is asked for ``again``. Returns whether it was written."""
    if not again and _exists(spark, f"{dst}/_SUCCESS"):
        return False
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").option("sep", delimiter).csv(src)
    rows.write.mode("overwrite").option("compression", "zstd").parquet(dst)
    return True


def incremental_load(
    listing: DataFrame, log: DataFrame, log_path: str, read: Callable[[list[str]], DataFrame], write: Callable[[DataFrame], DataFrame | None], *, growth: bool = False, batch_files: int = 10_000, **entry
) -> int:
    """Load the files that the plan names, in batches of at most ``batch_files``, each logged when it is written.

    The plan is computed once and stored beside the log. A batch's file names go through the driver: they are the reader's arguments. ``write`` may return what it
    wrote by file (file_path, row_count), which is logged; a log of its own load, that counts by itself, is ``ledger.load_files``. Returns the number of files."""
    plan = plan_growth(listing, log) if growth else plan_incremental(listing, log)
    planned = f"{log_path}-plans/{uuid.uuid4().hex}"
    plan.select("file_path", "file_size").distinct().sort("file_path").write.parquet(planned)
    plan = listing.sparkSession.read.schema("file_path string, file_size long").parquet(planned)
    total, after = 0, ""
    while True:
        names = [r[0] for r in plan.where(F.col("file_path") > after).orderBy("file_path").limit(batch_files).select("file_path").collect()]
        if not names:
            return total
        began = time.monotonic()
        counts = write(read(names))
        done, measured = plan.where(F.col("file_path").between(names[0], names[-1])), {}
        if isinstance(counts, DataFrame):
            done = done.join(counts.select("file_path", "row_count"), "file_path", "left")
            measured = {"rows": F.coalesce("row_count", F.lit(0)), "elapsed_ms": F.lit(round(1000 * (time.monotonic() - began) / len(names)))}
        append_log(log_entries(done, **(measured | entry)), log_path)
        total, after = total + len(names), names[-1]
