"""Live spots: one normalization for batch and stream, rotated files, counters and catch-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.solar import live_conditions
from ..sources import replay
from ..sources.pskr import normalize_live, parse_pskr

#: Sources whose messages are the column value.
LOG_FORMATS = ("kafka", "spot_log")


def read_spot_stream(spark: SparkSession, fmt: str = "text", options: dict[str, str] | None = None, path: str | None = None, *, max_files: int | None = 1000) -> DataFrame:
    """A stream of messages (column line) from files, or from a log with offsets: Kafka, or ``spot_log`` (see ``sources.replay``). The rate of files is
    limited at the source; nothing is dropped. A message without a value is an empty line."""
    if fmt == "spot_log":
        replay.register(spark)
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt in LOG_FORMATS:
        return (reader.load(path) if path else reader.load()).select(F.coalesce(F.col("value").cast("string"), F.lit("")).alias("line"))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (reader.load(path) if path else reader.load()).select(F.col("value").alias("line"))


#: Files of an hour that a trigger writes at most.
HOUR_FILES = 4
SPOT_COLUMNS = ("ts", "sc", "sg", "rc", "rg", "f", "band", "mode", "snr")


def rotated(spots: DataFrame) -> DataFrame:
    """Accepted spots with the partition columns of their hour."""
    time = F.to_timestamp("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return spots.where("_status = 'ok'").select(*SPOT_COLUMNS, *[F.date_format(time, f).alias(n) for n, f in (("yyyy", "yyyy"), ("mm", "MM"), ("dd", "dd"), ("hh", "HH"))])


def write_jsonl_rotated(spots: DataFrame, path: str, checkpoint: str, *, once: bool = False, every: str = "60 seconds") -> StreamingQuery:
    """Accepted spots as gz JSON lines by year, month, day and hour of the spot; a restart goes on from the checkpoint. An hour's spots of a trigger go
    to ``HOUR_FILES`` files at most, however many tasks have read them."""
    hour = ("yyyy", "mm", "dd", "hh")
    dealt = rotated(spots).withColumn("_deal", F.pmod(F.xxhash64(*SPOT_COLUMNS), F.lit(HOUR_FILES))).repartition(*hour, "_deal").drop("_deal")
    writer = dealt.writeStream.format("json").option("compression", "gzip").option("path", path).option("checkpointLocation", checkpoint).partitionBy("yyyy", "mm", "dd", "hh")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def ingest_jsonl(spark: SparkSession, src: str, dst: str, checkpoint: str) -> StreamingQuery:
    """Catch up with new JSON-lines files below ``src``: the checkpoint knows which have been read."""
    lines = spark.readStream.option("recursiveFileLookup", True).text(src).select(F.col("value").alias("line"))
    good = parse_pskr(lines).where("_ok").drop("line", "_ok", "_reason")
    return good.writeStream.format("parquet").option("path", dst).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counters(spots: DataFrame, *, every: str = "60 seconds", delay: str = "5 minutes") -> DataFrame:
    """received, written, filtered and invalid messages of each interval of event time (column event_time); batch or stream."""
    rows = spots.withWatermark("event_time", delay) if spots.isStreaming else spots
    counts = [F.count_if(F.col("_status") == s).alias(n) for n, s in (("written", "ok"), ("filtered", "filtered"), ("invalid", "invalid"))]
    out = rows.groupBy(F.window("event_time", every).alias("w")).agg(F.count(F.lit(1)).alias("received"), *counts)
    return out.select(F.col("w.start").alias("start"), "received", "written", "filtered", "invalid")


def dedupe_stream(df: DataFrame, keys: list[str], *, time: str = "event_time", delay: str = "7 days") -> DataFrame:
    """Rows of overlapping windows once; state is kept as long as a row may come again."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys) if df.isStreaming else df.dropDuplicates(keys)


def refresh_live(kp: DataFrame, xray: DataFrame, flux: DataFrame, path: str) -> None:
    """Overwrite the one-row snapshot, as a table and as a JSON document."""
    now = live_conditions(kp, xray, flux).coalesce(1)
    now.write.mode("overwrite").parquet(f"{path}/table")
    now.write.mode("overwrite").json(f"{path}/json")


def last_readings(readings: DataFrame) -> DataFrame:
    """kind, time, a and b of the last reading of each kind (of readings of one time, the largest values). On a stream its state is one row a
    kind, however long it runs, and readings that come late change nothing."""
    newest = F.max(F.struct("time", "a", "b")).alias("last")
    return readings.groupBy("kind").agg(newest).select("kind", "last.time", "last.a", "last.b")


def refresh_stream(readings: DataFrame, path: str, checkpoint: str, *, once: bool = False, every: str = "15 minutes") -> StreamingQuery:
    """Keep the snapshot of ``refresh_live`` up to date from a stream of readings (kind ``kp``, ``xray`` or ``flux``, time, and
    the values a, b). The state is the last reading of each kind; a trigger gets these few rows, whatever came before, and a restart goes on from
    the checkpoint."""

    def refresh(last: DataFrame, number: int) -> None:
        # Three rows at most.
        rows = last.sparkSession.createDataFrame(last.collect(), last.schema)
        of = lambda kind, time, *names: rows.where(F.col("kind") == kind).select(F.col("time").alias(time), *[F.col(c).alias(n) for c, n in zip("ab", names, strict=False)])
        refresh_live(of("kp", "time", "kp_index", "ap_index"), of("xray", "t", "xray_short", "xray_long"), of("flux", "time", "flux"), path)

    known = readings.where(F.col("kind").isin("kp", "xray", "flux"))
    writer = last_readings(known).writeStream.outputMode("complete").foreachBatch(refresh).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


__all__ = ["counters", "dedupe_stream", "ingest_jsonl", "last_readings", "normalize_live", "read_spot_stream", "refresh_live", "refresh_stream", "rotated", "write_jsonl_rotated"]
