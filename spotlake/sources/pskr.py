"""Live spots: the feed's short-key JSON and the normalized JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bands import HF_BANDS, band_id
from ..functions.clean import valid_grid

FEED = "t long, sc string, rc string, sl string, rl string, rp int, f long, md string"
SPOT = "ts string, sc string, sg string, rc string, rg string, f long, band int, mode string, snr smallint"


def normalize_live(df: DataFrame, *, hf_only: bool = True, line: str = "line") -> DataFrame:
    """``df`` (batch or stream) with the normalized spot of each message and _status: ``ok``, ``invalid`` or ``filtered``.

    Columns added: ts (ISO text), sc, sg, rc, rg, f, band, mode, snr. Malformed messages, and those without both
    calls and a frequency, are invalid; bands beyond HF are filtered if ``hf_only``. Bad grids are emptied."""
    text = lambda c: F.coalesce(c, F.lit(""))
    out = df.withColumn("_m", F.from_json(line, FEED))
    band = band_id(F.col("_m.f") / 1e6)
    missing = F.col("_m").isNull() | (text(F.col("_m.sc")) == "") | (text(F.col("_m.rc")) == "") | (F.coalesce("_m.f", F.lit(0)) == 0)
    grid = lambda c: F.when(valid_grid(c, live=True), c).otherwise("")
    return out.select(
        *df.columns,
        F.date_format(F.timestamp_seconds(F.coalesce("_m.t", F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
        F.col("_m.sc").alias("sc"),
        grid(F.col("_m.sl")).alias("sg"),
        F.col("_m.rc").alias("rc"),
        grid(F.col("_m.rl")).alias("rg"),
        F.col("_m.f").alias("f"),
        band.alias("band"),
        text(F.col("_m.md")).alias("mode"),
        F.coalesce("_m.rp", F.lit(0)).cast("smallint").alias("snr"),
        F.when(missing, "invalid").when(F.lit(hf_only) & ~band.between(*HF_BANDS), "filtered").otherwise("ok").alias("_status"),
    )


def parse_pskr(lines: DataFrame, *, line: str = "line") -> DataFrame:
    """``lines`` of normalized JSON in the columns of pskr.bronze, with the other columns of ``lines``, _ok and _reason."""
    out = lines.withColumn("_m", F.from_json(line, SPOT))
    time = F.try_to_timestamp(F.col("_m.ts"), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
    text = lambda c: F.coalesce(c, F.lit(""))
    empty = (text(F.col("_m.sc")) == "") | (text(F.col("_m.rc")) == "") | (F.coalesce("_m.f", F.lit(0)) == 0)
    reason = F.when(F.col("_m").isNull() | F.col("_m.ts").isNull(), "bad json").when(time.isNull(), "bad timestamp").when(empty, "missing field")
    return out.select(
        *lines.columns,
        time.alias("timestamp"),
        text(F.col("_m.sc")).alias("sender_call"),
        text(F.col("_m.sg")).alias("sender_grid"),
        text(F.col("_m.rc")).alias("receiver_call"),
        text(F.col("_m.rg")).alias("receiver_grid"),
        F.col("_m.f").alias("frequency"),
        F.coalesce("_m.band", F.lit(0)).alias("band"),
        text(F.col("_m.mode")).alias("mode"),
        F.coalesce("_m.snr", F.lit(0)).cast("smallint").alias("snr"),
        reason.isNull().alias("_ok"),
        reason.alias("_reason"),
    )


def read_pskr_jsonl(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Parsed rows of JSON-lines files, plain or gz."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    return parse_pskr(lines)
