"""Reverse-beacon spots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bands import band_id
from ..functions.clean import continent2, fields, khz_floor, settled, to_float, to_int
from ..functions.times import rbn_time
from .files import read_zip_csv

#: Fewest columns, and columns of the layout that has speed and mode.
LEAST_COLUMNS, WIDE_COLUMNS = 11, 13


def parse_rbn(lines: DataFrame) -> DataFrame:
    """``lines`` (file, line_no, line) in the columns of rbn.bronze, with file, line_no, _ok and _reason.

    Header rows (``callsign...``) and marker rows (``(...``) are left out. The first row left in a file
    decides whether the file has speed and mode. A row with a bad time, frequency or report is rejected."""
    rows = lines.where(~(F.lower("line").startswith("callsign") | F.col("line").startswith("(") | (F.trim("line") == "")))
    # One row a file, from a pass that splits no lines but the first ones.
    layout = rows.groupBy("file").agg(F.min_by("line", "line_no").alias("first")).select("file", F.size(fields(F.col("first"))).alias("_layout"))
    rows = rows.withColumn("_f", fields(F.col("line"))).join(layout, "file")
    at = lambda k: F.get("_f", F.lit(k))
    count = F.size("_f")
    # Rows are settled twice: one projection of everything would be more code than the JVM compiles.
    read = rows.select(
        "file",
        "line_no",
        "_f",
        count.alias("_n"),
        ((F.col("_layout") >= WIDE_COLUMNS) & (count >= WIDE_COLUMNS)).alias("_wide"),
        F.when(F.trim(at(3)) != "", to_float(at(3))).alias("_khz"),
        F.when(F.trim(at(9)) != "", to_int(at(9), -32768, 32767)).alias("_snr"),
        rbn_time(at(10)).alias("timestamp"),
    )
    parsed = settled(read.withColumn("_mhz", F.col("_khz") / 1000))
    reason = F.when(F.col("_n") < LEAST_COLUMNS, "too few fields").when(F.col("timestamp").isNull(), "bad timestamp").when(F.col("_khz").isNull(), "bad frequency").when(F.col("_snr").isNull(), "bad snr")
    out = parsed.select(
        "file",
        "line_no",
        "timestamp",
        at(0).alias("de_call"),
        at(1).alias("de_pfx"),
        continent2(at(2)).alias("de_cont"),
        khz_floor(at(3)).alias("frequency"),
        band_id(F.col("_mhz")).alias("band"),
        at(5).alias("dx_call"),
        at(6).alias("dx_pfx"),
        continent2(at(7)).alias("dx_cont"),
        at(8).alias("spot_type"),
        F.col("_snr").cast("smallint").alias("snr"),
        F.when(F.col("_wide"), to_int(at(11), 0, 65535, policy="lenient")).otherwise(0).cast("int").alias("speed"),
        F.when(F.col("_wide"), at(12)).otherwise("").alias("tx_mode"),
        reason.isNull().alias("_ok"),
        reason.alias("_reason"),
    )
    return settled(out)


def read_rbn_zip(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Parsed rows of daily zip archives."""
    return parse_rbn(read_zip_csv(spark, paths))
