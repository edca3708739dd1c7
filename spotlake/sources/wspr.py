"""WSPR spots from CSV lines and Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bands import band_id
from ..functions.clean import fields, fixed, mhz_to_hz, sanitize_callsign, settled, to_float, to_int, upper_grid
from .files import read_lines, read_tar_csv, spread

#: Fewest columns of a line.
LEAST_COLUMNS = 15
#: (column, place in the line, lowest and highest value) of whole numbers, in the order in which they are looked at (fixed values).
NUMBERS = (
    ("id", 0, 0, (1 << 63) - 1),
    ("epoch", 1, -(1 << 63), (1 << 63) - 1),
    ("snr", 4, -128, 127),
    ("power", 8, -128, 127),
    ("drift", 9, -128, 127),
    ("distance", 10, 0, (1 << 32) - 1),
    ("azimuth", 11, 0, 65535),
)


def _float32(c: Column) -> Column:
    return F.coalesce(to_float(c, policy="lenient"), F.lit(0.0)).cast("float")


def parse_wspr(lines: DataFrame, *, policy: str = "strict", line: str = "line") -> DataFrame:
    """``lines`` with the columns of wspr.spots and _ok, _reason (why a line is rejected, by its first bad field).

    ``strict`` rejects a line with a bad number, ``lenient`` reads it as 0 or the nearest bound. The band is
    always derived from the frequency; the code and the coordinates are read leniently by either policy."""
    at = lambda k: F.get("_f", F.lit(k))
    out = lines.withColumn("_f", fields(F.col(line))).withColumn("column_count", F.size("_f"))
    full = F.col("column_count") >= LEAST_COLUMNS
    numbers = {name: F.when(full, to_int(at(k), lo, hi, policy=policy)) for name, k, lo, hi in NUMBERS}
    # Rows are settled twice: one projection of everything would be more code than the JVM compiles.
    out = settled(out.withColumns({**numbers, "mhz": F.when(full, to_float(at(5), policy=policy))}))
    reason = F.when(~full, "insufficient columns")
    for name in ("id", "epoch", "snr", "mhz", "power", "drift", "distance", "azimuth"):
        reason = reason.when(F.col(name).isNull(), {"epoch": "invalid timestamp", "mhz": "invalid frequency"}.get(name, f"invalid {name}"))
    text = F.when(F.trim(at(5)).rlike("[eE]"), F.col("mhz").cast("string")).otherwise(F.trim(at(5)))
    out = out.withColumns(
        {
            "_reason": reason,
            "timestamp": F.timestamp_seconds("epoch"),
            "reporter": sanitize_callsign(F.trim(at(2))),
            "reporter_grid": F.trim(at(3)),
            "frequency": F.when(F.col("mhz").isNotNull(), F.coalesce(mhz_to_hz(text), F.lit(0).cast("long"))),
            "callsign": sanitize_callsign(F.trim(at(6))),
            "grid": F.trim(at(7)),
            "mode": F.lit("WSPR"),
            "version": F.coalesce(F.trim(at(13)), F.lit("")),
            "code": F.coalesce(to_int(F.coalesce(at(14), F.lit("")), 0, 255), F.lit(0)),
            "rx_lat": _float32(at(15)),
            "rx_lon": _float32(at(16)),
            "tx_lat": _float32(at(17)),
            "tx_lon": _float32(at(18)),
        }
    )
    out = settled(out.drop("_f")).withColumns({"band": F.when(F.col("mhz").isNotNull(), band_id(F.col("mhz"))), "_ok": F.col("_reason").isNull()})
    return settled(out)


def good_spots(parsed: DataFrame) -> DataFrame:
    """Accepted lines in the columns of wspr.bronze."""
    kinds = {"snr": "tinyint", "power": "tinyint", "drift": "tinyint", "azimuth": "int", "code": "smallint", "column_count": "smallint"}
    names = "id timestamp reporter reporter_grid snr frequency callsign grid power drift distance azimuth band mode version code column_count".split()
    return parsed.where("_ok").select(*[F.col(n).cast(kinds[n]).alias(n) if n in kinds else F.col(n) for n in names])


def apply_defaults(spots: DataFrame) -> DataFrame:
    """Mode ``WSPR`` if empty, 15 columns if unknown, and a band if it is 0 though there is a frequency (in Hz)."""
    return spots.withColumns(
        {
            "mode": F.when(F.coalesce("mode", F.lit("")) == "", "WSPR").otherwise(F.col("mode")),
            "column_count": F.when(F.coalesce("column_count", F.lit(0)) == 0, 15).otherwise(F.col("column_count")),
            "band": F.when((F.coalesce("band", F.lit(0)) == 0) & (F.col("frequency") > 0), band_id(F.col("frequency") / 1e6)).otherwise(F.col("band")),
        }
    )


def read_wspr(spark: SparkSession, paths: str | list[str], *, policy: str = "strict", partitions: int | None = None) -> DataFrame:
    """Parsed lines of CSV files, plain or gz. Lines of few files are spread over all cores, or over ``partitions``."""
    lines = read_lines(spark, paths)
    return parse_wspr(lines.repartition(partitions) if partitions else spread(lines), policy=policy)


def read_wspr_tar(spark: SparkSession, paths: str | list[str], *, policy: str = "strict") -> DataFrame:
    """Parsed lines of the first CSV member of tar archives."""
    return parse_wspr(read_tar_csv(spark, paths), policy=policy)


def from_parquet_columns(df: DataFrame) -> DataFrame:
    """wspr.bronze columns of a Parquet archive (epoch seconds, frequency in MHz)."""
    return df.select(
        F.col("id").cast("long"),
        F.timestamp_seconds(F.col("timestamp").cast("long")).alias("timestamp"),
        fixed(F.col("reporter"), 16).alias("reporter"),
        upper_grid(F.col("reporter_grid")).alias("reporter_grid"),
        F.col("snr").cast("tinyint").alias("snr"),
        F.coalesce(mhz_to_hz(F.col("frequency").cast("string")), F.lit(0).cast("long")).alias("frequency"),
        fixed(F.col("callsign"), 16).alias("callsign"),
        upper_grid(F.col("grid")).alias("grid"),
        F.col("power").cast("tinyint").alias("power"),
        F.col("drift").cast("tinyint").alias("drift"),
        F.col("distance").cast("long").alias("distance"),
        F.col("azimuth").cast("int").alias("azimuth"),
        band_id(F.col("frequency")).alias("band"),
        F.lit("WSPR").alias("mode"),
        fixed(F.col("version"), 8).alias("version"),
        F.col("code").cast("smallint").alias("code"),
        F.lit(15).cast("smallint").alias("column_count"),
    )


def read_wspr_parquet(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return from_parquet_columns(spark.read.parquet(*([paths] if isinstance(paths, str) else paths)))
