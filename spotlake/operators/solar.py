"""Pivoting, resampling and merging of solar and solar-wind feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.space import FALLBACK_FLUX, flux_or_fallback, space_conditions
from ..functions.times import bucket3h
from ..schemas import SOLAR, SOLAR_MEASURES, conform
from ..sources import solar as feeds
from ..sources.files import detect_format, detect_legacy_format, read_documents

#: Energy bands of the x-ray feed (fixed values).
SHORT_BAND, LONG_BAND = "0.05-0.4nm", "0.1-0.8nm"
#: Source of merged rows.
MERGED = "noaa_swpc_7day"


def pivot_xray(df: DataFrame, *, order: str | None = None) -> DataFrame:
    """t, xray_short and xray_long: the flux of each energy band at a time (0 without one). order: a column by which
    the last of repeated readings wins; else the greatest does."""

    def of(band: str) -> Column:
        flux = F.when(F.col("energy") == band, F.col("flux"))
        return F.coalesce(F.max_by(flux, F.when(flux.isNotNull(), F.col(order))) if order else F.max(flux), F.lit(0.0))

    return df.where(F.col("energy").isin(SHORT_BAND, LONG_BAND)).groupBy("t").agg(of(SHORT_BAND).alias("xray_short"), of(LONG_BAND).alias("xray_long"))


def bucket_3h(df: DataFrame, time_col: str, measures: list[str]) -> DataFrame:
    """bucket (epoch seconds of each three-hour interval) and the greatest of each measure in it; missing is 0."""
    return df.groupBy(bucket3h(F.col(time_col)).alias("bucket")).agg(*[F.coalesce(F.max(m), F.lit(0.0)).alias(m) for m in measures])


def explode_day(days: DataFrame) -> DataFrame:
    """Eight three-hour rows of each day: kp_index and ap_index by interval, the daily values repeated."""
    rows = days.select("*", F.posexplode(F.arrays_zip("kp", "ap")).alias("slot", "v"))
    daily = [c for c in ("ssn", "observed_flux", "adjusted_flux") if c in days.columns]
    return rows.select("date", (F.col("slot") * 3).alias("hour"), F.col("v.kp").alias("kp_index"), F.col("v.ap").alias("ap_index"), *daily)


def spread_daily(df: DataFrame, measures: list[str]) -> DataFrame:
    """Each daily row at hours 0, 3, ... 21."""
    return df.select("date", F.explode(F.sequence(F.lit(0), F.lit(21), F.lit(3))).alias("hour"), *measures)


def align(df: DataFrame, keys: tuple[str, ...] = ("date", "hour"), measures: tuple[str, ...] = SOLAR_MEASURES) -> DataFrame:
    """The keys and all measures; those that a feed hasn't are 0."""
    return df.select(*keys, *[(F.coalesce(F.col(m).cast("double"), F.lit(0.0)) if m in df.columns else F.lit(0.0)).alias(m) for m in measures])


def union_feeds(*dfs: DataFrame, keys: tuple[str, ...] = ("date", "hour"), measures: tuple[str, ...] = SOLAR_MEASURES) -> DataFrame:
    """Feeds in one schema."""
    return reduce(DataFrame.unionByName, [align(df, keys, measures) for df in dfs])


def merge_feeds(*dfs: DataFrame, tag: str = MERGED, keys: tuple[str, ...] = ("date", "hour"), measures: tuple[str, ...] = SOLAR_MEASURES) -> DataFrame:
    """One row per key with the greatest of each measure over all feeds, so that partial rows complete each other."""
    return union_feeds(*dfs, keys=keys, measures=measures).groupBy(*keys).agg(*[F.max(m).alias(m) for m in measures]).withColumn("source_file", F.lit(tag))


def merged_keys(*dfs: DataFrame, keys: tuple[str, ...] = ("date", "hour")) -> DataFrame:
    """n_keys: how many rows a merge gives."""
    return reduce(DataFrame.unionByName, [df.select(*keys) for df in dfs]).distinct().agg(F.count(F.lit(1)).alias("n_keys"))


def merge_solar_wind(mag: DataFrame, plasma: DataFrame) -> DataFrame:
    """Both instruments by time t, the last reading (by pos) of each; an absent side is 0."""
    out = None
    for df in (mag, plasma):
        values = [c for c in df.columns if c not in ("t", "pos")]
        side = df.groupBy("t").agg(*[F.max_by(v, "pos").alias(v) for v in values])
        out = side if out is None else out.join(side, "t", "full_outer")
    return out.select("t", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in out.columns if c != "t"])


def live_conditions(kp: DataFrame, xray: DataFrame, flux: DataFrame, *, fallback: float = FALLBACK_FLUX) -> DataFrame:
    """One row of the present state: kp (time, kp_index, ap_index), xray (t, xray_short, xray_long), flux (time, flux)."""
    k = kp.agg(F.max_by("kp_index", "time").alias("kp_index"), F.max_by("ap_index", "time").alias("ap_index"))
    x = xray.agg(F.max_by("xray_short", "t").alias("xray_short"), F.max_by("xray_long", "t").alias("xray_long"))
    f = flux.agg(F.max_by("flux", "time").alias("solar_flux"))
    # Three single rows.
    one = k.withColumn("_k", F.lit(1)).join(x.withColumn("_k", F.lit(1)), "_k").join(f.withColumn("_k", F.lit(1)), "_k")
    zero = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    one = one.select(zero("kp_index"), zero("ap_index"), flux_or_fallback(F.col("solar_flux"), fallback).alias("solar_flux"), zero("xray_short"), zero("xray_long"))
    return one.withColumn("conditions", space_conditions(F.col("kp_index"), F.col("xray_long")))


def solar_batch(documents: DataFrame) -> DataFrame:
    """Solar documents (file, text) of mixed families in one batch, in the columns of the solar table: each document goes
    to the parser of its family, by its name and first character; unknown ones are left out. source_file is the family."""
    first = F.substring(F.ltrim(F.col("text")), 1, 1)
    known = documents.withColumn("family", detect_format(F.col("file"), first))
    of = lambda family: known.where(F.col("family") == family)
    lines = of("sidc").select(F.explode(F.split("text", "\r?\n", -1)).alias("line"))
    xray = bucket_3h(pivot_xray(feeds.parse_xray(of("xray_json"))), "t", ["xray_short", "xray_long"])
    parts = {
        "sidc": feeds.parse_sidc(lines).withColumn("time", F.col("date").cast("timestamp")),
        "kp_json": feeds.parse_kp(of("kp_json")),
        "xray_json": xray.withColumn("time", F.timestamp_seconds("bucket")).withColumn("date", F.to_date("time")),
        "sfi_json": feeds.parse_flux_daily(of("sfi_json")).withColumn("time", F.col("date").cast("timestamp")),
    }
    return reduce(DataFrame.unionByName, [conform(df.withColumn("source_file", F.lit(family)), SOLAR) for family, df in parts.items()])


def legacy_batch(documents: DataFrame) -> DataFrame:
    """Older text files (file, text) of mixed families in one batch, in the columns of the solar table: by their name, or else by
    the first line that isn't blank or a comment, each goes to the parser of daily flux, of sunspot numbers or of fixed-width indices."""
    lines = F.split("text", "\r?\n", -1)
    first = F.get(F.filter(lines, lambda x: (F.trim(x) != "") & ~F.startswith(F.ltrim(x), F.lit("#"))), F.lit(0))
    rows = documents.select(detect_legacy_format(F.col("file"), F.coalesce(first, F.lit(""))).alias("family"), F.explode(lines).alias("line"))
    parsers = {"noaa": feeds.parse_dsd, "sidc": feeds.parse_sidc, "kpap": feeds.parse_kpap_fixed}
    parts = [parse(rows.where(F.col("family") == family).select("line")).withColumns({"source_file": F.lit(family), "time": F.col("date").cast("timestamp")}) for family, parse in parsers.items()]
    return reduce(DataFrame.unionByName, [conform(df, SOLAR) for df in parts])


def read_solar_folder(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One batch of all solar files below ``paths``."""
    return solar_batch(read_documents(spark, paths))
