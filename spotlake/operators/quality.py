"""Row counts, coverage, completeness, parse and run statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of a spot as stored plainly, by which a compression ratio is estimated (fixed value).
PLAIN_ROW_BYTES = 80


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, 100.0 * part / whole).otherwise(0.0)


def verify_daily(df: DataFrame, *, start: str | None = None, end: str | None = None, tag: str | None = None) -> DataFrame:
    """Per date: rows, how many have Kp, x-ray and flux, and their maxima, ordered by date."""
    if tag is not None:
        df = df.where(F.col("source_file") == tag)
    if start:
        df = df.where(F.col("date") >= F.lit(start).cast("date"))
    if end:
        df = df.where(F.col("date") <= F.lit(end).cast("date"))
    measures = (("kp", "kp_index"), ("xray", "xray_long"), ("sfi", "observed_flux"))
    has = [F.count_if(F.col(c) > 0).alias(f"has_{n}") for n, c in measures]
    most = [F.max(c).alias(f"max_{n}") for n, c in measures]
    return df.groupBy("date").agg(F.count(F.lit(1)).alias("rows"), *has, *most).orderBy("date")


def coverage(days: DataFrame) -> DataFrame:
    """First and last day, and number, minimum and maximum of the positive flux, sunspot and Kp values."""
    positive = lambda c: F.when(F.col(c) > 0, F.col(c))
    stats = [x for n, c in (("sfi", "observed_flux"), ("ssn", "ssn")) for x in (F.count(positive(c)).alias(f"{n}_days"), F.min(positive(c)).alias(f"{n}_min"), F.max(positive(c)).alias(f"{n}_max"))]
    kp = F.filter("kp", lambda x: x > 0)
    return days.agg(
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        F.count(F.lit(1)).alias("days"),
        *stats,
        F.sum(F.size(kp)).cast("long").alias("kp_values"),
        F.min(F.array_min(kp)).alias("kp_min"),
        F.max(F.array_max(kp)).alias("kp_max"),
    )


def wind_summary(df: DataFrame) -> DataFrame:
    """Averages and ranges of Bz and speed, average density, and the range of times."""
    return df.agg(
        F.min("t").alias("first_t"),
        F.max("t").alias("last_t"),
        *[f(c).alias(f"{n}_{c}") for c in ("bz_gsm", "speed") for n, f in (("avg", F.avg), ("min", F.min), ("max", F.max))],
        F.avg("density").alias("avg_density"),
    )


def _parts() -> dict[str, Column]:
    parts = {"sfi": F.col("observed_flux") > 0, "ssn": F.col("ssn") > 0, "kp": F.col("kp_index") > 0}
    return parts | {"all": parts["sfi"] & parts["ssn"] & parts["kp"]}


def completeness(df: DataFrame) -> DataFrame:
    """Total rows, how many have flux, sunspots, Kp and all three, and the percentages."""
    out = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(p).alias(f"n_{k}") for k, p in _parts().items()])
    return out.select("*", *[_percent(F.col(f"n_{k}"), F.col("total")).alias(f"pct_{k}") for k in _parts()])


def completeness_on(df: DataFrame, day: str) -> DataFrame:
    """The rows of one date with status ``complete`` or ``incomplete``."""
    return df.where(F.col("date") == F.lit(day).cast("date")).withColumn("status", F.when(_parts()["all"], "complete").otherwise("incomplete"))


def row_status(rows: Column, min_rows: Column) -> Column:
    return F.when(rows.isNull(), "FAIL").when((min_rows > 0) & (rows < min_rows), "WARN").when(rows == 0, "empty").otherwise("OK")


def validate_tables(spark: SparkSession, checks: list[tuple[str, str, int, str]]) -> DataFrame:
    """table, grp, rows and status of each check (table, Parquet path, least rows, group); a path that can't be read fails."""
    parts = []
    for name, path, least, group in checks:
        try:
            counted = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
        except Exception:  # reported, not raised: that is what the check is for
            counted = spark.range(1).select(F.lit(None).cast("long").alias("rows"))
        parts.append(counted.select(F.lit(name).alias("table"), F.lit(group).alias("grp"), "rows", row_status(F.col("rows"), F.lit(least)).alias("status")))
    return reduce(DataFrame.unionAll, parts)


def status_totals(validated: DataFrame) -> DataFrame:
    return validated.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def run_stats(log: DataFrame) -> DataFrame:
    """Totals of a run from its log (file_size, row_count, elapsed_ms): files, rows, bytes, rates and an estimate of the compression."""
    out = log.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("row_count") > 0).alias("files_ok"),
        F.count_if(F.col("row_count") == 0).alias("files_empty"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("elapsed_ms"), F.lit(0)).alias("elapsed_ms"),
    )
    seconds = F.col("elapsed_ms") / 1000.0
    return out.select(
        "*",
        F.when(seconds > 0, F.col("rows") / seconds).otherwise(0.0).alias("rows_per_s"),
        F.when(seconds > 0, F.col("bytes") / 1048576.0 / seconds).otherwise(0.0).alias("mb_per_s"),
        F.when(F.col("rows") > 0, F.col("bytes") / F.col("rows")).otherwise(0.0).alias("bytes_per_row"),
        F.when(F.col("bytes") > 0, F.col("rows") * PLAIN_ROW_BYTES / F.col("bytes")).otherwise(0.0).alias("compression"),
    )


def write_report(stats: DataFrame, path: str) -> None:
    """A run's totals, one row, as a JSON document."""
    stats.coalesce(1).write.mode("overwrite").json(path)


def size_figures(bytes_in: Column, bytes_out: Column) -> dict[str, Column]:
    """mb_in, mb_out, gb_in and ratio of two sizes."""
    return {"mb_in": bytes_in / 1048576.0, "mb_out": bytes_out / 1048576.0, "gb_in": bytes_in / 1073741824.0, "ratio": F.when(bytes_out > 0, bytes_in / bytes_out).otherwise(0.0)}


def parse_stats(parsed: DataFrame, *, file: str | None = "file", line: str = "line", sanitized: Column | None = None) -> DataFrame:
    """Per file: lines read, parsed, failed, empty, and sanitized."""
    groups = [file] if file else []
    return parsed.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_read"),
        F.count_if("_ok").alias("n_parsed"),
        F.count_if(~F.col("_ok")).alias("n_failed"),
        F.count_if(F.trim(F.col(line)) == "").alias("n_empty"),
        F.count_if(sanitized if sanitized is not None else F.lit(False)).alias("n_sanitized"),
    )


def sanitize_audit(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """field, original and sanitized of each value that its cleaning changes. cols: column name and its cleaned form."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("original"), clean.alias("sanitized")) for c, clean in cols.items()])
    return df.select(F.explode(pairs).alias("x")).select("x.*").where("original <> sanitized")


def audit_totals(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """total and modified values."""
    modified = sum((F.coalesce((F.col(c) != clean).cast("long"), F.lit(0)) for c, clean in cols.items()), F.lit(0))
    return df.agg((F.count(F.lit(1)) * len(cols)).alias("total"), F.coalesce(F.sum(modified), F.lit(0)).alias("modified"))


def storage_report(listing: DataFrame) -> DataFrame:
    """Files and bytes by format, the last suffix of the name."""
    kind = F.lower(F.regexp_extract("file_path", r"\.([^./]+)$", 1))
    return listing.groupBy(kind.alias("format")).agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"))


def throughput(samples: DataFrame, *, window: int = 10) -> DataFrame:
    """Samples (run, t seconds, rows in total) with delta_rows, mrps (million rows a second since the sample before) and
    smoothed_mrps, the mean of the positive ones of the last ``window``. Samples are one row a tick of a run."""
    w = Window.partitionBy("run").orderBy("t")
    out = samples.withColumn("delta_rows", F.col("rows") - F.lag("rows", 1, 0).over(w)).withColumn("_s", F.col("t") - F.lag("t").over(w))
    out = out.withColumn("mrps", F.when(F.col("_s") > 0, F.col("delta_rows") / 1e6 / F.col("_s")).otherwise(0.0))
    smooth = F.avg(F.when(F.col("mrps") > 0, F.col("mrps"))).over(w.rowsBetween(1 - window, 0))
    return out.withColumn("smoothed_mrps", F.coalesce(smooth, F.lit(0.0))).drop("_s")
