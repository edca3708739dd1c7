"""Archive catalogues: what should be there, what has changed, and links of index pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedupe import first_by_key

#: Link patterns of index pages (fixed values): log files of a directory listing; query pages with hash and callsign.
LOG_LINK = r"""href=['"]([^'"]+\.log)['"]"""
QUERY_LINK = r"""showpubliclog\.php\?q=([^"]+)"[^>]*>([^<]+)</a>"""


def _calendar(spark, start: str, end: str, step: str) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr(f"interval 1 {step}"))).alias("day"))


def missing_days(present: DataFrame, start: str, end: str) -> DataFrame:
    """Days between both dates that ``present`` (column day) lacks."""
    return _calendar(present.sparkSession, start, end, "day").join(present.select("day").distinct(), "day", "left_anti")


def missing_months(present: DataFrame, start: str, end: str) -> DataFrame:
    """First days of the months that ``present`` (column day) has no day of."""
    have = present.select(F.trunc("day", "month").alias("day")).distinct()
    return _calendar(present.sparkSession, start, end, "month").select(F.trunc("day", "month").alias("day")).join(have, "day", "left_anti")


def work_list(catalog: DataFrame, *, year: int | None = None, mode: str | None = None) -> DataFrame:
    """contest, year, mode and subdir of each download of a catalogue (contest, year_min, year_max, modes array, and
    optionally years, the only ones that exist). A contest without modes has mode '' and falls away if one is asked for."""
    years = F.sequence(F.col("year_min"), F.col("year_max"))
    if "years" in catalog.columns:
        years = F.when(F.col("years").isNull(), years).otherwise(F.array_intersect(years, F.col("years")))
    out = catalog.select("contest", "modes", F.explode(years).alias("year")).select("contest", "year", F.explode_outer("modes").alias("mode"))
    out = out.withColumn("mode", F.coalesce("mode", F.lit("")))
    if year:
        out = out.where(F.col("year") == year)
    if mode:
        out = out.where(F.col("mode") == mode)
    return out.withColumn("subdir", F.concat(F.col("year").cast("string"), F.col("mode")))


def changed_remote(local: DataFrame, remote: DataFrame) -> DataFrame:
    """file_path and action of each remote file (file_path, etag), by what is stored of it: ``download`` if it is not there or
    has another tag, ``adopt`` if no tag was stored, else ``skip``. A remote file without a tag is skipped if it is there."""
    known = local.select("file_path", F.coalesce("etag", F.lit("")).alias("_etag"), F.lit(True).alias("_there"))
    action = (
        F.when(F.col("_there").isNull(), "download")
        .when(F.coalesce("etag", F.lit("")) == "", "skip")
        .when(F.col("_etag") == "", "adopt")
        .when(F.col("_etag") != F.col("etag"), "download")
        .otherwise("skip")
    )
    return remote.join(known, "file_path", "left").select("file_path", action.alias("action"))


def not_on_disk(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Manifest entries whose file isn't there, or is empty."""
    return manifest.join(listing.where("file_size > 0").select("file_path").distinct(), "file_path", "left_anti")


def extract_links(pages: DataFrame, pattern: str = LOG_LINK, *, page: str = "page_id", html: str = "html", group: int = 1) -> DataFrame:
    """page, pos and link of each match of the pattern in each page."""
    return pages.select(page, F.posexplode(F.regexp_extract_all(html, F.lit(pattern), F.lit(group))).alias("pos", "link"))


def query_manifest(pages: DataFrame, *, page: str = "page_id", html: str = "html", pattern: str = QUERY_LINK) -> DataFrame:
    """page, callsign (trimmed, lower case, ``/`` as ``-``), pos and hash of the query links of each page; the first link of a callsign wins."""
    both = F.arrays_zip(*[F.regexp_extract_all(html, F.lit(pattern), F.lit(g)).alias(n) for g, n in ((1, "hash"), (2, "name"))])
    rows = pages.select(page, F.posexplode(both).alias("pos", "x")).select(page, "pos", F.col("x.hash").alias("hash"), F.replace(F.lower(F.trim("x.name")), F.lit("/"), F.lit("-")).alias("callsign"))
    return first_by_key(rows.where("callsign <> ''").select(page, "callsign", "pos", "hash"), [page, "callsign"], ["pos"])


def log_manifest(links: DataFrame, page: str = "page_id") -> DataFrame:
    """callsign of each log link: file name without suffix, lower case, ``/`` as ``-``; the first link of a page wins."""
    name = F.regexp_replace(F.lower(F.regexp_extract("link", r"([^/]*)$", 1)), r"\.log$", "")
    rows = links.withColumn("callsign", F.replace(F.trim(name), F.lit("/"), F.lit("-"))).where("callsign <> ''")
    return first_by_key(rows.select(page, "callsign", "pos", "link"), [page, "callsign"], ["pos"])
