"""Latest-wins deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _columns(names) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def latest_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is last by ``order``.

    A grouped maximum, so that only one row a key and task is shuffled. Rows that tie in ``order``
    are settled by their other values, so that the result doesn't depend on the partitions."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*_columns(order), *_columns(rest))
    out = df.groupBy(*keys).agg(F.max(packed).alias("_last"))
    return out.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns])


def latest_by_priority(df: DataFrame, keys: list[str], priority: str, order: list[str]) -> DataFrame:
    """The row of each key of the lowest ``priority``, and among those the last by ``order``."""
    out = latest_by_key(df.withColumn("_rank", -F.col(priority)), keys, ["_rank", *order])
    return out.select(*df.columns)


def first_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is first by ``order``."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    out = df.groupBy(*keys).agg(F.min(F.struct(*_columns(order), *_columns(rest))).alias("_first"))
    return out.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


#: Load priority of solar files by what their name contains (fixed values): the highest is loaded first, so that the lowest wins.
FILE_PRIORITY = ((("sn_d_tot", "sn_y_tot"), 100), (("kp_ap_historical", "kp_ap.txt"), 90), (("sfi_daily_flux", "dsd.txt"), 80), (("daily", "recent"), 50), (("forecast", "predicted"), 40))


def file_priority(name: Column) -> Column:
    base, out = F.lower(F.regexp_extract(name, r"([^/]*)$", 1)), F.lit(10)
    for words, rank in reversed(FILE_PRIORITY):
        hit = F.lit(False)
        for w in words:
            hit = hit | base.contains(w)
        out = F.when(hit, rank).otherwise(out)
    return out
