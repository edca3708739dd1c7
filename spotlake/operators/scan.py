"""Ordered scans of groups of any size: values carried forward, running sums and the row before, on many tasks.

Rows are dealt by sampled ranges of the group and its order, so that a long group lies in several partitions one after the other. Each piece (the rows of a group in a
partition) is scanned by itself; a summary of each piece (its last value, its sum, its last row) is composed over the pieces before, and added to
its rows. Only groups that lie in several partitions have such summaries, two a partition at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import stored


def ordered_scan(df: DataFrame, keys: list[str], order: list[str], *, last: dict[str, str] | None = None, total: dict[str, str] | None = None, before: dict[str, str] | None = None, tasks: int | None = None) -> DataFrame:
    """``df`` with columns that follow the ``order`` inside each group of ``keys`` (not null), each named after what it is made of:

    last: the value of a column in the last row, up to this one, in which it isn't null; total: the sum of a column up to this
    row; before: the value of a column in the row before (null in the first). Rows that tie in ``order`` are in any one order."""
    last, total, before = last or {}, total or {}, before or {}
    dealt = df.repartitionByRange(tasks, *keys, *order) if tasks else df.repartitionByRange(*keys, *order)
    # Written: the pieces stay as they are, whatever task is run again.
    rows = stored(dealt.withColumn("_piece", F.spark_partition_id()))
    by = F.struct(*order)
    piece = ["_piece", *keys]
    pieces = rows.groupBy(*piece).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), by)).alias(f"_last_{o}") for o, c in last.items()],
        *[F.sum(c).alias(f"_total_{o}") for o, c in total.items()],
        *[F.max_by(F.struct(c), by).alias(f"_before_{o}") for o, c in before.items()],
    )
    spread = pieces.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    ahead = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.join(spread, keys, "left_semi").select(
        *piece,
        *[F.last(f"_last_{o}", ignorenulls=True).over(ahead).alias(f"_last_{o}") for o in last],
        *[F.sum(f"_total_{o}").over(ahead).alias(f"_total_{o}") for o in total],
        *[F.last(f"_before_{o}").over(ahead).alias(f"_before_{o}") for o in before],
    )
    here = Window.partitionBy(*piece).orderBy(*order)
    so_far = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def sum_of(local: Column, ahead: Column) -> Column:
        return F.when(local.isNull(), ahead).otherwise(local + F.coalesce(ahead, F.lit(0)))

    scanned = rows.select(
        "*",
        *[F.last(c, ignorenulls=True).over(so_far).alias(f"_here_last_{o}") for o, c in last.items()],
        *[F.sum(c).over(so_far).alias(f"_here_total_{o}") for o, c in total.items()],
        *[F.lag(F.struct(c)).over(here).alias(f"_here_before_{o}") for o, c in before.items()],
    )
    met = scanned.join(F.broadcast(carried), piece, "left")
    return met.select(
        *df.columns,
        *[F.coalesce(f"_here_last_{o}", f"_last_{o}").alias(o) for o in last],
        *[sum_of(F.col(f"_here_total_{o}"), F.col(f"_total_{o}")).alias(o) for o in total],
        *[F.coalesce(f"_here_before_{o}", f"_before_{o}")[c].alias(o) for o, c in before.items()],
    )
