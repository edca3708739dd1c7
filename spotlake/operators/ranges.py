"""Range plans of any size: overlapping ranges cut into disjoint segments, and values looked up in them.

The distinct ends of all ranges are ranked; between and on them lie slots (two for each end: the end itself and the gap behind it) in which nothing
changes. A range covers a run of slots, which is cut into at most two nodes of each level of a binary tree, and each node keeps its best range. The winner
of a slot is the best of its ancestors. So the work grows as n log n however the ranges overlap, and all of it is grouping and equi-joins.

The distinct values and the ends are then sorted together, dealt by ranges, and a value takes the last end up to it; the rows meet their value's
range in an equi-join. So the work of a row is that of a grouping and a join, and only distinct values are searched for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import stored
from .scan import ordered_scan


def dense_rank(values: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` (not null) and their rank i from 0: sorted by ranges, numbered in each partition, and moved
    by the number of values in the partitions before. Only a count of each partition meets in one task."""
    own = (1 << 33) - 1
    dealt = values.select(column).where(F.col(column).isNotNull()).distinct().repartitionByRange(column).sortWithinPartitions(column)
    placed = stored(dealt.withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.select(column, F.shiftright("_id", 33).alias("_p"), F.col("_id").bitwiseAND(F.lit(own)).alias("_i"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n")).select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # A row for each partition.
    return placed.join(F.broadcast(offsets), "_p").select(column, (F.col("_i") + F.col("_before")).alias("i"))


def disjoint_segments(plan: DataFrame, lo: str, hi: str, order: list[str]) -> DataFrame:
    """x (each distinct end), i (its rank), at and after: of the ranges [lo, hi] of ``plan`` that hold x, and of those that hold the gap
    behind it, the first by ``order`` (a struct of these columns; null if there is none).

    Ranges with a null or NaN end, or with ends in the wrong order, hold nothing."""
    ranges = plan.select(F.col(lo).cast("double").alias("lo"), F.col(hi).cast("double").alias("hi"), F.struct(*order).alias("best")).where("lo <= hi and not isnan(hi)")
    ranges = stored(ranges.groupBy("lo", "hi").agg(F.min("best").alias("best")))
    ends = stored(dense_rank(ranges.select(F.col("lo").alias("x")).unionAll(ranges.select("hi")), "x"))
    levels = max(1, (2 * ends.count()).bit_length())
    of = lambda side, name: ends.select(F.col("x").alias(side), F.col("i").alias(name))
    spans = ranges.join(of("lo", "_a"), "lo").join(of("hi", "_b"), "hi").select("best", F.expr("2 * _a").alias("a"), F.expr("2 * _b + 1").alias("b"))
    # Of each level: the node at the left end of what is left there, if it is a right child, and that at the right end, if a left one.
    cut = f"""inline(flatten(transform(sequence(0, {levels}), t -> filter(array(
        struct(t as level, shiftright(a + shiftleft(1L, t) - 1, t) as node, true as left, shiftright(b, t) as stop),
        struct(t as level, shiftright(b, t) - 1 as node, false as left, shiftright(a + shiftleft(1L, t) - 1, t) as stop)),
        n -> if(n.left, n.node < n.stop and n.node % 2 = 1, n.stop <= n.node and n.node % 2 = 0)))))"""
    nodes = spans.select("best", F.expr(cut)).groupBy("level", "node").agg(F.min("best").alias("best"))
    slots = ends.select("i", F.expr(f"inline(flatten(transform(sequence(0, {levels}), t -> array(struct(t as level, shiftright(2 * i, t) as node, true as on), struct(t as level, shiftright(2 * i + 1, t) as node, false as on)))))"))
    won = slots.join(nodes, ["level", "node"]).groupBy("i").agg(F.min(F.when(F.col("on"), F.col("best"))).alias("at"), F.min(F.when(~F.col("on"), F.col("best"))).alias("after"))
    return ends.join(won, "i", "left").select("x", "i", "at", "after")


def place(array: Column, value: Column, size: int) -> Column:
    """How many elements of a sorted array are at most ``value``."""
    start = F.struct(F.lit(0).alias("lo"), F.size(array).alias("hi"))

    def half(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        low = F.get(array, middle) <= value
        left = F.struct(F.when(low, middle + 1).otherwise(s["lo"]).alias("lo"), F.when(low, s["hi"]).otherwise(middle).alias("hi"))
        return F.when(s["lo"] < s["hi"], left).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(size.bit_length() + 1)), start, half)["lo"]


def range_lookup(df: DataFrame, value: str, plan: DataFrame, lo: str, hi: str, order: list[str], out: str) -> DataFrame:
    """``df`` with the column ``out``: of the ranges [lo, hi] of ``plan`` that hold ``value``, the first by ``order`` (its columns
    as a struct); null if there is none, and for null and NaN values. Every row of ``df`` stays once, however many ranges overlap.

    A distinct value is looked up once, and the rows meet what was found in an equi-join: ``df`` is read twice."""
    ends = disjoint_segments(plan, lo, hi, order).select(F.lit(0).alias("_all"), "x", F.lit(0).alias("_kind"), F.struct("x", "at", "after").alias("_end"))
    number = F.col(value).cast("double")
    known = F.when(~F.isnan(number), number)
    values = df.select(known.alias("x")).where("x is not null").distinct().select(F.lit(0), "x", F.lit(1), F.lit(None).cast(ends.schema["_end"].dataType))
    met = ordered_scan(ends.unionAll(values), ["_all"], ["x", "_kind"], last={"_last": "_end"}).where("_kind = 1")
    best = met.select(F.col("x").alias("_v"), F.when(F.col("_last.x") == F.col("x"), F.col("_last.at")).otherwise(F.col("_last.after")).alias(out))
    best = stored(best.where(F.col(out).isNotNull()))
    return df.withColumn("_v", known).join(best, "_v", "left").select(*df.columns, out)
