"""Range layout of small and tied partitions, plans looked up by distinct values, archives in bounded batches, and logs of many segments."""

import random

from pyspark.sql import functions as F
from spotlake.operators import load, ranges
from spotlake.plans import feeds
from spotlake.plans.queries import QUERIES
from spotlake.sources import cabrillo, files, replay

from oracle import SF


def layout(spark, path, rows, **how):
    df = spark.createDataFrame(rows, "part string, v int, k int").repartition(3)
    load.range_clustered(df, ["part"], ["v", "k"], **how).write.partitionBy("part").parquet(path)
    back = spark.read.schema("v int, k int, part string").parquet(path).select("part", "v", "k", F.col("_metadata.file_path").alias("file")).collect()
    assert sorted((r.part or "", r.v or 0, r.k) for r in back) == sorted((p or "", v or 0, k) for p, v, k in rows)
    files = {}
    for r in back:
        files.setdefault(r.part, {}).setdefault(r.file, []).append((r.v or -1, r.k))
    for of in files.values():
        ends = sorted((min(x), max(x)) for x in of.values())
        assert all(a[1] < b[0] for a, b in zip(ends, ends[1:], strict=False))
    return {p: len(of) for p, of in files.items()}


def test_range_layout_spreads_partitions_below_a_file(spark, tmp_path):
    """A partition of fewer rows than a file's lies in two files if it is above the bound, wherever ranges end; ties stay together."""
    draw = random.Random(4)
    rows = [("hot", draw.randrange(900), k) for k in range(4000)] + [(None, None if k % 5 == 0 else k, k) for k in range(300)]
    rows += [(p, k % 7, k) for p, n in (("a", 60), ("b", 70), ("c", 40), ("one", 1)) for k in range(n)]
    rows += [("tied", 3, 3)] * 200 + [("low", 1, 1)] * 199 + [("low", 1, 2)]
    got = layout(spark, str(tmp_path / "t"), rows, file_rows=1000, spread_rows=50)
    assert got == {"hot": 4, None: 2, "a": 2, "b": 2, "c": 1, "one": 1, "tied": 1, "low": 2}
    assert set(layout(spark, str(tmp_path / "u"), rows, file_rows=1000).values()) == {1, 4}
    assert layout(spark, str(tmp_path / "none"), [], file_rows=1000, spread_rows=5) == {}


def test_plan_lookup_by_distinct_values(spark, tmp_path):
    """Many rows of few values: what is looked up are the values, so that the search runs over a handful of rows."""
    plan = spark.createDataFrame([(k, float(k), k + 0.5, k % 3) for k in range(400)], "band int, lo double, hi double, priority int")
    values = [0.25, -0.0, 0.0, 7.5, 7.75, -3.0, 399.5, float("nan"), None]
    df = spark.range(9000).select("id", F.get(F.array(*[F.lit(v).cast("double") for v in values]), (F.col("id") % 9).cast("int")).alias("f"))
    met = ranges.range_lookup(df, "f", plan, "lo", "hi", ["priority", "band"], "best")
    assert {(r.id % 9, r.best and r.best.band, r.n) for r in met.groupBy((F.col("id") % 9).alias("id"), "best").agg(F.count("*").alias("n")).collect()} == {(k, b, 1000) for k, b in enumerate((0, 0, 0, 7, None, None, 399, None, None))}
    # The search is done when the plan is looked up in, for the distinct values alone.
    assert "aggregate(" not in met._jdf.queryExecution().optimizedPlan().toString()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rejects_of_several_runs_are_parsed_once(spark, monkeypatch):
    plans, append_run = [], load.append_run
    monkeypatch.setattr(load, "append_run", lambda rows, *how: (plans.append(plan_of(rows)), append_run(rows, *how)))
    assert QUERIES["cabrillo_rejects_readback"](spark, SF).count() > 0
    assert len(plans) == 3 and not any("Window" in p for p in plans)


def test_contest_lines_are_sorted_once(spark):
    """All windows of a log share one order, and the sorted rows have the line once."""
    lines = spark.createDataFrame([("a", 1, "CALLSIGN: k1abc"), ("a", 2, "QSO: 7000 CW 2005-11-26 0001 K1ABC 599 05 JA1XYZ 599 25")], "file string, line_no long, line string")
    plan = plan_of(cabrillo.parse_cabrillo(lines))
    assert plan.count("+- Sort [") == 1 and "_up" not in plan


def test_log_tasks_read_many_segments(spark, tmp_path):
    """Segments of a few messages are read by few tasks, and each stretch covers its offsets once."""
    log = str(tmp_path / "log")
    rows = spark.range(3000).select((F.col("id") % 5).cast("string").alias("key"), F.col("id").cast("string").alias("value"))
    assert replay.publish(rows, log, partitions=2, segment_rows=50) == 3000
    reader = replay.SpotLogReader(log)
    parts = reader.partitions({"0": 7}, reader.latestOffset())
    assert len(parts) <= 2 and len(replay.segments(log)[0]) + len(replay.segments(log)[1]) >= 60
    got = [(p, offset) for s in parts for p, offset, _, _ in reader.read(s)]
    assert sorted(got) == [(p, k) for p, n in sorted(replay.ends(log).items()) for k in range(0 if p else 7, n)]


def test_archives_are_read_one_at_a_time(spark):
    archives = spark.createDataFrame([], "path string, content binary")
    assert "FlatMapGroupsInArrow" in plan_of(files.archive_lines(archives, "zip"))
    packed = feeds._archives(spark.createDataFrame([("a", 1, "x")], "file string, line_no long, line string"), "zip")
    assert "FlatMapGroupsInArrow" in plan_of(packed) and [r.line for r in files.archive_lines(packed, "zip").collect()] == ["x"]
