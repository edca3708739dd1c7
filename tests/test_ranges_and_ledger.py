"""Range plans against all ranges, loads resolved by their log, outcomes of files, and streams in several runs."""

import random

import pytest
from pyspark.sql import functions as F
from spotlake import schemas
from spotlake.functions import bands
from spotlake.operators import ledger, load, ranges
from spotlake.sources import cabrillo
from spotlake.streaming import live

NAN = float("nan")


def looked_up(spark, plan, values):
    p = spark.createDataFrame(plan, "band int, min_mhz double, max_mhz double, priority int")
    df = spark.createDataFrame([(k, v, "x") for k, v in enumerate(values)], "k int, f double, at string")
    return {r.k: r.best and tuple(r.best) for r in ranges.range_lookup(df, "f", p, "min_mhz", "max_mhz", ["priority", "band"], "best").collect()}


def held(plan, v):
    fits = [(p, b) for b, lo, hi, p in plan if v is not None and lo is not None and hi is not None and lo <= v <= hi]
    return min(fits, default=None)


@pytest.mark.parametrize("n", [0, 1, 3, 400])
def test_ranges_against_all(spark, n):
    draw = random.Random(n)
    plan = []
    for k in range(n):
        lo = draw.choice((-5.0, -0.0, 0.0, 1.5, draw.uniform(-10, 10)))
        plan.append((k % 37, lo, lo + draw.choice((0.0, 0.5, 3.0, 40.0, -1.0)), draw.randint(0, 20)))
    plan += [(90, None, 3.0, 0), (91, NAN, 3.0, 0), (92, 0.0, NAN, 0), (93, 2.0, None, 0)] if n else []
    ends = [x for _, lo, hi, _ in plan for x in (lo, hi) if x is not None]
    values = [None, NAN, float("inf"), float("-inf"), 0.0, -0.0, *ends, *(draw.uniform(-12, 50) for _ in range(300)), *(e + 1e-9 for e in ends)]
    assert looked_up(spark, plan, values) == {k: held(plan, v) for k, v in enumerate(values)}


def test_small_and_large_plans_agree(spark, monkeypatch):
    plan = bands.amateur_bands(spark).withColumn("priority", F.lit(1))
    rows = spark.range(3000).select((F.col("id") / 20.0).alias("f"))
    want = sorted(map(str, bands.join_band_plan(rows, "f", plan).collect()))
    monkeypatch.setattr(bands, "PLAN_ROWS", 3)
    assert sorted(map(str, bands.join_band_plan(rows, "f", plan).collect())) == want


def test_many_ranges(spark):
    """200,000 ranges of which each value is in thousands."""
    plan = spark.range(200_000).select(F.col("id").cast("int").alias("band"), (F.col("id") % 50_021).cast("double").alias("min_mhz"), (F.col("id") % 50_021 + F.col("id") % 7_919).cast("double").alias("max_mhz"), F.pmod(F.xxhash64("id"), F.lit(1000)).cast("int").alias("priority"))
    values = spark.range(0, 60_000, 997).select(F.col("id").alias("k"), (F.col("id") + 0.5).alias("f"))
    got = bands.join_band_plan(values, "f", plan)
    best = plan.join(F.broadcast(values), F.col("f").between(F.col("min_mhz"), F.col("max_mhz"))).groupBy("k").agg(F.min(F.struct("priority", "band")).alias("b"))
    want = {r.k: r.band for r in values.join(best, "k", "left").select("k", "b.band").collect()}
    assert {r.k: r.plan_band for r in got.collect()} == want and sum(v is not None for v in want.values()) > 50


def test_ranks(spark):
    df = spark.createDataFrame([(float(x),) for x in random.Random(1).choices(range(500), k=3000)] + [(None,)], "x double").repartition(7)
    got = {r.x: r.i for r in ranges.dense_rank(df, "x").collect()}
    assert got == {x: k for k, x in enumerate(sorted({r.x for r in df.where("x is not null").collect()}))}


SCHEMA = schemas._schema("file_path string, month string, v int")


def rows(spark, *some):
    return spark.createDataFrame(list(some), SCHEMA)


def current(spark, path):
    return sorted(map(tuple, ledger.current_rows(spark, f"{path}/t", f"{path}/log", SCHEMA).collect()))


def test_ledger(spark, tmp_path):
    path = str(tmp_path)
    log = lambda: load.read_log(spark, f"{path}/log", ledger.LOAD_LOG)
    listing = lambda **sizes: spark.createDataFrame(list(sizes.items()), "file_path string, file_size long")
    run = lambda of, **sizes: ledger.load_files(load.plan_growth(listing(**sizes), log()), f"{path}/t", f"{path}/log", lambda names: of.where(F.col("file_path").isin(names)), ["month"], batch_files=2, host="h")
    first = rows(spark, ("a", "1", 1), ("a", "2", 2), ("b", "1", 3), ("c", "9", 4))
    assert run(first, a=10, b=10, c=10, none=5) == 4
    assert {(r.file_path, r.row_count) for r in log().collect()} == {("a", 2), ("b", 1), ("c", 1), ("none", 0)} and all(r.hostname == "h" for r in log().collect())
    assert run(first, a=10, b=10, c=10, none=5) == 0 and len(current(spark, path)) == 4
    # A load that is lost between write and log changes nothing; the next one has part 1 alone.
    ledger.write_load(rows(spark, ("a", "1", 77), ("b", "3", 78)), f"{path}/t", ["month"], ledger.new_load())
    assert len(current(spark, path)) == 4
    assert run(rows(spark, ("a", "1", 9)), a=11, b=10, c=10) == 1
    assert current(spark, path) == [("a", "1", 9), ("b", "1", 3), ("c", "9", 4)]
    # A primed file has no rows, and a file that is empty now has none left.
    assert run(rows(spark), c=12) == 1
    assert current(spark, path) == [("a", "1", 9), ("b", "1", 3)]
    assert len(ledger.vacuum(spark, f"{path}/t", f"{path}/log")) == 1 and current(spark, path) == [("a", "1", 9), ("b", "1", 3)]


def test_outcomes(spark):
    lines = spark.createDataFrame(
        [("ok", 1, "CALLSIGN: k1abc"), ("ok", 2, "QSO: 7000 CW 2005-11-26 0001 K1ABC 599 05 JA1XYZ 599 25"), ("ok", 3, "QSO: bad"), ("bad", 1, "QSO: bad"), ("bad", 2, "QSO: worse"), ("none", 1, "CALLSIGN: k1abc"), ("none", 2, "END-OF-LOG:"), ("none", 3, "QSO: late"), ("blank", 1, "")],
        "file string, line_no long, line string",
    )
    listing = spark.createDataFrame([("ok",), ("ok",), ("bad",), ("none",), ("blank",), ("gone",)], "file string")
    got = {r.file: tuple(r)[1:] for r in cabrillo.file_outcomes(lines, cabrillo.parse_cabrillo(lines), listing).collect()}
    assert got == {
        "ok": ("loaded", 1, 1, None),
        "bad": ("failed", 0, 2, "all 2 QSO lines failed to parse"),
        "none": ("empty", 0, 0, "0 QSOs parsed"),
        "blank": ("empty", 0, 0, "0 QSOs parsed"),
        "gone": ("unreadable", 0, 0, "file can't be read"),
    }
    assert {r.file for r in cabrillo.rejects(lines, cabrillo.parse_cabrillo(lines)).collect()} == {"bad", "none", "blank"}


def test_repeated_run_replaces_its_rows(spark, tmp_path):
    some = spark.createDataFrame([("a", "r"), ("b", "s")], "file string, reason string")
    for run, part in (("1", some), ("2", some), ("1", some.where("file = 'b'")), ("2", some.limit(0))):
        load.append_run(part, str(tmp_path / "t"), run)
    assert [tuple(r) for r in spark.read.schema("file string, reason string, run string").parquet(str(tmp_path / "t")).collect()] == [("b", "s", "1")]


def test_live_state_is_a_row_a_kind(spark, tmp_path):
    path, schema = str(tmp_path), "kind string, time long, a double, b double"
    steps = [
        ([("kp", 5, 3.0, 10.0), ("kp", 4, 9.0, 99.0), ("other", 9, 1.0, 1.0)], (3.0, 145.0, "Unsettled")),
        ([("flux", 2, 180.0, 0.0), ("kp", 1, 8.0, 80.0), ("xray", 7, 0.0, 1e-3)], (3.0, 180.0, "Unsettled + Radio Blackout")),
        ([("kp", 6, 1.0, 4.0), ("flux", 1, 90.0, 0.0), ("xray", 8, 0.0, 0.0)], (1.0, 180.0, "Quiet")),
    ]
    for readings, want in steps:
        spark.createDataFrame(readings, schema).write.mode("append").parquet(f"{path}/in")
        live.refresh_stream(spark.readStream.schema(schema).parquet(f"{path}/in"), f"{path}/live", f"{path}/state", once=True).awaitTermination()
        r = spark.read.parquet(f"{path}/live/table").first()
        assert (r.kp_index, r.solar_flux, r.conditions) == want
        assert spark.read.format("statestore").load(f"{path}/state").count() <= 3
