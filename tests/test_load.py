"""Loading, planning and the live stream on files."""

import json

from pyspark.sql import functions as F
from spotlake import schemas
from spotlake.operators import load, quality, solar
from spotlake.streaming import live


def spots(spark, *rows):
    return spark.createDataFrame(list(rows), "file string, month string, v int")


def read(spark, path):
    return sorted((r.file, r.month, r.v) for r in spark.read.schema("file string, v int, month string").parquet(path).collect())


def test_replace_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spots(spark, ("a", "202401", 1), ("b", "202402", 2))
    for _ in range(2):
        load.replace_partitions(first, path, ["month"])
    assert read(spark, path) == [("a", "202401", 1), ("b", "202402", 2)]
    load.replace_partitions(spots(spark, ("a", "202401", 9)), path, ["month"])
    assert read(spark, path) == [("a", "202401", 9), ("b", "202402", 2)]
    load.append(spots(spark, ("c", "202403", 3)), path, ["month"])
    assert len(read(spark, path)) == 3


def test_replace_files_keeps_others(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        load.replace_files(spots(spark, ("a", "202401", 1), ("b", "202401", 2)), path, ["month"])
    load.replace_files(spots(spark, ("a", "202401", 7)), path, ["month"])
    assert read(spark, path) == [("a", "202401", 7), ("b", "202401", 2)]


def listing(spark, *rows):
    return spark.createDataFrame(list(rows), "file_path string, file_size long")


def test_incremental_prime_and_growth(spark, tmp_path):
    log_path, seen = str(tmp_path / "log"), []
    files = listing(spark, ("a", 10), ("b", 20), ("c", 30))
    log = lambda: load.read_log(spark, log_path, schemas.INGEST_LOG)
    run = lambda files, **how: load.incremental_load(files, log(), log_path, lambda names: names, seen.extend, host="h", **how)
    load.append_log(load.prime(files.where("file_path = 'a'"), log()), log_path)
    assert run(files, batch_files=1) == 2 and seen == ["b", "c"]
    assert run(files) == 0
    assert run(listing(spark, ("a", 11), ("b", 19), ("c", 30)), growth=True) == 1 and seen[-1] == "a"
    assert run(listing(spark, ("a", 11)), growth=True) == 0
    assert load.latest_log(log()).count() == 3


def test_csv_to_parquet(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,x\nbad,y\n2,z\n")
    load.csv_to_parquet(spark, f"{tmp_path}/a.csv", f"{tmp_path}/out", "n int, s string")
    assert sorted(r.n for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2]


def test_conform_has_no_nulls(spark):
    df = schemas.conform(spark.createDataFrame([("2024-01-01", None)], "date string, ssn double"), schemas.SOLAR)
    r = df.first()
    assert df.columns == schemas.SOLAR.names and r.ssn == 0 and r.source_file == ""


def message(n, f=14074000, sc="K1ABC"):
    return json.dumps({"t": 1700000000 + n, "sc": sc, "rc": "W1AW", "sl": "FN42", "rl": "bad", "rp": -5, "f": f, "md": "FT8"})


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("\n".join([message(1), "{bad", message(2, 50_000_000), message(3, sc="")]))
    for k in (2, 3):
        spots_in = live.normalize_live(live.read_spot_stream(spark, path=src))
        live.write_jsonl_rotated(spots_in, out, state, once=True).awaitTermination()
        (tmp_path / "in" / f"{k}.txt").write_text(message(10 * k))
    spots_in = live.normalize_live(live.read_spot_stream(spark, path=src))
    live.write_jsonl_rotated(spots_in, out, state, once=True).awaitTermination()
    got = sorted(r.ts for r in spark.read.json(out).collect())
    batch = live.normalize_live(spark.read.text(src).withColumnRenamed("value", "line"))
    assert got == sorted(r.ts for r in batch.where("_status = 'ok'").collect()) and len(got) == 3
    live.ingest_jsonl(spark, out, str(tmp_path / "bronze"), str(tmp_path / "state2")).awaitTermination()
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    assert bronze.count() == 3 and set(bronze.columns) == set(schemas.PSKR.names)


def test_stream_counters_and_dedupe(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("\n".join([message(1), message(1), message(1, sc="K9X"), "{bad"]))
    rows = live.normalize_live(live.read_spot_stream(spark, path=str(tmp_path / "in"))).withColumn("event_time", F.coalesce(F.try_to_timestamp("ts"), F.lit("2023-11-14 22:13:21").cast("timestamp")))
    q = live.dedupe_stream(rows, ["sc", "f"]).writeStream.format("memory").queryName("once").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination()
    assert spark.sql("select * from once").count() == 2
    q = live.counters(rows, delay="0 seconds").writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "d")).start()
    q.awaitTermination()
    assert spark.sql("select sum(received), sum(written), sum(invalid) from counted").first() == (4, 3, 1)


def test_refresh_live(spark, tmp_path):
    kp = spark.createDataFrame([(1, 2.0, 3.0), (2, 6.0, 40.0)], "time int, kp_index double, ap_index double")
    xray = spark.createDataFrame([(1, 0.0, 2e-5)], "t int, xray_short double, xray_long double")
    flux = spark.createDataFrame([], "time int, flux double")
    for _ in range(2):
        live.refresh_live(kp, xray, flux, str(tmp_path / "live"))
    r = spark.read.parquet(str(tmp_path / "live/table")).collect()
    assert len(r) == 1 and (r[0].kp_index, r[0].solar_flux, r[0].conditions) == (6.0, 145.0, "Storm + Radio Blackout")


def test_last_reading_wins(spark):
    df = spark.createDataFrame([(0, "0.05-0.4nm", 2.0, 0), (0, "0.05-0.4nm", 1.0, 1), (60, "other", 9.0, 2)], "t long, energy string, flux double, pos int")
    assert [tuple(r) for r in solar.pivot_xray(df, order="pos").collect()] == [(0, 1.0, 0.0)]


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "file_path string, file_size long, row_count long, elapsed_ms long")
    assert quality.run_stats(none).first().rows_per_s == 0.0
    assert load.plan_incremental(none.select("file_path", "file_size"), none).count() == 0
