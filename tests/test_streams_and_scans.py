"""Archives read as streams, ordered scans on many tasks, and compaction of rotated files."""

import io
import json
import random
import tarfile
import zipfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from spotlake.operators import scan
from spotlake.sources import cabrillo, files, replay
from spotlake.streaming import compact, live


def packed(kind, *members):
    out = io.BytesIO()
    if kind == "zip":
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for name, data in members:
                z.writestr(name, data)
    else:
        with tarfile.open(fileobj=out, mode="w:gz" if kind == "tar.gz" else "w") as t:
            for name, data in members:
                info = tarfile.TarInfo(name)
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))
    return out.getvalue()


@pytest.mark.parametrize("kind", ["zip", "tar", "tar.gz"])
def test_archives_as_streams(spark, tmp_path, monkeypatch, kind):
    draw = random.Random(1)
    long = "".join(f"{k},{draw.random()}\r\n" for k in range(120_000)).encode()
    make = {
        "long": packed(kind, ("readme.txt", b"x"), ("a.CSV", long), ("b.csv", b"no")),
        "plain": packed(kind, ("a.csv", b"1,2\n\xff\xfe,3")),
        "blank": packed(kind, ("a.csv", b"")),
        "none": packed(kind, ("a.txt", b"1")),
        "junk": b"\x1f\x8bjunk" * 50,
        "wide": packed(kind, ("a.csv", b"1\n" + b"x" * (files.LINE_CHARS + 5))),
    }
    make["cut"] = make["long"][: len(make["long"]) // 2]
    for name, data in make.items():
        (tmp_path / f"{name}.{kind}").write_bytes(data)
    got = files.stream_archives(spark, f"{tmp_path}/*.{kind}", kind.split(".")[0]).cache()
    name = lambda path: path.rsplit("/", 1)[1].split(".")[0]
    broken = {name(r.file) for r in files.archive_faults(got).collect()}
    assert broken == {"none", "junk", "wide", "cut"}
    whole = files.whole_archives(got)
    assert [(r.line_no, r.line) for r in whole.where("file like '%/long.%'").orderBy("line_no").collect()] == list(enumerate(long.decode().splitlines(), 1))
    assert [r.line for r in whole.where("file like '%/plain.%'").orderBy("line_no").collect()] == ["1,2", "\ufffd\ufffd,3"]
    assert {name(r.file) for r in whole.select("file").distinct().collect()} == {"long", "plain"}


def test_scans_on_many_tasks(spark):
    draw = random.Random(2)
    rows = [("hot" if draw.random() < 0.7 else f"g{draw.randrange(40)}", k, draw.choice((None, None, k * 3)), draw.choice((None, 1, 5))) for k in range(6000)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, k long, a long, b long")
    w = Window.partitionBy("g").orderBy("k")
    want = df.select("*", F.last("a", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("x"), F.sum("b").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("y"), F.lag("a").over(w).alias("z"))
    for tasks in (1, 5, 64):
        got = scan.ordered_scan(df, ["g"], ["k"], last={"x": "a"}, total={"y": "b"}, before={"z": "a"}, tasks=tasks)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert scan.ordered_scan(df.limit(0), ["g"], ["k"], last={"x": "a"}, tasks=4).count() == 0


def test_a_long_log_on_many_tasks(spark):
    head = [("log", 1, "CONTEST: a"), ("log", 2, "GRID-LOCATOR: fn42"), ("log", 50, "CALLSIGN: k1abc"), ("log", 4000, "CALLSIGN: k2abc"), ("log", 4500, "CONTEST: b"), ("log", 4900, "END-OF-LOG:")]
    rows = head + [("log", 10 + 10 * k + 5, "QSO: 7000 CW 2005-11-26 0001 K1ABC 599 05 JA1XYZ 599 25") for k in range(499)] + [("other", 1, "QSO: 7000 CW 2005-11-26 0001 K1ABC 599 05 JA1XYZ 599 25")]
    lines = spark.createDataFrame(rows, "file string, line_no long, line string")
    some = lambda df: sorted(map(str, df.collect()))
    want = some(cabrillo.parse_cabrillo(lines))
    for tasks in (1, 16):
        assert some(cabrillo.parse_cabrillo(lines, tasks=tasks)) == want
    assert sum("no callsign" in x for x in want) == 5


def test_compaction(spark, tmp_path):
    src, dst, arrived = (str(tmp_path / n) for n in ("rotated", "few", "in"))

    def arrive(name, times):
        folder = tmp_path / "in"
        folder.mkdir(exist_ok=True)
        (folder / f"{name}.txt").write_text("\n".join(json.dumps({"t": t, "sc": f"K{t}", "rc": "W1AW", "sl": "FN42", "rl": "", "rp": 1, "f": 14074000, "md": "FT8"}) for t in times))
        spots = live.normalize_live(live.read_spot_stream(spark, path=arrived))
        live.write_jsonl_rotated(spots, src, str(tmp_path / "state"), once=True).awaitTermination()

    def spots():
        return sorted(r.sc for r in compact.compacted_spots(spark, src, dst).collect())

    hour, every = 3600, []
    for k in range(4):
        times = [h * hour + k for h in range(3)] * 2
        every += [f"K{t}" for t in times]
        arrive(k, times)
    assert spots() == sorted(every)
    assert compact.compact(spark, src, dst, "1970-01-01-02") == 2 and compact.compact(spark, src, dst, "1970-01-01-02") == 0
    assert spots() == sorted(every)
    assert {r.hour: r.files for r in compact.rotated_hours(spark, f"{dst}/spots").collect()} == {"1970-01-01-00": 1, "1970-01-01-01": 1}
    arrive("late", [100])  # into a closed hour
    assert spots() == sorted([*every, "K100"]) and compact.compact(spark, src, dst, "1970-01-01-02") == 1
    assert spots() == sorted([*every, "K100"])
    assert compact.compact(spark, src, dst, "1970-01-01-04", target_bytes=100) == 1 and spots() == sorted([*every, "K100"])


def test_log_with_offsets_is_replayable(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    messages = lambda *some: spark.createDataFrame(list(some), "key string, value string")

    def run(state):
        lines = live.read_spot_stream(spark, "spot_log", {"path": log})
        lines.writeStream.format("parquet").option("path", f"{out}-{state}").option("checkpointLocation", str(tmp_path / state)).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.line for r in spark.read.schema("line string").parquet(f"{out}-{state}").collect())

    first = [(None, "a"), ("{bad", "b\u00e9"), ("k", None), ("k", "c\nd"), *(("k", f"m{i:02}") for i in range(25))]
    assert replay.publish(messages(*first), log, partitions=3, segment_rows=10) == len(first)
    want = sorted(v or "" for _, v in first)
    assert run("one") == want and run("one") == want
    assert replay.publish(messages(("k", "later"), (None, "z")), log, partitions=3) == 2 and replay.publish(messages(), log, partitions=3) == 0
    assert run("one") == sorted([*want, "later", "z"])  # what is new alone was read
    assert run("two") == sorted([*want, "later", "z"])  # a new reader has all from the start
    held = replay.segments(log)
    assert all(a[0] + a[1] == b[0] for s in held.values() for a, b in zip(s, s[1:], strict=False)) and sum(r for s in held.values() for _, r, _ in s) == len(first) + 2
