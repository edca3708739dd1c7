"""Queries that write tables, logs, reports and streams, and read them back. What they write is derived from the given
tables and lies in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..operators import ledger, load, quality
from ..shared import scratch, stored
from ..sources import cabrillo, files, pskr, replay
from ..streaming import compact, live
from .registry import register
from .views import view


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, v and part (the year) of the orders."""
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v"), F.date_format("o_orderdate", "yyyy").alias("part"))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("k long, v long, part string").parquet(path).select("k", "v", "part")


_O = "o as (select o_orderkey as k, o_custkey as v, strftime(o_orderdate, '%Y') as part from orders)"


# --- loading


@register(f"with {_O} select k, v, part from o union all select k, v + 1, part from o where v >= 50")
def append_readback(spark, sf_dir):
    path, rows = scratch(spark), _orders(spark, sf_dir)
    load.append(rows, path, ["part"])
    load.append(rows.where("v >= 50").withColumn("v", F.col("v") + 1), path, ["part"])
    return _stored(spark, path)


@register(f"with {_O} select k, case when part < '1996' then v + 1 else v end as v, part from o")
def replace_partitions_readback(spark, sf_dir):
    """Partitions of the early years are loaded again, twice; the others stay."""
    path, rows = scratch(spark), _orders(spark, sf_dir)
    load.replace_partitions(rows, path, ["part"])
    for _ in range(2):
        load.replace_partitions(rows.where("part < '1996'").withColumn("v", F.col("v") + 1), path, ["part"])
    return _stored(spark, path)


@register(f"with {_O} select k, case when part < '1996' and v < 100 then v + 1 else v end as v, part from o")
def replace_files_readback(spark, sf_dir):
    """Rows of some files of the early years are loaded again; other files of the same partitions stay."""
    path, rows = scratch(spark), _orders(spark, sf_dir).withColumn("file", F.when(F.col("v") < 100, "a").otherwise("b"))
    load.replace_files(rows, path, ["part"])
    load.replace_files(rows.where("part < '1996' and file = 'a'").withColumn("v", F.col("v") + 1), path, ["part"])
    return _stored(spark, path)


@register(f"with {_O} select k, v + 1 as v, part from o where part >= '1996'")
def replace_table_readback(spark, sf_dir):
    path, rows = scratch(spark), _orders(spark, sf_dir)
    load.replace_table(rows, path)
    load.replace_table(rows.where("part >= '1996'").withColumn("v", F.col("v") + 1), path)
    return _stored(spark, path)


@register(f"with {_O} select part, count(*) as n, min(v) as least, max(v) as greatest, 1::bigint as files, true as in_order from o group by part")
def clustered_readback(spark, sf_dir):
    """A partition is one file, sorted by the value."""
    path = scratch(spark)
    load.clustered(_orders(spark, sf_dir), ["part"], ["v"]).write.partitionBy("part").parquet(path)
    rows = spark.read.schema("k long, v long, part string").parquet(path).select("part", "v", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("place"))
    placed = rows.groupBy("part", "file", "v").agg(F.min("place").alias("first"), F.max("place").alias("last"), F.count(F.lit(1)).alias("n"))
    # In a sorted file the rows of a value stand side by side.
    whole = placed.groupBy("part").agg(F.sum("n").alias("n"), F.min("v").alias("least"), F.max("v").alias("greatest"), F.count_distinct("file").alias("files"), F.bool_and(F.col("last") - F.col("first") + 1 == F.col("n")).alias("in_order"))
    return whole.select("part", "n", "least", "greatest", "files", "in_order")


@register("select o_orderkey as k, o_totalprice as price, o_orderdate::date as day from orders where o_orderkey % 11 <> 0")
def csv_to_parquet_readback(spark, sf_dir):
    """Malformed rows are dropped, and the second run leaves the finished output alone."""
    path, k = scratch(spark), F.col("o_orderkey")
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet")
    line = F.concat_ws(";", F.when(k % 11 == 0, "bad").otherwise(k.cast("string")), F.col("o_totalprice").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows.select(line.alias("value")).write.text(f"{path}/csv")
    kind = "k long, price double, day date"
    first = load.csv_to_parquet(spark, f"{path}/csv", f"{path}/out", kind, delimiter=";")
    rows.limit(1).select(F.lit("1;2.0;2024-01-01").alias("value")).write.mode("overwrite").text(f"{path}/csv")
    if not first or load.csv_to_parquet(spark, f"{path}/csv", f"{path}/out", kind, delimiter=";"):
        raise RuntimeError("a finished output was not skipped")
    return spark.read.parquet(f"{path}/out")


@register("select file_path, file_size, 0::bigint as row_count, timestamp '2024-01-01 00:00:00' as loaded_at, 7::bigint as elapsed_ms, 'h' as hostname from file_listing", "file_listing")
def log_append_readback(spark, sf_dir):
    """Half of the files are logged as primed; the rest follow from a plan on that log."""
    path, listing = scratch(spark), view(spark, sf_dir, "file_listing")
    how = {"host": "h", "now": F.lit("2024-01-01").cast("timestamp"), "elapsed_ms": F.lit(7)}
    log = lambda: load.read_log(spark, path, schemas.INGEST_LOG)
    load.append_log(load.prime(listing.where("file_path like '%.gz'"), log(), **how), path)
    load.append_log(load.log_entries(load.plan_incremental(listing, log()), **how), path)
    return log()


def _file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as rows of source files, each with several years."""
    return _orders(spark, sf_dir).withColumn("file_path", F.concat(F.lit("f"), (F.col("v") % 97).cast("string")))


def _listing(rows: DataFrame) -> DataFrame:
    return rows.groupBy("file_path").agg(F.count(F.lit(1)).alias("file_size"))


def _grown(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A load of all files; a load that was lost after it wrote; and one of every third file, grown by its own listing, with the later years alone."""
    rows, log = _file_rows(spark, sf_dir), lambda: load.read_log(spark, f"{path}/log", ledger.LOAD_LOG)
    third = F.regexp_extract("file_path", "[0-9]+", 0).cast("int") % 3 == 0
    reader = lambda of: lambda names: of.where(F.col("file_path").isin(names))
    ledger.load_files(load.plan_growth(_listing(rows), log()), f"{path}/table", f"{path}/log", reader(rows), ["part"], batch_files=40)
    ledger.write_load(rows.withColumn("v", F.lit(-1).cast("long")), f"{path}/table", ["part"], ledger.new_load())
    later = rows.where(third & F.col("part").between("1995", "1997")).withColumn("v", F.col("v") + 1)
    grown = _listing(rows).withColumn("file_size", F.col("file_size") + F.when(third, 1).otherwise(0))
    ledger.load_files(load.plan_growth(grown, log()), f"{path}/table", f"{path}/log", reader(later), ["part"], batch_files=40)


_FILES = f"with {_O}, r as (select *, 'f' || (v % 97) as file_path, v % 97 % 3 = 0 as again from o)"
_LEDGER = "k long, v long, part string, file_path string"


@register(f"{_FILES} select k, case when again then v + 1 else v end as v, part, file_path from r where not again or part between '1995' and '1997'")
def ledger_readback(spark, sf_dir):
    """Rows of the last load that was logged: none of a lost load, and none of a reloaded file in partitions that it has no more."""
    path = scratch(spark)
    _grown(spark, sf_dir, path)
    return ledger.current_rows(spark, f"{path}/table", f"{path}/log", schemas._schema(_LEDGER))


@register(f"""{_FILES}, n as (select file_path, again, count(*) as n, count(*) filter (part between '1995' and '1997') as later from r group by all)
  select file_path, n as file_size, n as row_count, true as timed, 1::bigint as entry from n union all select file_path, n + 1, later, true, 2 from n where again""")
def ledger_log_readback(spark, sf_dir):
    """The log's entries in order: rows as counted in what was written, and times that add up to those of the loads."""
    path = scratch(spark)
    _grown(spark, sf_dir, path)
    log = load.read_log(spark, f"{path}/log", ledger.LOAD_LOG)
    entry = F.row_number().over(Window.partitionBy("file_path").orderBy("load_id")).cast("long")
    timed = F.sum("elapsed_ms").over(Window.partitionBy("load_id")) > 0
    return log.select("file_path", "file_size", "row_count", timed.alias("timed"), entry.alias("entry"))


@register(f"{_FILES} select k, case when again then v + 1 else v end as v, part from r where not again or part between '1995' and '1997'")
def vacuum_readback(spark, sf_dir):
    """The same rows after the loads that nobody reads are gone."""
    path = scratch(spark)
    _grown(spark, sf_dir, path)
    lost = ledger.vacuum(spark, f"{path}/table", f"{path}/log")
    if len(lost) != 1 or ledger.vacuum(spark, f"{path}/table", f"{path}/log"):
        raise RuntimeError("just the lost load should have gone")
    return ledger.current_rows(spark, f"{path}/table", f"{path}/log", schemas._schema(_LEDGER)).select("k", "v", "part")


@register(f"{_FILES} select file_path, count(*) as file_size, count(*) as row_count, true as timed from r group by file_path")
def measured_log_readback(spark, sf_dir):
    """The log of an incremental load whose writer counts: a second run finds nothing to load."""
    path, rows = scratch(spark), _file_rows(spark, sf_dir)
    log = lambda: load.read_log(spark, f"{path}/log", schemas.INGEST_LOG)

    def write(batch: DataFrame) -> DataFrame:
        load.append(batch, f"{path}/table", ["part"])
        return batch.groupBy("file_path").agg(F.count(F.lit(1)).alias("row_count"))

    for _ in range(2):
        load.incremental_load(_listing(rows), log(), f"{path}/log", lambda names: rows.where(F.col("file_path").isin(names)), write, batch_files=40)
    return log().select("file_path", "file_size", "row_count", (F.col("elapsed_ms") > 0).alias("timed"))


@register("""with seen as (select cast(c_custkey as varchar) as file, count(o_orderkey) filter (c_custkey % 13 <> 0 and o_orderkey % 3 <> 2) as n_ok, count(o_orderkey) as n from customer left join orders on o_custkey = c_custkey group by c_custkey),
  r as (select file, case when n = 0 then '0 QSOs parsed' else 'all ' || n || ' QSO lines failed to parse' end as reason from seen where n_ok = 0)
  select file, reason, run from r, (values ('a'), ('b')) t(run)""")
def cabrillo_rejects_readback(spark, sf_dir):
    """The rejects of two runs; the first was repeated, with half of the files and then all."""
    path, lines = scratch(spark), view(spark, sf_dir, "cabrillo_lines")
    # Written once: each run would parse all logs again.
    found = stored(cabrillo.rejects(lines, cabrillo.parse_cabrillo(lines)))
    for run, rows in (("a", found.where(F.col("file").cast("int") % 2 == 0)), ("a", found), ("b", found)):
        load.append_run(rows, path, run)
    return spark.read.schema("file string, reason string, run string").parquet(path).select("file", "reason", "run")


@register(f"with {_O}, h as (select k, v, case when k % 10 < 7 then '1995' else part end as part from o) select part, count(*) as n, min(v) as least, max(v) as greatest, true as apart, count(*) > 500 as many from h group by part")
def range_layout_readback(spark, sf_dir):
    """A hot partition is spread over many files, whose ranges don't overlap: only values at the ends may be in two files."""
    path, rows = scratch(spark), _orders(spark, sf_dir)
    rows = rows.withColumn("part", F.when(F.col("k") % 10 < 7, "1995").otherwise(F.col("part")))
    load.range_clustered(rows, ["part"], ["v", "k"], file_rows=max(100, rows.count() // 20), spread_rows=500).write.partitionBy("part").parquet(path)
    of = F.struct("v", "k")
    each = spark.read.schema("k long, v long, part string").parquet(path).groupBy("part", F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"), F.min(of).alias("lo"), F.max(of).alias("hi"))
    each = each.withColumn("before", F.lag("hi").over(Window.partitionBy("part").orderBy("lo")))
    whole = each.groupBy("part").agg(F.sum("n").alias("n"), F.min("lo.v").alias("least"), F.max("hi.v").alias("greatest"), F.bool_and(F.coalesce(F.col("before") < F.col("lo"), F.lit(True))).alias("apart"), F.count(F.lit(1)).alias("files"))
    hot = F.col("n") > 500
    return whole.select("part", "n", "least", "greatest", "apart", (hot & (F.col("files") > 1)).alias("many"))


@register("""with s as (select count(*) as files, sum(row_count)::bigint as rows, sum(file_size)::bigint as bytes, sum(elapsed_ms)::bigint as elapsed_ms from ingest_log) select *, round(rows / (elapsed_ms / 1000.0), 4) as rows_per_s from s""", "ingest_log")
def run_report_readback(spark, sf_dir):
    path = scratch(spark)
    quality.write_report(quality.run_stats(view(spark, sf_dir, "ingest_log")), path)
    back = spark.read.schema("files long, rows long, bytes long, elapsed_ms long, rows_per_s double").json(path)
    return back.withColumn("rows_per_s", F.round("rows_per_s", 4))


@register("""with o as (select case o_custkey % 3 when 0 then 'cq-ww' when 1 then 'arrl' else 'wpx' end as contest, year(o_orderdate) as y, length(o_orderpriority) + 1 as n from orders)
  select contest || '/' || y as folder, 1::bigint as files, sum(n)::bigint as bytes from o where contest = 'cq-ww' group by 1
  union all select y || '/' || contest, 1, sum(n)::bigint from o where y = 1996 group by 1""")
def listed_files(spark, sf_dir):
    """Files by contest and year: those of one contest, and those of one year; none is an hour old."""
    path, k = scratch(spark), F.col("o_custkey")
    contest = F.when(k % 3 == 0, "cq-ww").when(k % 3 == 1, "arrl").otherwise("wpx")
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(contest.alias("contest"), F.date_format("o_orderdate", "yyyy").alias("year"), F.col("o_orderpriority").alias("value"))
    # The names of the folders are the values alone.
    for folder in ("contest", "year"):
        other = "year" if folder == "contest" else "contest"
        rows.repartition("contest", "year").write.partitionBy(folder, other).text(f"{path}/{folder}")
    found = [files.list_files(spark, f"{path}/contest", "*.txt", contest="contest=cq-ww"), files.list_files(spark, f"{path}/year", "*.txt").where(F.startswith("file_path", F.lit("year=1996/")))]
    young = files.list_files(spark, path, "*.txt", min_age="1 hour").select("file_path", "file_size")
    listed = found[0].unionByName(found[1]).select("file_path", "file_size").unionByName(young)
    folder = F.regexp_replace(F.regexp_replace("file_path", r"/[^/]*$", ""), "(contest|year)=", "")
    return listed.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"))


# --- streams

_HF = """m as (select line_no, case when line <> '{bad' then line end as j from pskr_json),
v as (select line_no, (j ->> '$.t')::bigint as t, j ->> '$.sc' as sc, j ->> '$.rc' as rc, (j ->> '$.rp')::int as snr, (j ->> '$.f')::bigint as f from m),
hf as (select * from v where sc <> '' and rc <> '' and f > 0 and (f between 1800000 and 2000000 or f between 3500000 and 4000000 or f between 5287200 and 5405000 or f between 7000000 and 7300000 or f between 10100000 and 10150000
  or f between 14000000 and 14350000 or f between 18068000 and 18168000 or f between 21000000 and 21450000 or f between 24890000 and 24990000 or f between 28000000 and 29700000))"""


def _streamed(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """The live messages as a stream, from files in which they arrived."""
    view(spark, sf_dir, "pskr_json").select("line").write.text(f"{path}/in")
    return live.normalize_live(live.read_spot_stream(spark, path=f"{path}/in"))


_ROTATED = f"with {_HF} select strftime(make_timestamp(t * 1000000), '%Y-%m-%dT%H:%M:%SZ') as ts, strftime(make_timestamp(t * 1000000), '%H') as hh, sc, f, snr::bigint as snr from hf"


@register(_ROTATED, "pskr_json")
def stream_rotated_readback(spark, sf_dir):
    """Rotated gz JSON lines of a stream; the second run finds nothing new."""
    path = scratch(spark)
    spots = _streamed(spark, sf_dir, path)
    for _ in range(2):
        live.write_jsonl_rotated(spots, f"{path}/out", f"{path}/state", once=True).awaitTermination()
    return spark.read.schema("ts string, sc string, f long, snr long, yyyy string, mm string, dd string, hh string").json(f"{path}/out").select("ts", "hh", "sc", "f", "snr")


@register(_ROTATED, "pskr_json")
def stream_replay_readback(spark, sf_dir):
    """The live messages from a log with offsets, to rotated files: in three runs, with more messages before the second, none before the third, and keys that are null or malformed."""
    path, rows = scratch(spark), view(spark, sf_dir, "pskr_json")
    n = F.col("line_no")
    rows = rows.select("line_no", F.when(n % 5 == 0, None).when(n % 5 == 1, "{").otherwise((n % 13).cast("string")).alias("key"), F.col("line").alias("value"))
    for part in (n % 2 == 0, n % 2 == 1, None):
        if part is not None:
            replay.publish(rows.where(part), f"{path}/log", segment_rows=500)
        spots = live.normalize_live(live.read_spot_stream(spark, "spot_log", path=f"{path}/log"))
        live.write_jsonl_rotated(spots, f"{path}/out", f"{path}/state", once=True).awaitTermination()
    return spark.read.schema("ts string, sc string, f long, snr long, yyyy string, mm string, dd string, hh string").json(f"{path}/out").select("ts", "hh", "sc", "f", "snr")


@register(_ROTATED, "pskr_json")
def compacted_readback(spark, sf_dir):
    """Rotated files of many triggers: the closed hours are compacted, some of them get late spots and are compacted again, the others stay as they are.
    A last run finds nothing to do, and an hour has one file."""
    path, rows = scratch(spark), view(spark, sf_dir, "pskr_json")
    before = "9999" if rows.isEmpty() else rows.agg(F.date_format(F.expr("percentile_approx(event_time, 0.7)"), "yyyy-MM-dd-HH")).first()[0]
    done = []
    for k in range(4):
        spots = live.rotated(pskr.normalize_live(rows.where(F.col("line_no") % 4 == k)))
        spots.write.mode("append").option("compression", "gzip").partitionBy("yyyy", "mm", "dd", "hh").json(f"{path}/in")
        if k in (1, 3):
            done += [compact.compact(spark, f"{path}/in", f"{path}/few", before) for _ in range(2)]
    most = compact.rotated_hours(spark, f"{path}/few/spots").agg(F.max("files")).first()[0]
    if done[1] or done[3] or not done[0] or not done[2] or most != 1:
        raise RuntimeError(f"compaction made {done} hours of up to {most} files")
    return compact.compacted_spots(spark, f"{path}/in", f"{path}/few").select("ts", "hh", "sc", "f", F.col("snr").cast("long").alias("snr"))


@register(f"with {_HF} select make_timestamp(t * 1000000) as timestamp, sc as sender_call, f as frequency, snr::bigint as snr from hf", "pskr_json")
def stream_catchup_readback(spark, sf_dir):
    """Rotated files caught up with in two runs, with more files between them."""
    path = scratch(spark)
    spots = pskr.normalize_live(view(spark, sf_dir, "pskr_json")).where("_status = 'ok'")
    for half in (0, 1):
        part = live.rotated(spots.where(F.col("line_no") % 2 == half))
        part.write.mode("append").option("compression", "gzip").partitionBy("yyyy", "mm", "dd", "hh").json(f"{path}/in")
        live.ingest_jsonl(spark, f"{path}/in", f"{path}/bronze", f"{path}/state").awaitTermination()
    return spark.read.schema(schemas.PSKR).parquet(f"{path}/bronze").select("timestamp", "sender_call", "frequency", F.col("snr").cast("long").alias("snr"))


@register("""with last as (select day_no * 24 + hour as time, arg_max(kp, updated_seq) as kp, arg_max(flux, updated_seq) as flux from solar_versions group by 1), k as (select arg_max(kp, time) as kp, arg_max(flux, time) as flux from last),
  p as (select max(t) as t from xray_rows), l as (select max(flux) as v from xray_rows where energy = '0.1-0.8nm' and t = (select t from p)), s as (select max(flux) as v from xray_rows where energy = '0.05-0.4nm' and t = (select t from p))
  select kp as kp_index, case when flux > 0 then flux else 145.0 end as solar_flux, coalesce(s.v, 0.0) as xray_short, coalesce(l.v, 0.0) as xray_long from k, s, l""", "solar_versions", "xray_rows")
def stream_refresh_readback(spark, sf_dir):
    """The snapshot that a stream of readings keeps up to date, one file of readings a batch."""
    from ..operators import dedupe, solar

    path = scratch(spark)
    last = dedupe.latest_by_key(view(spark, sf_dir, "solar_versions"), ["day_no", "hour"], ["updated_seq"]).withColumn("time", F.col("day_no") * 24 + F.col("hour"))
    xray = solar.pivot_xray(view(spark, sf_dir, "xray_rows"))
    zero = F.lit(0.0)
    for rows in (last.select(F.lit("kp").alias("kind"), "time", F.col("kp").alias("a"), zero.alias("b")), xray.select(F.lit("xray"), "t", "xray_short", "xray_long"), last.select(F.lit("flux"), "time", "flux", zero)):
        rows.toDF("kind", "time", "a", "b").write.mode("append").parquet(f"{path}/in")
    readings = spark.readStream.schema("kind string, time long, a double, b double").option("maxFilesPerTrigger", 100).parquet(f"{path}/in")
    for _ in range(2):
        live.refresh_stream(readings, f"{path}/live", f"{path}/state", once=True).awaitTermination()
    return spark.read.parquet(f"{path}/live/table").select("kp_index", "solar_flux", "xray_short", "xray_long")


@register("""with last as (select day_no * 24 + hour as time, arg_max(kp, updated_seq) as kp, arg_max(flux, updated_seq) as flux from solar_versions group by 1), k as (select arg_max(kp, time) as kp, arg_max(flux, time) as flux from last)
  select kp as kp_index, case when flux > 0 then flux else 145.0 end as solar_flux, 2::bigint as state_rows from k""", "solar_versions")
def stream_late_readback(spark, sf_dir):
    """The newest readings come in the first run, and all older ones after a restart: they change nothing, and the state holds a row a kind."""
    from ..operators import dedupe

    path, zero = scratch(spark), F.lit(0.0)
    last = dedupe.latest_by_key(view(spark, sf_dir, "solar_versions"), ["day_no", "hour"], ["updated_seq"]).withColumn("time", F.col("day_no") * 24 + F.col("hour"))
    both = last.select(F.lit("kp").alias("kind"), "time", F.col("kp").alias("a"), zero.alias("b")).unionAll(last.select(F.lit("flux"), "time", "flux", zero))
    cut = last.agg(F.expr("percentile_disc(0.5) within group (order by time)")).first()[0]
    for rows in (both.where(F.col("time") > cut), both.where(F.col("time") <= cut)):
        rows.write.mode("append").parquet(f"{path}/in")
        readings = spark.readStream.schema("kind string, time long, a double, b double").parquet(f"{path}/in")
        live.refresh_stream(readings, f"{path}/live", f"{path}/state", once=True).awaitTermination()
    held = spark.read.format("statestore").load(f"{path}/state").agg(F.count(F.lit(1)).alias("state_rows"))
    return spark.read.parquet(f"{path}/live/table").select("kp_index", "solar_flux", held.scalar().alias("state_rows"))


def _in_runs(spark: SparkSession, path: str, runs: list[DataFrame], schema: str, step) -> None:
    """Append each run's rows to a folder and let ``step`` start a query on the stream of it, which goes on from the last one's checkpoint."""
    for rows in runs:
        rows.write.mode("append").parquet(f"{path}/in")
        step(spark.readStream.schema(schema).parquet(f"{path}/in")).awaitTermination()


#: The times of the messages: the cut between two runs, and what the first run's watermark is at its end.
_TIMES = """c as (select min(event_time) + (max(event_time) - min(event_time)) / 2 as cut from pskr_json), e as (select max(event_time) as most from pskr_json, c where event_time < cut)"""


@register(f"""with {_TIMES}, {_HF},
  s as (select m.line_no, p.event_time, case when hf.line_no is not null then 'ok' when v.f is null or v.sc = '' or v.rc = '' or v.f = 0 then 'invalid' else 'filtered' end as status
    from m join pskr_json p using (line_no) left join v using (line_no) left join hf using (line_no)),
  w as (select time_bucket(interval '1 hour', event_time) as start, status, line_no, event_time < cut as first from s, c),
  a as (select start, status from w where first union all select start, status from w where not first
    union all select start, status from w, e where first and line_no % 7 = 0 and start + interval '1 hour' > most - interval '90 minutes')
  select start, count(*) as received, count(*) filter (status = 'ok') as written, count(*) filter (status = 'filtered') as filtered, count(*) filter (status = 'invalid') as invalid
  from a, (select max(event_time) as last from pskr_json) l where start + interval '1 hour' <= last - interval '90 minutes' group by start""", "pskr_json")
def stream_counters_readback(spark, sf_dir):
    """Counters in append mode: a window is written once, when the watermark closes it. The second run, from the checkpoint, brings messages of the first
    one again: those of closed windows are late and dropped, those of open ones count."""
    path = scratch(spark)
    rows = live.normalize_live(view(spark, sf_dir, "pskr_json")).select("line_no", F.col("event_time").cast("timestamp").alias("event_time"), "_status")
    low, high = rows.agg(F.min("event_time"), F.max("event_time")).first()
    cut = F.lit(low + (high - low) / 2)
    first = rows.where(F.col("event_time") < cut)

    def count(stream: DataFrame):
        counted = live.counters(stream, every="1 hour", delay="90 minutes")
        return counted.writeStream.format("parquet").outputMode("append").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()

    _in_runs(spark, path, [first, rows.where(F.col("event_time") >= cut).unionAll(first.where("line_no % 7 = 0"))], "line_no long, event_time timestamp, _status string", count)
    return spark.read.parquet(f"{path}/out").select("start", "received", "written", "filtered", "invalid")


@register("""with r as (select day_no * 8 + hour // 3 as k, day_no, hour from solar_versions group by all), c as (select min(day_no) + (max(day_no) - min(day_no)) // 2 as cut from r), e as (select max(day_no * 24 + hour) as most from r, c where day_no < cut)
  select k, day_no, hour::bigint as hour from r, c, e where day_no >= cut or k % 11 <> 0 or day_no * 24 + hour > most - 156""", "solar_versions")
def stream_windows_readback(spark, sf_dir):
    """Rolling windows loaded again and again, as a stream: the second run sends all of the first one once more. Rows known within the watermark come
    once; rows that are older than it are late, so that those the first run left out appear only where they are young enough."""
    path = scratch(spark)
    rows = view(spark, sf_dir, "solar_versions").select((F.col("day_no") * 8 + F.expr("hour div 3")).alias("k"), "day_no", F.col("hour").cast("long").alias("hour")).distinct()
    rows = rows.withColumn("event_time", F.timestamp_seconds((F.col("day_no") * 24 + F.col("hour")) * 3600))
    low, high = rows.agg(F.min("day_no"), F.max("day_no")).first()
    cut = low + (high - low) // 2
    first = rows.where((F.col("day_no") < cut) & (F.col("k") % 11 != 0))

    def once(stream: DataFrame):
        kept = live.dedupe_stream(stream, ["k"], delay="156 hours 30 minutes")
        return kept.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()

    _in_runs(spark, path, [first.unionAll(first), rows.unionAll(rows)], "k long, day_no long, hour long, event_time timestamp", once)
    return spark.read.parquet(f"{path}/out").select("k", "day_no", "hour")
