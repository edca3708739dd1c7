"""Queries on documents, archives and raw lines. They are made from the given tables on the Spark side alone: the SQL says
what they hold, so that it checks both the parsers and the forms."""

from __future__ import annotations

import io
import tarfile
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import times
from ..operators import catalog, solar
from ..shared import scratch, stored
from ..sources import cabrillo, files, rbn, wspr
from ..sources import solar as feeds
from .registry import register
from .views import view

#: Rows of a derived document or archive.
DOCUMENT_ROWS = 500


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(rows: DataFrame, key: str, entry: Column, header: str | None = None) -> DataFrame:
    """doc and text: JSON arrays of the entries (JSON texts) of ``DOCUMENT_ROWS`` keys each, after a header."""
    held = rows.select(F.expr(f"{key} div {DOCUMENT_ROWS}").alias("doc"), F.struct(F.col(key).alias("k"), entry.alias("entry")).alias("e"))
    joined = F.array_join(F.transform(F.array_sort("e"), lambda e: e["entry"]), ",")
    return held.groupBy("doc").agg(F.collect_list("e").alias("e")).select("doc", F.concat(F.lit("[" + (header + "," if header else "")), joined, F.lit("]")).alias("text"))


def _json(**values: Column) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in values.items()]))


def _row(*values: Column) -> Column:
    """A JSON array of texts; null stays null."""
    return F.to_json(F.array(*[v.cast("string") for v in values]), {"ignoreNullFields": "false"})


# --- JSON documents


@register("""select make_date(year(o_orderdate)::int, month(o_orderdate)::int, 15) as date, case when o_orderkey % 7 = 0 then 0.0 else (o_orderkey % 300) / 2.0 end as ssn,
  65 + (o_orderkey % 200) / 4.0 as observed_flux, case when o_orderkey % 3 = 0 then 0.0 else 70 + (o_orderkey % 100) / 8.0 end as adjusted_flux from orders where o_orderkey % 17 <> 0""")
def indices_documents(spark, sf_dir):
    """Monthly indices: missing values are -1, and some months are impossible."""
    k = F.col("o_orderkey")
    month = F.when(k % 17 == 0, "1850-13").otherwise(F.date_format("o_orderdate", "yyyy-MM"))
    value = lambda missing, x: F.when(missing, -1.0).otherwise(x)
    entry = F.to_json(F.struct(month.alias("time-tag"), value(k % 7 == 0, (k % 300) / 2).alias("ssn"), (65 + (k % 200) / 4).alias("f10.7"), value(k % 3 == 0, 70 + (k % 100) / 8).alias("smoothed_f10.7")))
    return feeds.parse_indices(documents(_table(spark, sf_dir, "orders"), "o_orderkey", entry))


@register("""select ts::date as date, date_trunc('second', ts) as time, (event_id % 28) / 4.0 as kp_index, case when event_id % 5 = 0 then 0.0 else (event_id % 50)::double end as ap_index from events where event_id % 13 <> 0""")
def kp_documents(spark, sf_dir):
    """K indices in both forms: arrays with a header row, and objects. Some have no number, some no running index."""
    k, rows = F.col("event_id"), _table(spark, sf_dir, "events")
    time, kp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.when(k % 13 == 0, "none").otherwise(((k % 28) / 4).cast("string"))
    ap = F.when(k % 5 != 0, (k % 50).cast("string"))
    first = F.expr(f"event_id div {DOCUMENT_ROWS} % 2 = 0")
    arrays = documents(rows.where(first), "event_id", _row(F.concat(time, F.lit(".000")), kp, ap, F.lit("8")), '["time_tag","Kp","a_running","station_count"]')
    objects = documents(rows.where(~first), "event_id", _json(time_tag=F.replace(time, F.lit(" "), F.lit("T")), Kp=kp, a_running=ap))
    return feeds.parse_kp(arrays.unionByName(objects))


@register("""select cast(floor(epoch(ts)) as bigint) as t, case when event_id % 2 = 0 then '0.05-0.4nm' else '0.1-0.8nm' end as energy, value / 1e8 as flux from events where event_id % 19 <> 0""")
def xray_documents(spark, sf_dir):
    """X-ray readings, some without a time."""
    k = F.col("event_id")
    time = F.when(k % 19 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    entry = _json(time_tag=time, satellite=F.lit(18), flux=F.col("value") / 1e8, energy=F.when(k % 2 == 0, "0.05-0.4nm").otherwise("0.1-0.8nm"))
    return feeds.parse_xray(documents(_table(spark, sf_dir, "events"), "event_id", entry)).select("t", "energy", "flux")


@register("""select cast(floor(epoch(ts)) as bigint) as t, event_id / 8.0 as bx_gsm, case when event_id % 3 = 0 then 0.0 else event_id % 11 - 5.5 end as by_gsm, event_id % 20 - 10.25 as bz_gsm, (event_id % 40) / 4.0 as bt from events""")
def mag_documents(spark, sf_dir):
    """Magnetometer readings, some of them null."""
    k = F.col("event_id")
    entry = _row(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), k / 8, F.when(k % 3 != 0, k % 11 - 5.5), k % 20 - 10.25, F.lit("0"), F.lit("0"), (k % 40) / 4)
    return feeds.parse_mag(documents(_table(spark, sf_dir, "events"), "event_id", entry, '["time_tag","bx_gsm","by_gsm","bz_gsm","lon_gsm","lat_gsm","bt"]')).drop("pos")


@register("""select cast(floor(epoch(ts)) as bigint) as t, case when event_id % 6 = 0 then 0.0 else (event_id % 90) / 8.0 end as density, 300 + (event_id % 400)::double as speed, 1000.0 * (event_id % 500) as temperature from events""")
def plasma_documents(spark, sf_dir):
    k = F.col("event_id")
    entry = _row(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), F.when(k % 6 != 0, (k % 90) / 8), 300 + k % 400, 1000 * (k % 500))
    return feeds.parse_plasma(documents(_table(spark, sf_dir, "events"), "event_id", entry, '["time_tag","density","speed","temperature"]')).drop("pos")


@register("select o_orderdate::date as date, case when o_orderkey % 9 = 0 then 0.0 else 60 + (o_orderkey % 250)::double end as observed_flux from orders")
def flux_documents(spark, sf_dir):
    k = F.col("o_orderkey")
    entry = _json(time_tag=F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), flux=F.when(k % 9 != 0, 60 + k % 250))
    return feeds.parse_flux_daily(documents(_table(spark, sf_dir, "orders"), "o_orderkey", entry))


@register("select o_orderdate as time, case when o_orderkey % 4 = 0 then null else 60 + (o_orderkey % 250)::double end as flux from orders")
def flux_summary(spark, sf_dir):
    """Documents of one object each."""
    k = F.col("o_orderkey")
    text = _json(Flux=F.when(k % 4 == 0, "n/a").otherwise((60 + k % 250).cast("string")), TimeStamp=F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return feeds.parse_flux_summary(_table(spark, sf_dir, "orders").select(text.alias("text")))


@register("""with s as (select 'sidc' as source_file, o_orderdate::date as date, o_orderdate as time, 0.0 as observed_flux, (o_orderkey % 300)::double as ssn, 0.0 as kp_index, 0.0 as ap_index, 0.0 as xray_long from orders
  union all select 'sfi_json', o_orderdate::date, o_orderdate, 60 + (o_orderkey % 250)::double, 0.0, 0.0, 0.0, 0.0 from orders
  union all select 'kp_json', o_orderdate::date, o_orderdate, 0.0, 0.0, (o_orderkey % 28) / 4.0, (o_orderkey % 50)::double, 0.0 from orders
  union all select 'xray_json', o_orderdate::date, o_orderdate, 0.0, 0.0, 0.0, 0.0, max(o_orderkey % 64) / 4.0 from orders group by 2, 3)
  select source_file, date, time, count(*) as n, sum(observed_flux) as observed_flux, sum(ssn) as ssn, sum(kp_index) as kp_index, sum(ap_index) as ap_index, sum(xray_long) as xray_long from s group by all""")
def solar_mixed_files(spark, sf_dir):
    """A folder's worth of files of all families, and of unknown ones, in one batch."""
    k, rows = F.col("o_orderkey"), _table(spark, sf_dir, "orders")
    day = lambda f: F.date_format("o_orderdate", f)
    named = lambda df, name: df.select(F.concat(F.lit("/in/"), F.col("doc").cast("string"), F.lit(name)).alias("file"), "text")
    sidc = rows.groupBy(F.expr(f"o_orderkey div {DOCUMENT_ROWS}").alias("doc")).agg(F.array_join(F.collect_list(F.concat(day("yyyy;MM;dd"), F.lit(";0.0;"), (k % 300).cast("string"), F.lit(";1.0;1;1"))), "\r\n").alias("text"))
    kp = documents(rows, "o_orderkey", _row(day("yyyy-MM-dd HH:mm:ss"), (k % 28) / 4, k % 50), '["time_tag","Kp","a_running"]')
    xray = documents(rows, "o_orderkey", _json(time_tag=day("yyyy-MM-dd'T'HH:mm:ss'Z'"), satellite=F.lit(18), flux=(k % 64) / 4, energy=F.lit("0.1-0.8nm")))
    flux = documents(rows, "o_orderkey", _json(time_tag=day("yyyy-MM-dd'T'HH:mm:ss"), flux=60 + k % 250))
    found = [sidc.select(F.concat(F.lit("/in/SIDC_"), F.col("doc").cast("string"), F.lit(".csv")).alias("file"), "text"), named(kp, "_kp_index.json"), named(xray, "_xray.json"), named(flux, "_flux.txt"), named(flux, "_notes.txt")]
    batch = solar.solar_batch(found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3]).unionByName(found[4]))
    sums = [F.sum(F.col(c).cast("double")).alias(c) for c in ("observed_flux", "ssn", "kp_index", "ap_index", "xray_long")]
    return batch.groupBy("source_file", "date", "time").agg(F.count(F.lit(1)).alias("n"), *sums)


@register("""with s as (select 'sidc' as source_file, o_orderdate::date as date, 0.0 as observed_flux, 2.0 * (o_orderkey % 300) as ssn, 0.0 as kp_index, 2 as n from orders
  union all select 'noaa', o_orderdate::date, 60.0 + o_orderkey % 200, 0.0, 0.0, 1 from orders union all select 'kpap', o_orderdate::date, 0.0, 0.0, (o_orderkey % 28) / 4.0, 1 from orders)
  select source_file, date, sum(n)::bigint as n, sum(observed_flux) as observed_flux, sum(ssn) as ssn, sum(kp_index) as kp_index from s group by all""")
def legacy_mixed_files(spark, sf_dir):
    """Older files of all families, one of them known by its content alone."""
    k, day = F.col("o_orderkey"), lambda f: F.date_format("o_orderdate", f)
    sidc = F.concat(day("yyyy;MM;dd"), F.lit(";0.0;"), (k % 300).cast("string"), F.lit(";1.0;1;1"))
    noaa = F.concat_ws(" ", day("yyyy MM dd"), (60 + k % 200).cast("string"), F.lit("1 2"))
    kpap = F.concat(day("yyyy MM dd "), F.lit("00.0" + " " * 32), F.format_string("%5.2f", (k % 28) / 4), F.lit("   "), F.format_string("%2d", k % 90), F.lit("  x"))
    rows = _table(spark, sf_dir, "orders").withColumn("doc", F.expr(f"o_orderkey div {DOCUMENT_ROWS}"))
    texts = {"/x/sunspots_%d.csv": sidc, "/x/SFI_%d.txt": noaa, "/x/KpData_%d.txt": kpap, "/x/other_%d.dat": sidc}
    held = rows.groupBy("doc").agg(*[F.concat(F.lit("# notes\n\n"), F.array_join(F.collect_list(line), "\n")).alias(f"t{i}") for i, line in enumerate(texts.values())])
    files_of = F.explode(F.array(*[F.struct(F.format_string(name, "doc").alias("file"), F.col(f"t{i}").alias("text")) for i, name in enumerate(texts)])).alias("d")
    batch = solar.legacy_batch(held.select(files_of).select("d.file", "d.text"))
    sums = [F.sum(F.col(c).cast("double")).alias(c) for c in ("observed_flux", "ssn", "kp_index")]
    return batch.groupBy("source_file", "date").agg(F.count(F.lit(1)).alias("n"), *sums)


# --- raw lines with headers, comments and markers


def _among(lines: DataFrame, *others: str) -> DataFrame:
    """``lines`` with each of the other lines beside every one of them."""
    both = F.explode(F.array(*[F.lit(x) for x in others], F.col("line"))).alias("line")
    return lines.select(*[c for c in lines.columns if c != "line"], both)


@register("select file, count(*) as n, count(*) filter (split_part(line, ',', 10) <> 'x') as good, min(line_no) as first_no from rbn_lines group by file", "rbn_lines")
def rbn_header_rows(spark, sf_dir):
    """Header rows, marker rows and blank lines among the spots."""
    lines = _among(view(spark, sf_dir, "rbn_lines"), "callsign,de_pfx,de_cont,freq,band,dx,dx_pfx,dx_cont,mode,db,date,speed,tx_mode", "Callsign,again", "(12 rows)", "  ")
    return rbn.parse_rbn(lines).groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.count_if("_ok").alias("good"), F.min("line_no").alias("first_no"))


@register("""with s as (select string_split(line, ';') as f from sidc_lines) select make_date(f[1]::int, f[2]::int, 1) + (f[3]::int - 1) as date, greatest(f[5]::double, 0.0) as ssn from s where f[3]::int between 1 and 31""", "sidc_lines")
def sidc_comment_lines(spark, sf_dir):
    """Blank lines, comments and short lines among the days."""
    return feeds.parse_sidc(_among(view(spark, sf_dir, "sidc_lines"), "", "  ", "# comment;1;1;1;1;1", "2024;05"))


@register("""select greatest(o_orderdate::date - (case when o_orderkey % 10 = 0 then 36525 else 0 end), date '1900-01-01')::date as date, case when o_orderkey % 6 = 0 then (600 + o_orderkey % 900) / 10.0 else 60 + (o_orderkey % 200)::double end as observed_flux,
  case when o_orderkey % 6 = 0 then (600 + o_orderkey % 900)::double else 60 + (o_orderkey % 200)::double end as original_value from orders""")
def dsd_lines(spark, sf_dir):
    """Daily flux, some of it in tenths and some of it before 1900, among headers of all kinds."""
    k = F.col("o_orderkey")
    day = F.date_sub(F.to_date("o_orderdate"), F.when(k % 10 == 0, 36525).otherwise(0))
    flux = F.when(k % 6 == 0, 600 + k % 900).otherwise(60 + k % 200)
    line = F.concat_ws(" ", F.date_format(day, "yyyy MM dd"), flux.cast("string"), F.lit("1 2"))
    lines = _among(_table(spark, sf_dir, "orders").select(line.alias("line")), ":Product: x", "# comment", "--------", "Date flux", "", "1 2", "2024 13 01 100", "2024 01 01 none")
    return feeds.parse_dsd(lines).select("date", "observed_flux", "original_value")


@register("select o_orderdate::date as date, (o_orderkey % 28) / 4.0 as kp_index, (o_orderkey % 90)::double as ap_index from orders where o_orderkey % 4 = 0")
def kpap_fixed_lines(spark, sf_dir):
    """Fixed-width lines, of which only those of hour 00.0 count."""
    k = F.col("o_orderkey")
    hour = F.format_string("%02d.0", (k % 4) * 3)
    line = F.concat(F.date_format("o_orderdate", "yyyy MM dd "), hour, F.lit(" " * 32), F.format_string("%5.2f", (k % 28) / 4), F.lit("   "), F.format_string("%2d", k % 90), F.lit("  x"))
    return feeds.parse_kpap_fixed(_among(_table(spark, sf_dir, "orders").select(line.alias("line")), "# short", "2024 01 01 00.0"))


@register("select event_id as k, strftime(ts, '%Y-%m-%d') as day, hour(ts) as hour from events")
def iso_keys(spark, sf_dir):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return _table(spark, sf_dir, "events").select(F.col("event_id").alias("k"), times.date_key(iso).alias("day"), times.hour_key(iso).cast("long").alias("hour"))


@register("select o_orderkey as k, 1800 + o_orderkey % 27000 as frequency, 'W' || (o_orderkey % 10) || 'ABC' as call_1 from orders")
def plain_space_lines(spark, sf_dir):
    """Contest lines whose spaces are non-breaking ones, as ISO-8859-1 bytes."""
    k, rows = F.col("o_orderkey"), _table(spark, sf_dir, "orders")
    line = F.concat_ws(" ", F.lit("QSO:"), (1800 + k % 27000).cast("string"), F.lit("CW"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("0101"), F.concat(F.lit("W"), (k % 10).cast("string"), F.lit("ABC")), F.lit("599"), F.lit("05"), F.lit("K2XYZ"), F.lit("599"), F.lit("14"))
    text = F.decode(F.encode(F.concat(F.lit("CALLSIGN: W1AW\n"), line), "ISO-8859-1"), "ISO-8859-1")
    lines = files.numbered_lines(rows.select(k.cast("string").alias("file"), text.alias("text")))
    return cabrillo.parse_cabrillo(lines).where("_ok").select(F.col("file").cast("long").alias("k"), "frequency", "call_1")


@register("""with n as (select o_orderkey as k, case o_orderkey % 6 when 0 then '/x/SFI_daily.txt' when 1 then '/x/sunspots.csv' when 2 then '/x/KpData.txt' when 3 then '/x/other.txt' else '/x/more.dat' end as p, case when o_orderkey % 4 < 2 then '2024;01;01;1;2' else '2024 01 01 2' end as l from orders)
  select k, case when p like '%SFI%' then 'noaa' when p like '%sunspot%' then 'sidc' when p like '%Kp%' then 'kpap' when l like '%;%' then 'sidc' else 'noaa' end as family from n""")
def legacy_formats(spark, sf_dir):
    k = F.col("o_orderkey")
    name = F.when(k % 6 == 0, "/x/SFI_daily.txt").when(k % 6 == 1, "/x/sunspots.csv").when(k % 6 == 2, "/x/KpData.txt").when(k % 6 == 3, "/x/other.txt").otherwise("/x/more.dat")
    line = F.when(k % 4 < 2, "2024;01;01;1;2").otherwise("2024 01 01 2")
    return _table(spark, sf_dir, "orders").select(k.alias("k"), files.detect_legacy_format(name, line).alias("family"))


# --- archives


def _archives(lines: DataFrame, kind: str) -> DataFrame:
    """path and content: archives of ``lines`` (file, line_no, line), each with a note before its CSV member."""

    def pack(text: str) -> bytes:
        out, members = io.BytesIO(), {"readme.txt": b"notes", "spots.CSV": text.encode()}
        if kind == "zip":
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                for name, data in members.items():
                    z.writestr(name, data)
        else:
            with tarfile.open(fileobj=out, mode="w:gz") as t:
                for name, data in members.items():
                    info = tarfile.TarInfo(name)
                    info.size = len(data)
                    t.addfile(info, io.BytesIO(data))
        return out.getvalue()

    def packed(key: tuple, whole: pa.Table) -> pa.Table:
        return pa.table({"path": pa.array([key[0].as_py()], pa.string()), "content": pa.array([pack(whole["text"][0].as_py())], pa.binary())})

    held = lines.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("e"))
    text = F.array_join(F.transform("e", lambda e: e["line"]), "\n")
    # An archive is one group: a task's Python holds one at a time, however many it packs.
    return held.select("file", text.alias("text")).groupBy("file").applyInArrow(packed, "path string, content binary")


@register("with p as (select string_split(line, ',') as c from wspr_lines) select count(*) as n_read, count(*) filter (len(c) >= 15 and c[6] <> 'bad') as n_parsed, sum(try_cast(c[1] as bigint))::bigint as ids from p", "wspr_lines")
def tar_archives(spark, sf_dir):
    lines = view(spark, sf_dir, "wspr_lines").withColumn("file", F.expr(f"concat('/a/', line_no div {DOCUMENT_ROWS}, '.tar.gz')"))
    parsed = wspr.parse_wspr(files.archive_lines(_archives(lines, "tar"), "tar"))
    first = F.get(F.split("line", ","), F.lit(0)).try_cast("long")
    return parsed.agg(F.count(F.lit(1)).alias("n_read"), F.count_if("_ok").alias("n_parsed"), F.sum(first).alias("ids"))


@register("""with p as (select string_split(line, ',') as c from rbn_lines) select c[1] as de_call, count(*) as n, count(*) filter (c[10] <> 'x') as n_parsed, sum(case when len(c) = 13 then 25 else 0 end)::bigint as speeds from p group by 1""", "rbn_lines")
def zip_archives(spark, sf_dir):
    """Archives of one layout each, as daily ones are."""
    lines = view(spark, sf_dir, "rbn_lines").withColumn("file", F.expr(f"concat('/a/', file, '-', line_no div {20 * DOCUMENT_ROWS}, '.zip')"))
    parsed = rbn.parse_rbn(files.archive_lines(_archives(lines, "zip"), "zip"))
    return parsed.groupBy("de_call").agg(F.count(F.lit(1)).alias("n"), F.count_if("_ok").alias("n_parsed"), F.sum(F.col("speed").cast("long")).alias("speeds"))


def _as_files(archives: DataFrame, folder: str, broken: Column) -> DataFrame:
    """Archives (path, content) as files of the shared folder; of the broken ones the second half is missing. Written by a job, whose rows are the paths."""

    def write(key: tuple, archive: pa.Table) -> pa.Table:
        store, root = files._store_of(folder)
        store.create_dir(root, recursive=True)
        path, content, cut = key[0].as_py(), archive["content"][0].as_py(), archive["cut"][0].as_py()
        with store.open_output_stream(f"{root}/{path.rsplit('/', 1)[1]}", compression=None) as out:
            out.write(content[: len(content) // 2] if cut else content)
        return pa.table({"path": pa.array([path], pa.string())})

    return stored(archives.withColumn("cut", broken).groupBy("path").applyInArrow(write, "path string"))


def _streamed_archives(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    lines = view(spark, sf_dir, "wspr_lines").withColumn("file", F.expr(f"concat('/a/', line_no div {DOCUMENT_ROWS}, '.{kind}')"))
    folder = scratch(spark)
    _as_files(_archives(lines, kind.split(".")[0]), folder, F.regexp_extract("path", "([0-9]+)[.]", 1).cast("int") % 3 == 1)
    return files.stream_archives(spark, f"{folder}/*.{kind}", kind.split(".")[0])


_BLOCKS = f"b as (select line, line_no // {DOCUMENT_ROWS} as block from wspr_lines), p as (select block, string_split(line, ',') as c from b)"


@register(f"with {_BLOCKS} select block, count(*) as n_read, count(*) filter (len(c) >= 15 and c[6] <> 'bad') as n_parsed, sum(try_cast(c[1] as bigint))::bigint as ids from p where block % 3 <> 1 group by block", "wspr_lines")
def tar_streams(spark, sf_dir):
    """Archives read from files as streams; those that are cut off give no rows."""
    parsed = wspr.parse_wspr(files.whole_archives(_streamed_archives(spark, sf_dir, "tar.gz")))
    first = F.get(F.split("line", ","), F.lit(0)).try_cast("long")
    block = F.regexp_extract("file", "([0-9]+)[.]tar", 1).cast("long").alias("block")
    return parsed.groupBy(block).agg(F.count(F.lit(1)).alias("n_read"), F.count_if("_ok").alias("n_parsed"), F.sum(first).alias("ids"))


@register(f"with {_BLOCKS} select distinct block, true as told from b where block % 3 = 1", "wspr_lines")
def zip_stream_rejects(spark, sf_dir):
    """The archives that are cut off, with a reason each, as the reject table has them."""
    found = files.archive_faults(_streamed_archives(spark, sf_dir, "zip"))
    return found.select(F.regexp_extract("file", "([0-9]+)[.]zip", 1).cast("long").alias("block"), (F.length("reason") > 0).alias("told"))


# --- index pages


@register("""select c_custkey as page_id, 'w' || (c_custkey % 10) || 'ab-4' as callsign, 1 as pos, 'h' || c_custkey || '=' as hash from customer union all select c_custkey, 'k' || (c_custkey % 7) || 'x', 0, 'g' || c_custkey from customer""")
def query_links(spark, sf_dir):
    """Hash and callsign of the query links of index pages; the first link of a callsign wins."""
    k = F.col("c_custkey").cast("string")
    link = lambda hash, name: F.concat(F.lit('<a href="showpubliclog.php?q='), hash, F.lit('" target="_new">'), name, F.lit("</a>"))
    one, two = F.concat(F.lit("K"), (F.col("c_custkey") % 7).cast("string"), F.lit("X")), F.concat(F.lit(" w"), (F.col("c_custkey") % 10).cast("string"), F.lit("ab/4 "))
    html = F.concat(F.lit("<p>"), link(F.concat(F.lit("g"), k), one), F.lit("<br>"), link(F.concat(F.lit("h"), k, F.lit("=")), two), link(F.lit("later"), F.lower(one)), link(F.lit("none"), F.lit(" ")), F.lit('<a href="x.php?q=1">no</a>'))
    pages = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("page_id"), html.alias("html"))
    return catalog.query_manifest(pages).select("page_id", "callsign", "pos", "hash")
