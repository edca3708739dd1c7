"""Registered queries: each operator on raw inputs derived from the given tables, with the DuckDB SQL of the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import bands, clean, space, times
from ..operators import catalog, dedupe, load, quality, scan, solar
from ..sources import cabrillo, files, pskr, rbn, wspr
from ..sources import solar as feeds
from ..streaming import live
from .registry import ORACLE_SQL, QUERIES, register
from .views import view


def _case(f: str, place: int) -> str:
    """The band classification of DuckDB, by position of the value in a row."""
    value = lambda row: f"'{row[1]}'" if place else str(row[0])
    unknown = "'Unknown'" if place else "0"
    out = [f"case when {f} is null or isnan({f}) then {unknown}"]
    out += [f"when {f} between {r[3]!r} and {r[4]!r} then {value(r)}" for r in bands.WSPR_SEGMENTS + bands.AMATEUR_BANDS]
    out += [f"when {f} * 1e6 < {r[4] * 1e6!r} then {value(r)}" for r in bands.SPECTRUM[:3]]
    out += [f"when {f} < {r[4]!r} then {value(r)}" for r in bands.SPECTRUM[3:-1]]
    return " ".join(out) + f" else {value(bands.SPECTRUM[-1])} end"


BAND, NAME = lambda f: _case(f, 0), lambda f: _case(f, 1)
_WSPR = " or ".join(f"f between {r[3]!r} and {r[4]!r}" for r in bands.WSPR_SEGMENTS)
def _frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), (F.round(F.pow(F.lit(10.0), (F.col("l_partkey") % 1000) / 125.0 - 2.0), 9) + F.col("l_linenumber") / 1000.0).alias("f"))


#: Frequencies over all classes, in logarithmic steps.
_FREQ = "freqs as (select l_orderkey * 10 + l_linenumber as k, round(pow(10.0, (l_partkey % 1000) / 125.0 - 2.0), 9) + l_linenumber / 1000.0 as f from lineitem)"

# Accepted WSPR lines in DuckDB: strict numbers, as all numbers but the frequency are well formed in the view.
_WSPR_PARSED = rf"""
parts as (select line_no, line, string_split(line, ',') as c from wspr_lines),
parsed as (
  select line_no, line, len(c) as n, try_cast(c[6] as double) as mhz,
    case when len(c) < 15 then 'insufficient columns' when try_cast(c[6] as double) is null then 'invalid frequency' end as reason,
    try_cast(c[1] as bigint) as id, try_cast(c[2] as bigint) as epoch, c[3] as raw_reporter, c[7] as raw_callsign,
    regexp_replace(replace(c[3], chr(92) || chr(92), '/'), '["''\\]', '', 'g') as reporter, c[4] as reporter_grid,
    try_cast(c[5] as bigint) as snr, cast(floor(try_cast(c[6] as decimal(28, 9)) * 1000000) as bigint) as frequency,
    regexp_replace(replace(c[7], chr(92) || chr(92), '/'), '["''\\]', '', 'g') as callsign, c[8] as grid, try_cast(c[9] as bigint) as power,
    try_cast(c[10] as bigint) as drift, try_cast(c[11] as bigint) as distance, try_cast(c[12] as bigint) as azimuth, c[14] as version, try_cast(c[15] as bigint) as code
  from parts)"""


def _wspr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wspr.parse_wspr(files.spread(view(spark, sf_dir, "wspr_lines")))


# --- bands


@register(f"with {_FREQ} select k, f, {BAND('f')} as band, {NAME('f')} as band_name, {_WSPR} as is_wspr from freqs")
def band_lookup(spark, sf_dir):
    f = F.col("f")
    return _frequencies(spark, sf_dir).select("k", "f", bands.band_id(f).alias("band"), bands.band_name(f).alias("band_name"), bands.is_wspr_frequency(f).alias("is_wspr"))


_DIM = ", ".join(f"({r[0]}, '{r[1]}', '{r[2]}', {r[3]!r}, {r[4]!r}, {r in bands.WSPR_SEGMENTS})" for r in {r[0]: r for r in bands.SPECTRUM + bands.AMATEUR_BANDS + bands.WSPR_SEGMENTS}.values())


@register(f"with {_FREQ}, dim(band, name, frequency_class, min_mhz, max_mhz, is_wspr) as (values {_DIM}) select band, name, frequency_class, min_mhz, max_mhz, is_wspr, count(*) as n from (select {BAND('f')} as band from freqs) join dim using (band) group by all")
def band_info(spark, sf_dir):
    rows = _frequencies(spark, sf_dir).select(bands.band_id(F.col("f")).alias("band")).groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    return bands.band_info(rows, "band").select("band", "name", "frequency_class", "min_mhz", "max_mhz", "is_wspr", "n")


_AMATEUR = ", ".join(f"({r[0]}, {r[3]!r}, {r[4]!r})" for r in bands.AMATEUR_BANDS)


@register(f"with {_FREQ}, plan(band, lo, hi) as (values {_AMATEUR}) select k, f, (select min(band) from plan where f between lo and hi) as plan_band from freqs")
def band_plan_join(spark, sf_dir):
    plan = bands.amateur_bands(spark).withColumn("priority", F.lit(1))
    return bands.join_band_plan(_frequencies(spark, sf_dir), "f", plan).select("k", "f", "plan_band")


@register(f"""with {_FREQ}, plan as (select o_orderkey as band, (o_custkey % 997) * 0.375::double as lo, (o_custkey % 997) * 0.375::double + (o_orderkey % 89) * 0.125::double as hi, o_orderkey % 50 as priority from orders),
  met as (select k, f, arg_min(band, priority * 1000000000 + band) as band from freqs join plan on f between lo and hi group by k, f) select k, f, band as plan_band from freqs left join met using (k, f)""")
def wide_plan_join(spark, sf_dir):
    """A plan of a range for each order, most of which overlap many others; the ends are exact in binary."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    lo = (c % 997) * F.lit(0.375)
    plan = spark.read.parquet(f"{sf_dir}/orders.parquet").select(o.alias("band"), lo.alias("min_mhz"), (lo + (o % 89) * F.lit(0.125)).alias("max_mhz"), (o % 50).alias("priority"))
    return bands.join_band_plan(_frequencies(spark, sf_dir), "f", plan).select("k", "f", "plan_band")


@register(f"with {_FREQ} select k, f from freqs where {NAME('f')} = '20m'")
def band_pruned(spark, sf_dir):
    f = F.col("f")
    return _frequencies(spark, sf_dir).where(bands.band_predicate(f, "20m")).where(bands.band_name(f) == "20m")


# --- scalar functions


@register(
    r"""with p as (select p_partkey as k, p_name as name, case p_partkey % 8 when 0 then '"' || p_brand || '"' when 1 then '<[' || p_brand || ']>' when 2 then 'EA' || (p_partkey % 10) || chr(92) || chr(92) || 'DL2OBT'
      when 3 then 'w' || (p_partkey % 10) || 'aw/4' when 4 then 'DL/ON4KHG' when 5 then '3DA0NW' when 6 then 'test' || chr(92) || '''escape' else '' end as c from part)
    select k, regexp_replace(replace(c, chr(92) || chr(92), '/'), '["''\\]', '', 'g') as sanitized, trim(c, '"''`<>[]{}()') as trimmed, translate(c, '"''`<>[]{}()', '') as stripped,
      length(c) between 1 and 20 and regexp_matches(c, '[A-Za-z0-9]') as valid,
      regexp_matches(regexp_replace(upper(c), '^([^/]+)/.*$', '\1'), '^[A-Z0-9]{1,3}[0-9][A-Z0-9]{0,3}[A-Z]$') as is_call, left(c, 8) as cut from p"""
)
def callsign_functions(spark, sf_dir):
    k = F.col("p_partkey")
    digit = (k % 10).cast("string")
    kinds = {0: F.concat(F.lit('"'), "p_brand", F.lit('"')), 1: F.concat(F.lit("<["), "p_brand", F.lit("]>")), 2: F.concat(F.lit("EA"), digit, F.lit("\\\\DL2OBT")), 3: F.concat(F.lit("w"), digit, F.lit("aw/4")), 4: F.lit("DL/ON4KHG"), 5: F.lit("3DA0NW"), 6: F.lit("test\\'escape")}
    c = F.lit("")
    for r, form in kinds.items():
        c = F.when(k % 8 == r, form).otherwise(c)
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select(k.alias("k"), c.alias("c"))
    c = F.col("c")
    return rows.select("k", clean.sanitize_callsign(c).alias("sanitized"), clean.trim_brackets(c).alias("trimmed"), clean.strip_brackets(c).alias("stripped"), clean.valid_callsign(c).alias("valid"), clean.is_callsign(c).alias("is_call"), clean.fixed(c, 8).alias("cut"))


@register(
    """with g as (select event_id as k, case event_id % 6 when 0 then 'FN42' when 1 then 'FN42ab' when 2 then 'fn42AB' when 3 then 'zz99' when 4 then 'EM10aa11' else '' end as g from events)
    select k, regexp_matches(upper(g), '^[A-R]{2}[0-9]{2}([A-X]{2})?$') as log_ok, regexp_matches(g, '^[A-R]{2}[0-9]{2}([a-x]{2})?$') as live_ok, left(upper(g), 8) as upper8,
      rpad(left(case when length(g) = 4 then g || 'MM' else g end, 6), 6, ' ') as padded, left(g, 4) as g4 from g"""
)
def grid_functions(spark, sf_dir):
    k = F.col("event_id")
    g = F.lit("")
    for r, v in enumerate(("FN42", "FN42ab", "fn42AB", "zz99", "EM10aa11")):
        g = F.when(k % 6 == r, v).otherwise(g)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(k.alias("k"), g.alias("g"))
    g = F.col("g")
    return rows.select("k", clean.valid_grid(g).alias("log_ok"), clean.valid_grid(g, live=True).alias("live_ok"), clean.upper_grid(g).alias("upper8"), clean.pad_grid6(g).alias("padded"), clean.grid4(g).alias("g4"))


@register(
    """with t as (select o_orderkey as k, case o_orderkey % 7 when 0 then '' when 1 then ' 12 ' when 2 then '-7' when 3 then '300' when 4 then 'x1' when 5 then '1.5' else '99999999999' end as c from orders)
    select k, case when trim(c) = '' then 0 when regexp_matches(trim(c), '^[+-]?[0-9]+$') and cast(trim(c) as bigint) between -128 and 127 then cast(trim(c) as bigint) end as strict_i8,
      case when regexp_matches(trim(c), '^[+-]?[0-9]+$') then least(127, greatest(-128, cast(trim(c) as bigint))) else 0 end as lenient_i8,
      case when trim(c) = '' then 0.0 when c = 'x1' then null else cast(trim(c) as double) end as strict_f, case when trim(c) = '' or c = 'x1' then 0.0 else cast(trim(c) as double) end as lenient_f,
      case when c in ('', 'x1', '-7') then 0.0 else cast(trim(c) as double) end as non_neg from t"""
)
def number_policies(spark, sf_dir):
    k = F.col("o_orderkey")
    c = F.lit("99999999999")
    for r, v in enumerate(("", " 12 ", "-7", "300", "x1", "1.5")):
        c = F.when(k % 7 == r, v).otherwise(c)
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(k.alias("k"), c.alias("c"))
    c = F.col("c")
    return rows.select("k", clean.to_int(c, -128, 127).alias("strict_i8"), clean.to_int(c, -128, 127, policy="lenient").alias("lenient_i8"), clean.to_float(c).alias("strict_f"), clean.to_float(c, policy="lenient").alias("lenient_f"), clean.non_negative(F.trim(c)).alias("non_neg"))


@register("""select o_orderkey as k, (1800 + o_orderkey % 27000) * 1000 as hz, 1800 + o_orderkey % 27000 as khz,
  case when o_orderkey % 1000 > 500 then (o_orderkey % 1000) / 10.0 else (o_orderkey % 1000) * 1.0 end as flux from orders""")
def frequency_units(spark, sf_dir):
    k = F.col("o_orderkey")
    khz = (1800 + k % 27000).cast("string")
    mhz = ((1800 + k % 27000).cast("decimal(18,3)") / 1000).cast("decimal(18,6)").cast("string")
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(k.alias("k"), clean.mhz_to_hz(mhz).alias("hz"), clean.khz_floor(F.concat(khz, F.lit(".7"))).alias("khz"), clean.repair_flux((k % 1000).cast("double")).alias("flux"))


@register("""with d as (select o_orderkey as k, 1850 + o_orderkey % 200 as y, 1 + o_orderkey % 13 as m, 1 + o_orderkey % 33 as d from orders)
  select k, case when y between 1900 and 2100 and m between 1 and 12 and d between 1 and 31 then make_date(y, m, 1) + cast(d - 1 as integer) end as day,
    case when m <= 12 then greatest(make_date(y, m, 1), date '1900-01-01') end as clamped, case when y between 1900 and 2100 and m between 1 and 12 then make_date(y, m, 15) end as mid from d""")
def calendar_functions(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(k.alias("k"), (1850 + k % 200).cast("int").alias("y"), (1 + k % 13).cast("int").alias("m"), (1 + k % 33).cast("int").alias("d"))
    good = F.col("m") <= 12
    first = F.when(good, F.make_date("y", F.when(good, F.col("m")).otherwise(1), F.lit(1)))
    month = F.concat_ws("-", F.col("y").cast("string"), F.lpad(F.col("m").cast("string"), 2, "0"))
    return rows.select("k", times.civil_date(F.col("y"), F.col("m"), F.col("d")).alias("day"), F.when(good, times.clamp_1900(first)).alias("clamped"), times.mid_month(month).alias("mid"))


@register("""select event_id as k, (case when event_id % 10 < 3 then 'Quiet' when event_id % 10 < 5 then 'Unsettled' when event_id % 10 < 7 then 'Storm' else 'Severe Storm' end) ||
  case when (event_id % 30) / 1e6 > 1e-5 then ' + Radio Blackout' else '' end as conditions, case when event_id % 5 > 0 then (event_id % 5) * 1.0 else 145.0 end as flux from events""")
def space_weather(spark, sf_dir):
    k = F.col("event_id")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(k.alias("k"), space.space_conditions((k % 10).cast("double"), (k % 30) / 1e6).alias("conditions"), space.flux_or_fallback((k % 5).cast("double")).alias("flux"))


@register(
    """with n as (select o_orderkey as k, case o_orderkey % 5 when 0 then '/a/wsprspots-2024-0' || (1 + o_orderkey % 9) || '.csv.gz' when 1 then '/a/rbndata-2024010' || (o_orderkey % 9) || '.zip'
      when 2 then '/a/2024010' || (o_orderkey % 9) || '.zip' when 3 then '/a/SIDC_x.csv' else '/a/b/noaa_kp_index.json' end as p from orders)
    select k, case when regexp_matches(p, 'wsprspots-') then replace(substr(regexp_extract(p, '([0-9]{4}-[0-9]{2})', 1), 1, 7), '-', '') else regexp_extract(p, '/(?:rbndata-)?([0-9]{8})[.]zip$', 1) end as part,
      case when p like '%SIDC_x.csv' then 'sidc' when p like '%kp_index%' then 'kp_json' else 'unknown' end as family, regexp_replace(substr(p, 4), '/?[^/]*$', '') as source from n"""
)
def file_names(spark, sf_dir):
    k = F.col("o_orderkey")
    nine = (k % 9).cast("string")
    p = F.when(k % 5 == 0, F.concat(F.lit("/a/wsprspots-2024-0"), (1 + k % 9).cast("string"), F.lit(".csv.gz"))).when(k % 5 == 1, F.concat(F.lit("/a/rbndata-2024010"), nine, F.lit(".zip")))
    p = p.when(k % 5 == 2, F.concat(F.lit("/a/2024010"), nine, F.lit(".zip"))).when(k % 5 == 3, "/a/SIDC_x.csv").otherwise("/a/b/noaa_kp_index.json")
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(k.alias("k"), p.alias("p"))
    return rows.select("k", clean.partition_from_name(F.col("p")).alias("part"), files.detect_format(F.col("p"), F.lit("[")).alias("family"), clean.source_key(F.col("p"), "/a").alias("source"))


# --- spots


@register(f"""with {_WSPR_PARSED} select id, make_timestamp(epoch * 1000000) as timestamp, reporter, reporter_grid, snr, frequency, callsign, grid, power, drift, distance, azimuth, {BAND('mhz')} as band, 'WSPR' as mode, version, code, n as column_count
  from parsed where reason is null""", "wspr_lines")
def wspr_strict(spark, sf_dir):
    return wspr.good_spots(_wspr(spark, sf_dir)).withColumns({c: F.col(c).cast("long") for c in ("snr", "power", "drift", "azimuth", "band", "code", "column_count")})


@register(f"with {_WSPR_PARSED} select line_no, coalesce(frequency, 0) as frequency, {BAND('coalesce(mhz, 0.0)')} as band from parsed where n >= 15", "wspr_lines")
def wspr_lenient(spark, sf_dir):
    rows = wspr.parse_wspr(view(spark, sf_dir, "wspr_lines"), policy="lenient").where("_ok")
    return rows.select("line_no", "frequency", "band")


@register(f"""with {_WSPR_PARSED}, b as (select *, {BAND('mhz')} as band, {NAME('mhz')} as band_name from parsed where reason is null)
  select band, band_name, count(*) as n_spots, round(avg(snr), 6) as avg_snr, max(distance) as max_distance from b group by band, band_name""", "wspr_lines")
def wspr_by_band(spark, sf_dir):
    spots = wspr.good_spots(_wspr(spark, sf_dir)).withColumn("band_name", bands.band_name(F.col("frequency") / 1e6))
    return spots.groupBy("band", "band_name").agg(F.count(F.lit(1)).alias("n_spots"), F.round(F.avg("snr"), 6).alias("avg_snr"), F.max("distance").alias("max_distance"))


@register(f"""with {_WSPR_PARSED} select count(*) as n_read, count(*) filter (reason is null) as n_parsed, count(*) filter (reason is not null) as n_failed, count(*) filter (trim(line) = '') as n_empty,
  count(*) filter (n >= 15 and raw_reporter <> reporter) as n_sanitized from parsed""", "wspr_lines")
def wspr_parse_stats(spark, sf_dir):
    parsed = _wspr(spark, sf_dir).withColumn("_raw", F.get(F.split("line", ","), F.lit(2)))
    return quality.parse_stats(parsed, file=None, sanitized=F.coalesce(F.col("_raw") != F.col("reporter"), F.lit(False)))


@register(f"with {_WSPR_PARSED} select reason, count(*) as n from parsed where reason is not null group by reason", "wspr_lines")
def wspr_rejects(spark, sf_dir):
    return _wspr(spark, sf_dir).where(~F.col("_ok")).groupBy(F.col("_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def _raw_calls(spark, sf_dir):
    cols = F.split("line", ",")
    return view(spark, sf_dir, "wspr_lines").where(F.size(cols) >= 15).select(F.get(cols, F.lit(2)).alias("reporter"), F.get(cols, F.lit(6)).alias("callsign"))


def _cleaned():
    return {c: clean.sanitize_callsign(F.col(c)) for c in ("reporter", "callsign")}


@register(f"""with {_WSPR_PARSED}, pairs as (select 'reporter' as field, raw_reporter as original, reporter as sanitized from parsed where n >= 15 union all select 'callsign', raw_callsign, callsign from parsed where n >= 15)
  select field, original, sanitized, count(*) as n from pairs where original <> sanitized group by all""", "wspr_lines")
def sanitize_audit(spark, sf_dir):
    return quality.sanitize_audit(_raw_calls(spark, sf_dir), _cleaned()).groupBy("field", "original", "sanitized").agg(F.count(F.lit(1)).alias("n"))


@register(f"with {_WSPR_PARSED} select 2 * count(*) as total, sum((raw_reporter <> reporter)::int + (raw_callsign <> callsign)::int)::bigint as modified from parsed where n >= 15", "wspr_lines")
def sanitize_totals(spark, sf_dir):
    return quality.audit_totals(_raw_calls(spark, sf_dir), _cleaned())


@register(f"with {_WSPR_PARSED} select id, frequency from parsed where reason is null order by id limit 100", "wspr_lines")
def wspr_first_rows(spark, sf_dir):
    """A row limit, which is the feature here."""
    return wspr.good_spots(_wspr(spark, sf_dir)).orderBy("id").limit(100).select("id", "frequency")


@register(f"""select event_id as id, make_timestamp(cast(floor(epoch(ts)) as bigint) * 1000000) as timestamp, 'FN42AB' as reporter_grid, cast(floor(cast(1.8 + (event_id % 28000) / 1000.0 as decimal(28, 9)) * 1000000) as bigint) as frequency,
  {BAND('(cast(1800 + event_id % 28000 as double) / 1000.0)')} as band, 15 as column_count, 'WSPR' as mode from events""")
def wspr_from_parquet(spark, sf_dir):
    k = F.col("event_id")
    raw = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        k.alias("id"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("timestamp"), F.lit("W1AB").alias("reporter"), F.lit("fn42ab").alias("reporter_grid"), F.lit(5).alias("snr"), ((1800 + k % 28000).cast("double") / 1000.0).alias("frequency"),
        F.lit("K1RX").alias("callsign"), F.lit("EM10").alias("grid"), F.lit(37).alias("power"), F.lit(0).alias("drift"), F.lit(1).alias("distance"), F.lit(1).alias("azimuth"), F.lit(14).alias("band"), F.lit("2.1").alias("version"), F.lit(0).alias("code"),
    )
    return wspr.from_parquet_columns(raw).select("id", "timestamp", "reporter_grid", "frequency", "band", F.col("column_count").cast("int").alias("column_count"), "mode")


@register(f"""select event_id as id, case when event_id % 3 = 0 then 'WSPR' else 'FST4W' end as mode, case when event_id % 4 = 0 then 15 else 19 end as column_count,
  case when event_id % 5 = 0 then {BAND('(cast(event_id % 30 as double) * 1000000 / 1e6)')} * (event_id % 30 > 0)::int else 105 end as band from events""")
def spot_defaults(spark, sf_dir):
    k = F.col("event_id")
    raw = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        k.alias("id"), F.when(k % 3 == 0, "").otherwise("FST4W").alias("mode"), F.when(k % 4 == 0, 0).otherwise(19).alias("column_count"), F.when(k % 5 == 0, 0).otherwise(105).alias("band"), (k % 30 * 1000000).alias("frequency")
    )
    return wspr.apply_defaults(raw).select("id", "mode", "column_count", "band")


_RBN = f"""
parts as (select file, line_no, string_split(line, ',') as c from rbn_lines),
layout as (select file, arg_min(len(c), line_no) as layout from parts group by file),
spots as (select file, line_no, strptime(replace(c[11], '+00', ''), '%Y-%m-%d %H:%M:%S') as timestamp, c[1] as de_call, c[2] as de_pfx, left(c[3], 2) as de_cont, cast(floor(cast(c[4] as double)) as bigint) as frequency,
  {BAND('(cast(c[4] as double) / 1000)')} as band, c[6] as dx_call, c[7] as dx_pfx, left(c[8], 2) as dx_cont, c[9] as spot_type, try_cast(c[10] as integer) as snr,
  case when layout >= 13 and len(c) >= 13 then cast(c[12] as integer) else 0 end as speed, case when layout >= 13 and len(c) >= 13 then c[13] else '' end as tx_mode from parts join layout using (file))"""


@register(f"with {_RBN} select * from spots where snr is not null", "rbn_lines")
def rbn_spots(spark, sf_dir):
    rows = rbn.parse_rbn(files.spread(view(spark, sf_dir, "rbn_lines"))).where("_ok").drop("_ok", "_reason")
    return rows.withColumn("snr", F.col("snr").cast("int"))


@register(f"with {_RBN} select file, count(*) as n_read, count(snr) as n_parsed, count(*) - count(snr) as n_failed from spots group by file", "rbn_lines")
def rbn_parse_stats(spark, sf_dir):
    parsed = rbn.parse_rbn(files.spread(view(spark, sf_dir, "rbn_lines")))
    return parsed.groupBy("file").agg(F.count(F.lit(1)).alias("n_read"), F.count_if("_ok").alias("n_parsed"), F.count_if(~F.col("_ok")).alias("n_failed"))


_LOG = r"""
up as (select file, line_no, trim(line) as line, upper(trim(line)) as u from cabrillo_lines),
ends as (select file, min(line_no) as e from up where u like 'END-OF-LOG%' group by file),
body as (select up.* from up left join ends using (file) where e is null or line_no < e),
head as (select file, max(case when u like 'CALLSIGN:%' then trim(substr(u, 10)) end) as call, max(case when u like 'CONTEST:%' then trim(substr(u, 9)) end) as contest,
  max(case when u like 'GRID-LOCATOR:%' and regexp_matches(trim(substr(u, 14)), '^[A-R]{2}[0-9]{2}([A-X]{2})?$') then trim(substr(u, 14)) end) as grid from body group by file),
qso as (select b.file, line_no, call, coalesce(contest, '') as contest, list_filter(regexp_split_to_array(b.line, '\s+'), lambda x: x <> 'QSO:') as f from body b join head using (file) where u like 'QSO:%'),
found as (select *, list_position(list_transform(f[6:len(f)], lambda x: regexp_matches(regexp_replace(upper(x), '^([^/]+)/.*$', '\1'), '^[A-Z0-9]{1,3}[0-9][A-Z0-9]{0,3}[A-Z]$') and upper(x) <> upper(f[5])), true) + 5 as raw_at from qso),
placed as (select *, case when raw_at >= 6 then raw_at end as p from found)"""


_CONTACTS = f"""with {_LOG} select file, line_no, strptime(f[3] || ' ' || lpad(left(regexp_replace(f[4], '[Zz]+$', ''), 4), 4, '0'), '%Y-%m-%d %H%M') as timestamp, cast(floor(cast(f[1] as double)) as bigint) as frequency,
      {BAND('(floor(cast(f[1] as double)) / 1000.0)')} as band, upper(f[2]) as mode, upper(f[5]) as call_1, upper(f[p]) as call_2, f[6] as rst_sent, array_to_string(f[7:p - 1], ' ') as exch_sent, f[p + 1] as rst_rcvd,
      array_to_string(f[p + 2:len(f)], ' ') as exch_rcvd, contest, '' as source from placed where call is not null and p is not null"""


@register(_CONTACTS, "cabrillo_lines")
def cabrillo_contacts(spark, sf_dir):
    return cabrillo.parse_cabrillo(view(spark, sf_dir, "cabrillo_lines")).where("_ok").drop("_ok", "_reason")


@register(_CONTACTS, "cabrillo_lines")
def cabrillo_segmented(spark, sf_dir):
    """The same from lines dealt by ranges, as for logs that are too long for a task."""
    return cabrillo.parse_cabrillo(view(spark, sf_dir, "cabrillo_lines"), tasks=7).where("_ok").drop("_ok", "_reason")


@register(f"with {_LOG} select case when call is null then 'no callsign' else 'no other call' end as reason, count(*) as n from placed where call is null or p is null group by 1", "cabrillo_lines")
def cabrillo_reasons(spark, sf_dir):
    return cabrillo.parse_cabrillo(view(spark, sf_dir, "cabrillo_lines")).where(~F.col("_ok")).groupBy(F.col("_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


_OUTCOMES = f"""{_LOG}, n as (select file, count(*) filter (call is not null and p is not null) as n_ok, count(*) filter (call is null or p is null) as n_failed from placed group by file),
files as (select distinct file from cabrillo_lines),
outcomes as (select file, case when n_ok > 0 then 'loaded' when n_failed > 0 then 'failed' else 'empty' end as outcome, coalesce(n_ok, 0) as n_ok, coalesce(n_failed, 0) as n_failed,
  case when n_ok > 0 then null when n_failed > 0 then 'all ' || n_failed || ' QSO lines failed to parse' else '0 QSOs parsed' end as reason from files left join n using (file))"""


@register(f"with {_OUTCOMES} select file, reason from outcomes where reason is not null", "cabrillo_lines")
def cabrillo_rejects(spark, sf_dir):
    lines = view(spark, sf_dir, "cabrillo_lines")
    return cabrillo.rejects(lines, cabrillo.parse_cabrillo(lines))


@register(f"with {_OUTCOMES} select * from outcomes union all select 'gone-' || n_nationkey, 'unreadable', 0, 0, 'file can''t be read' from nation", "cabrillo_lines")
def cabrillo_outcomes(spark, sf_dir):
    """Of all listed files, some of which give no line."""
    lines = view(spark, sf_dir, "cabrillo_lines")
    gone = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.concat(F.lit("gone-"), F.col("n_nationkey").cast("string")).alias("file"))
    return cabrillo.file_outcomes(lines, cabrillo.parse_cabrillo(lines), lines.select("file").unionAll(gone))


@register(f"with {_LOG} select call as callsign, rpad(case when length(grid) = 4 then grid || 'MM' else grid end, 6, ' ') as grid, left(grid, 4) as grid_4, cast(0 as bigint) as spot_count, date '2024-05-11' as last_seen from head where call is not null and grid is not null", "cabrillo_lines")
def cabrillo_grids(spark, sf_dir):
    heads = cabrillo.cabrillo_headers(view(spark, sf_dir, "cabrillo_lines"))
    return cabrillo.grid_enrichment(heads, F.lit("2024-05-11").cast("date"))


_LIVE = f"""
m as (select line_no, event_time, case when line <> '{{bad' then line end as j from pskr_json),
v as (select line_no, event_time, j, (j ->> '$.t')::bigint as t, j ->> '$.sc' as sc, j ->> '$.rc' as rc, j ->> '$.sl' as sl, j ->> '$.rl' as rl, (j ->> '$.rp')::int as rp, (j ->> '$.f')::bigint as f, j ->> '$.md' as md from m),
live as (select *, {BAND('(f / 1e6)')} as band, case when j is null or sc = '' or rc = '' or f = 0 then 'invalid' when {BAND('(f / 1e6)')} not between 102 and 111 then 'filtered' else 'ok' end as status from v)"""


@register(
    f"""with {_LIVE} select line_no, strftime(make_timestamp(t * 1000000), '%Y-%m-%dT%H:%M:%SZ') as ts, sc, case when regexp_matches(sl, '^[A-R]{{2}}[0-9]{{2}}([a-x]{{2}})?$') then sl else '' end as sg, rc,
      case when regexp_matches(rl, '^[A-R]{{2}}[0-9]{{2}}([a-x]{{2}})?$') then rl else '' end as rg, f, band, md as mode, rp as snr from live where status = 'ok'""",
    "pskr_json",
)
def live_normalized(spark, sf_dir):
    return pskr.normalize_live(view(spark, sf_dir, "pskr_json")).where("_status = 'ok'").select("line_no", *live.SPOT_COLUMNS).withColumn("snr", F.col("snr").cast("int"))


@register(f"""with {_LIVE} select time_bucket(interval '60 seconds', event_time) as start, count(*) as received, count(*) filter (status = 'ok') as written, count(*) filter (status = 'filtered') as filtered,
  count(*) filter (status = 'invalid') as invalid from live group by 1""", "pskr_json")
def live_counters(spark, sf_dir):
    spots = pskr.normalize_live(view(spark, sf_dir, "pskr_json").withColumn("event_time", F.col("event_time").cast("timestamp")))
    return live.counters(spots)


@register(f"with {_LIVE} select make_timestamp(t * 1000000) as timestamp, sc as sender_call, f as frequency, band, md as mode, rp as snr, count(*) as n from live where status = 'ok' group by all", "pskr_json")
def pskr_roundtrip(spark, sf_dir):
    """Live spots written as normalized JSON lines and parsed again."""
    spots = pskr.normalize_live(view(spark, sf_dir, "pskr_json")).where("_status = 'ok'")
    lines = spots.select(F.to_json(F.struct(*live.SPOT_COLUMNS)).alias("line"))
    good = pskr.parse_pskr(lines).where("_ok").withColumn("snr", F.col("snr").cast("int"))
    return good.groupBy("timestamp", "sender_call", "frequency", "band", "mode", "snr").agg(F.count(F.lit(1)).alias("n"))


# --- solar


_SIDC = """s as (select string_split(line, ';') as f from sidc_lines),
sidc as (select make_date(f[1]::int, f[2]::int, 1) + (f[3]::int - 1) as date, greatest(f[5]::double, 0.0) as ssn from s where f[3]::int between 1 and 31)"""


@register(f"with {_SIDC} select * from sidc", "sidc_lines")
def sidc_days(spark, sf_dir):
    return feeds.parse_sidc(view(spark, sf_dir, "sidc_lines"))


_GFZ = """g as (select string_split(line, ' ') as f from gfz_lines),
gfz as (select make_date(f[1]::int, f[2]::int, f[3]::int) as date, list_transform(f[8:15], lambda x: greatest(x::double, 0.0)) as kp, list_transform(f[16:23], lambda x: greatest(x::double, 0.0)) as ap,
  f[24]::double as day_ap, greatest(f[25]::double, 0.0) as ssn, f[26]::double as observed_flux, greatest(f[27]::double, 0.0) as adjusted_flux from g),
slots as (select date, unnest(range(8)) as k, kp, ap, ssn, observed_flux, adjusted_flux from gfz),
solar8 as (select date, k * 3 as hour, kp[k + 1] as kp_index, ap[k + 1] as ap_index, ssn, observed_flux, adjusted_flux from slots)"""


def _gfz(spark, sf_dir):
    return feeds.parse_gfz(view(spark, sf_dir, "gfz_lines"))


@register(f"with {_GFZ} select * from solar8", "gfz_lines")
def gfz_three_hourly(spark, sf_dir):
    return solar.explode_day(_gfz(spark, sf_dir))


@register(f"with {_GFZ} select date, day_ap, ssn, observed_flux from gfz where date between date '1995-01-01' and date '1996-12-31'", "gfz_lines")
def gfz_range(spark, sf_dir):
    return feeds.parse_gfz(view(spark, sf_dir, "gfz_lines"), start="1995-01-01", end="1996-12-31").select("date", "day_ap", "ssn", "observed_flux")


@register(
    f"""with {_GFZ}, k as (select date, unnest(kp) as v from gfz) select min(date) as first_day, max(date) as last_day, count(*) as days, count(*) filter (observed_flux > 0) as sfi_days, min(observed_flux) filter (observed_flux > 0) as sfi_min,
      max(observed_flux) filter (observed_flux > 0) as sfi_max, count(*) filter (ssn > 0) as ssn_days, min(ssn) filter (ssn > 0) as ssn_min, max(ssn) filter (ssn > 0) as ssn_max,
      (select count(*) from k where v > 0) as kp_values, (select min(v) from k where v > 0) as kp_min, (select max(v) from k where v > 0) as kp_max from gfz""",
    "gfz_lines",
)
def solar_coverage(spark, sf_dir):
    return quality.coverage(_gfz(spark, sf_dir))


@register(
    f"""with {_GFZ}, c as (select count(*) as total, count(*) filter (observed_flux > 0) as n_sfi, count(*) filter (ssn > 0) as n_ssn, count(*) filter (kp_index > 0) as n_kp,
      count(*) filter (observed_flux > 0 and ssn > 0 and kp_index > 0) as n_all from solar8)
      select *, round(100.0 * n_sfi / total, 6) as pct_sfi, round(100.0 * n_ssn / total, 6) as pct_ssn, round(100.0 * n_kp / total, 6) as pct_kp, round(100.0 * n_all / total, 6) as pct_all from c""",
    "gfz_lines",
)
def solar_completeness(spark, sf_dir):
    out = quality.completeness(solar.explode_day(_gfz(spark, sf_dir)))
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c.startswith("pct_")})


@register(f"with {_GFZ} select date, hour, case when observed_flux > 0 and ssn > 0 and kp_index > 0 then 'complete' else 'incomplete' end as status from solar8 where date = date '1996-05-11'", "gfz_lines")
def solar_completeness_on(spark, sf_dir):
    return quality.completeness_on(solar.explode_day(_gfz(spark, sf_dir)), "1996-05-11").select("date", "hour", "status")


@register("""with e as (select t, max(flux) filter (energy = '0.05-0.4nm') as s, max(flux) filter (energy = '0.1-0.8nm') as l from xray_rows group by t) select t, coalesce(s, 0.0) as xray_short, coalesce(l, 0.0) as xray_long from e""", "xray_rows")
def xray_pivot(spark, sf_dir):
    return solar.pivot_xray(view(spark, sf_dir, "xray_rows"))


_XRAY3 = "x3 as (select t - t % 10800 as bucket, coalesce(max(flux) filter (energy = '0.05-0.4nm'), 0.0) as xray_short, coalesce(max(flux) filter (energy = '0.1-0.8nm'), 0.0) as xray_long from xray_rows group by 1)"


def _xray3(spark, sf_dir):
    return solar.bucket_3h(solar.pivot_xray(view(spark, sf_dir, "xray_rows")), "t", ["xray_short", "xray_long"])


@register(f"with {_XRAY3} select * from x3", "xray_rows")
def xray_three_hourly(spark, sf_dir):
    return _xray3(spark, sf_dir)


_VERSIONS = """last as (select day_no, hour, arg_max(kp, updated_seq) as kp, arg_max(flux, updated_seq) as flux from solar_versions group by all),
daily as (select date '1970-01-01' + day_no::int as date, max(flux) as observed_flux from last group by day_no),
spread as (select date, unnest(range(0, 24, 3)) as hour, observed_flux from daily)"""


def _kp_flux(spark, sf_dir):
    last = dedupe.latest_by_key(view(spark, sf_dir, "solar_versions"), ["day_no", "hour"], ["updated_seq"])
    last = last.withColumn("date", F.date_add(F.lit("1970-01-01").cast("date"), F.col("day_no").cast("int")))
    kp = last.select("date", F.col("hour").cast("int").alias("hour"), F.col("kp").alias("kp_index"))
    return kp, solar.spread_daily(last.groupBy("date").agg(F.max("flux").alias("observed_flux")), ["observed_flux"])


def _feeds(spark, sf_dir):
    kp, flux = _kp_flux(spark, sf_dir)
    at = F.timestamp_seconds("bucket")
    xray = _xray3(spark, sf_dir).select(F.to_date(at).alias("date"), F.hour(at).alias("hour"), "xray_short", "xray_long")
    return kp, flux, xray


_MERGED = f"""{_VERSIONS}, {_XRAY3},
feeds as (select date '1970-01-01' + day_no::int as date, hour, kp as kp_index, 0.0 as observed_flux, 0.0 as xray_short, 0.0 as xray_long from last
  union all select date, hour, 0.0, observed_flux, 0.0, 0.0 from spread
  union all select date '1970-01-01' + (bucket // 86400)::int, (bucket % 86400) // 3600, 0.0, 0.0, xray_short, xray_long from x3),
merged as (select date, hour, max(observed_flux) as observed_flux, max(kp_index) as kp_index, max(xray_short) as xray_short, max(xray_long) as xray_long from feeds group by date, hour)"""


@register(f"with {_MERGED} select date, hour, observed_flux, kp_index, xray_short, xray_long, 'noaa_swpc_7day' as source_file from merged", "solar_versions", "xray_rows")
def solar_merged(spark, sf_dir):
    return solar.merge_feeds(*_feeds(spark, sf_dir)).select("date", "hour", "observed_flux", "kp_index", "xray_short", "xray_long", "source_file")


@register(f"with {_MERGED} select count(*) as n, round(sum(kp_index), 6) as kp, round(sum(observed_flux), 6) as flux from feeds", "solar_versions", "xray_rows")
def solar_union(spark, sf_dir):
    return solar.union_feeds(*_feeds(spark, sf_dir)).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("kp_index"), 6).alias("kp"), F.round(F.sum("observed_flux"), 6).alias("flux"))


@register(f"with {_MERGED} select count(*) as n_keys from merged", "solar_versions", "xray_rows")
def solar_merged_keys(spark, sf_dir):
    return solar.merged_keys(*_feeds(spark, sf_dir))


@register(
    f"""with {_MERGED} select date, count(*) as rows, count(*) filter (kp_index > 0) as has_kp, count(*) filter (xray_long > 0) as has_xray, count(*) filter (observed_flux > 0) as has_sfi, max(kp_index) as max_kp, max(xray_long) as max_xray,
      max(observed_flux) as max_sfi from merged where date between date '1994-01-01' and date '2025-12-31' group by date""",
    "solar_versions",
    "xray_rows",
)
def solar_verified(spark, sf_dir):
    return quality.verify_daily(solar.merge_feeds(*_feeds(spark, sf_dir)), start="1994-01-01", end="2025-12-31", tag=solar.MERGED)


_WIND = """mg as (select t, arg_max(bz_gsm, pos) as bz_gsm from mag_rows group by t), pl as (select t, arg_max(speed, pos) as speed, arg_max(density, pos) as density from plasma_rows group by t),
wind as (select t, coalesce(bz_gsm, 0.0) as bz_gsm, coalesce(speed, 0.0) as speed, coalesce(density, 0.0) as density from mg full join pl using (t))"""


def _wind(spark, sf_dir):
    return solar.merge_solar_wind(view(spark, sf_dir, "mag_rows"), view(spark, sf_dir, "plasma_rows"))


@register(f"with {_WIND} select * from wind order by t", "mag_rows", "plasma_rows")
def wind_merged(spark, sf_dir):
    return _wind(spark, sf_dir).orderBy("t")


@register(
    f"""with {_WIND} select min(t) as first_t, max(t) as last_t, round(avg(bz_gsm), 6) as avg_bz_gsm, min(bz_gsm) as min_bz_gsm, max(bz_gsm) as max_bz_gsm, round(avg(speed), 6) as avg_speed, min(speed) as min_speed, max(speed) as max_speed,
      round(avg(density), 6) as avg_density from wind""",
    "mag_rows",
    "plasma_rows",
)
def wind_summary(spark, sf_dir):
    out = quality.wind_summary(_wind(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c.startswith("avg_")})


@register(f"""with {_VERSIONS}, p as (select max(t) as t from xray_rows), s as (select arg_max(flux, t) as v from (select t, max(flux) as flux from xray_rows where energy = '0.05-0.4nm' group by t) where t = (select t from p)),
  l as (select max(flux) as v from xray_rows where energy = '0.1-0.8nm' and t = (select t from p)), k as (select arg_max(kp, day_no * 24 + hour) as kp, arg_max(flux, day_no * 24 + hour) as flux from last)
  select kp as kp_index, 0.0 as ap_index, case when flux > 0 then flux else 145.0 end as solar_flux, coalesce(s.v, 0.0) as xray_short, coalesce(l.v, 0.0) as xray_long,
    (case when kp < 3 then 'Quiet' when kp < 5 then 'Unsettled' when kp < 7 then 'Storm' else 'Severe Storm' end) || case when coalesce(l.v, 0.0) > 1e-5 then ' + Radio Blackout' else '' end as conditions from k, s, l""", "solar_versions", "xray_rows")
def live_snapshot(spark, sf_dir):
    last = dedupe.latest_by_key(view(spark, sf_dir, "solar_versions"), ["day_no", "hour"], ["updated_seq"]).withColumn("time", F.col("day_no") * 24 + F.col("hour"))
    return solar.live_conditions(last.select("time", F.col("kp").alias("kp_index"), F.lit(0.0).alias("ap_index")), solar.pivot_xray(view(spark, sf_dir, "xray_rows")), last.select("time", "flux"))


# --- latest wins, planning


@register("select day_no, hour, max(updated_seq) as updated_seq, arg_max(kp, updated_seq) as kp, arg_max(flux, updated_seq) as flux from solar_versions group by day_no, hour", "solar_versions")
def latest_versions(spark, sf_dir):
    return dedupe.latest_by_key(view(spark, sf_dir, "solar_versions"), ["day_no", "hour"], ["updated_seq"])


@register(
    """with p as (select *, case updated_seq % 3 when 0 then 100 when 1 then 50 else 10 end as priority from solar_versions),
    r as (select *, row_number() over (partition by day_no order by priority, updated_seq desc) as n from p) select day_no, hour, updated_seq, kp, flux, priority from r where n = 1""",
    "solar_versions",
)
def latest_by_file(spark, sf_dir):
    name = F.when(F.col("updated_seq") % 3 == 0, "/x/SN_d_tot_V2.0.csv").when(F.col("updated_seq") % 3 == 1, "/x/recent.txt").otherwise("/x/other.txt")
    rows = view(spark, sf_dir, "solar_versions").withColumn("priority", dedupe.file_priority(name))
    return dedupe.latest_by_priority(rows, ["day_no"], "priority", ["updated_seq"])


@register("select distinct day_no, hour, kp from solar_versions", "solar_versions")
def overlapping_windows_whole(spark, sf_dir):
    """All versions, in two windows of hours that overlap."""
    rows = view(spark, sf_dir, "solar_versions").select("day_no", "hour", "kp")
    return live.dedupe_stream(rows.where("hour < 15").unionAll(rows.where("hour >= 9")), ["day_no", "hour", "kp"])


_LATEST = "latest as (select file_path, arg_max(file_size, loaded_seq) as was_size from ingest_log group by file_path)"


def _log(spark, sf_dir):
    return view(spark, sf_dir, "ingest_log")


@register("select l.* from file_listing l where not exists (select 1 from ingest_log g where g.file_path = l.file_path)", "file_listing", "ingest_log")
def plan_incremental(spark, sf_dir):
    return load.plan_incremental(view(spark, sf_dir, "file_listing"), _log(spark, sf_dir))


@register(f"with {_LATEST} select l.file_path, file_size, coalesce(was_size, 0) as was_size, case when was_size is null then 'new' else 'grown' end as action from file_listing l left join latest using (file_path) where was_size is null or file_size > was_size", "file_listing", "ingest_log")
def plan_growth(spark, sf_dir):
    return load.plan_growth(view(spark, sf_dir, "file_listing"), _log(spark, sf_dir), order="loaded_seq")


@register(f"with {_LATEST} select l.file_path, file_size, case when was_size is null then 'new' else 'was ' || was_size || ' bytes' end as note from file_listing l left join latest using (file_path) where was_size is null or file_size > was_size", "file_listing", "ingest_log")
def plan_dry_run(spark, sf_dir):
    return load.dry_run(load.plan_growth(view(spark, sf_dir, "file_listing"), _log(spark, sf_dir), order="loaded_seq"))


@register("select *, 'load' as action from file_listing", "file_listing")
def plan_full(spark, sf_dir):
    return load.plan_full(view(spark, sf_dir, "file_listing"))


@register("select l.file_path, file_size, cast(0 as bigint) as row_count, timestamp '2024-01-01 00:00:00' as loaded_at, cast(0 as bigint) as elapsed_ms, 'h' as hostname from file_listing l where not exists (select 1 from ingest_log g where g.file_path = l.file_path)", "file_listing", "ingest_log")
def plan_prime(spark, sf_dir):
    return load.prime(view(spark, sf_dir, "file_listing"), _log(spark, sf_dir), host="h", now=F.lit("2024-01-01").cast("timestamp"))


@register("select file_path, arg_max(file_size, loaded_seq) as file_size, arg_max(row_count, loaded_seq) as row_count, arg_max(elapsed_ms, loaded_seq) as elapsed_ms, max(loaded_seq) as loaded_seq from ingest_log group by file_path", "ingest_log")
def log_latest(spark, sf_dir):
    return load.latest_log(_log(spark, sf_dir), "loaded_seq")


@register(
    """with s as (select count(*) as files, count(*) filter (row_count > 0) as files_ok, count(*) filter (row_count = 0) as files_empty, sum(row_count)::bigint as rows, sum(file_size)::bigint as bytes, sum(elapsed_ms)::bigint as elapsed_ms from ingest_log)
    select *, round(rows / (elapsed_ms / 1000.0), 4) as rows_per_s, round(bytes / 1048576.0 / (elapsed_ms / 1000.0), 6) as mb_per_s, round(bytes / rows, 6) as bytes_per_row, round(rows * 80 / bytes, 8) as compression from s""",
    "ingest_log",
)
def run_totals(spark, sf_dir):
    out = quality.run_stats(_log(spark, sf_dir))
    return out.withColumns({c: F.round(c, n) for c, n in (("rows_per_s", 4), ("mb_per_s", 6), ("bytes_per_row", 6), ("compression", 8))})


@register("select case when file_path like '%.gz' then 'gz' else 'parquet' end as format, count(*) as files, sum(file_size)::bigint as bytes from file_listing group by 1", "file_listing")
def storage_by_format(spark, sf_dir):
    return quality.storage_report(view(spark, sf_dir, "file_listing"))


@register("select file_path, round(file_size / 1048576.0, 9) as mb_in, round(file_size / 2 / 1048576.0, 9) as mb_out, round(file_size / 1073741824.0, 12) as gb_in, case when file_size > 0 then 2.0 else 0.0 end as ratio from file_listing", "file_listing")
def size_figures(spark, sf_dir):
    figures = quality.size_figures(F.col("file_size"), F.col("file_size") / 2)
    return view(spark, sf_dir, "file_listing").select("file_path", *[F.round(c, 12 if n == "gb_in" else 9).alias(n) for n, c in figures.items()])


@register("""with c(tbl, n, least, grp) as (select 'orders', count(*), 10, 'sales' from orders union all select 'nation', count(*), 1000, 'geo' from nation union all select 'region', count(*), 0, 'geo' from region union all select 'absent', null, 0, 'geo')
  select tbl as "table", grp, n as rows, case when n is null then 'FAIL' when least > 0 and n < least then 'WARN' when n = 0 then 'empty' else 'OK' end as status from c""")
def table_checks(spark, sf_dir):
    checks = [("orders", 10, "sales"), ("nation", 1000, "geo"), ("region", 0, "geo"), ("absent", 0, "geo")]
    return quality.validate_tables(spark, [(t, f"{sf_dir}/{t}.parquet", least, g) for t, least, g in checks])


@register("select status, count(*) as n from (select case when count(*) < 1000 then 'WARN' else 'OK' end as status from nation union all select case when count(*) = 0 then 'empty' else 'OK' end from region union all select 'FAIL') group by status")
def table_check_totals(spark, sf_dir):
    return quality.status_totals(quality.validate_tables(spark, [("nation", f"{sf_dir}/nation.parquet", 1000, "g"), ("region", f"{sf_dir}/region.parquet", 0, "g"), ("absent", f"{sf_dir}/absent.parquet", 0, "g")]))


@register("""with s as (select user_id as run, event_id as t, cast(floor(value) as bigint) * 1000000 as inc from events), c as (select run, t, sum(inc) over (partition by run order by t) as rows from s),
  d as (select run, t, rows, rows - lag(rows, 1, 0) over (partition by run order by t) as delta_rows, t - lag(t) over (partition by run order by t) as sec from c), m as (select *, case when sec > 0 then delta_rows / 1e6 / sec else 0.0 end as mrps from d)
  select run, t, rows::bigint as rows, delta_rows::bigint as delta_rows, round(mrps, 6) as mrps, round(coalesce(avg(case when mrps > 0 then mrps end) over (partition by run order by t rows between 9 preceding and current row), 0.0), 6) as smoothed_mrps from m""")
def throughput(spark, sf_dir):
    steps = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("run"), F.col("event_id").alias("t"), (F.floor("value") * 1000000).alias("inc"))
    samples = steps.select("run", "t", F.sum("inc").over(Window.partitionBy("run").orderBy("t")).alias("rows"))
    return quality.throughput(samples).withColumns({c: F.round(c, 6) for c in ("mrps", "smoothed_mrps")})


# --- catalogues


@register("select d::date as day from unnest(generate_series(timestamp '1990-01-01', timestamp '2001-12-31', interval 1 day)) x(d) where d::date not in (select o_orderdate::date from orders)")
def archive_gaps_whole(spark, sf_dir):
    """Gaps of all orders, in a calendar that reaches beyond them."""
    present = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.to_date("o_orderdate").alias("day"))
    return catalog.missing_days(present, "1990-01-01", "2001-12-31")


@register("select d::date as day from unnest(generate_series(timestamp '1990-01-01', timestamp '2001-12-01', interval 1 month)) x(d) where d::date not in (select date_trunc('month', o_orderdate)::date from orders)")
def archive_month_gaps_whole(spark, sf_dir):
    present = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.to_date("o_orderdate").alias("day"))
    return catalog.missing_months(present, "1990-01-01", "2001-12-01")


@register("""with c as (select s_name as contest, 2005 + s_suppkey % 10 as lo, 2016 + s_suppkey % 10 as hi, case when s_suppkey % 3 = 0 then [''] else ['ph', 'cw'] end as modes from supplier), y as (select contest, unnest(range(lo, hi + 1)) as year, modes from c),
  m as (select contest, year, unnest(modes) as mode from y) select contest, year, mode, year::varchar || mode as subdir from m""")
def download_work(spark, sf_dir):
    k = F.col("s_suppkey")
    rows = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_name").alias("contest"), (2005 + k % 10).alias("year_min"), (2016 + k % 10).alias("year_max"), F.when(k % 3 != 0, F.array(F.lit("ph"), F.lit("cw"))).alias("modes"))
    return catalog.work_list(rows)


@register("""select file_path, case when file_size % 4 = 0 then 'download' when file_size % 5 = 0 then 'skip' when file_size % 3 = 0 then 'adopt' when file_size % 7 = 0 then 'download' else 'skip' end as action from file_listing""", "file_listing")
def remote_changes(spark, sf_dir):
    rows, size = view(spark, sf_dir, "file_listing"), F.col("file_size")
    remote = rows.select("file_path", F.when(size % 5 != 0, F.concat(F.lit("e"), size.cast("string"))).alias("etag"))
    local = rows.where(size % 4 != 0).select("file_path", F.when(size % 3 == 0, "").when(size % 7 == 0, "old").otherwise(F.concat(F.lit("e"), size.cast("string"))).alias("etag"))
    return catalog.changed_remote(local, remote)


@register("select file_path from file_listing where not (file_size % 3 = 0 and file_size - file_size % 2 > 0 and file_size % 2 = 1)", "file_listing")
def absent_files(spark, sf_dir):
    rows, size = view(spark, sf_dir, "file_listing"), F.col("file_size")
    listing = rows.where(size % 3 == 0).select("file_path", F.when(size % 2 == 1, size).otherwise(0).alias("file_size"))
    return catalog.not_on_disk(rows.select("file_path"), listing)


@register("""with l as (select page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) as a from pages), x as (select page_id, a, unnest(range(len(a))) as pos from l) select page_id, pos, a[pos + 1] as link from x""")
def page_links(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html")
    return catalog.extract_links(pages, r'href="([^"]+)"')


@register("""with l as (select page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) as a from pages), x as (select page_id, a, unnest(range(len(a))) as pos from l), c as (select page_id, pos, replace(lower(regexp_extract(a[pos + 1], '([^/]*)$', 1)), '/', '-') as callsign from x)
  select page_id, trim(callsign) as callsign, min(pos) as pos from c where trim(callsign) <> '' group by 1, 2""")
def page_manifest(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html")
    return catalog.log_manifest(catalog.extract_links(pages, r'href="([^"]+)"')).select("page_id", "callsign", "pos")


from . import feeds as _feed_queries, stores as _store_queries  # noqa: E402, F401  (they register theirs)

__all__ = ["ORACLE_SQL", "QUERIES"]


@register("""with e as (select event_type, event_id, user_id, case when event_id % 5 = 0 then user_id end as sparse from events)
  select event_type, event_id, last_value(sparse ignore nulls) over w as carried, sum(sparse) over w::bigint as running, lag(user_id) over (partition by event_type order by event_id) as earlier
  from e window w as (partition by event_type order by event_id rows unbounded preceding)""")
def ordered_scans(spark, sf_dir):
    """Values carried forward, running sums and the row before in a few long groups, each on many tasks."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_type", "event_id", "user_id", F.when(F.col("event_id") % 5 == 0, F.col("user_id")).alias("sparse"))
    out = scan.ordered_scan(rows, ["event_type"], ["event_id"], last={"carried": "sparse"}, total={"running": "sparse"}, before={"earlier": "user_id"}, tasks=32)
    return out.select("event_type", "event_id", "carried", "running", "earlier")
