"""Raw inputs derived from the given tables, as SQL for Spark and for DuckDB.

``{E:x}`` stands for epoch seconds, ``{D:x}`` for date text and ``{Y:x}`` for the year of x."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..functions.clean import settled

_GFZ_KP = ",\n  ".join(f"case when sum(o_orderkey) % 11 = {k} then '-1.000' else concat(cast((sum(o_orderkey) + {k}) % 9 as string), '.333') end" for k in range(8))
_GFZ_AP = ", ".join(f"cast((sum(o_orderkey) + {k}) % 180 as string)" for k in range(8))

VIEWS = {
    "wspr_lines": """select event_id as line_no, case
  when event_id % 23 = 0 then concat_ws(',', cast(event_id as string), 'short')
  else concat_ws(',', cast(event_id as string), cast({E:ts} as string),
    case when event_id % 17 = 0 then concat(chr(39), 'W', cast(user_id % 10 as string), 'AB', chr(39))
         when event_id % 19 = 0 then concat('EA', cast(user_id % 10 as string), chr(92), chr(92), 'DL2OBT')
         else concat('W', cast(user_id % 10 as string), 'AB') end,
    'fn42', cast(event_id % 60 - 35 as string),
    case event_id % 10 when 0 then '14.097100' when 1 then '7.040095' when 2 then '3.594050' when 3 then '1.838050'
      when 4 then '10.140150' when 5 then '21.200000' when 6 then '0.136500' when 7 then '27.500000' when 8 then '144.490000' else 'bad' end,
    concat('K', cast(user_id % 7 as string), 'XYZ'), 'EM10aa', '37', '0',
    cast(event_id % 18000 as string), cast(event_id % 360 as string), '14', '2.1_x', '0') end as line from events""",
    "rbn_lines": """select cast({Y:l_shipdate} as string) as file, l_orderkey * 10 + l_linenumber as line_no,
  concat_ws(',', concat('S', cast(l_suppkey % 10 as string), 'KIM'), 'S5', 'EUR', cast(1800 + (l_partkey * 13) % 27000 as string) || '.5',
    '40m', concat('K', cast(l_partkey % 10 as string), 'AA'), 'K', 'NA', 'CQ',
    case when l_orderkey % 31 = 0 then 'x' else cast(l_linenumber + 3 as string) end,
    {D:l_shipdate} || ' 00:05:00' || case when {Y:l_shipdate} % 2 = 0 then '+00' else '' end)
  || case when {Y:l_shipdate} % 2 = 1 then ',25,CW' else '' end as line from lineitem""",
    "cabrillo_lines": """select cast(c_custkey as string) as file, cast(-2 as bigint) as line_no, 'CONTEST: cq-ww-cw' as line from customer
 union all select cast(c_custkey as string), cast(-1 as bigint), concat('CALLSIGN: w', cast(c_custkey % 10 as string), 'abc') from customer where c_custkey % 13 <> 0
 union all select cast(c_custkey as string), cast(0 as bigint), concat('GRID-LOCATOR: ', case c_custkey % 3 when 0 then 'fn42' when 1 then 'EM10aa' else 'zz99' end) from customer where c_custkey % 5 <> 0
 union all select cast(o_custkey as string), o_orderkey, concat('QSO: ', cast(1800 + (o_orderkey * 7) % 27000 as string), '.7 cw ', {D:o_orderdate}, ' ',
   case o_orderkey % 4 when 0 then '1257Z' when 1 then '5' when 2 then '235959' else '0101' end, ' W1ABC 599 05 ',
   case o_orderkey % 3 when 0 then 'k2xyz' when 1 then 'JA1AA/P' else 'DL/ON4KHG' end, ' 599 14 MA') from orders
 union all select cast(c_custkey as string), cast(9000000000 as bigint), 'END-OF-LOG:' from customer
 union all select cast(c_custkey as string), cast(9000000001 as bigint), 'QSO: 7000 CW 2005-11-26 0001 K1ABC 599 05 JA1XYZ 599 25' from customer""",
    "pskr_json": """select event_id as line_no, ts as event_time, case when event_id % 29 = 0 then '{bad' else
  concat('{"t":', cast({E:ts} as string), ',"sc":"', case when event_id % 11 = 0 then '' else concat('W', cast(user_id % 10 as string), 'AB') end,
  '","rc":"K1RX","sl":"', case event_id % 4 when 0 then 'FN42' when 1 then 'FN42ab' when 2 then 'FN42AB' else 'zz99' end,
  '","rl":"EM10","rp":', cast(event_id % 40 - 20 as string), ',"f":', cast(1000000 + (event_id * 4567) % 60000000 as string), ',"md":"FT8"}') end as line from events""",
    "xray_rows": """select {E:ts} as t, case when event_id % 2 = 0 then '0.05-0.4nm' else '0.1-0.8nm' end as energy, value / 1e8 as flux from events where event_type in ('click', 'view')""",
    "mag_rows": """select {E:ts} - {E:ts} % 3600 as t, event_id as pos, value / 10 - 10 as bz_gsm from events where event_type = 'click'""",
    "plasma_rows": """select {E:ts} - {E:ts} % 3600 as t, event_id as pos, value + 300 as speed, value / 7 as density from events where event_type = 'error'""",
    "file_listing": """select concat('2024/', cast(o_custkey as string), '/f', cast(o_orderkey as string), case when o_orderkey % 2 = 0 then '.gz' else '.parquet' end) as file_path, cast(floor(o_totalprice) as bigint) as file_size from orders""",
    "ingest_log": """select concat('2024/', cast(o_custkey as string), '/f', cast(o_orderkey as string), case when o_orderkey % 2 = 0 then '.gz' else '.parquet' end) as file_path,
  cast(floor(o_totalprice) as bigint) - case when o_orderkey % 5 = 0 then 100 else 0 end as file_size, o_orderkey % 1000 as row_count, (o_orderkey * 37) % 5000 as elapsed_ms, cast(n as bigint) as loaded_seq
  from (select *, {U} as n from orders) x where o_orderkey % 3 <> 0""",
    "sidc_lines": """select concat(cast({Y:o_orderdate} as string), ';', lpad(cast(month(o_orderdate) as string), 2, '0'), ';',
  case when count(*) % 5 = 0 then '32' else lpad(cast(day(o_orderdate) as string), 2, '0') end, ';0.0;',
  case when sum(o_orderkey) % 7 = 0 then '-1' else cast(sum(o_orderkey) % 300 as string) end, ';1.0;1;1') as line
  from orders group by o_orderdate""",
    "gfz_lines": f"""select concat_ws(' ', cast({{Y:o_orderdate}} as string), cast(month(o_orderdate) as string), cast(day(o_orderdate) as string), '1 1 1 1',
  {_GFZ_KP},
  {_GFZ_AP},
  '15', case when sum(o_orderkey) % 13 = 0 then '-1' else cast(sum(o_orderkey) % 250 as string) end,
  concat(cast(65 + sum(o_orderkey) % 200 as string), '.4'), '-1.0') as line from orders group by o_orderdate""",
    "solar_versions": """select cast(floor({E:o_orderdate} / 86400) as bigint) as day_no, (o_orderkey % 8) * 3 as hour, o_orderkey as updated_seq,
  cast(o_orderkey % 9 as double) as kp, cast(65 + o_orderkey % 200 as double) as flux from orders""",
}

_SPARK = {"E": r"unix_timestamp(cast(\1 as timestamp))", "D": r"date_format(\1, 'yyyy-MM-dd')", "Y": r"year(\1)"}
_DUCKDB = {"E": r"cast(floor(epoch(\1)) as bigint)", "D": r"strftime(\1, '%Y-%m-%d')", "Y": r"year(\1)"}


def _render(text: str, dialect: dict[str, str], unnest: str) -> str:
    for k, form in dialect.items():
        text = re.sub(rf"\{{{k}:(\w+)\}}", form, text)
    return text.replace("{U}", unnest)


def spark_sql(name: str, sf_dir: str) -> str:
    text = _render(VIEWS[name], _SPARK, "explode(array(1, 2))")
    return re.sub(r"\bfrom (events|lineitem|orders|customer)\b", lambda m: f"from parquet.`{sf_dir}/{m[1]}.parquet`", text)


def duckdb_sql(name: str) -> str:
    return _render(VIEWS[name], _DUCKDB, "unnest([1, 2])")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Rows of a derived input, made once as those of a file are."""
    return settled(spark.sql(spark_sql(name, sf_dir)))
