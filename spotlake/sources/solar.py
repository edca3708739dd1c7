"""Solar and geomagnetic indices. Parsers return the columns that a format has, ready for ``schemas.conform``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import non_negative, repair_flux, words
from ..functions.times import civil_date, clamp_1900, mid_month, plausible

DAY_SECONDS = 86400


def _int(c: Column) -> Column:
    return F.coalesce(F.trim(c).try_cast("int"), F.lit(0))


def _at(k: int) -> Column:
    return F.get("_f", F.lit(k))


def parse_sidc(lines: DataFrame) -> DataFrame:
    """date, ssn (0 where missing) and the other columns of ``lines`` but the line: ``YYYY;MM;DD;year;SSN;...``.

    Blank and comment lines, lines of fewer than five fields and implausible dates are left out; an
    SSN that isn't a number is 0."""
    line = F.trim("line")
    rows = lines.where((line != "") & ~line.startswith("#")).withColumn("_f", F.split(line, ";", -1)).where(F.size("_f") >= 5)
    y, m, d = _int(_at(0)), _int(_at(1)), _int(_at(2))
    rows = rows.where(plausible(y, m, d))
    return rows.select(*[c for c in lines.columns if c != "line"], civil_date(y, m, d).alias("date"), non_negative(F.trim(_at(4))).alias("ssn"))


def parse_indices(documents: DataFrame) -> DataFrame:
    """date (the month's 15th), ssn, observed_flux and adjusted_flux of monthly index documents (column text)."""
    kind = "array<struct<`time-tag`:string,ssn:double,`f10.7`:double,`smoothed_f10.7`:double>>"
    rows = documents.select(F.explode(F.from_json("text", kind)).alias("r"))
    return rows.select(mid_month(F.col("r.`time-tag`")).alias("date"), non_negative(F.col("r.ssn")).alias("ssn"), non_negative(F.col("r.`f10.7`")).alias("observed_flux"), non_negative(F.col("r.`smoothed_f10.7`")).alias("adjusted_flux")).where("date is not null")


def _time(c: Column) -> Column:
    plain = F.regexp_replace(F.replace(c, F.lit("T"), F.lit(" ")), r"(\.\d+)?Z?$", "")
    return F.try_to_timestamp(plain, F.lit("yyyy-MM-dd HH:mm:ss"))


def table_rows(text: Column, kind: str = "array<array<string>>") -> Column:
    """Rows of a JSON array of arrays without its header row; null if the document has another form."""
    rows = F.from_json(text, kind)
    return F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0)))


def parse_kp(documents: DataFrame) -> DataFrame:
    """time, date, kp_index and ap_index of K-index documents (column text): arrays with a header row, or objects."""
    arrays = F.transform(table_rows(F.col("text")), lambda r: F.struct(F.get(r, F.lit(0)).alias("t"), F.get(r, F.lit(1)).alias("kp"), F.get(r, F.lit(2)).alias("ap")))
    objects = F.transform(F.from_json("text", "array<struct<time_tag:string,Kp:string,a_running:string>>"), lambda r: F.struct(r["time_tag"].alias("t"), r["Kp"].alias("kp"), r["a_running"].alias("ap")))
    found = F.when(F.get(F.from_json("text", "array<array<string>>"), F.lit(0)).isNotNull(), arrays).otherwise(objects)
    rows = documents.select(F.explode(found).alias("r"))
    rows = rows.select(_time(F.col("r.t")).alias("time"), F.col("r.kp").try_cast("double").alias("kp_index"), F.coalesce(F.col("r.ap").try_cast("double"), F.lit(0.0)).alias("ap_index"))
    return rows.where("time is not null and kp_index is not null").select(F.to_date("time").alias("date"), "time", "kp_index", "ap_index")


def parse_xray(documents: DataFrame) -> DataFrame:
    """t (epoch seconds), energy and flux of x-ray documents (column text), with pos, the place in its document."""
    kind = "array<struct<time_tag:string,satellite:int,flux:double,energy:string>>"
    rows = documents.select(F.posexplode(F.from_json("text", kind)).alias("pos", "r"))
    return rows.select(F.unix_timestamp(_time(F.col("r.time_tag"))).alias("t"), F.col("r.energy").alias("energy"), F.col("r.flux").alias("flux"), "pos").where("t is not null")


def parse_gfz(lines: DataFrame, *, start: str | None = None, end: str | None = None) -> DataFrame:
    """date, kp and ap (eight values each), day_ap, ssn, observed_flux and adjusted_flux of daily lines; -1 is 0."""
    line = F.trim("line")
    rows = lines.where((line != "") & ~line.startswith("#")).withColumn("_f", words(line)).where(F.size("_f") >= 27)
    y, m, d = _int(_at(0)), _int(_at(1)), _int(_at(2))
    rows = rows.where(plausible(y, m, d))
    eight = lambda k: F.transform(F.slice("_f", k, 8), non_negative)
    out = rows.select(*[c for c in lines.columns if c != "line"], civil_date(y, m, d).alias("date"), eight(8).alias("kp"), eight(16).alias("ap"), *[non_negative(_at(k)).alias(n) for k, n in ((23, "day_ap"), (24, "ssn"), (25, "observed_flux"), (26, "adjusted_flux"))])
    return in_range(out, start, end)


def in_range(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Rows whose date lies between both dates, inclusive."""
    if start:
        df = df.where(F.col("date") >= F.lit(start).cast("date"))
    return df.where(F.col("date") <= F.lit(end).cast("date")) if end else df


def parse_dsd(lines: DataFrame) -> DataFrame:
    """date, year, month, day, observed_flux (above 500: tenths) and original_value of daily flux lines; headers are left out."""
    line = F.trim("line")
    skip = (line == "") | line.startswith("#") | line.startswith(":") | line.contains("Date") | line.startswith("---")
    rows = lines.where(~skip).withColumn("_f", words(line)).where(F.size("_f") >= 4)
    y, m, d, flux = _int(_at(0)), _int(_at(1)), _int(_at(2)), _at(3).try_cast("double")
    good = y.between(1700, 2100) & m.between(1, 12) & d.between(1, 31) & flux.isNotNull()
    rows = rows.withColumns({"year": y, "month": m, "day": d, "original_value": flux}).where(good)
    day = F.date_add(F.make_date("year", "month", F.lit(1)), F.col("day") - 1)
    return rows.select(clamp_1900(day).alias("date"), "year", "month", "day", repair_flux(F.col("original_value")).alias("observed_flux"), "original_value")


def parse_kpap_fixed(lines: DataFrame) -> DataFrame:
    """date, kp_index and ap_index of fixed-width lines of at least 59 characters, the hour 00.0 of each day only."""
    part = lambda a, n: F.trim(F.substring("line", a, n))
    rows = lines.withColumn("line", F.trim("line")).where((F.length("line") >= 59) & (part(12, 4) == "00.0") & ~F.col("line").startswith("#"))
    rows = rows.select(_int(part(1, 4)).alias("y"), _int(part(6, 2)).alias("m"), _int(part(9, 2)).alias("d"), part(48, 5).try_cast("double").alias("kp_index"), part(56, 2).try_cast("double").alias("ap_index"))
    rows = rows.where("y between 1700 and 2100 and m between 1 and 12 and d between 1 and 31 and kp_index is not null and ap_index is not null")
    return rows.select(clamp_1900(F.date_add(F.make_date("y", "m", F.lit(1)), F.col("d") - 1)).alias("date"), "kp_index", "ap_index")


def parse_flux_daily(documents: DataFrame) -> DataFrame:
    """date and observed_flux of 30-day documents (column text: objects with time_tag and flux)."""
    rows = documents.select(F.explode(F.from_json("text", "array<struct<time_tag:string,flux:double>>")).alias("r"))
    return rows.select(F.to_date(_time(F.col("r.time_tag"))).alias("date"), F.coalesce("r.flux", F.lit(0.0)).alias("observed_flux")).where("date is not null")


def parse_flux_summary(documents: DataFrame) -> DataFrame:
    """time and flux of a summary document (column text: one object with Flux and TimeStamp)."""
    rows = documents.select(F.from_json("text", "Flux string, TimeStamp string").alias("r"))
    return rows.select(_time(F.col("r.TimeStamp")).alias("time"), F.col("r.Flux").try_cast("double").alias("flux"))


def parse_mag(documents: DataFrame) -> DataFrame:
    """t, pos, bx_gsm, by_gsm, bz_gsm and bt of magnetometer documents (column text); null values are 0."""
    return _wind(documents, {"bx_gsm": 1, "by_gsm": 2, "bz_gsm": 3, "bt": 6})


def parse_plasma(documents: DataFrame) -> DataFrame:
    """t, pos, density, speed and temperature of plasma documents (column text)."""
    return _wind(documents, {"density": 1, "speed": 2, "temperature": 3})


def _wind(documents: DataFrame, places: dict[str, int]) -> DataFrame:
    rows = documents.select(F.posexplode(table_rows(F.col("text"))).alias("pos", "r"))
    value = lambda k: F.coalesce(F.get("r", F.lit(k)).try_cast("double"), F.lit(0.0))
    return rows.select(F.unix_timestamp(_time(F.get("r", F.lit(0)))).alias("t"), "pos", *[value(k).alias(n) for n, k in places.items()]).where("t is not null")
