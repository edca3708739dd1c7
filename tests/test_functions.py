"""Golden values of the column functions."""

from pyspark.sql import functions as F
from spotlake.functions import bands, clean, space, times


def values(spark, inputs, *columns, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in df.select("i", *[c(F.col("x")) for c in columns]).orderBy("i").collect()]


def test_band_ids(spark):
    given = [14.0956, 14.0972, 14.2, 5.2872, 5.28, 27.5, 0.1365, 0.0, float("nan"), 3e6, None, -1.0]
    assert values(spark, given, bands.band_id, kind="double") == [107, 107, 107, 104, 5, 5, 100, 1, 0, 11, 0, 1]


def test_band_edges(spark):
    rows = bands.AMATEUR_BANDS
    assert values(spark, [r[3] for r in rows] + [r[4] for r in rows], bands.band_id, kind="double") == [r[0] for r in rows] * 2
    outside = [r[4] * 1.0001 for r in bands.WSPR_SEGMENTS]
    assert not any(values(spark, outside, bands.is_wspr_frequency, kind="double"))
    assert values(spark, [14.1, 100.0, 0.001], bands.band_name, kind="double") == ["20m", "VHF", "ELF"]


def test_band_info(spark):
    got = bands.band_info(spark.createDataFrame([(102,), (999,), (11,)], "band int"), "band").collect()
    assert {r.band: (r.name, r.min_mhz, r.max_mhz, r.is_wspr) for r in got} == {102: ("160m", 1.8366, 1.838, True), 11: ("Infrared", 3e6, 0.0, False)}
    assert bands.wspr_bands(spark).count() == 16 and bands.amateur_bands(spark).count() == 24


def test_band_plan_of_any_size(spark):
    """Beyond the rows that become an expression, ranges are joined: of 1,001 equal ones the smallest band wins."""
    plan = spark.range(bands.PLAN_ROWS + 1).selectExpr("cast(id as int) band", "0.0D min_mhz", "1.0D max_mhz", "1 priority")
    got = bands.join_band_plan(spark.createDataFrame([(1.0,), (1.5,)], "f double"), "f", plan).collect()
    assert sorted((r.f, r.plan_band) for r in got) == [(1.0, 0), (1.5, None)]


def test_sanitize(spark):
    given = ["EA5\\\\DL2OBT", '"malicious"', "test\\'escape", '"', "\\", "G0UPL/P", "VK2/W1ABC", "DL/ON4KHG/P"]
    assert values(spark, given, clean.sanitize_callsign) == ["EA5/DL2OBT", "malicious", "testescape", "", "", "G0UPL/P", "VK2/W1ABC", "DL/ON4KHG/P"]


def test_callsigns(spark):
    good = ["K1ABC", "JA1XYZ", "3DA0NW", "VK9DWX", "HB9DAX/QRP", "W1AW/4", "w1aw"]
    assert values(spark, [*good, "599", "DL/ON4KHG", "", None], clean.is_callsign) == [True] * 7 + [False] * 4
    assert values(spark, ["K1", "--", "", "x" * 21, None], clean.valid_callsign) == [True, False, False, False, False]


def test_grids(spark):
    given = ["FN42", "FN42AB", "FN42ab", "zz99", ""]
    assert values(spark, given, clean.valid_grid) == [True, True, True, False, False]
    assert values(spark, given, lambda c: clean.valid_grid(c, live=True)) == [True, False, True, False, False]
    assert values(spark, ["FN42", "FN42ab", "FN"], clean.pad_grid6) == ["FN42MM", "FN42ab", "FN    "]


def test_numbers(spark):
    given = ["", " 5 ", "-129", "128", "1.5", "x", "9" * 40, None]
    assert values(spark, given, lambda c: clean.to_int(c, -128, 127)) == [0, 5, None, None, None, None, None, None]
    assert values(spark, given[:-1], lambda c: clean.to_int(c, -128, 127, policy="lenient")) == [0, 5, -128, 127, 0, 0, 127]
    assert values(spark, ["1e3", ".5", "nan", "1_0"], clean.to_float) == [1000.0, 0.5, None, None]
    assert values(spark, ["14.097150", "7.0400955"], clean.mhz_to_hz) == [14097150, 7040095]


def test_fields(spark):
    assert values(spark, ['a,"b,c","d""e",', "a,,c"], clean.fields) == [["a", "b,c", 'd"e', ""], ["a", "", "c"]]


def test_times(spark):
    df = spark.createDataFrame([("2005-11-26", "1257Z"), ("11/26/2005", "1"), ("2005-11-26", "235959"), ("bad", "1")], "d string, t string")
    got = [r[0] and r[0].strftime("%H:%M") for r in df.select(times.cabrillo_time(F.col("d"), F.col("t"))).collect()]
    assert got == ["12:57", "00:01", "23:59", None]
    df = spark.createDataFrame([(2023, 2, 31), (2023, 13, 1), (1899, 1, 1)], "y int, m int, d int")
    assert [str(r[0]) for r in df.select(times.civil_date(F.col("y"), F.col("m"), F.col("d"))).collect()] == ["2023-03-03", "None", "None"]
    assert [str(x) for x in values(spark, ["2009-02-21 00:00:00+00", "x"], times.rbn_time)] == ["2009-02-21 00:00:00", "None"]


def test_conditions(spark):
    df = spark.createDataFrame([(2.99, 1e-5), (3.0, 1.1e-5), (5.0, 0.0), (7.0, 0.0)], "k double, x double")
    assert [r[0] for r in df.select(space.space_conditions(F.col("k"), F.col("x"))).collect()] == ["Quiet", "Unsettled + Radio Blackout", "Storm", "Severe Storm"]


def test_names(spark):
    given = ["/a/wsprspots-2024-05.csv.gz", "rbndata-20240501.zip", "20240501.zip", "x.zip"]
    assert values(spark, given, clean.partition_from_name) == ["202405", "20240501", "20240501", ""]
    assert values(spark, ["/r/cq-ww/2005cw/k1abc.log"], lambda c: clean.source_key(c, "/r")) == ["cq-ww/2005cw"]
