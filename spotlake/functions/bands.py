"""Band plan: from a frequency in MHz to a band identifier, and back to the band's data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values: (id, name, class, lowest MHz, highest MHz), both edges inclusive.
WSPR_SEGMENTS = (
    (100, "2190m", "LF", 0.1357, 0.1378),
    (101, "630m", "MF", 0.475, 0.479),
    (102, "160m", "HF", 1.8366, 1.8380),
    (103, "80m", "HF", 3.5926, 3.5941),
    (104, "60m", "HF", 5.2872, 5.3662),
    (105, "40m", "HF", 7.0386, 7.0400),
    (106, "30m", "HF", 10.1387, 10.1402),
    (107, "20m", "HF", 14.0956, 14.0972),
    (108, "17m", "HF", 18.1046, 18.1061),
    (109, "15m", "HF", 21.0946, 21.0961),
    (110, "12m", "HF", 24.9246, 24.9261),
    (111, "10m", "HF", 28.1246, 28.1261),
    (200, "6m", "VHF", 50.293, 50.313),
    (202, "2m", "VHF", 144.489, 144.491),
    (300, "70cm", "UHF", 432.300, 432.400),
    (302, "23cm", "UHF", 1296.5, 1296.7),
)
AMATEUR_BANDS = (
    (100, "2190m", "LF", 0.1357, 0.1378),
    (101, "630m", "MF", 0.472, 0.479),
    (102, "160m", "HF", 1.8, 2.0),
    (103, "80m", "HF", 3.5, 4.0),
    (104, "60m", "HF", 5.3, 5.405),
    (105, "40m", "HF", 7.0, 7.3),
    (106, "30m", "HF", 10.1, 10.15),
    (107, "20m", "HF", 14.0, 14.35),
    (108, "17m", "HF", 18.068, 18.168),
    (109, "15m", "HF", 21.0, 21.45),
    (110, "12m", "HF", 24.89, 24.99),
    (111, "10m", "HF", 28.0, 29.7),
    (200, "6m", "VHF", 50.0, 54.0),
    (201, "4m", "VHF", 70.0, 71.0),
    (202, "2m", "VHF", 144.0, 148.0),
    (203, "1.25m", "VHF", 222.0, 225.0),
    (300, "70cm", "UHF", 420.0, 450.0),
    (301, "33cm", "UHF", 902.0, 928.0),
    (302, "23cm", "UHF", 1240.0, 1300.0),
    (303, "13cm", "UHF", 2300.0, 2450.0),
    (400, "9cm", "SHF", 3300.0, 3500.0),
    (401, "5cm", "SHF", 5650.0, 5925.0),
    (402, "3cm", "SHF", 10000.0, 10500.0),
    (403, "1.2cm", "SHF", 24000.0, 24250.0),
)
# Spectrum classes by (id, name, class, lowest MHz, upper bound in MHz, exclusive); 0 is no bound.
SPECTRUM = (
    (1, "ELF", "ELF", 0.0, 0.003),
    (2, "VLF", "VLF", 0.003, 0.03),
    (3, "LF", "LF", 0.03, 0.3),
    (4, "MF", "MF", 0.3, 3.0),
    (5, "HF", "HF", 3.0, 30.0),
    (6, "VHF", "VHF", 30.0, 300.0),
    (7, "UHF", "UHF", 300.0, 3000.0),
    (8, "SHF", "SHF", 3000.0, 30000.0),
    (9, "EHF", "EHF", 30000.0, 300000.0),
    (10, "THz", "THz", 300000.0, 3000000.0),
    (11, "Infrared", "IR", 3000000.0, 0.0),
)
#: HF amateur bands.
HF_BANDS = (102, 111)
#: Rows of a user's band plan that become branches of one expression.
PLAN_ROWS = 1000


def _row_of(f: float) -> tuple:
    """Row of a frequency: WSPR segment, else amateur band, else spectrum class."""
    for row in WSPR_SEGMENTS + AMATEUR_BANDS:
        if row[3] <= f <= row[4]:
            return row
    for row in SPECTRUM[:-1]:
        if f * 1e6 < row[4] * 1e6 if row in SPECTRUM[:3] else f < row[4]:
            return row
    return SPECTRUM[-1]


#: Where the row can change, in order: (MHz, whether the value itself still belongs to what is below, the scale of the comparison).
_CUTS = sorted(
    {(row[3], False, 1.0) for row in WSPR_SEGMENTS + AMATEUR_BANDS} | {(row[4], True, 1.0) for row in WSPR_SEGMENTS + AMATEUR_BANDS} | {(row[4], False, 1e6 if k < 3 else 1.0) for k, row in enumerate(SPECTRUM[:-1])}
)
#: The row between two cuts.
_BETWEEN = [_row_of((a + b) / 2) for a, b in zip([-1.0, *(c[0] for c in _CUTS)], [*(c[0] for c in _CUTS), 2 * _CUTS[-1][0]], strict=True)]


def _classify(f: Column, value) -> Column:
    """Value of the row of a frequency, by a search tree of seven comparisons; NaN and null are unknown."""

    def tree(lo: int, hi: int) -> Column:
        rows = {value(r) for r in _BETWEEN[lo : hi + 1]}
        if len(rows) == 1:
            return F.lit(rows.pop())
        middle = (lo + hi + 1) // 2
        at, below, scale = _CUTS[middle - 1]
        x = f if scale == 1 else f * scale
        above = x > at * scale if below else x >= at * scale
        return F.when(above, tree(middle, hi)).otherwise(tree(lo, middle - 1))

    return F.when(F.isnan(f) | f.isNull(), F.lit(value((0, "Unknown")))).otherwise(tree(0, len(_CUTS)))


def band_id(f: Column) -> Column:
    return _classify(f, lambda row: row[0])


def band_name(f: Column) -> Column:
    return _classify(f, lambda row: row[1])


def is_wspr_frequency(f: Column) -> Column:
    return F.coalesce(_classify(f, lambda row: row in WSPR_SEGMENTS), F.lit(False))


_BAND_SCHEMA = "band int, name string, frequency_class string, min_mhz double, max_mhz double, is_wspr boolean"


def wspr_bands(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*row, True) for row in WSPR_SEGMENTS], _BAND_SCHEMA)


def amateur_bands(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*row, False) for row in AMATEUR_BANDS], _BAND_SCHEMA)


def bands_dim(spark: SparkSession) -> DataFrame:
    """One row per band: its WSPR segment if it has one, else its amateur band, else its spectrum class."""
    rows = {row[0]: (*row, False) for row in SPECTRUM + AMATEUR_BANDS} | {row[0]: (*row, True) for row in WSPR_SEGMENTS}
    return spark.createDataFrame([rows[k] for k in sorted(rows)], _BAND_SCHEMA)


def band_info(df: DataFrame, id_col: str) -> DataFrame:
    """``df`` with the data of the band in ``id_col``; unknown bands are left out. The dimension has 35 rows."""
    dim = bands_dim(df.sparkSession).withColumnRenamed("band", id_col)
    return df.join(F.broadcast(dim), id_col)


def join_band_plan(df: DataFrame, freq_col: str, plan: DataFrame) -> DataFrame:
    """``df`` with plan_band: the band of lowest ``priority`` in ``plan`` (band, min_mhz, max_mhz, priority) that
    holds the frequency, the smaller band on ties; null outside. A plan of at most PLAN_ROWS rows, which is counted first,
    becomes one expression; a larger one is cut into disjoint segments that the rows are joined with."""
    from ..operators.ranges import range_lookup

    rows = plan.select("band", "min_mhz", "max_mhz", "priority").orderBy("priority", "band").limit(PLAN_ROWS + 1)
    if rows.count() > PLAN_ROWS:
        found = range_lookup(df, freq_col, plan, "min_mhz", "max_mhz", ["priority", "band"], "plan_band")
        return found.withColumn("plan_band", F.col("plan_band.band"))
    f, out = F.col(freq_col), F.lit(None).cast("int")
    for r in reversed(rows.collect()):
        out = F.when(f.between(r["min_mhz"], r["max_mhz"]), F.lit(r["band"])).otherwise(out)
    return df.withColumn("plan_band", out)


def band_predicate(f: Column, name: str) -> Column:
    """Frequencies that ``band_name`` can call ``name``, as plain ranges for file pruning (a superset for spectrum classes)."""
    out = F.lit(False)
    for row in WSPR_SEGMENTS + AMATEUR_BANDS:
        if row[1] == name:
            out = out | f.between(row[3], row[4])
    for row in SPECTRUM:
        if row[1] == name:
            out = out | (f < row[4] if row[0] == 1 else f >= row[3] if not row[4] else (f >= row[3]) & (f < row[4]))
    return out
