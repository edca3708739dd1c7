"""Schemas of the stored tables. Nothing stored is null: absent values are 0 or empty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "smallint": T.ShortType(), "tinyint": T.ByteType(), "float": T.FloatType(), "double": T.DoubleType(), "string": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampType()}


def _schema(text: str) -> T.StructType:
    """A schema from ``name type`` pairs, without a session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (pair.split() for pair in text.split(","))])


WSPR = _schema(
    "id long, timestamp timestamp, reporter string, reporter_grid string, snr tinyint, frequency long, callsign string, grid string, power tinyint, drift tinyint,"
    " distance long, azimuth int, band int, mode string, version string, code smallint, column_count smallint"
)
WSPR_SPOTS = T.StructType(WSPR.fields + _schema("rx_lat float, rx_lon float, tx_lat float, tx_lon float").fields)
RBN = _schema("timestamp timestamp, de_call string, de_pfx string, de_cont string, frequency long, band int, dx_call string, dx_pfx string, dx_cont string, spot_type string, snr smallint, speed int, tx_mode string")
CONTEST = _schema("timestamp timestamp, frequency long, band int, mode string, call_1 string, call_2 string, rst_sent string, exch_sent string, rst_rcvd string, exch_rcvd string, contest string, source string")
CALLSIGN_GRID = _schema("callsign string, grid string, grid_4 string, spot_count long, last_seen date")
PSKR = _schema("timestamp timestamp, sender_call string, sender_grid string, receiver_call string, receiver_grid string, frequency long, band int, mode string, snr smallint")
SOLAR = _schema("date date, time timestamp, observed_flux float, adjusted_flux float, ssn float, kp_index float, ap_index float, xray_short float, xray_long float, source_file string")
SOLAR_WIND = _schema("date date, time timestamp, bz_gsm float, bt float, bx_gsm float, by_gsm float, speed float, density float, temperature float, source_file string")
LIVE_CONDITIONS = _schema("kp_index double, ap_index double, solar_flux double, xray_short double, xray_long double, conditions string")
INGEST_LOG = _schema("file_path string, file_size long, row_count long, loaded_at timestamp, elapsed_ms long, hostname string")

SOLAR_MEASURES = ("observed_flux", "adjusted_flux", "ssn", "kp_index", "ap_index", "xray_short", "xray_long")
WIND_MEASURES = ("bz_gsm", "bt", "bx_gsm", "by_gsm", "speed", "density", "temperature")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in order and type; absent ones, and nulls, become 0 or empty."""
    zero = {"string": "", "date": None, "timestamp": None}
    out = []
    for f in schema:
        value = F.col(f.name) if f.name in df.columns else F.lit(None)
        kind = f.dataType.simpleString()
        absent = zero.get(kind, 0)
        value = value.cast(f.dataType)
        out.append((value if absent is None else F.coalesce(value, F.lit(absent).cast(f.dataType))).alias(f.name))
    return df.select(*out)
