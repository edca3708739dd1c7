"""Readers on files of each raw format."""

import gzip
import io
import tarfile
import zipfile

from pyspark.sql import functions as F
from spotlake.sources import cabrillo, files, pskr, rbn, solar, wspr

WSPR = "7045401,1700000000,K9AN,EN50,-21,14.097150,G8JNJ,IO90,37,0,6217,47,14,2.1,0"


def test_wspr_containers(spark, tmp_path):
    (tmp_path / "a.csv").write_text(WSPR + "\nshort,line\n")
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write(WSPR + ",1.5,2.5,3.5,4.5\n")
    with tarfile.open(tmp_path / "c.tar.gz", "w:gz") as t:
        data = (WSPR + "\r\n" + WSPR.replace("-21", "-999") + "\n").encode()
        info = tarfile.TarInfo("spots.csv")
        info.size = len(data)
        t.addfile(info, io.BytesIO(data))
    got = wspr.read_wspr(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv.gz"])
    good = got.where("_ok").orderBy("column_count").collect()
    assert [r.frequency for r in good] == [14097150] * 2 and good[1].rx_lat == 1.5 and good[0].band == 107
    assert [r._reason for r in got.where("not _ok").collect()] == ["insufficient columns"]
    tar = wspr.read_wspr_tar(spark, f"{tmp_path}/c.tar.gz")
    assert sorted(str(r._reason) for r in tar.collect()) == ["None", "invalid snr"]
    lenient = wspr.read_wspr_tar(spark, f"{tmp_path}/c.tar.gz", policy="lenient").where("line_no = 2").first()
    assert lenient.snr == -128 and lenient._ok


def test_rbn_zip(spark, tmp_path):
    rows = ["callsign,de_pfx", "S50ARX,S5,EU,7018.3,40m,K1TTT,K,NA,CQ,12,2009-02-21 00:00:00+00", "(end", "S50ARX,S5,EUR,x,40m,K1TTT,K,NA,CQ,12,2009-02-21 00:00:00"]
    with zipfile.ZipFile(tmp_path / "20090221.zip", "w") as z:
        z.writestr("20090221.csv", "\n".join(rows))
    with zipfile.ZipFile(tmp_path / "20120221.zip", "w") as z:
        z.writestr("20120221.csv", "S50ARX,S5,EU,7018.3,40m,K1TTT,K,NA,CQ,12,2012-02-21 00:00:00,25,CW\n")
    with zipfile.ZipFile(tmp_path / "empty.zip", "w") as z:
        z.writestr("readme.txt", "")
    got = rbn.read_rbn_zip(spark, f"{tmp_path}/*.zip").orderBy("timestamp").collect()
    assert [(r._ok, r.frequency, r.speed, r.tx_mode) for r in got if r._ok] == [(True, 7018, 0, ""), (True, 7018, 25, "CW")]
    assert [r._reason for r in got if not r._ok] == ["bad frequency"]


def test_cabrillo(spark, tmp_path):
    (tmp_path / "cq" / "2005cw").mkdir(parents=True)
    text = "START-OF-LOG: 2.0\nCALLSIGN: k1abc\nCONTEST: cq-ww-cw\nGRID-LOCATOR: fn42\nQSO: 7000.9 CW\xa02005-11-26 0001 K1ABC 599 05 x JA1XYZ 599 25\nQSO: bad\nEND-OF-LOG:\nQSO: 7000 CW 2005-11-26 0001 K1ABC 599 05 W1AW 599 25\n"
    (tmp_path / "cq" / "2005cw" / "k1abc.log").write_bytes(text.encode("iso-8859-1"))
    (tmp_path / "cq" / "2005cw" / "none.log").write_text("QSO: 7000 CW 2005-11-26 0001 K1ABC 599 05 W1AW 599 25\n")
    lines = cabrillo.read_cabrillo_lines(spark, str(tmp_path))
    parsed = cabrillo.parse_cabrillo(lines, root=f"file:{tmp_path}").cache()
    r = parsed.where("_ok").first()
    assert (r.frequency, r.call_1, r.call_2, r.rst_sent, r.exch_sent, r.rst_rcvd, r.exch_rcvd, r.contest, r.source) == (7000, "K1ABC", "JA1XYZ", "599", "05 x", "599", "25", "CQ-WW-CW", "cq/2005cw")
    assert sorted(x._reason for x in parsed.where("not _ok").collect()) == ["no callsign", "too few fields"]
    assert [x.file.rsplit("/", 1)[1] for x in cabrillo.rejects(lines, parsed).collect()] == ["none.log"]
    grids = cabrillo.grid_enrichment(cabrillo.cabrillo_headers(lines), F.lit("2024-01-01").cast("date")).collect()
    assert [(g.callsign, g.grid, g.grid_4) for g in grids] == [("K1ABC", "FN42MM", "FN42")]


def test_pskr(spark, tmp_path):
    with gzip.open(tmp_path / "a.jsonl.gz", "wt") as f:
        f.write('{"ts":"2026-02-10T01:17:43Z","sc":"K1ABC","sg":"FN42","rc":"W1AW","rg":"FN31","f":14074000,"band":107,"mode":"FT8","snr":-5}\n{bad\n{"ts":"x","sc":"K","rc":"W","f":1}\n{"ts":"2026-02-10T01:17:43Z","sc":"","rc":"W","f":1}\n')
    got = pskr.read_pskr_jsonl(spark, f"{tmp_path}/a.jsonl.gz").collect()
    assert sorted(str(r._reason) for r in got) == ["None", "bad json", "bad timestamp", "missing field"]
    assert [r.snr for r in got if r._ok] == [-5]


def documents(spark, *texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "file string, text string")


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "line string")


def test_kp_forms(spark):
    arrays = '[["time_tag","Kp","a_running","station_count"],["2026-01-27 00:00:00.000","3.33","18","8"],["bad","1","1","1"]]'
    objects = '[{"time_tag":"2026-04-21T00:00:00","Kp":4.67,"a_running":39,"station_count":8}]'
    got = {str(r.time): (r.kp_index, r.ap_index) for r in solar.parse_kp(documents(spark, arrays, objects, "[]", "{bad")).collect()}
    assert got == {"2026-01-27 00:00:00": (3.33, 18.0), "2026-04-21 00:00:00": (4.67, 39.0)}


def test_xray_flux_indices(spark):
    x = solar.parse_xray(documents(spark, '[{"time_tag":"2026-02-02T18:14:00Z","satellite":18,"flux":1.2e-6,"energy":"0.1-0.8nm"},{"time_tag":"x","flux":1,"energy":"e"}]')).collect()
    assert [(r.t, r.flux) for r in x] == [(1770056040, 1.2e-6)]
    f = solar.parse_flux_daily(documents(spark, '[{"time_tag":"2026-04-17T20:00:00","flux":107}]')).collect()
    assert [(str(r.date), r.observed_flux) for r in f] == [("2026-04-17", 107.0)]
    s = solar.parse_flux_summary(documents(spark, '{"Flux":"174","TimeStamp":"2026-02-02 20:00:00"}')).collect()
    assert [(str(r.time), r.flux) for r in s] == [("2026-02-02 20:00:00", 174.0)]
    n = solar.parse_indices(documents(spark, '[{"time-tag":"2024-05","ssn":171.7,"f10.7":187.0,"smoothed_f10.7":-1},{"time-tag":"2024","ssn":1}]')).collect()
    assert [(str(r.date), r.ssn, r.observed_flux, r.adjusted_flux) for r in n] == [("2024-05-15", 171.7, 187.0, 0.0)]


def test_wind_documents(spark):
    mag = '[["time_tag","bx_gsm","by_gsm","bz_gsm","lon_gsm","lat_gsm","bt"],["2026-02-21 22:22:00.000","1.1",null,"-3.5","0","0","4.2"]]'
    r = solar.parse_mag(documents(spark, mag)).first()
    assert (r.bx_gsm, r.by_gsm, r.bz_gsm, r.bt) == (1.1, 0.0, -3.5, 4.2)
    r = solar.parse_plasma(documents(spark, '[["time_tag","density","speed","temperature"],["2026-02-21 22:22:00.000","3.1","412.5","81000"]]')).first()
    assert (r.density, r.speed, r.temperature) == (3.1, 412.5, 81000.0)


def test_line_formats(spark):
    assert [(str(r.date), r.ssn) for r in solar.parse_sidc(lines(spark, "2024;02;31;2024.360;170;15.0;40;1", "# c", "", "2024;05", "2024;05;01;x;-1;;")).collect()] == [("2024-03-02", 170.0), ("2024-05-01", 0.0)]
    r = solar.parse_dsd(lines(spark, ":Product", "# x", "--- ", "Date", "1880 05 11 2140 1", "bad")).collect()
    assert [(str(x.date), x.year, x.observed_flux, x.original_value) for x in r] == [("1900-01-01", 1880, 214.0, 2140.0)]
    fixed = "2024 05 11 00.0".ljust(47) + " 4.67" + "   " + "39" + "  "
    got = solar.parse_kpap_fixed(lines(spark, fixed.ljust(59) + "x", fixed.replace("00.0", "03.0").ljust(59) + "x", "short")).collect()
    assert [(str(x.date), x.kp_index, x.ap_index) for x in got] == [("2024-05-11", 4.67, 39.0)]
    g = "2024 5 11 1 1 1 1 " + " ".join(["-1.000", *["3.333"] * 7]) + " " + " ".join(["7"] * 8) + " 15 -1 187.4 -1.0"
    r = solar.parse_gfz(lines(spark, g, "#", "1 2")).first()
    assert r.kp[0] == 0 and r.kp[1] == 3.333 and r.ap == [7.0] * 8 and (r.ssn, r.observed_flux, r.adjusted_flux) == (0.0, 187.4, 0.0)


def test_listing_and_formats(spark, tmp_path):
    (tmp_path / "2024").mkdir()
    (tmp_path / "2024" / "a.csv").write_text("x")
    (tmp_path / "2025b.csv").write_text("xy")
    got = files.list_files(spark, str(tmp_path), "*.csv")
    assert sorted((r.file_path, r.file_size) for r in got.collect()) == [("2024/a.csv", 1), ("2025b.csv", 2)]
    assert [r.file_path for r in files.list_files(spark, str(tmp_path), year=2025).collect()] == ["2025b.csv"]
    assert files.list_files(spark, str(tmp_path), min_age="1 hour").count() == 0
    df = spark.createDataFrame([("/d/SIDC_2024.csv", "2"), ("flux.txt", "["), ("flux.txt", "2"), ("goes_xray.json", "[")], "n string, c string")
    assert [r[0] for r in df.select(files.detect_format(F.col("n"), F.col("c"))).collect()] == ["sidc", "sfi_json", "unknown", "xray_json"]


def test_listing_by_year_and_contest(spark, tmp_path):
    for name in ("2024/2019-x.zip", "2025/a.zip", "cq-ww/2024/a.log", "cq-ww-cw/b.log", "2024.zip"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    found = lambda **how: sorted(r.file_path for r in files.list_files(spark, str(tmp_path), **how).collect())
    assert {r.file_path for r in files.list_files(spark, f"file://{tmp_path}", contest="cq-ww").collect()} == {"cq-ww/2024/a.log"}
    assert found(year=2024) == ["2024.zip", "2024/2019-x.zip"] and found(year=2019) == []
    assert found(contest="cq-ww") == ["cq-ww/2024/a.log"] and len(found(min_age="0 seconds")) == 5 and found(min_age="1 hour") == []


def test_mixed_solar_files(spark, tmp_path):
    (tmp_path / "SIDC_x.csv").write_text("2024;05;11;2024.360;170;15.0;40;1\n#\n")
    (tmp_path / "noaa_kp_index.json").write_text('[["time_tag","Kp","a_running"],["2024-05-11 00:00:00.000","9.00","400"]]')
    (tmp_path / "goes_xray.json").write_text('[{"time_tag":"2024-05-11T01:14:00Z","satellite":18,"flux":1e-3,"energy":"0.1-0.8nm"}]')
    (tmp_path / "readme.txt").write_text("flux")
    from spotlake.operators.solar import read_solar_folder

    got = {r.source_file: r for r in read_solar_folder(spark, str(tmp_path)).collect()}
    assert set(got) == {"sidc", "kp_json", "xray_json"} and {str(r.date) for r in got.values()} == {"2024-05-11"}
    assert (got["sidc"].ssn, got["kp_json"].kp_index) == (170, 9) and abs(got["xray_json"].xray_long - 1e-3) < 1e-9


def test_lines_are_split_once(spark):
    """Filters on parsed rows don't repeat the split, and quoted lines are read from the left."""
    from spotlake.functions.clean import fields
    from spotlake.sources import cabrillo, rbn, wspr
    from pyspark.sql import functions as F

    lines = spark.createDataFrame([("f", 1, "x")], "file string, line_no long, line string")
    for parse in (wspr.parse_wspr, rbn.parse_rbn, cabrillo.parse_cabrillo):
        plan = parse(lines).where("_ok")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("split(") <= 3, parse
    odd = ['a,"b,c",d', '"x ""y""",', ",,", 'a"b,c,"d', '"', ""]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in odd], "c string").select(fields(F.col("c"))).collect()]
    assert got == [["a", "b,c", "d"], ['x "y"', ""], ["", "", ""], ['a"b,c,"d'], ['"'], [""]]
