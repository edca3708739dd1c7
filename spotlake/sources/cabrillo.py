"""Contest logs in Cabrillo form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.bands import band_id
from ..functions.clean import grid4, is_callsign, pad_grid6, plain_spaces, settled, source_key, to_float, valid_grid, words
from ..functions.times import cabrillo_time
from ..operators.scan import ordered_scan
from .files import numbered_lines


def _body(line: Column, size: int) -> Column:
    return F.upper(F.trim(F.substring(line, size + 1, 1 << 20)))


def _log_lines(lines: DataFrame, tasks: int | None = None) -> DataFrame:
    """Non-blank lines before END-OF-LOG, with what is known of their file: the callsign so far, and the last contest and grid. A
    file is one task's work, or with ``tasks`` that of as many as it takes."""
    rows = lines.select("file", "line_no", F.trim(plain_spaces(F.col("line"))).alias("line")).where("line <> ''")
    # The line alone is sorted, not a second one in capitals beside it.
    up = F.upper("line")
    # One order for all windows: a task sorts its lines once.
    ordered = Window.partitionBy("file").orderBy("line_no")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.min(F.when(up.startswith("END-OF-LOG"), F.col("line_no")))
    rows = rows.join(rows.groupBy("file").agg(end.alias("_end")), "file") if tasks else rows.withColumn("_end", end.over(whole))
    rows = rows.where("_end is null or line_no < _end").drop("_end")
    grid = F.when(up.startswith("GRID-LOCATOR:"), _body(F.col("line"), 13)).when(up.startswith("HQ-GRID-LOCATOR:"), _body(F.col("line"), 16))
    rows = rows.withColumns(
        {
            "_call": F.when(up.startswith("CALLSIGN:"), _body(F.col("line"), 9)),
            "_contest": F.when(up.startswith("CONTEST:"), _body(F.col("line"), 8)),
            "_grid": F.when(valid_grid(grid), grid),
        }
    )
    if tasks:
        latest = lambda c: F.coalesce(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("line_no"))), F.lit(""))
        heads = rows.groupBy("file").agg(latest("_contest").alias("contest"), latest("_grid").alias("grid"))
        scanned = ordered_scan(rows, ["file"], ["line_no"], last={"header_call": "_call"}, tasks=tasks)
        return scanned.join(heads, "file").withColumn("header_call", F.coalesce("header_call", F.lit("")))
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("line_no"))).over(whole)
    return rows.withColumns({"header_call": F.coalesce(F.last("_call", ignorenulls=True).over(so_far), F.lit("")), "contest": F.coalesce(last("_contest"), F.lit("")), "grid": F.coalesce(last("_grid"), F.lit(""))})


def parse_cabrillo(lines: DataFrame, *, root: str = "", tasks: int | None = None) -> DataFrame:
    """Contacts of ``lines`` (file, line_no, line) in the columns of contest.bronze, with file, line_no, _ok, _reason.

    A contact needs a CALLSIGN header before it; its own call comes from its line. The other call is the
    first word after the own one that looks like a callsign and isn't it. The band follows the kHz
    without decimals. A file's contest is the last one named, for all its rows. ``tasks``: into how many ranges all lines are dealt,
    where single files are too long for a task; left out, a file is one task's work."""
    rows = _log_lines(lines, tasks).where(F.upper("line").startswith("QSO:")).withColumn("_f", words(F.col("line")))
    # ``QSO:7000`` without a space keeps its first word, as one that is not ``QSO:``.
    rows = rows.withColumn("_f", F.when(F.upper(F.rtrim(F.get("_f", F.lit(0)), F.lit(":"))) == "QSO", F.expr("slice(_f, 2, greatest(size(_f) - 1, 0))")).otherwise(F.col("_f")))
    at = lambda k: F.get("_f", F.lit(k))
    rows = rows.withColumns({"_own": F.upper(at(4)), "_khz": F.floor(F.when(at(0) != "", to_float(at(0)))).cast("long"), "timestamp": cabrillo_time(at(2), at(3))})
    marked = F.transform("_f", lambda x, i: F.struct(i.alias("i"), ((i >= 5) & is_callsign(x) & (F.upper(x) != F.col("_own"))).alias("hit")))
    rows = settled(rows.withColumns({"_at": F.get(F.filter(marked, lambda x: x["hit"]), F.lit(0))["i"], "_mhz": F.col("_khz") / 1000.0}))
    reason = F.when(F.col("header_call") == "", "no callsign").when(F.size("_f") < 8, "too few fields").when(F.col("_khz").isNull(), "bad frequency").when(F.col("timestamp").isNull(), "bad timestamp").when(F.col("_at").isNull(), "no other call")
    part = lambda a, b: F.array_join(F.expr(f"slice(_f, {a}, greatest({b}, 0))"), " ")
    none = F.lit("")
    out = rows.select(
        "file",
        "line_no",
        "timestamp",
        F.col("_khz").alias("frequency"),
        band_id(F.col("_mhz")).alias("band"),
        F.upper(at(1)).alias("mode"),
        F.col("_own").alias("call_1"),
        F.upper(F.get("_f", F.col("_at"))).alias("call_2"),
        F.when(F.col("_at") > 5, at(5)).otherwise(none).alias("rst_sent"),
        F.when(F.col("_at") > 6, part(7, "_at - 6")).otherwise(none).alias("exch_sent"),
        F.coalesce(F.get("_f", F.col("_at") + 1), none).alias("rst_rcvd"),
        F.coalesce(part("_at + 3", "size(_f) - _at - 2"), none).alias("exch_rcvd"),
        "contest",
        source_key(F.col("file"), root).alias("source"),
        reason.isNull().alias("_ok"),
        reason.alias("_reason"),
    )
    return settled(out)


def cabrillo_headers(lines: DataFrame) -> DataFrame:
    """file, callsign, contest and grid (the last of each that stands before END-OF-LOG; empty if none)."""
    last = _log_lines(lines).groupBy("file").agg(F.max_by("header_call", "line_no").alias("callsign"), F.max("contest").alias("contest"), F.max("grid").alias("grid"))
    return last


def grid_enrichment(headers: DataFrame, today: Column) -> DataFrame:
    """callsign_grid rows of the headers that have both a callsign and a grid."""
    good = headers.where("callsign <> '' and grid <> ''")
    return good.select("callsign", pad_grid6(F.col("grid")).alias("grid"), grid4(F.col("grid")).alias("grid_4"), F.lit(0).cast("long").alias("spot_count"), today.alias("last_seen"))


def file_outcomes(lines: DataFrame, parsed: DataFrame, listing: DataFrame | None = None) -> DataFrame:
    """One row for each file of ``listing`` (column file; left out: the files that have lines): file, outcome, n_ok, n_failed (contacts) and
    reason (null where rows were loaded).

    outcome: ``loaded``; ``failed`` where none of the contacts was accepted; ``empty`` where the log has no contact;
    ``unreadable`` where a listed file gave no line at all. Files that aren't listed have no row."""
    by_file = parsed.groupBy("file").agg(F.count_if("_ok").alias("n_ok"), F.count_if(~F.col("_ok")).alias("n_failed"))
    seen = lines.select("file").distinct()
    out = seen.withColumn("_seen", F.lit(True)) if listing is None else listing.select("file").distinct().join(seen.withColumn("_seen", F.lit(True)), "file", "left")
    none = F.lit(0).cast("long")
    out = out.join(by_file, "file", "left").withColumns({"n_ok": F.coalesce("n_ok", none), "n_failed": F.coalesce("n_failed", none)})
    outcome = F.when(F.col("_seen").isNull(), "unreadable").when(F.col("n_ok") > 0, "loaded").when(F.col("n_failed") > 0, "failed").otherwise("empty")
    lost = F.concat(F.lit("all "), F.col("n_failed").cast("string"), F.lit(" QSO lines failed to parse"))
    reason = F.when(F.col("outcome") == "failed", lost).when(F.col("outcome") == "empty", "0 QSOs parsed").when(F.col("outcome") == "unreadable", "file can't be read")
    return out.withColumn("outcome", outcome).select("file", "outcome", "n_ok", "n_failed", reason.alias("reason"))


def rejects(lines: DataFrame, parsed: DataFrame, listing: DataFrame | None = None) -> DataFrame:
    """file and reason of the files that gave no contact (see ``file_outcomes``)."""
    return file_outcomes(lines, parsed, listing).where("outcome <> 'loaded'").select("file", "reason")


def read_cabrillo_lines(spark: SparkSession, root: str, glob: str = "*.log") -> DataFrame:
    """file, line_no and line of the logs below ``root``, decoded as ISO-8859-1 so that any byte can be read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return numbered_lines(files.select(F.col("path").alias("file"), F.decode("content", "ISO-8859-1").alias("text")))
