"""File listings, text lines and archive members."""

from __future__ import annotations

import io
import re
import tarfile
import zipfile
import zlib
from collections.abc import Iterator
from typing import IO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import relative_path

#: Lines that an archive reader hands over at once.
BATCH_LINES = 50_000
#: Characters of a line of a streamed archive, its end included.
LINE_CHARS = 1 << 20


def list_files(spark: SparkSession, root: str, glob: str = "*", *, min_age: str | None = None, year: int | None = None, contest: str | None = None) -> DataFrame:
    """file_path (relative to ``root``), file_size and modified of the files below ``root``, contents unread.

    min_age: an interval such as ``5 minutes``; younger files are left out. year: only files of that year's folder, or
    where files lie in no year's folder, those whose name starts with it. contest: only files of that folder."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    base = re.sub("^file:/+", "file:/", root) if ":/" in root else f"file:{root}"
    out = found.select(relative_path(F.regexp_replace("path", "^file:/+", "file:/"), base).alias("file_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("modified"))
    if min_age:
        out = out.where(F.col("modified") <= F.current_timestamp() - F.expr(f"interval {min_age}"))
    if year:
        folder = F.regexp_extract("file_path", r"^(\d{4})/", 1)
        out = out.where(F.when(folder != "", folder).otherwise(F.regexp_extract("file_path", r"([0-9]{4})[^/]*$", 1)) == str(year))
    return out.where(F.startswith("file_path", F.lit(contest.rstrip("/") + "/"))) if contest else out


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file and line of text files, plain or gz. A gz file is one task: repartition before heavy work."""
    return spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))


def spread(lines: DataFrame) -> DataFrame:
    """``lines`` over all cores where they come in fewer partitions than that (gz files, archives, small tables); as they are otherwise."""
    cores = lines.sparkSession.sparkContext.defaultParallelism
    return lines.repartition(cores) if lines.rdd.getNumPartitions() < cores else lines


def numbered_lines(documents: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """file, line_no (from 1) and line of whole documents."""
    lines = F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n", -1)
    return documents.select(F.col(file).alias("file"), F.posexplode(lines).alias("n", "line")).select("file", (F.col("n") + 1).cast("long").alias("line_no"), "line")


def read_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file and text of whole files."""
    return spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def _members(kind: str):
    def first_csv(content: bytes) -> io.TextIOBase | None:
        if kind == "zip":
            archive = zipfile.ZipFile(io.BytesIO(content))
            name = next((n for n in archive.namelist() if n.lower().endswith(".csv")), None)
            return name and io.TextIOWrapper(archive.open(name), "utf-8", errors="replace")
        archive = tarfile.open(fileobj=io.BytesIO(content), mode="r:*")  # noqa: SIM115
        member = next((m for m in archive if m.isfile() and m.name.lower().endswith(".csv")), None)
        return member and io.TextIOWrapper(archive.extractfile(member), "utf-8", errors="replace")

    def lines(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, path = ["file", "line_no", "line"], key[0].as_py()
        for batch in batches:
            for content in batch.column("content"):
                member = first_csv(content.as_py())
                held: list[str] = []
                n = 0
                for line in member or ():
                    held.append(line.rstrip("\r\n"))
                    if len(held) == BATCH_LINES:
                        yield pa.RecordBatch.from_arrays([pa.array([path] * len(held), pa.string()), pa.array(range(n + 1, n + 1 + len(held)), pa.int64()), pa.array(held)], names)
                        n, held = n + len(held), []
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(held), pa.string()), pa.array(range(n + 1, n + 1 + len(held)), pa.int64()), pa.array(held, pa.string())], names)

    return lines


def archive_lines(archives: DataFrame, kind: str) -> DataFrame:
    """file, line_no and line of the first CSV member of each of ``archives`` (path, content), of kind ``zip`` or ``tar``
    (tar.gz too). An archive is one group: a task's Python gets one at a time, not a batch of as many as an Arrow batch has rows."""
    return archives.select("path", "content").groupBy("path").applyInArrow(_members(kind), "file string, line_no long, line string")


def _store_of(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), path) if "://" not in path else fs.FileSystem.from_uri(path)


def _first_csv(stream: IO[bytes], kind: str) -> IO[bytes] | None:
    """The first CSV member of an archive, to be read piece by piece: a tar as it comes, a zip by its directory."""
    if kind == "zip":
        archive = zipfile.ZipFile(stream)
        name = next((n for n in archive.namelist() if n.lower().endswith(".csv")), None)
        return name and archive.open(name)
    archive = tarfile.open(fileobj=stream, mode="r:*")  # noqa: SIM115
    member = next((m for m in archive if m.isfile() and m.name.lower().endswith(".csv")), None)
    return member and archive.extractfile(member)


def stream_archives(spark: SparkSession, paths: str | list[str], kind: str, *, tasks: int | None = None) -> DataFrame:
    """file, line_no, line and fault of the first CSV member of archives (``zip``, or ``tar``, tar.gz too) of any size.

    An archive is one task, which reads it as a stream: it holds ``BATCH_LINES`` lines and a decompression buffer. An archive that is broken, cut
    off, without a CSV member or with a line above ``LINE_CHARS`` has a last row with its fault and no line; lines that stand before the
    break have theirs. Spark lists no files of zero bytes. Paths may hold patterns, and must be those of a store that tasks can open by pyarrow."""
    found = spark.read.format("binaryFile").load(paths).select("path")
    tasks = tasks or max(64, 4 * spark.sparkContext.defaultParallelism)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(path: str, n: int, held: list[str], fault: str | None = None) -> pa.RecordBatch:
            size = len(held) + (fault is not None)
            faults = pa.array([None] * len(held) + [fault] * (size - len(held)), pa.string())
            numbers = pa.array([*range(n + 1, n + 1 + len(held)), *[None] * (size - len(held))], pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([path] * size, pa.string()), numbers, pa.array(held + [None] * (size - len(held)), pa.string()), faults], ["file", "line_no", "line", "fault"])

        for batch in batches:
            for path in batch.column("path").to_pylist():
                held: list[str] = []
                n, fault = 0, None
                try:
                    store, place = _store_of(path)
                    with store.open_input_file(place) as stream:
                        member = _first_csv(stream, kind)
                        if member is None:
                            raise ValueError("no CSV member")
                        text = io.TextIOWrapper(member, "utf-8", errors="replace")
                        while line := text.readline(LINE_CHARS):
                            if len(line) == LINE_CHARS and line[-1] != "\n":
                                raise ValueError(f"line {n + len(held) + 1} is too long")
                            held.append(line.rstrip("\r\n"))
                            if len(held) == BATCH_LINES:
                                yield rows(path, n, held)
                                n, held = n + len(held), []
                except (OSError, EOFError, ValueError, RuntimeError, NotImplementedError, zlib.error, tarfile.TarError, zipfile.BadZipFile) as problem:
                    fault = f"{type(problem).__name__}: {problem}"
                if held or fault:
                    yield rows(path, n, held, fault)

    return found.repartition(tasks, "path").mapInArrow(lines, "file string, line_no long, line string, fault string")


def archive_faults(streamed: DataFrame) -> DataFrame:
    """file and reason of the archives that could not be read to their end, as the reject table has them."""
    return streamed.where("fault is not null").select("file", F.col("fault").alias("reason"))


def whole_archives(streamed: DataFrame) -> DataFrame:
    """file, line_no and line of the archives that were read to their end."""
    return streamed.where("fault is null").join(archive_faults(streamed).select("file"), "file", "left_anti").select("file", "line_no", "line")


def read_zip_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of zip archives."""
    return archive_lines(spark.read.format("binaryFile").load(paths), "zip")


def read_tar_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of tar and tar.gz archives."""
    return archive_lines(spark.read.format("binaryFile").load(paths), "tar")


def detect_format(name: Column, first_char: Column) -> Column:
    """Family of a solar file by its name, and by its first character where names are shared."""
    base = F.lower(F.regexp_extract(name, r"([^/]*)$", 1))
    return (
        F.when(base.startswith("sidc_") & base.endswith(".csv"), "sidc")
        .when(base.contains("kp_index") & base.endswith(".json"), "kp_json")
        .when(base.contains("xray") & base.endswith(".json"), "xray_json")
        .when(base.contains("flux") & base.endswith(".txt") & (first_char == "["), "sfi_json")
        .otherwise("unknown")
    )


def detect_legacy_format(name: Column, first_line: Column) -> Column:
    """Family by name, else by the first line that isn't blank or a comment."""
    base = F.lower(F.regexp_extract(name, r"([^/]*)$", 1))
    return (
        F.when(base.contains("sfi") | base.contains("flux"), "noaa")
        .when(base.contains("ssn") | base.contains("sunspot"), "sidc")
        .when(base.contains("kp") | base.contains("ap"), "kpap")
        .when(first_line.contains(";"), "sidc")
        .otherwise("noaa")
    )
