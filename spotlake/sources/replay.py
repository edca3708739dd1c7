"""A replayable log of messages with offsets, in a shared folder: the broker-shaped source of the live feed.

A topic is a few partitions, each a run of segments named ``<partition>-<first offset>-<rows>.log`` with a message a line, so that names alone say what is there. Keys and
values may be anything without line feeds. As a streaming source (format ``spot_log``, option ``path``), its offset is the next one of each partition; a restart goes on
from the checkpoint, and any range can be read again.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..operators.scan import ordered_scan
from .files import _store_of

#: Messages of a segment.
SEGMENT_ROWS = 10_000
#: Messages that a task of the source reads: of as many segments as it takes, but one at least.
TASK_ROWS = 20_000


def segments(path: str) -> dict[int, list[tuple[int, int, str]]]:
    """(first offset, rows, place) of the segments of each partition, in order."""
    store, root = _store_of(path)
    out: dict[int, list[tuple[int, int, str]]] = {}
    for f in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        if f.base_name.endswith(".log"):
            partition, first, rows = map(int, f.base_name.removesuffix(".log").split("-"))
            out.setdefault(partition, []).append((first, rows, f.path))
    return {p: sorted(s) for p, s in out.items()}


def ends(path: str) -> dict[int, int]:
    """The next offset of each partition."""
    return {p: s[-1][0] + s[-1][1] for p, s in segments(path).items()}


def publish(messages: DataFrame, path: str, *, partitions: int = 4, segment_rows: int = SEGMENT_ROWS) -> int:
    """Append messages (key, value; texts, keys may be null) to the log, those of a key to one partition; returns their number. A partition
    is written in the order of its values' arrival in the job, by a task a segment; one publisher at a time. An attempt that is repeated writes the same segments again."""
    start = ends(path)
    first = F.create_map(*[F.lit(x) for p in range(partitions) for x in (p, start.get(p, 0))])
    rows = messages.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    rows = rows.withColumn("partition", F.pmod(F.coalesce(F.xxhash64("key"), F.lit(0)), F.lit(partitions)).cast("int"))
    # Numbered by ranges on many tasks, as a partition may hold any number of messages.
    rows = ordered_scan(rows.withColumn("_one", F.lit(1).cast("long")), ["partition"], ["key", "value"], total={"_number": "_one"})
    rows = rows.withColumn("offset", F.col("_number") - 1 + first[F.col("partition")]).drop("_one", "_number")
    rows = rows.withColumn("segment", F.floor((F.col("offset") - first[F.col("partition")]) / segment_rows))

    def write(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("offset")
        store, root = _store_of(path)
        store.create_dir(root, recursive=True)
        lines = [json.dumps([k, base64.b64encode(v.encode()).decode() if v is not None else None]) for k, v in zip(table["key"].to_pylist(), table["value"].to_pylist(), strict=True)]
        name = f"{table['partition'][0]}-{table['offset'][0]}-{len(lines)}.log"
        with store.open_output_stream(f"{root}/.{name}", compression=None) as out:
            out.write("".join(x + "\n" for x in lines).encode())
        store.move(f"{root}/.{name}", f"{root}/{name}")
        return pa.table({"rows": pa.array([len(lines)], pa.int64())})

    return rows.groupBy("partition", "segment").applyInArrow(write, "rows long").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


@dataclass
class Stretch(InputPartition):
    """Offsets [start, stop) of a partition, and the segments that hold them (first offset, place), in order."""

    partition: int
    start: int
    stop: int
    segments: list[tuple[int, str]]


class SpotLogReader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {str(p): n for p, n in ends(self.path).items()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out = []
        for p, held in segments(self.path).items():
            low, high = start.get(str(p), 0), end.get(str(p), 0)
            last = None
            for first, rows, place in held:
                if first >= high or first + rows <= low:
                    continue
                a, b = max(low, first), min(high, first + rows)
                if last and b - last.start <= TASK_ROWS:
                    last.stop = b
                    last.segments.append((first, place))
                else:
                    last = Stretch(p, a, b, [(first, place)])
                    out.append(last)
        return out

    def read(self, stretch: Stretch) -> Iterator[tuple]:
        store, _ = _store_of(self.path)
        for first, place in stretch.segments:
            with store.open_input_stream(place, compression=None) as stream:
                held = stream.read().decode().splitlines()
            for offset, line in enumerate(held, first):
                if stretch.start <= offset < stretch.stop:
                    key, value = json.loads(line)
                    yield stretch.partition, offset, key, None if value is None else base64.b64decode(value)

    def commit(self, end: dict) -> None:
        """Segments stay: any range can be read again."""


class SpotLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "spot_log"

    def schema(self) -> str:
        return "partition int, offset long, key string, value binary"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return SpotLogReader(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(SpotLog)
