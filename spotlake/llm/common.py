"""Helpers that the operators share: Arrow blocks of bounded size and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker handles at once.
BLOCK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 of each row; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def text_blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes in ``column``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start, before = 0, 0
        while start < len(ends):
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start, before = stop, int(ends[stop - 1])


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column in one array, and where each row starts (one more entry than rows)."""
    rows = text_bytes(column)
    starts = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(x) for x in rows], out=starts[1:])
    return np.frombuffer(b"".join(rows), np.uint8), starts


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where neither the session nor the context has one, a local session
    gets a temporary one, as in tests; on a cluster, whose machines don't share such a folder, that is an error."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` in the shared folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as compressed Parquet in the shared folder, read again: smaller than a checkpoint where texts are long."""
    path = f"{checkpoint_folder(df.sparkSession)}/written-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete what was written at ``path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number of each row, and that column's name. Written, so that a lost task can't draw other numbers."""
    name = "_row"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return written(docs.withColumn(name, F.monotonically_increasing_id())), name


def ranked_id(id_col: str, row: str) -> F.Column:
    """An identifier of a row that orders by id, null ids last, and then by the row's number."""
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row).alias("row"))


#: Most row numbers (eight bytes each) that are broadcast.
FEW_ROWS = 2_000_000


def chosen_rows(docs: DataFrame, row: str, chosen: DataFrame) -> DataFrame:
    """The numbered rows whose numbers are in ``chosen``, without the number. Few numbers, which are counted first, are sent to
    the rows; more of them meet the rows in a shuffle."""
    chosen = checkpointed(chosen.withColumnsRenamed({chosen.columns[0]: row}))
    few = chosen.limit(FEW_ROWS + 1).count() <= FEW_ROWS
    return docs.join(F.broadcast(chosen) if few else chosen, row, "left_semi").drop(row)


def normal_space(text) -> F.Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def token_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without ASCII white space."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


#: A random word for each byte, and the odd base of the position weights.
_BYTE_WORDS = np.random.default_rng(42).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span (spans in order, apart, not empty)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    place = np.arange(int(sizes.sum())) - np.repeat(offsets, sizes)
    weights = np.full(int(sizes.max()), _BASE, np.uint64)
    weights[0] = 1
    weights = np.cumprod(weights, dtype=np.uint64)
    h = np.add.reduceat(_BYTE_WORDS[data[np.repeat(starts, sizes) + place]] * weights[place], offsets)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes (spans are not empty), eight bytes at a time."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    sizes = ends - starts
    masks = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
    h = sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    live, at = np.arange(len(starts)), 0
    while len(live):
        part = eights[starts[live] + at] & masks[np.minimum(sizes[live] - at, 8)]
        x = (h[live] ^ part) * np.uint64(0xBF58476D1CE4E5B9)
        h[live] = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        at += 8
        live = live[sizes[live] > at]
    return h ^ (h >> np.uint64(29))
