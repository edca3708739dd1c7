"""Mixing sources to target weights by iterative proportional fitting.

Token counts of (source, language, topic) cells are raked until the weighted tokens meet a
target share of every source, language and topic at once. The factors calibrate one sampling
probability per cell, and a hash of the document decides against it.

Languages and topics are few, so a source is one row with a small matrix of tokens, and a
sweep is one aggregate over the sources that returns such a matrix. The table of sources stays
distributed, unless it is seen to have ``LOCAL_SOURCES`` rows at most (a megabyte); the arithmetic is the same. Topics come from a small k-means model of hashed word counts, fitted on all
documents: their vectors are written once, and a sweep hands back a sum per centroid. Vectors and
centroids are whole numbers, so that sums are the same in whatever order they are taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, span_hashes, text_blocks, text_bytes, token_spans, written

LANGUAGES = ("en", "fr", "de", "es")
#: Topics, cells of a word-count vector, and the most sweeps of k-means.
TOPICS, CELLS, TOPIC_SWEEPS = 8, 256, 20
#: Length of a vector and of a centroid. All products and their sums stay below 2**53: they are exact as floats.
VECTOR_ONE, CENTROID_ONE = 1 << 23, 1 << 20
#: A target share is in proportion to the tokens to this power.
FLATTEN = 0.7
#: Share of the tokens to keep.
KEEP = 0.8
#: Sweeps go on until every marginal is this close to its target share, or so many times.
CLOSE, SWEEPS = 1e-6, 200
#: Stands for a null source, apart from an empty one, between the scan and the result.
NO_SOURCE = "\0"
#: Up to so many sources (a row of a small matrix each) are raked where the sweeps are driven; more of them stay distributed.
LOCAL_SOURCES = 4096
#: Bins (of the logarithm of the factors) by which the probabilities are calibrated.
BINS = 20_000


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each row, and its normalised square-root word counts by hashed word."""
    rows = text_bytes(column)
    data = np.frombuffer(b"".join(x + b"\n" for x in rows), np.uint8)
    row_starts = np.concatenate([[0], np.cumsum([len(x) + 1 for x in rows], dtype=np.int64)])
    starts, ends = token_spans(data)
    row = np.searchsorted(row_starts, starts, side="right") - 1
    n = len(row_starts) - 1
    cell = (span_hashes(data, starts, ends) & np.uint64(CELLS - 1)).astype(np.int64)
    counts = np.sqrt(np.bincount(row * CELLS + cell, minlength=n * CELLS).reshape(n, CELLS).astype(np.float32))
    counts /= np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-9)
    return np.bincount(row, minlength=n), counts


def _pack(vectors: np.ndarray) -> pa.Array:
    """Of each vector the cells that are not 0, four bytes each: the cell and the value times ``VECTOR_ONE``."""
    value = np.rint(vectors.astype(np.float64) * VECTOR_ONE).astype(np.uint32)
    row, cell = np.nonzero(value)
    entries = value[row, cell] << np.uint32(8) | cell.astype(np.uint32)
    ends = np.searchsorted(row, np.arange(len(vectors) + 1)).astype(np.int32) * 4
    return pa.Array.from_buffers(pa.binary(), len(vectors), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(entries.tobytes())])


def _unpack(packed: list[bytes]) -> np.ndarray:
    entries = np.frombuffer(b"".join(packed), np.uint32)
    out = np.zeros((len(packed), CELLS))
    out[np.repeat(np.arange(len(packed)), [len(x) // 4 for x in packed]), entries & np.uint32(CELLS - 1)] = entries >> np.uint32(8)
    return out


def _centroids(sums: np.ndarray) -> np.ndarray:
    """Sums brought to the length ``CENTROID_ONE``, in whole numbers."""
    sums = sums.astype(np.float64)
    return np.rint(sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9) * CENTROID_ONE)


def fit_topics(vectors: DataFrame, topics: int) -> np.ndarray:
    """Centroids of spherical k-means over all rows of ``vectors`` (order, vector); zeros where there are too few of them.

    The first centroids are the vectors of the smallest numbers ``order``. The driver gets ``topics`` vectors at the
    start, and ``topics`` x ``CELLS`` sums a sweep; sweeps end when no centroid changes."""
    out = np.zeros((topics, CELLS))
    first = vectors.where(F.length("vector") > 0).groupBy("order").agg(F.min("vector").alias("vector")).orderBy("order").limit(topics).collect()
    if not first:
        return out
    at = _centroids(_unpack([bytes(r["vector"]) for r in first]))
    for _ in range(TOPIC_SWEEPS):

        def add(batches: Iterator[pa.RecordBatch], at: np.ndarray = at) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((len(at), CELLS), np.int64)
            for batch in batches:
                packed = text_bytes(batch.column("vector"))
                for k in range(0, len(packed), 4096):
                    made = _unpack(packed[k : k + 4096])
                    own = np.argmax(made @ at.T, axis=1)
                    for c in range(len(at)):
                        sums[c] += made[own == c].sum(axis=0).astype(np.int64)
            topic, cell = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(topic.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(sums[topic, cell])], ["topic", "cell", "n"])

        got = vectors.select("vector").mapInArrow(add, "topic int, cell int, n long").groupBy("topic", "cell").agg(F.sum("n").alias("n")).toArrow()
        sums = np.zeros((len(at), CELLS), np.int64)
        sums[got["topic"].to_numpy(), got["cell"].to_numpy()] = got["n"].to_numpy()
        after = np.where(sums.any(axis=1)[:, None], _centroids(sums), at)
        if (after == at).all():
            break
        at = after
    out[: len(at)] = at
    return out


def topic_features(docs: DataFrame, *, id_col: str, text_col: str, keep: tuple[str, ...], topics: int = TOPICS) -> DataFrame:
    """doc_id, the columns ``keep``, tokens (words of the whole text) and topic."""
    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, F.xxhash64(text_col).alias("order"), F.col(text_col).alias("text"))
    names = ["doc_id", *keep]
    kinds = [f for f in rows.schema if f.name in names]
    long, binary = T.LongType(), T.BinaryType()

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text", 1 << 20):
            tokens, made = _vectors(block.column("text"))
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in names), pa.array(tokens), block.column("order"), _pack(made)], [*names, "tokens", "order", "vector"])

    stored = written(rows.mapInArrow(vectors, T.StructType([*kinds]).add("tokens", long).add("order", long).add("vector", binary)))
    model = docs.sparkSession.sparkContext.broadcast(fit_topics(stored.select("order", "vector"), topics))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = text_bytes(batch.column("vector"))
            own = [np.argmax(_unpack(packed[k : k + 4096]) @ model.value.T, axis=1) for k in range(0, len(packed), 4096)]
            topic = np.concatenate([np.zeros(0, np.int64), *own]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), batch.column("tokens"), pa.array(topic)], [*names, "tokens", "topic"])

    return stored.drop("order").mapInArrow(assign, T.StructType([*kinds]).add("tokens", long).add("topic", T.IntegerType()))


def unit_hash(column, seed: int) -> F.Column:
    """A number in [0, 1) that depends on the value alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(column)), 11) / F.lit(float(1 << 53))


def _share(x: np.ndarray, power: float) -> np.ndarray:
    x = np.where(x > 0, np.maximum(x, 1e-300) ** power, 0)
    return x / x.sum() if x.sum() else x


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    languages: tuple[str, ...] = LANGUAGES,
    topics: int = TOPICS,
    flatten: float = FLATTEN,
    keep: float = KEEP,
    seed: int = 17,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, source, lang, topic, tokens, weight, probability, sampled and residual of every row, and the columns ``carry``.

    weight is the raked factor of the document's cell: weighted tokens have the target shares,
    which are in proportion to the tokens of a source, language or topic to the power ``flatten``.
    probability is min(1, scale x weight), with the scale that keeps the share ``keep`` of all
    tokens in expectation. sampled compares it with a hash of the id, so rows that repeat an id
    are sampled together. Texts without words weigh nothing and keep the weight of their
    cell; a cell without any tokens has weight 1. Null sources and languages are a source and a
    language of their own; languages beyond ``languages`` are one. Other columns are not read.
    residual, the same in every row, is how far the farthest language or topic ends from its target share: targets
    that can't all be met (a topic of one document, say) leave one when the sweeps end. Sources are met exactly.
    """
    # Languages beyond those listed are one, and so is none.
    n_lang, width = len(languages) + 2, (len(languages) + 2) * topics
    code = F.when(F.col(lang_col).isNull(), len(languages) + 1).otherwise(len(languages))
    for k, name in enumerate(languages):
        code = F.when(F.col(lang_col) == name, k).otherwise(code)
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.col(source_col).cast("string"), F.lit(NO_SOURCE)).alias("source"), F.col(lang_col).cast("string").alias("lang"), code.cast("int").alias("language"), *carry)
    rows = topic_features(base, id_col="doc_id", text_col="text", keep=("source", "lang", "language", *carry), topics=topics)

    cell = F.col("language") * topics + F.col("topic")
    own = F.array(*[F.sum(F.when(cell == k, F.col("tokens")).otherwise(0)).cast("double") for k in range(width)])
    sources = rows.groupBy("source").agg(own.alias("cells"))
    sources = checkpointed(sources.withColumn("total", F.aggregate("cells", F.lit(0.0), lambda a, x: a + x)))

    def gathered(b: np.ndarray | None, c: np.ndarray | None) -> np.ndarray:
        """Tokens of each (language, topic) over all sources, each source brought to its target under the
        factors b and c (plain tokens without them). Numbers travel as data: the plan is the same in every sweep."""
        both = None if b is None else np.outer(b, c).ravel()

        def part(cells: np.ndarray, total: np.ndarray) -> np.ndarray:
            if both is None:
                return cells.sum(axis=0)
            good = total > 0
            return cells[good].T @ (total[good] ** flatten / powers / (cells[good] @ both))

        def matrices(batch) -> tuple[np.ndarray, np.ndarray]:
            cells = pa.array(batch.column("cells").to_pylist(), pa.list_(pa.float64())).flatten()
            return cells.to_numpy(zero_copy_only=False).reshape(-1, width), batch.column("total").to_numpy()

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = sum((part(*matrices(batch)) for batch in batches), np.zeros(width))
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, width], pa.int32()), pa.array(out))], ["part"])

        if few is not None:
            return part(*matrices(few)).reshape(n_lang, topics)
        got = sources.mapInArrow(add, "part array<double>").agg(*[F.sum(F.col("part")[k]) for k in range(width)]).first()
        return np.array([x or 0.0 for x in got]).reshape(n_lang, topics)

    few = sources.select("cells", "total").limit(LOCAL_SOURCES + 1).toArrow()
    few = few if few.num_rows <= LOCAL_SOURCES else None
    plain = gathered(None, None)
    total = plain.sum()
    by_lang, by_topic = _share(plain.sum(axis=1), flatten), _share(plain.sum(axis=0), flatten)
    powers = sources.agg(F.sum(F.when(F.col("total") > 0, F.pow("total", F.lit(flatten))))).first()[0] or 1.0
    b, c = np.ones(n_lang), np.ones(topics)
    for sweep in range(SWEEPS + 1):
        now = gathered(b, c)
        mixed = now * np.outer(b, c)
        residual = float(max(np.abs(mixed.sum(axis=1) - by_lang).max(), np.abs(mixed.sum(axis=0) - by_topic).max()))
        if residual < CLOSE or sweep == SWEEPS:
            break
        rest = (now * c).sum(axis=1)
        b = np.where(rest > 0, by_lang / np.maximum(rest, 1e-300), 1.0)
        rest = (now * b[:, None]).sum(axis=0)
        c = np.where(rest > 0, by_topic / np.maximum(rest, 1e-300), 1.0)

    def source_factor() -> F.Column:
        """What brings each source to its target under the final language and topic factors."""
        target = F.pow("total", F.lit(flatten)) / F.lit(float(powers))
        inner = F.zip_with("cells", F.array(*[F.lit(float(x)) for x in np.outer(b, c).ravel()]), lambda x, y: x * y)
        return F.when(F.col("total") > 0, target / F.aggregate(inner, F.lit(0.0), lambda a, x: a + x)).otherwise(0.0)

    # Weights are relative to the plain mix: 1 leaves a cell's share as it is.
    both = F.array(*[F.lit(float(x)) for x in np.outer(b, c).ravel()])
    factors = checkpointed(sources.select("source", "cells", F.transform(both, lambda y: F.when(F.col("total") > 0, F.round(y * source_factor() * F.lit(float(total or 1)), 9)).otherwise(1.0)).alias("factors")))
    scale = _scale(factors, keep, total)
    weight = F.col("factors")[cell]
    chance = F.least(F.lit(1.0), weight * F.lit(scale))
    factors = factors.select("source", "factors")
    out = rows.join(factors if few is None else F.broadcast(factors), "source")
    out = out.withColumns({"weight": weight, "probability": F.round(chance, 9)})
    sampled = (unit_hash("doc_id", seed) < F.col("probability")).alias("sampled")
    source = F.when(F.col("source") != NO_SOURCE, F.col("source")).alias("source")
    return out.select("doc_id", source, "lang", "topic", "tokens", "weight", "probability", sampled, F.lit(round(residual, 9)).alias("residual"), *carry)


def _scale(factors: DataFrame, keep: float, total: float) -> float:
    """The scale under which min(1, scale x factor) keeps the share ``keep`` of the tokens, from a histogram of
    the factors' logarithms (a fixed number of bins)."""
    pairs = factors.select(F.explode(F.arrays_zip("cells", "factors")).alias("x")).where("x.cells > 0 and x.factors > 0")
    log_bin = F.round(F.log("x.factors") * (BINS / 40)).cast("int")
    found = pairs.groupBy(F.greatest(F.least(log_bin, F.lit(BINS)), F.lit(-BINS)).alias("bin")).agg(F.sum("x.cells").alias("n")).collect()
    if not found:
        return 1.0
    factor = np.exp(np.array([r["bin"] for r in found]) / (BINS / 40))
    tokens = np.array([r["n"] for r in found])
    low, high = 0.0, float(1 / factor.min())
    for _ in range(100):
        middle = (low + high) / 2
        if (tokens * np.minimum(1, middle * factor)).sum() < keep * total:
            low = middle
        else:
            high = middle
    return high


def sample_mix(docs: DataFrame, *, id_col: str = "doc_id", **how) -> DataFrame:
    """``docs`` without the documents that the mix doesn't sample; all columns kept, whatever their names. Each row goes by the probability
    of its own cell; rows that repeat an id (or have none) share their hash alone. An empty table gives an empty result."""
    row = "_row"
    while row.lower() in {c.lower() for c in docs.columns}:
        row += "_"
    whole = docs.withColumn(row, F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    return mix(whole, id_col=id_col, carry=(row,), **how).where("sampled").select(*[F.col(f"{row}.`{c}`").alias(c) for c in docs.columns])
