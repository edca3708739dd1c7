"""Language identification by Bayesian evidence fusion.

Four kinds of evidence meet in one posterior per document:

* text: letter-trigram models of each language, counted over every document that declares
  one, against a uniform model of no language (``und``)
* declared markup language: how often each declaration stands on texts of each language
* address suffix: likewise for a language hint in the address (top-level domain, or a path
  segment that names a language)
* host prior: how often a host's texts are of each language, smoothed towards its parent
  domain and that towards the whole corpus

All tables come from grouped aggregates. What the driver gets is bounded by the number of
languages: the trigram counts (languages x 32,768) and two small confusion tables. Host and
domain tables stay distributed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, joined, text_blocks, written

LANGUAGES = ("en", "fr", "de", "es")
#: Class of texts in none of the languages.
NONE = "und"
#: Cells of a trigram model, as a power of two.
BITS = 15
#: Trigrams overlap, so that a text's log-likelihood counts by this share.
TEXT_WEIGHT = 0.3
#: Documents that the parent's prior counts for at a host, and the corpus prior at a domain.
PRIOR_DOCS = 20.0
#: Prior probability of no language.
NONE_PRIOR = 1e-3
#: Most hosts whose priors are broadcast.
FEW_HOSTS = 50_000
#: Least posterior of an accepted language.
LEAST_POSTERIOR = 0.5


def _letters() -> np.ndarray:
    """Bytes as they are counted: lower case, all but letters and non-ASCII bytes as one space."""
    table = np.full(256, 32, np.int32)
    for b in range(256):
        if chr(b).isalpha() and b < 128:
            table[b] = ord(chr(b).lower())
        elif b >= 128:
            table[b] = b
    return table


def _trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the trigrams that hold a letter, and the row of each."""
    data, starts = joined(column)
    letters = _letters()[data]
    if len(letters) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (letters[:-2] * np.int32(31 * 31) + letters[1:-1] * np.int32(1009) + letters[2:] * np.int32(40503)) & np.int32((1 << BITS) - 1)
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    good = (row[:-2] == row[2:]) & ((letters[:-2] != 32) | (letters[1:-1] != 32) | (letters[2:] != 32)) & (letters[1:-1] != 32)
    return code[good], row[:-2][good]


def _code(column, languages) -> F.Column:
    """Index of the language that a tag names (``fr``, ``fr-CA``), the number of languages for another tag, one more for none."""
    tag = F.lower(F.trim(F.coalesce(column, F.lit(""))))
    out = F.when(tag == "", len(languages) + 1).otherwise(len(languages))
    for k, name in enumerate(languages):
        out = F.when(F.regexp_extract(tag, "^[a-z]+", 0) == name, k).otherwise(out)
    return out.cast("int")


def address_hint(url) -> F.Column:
    """The top-level domain, or else the first path segment of two letters, of an address; null without one."""
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://([^/?#:]*)", 1)
    top = F.regexp_extract(host, r"\.([a-z]{2})$", 1)
    segment = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://[^/?#]*/([a-z]{2})(?:[/?#]|$)", 1)
    return F.when(top != "", top).when(segment != "", segment)


def page_host(url) -> F.Column:
    """The host of an address, lower case, without user and port; empty without one."""
    return F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)


def identify(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    declared_col: str = "lang",
    host_col: str = "source",
    url_col: str | None = None,
    languages: tuple[str, ...] = LANGUAGES,
    whole_rows: bool = False,
) -> DataFrame:
    """doc_id, language, posterior, accepted and text_language of every row, and its columns as the struct ``row`` if ``whole_rows``.

    Null and empty texts, and texts without a letter, are of no language (``und``), with
    posterior 1 and not accepted: metadata alone never accept a document. A null host
    is a host of its own, and undeclared languages and absent addresses say nothing. Ties go to
    the language listed first. Repeated rows count each time. An empty table gives an empty
    result. Other columns are not read.
    """
    n = len(languages)
    context = docs.sparkSession.sparkContext
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        _code(F.col(declared_col), languages).alias("declared"),
        _code(address_hint(F.col(url_col)) if url_col else F.lit(None).cast("string"), languages).alias("hint"),
        # A character that no host has stands for an absent one, apart from an empty one.
        F.coalesce(F.col(host_col).cast("string"), F.lit("\0")).alias("host"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole_rows else []),
    )
    kept = ["row"] if whole_rows else []

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, 1 << BITS), np.int64)
        for block in text_blocks(batches, "text"):
            cell, row = _trigrams(block.column("text"))
            language = block.column("declared").to_numpy(zero_copy_only=False)[row]
            total += np.bincount((language.astype(np.int64) << BITS) + cell, minlength=total.size).reshape(total.shape)
        language, cell = np.nonzero(total)
        if len(cell):
            yield pa.RecordBatch.from_arrays([pa.array(language.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(total[language, cell])], ["language", "cell", "n"])

    counted = rows.where(F.col("declared") < n).select("text", "declared").mapInArrow(count, "language int, cell int, n long").groupBy("language", "cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((n, 1 << BITS))
    counts[counted["language"].to_numpy(), counted["cell"].to_numpy()] = counted["n"].to_numpy()
    # Log-likelihood ratios to no language, whose trigrams are uniform.
    ratio = np.log((counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)) + BITS * np.log(2)
    model = context.broadcast(np.ascontiguousarray(ratio.T.astype(np.float32)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text", 2 << 20):
            cell, row = _trigrams(block.column("text"))
            sums = np.zeros((block.num_rows, n))
            if len(row):
                heads = np.flatnonzero(np.diff(row, prepend=-1))
                sums[row[heads]] = np.add.reduceat(model.value[cell], heads, axis=0, dtype=np.float64)
            sums = np.round(sums * TEXT_WEIGHT, 3)
            made = pa.ListArray.from_arrays(pa.array(np.arange(block.num_rows + 1, dtype=np.int32) * n), pa.array(sums.ravel()))
            letters = np.bincount(row, minlength=block.num_rows)
            names = ["doc_id", "declared", "hint", "host", *kept]
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in names), pa.array(letters), made], [*names, "grams", "text_score"])

    kinds = T.StructType([f for f in rows.schema if f.name != "text"]).add("grams", "long").add("text_score", T.ArrayType(T.DoubleType()))
    scored = rows.mapInArrow(score, kinds)
    first = F.expr(f"if(array_max(text_score) <= 0 or grams = 0, {n}, array_position(text_score, array_max(text_score)) - 1)")
    settle = written if whole_rows else checkpointed
    scored = settle(scored.withColumn("first", first.cast("int")).withColumn("domain", F.regexp_replace("host", r"^[^.]*\.(?=.*\.)", "")))

    def evidence(column: str) -> F.Column:
        """log P(column | language) for each language, over the documents whose text decides; by column value."""
        table = np.ones((n + 2, n))
        for r in scored.where(F.col("first") < n).groupBy(column, "first").count().collect():
            table[r[column], r["first"]] += r["count"]
        table = np.log(table / table.sum(axis=0))
        table[n + 1] = 0  # nothing was declared
        rows = F.array(*[F.array(*[F.lit(float(round(x, 6))) for x in row]) for row in table])
        return rows[F.col(column)]

    of_language = [F.count_if(F.col("first") == k).cast("double").alias(f"n{k}") for k in range(n)]
    counts_of = F.array(*[f"n{k}" for k in range(n)])
    corpus = scored.agg(*of_language).first()
    total = sum(corpus)
    base = F.array(*[F.lit((x + 1.0) / (total + n)) for x in corpus])

    def smoothed(own, parent) -> F.Column:
        size = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(own, parent, lambda x, p: (x + PRIOR_DOCS * p) / (size + PRIOR_DOCS))

    hosts = scored.groupBy("host", "domain").agg(*of_language)
    domains = hosts.groupBy("domain").agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(n)]).select("domain", smoothed(counts_of, base).alias("parent"))
    # Written, so that a hot host can be split in the join below.
    priors = checkpointed(hosts.join(domains, "domain").select("host", smoothed(counts_of, F.col("parent")).alias("prior")))
    # Few hosts are sent to the rows (their number bounds the size: names are short), so that no row moves.
    few = priors.limit(FEW_HOSTS + 1).count() <= FEW_HOSTS
    fused = scored.join(F.broadcast(priors) if few else priors, "host").withColumns({"by_declared": evidence("declared"), "by_hint": evidence("hint")})
    log_joint = F.concat(
        F.transform("text_score", lambda x, i: x + F.log(F.col("prior")[i]) + F.col("by_declared")[i] + F.col("by_hint")[i] + F.lit(float(np.log(1 - NONE_PRIOR)))),
        F.array(F.lit(float(np.log(NONE_PRIOR)))),
    )
    fused = fused.withColumn("joint", log_joint).withColumn("most", F.array_max("joint"))
    best = F.when(F.col("grams") == 0, n).otherwise(F.array_position("joint", F.col("most")) - 1)
    posterior = F.when(F.col("grams") == 0, 1.0).otherwise(1 / F.aggregate("joint", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("most"))))
    names = F.array(*[F.lit(x) for x in (*languages, NONE)])
    return fused.withColumns({"best": best.cast("int"), "p": posterior}).select(
        "doc_id",
        names[F.col("best")].alias("language"),
        F.round("p", 6).alias("posterior"),
        ((F.col("best") < n) & (F.col("p") >= LEAST_POSTERIOR)).alias("accepted"),
        names[F.col("first")].alias("text_language"),
        *kept,
    )


def keep_identified(docs: DataFrame, *, id_col: str = "doc_id", **how) -> DataFrame:
    """``docs`` without the documents whose language is not accepted; all columns kept, whatever their names. Each row goes by its own
    text, whether its id is null or repeated; null and empty texts go. An empty table gives an empty result."""
    found = identify(docs, id_col=id_col, whole_rows=True, **how).where("accepted")
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
