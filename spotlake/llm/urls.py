"""URL filters: allow and block rules first, then a character language-model ratio.

Two variable-order Markov models (orders 0 to 3 over 32 character classes, each order
smoothed towards the next lower one by Witten-Bell weights) are counted over every URL that
a rule accepts or rejects. A URL that no rule fits is judged by the difference of its two
log-likelihoods divided by its length, against a threshold calibrated on held-out URLs.

What reaches the driver is bounded by the model's shape, whatever the corpus: at most
2 x 2 x 32**4 counts and 2 x 4,096 histogram bins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_blocks, text_bytes

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path) of each rule.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Highest order of the models and number of character classes (letters, digits, dot, slash, hyphen, others; 0 pads the start).
ORDER, CLASSES = 3, 32
#: One labelled URL in so many is held out to calibrate the threshold.
FOLDS = 5
#: Bins of the calibration histogram over scores from -SPAN to SPAN.
BINS, SPAN = 4096, 8.0


def host_and_path(url) -> tuple[F.Column, F.Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from
    there up to ``?``, ``#`` or the end. Both are empty for null and without ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.contains(url, F.lit("://")), F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def fitting_rule(host, path, rules=RULES) -> tuple[F.Column, F.Column]:
    """The longest rule that fits (like ``net/``) and its verdict; null without one."""
    rule = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the last one asks first
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _classes() -> np.ndarray:
    table = np.full(256, 31, np.int64)
    for i, c in enumerate(LOWER):
        table[ord(c)] = table[ord(c.upper())] = i + 1
    table[ord("0") : ord("9") + 1] = 27
    table[ord(".")], table[ord("/")], table[ord("-")] = 28, 29, 30
    return table


def _grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code of each character with its ORDER characters of context, and where each row starts."""
    rows = text_bytes(column)
    padded = np.frombuffer(b"".join(b"\0" * ORDER + x for x in rows), np.uint8)
    starts = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(x) for x in rows], out=starts[1:])
    real = np.ones(len(padded), bool)
    for k in range(ORDER):
        real[starts[:-1] + ORDER * np.arange(len(rows)) + k] = False
    classes = _classes()[padded]
    classes[~real] = 0
    code = classes.copy()
    for k in range(1, ORDER + 1):
        code[k:] += classes[:-k] << (5 * k)
    return code[real], starts


def _log_model(counts: np.ndarray) -> np.ndarray:
    """log P(character | context) for each code, from its counts; Witten-Bell from order 0 up."""
    prob = np.full(CLASSES, 1 / CLASSES)
    for order in range(ORDER + 1):
        n = counts.reshape(-1, CLASSES ** (order + 1)).sum(axis=0).reshape(-1, CLASSES)
        seen, total = (n > 0).sum(axis=1, keepdims=True), n.sum(axis=1, keepdims=True)
        below = np.tile(prob.reshape(-1, CLASSES), (CLASSES if order else 1, 1))
        prob = (n + np.maximum(seen, 1) * below) / (total + np.maximum(seen, 1))
    return np.log(prob).ravel()


def _ratio(counts: np.ndarray) -> np.ndarray:
    """counts: [label, code]; label 1 is accepted."""
    return (_log_model(counts[1]) - _log_model(counts[0])).astype(np.float32)


def _scored(rows: DataFrame, ratio: np.ndarray) -> DataFrame:
    """``rows`` with score: the mean log-likelihood difference over the characters of ``place``; 0 for empty ones."""
    table = rows.sparkSession.sparkContext.broadcast(ratio)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "place"):
            code, starts = _grams(block.column("place"))
            sums = np.concatenate([[0.0], np.cumsum(table.value[code], dtype=np.float64)])
            n = np.diff(starts)
            # Rounded so that equal addresses score the same in any block.
            mean = np.round((sums[starts[1:]] - sums[starts[:-1]]) / np.maximum(n, 1), 6)
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(mean)], [*block.schema.names, "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(score, f"{schema}, score double")


def filter_urls(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score, threshold for every row.

    A null or unusable URL has an empty host and path, fits no rule and scores 0. Without URLs
    of either label the models are equal and all scores are 0, at the threshold: allowed. Repeated
    rows count each time in the models. Other columns are not read.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "ruled": verdict, "place": F.concat("host", "path")})
    labelled = rows.where(F.col("ruled").isNotNull()).select((F.col("ruled") == "allow").cast("int").alias("label"), (F.pmod(F.xxhash64("place"), F.lit(FOLDS)) == 0).cast("int").alias("held"), "place")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, CLASSES ** (ORDER + 1)), np.int64)
        for block in text_blocks(batches, "place"):
            code, starts = _grams(block.column("place"))
            part = 2 * block.column("label").to_numpy(zero_copy_only=False) + block.column("held").to_numpy(zero_copy_only=False)
            part = np.repeat(part.astype(np.int64), np.diff(starts))
            total += np.bincount(part * total.shape[1] + code, minlength=total.size).reshape(total.shape)
        part, code = np.nonzero(total)
        if len(part):
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(code.astype(np.int32)), pa.array(total[part, code])], ["part", "code", "n"])

    counted = labelled.mapInArrow(count, "part int, code int, n long").groupBy("part", "code").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((2, 2, CLASSES ** (ORDER + 1)))
    part = counted["part"].to_numpy()
    counts[part // 2, part % 2, counted["code"].to_numpy()] = counted["n"].to_numpy()

    held = _scored(labelled.where("held = 1"), _ratio(counts[:, 0]))
    place = F.least(F.greatest(F.floor((F.col("score") + SPAN) * (BINS / (2 * SPAN))), F.lit(0)), F.lit(BINS - 1))
    bins = np.zeros((2, BINS))
    for r in held.groupBy("label", place.cast("int").alias("bin")).count().collect():
        bins[r["label"], r["bin"]] = r["count"]
    threshold = 0.0
    if bins.sum(axis=1).all():
        right = bins[0].cumsum() / bins[0].sum() + 1 - bins[1].cumsum() / bins[1].sum()  # if the threshold is each bin's end
        best = np.flatnonzero(right >= right.max() - 1e-12)
        best = best[np.argmin(np.abs(best - BINS / 2))] if len(best) else BINS // 2 - 1
        threshold = float((best + 1) * (2 * SPAN / BINS) - SPAN)
    out = _scored(rows, _ratio(counts.sum(axis=1))).withColumn("threshold", F.lit(threshold))
    judged = F.coalesce("ruled", F.when(F.col("score") >= F.col("threshold"), "allow").otherwise("block"))
    return out.select("page_id", "host", "path", "rule", judged.alias("verdict"), "score", "threshold")
