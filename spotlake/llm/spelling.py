"""Spelling variants grouped by asymmetric q-chunks.

Words are counted where the documents lie (each task adds up its own), so only the vocabulary moves. Two words are near if one
inserted, deleted or replaced code point tells them apart. Of a pair, the longer word (of equally long ones, either) contributes two disjoint
chunks, its halves, and the other one its positional grams of the chunks' lengths. One edit leaves a chunk whole, so
that it is a gram of the other word within shift one: the first half at shift 0, the second at minus the difference of the lengths.
Other grams within shift one can't belong to a single edit and are left out. A chunk and its place are the key of an equi-join, and each pair
that meets is verified.

A common chunk ("tion" at the end of words of eight letters) would bring many words together. Where the pairs of a key are
more than ``FULL``, what the chunk leaves open is cut in two again: one of its halves must be whole too, so the key grows by that half. In the end one
code point is open, and a key has at most the alphabet's words. Every pair is found under just one key: the one whose open part
holds the first place where the words differ.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, text_blocks, text_bytes

#: Code points of a word, its occurrences, how many times more frequent a form is, and the divisor of the hash that makes a slip of the pen.
LEAST_LENGTH, LEAST_COUNT, RATIO, SLIPS = 7, 2, 10, 31
#: Pairs of a key above which it is cut again.
FULL = 1024
#: Distinct words that a task holds before it hands them on.
HELD = 200_000
LETTERS = "a-zÀ-ÿ"


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, slips: int | None = None) -> DataFrame:
    """word and n (its occurrences) of all words of ``least_length`` code points or more.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, of which only A-Z are lower-cased. With ``slips``, a run whose document's
    id and letters have a CRC-32 (of ``<id>:<run>``) that ``slips`` divides loses the code point at that number modulo its length,
    before its length is looked at. A null text has no words; a null id counts as an empty one.
    """
    runs = re.compile(f"[{LETTERS}]{{{least_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for block in text_blocks(batches, "text"):
            for i, text in zip(block.column("id").to_pylist(), text_bytes(block.column("text")), strict=True):
                start = zlib.crc32(b"%s:" % i.encode()) if slips else 0
                for run in runs.findall(text.lower().decode()):
                    if slips and not (h := zlib.crc32(run.encode(), start)) % slips:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < least_length:
                            continue
                    held[run] = held.get(run, 0) + 1
                if len(held) > HELD:
                    yield done()
                    held = {}
        yield done()

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _key(row: DataFrame) -> Column:
    """Of the word's length (that of the longer word of a pair), the open part, and all that lies before and behind it."""
    behind = F.expr("substring(word, hi - short + 1)")
    return F.xxhash64("size", "lo", "hi", F.expr("left(word, lo)"), behind)


def _chunks(words: DataFrame) -> DataFrame:
    """A row for each chunk and each aligned gram: word, n, gram (whether it is one), short (1 if its word is the shorter one), size, and the part
    [lo, hi) that is open."""
    roles = "array(struct(false as gram, 0 as short), struct(true as gram, 0 as short), struct(true as gram, 1 as short))"
    rows = words.select("word", "n", F.expr(f"inline({roles})")).withColumn("size", F.expr("length(word) + short"))
    half = "cast(ceil(size / 2) as int)"
    return rows.select("*", F.expr(f"inline(array(struct({half} as lo, size as hi), struct(0 as lo, {half} as hi)))"))


def near_pairs(words: DataFrame, *, full: int = FULL) -> DataFrame:
    """Each pair of ``words`` (word, n; distinct words) that one inserted, deleted or replaced code point tells apart, once:
    word, n, other and other_n."""
    rows, found = _chunks(words), None
    while True:
        rows = rows.withColumn("key", _key(rows))
        sizes = rows.groupBy("key").agg(F.count_if(~F.col("gram")).alias("c"), F.count_if("gram").alias("g"), F.max(F.expr("hi - lo")).alias("open"))
        hot = checkpointed(sizes.where((F.col("c") * F.col("g") > full) & (F.col("open") > 1)).select("key"))
        cold = rows.join(hot, "key", "left_anti")
        longer = cold.where("not gram").select("key", "size", "lo", "hi", F.col("word").alias("a"), F.col("n").alias("an"))
        other = cold.where("gram").select(F.col("key").alias("k"), "short", F.col("word").alias("b"), F.col("n").alias("bn"))
        # The words agree outside the open part, differ inside, and there by one edit.
        meet = (
            "key = k and length(b) = size - short and (short = 1 or a < b) and left(a, hi) <> left(b, hi)"
            " and levenshtein(substring(a, lo + 1, hi - lo), substring(b, lo + 1, hi - lo - short), 1) = 1"
            " and left(a, lo) = left(b, lo) and substring(a, hi + 1) = substring(b, hi - short + 1)"
        )
        pairs = longer.join(other, F.expr(meet)).select(F.col("a").alias("word"), F.col("an").alias("n"), F.col("b").alias("other"), F.col("bn").alias("other_n"))
        found = pairs if found is None else found.unionAll(pairs)
        if hot.isEmpty():
            return found
        # The first half of the open part is whole, or the second.
        middle = "cast(ceil((lo + hi) / 2) as int)"
        rows = checkpointed(rows.join(hot, "key", "left_semi").select("word", "n", "gram", "short", "size", F.expr(f"inline(array(struct({middle} as lo, hi as hi), struct(lo as lo, {middle} as hi)))")))


def _roots(forms: DataFrame) -> DataFrame:
    """word and root: the last word that the forms (word, form) lead to. A form is ``RATIO`` times more frequent than its word, so
    chains are short and have no cycles; each round doubles the steps."""
    links = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        further = links.select(F.col("word").alias("via"), F.col("root").alias("next"))
        after = checkpointed(links.join(further, links["root"] == further["via"], "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        links = after.drop("moved")
        if after.where("moved").isEmpty():
            return links


def spelling_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    slips: int | None = None,
    full: int = FULL,
) -> DataFrame:
    """A row for each word (see ``word_counts``) that occurs ``least_count`` times or more: word, form, root, n, n_near and form_n.

    n_near counts the words near it. form is the most frequent of them (of equally frequent ones the first by code points) if it is
    ``ratio`` times as frequent as the word or more, else null; form_n are its occurrences. root is the word that forms lead to in
    the end, or the word itself. Rows with one id, equal texts or null ones add their words; an empty table gives no rows; other columns aren't read.
    """
    words = checkpointed(word_counts(docs, id_col=id_col, text_col=text_col, least_length=least_length, slips=slips).where(F.col("n") >= least_count))
    pairs = near_pairs(words, full=full)
    both = F.expr("inline(array(struct(word as word, other as near, other_n as near_n), struct(other as word, word as near, n as near_n)))")
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("form")))
    near = pairs.select(both).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    chosen = -F.col("best.rank") >= ratio * F.col("n")
    found = checkpointed(
        words.join(near, "word", "left").select("word", F.when(chosen, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(chosen, -F.col("best.rank")).alias("form_n"))
    )
    roots = _roots(found.where(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
