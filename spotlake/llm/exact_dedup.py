"""Exact dedup by distributed MSD radix partitioning.

Documents are split by successive bytes of their normalised text. A round takes the next
digit (a run of bytes; its width grows eightfold a round, so that rounds are logarithmic in
the longest text), counts the documents of each (group, digit) with map-side partial
aggregates, and closes the groups that hold one document or whose texts have ended. Only
documents of open groups go on. Equality rests on the bytes themselves; no digest takes part.

A group is only ever counted (never gathered), and the join that hands each document its
group is one row per group on one side, so a hot group can be split between tasks. A document's
columns travel with its text, so that no decision has to be joined back to the documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, normal_space, written

#: Bytes of the first digit, and how much wider each further digit is.
FIRST_BYTES, WIDER = 256, 8


def _closed_groups(rows: DataFrame, first_bytes: int) -> DataFrame:
    """``rows`` (id, text and others) with grp, n and first: a number of each group of equal texts, its rows and its
    smallest id that isn't null."""
    done, at, width = [], 0, first_bytes
    rows = rows.withColumn("grp", F.lit(0).cast("long"))
    while True:
        rest = F.substring(normal_space(F.col("text")).cast("binary"), at + 1, width + 1)
        rows = rows.withColumn("_rest", rest).withColumns({"digit": F.substring("_rest", 1, width), "ended": F.length("_rest") <= width}).drop("_rest")
        groups = rows.groupBy("grp", "digit", "ended").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
        # Identifiers are drawn once and written, so that a lost task can't draw others.
        groups = checkpointed(groups.withColumn("next", F.monotonically_increasing_id()))
        # Written, so that texts are shuffled once a round; open documents alone go on.
        dealt = written(rows.join(groups, ["grp", "digit", "ended"]).drop("grp", "digit"))
        closed = F.col("ended") | (F.col("n") == 1)
        done.append(dealt.where(closed).withColumn("grp", F.concat_ws(".", F.lit(width), F.col("next"))).drop("next", "ended"))
        if groups.where(~closed).limit(1).count() == 0:
            return reduce(DataFrame.unionAll, done)
        rows = dealt.where(~closed).drop("n", "first", "ended").withColumnRenamed("next", "grp")
        at, width = at + width, width * WIDER


def msd_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", first_bytes: int = FIRST_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space has become one space;
    null counts as empty, and all empty texts are equal. The smallest id of a group stays.
    Rows that repeat an id and its text are copies of one document: each counts in
    ``group_size`` and each has ``kept`` true if the id stays. A null id is never the keeper
    unless all ids of the group are null. An empty table gives an empty result. Other columns
    of ``docs`` are not read. text_sha256 is output only and decides nothing.
    """
    found = _closed_groups(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), first_bytes)
    return found.select(F.col("id").alias("doc_id"), F.col("first").alias("keep_id"), F.col("n").alias("group_size"), F.col("id").eqNullSafe(F.col("first")).alias("kept"), F.sha2(normal_space(F.col("text")), 256).alias("text_sha256"))


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", first_bytes: int = FIRST_BYTES) -> DataFrame:
    """``docs`` with one row of each group of equal texts (null ones count as empty), all columns kept, whatever their names; an empty table stays empty: the row of the smallest id, whatever its place in
    the table; of rows that repeat that id, or of a group that has null ids alone, any one. Rows that share an id but not
    their text each count for themselves."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"))
    found = _closed_groups(rows, first_bytes)
    alone = found.where(F.col("n") == 1)
    # Of copies the candidates alone move once more: one row a group, unless its id is repeated.
    one = found.where((F.col("n") > 1) & F.col("id").eqNullSafe(F.col("first"))).dropDuplicates(["grp"])
    columns = [F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return alone.unionAll(one).select(*columns)
