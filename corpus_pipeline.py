"""A corpus from ``documents``: identified, deduplicated, mixed and encoded.

``STAGES`` in order; each stage gets what the one before wrote and returns the columns of
documents, the last one the encoded corpus. Rows are decided one by one: null or repeated ids don't
join them, null texts count as empty (which no language accepts), further columns are kept whatever their names, and an
empty table goes through as an empty one.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from spotlake.llm.bpe import bpe_encode
from spotlake.llm.common import checkpoint_folder, remove
from spotlake.llm.exact_dedup import drop_copies
from spotlake.llm.langid import keep_identified
from spotlake.llm.mixing import sample_mix
from spotlake.llm.queries import RANKS, digests
from spotlake.llm.simhash import drop_near_copies


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of an accepted language."""
    return keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_copies(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights."""
    return sample_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids (the tokens), and the digests of the ids and of what they decode to."""
    path = public_tokenizers.path(RANKS)
    return digests(bpe_encode(docs, path, public_tokenizers.PATTERN, keep=("lang", "source"), decode=True), "lang", "source", "ids")


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_duplicates),
    ("mixing to target weights", mix_sources),
    ("byte-level BPE", encode),
]

#: Language models, Hamming components and merges have no form in SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each stage returns is written beside the checkpoints and read again, and deleted
    when the next stage has been written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder, before = checkpoint_folder(spark), None
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/corpus-{uuid.uuid4().hex}-{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
