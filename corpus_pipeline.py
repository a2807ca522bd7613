"""Documents to token ids: language ID, exact dedup, near-dedup, benchmark decontamination, encoding.

Each stage takes all rows its predecessor kept, with the columns of `documents`; the last returns token digests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import decontaminate, exact, langid, queries, simhash
from plumbline.llm.common import Scratch, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a language; the text model is fitted on a bounded sample of the stage's own labelled rows."""
    return langid.keep_identified(docs, langid.fit(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact.dedup(docs, keep="largest")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-equal fingerprints the row with the least doc_id."""
    return simhash.dedup(docs, shingle=3, radius=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark passage beyond the coverage limit; the others stay as they are."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return queries.op5_bpe_digest(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: No SQL: fingerprints, their components and byte-pair merges can't be expressed in it. The tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each keeps is written before the next reads it, and dropped once that is written too.

    An empty `documents` gives no rows. Columns may have any names: the stages carry them as one struct.
    """
    scratch = Scratch(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name, collect=True)
        scratch.drop(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
