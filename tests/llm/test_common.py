"""What the operators share: batches between JVM and Python, and the text of a row in them."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import bpe, decontaminate
from plumbline.llm.common import arrow_map, texts_of, with_text
from plumbline.llm.queries import VOCABULARY

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def batch_sizes(df):
    def of_batches(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    return [r.n for r in arrow_map(df, of_batches, "n long").collect()]


@pytest.fixture
def unset(spark):
    held = spark.conf.get(LIMIT, None)
    spark.conf.unset(LIMIT)
    yield spark
    spark.conf.unset(LIMIT) if held is None else spark.conf.set(LIMIT, held)


def test_long_texts_come_in_several_batches(unset):
    texts = unset.range(0, 12, 1, 1).select(F.repeat(F.lit("abcdefgh"), 1 << 18).alias("text"))  # 2 MB each
    sizes = batch_sizes(texts)
    assert sum(sizes) == 12 and max(sizes) <= 5


def test_limit_of_the_session_stays(unset):
    unset.conf.set(LIMIT, "64m")
    texts = unset.range(0, 12, 1, 1).select(F.repeat(F.lit("abcdefgh"), 1 << 18).alias("text"))
    assert batch_sizes(texts) == [12] and unset.conf.get(LIMIT) in ("64m", f"{64 << 20}b")


def test_a_string_is_sent_once_and_other_types_as_text(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert with_text(docs, "text").columns == ["row"]
    assert with_text(docs, "doc_id").columns == ["row", "text"]
    clashing = docs.withColumn("row", F.lit(1))
    batch = with_text(clashing, "text").toArrow().combine_chunks().to_batches()[0]
    assert texts_of(batch, "text").to_pylist() == ["a b", ""]
    assert texts_of(batch.slice(1), "text").to_pylist() == [""]


def test_operators_on_numbers_as_text(spark):
    docs = spark.createDataFrame([(1, 1234), (2, None)], "doc_id long, text long")
    strings = docs.withColumn("text", F.col("text").cast("string"))
    ids = [{r.row.doc_id: bytes(r.ids) for r in bpe.encode(d, VOCABULARY).collect()} for d in (docs, strings)]
    assert ids[0] == ids[1] and ids[0][2] == b"" and ids[0][1]
    benchmark = spark.createDataFrame([("i", "1234"), ("j", "77")], "item_id string, text string")
    for one_block in (True, False):
        found = decontaminate.contamination(docs, benchmark, **({} if one_block else {"block_bytes": 1}))
        assert {r.row.doc_id: (r.row.text, r.n_hit, list(r["items"]), r.contaminated) for r in found.collect()} == {1: (1234, 1, ["i"], True), 2: (None, 0, [], False)}
