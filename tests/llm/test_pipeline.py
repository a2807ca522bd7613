"""The pipeline against a brute-force version of its later stages, and the registered queries at the smallest scale."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import corpus_pipeline
from plumbline.llm import queries, secrets
from plumbline.llm.common import table
from tests.llm.edges import sha
from tests.llm.test_operators import brute_fingerprint, brute_hits

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = entry_point.queries()
    assert "pipeline" in names and [n for n in range(1, 14) if not any(re.match(rf"op{n}_", q) for q in names)] == []


def test_pipeline(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = table(spark, SF, "documents")
    said = stages["language_id"](spark, docs, SF)
    assert said.columns == docs.columns
    rows = {r.doc_id: r.text or "" for r in said.collect()}
    assert all(r.doc_id in rows for r in docs.collect() if sum(c.isalpha() for c in r.text or "") >= 20)
    same = defaultdict(list)
    for i, t in rows.items():
        same[t].append(i)
    rows = {max(ids): t for t, ids in same.items()}
    fps = {i: brute_fingerprint(t, 3) for i, t in rows.items()}
    root = {i: i for i in rows}
    for _ in rows:
        new = {i: min(root[j] for j in rows if (fps[i] ^ fps[j]).bit_count() <= 3) for i in rows}
        if new == root:
            break
        root = new
    rows = {i: t for i, t in rows.items() if root[i] == i}
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    rows = {i: t for i, t in rows.items() if not brute_hits(t, items)[3]}
    library, expected = Tokenizer.from_file(queries.VOCABULARY), Counter()
    for i, t in rows.items():
        ids = library.encode(t, add_special_tokens=False).ids
        expected[i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(t)] += 1
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == expected


def test_stages_with_clashing_columns_nulls_and_no_rows(spark):
    names = ("gone_id", "gone_digest", "own_id", "own_digest", "row", "digest", "fp", "key", "id", "body", "found", "host", "tid")
    docs = table(spark, SF, "documents").limit(40)
    odd = docs.unionByName(spark.createDataFrame([(None, None, None, None, None), (None, None, None, None, None), (7, "", "en", "s", 0)], docs.schema))
    for some in (odd, docs.limit(0)):
        clashing = some.select("*", *[F.col("doc_id").alias(n) for n in names])
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, clashing, SF)
            assert out.columns == clashing.columns and Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in stage(spark, some, SF).collect())


@pytest.mark.parametrize("name", ["op1_chat_formatting", "op4_language_id", "op9_token_counts", "op10_line_dedup"])
def test_queries_return_a_row_for_every_input(spark, name):
    source = {"op1_chat_formatting": ("conversations", "conv_id"), "op4_language_id": ("pages", "page_id")}.get(name, ("documents", "doc_id"))
    out = entry_point.queries()[name](spark, SF)
    expected = table(spark, SF, source[0]).select(source[1]).distinct().count() + (name == "op1_chat_formatting")
    assert out.select(source[1]).distinct().count() == out.count() == expected


def test_secret_scan_runs_against_a_ledger(spark, monkeypatch):
    docs, held, read = table(spark, SF, "documents"), [], secrets.read_ledger

    def spied(session, path):
        ledger = read(session, path)
        held.append(0 if ledger is None else ledger.select("blob").distinct().count())
        return ledger

    monkeypatch.setattr(secrets, "read_ledger", spied)
    out = Counter((r.doc_id, r.spans) for r in entry_point.queries()["op8_secret_scan"](spark, SF).collect())
    contents = len({r.text or "" for r in docs.collect()})
    assert held[0] == 0 and 0 < held[-1] < contents
    whole_scan = secrets.scan(docs).select("doc_id", secrets.joined(F.col("findings")))
    assert out == Counter(map(tuple, whole_scan.collect()))


def test_language_agrees_with_markup(spark):
    out = {r.page_id: r.language for r in entry_point.queries()["op4_language_id"](spark, SF).collect()}
    declared = {r.page_id: re.search('lang="([a-z]+)"', r.html)[1] for r in table(spark, SF, "pages").collect() if 'lang="' in (r.html or "")}
    assert sum(out[i] == lang for i, lang in declared.items()) >= 0.95 * len(declared)
