"""CSV records found in blocks of a few bytes, against the csv module."""

from __future__ import annotations

import csv
import io
import random

import pytest

from plumbline.sources import files, records
from plumbline.sources.contracts import ContractError
from conftest import rows


@pytest.fixture()
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {name: spark.conf.get(name, None) for name in names}
    spark.conf.set(names[0], "64")
    spark.conf.set(names[1], "0")
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def written(path, table, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(table)
    path.write_text(out.getvalue(), encoding="utf-8", newline="")
    return str(path)


def some_table(n, seed):
    rng = random.Random(seed)
    parts = ["a", "b c", '"', '""', ",", "\n", "\n\n", "line\nbreak", '",\n"', "é", "x" * 90, " ", "5\" pipe", '\n"\n']
    return [["k", "first", "second column"]] + [[str(i)] + ["".join(rng.choices(parts, k=rng.randint(0, 4))) for _ in range(2)] for i in range(n)]


def known(table):
    return sorted(tuple(v or None for v in r) for r in table[1:])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_blocks_of_a_few_bytes(spark, tmp_path, small_blocks, end):
    table = some_table(150, len(end))
    path = written(tmp_path / "x.csv", table, end)
    df = files.read_raw(spark, path, split=True)
    assert df.columns == table[0]
    assert sorted(tuple(r) for r in df.collect()) == known(table)
    lines = spark.read.option("lineSep", "\n").text(path)
    assert lines.rdd.getNumPartitions() > 50


def test_values_without_quotes_may_hold_them(spark, tmp_path, small_blocks):
    (tmp_path / "x.csv").write_text('a,b\n5" pipe,"two\nlines"\n"x",3" rod\n\n"""",last', encoding="utf-8")
    out = files.read_raw(spark, str(tmp_path / "x.csv"), split=True)
    assert rows(out) == sorted([('5" pipe', "two\nlines"), ("x", '3" rod'), ('"', "last")])


def test_same_as_one_task_over_a_folder(spark, tmp_path, small_blocks):
    for i in range(3):
        written(tmp_path / f"{i}.csv", some_table(40, i))
    split, whole = (files.read_raw(spark, str(tmp_path), split=s) for s in (True, False))
    assert split.schema == whole.schema and rows(split) == rows(whole)


def test_empty_and_header_only(spark, tmp_path):
    (tmp_path / "x.csv").write_text("﻿a,b\n")
    out = files.read_raw(spark, str(tmp_path / "x.csv"), split=True)
    assert out.columns == ["a", "b"] and out.collect() == []
    (tmp_path / "y.csv").write_text("")
    with pytest.raises(ContractError):
        files.read_raw(spark, str(tmp_path / "y.csv"), split=True)


@pytest.mark.parametrize("text", ['a,b\n1,"open\n2,x\n', 'a,b\n1,"closed" wrong\n2,"x"\n', "a,A\n1,2\n"])
def test_faulty_files_are_refused_without_their_data(spark, tmp_path, text):
    (tmp_path / "x.csv").write_text(text)
    with pytest.raises(ContractError) as error:
        files.read_raw(spark, str(tmp_path / "x.csv"), split=True)
    assert "open" not in str(error.value) and "wrong" not in str(error.value)


def test_headers_have_to_agree(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    (tmp_path / "y.csv").write_text("b,a\n1,2\n")
    with pytest.raises(ContractError):
        files.read_raw(spark, str(tmp_path), split=True)


def test_a_record_of_too_many_lines_is_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "MOST_LINES", 3)
    (tmp_path / "x.csv").write_text('a,b\n1,"x\n\n\n\ny"\n')
    with pytest.raises(ContractError):
        files.read_raw(spark, str(tmp_path / "x.csv"), split=True)


def test_tasks_do_not_grow_with_the_file(spark, tmp_path, small_blocks):
    """Lines are dealt by block, so twice the file gives twice the blocks and none with more lines."""
    most = []
    for n in (100, 200):
        path = written(tmp_path / f"{n}.csv", [["a", "b"]] + [[str(i), "two\nlines"] for i in range(n)])
        held = records._lines(spark, path, lambda df, _: df)
        sizes = [r["count"] for r in held.groupBy("file", "block").count().collect()]
        most.append((len(sizes), max(sizes)))
    assert most[1][0] > 1.8 * most[0][0] and most[1][1] <= most[0][1] + 1
