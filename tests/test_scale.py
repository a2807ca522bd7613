"""Plans and partitioning: hot keys, pruning, no Python, nothing whole in one task."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from plumbline.operators import checks, keys, kpi, star
from workload import queries
from workload.queries import QUERIES
from conftest import rows

SF = "/root/testdata/sf0.001"


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture()
def conf(spark):
    changed = {}

    def put(name, value):
        changed.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield put
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_stay_in_the_engine(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(QUERIES["segment_kpi"](spark, SF))
    assert sorted(re.findall(r"ReadSchema: struct<(.*?)>", plan)) == [
        "c_custkey:bigint,c_mktsegment:string", "o_custkey:bigint,o_totalprice:double",
    ]
    assert "GreaterThanOrEqual(o_totalprice,2000.0)" in plan_of(QUERIES["recon_close"](spark, SF))


def test_samples_are_limited_before_the_shuffle(spark):
    plan = plan_of(QUERIES["score_masked_samples"](spark, SF))
    assert plan.count("+- WindowGroupLimit") == 4  # before and after the shuffle, per part and per rule


def test_dense_keys_over_many_partitions(spark, conf):
    conf("spark.sql.shuffle.partitions", "16")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    # A third of the rows are copies of one row, and some keys repeat with different attributes.
    df = spark.range(9000).selectExpr(
        "concat('K', if(id % 3 = 0, 0, id % 4000)) k", "if(id % 3 = 0, 0, id % 7) v"
    )
    numbered = keys.add_dense_key(df, "key", ["k", "v"])
    got = [tuple(r) for r in numbered.orderBy("key").collect()]
    assert got == [(i + 1, *r) for i, r in enumerate(sorted(tuple(r) for r in df.collect()))]
    # The copies were spread over several partitions.
    ranged = df.withColumn("t", F.rand(1)).repartitionByRange("k", "v", "t")
    assert ranged.where("k = 'K0'").select(F.spark_partition_id()).distinct().count() > 1


def test_hot_key_is_counted_before_the_foreign_key_join(spark):
    orders = spark.range(30000).selectExpr("if(id % 3 = 0, 1, id) k")
    parents = spark.range(15000).selectExpr("if(id % 3 = 0, 1, id) k")
    orphans = checks.orphan_rows(orders, "k", parents, "k")
    plan = plan_of(orphans)
    assert plan.index("LeftAnti") < plan.index("HashAggregate", plan.index("LeftAnti"))
    assert orphans.first()[0] == spark.range(15000, 30000).where("id % 3 <> 0").count()


def test_hot_customer_is_split_in_the_key_lookup(spark, conf):
    """Beyond broadcast size, adaptive execution splits the hot customer's partition."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    conf("spark.sql.shuffle.partitions", "16")
    orders = spark.range(0, 60000, 1, 8).selectExpr(
        "concat('O', id) order_id", "concat('C', if(id % 3 = 0, 1, id % 500)) customer_id",
        "date'2026-01-01' order_date", "cast(1 as decimal(18,2)) order_amount", "'USD' currency", "'RETAIL' category",
    )
    customers = spark.range(500).selectExpr("concat('C', id) customer_id", "id customer_key")
    categories = spark.createDataFrame([("RETAIL", 1)], "category_code string, category_key bigint")
    facts = star.order_facts(orders, customers, categories)
    assert facts.groupBy("customer_key").count().where("customer_key = 1").first()["count"] == 20080
    facts.write.format("noop").mode("overwrite").save()
    facts.collect()
    assert "skew=true" in facts._jdf.queryExecution().executedPlan().toString()


def test_facts_are_summed_per_customer_before_the_dimension_join(spark):
    fact = spark.range(3000).selectExpr("if(id % 3 = 0, 1, id % 50) customer_key", "cast(1 as decimal(18,2)) order_amount")
    customers = spark.range(50).selectExpr("id customer_key", "if(id < 25, 'A', 'B') segment")
    plan = plan_of(kpi.segment_kpi(fact, customers))
    scan_side = plan[plan.index("Join") :]
    assert scan_side.index("HashAggregate") < scan_side.index("Range")
    got = {r.segment: (r.customers_with_orders, r.order_count) for r in kpi.segment_kpi(fact, customers).collect()}
    assert sum(n for _, n in got.values()) == 3000 and sum(c for c, _ in got.values()) == 50


def test_recurrence_reads_the_exceptions_once(spark):
    df = QUERIES["score_recurrence"](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_no_task_of_the_round_trip_gets_all_texts(spark, conf, tmp_path, monkeypatch):
    """Twice the documents give twice the files and none with more rows; their records span blocks, and some tasks have no rows."""
    conf("spark.sql.files.maxPartitionBytes", "512")
    conf("spark.sql.files.openCostInBytes", "0")
    texts = ["two\nlines", 'a "quote", a comma', "", None, "\n", '"', "x" * 200, '",\n"', "cr\r\nlf ", "text"]
    most = []
    for parts in (2, 4):
        sf, run = tmp_path / f"sf{parts}", tmp_path / f"run{parts}"
        n = 40 * parts
        known = [(i, texts[i % len(texts)]) for i in range(n)] + [(0, texts[0]), (None, "no key")]
        for k in range(parts):
            mine = spark.createDataFrame(known[k::parts], "doc_id bigint, text string")
            mine.withColumn("lang", F.lit("en")).coalesce(1).write.mode("append").parquet(str(sf / "documents.parquet"))
        monkeypatch.setattr(queries, "_run_dir", lambda _, run=run: str(run))
        out = QUERIES["staged_round_trip"](spark, str(sf))
        assert rows(out) == sorted(((i, t or None) for i, t in known), key=lambda r: tuple(str(v) for v in r))
        written = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(str(run))
        held = [r["count"] for r in written.groupBy(F.input_file_name()).count().collect()]
        blocks = spark.read.option("lineSep", "\n").text(str(run)).select(F.col("_metadata.file_path"), F.col("_metadata.file_block_start")).distinct()
        assert blocks.count() > 2 * len(held)
        most.append((len(held), max(held)))
    assert most[0][0] == 2 and most[1][0] == 4 and most[1][1] <= most[0][1] + 1
