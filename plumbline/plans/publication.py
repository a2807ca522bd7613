"""From raw extracts to the published star schema (clean, control, gate, stage, load, report)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from plumbline.functions.parsing import utc_stamp
from plumbline.operators import checks, cleaning, keys, recon, star
from plumbline.plans import views
from plumbline.sources import files
from plumbline.sources.contracts import CHECK_SCHEMA, CLEAN_COLUMNS, Policy

DATASETS = tuple(CLEAN_COLUMNS)
MODEL = ("dim_date", "dim_customer", "dim_category", "fact_sales_order", "fact_reconciliation_control")
PUBLISHED_SCHEMA = "run_id string, published_at timestamp"


def load_model(clean: dict[str, DataFrame], path: str, keys_path: str) -> dict[str, DataFrame]:
    """Rebuild the star tables in Parquet.

    Dimensions are written first and read back, so the facts are joined to tables of known size; each fact is written
    once. The keys of customers and categories come from maps below `keys_path`, so they are the same in every run.
    """
    spark = clean["customers"].sparkSession

    def write(name: str, df: DataFrame) -> DataFrame:
        files.write_governed(df, f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    def kept(name: str, rows: DataFrame, by: str) -> DataFrame:
        return star.with_kept_key(rows, keys.keep_keys(rows, f"{keys_path}/{name}", f"{name}_key", by), by, f"{name}_key")

    customers, orders, controls = clean["customers"], clean["sales_orders"], clean["gl_controls"]
    model = {
        "dim_date": write("dim_date", star.dim_date(orders, controls)),
        "dim_customer": write("dim_customer", kept("customer", star.customer_rows(customers), "customer_id")),
        "dim_category": write("dim_category", kept("category", star.category_rows(orders), "category_code")),
    }
    fact = star.published_orders(orders, model["dim_customer"], model["dim_category"])
    model["fact_sales_order"] = write("fact_sales_order", fact)
    model["fact_reconciliation_control"] = write(
        "fact_reconciliation_control", star.fact_reconciliation_control(controls)
    )
    return model


def _switch(spark: SparkSession, out_dir: str, run_id: str, at: datetime) -> None:
    """Make a run's model the current one, by one appended row."""
    done = spark.range(1).select(F.lit(run_id).alias("run_id"), utc_stamp(at).alias("published_at"))
    files.append_governed(done.coalesce(1), f"{out_dir}/published")


def current_model(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """Star tables of the run that was published last; a run that is under way or has failed is not seen."""
    runs = files.read_governed(spark, f"{out_dir}/published", PUBLISHED_SCHEMA)
    last = runs.orderBy(F.desc("published_at"), F.desc("run_id")).first()
    if last is None:
        raise LookupError(f"nothing is published in {out_dir}")
    return {name: spark.read.parquet(f"{out_dir}/model/run_id={last.run_id}/{name}") for name in MODEL}


def run(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    day: date,
    evaluated_at: datetime,
    policy: Policy = Policy(),
    mode: str = "strict",
    run_id: str | None = None,
    one_line: bool = False,
    split: bool = False,
) -> dict[str, DataFrame]:
    """Publish the model if every control passes, and return its tables and views.

    The controls are persisted before the gate, per `run_id` (the evaluation time if not given), so a
    failed run leaves its evidence under `checks` and earlier runs stay readable beside it. The model is
    written per run too, and becomes the current one when all its tables are there. In `quarantine` mode rows that do not parse are set aside under `rejects`; the raw-to-clean count control
    then reports them. In `strict` mode they end the run. `one_line` says that the extracts have one
    record per line, `split` deals large ones with line breaks in values out to many tasks.
    """
    raw, raw_columns, clean = {}, {}, {}
    for name in DATASETS:
        extract = files.read_raw(spark, f"{raw_dir}/{name}.csv", one_line, split)
        raw_columns[name] = extract.columns
        # Raw text is parsed once; controls, staging and the star schema read the written result.
        parsed = files.materialize(cleaning.parse(files.fill_missing(extract, name), name), f"parsed-{name}")
        raw[name] = parsed
        if mode == "quarantine":
            files.write_governed(cleaning.rejects(parsed), f"{out_dir}/rejects/{name}")
        clean[name] = cleaning.clean(parsed, mode)

    ages = files.raw_file_ages(spark, raw_dir, day.isoformat())
    suite = checks.check_suite(clean, raw, evaluated_at, policy, ages, raw_columns)
    run_id = run_id or f"{evaluated_at:%Y%m%dT%H%M%S}"
    path = f"{out_dir}/checks/dq_check_result/run_id={run_id}"
    files.write_governed(suite, path)
    results = files.read_governed(spark, path, CHECK_SCHEMA)
    # At most one row per control.
    numbered = recon.check_exceptions(results).withColumn("exception_key", F.row_number().over(W.orderBy("check_id")))
    files.write_governed(numbered, f"{out_dir}/checks/dq_reconciliation_exception/run_id={run_id}")
    checks.gate(results)

    for name in DATASETS:
        files.write_extract(clean[name], f"{out_dir}/staging/{name}_clean.csv")
    model = load_model(clean, f"{out_dir}/model/run_id={run_id}", f"{out_dir}/keys")
    _switch(spark, out_dir, run_id, evaluated_at)
    published = {**model, "dq_check_result": results, **views.model_views(model, results)}
    views.install(spark, published)
    return published
