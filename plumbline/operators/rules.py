"""Configured rules and the incidents they open."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from datetime import date, datetime
from functools import reduce
from pathlib import Path
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from plumbline.functions.parsing import utc_stamp
from plumbline.functions.frames import literal_rows
from plumbline.functions.numeric import ratio_half_even
from plumbline.operators.checks import orphan_rows
from plumbline.sources.contracts import SEVERITIES, ContractError
from plumbline.sources.files import materialize

# Fields every rule has, and those each kind adds, with their types.
RULE_FIELDS = {"rule_id": str, "dataset": str, "kind": str, "severity": str, "owner": str, "description": str}
KIND_FIELDS = {
    "expression": {"condition": str},
    "foreign_key": {"column": str, "reference_dataset": str, "reference_column": str},
    "freshness": {"column": str, "max_age_days": int},
}
ALLOWED = {"kind": tuple(KIND_FIELDS), "severity": tuple(SEVERITIES)}


def _findings(rules: list[dict[str, Any]]) -> Iterator[str]:
    """Everything wrong with the rules, a sentence each."""
    for place, rule in enumerate(rules, 1):
        name = f"rule {place} ({rule.get('rule_id', 'unnamed')})"
        for field, kind in {**RULE_FIELDS, **KIND_FIELDS.get(rule.get("kind"), {})}.items():
            if field not in rule:
                yield f"{name} lacks {field}"
            elif not isinstance(rule[field], kind):
                yield f"{name}: {field} is not {kind.__name__}"
        for field, known in ALLOWED.items():
            if field in rule and rule[field] not in known:
                yield f"{name} has unsupported {field} {rule[field]!r}"
    for name, uses in Counter(rule.get("rule_id") for rule in rules).items():
        if name is not None and uses > 1:
            yield f"{name} is defined twice or more ({uses} times)"


def _resolved(frame: DataFrame, rule: dict[str, Any], frames: dict[str, DataFrame]) -> DataFrame:
    """The rule's test over a frame without rows; Spark resolves it at once and starts no job."""
    if rule["kind"] == "expression":
        frame.agg(_failed_rows(rule, date.min))  # the use an evaluation makes of it
        return frame.where(F.expr(rule["condition"]))  # no room for aggregates, windows or other types than boolean
    if rule["kind"] == "freshness":
        return frame.select(F.to_date(F.col(rule["column"])))
    reference = frames[rule["reference_dataset"]].select(F.col(rule["reference_column"]).alias("_reference"))
    return frame.select(F.col(rule["column"]).alias("_key")).join(reference, F.col("_key") == F.col("_reference"))


def _unresolved(rules: list[dict[str, Any]], frames: dict[str, DataFrame]) -> Iterator[str]:
    """What does not fit the columns of the datasets, a sentence each, of rules whose fields are sound."""
    empty = {name: df.sparkSession.createDataFrame([], df.schema) for name, df in frames.items()}
    for place, rule in enumerate(rules, 1):
        if list(_findings([rule])):
            continue
        name = f"rule {place} ({rule['rule_id']})"
        absent = [rule[f] for f in ("dataset", "reference_dataset") if f in rule and rule[f] not in empty]
        if absent:
            yield from (f"{name}: there is no dataset {dataset}" for dataset in absent)
            continue
        try:
            resolved = _resolved(empty[rule["dataset"]], rule, empty)
            if not resolved._jdf.queryExecution().analyzed().deterministic():
                yield f"{name} does not give the same result each time"
        except AnalysisException as error:
            yield f"{name} can't be resolved: {error.getCondition()}"


def validate_rules(config: dict[str, Any], frames: dict[str, DataFrame] | None = None) -> dict[str, Any]:
    """The configuration itself, or one error that lists all that is wrong with its rules.

    With `frames`, rules whose fields are sound are resolved against the columns of the datasets as well: unknown
    datasets and columns, conditions that are malformed, not boolean, aggregates or random. No job is started.
    """
    found = list(_findings(config["rules"]))
    if frames:
        found += _unresolved(config["rules"], frames)
    if found:
        raise ContractError("; ".join(found))
    return config


def load_rules(path: str | Path) -> dict[str, Any]:
    """Rule configuration from a JSON file."""
    return validate_rules(json.loads(Path(path).read_text(encoding="utf-8")))


def rule_catalog(spark: SparkSession, config: dict[str, Any]) -> DataFrame:
    """Rules as rows."""
    rows = [tuple(rule[field] for field in RULE_FIELDS) for rule in config["rules"]]
    return literal_rows(spark, rows, dict.fromkeys(RULE_FIELDS, "string"))


def _failed_rows(rule: dict[str, Any], day: date) -> Column:
    """Failed rows of a rule that one dataset answers alone. Foreign keys are counted by their join."""
    if rule["kind"] == "expression":
        # A condition that is NULL is not a failure.
        return F.count_if(~F.expr(rule["condition"]))
    if rule["kind"] == "freshness":
        latest = F.max(F.to_date(rule["column"]))
        age = F.date_diff(F.lit(day.isoformat()).cast("date"), latest)
        stale = F.coalesce(age > int(rule["max_age_days"]), F.lit(True))
        return F.when(stale, F.count("*")).otherwise(0)
    return F.lit(0)


def evaluate_rules(
    frames: dict[str, DataFrame],
    config: dict[str, Any],
    day: date,
    evaluated_at: datetime,
    empty_is_failure: bool = False,
) -> DataFrame:
    """One row per rule.

    All rules of a dataset are answered by one aggregation over it, foreign keys by one join each. A
    dataset without rows has a failed rate of 100 and still passes, unless `empty_is_failure`.
    """
    rules = config["rules"]
    spark = next(iter(frames.values())).sparkSession
    parts = []
    for dataset in dict.fromkeys(rule["dataset"] for rule in rules):
        own = [rule for rule in rules if rule["dataset"] == dataset]
        counts = [
            F.struct(
                F.lit(rule["rule_id"]).alias("rule_id"),
                F.count("*").alias("evaluated_rows"),
                _failed_rows(rule, day).cast("bigint").alias("failed_rows"),
            )
            for rule in own
        ]
        parts.append(frames[dataset].agg(F.array(*counts).alias("counts")).select(F.inline("counts")))
        for rule in own:
            if rule["kind"] == "foreign_key":
                parent = frames[rule["reference_dataset"]]
                orphans = orphan_rows(frames[dataset], rule["column"], parent, rule["reference_column"])
                parts.append(
                    orphans.select(
                        F.lit(rule["rule_id"]).alias("rule_id"),
                        F.lit(0).cast("bigint").alias("evaluated_rows"),
                        F.col("orphans").alias("failed_rows"),
                    )
                )
    counted = parts[0]
    for part in parts[1:]:
        counted = counted.unionByName(part)
    totals = counted.groupBy("rule_id").agg(
        F.sum("evaluated_rows").alias("evaluated_rows"), F.sum("failed_rows").alias("failed_rows")
    )
    failed = F.col("failed_rows") > 0
    if empty_is_failure:
        failed = failed | (F.col("evaluated_rows") == 0)
    rate = ratio_half_even(F.col("failed_rows"), F.col("evaluated_rows"))
    return totals.join(rule_catalog(spark, config), "rule_id").select(
        "rule_id",
        "dataset",
        "severity",
        "owner",
        "description",
        F.when(failed, "FAIL").otherwise("PASS").alias("status"),
        "evaluated_rows",
        "failed_rows",
        F.coalesce(rate.cast("double"), F.lit(100.0)).alias("failed_rate_pct"),
        utc_stamp(evaluated_at).alias("evaluated_at_utc"),
    )


def versions_in_effect(days: DataFrame, versions: DataFrame) -> DataFrame:
    """rule_id, day and the version in effect on it; days before a rule's first version have none.

    Days and starts of versions are put in one order, and the last version carried forward: one sort of a row per rule,
    day and version, whatever the number of versions.
    """
    starts = versions.select("rule_id", F.col("effective_from").alias("day"), F.col("version").alias("_starts"))
    line = days.select("rule_id", "day").distinct().withColumn("_starts", F.lit(None).cast(starts.schema["_starts"].dataType)).unionByName(starts)
    # The start of a version comes before the day it begins on.
    order = W.partitionBy("rule_id").orderBy("day", F.col("_starts").isNull(), "_starts")
    carried = F.last("_starts", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0))
    return line.withColumn("version", carried).where("_starts IS NULL AND version IS NOT NULL").drop("_starts")


def evaluate_versions(
    frames: dict[str, DataFrame],
    day_columns: dict[str, str],
    conditions: list[dict[str, Any]],
    versions: DataFrame,
    evaluated_at: datetime,
) -> DataFrame:
    """One row per rule and version that judged rows: each row by the version in effect on its own day.

    `conditions`: expression rules, each with its `version`; a rule comes once for every version. `versions`: rule_id,
    version, effective_from. `day_columns` names the day of a row, by dataset. A dataset is read once and summed up by day
    under all versions of its rules; the version of each day is chosen from those few rows.
    """
    found = [f for f in _findings(conditions) if "is defined twice" not in f]
    found += [f"{r.get('rule_id')} is of kind {r.get('kind')}, only expressions have versions" for r in conditions if r.get("kind") != "expression"]
    found += [f"{name} version {v} is defined {n} times" for (name, v), n in Counter((r.get("rule_id"), r.get("version")) for r in conditions).items() if n > 1]
    if found:
        raise ContractError("; ".join(found))
    spark, parts = versions.sparkSession, []
    for dataset in dict.fromkeys(rule["dataset"] for rule in conditions):
        counts = [
            F.struct(
                F.lit(rule["rule_id"]).alias("rule_id"),
                F.lit(rule["version"]).cast("int").alias("version"),
                F.count("*").alias("evaluated_rows"),
                F.count_if(~F.expr(rule["condition"])).alias("failed_rows"),
            )
            for rule in conditions
            if rule["dataset"] == dataset
        ]
        by_day = frames[dataset].groupBy(F.col(day_columns[dataset]).cast("date").alias("day"))
        parts.append(by_day.agg(F.array(*counts).alias("counts")).select("day", F.inline("counts")))
    counted = materialize(reduce(DataFrame.unionByName, parts), "rule-days")
    in_effect = versions_in_effect(counted, versions.withColumn("version", F.col("version").cast("int")))
    fields = [f for f in RULE_FIELDS if f not in ("kind", "rule_id")]
    rows = [(r["rule_id"], r["version"], *[r[f] for f in fields]) for r in conditions]
    catalog = literal_rows(spark, rows, {"rule_id": "string", "version": "int", **dict.fromkeys(fields, "string")})
    totals = counted.join(in_effect, ["rule_id", "day", "version"]).groupBy("rule_id", "version").agg(
        F.sum("evaluated_rows").alias("evaluated_rows"), F.sum("failed_rows").alias("failed_rows")
    )
    rate = ratio_half_even(F.col("failed_rows"), F.col("evaluated_rows"))
    return totals.join(catalog, ["rule_id", "version"]).select(
        "rule_id",
        "version",
        "dataset",
        "severity",
        "owner",
        "description",
        F.when(F.col("failed_rows") > 0, "FAIL").otherwise("PASS").alias("status"),
        "evaluated_rows",
        "failed_rows",
        F.coalesce(rate.cast("double"), F.lit(100.0)).alias("failed_rate_pct"),
        utc_stamp(evaluated_at).alias("evaluated_at_utc"),
    )


def rule_status(results: DataFrame) -> DataFrame:
    """Rules and failed rows by severity, owner and status."""
    return results.groupBy("severity", "owner", "status").agg(
        F.count("*").alias("rule_count"), F.sum("failed_rows").alias("failed_rows")
    )


def incidents(results: DataFrame, config: dict[str, Any], day: date) -> DataFrame:
    """An incident per result whose status the policy opens on."""
    key = F.concat_ws("|", "rule_id", "dataset", F.lit(day.isoformat()))
    return results.where(F.col("status").isin(*config["incident_policy"]["open_on_status"])).select(
        F.concat(F.lit("INC-"), "rule_id", F.lit(f"-{day:%Y%m%d}")).alias("incident_id"),
        "rule_id",
        "dataset",
        "severity",
        "owner",
        F.lit("OPEN").alias("status"),
        "failed_rows",
        F.col("evaluated_at_utc").alias("opened_at_utc"),
        key.alias("deduplication_key"),
    )


def new_incidents(opened: DataFrame, published: DataFrame) -> DataFrame:
    """Incidents whose deduplication key has not been published yet, each once."""
    return opened.dropDuplicates(["deduplication_key"]).join(
        published.select("deduplication_key"), "deduplication_key", "left_anti"
    ).select(*opened.columns)


def open_incidents(published: DataFrame) -> DataFrame:
    """Incidents still open."""
    return published.where(F.col("status") == "OPEN")
