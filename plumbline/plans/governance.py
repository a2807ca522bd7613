"""Profile, rules, incidents and their governed publication."""

from __future__ import annotations

from datetime import date, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from plumbline.operators import profile, rules
from plumbline.plans import views
from plumbline.sources import files
from plumbline.sources.contracts import INCIDENT_SCHEMA


def run(
    spark: SparkSession,
    frames: dict[str, DataFrame],
    config: dict[str, Any],
    out_dir: str,
    day: date,
    evaluated_at: datetime,
    distinct: str = "exact",
    run_id: str | None = None,
) -> dict[str, DataFrame]:
    """Publish profiles, rule results and incidents under `out_dir`, and return them with their views.

    Profiles and results are kept per `run_id` (the evaluation time if not given); the views show this run's.
    Incidents are added, each deduplication key once, so a second run on the same day opens nothing twice. The
    session is the caller's and stays open.
    """
    run_id = run_id or f"{evaluated_at:%Y%m%dT%H%M%S}"

    def keep(name: str, df: DataFrame) -> DataFrame:
        path = f"{out_dir}/{name}/run_id={run_id}"
        files.write_governed(df, path)
        return spark.read.schema(df.schema).parquet(path)

    rules.validate_rules(config, frames)
    profiles = keep("column_profile", profile.profile_all(frames, evaluated_at, distinct))
    results = keep("rule_result", rules.evaluate_rules(frames, config, day, evaluated_at))

    path = f"{out_dir}/incident"
    published = files.read_governed(spark, path, INCIDENT_SCHEMA)
    files.append_governed(rules.new_incidents(rules.incidents(results, config, day), published), path)
    incidents = files.read_governed(spark, path, INCIDENT_SCHEMA)

    frames_out = {"governed_column_profile": profiles, "governed_rule_result": results, "governed_incident": incidents}
    frames_out |= views.governance_views(results, incidents)
    views.install(spark, frames_out)
    return frames_out
