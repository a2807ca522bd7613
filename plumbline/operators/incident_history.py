"""Histories of incidents: which state each was in, from when to when."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plumbline.sources.files import materialize

_STATE = ("status", "disposition")


def _events(rows: DataFrame, at: str, rank: int, status: Column, disposition: Column) -> DataFrame:
    state = F.struct(F.lit(rank).alias("rank"), status.cast("string").alias("status"), disposition.cast("string").alias("disposition"))
    return rows.select("deduplication_key", F.col(at).alias("at"), state.alias("event"))


def closings(incidents: DataFrame, evaluations: DataFrame) -> DataFrame:
    """deduplication_key and closed_at: the first passing evaluation of an incident's rule and dataset after it opened.

    `evaluations`: rule_id, dataset, status, evaluated_at. Openings and passes are put in one order and the next pass is
    carried back, so that no incident meets all evaluations. A rule's window holds its incidents and distinct passes.
    """
    passes = evaluations.where("status = 'PASS'").select("rule_id", "dataset", F.col("evaluated_at").alias("at")).distinct()
    line = incidents.select("rule_id", "dataset", F.col("opened_at_utc").alias("at"), "deduplication_key", F.lit(False).alias("passes"))
    line = line.unionByName(passes.withColumn("passes", F.lit(True)), allowMissingColumns=True)
    # Backwards in time; at one moment the opening comes first, so a pass of the same moment doesn't close it.
    back = W.partitionBy("rule_id", "dataset").orderBy(F.col("at").desc(), "passes").rowsBetween(W.unboundedPreceding, 0)
    closed = line.withColumn("closed_at", F.last(F.when(F.col("passes"), F.col("at")), ignorenulls=True).over(back))
    return closed.where("NOT passes AND closed_at IS NOT NULL").select("deduplication_key", "closed_at")


def history(incidents: DataFrame, updates: DataFrame, evaluations: DataFrame) -> DataFrame:
    """deduplication_key, valid_from, valid_to, status, disposition: one row for each state of an incident.

    An incident is OPEN from its opening, has the state of each update from `updated_at` on, and is RESOLVED with
    disposition PASSED at its first passing evaluation after the opening; an update behind that states it anew. A state
    holds until the next other one begins; the last has no end. Late updates take effect at their own time, whenever
    they come. Of several at one moment a pass counts, then the update that sorts last. Updates without a moment
    or before the opening, and those of unknown incidents, have no place in a history.
    """
    openings = incidents.groupBy("deduplication_key").agg(F.min("opened_at_utc").alias("opened_at"))
    known = updates.join(openings, "deduplication_key").where("updated_at >= opened_at")
    none = F.lit(None)
    events = (
        _events(openings, "opened_at", 0, F.lit("OPEN"), none)
        .unionByName(_events(known, "updated_at", 1, F.col("status"), F.col("disposition")))
        .unionByName(_events(closings(incidents, evaluations), "closed_at", 2, F.lit("RESOLVED"), F.lit("PASSED")))
    )
    states = events.groupBy("deduplication_key", "at").agg(F.max("event").alias("event")).select(
        "deduplication_key", "at", F.struct(*[F.col(f"event.{c}").alias(c) for c in _STATE]).alias("state")
    )
    return _intervals(states).select("deduplication_key", "valid_from", "valid_to", *[f"state.{c}" for c in _STATE])


def _intervals(states: DataFrame) -> DataFrame:
    """States by moment as intervals, equal neighbours collapsed.

    An incident may hold a large part of all updates, so its hours are collapsed apart from each other; then only the
    first and last state of each hour meet.
    """
    hour = ["deduplication_key", "hour"]
    within = W.partitionBy(*hour).orderBy("at")
    before = F.lag("state").over(within)
    changes = states.withColumn("hour", F.date_trunc("hour", "at")).withColumn("_same", before.eqNullSafe(F.col("state")))
    changes = changes.where("NOT _same").select(*hour, "at", "state", F.row_number().over(within).alias("no"), F.lead("at").over(within).alias("next_at"))
    changes = materialize(changes, "state-changes")
    hours = changes.groupBy(*hour).agg(
        F.min_by("state", "at").alias("first"), F.max_by("state", "at").alias("last"), F.min("at").alias("begin"), F.min(F.when(F.col("no") == 2, F.col("at"))).alias("second")
    )
    by_hour = W.partitionBy("deduplication_key").orderBy("hour")
    hours = hours.withColumn("goes_on", F.lag("last").over(by_hour).eqNullSafe(F.col("first")))
    hours = hours.withColumn("begin", F.when(F.col("goes_on"), F.col("second")).otherwise(F.col("begin")))
    later = W.partitionBy("deduplication_key").orderBy(F.col("hour").desc()).rowsBetween(W.unboundedPreceding, -1)
    hours = hours.select(*hour, "goes_on", F.last("begin", ignorenulls=True).over(later).alias("later_at"))
    kept = changes.join(hours, hour).where("NOT (goes_on AND no = 1)")
    # An hour's first change may be gone; its end was that of the state it goes on with, which `later_at` gives.
    return kept.select("deduplication_key", F.col("at").alias("valid_from"), F.coalesce("next_at", "later_at").alias("valid_to"), "state")


def states_at(intervals: DataFrame, moment: datetime) -> DataFrame:
    """The state of every incident that had opened by `moment`, as it was then."""
    at = F.lit(moment.isoformat(sep=" ")).cast(intervals.schema["valid_from"].dataType)
    return intervals.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))
