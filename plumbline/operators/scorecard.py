"""Governance metrics of the KPI catalogue.

Dimension scores share one shape: product, dimension, element, passed, assessed, rate_pct.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plumbline.functions.numeric import percent, ratio
from plumbline.functions.parsing import month_start
from plumbline.functions.text import identity, is_blank
from plumbline.operators.checks import duplicate_rows


# --- dimension scores -----------------------------------------------------------------------------


def _scores(
    df: DataFrame, product: str, passed: list[tuple[str, str, Column]], assessed: Column, by: Sequence[str]
) -> DataFrame:
    """One score per element and group of `by`, all from one aggregation."""
    rows = [
        F.struct(
            F.lit(product).alias("product"),
            F.lit(dimension).alias("dimension"),
            F.lit(element).alias("element"),
            count.cast("bigint").alias("passed"),
            assessed.cast("bigint").alias("assessed"),
        )
        for dimension, element, count in passed
    ]
    scored = df.groupBy(*by).agg(F.array(*rows).alias("rows")).select(*by, F.inline("rows"))
    rated = scored.withColumn("rate_pct", percent(F.col("passed"), F.col("assessed")))
    return rated.select("product", "dimension", "element", "passed", "assessed", "rate_pct", *by)


def _text_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema if f.dataType.typeName() == "string"}


def cell_scores(
    df: DataFrame,
    product: str,
    complete: Sequence[str] = (),
    valid: dict[str, Column] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Completeness of the columns `complete` and validity by the conditions `valid`, in one scan (K2, K3).

    `by` names attributes of the rows, such as owner, severity or month, that the scores then carry.
    """
    text = _text_columns(df)
    filled = [("completeness", c, F.count_if(~is_blank(F.col(c), c in text))) for c in complete]
    met = [("validity", name, F.count_if(F.coalesce(c, F.lit(False)))) for name, c in (valid or {}).items()]
    return _scores(df, product, filled + met, F.count("*"), by)


def completeness(df: DataFrame, product: str, columns: list[str], by: Sequence[str] = ()) -> DataFrame:
    """Populated of expected values per column (K2)."""
    return cell_scores(df, product, complete=columns, by=by)


def validity(df: DataFrame, product: str, conditions: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Values that meet their domain, range or pattern, of all values assessed (K3); NULL is not valid."""
    return cell_scores(df, product, valid=conditions, by=by)


def uniqueness(df: DataFrame, product: str, keys: list[str], by: Sequence[str] = ()) -> DataFrame:
    """One minus duplicate rows over keys assessed (K4)."""
    text = _text_columns(df)
    parts = [identity(F.col(k)).alias(k) if k in text else F.col(k) for k in keys]
    passed = [("uniqueness", ", ".join(keys), F.count("*") - duplicate_rows(*parts))]
    return _scores(df, product, passed, F.count("*"), by)


def overall_score(scores: DataFrame, weights: dict[str, Decimal | int]) -> DataFrame:
    """Weighted mean of the dimension scores of a product (K1); dimensions without a weight do not count.

    A dimension's score pools its elements, so each product and dimension weighs in once.
    """
    by_dimension = scores.groupBy("product", "dimension").agg(
        F.sum("passed").alias("passed"), F.sum("assessed").alias("assessed")
    )
    weight = F.lit(None).cast("decimal(9,4)")
    for dimension, value in weights.items():
        weight = F.when(F.col("dimension") == dimension, F.lit(value).cast("decimal(9,4)")).otherwise(weight)
    weighed = by_dimension.select(
        "product", percent(F.col("passed"), F.col("assessed")).alias("score"), weight.alias("weight")
    ).where("weight IS NOT NULL AND score IS NOT NULL")
    return weighed.groupBy("product").agg(
        ratio(F.sum(F.col("score") * F.col("weight")), F.sum("weight"), scale=6).alias("overall_score_pct")
    )


def scorecard(scores: DataFrame, by: list[str], totals: bool = False, where: Column | str = "true") -> DataFrame:
    """Scores filtered and pooled by any attributes they carry, with sub-totals on request."""
    chosen = scores.where(where)
    grouped = chosen.rollup(*by) if totals else chosen.groupBy(*by)
    pooled = grouped.agg(F.sum("passed").alias("passed"), F.sum("assessed").alias("assessed"))
    return pooled.withColumn("rate_pct", percent(F.col("passed"), F.col("assessed")))


# --- refreshes ------------------------------------------------------------------------------------


def refresh_status(schedule: DataFrame, loads: DataFrame) -> DataFrame:
    """ON_TIME, LATE or MISSING per scheduled refresh, apart from any content result.

    `schedule`: product, due_date, due_at. `loads`: product, due_date, received_at; the first counts.
    """
    first = loads.groupBy("product", "due_date").agg(F.min("received_at").alias("received_at"))
    status = (
        F.when(F.col("received_at").isNull(), "MISSING")
        .when(F.col("received_at") > F.col("due_at"), "LATE")
        .otherwise("ON_TIME")
    )
    return schedule.join(first, ["product", "due_date"], "left").select(
        "product", "due_date", "due_at", "received_at", status.alias("refresh_status")
    )


def timeliness(refreshes: DataFrame) -> DataFrame:
    """Loads received by their SLA of scheduled loads, per product and month (K5)."""
    counted = refreshes.groupBy("product", month_start(F.col("due_date")).alias("month_start")).agg(
        F.count_if(F.col("refresh_status") == "ON_TIME").alias("on_time"), F.count("*").alias("scheduled")
    )
    return counted.withColumn("timeliness_pct", percent(F.col("on_time"), F.col("scheduled")))


# --- reconciliation -------------------------------------------------------------------------------


def variance_percent(recon_daily: DataFrame) -> DataFrame:
    """|source - target| / max(|source|, 1) per control (K6)."""
    source = F.abs("source_order_amount")
    gap = F.abs(F.col("source_order_amount") - F.col("curated_order_amount"))
    base = F.greatest(source, F.lit(1).cast("decimal(38,2)"))
    return recon_daily.select("calendar_date", "currency_code", percent(gap, base, 4).alias("variance_pct"))


def coverage(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Eligible source keys that the target has (K7). Both sides are made distinct before they meet."""
    wanted = source.select(key).where(F.col(key).isNotNull()).distinct()
    there = target.select(key).distinct().withColumn("_found", F.lit(1))
    counted = wanted.join(there, key, "left").agg(
        F.count("_found").alias("matched_keys"), F.count("*").alias("source_keys")
    )
    return counted.withColumn("coverage_pct", percent(F.col("matched_keys"), F.col("source_keys")))


# --- exceptions -----------------------------------------------------------------------------------
# Exceptions: exception_id, rule_id, root_cause, domain, severity, owner, opened_at, assigned_at, resolved_at,
# and disposition once a steward has decided on them.


def one_business_day_after(moment: Column) -> Column:
    """The same time on the next day from Monday to Friday."""
    weekday = F.weekday(moment)  # 0 is Monday
    days = F.when(weekday == 4, 3).when(weekday == 5, 2).otherwise(1)
    return moment + F.make_dt_interval(days)


def next_business_days(days: DataFrame, holidays: DataFrame) -> DataFrame:
    """(day, next_day): the weekday after each `day` that is not among `holidays`, a one-column frame.

    All steps are over calendar days, so the window is bounded by the calendar.
    """
    off = holidays.toDF("day").distinct()
    closed = off.agg(F.count("*")).scalar()
    # Past the last day there is a working day within the holidays and a weekend for each of them.
    span = days.agg(F.min("day").alias("low"), F.max("day").alias("high")).where("low IS NOT NULL")
    reach = F.date_add("high", (closed * 3 + 5).cast("int"))
    dates = span.select(F.explode(F.sequence("low", reach)).alias("day"))
    open_days = dates.where(F.weekday("day") < 5).join(off, "day", "left_anti").withColumn("_open", F.col("day"))
    after = W.orderBy("day").rowsBetween(1, W.unboundedFollowing)
    following = dates.join(open_days, "day", "left").select(
        "day", F.first("_open", ignorenulls=True).over(after).alias("next_day")
    )
    return days.select("day").distinct().join(following, "day")


def assignment_sla(exceptions: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Critical exceptions assigned within one business day, per domain and month raised (K8).

    Business days are Monday to Friday, but for the `holidays`, a frame of one date column.
    """
    critical = exceptions.where(F.col("severity") == "CRITICAL")
    due = one_business_day_after(F.col("opened_at"))
    if holidays is not None:
        critical = critical.withColumn("day", F.to_date("opened_at"))
        critical = critical.join(next_business_days(critical.select("day"), holidays), "day", "left")
        due = F.col("opened_at") + F.make_dt_interval(F.date_diff("next_day", "day"))
    counted = critical.groupBy("domain", month_start(F.col("opened_at")).alias("month_start")).agg(
        F.count_if(F.col("assigned_at") <= due).alias("assigned_in_time"), F.count("*").alias("raised")
    )
    return counted.withColumn("sla_pct", percent(F.col("assigned_in_time"), F.col("raised")))


def time_to_resolve(exceptions: DataFrame) -> DataFrame:
    """Mean hours from opening to resolution, per severity and month resolved (K9)."""
    seconds = F.unix_timestamp(F.col("resolved_at").cast("timestamp")) - F.unix_timestamp(
        F.col("opened_at").cast("timestamp")
    )
    counted = (
        exceptions.where(F.col("resolved_at").isNotNull())
        .groupBy("severity", month_start(F.col("resolved_at")).alias("month_start"))
        .agg(F.count("*").alias("resolved"), F.sum(seconds).alias("_seconds"))
    )
    hours = ratio(F.col("_seconds"), F.col("resolved") * 3600)
    return counted.select("severity", "month_start", "resolved", hours.alias("mean_hours_to_resolve"))


def recurrence(exceptions: DataFrame, within_days: int = 30) -> DataFrame:
    """Exceptions that repeat rule and root cause within 30 days, of those resolved, per rule and month.

    Days are the grain. Exceptions are counted per rule, cause, day and closing month first, in one pass
    that both halves share; the look-back then sees at most one row per calendar day in a group, however
    often it recurs. A repeat falls in the month it opens, a resolution in the month it closes.
    """
    closed = month_start(F.col("resolved_at")).alias("closed")
    counted = exceptions.groupBy("rule_id", "root_cause", F.to_date("opened_at").alias("day"), closed).agg(
        F.count("*").alias("opened")
    )
    per_day = counted.groupBy("rule_id", "root_cause", "day").agg(F.sum("opened").alias("opened"))
    before = F.lag("day").over(W.partitionBy("rule_id", "root_cause").orderBy("day"))
    known = F.col("root_cause").isNotNull()  # unknown causes are not one cause
    first_repeats = F.coalesce(F.date_diff("day", before) <= within_days, F.lit(False)).cast("bigint")
    repeats = (
        per_day.select("rule_id", "day", F.when(known, F.col("opened") - 1 + first_repeats).otherwise(0).alias("repeats"))
        .groupBy("rule_id", month_start(F.col("day")).alias("month_start"))
        .agg(F.sum("repeats").alias("repeats"))
    )
    # Open ones leave by their sum and not by a filter on the month, which would move into the scan and
    # make this half's pass a different one.
    resolved = (
        counted.groupBy("rule_id", F.col("closed").alias("month_start"))
        .agg(F.sum(F.when(F.col("closed").isNotNull(), F.col("opened"))).alias("resolved"))
        .where("resolved IS NOT NULL")
    )
    both = repeats.join(resolved, ["rule_id", "month_start"], "full_outer").select(
        "rule_id",
        "month_start",
        F.coalesce("repeats", F.lit(0)).alias("repeats"),
        F.coalesce("resolved", F.lit(0)).alias("resolved"),
    )
    return both.withColumn("recurrence_pct", percent(F.col("repeats"), F.col("resolved")))


def exception_register(incidents: DataFrame, updates: DataFrame, day: date) -> DataFrame:
    """Incidents with their latest stewardship update and their age in days.

    `updates`: deduplication_key, updated_at, status, disposition, root_cause, resolved_at. Age runs to
    the resolution, or to `day` while unresolved.
    """
    state = F.struct("updated_at", "status", "disposition", "root_cause", "resolved_at")
    latest = updates.groupBy("deduplication_key").agg(F.max(state).alias("latest"))
    until = F.coalesce(F.to_date("latest.resolved_at"), F.lit(day.isoformat()).cast("date"))
    return incidents.join(latest, "deduplication_key", "left").select(
        "incident_id",
        "rule_id",
        "dataset",
        "severity",
        "owner",
        F.coalesce("latest.status", incidents["status"]).alias("status"),
        F.col("latest.disposition").alias("disposition"),
        F.col("latest.root_cause").alias("root_cause"),
        F.col("latest.resolved_at").alias("resolved_at"),
        F.date_diff(until, F.to_date("opened_at_utc")).alias("age_days"),
    )


# --- status ---------------------------------------------------------------------------------------


def rate_rag(rate: Column, target: Column) -> Column:
    """GREEN at target, AMBER within two percentage points below it, else RED."""
    return F.when(rate >= target, "GREEN").when(rate >= target - 2, "AMBER").otherwise("RED")


def variance_rag(variance: Column, tolerance: Column) -> Column:
    """GREEN within tolerance, AMBER up to a quarter above it, else RED."""
    near = variance <= tolerance * F.lit(Decimal("1.25"))
    return F.when(variance <= tolerance, "GREEN").when(near, "AMBER").otherwise("RED")


def product_status(rated: DataFrame, exceptions: DataFrame) -> DataFrame:
    """`rated` (product, rag, ...) where an unresolved critical exception turns GREEN to AMBER until its
    disposition is recorded (K11)."""
    undecided = F.col("resolved_at").isNull() & F.col("disposition").isNull()
    critical = (
        exceptions.where((F.col("severity") == "CRITICAL") & undecided)
        .select(F.col("domain").alias("product"))
        .distinct()
        .withColumn("_critical", F.lit(True))
    )
    overruled = F.col("_critical") & (F.col("rag") == "GREEN")
    return (
        rated.join(critical, "product", "left")
        .withColumn("rag", F.when(overruled, "AMBER").otherwise(F.col("rag")))
        .drop("_critical")
    )


# --- rules and evidence ---------------------------------------------------------------------------


def rule_version_at(evaluations: DataFrame, versions: DataFrame) -> DataFrame:
    """Each evaluation with the rule version in effect on its day.

    `versions`: rule_id, version, effective_from, effective_to (exclusive; NULL while current).
    """
    day = F.col("evaluation_day")
    v = versions.withColumnRenamed("rule_id", "_rule")
    in_effect = (day >= F.col("effective_from")) & (F.col("effective_to").isNull() | (day < F.col("effective_to")))
    return evaluations.join(v, (F.col("rule_id") == F.col("_rule")) & in_effect, "left").drop(
        "_rule", "effective_from", "effective_to"
    )


def schema_contract(df: DataFrame, contract: dict[str, tuple[str, bool]]) -> DataFrame:
    """Contracted and actual columns side by side, with the NULLs found.

    `contract` gives each column's type and whether it may be NULL. Findings: OK, MISSING, EXTRA,
    TYPE_CHANGED, NULLS_FOUND.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    rows = []
    for name in dict.fromkeys([*contract, *actual]):
        expected, nullable = contract.get(name, (None, True))
        nulls = F.count_if(F.col(name).isNull()) if name in actual else F.lit(0).cast("bigint")
        if name not in actual:
            finding = F.lit("MISSING")
        elif name not in contract:
            finding = F.lit("EXTRA")
        elif actual[name] != expected:
            finding = F.lit("TYPE_CHANGED")
        elif nullable:
            finding = F.lit("OK")
        else:
            finding = F.when(nulls > 0, "NULLS_FOUND").otherwise("OK")
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(expected).cast("string").alias("expected_type"),
                F.lit(actual.get(name)).cast("string").alias("actual_type"),
                nulls.alias("null_count"),
                finding.alias("finding"),
            )
        )
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


#: Parts each rule's failing rows are split into before their samples are merged.
_SAMPLE_PARTS = 256


def masked_samples(df: DataFrame, conditions: dict[str, str], key: str, size: int, secret: str) -> DataFrame:
    """Keyed digests of up to `size` failing rows per rule, as evidence without raw identifiers.

    Without `secret` no one can recompute a reference. No output holds it, but the query plan does, and with it
    plan listings and event logs. The sample is the smallest
    digests, so it is the same on every run. They are taken in parts of each rule first, so that a rule
    nearly every row fails is never one task's work, whatever the size.
    """
    failing = F.filter(
        F.array(*[F.when(~F.expr(c), F.lit(rule)) for rule, c in conditions.items()]), lambda r: r.isNotNull()
    )
    inner = F.sha2(F.concat(F.lit(secret), F.col(key).cast("string")), 256)
    masked = df.select(
        F.explode(failing).alias("rule_id"), F.sha2(F.concat(F.lit(secret), inner), 256).alias("record_reference")
    ).withColumn("_part", F.pmod(F.xxhash64("record_reference"), F.lit(_SAMPLE_PARTS)))
    in_part = F.row_number().over(W.partitionBy("rule_id", "_part").orderBy("record_reference"))
    least = masked.withColumn("_no", in_part).where(F.col("_no") <= size)
    place = F.row_number().over(W.partitionBy("rule_id").orderBy("record_reference"))
    return least.select("rule_id", "record_reference").withColumn("sample_no", place).where(F.col("sample_no") <= size)
