"""The control suite (Q1-Q12): datasets are measured first, then all controls judge the one row of measures."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.functions.parsing import utc_stamp
from plumbline.functions.text import is_blank
from plumbline.sources.contracts import CLEAN_COLUMNS, Policy, missing_columns, required_columns

_VALUE = "decimal(38,2)"


class GateFailed(RuntimeError):
    """At least one control failed; nothing is published."""


# --- measures -------------------------------------------------------------------------------------


def blank_cells(dataset: str) -> Column:
    """Blank required cells of a clean dataset (Q2)."""
    cells = [is_blank(F.col(n), kind == "string").cast("int") for n, kind in CLEAN_COLUMNS[dataset].items()]
    total = cells[0]
    for cell in cells[1:]:
        total = total + cell
    return F.coalesce(F.sum(total), F.lit(0))


def duplicate_rows(*keys: str | Column) -> Column:
    """Rows beyond the first of each key (A14, Q3). NULL keys count as one key.

    Keep it apart from other measures: a distinct count shuffles every key, and would carry them along.
    """
    return F.count("*") - F.count_distinct(F.struct(*keys))


def out_of_range(amount: Column, policy: Policy) -> Column:
    """Amounts outside 0 < amount <= limit, NULL included."""
    valid = (amount > 0) & (amount <= F.lit(policy.max_amount))
    return F.count_if(~F.coalesce(valid, F.lit(False)))


def outside_domains(**domains: tuple[str, ...]) -> Column:
    """Rows with any column outside its domain, NULL included."""
    valid = F.lit(True)
    for name, allowed in domains.items():
        valid = valid & F.coalesce(F.col(name).isin(*allowed), F.lit(False))
    return F.count_if(~valid)


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """One row, `orphans`: child rows whose key the parent lacks; NULL keys are orphans.

    Child rows are counted per key first and parent keys made distinct, both partly before their shuffle,
    so a hot key on either side is one row by the time the join sees it.
    """
    per_key = child.groupBy(F.col(column).alias("_key")).agg(F.count("*").alias("_rows"))
    keys = parent.select(F.col(parent_column).alias("_key")).distinct()
    return per_key.join(keys, "_key", "left_anti").agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphans"))


def _measure(df: DataFrame, **measures: Column) -> DataFrame:
    """One aggregation over `df`, as rows of (measure, value)."""
    one_row = df.agg(*[c.cast(_VALUE).alias(name) for name, c in measures.items()])
    return one_row.unpivot([], list(measures), "measure", "value")


def measure_datasets(clean: dict[str, DataFrame], raw_orders: DataFrame, policy: Policy) -> DataFrame:
    """Rows of (measure, value). Row-level measures are one scan per clean dataset and shuffle a row per
    task; the two duplicate counts and the orphan count then read only their key columns."""
    customers, orders, controls = clean["customers"], clean["sales_orders"], clean["gl_controls"]
    frames = [
        _measure(
            customers,
            rows_customers=F.count("*"),
            null_customers=blank_cells("customers"),
            enum_customers=outside_domains(segment=policy.segments, status=policy.statuses),
        ),
        _measure(
            orders,
            rows_sales_orders=F.count("*"),
            null_sales_orders=blank_cells("sales_orders"),
            range_orders=out_of_range(F.col("order_amount"), policy),
            enum_orders=outside_domains(category=policy.categories, currency=policy.currencies),
            amount_orders=F.coalesce(F.sum("order_amount"), F.lit(0)),
        ),
        _measure(
            controls,
            rows_gl_controls=F.count("*"),
            null_gl_controls=blank_cells("gl_controls"),
            count_controls=F.coalesce(F.sum("order_count"), F.lit(0)),
            amount_controls=F.coalesce(F.sum("order_amount"), F.lit(0)),
        ),
        _measure(customers, dup_customers=duplicate_rows("customer_id")),
        _measure(orders, dup_sales_orders=duplicate_rows("order_id")),
        _measure(orphan_rows(orders, "customer_id", customers, "customer_id"), orphan_orders=F.max("orphans")),
        _measure(raw_orders, rows_raw_orders=F.count("*")),
    ]
    measured = frames[0]
    for frame in frames[1:]:
        measured = measured.unionByName(frame)
    return measured


# --- outcomes -------------------------------------------------------------------------------------


def _outcome(check_id: str, status: Column, observed: Column, expected: Column, detail: str | Column) -> Column:
    """One check result (Q11)."""
    return F.struct(
        F.lit(check_id).alias("check_id"),
        status.alias("status"),
        observed.cast("string").alias("observed"),
        expected.cast("string").alias("expected"),
        (F.lit(detail) if isinstance(detail, str) else detail).alias("detail"),
    )


def _status(passed: Column, violations: Column | None = None, warn_limit: int = 0) -> Column:
    status = F.when(passed, "PASS")
    if violations is not None and warn_limit:
        status = status.when(violations <= warn_limit, "WARN")
    return status.otherwise("FAIL")


def _plain(number: Column) -> Column:
    """Decimal text without trailing zeros."""
    return F.regexp_replace(number.cast("decimal(38,6)").cast("string"), r"\.?0+$", "")


def _measure_outcomes(raw_columns: dict[str, list[str]], policy: Policy) -> list[Column]:
    """Outcomes of every check that rests on the measures, as columns over their one wide row."""
    whole = lambda name: F.col(name).cast("bigint")

    def none_allowed(check_id: str, violations: Column, detail: str) -> Column:
        status = _status(violations == 0, violations, policy.warn_limit.get(check_id, 0))
        return _outcome(check_id, status, violations, F.lit("0"), detail)

    def equal(check_id: str, observed: Column, expected: Column, detail: str) -> Column:
        gap = F.abs(observed - expected)
        status = _status(gap == 0, gap, policy.warn_limit.get(check_id, 0))
        return _outcome(check_id, status, observed, expected, detail)

    outcomes = []
    for dataset in CLEAN_COLUMNS:
        required = required_columns(dataset)
        missing = missing_columns(raw_columns[dataset], dataset)
        observed = f"missing: {', '.join(missing)}" if missing else ", ".join(required)
        outcomes.append(
            _outcome(
                f"REQ_{dataset.upper()}",
                F.lit("FAIL" if missing else "PASS"),
                F.lit(observed),
                F.lit("all required columns present"),
                "Validated at ingestion",
            )
        )
        nulls = whole(f"null_{dataset}")
        limit = F.col(f"rows_{dataset}") * F.lit(policy.null_threshold.get(dataset, 0)).cast("decimal(9,6)") * len(required)
        check_id = f"NULL_{dataset.upper()}"
        status = _status(nulls <= limit, nulls, policy.warn_limit.get(check_id, 0))
        limit_text = F.concat(F.lit("<= "), _plain(limit))
        outcomes.append(_outcome(check_id, status, nulls, limit_text, "Required-field null values"))

    outcomes += [
        none_allowed("DUP_CUSTOMERS", whole("dup_customers"), "Duplicate customer_id values"),
        none_allowed("DUP_SALES_ORDERS", whole("dup_sales_orders"), "Duplicate order_id values"),
        none_allowed(
            "RANGE_ORDER_AMOUNT", whole("range_orders"), f"Amount must be > 0 and <= {policy.max_amount:,}"
        ),
        none_allowed(
            "VALID_ENUMS",
            whole("enum_customers") + whole("enum_orders"),
            "Approved segment, status, category, and currency values",
        ),
        none_allowed("FK_ORDER_CUSTOMER", whole("orphan_orders"), "Every order customer exists in customer master"),
        equal("RECON_ROW_COUNT", whole("rows_sales_orders"), whole("rows_raw_orders"), "Raw-to-clean sales order count"),
        equal("RECON_ORDER_COUNT", whole("rows_sales_orders"), whole("count_controls"), "Sales orders versus GL control count"),
        equal("RECON_ORDER_VALUE", F.col("amount_orders"), F.col("amount_controls"), "Sales orders versus GL control amount"),
    ]
    return outcomes


def freshness(file_ages: DataFrame, policy: Policy) -> DataFrame:
    """FRESH_RAW_EXTRACTS over one row per raw file (Q7). No files at all fail.

    An extract that is a folder of files counts with its oldest file.
    """
    oldest = F.max("age_days")
    quoted = F.regexp_replace(F.to_json(F.array("file_name")), r"\]$", "")
    pair = F.concat(quoted, F.lit(", "), F.col("age_days").cast("string"), F.lit("]"))
    # One entry per extract, however many files it has.
    listing = F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list(pair)), ", "), F.lit("]"))
    outcome = _outcome(
        "FRESH_RAW_EXTRACTS",
        F.when(oldest <= policy.max_age_days, "PASS").otherwise("FAIL"),
        F.coalesce(F.concat(oldest.cast("string"), F.lit(" days")), F.lit("no files")),
        F.lit(f"<= {policy.max_age_days} days"),
        listing,
    )
    extracts = file_ages.groupBy(F.substring_index("file_name", "/", 1).alias("file_name")).agg(oldest.alias("age_days"))
    return extracts.agg(F.array(outcome).alias("outcomes")).select(F.inline("outcomes"))


def check_suite(
    clean: dict[str, DataFrame],
    raw: dict[str, DataFrame],
    evaluated_at: datetime,
    policy: Policy = Policy(),
    file_ages: DataFrame | None = None,
    raw_columns: dict[str, list[str]] | None = None,
) -> DataFrame:
    """One row per control. `file_ages` adds the file freshness control; `raw_columns` are the columns the
    extracts came with, where `raw` had missing ones filled in."""
    raw_columns = raw_columns or {name: frame.columns for name, frame in raw.items()}
    measured = measure_datasets(clean, raw["sales_orders"], policy)
    names = [f"{kind}_{dataset}" for dataset in CLEAN_COLUMNS for kind in ("rows", "null")] + [
        "dup_customers", "dup_sales_orders", "range_orders", "enum_customers", "enum_orders",
        "amount_orders", "count_controls", "amount_controls", "orphan_orders", "rows_raw_orders",
    ]
    wide = measured.agg(*[F.max(F.when(F.col("measure") == n, F.col("value"))).alias(n) for n in names])
    outcomes = wide.select(F.inline(F.array(*_measure_outcomes(raw_columns, policy))))
    if file_ages is not None:
        outcomes = outcomes.unionByName(freshness(file_ages, policy))
    return outcomes.withColumn("evaluated_at_utc", utc_stamp(evaluated_at))


def gate(checks: DataFrame) -> None:
    """Raise if any control failed (Q12). Persist the checks first, so a failure leaves its evidence."""
    failed = [row["check_id"] for row in checks.where("status = 'FAIL'").select("check_id").collect()]
    if failed:
        raise GateFailed(f"controls failed: {', '.join(sorted(failed))}")
