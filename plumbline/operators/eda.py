"""Descriptive statistics of the star orders."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from plumbline.functions.numeric import ratio
from plumbline.operators.quantiles import exact_percentiles


def _is_floating(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType))


def _missing(df: DataFrame, column: str) -> Column:
    """NULL, and in floating columns NaN."""
    return F.col(column).isNull() | F.isnan(column) if _is_floating(df, column) else F.col(column).isNull()


def _scale(df: DataFrame, column: str) -> int:
    kind = df.schema[column].dataType
    return kind.scale if isinstance(kind, T.DecimalType) else 0


def _exact(df: DataFrame, column: str) -> str:
    """Type that holds quartiles and fences of the column: quarters add two decimals, half of them one more."""
    return "double" if _is_floating(df, column) else f"decimal(38,{_scale(df, column) + 3})"


def revenue_by(orders: DataFrame, attribute: str) -> DataFrame:
    """Revenue and orders by an attribute, highest first; orders without it are left out."""
    return (
        orders.where(F.col(attribute).isNotNull())
        .groupBy(attribute)
        .agg(F.sum("order_amount").alias("revenue_usd"), F.count("order_id").alias("orders"))
        .orderBy(F.desc("revenue_usd"), attribute)
    )


def revenue_by_dimension(fact: DataFrame, dimension: DataFrame, key: str, attribute: str) -> DataFrame:
    """`revenue_by` straight from the fact, summed per dimension key before the join."""
    per_key = fact.groupBy(key).agg(
        F.sum("order_amount").alias("_revenue"), F.count("order_id").alias("_orders")
    )
    return (
        per_key.join(dimension.select(key, attribute), key)
        .where(F.col(attribute).isNotNull())
        .groupBy(attribute)
        .agg(F.sum("_revenue").alias("revenue_usd"), F.sum("_orders").alias("orders"))
        .orderBy(F.desc("revenue_usd"), attribute)
    )


def missing_values(df: DataFrame) -> DataFrame:
    """NULLs and NaNs per column, and over all columns as '(total)' (A18). Blank text is not missing."""
    counts = df.agg(*[F.count_if(_missing(df, c)).alias(c) for c in df.columns])
    total = sum((F.col(c) for c in df.columns), F.lit(0))
    return counts.withColumn("(total)", total).unpivot([], [*df.columns, "(total)"], "column_name", "missing")


def quartiles(df: DataFrame, column: str) -> dict[str, Decimal | float | None]:
    """Quartiles, their range and the 1.5 IQR fences."""
    q1, median, q3 = exact_percentiles(df, column, ["0.25", "0.5", "0.75"])
    if q1 is None:
        return dict.fromkeys(["q1", "median", "q3", "iqr", "lower_fence", "upper_fence"])
    reach = type(q1)("1.5") * (q3 - q1)
    return {
        "q1": q1, "median": median, "q3": q3, "iqr": q3 - q1, "lower_fence": q1 - reach, "upper_fence": q3 + reach,
    }


def outliers(df: DataFrame, column: str) -> DataFrame:
    """Rows outside the fences."""
    fences = quartiles(df, column)
    value, kind = F.col(column), _exact(df, column)
    outside = (value < F.lit(fences["lower_fence"]).cast(kind)) | (value > F.lit(fences["upper_fence"]).cast(kind))
    return df.where(~_missing(df, column) & outside)


def distribution(df: DataFrame, column: str) -> DataFrame:
    """One row: rows, total, quartiles, fences and outlier count."""
    stats = {name: F.lit(v).cast(_exact(df, column)) for name, v in quartiles(df, column).items()}
    value = F.when(~_missing(df, column), F.col(column))
    outside = (value < stats["lower_fence"]) | (value > stats["upper_fence"])
    return df.agg(
        F.count("*").alias("orders"),
        F.sum(value).alias("total"),
        F.count_if(outside).alias("outliers"),
    ).select("orders", "total", *[c.alias(name) for name, c in stats.items()], "outliers")


def correlation(df: DataFrame) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, three digits, one row per pair.

    NULL where a column does not vary. A pair counts the rows that have both values, NaN being none. Each
    unordered pair is computed once.
    """
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    rows = []
    for i, x in enumerate(numeric):
        for y in numeric[i:]:
            a = F.when(~_missing(df, x) & ~_missing(df, y), F.col(x).cast("double"))
            b = F.when(~_missing(df, x) & ~_missing(df, y), F.col(y).cast("double"))
            spread = F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0))
            value = F.when(spread.isNotNull(), 1.0) if x == y else F.round(F.covar_pop(a, b) / spread, 3) + 0.0
            for left, right in {(x, y), (y, x)}:
                names = F.lit(left).alias("column_x"), F.lit(right).alias("column_y")
                rows.append(F.struct(*names, value.alias("correlation")))
    return df.agg(F.array(*rows).alias("pairs")).select(F.inline("pairs"))


def histogram(df: DataFrame, column: str, max_bins: int = 6) -> DataFrame:
    """Counts in min(max_bins, rows) bins of equal width, the last one closed (A23); empty bins count 0.

    Equal values throughout get a range of one half to either side. NULL and NaN are in no bin.
    """
    floating, scale = _is_floating(df, column), _scale(df, column)
    kind = "double" if floating else f"decimal({max(20, scale + 16)},{max(scale, 1)})"
    df = df.where(~_missing(df, column))
    value, half = F.col(column).cast(kind), F.lit(0.5 if floating else Decimal("0.5"))
    stats = df.agg(
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        F.least(F.lit(max_bins), F.count(column)).cast("int").alias("bins"),
    ).withColumns(
        {
            "low": F.when(F.col("low") == F.col("high"), F.col("low") - half).otherwise(F.col("low")),
            "high": F.when(F.col("low") == F.col("high"), F.col("high") + half).otherwise(F.col("high")),
        }
    )
    # The one-row statistics as a scalar subquery, evaluated once and read by every row.
    placed = df.select(
        value.alias("v"), stats.select(F.struct("low", "high", "bins")).scalar().alias("s")
    )
    width = F.col("s.high") - F.col("s.low")
    along = (F.col("v") - F.col("s.low")) * F.col("s.bins")
    place = F.floor(along / width) if floating else F.call_function("div", along, width)
    bin_of = F.least(place, F.col("s.bins") - 1)
    counts = placed.groupBy(bin_of.cast("int").alias("bin")).agg(F.count("*").alias("n"))

    def edge(i):
        sums = F.col("low") * (F.col("bins") - i) + F.col("high") * i
        return sums / F.col("bins") if floating else ratio(sums, F.col("bins"), digits=max(4, scale + 2), scale=max(4, scale))

    frame = stats.where("bins > 0").select(
        "low", "high", "bins", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin")
    )
    return frame.join(counts, "bin", "left").select(
        "bin",
        edge(F.col("bin")).alias("lower_edge"),
        edge(F.col("bin") + 1).alias("upper_edge"),
        F.coalesce("n", F.lit(0)).alias("orders"),
    )


def headline(orders: DataFrame, checks: DataFrame) -> DataFrame:
    """One row: orders, total value, and passed of all checks."""
    passed = checks.agg(
        F.struct(F.count_if(F.col("status") == "PASS").alias("passed"), F.count("*").alias("total"))
    ).scalar()
    sales = orders.agg(F.count("*").alias("orders"), F.sum("order_amount").alias("total_usd"))
    return sales.withColumn("_checks", passed).select(
        "orders", "total_usd", F.col("_checks.passed").alias("checks_passed"), F.col("_checks.total").alias("checks_total")
    )


def volumes(raw: dict[str, DataFrame], clean: dict[str, DataFrame]) -> DataFrame:
    """Raw and clean rows per dataset."""
    counted = None
    for stage, frames in (("raw", raw), ("clean", clean)):
        for name, df in frames.items():
            part = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("dataset"), F.lit(stage).alias("stage"), "n")
            counted = part if counted is None else counted.unionByName(part)
    pick = lambda stage: F.sum(F.when(F.col("stage") == stage, F.col("n")))
    return counted.groupBy("dataset").agg(pick("raw").alias("raw_rows"), pick("clean").alias("clean_rows"))
