"""Dense surrogate keys without putting all rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from plumbline.sources.files import append_governed, materialize, read_governed

# monotonically_increasing_id keeps the partition number above bit 33 and the row's place below it.
_PLACE_BITS = 33


def add_dense_key(df: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """Add `key` = 1, 2, 3, ... in the order of `order_by`.

    Rows are range-partitioned and sorted, each takes its place within its partition, and the partitions'
    row counts give where each one starts. Only those counts, one row per partition, meet in one task.
    Rows equal in every ordering column are spread by a random tie-break, so copies cannot pile up in one
    partition. The input is written first: sampling the range bounds reads it a second time, and the
    tie-break of a task that runs again has to fall the same. The ranged rows are written too, as both
    uses have to see the same bounds.
    """
    df = materialize(df, f"{key}-input")
    ranged = (
        df.withColumn("_tie", F.rand(17))
        .repartitionByRange(*order_by, "_tie")
        .sortWithinPartitions(*order_by, "_tie")
        .drop("_tie")
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    ranged = materialize(ranged, key).withColumns(
        {
            "_part": F.shiftright("_slot", _PLACE_BITS),
            "_place": F.col("_slot").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)),
        }
    )
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_rows"))
    starts = sizes.select(
        "_part", (F.sum("_rows").over(W.orderBy("_part")) - F.col("_rows")).alias("_start")
    )
    # One row per partition, so the broadcast is bounded by the number of partitions.
    return ranged.join(F.broadcast(starts), "_part").select(
        (F.col("_start") + F.col("_place") + 1).alias(key), *df.columns
    )


def add_ordered_key(df: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """Add a unique number that ascends with `order_by`, with gaps between partitions.

    Nothing is written and nothing counted: rows are ranged and sorted, and partition and place make up the number.
    """
    columns = df.columns
    ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    return ranged.select((F.monotonically_increasing_id() + 1).alias(key), *[F.col(f"`{name}`") for name in columns])


def keep_keys(found: DataFrame, path: str, key: str, by: str) -> DataFrame:
    """The stored map (`by`, `key`) at `path`, after business keys it does not have were numbered on and appended.

    A key once given stays: only unseen business keys are numbered, in their order, from the last number on. NULL is a
    business key like any other. What a run appends shows as a whole or not at all; one run at a time may append.
    """
    spark = found.sparkSession
    schema = found.select(F.col(f"`{by}`").alias(by)).withColumn(key, F.lit(0).cast("bigint")).schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    known = read_governed(spark, path, ddl)
    seen = known.select(F.col(by).alias("_seen"))
    unseen = materialize(found.select(by).distinct().join(seen, F.col(by).eqNullSafe(F.col("_seen")), "left_anti"), f"unseen-{by}")
    if unseen.limit(1).count():
        last = known.agg(F.max(key)).first()[0] or 0
        append_governed(add_dense_key(unseen, key, [by]).select(by, (F.col(key) + last).alias(key)), path)
    return read_governed(spark, path, ddl)
