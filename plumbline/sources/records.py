"""CSV whose quoted values hold line breaks, read by as many tasks as its files have blocks.

Whether a line begins inside quotes depends on all lines before it. A line turns that state into the one it ends with:
it leaves it as it is, flips it, or ends in one state whatever came before. Such steps can be put together, so each
block of a file is first summed up on its own, the few sums are carried along the file in order, and only then does every
line get its state, its record, and the records that span lines their text. Only lines of those are gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from plumbline.sources.contracts import ContractError

#: A value in quotes with inner ones doubled, or one that doesn't begin with a quote.
VALUE = r'(?:"(?:[^"]++|"")*+" *+|(?:[^",][^,]*+)?+)'
#: What follows a quote that opens a value, up to the end of a whole record.
_CLOSED = rf'(?:[^"]++|"")*+" *+(?:,{VALUE})*+'
RECORD = rf"\A{VALUE}(?:,{VALUE})*+\r?\z"
_REST = rf"\A{_CLOSED}\r?\z"

#: Lines that one record may span. A quote that is never closed would gather the rest of its file.
MOST_LINES = 100_000


def _matches(text: Column, pattern: str) -> Column:
    return F.rlike(text, F.lit(pattern))


def _carried(rows: DataFrame, window, zero: Column, one: Column) -> DataFrame:
    """`zero` and `one`: the state after each row of an ordered window, if that began with state 0, or 1.

    They are given as what each row alone makes of the two states.
    """
    flips = F.sum(F.when((zero == 1) & (one == 0), 1).otherwise(0)).over(window)
    rows = rows.withColumns({"_zero": zero, "_one": one}).withColumn("_flips", flips)
    fixed = F.when(F.col("_zero") == F.col("_one"), F.struct(F.col("_zero").alias("state"), F.col("_flips").alias("flips")))
    rows = rows.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(window))

    def after(start: int) -> Column:
        since = F.col("_fixed.state") + F.col("_flips") - F.col("_fixed.flips")
        return F.pmod(F.when(F.col("_fixed").isNull(), F.col("_flips") + start).otherwise(since), F.lit(2)).cast("int")

    return rows.withColumns({"zero": after(0), "one": after(1)}).drop("_zero", "_one", "_flips", "_fixed")


def _lines(spark: SparkSession, path: str, materialize) -> DataFrame:
    """Lines with their place (file, block, id), and the state before and after them for either state of the block."""
    text = F.col("value")
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("id"),
            text.alias("line"),
        )
        .withColumn("zero", F.when(_matches(F.col("line"), RECORD), 0).otherwise(1))
        .withColumn("one", F.when(F.col("line").contains('"') & _matches(F.col("line"), _REST), 0).otherwise(1))
    )
    ordered = W.partitionBy("file", "block").orderBy("id")
    upto = ordered.rowsBetween(W.unboundedPreceding, 0)
    lines = _carried(lines, upto, F.col("zero"), F.col("one"))
    for start, name in enumerate(("zero", "one")):
        lines = lines.withColumn(f"before_{name}", F.coalesce(F.lag(name).over(ordered), F.lit(start)))
        lines = lines.withColumn(f"records_{name}", F.sum(1 - F.col(f"before_{name}")).over(upto))
    return materialize(lines, "csv-lines")


def _blocks(lines: DataFrame, materialize) -> DataFrame:
    """One row per block: the state it begins with, the records before it, and the state its file ends with."""
    last = F.struct("id", "zero", "one", "records_zero", "records_one")
    sums = materialize(lines.groupBy("file", "block").agg(F.max(last).alias("last")).select("file", "block", "last.*"), "csv-blocks")
    along = W.partitionBy("file").orderBy("block")  # a row a block
    upto = along.rowsBetween(W.unboundedPreceding, 0)
    sums = _carried(sums.withColumns({"all_zero": F.col("records_zero"), "all_one": F.col("records_one")}), upto, F.col("zero"), F.col("one"))
    sums = sums.withColumn("begins", F.coalesce(F.lag("zero").over(along), F.lit(0)))
    mine = F.when(F.col("begins") == 0, F.col("all_zero")).otherwise(F.col("all_one"))
    ends = F.last("zero").over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    sums = sums.withColumns({"earlier": F.sum(mine).over(upto) - mine, "ends": ends})
    return materialize(sums.select("file", "block", "begins", "earlier", "ends"), "csv-starts")


def records(spark: SparkSession, path: str, materialize) -> DataFrame:
    """file, number (from 1, in the order of the file) and text of every record, the header included."""
    lines = _lines(spark, path, materialize)
    starts = _blocks(lines, materialize)
    open_ = starts.where("ends = 1").select("file").first()
    if open_ is not None:
        raise ContractError(f"a quote is never closed in {open_.file}")
    of_block = lambda name: F.when(F.col("begins") == 0, F.col(f"{name}_zero")).otherwise(F.col(f"{name}_one"))
    placed = lines.join(starts, ["file", "block"]).select(
        "file",
        "id",
        "line",
        (F.col("earlier") + of_block("records")).alias("number"),
        of_block("before").alias("before"),
        F.when(F.col("begins") == 0, F.col("zero")).otherwise(F.col("one")).alias("after"),
    )
    spans = (F.col("before") == 1) | (F.col("after") == 1)
    several = materialize(placed.where(spans).select("file", "number", "id", "line"), "csv-spans")
    long_ = several.groupBy("file", "number").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MOST_LINES).first()
    if long_ is not None:
        raise ContractError(f"record {long_.number} of {long_.file} spans {long_.n} lines; is a quote missing?")
    held = F.array_sort(F.collect_list(F.struct("id", "line")))
    joined = several.groupBy("file", "number").agg(F.concat_ws("\n", F.transform(held, lambda x: x["line"])).alias("text"))
    broken = joined.where(~_matches(F.col("text"), RECORD)).select("file", "number").first()
    if broken is not None:
        raise ContractError(f"record {broken.number} of {broken.file} has a misplaced quote")
    single = placed.where(~spans).select("file", "number", F.col("line").alias("text"))
    return single.unionByName(joined).withColumn("text", F.regexp_replace("text", r"\r\z", ""))


def read_records(spark: SparkSession, path: str, materialize) -> DataFrame:
    """CSV files with the same header, every column text. Empty lines between records do not count."""
    found = records(spark, path, materialize)
    headers = [r.text.removeprefix("﻿") for r in found.where("number = 1").select("text").distinct().limit(2).collect()]
    if not headers:
        raise ContractError(f"no header in {path}")
    if len(headers) > 1:
        raise ContractError(f"files of {path} have different headers")
    header = spark.range(1).select(F.lit(headers[0]).alias("text"))
    width = len(headers[0].split(",")) + 1
    first = header.select(F.from_csv("text", ", ".join(f"c{i} string" for i in range(width)), {"escape": '"'}).alias("r")).first().r
    names = list(first)
    while names and names[-1] is None:
        names.pop()
    names = [name if name is not None else f"_c{i}" for i, name in enumerate(names)]
    if len({name.lower() for name in names}) < len(names):
        raise ContractError(f"a column comes twice in {path}: {names}")
    ddl = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    parsed = F.from_csv("text", ddl, {"escape": '"', "multiLine": "true"})
    return found.where("number > 1 AND text <> ''").select(parsed.alias("r")).select("r.*")
