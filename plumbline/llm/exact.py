"""Exact dedup by content sort, with DataFrame operations only.

Sampled splitters deal the normalised bytes out to ranges, an external sort places equal texts beside each other, and
every row is compared in full with its neighbours. The order is by leading bytes, then digest, then the identifier that
decides who stays, so that equal texts are adjacent and a group of any size runs on over as many ranges as it needs:
no range ever has to hold a whole group.

Defined results: a null text is empty; a null identifier is smaller than any other; of repeated rows with the same
identifier and text exactly one stays; an empty table gives an empty result; other columns pass through as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.llm.common import Scratch, packed, partitions, whole

#: Leading bytes of a text that its sort key holds.
LEAD = 24
#: Ranges for each shuffle partition, and sampled rows for each range.
RANGES, SAMPLED = 4, 40


def _key(body: Column, ident: Column, keep: str) -> Column:
    """Sort key as hex text: leading bytes, digest, identifier. The row that stays comes last among equals."""
    ident = ident.cast("long").bitwiseXOR(F.lit(-(2**63) if keep == "largest" else 2**63 - 1))
    return F.concat(
        F.rpad(F.hex(F.substring(body, 1, LEAD)), 2 * LEAD, "0"),
        F.sha2(body, 256),
        F.coalesce(F.lpad(F.hex(ident), 16, "0"), F.lit("")),
    )


def _splitters(docs: DataFrame, key: Column, ranges: int) -> list[str]:
    """At most `ranges` - 1 keys at even distances in a sample of `SAMPLED` rows a range."""
    total = docs.count()
    if total == 0 or ranges < 2:
        return []
    sample = docs.sample(min(1.0, SAMPLED * ranges / total), seed=11).select(key.alias("key"))
    parts = sample.select("key", F.ntile(ranges).over(Window.orderBy("key")).alias("part"))
    return sorted({r[0] for r in parts.groupBy("part").agg(F.min("key")).where("part > 1").select("min(key)").collect()})


def _range_of(key: Column, splitters: list[str]) -> Column:
    """Number of splitters that are not above the key, by binary search."""
    if not splitters:
        return F.lit(0)
    held = F.split(F.lit(",".join(splitters)), ",")

    def step(state: Column, _: Column) -> Column:
        middle = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
        below = F.get(held, middle) <= key
        open_ = state["lo"] < state["hi"]
        return F.struct(
            F.when(open_ & below, middle + 1).otherwise(state["lo"]).alias("lo"),
            F.when(open_ & ~below, middle).otherwise(state["hi"]).alias("hi"),
        )

    steps = len(splitters).bit_length() + 1
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(splitters)).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)["lo"]


def content_sort(docs: DataFrame, scratch: Scratch, payload: Column, id_col: str, text_col: str, keep: str) -> DataFrame:
    """Rows with their range, their run of equal texts in it, and what `_borders` needs at the ends of ranges."""
    spark = docs.sparkSession
    body = whole(text_col).cast("binary")
    ranges = RANGES * partitions(spark)
    key = _key(body, F.col(f"`{id_col}`"), keep)
    splitters = _splitters(docs, key, ranges)
    keyed = docs.select(
        payload.alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), body.alias("body"), key.alias("key")
    ).withColumn("range", _range_of(F.col("key"), splitters))
    order = Window.partitionBy("range").orderBy("key", "body")
    compared = keyed.select(
        "row",
        "id",
        "range",
        "body",
        F.substring("key", 2 * LEAD + 1, 64).alias("digest"),
        F.row_number().over(order).alias("at"),
        (F.lag("body").over(order) == F.col("body")).alias("like_last"),
        (F.lead("body").over(order) == F.col("body")).alias("like_next"),
    )
    runs = F.sum(F.when(F.col("like_last"), 0).otherwise(1)).over(
        Window.partitionBy("range").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    )
    return scratch.keep(
        compared.select(
            "row",
            "id",
            "range",
            "digest",
            "like_next",
            runs.alias("run"),
            (F.col("at") == 1).alias("first"),
            F.col("like_next").isNull().alias("last"),
            F.when((F.col("at") == 1) | F.col("like_next").isNull(), F.col("body")).alias("border"),
        ),
        "sorted",
    )


def _borders(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per range: its runs, whether its first text goes on from the range before, and its last into the next."""
    ends = rows.where("first OR last").groupBy("range").agg(
        F.max(F.when(F.col("first"), F.col("border"))).alias("head"),
        F.max(F.when(F.col("last"), F.col("border"))).alias("tail"),
        F.max("run").alias("runs"),
    )
    ends = scratch.keep(ends, "ends")
    line = Window.orderBy("range")  # one small row per range
    beside = ends.select("range", "runs", F.lag("range").over(line).alias("before"))
    tails = ends.select(F.col("range").alias("before"), "tail")
    heads = ends.select("range", "head")
    joined = beside.join(tails, "before", "left").join(heads, "range").select(
        "range", "runs", F.coalesce(F.col("tail") == F.col("head"), F.lit(False)).alias("goes_on")
    )
    anchor = F.when((F.col("runs") > 1) | ~F.col("goes_on"), F.struct("range", "runs"))
    return scratch.keep(
        joined.select(
            "range",
            "goes_on",
            F.max(anchor).over(line.rowsBetween(Window.unboundedPreceding, -1)).alias("origin"),
            F.coalesce(F.lead("goes_on").over(line), F.lit(False)).alias("into_next"),
        ),
        "borders",
    )


def _decided(rows: DataFrame, borders: DataFrame) -> DataFrame:
    """Rows with `kept`: the last row of its group of equals."""
    ends = borders.select(F.col("range").alias("end_range"), "into_next")
    at_end = (rows["range"] == F.col("end_range")) & rows["last"]
    return rows.join(ends, at_end, "left").withColumn("kept", ~F.coalesce(F.col("like_next"), F.col("into_next"), F.lit(False)))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    `keep` is "largest" or "smallest": which identifier of a group of equal texts stays.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    rows = content_sort(docs, scratch, F.lit(None).cast("string"), id_col, text_col, keep)
    borders = _borders(rows, scratch)
    best = F.max if keep == "largest" else F.min
    runs = rows.groupBy("range", "run").agg(F.count(F.lit(1)).alias("n"), best("id").alias("best"))
    goes_on = F.col("goes_on") & (F.col("run") == 1)
    runs = runs.join(borders.drop("into_next"), "range").select(
        "range",
        "run",
        "n",
        "best",
        F.when(goes_on, F.col("origin.range")).otherwise(F.col("range")).alias("group_range"),
        F.when(goes_on, F.col("origin.runs")).otherwise(F.col("run")).alias("group_run"),
    )
    sums = runs.groupBy("group_range", "group_run").agg(F.sum("n").alias("group_size"), best("best").alias("keep_id"))
    sums = runs.join(sums, ["group_range", "group_run"]).select("range", "run", "group_size", "keep_id")
    return (
        _decided(rows, borders)
        .join(sums, ["range", "run"])
        .select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    scratch = Scratch(docs.sparkSession, "exact")
    rows = content_sort(docs, scratch, packed(docs), id_col, text_col, keep)
    return _decided(rows, _borders(rows, scratch)).where("kept").select("row.*")
