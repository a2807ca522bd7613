"""Readers and writers."""

from __future__ import annotations

import re
import tempfile
import uuid
from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.sources import records
from plumbline.sources.contracts import CLEAN_COLUMNS, ContractError, missing_columns

def read_raw(spark: SparkSession, path: str, one_line: bool = False, split: bool = False) -> DataFrame:
    """CSV with a header as it is, every column text.

    A quoted value may hold line breaks, so by default a file is read by one task, which suits extracts that come as a
    folder of files. `split` deals large files out to many tasks and finds their records there. With `one_line`, for a
    feed that guarantees one record per line, files are split among tasks without that, and checked before: a line with
    an unbalanced quote raises.
    """
    if split:
        return records.read_records(spark, path, materialize)
    if one_line:
        numbered = spark.read.text(path).select("_metadata.file_path", "_metadata.file_block_start", "value")
        broken = numbered.where(~F.rlike("value", F.lit(records.RECORD))).first()
        if broken is not None:
            raise ContractError(f"unbalanced quote in {broken.file_path}, in the block from byte {broken.file_block_start}")
    return spark.read.option("header", True).option("escape", '"').option("multiLine", not one_line).csv(path)


def fill_missing(raw: DataFrame, dataset: str) -> DataFrame:
    """Missing required columns added as NULL, for the control suite to report."""
    missing = missing_columns(raw.columns, dataset)
    return raw.withColumns({name: F.lit(None).cast("string") for name in missing}) if missing else raw


def read_extract(spark: SparkSession, path: str, dataset: str, one_line: bool = False, split: bool = False) -> DataFrame:
    """Raw CSV extract that has its required columns.

    Columns are matched by name, so their order and extra columns do not matter.
    """
    raw = read_raw(spark, path, one_line, split)
    missing = missing_columns(raw.columns, dataset)
    if missing:
        raise ContractError(f"{dataset} missing required columns: {missing}")
    return raw


def read_staged(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Staged clean dataset in Parquet, typed by its contract."""
    ddl = ", ".join(f"{name} {kind}" for name, kind in CLEAN_COLUMNS[dataset].items())
    return spark.read.schema(ddl).parquet(path)


def raw_file_ages(spark: SparkSession, directory: str, day: str, pattern: str = "*.csv") -> DataFrame:
    """Path below `directory` and age in days on `day` of every raw file, in folders of files too (S3).

    The file reader passes over files of zero bytes; those come from the directory listing.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(directory)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    prefix = system.makeQualified(root).toString().rstrip("/") + "/"
    ages = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(directory)
        .select(F.col("path"), F.to_date("modificationTime").alias("modified"))
    )
    empty, listed = [], system.listFiles(root, True)
    while listed.hasNext():
        f = listed.next()
        if f.getLen() == 0 and fnmatch(f.getPath().getName(), pattern):
            empty.append((f.getPath().toString(), f.getModificationTime()))
    if empty:
        extra = spark.createDataFrame(empty, "path string, millis bigint")
        ages = ages.unionByName(extra.select("path", F.to_date(F.timestamp_millis("millis")).alias("modified")))
    # Paths carry one slash after the scheme or three, by who wrote them.
    below = F.substr(F.regexp_replace("path", "^file:/+", "file:/"), F.lit(len(re.sub("^file:/+", "file:/", prefix)) + 1))
    return ages.select(
        below.alias("file_name"), F.date_diff(F.lit(day).cast("date"), F.col("modified")).alias("age_days")
    )


def write_extract(df: DataFrame, path: str) -> None:
    """Staged CSV with a header, replacing what is there (S6); amounts keep two decimals.

    Line breaks, quotes and blanks come back as they were; CSV does not tell empty text from missing, so that
    reads as NULL.
    """
    as_text = [F.col(f.name).cast("string").alias(f.name) for f in df.schema]
    (
        df.select(*as_text)
        .write.mode("overwrite")
        .options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


def write_governed(df: DataFrame, path: str) -> None:
    """Governed Parquet table, replaced as a whole (S7). No rows give an empty table with its schema, so
    nothing stale is left behind (S8)."""
    df.write.mode("overwrite").parquet(path)


def append_governed(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_governed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Governed table, or an empty one where nothing has been published yet."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def save_tables(tables: dict[str, DataFrame], database: str | None = None) -> None:
    """Rebuild managed tables."""
    for name, df in tables.items():
        df.write.mode("overwrite").saveAsTable(f"{database}.{name}" if database else name)


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder of the session for written intermediate tables.

    `spark.checkpoint.dir` decides. A temporary folder stands in only in local mode: on a cluster the
    executors would not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    shared = tempfile.mkdtemp(prefix="plumbline-")
    spark.sparkContext.setCheckpointDir(shared)
    return spark.sparkContext.getCheckpointDir()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    This cuts the lineage at a place that outlives executors, and gives the planner real sizes to choose
    join strategies by.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
