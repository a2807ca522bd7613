"""Small helpers the operators share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plumbline.sources.files import scratch_dir

#: Bytes of text that a task handles at once; a longer text is handled alone.
SLICE_BYTES = 2 << 20
#: Bytes of an Arrow batch between JVM and Python where the session sets none; a longer row is a batch of its own.
BATCH_BYTES = "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(column: str = "text") -> Column:
    """The text of a row; a null one is empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def packed(docs: DataFrame) -> Column:
    """All columns of a row in one struct, so that no name can clash with an operator's own."""
    return F.struct(*[F.col(f"`{name}`") for name in docs.columns])


def with_text(docs: DataFrame, text_col: str) -> DataFrame:
    """The rows of `docs` as struct `row`; only a text that is no string is sent to Python a second time, as `text`."""
    held = any(f.name == text_col and isinstance(f.dataType, T.StringType) for f in docs.schema)
    return docs.select(packed(docs).alias("row"), *([] if held else [whole(text_col).alias("text")]))


def texts_of(batch: pa.RecordBatch, text_col: str) -> pa.Array:
    """The whole texts of a batch of such rows; null ones are empty."""
    if "text" in batch.schema.names:
        return batch.column("text")
    return pc.fill_null(batch.column("row").field(text_col), "")


def unpacked(df: DataFrame, packed_as: str = "row") -> DataFrame:
    return df.select(f"{packed_as}.*")


_shipped: set[str] = set()


def arrow_map(df: DataFrame, of_batches: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """mapInArrow by a function of this package, which Spark sends along to the executors as a Python file."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="plumbline-")) / "plumbline.zip"
        with zipfile.ZipFile(archive, "w") as file:
            for source in sorted(package.rglob("*.py")):
                file.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from of_batches(batches)
        give_back()

    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if df.sparkSession.conf.get(limit, None) is None:
        df.sparkSession.conf.set(limit, BATCH_BYTES)
    return df.mapInArrow(of_task, schema)


def give_back() -> None:
    """Return what a task has freed to the machine: a worker goes on to other operators, beside workers that need room."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


class Scratch:
    """Written intermediate tables below the shared folder of the session.

    `keep` writes a table and reads it back, which cuts the lineage at a place that outlives executors.
    `drop` deletes tables whose readers have all been written themselves. The shuffle files of finished steps go
    when the driver's JVM collects their plans, so `keep` asks it to.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.kept, self.paths = 0, dict[int, tuple[DataFrame, str]]()

    def keep(self, df: DataFrame, name: str, collect: bool = False) -> DataFrame:
        path = f"{self.root}/{name}-{self.kept}"
        self.kept += 1
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = out, path  # the table is held, so that no other gets its id
        if collect:
            del df
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()
        return out

    def drop(self, *tables: DataFrame) -> None:
        for out in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(out))[1])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(lengths: Iterable[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows whose texts make up about `limit` bytes."""
    begin = total = at = 0
    for at, n in enumerate(lengths, 1):
        total += n or 0
        if total >= limit:
            yield begin, at
            begin, total = at, 0
    if begin < at:
        yield begin, at
