"""SimHash near-dedup: word-shingle fingerprints, and all pairs within a radius by covering locality-sensitive hashing.

Each bit place gets a nonzero vector of radius + 1 bits; each nonzero vector of as many bits gives a mask of the places
whose product with it is odd. Any `radius` places leave some mask untouched, since fewer equations than unknowns have a
nonzero solution. So two fingerprints within the radius are equal under that mask and share a bucket in its table: no
pair is missed. A bucket with many different fingerprints is covered again over the places its mask leaves free; after
three levels a bucket has so few free places that its size is bounded by them.

Work is on distinct fingerprints; documents join their component by fingerprint.

Defined results: a null text is empty; a text without words has fingerprint zero, linked like any other; of fewer words
than a shingle the whole sequence is one; repeated rows each get a row; a null identifier is ignored in the least one
of a component; an empty table gives an empty result. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.common import Scratch, arrow_map, packed, whole
from plumbline.llm.components import components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SEED, BITS = 42, 64
#: Shingles whose bits are counted at once.
BLOCK = 1 << 15
#: Different fingerprints of a bucket that are compared with each other.
SMALL = 24


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Unsigned fingerprint of a text in UTF-8."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    stops = ends[len(words) - n :].tolist() if len(words) >= shingle else [len(flat)]
    digest = xxhash.xxh64_digest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, BLOCK):
        hashes = b"".join([digest(flat[a:b], SEED) for a, b in zip(starts[at : at + BLOCK], stops[at : at + BLOCK])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, digest, fp) of every row; fp as signed long, digest of the whole text to tell rows apart."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            fps = np.fromiter((fingerprint(x.as_py(), shingle) for x in texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(fps)], ["doc_id", "digest", "fp"])

    text = whole(text_col)
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.sha2(text.cast("binary"), 256).alias("digest"), text.alias("text"))
    return arrow_map(slim, of_batches, "doc_id long, digest string, fp long")


def covering_masks(places: list[int], radius: int) -> list[int]:
    """Masks over bit `places`: any `radius` of them are all left out by at least one mask."""
    top = 1 << (radius + 1)
    vector = {place: 1 + i % (top - 1) for i, place in enumerate(places)}
    return [sum(1 << p for p, m in vector.items() if (m & v).bit_count() % 2) for v in range(1, top)]


def _levels(radius: int, depth: int) -> list[list[int]]:
    """Masks of each level: mask i at one level has its refinements at i * n ... i * n + n - 1 at the next."""
    levels = [covering_masks(list(range(BITS)), radius)]
    while len(levels) < depth:
        levels.append([m | x for m in levels[-1] for x in covering_masks([p for p in range(BITS) if not m >> p & 1], radius)])
    return levels


def _signed(masks: list[int]) -> Column:
    return F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in masks])


def near_pairs(fps: DataFrame, radius: int, scratch: Scratch, small: int = SMALL, depth: int = 3) -> DataFrame:
    """Distinct pairs a < b of the distinct longs `fp` that differ in 1 to `radius` bits."""
    levels = _levels(radius, depth)
    width = len(levels[0])
    rows = fps.select("fp", F.posexplode(_signed(levels[0])).alias("mask", "bits"))
    pairs = None
    for level, masks in enumerate(levels):
        rows = rows.select("fp", "mask", F.col("fp").bitwiseAND(F.col("bits")).alias("key"))
        sizes = scratch.keep(rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
        met = scratch.keep(rows.join(sizes, ["mask", "key"]), f"buckets{level}", collect=True)
        last = level == len(levels) - 1
        few = met if last else met.where(F.col("n") <= small)
        left, right = few.select("mask", "key", F.col("fp").alias("a")), few.select("mask", "key", F.col("fp").alias("b"))
        close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
        found = left.join(right, ["mask", "key"]).where((F.col("a") < F.col("b")) & close).select("a", "b")
        pairs = found if pairs is None else pairs.unionByName(found)
        if last or met.where(F.col("n") > small).limit(1).count() == 0:
            break
        finer = spark_masks(levels[level + 1], width, scratch)
        rows = met.where(F.col("n") > small).join(F.broadcast(finer), "mask").select("fp", F.col("next").alias("mask"), "bits")
    return pairs.distinct()


def spark_masks(masks: list[int], width: int, scratch: Scratch) -> DataFrame:
    """(mask, next, bits): the refinements of each mask of the level above; their number depends on the radius only."""
    held = [(i // width, i, m - (1 << 64) if m >> 63 else m) for i, m in enumerate(masks)]
    return scratch.spark.createDataFrame(held, "mask int, next int, bits long")


def grouped(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text", small: int = SMALL) -> DataFrame:
    """(doc_id, digest, fp, component_id, keeper) of every row.

    `component_id` is the least identifier reachable over links; `keeper` tells the row that stands for its component:
    the one with the least identifier, null ones last, then the least digest.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.keep(fingerprints(docs, shingle, id_col, text_col), "fps")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    fps = scratch.keep(rows.groupBy("fp").agg(F.min(first).alias("first")), "distinct")
    roots = scratch.keep(components(near_pairs(fps, radius, scratch, small), scratch), "roots")
    nodes = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    firsts = nodes.groupBy("root").agg(F.min("first").alias("first"))
    member = nodes.select("fp", "root").join(firsts, "root").select("fp", "first")
    return rows.join(member, "fp").select(
        "doc_id", "digest", "fp", F.col("first.doc_id").alias("component_id"), (first == F.col("first")).alias("keeper")
    )


def dedup(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stand for their component, with all their columns."""
    scratch = Scratch(docs.sparkSession, "simhash-out")
    gone = grouped(docs, shingle, radius, id_col, text_col).where("NOT keeper")
    gone = scratch.keep(gone.select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest")).distinct(), "gone")
    text = whole(text_col).cast("binary")
    rows = docs.select(packed(docs).alias("row"), F.col(f"`{id_col}`").cast("long").alias("own_id"), F.sha2(text, 256).alias("own_digest"))
    same = F.col("own_id").eqNullSafe(F.col("gone_id")) & (F.col("own_digest") == F.col("gone_digest"))
    return rows.join(gone, same, "left_anti").select("row.*")


def hexed(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), BITS // 4, "0"))
