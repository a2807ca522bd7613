"""Removal of repeated byte strings by bucket-pointer refinement.

A byte goes when a string of `length` bytes covers it that starts anywhere else too. Suffixes are put in buckets by
their first q bytes, and buckets are refined by the bucket identifiers at later offsets: the identifier of 2m bytes is
made of those of m bytes at the offsets 0 and m, and each level is used again by the next (8, 16, ... q, `length`).
An identifier is a 64-bit value made from the bytes, so all tasks give a bucket the same one without numbering it.

Not every suffix has to be sorted. Of the q-byte strings inside a string of `length` bytes the least identifier
is its anchor, wherever that string is; an anchor owns the run of suffixes that have it. So
1. anchors are grouped by the bucket of their q bytes; those alone in a bucket own no repeated string and leave;
2. a bucket is refined by the identifiers at the first and last suffix that an anchor owns: where these agree, all
   suffixes between are repeated, and one of the group stands for it from here on;
3. what is left alone beside others is cut in blocks of `BLOCK` suffixes at fixed distances from the anchor. A block is
   refined in the same way; the bytes that all its suffixes share show whether any of them can be repeated at all;
4. blocks that are still open are refined suffix by suffix. Suffixes in the same last bucket are repeated.
Steps compare under the identifiers of the levels before, so at least 128 bits decide. A group shares nothing but
counts and one stand-in, so a hot passage never meets in one task.

Texts are held once; copies of a whole text repeat everything in it if it has `length` bytes.

Defined results: a null text is empty; a text shorter than `length` loses nothing; rows with the same text get equal
results; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import Scratch, arrow_map, whole

#: Suffixes that are handled at once; a place in such a piece has to fit in `PLACE` bits.
PIECE, PLACE = 1 << 21, 24
#: Suffixes of a block.
BLOCK = 8
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifiers of pairs of identifiers."""
    x = b >> np.uint64(31)
    x ^= b
    x *= _K[1]
    x += a * _K[0]
    x ^= x >> np.uint64(32)
    x *= _K[2]
    x ^= x >> np.uint64(29)
    return x


def identifiers(flat: bytes, lengths: tuple[int, ...]) -> list[np.ndarray]:
    """For each of the ascending lengths, at least 8, the identifier of that many bytes from every place on."""
    out, now, size = [], None, 8
    now = np.ndarray((max(0, len(flat) - 7),), "<u8", flat, 0, (1,)).copy()
    now ^= now >> np.uint64(33)
    now *= _K[3]
    for length in lengths:
        while size < length:
            step = min(size, length - size)
            now = _joined(now[: max(0, len(now) - step)], now[step:])
            size += step
        out.append(now)
    return out


def _pieces(texts: Iterable[tuple[int, bytes]], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (text, place in it, bytes); a long text comes in pieces that overlap by `length` - 1 bytes."""
    group, size = [], 0
    for key, text in texts:
        for at in range(0, len(text) - length + 1, PIECE):
            part = text[at : at + PIECE + length - 1]
            group.append((key, at, part))
            size += len(part)
            if size >= PIECE:
                yield group
                group, size = [], 0
    if group:
        yield group


def anchors(group: list[tuple[int, int, bytes]], length: int, q: int) -> dict[str, np.ndarray]:
    """Anchors of a group of pieces: bucket, refined (by what they own), tid, lo and n (the suffixes they own), and `to`,
    the way from the first of these to the anchor."""
    flat = b"".join(part for _, _, part in group)
    by_q, by_length = identifiers(flat, (q, length))
    sizes = np.fromiter((len(part) for _, _, part in group), np.int64, len(group))
    starts = np.cumsum(sizes) - sizes
    mask = np.uint64((1 << PLACE) - 1)
    least = (by_q & ~mask) | np.arange(len(by_q), dtype=np.uint64)
    width, span = length - q + 1, 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    counts = sizes - length + 1
    first = np.cumsum(counts) - counts
    places = np.arange(int(counts.sum())) + np.repeat(starts - first, counts)
    owner = (least[places] & mask).astype(np.int64)
    new = np.ones(len(places), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (places[1:] != places[:-1] + 1)
    at = np.flatnonzero(new)
    lo, hi = places[at], places[np.append(at[1:], len(places)) - 1]
    mine = owner[at]
    piece = np.searchsorted(starts, lo, "right") - 1
    shape = ((hi - lo).astype(np.uint64) << np.uint64(32)) | (mine - lo).astype(np.uint64)
    return {
        "bucket": by_q[mine].view(np.int64),
        "refined": _joined(_joined(by_length[lo], by_length[hi]), shape).view(np.int64),
        "tid": np.fromiter((key for key, _, _ in group), np.int64, len(group))[piece],
        "lo": lo - starts[piece] + np.fromiter((base for _, base, _ in group), np.int64, len(group))[piece],
        "n": (hi - lo + 1).astype(np.int32),
        "to": (mine - lo).astype(np.int32),
    }


def _texts(docs: DataFrame, scratch: Scratch, text_col: str) -> DataFrame:
    """One row per distinct text: tid, digest, text (binary), copies."""
    text = whole(text_col).cast("binary")
    rows = docs.select(F.sha2(text, 256).alias("digest"), text.alias("text"))
    one = rows.groupBy("digest").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    return scratch.keep(one.select(F.monotonically_increasing_id().alias("tid"), "*"), "texts", collect=True)


def _anchored(texts: DataFrame, length: int, q: int) -> DataFrame:
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = ((t, x.as_py()) for t, x in zip(batch.column("tid").to_pylist(), batch.column("text")))
            for group in _pieces(pairs, length):
                yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in anchors(group, length, q).items()})

    return arrow_map(texts.select("tid", "text"), of_batches, "bucket long, refined long, tid long, lo long, n int, to int")


def blocks(runs: list[tuple[int, dict, bytes]], length: int) -> dict[str, pa.Array]:
    """Runs (text, run, its bytes) in blocks: bucket, core (what the block's suffixes share), refined, tid, lo, n, to."""
    flat = b"".join(part for _, _, part in runs)
    by_core, by_length = identifiers(flat, (length - BLOCK + 1, length))
    column = {k: np.fromiter((run[k] for _, run, _ in runs), np.int64, len(runs)) for k in ("bucket", "lo", "n", "to", "alone")}
    tid = np.fromiter((t for t, _, _ in runs), np.int64, len(runs))
    n, to = column["n"], column["to"]
    start = np.cumsum(n + length - 1) - (n + length - 1)
    top, low = to // BLOCK, (to - n + 1) // BLOCK  # numbers of the first and last block; distances fall along the text
    count = top - low + 1
    of = np.repeat(np.arange(len(runs)), count)
    number = top[of] - (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count))
    ends = to[of] - BLOCK * number  # place in the run of a whole block's last suffix
    first, last = np.maximum(ends - BLOCK + 1, 0), np.minimum(ends, n[of] - 1)
    at = start[of]
    shape = ((last - first).astype(np.uint64) << np.uint64(32)) | (to[of] - first).astype(np.uint64)
    return {
        "bucket": pa.array(column["bucket"][of]),
        "core": pa.array(_joined(by_core[at + ends], number.astype(np.uint64)).view(np.int64)),
        "refined": pa.array(_joined(_joined(by_length[at + first], by_length[at + last]), shape).view(np.int64)),
        "tid": pa.array(tid[of]),
        "lo": pa.array(column["lo"][of] + first),
        "n": pa.array((last - first + 1).astype(np.int32)),
        "to": pa.array((to[of] - first).astype(np.int32)),
        "alone": pa.array(column["alone"][of].astype(bool)),
    }


def suffixes(runs: list[tuple[int, dict, bytes]], length: int) -> dict[str, pa.Array]:
    """Runs (text, run, its bytes) suffix by suffix: bucket, refined, tid, lo, n, to, alone."""
    by_length = identifiers(b"".join(part for _, _, part in runs), (length,))[0]
    n = np.fromiter((run["n"] for _, run, _ in runs), np.int64, len(runs))
    of = np.repeat(np.arange(len(runs)), n)
    within = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    start = np.cumsum(n + length - 1) - (n + length - 1)
    column = {k: np.fromiter((run[k] for _, run, _ in runs), np.int64, len(runs))[of] for k in ("bucket", "lo", "to", "alone")}
    return {
        "bucket": pa.array(column["bucket"]),
        "refined": pa.array(by_length[start[of] + within].view(np.int64)),
        "tid": pa.array(np.fromiter((t for t, _, _ in runs), np.int64, len(runs))[of]),
        "lo": pa.array(column["lo"] + within),
        "n": pa.array(np.ones(len(of), np.int32)),
        "to": pa.array((column["to"] - within).astype(np.int32)),
        "alone": pa.array(column["alone"].astype(bool)),
    }


def _finer(texts: DataFrame, asked: DataFrame, cut: Callable[[list, int], dict], length: int, ddl: str) -> DataFrame:
    """The asked runs, cut finer by `cut` from the bytes of their texts."""
    lists = asked.groupBy("tid").agg(F.collect_list(F.struct("bucket", "lo", "n", "to", "alone")).alias("runs"))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, size = [], 0
            for tid, text, runs in zip(batch.column("tid").to_pylist(), batch.column("text"), batch.column("runs")):
                text = text.as_py()
                for run in runs.as_py():
                    part = text[run["lo"] : run["lo"] + run["n"] + length - 1]
                    group.append((tid, run, part))
                    size += len(part)
                    if size >= PIECE:
                        yield pa.RecordBatch.from_pydict(cut(group, length))
                        group, size = [], 0
            if group:
                yield pa.RecordBatch.from_pydict(cut(group, length))

    return arrow_map(texts.select("tid", "text").join(lists, "tid"), of_batches, ddl)


def _refined(rows: DataFrame, group: list[str], scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Runs that the identifiers in `refined` settle as repeated, and those asked for next.

    A run is settled when another has its identifier. Asked for are runs alone with theirs that have others in their
    group, and one stand-in for each other identifier of the group.
    """
    one = F.min(F.struct("tid", "lo", "n", "to")).alias("one")
    by = rows.groupBy(*group, "refined").agg(F.count(F.lit(1)).alias("members"), F.max("alone").alias("alone"), one)
    classes = scratch.keep(by, "classes", collect=True)
    several = classes.where("members > 1 AND alone").select(*group, "refined")
    settled = scratch.keep(rows.where("alone").join(several, [*group, "refined"]).select("tid", "lo", "n"), "settled", collect=True)
    open_ = classes.groupBy(*group).agg(F.sum("members").alias("all"), F.max(F.col("alone") & (F.col("members") == 1)).alias("open"))
    open_ = scratch.keep(open_.where("all > 1 AND open").select(*group), "open")
    asked = classes.join(open_, group)
    return settled, asked.select("bucket", "one.*", (F.col("alone") & (F.col("members") == 1)).alias("alone"))


def repeated(texts: DataFrame, scratch: Scratch, length: int, q: int) -> DataFrame:
    """(tid, lo, n): runs of suffixes whose first `length` bytes start elsewhere in `texts` too."""
    found = scratch.keep(_anchored(texts, length, q), "anchors")
    shared = found.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("bucket")
    shared = scratch.keep(shared, "shared", collect=True)  # written, so that Spark can split a hot bucket in the join
    met = scratch.keep(found.join(shared, "bucket").withColumn("alone", F.lit(True)), "met", collect=True)
    scratch.drop(found)
    whole_runs, asked = _refined(met, ["bucket"], scratch)
    ddl = "bucket long, core long, refined long, tid long, lo long, n int, to int, alone boolean"
    cut = scratch.keep(_finer(texts, asked, blocks, length, ddl), "blocks", collect=True)
    scratch.drop(met)
    whole_blocks, asked = _refined(cut, ["bucket", "core"], scratch)
    ddl = "bucket long, refined long, tid long, lo long, n int, to int, alone boolean"
    single = scratch.keep(_finer(texts, asked, suffixes, length, ddl), "suffixes", collect=True)
    scratch.drop(cut)
    again = single.groupBy("bucket", "refined").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("bucket", "refined")
    again = scratch.keep(again, "again", collect=True)
    single_suffixes = scratch.keep(single.where("alone").join(again, ["bucket", "refined"]).select("tid", "lo", "n"), "settled", collect=True)
    return whole_runs.unionByName(whole_blocks).unionByName(single_suffixes)


def remove_repeats(docs: DataFrame, length: int = 200, text_col: str = "text") -> DataFrame:
    """(digest, copies, n_bytes, removed, kept), one row per distinct text of `docs`.

    `removed` are maximal removed runs of bytes (start, end exclusive), `kept` the remaining bytes; `digest` is the
    SHA-256 of the text. `length` is at least 16.
    """
    scratch = Scratch(docs.sparkSession, "suffix")
    texts = _texts(docs, scratch, text_col)
    runs = repeated(texts, scratch, length, max(8, length // 2))
    lists = runs.groupBy("tid").agg(F.collect_list(F.struct("lo", "n")).alias("runs"))
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for text, copies, runs in zip(batch.column("text"), batch.column("copies").to_pylist(), batch.column("runs")):
                text = text.as_py()
                if copies > 1 and len(text) >= length:
                    gone = [(0, len(text))]
                else:
                    gone = _covered([(r["lo"], r["n"]) for r in runs.as_py() or ()], length)
                edges = [0, *(e for span in gone for e in span), len(text)]
                sizes.append(len(text))
                spans.append([{"start": a, "end": b} for a, b in gone])
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), batch.column("copies"), pa.array(sizes, pa.int64()), pa.array(spans, spans_type), pa.array(kept, pa.binary())],
                ["digest", "copies", "n_bytes", "removed", "kept"],
            )

    joined = texts.join(lists, "tid", "left").select("digest", "text", "copies", "runs")
    ddl = "digest string, copies long, n_bytes long, removed array<struct<start: bigint, end: bigint>>, kept binary"
    return arrow_map(joined, of_batches, ddl)


def _covered(runs: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the strings that start in `runs`."""
    out: list[tuple[int, int]] = []
    for lo, n in sorted(runs):
        end = lo + n - 1 + length
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((lo, end))
    return out
