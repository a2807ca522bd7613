"""Line dedup by pairwise alignment.

Texts overlap when they share consecutive lines of enough words: a line that has them, or a run of shorter ones. In
scripts without spaces two characters count as a word, and two words without a letter or digit as one. Overlapping texts
are aligned with patience diff over their line hashes, and the aligned common blocks of enough words are deleted from the
later one. Only hashes travel until then; identical texts are one.

The result is that of aligning every text with every earlier one it overlaps; a pair that can't delete more is left out.
Each line first links every later text to the first text that holds it, n - 1 links for a line in n texts. A line that
is still there after that links its text to some more holders, in the last round to all earlier ones, so only lines of
which the alignments keep failing (in another order) cost all their pairs.

Texts are ordered by least identifier (null ones last), then digest. A later row with the text of an earlier one loses
all of it, however short.

Defined results: a null text is empty; rows with the same identifier and text count as one document and get equal
results; an empty table gives an empty result. Other columns pass through.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import Scratch, arrow_map, packed, whole

#: Words that make consecutive lines evidence of overlap, and their size: two for a word.
WORDS = 5
ENOUGH = 2 * WORDS
#: Earlier holders that a line still there links its text to, round by round before all of them.
HOLDERS = (8, 64)
_PRIME, _BASE = (1 << 61) - 1, 0x1B873593CC9E2D51
_BLANK = int.from_bytes(xxhash.xxh64_digest(b""), "big", signed=True)
_LETTER = re.compile(rb"[0-9A-Za-z\x80-\xff]")
#: Thai, Lao, Myanmar, Khmer, kana and Han characters.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def size_of(line: bytes) -> int:
    """Twice the words of a line, up to ENOUGH; only a blank line has none."""
    words = line.split()
    if len(words) >= WORDS:
        return ENOUGH
    size = sum(2 if _LETTER.search(w) else 1 for w in words)
    if not line.isascii():
        size = max(size, len(_UNSPACED.findall(line.decode(errors="ignore"))))
    return min(size, ENOUGH)


def lines_of(text: bytes | None) -> tuple[list[int], list[int]]:
    """Hash and size of every line. White space at line ends doesn't count."""
    digest, hashes, sizes = xxhash.xxh64_digest, [], []
    for line in (text or b"").split(b"\n"):
        line = line.strip()
        hashes.append(int.from_bytes(digest(line), "big", signed=True))
        sizes.append(size_of(line))
    return hashes, sizes


def _run(so_far: int, line: int) -> int:
    return (so_far * _BASE + line) % _PRIME


def seeds_of(hashes: list[int], sizes: list[int]) -> set[int]:
    """The least evidence: lines with enough words, and of each shorter line the run from it that has them, without blanks."""
    out = set()
    solid = [(h, size) for h, size in zip(hashes, sizes) if size]
    for at, (line, size) in enumerate(solid):
        if size >= ENOUGH:
            out.add(line)
            continue
        run, total = 1, 0
        for line, size in solid[at : at + ENOUGH]:
            run, total = _run(run, line), total + size
            if total >= ENOUGH:
                out.add(run)
                break
    return out


def line_hashes(text: bytes | None) -> tuple[list[int], list[int]]:
    """Hash of every line, and the distinct seeds; a text without one, if not empty, has itself. White space at line ends doesn't count."""
    hashes, sizes = lines_of(text)
    seeds = sorted(seeds_of(hashes, sizes))
    if text and not seeds:
        seeds = [xxhash.xxh3_64_intdigest(text) >> 1]
    return hashes, seeds


def keys(hashes: list[int], sizes: list[int], places: Iterable[int] | None = None) -> set[int]:
    """Hashes of the least runs of lines that are evidence and hold one of the places (by default any).

    A block deleted at a place holds such a run around it, so a text without any of its keys can't delete it.
    """
    total = list(accumulate(sizes, initial=0))
    solid = [i for i, size in enumerate(sizes) if size]
    sums = powers = None
    out = set()
    for p in range(len(hashes)) if places is None else places:
        if sizes[p] >= ENOUGH:
            out.add(hashes[p])
            continue
        if sums is None:
            sums = list(accumulate(hashes, lambda s, h: (s * _BASE + h) % _PRIME, initial=1))
            powers = list(accumulate(hashes, lambda s, _: s * _BASE % _PRIME, initial=1))
        end, after, last = p, bisect_right(solid, p), -1
        while True:
            start = min(p, bisect_right(total, total[end + 1] - ENOUGH) - 1)
            if start > last:
                out.add((sums[end + 1] - sums[start] * powers[end + 1 - start]) % _PRIME)
                last = start
            if start == p or after == len(solid):
                break
            end, after = solid[after], after + 1
    return out


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of pairs (ascending in the first) that also ascends in the second, by patience sorting."""
    tops: list[int] = []
    at_top: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        back[k] = at_top[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(b)
            at_top.append(k)
        else:
            tops[pile], at_top[pile] = b, k
    out, k = [], at_top[-1] if at_top else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _counted(lines: list[int]) -> Iterator[tuple[int, int]]:
    """Each line with its number among its equals."""
    seen: Counter = Counter()
    for line in lines:
        yield line, seen[line]
        seen[line] += 1


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned lines (place in a, place in b): equal ends first, then lines unique in both, again between those.

    Between them, where only lines are shared that repeat, those are aligned by their occurrence.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1}
        anchors = _rising([(i, place[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in place])
        if not anchors:
            # Lines that repeat: the first one of either side belongs to the first of the other, and so on.
            places = {key: j for j, key in enumerate(_counted(b[b0:b1]), b0)}
            anchors = _rising([(i, places[key]) for i, key in enumerate(_counted(a[a0:a1]), a0) if key in places])
        if not anchors:
            continue
        edges = [*anchors, (a1, b1)]
        out += anchors
        last_a, last_b = a0, b0
        for i, j in edges:
            todo.append((last_a, i, last_b, j))
            last_a, last_b = i + 1, j + 1
    return sorted(out)


def _holds(block: list[int], seeds: set[int]) -> bool:
    if not seeds.isdisjoint(block):
        return True
    solid = [h for h in block if h != _BLANK]
    return any(not seeds.isdisjoint(accumulate(solid[at : at + ENOUGH], _run, initial=1)) for at in range(len(solid)))


def common_blocks(a: list[int], b: list[int], seeds: set[int]) -> list[int]:
    """Lines of b in aligned blocks that hold a seed: a line or a run of them. A block is consecutive in both."""
    out: list[int] = []
    block: list[int] = []
    last = (-2, -2)
    for i, j in [*patience(a, b), (-9, -9)]:
        if (i, j) != (last[0] + 1, last[1] + 1):
            if _holds([b[k] for k in block], seeds):
                out += block
            block = []
        block.append(j)
        last = (i, j)
    return out


def _texts(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str) -> DataFrame:
    """One row per distinct text: text (its place in the order, and tid), tid, digest, first_id, hashes, sizes, keys."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lines_of(x.as_py()) for x in batch.column("text").cast(pa.binary())]
            columns = [
                pa.array([f[0] for f in found], pa.list_(pa.int64())),
                pa.array([f[1] for f in found], pa.list_(pa.int8())),
                pa.array([sorted(keys(*f)) for f in found], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), *columns], ["doc_id", "digest", "hashes", "sizes", "keys"])

    text = whole(text_col)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.sha2(text.cast("binary"), 256).alias("digest"), text.alias("text"))
    lined = arrow_map(rows, of_batches, "doc_id long, digest string, hashes array<bigint>, sizes array<tinyint>, keys array<bigint>")
    one = lined.groupBy("digest").agg(F.min("doc_id").alias("first_id"), *[F.first(c).alias(c) for c in ("hashes", "sizes", "keys")])
    one = scratch.keep(one.select(F.monotonically_increasing_id().alias("tid"), "*"), "texts", collect=True)
    return one.withColumn("text", F.struct(F.col("first_id").isNull().alias("none"), "first_id", "digest", "tid"))


def _shared(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(line, text, n, first) for the keys that n > 1 texts hold, once for each of them."""
    held = texts.select(F.explode("keys").alias("line"), "text")
    first = held.groupBy("line").agg(F.min("text").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Written, so that Spark can split a hot line in the join.
    first = scratch.keep(first.select("line", "n", F.col("first.tid").alias("first")), "first")
    return scratch.keep(held.join(first, "line"), "shared")


def _open(texts: DataFrame, shared: DataFrame, gone: DataFrame) -> DataFrame:
    """(line, n, text): the shared keys around places that are not deleted, of all texts but the first holders."""
    mine = shared.where("text.tid <> first").groupBy("text.tid").agg(F.collect_list(F.struct("line", "n")).alias("lines"))
    rows = texts.select("tid", "text", "hashes", "sizes").join(mine, "tid").join(gone, "tid", "left")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, lines, counts = [], [], []
            for i, (hashes, sizes, held, lost) in enumerate(zip(*[batch.column(c) for c in ("hashes", "sizes", "lines", "gone")])):
                hashes, lost = hashes.as_py(), set(lost.as_py() or ())
                left = keys(hashes, sizes.as_py(), [p for p in range(len(hashes)) if p not in lost])
                for x in held.as_py():
                    if x["line"] in left:
                        of.append(i)
                        lines.append(x["line"])
                        counts.append(x["n"])
            columns = [pa.array(lines, pa.int64()), pa.array(counts, pa.int64()), batch.column("text").take(pa.array(of, pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["line", "n", "text"])

    return arrow_map(rows, of_batches, shared.select("line", "n", "text").schema)


def _deleted(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(tid, gone): places of deleted lines of every text that loses some."""
    earlier = texts.select(F.col("tid").alias("earlier"), F.col("hashes").alias("a"))
    later = texts.select(F.col("tid").alias("later"), F.col("hashes").alias("b"), F.col("sizes").alias("s"))
    both = pairs.join(earlier, "earlier").join(later, "later").select("later", "a", "b", "s")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = []
            for a, b, s in zip(batch.column("a"), batch.column("b"), batch.column("s")):
                b = b.as_py()
                gone.append(common_blocks(a.as_py(), b, seeds_of(b, s.as_py())))
            yield pa.RecordBatch.from_arrays([batch.column("later"), pa.array(gone, pa.list_(pa.int32()))], ["tid", "gone"])

    return _joined(arrow_map(both, of_batches, "tid long, gone array<int>").where(F.size("gone") > 0))


def _joined(gone: DataFrame) -> DataFrame:
    """One row per tid. Sets are merged as they come, so that a text with many partners doesn't hold all their lists."""
    each = gone.select("tid", F.explode("gone").alias("place")).distinct()
    return each.groupBy("tid").agg(F.collect_list("place").alias("gone"))


def _all_deleted(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(tid, gone) as from the alignment of all overlapping pairs."""
    shared = _shared(texts, scratch)
    pairs = shared.where("text.tid <> first").select(F.col("text.tid").alias("later"), F.col("first").alias("earlier")).distinct()
    pairs = scratch.keep(pairs, "links", collect=True)
    gone = scratch.keep(_deleted(texts, pairs), "gone", collect=True)
    done, few = [pairs], 2 * texts.count()
    for holders in (*HOLDERS, None):
        left = scratch.keep(_open(texts, shared, gone), "open", collect=True)
        links = left.agg(F.sum("n")).first()[0]
        if not links:
            break
        if links <= few:
            holders = None
        by = shared.select("line", F.col("text").alias("before"))
        if holders:
            by = by.groupBy("line", F.pmod(F.xxhash64("before.tid"), F.lit(holders))).agg(F.min("before").alias("before")).select("line", "before")
        new = left.join(by, "line").where("before < text").select(F.col("text.tid").alias("later"), F.col("before.tid").alias("earlier")).distinct()
        pairs = scratch.keep(new.join(reduce(DataFrame.unionByName, done), ["later", "earlier"], "left_anti"), "links", collect=True)
        done.append(pairs)
        gone = scratch.keep(_joined(gone.unionByName(_deleted(texts, pairs))), "gone", collect=True)
        if not holders:
            break
    return gone


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of `docs` as struct `row`, with n_lines, n_removed and the text that is left as `kept`."""
    scratch = Scratch(docs.sparkSession, "lines")
    texts = _texts(docs, scratch, id_col, text_col)
    gone = _all_deleted(texts, scratch)
    seen = texts.select("tid", "digest", "first_id").join(gone, "tid", "left")
    seen = scratch.keep(seen.drop("tid").withColumnRenamed("digest", "of_digest"), "seen", collect=True)
    rows = docs.select(
        packed(docs).alias("row"), whole(text_col).alias("text"), F.sha2(whole(text_col).cast("binary"), 256).alias("digest"), F.col(f"`{id_col}`").cast("long").alias("id")
    )
    again = (F.col("text") != "") & ~F.col("id").eqNullSafe(F.col("first_id"))
    joined = rows.join(seen, F.col("digest") == F.col("of_digest")).select("row", "text", "gone", again.alias("again"))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, gone, again in zip(batch.column("text"), batch.column("gone"), batch.column("again")):
                lines = text.as_py().split("\n")
                drop = range(len(lines)) if again.as_py() else gone.as_py() or ()
                stay = np.ones(len(lines), bool)
                stay[list(drop)] = False
                counts.append(len(lines))
                removed.append(len(lines) - int(stay.sum()))
                kept.append("\n".join(x for x, s in zip(lines, stay) if s))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["row", "n_lines", "n_removed", "kept"],
            )

    schema = rows.select("row").schema.add("n_lines", "long").add("n_removed", "long").add("kept", "string")
    return arrow_map(joined, of_batches, schema)
