"""Benchmark decontamination by a generalised suffix automaton of the normalised benchmark items.

Training texts are streamed through the automaton word by word; it tracks the longest suffix read so far that occurs in
some item. Where that length reaches a window (13 words, or a whole shorter item), the window occurs and its words are
hit. Only runs of words and word pairs that the items have can hold a window, so only those are streamed.

The benchmark is a stated set. Its size is checked before it is gathered: items are cut into pieces that overlap by a
window less one word, pieces are dealt to blocks, and the number of blocks is doubled until none has more than
`BLOCK_BYTES` of text (or it is a single piece). Each block has its own automaton and its own pass over the texts, so
driver and tasks hold one automaton of bounded size at a time.

Defined results: a null text or item has no words; an item without words has no window; a null item_id counts as an
item but is left out of the list; repeated items count by item_id; an empty table gives an empty result, an empty
benchmark no hits. Other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from plumbline.llm.common import Scratch, arrow_map, slices, texts_of, whole, with_text

#: Text of the items that one automaton is made of, which takes about a hundred times that in the tasks that use it.
BLOCK_BYTES = 2 << 20
#: Words of a piece of an item.
PIECE = 4096
#: Not a letter of A-Z, a-z, a digit or beyond ASCII: between words. Capitals become small.
PLAIN = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))
_GAP, _END = -1, -2
_FOUND_DDL = "n_words bigint, items array<string>, hits array<struct<start: bigint, end: bigint>>"
_FOUND_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("hits", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)
_PAIRS = 1 << 20


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(PLAIN).split()


class Automaton:
    """Suffix automaton of several word sequences, with the windows that end in each state."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window, self.words = window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        ids = [(item, [self.words.setdefault(w, len(self.words)) for w in words]) for item, words in items if words]
        self.lookup = {**self.words, b"\x00": _END}
        for _, seq in ids:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        self.full: dict[int, set] = {}
        short: dict[int, set] = {}
        self.shortest = window
        self.pairs = np.zeros(_PAIRS, bool)
        for item, seq in ids:
            state = length = 0
            for c in seq:
                state, length = self.next[state][c], length + 1
                if length > window:
                    length = window
                while self.len[self.link[state]] >= length:
                    state = self.link[state]
                if length == window:
                    self.full.setdefault(state, set()).add(item)
            if len(seq) < window:
                self.shortest = min(self.shortest, len(seq))
                short.setdefault(state, set()).add((len(seq), item))
            a = np.array(seq, np.int64)
            self.pairs[self.pair(a[:-1], a[1:])] = True
        #: Short items that are suffixes of what a state stands for, its own included.
        self.short: list[tuple] = [()] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.len.__getitem__):
            self.short[s] = tuple(short.get(s, ())) + (self.short[self.link[s]] if self.link[s] > 0 else ())

    @staticmethod
    def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * 1_000_003 + b * 7919) % _PAIRS

    def _new(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.len.append(length)
        self.link.append(link)
        return len(self.len) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The state for what p reads with c, cut out of q where q also stands for longer words."""
        if self.len[p] + 1 == self.len[q]:
            return q
        copy = self._new(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c, self.next[last][c])
        fresh, p = self._new(self.len[last] + 1, {}, 0), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = fresh
            p = self.link[p]
        if p >= 0:
            self.link[fresh] = self._split(p, c, self.next[p][c])
        return fresh

    def stream(self, seq: list[int]) -> Iterator[tuple[int, int, set]]:
        """(first word, last word, items) of the windows that occur in a sequence of word numbers."""
        nxt, link, size, window = self.next, self.link, self.len, self.window
        state = length = 0
        for at, c in enumerate(seq):
            while state and c not in nxt[state]:
                state = link[state]
                length = size[state]
            if c in nxt[state]:
                state, length = nxt[state][c], length + 1
            if length >= window:
                holder = state
                while size[link[holder]] >= window:
                    holder = link[holder]
                yield at - window + 1, at, self.full[holder]
            for k, item in self.short[state]:
                if k <= length:
                    yield at - k + 1, at, {item}

    def numbers(self, texts: list[bytes | None]) -> np.ndarray:
        """Word numbers of several texts, each followed by a mark."""
        found = b" \x00 ".join((x or b"").translate(PLAIN) for x in texts).split() + [b"\x00"]
        return np.fromiter(map(self.lookup.get, found, repeat(_GAP)), np.int64, len(found))

    def candidates(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Runs of known words, of which all neighbours are known pairs, that are long enough for a window."""
        known = ids >= 0
        joins = known[:-1] & known[1:]
        at = np.flatnonzero(joins)
        joins[at] = self.pairs[self.pair(ids[at], ids[at + 1])]
        if self.shortest == 1:
            starts = np.flatnonzero(known & ~np.concatenate(([False], joins)))
            stops = np.flatnonzero(known & ~np.concatenate((joins, [False]))) + 1
        else:
            edge = np.diff(np.concatenate(([0], joins.astype(np.int8), [0])))
            starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
        long_ = stops - starts >= self.shortest
        return list(zip(starts[long_].tolist(), stops[long_].tolist()))


def scan_texts(texts: list[bytes | None], automaton: Automaton) -> list[tuple[int, list[tuple[int, int]], set]]:
    """(words, maximal hit runs of words with exclusive ends, items) of each text."""
    ids = automaton.numbers(texts)
    ends = np.flatnonzero(ids == _END)
    starts = np.concatenate(([0], ends[:-1] + 1))
    out: list[tuple[int, list[tuple[int, int]], set]] = [(n, [], set()) for n in (ends - starts).tolist()]
    for a, b in automaton.candidates(ids):
        i = int(np.searchsorted(ends, a))
        base = a - int(starts[i])
        for first, last, items in automaton.stream(ids[a:b].tolist()):
            out[i][1].append((base + first, base + last + 1))
            out[i][2].update(items)
    return [(n, _merged(spans), items) for n, spans, items in out]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def pieces_of(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """Distinct (item, piece): the words of every item, long ones in pieces that hold each window whole."""
    step = PIECE - window + 1

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, pieces = [], []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                words = words_of(text)
                for at in range(0, max(1, len(words) - window + 1), step):
                    items.append(item)
                    pieces.append(b" ".join(words[at : at + PIECE]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(pieces, pa.string())], ["item", "piece"])

    items = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), whole(text_col).alias("text"))
    return arrow_map(items, of_batches, "item string, piece string").where("piece <> ''").distinct()


def blocks_of(pieces: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    """(item, words) of one block after the other; a written table of pieces is dealt by hash."""
    size = F.octet_length("piece") + 16
    total, rows = pieces.agg(F.coalesce(F.sum(size), F.lit(0)), F.count(F.lit(1))).first()
    count = max(1, -(-total // block_bytes))

    def dealt(n: int) -> DataFrame:
        return pieces.withColumn("block", F.pmod(F.xxhash64("item", "piece"), F.lit(n)))

    if count > 1:
        # A block over the limit that holds one piece cannot be made smaller.
        def crowded(n: int) -> bool:
            sizes = dealt(n).groupBy("block").agg(F.sum(size).alias("n"), F.count(F.lit(1)).alias("pieces"))
            return sizes.where((F.col("n") > block_bytes) & (F.col("pieces") > 1)).limit(1).count() > 0

        while count < rows * rows and crowded(count):
            count *= 2
    for k in range(count):
        held = [(r.item, r.piece.encode().split()) for r in dealt(count).where(F.col("block") == k).collect()]
        if held or k == 0:
            yield held


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    one_in: int = 20,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Rows of `docs` as struct `row`, with n_words, n_hit, items (sorted as strings), hits and contaminated.

    `hits` are maximal runs of hit words (start, end exclusive, counted in words). A text is contaminated when it has a
    hit and at least one in `one_in` of its words is hit.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    pieces = scratch.keep(pieces_of(benchmark, window, item_col, item_text_col), "pieces")
    rows = with_text(docs, text_col)
    text = F.col("text") if "text" in rows.columns else F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    digest = F.sha2(text.cast("binary"), 256)
    last, passes = None, []
    for items in blocks_of(pieces, block_bytes):
        if last is not None:  # the hits of the pass before are written, so that its automaton can go
            slim = rows.select(F.struct(digest.alias("digest")).alias("row"), text.alias("text"))
            hit = _streamed(slim, last, text_col).where(F.size("found.hits") > 0)
            passes.append(scratch.keep(hit.groupBy("row.digest").agg(F.first("found").alias("found")), "found", collect=True))
        last = Automaton(items, window)
    if passes:
        parts = [F.flatten(F.collect_list(f"found.{name}")).alias(name) for name in ("items", "hits")]
        found = reduce(DataFrame.unionByName, passes).groupBy(F.col("digest").alias("of_digest")).agg(*parts)
        found = scratch.keep(found.select("of_digest", F.struct("items", "hits").alias("earlier")), "earlier")
        rows = rows.join(found, digest == F.col("of_digest"), "left").select(*rows.columns, "earlier")
    found = F.struct(F.aggregate("found.hits", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"]).alias("n_hit"), F.col("found"))
    bad = (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))
    return (
        _streamed(rows, last, text_col)
        .select("row", found.alias("f"))
        .select("row", "f.found.n_words", "f.n_hit", "f.found.items", "f.found.hits")
        .withColumn("contaminated", bad)
    )


def _streamed(rows: DataFrame, automaton: Automaton, text_col: str) -> DataFrame:
    """(row, found) of (row, and text if it isn't in there) after a pass through one automaton; `earlier`, if there, is what other passes found."""
    sent = rows.sparkSession.sparkContext.broadcast(automaton)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch, text_col).cast(pa.binary()).to_pylist()
            before = batch.column("earlier").to_pylist() if "earlier" in batch.schema.names else [None] * len(texts)
            found = []
            for a, b in slices(map(len, texts)):
                for old, (n, spans, items) in zip(before[a:b], scan_texts(texts[a:b], sent.value)):
                    if old:
                        spans = _merged(spans + [(s["start"], s["end"]) for s in old["hits"]])
                        items.update(old["items"])
                    hits = [{"start": s, "end": e} for s, e in spans]
                    found.append({"n_words": n, "items": sorted(x for x in items if x is not None), "hits": hits})
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, _FOUND_ARROW)], ["row", "found"])

    schema = rows.select("row").schema.add("found", T.StructType.fromDDL(_FOUND_DDL))
    return arrow_map(rows, of_batches, schema)


def remove(docs: DataFrame, benchmark: DataFrame, window: int = 13, one_in: int = 20, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that are not contaminated, as they are; those beyond the coverage limit go."""
    return contamination(docs, benchmark, window, one_in, text_col).where("NOT contaminated").select("row.*")


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text without spans of its words (ascending, ends exclusive). What stands between words around them stays."""
    if not spans:
        return text
    places = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(PLAIN))]
    out, last = [], 0
    for start, end in spans:
        out.append(text[last : places[start][0]])
        last = places[end - 1][1]
    return b"".join([*out, text[last:]])


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 13, least: int = 13, one_in: int = 20, text_col: str = "text", **named) -> DataFrame:
    """Rows of `docs` as struct `row`, with n_words, n_cut (words) and the text that is left as `cleaned`.

    A maximal run of hit words is cut when it has at least `least` words; all runs of a text are when at least one in
    `one_in` of its words is hit. Other arguments are those of `contamination`.
    """
    found = contamination(docs, benchmark, window, one_in, text_col, **named)
    going = F.when(F.col("contaminated"), F.col("hits")).otherwise(F.filter("hits", lambda x: x["end"] - x["start"] >= least))
    text = F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))
    rows = found.select("row", "n_words", text.alias("text"), going.alias("going"))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, left = [], []
            for text, going in zip(batch.column("text").cast(pa.binary()), batch.column("going")):
                spans = [(x["start"], x["end"]) for x in going.as_py()]
                counts.append(sum(b - a for a, b in spans))
                left.append(cut(text.as_py(), spans).decode())
            columns = [batch.column("row"), batch.column("n_words"), pa.array(counts, pa.int64()), pa.array(left, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "n_words", "n_cut", "cleaned"])

    return arrow_map(rows, of_batches, rows.select("row", "n_words").schema.add("n_cut", "long").add("cleaned", "string"))
