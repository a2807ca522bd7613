"""Byte-pair encoding and decoding with a pair occurrence index.

The distinct pre-tokens that a slice of texts brings anew are laid out in one array of symbols. An index maps each
mergeable pair to all its positions in it. Active ranks are applied in ascending order, each to all its positions at
once: ranks with many positions by array operations, the others one position after the other. A merge enters the new
neighbour pairs in their lists, and stale positions are recognised when they come up. Lists of later ranks are kept by
blocks of ranks and sorted when their block begins. Encoded chunks of text are kept for the following slices in a
bounded table; ids lie in one array, from which those of a text are gathered.

The vocabulary is a file of the tokenizers library, byte-level BPE; its path is a parameter. It is read on the driver
and sent to the tasks (a vocabulary is a few MB, `MAX_VOCABULARY` at most). A setting of it that isn't implemented here
is an error.

Defined results: a null text is empty and has no tokens; strings of special tokens in a text are encoded as those
tokens; repeated rows each get a row; an empty table gives an empty result. Other columns pass through.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from plumbline.llm.common import arrow_map, slices, texts_of, with_text

MAX_VOCABULARY = 64 << 20
#: Kept chunks of text at most, and the length in characters up to which one is kept.
KEPT, KEPT_LENGTH = 200_000, 40
#: Pre-tokens that one index holds.
INDEXED = 100_000
#: Ranks of a block, and positions from which a rank is applied by arrays.
BLOCK, MANY = 512, 48
#: The pre-tokens of the byte-level splitter (a fixed value), and the first character for which versions of Unicode differ.
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_KNOWN = "\u0558"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones stand for themselves."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Splitter:
    """Pre-tokens of chunks of text, as the vocabulary's pre-tokenizer makes them."""

    def __init__(self, config: str):
        self.pre = Tokenizer.from_str(config).pre_tokenizer
        self.byte_of = {c: b for b, c in enumerate(byte_letters())}

    def parts(self, text: str) -> list[str]:
        """Those of letters alone, or with one mark behind, need no pattern."""
        bare = text[1:] if text[:1] == " " else text
        if bare.isalpha():
            return [text]
        if bare[:-1].isalpha() and bare[-1] in ",.!?;:":
            return [text[:-1], bare[-1]]
        return [bytes(map(self.byte_of.__getitem__, t)).decode() for t, _ in self.pre.pre_tokenize_str(text)]


def refuse_unknown(held: dict) -> None:
    """Raise for settings of a vocabulary that would give other ids than the ones here."""
    model, split = held["model"], held["pre_tokenizer"] or {}
    if model["type"] != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) or held.get("normalizer"):
        raise ValueError("a byte-level BPE vocabulary without normalizer and prefix space is needed")
    wrong = [name for name in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback") if model.get(name)]
    wrong += [f"{t['content']}: {name}" for t in held["added_tokens"] for name in ("single_word", "lstrip", "rstrip") if t.get(name)]
    if wrong:
        raise ValueError(f"settings that are not implemented: {wrong}")


class Store:
    """Id sequences one after the other in one array."""

    def __init__(self):
        self.flat, self.stops = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.stops) - 1

    def add(self, flat: np.ndarray, stops: np.ndarray) -> None:
        self.stops = np.concatenate((self.stops, stops + len(self.flat)))
        self.flat = np.concatenate((self.flat, flat.astype(np.uint32)))

    def gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sequences of the given numbers in a row, and where each stops."""
        sizes = self.stops[numbers + 1] - self.stops[numbers]
        stops = np.cumsum(sizes)
        total = int(stops[-1]) if len(stops) else 0
        return self.flat[np.arange(total) + np.repeat(self.stops[numbers] - (stops - sizes), sizes)], stops

    def keep(self, numbers: np.ndarray) -> None:
        self.flat, stops = self.gathered(numbers)
        self.stops = np.concatenate(([0], stops))


class Index:
    """Positions of pairs by rank. Those of the block of ranks at hand are lists by rank, later ones are collected by block."""

    def __init__(self, blocks: int):
        self.later: list[list] = [[] for _ in range(blocks)]
        self.loose: list[list[tuple[int, int]]] = [[] for _ in range(blocks)]
        self.block, self.at, self.active = -1, dict[int, list](), list[int]()

    def enter(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        blocks = ranks // BLOCK
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(blocks)) + 1, [len(ranks)])).tolist()
        for a, b in zip(cuts, cuts[1:]):
            if blocks[a] == self.block:
                self._lists(ranks[a:b], positions[a:b])
            else:
                self.later[blocks[a]].append((ranks[a:b], positions[a:b]))

    def _lists(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Sorted ranks and their positions into the lists of the block at hand."""
        cuts = [0, *(np.flatnonzero(np.diff(ranks)) + 1).tolist(), len(ranks)]
        for a, b in zip(cuts, cuts[1:]):
            rank = int(ranks[a])
            if rank in self.at:
                self.at[rank].append(positions[a:b])
            else:
                self.at[rank] = [positions[a:b]]
                heapq.heappush(self.active, rank)

    def enter_one(self, rank: int, position: int) -> None:
        if rank // BLOCK != self.block:
            self.loose[rank // BLOCK].append((rank, position))
        elif rank in self.at:
            self.at[rank].append((position,))
        else:
            self.at[rank] = [(position,)]
            heapq.heappush(self.active, rank)

    def lists(self) -> Iterator[tuple[int, list]]:
        """Ranks in ascending order with parts of their positions; those entered meanwhile come up too."""
        for self.block in range(len(self.later)):
            held, loose = self.later[self.block], self.loose[self.block]
            self.later[self.block] = self.loose[self.block] = []
            if loose:
                held.append(tuple(np.array(loose, np.int64).T))
            if held:
                ranks = np.concatenate([r for r, _ in held])
                order = np.argsort(ranks, kind="stable")
                self._lists(ranks[order], np.concatenate([p for _, p in held])[order])
            while self.active:
                rank = heapq.heappop(self.active)
                yield rank, self.at.pop(rank)


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, config: str):
        held = json.loads(config)
        refuse_unknown(held)
        model = held["model"]
        self.split = Splitter(config)
        letters, byte_of = byte_letters(), self.split.byte_of
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        #: A pair of ids is one number: the first times `width`, plus the second.
        self.width = 1 + max([*vocab.values(), *self.special.values()])
        self.first = np.array([vocab[c] for c in letters], np.int64)
        self.merges: list[tuple[int, int, int]] = []
        self.rank: dict[int, int] = {}
        born: dict[int, int] = {}
        for rank, (a, b) in enumerate(tuple(m.split(" ")) if isinstance(m, str) else m for m in model["merges"]):
            left, right, new = vocab[a], vocab[b], vocab[a + b]
            if max(born.get(left, -1), born.get(right, -1)) >= rank:
                raise ValueError("a merge comes before one that makes its parts")
            born.setdefault(new, rank)
            self.rank[left * self.width + right] = len(self.merges)
            self.merges.append((left, right, new))
        self.pairs = np.array(sorted(self.rank), np.int64)
        self.pair_ranks = np.array([self.rank[p] for p in self.pairs.tolist()], np.int64)
        self.bytes_of = [b""] * self.width
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.forget()

    def forget(self) -> None:
        """Empty tables; the special tokens are the first sequences."""
        self.start: dict[str, int] = {}
        self.after: dict[str, int] = {}
        self.store = Store()
        ids = np.array([*self.special.values()], np.int64)
        self.store.add(ids, np.arange(1, len(ids) + 1))
        self.of_special = dict(zip(self.special, range(len(ids))))
        #: In how many slices each sequence came up.
        self.met = np.zeros(len(ids), np.int64)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols, -1 for those that don't merge."""
        if not len(self.pairs):
            return np.full(len(left), -1)
        pair = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((self.pairs[at] == pair) & (left >= 0) & (right >= 0), self.pair_ranks[at], -1)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row after all merges, and where each word stops."""
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        flat = np.frombuffer(b"\n".join(words) + b"\n", np.uint8)
        ends, n = np.cumsum(sizes) - 1, len(flat)
        sym = np.append(self.first[flat], -1)  # a mark behind each word, and one more at the end
        sym[ends] = -1
        nxt, prv = np.arange(1, n + 2), np.arange(-1, n)
        index = Index(len(self.merges) // BLOCK + 1)
        ranks = self.ranks_of(sym[:-1], sym[1:])
        places = np.flatnonzero(ranks >= 0)
        index.enter(ranks[places], places)
        one, one_next, one_prev = memoryview(sym), memoryview(nxt), memoryview(prv)
        rank_of, width = self.rank.get, self.width
        for r, parts in index.lists():
            left, right, new = self.merges[r]
            if left != right and sum(map(len, parts)) >= MANY:
                p = np.sort(np.concatenate(parts))
                p = p[np.append(True, p[1:] != p[:-1])]
                q = nxt[p]
                live = (sym[p] == left) & (sym[q] == right)
                p, q = p[live], q[live]
                sym[p], sym[q] = new, -2
                after = nxt[q]
                nxt[p], prv[after] = after, p
                before = prv[p]
                made = np.full(len(p), new)
                ranks = np.concatenate((self.ranks_of(sym[before], made), self.ranks_of(made, sym[after])))
                some = np.flatnonzero(ranks >= 0)
                index.enter(ranks[some], np.concatenate((before, p))[some])
                continue
            for p in sorted(chain.from_iterable(x.tolist() if isinstance(x, np.ndarray) else x for x in parts)):
                q = one_next[p]
                if one[p] != left or one[q] != right:
                    continue
                after, before = one_next[q], one_prev[p]
                one[p], one[q] = new, -2
                one_next[p], one_prev[after] = after, p
                if before >= 0 and (x := one[before]) >= 0 and (made := rank_of(x * width + new)) is not None:
                    index.enter_one(made, before)
                if (x := one[after]) >= 0 and (made := rank_of(new * width + x)) is not None:
                    index.enter_one(made, p)
        done = sym[:-1]
        done = done[done != -2]
        marks = np.flatnonzero(done == -1)
        return done[done >= 0], marks - np.arange(len(marks))

    def _parts(self, lead: str, chunk: str) -> list[str]:
        if chunk[:-1].isalpha() and chunk[-1] in ",.!?;:":
            return [lead + chunk[:-1], chunk[-1]]
        return _PARTS.findall(lead + chunk) if chunk and max(chunk) < _KNOWN else self.split.parts(lead + chunk)

    def _learn(self, chunks: list[str], table: dict[str, int], lead: str) -> None:
        """Encode new chunks into `table`; the pre-tokens they consist of are merged together, over one index.

        Letters alone, or with one mark behind, need no pattern.
        """
        kept = [c for c in chunks if c.isalpha()]
        number: dict[str, int] = {lead + c: i for i, c in enumerate(kept)}
        parts, counts = list(range(len(kept))), [1] * len(kept)
        for c in chunks:
            if not c.isalpha():
                ts = self._parts(lead, c)
                kept.append(c)
                counts.append(len(ts))
                for t in ts:
                    parts.append(number.setdefault(t, len(number)))
        tokens, merged = list(number), Store()
        for at in range(0, len(tokens), INDEXED):
            merged.add(*self.merge([t.encode() for t in tokens[at : at + INDEXED]]))
        flat, stops = merged.gathered(np.array(parts, np.int64))
        at = np.cumsum(np.array(counts, np.int64))
        table.update(zip(kept, range(len(self.store), len(self.store) + len(kept))))
        self.store.add(flat, np.concatenate(([0], stops))[at])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text as little-endian unsigned 32-bit integers."""
        chunks: list[str] = []
        begins: list[int] = []
        special: list[tuple[int, int]] = []
        sizes = []
        for text in texts:
            had = len(chunks)
            for at, part in enumerate(_around(text, self.special)):
                if at % 2:
                    special.append((len(chunks), self.of_special[part]))
                    chunks.append("")
                elif part:
                    begins.append(len(chunks))
                    chunks += chunks_of(part)
            sizes.append(len(chunks) - had)
        first, set_apart = {chunks[i] for i in begins}, np.array([*begins, *[i for i, _ in special]], np.int64)
        numbers = np.fromiter(map(self.after.get, chunks, repeat(-1)), np.int64, len(chunks))
        numbers[set_apart] = 0
        missing = np.flatnonzero(numbers < 0).tolist()
        fresh, fresh_first = {chunks[i] for i in missing}, first.difference(self.start)
        # Long chunks come last, so that they can go again after the slice.
        for of_length in (False, True):
            if of_length:
                short = len(self.store)
            self._learn([c for c in fresh if (len(c) > KEPT_LENGTH) == of_length], self.after, " ")
            self._learn([c for c in fresh_first if (len(c) > KEPT_LENGTH) == of_length], self.start, "")
        numbers[missing] = np.fromiter(map(self.after.__getitem__, map(chunks.__getitem__, missing)), np.int64, len(missing))
        numbers[begins] = np.fromiter(map(self.start.__getitem__, map(chunks.__getitem__, begins)), np.int64, len(begins))
        for i, k in special:
            numbers[i] = k
        flat, stops = self.store.gathered(numbers)
        little, at = flat.astype("<u4").tobytes(), np.concatenate(([0], stops))[np.cumsum(sizes)].tolist()
        self._trim(numbers, short, [c for c in fresh if len(c) > KEPT_LENGTH], [c for c in fresh_first if len(c) > KEPT_LENGTH])
        return [little[4 * a : 4 * b] for a, b in zip([0, *at], at)]

    def _trim(self, numbers: np.ndarray, short: int, long_after: list[str], long_start: list[str]) -> None:
        """Drop long chunks; in a full table, also those that came up in one slice only, or else all."""
        for table, long_ in ((self.after, long_after), (self.start, long_start)):
            for c in long_:
                del table[c]
        self.store.flat, self.store.stops = self.store.flat[: self.store.stops[short]], self.store.stops[: short + 1]
        self.met = np.concatenate((self.met, np.zeros(short - len(self.met), np.int64)))
        self.met[np.unique(numbers[numbers < short])] += 1
        if short <= KEPT:
            return
        stay = self.met > 1
        stay[: len(self.special)] = True
        if stay.sum() > KEPT // 2:
            return self.forget()
        new = np.cumsum(stay) - 1
        self.after = {c: int(new[k]) for c, k in self.after.items() if stay[k]}
        self.start = {c: int(new[k]) for c, k in self.start.items() if stay[k]}
        self.store.keep(np.flatnonzero(stay))
        self.met = np.ones(len(self.store), np.int64)

    def decode(self, ids: bytes) -> str:
        tokens = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.bytes_of.__getitem__, tokens)).decode("utf-8", "replace")


def _around(text: str, special: dict[str, int]) -> list[str]:
    """Text and special strings by turns; leftmost first, the longest of those that begin together."""
    if not any(s in text for s in special):
        return [text]
    out, at = [], 0
    while True:
        found = min(((text.find(s, at), -len(s), s) for s in special if text.find(s, at) >= 0), default=None)
        if found is None:
            return [*out, text[at:]]
        out += [text[at : found[0]], found[2]]
        at = found[0] + len(found[2])


_ODD_SPACE = re.compile(r" (?!\S)")


def chunks_of(text: str) -> list[str]:
    """The text cut at spaces before something else; those spaces are left out. Other spaces stay in a chunk."""
    parts = text.split(" ")
    if not _ODD_SPACE.search(text):
        return parts
    out, run = [], [parts[0]]
    for p in parts[1:]:
        if p and not p[0].isspace():
            out.append(" ".join(run))
            run = [p]
        else:
            run.append(p)
    return [*out, " ".join(run)]


_codecs: dict[int, Codec] = {}


def _codec(config: str) -> Codec:
    """One codec for each vocabulary and Python worker."""
    if hash(config) not in _codecs:
        _codecs.clear()
        _codecs[hash(config)] = Codec(config)
    return _codecs[hash(config)]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        config = file.read(MAX_VOCABULARY + 1)
    if len(config) > MAX_VOCABULARY:
        raise ValueError(f"{path} is larger than a vocabulary may be")
    return config


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", decoded: bool = False) -> DataFrame:
    """Rows of `docs` as struct `row`, with n_tokens and ids: binary, little-endian unsigned 32-bit integers.

    With `decoded`, the text that the ids decode to comes beside them, from the same task.
    """
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value)
        for batch in batches:
            texts = texts_of(batch, text_col)
            for a, b in slices(pc.binary_length(texts).to_pylist()):
                ids = codec.encode(texts.slice(a, b - a).to_pylist())
                columns = {"row": batch.column("row").slice(a, b - a), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary())}
                if decoded:
                    columns["decoded"] = pa.array(map(codec.decode, ids), pa.string())
                yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])
        codec.forget()  # a worker goes on to other tasks

    rows = with_text(docs, text_col)
    schema = rows.select("row").schema.add("n_tokens", "long").add("ids", "binary")
    return arrow_map(rows, of_batches, schema.add("decoded", "string") if decoded else schema)


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """The rows with column `decoded` after the others; special tokens are kept. Null ids give a null text."""
    sent = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value)
        for batch in batches:
            ids = batch.column(ids_col)
            for a, b in slices([len(x.as_py() or b"") for x in ids]):
                texts = [None if x is None else codec.decode(x) for x in ids.slice(a, b - a).to_pylist()]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"])

    return arrow_map(encoded, of_batches, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))
