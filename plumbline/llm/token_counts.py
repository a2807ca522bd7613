"""Token counts of a unigram model by dynamic programming over a trie of pre-tokens.

The distinct pre-tokens of a slice of texts are put in a trie, walked in sorted order. The best forward score of a node,
and the number of pieces on its best segmentation, are computed once from its ancestors, so pre-tokens that share a
prefix share its work; the count at a pre-token's terminal node is kept. A text's count is the sum over its pre-tokens.

Pieces come from a vocabulary file of the tokenizers library (byte-level, its path is a parameter); a piece of rank r
has the log-probability of Zipf's law, so nothing is trained. Among segmentations of equal score the one with the
longest last piece is taken, and so on towards the front.

Defined results: a null or empty text has no tokens; strings of special tokens are ordinary text; repeated rows each
get a row; an empty table gives an empty result. Other columns pass through.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.bpe import KEPT, KEPT_LENGTH, Splitter, byte_letters, chunks_of, read_vocabulary
from plumbline.llm.common import arrow_map, packed, slices, whole


def zipf_scores(vocab: dict[str, int]) -> dict[str, float]:
    """Log-probability of each piece, in proportion to one over its rank."""
    ranked = sorted(vocab, key=vocab.__getitem__)
    norm = math.log(sum(1 / r for r in range(1, len(ranked) + 1)))
    return {piece: -math.log(r) - norm for r, piece in enumerate(ranked, 1)}


class Counter:
    """Counts pieces of texts under one vocabulary file."""

    def __init__(self, config: str):
        self.split = Splitter(config)
        special = {t["content"] for t in json.loads(config)["added_tokens"]}
        scores = zipf_scores({p: i for p, i in json.loads(config)["model"]["vocab"].items() if p not in special})
        if any(c not in scores for c in byte_letters()):
            raise ValueError("every byte must be a piece")
        #: Pieces read backwards: byte -> node; the score of a piece stands under -1.
        self.back: dict = {}
        for piece, score in scores.items():
            node = self.back
            for c in reversed(piece):
                node = node.setdefault(self.split.byte_of[c], {})
            node[-1] = score
        self.start: dict[str, tuple[int, int]] = {}
        self.after: dict[str, tuple[int, int]] = {}
        #: Chunks that came up in more than one slice; they outlive a cleared table.
        self.again: set[str] = set()

    def terminal_counts(self, words: Iterable[bytes]) -> dict[bytes, int]:
        """Pieces of each distinct word on its best segmentation."""
        out: dict[bytes, int] = {}
        best, count, last, back = [0.0], [0], b"", self.back
        for word in sorted(words):
            shared, most = 0, min(len(word), len(last))
            while shared < most and word[shared] == last[shared]:
                shared += 1
            del best[shared + 1 :], count[shared + 1 :]
            for d in range(shared + 1, len(word) + 1):
                node, top, pieces = back, -math.inf, 0
                for j in range(d - 1, -1, -1):
                    node = node.get(word[j])
                    if node is None:
                        break
                    if -1 in node:
                        score = best[j] + node[-1]
                        if score >= top:
                            top, pieces = score, count[j] + 1
                best.append(top)
                count.append(pieces)
            out[word], last = count[-1], word
        return out

    def _learn(self, chunks: Iterable[str], table: dict[str, tuple[int, int]], lead: str) -> None:
        parts = {c: [t.encode() for t in self.split.parts(lead + c)] for c in chunks}
        counts = self.terminal_counts({t for ts in parts.values() for t in ts})
        for c, ts in parts.items():
            table[c] = (sum(map(counts.__getitem__, ts)), len(ts))

    def count(self, texts: list[str]) -> list[tuple[int, int]]:
        """(tokens, pre-tokens) of each text."""
        if len(self.after) > KEPT:
            self.after = {c: self.after[c] for c in self.again if c in self.after}
            if len(self.after) > KEPT // 2:
                self.after.clear()
            self.again.clear()
        if len(self.start) > KEPT:
            self.start.clear()
        cut = [chunks_of(t) for t in texts]
        self._learn({c[0] for c in cut}.difference(self.start), self.start, "")
        met: set[str] = set()
        for c in cut:
            met.update(c[1:])
        new = met.difference(self.after)
        self.again.update(met.difference(new))
        self._learn(new, self.after, " ")
        out = []
        for c in cut:
            tokens, pretokens = zip(self.start[c[0]], *map(self.after.__getitem__, c[1:]))
            out.append((sum(tokens), sum(pretokens)))
        for table in (self.start, self.after):
            for c in [c for c in table if len(c) > KEPT_LENGTH]:
                del table[c]
        return out


_counters: dict[int, Counter] = {}


def _counter(config: str) -> Counter:
    if hash(config) not in _counters:
        _counters.clear()
        _counters[hash(config)] = Counter(config)
    return _counters[hash(config)]


def token_counts(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """Rows of `docs` as struct `row`, with n_tokens and n_pretokens."""
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(sent.value)
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(texts.cast(pa.binary()).to_pandas().map(len)):
                counts = counter.count(texts.slice(a, b - a).to_pylist())
                columns = [pa.array([c[i] for c in counts], pa.int64()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(a, b - a), *columns], ["row", "n_tokens", "n_pretokens"])

    rows = docs.select(packed(docs).alias("row"), whole(text_col).alias("text"))
    return arrow_map(rows, of_batches, rows.select("row").schema.add("n_tokens", "long").add("n_pretokens", "long"))
