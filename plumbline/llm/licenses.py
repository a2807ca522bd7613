"""License scans by a generalised suffix automaton of the words of licence texts.

Every text is streamed through the automaton word by word, which gives its matching statistics: for each word the
longest run ending there that stands in some template. Where a run reaches `LEAST` words, the places of its last words
in the templates are the state's end places; places on one diagonal make up a match, as long as it goes. Matches of one
template that follow each other in the text and in the template, with gaps of at most `GAP` words, are chained, and a
chain that covers `SHARE` of its template is a span. Of spans that overlap the one that matches more words stays.
Phrases are templates of the same automaton that have to stand whole; every place counts.

The templates are a stated set; driver and tasks hold one automaton of them (`MOST_WORDS`, beyond it an error). Texts
aren't shuffled. Only runs of words and word pairs that the templates have can hold a match, so only those are streamed.
Chaining looks back over at most `GAP` words of text, so its work grows with the text.

Defined results: a null text is empty and has no words; a text without matches has score 0 and empty lists; repeated
rows are each scanned; a null label is an error; no templates and no phrases give no findings; an empty table gives an
empty result. Other columns pass through in `row`, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict, deque
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from plumbline.llm.common import arrow_map, packed, slices, whole
from plumbline.llm.decontaminate import PLAIN, words_of
from plumbline.llm.license_texts import PHRASES, TEMPLATES

#: Words of a match that counts for a chain.
LEAST = 4
#: Words that may stand between two matches of a chain, in the text and in the template.
GAP = 40
#: Share of a template's words that a span has to cover.
SHARE = 0.8
#: Words that a finding has to match for a score of 1.
SURE = 16
#: Words of all templates together.
MOST_WORDS = 1 << 20
_GAP, _END = -1, -2
_PAIRS = 1 << 20
_FOUND_DDL = (
    "n_words bigint, places array<struct<label: string, start: bigint>>, "
    "spans array<struct<label: string, template: int, start: bigint, end: bigint, matched: bigint, coverage: double>>, score double"
)
_FOUND_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("places", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))),
        (
            "spans",
            pa.list_(
                pa.struct(
                    [
                        ("label", pa.string()),
                        ("template", pa.int32()),
                        ("start", pa.int64()),
                        ("end", pa.int64()),
                        ("matched", pa.int64()),
                        ("coverage", pa.float64()),
                    ]
                )
            ),
        ),
        ("score", pa.float64()),
    ]
)


class Matcher:
    """The automaton with the end places of its states, and what is found with it in texts."""

    def __init__(self, templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]], least: int = LEAST, gap: int = GAP, share: float = SHARE):
        if any(label is None for label, _ in (*templates, *phrases)):
            raise ValueError("a label is missing")
        self.least, self.gap, self.share = least, gap, share
        self.number: dict[bytes, int] = {}
        self.templates = [(label, self._numbers(text)) for label, text in templates]
        self.phrases = [(label, self._numbers(text)) for label, text in phrases]
        sequences = [seq for _, seq in (*self.templates, *self.phrases) if seq]
        if sum(map(len, sequences)) > MOST_WORDS:
            raise ValueError(f"templates of more than {MOST_WORDS} words")
        self.lookup = {**self.number, b"\x00": _END}
        self.moves: list[dict[int, int]] = [{}]
        self.suffix, self.longest = [-1], [0]
        self.pairs = np.zeros(_PAIRS, bool)
        for seq in sequences:
            state = 0
            for word in seq:
                state = self._grown(state, word)
            a = np.array(seq, np.int64)
            self.pairs[self._pair(a[:-1], a[1:])] = True
        #: Smallest run that can matter; a phrase may be one word.
        self.shortest = min([least, *(len(seq) for _, seq in self.phrases if seq)])
        #: Templates and their places (exclusive ends) where the last `least` words of a state stand.
        self.ends: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, (_, seq) in enumerate(self.templates):
            state = length = 0
            for end, word in enumerate(seq, 1):
                state, length = self._read(state, length, word)
                if end >= least:
                    self.ends[self._holder(state, least)].append((t, end))
        whole_at: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, seq) in enumerate(self.phrases):
            state = length = 0
            for word in seq:
                state, length = self._read(state, length, word)
            if seq:
                whole_at[self._holder(state, len(seq))].append((len(seq), k))
        #: Phrases that are suffixes of what a state stands for.
        self.told: list[tuple[tuple[int, int], ...]] = [()] * len(self.moves)
        for s in sorted(range(1, len(self.moves)), key=self.longest.__getitem__):
            self.told[s] = (*whole_at.get(s, ()), *self.told[self.suffix[s]])

    def _numbers(self, text: str) -> list[int]:
        return [self.number.setdefault(w, len(self.number)) for w in words_of(text.encode())]

    @staticmethod
    def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * 1_000_003 + b * 7919) % _PAIRS

    def _state(self, longest: int, suffix: int, moves: dict[int, int]) -> int:
        self.longest.append(longest)
        self.suffix.append(suffix)
        self.moves.append(moves)
        return len(self.longest) - 1

    def _target(self, state: int, word: int) -> int:
        """Where `word` leads from `state`, as a state whose longest run is one word longer than that of `state`."""
        old = self.moves[state][word]
        if self.longest[old] == self.longest[state] + 1:
            return old
        part = self._state(self.longest[state] + 1, self.suffix[old], dict(self.moves[old]))
        self.suffix[old] = part
        while state >= 0 and self.moves[state].get(word) == old:
            self.moves[state][word] = part
            state = self.suffix[state]
        return part

    def _grown(self, state: int, word: int) -> int:
        if word in self.moves[state]:
            return self._target(state, word)
        new = self._state(self.longest[state] + 1, 0, {})
        while state >= 0 and word not in self.moves[state]:
            self.moves[state][word] = new
            state = self.suffix[state]
        if state >= 0:
            self.suffix[new] = self._target(state, word)
        return new

    def _read(self, state: int, length: int, word: int) -> tuple[int, int]:
        """State and matching statistic after one more word."""
        moves = self.moves
        while state and word not in moves[state]:
            state = self.suffix[state]
            length = self.longest[state]
        after = moves[state].get(word)
        return (0, 0) if after is None else (after, length + 1)

    def _holder(self, state: int, length: int) -> int:
        """The state of the last `length` words."""
        while self.longest[self.suffix[state]] >= length:
            state = self.suffix[state]
        return state

    def statistics(self, seq: Sequence[int]) -> Iterator[tuple[int, int]]:
        """(state, longest run of the templates that ends here) of each word."""
        state = length = 0
        for word in seq:
            state, length = self._read(state, length, word)
            yield state, length

    def candidates(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Runs of known words, neighbours all known pairs, that are long enough for a match or a phrase."""
        known = ids >= 0
        joined = known[:-1] & known[1:]
        at = np.flatnonzero(joined)
        joined[at] = self.pairs[self._pair(ids[at], ids[at + 1])]
        begins = np.flatnonzero(known & ~np.concatenate(([False], joined)))
        stops = np.flatnonzero(known & ~np.concatenate((joined, [False]))) + 1
        enough = stops - begins >= self.shortest
        return list(zip(begins[enough].tolist(), stops[enough].tolist()))

    def scanned(self, texts: list[bytes | None]) -> list[dict]:
        marked = b" \x00 ".join((x or b"").translate(PLAIN) for x in texts).split() + [b"\x00"]
        ids = np.fromiter(map(self.lookup.get, marked, repeat(_GAP)), np.int64, len(marked))
        stops = np.flatnonzero(ids == _END)
        begins = np.concatenate(([0], stops[:-1] + 1))
        places: list[list[tuple[int, int]]] = [[] for _ in texts]
        matches: list[dict[int, list[tuple[int, int, int]]]] = [defaultdict(list) for _ in texts]
        for a, b in self.candidates(ids):
            i = int(np.searchsorted(stops, a))
            self._matched(ids[a:b].tolist(), a - int(begins[i]), places[i], matches[i])
        return [self._found(n, p, m) for n, p, m in zip((stops - begins).tolist(), places, matches)]

    def _matched(self, run: list[int], base: int, places: list[tuple[int, int]], matches: dict[int, list[tuple[int, int, int]]]) -> None:
        """Places of phrases, and maximal matches (start in the text, end, start in the template) of each template."""
        least, open_ = self.least, {}
        for at, (state, length) in enumerate(self.statistics(run), base + 1):
            for n, k in self.told[state]:
                if n <= length:
                    places.append((at - n, k))
            going = {}
            if length >= least:
                for t, end in self.ends.get(self._holder(state, least), ()):
                    going[t, at - end] = open_.pop((t, at - end), at - least)
            for (t, shift), start in open_.items():
                matches[t].append((start, at - 1, start - shift))
            open_ = going
        for (t, shift), start in open_.items():
            matches[t].append((start, base + len(run), start - shift))

    def _found(self, n_words: int, places: list[tuple[int, int]], matches: dict[int, list[tuple[int, int, int]]]) -> dict:
        named = [{"label": self.phrases[k][0], "start": start} for start, k in sorted(places)]
        spans = []
        for t in matches:
            label, seq = self.templates[t]
            for start, end, covered in chains(matches[t], self.gap):
                if covered >= self.share * len(seq):
                    spans.append((covered, covered / len(seq), t, start, end))
        spans = apart(spans)
        best = max([n for n, *_ in spans] + [len(self.phrases[k][1]) for _, k in places], default=0)
        return {
            "n_words": n_words,
            "places": named,
            "spans": [
                {"label": self.templates[t][0], "template": t, "start": start, "end": end, "matched": n, "coverage": share}
                for n, share, t, start, end in sorted(spans, key=lambda s: s[3])
            ],
            "score": min(1.0, best / SURE),
        }


def chains(matches: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """(start, end, words covered) of disjoint chains of one template's matches, the best ones first.

    A match follows another when it goes on after it in the text and in the template, at most `gap` words on in each;
    what both hold counts once. Each match takes the predecessor that gives most words; chains are then traced back from
    the match with most words, and end where another chain has passed.
    """
    matches = sorted(matches)
    total, before = [0] * len(matches), [-1] * len(matches)
    near: deque[int] = deque()
    for i, (start, end, place) in enumerate(matches):
        total[i] = end - start
        while near and matches[near[0]][1] < start - gap:
            near.popleft()
        for j in near:
            j_start, j_end, j_place = matches[j]
            j_stop = j_place + j_end - j_start
            new = end - start - max(0, j_end - start, j_stop - place)
            follows = j_start < start and j_place < place and j_end >= start - gap and j_stop >= place - gap
            if follows and new > 0 and total[j] + new > total[i]:
                total[i], before[i] = total[j] + new, j
        near.append(i)
    used, out = [False] * len(matches), []
    for i in sorted(range(len(matches)), key=lambda i: (-total[i], i)):
        if used[i]:
            continue
        at = first = i
        while at >= 0 and not used[at]:
            used[at], first, at = True, at, before[at]
        out.append((matches[first][0], matches[i][1], total[i] - (total[at] if at >= 0 else 0)))
    return out


def apart(spans: list[tuple]) -> list[tuple]:
    """Of (words, share, template, start, end) those that do not overlap a better one."""
    kept: list[tuple] = []
    begins: list[int] = []
    for span in sorted(spans, key=lambda s: (-s[0], -s[1], s[2], s[3])):
        at = bisect_right(begins, span[3])
        if (at == 0 or kept[at - 1][4] <= span[3]) and (at == len(kept) or kept[at][3] >= span[4]):
            begins.insert(at, span[3])
            kept.insert(at, span)
    return kept


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    text_col: str = "text",
    least: int = LEAST,
    gap: int = GAP,
    share: float = SHARE,
) -> DataFrame:
    """Rows of `docs` as struct `row`, with n_words, places, spans and score.

    `places` are those of whole phrases (label, start), `spans` those of covered templates (label, template number,
    start, end exclusive, words matched, share of the template), all counted in words; `score` is the most words that a
    finding matches over `SURE`, at most 1.
    """
    sent = docs.sparkSession.sparkContext.broadcast(Matcher(templates, phrases, least, gap, share))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = [f for a, b in slices(map(len, texts)) for f in sent.value.scanned(texts[a:b])]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, _FOUND_ARROW)], ["row", "found"])

    rows = docs.select(packed(docs).alias("row"), whole(text_col).alias("text"))
    schema = rows.select("row").schema.add("found", T.StructType.fromDDL(_FOUND_DDL))
    return arrow_map(rows, of_batches, schema).select("row", "found.*")


def labels_of(*lists: str):
    """The distinct labels of the given columns, sorted and joined by commas."""
    return F.concat_ws(",", F.array_sort(F.array_distinct(F.concat(*[F.transform(name, lambda x: x["label"]) for name in lists]))))
