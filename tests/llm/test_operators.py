"""Each operator against a brute-force version on the table of edge cases, and on an empty table."""

from __future__ import annotations

import json
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from plumbline.llm import bpe, chat, decontaminate, exact, langid, line_dedup, queries, secrets, simhash, suffix, token_counts
from plumbline.llm.common import Scratch
from plumbline.llm.components import components
from tests.llm.edges import frame, rows as edge_rows, sha


def text_of(row):
    return row[1] or ""


def got(df):
    return Counter(tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.collect())


# --- exact dedup ----------------------------------------------------------------------------------


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups(spark, keep):
    data, held = edge_rows(), defaultdict(list)
    for r in data:
        held[text_of(r)].append(r[0])
    out = exact.groups(frame(spark), keep=keep).collect()
    assert len(out) == len(data)
    for t, ids in held.items():
        mine = [r for r in out if r.text_sha256 == sha(t)]
        known = [i for i in ids if i is not None]
        best = (max if keep == "largest" else min)(known) if known else None
        assert {(r.keep_id, r.group_size) for r in mine} == {(best, len(ids))}
        assert sum(r.kept for r in mine) == 1
        assert Counter(r.doc_id for r in mine) == Counter(ids)
        if keep == "largest":
            assert [r.doc_id for r in mine if r.kept] == [best]


def test_exact_group_over_many_ranges(spark):
    some = [(i, "the same text", None, None, None, None, None, None, None, None) for i in range(300)]
    out = exact.groups(frame(spark, some)).collect()
    assert {(r.keep_id, r.group_size) for r in out} == {(299, 300)} and [r.doc_id for r in out if r.kept] == [299]
    assert exact.dedup(frame(spark, some)).count() == 1


def test_exact_dedup_passes_columns(spark):
    df = frame(spark)
    out = exact.dedup(df)
    assert out.columns == df.columns and out.count() == len({text_of(r) for r in edge_rows()})


# --- suffix dedup ---------------------------------------------------------------------------------


def brute_suffix(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        runs = [(m.start(), m.end()) for m in re.finditer(b"\x01+", bytes(gone))]
        out.append((sha(t), tuple(runs), sha(bytes(b for b, g in zip(t, gone) if not g))))
    return out


@pytest.mark.parametrize("length", [200, 40])
def test_suffix(spark, length):
    texts = [text_of(r).encode() for r in edge_rows()]
    out = suffix.remove_repeats(frame(spark), length).select("digest", "removed", F.sha2("kept", 256)).collect()
    assert {(r[0], tuple(map(tuple, r[1])), r[2]) for r in out} == set(brute_suffix(texts, length))
    assert len(out) == len(set(texts))


def test_suffix_random_passages(spark):
    rng = random.Random(8)
    passages = ["".join(rng.choices("abc ", k=rng.randint(150, 600))) for _ in range(6)]
    texts = []
    for _ in range(60):
        t = "".join(rng.choices("abcd", k=rng.randint(0, 80)))
        for p in rng.choices(passages, k=rng.randint(0, 3)):
            a, b = sorted(rng.choices(range(len(p) + 1), k=2))
            t += p[a:b] + "".join(rng.choices("efg", k=rng.randint(0, 30)))
        texts.append(t)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = suffix.remove_repeats(df, 200).select("digest", "removed", F.sha2("kept", 256)).collect()
    assert {(r[0], tuple(map(tuple, r[1])), r[2]) for r in out} == set(brute_suffix([t.encode() for t in texts], 200))


def test_suffix_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(suffix, "PIECE", 1 << 10)
    text = bytes(np.random.default_rng(1).integers(97, 100, 5000, dtype=np.uint8))
    groups = [suffix.anchors(g, 200, 100) for g in suffix._pieces([(0, text)], 200)]
    owned = sorted(p for g in groups for lo, n in zip(g["lo"].tolist(), g["n"].tolist()) for p in range(lo, lo + n))
    assert owned == list(range(5000 - 199))


# --- SimHash --------------------------------------------------------------------------------------


def brute_fingerprint(text, k):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
    parts = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark):
    data = edge_rows()
    fps = [brute_fingerprint(text_of(r), 3) for r in data]
    root = list(range(len(data)))
    for _ in data:
        root = [min(root[j] for j in range(len(data)) if (fps[i] ^ fps[j]).bit_count() <= 3) for i in range(len(data))]
    least = {c: min((data[i][0] for i in range(len(data)) if root[i] == c and data[i][0] is not None), default=None) for c in set(root)}
    out = simhash.grouped(frame(spark), small=2).select("doc_id", simhash.hexed(F.col("fp")), "component_id")
    assert got(out) == Counter((r[0], f"{f:016x}", least[c]) for r, f, c in zip(data, fps, root))
    df = frame(spark)
    kept = simhash.dedup(df)
    assert kept.columns == df.columns
    groups = Counter(r[0] for r in kept.select(F.sha2(F.coalesce("text", F.lit("")), 256)).collect())
    assert len(groups) <= len(set(root))


def test_near_pairs_of_a_crowded_bucket(spark):
    rng, base = random.Random(2), 0x0123456789ABCDEF
    fps = {base}
    for _ in range(250):
        f = base
        for b in rng.sample(range(64), rng.randint(1, 5)):
            f ^= 1 << b
        fps.add(f)
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    expected = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert set(map(tuple, simhash.near_pairs(df, 3, Scratch(spark, "t"), small=4).collect())) == expected


def test_every_radius_is_covered():
    masks = simhash.covering_masks(list(range(64)), 3)
    rng = random.Random(1)
    for _ in range(3000):
        places = sum(1 << p for p in rng.sample(range(64), 3))
        assert any(not m & places for m in masks)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 201), (5, 5)], "a long, b long")
    out = dict(map(tuple, components(edges, Scratch(spark, "t")).collect()))
    assert out == {**{i: 0 for i in range(101)}, 200: 200, 201: 200}


# --- decontamination ------------------------------------------------------------------------------

ITEMS = [
    (1, "One two three, four five six seven eight nine ten eleven twelve thirteen"),
    (2, "short ITEM here"),
    (3, None),
    (4, "..."),
    (None, "two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (10, "short item"),
    (2, "here too"),
]


def brute_hits(text, items, window=13):
    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    words, hit, found = split(text), set(), set()
    for item, t in items:
        w = split(t)
        k = min(window, len(w))
        for a in range(len(w) - k + 1 if k else 0):
            for i in range(len(words) - k + 1):
                if words[i : i + k] == w[a : a + k]:
                    hit.update(range(i, i + k))
                    found.add(item)
    return len(words), len(hit), tuple(sorted(str(i) for i in found if i is not None)), len(hit) > 0 and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_contamination(spark, block_bytes):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontaminate.contamination(frame(spark), bench, block_bytes=block_bytes).select("row.doc_id", "n_words", "n_hit", "items", "contaminated")
    assert got(out) == Counter((r[0], *brute_hits(text_of(r), ITEMS)) for r in edge_rows())


def test_long_items_are_cut_without_losing_windows(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE", 16)
    rng = random.Random(8)
    items = [(1, " ".join(f"t{rng.randrange(40)}" for _ in range(90))), (2, " ".join(f"t{i}" for i in range(13))), (3, "t1 t2 t3")]
    long = items[0][1].split()
    texts = [(i, " ".join(["pad", *long[i : i + 11 + i % 5], "pad"])) for i in range(75)] + [(99, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_bytes in (1 << 20, 200):
        out = decontaminate.contamination(spark.createDataFrame(texts, "doc_id long, text string"), bench, block_bytes=block_bytes)
        assert got(out.select("row.doc_id", "n_words", "n_hit", "items", "contaminated")) == Counter((i, *brute_hits(t, items)) for i, t in texts)


def test_contamination_without_items_and_clean_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    df = frame(spark)
    assert decontaminate.contamination(df, none).where("n_hit > 0 OR contaminated").count() == 0
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.remove(df, bench)
    assert kept.columns == df.columns
    assert kept.count() == sum(not brute_hits(text_of(r), ITEMS)[3] for r in edge_rows())


def test_hit_spans_are_cut_out(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    long = " ".join(f"ünö{i}" for i in range(2000))
    docs = [
        (1, f"{long}\n«{passage.replace(' ', ', ').upper()}»\n{long}"), (2, f"{long} tiny item {long}"), (3, "a tiny item here"),
        (4, passage), (5, "nothing of it"), (6, None), (7, f"{long} {passage} x {passage}"),
    ]
    bench = spark.createDataFrame([(1, passage), (2, "tiny item")], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    expected = {2: (docs[1][1], 0), 3: ("a  here", 2), 4: ("", 30), 5: (docs[4][1], 0), 6: ("", 0), 7: (f"{long}  x ", 60)}
    # A byte beyond ASCII belongs to a word, so the marks stay with the first and last words, which aren't hit.
    expected[1] = (f"{long}\n«P0, , P29»\n{long}", 28)
    assert {r.doc_id: (r.cleaned, r.n_cut) for r in decontaminate.clean(df, bench).select("row.doc_id", "cleaned", "n_cut").collect()} == expected
    kept = decontaminate.clean(df, bench, least=31).select("row.doc_id", "cleaned").collect()
    assert {r.doc_id: r.cleaned for r in kept} == {**{i: t or "" for i, t in docs}, 3: "a  here", 4: ""}
    assert {r.doc_id for r in decontaminate.clean(df, bench, least=2).where("n_cut > 0").select("row.doc_id").collect()} == {1, 2, 3, 4, 7}


def test_automaton_on_random_items():
    rng = random.Random(4)
    items = [(i, " ".join(rng.choices("abc", k=rng.randint(1, 12)))) for i in range(20)]
    automaton = decontaminate.Automaton([(str(i), decontaminate.words_of(t.encode())) for i, t in items], 4)
    for _ in range(200):
        text = " ".join(rng.choices("abcd", k=rng.randint(0, 30)))
        n, hits, found = decontaminate.scan_texts([text.encode()], automaton)[0]
        assert (n, sum(b - a for a, b in hits), tuple(sorted(found))) == brute_hits(text, items, 4)[:3]


# --- secrets --------------------------------------------------------------------------------------

BRUTE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def brute_secrets(text):
    found = [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, p, ok) in enumerate(BRUTE) for m in p.finditer(text) if ok(m)]
    return ",".join(x for _, _, x in sorted(found))


def test_secrets(spark):
    out = secrets.scan(frame(spark)).select("doc_id", secrets.joined(secrets.of_kind(F.col("findings"), "assign", "access", "hex")))
    assert got(out) == Counter((r[0], brute_secrets(text_of(r))) for r in edge_rows())


def test_ledger_scans_only_what_is_new(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    df = frame(spark)
    first = secrets.update_ledger(df, ledger, secrets.BASE).count()
    contents = len({text_of(r) for r in edge_rows()})
    assert spark.read.parquet(ledger).where("start IS NULL").count() == 3 * contents
    assert secrets.update_ledger(df, ledger, secrets.BASE).count() == first
    assert spark.read.parquet(ledger).count() == first
    newer = (*secrets.BASE[:2], secrets.Rule("hex", r"[0-9a-f]{24,}", version=2))
    more = df.unionByName(frame(spark, [(999, "token=abcdefghij", *[None] * 8)]))
    found = secrets.scan(more, ledger, newer)
    scanned = spark.read.parquet(ledger).where("start IS NULL").groupBy("rule", "version").count().collect()
    assert {(r[0], r[1]): r[2] for r in scanned} == {
        ("assign", 1): contents + 1, ("access", 1): contents + 1, ("hex", 1): contents, ("hex", 2): contents + 1,
    }
    assert found.where("doc_id = 999").select(secrets.joined(F.col("findings"))).first()[0] == "assign:0:16"


# --- BPE and token counts -------------------------------------------------------------------------


def test_bpe(spark):
    reference = Tokenizer.from_file(queries.VOCABULARY)
    columns = ["row.doc_id", "n_tokens", "ids", "decoded"]
    out = bpe.decode(bpe.encode(frame(spark), queries.VOCABULARY), queries.VOCABULARY).select(columns)
    assert got(bpe.encode(frame(spark), queries.VOCABULARY, decoded=True).select(columns)) == got(out)
    expected = Counter()
    for r in edge_rows():
        ids = reference.encode(text_of(r), add_special_tokens=False).ids
        expected[r[0], len(ids), np.array(ids, "<u4").tobytes(), reference.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r[0], r[1], bytes(r[2]), r[3]) for r in out.collect()) == expected


MIXED = ["a", "b", "the", " ", "  ", "\n", " \n", "'s", "é", "日本", "1", "23", ",", "<|endoftext|>", "\t", "\xa0", "aaaa", "!!", "😀", "\x1c", "ſ"]


def test_bpe_and_counts_on_mixed_strings(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 50)
    monkeypatch.setattr(token_counts, "KEPT", 50)
    monkeypatch.setattr(bpe, "INDEXED", 7)
    rng, config = random.Random(5), bpe.read_vocabulary(queries.VOCABULARY)
    codec, reference = bpe.Codec(config), Tokenizer.from_file(queries.VOCABULARY)
    counter = token_counts.Counter(config)
    vocab = {p: i for p, i in json.loads(config)["model"]["vocab"].items()}
    scores = token_counts.zipf_scores(vocab)
    unigram = Tokenizer(models.Unigram([("<unk>", 0.0)] + [(p, scores[p]) for p in sorted(vocab, key=vocab.get)], unk_id=0, byte_fallback=False))
    unigram.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    for _ in range(40):
        texts = ["".join(rng.choices(MIXED, k=rng.randint(0, 30))) for _ in range(20)]
        for text, ids, count in zip(texts, codec.encode(texts), counter.count(texts)):
            expected = reference.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == expected
            assert codec.decode(ids) == reference.decode(expected, skip_special_tokens=False) == text
            assert count == (len(unigram.encode(text).ids), len(unigram.pre_tokenizer.pre_tokenize_str(text)))


def small_vocabulary(pairs=(), far=0, **model):
    """A byte-level file of the tokenizers library with a few merges; ids begin at `far`."""
    letters = bpe.byte_letters()
    tokens = [*letters, *(a + b for a, b in pairs)]
    held = json.loads(bpe.read_vocabulary(queries.VOCABULARY))
    held["model"].update(vocab={t: far + i for i, t in enumerate(tokens)}, merges=[list(p) for p in pairs], **model)
    held["added_tokens"] = []
    return json.dumps(held)


def test_bpe_merges_by_arrays_and_by_positions(monkeypatch):
    """Words of two letters, many of them overlapping, so that each kind of list is met."""
    pairs = [("a", "b"), ("a", "a"), ("ab", "ab"), ("b", "b"), ("aa", "ab"), ("aa", "aa"), ("abab", "a"), ("bb", "aa")]
    for many, block in ((1, 1), (3, 2), (10**9, 512)):
        monkeypatch.setattr(bpe, "MANY", many)
        monkeypatch.setattr(bpe, "BLOCK", block)
        codec = bpe.Codec(small_vocabulary(pairs))
        rng = random.Random(many)
        words = ["".join(rng.choices("ab", k=rng.randint(1, 30))) for _ in range(400)]
        flat, stops = codec.merge([w.encode() for w in words])
        for w, a, b in zip(words, [0, *stops.tolist()], stops.tolist()):
            parts = list(w)
            for left, right in pairs:
                i = 0
                while i < len(parts) - 1:
                    if (parts[i], parts[i + 1]) == (left, right):
                        parts[i : i + 2] = [left + right]
                    i += 1
            assert [codec.bytes_of[i].decode() for i in flat[a:b].tolist()] == parts


def test_bpe_ids_beyond_16_bits():
    config = small_vocabulary([("a", "b")], far=100_000)
    codec, reference = bpe.Codec(config), Tokenizer.from_str(config)
    ids = codec.encode(["ab ba abab", ""])
    assert np.frombuffer(ids[0], "<u4").tolist() == reference.encode("ab ba abab").ids and ids[1] == b""
    assert codec.decode(ids[0]) == "ab ba abab"


@pytest.mark.parametrize("setting", [{"ignore_merges": True}, {"dropout": 0.1}, {"continuing_subword_prefix": "##"}, {"end_of_word_suffix": "</w>"}])
def test_bpe_refuses_settings_it_does_not_have(setting):
    with pytest.raises(ValueError):
        bpe.Codec(small_vocabulary([("a", "b")], **setting))


def test_bpe_splits_as_the_library_does():
    pre, byte_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True), {c: b for b, c in enumerate(bpe.byte_letters())}
    for first in range(0, ord(bpe._KNOWN), 8):
        text = "".join(f"x{chr(c)}1{chr(c)}! {chr(c)}?\n" for c in range(first, min(first + 8, ord(bpe._KNOWN))))
        assert bpe._PARTS.findall(text) == [bytes(map(byte_of.__getitem__, t)).decode() for t, _ in pre.pre_tokenize_str(text)]


def test_token_counts_rows(spark):
    counter = token_counts.Counter(bpe.read_vocabulary(queries.VOCABULARY))
    out = token_counts.token_counts(frame(spark), queries.VOCABULARY).select("row.doc_id", "n_tokens", "n_pretokens")
    assert got(out) == Counter((r[0], *counter.count([text_of(r)])[0]) for r in edge_rows())


# --- line dedup -----------------------------------------------------------------------------------


def test_patience_aligns_and_keeps_order():
    a, b = [1, 2, 3, 4, 5, 9, 9], [7, 2, 3, 8, 5, 9, 9]
    assert line_dedup.patience(a, b) == [(1, 1), (2, 2), (4, 4), (5, 5), (6, 6)]
    assert line_dedup.common_blocks(a, b, {3}) == [1, 2]
    rng = random.Random(1)
    for _ in range(200):
        a, b = rng.choices(range(9), k=rng.randint(0, 12)), rng.choices(range(9), k=rng.randint(0, 12))
        pairs = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p < q and r < s for (p, r), (q, s) in zip(pairs, pairs[1:]))


def brute_lines(data):
    known = {}
    for r in data:
        t, key = text_of(r), (r[0] is None, r[0] or 0)
        known[t] = min(known.get(t, key), key)
    order = sorted(known, key=lambda t: (known[t], sha(t)))
    lines = {t: line_dedup.line_hashes(t.encode()) for t in order}
    first, left = {}, {}
    for t in order:
        hashes, seeds = lines[t]
        gone = set()
        for e in {first[s] for s in seeds if s in first}:
            gone.update(line_dedup.common_blocks(lines[e][0], hashes, set(seeds)))
        for s in seeds:
            first.setdefault(s, t)
        left[t] = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
    out = Counter()
    for r in data:
        t = text_of(r)
        again = bool(lines[t][1]) and (r[0] is None, r[0] or 0) != known[t]
        out[r[0], len(t.split("\n")), "" if again else left[t]] += 1
    return out


def test_line_dedup(spark):
    df = frame(spark)
    assert got(line_dedup.dedup(df).select("row.doc_id", "n_lines", "kept")) == brute_lines(edge_rows())


def brute_all_pairs(data):
    """Every text aligned with every earlier one that shares a line: (doc_id, what is left) of distinct texts."""
    lines, out = [], {}
    for i, t in data:
        hashes, seeds = line_dedup.line_hashes(t.encode())
        gone = set()
        for before, shared in lines:
            if shared & set(seeds):
                gone.update(line_dedup.common_blocks(before, hashes, set(seeds)))
        lines.append((hashes, set(seeds)))
        out[i] = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)
    return out


def kept_lines(spark, data):
    return {r.doc_id: r.kept for r in line_dedup.dedup(spark.createDataFrame(data, "doc_id long, text string").repartition(3)).select("row.doc_id", "kept").collect()}


def test_line_dedup_aligns_later_holders(spark):
    p, q = "this passage is the first of two", "that passage is the second of two"
    repeated = [(0, f"a\n{p}\nb\n{p}\nc"), (1, f"d\n{p}\ne"), (2, f"f\n{p}\ng"), (3, f"h\n{p}\ni")]
    assert kept_lines(spark, repeated) == {0: repeated[0][1], 1: "d\ne", 2: "f\ng", 3: "h\ni"}
    crossed = [(0, f"a\n{p}\nb\n{q}\nc"), (1, f"d\n{q}\ne\n{p}\nf"), (2, f"g\n{q}\nh\n{p}\ni")]
    assert kept_lines(spark, crossed) == brute_all_pairs(crossed) and kept_lines(spark, crossed)[2] == "g\nh\ni"


def test_line_dedup_links_follow_the_occurrences_of_a_repeated_line(spark, monkeypatch):
    """A line that stands twice in each text, between lines of its own, is deleted with n - 1 links."""
    links, keep = [], Scratch.keep

    def spied(self, df, name, collect=False):
        out = keep(self, df, name, collect)
        if name == "links":
            links.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "keep", spied)
    footer = "this footer stands in each of the texts"
    for n in (100, 200):
        links.clear()
        data = [(i, f"one {i}\n{footer}\ntwo {i}\n{footer}\nthree {i}") for i in range(n)]
        assert kept_lines(spark, data) == {0: data[0][1], **{i: f"one {i}\ntwo {i}\nthree {i}" for i in range(1, n)}}
        assert sum(links) == n - 1


@pytest.mark.parametrize("holders", [(), (2, 3)])
def test_line_dedup_is_that_of_all_pairs(spark, monkeypatch, holders):
    rng = random.Random(12)
    long_ = [f"the line number {i} that has words enough" for i in range(12)]
    data = []
    for i in range(150):
        lines = rng.choices([*long_, "", "short", "of words", f"own line {i}"], k=rng.randint(1, 9))
        data.append((i, "\n".join([f"start {i}", *lines, f"end {i}"])))
    monkeypatch.setattr(line_dedup, "HOLDERS", holders)
    assert kept_lines(spark, data) == brute_all_pairs(data)


def test_line_dedup_of_short_lines(spark):
    verse = "\n".join(f"verse of {i}" for i in range(40))
    chinese, thai, code = "\n".join("今天天气很好" + "啊" * i for i in range(1, 6)), "สวัสดีชาวโลก", "f(x)\n{\n\ny = 2\nreturn y"
    data = [(0, f"a\n{verse}"), (1, f"b\n{verse}\nc"), (2, f"d\n{chinese}"), (3, f"e\n{chinese}\nf"), (4, f"g\n{thai}"), (5, f"h\n{thai}\ni")]
    data += [(6, f"j\n{code}"), (7, f"k\n{code}\nl"), (8, "ok"), (9, "ok"), (10, "m\nok"), (11, "n\nok"), (12, ""), (13, "")]
    left = {1: "b\nc", 3: "e\nf", 5: "h\ni", 7: "k\nl", 9: ""}
    assert kept_lines(spark, data) == {i: left.get(i, t) for i, t in data}


def test_line_dedup_of_short_lines_is_that_of_all_pairs(spark):
    rng = random.Random(13)
    lines = ["", "a b", "c d", "e", "f g h", "}", "i j k l", "天气很好", "one line of five words"]
    data = [(i, "\n".join([f"start{i}", *rng.choices(lines, k=rng.randint(1, 12)), f"end{i}"])) for i in range(150)]
    assert kept_lines(spark, data) == brute_all_pairs(data)


# --- language ID ----------------------------------------------------------------------------------


def test_language_id(spark):
    rng = random.Random(6)
    syllables = {"en": "th er ing on".split(), "de": "sch ung ein ß".split(), "fr": "eau ê ier ou".split()}
    docs = []
    for i in range(240):
        lang = list(syllables)[i % 3]
        words = ["".join(rng.choices(syllables[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(5, 60))]
        docs.append((i, " ".join(words), lang))
    train = spark.createDataFrame(docs[:120], "doc_id long, text string, lang string")
    model = langid.fit(train, rows=60)
    assert model.languages == ["de", "en", "fr"]
    pages = [(i, f"http://a.{lang}.example.org/{i}", f"<html lang='{lang}'><style>x</style><p>{text}</p></html>") for i, text, lang in docs[120:]]
    pages += [(900, None, None), (901, "http://b.example.org/", "<p>  123 </p>"), (902, "http://c.de/x", "<html lang=de><p>ok</p>"), (902, "http://c.de/x", "<html lang=de><p>ok</p>")]
    out = langid.identify_pages(spark.createDataFrame(pages, "page_id long, url string, html string"), model).select("row.page_id", "language", "confidence").collect()
    assert len(out) == len(pages)
    said = {r.page_id: r.language for r in out}
    assert sum(said[i] == lang for i, _, lang in docs[120:]) >= 118
    assert said[900] == said[901] == "und" and said[902] == "de"
    assert all(0 <= r.confidence <= 1 for r in out)
    held_out = [max(zip(model.text(t.encode())[1], model.languages))[1] == lang for _, t, lang in docs[120:]]
    assert sum(held_out) >= 0.95 * len(held_out)


def test_host_priors_by_brute_force(spark):
    votes = [("a.x.org", 0), ("a.x.org", 0), ("b.x.org", 1), (None, 1), ("c.y.org", -1)]
    out = {r.host: r for r in langid.host_priors(spark.createDataFrame(votes, "host string, vote int"), 2).collect() if r.host}
    assert (out["a.x.org"].h0, out["a.x.org"].d0, out["a.x.org"].d1) == (2, 2, 1) and out["b.x.org"].h1 == 1


def test_language_stage_keeps_clean_rows(spark):
    df = frame(spark)
    kept = langid.keep_identified(df, langid.fit(df))
    assert kept.columns == df.columns
    texts = [r.text or "" for r in kept.collect()]
    assert all(any(c.isalpha() for c in t) for t in texts)
    assert len(texts) >= sum(any(c.isalpha() for c in text_of(r)) for r in edge_rows()) - 6


def spelled(number, digits="bcdfghjklm"):
    return "".join(digits[int(d)] for d in str(number))


def test_every_label_gets_a_model(spark):
    docs = [(f"{spelled(100 + i)} word{spelled(k)}", f"l{i}") for i in range(70) for k in range(2)]
    docs += [("ひらがなの文章です", "ja"), *[(f"the common text {spelled(k)}", "en") for k in range(300)]]
    docs += [("the common text", "en")] * 300 + [("the unlabelled text", None)] * 2000
    model = langid.fit(spark.createDataFrame(docs, "text string, lang string").repartition(3), rows=50)
    assert model.languages == sorted({lang for _, lang in docs if lang})
    said = model.languages[int(np.argmax(model.text("ひらがなの文章".encode())[1]))]
    assert said == "ja"


def test_copies_and_unlabelled_rows_do_not_shrink_the_sample(spark):
    docs = [(f"{spelled(k)}", "en") for k in range(100, 400)] + [("same", None)] * 3000
    few, all_ = (langid.fit(spark.createDataFrame(docs, "text string, lang string").repartition(3), rows=n) for n in (300, 4000))
    assert (few.logs == all_.logs).all()


def test_too_many_labels_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    with pytest.raises(ValueError, match="more than 2 labels"):
        langid.fit(spark.createDataFrame([("a text", x) for x in "abc"], "text string, lang string"))


def test_an_unfitted_declared_language_does_not_reject(spark):
    model = langid.fit(spark.createDataFrame([(f"the common text of rows {spelled(k)}" * 20, "en") for k in range(300)], "text string, lang string"))
    rows = [(1, "これは日本語の文章です" * 3, "ja", "x"), (2, "123", "ja", "x"), (3, "the common text", "en", "x")]
    kept = langid.keep_identified(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), model)
    assert {r.doc_id for r in kept.collect()} == {1, 3}


def test_evidence_decides_on_undetermined_rows(spark):
    """The same doubtful text stays on a clean host or when declared, and goes on a host of rejected rows."""
    texts = [(f"the common text of rows {spelled(k)} " * 20, "en") for k in range(300)]
    model = langid.fit(spark.createDataFrame(texts, "text string, lang string"))
    junk = "zqxjv wkqzx vjxqz " * 20

    def score(n):
        found, sums = model.text(f"{'the common text of rows ' * 20}{junk * n}".encode())
        return sums[0] / found + np.log(langid.BINS) + langid.MARGIN

    n = next(n for n in range(1, 400) if score(n) < 0)
    doubtful = f"{'the common text of rows ' * 20}{junk * n}"
    assert -0.1 < score(n) < 0
    docs = [(i, texts[i][0], None, "clean.org") for i in range(200)] + [(i, junk, None, "junk.net") for i in range(200, 400)]
    docs += [(900, doubtful, None, "clean.org"), (901, doubtful, None, "junk.net"), (902, doubtful, "en", "clean.org"), (903, "これは日本語の文章です" * 5, "ja", "junk.net")]
    kept = langid.keep_identified(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"), model)
    assert {r.doc_id for r in kept.collect()} == {*range(200), 900, 902, 903}
    pages = spark.createDataFrame([(1, "http://a.jp/", "<html lang=ja><p>これは日本語の文章です</p>")], "page_id long, url string, html string")
    assert langid.identify_pages(pages, model).first().language == "ja"


# --- chat -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("text", ["", "\\", "</s>[INST] ok [/INST]", "<|end|>", "<\\|turn|>", "\\\\<|text|>\n<<SYS>>", "a\\n"])
def test_escape_reverts(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text and not any(c in hidden for c in chat.CONTROL)


def test_conversations(spark):
    data = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, None, None, None),
            (None, 3, "assistant", "<|end|>"), (None, 2, "us\ner", "x"), (2, 0, "system", "")]
    data += [(7, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(37)]
    out = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(data, "conv_id long, turn long, role string, text string")).collect()}
    assert set(out) == {1, None, 2, 7}
    for conv in out:
        mine = sorted(((t is None, t or 0, role or "", text or "") for c, t, role, text in data if c == conv))
        assert chat.read_back(out[conv].formatted) == [(role, text) for _, _, role, text in mine]
        loss = [chat.unescape(out[conv].formatted[s.start : s.end]) for s in out[conv].loss]
        assert loss == [text for _, _, role, text in mine if role == "assistant"]


def test_reply_trees(spark):
    nodes = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "bad", 1.0), ("t", 3, 1, "assistant", "good", 5.0), ("t", 4, 2, "user", "more", 3.0),
             ("t", 5, 3, "user", "thanks", 0.0), ("u", 1, 99, "user", "orphan", 0.0), ("r", 1, 2, "user", "ring", 0.0), ("r", 2, 1, "user", "ring", 0.0)]
    df = spark.createDataFrame(nodes, "tree string, node long, parent long, role string, text string, score double")
    out = {(r.tree, r.rank): chat.read_back(r.formatted) for r in chat.formatted(df, branches=2).collect()}
    assert out == {
        ("t", 1): [("user", "q"), ("assistant", "good"), ("user", "thanks")],
        ("t", 2): [("user", "q"), ("assistant", "bad"), ("user", "more")],
        ("u", 1): [("user", "orphan")],
    }


# --- empty tables ---------------------------------------------------------------------------------


def test_empty_tables(spark):
    df = frame(spark, [])
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    for out in (
        exact.groups(df), exact.dedup(df), suffix.remove_repeats(df), simhash.grouped(df), simhash.dedup(df), decontaminate.remove(df, bench),
        secrets.scan(df), bpe.encode(df, queries.VOCABULARY), token_counts.token_counts(df, queries.VOCABULARY), line_dedup.dedup(df),
        langid.keep_identified(df, langid.fit(df)),
        chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")),
    ):
        assert out.collect() == []
