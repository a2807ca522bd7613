"""Conversation repair against a plain recursion over the same rules."""

from __future__ import annotations

import random
import re
import sys
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from plumbline.llm import queries, repair
from tests.llm.edges import sha

SCHEMA = "conv_id long, turn long, role string, text string"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def harmed(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        told = ":".join(" " if v is None else str(v) for v in (conv, turn))
        harm = zlib.crc32(told.encode()) % 20
        if harm == 1:
            text = ""
        if harm == 2:
            text = re.sub("[.!?]", "", text)
        if harm == 4:
            role = "user"
        for _ in range({0: 0, 3: 2}.get(harm, 1)):
            yield conv, turn, role, text


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """(cost, edits, lines) by recursion from the end."""

    @lru_cache(None)
    def best(at, read, inserted):
        after = "a" if read == "u" else "u"
        ways = [] if at < len(rows) or read in ("s", "u") else [(0, "")]
        if inserted < 3:
            cost, edits = best(at, after, inserted + 1)
            ways.append((cost + 3, "I" + edits))
        if at < len(rows):
            role, more = rows[at][2], 3 * (faults[at] == "truncated")
            cost, edits = best(at + 1, read, 0)
            ways.append((cost + 4, "D" + edits))
            if faults[at] not in ("blank", "duplicate"):
                cost, edits = best(at + 1, after, 0)
                ways.append((cost + 3 + more, "R" + edits))
                if role[:1] == after or (role[:1] == "s" and read == ""):
                    cost, edits = best(at + 1, role[:1], 0)
                    ways.append((cost + more, "K" + edits))
        return min(ways, default=(10**9, ""))

    sys.setrecursionlimit(20_000)
    cost, edits = best(0, "", 0)
    at, read, lines = 0, "", []
    for edit in edits:
        role, text = ("", "") if edit == "I" else rows[at][2:]
        if edit in "IR":
            role = "assistant" if read == "u" else "user"
        if edit != "D":
            lines.append(f"{role}:{text}")
            read = role[:1]
        at += edit != "I"
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
    return cost, edits, lines


def brute(rows, damage=True):
    held = defaultdict(list)
    for r in harmed(rows) if damage else rows:
        held[r[0]].append(r)
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(held[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        faults, turns = faults_of(mine), [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, edits, lines = cheapest(tuple(mine), tuple(faults))
        out[conv] = (gaps, *[faults.count(f) for f in repair.FAULTS], illegal, cost, edits, sha("\n".join(lines)))
    return out


def some_rows(n, seed, longest=12):
    rng, out = random.Random(seed), []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "User"])
            text = rng.choice(["Yes.", "No!", "Why?", "cut short", None, "", " \t\n", f"{rng.random()}.", "One. two", "end. ", "end. \x0b"])
            out.append((conv if conv else None, None if rng.random() < 0.05 else turn * rng.choice([1, 1, 1, 2]), role, text))
    return out


def found(df):
    out = {r.conv_id: tuple(r[c] for c in (*COUNTS, "audit", "repaired_sha256")) for r in df.collect()}
    assert len(out) == df.count()
    return out


def test_damaged_conversations(spark):
    rows = some_rows(250, 1)
    rows += [(901, t, "user", "Yes.") for t in range(40)] + [(902, 7, "user", "Yes.")] * 9 + [(903, 0, "user", "word " * 50000 + ".")]
    assert found(queries.op11_digest(spark.createDataFrame(rows, SCHEMA).repartition(3))) == brute(rows)


def test_conversation_without_rows_left(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    out = found(queries.op11_digest(spark.createDataFrame([(gone, 0, "user", "Hello.")], SCHEMA)))
    assert out == {gone: (0, 0, 0, 0, 0, 0, "", sha(""))}


def test_empty_table(spark):
    assert queries.op11_digest(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("bits", [0, 2])
def test_conversations_in_pieces(spark, bits):
    """Blocks of a few rows cut nearly all conversations; one holds most rows."""
    rows = some_rows(25, 5) + [(77, t, random.Random(t).choice(["user", "assistant", "system"]), f"{t % 50}.") for t in range(120)]
    assert found(queries.op11_digest(spark.createDataFrame(rows, SCHEMA).repartition(3), block_bits=bits)) == brute(rows)


def test_repaired_rows_keep_other_columns(spark):
    rows = [(c, t, "user", "Yes.", f"k{c}{t}", "s", "r", t) for c in range(5) for t in range(4)]
    names = "conv_id long, turn long, role string, text string, key string, slot string, row string, audit long"
    done = repair.repair(spark.createDataFrame(rows, names))
    out = repair.repaired(done).orderBy("key", "slot", "sub").collect()
    assert all((r.row is None) == (r.edit == "I") for r in out)
    assert sorted(r.row.key for r in out if r.row is not None) == sorted(r[4] for r in rows)
    plain = [(c, t, r, x) for c, t, r, x, *_ in rows]
    assert {r.conv_id: (r.cost, r.duplicate) for r in repair.report(done).collect()} == {c: (v[5], v[2]) for c, v in brute(plain, damage=False).items()}


def test_inserted_rows_under_compiled_plans(spark):
    """A row that was inserted has a null `row`, which a compiled plan has to expect."""
    names = ("spark.sql.codegen.wholeStage", "spark.sql.codegen.factoryMode")
    before = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[0], "true")
    spark.conf.set(names[1], "CODEGEN_ONLY")
    try:
        rows = [(1, 0, "user", "Yes."), (1, 1, "user", "No."), (2, 0, "assistant", "Yes.")]
        df = spark.createDataFrame(rows, SCHEMA)
        assert found(queries.op11_digest(df)) == brute(rows)
        done = repair.repair(df)
        assert repair.repaired(done).schema["row"].nullable and repair.repaired(done, True).schema["row"].nullable
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_prices_are_exact_and_pieces_compose():
    rng = random.Random(2)
    for _ in range(300):
        codes = bytes(rng.choices(range(9), weights=[2, 5, 5, 2, 1, 3, 3, 1, 3], k=rng.randint(0, 60)))
        whole = repair.decided(codes)
        at = rng.randint(0, len(codes))
        left, right = repair.through(codes[:at]), repair.priced(codes[at:], repair.FINISH)[0][1][:4]
        entry = [min(left[4 * p + q] + right[q] for q in range(4)) for p in range(4)]
        assert entry[repair.START] == whole[1]
        first, state, cost = repair.traced(repair.priced(codes[:at], right), repair.START)
        second, last, more = repair.traced(repair.priced(codes[at:], repair.FINISH), state)
        assert (first + second + repair.TAIL[last], cost + more + repair.FINISH[last]) == whole


def test_long_conversation_takes_time_in_proportion():
    steps = []
    for n in (4000, 8000):
        codes = bytes(random.Random(n).choices(range(9), k=n))
        counted = 0
        real = repair.auction

        def spied(run, price, origin):
            nonlocal counted
            counted += len(run)
            real(run, price, origin)

        repair.auction = spied
        try:
            repair.decided(codes)
        finally:
            repair.auction = real
        steps.append(counted)
    assert steps[1] < 2.2 * steps[0]
