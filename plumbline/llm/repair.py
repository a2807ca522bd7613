"""Repair of the turn structure of conversations by an auction shortest-path algorithm.

A conversation should read: one system turn or none, then user and assistant in turn; or have no turns at all. Its rows
may be kept (K), given another role (R), deleted (D), and turns without text may be inserted (I), each at a cost. Rows
and what may come next make up a lattice of integer costs. Every node of it has a price; a path from the start is
extended along an arc whose cost makes up the difference of prices, or else its last node's price is raised and the path
contracted by it. When the path arrives, prices of nodes on cheapest paths are exact, so that their arcs are the tight
ones, and the cheapest repair that reads first in the alphabet is traced along those.

Rows are ordered once, over all tasks together, and dealt out in blocks of at most 2 ** `BLOCK_BITS` consecutive rows, so no
conversation has to fit into a task. Prices are found from the end in runs of `RUN` rows, whose prices at the end are
known by then. Where a conversation has several pieces, each gives its prices from every entry to every exit, a walk over
these few numbers a piece gives the prices at its end, and a second one the entry it is read from.

Defined results: a null role or text is one space; a row without a role has no initial and can't be kept; rows of a
turn are taken by role and text (its first characters, then its digest), a null turn first; a null conversation is one
of its own; an empty table gives an empty result. Other columns pass through in `row`, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.common import Scratch, arrow_map, packed

#: Costs of the edits, and what a row that ends too early adds if it isn't deleted.
DELETE, INSERT, REROLE, CUT_SHORT = 4, 3, 3, 3
#: Rows of a block are numbered by so many bits of their place.
BLOCK_BITS = 12
#: Rows of a run.
RUN = 8
#: Leading characters of a text by which rows of a turn are ordered.
LEAD = 64
WHITE = " \t\n\x0b\x0c\r"
FAULTS = ("blank", "duplicate", "truncated")
#: What has been read: nothing, a system turn, a user turn that waits for its answer, an answer.
START, SYSTEM, USER, ANSWER = range(4)
NONE = 1 << 60
#: By entry: what is left to insert at the end of a conversation, and what that costs.
TAIL = ("", "II", "I", "")
FINISH = [len(t) * INSERT for t in TAIL]
HEADS = "sua"
MUST_GO = 8


def _arcs(code: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """(edit, cost, target less the first node of the row) of what a row of `code` allows, by edit.

    A code is the number of the role's initial (3: none of them), 4 more if cut short, or MUST_GO.
    """
    user_next = state != USER
    after = USER if user_next else ANSWER
    arcs = [("D", DELETE, 4 + state), ("I", INSERT, after)]
    if code != MUST_GO:
        head, more = code % 4, CUT_SHORT * (code // 4)
        if (head == 0 and state == START) or (head == 1 and user_next) or (head == 2 and not user_next):
            arcs.append(("K", more, 4 + (SYSTEM if head == 0 else after)))
        arcs.append(("R", REROLE + more, 4 + after))
    return tuple(arcs)


ARCS = tuple(tuple(_arcs(code, state) for state in range(4)) for code in range(MUST_GO + 1))
_REACH = ((0, 1, 2, 3), (1, 2, 3), (2, 3), (2, 3))


def auction(codes: bytes, price: list[int], origin: int) -> None:
    """Raise prices until that of `origin` is the cost of its cheapest way through the rows.

    Node 4 * row + state; the last four are the way out, whose prices are exact. No price is ever above the cost of an
    arc and the price it leads to.
    """
    out, path = 4 * len(codes), [origin]
    while path[-1] < out:
        node = path[-1]
        best, target = NONE, -1
        for _, cost, to in ARCS[codes[node >> 2]][node & 3]:
            value = cost + price[(node & ~3) + to]
            if value < best:
                best, target = value, (node & ~3) + to
        if price[node] < best:
            price[node] = best
            if len(path) > 1:
                path.pop()
        elif target < 0:  # no way out
            return
        else:
            path.append(target)


def priced(codes: bytes, right: list[int], whole: bool = False) -> list[tuple[bytes, list[int]]]:
    """Runs of the rows with the prices of their nodes; those of a run's first nodes are exact.

    `right` are the prices where the rows end. For a whole conversation only the start matters in the first run.
    """
    out = []
    for at in reversed(range(0, max(len(codes), 1), RUN)):
        run = codes[at : at + RUN]
        dead = [all(right[s] >= NONE for s in _REACH[state]) for state in range(4)]
        least = min(right)  # prices count from the cheapest way out, so that they don't grow with what follows
        price = [NONE if d else 0 for d in dead] * len(run) + [p - least if p < NONE else NONE for p in right]
        for state in range(1 if whole and at == 0 else 4):
            if price[state] < NONE:
                auction(run, price, state)
        price = [p + least if p < NONE else NONE for p in price]
        out.append((run, price))
        right = price[:4]
    return out[::-1]


def _leading_out(codes: bytes, price: list[int]) -> list[bool]:
    """Nodes from which tight arcs lead to the way out."""
    good = [p < NONE for p in price]
    for row in reversed(range(len(codes))):
        first = 4 * row
        for state in sorted(range(4), key=lambda s: price[first + s]):
            here = price[first + state]
            good[first + state] = here < NONE and any(here == cost + price[first + to] and good[first + to] for _, cost, to in ARCS[codes[row]][state])
    return good


def traced(runs: list[tuple[bytes, list[int]]], entry: int) -> tuple[str, int, int]:
    """(edits, exit, cost) of the cheapest way that reads first, along tight arcs from `entry`."""
    edits, state, total = [], entry, 0
    for codes, price in runs:
        good, node = _leading_out(codes, price), state
        while node < 4 * len(codes):
            first = node & ~3
            for edit, cost, to in ARCS[codes[node >> 2]][node & 3]:
                if price[node] == cost + price[first + to] and good[first + to]:
                    edits.append(edit)
                    total += cost
                    node = first + to
                    break
        state = node & 3
    return "".join(edits), state, total


def decided(codes: bytes) -> tuple[str, int]:
    """(edits, cost) of a whole conversation."""
    edits, state, cost = traced(priced(codes, FINISH, whole=True), START)
    return edits + TAIL[state], cost + FINISH[state]


def through(codes: bytes) -> list[int]:
    """Costs from each of the four entries of a piece to each exit, entry by entry."""
    columns = []
    for state in range(4):
        right = [NONE] * 4
        right[state] = 0
        columns.append(priced(codes, right)[0][1][:4])
    return [columns[out][entry] for entry in range(4) for out in range(4)]


@dataclass
class Repair:
    """Ordered rows (key, slot, row and others), their faults and the edits of each piece."""

    rows: DataFrame
    coded: DataFrame
    audits: DataFrame
    role_col: str
    text_col: str
    block_bits: int


def _key(conversation: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conversation.cast("string")), F.lit(""))


def _said(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def _ordered(turns: DataFrame, scratch: Scratch, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """All rows in order, numbered by task and place, with what decides about them (`ends` is a fault but for repeats).

    Equal rows are told apart at random, so they can be split; the input is written first, so that a task that runs
    again deals alike.
    """
    rows = scratch.keep(turns.select(packed(turns).alias("row")), "rows")
    field = {name: F.col("row").getField(name) for name in (conv_col, turn_col, role_col, text_col)}
    role, text = _said(field[role_col]), _said(field[text_col])
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    last = F.substring(F.rtrim(text, F.lit(WHITE)), -1, 1)
    ends = F.when(last == "", 1).when(last.isin(".", "!", "?"), 0).otherwise(3)
    at = F.instr(F.lit(HEADS), F.substring(role, 1, 1)) - 1
    head = F.when((at >= 0) & (role != ""), at).otherwise(3)
    order = ["key", "turn", "said", "lead", "digest", "tie"]
    return scratch.keep(
        rows.select(
            _key(field[conv_col]).alias("key"),
            field[conv_col].alias("conv_id"),
            field[turn_col].alias("turn"),
            role.alias("said"),
            F.substring(text, 1, LEAD).alias("lead"),
            digest.alias("digest"),
            F.rand(29).alias("tie"),
            head.cast("tinyint").alias("head"),
            ends.cast("tinyint").alias("ends"),
            "row",
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("said", "lead", "tie")
        .withColumn("slot", F.monotonically_increasing_id()),
        "ordered",
    )


def _coded(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """key, conv_id, turn, slot, head (number of the role's initial) and fault (0: none, else 1 + its place in FAULTS)."""
    slim = rows.drop("row")
    same = slim.where("ends <> 1").groupBy("key", "digest").agg(F.min("slot").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    same = scratch.keep(same, "repeated")
    fault = F.when((F.col("ends") != 1) & (F.col("slot") > F.col("first")), 2).otherwise(F.col("ends"))
    coded = slim.join(same, ["key", "digest"], "left").select("key", "conv_id", "turn", "slot", "head", fault.cast("tinyint").alias("fault"))
    return scratch.keep(coded, "coded")


def _pieces(coded: DataFrame, scratch: Scratch, bits: int) -> DataFrame:
    """key, slot of the first row, codes, initials of the ends, and improper neighbours inside, of each piece."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def row() -> tuple:
            key, _, slot, heads, faults = held[0][0], held[0][1], held[0][2], np.concatenate([h[3] for h in held]), np.concatenate([h[4] for h in held])
            codes = np.where((faults == 1) | (faults == 2), MUST_GO, heads + 4 * (faults == 3)).astype(np.uint8)
            return key, slot, codes.tobytes(), int(heads[0]), int(heads[-1]), int(improper(heads[:-1], heads[1:]).sum())

        for batch in batches:
            keys, slots = batch.column("key").to_pylist(), batch.column("slot").to_numpy()
            heads, faults = batch.column("head").to_numpy(), batch.column("fault").to_numpy()
            blocks = slots >> bits
            cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1] or blocks[i] != blocks[i - 1]], len(keys)]
            done = []
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held and (held[0][0], held[0][1]) != (keys[a], blocks[a]):
                    done.append(row())
                    held = []
                held.append((keys[a], blocks[a], int(slots[a]), heads[a:b], faults[a:b]))
            yield _batch(done, _PIECES)
        if held:
            yield _batch([row()], _PIECES)

    dealt = coded.select("key", "slot", "head", "fault").repartition(F.shiftright("slot", bits)).sortWithinPartitions("slot")
    return scratch.keep(arrow_map(dealt, of_batches, "key string, slot long, codes binary, head int, tail int, illegal long"), "pieces")


_PIECES = {"key": pa.string(), "slot": pa.int64(), "codes": pa.binary(), "head": pa.int32(), "tail": pa.int32(), "illegal": pa.int64()}


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds.values())], list(kinds))


def improper(before, after):
    """Neighbours that are not system and user, user and assistant, or assistant and user."""
    return ~(((before == 0) & (after == 1)) | ((before == 1) & (after == 2)) | ((before == 2) & (after == 1)))


_AUDITS = {"key": pa.string(), "slot": pa.int64(), "entry": pa.int32(), "audit": pa.string(), "cost": pa.int64(), "illegal": pa.int64()}
_AUDITS_DDL = "key string, slot long, entry int, audit string, cost long, illegal long"


def _of_whole(pieces: DataFrame) -> DataFrame:
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[bytes, tuple[str, int]] = {}
            out = []
            for r in batch.select(["key", "slot", "codes", "illegal"]).to_pylist():
                if r["codes"] not in known:
                    known[r["codes"]] = decided(r["codes"])
                audit, cost = known[r["codes"]]
                out.append((r["key"], r["slot"], START, audit, cost, r["illegal"]))
            yield _batch(out, _AUDITS)

    return arrow_map(pieces, of_batches, _AUDITS_DDL)


def _of_cut(pieces: DataFrame, scratch: Scratch) -> DataFrame:
    """Audits of conversations in several pieces."""

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"key": pa.string(), "slot": pa.int64(), "costs": pa.list_(pa.int64())}
        for batch in batches:
            yield _batch([(r["key"], r["slot"], through(r["codes"])) for r in batch.to_pylist()], kinds)

    def backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"key": pa.string(), "slot": pa.int64(), "prices": pa.list_(pa.int64()), "last": pa.bool_()}
        of, prices = None, FINISH
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["key"] != of:
                    of, prices = r["key"], FINISH
                    last = True
                else:
                    last = False
                out.append((of, r["slot"], prices, last))
                prices = [min(min(r["costs"][4 * p + q] + prices[q] for q in range(4)), NONE) for p in range(4)]
            yield _batch(out, kinds)

    def ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        way = pa.struct([("audit", pa.string()), ("exit", pa.int32()), ("cost", pa.int64())])
        kinds = {"key": pa.string(), "slot": pa.int64(), "head": pa.int32(), "tail": pa.int32(), "illegal": pa.int64(), "ways": pa.list_(way)}
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                runs, found = priced(r["codes"], r["prices"]), []
                for entry in range(4):
                    audit, state, cost = traced(runs, entry)
                    if r["last"]:
                        audit, cost = audit + TAIL[state], cost + FINISH[state]
                    found.append({"audit": audit, "exit": state, "cost": cost})
                out.append((r["key"], r["slot"], r["head"], r["tail"], r["illegal"], found))
            yield _batch(out, kinds)

    def forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, state, tail = None, START, 3
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                illegal = r["illegal"]
                if r["key"] != of:
                    of, state = r["key"], START
                else:
                    illegal += int(improper(np.array(tail), np.array(r["head"])))
                way = r["ways"][state]
                out.append((of, r["slot"], state, way["audit"], way["cost"], illegal))
                state, tail = way["exit"], r["tail"]
            yield _batch(out, _AUDITS)

    through_all = scratch.keep(arrow_map(pieces.select("key", "slot", "codes"), costs, "key string, slot long, costs array<long>"), "through")
    prices = arrow_map(
        through_all.repartition("key").sortWithinPartitions("key", F.desc("slot")), backwards, "key string, slot long, prices array<long>, last boolean"
    )
    found = arrow_map(
        pieces.join(scratch.keep(prices, "prices"), ["key", "slot"]),
        ways,
        "key string, slot long, head int, tail int, illegal long, ways array<struct<audit: string, exit: int, cost: long>>",
    )
    return arrow_map(scratch.keep(found, "ways").repartition("key").sortWithinPartitions("key", "slot"), forwards, _AUDITS_DDL)


def repair(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    block_bits: int = BLOCK_BITS,
) -> Repair:
    """The edits of every conversation of a table of turns."""
    scratch = Scratch(turns.sparkSession, "repair")
    rows = _ordered(turns, scratch, conv_col, turn_col, role_col, text_col)
    coded = _coded(rows, scratch)
    pieces = _pieces(coded, scratch, block_bits)
    cut = scratch.keep(pieces.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "cut")
    whole = _of_whole(pieces.join(cut, "key", "left_anti"))
    if cut.limit(1).count():
        whole = whole.unionByName(_of_cut(pieces.join(cut, "key"), scratch))
    return Repair(rows, coded, scratch.keep(whole, "audits"), role_col, text_col, block_bits)


def report(repair: Repair) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal and cost."""
    turn = F.col("turn").cast("decimal(20,0)")
    missing = F.max(turn) - F.min(turn) + 1 - F.count_distinct("turn")
    counts = [F.count_if(F.col("fault") == i + 1).alias(name) for i, name in enumerate(FAULTS)]
    faults = repair.coded.groupBy("key").agg(F.first("conv_id").alias("conv_id"), F.coalesce(missing, F.lit(0)).cast("long").alias("gaps"), *counts)
    edits = repair.audits.groupBy("key").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    return faults.join(edits, "key")


def repaired(repair: Repair, by_conversation: bool = False) -> DataFrame:
    """All rows with their edits: key, slot, sub (they order the rows), edit, role, text, row (null for an inserted one).

    Blocks are dealt out; `by_conversation` keeps each conversation together and in order, in one task but never in its
    memory, for what has to be read from end to end. `row` holds role and text alone then.
    """
    source = repair.rows.select("key", "slot", F.lit(None).cast("int").alias("entry"), F.lit(None).cast("string").alias("audit"), "row")
    if by_conversation:
        source = source.withColumn("row", F.struct(*[F.col("row").getField(name).alias(name) for name in (repair.role_col, repair.text_col)]))
    audits = repair.audits.select("key", "slot", "entry", "audit", F.lit(None).cast(source.schema["row"].dataType).alias("row"))
    together = F.col("key") if by_conversation else F.shiftright("slot", repair.block_bits)
    dealt = source.unionByName(audits).repartition(together).sortWithinPartitions("key", "slot", F.col("audit").isNull())
    role, text = (_said(F.col("row").getField(name)) for name in (repair.role_col, repair.text_col))
    dealt = dealt.select("*", role.alias("role"), text.alias("text"))
    kinds = {"key": pa.string(), "slot": pa.int64(), "sub": pa.int32(), "edit": pa.string(), "role": pa.string(), "text": pa.string()}

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, audit, at = START, "", 0
        for batch in batches:
            out, places = [], []
            columns = [batch.column(name).to_pylist() for name in ("key", "slot", "entry", "audit", "role", "text")]
            for i, (key, slot, entry, edits, role, text) in enumerate(zip(*columns)):
                if edits is not None:
                    state, audit, at = entry, edits, 0
                    continue
                sub, read = 0, False
                while at < len(audit) and (not read or set(audit[at:]) == {"I"}):
                    edit = audit[at]
                    given = "user" if state != USER else "assistant"
                    read = read or edit != "I"
                    if edit in "IR":
                        out.append((key, slot, sub, edit, given, "" if edit == "I" else text))
                        state = ANSWER if state == USER else USER
                    else:
                        out.append((key, slot, sub, edit, role, text))
                        if edit == "K":
                            state = SYSTEM if role[:1] == "s" else USER if role[:1] == "u" else ANSWER
                    places.append(None if edit == "I" else i)
                    at, sub = at + 1, sub + 1
            done = _batch(out, kinds)
            taken = batch.column("row").take(pa.array(places, pa.int64()))
            yield pa.RecordBatch.from_arrays([*done.columns, taken], [*kinds, "row"])

    schema = source.select("key", "slot").schema.add("sub", "integer").add("edit", "string").add("role", "string").add("text", "string").add("row", source.schema["row"].dataType)
    return arrow_map(dealt, of_batches, schema)


def digests(repair: Repair) -> DataFrame:
    """key, audit and sha256 of the lines `role:text` that stay, of each conversation, read from end to end."""
    kinds = {"key": pa.string(), "audit": pa.string(), "sha256": pa.string()}

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, audit, digest, lines = None, [], hashlib.sha256(), 0
        for batch in batches:
            out = []
            for key, edit, role, text in zip(*(batch.column(name).to_pylist() for name in ("key", "edit", "role", "text"))):
                if key != of:
                    if of is not None:
                        out.append((of, "".join(audit), digest.hexdigest()))
                    of, audit, digest, lines = key, [], hashlib.sha256(), 0
                audit.append(edit)
                if edit != "D":
                    digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                    lines += 1
            yield _batch(out, kinds)
        if of is not None:
            yield _batch([(of, "".join(audit), digest.hexdigest())], kinds)

    return arrow_map(repaired(repair, by_conversation=True).select("key", "edit", "role", "text"), of_batches, "key string, audit string, sha256 string")
