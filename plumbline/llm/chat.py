"""Chat formatting of reply trees.

Iterative self-joins of the reply table double the distance to a known ancestor in every round, so a path of any length
takes as many rounds as its length has binary digits. They give each message its root, depth and path score. Leaves are
ranked by the score of their path; the chosen paths are then climbed with the same tables, and each becomes one
conversation.

A turn is written as <|turn|>role<|text|>text<|end|>. Control strings inside roles and texts get a backslash after their
first character and backslashes are doubled, which `unescape` reverts. The loss mask is a list of spans of code points
of the formatted string, one for each assistant text.

Defined results: null roles and texts are empty; turns of one conversation are ordered by turn (null last), role and
text, so ties and repeated rows each stay; a null conversation identifier is a conversation of its own; a reply to a
message that is not there begins a tree; messages that reply to each other in a ring have no root and are left out; an
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.llm.common import Scratch, arrow_map, whole

# The template's own control strings begin with <|; the others belong to chat templates in common use.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
_PARSE = re.compile(re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END), re.DOTALL)


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for control in CONTROL:
        text = text.replace(control, control[0] + "\\" + control[1:])
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Formatted conversation and the spans under its loss mask."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = TURN + escape(role) + TEXT, escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(role), unescape(text)) for role, text in _PARSE.findall(formatted)]


def replies_of_turns(conversations: DataFrame) -> DataFrame:
    """Rows by turn as a reply table: each turn replies to the one before it."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    turns = conversations.select(F.col("conv_id").cast("long"), "turn", whole("role").alias("role"), whole("text").alias("text"))
    node = F.row_number().over(order).cast("long")
    assistant = F.when(F.col("role") == "assistant", F.length("text")).otherwise(0).cast("double")
    placed = turns.select("conv_id", node.alias("node"), "role", "text", assistant.alias("score"))
    return placed.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))


def _climbs(nodes: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """Table k leads from each message up to 2^k replies to an ancestor: (tree, node, up, hops, gain)."""
    ups = nodes.select("tree", F.col("node").alias("parent")).withColumn("known", F.lit(True))
    step = nodes.join(ups, ["tree", "parent"], "left").select(
        "tree",
        "node",
        F.when(F.col("known"), F.col("parent")).otherwise(F.col("node")).alias("up"),
        F.when(F.col("known"), 1).otherwise(0).cast("long").alias("hops"),
        F.when(F.col("known"), F.col("score")).otherwise(0.0).alias("gain"),
    )
    tables, longest = [scratch.keep(step, "climb")], 0
    total = nodes.count()
    while True:
        now = tables[-1]
        reach = now.agg(F.max("hops")).first()[0] or 0
        if reach <= longest or 1 << (len(tables) - 1) > total:
            return tables
        longest = reach
        above = now.select("tree", F.col("node").alias("up"), F.col("up").alias("far"), F.col("hops").alias("more"), F.col("gain").alias("rest"))
        # Messages that took fewer replies are at their root and are not joined again.
        full = F.col("hops") == 1 << (len(tables) - 1)
        higher = now.where(full).join(above, ["tree", "up"]).select(
            "tree", "node", F.col("far").alias("up"), (F.col("hops") + F.col("more")).alias("hops"), (F.col("gain") + F.col("rest")).alias("gain")
        )
        tables.append(scratch.keep(now.where(~full).select("tree", "node", "up", "hops", "gain").unionByName(higher), "climb"))


def paths(messages: DataFrame, scratch: Scratch, branches: int = 1) -> DataFrame:
    """(tree, leaf, rank, depth, role, text): the messages of the best `branches` root-to-leaf paths of each tree.

    `messages` has tree (string), node and parent (long), role, text and score. The score of a path is the sum of its
    messages' scores; ties go to the longer path, then to the smaller leaf.
    """
    nodes = scratch.keep(messages.select("tree", "node", "parent", "role", "text", "score"), "nodes")
    climbs = _climbs(nodes, scratch)
    roots = climbs[0].where("hops = 0").select("tree", F.col("node").alias("root"))
    roots = roots.join(nodes.select("tree", F.col("node").alias("root"), F.col("score").alias("root_score")), ["tree", "root"])
    whole_way = climbs[-1].withColumnRenamed("up", "root").join(roots, ["tree", "root"])
    parents = nodes.select("tree", F.col("parent").alias("node")).where("node IS NOT NULL").distinct()
    leaves = whole_way.join(parents, ["tree", "node"], "left_anti").select(
        "tree", F.col("node").alias("leaf"), "hops", (F.col("gain") + F.col("root_score")).alias("path_score")
    )
    best = Window.partitionBy("tree").orderBy(F.desc("path_score"), F.desc("hops"), "leaf")
    chosen = leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
    on_path = scratch.keep(chosen.select("tree", "leaf", "rank", F.col("leaf").alias("node"), F.col("hops").alias("depth")), "path")
    for k, climb in enumerate(climbs[:-1]):
        jump = climb.where(F.col("hops") == 1 << k).select("tree", "node", "up")
        further = on_path.join(jump, ["tree", "node"]).select("tree", "leaf", "rank", F.col("up").alias("node"), (F.col("depth") - (1 << k)).alias("depth"))
        on_path = scratch.keep(on_path.unionByName(further), "path")
    return on_path.join(nodes.select("tree", "node", "role", "text"), ["tree", "node"]).select("tree", "leaf", "rank", "depth", "role", "text")


def formatted(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, rank, formatted, loss): one row per chosen path; `loss` holds spans of code points (start, end)."""
    scratch = Scratch(messages.sparkSession, "chat")
    turn = F.struct("depth", "role", "text")
    whole_paths = paths(messages, scratch, branches).groupBy("tree", "leaf", "rank").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    loss_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, losses = [], []
            for turns in batch.column("turns"):
                text, spans = render([(t["role"], t["text"]) for t in turns.as_py()])
                texts.append(text)
                losses.append([{"start": a, "end": b} for a, b in spans])
            keys = [batch.column(k) for k in ("tree", "leaf", "rank")]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(texts, pa.string()), pa.array(losses, loss_type)], ["tree", "leaf", "rank", "formatted", "loss"]
            )

    ddl = "tree string, leaf long, rank int, formatted string, loss array<struct<start: bigint, end: bigint>>"
    return arrow_map(whole_paths, of_batches, ddl)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss) of a table of rows by turn (conv_id, turn, role, text)."""
    messages = replies_of_turns(conversations).withColumn("tree", tree_of(F.col("conv_id")))
    return formatted(messages).select(F.col("tree").try_cast("long").alias("conv_id"), "formatted", "loss")


def tree_of(conv_id: Column) -> Column:
    return F.coalesce(conv_id.cast("string"), F.lit("none"))
