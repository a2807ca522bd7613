"""Secret scans with an incremental ledger of contents, with DataFrame operations only.

Every version of a text is addressed by the SHA-256 of its content. A pair of content and rule version is scanned
once: contents that the ledger holds for a version are left out, the findings of new ones are added to it, and findings
are joined back to every row that has the content.

Positions are code points, end exclusive. Spark's functions give the matches and the pieces between them; a running sum
of their lengths gives where each match lies.

Defined results: a null text is empty and has no findings; repeated rows each get a row; a null identifier is kept;
an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from plumbline.llm.common import Scratch, whole

LEDGER = "blob string, rule string, version int, start long, end long"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost matches of `pattern` that do not overlap, of which those count whose `group` has at
    least `least` characters. `gate` is a cheaper pattern found in every text that has a match that counts."""

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1
    gate: str | None = None


# The kinds and patterns of the contract, in the order in which kinds are listed. A run of hexadecimal
# digits or a key id is matched as a whole, so its least length may stand in the pattern itself.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: What this scan adds to them.
ADDED = (Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),)


def _matches(text: Column, rule: Rule) -> Column:
    """Array of (gap before, length, length of the judged group) of every match, in code points."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    gaps = F.split(text, rule.pattern, -1)
    zipped = F.arrays_zip(found.alias("m"), judged.alias("j"), F.slice(gaps, F.lit(1), F.size(found)).alias("g"))
    return F.transform(
        zipped,
        lambda x: F.struct(
            F.length(x["g"]).cast("long").alias("gap"),
            F.length(x["m"]).cast("long").alias("size"),
            F.length(x["j"]).cast("long").alias("judged"),
        ),
    )


def _numbered(rule: int) -> Callable[[Column, Column], Column]:
    return lambda match, at: F.struct(F.lit(rule).alias("i"), at.alias("at"), match.alias("m"))


def read_ledger(spark: SparkSession, path: str | None) -> DataFrame | None:
    if path is None:
        return None
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
    return spark.read.schema(LEDGER).parquet(path) if there else None


def update_ledger(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = BASE + ADDED, text_col: str = "text") -> DataFrame:
    """The ledger's rows for the contents of `docs`, after scanning those it has not seen under these rule versions.

    A scanned pair of content and rule version has one row with a null start beside its findings. New rows are appended
    to the folder `ledger`.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "secrets")
    text = whole(text_col)
    contents = docs.select(F.sha2(text.cast("binary"), 256).alias("blob"), text.alias("text"))
    asked = F.array(*[F.lit(f"{r.kind}:{r.version}") for r in rules])
    # Copies meet here; what a task holds of a group is one row before anything is shuffled.
    blobs = contents.groupBy("blob").agg(F.first("text").alias("text"))
    seen = read_ledger(spark, ledger)
    if seen is None:
        blobs = blobs.withColumn("todo", asked)
    else:
        done = seen.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "rule", F.col("version").cast("string"))).alias("done"))
        todo = F.when(F.col("done").isNull(), asked).otherwise(F.array_except(asked, F.col("done")))
        blobs = blobs.join(done, "blob", "left").withColumn("todo", todo).where(F.size("todo") > 0)
    # One pass per text: the matches of all rules leave with its address, the text stays behind.
    of_rule = [
        F.when(
            F.array_contains("todo", f"{r.kind}:{r.version}") & F.col("text").rlike(r.gate or r.pattern),
            F.transform(_matches(F.col("text"), r), _numbered(i)),
        )
        for i, r in enumerate(rules)
    ]
    matches = F.flatten(F.array_compact(F.array(*of_rule)))
    found = scratch.keep(blobs.select("blob", "todo", matches.alias("matches")), "matches", collect=True)
    names = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), F.lit(r.least).alias("least")) for r in rules])
    order = Window.partitionBy("blob", "i").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    findings = (
        found.select("blob", F.explode("matches").alias("x"))
        .select("blob", "x.i", "x.at", "x.m.*")
        .withColumn("end", F.sum(F.col("gap") + F.col("size")).over(order))
        .select("*", F.get(names, F.col("i")).alias("r"))
        .where(F.col("judged") >= F.col("r.least"))
        .select("blob", "r.rule", "r.version", (F.col("end") - F.col("size")).alias("start"), "end")
    )
    scanned = found.select("blob", F.explode("todo").alias("pair")).select(
        "blob",
        F.substring_index("pair", ":", 1).alias("rule"),
        F.substring_index("pair", ":", -1).cast("int").alias("version"),
        F.lit(None).cast("long").alias("start"),
        F.lit(None).cast("long").alias("end"),
    )
    new = scratch.keep(findings.unionByName(scanned), "new")
    if ledger is not None:
        new.write.mode("append").parquet(ledger)
    return new if seen is None else new.unionByName(seen)


def scan(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = BASE + ADDED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, blob, findings (array of kind, start, end by start, then kind as listed)."""
    order = {r.kind: i for i, r in enumerate(rules)}
    found = update_ledger(docs, ledger, rules, text_col).where("start IS NOT NULL")
    wanted = F.lit(False)
    for r in rules:
        wanted = wanted | ((F.col("rule") == r.kind) & (F.col("version") == r.version))
    rank = F.coalesce(*[F.when(F.col("rule") == k, F.lit(i)) for k, i in order.items()])
    scratch = Scratch(docs.sparkSession, "secrets")
    lists = (
        found.where(wanted)
        .distinct()
        .groupBy("blob")
        .agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", F.col("rule").alias("kind")))).alias("findings"))
    )
    lists = scratch.keep(lists, "lists")  # written, so that Spark can split a hot content in the join
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.sha2(whole(text_col).cast("binary"), 256).alias("blob"))
    return rows.join(lists, "blob", "left").select(
        "doc_id",
        "blob",
        F.coalesce("findings", F.array().cast(lists.schema["findings"].dataType)).alias("findings"),
    )


def of_kind(findings: Column, *kinds: str) -> Column:
    return F.filter(findings, lambda x: x["kind"].isin(*kinds))


def joined(findings: Column) -> Column:
    return F.concat_ws(",", F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
