"""Language ID by Bayesian fusion of evidence.

The posterior of a language is in proportion to

    text likelihood x P(declared markup language | language) x P(address suffix | language) x prior of the host.

* Text: byte trigrams of lower-cased letters in `BINS` hashed bins, multinomial with additive smoothing, fitted on about
  `FIT_ROWS` different texts of each label at most. Neighbouring trigrams are not independent, so the sum of a text's log-likelihoods is
  brought down to that of `INDEPENDENT` trigrams.
* Declared language and address suffix: right with a stated probability, otherwise any other language; absent or
  unknown, they say nothing.
* Host prior: grouped counts of what the first three say about every row, smoothed from all rows to the domain (last
  two labels) to the host. A row's own vote is left out of its host's and domain's counts.

`und` is an outcome beside the languages, with its own votes and prior. Its text likelihood is that of a uniform model,
lowered by a margin; a declared language and an address suffix speak against it. Where it wins and the row declares a
language that has no model, the answer is that language. A text without letters is `und` whatever the rest says, and
doesn't vote. Rows with `und` are rejected.

Defined results: a null text is empty and `und`; a null host counts as an empty one; repeated rows each get a row; an
empty table gives an empty result; without labelled rows every row is `und`. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.llm.common import Scratch, arrow_map, packed, whole

#: Different texts of a label that its model is fitted on. Labels beyond LANGUAGES are an error: the driver holds a model of each.
FIT_ROWS, LANGUAGES = 4000, 512
BINS = 1 << 15
SMOOTHING, INDEPENDENT = 0.5, 40.0
#: Log-likelihood for each trigram by which the uniform model has to win.
MARGIN = 0.5
#: Probability that a declared language and an address suffix are right; weight of the wider prior in rows.
DECLARED, SUFFIX, WIDER = 0.9, 0.8, 5.0
#: Bytes whose trigrams are looked up at once.
BLOCK = 1 << 18

# Country suffixes of addresses and the language most pages below them are in.
SUFFIXES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "au": "en", "it": "it", "pt": "pt", "br": "pt", "nl": "nl"}

UNDETERMINED = "und"
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 0x80 or chr(c).isalpha() else 32 for c in range(256))


def trigrams(text: bytes | None) -> Iterator[np.ndarray]:
    """Bins of the trigrams of the folded words of a text, in blocks."""
    flat = b" ".join((text or b"").translate(_FOLD).split())
    if not flat:
        return
    flat = b" " + flat + b" "
    for at in range(0, len(flat) - 2, BLOCK):
        a = np.frombuffer(flat, np.uint8, min(BLOCK + 2, len(flat) - at), at).astype(np.uint32)
        code = a[:-2] << np.uint32(16) | a[1:-1] << np.uint32(8) | a[2:]
        yield (code * np.uint32(2654435761)) >> np.uint32(17)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    logs: np.ndarray  # bins x languages

    def text(self, text: bytes | None) -> tuple[int, list[float]]:
        """Trigrams of a text and its log-likelihood in each language."""
        n, sums = 0, np.zeros(len(self.languages))
        for bins in trigrams(text):
            n += len(bins)
            sums += self.logs[bins].sum(axis=0, dtype=np.float64)
        return n, sums.tolist()


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", rows: int = FIT_ROWS) -> Model:
    """Text model from at most about `rows` different texts of each label, drawn by a hash of their content; copies count once."""
    usable = labelled.select(whole(text_col).alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")).where("lang IS NOT NULL")
    usable = usable.where(F.col("text").rlike(r"[A-Za-z]|[^\x00-\x7F]")).withColumn("h", F.xxhash64("text"))
    sizes = usable.select("lang", "h").distinct().groupBy("lang").count().limit(LANGUAGES + 1).collect()
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} labels in {lang_col}")
    drawn = usable
    large = [x for r in sizes if r["count"] > rows for x in (F.lit(r["lang"]), F.lit(r["count"]))]
    if large:
        size = F.coalesce(F.try_element_at(F.create_map(*large), F.col("lang")), F.lit(1))
        drawn = usable.where(F.pmod("h", size) < rows)
    drawn = drawn.select("text", "lang").distinct()

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").cast(pa.binary()), batch.column("lang").to_pylist()):
                held = counts.setdefault(lang, np.zeros(BINS, np.int64))
                for bins in trigrams(text.as_py()):
                    held += np.bincount(bins, minlength=BINS)
        for lang, held in counts.items():
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(held[at])], ["lang", "bin", "n"])

    counted = arrow_map(drawn, of_batches, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    languages = sorted(set(found.column("lang").to_pylist()))
    table = np.full((BINS, len(languages)), SMOOTHING)
    which = np.array(pa.compute.index_in(found.column("lang"), pa.array(languages, pa.string())), np.int64)
    table[found.column("bin").to_numpy(), which] += found.column("n").to_numpy()
    return Model(languages, np.log(table / table.sum(axis=0)).astype(np.float32))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def suffix_language(host: Column) -> Column:
    last = F.element_at(F.split(host, r"\."), -1)
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in SUFFIXES.items() for x in pair]), last)


def markup_language(html: Column) -> Column:
    """Primary language of the first lang attribute of an html element; null if there is none."""
    found = F.lower(F.regexp_extract(html, r"""(?i)<html[^>]*?\slang\s*=\s*["']?([a-z]{2,3})""", 1))
    return F.when(found != "", found)


def visible_text(html: Column) -> Column:
    """Text of a page without scripts, styles, comments and tags."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(bare, r"<[^>]*>", " ")


def _index(value: Column, languages: list[str]) -> Column:
    places = F.create_map(*[x for i, lang in enumerate(languages) for x in (F.lit(lang), F.lit(i))])
    return F.coalesce(F.try_element_at(places, value), F.lit(-1))


def _says(index: Column, right: float, languages: int) -> list[Column]:
    """Log-probability of a declaration under each language, and under none of them."""
    wrong = float(np.log((1 - right) / max(1, languages - 1)))
    return [F.when(index < 0, 0.0).when(index == i, float(np.log(right))).otherwise(wrong) for i in range(languages + 1)]


def evidence(rows: DataFrame, model: Model) -> DataFrame:
    """(row, host, text, declared, suffix) to (row, host, other, empty, vote, l0, l1, ...): log evidence without the host's.

    The last one is of no fitted language; `other` is what that means, `und` or the declared language.
    """
    languages = model.languages
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uniform = -np.log(BINS)
        for batch in batches:
            other, empty, logs = [], [], []
            for text, said in zip(batch.column("text").cast(pa.binary()), batch.column("declared").to_pylist()):
                n, sums = sent.value.text(text.as_py())
                fitted = said is None or said in sent.value.languages
                other.append(UNDETERMINED if fitted else said)
                empty.append(n == 0)
                scale = min(1.0, INDEPENDENT / n) if n else 0.0
                logs.append([s * scale for s in (*sums, n * (uniform - MARGIN))])
            kept = [batch.column(c) for c in ("row", "host", "declared", "suffix")]
            found = [pa.array(other, pa.string()), pa.array(empty, pa.bool_()), pa.array(logs, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*kept, *found], ["row", "host", "declared", "suffix", "other", "empty", "logs"])

    schema = rows.select("row", "host", "declared", "suffix").schema.add("other", "string").add("empty", "boolean").add("logs", T.ArrayType(T.DoubleType()))
    read = arrow_map(rows.select("row", "host", "declared", "suffix", "text"), of_batches, schema)
    read = read.withColumns({f"{c}_at": _index(F.col(c), languages) for c in ("declared", "suffix")})
    said = zip(_says(F.col("declared_at"), DECLARED, len(languages)), _says(F.col("suffix_at"), SUFFIX, len(languages)))
    sums = [(F.get("logs", F.lit(i)) + d + s).alias(f"l{i}") for i, (d, s) in enumerate(said)]
    out = read.select("row", "host", "other", "empty", *sums)
    return out.withColumn("vote", F.when(F.col("empty"), -1).otherwise(_best([F.col(f"l{i}") for i in range(len(sums))])))


def _best(scores: list[Column]) -> Column:
    every = F.array(*scores)
    return (F.array_position(every, F.array_max(every)) - 1).cast("int")


def domain_of(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def host_priors(votes: DataFrame, languages: int) -> DataFrame:
    """Per host: its votes (h0, ...), those of its domain (d0, ...) and of all rows (a0, ...). `votes` has host, vote."""
    n = [F.sum((F.col("vote") == i).cast("long")) for i in range(languages)]
    hosts = votes.groupBy("host").agg(*[c.alias(f"h{i}") for i, c in enumerate(n)])
    domain = hosts.withColumn("domain", domain_of(F.col("host")))
    domains = domain.groupBy("domain").agg(*[F.sum(f"h{i}").alias(f"d{i}") for i in range(languages)])
    every = domains.agg(*[F.sum(f"d{i}").alias(f"a{i}") for i in range(languages)]).first() or [0] * languages
    return domain.join(domains, "domain").drop("domain").withColumns({f"a{i}": F.lit(every[i] or 0).cast("long") for i in range(languages)})


def posterior(evident: DataFrame, priors: DataFrame, languages: list[str]) -> DataFrame:
    """(row, language, confidence)."""
    size = len(languages) + 1
    voted = (F.col("vote") >= 0).cast("long")
    joined = evident.join(priors, "host")
    # Columns of their own, so that the plan grows with the languages and not with their square.
    joined = joined.withColumns({f"n_{x}": sum((F.col(f"{x}{i}") for i in range(1, size)), F.col(f"{x}0")) - (0 if x == "a" else voted) for x in "adh"})

    def counts(level: str) -> list[Column]:
        own = 0 if level == "a" else 1
        return [F.col(f"{level}{i}") - own * (F.col("vote") == i).cast("long") for i in range(size)]

    prior = [F.lit(1.0 / size)] * size
    for level in "adh":
        prior = [(n + WIDER * p) / (F.col(f"n_{level}") + WIDER) for n, p in zip(counts(level), prior)]
    step = joined.select("row", "other", "empty", *[(F.col(f"l{i}") + F.log(p)).alias(f"s{i}") for i, p in enumerate(prior)])
    scores = [F.col(f"s{i}") for i in range(size)]
    best, top = _best(scores), F.col("top")
    step = step.withColumn("top", F.greatest(*scores))
    mass = sum((F.exp(s - top) for s in scores[1:]), F.exp(scores[0] - top))
    return step.select(
        "row",
        F.when(F.col("empty"), UNDETERMINED).otherwise(F.get(F.array(*[F.lit(x) for x in languages], F.col("other")), best)).alias("language"),
        F.when(F.col("empty"), 0.0).otherwise(1 / mass).alias("confidence"),
    )


def identify(rows: DataFrame, model: Model) -> DataFrame:
    """(row, language, confidence) of rows with row (any type), host, text, declared and suffix."""
    if not model.languages:
        return rows.select("row", F.lit(UNDETERMINED).alias("language"), F.lit(0.0).alias("confidence"))
    scratch = Scratch(rows.sparkSession, "langid")
    rows = rows.withColumn("host", F.coalesce("host", F.lit("")))
    evident = scratch.keep(evidence(rows, model), "evidence")
    # Written, so that Spark sees their size and can split a hot host in the join.
    priors = scratch.keep(host_priors(evident.select("host", "vote"), len(model.languages) + 1), "priors")
    return posterior(evident, priors, model.languages)


def identify_pages(pages: DataFrame, model: Model) -> DataFrame:
    """Web pages (url, html, and other columns) with the language and confidence of each; columns pass in `row`."""
    host = host_of(F.col("url"))
    html = whole("html")
    slim = [F.col(f"`{c}`") for c in pages.columns if c != "html"]
    rows = pages.select(F.struct(*slim).alias("row"), host.alias("host"), visible_text(html).alias("text"), markup_language(html).alias("declared"), suffix_language(host).alias("suffix"))
    return identify(rows, model)


def keep_identified(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", declared_col: str = "lang", host_col: str = "source") -> DataFrame:
    """The rows of `docs` with a language, as they are: rows that come out as `und` go."""
    text = whole(text_col)
    row = F.struct(F.col(f"`{id_col}`").cast("long").alias("gone_id"), F.sha2(text.cast("binary"), 256).alias("gone_digest"))
    label = F.col(f"`{declared_col}`").cast("string")
    declared = F.when(label.isin(model.languages), label).otherwise(F.lower(F.substring(label, 1, 2)))
    rows = docs.select(row.alias("row"), F.col(f"`{host_col}`").cast("string").alias("host"), text.alias("text"), declared.alias("declared"), F.lit(None).cast("string").alias("suffix"))
    scratch = Scratch(docs.sparkSession, "langid-out")
    gone = scratch.keep(identify(rows, model).where(F.col("language") == UNDETERMINED).select("row.*").distinct(), "gone")
    own = docs.select(packed(docs).alias("row"), F.col(f"`{id_col}`").cast("long").alias("own_id"), F.sha2(text.cast("binary"), 256).alias("own_digest"))
    same = F.col("own_id").eqNullSafe(F.col("gone_id")) & (F.col("own_digest") == F.col("gone_digest"))
    return own.join(gone, same, "left_anti").select("row.*")
