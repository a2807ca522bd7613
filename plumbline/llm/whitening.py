"""Whitening of embeddings by shifted CholeskyQR.

The centred vectors are a tall matrix of which no task sees more than its rows. A pass sums the Gram matrices of the
tasks; its Cholesky factor R turns the rows into nearly orthogonal ones by triangular solves, and the next pass measures
those. Where a Gram matrix is close to singular a small shift keeps the factor defined; directions that stay empty after
it are set apart. Passes go on until the Gram matrix is a projection, which for vectors of full rank is the identity; the
product of all factors is then the R of the matrix, and its singular values and right vectors give variances and
components. So small components keep the precision that an eigenvalue problem of the covariance would cost.

Each pass reads the written list of distinct vectors and returns one square matrix of the dimension, which is bounded by
`DIMENSIONS`; nothing else comes to the driver. A lost executor costs its tasks only.

Defined results: rows whose vector is null or holds null, NaN or infinite entries go; repeated vectors count once in the
fit and are each transformed; shorter vectors are filled up with zeros to the longest; more dimensions than `DIMENSIONS`
are an error; entries beyond 64 bits after scaling are held at its limits. A component without variance has whitened
null and explained 0 (null where nothing varies at all). An empty table gives an empty result. Other columns pass
through in `row`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.llm.common import Scratch, arrow_map, packed

#: An entry counts in steps of one over this.
SCALE = 256
#: Longest vector; driver and tasks hold some square matrices of it.
DIMENSIONS = 1024
#: Passes at most, and how far the Gram matrix may be from a projection in the end.
PASSES, ORTHOGONAL = 8, 1e-12
#: A Gram matrix with a smaller least eigenvalue, against the largest, is shifted.
SINGULAR = 1e-6
#: After a shift, directions with a smaller eigenvalue, against the largest, are empty.
EMPTY = 1e-13
#: Singular values below this, against the largest, are none.
NO_VARIANCE = 2e-11
#: Rows that a task multiplies at once.
ROWS = 4096


@dataclass
class Whitening:
    """What a fit leaves: all of it has the size of a vector or of its square."""

    n: int
    sums: list[int]
    factors: list[np.ndarray]
    components: np.ndarray  # one a row, by falling variance
    variances: np.ndarray
    identity_error: float | None = None

    @property
    def explained(self) -> list[float | None]:
        total = float(self.variances.sum())
        return [float(e) / total if total > 0 else None for e in self.variances]

    def whitened(self, centred: np.ndarray, count: int) -> np.ndarray:
        """Rows projected on the first components, over their standard deviation; NaN without one."""
        scale = np.sqrt(self.variances[:count])
        return (centred @ self.components[:count].T) / np.where(scale > 0, scale, np.nan)


def steps(vector: Column, scale: int = SCALE) -> Column:
    """The vector in whole steps, null where it has entries that are no numbers."""
    vector = vector.cast("array<double>")
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    limit = float(2**63 - 1024)
    held = F.transform(vector, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(limit)), F.lit(-limit))))
    return F.when(vector.isNotNull() & ~bad, held)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as 64-bit integers, filled up with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _blocks(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    for at in range(0, batch.num_rows, ROWS):
        yield _matrix(batch.column("x").slice(at, ROWS), width)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n; the whole part of the mean is taken off before numbers become floating."""
    whole = [s // n for s in sums]
    rest = np.array([(s - w * n) / n for s, w in zip(sums, whole)])
    return (x - np.array(whole, np.int64)).astype(np.float64) - rest


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """rows times the inverse of an upper triangular factor, column after column."""
    out = np.empty_like(rows)
    for j in range(factor.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def _totals(vectors: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and exact sum of each dimension; a task returns its own, those are added as decimals."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * width
        for batch in batches:
            for x in _blocks(batch, width):
                n += len(x)
                high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
                sums = [s + (h << 32) + v for s, h, v in zip(sums, high, low)]
        lines = [(-1, str(n)), *enumerate(map(str, sums))]
        yield pa.RecordBatch.from_arrays([pa.array([j for j, _ in lines], pa.int32()), pa.array([v for _, v in lines])], ["j", "v"])

    parts = arrow_map(vectors.select("x"), of_batches, "j int, v string")
    found = {r.j: int(r.v) for r in parts.groupBy("j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()}
    return found.get(-1, 0), [found.get(j, 0) for j in range(width)]


def _summed(vectors: DataFrame, width: int, of_rows: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum over all rows of square matrices that `of_rows` gives for blocks of them.

    A task returns its matrix by rows; a second stage adds up the cells.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for x in _blocks(batch, width):
                total += of_rows(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "line"])

    lines = arrow_map(vectors.select("x"), of_batches, "i int, line array<double>")
    cells = lines.select("i", F.posexplode("line").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((size, size))
    out[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["v"].to_numpy()
    return (out + out.T) / 2


def factor_of(gram: np.ndarray, n: int, shifted: bool) -> tuple[np.ndarray, bool]:
    """Upper triangular Cholesky factor of a Gram matrix that may be singular, and whether it was shifted.

    After a shift, directions without anything in them are filled up by their projection, which leaves the others as
    they are.
    """
    d, (eigen, vectors) = len(gram), np.linalg.eigh(gram)
    if shifted:
        empty = vectors[:, eigen < EMPTY * eigen[-1]]
        gram = gram + eigen[-1] * (empty @ empty.T)
        eigen = eigen[empty.shape[1] :]
    shift = eigen[0] <= SINGULAR * eigen[-1]
    if shift:
        size = max(11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2, 64 * d * np.finfo(float).eps)
        gram = gram + min(size, SINGULAR) * eigen[-1] * np.eye(d)
    return np.linalg.cholesky(gram).T, shifted or shift


def factors_of(vectors: DataFrame, n: int, sums: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """Upper triangular factors, the first one first, and the Gram matrix of the rows they leave."""
    width, factors, shifted = len(sums), list[np.ndarray](), False
    while True:
        known = list(factors)

        def of_rows(x: np.ndarray) -> np.ndarray:
            rows = _centred(x, n, sums)
            for factor in known:
                rows = solved(rows, factor)
            return rows.T @ rows

        gram = _summed(vectors, width, of_rows, width)
        done = not gram.any() or (factors and np.abs(gram @ gram - gram).max() < ORTHOGONAL)
        if done or len(factors) == PASSES:
            return factors, gram
        factor, shifted = factor_of(gram, n, shifted)
        factors.append(factor)


def _identity_error(vectors: DataFrame, model: Whitening, count: int) -> float | None:
    """Largest absolute entry of the covariance of the whitened fit vectors less the identity.

    Sums and products are of the whitened rows themselves; the product of their means is taken off in the end.
    """
    live = [k for k in range(min(count, len(model.variances))) if model.variances[k] > 0]
    if not live:
        return None
    n, sums, size = model.n, model.sums, len(live) + 1

    def of_rows(x: np.ndarray) -> np.ndarray:
        rows = model.whitened(_centred(x, n, sums), len(live))
        rows = np.hstack([rows, np.ones((len(rows), 1))])
        return rows.T @ rows

    total = _summed(vectors, len(sums), of_rows, size) / n
    mean = total[:-1, -1]
    return float(np.abs(total[:-1, :-1] - np.outer(mean, mean) - np.eye(len(live))).max())


def distinct_steps(vectors: DataFrame, vector_col: str, scale: int, scratch: Scratch) -> DataFrame:
    """The written list of distinct vectors in steps; copies are merged before anything is shuffled."""
    x = steps(F.col(f"`{vector_col}`"), scale).alias("x")
    found = vectors.select(x).where("x IS NOT NULL")
    width = found.agg(F.max(F.size("x"))).first()[0] or 0
    if width > DIMENSIONS:
        raise ValueError(f"vectors of {width} dimensions, more than {DIMENSIONS}")
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    return scratch.keep(found.select(filled.alias("x")).distinct(), "vectors")


def fit(vectors: DataFrame, vector_col: str = "embedding", scale: int = SCALE, count: int = 4) -> Whitening | None:
    """Components of the distinct vectors of a table, None where there are none; `count` go into the identity error."""
    scratch = Scratch(vectors.sparkSession, "whitening")
    held = distinct_steps(vectors, vector_col, scale, scratch)
    width = len((held.first() or {"x": []})["x"])
    n, sums = _totals(held, width)
    if not n:
        return None
    factors, gram = factors_of(held, n, sums)
    if factors:
        # The root of the last Gram matrix is a projection on what varies, for full rank the identity.
        eigen, vectors_of = np.linalg.eigh(gram)
        r = (vectors_of * np.sqrt(np.clip(eigen, 0, None))) @ vectors_of.T
        for factor in reversed(factors):
            r = r @ factor
        _, singular, components = np.linalg.svd(r)
        singular[singular <= NO_VARIANCE * singular[0]] = 0.0
        # A vector and its negative both serve; the entry of most weight is positive.
        top = components[np.arange(len(components)), np.abs(components).argmax(axis=1)]
        components *= np.where(top < 0, -1.0, 1.0)[:, None]
    else:
        singular, components = np.zeros(len(sums)), np.eye(len(sums))
    model = Whitening(n, sums, factors, components, singular**2 / n)
    model.identity_error = _identity_error(held, model, count)
    scratch.drop(held)
    return model


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over dimensions of (n*x - S)^2, in whole numbers of any size where 64 bits might not hold them."""
    most = max(n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max(map(abs, sums), default=0), 1)
    if most * most * max(x.shape[1], 1) < 2**63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    return [sum((n * v - s) ** 2 for v, s in zip(line, sums)) for line in x.tolist()]


def transform(vectors: DataFrame, model: Whitening | None, vector_col: str = "embedding", scale: int = SCALE, count: int = 4) -> DataFrame:
    """Rows with a usable vector as struct `row`, with deviation (decimal) and whitened, an array of `count` components."""
    rows = vectors.select(packed(vectors).alias("row"), steps(F.col(f"`{vector_col}`"), scale).alias("x")).where("x IS NOT NULL")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deviations, whitened = [], []
            for x in _blocks(batch, len(model.sums)):
                deviations += _deviations(x, model.n, model.sums)
                whitened += model.whitened(_centred(x, model.n, model.sums), count).tolist()
            told = [[None if v != v else v for v in line] for line in whitened]
            columns = [batch.column("row"), pa.array([str(v) for v in deviations], pa.string()), pa.array(told, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "deviation", "whitened"])

    schema = rows.select("row").schema.add("deviation", "string").add("whitened", T.ArrayType(T.DoubleType()))
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema).withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))
    return arrow_map(rows, of_batches, schema).withColumn("deviation", F.expr("try_cast(deviation AS decimal(38,0))"))
