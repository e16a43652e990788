"""Embedding whitening by shifted CholeskyQR.

The fit list is each distinct integer vector once, n of them with sums S in each dimension. Its centred rows
y = (n x - S) / n are differences of exact integers, so a large common offset costs no digits. Rows are never
orthogonalised in place: each pass sends a row through the triangular solves of all factors found so far and adds up the
Gram matrix of the outcome, one matrix a task. The first Cholesky factor is that of the Gram matrix plus a shift, which
makes it positive whatever the rank; later passes make the rows orthonormal to the last digits. The factors compose
to R with R'R = n V, and the right singular vectors of R are the components, its singular values those of the rows.
The covariance itself is never factored, so small eigenvalues keep their digits.

What reaches the driver are matrices of the vectors' width, whatever the number of rows.

Defined results: rows with a null or non-finite entry, a null vector, or a length other than the most frequent take no
part; repeated rows are each returned, and count once in the fit list; a null vec_id stays null; components without
variance cannot be whitened and are not returned (for a single distinct vector, none); ``deviation`` is null where a long
cannot hold it; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.integer_vectors import SAFE, as_long, exact, integer_vectors, largest, matrix
from clinlake.session import stored

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Gram passes at most; two are the rule, more are needed for nearly dependent dimensions.
PASSES = 6
#: Rows count as orthonormal when every eigenvalue of their Gram matrix is so close to one, or to zero.
ORTHONORMAL = 1e-10
_ROWS = 2048

_ROW = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Centre:
    """The number of fitted vectors and their exact sums."""

    n: int
    sums: tuple[int, ...]

    def exactly(self, x: np.ndarray) -> np.ndarray:
        """n x - S, in integers."""
        bound = 2 * max(self.n * largest(x), *map(abs, self.sums))
        kind = np.int64 if bound < SAFE else object
        return self.n * x.astype(kind) - np.array(self.sums, dtype=kind)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.exactly(x).astype(np.float64) / self.n


@dataclass(frozen=True)
class Whitening:
    centre: Centre
    components: np.ndarray  # one a row, unit length
    eigenvalues: np.ndarray
    trace: float

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.centre.rows(x) @ self.components.T / np.sqrt(self.eigenvalues)


def solved(y: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Q with Q R = Y for an upper triangular R, a column after the other."""
    q = np.empty_like(y)
    for j in range(y.shape[1]):
        q[:, j] = (y[:, j] - q[:, :j] @ factor[:j, j]) / factor[j, j]
    return q


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for first in range(0, batch.num_rows, _ROWS):
            yield matrix(batch["_x"].slice(first, _ROWS), width)


def centre_of(fit: DataFrame, width: int) -> Centre:
    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * width
        for x in _chunks(batches, width):
            n += len(x)
            sums = [a + int(b) for a, b in zip(sums, exact(x, len(x) * largest(x)).sum(0), strict=True)]
        if n:
            yield pa.RecordBatch.from_pydict(
                {"axis": pa.array(range(width), pa.int32()), "n": pa.array([n] * width, pa.int64()), "s": pa.array(map(Decimal, sums), pa.decimal128(38, 0))}
            )

    rows = fit.mapInArrow(of_task, "axis int, n long, s decimal(38,0)").groupBy("axis").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    return Centre(rows[0]["n"] if rows else 0, tuple(int(r["s"]) for r in sorted(rows, key=lambda r: r["axis"])))


def _summed(fit: DataFrame, width: int, of_rows: Callable[[np.ndarray], np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Gram matrix and sum of the rows that ``of_rows`` makes, ``size`` wide, added up in each task and then over tasks."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, total, some = np.zeros((size, size)), np.zeros(size), False
        for x in _chunks(batches, width):
            rows = of_rows(x)
            gram += rows.T @ rows
            total += rows.sum(0)
            some = True
        if some:
            i, j = np.triu_indices(size)
            yield pa.RecordBatch.from_pydict({
                "i": np.concatenate([i, np.full(size, -1)]).astype(np.int32),
                "j": np.concatenate([j, np.arange(size)]).astype(np.int32),
                "v": np.concatenate([gram[i, j], total]),
            })

    found = fit.mapInArrow(of_task, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    i, j, v = (found[c].to_numpy() for c in "ijv")
    gram, total, inner = np.zeros((size, size)), np.zeros(size), i >= 0
    total[j[~inner]] = v[~inner]
    gram[i[inner], j[inner]] = gram[j[inner], i[inner]] = v[inner]
    return gram, total


def triangular_factors(n: int, width: int, gram_of: Callable[[list[np.ndarray]], np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The factors of the passes, first to last, and the Gram matrix of the rows after all of them."""
    factors: list[np.ndarray] = []
    gram = gram_of(factors)
    for _ in range(PASSES):
        values = np.linalg.eigvalsh(gram)
        if factors and np.minimum(np.abs(values - 1), np.abs(values)).max() < ORTHONORMAL:
            break
        shift = min(11 * (n * width + width * (width + 1)) * np.finfo(float).eps / 2, 0.01) * values[-1]
        # A later Gram matrix needs the shift only where the rank is short.
        shifted = gram + shift * np.eye(width) if not factors or values[0] <= shift else gram
        factors.append(np.linalg.cholesky(shifted).T)
        gram = gram_of(factors)
    return factors, gram


def fitted(fit: DataFrame, width: int, k: int = COMPONENTS) -> Whitening | None:
    """The whitening of the fit list (_x, each vector once), or None where nothing varies."""
    centre = centre_of(fit, width)

    def orthogonalised(factors: list[np.ndarray]) -> Callable[[np.ndarray], np.ndarray]:
        def of_rows(x: np.ndarray) -> np.ndarray:
            y = centre.rows(x)
            for factor in factors:
                y = solved(y, factor)
            return y

        return of_rows

    if centre.n < 2:
        return None
    factors, gram = triangular_factors(centre.n, width, lambda found: _summed(fit, width, orthogonalised(list(found)), width)[0])
    composed = np.eye(width)
    for factor in factors:
        composed = factor @ composed
    # What the last Gram matrix still differs from the identity goes into R as its square root; directions that the
    # shift alone carried are zero there.
    values, vectors = np.linalg.eigh(gram)
    _, singular, components = np.linalg.svd((vectors * np.sqrt(np.maximum(values, 0))).T @ composed)
    rank = int((singular > singular[0] * max(centre.n, width) * np.finfo(float).eps).sum())
    eigenvalues = singular**2 / centre.n
    kept = min(k, rank)
    return Whitening(centre, components[:kept], eigenvalues[:kept], float(eigenvalues.sum()))


def identity_error(fit: DataFrame, width: int, whitening: Whitening) -> float:
    """The largest entry of the covariance of the whitened fit list, minus the identity."""
    gram, total = _summed(fit, width, whitening.rows, len(whitening.eigenvalues))
    n = whitening.centre.n
    return float(np.abs(gram / n - np.outer(total / n, total / n) - np.eye(len(total))).max())


def whitened(vectors: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error of every row and component."""
    spark = vectors.sparkSession
    rows, width = integer_vectors(vectors, F.col("vec_id").cast("long"), SCALE, OFFSET)
    if not width:
        return spark.createDataFrame([], _ROW)
    fit = stored(rows.select("_x").distinct(), "fit-list")
    whitening = fitted(fit, width, k)
    if whitening is None or not len(whitening.eigenvalues):
        return spark.createDataFrame([], _ROW)
    error, size = identity_error(fit, width, whitening), len(whitening.eigenvalues)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                part = batch.slice(first, _ROWS)
                x = matrix(part["_x"], width)
                apart = whitening.centre.exactly(x)
                deviation = [as_long(v) for v in (exact(apart, width * largest(apart) ** 2) ** 2).sum(1)]
                each = np.repeat(np.arange(len(x)), size)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["_whole"].take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(each), whitening.centre.n)),
                        pa.array(deviation, pa.int64()).take(pa.array(each)),
                        pa.array(whitening.rows(x).ravel()),
                        pa.array(np.tile(whitening.eigenvalues / whitening.trace, len(x))),
                        pa.array(np.full(len(each), error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(of_batches, _ROW)
