"""Embedding whitening by shifted CholeskyQR.

The centred rows are a tall matrix A that stays distributed. Each pass adds up a Gram matrix over all
rows, takes its Cholesky factor R on the driver, and the next pass orthogonalises the rows through
triangular solves with the factors so far. The first factor comes from a shifted Gram matrix, so that
nearly dependent dimensions do not stop it. The composed factors have the singular values and right
singular vectors of A: one SVD of that small matrix gives the components.

The driver holds a few matrices of dimension x dimension; vectors never go there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.taskcontext import TaskContext

# The grid of the entries.
SCALE = 64
OFFSET = 1_000_000

# Entries beyond this do not fit the grid's 64-bit integers and count as not finite.
LARGEST = float(2**55)

# Gram passes at most; three are enough unless dimensions depend on each other.
MOST_PASSES = 6

# Singular values below this share of the largest are rounding, not variance.
RANK_SHARE = 1e-11

# Partial sums added up by one task, and the bytes of one.
FAN_IN = 32
SLICE_BYTES = 1 << 20

# Rows unpacked at a time.
BLOCK_ROWS = 1024


@dataclass(frozen=True)
class Whitening:
    """What was learned: ``axes`` has a unit column per component, by falling ``variances``.

    ``total`` is the trace of the covariance, ``identity_error`` the largest absolute entry of the
    whitened covariance minus the identity.
    """

    dimension: int
    n: int
    sums: np.ndarray
    axes: np.ndarray
    variances: np.ndarray
    total: float
    identity_error: float

    def top(self, components: int) -> Whitening:
        return Whitening(
            self.dimension, self.n, self.sums, self.axes[:, :components],
            self.variances[:components], self.total, self.identity_error,
        )


def _blocks(batch: pa.RecordBatch, vector: int, dimension: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, grid values as int64) of the batch's usable rows, some rows at a time."""
    for start in range(0, batch.num_rows, BLOCK_ROWS):
        lists = batch.column(vector).slice(start, BLOCK_ROWS)
        fits = pc.fill_null(pc.equal(pc.list_value_length(lists), dimension), False)
        rows = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
        if not len(rows):
            continue
        flat = lists.filter(fits).flatten().cast(pa.float64())
        values = flat.to_numpy(zero_copy_only=False).reshape(len(rows), dimension)
        with np.errstate(invalid="ignore"):
            usable = (np.abs(values) < LARGEST / SCALE).all(axis=1)  # a null is a NaN here
        if usable.any():
            grid = np.floor(SCALE * values[usable]).astype(np.int64) + OFFSET
            yield rows[usable] + start, grid


def _deviations(grid: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact: 64-bit where that is enough, Python integers beyond."""
    largest = int(np.abs(grid).max()) * n + max(abs(int(s)) for s in sums)
    if largest < 1 << 62:
        return n * grid - sums.astype(np.int64)
    return n * grid.astype(object) - sums


def _centred(grid: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (_deviations(grid, n, sums) / n).astype(np.float64)


def _squares(deviations: np.ndarray) -> list[int | None]:
    """Exact sums of squares; null where one does not fit a long."""
    rough = float(np.abs(deviations).max()) ** 2 * deviations.shape[1]
    if rough < 2.0**62:
        return (deviations.astype(np.int64) ** 2).sum(axis=1).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in deviations]
    return [s if s < 1 << 63 else None for s in exact]


def _solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows times the inverse of each upper triangular factor in turn, by forward substitution."""
    for r in factors:
        out = np.empty_like(rows)
        for j in range(r.shape[0]):
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


def _added(tables: pa.Table, kind: str) -> pa.Table:
    total = sum(np.frombuffer(v, kind) for v in tables["value"].to_pylist())
    return pa.table(
        {
            "slice": tables["slice"][:1],
            "part": pa.array([tables["part"][0].as_py() // FAN_IN], pa.int32()),
            "value": pa.array([total.tobytes()], pa.binary()),
        }
    )


def _summed(
    rows: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int, kind: str
) -> np.ndarray:
    """The sum over all tasks of the ``size`` numbers that ``partial`` makes of a task's rows.

    Sums travel in slices and are added up ``FAN_IN`` at a time, so no task holds more than that many
    slices and the driver one total.
    """
    slices = max(1, -(-size * 8 // SLICE_BYTES))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = np.array_split(np.asarray(partial(batches), kind).reshape(-1), slices)
        yield pa.RecordBatch.from_pydict(
            {
                "slice": pa.array(range(slices), pa.int32()),
                "part": pa.array([TaskContext.get().partitionId()] * slices, pa.int32()),
                "value": pa.array([p.tobytes() for p in pieces], pa.binary()),
            }
        )

    schema = "slice int, part int, value binary"
    parts = max(1, rows.rdd.getNumPartitions())
    sums = rows.mapInArrow(emit, schema)
    while parts > FAN_IN:
        group = F.floor(F.col("part") / FAN_IN).cast("int").alias("group")
        sums = sums.groupBy("slice", group).applyInArrow(lambda t: _added(t, kind), schema)
        parts = -(-parts // FAN_IN)
    sums = sums.groupBy("slice").applyInArrow(lambda t: _added(t, kind), schema)
    found = {r["slice"]: r["value"] for r in sums.collect()}
    if not found:
        return np.zeros(size, kind)
    return np.concatenate([np.frombuffer(found[s], kind) for s in range(slices)])


def _factor(gram: np.ndarray, shifted: bool) -> np.ndarray:
    """Upper triangular R with R'R = gram, plus a shift above the rounding of the sums if asked or needed."""
    d = gram.shape[0]
    unit = np.finfo(np.float64).eps / 2
    shift = 11 * (BLOCK_ROWS * d + d * (d + 1)) * unit * np.trace(gram)
    add = shift if shifted else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + add * np.eye(d)).T
        except np.linalg.LinAlgError:
            add = max(10 * add, shift)


def _dimension(vectors: DataFrame) -> int:
    """The length that most usable vectors have, the longer of equally frequent ones."""
    item = lambda c: c.isNotNull() & (F.abs(c.cast("double")) < LARGEST / SCALE)
    usable = vectors.where(F.col("vector").isNotNull() & F.forall("vector", item))
    lengths = usable.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("rows"))
    first = lengths.orderBy(F.desc("rows"), F.desc("length")).limit(1).collect()
    return first[0]["length"] if first else 0


def fit_whitening(rows: DataFrame, vector_col: str = "embedding", components: int = 32) -> Whitening | None:
    """Learn the components of the usable vectors of ``rows``.

    A vector is usable if it is not null, has no null, NaN or infinite entry (nor one beyond 2**49)
    and has the length that most such vectors have. None where no usable vector varies, as in an
    empty table, a table of equal vectors or of empty ones. Dimensions that depend on others give
    fewer components than dimensions. Repeated rows count as often as they occur.
    """
    vectors = rows.select(F.col(vector_col).alias("vector"))
    d = _dimension(vectors)
    if not d:
        return None

    def sums_of(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        # 16 bits of the values at a time, so that no sum of a pass leaves 64 bits
        n, limbs = 0, np.zeros((4, d), np.int64)
        for batch in batches:
            for _, grid in _blocks(batch, 0, d):
                n += len(grid)
                for i in range(4):
                    limb = grid >> (16 * i)
                    limbs[i] += (limb & 0xFFFF if i < 3 else limb).sum(axis=0)
        return np.concatenate([[n], limbs.ravel()])

    counted = _summed(vectors, sums_of, 4 * d + 1, "<i8")
    n, limbs = int(counted[0]), counted[1:].reshape(4, d).tolist()
    sums = np.array([sum(limbs[i][j] << (16 * i) for i in range(4)) for j in range(d)], object)

    factors: list[np.ndarray] = []
    for number in range(MOST_PASSES):

        def gram_of(batches: Iterator[pa.RecordBatch], done=tuple(factors)) -> np.ndarray:
            total = np.zeros((d, d))
            for batch in batches:
                for _, grid in _blocks(batch, 0, d):
                    q = _solved(_centred(grid, n, sums), list(done))
                    total += q.T @ q
            return total

        gram = _summed(vectors, gram_of, d * d, "<f8").reshape(d, d)
        if not np.trace(gram) > 0:
            return None
        factors.append(_factor(gram, shifted=number == 0))
        if number >= 2 and np.abs(gram - np.eye(d)).max() < 1e-10:
            break

    composed = factors[0]
    for r in factors[1:]:
        composed = r @ composed
    _, singular, right = np.linalg.svd(composed)
    kept = (singular > RANK_SHARE * singular[0]).nonzero()[0][:components]
    axes = right[kept].T
    # one sign for all rows: the largest entry of each component is positive
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), range(len(kept))])
    variances = singular**2 / n
    found = Whitening(d, n, sums, axes, variances[kept], float(variances.sum()), 0.0)
    error = _identity_error(vectors, found)
    return Whitening(d, n, sums, axes, variances[kept], found.total, error)


def _identity_error(vectors: DataFrame, model: Whitening) -> float:
    """How far the covariance of the whitened vectors is from the identity, in one pass.

    Each block is centred before it is multiplied; what its own mean leaves out is added back.
    """
    k = len(model.variances)

    def moments_of(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        inner, outer, total = np.zeros((k, k)), np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            for _, grid in _blocks(batch, 0, model.dimension):
                white = _whitened(grid, model)
                mean = white.mean(axis=0)
                inner += (white - mean).T @ (white - mean)
                outer += len(white) * np.outer(mean, mean)
                total += white.sum(axis=0)
        return np.concatenate([inner.ravel(), outer.ravel(), total])

    sums = _summed(vectors, moments_of, 2 * k * k + k, "<f8")
    inner, outer, total = np.split(sums, [k * k, 2 * k * k])
    mean = total / model.n
    covariance = (inner + outer).reshape(k, k) / model.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max())


def _whitened(grid: np.ndarray, model: Whitening) -> np.ndarray:
    return _centred(grid, model.n, model.sums) @ model.axes / np.sqrt(model.variances)


def whiten(
    rows: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """A row for each usable vector and component, with the vector's whitened coordinate.

    Rows with unusable vectors (see ``fit_whitening``) have none. Ids may be null or repeated, other
    columns of ``rows`` are left out whatever their names. Without a model the result is empty.
    ``deviation`` is null where it does not fit a long.
    """
    schema = T.StructType(
        [
            T.StructField(id_col, rows.schema[id_col].dataType),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    k = len(model.variances)
    shares = model.variances / model.total

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for numbers, grid in _blocks(batch, 1, model.dimension):
                m = len(numbers)
                squares = pa.array(_squares(_deviations(grid, model.n, model.sums)), pa.int64())
                each = pa.array(np.repeat(np.arange(m), k))
                columns = [
                    batch.column(0).take(pa.array(numbers)).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, np.int64)),
                    squares.take(each),
                    pa.array(_whitened(grid, model).ravel()),
                    pa.array(np.tile(shares, m)),
                    pa.array(np.full(m * k, model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.select(id_col, vector_col).mapInArrow(emit, schema)
