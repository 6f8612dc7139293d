"""Principal components and whitening of an embedding table by Golub-Kahan-Lanczos bidiagonalisation."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodmark.llm.batches import map_batches
from floodmark.llm.scratch import Scratch
from floodmark.llm.text import column

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Scaled entries from this size on have no exact whole number in a double.
LARGEST = 2.0**52
#: Bytes of a block of centred rows as doubles, which a task holds at a time.
BLOCK_BYTES = 1 << 20
#: Residual of a component against the largest deviation, and the share of it below which a deviation counts as none.
CONVERGED, NOTHING = 1e-14, 1e-9


def usable(vector: Column) -> Column:
    """True where a vector is not null and all its entries are finite numbers with an exact whole number."""
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * SCALE) < LARGEST)
    return vector.isNotNull() & F.coalesce(F.forall(vector, entry), F.lit(False))


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column as doubles; all have `dims` entries."""
    return pc.list_flatten(lists).cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)


def _whole(values: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * values).astype(np.int64) + SHIFT


@dataclass(frozen=True)
class Centre:
    """n rows and the exact sums S of each dimension, as S = whole * n + rest."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    def differences(self, x: np.ndarray) -> np.ndarray:
        """x less the whole part of the mean; exact."""
        return x - self.whole

    def centred(self, differences: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once."""
        return differences - self.rest / self.n

    def deviations(self, differences: np.ndarray) -> list[Decimal]:
        """Sum over dimensions of (n * x - S) ** 2 for each row; exact."""
        most = self.n * (int(np.abs(differences).max(initial=0)) + 1)
        if most * most * differences.shape[1] < 1 << 63:
            t = self.n * differences - self.rest
            return [Decimal(v) for v in (t * t).sum(axis=1).tolist()]
        t = self.n * differences.astype(object) - self.rest.astype(object)
        return [Decimal(int(v)) for v in (t * t).sum(axis=1)]


def _narrow(rows: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, vector) of usable rows of the usual length, and that length: the most frequent one, then the longest."""
    good = rows.select(column(id_col).alias("id"), column(vector_col).cast("array<double>").alias("vector")).filter(usable(F.col("vector")))
    usual = good.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = usual.dims if usual else 0
    return good.filter(F.size("vector") == dims), dims


def _fit_centre(good: DataFrame, dims: int) -> Centre:
    """Counts and sums per dimension, added up in every task before `dims` + 1 numbers of each are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dims, dtype=object)
        for batch in batches:
            x = _whole(_matrix(batch.column(0), dims))
            n += len(x)
            total += sum((part.sum(axis=0).astype(object) for part in np.array_split(x, len(x) // 512 + 1)), np.zeros(dims, dtype=object))
        if n:
            values = pa.array([Decimal(int(v)) for v in [*total, n]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(dims + 1), pa.int32()), values], ["i", "s"])

    rows = map_batches(good.select("vector"), run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    sums = {r.i: int(r.s) for r in rows}
    n = sums.get(dims, 0)
    parts = [divmod(sums.get(i, 0), max(n, 1)) for i in range(dims)]
    return Centre(n, np.array([p[0] for p in parts], dtype=np.int64), np.array([p[1] for p in parts], dtype=np.int64))


def _blocks(good: DataFrame, dims: int, centre: Centre) -> DataFrame:
    """Rows as blocks of differences in the smallest integer type that holds them, (kind string, data binary)."""
    most = max(1, BLOCK_BYTES // (8 * dims))

    def packed(rows: list[np.ndarray]) -> pa.RecordBatch:
        data = np.concatenate(rows)
        kind = np.result_type(np.min_scalar_type(int(data.min(initial=0))), np.min_scalar_type(int(data.max(initial=0))), np.int8)
        return pa.RecordBatch.from_arrays([pa.array([kind.str]), pa.array([data.astype(kind).tobytes()], pa.binary())], ["kind", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            x = centre.differences(_whole(_matrix(batch.column(0), dims)))
            for part in np.array_split(x, range(most, len(x), most)):
                if count + len(part) > most:
                    yield packed(held)
                    held, count = [], 0
                held.append(part)
                count += len(part)
        if count:
            yield packed(held)

    return map_batches(good.select("vector"), run, "kind string, data binary")


def _summed(blocks: DataFrame, dims: int, centre: Centre, length: int, function: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all blocks of `function(centred rows)`, a vector of `length` numbers.

    A task adds up its blocks, a shuffle adds up the tasks number by number; the driver gets `length` numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_ = np.zeros(length), False
        for batch in batches:
            for kind, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = np.frombuffer(data.as_buffer(), dtype=np.dtype(kind)).reshape(-1, dims)
                total += function(centre.centred(rows.astype(np.float64)))
                any_ = True
        if any_:
            yield pa.RecordBatch.from_arrays([pa.array(range(length), pa.int32()), pa.array(total)], ["i", "s"])

    out = np.zeros(length)
    for r in map_batches(blocks, run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect():
        out[r.i] = r.s
    return out


class Bidiagonal:
    """Steps of the bidiagonalisation of centred rows A: A V = U B with B upper bidiagonal.

    Only numbers of the size of a row are held here. A left vector has an entry per row; it is A w for the w kept here,
    so each task makes the entries of its rows from w, and nothing of the rows' size is stored or sent. One pass over the
    rows gives A v, its products with all earlier left vectors and Aᵀ of it: both sides are reorthogonalised in full.
    """

    def __init__(self, dims: int, seed: int = 0) -> None:
        self.random = np.random.default_rng(seed)
        self.v = np.zeros((dims, 0))
        self.w = np.zeros((dims, 0))
        self.aty = np.zeros((dims, 0))
        self.alpha: list[float] = []
        self.beta: list[float] = []  # beta[k] lies between steps k and k + 1
        self.start = 0  # first step since the last restart
        self.restart()

    def restart(self) -> None:
        """Go on with a random direction outside of all found so far."""
        self.next = self._outside(self.random.standard_normal(len(self.v)))
        self.next /= max(np.linalg.norm(self.next), np.finfo(float).tiny)
        if self.beta:
            self.beta[-1] = 0.0
        self.start = len(self.alpha)

    def _outside(self, x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - self.v @ (self.v.T @ x)
        return x

    @property
    def steps(self) -> int:
        return len(self.alpha)

    def step(self, product: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, float]], scale: float) -> None:
        """One step. `product(w, W)` gives Aᵀ A w, (A W)ᵀ A w and |A w|² over all rows; `scale` is the size of A."""
        v, beta = self.next, self.beta[-1] if self.beta else 0.0
        w = v - beta * self.w[:, -1] if self.steps and beta else v
        aty, c, square = product(w, self.w)
        w, aty, square = w - self.w @ c, aty - self.aty @ c, max(square - float(c @ c), 0.0)
        alpha = square**0.5 if square**0.5 > NOTHING * scale else 0.0
        if alpha:
            w, aty = w / alpha, aty / alpha
            z = self._outside(aty - alpha * v)
            z = z - v * (v @ z)
        else:  # nothing of A lies along v
            w, aty, z = np.zeros_like(w), np.zeros_like(aty), np.zeros_like(v)
        self.v, self.w, self.aty = np.column_stack([self.v, v]), np.column_stack([self.w, w]), np.column_stack([self.aty, aty])
        z = self._outside(z)
        size = float(np.linalg.norm(z))
        self.alpha.append(alpha)
        self.beta.append(size)
        if size > 1e-13 * scale:
            self.next = z / size
        else:
            self.restart()

    def singular(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Deviations of A along the components found so far (falling), the components, and their residuals."""
        b = np.diag(self.alpha) + np.diag(self.beta[:-1], 1)
        left, s, right = np.linalg.svd(b)
        return s, self.v @ right.T, np.abs(left[-1]) * self.beta[-1]

    def newest(self) -> tuple[float, float]:
        """Largest deviation found since the last restart and its residual."""
        b = np.diag(self.alpha[self.start :]) + np.diag(self.beta[self.start : -1], 1)
        left, s, _ = np.linalg.svd(b)
        return s[0], abs(left[-1, 0]) * self.beta[-1]


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: `axes` has a column per component, `variances` their eigenvalues, falling."""

    dims: int
    centre: Centre
    axes: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float
    steps: int


def fit(good: DataFrame, dims: int, components: int = 32, scratch: Scratch | None = None) -> Whitening:
    """Components of (id, vector) rows, all of `dims` entries.

    Golub-Kahan-Lanczos steps go on until the wanted components have converged to double precision and a restart from a random
    direction outside of them shows no larger deviation (which would be one of several equal ones), or all dimensions are
    spanned. One pass over a table of packed rows per step. Directions in which the rows don't vary are no components.
    """
    scratch = scratch or Scratch(good.sparkSession)
    centre = _fit_centre(good, dims) if dims else Centre(0, np.zeros(0, np.int64), np.zeros(0, np.int64))
    if not centre.n:
        return Whitening(dims, centre, np.zeros((dims, 0)), np.zeros(0), np.zeros(0), 0.0, 0)
    blocks = scratch.keep(_blocks(good, dims, centre))
    moments = _summed(blocks, dims, centre, dims + 1, lambda a: np.append(a.sum(axis=0), (a * a).sum()))
    mean, square = moments[:dims] / centre.n, moments[dims]
    scale = square**0.5

    def product(w: np.ndarray, earlier: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        def add(a: np.ndarray) -> np.ndarray:
            p = a @ w
            return np.concatenate([p @ a, (p @ a) @ earlier, [p @ p]])

        out = _summed(blocks, dims, centre, dims + earlier.shape[1] + 1, add)
        return out[:dims], out[dims:-1], float(out[-1])

    want = min(components, dims)
    lanczos = Bidiagonal(dims)
    checked = False
    while scale and lanczos.steps < dims:
        lanczos.step(product, scale)
        if lanczos.steps < want:
            continue
        s, _, residual = lanczos.singular()
        if residual[:want].max() > CONVERGED * s[0]:
            continue
        if not checked:
            checked = True
            lanczos.restart()
        elif lanczos.steps > lanczos.start:
            new, left = lanczos.newest()
            if left <= 0.01 * new and new + left < s[want - 1] or new <= NOTHING * scale:
                break
    if not lanczos.steps:
        return Whitening(dims, centre, np.zeros((dims, 0)), np.zeros(0), np.zeros(0), 0.0, 0)
    s, axes, _ = lanczos.singular()
    kept = s[:want] > NOTHING * scale
    axes, variances = axes[:, :want][:, kept], s[:want][kept] ** 2 / centre.n
    turn = axes / np.sqrt(variances)
    at = mean @ turn

    def covariance(a: np.ndarray) -> np.ndarray:
        z = a @ turn - at
        return (z.T @ z).ravel()

    k = len(variances)
    found = _summed(blocks, dims, centre, k * k, covariance).reshape(k, k) / centre.n
    error = float(np.abs(found - np.eye(k)).max(initial=0.0))
    scratch.drop(blocks)
    return Whitening(dims, centre, axes, variances, variances * centre.n / square, error, lanczos.steps)


def whiten(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32, scratch: Scratch | None = None
) -> DataFrame:
    """One row per usable row of `rows` and component (from 1, by falling variance): id, component int, n long, deviation
    decimal(38,0), whitened, explained and identity_error double.

    Entries c become x = floor(64 * c) + 1000000. n counts the usable rows, deviation is the exact sum over dimensions of
    (n * x - S) ** 2 for the sums S, whitened the centred row along the component over its standard deviation, explained
    the component's share of the variance, identity_error the largest absolute entry of whitened's covariance less the
    identity.

    Left out: null vectors, vectors with a null, NaN or infinite entry or one over 2**46, and vectors of another length
    than most (the longer length of equally frequent ones). Directions without variance are no components, so equal
    rows, a single row, empty vectors and an empty table give no row. Null and repeated ids and equal vectors stay as they are.
    """
    good, dims = _narrow(rows, id_col, vector_col)
    model = fit(good, dims, components, scratch)
    centre, k = model.centre, len(model.variances)
    turn = model.axes / np.sqrt(model.variances) if k else model.axes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows if k else 0
            if not m:
                continue
            differences = centre.differences(_whole(_matrix(batch.column(1), dims)))
            at = pa.array(np.repeat(np.arange(m), k))
            deviation = pa.array(centre.deviations(differences), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), deviation.take(at),
                pa.array((centre.centred(differences) @ turn).ravel()), pa.array(np.tile(model.explained, m)),
            ], ["id", "component", "deviation", "whitened", "explained"])

    kind = good.schema["id"].dataType.simpleString()
    out = map_batches(good, run, f"id {kind}, component int, deviation decimal(38,0), whitened double, explained double")
    return out.select(
        F.col("id").alias(id_col), "component", F.lit(centre.n).cast("long").alias("n"), "deviation", "whitened", "explained",
        F.lit(model.identity_error).alias("identity_error"))
