"""Whitening of embeddings: projections on the covariance's largest eigenvectors, each scaled to variance one.

The covariance is never formed. A product of it with a few vectors is one pass over the rows: each row is centred, projected
on the vectors, and adds itself times its projections to a sum. On these products runs a block Jacobi-Davidson method on
the driver, which holds only vectors of the embedding's length:

* Rayleigh-Ritz in an orthonormal search space gives approximate pairs and their residuals without a further pass;
* leading pairs whose residuals reach double precision are locked, and the space is kept orthogonal to them;
* for the next pairs the correction equations (I - G G')(A - theta I)(I - G G') t = -r, with G the locked vectors and
  those approximated, are solved roughly by MINRES, all of them together, so that a step is one pass;
* the corrections widen the search space, which is cut back to the best vectors when it grows too large.

Rows are integers, so their sums are exact, and n * x - S is computed in integers before it is divided by n: an offset
that all rows share costs no digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
#: Integers are at most this size before the shift.
TOP = 1 << 35
#: Steps of the inner solver for one correction; a rough solution is enough.
INNER = 8
ROUGH = 0.05
#: The search space is cut back when it is wider than this many blocks.
BLOCKS = 4
#: Directions with a smaller share of the largest variance are taken to have none: it would be rounding only.
NOTHING = 1e-11
SEED = 12
PARTS = 64
LONG = (1 << 63) - 1

Product = Callable[[np.ndarray], np.ndarray]


# -- rows -----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Centre:
    """Number of rows and exact sums: x - S/n is (n * y - r) / n for y = x - floor(S/n)."""

    n: int
    floor: np.ndarray
    rest: np.ndarray

    def gaps(self, column: pa.Array) -> np.ndarray:
        return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), -1) - self.floor

    def fits(self, y: np.ndarray, bound: int) -> bool:
        """Whether n * y - r is below ``bound`` everywhere."""
        return self.n * (max(int(y.max(initial=0)), -int(y.min(initial=0))) + 1) < bound

    def centred(self, column: pa.Array) -> np.ndarray:
        y = self.gaps(column)
        return (self.n * y - self.rest) / self.n if self.fits(y, 1 << 62) else y - self.rest / self.n

    def deviations(self, column: pa.Array) -> list[int]:
        """Sum of (n * x - S)^2 of each row, exactly; 2^63 - 1 if it is larger."""
        y = self.gaps(column)
        if self.fits(y, 1 << max(0, (62 - y.shape[1].bit_length()) // 2)):
            z = self.n * y - self.rest
            return np.einsum("ij,ij->i", z, z).tolist()
        rest = [int(r) for r in self.rest]
        return [min(sum((self.n * v - r) ** 2 for v, r in zip(row, rest, strict=True)), LONG) for row in y.tolist()]


def centre_of(rows: DataFrame, size: int) -> Centre:
    """From one pass: sums of parts are long, their total decimal."""
    part = F.pmod(F.xxhash64("vec_id"), F.lit(PARTS))
    parts = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"), *[F.sum(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(size)])
    found = parts.agg(F.sum("n").alias("n"), *[F.sum(F.col(f"s{i}").cast("decimal(38, 0)")).alias(f"s{i}") for i in range(size)]).first()
    n, sums = found["n"], [int(found[f"s{i}"]) for i in range(size)]
    return Centre(n, np.array([s // n for s in sums]), np.array([s % n for s in sums]))


def summed(rows: DataFrame, add: Callable[[pa.Array], np.ndarray], width: int) -> np.ndarray:
    """Sum over all rows of the ``width`` numbers that ``add`` gives for a batch of x: a task hands on one set of them."""
    schema = pa.schema([("at", pa.int32()), ("value", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += add(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], schema=schema)

    out = np.zeros(width)
    for at, value in rows.select("x").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value")).collect():
        out[at] = value
    return out


def covariance_times(rows: DataFrame, centre: Centre) -> Product:
    """The covariance's product with the columns of a matrix, in one pass."""

    def product(vectors: np.ndarray) -> np.ndarray:
        def add(x: pa.Array) -> np.ndarray:
            z = centre.centred(x)
            return (z.T @ (z @ vectors)).ravel()

        return summed(rows, add, vectors.size).reshape(vectors.shape) / centre.n

    return product


# -- eigenvectors ---------------------------------------------------------------------------------


def minres(times: Product, right: np.ndarray, steps: int, rough: float) -> np.ndarray:
    """Solutions of symmetric systems, one for each column, all advanced by each product."""
    length = lambda a: np.sqrt((a * a).sum(axis=0))
    over = lambda a, b: np.divide(a, b, out=np.zeros_like(a), where=b > 0)
    start = length(right)
    v, v_old = over(right, np.broadcast_to(start, right.shape)), np.zeros_like(right)
    w = w_old = x = np.zeros_like(right)
    c = c_old = np.ones_like(start)
    s = s_old = beta = np.zeros_like(start)
    left = start.copy()
    for _ in range(steps):
        p = times(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * v_old
        after = length(p)
        delta, second, third = c * alpha - c_old * s * beta, s * alpha + c_old * c * beta, s_old * beta
        first = np.hypot(delta, after)
        c_old, s_old, c, s = c, s, over(delta, first), over(after, first)
        w, w_old = over(v - third * w_old - second * w, np.broadcast_to(first, v.shape)), w
        x = x + c * left * w
        left = -s * left
        v, v_old, beta = over(p, np.broadcast_to(after, p.shape)), v, after
        if (np.abs(left) <= rough * start).all():
            break
    return x


def orthonormal(vectors: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns add to the space of ``against``; columns that add nothing are left out."""
    kept = against
    for column in vectors.T:
        size = np.linalg.norm(column)
        if not size:
            continue
        v = column / size
        for _ in range(3):
            v = v - kept @ (kept.T @ v)
            size = np.linalg.norm(v)
            if size < 1e-8:
                break
            v /= size
        else:
            kept = np.column_stack([kept, v])
    return kept[:, against.shape[1] :]


def jacobi_davidson(times: Product, size: int, wanted: int, inner: int = INNER, most: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors of a symmetric positive matrix given by products.

    A pair is locked when its residual is at most max(size, 64) units of double precision of the largest eigenvalue, or
    when it has long been near that and gets no smaller. Raises if that is not reached.
    """
    rng = np.random.default_rng(SEED)
    wanted = min(wanted, size)
    locked, values = np.zeros((size, 0)), np.zeros(0)
    basis = orthonormal(rng.standard_normal((size, wanted)), locked)
    image = times(basis)
    smallest, idle = np.inf, 0
    for _ in range(most):
        inside = basis.T @ image
        found, turn = np.linalg.eigh((inside + inside.T) / 2)
        found, turn = found[::-1], turn[:, ::-1]
        ritz, images = basis @ turn, image @ turn
        away = images - ritz * found
        away = away - locked @ (locked.T @ away)
        sizes = np.linalg.norm(away, axis=0)
        top = max([abs(v) for v in (*values[:1], *found[:1])])
        left = min(wanted - locked.shape[1], len(found))
        unit = np.finfo(float).eps * top
        largest = sizes[:left].max(initial=0)
        smallest, idle = (largest, 0) if largest < smallest / 2 else (smallest, idle + 1)
        precise = unit * max(size, 64) if idle < 8 else unit * max(size, 64) * 100
        done = int((sizes[:left] <= precise).cumprod().sum())
        locked, values = np.column_stack([locked, ritz[:, :done]]), np.append(values, found[:done])
        basis, image = ritz[:, done:], images[:, done:]
        if locked.shape[1] >= wanted or locked.shape[1] >= size:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        left -= done
        near, theta, right = basis[:, :left], found[done : done + left], -away[:, done : done + left]
        if basis.shape[1] > BLOCKS * wanted:  # cut back to the best, with room for those behind them
            basis, image = basis[:, : 2 * wanted], image[:, : 2 * wanted]
        fixed = orthonormal(np.column_stack([locked, near]), np.zeros((size, 0)))
        outside = lambda a: a - fixed @ (fixed.T @ a)  # noqa: B023, E731
        shifted = lambda a: outside(times(a) - a * theta)  # noqa: B023, E731
        more = outside(minres(shifted, outside(right), inner, ROUGH))
        if idle:  # a step without gain: a direction of chance leads out of an invariant space
            more = np.column_stack([more, rng.standard_normal((size, 1))])
        more = orthonormal(more, np.column_stack([locked, basis]))
        if more.shape[1]:
            basis, image = np.column_stack([basis, more]), np.column_stack([image, times(more)])
    raise RuntimeError(f"residuals of {wanted - locked.shape[1]} eigenvectors did not reach double precision")


# -- the operator ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: the rows' centre, unit eigenvectors as columns, eigenvalues, their shares, the check."""

    centre: Centre | None
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float


def whole_numbers(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, x) of every usable row, with x = floor(scale * c) + shift for each entry c (bounded by ``TOP`` to either side)."""
    vector = F.col(f"`{embedding}`").cast("array<double>")
    usable = (F.size(vector) > 0) & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    bounded = lambda c: F.greatest(F.least(c * scale, F.lit(float(TOP))), F.lit(float(-TOP)))
    x = F.transform(vector, lambda c: F.floor(bounded(c)) + F.lit(shift).cast("long"))
    return rows.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.when(usable, x).alias("x")).where(F.col("x").isNotNull())


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of (vec_id, x), all of one length; none of its directions if all rows are equal or there are none."""
    first = rows.first()
    if first is None:
        return Whitening(None, np.zeros((0, 0)), np.zeros(0), np.zeros(0), 0.0)
    size = len(first["x"])
    centre = centre_of(rows, size)
    values, vectors = jacobi_davidson(covariance_times(rows, centre), size, components)
    kept = values > NOTHING * max(values.max(initial=0), np.finfo(float).tiny)
    values, vectors = values[kept], vectors[:, kept]
    ways, m = vectors / np.sqrt(values), len(values)

    def add(x: pa.Array) -> np.ndarray:
        z = centre.centred(x)
        w = z @ ways
        return np.concatenate([(w.T @ w).ravel(), w.sum(axis=0), [np.einsum("ij,ij->", z, z)]])

    sums = summed(rows, add, m * m + m + 1) / centre.n
    mean = sums[m * m : -1]
    error = np.abs(sums[: m * m].reshape(m, m) - np.outer(mean, mean) - np.eye(m)).max(initial=0)
    return Whitening(centre, vectors, values, values / sums[-1] if sums[-1] else values, float(error))


def apply(rows: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each row of (vec_id, x) and component."""
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("deviation", pa.int64()), ("whitened", pa.float64())])
    m = len(model.values)
    ways = model.vectors / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and m:
                ids, x = batch.column(0), batch.column(1)
                each = pa.array(np.repeat(np.arange(len(ids)), m))
                columns = [
                    ids.take(each), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(ids))),
                    pa.array(model.centre.deviations(x), pa.int64()).take(each), pa.array((model.centre.centred(x) @ ways).ravel()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    told = rows.select("vec_id", "x").mapInArrow(run, "vec_id long, component int, deviation long, whitened double")
    shares = F.array(*[F.lit(float(v)) for v in model.explained]) if m else F.array(F.lit(0.0))
    return told.select(
        "vec_id", "component", F.lit(model.centre.n if model.centre else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("component") - 1).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )


def whiten(rows: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row for each usable row and component: see ``apply``.

    Rows whose vector is null, empty, or holds a null or a number that is not finite have no row and no part in the fit, and
    so have vectors of another length than most (the smaller of two equally common ones counts). All others count, equal
    rows and rows without an id too. Components in which the rows do not differ are left out, so equal rows, a single row
    and an empty table give no rows. Other columns are not looked at.
    """
    usable = whole_numbers(rows, vec_id, embedding)
    sizes = usable.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(1).collect()
    kept = written(usable.where(F.size("x") == (sizes[0]["size"] if sizes else 0)), "whole-numbers")
    return apply(kept, fit(kept, components))
