"""Whitened embeddings by incremental eigendecomposition (operator 13).

The covariance matrix is never summed up. Each partition keeps the *spectrum* of its rows (count, exact sums, eigenvalues,
eigenvectors) and takes the rows in one after the other: a row centred on the mean so far changes the scatter by a
rank-one term ``v v'``, and the eigenvalues of ``D + z z'`` (``z`` is ``v`` in the eigenvectors so far) are the roots of
the secular equation ``1 + sum z_i^2 / (d_i - x) = 0``, one between each two neighbours of ``D``. Entries with a tiny ``z_i``
and groups of equal ``d_i`` are deflated: they keep their eigenvalue. Equal rows of an Arrow batch are one update
of their weight. Two spectra are joined in the same way: each eigenvector of the smaller one, times the root of
its eigenvalue, is a rank-one update of the larger one, and so is the distance of their means. Spectra of partitions are
joined in groups of ``FAN_IN``, round after round, so a task holds a few matrices of dimension x dimension.

One more pass over all rows refines the result: by Rayleigh-Ritz the rows are projected on all eigenvectors found, the small
matrix of their exactly centred products is added up, and its eigenvectors turn the basis. As the basis is complete and
the matrix almost diagonal, this gives the eigenvectors to working precision, whatever the updates lost.

Sums are exact integers, and rows are centred by ``x - S/n`` from quotient and remainder, so the common offset costs no
digits. The driver sees one row per dimension or matrix only; rows stay in their partitions.

Defined cases: vectors that are NULL or hold NULL or non-finite entries, or entries whose integer needs more than 52 bits,
take no part. Vectors of different length count as padded with zeros. Repeated rows, and rows with equal or NULL ids,
count and are returned each. ``deviation`` is NULL where it exceeds 64 bits. Where the covariance has fewer positive
eigenvalues than components asked for, only those are returned; where it has none (one row, all rows equal), no row is.
Further columns, whatever their names, are not read. Of equal eigenvalues any rotation is right; the one found is the same
for all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.llm.common import keep, only

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
FAN_IN = 16
FLAT = 1e-13  # eigenvalues below this share of the trace count as zero
DEFLATED = 1e-15  # entries below this share of the largest value take no part in an update
ROUNDING = 2e-15  # a secular function this small against its terms is zero
LARGEST = 2.0**52
SPECTRUM = "n long, sums array<string>, values array<double>, vectors array<double>"
ROWS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def integers(embedding: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> Column:
    """floor(scale * entry) + offset; NULL where the vector takes no part."""
    odd = F.exists(embedding, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) >= LARGEST / scale))
    whole = F.transform(embedding, lambda c: F.floor(c.cast("double") * scale) + offset)
    return F.when(F.col(embedding).isNotNull() & ~odd, whole)


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum z2_i / (d_i - x) for ascending, distinct ``d`` and positive ``z2``.

    Returned as the index of the nearest pole below or above and the distance from it, which keeps differences exact.
    Each step replaces the two sides of the sum by simple fractions that agree in value and slope, and falls back to
    halving where that leaves the bracket.
    """
    n = len(d)
    total = z2.sum()
    if n == 1:
        return np.zeros(1, int), np.array([total])
    above = np.append(d[1:], d[-1] + total)
    width = above - d
    apart = d[:, None] - d[None, :]  # [i, j] = d_i - d_j
    middle = 1 + (z2[:, None] / (apart - (width / 2)[None, :])).sum(axis=0)
    nearer_above = (middle < 0) & (np.arange(n) < n - 1)
    origin = np.arange(n) + nearer_above
    poles = d[:, None] - d[origin][None, :]  # [i, j]: pole i as seen from the origin of root j
    low = np.where(nearer_above, -width / 2, np.where(middle < 0, width / 2, 0.0))
    high = np.where(nearer_above, 0.0, np.where(middle < 0, width, width / 2))
    at = (low + high) / 2
    below = np.arange(n)[:, None] <= np.arange(n)[None, :]
    left, right = d - d[origin], above - d[origin]
    for _ in range(60):
        gap = poles - at[None, :]
        part = z2[:, None] / gap
        value = 1 + part.sum(axis=0)
        done = np.abs(value) <= ROUNDING * (1 + np.abs(part).sum(axis=0))
        if done.all():
            break
        slopes = part / gap
        psi = np.where(below, slopes, 0).sum(axis=0)
        phi = slopes.sum(axis=0) - psi
        low, high = np.where(value < 0, at, low), np.where(value < 0, high, at)
        x, y = left - at, right - at
        a, b, c = (x + y) * value - x * y * (psi + phi), x * y * value, value - x * psi - y * phi
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = x[-1] + x[-1] ** 2 * psi[-1] / c[-1]  # no pole above the last root
        new = at + step
        at = np.where(done, at, np.where((new > low) & (new < high), new, (low + high) / 2))
    return origin, at


@dataclass
class Spectrum:
    """Rows taken in so far: how many, their exact sums, and the eigenvalues and eigenvectors of their scatter."""

    n: int
    sums: np.ndarray  # of unbounded integers
    values: np.ndarray  # ascending
    vectors: np.ndarray  # a column each

    @classmethod
    def empty(cls, width: int) -> Spectrum:
        return cls(0, np.zeros(width, object), np.zeros(width), np.eye(width))

    @classmethod
    def of(cls, row: dict) -> Spectrum:
        values = np.array(row["values"], float)
        return cls(row["n"], np.array([int(s) for s in row["sums"]], object), values, np.array(row["vectors"], float).reshape(len(values), len(values)))

    def row(self) -> dict:
        return {"n": self.n, "sums": [str(s) for s in self.sums], "values": self.values.tolist(), "vectors": self.vectors.ravel().tolist()}

    def widened(self, width: int) -> Spectrum:
        """The same rows padded with zeros, which are integers ``OFFSET``."""
        old = len(self.values)
        if width == old:
            return self
        more = width - old
        vectors = np.zeros((width, width))
        vectors[:old, more:], vectors[old:, :more] = self.vectors, np.eye(more)
        sums = np.append(self.sums, np.full(more, OFFSET * self.n, object))
        return Spectrum(self.n, sums, np.append(np.zeros(more), self.values), vectors)

    def from_mean(self, point: np.ndarray) -> np.ndarray:
        """``point`` (integers) less the mean, without losing digits to a common offset."""
        if not self.n:
            return np.zeros(len(point))
        whole = self.sums // self.n
        return (point - whole.astype(np.int64)) - ((self.sums - whole * self.n) / self.n).astype(float)

    def update(self, v: np.ndarray) -> None:
        """Add ``v v'`` to the scatter."""
        z = v @ self.vectors
        size = float(z @ z)
        if size == 0.0:
            return
        d, q = self.values, self.vectors
        floor = DEFLATED * max(d[-1], size)
        # Groups of equal eigenvalues: a reflection moves all of z into their last vector.
        starts = np.flatnonzero(np.append(True, np.diff(d) > 8 * floor))
        if len(starts) < len(d):
            for start, end in zip(starts, np.append(starts[1:], len(d))):
                if end - start > 1 and (norm := np.linalg.norm(z[start:end])) > 0:
                    w = z[start:end].copy()
                    norm = norm if w[-1] >= 0 else -norm
                    w[-1] += norm
                    w /= np.linalg.norm(w)
                    block = q[:, start:end]
                    q[:, start:end] = block - 2 * np.outer(block @ w, w)
                    z[start:end] = 0
                    z[end - 1] = -norm
        live = np.flatnonzero(np.abs(z) * np.sqrt(size) > floor)
        if not len(live):
            return
        dl, zl = d[live], z[live]
        origin, at = secular_roots(dl, zl * zl)
        gap = (dl[:, None] - dl[origin][None, :]) - at[None, :]  # [i, j] = d_i - root_j
        # The z for which these roots are exact gives orthogonal vectors even where roots lie close together.
        others = dl[:, None] - dl[None, :]
        np.fill_diagonal(others, -1.0)
        exact = np.sqrt(np.abs(np.prod(gap / others, axis=1)))
        turned = np.copysign(exact, zl)[:, None] / gap
        turned /= np.linalg.norm(turned, axis=0)
        values = d.copy()
        values[live] = dl[origin] + at
        q[:, live] = q[:, live] @ turned
        order = np.argsort(values, kind="stable")
        self.values, self.vectors = values[order], q[:, order]

    def add(self, point: np.ndarray, weight: int = 1) -> None:
        """Take in ``weight`` equal rows."""
        self.update(self.from_mean(point) * np.sqrt(weight * self.n / (self.n + weight)))
        self.n += weight
        self.sums = self.sums + point.astype(object) * weight

    def join(self, other: Spectrum) -> Spectrum:
        """The spectrum of the rows of both."""
        width = max(len(self.values), len(other.values))
        few, many = sorted((self.widened(width), other.widened(width)), key=lambda s: s.n)
        if few.n:
            for value, vector in zip(few.values, few.vectors.T):
                if value > 0:
                    many.update(np.sqrt(value) * vector)
            n, m = many.n, few.n
            apart = (few.sums * n - many.sums * m) / (n * m)  # of the means, from exact integers
            many.update(apart.astype(float) * np.sqrt(n * m / (n + m)))
            many.n, many.sums = n + m, many.sums + few.sums
        return many


def _matrices(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with their integer vectors as a matrix; shorter ones are padded."""
    for batch in batches:
        column = batch[name]
        sizes = np.diff(column.offsets.to_numpy())
        flat = column.flatten().to_numpy(zero_copy_only=False)
        width = int(sizes.max(initial=0))
        if np.all(sizes == width):
            yield batch, flat.reshape(len(sizes), width)
            continue
        out = np.full((len(sizes), width), OFFSET, np.int64)
        out[np.arange(width) < sizes[:, None]] = flat
        yield batch, out


def _widened(points: np.ndarray, width: int) -> np.ndarray:
    more = width - points.shape[1]
    return np.pad(points, ((0, 0), (0, more)), constant_values=OFFSET) if more else points


SPECTRUM_ROWS = pa.schema([
    ("n", pa.int64()), ("sums", pa.list_(pa.string())), ("values", pa.list_(pa.float64())), ("vectors", pa.list_(pa.float64())),
])


def _spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spectrum of a partition."""
    state = None
    for _, points in _matrices(batches, "x"):
        distinct, counts = np.unique(points, axis=0, return_counts=True) if len(points) else (points, [])
        width = max(points.shape[1], len(state.values) if state else 0)
        state = state.widened(width) if state else Spectrum.empty(width)
        for point, count in zip(_widened(distinct, width), counts):
            state.add(point, int(count))
    if state and state.n:
        yield pa.RecordBatch.from_pylist([state.row()], SPECTRUM_ROWS)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spectrum of all spectra of a partition."""
    state = None
    for batch in batches:
        for row in batch.to_pylist():
            state = state.join(Spectrum.of(row)) if state else Spectrum.of(row)
    if state:
        yield pa.RecordBatch.from_pylist([state.row()], SPECTRUM_ROWS)


def _folded(parts: DataFrame, join: Callable, schema: str, label: str) -> DataFrame:
    """Join rows in groups of about ``FAN_IN`` until one is left; each round is a written table."""
    parts = keep(parts, label)
    while (n := parts.count()) > 1:
        groups = -(-n // FAN_IN)
        parts = keep(parts.repartition(groups).mapInArrow(join, schema), label)
    return parts


def fitted_spectrum(rows: DataFrame) -> Spectrum | None:
    """The spectrum of column ``x`` of all rows; None without rows. One row of dimension x dimension reaches the driver."""
    found = _folded(rows.select("x").mapInArrow(_spectra, SPECTRUM), _joined, SPECTRUM, "spectra").collect()
    return Spectrum.of(found[0].asDict()) if found else None


class Centre:
    """Exact sums of n rows, and rows as deviations from their mean."""

    def __init__(self, n: int, sums: np.ndarray):
        self.n, self.sums, self.width = n, sums, len(sums)
        whole = sums // n
        self.remainders = sums - whole * n
        self.quotients, self.rests = whole.astype(np.int64), (self.remainders / n).astype(float)

    def deviations(self, points: np.ndarray) -> np.ndarray:
        return (_widened(points, self.width) - self.quotients) - self.rests

    def squared(self, points: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n*x - S)^2; None beyond 64 bits."""
        near = _widened(points, self.width) - self.quotients  # n*x - S = n*near - remainder
        most = float(np.abs(near).max(initial=0))
        if self.width * most * max(most, self.n) >= 2.0**62 or self.n >= 2**62:
            near = near.astype(object)
        rest = self.remainders.astype(near.dtype)
        squares, mixed = (near * near).sum(axis=1).astype(object), (near * rest).sum(axis=1).astype(object)
        total = squares * self.n**2 - mixed * (2 * self.n) + int((self.remainders * self.remainders).sum())
        return [int(s) if s < 2**63 else None for s in total]


PRODUCTS = "products array<double>"
PRODUCT_ROWS = pa.schema([("products", pa.list_(pa.float64()))])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for row in batch["products"].to_pylist():
            total = np.array(row) + (0 if total is None else total)
    if total is not None:
        yield pa.RecordBatch.from_pylist([{"products": total.tolist()}], PRODUCT_ROWS)


def products(rows: DataFrame, centre: Centre, basis: np.ndarray) -> np.ndarray:
    """Sum over all rows of y y', y the centred row in the columns of ``basis``."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((basis.shape[1], basis.shape[1]))
        for _, points in _matrices(batches, "x"):
            y = centre.deviations(points) @ basis
            total += y.T @ y
        yield pa.RecordBatch.from_pylist([{"products": total.ravel().tolist()}], PRODUCT_ROWS)

    found = _folded(rows.select("x").mapInArrow(multiply, PRODUCTS), _added, PRODUCTS, "products").collect()
    return np.array(found[0]["products"]).reshape(basis.shape[1], -1)


@dataclass(frozen=True)
class Whitening:
    """Components by falling eigenvalue, and the centre they hold for."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray  # a column each
    trace: float
    identity_error: float

    def project(self, points: np.ndarray) -> np.ndarray:
        return self.centre.deviations(points) @ self.vectors / np.sqrt(self.values)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on column ``x`` (integer vectors) of all rows; None where no direction has any variance."""
    spectrum = fitted_spectrum(rows)
    if spectrum is None or not len(spectrum.sums):
        return None
    centre = Centre(spectrum.n, spectrum.sums)
    basis, _ = np.linalg.qr(spectrum.vectors[:, ::-1])  # orthogonal to the last digit
    small = products(rows, centre, basis) / centre.n
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    trace = float(np.trace(small))
    used = int((values[:components] > FLAT * trace).sum()) if trace > 0 else 0
    if not used:
        return None
    vectors = basis @ turn[:, :used]
    vectors /= np.linalg.norm(vectors, axis=0)
    scaled = vectors / np.sqrt(values[:used])
    error = float(np.abs(products(rows, centre, scaled) / centre.n - np.eye(used)).max())
    return Whitening(centre, values[:used], vectors, trace, error)


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each vector that takes part and each component: see ``ROWS``."""
    rows = only(vectors, "vec_id", "embedding").select(F.col("vec_id").cast("long"), integers().alias("x")).filter("x is not null")
    model = fit(rows, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], ROWS)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, names = len(model.values), [field.split()[0] for field in ROWS.split(", ")]
        explained = model.values / model.trace
        for batch, points in _matrices(batches, "x"):
            n = len(points)
            row = pa.array(np.repeat(np.arange(n), used))
            yield pa.RecordBatch.from_arrays([
                batch["vec_id"].take(row), pa.array(np.tile(np.arange(1, used + 1, dtype=np.int32), n)),
                pa.array(np.full(n * used, model.centre.n, np.int64)), pa.array(model.centre.squared(points), pa.int64()).take(row),
                pa.array(model.project(points).ravel()), pa.array(np.tile(explained, n)),
                pa.array(np.full(n * used, model.identity_error)),
            ], names)

    return rows.mapInArrow(project, ROWS)
