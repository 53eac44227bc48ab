"""Whitening of embeddings with eigenvectors refined beyond the precision they were found in.

The covariance is summed by the tasks over the distinct vectors, in whole numbers and
so exactly. Its eigenvectors are found once in single precision. From there, each step
of the iteration of Ogita and Aishima takes a few products of matrices in extended
precision and squares the error. Eigenvalues too close for a step to tell apart are
gathered into clusters: their vectors are first made orthonormal, and a small problem
of the cluster's own, with its mean eigenvalue taken off, turns them inside the space
that they span.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pavilion.llm import workers
from pavilion.llm.storage import stored
from pavilion.llm.vectors import matrix, scaled, usable

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
# Vectors of a task that are multiplied at once.
_ROWS = 4096
_EXACT = 1 << 53
# Entries beyond this would not fit a long after scaling.
_LARGEST = float(1 << 52)

_WIDE = T.DecimalType(38, 0)


# ---- eigenvectors -----------------------------------------------------------


def _clusters(values: np.ndarray, near: float) -> list[np.ndarray]:
    """Places of eigenvalues (in falling order) that follow each other at less than ``near``."""
    breaks = np.flatnonzero(values[:-1] - values[1:] > near) + 1
    return [c for c in np.split(np.arange(len(values)), breaks) if len(c) > 1]


def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One correction of approximate eigenvectors ``x``: the next ones, their values, and how near is too near."""
    n = len(a)
    one = np.eye(n, dtype=x.dtype)
    r = one - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    near = float(2 * (np.sqrt((off * off).sum()) + np.abs(a).sum(axis=1).max() * np.sqrt((r * r).sum())))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > near
    change = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + x @ change, values, near


def _sorted(x: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-values, kind="stable")
    return x[:, order], values[order]


def refined(a: np.ndarray, x: np.ndarray, steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvectors and falling eigenvalues of the symmetric ``a``, from approximate vectors ``x``.

    Works in the precision of ``a``. After each step, clusters are solved apart: the
    matrix in the cluster's basis, less the mean of its values, has the small
    differences as its largest entries, so double precision finds their directions.
    """
    kind = a.dtype
    x = x.astype(kind)
    size = float(np.abs(a).sum(axis=1).max()) or 1.0
    limit = float(np.finfo(kind).eps) * len(a)
    turned: set[tuple] = set()
    for _ in range(steps):
        x, values, near = _step(a, x)
        x, values = _sorted(x, values)
        clusters = _clusters(values, near)
        for c in clusters:
            basis = x[:, c]
            small = basis.T @ (a @ basis) - values[c].mean() * (basis.T @ basis)
            spread = float(np.abs(small).max())
            if spread <= limit * size:
                continue  # equal values: any basis of the space serves
            _, turn = np.linalg.eigh(((small + small.T) / (2 * spread)).astype(np.float64))
            x[:, c] = basis @ turn[:, ::-1].astype(kind)
            turned.add(tuple(c))
        if near <= 8 * limit * size and not clusters:
            break
    r = np.eye(len(a), dtype=kind) - x.T @ x
    x = x + x @ (r / 2)
    return _sorted(x, np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x))


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit eigenvectors (columns) and eigenvalues of the symmetric ``a`` by falling value.

    Found in single precision, refined in that of ``a``. The entry of a vector that is
    largest in size, the first of equals, is positive.
    """
    if not len(a):
        return a, np.diag(a)
    _, rough = np.linalg.eigh((a / (np.abs(a).max() or 1)).astype(np.float32))
    x, values = refined(a, rough[:, ::-1])
    x = x / np.sqrt((x * x).sum(axis=0))
    return x * np.where(x[np.abs(x).argmax(axis=0), range(len(a))] < 0, -1, 1), values


# ---- distributed sums -------------------------------------------------------


def _slices(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[np.ndarray]:
    for batch in batches:
        whole = matrix(batch["x"], dimensions)
        for at in range(0, len(whole), _ROWS):
            yield whole[at : at + _ROWS]


def _exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` of whole numbers, exactly; in floating point where that is exact."""
    most = int(max(np.abs(a).max(initial=0), 1)) * int(max(np.abs(b).max(initial=0), 1)) * max(len(a), 1)
    if most < _EXACT:
        return (a.astype(np.float64).T @ b.astype(np.float64)).astype(np.int64).astype(object)
    return a.astype(object).T @ b.astype(object)


def _sums(dimensions: int) -> Callable:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = 0, np.zeros(dimensions, dtype=object)
        for x in _slices(batches, dimensions):
            rows += len(x)
            total = total + _exact_product(np.ones((len(x), 1), dtype=np.int64), x)[0]
        told = [Decimal(rows), *map(Decimal, map(int, total))]
        yield workers.batch(i=pa.array(range(dimensions + 1), pa.int32()), total=pa.array(told, pa.decimal128(38, 0)))

    return sums


def _products(dimensions: int, middle: np.ndarray) -> Callable:
    first, second = np.triu_indices(dimensions)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimensions, dimensions), dtype=object)
        for x in _slices(batches, dimensions):
            y = x - middle
            total = total + _exact_product(y, y)
        told = [Decimal(int(t)) for t in total[first, second]]
        yield workers.batch(
            i=pa.array(first, pa.int32()), j=pa.array(second, pa.int32()), total=pa.array(told, pa.decimal128(38, 0))
        )

    return products


def _whitened_products(dimensions: int, white: Callable, kept: int) -> Callable:
    first, second = np.triu_indices(kept + 1)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((kept + 1, kept + 1))
        for x in _slices(batches, dimensions):
            z = np.column_stack([np.ones(len(x)), white(x)])
            total += z.T @ z
        yield workers.batch(i=pa.array(first, pa.int32()), j=pa.array(second, pa.int32()), total=total[first, second])

    return products


class Model:
    """What whitening needs: ``n``, the sums ``s``, components and their variances.

    ``middle`` are the means rounded to whole numbers and ``rest`` is ``s - n * middle``,
    so that ``n * x - s`` equals ``n * (x - middle) - rest`` without large products.
    """

    def __init__(self, n: int, s: list[int], products: np.ndarray, components: int):
        self.n, self.s = n, s
        self.middle = _middle(n, s)
        self.rest = [t - n * m for t, m in zip(s, self.middle.tolist(), strict=True)]
        d = len(s)
        # n * n times the covariance, in whole numbers of any size.
        scaled_up = [[n * int(products[i, j]) - self.rest[i] * self.rest[j] for j in range(d)] for i in range(d)]
        wide = np.array([[np.longdouble(str(v)) for v in row] for row in scaled_up], dtype=np.longdouble).reshape(d, d)
        covariance = wide / (np.longdouble(n) * np.longdouble(n))
        vectors, values = eigenvectors(covariance)
        trace = np.trace(covariance) if d else np.longdouble(0)
        self.kept = min(components, d)
        values = values[: self.kept]
        # What rounding leaves of a variance of zero is none.
        self.has_variance = values > trace * d * 16 * np.finfo(np.longdouble).eps
        self.explained = [float(v / trace) if trace > 0 else None for v in np.where(self.has_variance, values, 0)]
        scale = np.where(self.has_variance, 1 / np.sqrt(np.where(self.has_variance, values, 1)), 0)
        self.components = vectors[:, : self.kept].astype(np.float64)
        self.directions = (vectors[:, : self.kept] * scale).astype(np.float64)

    def white(self) -> Callable[[np.ndarray], np.ndarray]:
        """Function from whole-number vectors to whitened ones."""
        middle, directions = self.middle, self.directions
        share = np.array([r / self.n for r in self.rest])
        return lambda x: ((x - middle) - share) @ directions


def _middle(n: int, s: list[int]) -> np.ndarray:
    return np.array([(2 * t + n) // (2 * n) for t in s], dtype=np.int64)


def _whiten(dimensions: int, white: Callable, kept: int, has_variance: np.ndarray) -> Callable:
    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                z = white(matrix(part["x"], dimensions))
                flat = pa.array(z.ravel(), pa.float64(), mask=np.tile(~has_variance, len(z)))
                ends = pa.array(np.arange(len(z) + 1, dtype=np.int32) * kept)
                others = {n: part[n] for n in part.schema.names if n != "x"}
                yield workers.batch(**others, z=pa.ListArray.from_arrays(ends, flat))

    return whiten


def whitened(
    rows: DataFrame,
    vector_column: str = "embedding",
    id_column: str = "vec_id",
    components: int = COMPONENTS,
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """Whitened coordinates of every usable vector, one row per vector and component.

    Entries become whole numbers, ``floor(scale * c) + shift``. The covariance is that
    of the distinct whole-number vectors (the fit list), with their number ``n`` as
    divisor. Returns the id under its own name, ``component`` (from 1, by falling
    variance), ``n``, ``deviation`` (sum of ``(n * x - s) ** 2``, exact, as decimal),
    ``whitened``, ``explained`` (share of the whole variance) and ``identity_error``
    (largest entry of the fit list's whitened covariance less the identity).

    Null vectors, vectors with a null, infinite or other non-number entry, or one beyond
    2^52 after scaling, are left out. So are, of vectors of several lengths, all but
    those of the most frequent one (of equals, the longest). Repeated rows and null ids
    stay rows of their own. A component without variance has a null ``whitened`` and
    explains 0 (null if no component has any). Without usable vectors there are no rows.
    Other columns play no part, whatever their names.
    """
    names = [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"the id column cannot be called {id_column}")
    vector = F.col(vector_column)
    small = F.forall(vector, lambda c: F.abs(c.cast("double")) < _LARGEST / scale)
    x = rows.where(usable(vector)).where(small & (F.size(vector) > 0))
    x = x.select(F.col(id_column).alias("id"), scaled(vector, scale, shift).alias("x"))
    id_type = x.schema["id"].dataType
    fields = [T.StructField(n, t) for n, t in zip(names, [id_type, T.IntegerType(), T.LongType(), _WIDE, *[T.DoubleType()] * 3], strict=True)]
    common = x.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("d")).first()
    if common is None:
        return rows.sparkSession.createDataFrame([], T.StructType(fields))
    d = common.d
    x = x.where(F.size("x") == d)
    fit = stored(x.select("x").distinct(), "fit-list")
    s = {r.i: int(r.total) for r in workers.mapped(fit, _sums(d), "i int, total decimal(38,0)").groupBy("i").agg(F.sum("total").cast(_WIDE).alias("total")).collect()}
    n, s = s[0], [s[i + 1] for i in range(d)]
    products = np.zeros((d, d), dtype=object)
    parts = workers.mapped(fit, _products(d, _middle(n, s)), "i int, j int, total decimal(38,0)")
    # One row per pair of dimensions, whatever the number of vectors.
    for r in parts.groupBy("i", "j").agg(F.sum("total").cast(_WIDE).alias("total")).collect():
        products[r.i, r.j] = products[r.j, r.i] = int(r.total)
    model = Model(n, s, products, components)
    white, kept = model.white(), model.kept
    parts = workers.mapped(fit, _whitened_products(d, white, kept), "i int, j int, total double")
    moments = np.zeros((kept + 1, kept + 1))
    for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        moments[r.i, r.j] = moments[r.j, r.i] = r.total
    mean = moments[0, 1:] / n
    off = moments[1:, 1:] / n - np.outer(mean, mean) - np.diag(model.has_variance.astype(float))
    error = float(np.abs(off).max())

    y = F.zip_with("x", F.array(*[F.lit(m) for m in model.middle.tolist()]), lambda a, m: a - m)
    rest = F.array(*[F.lit(r) for r in model.rest])
    wide = lambda v: F.lit(Decimal(v)).cast(_WIDE)
    total = lambda terms: F.aggregate(terms, F.lit(0).cast(_WIDE), lambda t, v: (t + v).cast(_WIDE))
    square = lambda v: (v.cast("decimal(19,0)") * v.cast("decimal(19,0)")).cast(_WIDE)
    product = lambda a, b: (a.cast("decimal(19,0)") * b.cast("decimal(19,0)")).cast(_WIDE)
    deviation = (
        (total(F.transform("y", square)) * wide(n * n)).cast(_WIDE)
        - (total(F.zip_with("y", rest, product)) * wide(2 * n)).cast(_WIDE)
        + wide(sum(r * r for r in model.rest))
    ).cast(_WIDE)
    told = x.withColumn("y", y).select("id", "x", deviation.alias("deviation"))
    schema = T.StructType([told.schema["id"], told.schema["deviation"], T.StructField("z", T.ArrayType(T.DoubleType()))])
    out = workers.mapped(told, _whiten(d, white, kept, model.has_variance), schema)
    shares = F.array(*[F.lit(e).cast("double") for e in model.explained])
    out = out.withColumn("share", shares).select("id", "deviation", "share", F.posexplode("z").alias("at", "white"))
    return out.select(
        F.col("id").alias(names[0]),
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.col("white").alias("whitened"),
        F.get("share", "at").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
