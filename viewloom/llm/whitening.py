"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers on a fixed grid, so that sums, means and squared deviations are exact. The
rows are written once; every step of the bidiagonalisation is one pass over them that multiplies the centred rows
X by a vector (Xv) and gathers what that gives through the rows (X'u), together with the inner products
for full reorthogonalisation. A left vector is as long as the table, so it is never stored: it is X times a
short vector, and a pass forms it again from that. Only sums of the length of a row reach the driver, where the small
bidiagonal matrix has its singular value decomposition.

Zero steps (repeated or vanishing singular values) go on with a new direction orthogonal to all earlier ones. The
bidiagonalisation runs until no variance is left, so no component is missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.session import cut_lineage

STEPS_PER_UNIT, OFFSET = 64, 1_000_000
#: Entries must be smaller than this many units: their grid numbers are then exact in double precision.
LARGEST = 2.0**53 / STEPS_PER_UNIT
#: A norm is taken for zero below this share of the norm of all rows; so are singular values.
ZERO = 1e-13
TASK_BYTES = 32 << 20
LOW_BITS = 26


def finite(vector: Column) -> Column:
    """Not null, all entries there and finite."""
    entries = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(entries, F.lit(False))


def grid_points(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, x) of the rows with a finite vector; an entry c becomes floor(64 c) + 1000000."""
    entries = F.col(vector).cast("array<double>")

    def point(c: Column) -> Column:
        number = F.floor(c * STEPS_PER_UNIT).cast("bigint") + OFFSET
        return F.when(F.abs(c) < LARGEST, number).otherwise(F.raise_error(F.lit("an entry is too large for the grid")).cast("bigint"))

    rows = df.select(F.col(key).cast("bigint").alias("key"), entries.alias("v")).where(finite(F.col("v")))
    return rows.select("key", F.transform("v", point).alias("x"))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, dimension)


def summed(points: DataFrame, part: Callable[[np.ndarray], np.ndarray], dimension: int, kind: str) -> np.ndarray:
    """The sum over all rows of what ``part`` returns for a block of them; ``kind`` is bigint or double."""
    arrow = pa.int64() if kind == "bigint" else pa.float64()

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = part(_matrix(batch.column("x"), dimension))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(arrow))], names=["sums"])

    parts = points.select("x").mapInArrow(sums, f"sums array<{kind}>")
    rows = parts.select(F.posexplode("sums").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(rows), np.int64 if kind == "bigint" else np.float64)
    for r in rows:
        out[r["at"]] = r["value"]
    return out


@dataclass
class Centre:
    """Exact sums of n rows: column i has the mean near[i] + rest[i] / n."""

    n: int
    near: np.ndarray
    rest: np.ndarray

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Centred rows; whole numbers are taken off before anything is rounded."""
        return (x - self.near) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """For every row the sum of (n x - S) squared, exactly; an error if that needs more than 64 bits."""
        estimate = float(self.n) * self.rows(x)
        if not len(x) or (estimate * estimate).sum(axis=1).max() < 2.0**61:
            scaled = self.n * (x - self.near) - self.rest
            return (scaled * scaled).sum(axis=1)
        scaled = self.n * (x - self.near).astype(object) - self.rest.astype(object)
        return np.array([int(v) for v in (scaled * scaled).sum(axis=1)], np.int64)


def centre_of(points: DataFrame, n: int, dimension: int) -> Centre:
    def halves(x: np.ndarray) -> np.ndarray:
        return np.concatenate(((x >> LOW_BITS).sum(axis=0), (x & ((1 << LOW_BITS) - 1)).sum(axis=0)))

    found = [int(v) for v in summed(points, halves, dimension, "bigint")]
    sums = [(high << LOW_BITS) + low for high, low in zip(found[:dimension], found[dimension:], strict=True)]
    near = [s // n for s in sums]
    return Centre(n, np.array(near, np.int64), np.array([s - n * m for s, m in zip(sums, near, strict=True)], np.int64))


def bidiagonalise(product: Callable, dimension: int, energy: float) -> tuple[np.ndarray, np.ndarray]:
    """(B, V): the upper bidiagonal matrix of X and its right vectors, one per column.

    ``product(left, w)`` returns U'p, p'p and X'p for p = Xw and U = X left; ``energy`` is the sum of squares of X.
    """
    random = np.random.default_rng(7)
    zero = ZERO * np.sqrt(energy)
    right, left, gathered = (np.zeros((dimension, 0)) for _ in range(3))
    diagonal: list[float] = []
    above: list[float] = []

    def fresh() -> np.ndarray:
        while True:
            v = random.standard_normal(dimension)
            for _ in range(2):
                v = v / np.linalg.norm(v)
                v = v - right @ (right.T @ v)
            if np.linalg.norm(v) > 0.01:
                return v / np.linalg.norm(v)

    v, beta, before = fresh(), 0.0, None
    while True:
        # Xv less its known part.
        w = v if before is None else v - beta * left[:, before]
        for _ in range(3):
            inner, square, z = product(left, w)
            w = w - left @ inner
            z = z - gathered @ inner
            kept = square - inner @ inner
            if kept > 0.5 * square or square <= zero * zero:
                break
        alpha = np.sqrt(max(kept, 0.0))
        right = np.column_stack((right, v))
        above.append(beta)
        if alpha <= zero:
            # Xv lies among the left vectors, so there is no new one.
            alpha, beta, w, z = 0.0, 0.0, np.zeros(dimension), np.zeros(dimension)
        else:
            w, z = w / alpha, z / alpha
        diagonal.append(alpha)
        left, gathered = np.column_stack((left, w)), np.column_stack((gathered, z))
        before = right.shape[1] - 1
        rest = energy - sum(a * a for a in diagonal) - sum(b * b for b in above)
        if right.shape[1] == dimension:
            break
        r = z - alpha * v if alpha else z
        for _ in range(2):
            r = r - right @ (right.T @ r)
        beta = float(np.linalg.norm(r))
        if beta <= zero:
            if rest <= 1e-14 * energy * dimension:
                break
            v, beta, before = fresh(), 0.0, None
        else:
            v = r / beta
    small = np.diag(diagonal) + np.diag(above[1:], 1)
    return small, right


def whiten(df: DataFrame, components: int = 32, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) for every finite vector and component.

    Rows whose vector is null or holds null or non-finite entries are dropped; a null key stays, repeated rows
    count each. Components are numbered from 1 by falling variance; those without variance (fewer different
    vectors or columns than components) are left out, so a table of one vector, of equal ones or of none has no rows.
    The largest entry of a component is positive. Vectors of each length are a population of their own. An
    entry of 2**53 / 64 or more, and a deviation beyond 64 bits, are errors. Other columns are not returned.
    """
    schema = f"{key} bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    points = cut_lineage(grid_points(df, key, vector))
    sizes = {r.d: r.n for r in points.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect() if r.d > 0}
    out = df.sparkSession.createDataFrame([], schema)
    for dimension, n in sorted(sizes.items()):
        out = out.union(_whitened(points.where(F.size("x") == dimension), n, dimension, components, key, schema))
    return out


def _whitened(points: DataFrame, n: int, dimension: int, components: int, key: str, schema: str) -> DataFrame:
    spark = points.sparkSession
    context = spark.sparkContext
    # Passes are many, so parts are as few as cores and memory ask for.
    parts = max(context.defaultParallelism, -(-8 * n * dimension // TASK_BYTES))
    points = cut_lineage(points.repartition(parts))
    centre = centre_of(points, n, dimension)
    energy = float(summed(points, lambda x: np.array([(centre.rows(x) ** 2).sum()]), dimension, "double")[0])
    if not energy:
        return spark.createDataFrame([], schema)

    def product(left: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        shared = context.broadcast((left, w))

        def part(x: np.ndarray) -> np.ndarray:
            others, own = shared.value
            rows = centre.rows(x)
            p = rows @ own
            return np.concatenate(((rows @ others).T @ p, [p @ p], rows.T @ p))

        found = summed(points, part, dimension, "double")
        shared.destroy()
        k = left.shape[1]
        return found[:k], float(found[k]), found[k + 1 :]

    small, right = bidiagonalise(product, dimension, energy)
    _, singular, turned = np.linalg.svd(small)
    there = int((singular > ZERO * np.sqrt(energy) * dimension).sum())
    kept = min(components, there)
    axes = right @ turned[:kept].T
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(kept)])
    variances = singular[:kept] ** 2 / n
    explained = variances / (energy / n)
    scaled = axes / np.sqrt(variances)

    mean = summed(points, lambda x: (centre.rows(x) @ scaled).sum(axis=0), dimension, "double") / n

    def squares(x: np.ndarray) -> np.ndarray:
        rows = centre.rows(x) @ scaled - mean
        return (rows.T @ rows).reshape(-1)

    covariance = summed(points, squares, dimension, "double").reshape(kept, kept) / n
    error = float(np.abs(covariance - np.eye(kept)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            x = _matrix(batch.column("x"), dimension)
            each = np.repeat(np.arange(rows), kept)
            columns = [
                batch.column("key").take(pa.array(each)),
                pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * kept, n, np.int64)),
                pa.array(centre.deviations(x)[each]),
                pa.array((centre.rows(x) @ scaled).reshape(-1)),
                pa.array(np.tile(explained, rows)),
                pa.array(np.full(rows * kept, error)),
            ]
            names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return points.mapInArrow(project, schema)
