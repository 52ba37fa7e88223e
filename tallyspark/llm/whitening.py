"""Embedding whitening from bit-sliced cross-products.

Vectors become whole numbers, ``floor(64 * c) + 1000000``, shifted by the
smallest value of their dimension.  Inside a task the shifted numbers of up to
``CHUNK`` rows are cut into bit planes, one bit a row, packed into 64-bit
words; the cross-product of two dimensions is the sum over their planes of
``2^(a + b) * popcount(plane_a AND plane_b)``.  Tasks emit exact partial sums,
one row per pair of dimensions, which Spark adds up.  The scatter is centred
in whole numbers (``n * sum(xy) - sum(x) * sum(y)``) before anything becomes a
double, so the covariance is rounded once.

The driver receives d * (d + 1) / 2 sums for vectors of d entries, whatever
the number of rows; rows never leave their partition.

Edge cases: rows whose vector is NULL, empty, or holds a NULL, NaN or infinite
entry are dropped; so are vectors of another length than the commonest one
(the longer one on a tie).  A NULL id is kept, and repeated rows count as often
as they occur.  Entries so large that x leaves a long saturate.  Where the
eigenvalue is zero to double precision (constant or dependent dimensions, one
row) ``whitened`` is NULL and the component is left out of ``identity_error``,
which is 0 when no component is left; ``explained`` is then 0, also when every vector is the
same.  A ``deviation`` beyond a long is NULL.  An empty table gives an empty
result.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyspark.llm.common import table

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
CHUNK = 1 << 16          # rows packed at once
PLANE_BITS = 1 << 28     # bits of all planes packed at once
LIMB = 1 << 48           # exact sums travel as two decimals
LONG = (1 << 63) - 1
EXACT = pa.decimal128(38, 0)


def finite(vector: Column) -> Column:
    """The vector is there and each of its entries is a number."""
    good = F.forall(vector, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))  # NaN is above infinity
    return vector.isNotNull() & (F.size(vector) > 0) & good


def usable(rows: DataFrame, vector: str, row_id: str) -> tuple[DataFrame, int]:
    """(id, v) of the vectors that take part, and their length; 0 if there is none."""
    rows = rows.select(F.col(row_id).alias("id"), F.col(vector).cast("array<double>").alias("v")).where(finite(F.col("v")))
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return (rows.where(F.size("v") == most["d"]), most["d"]) if most else (rows, 0)


def whole(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """x of every row, as int64."""
    v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    edge = float(1 << 62) * 1.9
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * v), -edge, edge).astype(np.int64) + SHIFT


def exact_sum(x: np.ndarray) -> list[int]:
    """Column sums as Python integers."""
    if len(x) and max(abs(int(x.max())), abs(int(x.min()))) > LONG // len(x):
        x = x.astype(object)
    return [int(s) for s in x.sum(0)]


def limbs(values: list[int]) -> list[pa.Array]:
    from decimal import Decimal

    high, low = zip(*[divmod(v, LIMB) for v in values])
    return [pa.array([Decimal(v) for v in part], EXACT) for part in (high, low)]


def bounds(rows: DataFrame, d: int) -> tuple[int, list[int], list[int], list[int]]:
    """n, and by dimension the sum, smallest and largest x."""
    def run(batches):
        n, total, low, high = 0, [0] * d, np.full(d, LONG), np.full(d, -LONG)
        for batch in batches:
            if batch.num_rows:
                x = whole(batch, d)
                n += len(x)
                total = [a + b for a, b in zip(total, exact_sum(x))]
                low, high = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), *limbs(total), pa.array(low), pa.array(high)],
                                             ["dim", "n", "high", "low", "least", "most"])

    parts = rows.select("v").mapInArrow(run, "dim int, n long, high decimal(38,0), low decimal(38,0), least long, most long")
    per = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"), F.min("least").alias("least"), F.max("most").alias("most"))
    found = sorted(per.collect())
    return found[0].n, [int(r.high) * LIMB + int(r.low) for r in found], [r.least for r in found], [r.most for r in found]


def planes(y: np.ndarray, bits: list[int]) -> tuple[np.ndarray, list[int]]:
    """Bit planes (dimension, then bit) of unsigned rows as words of 64 rows, and the bit of every plane."""
    rows, d = y.shape
    y = np.pad(y, ((0, -rows % 64), (0, 0)))
    by_bit = []
    for b in range(max(bits)):
        packed = np.packbits((y >> np.uint64(b)).astype(np.uint8) & 1, axis=0)
        by_bit.append(np.ascontiguousarray(packed.T).view(np.uint64))
    return np.stack([by_bit[b][i] for i in range(d) for b in range(bits[i])]), [b for i in range(d) for b in range(bits[i])]


def products(y: np.ndarray, bits: list[int]) -> np.ndarray:
    """Exact sums over rows of y_i * y_j for i <= j, from AND-popcounts of the planes; zero below the diagonal."""
    d = y.shape[1]
    out = np.zeros((d, d), object)
    live = [i for i in range(d) if bits[i]]
    if not live:
        return out
    word, bit = planes(y[:, live], [bits[i] for i in live])
    starts = np.concatenate([[0], np.cumsum([bits[i] for i in live])[:-1]])
    kind = np.int64 if 2 * max(bits) + len(y).bit_length() + 8 < 63 else object
    weight = np.array([1 << b for b in bit], kind)
    ends = [*starts[1:], len(bit)]
    for k, i in enumerate(live):
        row = np.zeros(len(live) - k, kind)
        for p in range(starts[k], ends[k]):
            common = np.bitwise_count(word[p] & word[starts[k]:]).sum(1, dtype=np.int64)
            row = row + weight[p] * np.add.reduceat(common.astype(kind) * weight[starts[k]:], starts[k:] - starts[k])
        for j, value in zip(live[k:], row):
            out[i, j] = int(value)
    return out


def scatter(rows: DataFrame, d: int, least: list[int], most: list[int]) -> np.ndarray:
    """Sums over all rows of (x_i - least_i) * (x_j - least_j), as Python integers."""
    bits = [(b - a).bit_length() for a, b in zip(least, most)]
    low = np.array(least, np.int64).view(np.uint64)
    chunk = min(CHUNK, max(64, PLANE_BITS // max(sum(bits), 1) // 64 * 64))

    def run(batches):
        held, waiting, total, seen = [], 0, np.zeros((d, d), object), False
        for batch in batches:
            y = whole(batch, d).view(np.uint64) - low
            held.append(y)
            waiting += len(y)
            while waiting >= chunk:
                y = np.concatenate(held)
                total, seen = total + products(y[:chunk], bits), True
                held, waiting = [y[chunk:]], len(y) - chunk
        if waiting:
            total, seen = total + products(np.concatenate(held), bits), True
        if seen:
            i, j = np.triu_indices(d)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *limbs([int(v) for v in total[i, j]])], ["i", "j", "high", "low"])

    parts = rows.select("v").mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0)")
    out = np.zeros((d, d), object)
    for r in parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).toLocalIterator():
        out[r.i, r.j] = out[r.j, r.i] = int(r.high) * LIMB + int(r.low)
    return out


class Whitening:
    """Fitted on all rows: n, exact sums, eigenvalues and unit eigenvectors (columns) by falling eigenvalue."""

    def __init__(self, n: int, total: list[int], least: list[int], most: list[int], products: np.ndarray, components: int):
        d = len(total)
        shifted = [s - n * a for s, a in zip(total, least)]
        cov = np.array([[(n * products[i, j] - shifted[i] * shifted[j]) / (n * n) for j in range(d)] for i in range(d)], float)
        value, vector = np.linalg.eigh(cov)
        order = np.argsort(-value, kind="stable")[:components]
        self.n, self.total, self.values, self.vectors = n, total, value[order], vector[:, order]
        self.explained = self.values / np.trace(cov) if np.trace(cov) > 0 else np.zeros(len(order))
        self.live = self.values > d * np.finfo(float).eps * max(value[-1], 0.0)
        self.explained[~self.live] = 0.0
        far = [max(n * b - s, s - n * a) for s, a, b in zip(total, least, most)]
        # within a long, every step of a row's deviation is
        self.narrow = sum(f * f for f in far) <= LONG and max(n * max(abs(a), abs(b)) for a, b in zip(least, most)) <= LONG

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        return self.n * x - np.array(self.total, np.int64) if self.narrow else self.n * x.astype(object) - np.array(self.total, object)

    def project(self, centred: np.ndarray) -> np.ndarray:
        """One column per component; those without an eigenvalue hold 0."""
        root = np.sqrt(np.where(self.live, self.values, 1.0))
        return (centred / self.n).astype(float) @ (self.vectors * (self.live / root))


def fit(rows: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    n, total, least, most = bounds(rows, d)
    return Whitening(n, total, least, most, scatter(rows, d, least, most), min(components, d))


def identity_error(rows: DataFrame, d: int, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity, measured over all rows."""
    k = len(model.values)

    def run(batches):
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = model.project(model.centred(whole(batch, d)))
            total[:k] += w.T @ w
            total[k] += w.sum(0)
        i, j = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], ["i", "j", "s"])

    total = np.zeros((k + 1, k))
    for r in rows.select("v").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():  # (k + 1) * k rows
        total[r.i, r.j] = r.s
    mean = total[k] / model.n
    gap = np.abs(total[:k] / model.n - np.outer(mean, mean) - np.eye(k))[np.ix_(model.live, model.live)]
    return float(gap.max()) if gap.size else 0.0


def whiten(rows: DataFrame, vector: str = "embedding", row_id: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """row_id, component, n, deviation, whitened, explained, identity_error: one row per kept vector and component."""
    kind = rows.schema[row_id].dataType.simpleString()
    schema = f"`{row_id}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    kept, d = usable(rows, vector, row_id)
    if not d:
        return rows.sparkSession.createDataFrame([], schema)
    model = fit(kept, d, components)
    error = identity_error(kept, d, model)
    k = len(model.values)

    def run(batches):
        for batch in batches:
            centred = model.centred(whole(batch, d))
            w = model.project(centred)
            far = (centred * centred).sum(1)
            deviation = pa.array([int(f) if f <= LONG else None for f in far.tolist()], pa.int64())
            rows_at = np.repeat(np.arange(batch.num_rows), k)
            each = lambda values: np.tile(values, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows_at)), pa.array(each(np.arange(1, k + 1, dtype=np.int32))), pa.array(np.full(len(rows_at), model.n)),
                 deviation.take(pa.array(rows_at)), pa.array(w.ravel(), mask=each(~model.live)), pa.array(each(model.explained)), pa.array(np.full(len(rows_at), error))],
                [row_id, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return kept.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
