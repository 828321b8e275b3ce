"""Whitening of vectors from an exact covariance: bit-sliced cross-products, summed as integers.

Entries become integers. Over all rows, every dimension is shifted by its least value, so that each takes few bits. A
task packs bit `a` of a dimension over its rows into words, 64 rows a word; the number of rows that have bit `a` of one
dimension and bit `b` of another is a popcount of ANDed words, and such counts weighted by `2^(a+b)` sum to the exact
cross-product. Spark adds the tasks' products as decimals, in any order with the same result. The driver gets the sums of
a square matrix over dimensions, whose size does not grow with the rows, centres it in integers, rounds once, and takes
its eigenvectors. A last pass projects every row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import bounded_batches, discard, shared, store

COMPONENTS = 32
# entries are c -> floor(SCALE * c) + OFFSET
SCALE, OFFSET = 64, 1_000_000
# larger entries would not fit a long
LARGEST = float(1 << 55)
# the driver holds a matrix over dimensions
MOST_DIMENSIONS = 2048
# rows that a task packs at a time
ROWS = 4096
WHOLE = "decimal(38,0)"


@dataclass
class Fit:
    """n vectors, their sums by dimension, unit eigenvectors as columns, eigenvalues, and the trace of the covariance."""

    n: int
    sums: list[int]
    vectors: object
    values: object
    trace: float

    def centred(self, x):
        """x - S/n, rounded once where the difference of integers is exact."""
        import numpy as np

        mean = np.array([s // self.n for s in self.sums])
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - mean) - rest

    def deviations(self, x) -> list[int]:
        """Per row the sum over dimensions of (n * x - S) squared, exactly."""
        import numpy as np

        mean, rest = [s // self.n for s in self.sums], [s % self.n for s in self.sums]
        u = x - np.array(mean)
        largest = int(np.abs(u).max(initial=0))
        if max(largest, self.n) * largest * len(mean) >= 1 << 62:
            u = u.astype(object)
        squares, mixed = (u * u).sum(axis=1).tolist(), (u * np.array(rest, u.dtype)).sum(axis=1).tolist()
        last = sum(r * r for r in rest)
        return [self.n * (self.n * a - 2 * b) + last for a, b in zip(squares, mixed, strict=True)]

    def whitened(self, x):
        """The rows projected on the components, over the root of the eigenvalue; not a number where that is nothing."""
        import numpy as np

        scale = np.where(self.values > 0, self.values, np.nan)
        return self.centred(x) @ (self.vectors / np.sqrt(scale))


def entries(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key and x, the integer entries, of the vectors to fit: neither null nor with entries null or not finite.

    Vectors have the commonest length (of equals the greater); others, and those with an entry beyond 2^55, have no x
    and are left out, as are vectors without entries.
    """
    v = F.col(vector).cast("array<double>")
    sound = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST))
    rows = vectors.select(F.col(key), v.alias("v")).filter(sound & (F.size("v") > 0))
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.filter(F.size("v") == (length["d"] if length else 0))
    x = F.transform("v", lambda c: F.floor(c * float(SCALE)).cast("long") + F.lit(OFFSET).cast("long"))
    return store(rows.select(key, x.alias("x")), "entries")


def matrix(column):
    """An Arrow list column of equally long lists as an integer matrix."""
    import numpy as np

    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1), np.int64)


def exact_sum(x) -> list[int]:
    """Sums by column, in Python's integers where a long might overflow."""
    import numpy as np

    if int(np.abs(x).max(initial=0)) * len(x) >= 1 << 62:
        x = x.astype(object)
    return [int(s) for s in x.sum(axis=0)]


def bit_planes(y, bits: list[int]):
    """Words of the bit planes of columns of unsigned integers, one row per plane: 64 rows of y to a word."""
    import numpy as np

    padded = np.zeros((-(-len(y) // 64) * 64, y.shape[1]), np.uint64)
    padded[: len(y)] = y
    planes = [(padded[:, d] >> np.uint64(b)).astype(np.uint8) & 1 for d, n in enumerate(bits) for b in range(n)]
    if not planes:
        return np.zeros((0, len(padded) // 64), np.uint64)
    return np.packbits(np.stack(planes), axis=1).view(np.uint64)


def add_products(total, planes, bits: list[int]) -> None:
    """Add to `total` (upper triangle) the cross-products of the columns that the bit planes stand for."""
    import numpy as np

    used = [d for d, n in enumerate(bits) if n]
    starts = np.cumsum([0, *(bits[d] for d in used)])
    weights = np.array([1 << b for d in used for b in range(bits[d])], total.dtype)
    for i, d in enumerate(used):
        low = starts[i]
        for a in range(bits[d]):
            both = np.bitwise_count(planes[low:] & planes[low + a]).sum(axis=1, dtype=np.int64)
            summed = np.add.reduceat(both.astype(total.dtype) * weights[low:], starts[i:-1] - low)
            total[d, used[i:]] += summed * (1 << a)


def ranges(x: DataFrame) -> list:
    """n, low, high and total of every dimension."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high, total = 0, None, None, None
        for batch in batches:
            part = matrix(batch.column(0))
            if len(part):
                ends = part.min(axis=0).tolist(), part.max(axis=0).tolist(), exact_sum(part)
                low, high, total = (
                    (ends[0], ends[1], ends[2]) if not n else
                    (list(map(min, low, ends[0])), list(map(max, high, ends[1])), [a + b for a, b in zip(total, ends[2], strict=True)])
                )
                n += len(part)
        if n:
            columns = [pa.array(range(len(low)), pa.int32()), pa.array([n] * len(low)), pa.array(low), pa.array(high)]
            columns.append(pa.array([Decimal(t) for t in total], pa.decimal128(38, 0)))
            yield pa.RecordBatch.from_arrays(columns, ["d", "n", "low", "high", "total"])

    parts = x.select("x").mapInArrow(run, f"d int, n long, low long, high long, total {WHOLE}")
    sums = [F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total")]
    return parts.groupBy("d").agg(*sums).orderBy("d").collect()


def scatter(x: DataFrame, lows: list[int], bits: list[int]) -> list[list[int]]:
    """Exact sums over rows of the products of shifted entries, by dimension and dimension."""
    import pyarrow as pa

    wide = 2 * max(bits) + 40 > 62

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        total = np.zeros((len(bits), len(bits)), object if wide else np.int64)
        waiting, n, seen = [], 0, 0

        def pack():
            rows = np.concatenate(waiting)
            add_products(total, bit_planes((rows - np.array(lows)).astype(np.uint64), bits), bits)

        for batch in batches:
            part = matrix(batch.column(0))
            waiting, n, seen = [*waiting, part], n + len(part), seen + len(part)
            if n >= ROWS:
                pack()
                waiting, n = [], 0
        if n:
            pack()
        if seen:
            products = [[Decimal(int(p)) for p in total[d, d:]] for d in range(len(bits))]
            columns = [pa.array(range(len(bits)), pa.int32()), pa.array(products, pa.list_(pa.decimal128(38, 0)))]
            yield pa.RecordBatch.from_arrays(columns, ["d", "products"])

    parts = x.select("x").mapInArrow(run, f"d int, products array<{WHOLE}>")
    pairs = parts.select("d", F.posexplode("products").alias("k", "p")).groupBy("d", "k").agg(F.sum("p").alias("p"))
    square = [[0] * len(bits) for _ in bits]
    for row in pairs.collect():
        square[row["d"]][row["d"] + row["k"]] = square[row["d"] + row["k"]][row["d"]] = int(row["p"])
    return square


def fit(x: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """The largest components of the covariance of all rows; None without rows."""
    import numpy as np

    known = ranges(x)
    if not known:
        return None
    if len(known) > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {len(known)} entries; at most {MOST_DIMENSIONS}")
    n, sums = known[0]["n"], [int(r["total"]) for r in known]
    lows, bits = [r["low"] for r in known], [(r["high"] - r["low"]).bit_length() for r in known]
    square = scatter(x, lows, bits)
    shifted = [s - n * low for s, low in zip(sums, lows, strict=True)]
    # integers to the last step: each entry of the covariance is rounded once
    centred = [[(n * p - a * b) / (n * n) for p, b in zip(row, shifted, strict=True)] for row, a in zip(square, shifted, strict=True)]
    values, vectors = np.linalg.eigh(np.array(centred))
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    # what rounding alone can make of nothing counts as nothing
    values = np.where(values > len(bits) * np.finfo(float).eps * max(values[0], 0), values, 0.0)
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), range(vectors.shape[1])] < 0, -1, 1)
    return Fit(n, sums, vectors, values, math.fsum(centred[d][d] for d in range(len(bits))))


def identity_error(x: DataFrame, fitted: Fit) -> float | None:
    """The largest entry of the covariance of all whitened rows less the identity, over components with a variance."""
    import numpy as np
    import pyarrow as pa

    spread = np.flatnonzero(fitted.values > 0)
    if not len(spread):
        return None
    sent = shared(x.sparkSession, fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, products, sums = sent(), 0, 0
        for batch in batches:
            z = have.whitened(matrix(batch.column(0)))[:, spread] if batch.num_rows else np.zeros((0, len(spread)))
            products, sums = products + z.T @ z, sums + z.sum(axis=0)
        if not np.isscalar(products):
            yield pa.RecordBatch.from_arrays([pa.array([np.append(products, sums)], pa.list_(pa.float64()))], ["p"])

    parts = x.select("x").mapInArrow(run, "p array<double>").select(F.posexplode("p").alias("k", "p"))
    flat = np.array([r["p"] for r in parts.groupBy("k").agg(F.sum("p").alias("p")).orderBy("k").collect()]) / fitted.n
    means = flat[len(spread) ** 2 :]
    covariance = flat[: len(spread) ** 2].reshape(len(spread), -1) - np.outer(means, means)
    return float(np.abs(covariance - np.eye(len(spread))).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row per fitted vector (key, vector) and component, numbered from 1 by falling variance.

    Beside them n, deviation (exact; null beyond a long), whitened, explained, identity_error, and deviation_exact, a
    decimal, null beyond 38 digits. Rows that `entries` leaves out have none. Where vectors have fewer entries than
    `components`, there are as many components as entries; a component without variance, as of equal rows, has whitened null, and
    explained is null where no component has any. Repeated rows and ids are rows of their own; other columns are ignored. An empty
    table gives no rows.
    """
    import pyarrow as pa

    spark = vectors.sparkSession
    bounded_batches(spark)
    x = entries(vectors, key, vector)
    fitted = fit(x, components)
    kind = x.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, "
        f"identity_error double, deviation_exact {WHOLE}"
    )
    if fitted is None:
        discard(x)
        return spark.createDataFrame([], schema)
    error, sent = identity_error(x, fitted), shared(spark, fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        have = sent()
        k = len(have.values)
        share = [float(v) / have.trace if have.trace > 0 else None for v in have.values]
        for batch in batches:
            if not batch.num_rows:
                continue
            part = matrix(batch.column(1))
            exact = have.deviations(part)
            z = have.whitened(part).ravel()
            each, by = pa.array(np.repeat(np.arange(len(part)), k)), pa.array(np.tile(np.arange(k), len(part)))
            long = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
            whole = pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))
            columns = [
                batch.column(0).take(each),
                pa.array(np.tile(np.arange(1, k + 1), len(part)), pa.int32()),
                pa.array(np.full(len(z), have.n)),
                long.take(each),
                pa.array(z, mask=np.isnan(z)),
                pa.array(share, pa.float64()).take(by),
                pa.array([error] * len(z), pa.float64()),
                whole.take(each),
            ]
            names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return x.mapInArrow(run, schema)
