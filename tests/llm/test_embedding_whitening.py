import math
import random
from fractions import Fraction

import numpy as np
import pytest

from rowferry.llm.embedding_whitening import add_products, bit_planes, entries, whiten

SF_DIR = "/root/testdata/sf0.001"


def plain(rows):
    """Integer vectors by id, n, sums, and the exact covariance as fractions."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    xs = [[math.floor(64 * float(c)) + 1000000 for c in v] for _, v in kept]
    n, d = len(xs), len(xs[0])
    sums = [sum(x[j] for x in xs) for j in range(d)]
    y = np.array(xs, dtype=object)
    product = y.T.dot(y)
    cov = [[Fraction(n * product[i][j] - sums[i] * sums[j], n * n) for j in range(d)] for i in range(d)]
    return kept, xs, n, sums, cov


def check(df, k=32):
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    kept, xs, n, sums, cov = plain(rows)
    v = np.array([[float(c) for c in row] for row in cov])
    found = whiten(df).collect()
    k = min(k, len(sums))
    assert sorted((r["vec_id"], r["component"]) for r in found) == sorted((i, c) for i, _ in kept for c in range(1, k + 1))
    deviations = {}
    for (i, _), x in zip(kept, xs, strict=True):
        deviations.setdefault(i, set()).add(sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)))
    assert all(r["deviation"] in deviations[r["vec_id"]] and r["deviation_exact"] == r["deviation"] and r["n"] == n for r in found)
    values = np.linalg.eigvalsh(v)[::-1]
    by_id = {}
    for r in found:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r
    share = [by_id[kept[0][0]][c + 1]["explained"] for c in range(k)]
    assert np.allclose(share, values[:k] / v.trace(), rtol=1e-9)
    z = np.array([[by_id[i][c + 1]["whitened"] for c in range(k)] for i, _ in kept])
    mean = [Fraction(s, n) for s in sums]
    centred = np.array([[float(a - m) for a, m in zip(x, mean, strict=True)] for x in xs])
    # V times a component is its eigenvalue times it; the component is found back from the rows
    components = centred.T @ z / n / np.sqrt(values[:k])
    assert np.allclose(np.linalg.norm(components, axis=0), 1, atol=1e-9)
    assert np.allclose(v @ components, components * values[:k], atol=1e-9 * values[0])
    z0 = z - z.mean(axis=0)
    error = np.abs(z0.T @ z0 / n - np.eye(k)).max()
    assert all(abs(r["identity_error"] - error) < 1e-9 and r["identity_error"] <= 1e-4 for r in found[:50])


def test_given_embeddings(spark):
    check(spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding"))


def test_awkward_vectors(spark):
    draw = random.Random(1)
    rows = [(i, [draw.uniform(-3, 3) * (j + 1) for j in range(5)], "x") for i in range(150)]
    rows += [(200, None, "x"), (201, [1.0, None, 2.0, 3.0, 4.0], "x"), (202, [math.nan] * 5, "x"), (203, [math.inf] * 5, "x")]
    rows += [(204, [1e4] * 5, "x"), (205, [-1e4, 0.0, 0.0, 0.0, 0.0], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string")
    check(df)
    other = spark.createDataFrame([(7, [1.0, 2.0], "x"), (8, [], "x"), (9, [1e300] * 5, "x")], df.schema)
    assert entries(df.unionByName(other)).count() == 152
    assert {r["component"] for r in whiten(df).collect()} == {1, 2, 3, 4, 5}


def test_repeated_rows_and_no_spread(spark):
    schema = "vec_id long, embedding array<float>"
    assert whiten(spark.createDataFrame([], schema)).count() == 0
    same = whiten(spark.createDataFrame([(1, [0.5, 0.25])] * 3, schema)).collect()
    assert len(same) == 6
    assert all(r["whitened"] is None and r["deviation"] == 0 and r["identity_error"] is None and r["explained"] is None for r in same)
    line = whiten(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(4)], schema)).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in line)
    assert abs(line[0]["explained"] - 1) < 1e-9 and line[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("wide", [7, 30, 60])
def test_cross_products(wide):
    draw = random.Random(wide)
    y = [[draw.getrandbits(wide), draw.getrandbits(3), 0, draw.getrandbits(wide // 2)] for _ in range(130)]
    bits = [max(r[j] for r in y).bit_length() for j in range(4)]
    total = np.zeros((4, 4), object)
    for start in (0, 70):
        part = y[start : start + (70 if start == 0 else 60)]
        add_products(total, bit_planes(np.array(part, np.uint64), bits), bits)
    for i in range(4):
        for j in range(i, 4):
            assert total[i, j] == sum(r[i] * r[j] for r in y)


def test_wide_entries(spark):
    rows = [(i, [float(3**i), 1.0 * i, 0.0]) for i in range(33)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    kept, xs, n, sums, cov = plain(rows)
    for r in whiten(df).filter("component = 1").collect():
        exact = sum((n * a - s) ** 2 for a, s in zip(xs[r["vec_id"]], sums, strict=True))
        assert r["deviation_exact"] == (exact if exact < 10**38 else None)
        assert r["deviation"] == (exact if exact < 2**63 else None)
    trace = float(sum(cov[d][d] for d in range(3)))
    assert abs(r["explained"] - np.linalg.eigvalsh([[float(c) for c in row] for row in cov])[-1] / trace) < 1e-9
