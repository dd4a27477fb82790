import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchpath.llm import whitening
from touchpath.llm.queries import QUERIES

ROWS = "vec_id long, embedding array<float>, label int"


def vectors(seed=1, n=120, dim=7):
    rng = random.Random(seed)
    scale = [3.0 / (i + 1) for i in range(dim)]
    rows = [(i, [rng.gauss(0, s) for s in scale], 0) for i in range(n)]
    rows += [(500 + i, rows[4][1], 0) for i in range(60)]  # copies of one vector
    rows += [(600, None, 0), (601, [None] * dim, 0), (602, [float("nan")] * dim, 0), (603, [float("inf")] + [0.0] * (dim - 1), 0), (604, [], 0),
             (605, [1.0, 2.0], 0), rows[3], rows[3], (None, rows[9][1], None), (606, [-0.0] * dim, 0)]
    rng.shuffle(rows)
    return rows


def brute(rows, dim, k, counts=False):
    kept = [(v, np.floor(64 * np.array(e, np.float32).astype(float)).astype(int) + 1_000_000) for v, e, _ in rows
            if e is not None and len(e) == dim and all(c is not None and math.isfinite(c) for c in e)]
    fit = [x for _, x in kept] if counts else list({tuple(x): x for _, x in kept}.values())
    n, total = len(fit), sum(np.array(x, object) for x in fit)
    z = np.array([(n * np.array(x, object) - total) / n for x in fit], float)
    cov = z.T @ z / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = []
    for v, x in kept:
        y = n * np.array(x, object) - total
        out.append((v, n, int((y * y).sum()), (y / n).astype(float) @ u / np.sqrt(e), e / np.trace(cov)))
    return out


def key(r):
    return (-1 if r[0] is None else r[0], r[2])


@pytest.mark.parametrize("counts", [False, True])
def test_whitening_against_numpy(spark, counts):
    rows = vectors()
    df = spark.createDataFrame(rows, ROWS).repartition(5).withColumns({c: F.lit("x") for c in ("x", "copies", "row", "weight", "n", "_hot")})
    got = whitening.whiten(df, "embedding", 5, counts).select("row.vec_id", "n", "deviation", "whitened", "explained", "identity_error", "row.copies").collect()
    want = sorted(brute(rows, 7, 5, counts), key=key)
    got = sorted(got, key=key)
    assert [(r[0], r[1], int(r[2])) for r in got] == [w[:3] for w in want]
    a, b = np.array([r["whitened"] for r in got]), np.array([w[3] for w in want])
    np.testing.assert_allclose(a * np.sign((a * b).sum(axis=0)), b, atol=1e-8)
    np.testing.assert_allclose(got[0]["explained"], want[0][4], rtol=1e-10)
    assert {r["copies"] for r in got} == {"x"} and max(r["identity_error"] for r in got) < 1e-10


def write(spark, tmp_path, rows):
    spark.createDataFrame(rows, ROWS).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


def test_query(spark, tmp_path):
    rows = vectors(2, 300, 20)
    out = QUERIES["op13_whitening"](spark, write(spark, tmp_path, rows)).collect()
    want = brute(rows, 20, 16)
    assert len(out) == 16 * len(want) and {r["component"] for r in out} == set(range(1, 17))
    assert sorted((r["vec_id"] or -1, r["deviation"], r["n"]) for r in out if r["component"] == 3) == sorted((w[0] or -1, w[2], w[1]) for w in want)
    assert all(r["identity_error"] < 1e-9 for r in out)
    part = {r["component"]: r["explained"] for r in out}
    np.testing.assert_allclose([part[i] for i in range(1, 17)], want[0][4], rtol=1e-10)


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [], 0)], [(1, [0.5, 0.25], 0)] * 4, [(1, [float("nan")], 0)]])
def test_tables_without_a_component(spark, tmp_path, rows):
    assert QUERIES["op13_whitening"](spark, write(spark, tmp_path, rows)).collect() == []


def test_flat_directions_are_no_components(spark, tmp_path):
    rows = [(i, [float(i), 2.0 * i, 1.0], 0) for i in range(10)]
    out = QUERIES["op13_whitening"](spark, write(spark, tmp_path, rows)).collect()
    assert {r["component"] for r in out} == {1} and len(out) == 10


def test_exact_numbers_beyond_longs():
    x = np.array([[1 << 50, 3], [5, -(1 << 50)]], np.int64)
    n, sums = 1 << 20, [7, 1 << 60]
    want = [sum((n * int(v) - s) ** 2 for v, s in zip(r, sums)) for r in x]
    assert whitening.deviations(x, n, sums) == want
    assert whitening.deviations(np.zeros((0, 2), np.int64), 1, [0, 0]) == []
