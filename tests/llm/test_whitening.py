import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from lexwarrant.llm import queries, whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def plainly(vectors, most=32):
    """n, sums, exact deviations, values, vectors and trace by numpy over all rows at once."""
    x = np.floor(np.asarray(vectors, np.float32).astype(float) * 64).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return n, deviation, e[::-1][:most], u[:, ::-1][:, :most], c, np.trace(v)


def agrees(got, ids, vectors, most=32):
    n, deviation, e, u, c, trace = plainly(vectors, most)
    rows = {}
    for r in got:
        rows.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(rows) == set(ids) and all(sorted(x) == list(range(1, len(e) + 1)) for x in rows.values())
    for k in range(len(e)):
        col = np.array([rows[i][k + 1]["whitened"] for i in ids])
        want = c @ u[:, k] / np.sqrt(e[k])
        assert min(np.abs(col - want).max(), np.abs(col + want).max()) < 1e-7, k
        one = rows[ids[0]][k + 1]
        assert math.isclose(one["explained"], e[k] / trace, rel_tol=1e-9) and one["n"] == n and one["identity_error"] < 1e-9 and one["residual"] < 1e-11
    assert [rows[i][1]["deviation"] for i in ids] == deviation


def test_supplied_embeddings(spark):
    table = pq.read_table("/root/testdata/sf0.001/embeddings.parquet").to_pylist()
    agrees(queries.op12_whiten(spark, "/root/testdata/sf0.001").collect(), [r["vec_id"] for r in table], [r["embedding"] for r in table])


def test_few_dimensions_and_odd_rows(spark):
    rnd = np.random.default_rng(1)
    good = [[float(np.float32(v)) for v in rnd.standard_normal(5) * [5, 4, 3, 2, 1]] for _ in range(60)]
    rows = [(i, v, 1) for i, v in enumerate(good)]
    odd = [(100, None, 1), (101, [1.0, None, 1.0, 1.0, 1.0], 1), (102, [1.0, float("nan")] + [0.0] * 3, 1), (103, [float("inf")] + [0.0] * 4, 1), (104, [1e30] + [0.0] * 4, None), (105, [], 1), (106, [1.0, 2.0], 1)]
    agrees(W.whiten(spark.createDataFrame(rows + odd, SCHEMA)).collect(), list(range(60)), good)


def test_ids_that_repeat_or_are_null_and_clashing_names(spark):
    rows = [(None, [1.0, 2.0], 1), (7, [3.0, 1.0], 1), (7, [3.0, 1.0], 1), (8, [0.0, 5.0], None)]
    df = spark.createDataFrame(rows, SCHEMA).toDF("vec_id", "embedding", "x").selectExpr("*", "1 AS Vec_Id", "2 AS component", "3 AS v")
    got = W.whiten(df).collect()
    assert sorted(str(r["vec_id"]) for r in got) == sorted(["None", "7", "7", "8"] * 2)
    for k in (1, 2):
        assert math.isclose(sum(r["whitened"] ** 2 for r in got if r["component"] == k) / 4, 1)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [1.0, 2.0], 1)], [(1, [1.0, 2.0], 1)] * 3])
def test_nothing_to_whiten(spark, rows):
    got = W.whiten(spark.createDataFrame(rows, SCHEMA))
    assert got.count() == 0 and got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_a_flat_direction_is_left_out(spark):
    got = W.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0], 1) for i in range(20)], SCHEMA)).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 20


def test_many_dimensions_take_rounds_and_certify():
    """More dimensions than three blocks span: directions and residuals have to do the work."""
    rnd = np.random.default_rng(2)
    q = np.linalg.qr(rnd.standard_normal((300, 300)))[0]
    e = 100 * 0.97 ** np.arange(300)
    matrix = (q * e) @ q.T
    values, vectors, _, left, rounds = W.lobpcg(lambda b: matrix @ b, 300, 32)
    assert rounds > 3 and np.allclose(values, e[:32], rtol=1e-12) and left.max() < 1e-12
    assert np.abs(np.abs((vectors * q[:, :32]).sum(axis=0)) - 1).max() < 1e-12


def test_deviations_beyond_64_bits():
    rows = np.array([[1 << 40, 1], [2, 3]])
    n, sums = 1 << 29, np.array([5, 7])
    want = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, sums)) for r in rows]
    assert W._deviations(rows, n, sums) == [None, want[1]]
