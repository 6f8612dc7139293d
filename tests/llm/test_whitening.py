import math

import numpy as np
import pytest

from floodmark.llm import whitening
from floodmark.llm.queries import LLM_QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, n string, whitened int"


def plain(rows):
    """Whole numbers, exact deviations and eigenvectors of the covariance of the rows that remain."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in good]
    n = len(x)
    sums = [sum(column) for column in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    a = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    e, q = np.linalg.eigh(a.T @ a / n)
    return [i for i, _ in good], deviation, a, e[::-1], q[:, ::-1]


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(4)


def hold(out, rows, components, close=1e-7):
    ids, deviation, a, e, q = plain(rows)
    k = min(components, int((e > 1e-12 * e[0]).sum()))
    z = a @ q[:, :k] / np.sqrt(e[:k])
    got = out.collect()
    assert len(got) == len(ids) * k
    place = {i: at for at, i in enumerate(ids)}
    sign = np.zeros(k)
    for r in sorted(got, key=lambda r: -abs(z[place[r.vec_id], r.component - 1])):
        at, c = place[r.vec_id], r.component - 1
        sign[c] = sign[c] or np.sign(r.whitened * z[at, c])
        assert r.n == len(ids) and r.deviation == deviation[at]
        assert abs(r.whitened - sign[c] * z[at, c]) < close
        assert abs(r.explained - e[c] / e.sum()) < 1e-10 * r.explained + 1e-14
        assert r.identity_error < 1e-9
    return k


def test_query_equals_eigenvectors(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    out = LLM_QUERIES["op12_embedding_whitening"](spark, SMALL)
    assert out.dtypes == [
        ("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
        ("explained", "double"), ("identity_error", "double")]
    assert hold(out, rows, 32) == 32


def test_rows_that_are_left_out(spark):
    random = np.random.default_rng(1)
    rows = [(i, random.normal(size=5).tolist()) for i in range(60)]
    bad = [(60, None), (61, [1.0, None, 2.0, 3.0, 4.0]), (62, [1.0, math.nan] * 2 + [1.0]), (63, [math.inf, 1.0, 1.0, 1.0, 1.0])]
    hold(whitening.whiten(table(spark, rows + bad)), rows, 32)
    odd = [(64, []), (65, [1.0]), (66, [1e300, 0.0, 0.0, 0.0, 0.0])]
    hold(whitening.whiten(table(spark, rows + bad + odd), components=3), rows, 3)
    # Repeated rows and null ids count like others.
    twice = table(spark, rows[:30] + rows[:30] + [(None, rows[3][1])])
    out = whitening.whiten(twice).collect()
    assert len(out) == 61 * 5 and sum(r.vec_id is None for r in out) == 5 and {r.n for r in out} == {61}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [2.0, 3.0])], [(i, [1.0, 2.0, 3.0]) for i in range(9)]])
def test_no_variance_no_component(spark, rows):
    assert whitening.whiten(table(spark, rows)).collect() == []


def test_fewer_directions_than_dimensions(spark):
    random = np.random.default_rng(2)
    few = (random.integers(-40, 40, size=(80, 3)) / 64).tolist()
    rows = [(i, [a, b, c, a + b, c, 7.0]) for i, (a, b, c) in enumerate(few)]
    assert hold(whitening.whiten(table(spark, rows)), rows, 32) == 3
    assert hold(whitening.whiten(table(spark, rows[:2])), rows[:2], 32) == 1


def test_equal_eigenvalues(spark):
    rows = [(2 * i + s, [(2.0 - 4.0 * s) * (j == i) for j in range(12)]) for i in range(12) for s in (0, 1)]
    ids, _, a, e, _ = plain(rows)
    assert abs(e[0] - e[-1]) < 1e-9
    out = whitening.whiten(table(spark, rows)).collect()
    z = np.zeros((24, 12))
    for r in out:
        z[r.vec_id, r.component - 1] = r.whitened
        assert abs(r.explained - 1 / 12) < 1e-12
    assert np.abs(z.T @ z / 24 - np.eye(12)).max() < 1e-10


def test_early_stop_and_several_equal_eigenvalues(spark):
    random = np.random.default_rng(3)
    size = np.array([60.0, 30.0, 15.0, 15.0] + [0.5 * 0.9**i for i in range(76)])
    basis = np.linalg.qr(random.normal(size=(80, 80)))[0]
    left = np.linalg.qr(random.normal(size=(400, 80)))[0]
    rows = [(i, v) for i, v in enumerate((left * size * 20 @ basis.T).tolist())]
    good, dims = whitening._narrow(table(spark, rows), "vec_id", "embedding")
    model = whitening.fit(good, dims, 4)
    _, _, a, e, q = plain(rows)
    assert 4 < model.steps < 80
    assert np.abs(model.variances / e[:4] - 1).max() < 1e-10
    assert np.linalg.svd(model.axes[:, :4].T @ q[:, :4])[1].min() > 1 - 1e-9


def test_large_numbers_stay_exact(spark):
    rows = [(i, [1e9 + i * 1e6 + 0.3, -1e9 * (i % 3), i * 1e-3]) for i in range(50)]
    hold(whitening.whiten(table(spark, rows)), rows, 2, close=1e-5)


def test_blocks_are_small(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 8 * 3 * 7)
    rows = [(i, v) for i, v in enumerate(np.random.default_rng(4).normal(size=(100, 3)).tolist())]
    good, dims = whitening._narrow(table(spark, rows), "vec_id", "embedding")
    blocks = whitening._blocks(good, dims, whitening._fit_centre(good, dims)).collect()
    assert sum(len(b.data) // np.dtype(b.kind).itemsize for b in blocks) == 300
    assert max(len(b.data) // np.dtype(b.kind).itemsize for b in blocks) <= 21
    hold(whitening.whiten(table(spark, rows)), rows, 32)
