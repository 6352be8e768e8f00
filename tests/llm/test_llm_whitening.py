import math
from collections import Counter

import numpy as np
import pytest

from vectrine.llm.whitening import Inertia, contour, feast, project, whiten

SCHEMA = "vec_id long, embedding array<float>, x string, key string, w string, i string"


def plain_whitening(rows, components=4):
    """{(key, component): ...} by a dense decomposition; rows of (key, vector)."""
    usable = [(k, v) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    if not usable:
        return [], None
    sizes = Counter(len(v) for _, v in usable)
    dim = max((n, d) for d, n in sizes.items())[1]
    usable = [(k, [math.floor(256 * float(np.float32(c))) + 0 for c in v]) for k, v in usable if len(v) == dim]
    fit = np.array(sorted({tuple(x) for _, x in usable}), dtype=np.int64)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    y = fit - np.array(sums) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    return usable, (n, sums, values[::-1][:components], vectors[:, ::-1][:, :components], float(np.trace(y.T @ y / n)))


def check(spark, rows, components=4):
    got = whiten(spark.createDataFrame([(k, v, "clash", "clash", "clash", "clash") for k, v in rows], SCHEMA), components=components).collect()
    usable, model = plain_whitening(rows, components)
    if model is None:
        assert got == []
        return got
    n, sums, values, vectors, trace = model
    real = [i for i, e in enumerate(values) if e > 1e-12 * trace]
    assert len(got) == len(usable) * len(values)
    want = Counter((k, i + 1, n, sum((n * c - s) ** 2 for c, s in zip(x, sums))) for k, x in usable for i in range(len(values)))
    assert Counter((r["vec_id"], r["component"], r["n"], r["deviation"]) for r in got) == want
    if len({round(float(e), 6) for e in values[real]}) == len(real):  # else the vectors are not unique
        shares = {i + 1: sorted(abs((np.array(x) - np.array(sums) / n) @ vectors[:, i] / math.sqrt(values[i])) for _, x in usable) for i in real}
        for i, want_values in shares.items():
            np.testing.assert_allclose(sorted(abs(r["whitened"]) for r in got if r["component"] == i), want_values, atol=1e-8)
    for r in got:
        e = values[r["component"] - 1]
        if r["component"] - 1 in real:
            assert r["explained"] == pytest.approx(e / trace, rel=1e-10) and r["identity_error"] < 1e-9
        else:
            assert r["whitened"] is None and r["explained"] == (0.0 if real else None)
    return got


def test_registered_query_against_dense_decomposition(spark, run, table):
    rows = [(r["vec_id"], r["embedding"]) for r in table("embeddings").collect()]
    check(spark, rows)
    got = {(r["vec_id"], r["component"]): r["whitened"] for r in run("op12_feast_whitening")}
    w = np.array([[got[k, c] for c in range(1, 5)] for k, _ in rows])
    assert len(got) == 4 * len(rows) and np.abs(np.cov(w.T, bias=True) - np.eye(4)).max() < 1e-9


RNG = np.random.default_rng(5)
PLANE = (RNG.standard_normal((50, 2)) @ RNG.standard_normal((2, 7))).astype(np.float32)


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, None), (2, []), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0])],
        [(1, [1.0, 2.0, 3.0])],
        [(k, [0.5, -0.25]) for k in (1, 2, 2, None)],
        [(k, v.tolist()) for k, v in enumerate(RNG.standard_normal((40, 3)))] + [(None, [1.0, 2.0, 3.0]), (7, [1.0]), (8, None), (9, [-0.0, 0.0, float("nan")])],
        # a third of all rows one vector, and every row twice
        [(k, v.tolist()) for k, v in enumerate(RNG.standard_normal((30, 6)))] * 2 + [(k, [9.0] * 6) for k in range(100, 130)],
        [(k, [float(k)]) for k in range(10)],
        # the corners of a cube: all eigenvalues are one
        [(8 * a + 4 * b + 2 * c + d, [float(a), float(b), float(c), float(d), 0.0]) for a in (0, 1) for b in (0, 1) for c in (0, 1) for d in (0, 1)],
        [(k, [float(x), 1e30]) for k, x in enumerate(range(5))],
    ],
)
def test_awkward_rows(spark, rows):
    if any(v and v[-1] == 1e30 for _, v in rows):
        got = whiten(spark.createDataFrame([(k, v, "", "", "", "") for k, v in rows], SCHEMA)).collect()
        assert len(got) == 10 and {r["deviation"] for r in got} == {None}
    else:
        check(spark, rows)


def test_vectors_in_a_plane_have_two_components(spark):
    a = np.round(PLANE * 4) @ np.eye(7)
    got = check(spark, [(k, v.tolist()) for k, v in enumerate(a)], 3)
    assert len(got) == 150


@pytest.mark.parametrize(
    "values",
    [
        [5.0, 4.0, 3.0, 2.0, 1.0, 0.5, 0.25, 0.1],
        [2.0] * 12,
        [3.0, 3.0, 2.0, 2.0, 2.0, 2.0, 1.0] + [0.1] * 20,
        [1.0, 0.0, 0.0, 0.0, 0.0],
        [1.0 + i / 1000 for i in range(60)],
        [10.0**-i for i in range(9)],
    ],
)
def test_feast_finds_the_largest_and_misses_none(spark, values):
    rng = np.random.default_rng(len(values))
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    v = q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    want = [e for e in sorted(values, reverse=True)[:4] if e > 1e-12 * sum(values)]
    got = feast(spark, v, 4)
    np.testing.assert_allclose(got.values, want, rtol=1e-9)
    assert np.abs(v @ got.vectors - got.vectors * got.values).max() < 1e-12 * sum(values)
    assert np.abs(got.vectors.T @ got.vectors - np.eye(len(want))).max() < 1e-10
    assert got.counted >= len(want)


def test_inertia_counts_and_contour_projects(spark):
    rng = np.random.default_rng(1)
    a = rng.standard_normal((20, 20))
    v = a @ a.T
    values = np.linalg.eigvalsh(v)
    for shift in (-1.0, 0.5, *((values[1:] + values[:-1]) / 2), 1e6):
        assert Inertia(v).above(shift) == int((values > shift).sum())
    low, high = (values[-4] + values[-3]) / 2, values[-1] * 1.1
    inside = np.linalg.eigh(v)[1][:, -3:]
    projected = project(spark, v, np.eye(20), contour(low, high, 40))
    assert np.abs(projected - inside @ inside.T).max() < 0.05
