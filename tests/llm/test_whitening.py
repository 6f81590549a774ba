"""Whitening against a dense eigendecomposition of exactly centred rows."""

import math
from collections import Counter

import numpy as np
import pytest

from parcelyard.llm import queries, whitening
from parcelyard.llm.common import table
from parcelyard.llm.whitening import Centre, Spectrum, secular_roots


def integers(vectors):
    rows = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in rows), default=0)
    return [(i, [math.floor(1024 * float(c)) + 100_000 for c in v] + [100_000] * (width - len(v))) for i, v in rows]


def check(got, vectors, asked=8):
    rows = integers(vectors)
    n, x = len(rows), np.array([v for _, v in rows], object)
    sums = x.sum(axis=0)
    centred = (x * n - sums).astype(float) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    used = min(asked, int((values > 1e-12 * values.sum()).sum()))
    assert len(got) == n * used and {r["n"] for r in got} == {n}
    want = Counter((i, int(((v * n - sums) ** 2).sum())) for (i, _), v in zip(rows, x))
    assert Counter((r["vec_id"], r["deviation"]) for r in got if r["component"] == 1) == want
    (error,) = {r["identity_error"] for r in got}
    assert error < 1e-9
    for c in range(1, used + 1):
        mine = [r for r in got if r["component"] == c]
        assert {r["explained"] for r in mine} == {mine[0]["explained"]}
        assert mine[0]["explained"] == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
        y = centred @ basis[:, c - 1] / np.sqrt(values[c - 1])
        # Rows in the same order: by id and deviation, and with equal ones by value.
        for sign in (1, -1):
            told = sorted((r["vec_id"] is None, r["vec_id"] or 0, r["deviation"], r["whitened"] * sign) for r in mine)
            plain = sorted((i is None, i or 0, int(((v * n - sums) ** 2).sum()), float(w)) for (i, _), v, w in zip(rows, x, y))
            if np.allclose([t[3] for t in told], [p[3] for p in plain], atol=1e-9):
                break
        else:
            raise AssertionError(c)


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_op13_matches_a_dense_decomposition(spark, sf_dir):
    vectors = [tuple(r) for r in table(spark, sf_dir, "embeddings").select("vec_id", "embedding").collect()]
    check(queries.op13_whitening(spark, sf_dir).collect(), vectors)


VECTORS = "vec_id long, embedding array<float>, x string, component string"


def frame(spark, vectors, parts=1):
    return spark.createDataFrame([(i, v, "a", "b") for i, v in vectors], VECTORS).repartition(parts)


@pytest.mark.parametrize("parts", [1, 40])
def test_hard_rows(spark, parts):
    rng = np.random.default_rng(13)
    spread = rng.normal(0, 0.3, (11, 11)) * np.geomspace(1, 1e-2, 11)
    vectors = [(int(i), (rng.normal(0, 1, 11) @ spread).tolist()) for i in range(300)]
    vectors += [(1000 + k, vectors[0][1]) for k in range(200)]  # copies
    vectors += [(3, vectors[3][1])] * 2 + [(None, vectors[4][1]), (None, vectors[5][1])]
    vectors += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 11), (403, [float("-inf")] + [0.0] * 10)]
    vectors += [(404, []), (405, [0.5, 0.25]), (406, [900.0] + [0.0] * 10)]
    check(whitening.whitened(frame(spark, vectors, parts)).collect(), vectors)


def test_few_directions_and_none(spark):
    flat = [(i, [0.1 * i, 0.2 * (i % 3), 0.5, 0.5]) for i in range(30)]
    got = whitening.whitened(frame(spark, flat)).collect()
    check(got, flat)
    assert {r["component"] for r in got} == {1, 2}
    assert whitening.whitened(frame(spark, flat, 7), components=1).filter("component > 1").count() == 0
    for none in ([], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)], [(1, None)], [(1, []), (2, [])]):
        rows = whitening.whitened(frame(spark, none))
        assert rows.collect() == [] and rows.columns == [f.split()[0] for f in whitening.ROWS.split(", ")]


def test_deviation_beyond_64_bits(spark):
    vectors = [(i, [float(2**20 * i)]) for i in range(100)]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whitened(frame(spark, vectors)).collect()}
    rows = integers(vectors)
    total = sum(v[0] for _, v in rows)
    exact = {i: (100 * v[0] - total) ** 2 for i, v in rows}
    assert got == {i: d if d < 2**63 else None for i, d in exact.items()} and None in got.values()
    centre = Centre(10**12, np.array([10**12 * 100_000 + 7] * 3, object))
    x = np.array([[100_001, 99_999, 100_000]])
    assert centre.squared(x) == [None] and Centre(7, np.array([7 * 100_000 + 3], object)).squared(x[:, :1]) == [16]


def test_secular_roots():
    rng = np.random.default_rng(5)
    for n in (1, 2, 5, 40):
        for gaps in (rng.random(n), rng.random(n) * np.geomspace(1, 1e-9, n)):
            d, z = np.cumsum(gaps + 1e-12), rng.normal(size=n) * np.geomspace(1, 1e-4, n)
            origin, at = secular_roots(d, z * z)
            roots = d[origin] + at
            want = np.linalg.eigvalsh(np.diag(d) + np.outer(z, z))
            assert np.allclose(roots, want, rtol=0, atol=1e-13 * want.max())
            assert np.all(roots >= d) and np.all(roots[:-1] <= d[1:])


def test_updates_and_joins_deflate():
    rng = np.random.default_rng(6)
    x = (rng.normal(size=(200, 9)) @ rng.normal(size=(9, 9)) * 100).astype(np.int64) + 100_000
    x[:, 4] = 100_000  # no variance
    x[50:90] = x[50]
    for cut in (0, 1, 77, 199):
        parts = []
        for rows in (x[:cut], x[cut:]):
            parts.append(Spectrum.empty(9))
            for row in rows:
                parts[-1].add(row)
        whole = parts[0].join(parts[1])
        centred = x - x.mean(axis=0)
        want = centred.T @ centred
        assert np.abs(whole.vectors * whole.values @ whole.vectors.T - want).max() < 1e-11 * want.max()
        assert np.abs(whole.vectors.T @ whole.vectors - np.eye(9)).max() < 1e-12
        assert whole.n == 200 and list(whole.sums) == list(x.sum(axis=0))
    weighted, single = Spectrum.empty(9), Spectrum.empty(9)
    for row in x[:20]:
        weighted.add(row, 3)
        for _ in range(3):
            single.add(row)
    assert np.allclose(weighted.values, single.values, rtol=1e-10, atol=1e-6)
    assert Spectrum.of(weighted.row()).sums.tolist() == weighted.sums.tolist()
