from __future__ import annotations

import hashlib
import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodeworks.llm import centroids, whitening
from lodeworks.llm.queries import ORACLES, QUERIES

NAN, INF = float("nan"), float("inf")


# -- clusters -------------------------------------------------------------------------------------


def full_search(rows, k, rounds, size, scale=256):
    """(id, cluster, distance) by comparing every vector with every centroid, in Python's integers."""
    kept = [(i, [math.floor(scale * c) for c in v]) for i, v in rows if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]
    chance = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    middle = [v for _, v in sorted(kept, key=chance)[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(middle))
    for _ in range(rounds):
        of = {}
        for _, v in kept:
            of.setdefault(nearest(v)[1], []).append(v)
        middle = [[sum(c) // len(of[j]) for c in zip(*of[j], strict=True)] if j in of else m for j, m in enumerate(middle)]
    return sorted((i if i is not None else -1, nearest(v)[1], nearest(v)[0]) for i, v in kept), middle


def clustered(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found, final = centroids.cluster(df, **how)
    return sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["cluster"], r["distance"]) for r in found.collect()), final.tolist()


@pytest.mark.parametrize(("k", "rounds"), [(1, 2), (2, 3), (7, 5), (30, 4), (500, 2)])
def test_clusters_equal_those_of_a_full_search(spark, k, rounds):
    rng = np.random.default_rng(k)
    rows = [(i, (rng.integers(0, 6, 3) + rng.normal(0, 0.02, 3)).tolist()) for i in range(300)]
    assert clustered(spark, rows, k=k, rounds=rounds, size=3) == full_search(rows, k, rounds, 3)


def test_ties_copies_and_empty_clusters(spark):
    """Few whole values: many vectors are as near to two centroids, and many centroids are equal."""
    rng = np.random.default_rng(1)
    rows = [(i % 150, (rng.integers(-2, 3, 2) / 256).tolist()) for i in range(400)] + [(7, [0.0, 0.0])] * 300 + [(None, [1.0, 1.0])]
    assert clustered(spark, rows, k=20, rounds=4, size=2) == full_search(rows, 20, 4, 2)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(1, 4), st.integers(0, 10_000))
def test_bounds_hold_over_rounds(k, size, seed):
    """After every round the states bracket the true distances, and both remembered centroids are apart."""
    rng = np.random.default_rng(seed)
    x = rng.integers(-9, 10, (80, size)) * rng.integers(1, 3)
    middle, earlier = rng.integers(-9, 10, (k, size)), None
    states = [np.zeros(80, np.int32), np.full(80, min(1, k - 1), np.int32), np.full(80, np.inf), np.zeros(80)]
    for _ in range(5):
        centroids.Shallot(middle, earlier).search(x, *states)
        every = ((x[:, None] - middle[None]) ** 2).sum(axis=2)
        assert (states[0] == every.argmin(axis=1)).all()
        others = np.where(np.arange(k) == states[0][:, None], np.inf, np.sqrt(every)).min(axis=1)
        if k > 1:
            assert (states[2] >= np.sqrt(every.min(axis=1))).all() and (states[3] <= others).all() and (states[0] != states[1]).all()
        earlier, middle = middle, middle + rng.integers(-2, 3, (k, size)) * (rng.random((k, 1)) < 0.6)


def test_few_distances_are_computed_once_centroids_rest(monkeypatch):
    rng = np.random.default_rng(3)
    middle = rng.integers(-5_000, 5_000, (40, 8))
    x = np.repeat(middle, 50, axis=0) + rng.integers(-20, 21, (2_000, 8))
    states = [np.zeros(2_000, np.int32), np.ones(2_000, np.int32), np.full(2_000, np.inf), np.zeros(2_000)]
    seen = []
    first, then = centroids.Shallot(middle), centroids.Shallot(middle + 1, middle)
    own = centroids.squared
    monkeypatch.setattr(centroids, "squared", lambda a, b: seen.append(len(a)) or own(a, b))
    first.search(x, *states)
    assert sum(seen) < 2_000 * 40
    seen.clear()
    then.search(x, *states)
    assert sum(seen) == 0


def test_odd_vectors_have_no_cluster(spark):
    good = [(1, [0.5, 0.25]), (2, [-0.5, 0.125]), (2, [-0.5, 0.125])]
    bad = [(3, None), (4, []), (5, [1.0]), (6, [1.0, 2.0, 3.0]), (7, [None, 1.0]), (8, [NAN, 1.0]), (9, [INF, 1.0])]
    assert clustered(spark, good + bad, k=2, size=2) == full_search(good, 2, 5, 2)
    assert clustered(spark, bad, k=2, size=2) == ([], [])
    assert clustered(spark, [], k=2, size=2) == ([], [])
    huge, _ = clustered(spark, [(1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [0.0, 0.0])], k=1, rounds=0, size=2)
    assert len(huge) == 3 and max(d for *_, d in huge) <= (4 * centroids.largest(2) ** 2)
    wide = spark.createDataFrame([(1, [0.5] * 64, 3, 4.0)], "vec_id long, embedding array<float>, cluster int, x double")
    found, final = centroids.cluster(wide)
    row = centroids.with_inertia(found, final).first()
    assert (row["cluster"], row["distance"], row["inertia"]) == (0, 0, 0)
    assert row["centroid_sha256"] == hashlib.sha256(",".join(["128"] * 64).encode()).hexdigest()


def test_query_against_sql_and_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    got = sorted(map(tuple, QUERIES["op11_shallot_clusters"](spark, folder).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()))
    db = duckdb.connect()
    db.execute(f"create view embeddings as select * from '{folder}/embeddings.parquet'")
    told = db.execute(ORACLES["op11_shallot_clusters"])
    names = [d[0] for d in told.description]
    want = sorted(tuple(dict(zip(names, r, strict=True))[c] for c in ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")) for r in told.fetchall())
    assert got == want and len(got) == 500
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert [r[:3] for r in got] == full_search(rows, 40, 5, 64)[0]


# -- whitening ------------------------------------------------------------------------------------


def plain(rows, components=32):
    """Integers, covariance by centring first, and all eigenpairs, by numpy on the whole matrix."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    z = np.array([[n * a - s for a, s in zip(v, sums, strict=True)] for v in x], dtype=np.float64) / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    deviations = [sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for v in x]
    return z, values[::-1][:components], vectors[:, ::-1][:, :components], deviations


def check_whitening(spark, rows, components=32, digits=1e-6):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whiten(df, components).collect()
    z, values, vectors, deviations = plain(rows, components)
    m = len(values)
    assert len(got) == len(rows) * m
    of = {(r["vec_id"], r["component"]): r for r in got}
    mine = np.array([[of[i, c + 1]["whitened"] for c in range(m)] for i, _ in rows])
    want = z @ vectors / np.sqrt(values)
    signs = np.sign((mine * want).sum(axis=0))
    assert np.abs(mine * signs - want).max() < digits
    assert [of[i, 1]["deviation"] for i, _ in rows] == deviations and {r["n"] for r in got} == {len(rows)}
    total = sum(deviations) / len(rows) ** 3
    assert all(abs(of[rows[0][0], c + 1]["explained"] - values[c] / total) < 1e-9 for c in range(m))
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9
    return got


@pytest.mark.parametrize(("n", "size", "components"), [(400, 5, 3), (300, 12, 12), (600, 40, 32), (3, 9, 2)])
def test_whitening_equals_plain_eigenvectors(spark, n, size, components):
    rng = np.random.default_rng(size)
    rows = [(i, v) for i, v in enumerate((rng.standard_normal((n, size)) * np.linspace(1, 40, size) + 5_000).tolist())]
    check_whitening(spark, rows, components)


def test_a_search_space_smaller_than_the_whole_is_cut_back_and_converges():
    rng = np.random.default_rng(0)
    size = 300
    q, _ = np.linalg.qr(rng.standard_normal((size, size)))
    values = np.concatenate([[90.0, 89.999, 89.998], np.linspace(50, 0.01, size - 3)])
    a = q * values @ q.T
    calls = []
    found, vectors = whitening.jacobi_davidson(lambda v: calls.append(v.shape[1]) or a @ v, size, 6)
    assert np.allclose(found, values[:6], rtol=1e-12) and max(calls) <= 7
    assert np.linalg.norm(a @ vectors - vectors * found, axis=0).max() < 300 * 2.3e-16 * 90 * 2
    assert np.abs(vectors.T @ vectors - np.eye(6)).max() < 1e-12
    assert np.abs(np.abs((q[:, :6] * vectors).sum(axis=0)) - 1).max() < 1e-6


def test_equal_eigenvalues_and_a_null_space():
    """Repeated values and zeros: every vector of the space is as good, residuals and the order must hold."""
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((60, 60)))
    values = np.array([5.0] * 4 + [3.0] * 6 + [0.0] * 50)
    a = (q * values) @ q.T
    found, vectors = whitening.jacobi_davidson(lambda v: a @ v, 60, 14)
    assert np.abs(found - values[:14]).max() < 1e-12
    assert np.linalg.norm(a @ vectors - vectors * found, axis=0).max() < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(14)).max() < 1e-12


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(4)
    m = rng.standard_normal((30, 30))
    a = m + m.T
    right = rng.standard_normal((30, 3))
    right[:, 2] = 0
    assert np.abs(a @ whitening.minres(lambda v: a @ v, right, 60, 1e-13) - right).max() < 1e-9


def test_rows_without_rank_nulls_lengths_and_empty_tables(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.integers(-50, 50, 4).tolist()) for i in range(30)]
    good = [(i, [float(c) for c in (*v, 2 * v[0])]) for i, v in good]  # rank four of five
    bad = [(90, None), (91, []), (92, [1.0]), (93, [None] * 5), (94, [NAN] * 5), (95, [INF] * 5)]
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whiten(make(good + bad)).collect()
    assert {r["vec_id"] for r in got} == set(range(30)) and {r["component"] for r in got} == {1, 2, 3, 4}
    assert got[0]["n"] == 30 and got[0]["identity_error"] < 1e-9
    for rows in ([], bad[:2], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5):
        assert whitening.whiten(make(rows)).count() == 0
    both = good[:10] + [good[3], (None, [1.0, 2.0, 3.0, 4.0, 5.0])]
    assert whitening.whiten(make(both), 2).count() == 24


def test_an_offset_costs_no_digits_and_extremes_no_row(spark):
    rng = np.random.default_rng(6)
    near = rng.standard_normal((200, 3)) * 4
    rows = [(i, v) for i, v in enumerate((near + 2**24).tolist())]
    check_whitening(spark, rows, 3, 1e-7)
    huge = [(i, [float(i % 3) * 1e300, float(i)]) for i in range(50)]
    got = whitening.whiten(spark.createDataFrame(huge, "vec_id long, embedding array<double>")).collect()
    assert {r["vec_id"] for r in got} == set(range(50)) and all(math.isfinite(r["whitened"]) for r in got)
    assert max(r["deviation"] for r in got) == whitening.LONG


def test_query_over_all_embeddings(spark):
    folder = "/root/testdata/sf0.001"
    got = QUERIES["op12_jacobi_davidson_whitening"](spark, folder)
    assert got.count() == 500 * 32
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    z, values, vectors, deviations = plain(rows)
    want = z @ vectors / np.sqrt(values)
    mine = np.zeros_like(want)
    at = {i: k for k, (i, _) in enumerate(rows)}
    for r in got.select("vec_id", "component", "whitened").collect():
        mine[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
    assert np.abs(mine * np.sign((mine * want).sum(axis=0)) - want).max() < 1e-7
    assert {r["vec_id"]: r["deviation"] for r in got.where("component = 1").collect()} == {i: d for (i, _), d in zip(rows, deviations, strict=True)}
    error = got.agg(F.max("identity_error")).first()[0]
    assert error < 1e-10
