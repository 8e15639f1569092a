"""Fold-in for implicit and nonnegative models: numpy, the conditions, and MLlib's own vectors."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from factorframe import operators as ops

RANK = 5


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    v = rng.standard_normal((40, RANK)).astype(np.float32)
    items = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id bigint, features array<float>").cache()
    rows = [(int(q), int(i), float(r)) for q, i, r in zip(rng.integers(0, 9, 150), rng.integers(0, 50, 150), rng.integers(-2, 6, 150))]
    rows += [(0, 3, 2.0)] * 20 + [(1, 4, 0.0), (77, 999, 4.0)]
    return items, v.astype(float), rows, spark.createDataFrame(rows, "query_id int, item_id bigint, rating double").repartition(4)


def equations(v, rows, q, implicit, alpha, lam, scaled):
    a, b, n = (v.T @ v if implicit else np.zeros((RANK, RANK))), np.zeros(RANK), 0
    for p, i, r in rows:
        if p == q and i < len(v):
            if implicit:
                a, b, n = a + alpha * abs(r) * np.outer(v[i], v[i]), b + (1 + alpha * r) * v[i] * (r > 0), n + (r > 0)
            else:
                a, b, n = a + np.outer(v[i], v[i]), b + r * v[i], n + 1
    return a + lam * (n if scaled else 1) * np.eye(RANK), b


@pytest.mark.parametrize("scaled", [False, True])
@pytest.mark.parametrize("implicit, nonnegative", [(True, False), (False, True), (True, True)])
def test_vectors_meet_their_conditions(table, implicit, nonnegative, scaled):
    items, v, rows, feedback = table
    options = dict(implicit_prefs=implicit, alpha=0.7, nonnegative=nonnegative, scale_by_count=scaled)
    got = {r[0]: np.array(r[1], float) for r in ops.fold_in(feedback, items, **options).collect()}
    assert set(got) == {r[0] for r in rows}
    assert np.allclose(got.pop(77), v.mean(0), atol=1e-6)
    for q, x in got.items():
        a, b = equations(v, rows, q, implicit, 0.7, 0.1, scaled)
        gradient = a @ x - b
        if nonnegative:
            assert (x >= 0).all() and (gradient > -1e-3).all() and np.abs(x * gradient).max() < 1e-3
        else:
            assert np.allclose(x, np.linalg.solve(a, b), atol=1e-4)


def test_nonnegative_solver_against_every_choice_of_positive_variables():
    rng = np.random.default_rng(1)
    a, b = [], []
    for _ in range(200):
        m = rng.standard_normal((6, 4))
        a.append(m.T @ m + 1e-3 * np.eye(4))
        b.append(rng.standard_normal(4) * rng.choice([0, 1, 1e3]))
    x = ops.nonnegative_solutions(np.array(a), np.array(b))
    for one, rhs, found in zip(a, b, x):
        best = 0.0
        for mask in range(1, 16):
            at = [i for i in range(4) if mask >> i & 1]
            part = np.linalg.solve(one[np.ix_(at, at)], rhs[at])
            if (part >= 0).all():
                best = min(best, -0.5 * rhs[at] @ part)
        value = 0.5 * found @ one @ found - rhs @ found
        assert (found >= 0).all() and value == pytest.approx(best, rel=1e-6, abs=1e-9)


def test_nonnegative_of_high_rank_and_of_singular_equations():
    rng = np.random.default_rng(2)
    m = rng.standard_normal((100, 80, 64))
    a, b = np.einsum("pki,pkj->pij", m, m) + 0.1 * np.eye(64), rng.standard_normal((100, 64)) * 50
    x = ops.nonnegative_solutions(a, b)
    gradient = np.einsum("pij,pj->pi", a, x) - b
    assert (x >= 0).all() and gradient.min() > -1e-8 and np.abs(x * gradient).max() < 1e-6
    assert ops.nonnegative_solutions(np.zeros((0, 3, 3)), np.zeros((0, 3))).shape == (0, 3)


def test_nonnegative_without_regularisation(spark, table):
    items, v, *_ = table
    feedback = spark.createDataFrame([(1, 2, 3.0)], "query_id bigint, item_id bigint, rating double")
    x = np.array(ops.fold_in(feedback, items, lam=0.0, nonnegative=True).first()["features"])
    assert (x >= 0).all() and x @ v[2] == pytest.approx(3.0, abs=1e-3)


@pytest.mark.parametrize("implicit, nonnegative", [(False, False), (True, False), (False, True), (True, True)])
def test_the_users_of_a_model_fold_in_to_their_own_vectors(spark, implicit, nonnegative):
    """MLlib solves the users last, so folding in its training ratings gives its user vectors."""
    rows = [(i % 20, (i * 7 + i // 20) % 25, float((i * 13) % 5 + 1 - (i % 9 == 0) * 6)) for i in range(300)]
    ratings = spark.createDataFrame(rows, "CUST_ID int, MOVIE_ID int, RATING float")
    options = dict(rank=4, max_iter=6, reg_param=0.1, implicit_prefs=implicit, nonnegative=nonnegative, num_blocks=2)
    users, items = ops.model_factors(ops.fit_factors(ratings, **options))
    feedback = ratings.select(F.col("CUST_ID").alias("query_id"), F.col("MOVIE_ID").alias("item_id"), F.col("RATING").alias("rating"))
    folded = ops.fold_in(feedback, items, lam=0.1, scale_by_count=True, implicit_prefs=implicit, nonnegative=nonnegative)
    theirs = {r["id"]: np.array(r["features"]) for r in users.collect()}
    ours = {r["query_id"]: np.array(r["features"]) for r in folded.collect()}
    assert set(ours) == set(theirs)
    for u in theirs:
        assert np.allclose(ours[u], theirs[u], atol=2e-2 if nonnegative else 1e-3), (u, ours[u], theirs[u])


@pytest.mark.parametrize("name, explodes", [("fold_in_residual", 0), ("fold_in_kinds", 2)])
def test_solutions_are_checked_without_a_row_per_dimension(spark, name, explodes):
    """Only the items' own products take a row per dimension, once per implicit kind: feedback is summed as it is."""
    from catalog.queries import QUERIES
    from conftest import TESTDATA

    found = QUERIES[name](spark, str(TESTDATA))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("posexplode(") <= explodes
    assert all(r.get("solved", r.get("met")) for r in (x.asDict() for x in found.collect()))
