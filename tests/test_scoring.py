from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from factorframe import operators as ops
from factorframe.operators import topk
from factorframe.operators.topk import default_slices
from factorframe.sources import factor_shape, factors as factor_tables

RANK = 6


def factor_rows(n, seed, start=0, duplicates=False):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, RANK)).astype(np.float32)
    if duplicates:
        m[n // 2 :] = m[: n - n // 2]
    return [(start + i, [float(x) for x in v]) for i, v in enumerate(m)]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(factor_rows(90, 1, duplicates=True), "id bigint, features array<float>").cache()


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(factor_rows(40, 2), "id bigint, features array<float>").cache()


def matrix(df):
    rows = sorted(df.collect())
    return [r[0] for r in rows], np.array([r[1] for r in rows], dtype=np.float64)


def best(users, items, limits, left_out):
    uid, u = matrix(users)
    iid, v = matrix(items)
    scores = (u @ v.T).astype(np.float32)
    out = {}
    for a, q in enumerate(uid):
        k = limits(q)
        order = [i for i in range(len(iid)) if iid[i] not in left_out.get(q, ())]
        order.sort(key=lambda i: (-scores[a, i], iid[i]))
        for r, i in enumerate(order[:k]):
            out[(q, iid[i])] = (float(scores[a, i]), r + 1)
    return out


def found(df):
    got = [tuple(r) for r in df.collect()]
    as_dict = {(q, i): (s, r) for q, i, s, r in got}
    assert len(as_dict) == len(got)
    return as_dict


@pytest.mark.parametrize("layout", [{}, {"block_items": 13, "slices": 3}, {"block_items": 89, "slices": 1}])
@pytest.mark.parametrize("batch", [10_000, 3])
def test_top_k_is_exact(spark, users, items, conf, layout, batch):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    queries = users.withColumnRenamed("id", "query_id").withColumn("k", (F.col("query_id") % 9).cast("int"))
    exclude = queries.select("query_id", F.explode(F.sequence(F.lit(0), F.col("query_id") * 2)).alias("item_id"))
    left_out = defaultdict(set)
    for q, i in exclude.collect():
        left_out[q].add(i)
    got = found(ops.top_k(queries, items, exclude=exclude.union(exclude), **layout))
    assert got == best(users, items, lambda q: q % 9 or 10, left_out)
    assert found(ops.top_k(queries.union(queries), items, exclude=exclude, **layout)) == got


def test_top_k_limits(spark, users, items):
    queries = users.withColumnRenamed("id", "query_id")
    assert len(found(ops.top_k(queries, items, 500))) == 40 * 90
    assert found(ops.top_k(queries, items, 0)) == found(ops.top_k(queries, items, 10))
    everything = queries.select("query_id", F.explode(F.sequence(F.lit(0), F.lit(89))).alias("item_id"))
    assert ops.top_k(queries, items, 5, everything).count() == 0
    nobody = exclude = everything.where("item_id > 1000")
    assert found(ops.top_k(queries, items, 5, nobody)) == found(ops.top_k(queries, items, 5)), exclude


def test_top_k_with_text_ids(spark, users, items):
    queries = users.select(F.concat(F.lit("job-"), "id").alias("query_id"), "features")
    got = found(ops.top_k(queries, items, 3))
    assert {(f"job-{q}", i): v for (q, i), v in best(users, items, lambda q: 3, {}).items()} == got


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    pairs=st.sets(st.tuples(st.integers(0, 45), st.integers(0, 95)), max_size=60),
    block=st.integers(5, 100),
    k=st.integers(1, 12),
)
def test_top_k_with_exclusions_is_top_k_of_the_rest(spark, users, items, pairs, block, k):
    queries = users.withColumnRenamed("id", "query_id")
    exclude = spark.createDataFrame(sorted(pairs), "query_id bigint, item_id bigint")
    left_out = defaultdict(set)
    for q, i in pairs:
        left_out[q].add(i)
    got = found(ops.top_k(queries, items, k, exclude, block_items=block, slices=2))
    assert got == best(users, items, lambda q: k, left_out)


def test_top_k_plan_has_no_cross_join(users, items):
    df = ops.top_k(users.withColumnRenamed("id", "query_id"), items, 5, block_items=20)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "MapInArrow" in plan


def test_recommend_known_users(spark, users, items):
    requests = spark.createDataFrame([(1, 3, 0), (2, 4, 2), (3, 999, 5)], "query_id bigint, user_id bigint, k int")
    got = found(ops.recommend(requests, users, items))
    assert len([q for q, _ in got if q == 1]) == 20
    assert len([q for q, _ in got if q == 2]) == 2
    assert not [q for q, _ in got if q == 3]


@pytest.fixture(params=[factor_tables.BROADCAST_BYTES, 0], ids=["broadcast", "shuffle"])
def broadcast(request, monkeypatch):
    """Both ways of joining a factor table."""
    monkeypatch.setattr(factor_tables, "BROADCAST_BYTES", request.param)


def test_predict_pairs(spark, users, items, broadcast):
    pairs = spark.createDataFrame([(1, 2), (1, 999), (999, 2), (None, 2)], "user_id bigint, item_id bigint")
    got = {(r[0], r[1]): r[2] for r in ops.predict_pairs(pairs, users, items).collect()}
    _, u = matrix(users)
    _, v = matrix(items)
    assert got[(1, 2)] == pytest.approx(float(u[1] @ v[2]), abs=1e-9)
    assert got[(1, 999)] == got[(999, 2)] == got[(None, 2)] == 0.0


def test_predict_lists(spark, users, items):
    requests = spark.createDataFrame(
        [(1, [1, 2, 1], [3, 999, 3]), (2, [1], [1, 2]), (3, [], [])],
        "query_id bigint, user_ids array<bigint>, item_ids array<bigint>",
    )
    got = {r["query_id"]: r for r in ops.predict_lists(requests, users, items).collect()}
    assert got[1]["ratings"][0] == got[1]["ratings"][2] != 0.0 and got[1]["ratings"][1] == 0.0
    assert got[2]["ratings"] is None and got[2]["error"]
    assert got[3]["ratings"] == [] and got[3]["error"] is None


@pytest.mark.parametrize("batch", [10_000, 4])
@pytest.mark.parametrize("scaled", [True, False])
def test_fold_in_matches_direct_solution(spark, items, conf, batch, scaled, broadcast):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    rng = np.random.default_rng(3)
    rows = [(int(q), int(i), float(r)) for q, i, r in zip(rng.integers(0, 12, 300), rng.integers(0, 120, 300), rng.integers(1, 6, 300))]
    rows += [(0, 5, 4.0)] * 200  # a hot query with one repeated pair
    rows += [(77, 1000, 5.0)]  # nothing usable
    feedback = spark.createDataFrame(rows, "query_id int, item_id bigint, rating double").repartition(6)
    got = {r[0]: np.array(r[1]) for r in ops.fold_in(feedback, items, scale_by_count=scaled).collect()}
    _, v = matrix(items)
    assert set(got) == {r[0] for r in rows}
    for q in set(got) - {77}:
        used = [(i, r) for p, i, r in rows if p == q and i < 90]
        m = v[[i for i, _ in used]]
        lam = 0.1 * (len(used) if scaled else 1)
        expected = np.linalg.solve(m.T @ m + lam * np.eye(RANK), m.T @ np.array([r for _, r in used]))
        assert np.allclose(got[q], expected, atol=1e-4)
    assert np.allclose(got[77], v.mean(0), atol=1e-6)


def test_fold_in_singular_uses_pseudo_inverse(spark, items):
    feedback = spark.createDataFrame([(1, 2, 3.0)], "query_id bigint, item_id bigint, rating double")
    x = np.array(ops.fold_in(feedback, items, lam=0.0).first()["features"])
    _, v = matrix(items)
    assert x @ v[2] == pytest.approx(3.0, abs=1e-4)


def test_normal_equations(spark, items):
    feedback = spark.createDataFrame([("a", 2, 3.0), ("a", 2, 1.0), ("a", 7, 5.0)], "query_id string, item_id bigint, rating double")
    row = ops.normal_equations(feedback, items).first()
    _, v = matrix(items)
    m = v[[2, 2, 7]]
    assert np.allclose(np.reshape(row["gram"], (RANK, RANK)), m.T @ m)
    assert np.allclose(row["rhs"], m.T @ np.array([3.0, 1.0, 5.0]))


def test_fold_in_and_recommend_does_not_hide_rated_items(spark, items):
    feedback = spark.createDataFrame([(1, 2, 5.0)], "query_id bigint, item_id bigint, rating double")
    requests = spark.createDataFrame([(1,), (2,)], "query_id bigint")
    got = found(ops.fold_in_and_recommend(requests, feedback, items))
    assert len(got) == 40 and (1, 2) in got


def test_factor_checks(spark, items):
    shape = factor_shape(items)
    assert (shape.rows, shape.rank) == (90, RANK)
    ragged = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "id bigint, features array<float>")
    for bad in (ragged, ragged.drop("id"), ragged.drop("features"), ragged.limit(0), ragged.selectExpr("cast(null as bigint) id", "array(1f) features")):
        with pytest.raises(ValueError):
            factor_shape(bad)


@pytest.mark.parametrize("broken", [float("nan"), float("inf"), None])
def test_a_vector_that_is_no_number_is_refused(spark, users, items, broken):
    queries = users.withColumnRenamed("id", "query_id")
    bad = items.union(spark.createDataFrame([(500, [broken] + [1.0] * (RANK - 1))], items.schema))
    with pytest.raises(ValueError, match="no finite number"):
        ops.top_k(queries, bad, 3)
    # Where the check is skipped, and in a query vector, the task refuses.
    for q, i in ((queries, bad), (bad.withColumnRenamed("id", "query_id"), items)):
        with pytest.raises(Exception, match="no finite number"):
            ops.top_k(q, i, 3, shape=factor_tables.FactorShape(91, RANK)).collect()


def test_repeated_ids_are_refused(items):
    with pytest.raises(ValueError, match="repeat an id"):
        factor_shape(items.union(items.limit(2)))


def test_a_repeated_query_has_one_answer_on_every_layout(spark, users, items):
    queries = users.withColumnRenamed("id", "query_id")
    other = queries.withColumn("features", F.transform("features", lambda x: -x))
    answers = [
        sorted(map(tuple, ops.top_k(df, items, 3, slices=s).collect()))
        for df in (queries.union(other), other.union(queries).repartition(7))
        for s in (1, 4)
    ]
    assert all(a == answers[0] for a in answers) and len(answers[0]) == 3 * 40


def test_unknown_exclusions_never_reach_a_tile(spark, users, items):
    queries = users.withColumnRenamed("id", "query_id")
    exclude = spark.range(100_000).select(F.lit(3).alias("query_id"), (F.col("id") + 50).alias("item_id"))
    plan = ops.top_k(queries, items, 5, exclude)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan.split("collect_set")[1]
    got = found(ops.top_k(queries, items, 90, exclude))
    assert {i for q, i in got if q == 3} == set(range(50))
    assert len([1 for q, _ in got if q == 4]) == 90


def test_tiles_grow_with_the_queries(spark):
    shape = factor_tables.FactorShape(10_000_000, 64)
    cores = spark.sparkContext.defaultParallelism
    assert default_slices(spark, shape, queries=10**9) == 2_000
    assert default_slices(spark, factor_tables.FactorShape(10, 4), queries=10) == 2 * cores


def test_given_shapes_save_the_checks(spark, users, items):
    pairs = spark.createDataFrame([(1, 2), (1, 999)], "user_id long, item_id long")
    shapes = {"user_shape": factor_shape(users), "item_shape": factor_shape(items)}
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("given-shapes", "")
    ops.predict_pairs(pairs, users, items, **shapes)
    assert not jobs.getJobIdsForGroup("given-shapes")


@pytest.mark.parametrize("rank, spread, k", [(8, 0.3, 10), (8, 3.0, 3), (24, 1.0, 10), (3, 0.0, 5)])
def test_tiles_stop_early_and_lose_nothing(monkeypatch, rank, spread, k):
    """Queries of many directions, zero and opposite ones too, against every product; most products are not made."""
    rng = np.random.default_rng(rank + k)
    mean = rng.normal(size=rank)
    items = (mean + spread * rng.normal(size=(9000, rank))).astype(np.float32)
    items[500:520] = items[0]  # equal scores
    queries = (mean + spread * rng.normal(size=(3000, rank))).astype(np.float32)
    queries[:7], queries[7:60] = 0.0, -queries[7:60]
    monkeypatch.setattr(topk, "_FIRST_ITEMS", 256)
    made = []
    best_known = topk._best_known
    monkeypatch.setattr(topk, "_best_known", lambda best, scores: made.append(scores.size) or best_known(best, scores))
    rows, places = np.repeat(np.arange(0, 3000, 3), 4), rng.integers(0, 9000, 4000)
    asked = pa.RecordBatch.from_pydict({"query_id": list(range(3000)), "features": list(queries), "k": pa.array([k] * 3000, pa.int32())})
    found = pa.Table.from_batches(list(topk._rank(asked, np.arange(9000), items, rows, places))).sort_by([("query_id", "ascending"), ("rank", "ascending")])
    scores = (queries.astype(np.float64) @ items.T.astype(np.float64)).astype(np.float32)
    scores[rows, places] = -np.inf
    wanted = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    assert np.allclose(found["score"].to_numpy().reshape(3000, k), np.take_along_axis(scores, wanted, axis=1), rtol=1e-5, atol=1e-6)
    pairs = set(zip(rows.tolist(), places.tolist()))
    assert not any((q, i) in pairs for q, i in zip(found["query_id"].to_pylist(), found["item_id"].to_pylist()))
    if rank == 8:
        assert sum(made) < 0.7 * scores.size


def test_blocks_hold_more_short_vectors():
    assert topk.default_block_items(factor_tables.FactorShape(10**9, 64)) == 65536
    assert topk.default_block_items(factor_tables.FactorShape(10**9, 8)) == 8 * 65536


def test_vectors_are_solved_once_for_a_batch_of_requests(spark):
    """How many tiles there are is told from the requests, not from a count that solves their vectors."""
    solved = spark.sparkContext.accumulator(0)
    from factorframe.operators import foldin

    solutions = foldin._solutions

    def counted(*args):
        solved.add(1)
        return solutions(*args)

    items = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(6)], "id long, features array<float>")
    kind = "query_id long, user_id long, feedback array<struct<item_id:long,rating:double>>, k int, exclude_item_ids array<long>"
    requests = spark.createDataFrame([(1, None, [(2, 3.0)], 2, []), (2, 3, [], 1, [])], kind).coalesce(1)
    foldin._solutions = counted
    try:
        found = ops.recommend_requests(requests, items, items)
        before = solved.value
        assert found.count() == 3 and before == 0 and solved.value > 0
    finally:
        foldin._solutions = solutions


def test_a_user_meets_the_items_once(spark, users, items, monkeypatch):
    """Many requests of a user share a list, whatever they ask for and leave out; one that leaves out much does not."""
    from factorframe.operators import scoring

    kind = "query_id string, user_id long, feedback array<struct<item_id:long,rating:double>>, k int, exclude_item_ids array<long>"
    rows = [(f"q{i}", i % 3, [], i % 7, [j * 3 for j in range(i % 5)] + [None] * (i % 2)) for i in range(60)]
    rows += [("much", 1, [], 4, list(range(70))), ("all", 2, [], 2, list(range(200))), ("unknown", 10**6, [], 3, None)]
    rows += [("new", None, [(4, 2.0)], 3, [4]), ("none", 2, [], None, None)]
    requests = spark.createDataFrame(rows, kind)
    met, top_lists = [], scoring.top_lists
    monkeypatch.setattr(scoring, "top_lists", lambda queries, *a, **o: met.append(queries) or top_lists(queries, *a, **o))
    for hot in ((), (2,)):
        met.clear()
        lists = scoring.request_lists(requests, users, items, unique=True, hot_users=hot)
        assert sorted(q.where("features is not null").count() for q in met) == [3, 3]
        assert found(scoring.list_rows(lists)) == found(ops.recommend_requests(requests, users, items, hot_users=hot))


def test_lists_of_blocks_become_one(spark, users, items):
    """Few wide blocks by default; with several, a list per query and block is all that is shuffled."""
    assert topk.wide_block_items(factor_tables.FactorShape(10**9, 64)) == 4 * 65536
    # Short queries fill a tile no more than long ones do, so that items are copied to fewer.
    short = factor_tables.FactorShape(10**9, 8)
    assert default_slices(spark, short, queries=10**9) == 250
    queries = users.withColumnRenamed("id", "query_id")
    whole = {r["query_id"]: r for r in topk.top_lists(queries, items, 7).collect()}
    parts = topk.top_lists(queries, items, 7, block_items=9)
    assert {r["query_id"]: r for r in parts.collect()} == whole and len(whole) == 40
    assert all(len(r["item_ids"]) == len(r["scores"]) == 7 for r in whole.values())
