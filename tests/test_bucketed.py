"""Scoring from bucketed factor tables: the rows of predict_pairs, and no shuffle of vectors."""

from __future__ import annotations

import numpy as np
import pytest

from factorframe import operators as ops
from factorframe.operators import bucketed


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(1)
    made = []
    for name, n in (("test_bucketed_users", 300), ("test_bucketed_items", 200)):
        v = rng.standard_normal((n, 8)).astype(np.float32)
        df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id bigint, features array<float>").cache()
        ops.write_bucketed_factors(df, name, buckets=6)
        made.append((name, df))
    return made


def rows(df):
    return sorted(map(str, df.collect()))


def pairs(spark, hot=0):
    rng = np.random.default_rng(2)
    some = [(int(u), int(i), k) for k, (u, i) in enumerate(zip(rng.integers(0, 330, 900), rng.integers(0, 220, 900)))]
    some += [(None, 3, -1), (None, 3, -1), (4, None, -2), (None, None, -3), (999, 3, -4)]
    some += [(7, k % 210, 10_000 + k) for k in range(hot)]
    return spark.createDataFrame(some, "user_id int, item_id bigint, n int").repartition(5)


@pytest.mark.parametrize("hot", [0, 4000])
def test_the_rows_of_predict_pairs(spark, tables, hot):
    (user_name, users), (item_name, items) = tables
    asked = pairs(spark, hot)
    assert (7 in ops.hot_ids(asked, "user_id", 6)) == bool(hot)
    got = ops.predict_pairs_bucketed(asked, user_name, item_name)
    assert rows(got) == rows(ops.predict_pairs(asked, users, items))


def test_factor_scans_are_not_shuffled(spark, conf, tables):
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    conf("spark.sql.adaptive.enabled", "false")
    (user_name, _), (item_name, _) = tables
    plan = ops.predict_pairs_bucketed(pairs(spark), user_name, item_name)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and plan.count("Bucketed: true") == 2
    # The only shuffles are those of the pairs, by hand; the joins ask for none.
    exchanges = [x for x in plan.splitlines() if "Exchange hash" in x]
    assert "ENSURE_REQUIREMENTS" not in plan
    assert len(exchanges) == 2 and all("_place" in x and "REPARTITION_BY_NUM" in x for x in exchanges)


def test_a_table_without_buckets_is_refused(spark, tables, tmp_path):
    spark.sql("DROP TABLE IF EXISTS test_no_buckets")
    tables[0][1].write.option("path", str(tmp_path / "t")).saveAsTable("test_no_buckets")
    with pytest.raises(ValueError, match="not bucketed"):
        bucketed.bucket_count(spark, "test_no_buckets")
    with pytest.raises(ValueError):
        ops.write_bucketed_factors(tables[0][1].limit(0), "test_empty_buckets")


def test_the_table_that_fewer_pairs_find_comes_first(spark, conf, tables):
    """Only pairs that have found a vector carry one through the second shuffle."""
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    conf("spark.sql.adaptive.enabled", "false")
    (user_name, users), (item_name, items) = tables
    for few, some in (("_i", [(u, 10 * u) for u in range(300)]), ("_u", [(10 * i, i) for i in range(200)])):
        asked = spark.createDataFrame(some, "user_id long, item_id long")
        scored = ops.predict_pairs_bucketed(asked, user_name, item_name)
        exchanges = [x for x in scored._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hash" in x]
        assert f"{few}_place" in exchanges[-1]  # the innermost
        assert rows(scored) == rows(ops.predict_pairs(asked, users, items))
