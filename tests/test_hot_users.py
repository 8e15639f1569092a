"""A batch whose jobs are nearly all about one user."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from factorframe import operators as ops, streaming


@pytest.fixture(scope="module")
def factors(spark):
    v = np.random.default_rng(3).standard_normal((200, 4)).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    return spark.createDataFrame(rows, "id bigint, features array<float>").repartition(8, "id").cache()


def test_one_user_in_most_of_100_000_requests(spark, conf, factors):
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    conf("spark.sql.adaptive.enabled", "false")
    user = F.when(F.col("id") % 10 > 0, 7).when(F.col("id") % 20 == 0, F.col("id") % 331)
    requests = spark.range(100_000, numPartitions=8).select(F.col("id").alias("query_id"), user.cast("bigint").alias("user_id"))
    hot = ops.hot_ids(requests, "user_id", 8)
    assert hot == [7]
    answered = ops.user_vectors(requests.where("user_id is not null"), factors, hot)
    sizes = sorted(r["count"] for r in answered.groupBy(F.spark_partition_id()).count().collect())
    of_hot = [n for n in sizes if n > 2_000]
    assert sum(sizes) == 95_000 and max(of_hot) <= 3 * np.median(of_hot)
    assert max(n for n in sizes if n <= 2_000) <= 3 * np.median([n for n in sizes if n <= 2_000])
    plain = ops.user_vectors(requests.where("user_id is not null"), factors)
    worst = max(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect())
    assert worst > 90_000
    gap = answered.exceptAll(plain.select(answered.columns))
    assert gap.isEmpty() and answered.where("features is null").count() == plain.where("features is null").count()


@pytest.mark.parametrize("user", [7, 9999])
def test_hot_users_get_the_same_answers(spark, factors, user):
    """Known or unknown, and among requests without a user."""
    bodies = [(f"h{i}", {"user_id": user, "k": 2}) for i in range(300)] + [(f"c{i}", {"user_id": i, "k": 1}) for i in range(195, 205)]
    bodies += [("f", {"feedback": [{"item_id": 3, "rating": 4.0}], "k": 2})]
    rows = [(key, json.dumps({"job_id": key, "request": body})) for key, body in bodies]
    jobs = streaming.decode_jobs(spark.createDataFrame(rows, "key string, value string"))
    got = {(r["job_id"], r["seq"]): r for r in streaming.answer_jobs(jobs, factors, factors).collect()}
    assert len(got) == 2 * len(bodies)
    alone = streaming.decode_jobs(spark.createDataFrame(rows[:1], "key string, value string"))
    one = next(r for r in streaming.answer_jobs(alone, factors, factors).collect() if r["seq"] == 1)
    for i in range(300):
        r = got[f"h{i}", 1]
        assert (r["status"], r["items"], r["error"]) == (one["status"], one["items"], one["error"])
    assert one["status"] == ("DONE" if user == 7 else "FAILED")
    assert [got[f"c{i}", 1]["status"] for i in range(195, 205)] == ["DONE"] * 5 + ["FAILED"] * 5
    assert got["f", 1]["status"] == "DONE" and len(got["f", 1]["items"]) == 2
