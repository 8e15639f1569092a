"""The index by vector length gives the rows of top_k, and skips blocks."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from factorframe import operators as ops


def table(spark, seed, n, scales, name="id"):
    rng = np.random.default_rng(seed)
    v = (rng.standard_normal((n, 6)) * scales(rng, n)[:, None]).astype(np.float32)
    return spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], f"{name} bigint, features array<float>").repartition(3).cache()


def rows(df):
    return sorted((r["query_id"], r["rank"], r["item_id"], r["score"]) for r in df.collect())


STEEP = lambda rng, n: np.exp(rng.uniform(-6, 2, n))
EVEN = lambda rng, n: np.ones(n)


@pytest.mark.parametrize("scales", [STEEP, EVEN], ids=["steep", "even"])
@pytest.mark.parametrize("k", [1, 7, None])
def test_the_same_rows_as_top_k(spark, scales, k):
    items, queries = table(spark, 1, 600, scales), table(spark, 2, 50, EVEN, "query_id")
    if k is None:
        queries = queries.withColumn("k", (F.col("query_id") % 13 - 2).cast("int"))
    pairs = [(q, int(i)) for q in range(0, 50, 3) for i in np.random.default_rng(q).integers(0, 700, 200)]
    exclude = spark.createDataFrame(pairs, "query_id bigint, item_id bigint")
    index = ops.NormIndex.build(items, block_items=40)
    assert len(index.lengths) >= 12 and index.lengths == sorted(index.lengths, reverse=True)
    for left_out in (None, exclude):
        found = index.top_k(queries, k, left_out, slices=3)
        assert rows(found) == rows(ops.top_k(queries, items, k, left_out))
        met = found.agg(F.avg("blocks_met")).first()[0] / len(index.lengths)
        assert met < 0.6 if scales is STEEP and k != None else met <= 1  # noqa: E711


def test_all_blocks_when_there_are_too_few_items(spark):
    items, queries = table(spark, 3, 30, STEEP), table(spark, 4, 5, EVEN, "query_id")
    index = ops.NormIndex.build(items, block_items=4)
    found = index.top_k(queries, 100)
    assert rows(found) == rows(ops.top_k(queries, items, 100))
    assert {r["blocks_met"] for r in found.collect()} == {len(index.lengths)}


def test_ties_zeros_and_negative_scores(spark):
    items = spark.createDataFrame([(i, [float(i % 3), 0.0]) for i in range(60)], "id bigint, features array<float>")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [-1.0, 0.0]), (3, [0.0, 0.0]), (3, [0.0, 0.0]), (4, None), (None, [1.0, 1.0])], "query_id bigint, features array<float>")
    index = ops.NormIndex.build(items, block_items=7)
    assert rows(index.top_k(queries, 25)) == rows(ops.top_k(queries, items, 25))


def test_a_stored_index_is_opened_again(spark, tmp_path):
    items, queries = table(spark, 5, 100, STEEP), table(spark, 6, 8, EVEN, "query_id")
    built = ops.NormIndex.build(items, str(tmp_path / "index"), block_items=10)
    opened = ops.NormIndex.open(spark, str(tmp_path / "index"))
    assert opened.lengths == built.lengths and opened.shape == built.shape
    assert rows(opened.top_k(queries, 3)) == rows(ops.top_k(queries, items, 3))
    with pytest.raises(ValueError):
        ops.NormIndex.build(items.limit(0))
