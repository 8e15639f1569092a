"""Sums of feedback kept between batches: increments make what one whole run makes."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from factorframe import operators as ops

RANK = 4


@pytest.fixture(scope="module")
def items(spark):
    v = np.random.default_rng(1).standard_normal((30, RANK)).astype(np.float32)
    return spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id bigint, features array<float>").cache()


def batches(spark, n=5, id_type="string"):
    rng = np.random.default_rng(2)
    rows = [(f"u{q}" if id_type == "string" else int(q), int(i), float(r), int(b)) for q, i, r, b in zip(rng.integers(0, 12, 400), rng.integers(0, 35, 400), rng.integers(-1, 6, 400), rng.integers(0, n, 400))]
    df = spark.createDataFrame(rows, f"query_id {id_type}, item_id bigint, rating double, batch int").cache()
    return df, [df.where(F.col("batch") == b).drop("batch") for b in range(n)]


def vectors(df):
    rows = df.collect()
    out = {r["query_id"]: np.array(r["features"]) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("implicit, nonnegative, id_type", [(False, False, "string"), (True, True, "bigint")])
def test_increments_equal_one_run(spark, items, tmp_path, implicit, nonnegative, id_type):
    whole, parts = batches(spark, id_type=id_type)
    sums = ops.FeedbackSums(spark, str(tmp_path / "s"), items, implicit_prefs=implicit, alpha=0.5, fan_in=3)
    for b, part in enumerate(parts):
        assert sums.add(part, b) and not sums.add(part, b)
    assert sums.parts() == [(0, 4)]
    one = {r["query_id"]: r for r in ops.packed_equations(whole.drop("batch"), items, implicit_prefs=implicit, alpha=0.5).collect()}
    many = {r["query_id"]: r for r in sums.sums().collect()}
    assert set(one) == set(many)
    for q in one:
        assert one[q]["n"] == many[q]["n"]
        assert np.allclose(one[q]["gram"], many[q]["gram"]) and np.allclose(one[q]["rhs"], many[q]["rhs"])
    options = dict(lam=0.2, scale_by_count=True, nonnegative=nonnegative)
    expected = vectors(ops.fold_in(whole.drop("batch"), items, implicit_prefs=implicit, alpha=0.5, **options))
    got = vectors(sums.solve(**options))
    assert set(got) <= set(expected) and all(np.allclose(got[q], expected[q], atol=1e-4) for q in got)
    few = spark.createDataFrame([(q,) for q in sorted(got)[:2]] * 2 + [(None,)], f"query_id {id_type}")
    again = vectors(sums.solve(few, **options))
    assert set(again) == set(sorted(got)[:2]) and all(np.allclose(again[q], got[q]) for q in again)


def test_parts_are_merged_and_read_once(spark, items, tmp_path):
    _, parts = batches(spark, 4)
    sums = ops.FeedbackSums(spark, str(tmp_path / "s"), items, fan_in=3)
    with pytest.raises(FileNotFoundError):
        sums.sums()
    seen = []
    for b, part in enumerate(parts):
        sums.add(part, b)
        seen.append(sums.parts())
    assert seen == [[(0, 0)], [(0, 0), (1, 1)], [(0, 2)], [(0, 2), (3, 3)]]
    # A merge that was lost before it cleared up leaves parts that are not read.
    before = sorted(map(str, sums.sums().collect()))
    ops.packed_equations(parts[1], items).write.parquet(f"{sums.path}/part-1-1")
    assert sums.parts() == [(0, 2), (3, 3)] and sorted(map(str, sums.sums().collect())) == before
    with pytest.raises(ValueError):
        ops.FeedbackSums(spark, str(tmp_path), items, fan_in=1)


def test_a_batch_that_completes_a_part_is_not_written_by_itself(spark, items, tmp_path, monkeypatch):
    whole, parts = batches(spark, 3)
    written = []
    write = ops.FeedbackSums._write
    monkeypatch.setattr(ops.FeedbackSums, "_write", lambda self, rows, part: (written.append(part), write(self, rows, part))[1])
    sums = ops.FeedbackSums(spark, str(tmp_path / "s"), items, fan_in=2)
    for b, part in enumerate(parts):
        new = spark.createDataFrame([(f"only{b}", 1, 2.0), (f"unknown{b}", 999, 2.0)], "query_id string, item_id bigint, rating double")
        sums.add(part.unionByName(new), b)
    assert written == [(0, 0), (0, 1), (0, 2)] and sums.parts() == [(0, 2)]
    one = {r["query_id"]: r for r in ops.packed_equations(whole.drop("batch"), items).collect()}
    many = {r["query_id"]: r for r in sums.sums().collect()}
    assert set(many) == set(one) | {"only0", "only1", "only2"}
    for q in one:
        assert one[q]["n"] == many[q]["n"] and np.allclose(one[q]["gram"], many[q]["gram"]) and np.allclose(one[q]["rhs"], many[q]["rhs"])
