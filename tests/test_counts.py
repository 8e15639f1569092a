"""Counts that the writing jobs observe."""

from __future__ import annotations

import pytest

from factorframe import plans, sources

ROWS = [(1, 1, 3, "2004-01-01"), (1, 1, 5, "2004-01-01"), (2, 1, None, "2004-01-01"), (3, 1, 2, "2005-02-01"), (3, 2, 2, None)]


def counts(got):
    return got.rows_in, got.incomplete, got.existing, got.written, got.added


def jobs(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    action()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("stage", [True, False])
def test_counts_of_upserts(spark, tmp_path, make_ratings, stage):
    path = str(tmp_path / "r")
    df, first = sources.upsert_ratings(make_ratings(ROWS).repartition(3), path, stage=stage, with_counts=True)
    assert counts(first) == (5, 2, 0, 2, 2) and df.count() == 2
    # Only the month that is touched is read back.
    later = make_ratings([(1, 1, 1, "2004-01-01"), (9, 9, 4, "2004-01-31"), (9, 9, None, "2004-01-31")])
    if not stage:
        later = later.selectExpr("*", "year(DATE) year", "month(DATE) month")
    _, second = sources.upsert_ratings(later, path, stage=stage, with_counts=True)
    assert counts(second) == (3, 1, 1, 2, 1)
    _, all_ = sources.upsert_ratings(later, path, stage=stage, rewrite="all", with_counts=True)
    assert counts(all_) == (3, 1, 3, 3, 0)
    assert sources.read_ratings(spark, path).count() == 3


def test_counts_when_nothing_is_left(spark, tmp_path, make_ratings):
    path = str(tmp_path / "r")
    nothing = make_ratings([(1, 1, None, "2004-01-01")] * 4).repartition(2)
    _, first = sources.upsert_ratings(nothing, path, with_counts=True)
    assert counts(first) == (4, 4, 0, 0, 0)
    sources.upsert_ratings(make_ratings(ROWS), path)
    _, second = sources.upsert_ratings(nothing, path, with_counts=True)
    assert counts(second) == (4, 4, 0, 0, 0)
    _, none = sources.upsert_ratings(nothing.where("false"), path, with_counts=True)
    assert counts(none) == (0, 0, 0, 0, 0)
    assert sources.read_ratings(spark, path).count() == 2


def test_no_job_is_added(spark, tmp_path, make_ratings):
    df = make_ratings(ROWS).repartition(3)
    later = make_ratings([(7, 7, 4, "2004-01-31")]).repartition(2)
    found = {}
    for name, counted in (("plain", False), ("counted", True)):
        path = str(tmp_path / name)
        found[name] = [
            jobs(spark, f"{name}{i}", lambda part=part: sources.upsert_ratings(part, path, with_counts=counted))
            for i, part in enumerate((df, later))
        ]
    assert found["plain"] == found["counted"]


def test_counts_of_plans(spark, tmp_path):
    csv = tmp_path / "in.csv"
    csv.write_text("DATE,CUST_ID,MOVIE_ID,RATING\n2004-01-01,1,1,3\n2004-01-01,1,1,4\nbad,1,1,3\n2004-01-01,2,x,3\n2004-01-02,5,6,1\n")
    base, staged = str(tmp_path / "base"), str(tmp_path / "staged")
    train, test, arrived = plans.stage_arrivals(spark, str(csv), staged, with_counts=True)
    assert (arrived.rows_in, arrived.incomplete) == (5, 2)
    assert train[1].rows_in + test[1].rows_in == 3 and train[1].written + test[1].written == 2
    merged = plans.merge_staged(spark, staged, base)
    for was, got in ((merged.train_merged, merged.train), (merged.test_merged, merged.test)):
        assert was == (got is not None)
    assert sum(c.added for c in (merged.train, merged.test) if c) == 2
    again = plans.merge_staged(spark, staged, base)
    assert sum(c.added for c in (again.train, again.test) if c) == 0
    assert sum(c.existing for c in (again.train, again.test) if c) == 2
