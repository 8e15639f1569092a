"""Reports from month rows against reports from all ratings."""

from __future__ import annotations

import os
import random
from pathlib import Path

import pytest

from factorframe import operators as ops, sources


def report(row):
    return {k: pytest.approx(v, rel=1e-9) if isinstance(v, float) else v for k, v in row.asDict().items() if "median" not in k}


def random_rows(seed, n, years=(2003, 2004), high=5):
    rng = random.Random(seed)
    return [(rng.randint(1, 50), i, rng.choice([None, 7, *range(1, high + 1)]), f"{rng.choice(years)}-{rng.randint(1, 12):02d}-05") for i in range(n)]


def test_report_of_months_is_the_report_of_ratings(spark, make_ratings):
    original, current = make_ratings(random_rows(1, 900)), make_ratings(random_rows(2, 700, high=3))
    got = ops.drift_from_summaries(ops.month_summaries(original), ops.month_summaries(current)).first()
    expected = ops.data_drift(original, current).first()
    assert got.asDict().keys() == expected.asDict().keys() and report(expected) == {k: v for k, v in got.asDict().items() if "median" not in k}
    assert (got["original_median"], got["current_median"]) == (expected["original_median"], expected["current_median"])


def test_median_within_rank_error(spark):
    values = spark.range(60_000).selectExpr("cast(id % 24 + 1 as int) m", "cast(pow(id / 60000, 3) * 1000 as double) RATING")
    rows = values.selectExpr("RATING", "date_add(date'2001-01-01', m * 31) DATE").repartition(7)
    summaries = ops.month_summaries(rows)
    assert summaries.count() >= 24
    median = ops.drift_from_summaries(summaries, summaries).first()["original_median"]
    rank = rows.where(f"RATING <= {median}").count() / 60_000
    assert abs(rank - 0.5) <= 0.01


def test_only_touched_months_are_written_again(spark, make_ratings, tmp_path):
    path, summaries = str(tmp_path / "ratings"), ops.MonthSummaries(spark, str(tmp_path / "months"))
    assert summaries.read() is None
    first = make_ratings(random_rows(3, 400))
    summaries.refresh(sources.upsert_ratings(first, path))

    def times():
        return {str(p.parent): os.stat(p).st_mtime_ns for p in Path(summaries.path).glob("*/*/*.parquet")}

    before = times()
    assert len(before) == 24
    later = make_ratings([(1, 9999, 5, "2003-03-05"), (1, 9999, 5, "2007-08-01")])
    merged = sources.upsert_ratings(later, path)
    summaries.refresh(merged, [(2003, 3), (2007, 8)])
    after = times()
    changed = {k.split("months/")[1] for k in after if after[k] != before.get(k)}
    assert changed == {"year=2003/month=3", "year=2007/month=8"}
    got = ops.drift_from_summaries(summaries.read(), summaries.read()).first()
    assert got["original_total"] == merged.count() and got["kl_divergence"] == 0
    # A month without a rating any more goes.
    summaries.refresh(merged.where("year < 2007"), [(2007, 8)])
    assert set(times()) == set(before)


def test_empty_sides(spark, make_ratings):
    some, none = ops.month_summaries(make_ratings(random_rows(4, 50))), ops.month_summaries(make_ratings(random_rows(4, 5)).where("false"))
    row = ops.drift_from_summaries(some, none).first()
    assert row["current_total"] == 0 and row["current_median"] is None and list(row["current_counts"]) == [0] * 5
