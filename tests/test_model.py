from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from factorframe import operators as ops, plans, sources

OPTIONS = {"rank": 4, "max_iter": 3, "num_blocks": 2}


def data(n=900, shift=0):
    """Users and items of two tastes; ``shift`` moves the later ratings down."""
    rows = []
    for i in range(n):
        user, item = i % 30, (i * 7 + i // 30) % 25
        rating = 5 if (user + item) % 2 == 0 else 2
        rows.append((item, user, max(1, rating - shift), f"2005-{i % 9 + 1:02d}-{i % 28 + 1:02d}"))
    return rows


@pytest.fixture(scope="module")
def ratings(spark):
    df = spark.createDataFrame(data(), "MOVIE_ID int, CUST_ID int, RATING int, DATE string")
    return df.withColumn("DATE", F.to_date("DATE")).cache()


@pytest.fixture(scope="module")
def model(ratings):
    return ops.fit_factors(ratings, **OPTIONS)


def test_fit_is_repeatable(ratings, model):
    again = ops.fit_factors(ratings, **OPTIONS)
    first, second = (sorted(map(str, m.userFactors.collect())) for m in (model, again))
    assert first == second


def test_transform_drops_unknown_and_pairs_give_zero(spark, ratings, model):
    users, items = ops.model_factors(model)
    pairs = spark.createDataFrame([(0, 0), (0, 999), (999, 0)], "CUST_ID int, MOVIE_ID int")
    scored = ops.score_ratings(model, pairs).collect()
    assert len(scored) == 1
    ours = {(r[0], r[1]): r[2] for r in ops.predict_pairs(pairs, users, items, user="CUST_ID", item="MOVIE_ID").collect()}
    assert ours[(0, 0)] == pytest.approx(scored[0]["prediction"], abs=1e-5)
    assert ours[(0, 999)] == ours[(999, 0)] == 0.0


def test_own_top_k_agrees_with_the_model(ratings, model):
    some = ratings.where("CUST_ID < 12").select("CUST_ID")
    theirs = ops.flatten_recommendations(model.recommendForUserSubset(some, 5))
    theirs = sorted((r["CUST_ID"], round(r["score"], 4)) for r in theirs.collect())
    ours = ops.recommend_for_users(model, some.union(ratings.selectExpr("CUST_ID + 1000")), 5)
    assert theirs == sorted((r["CUST_ID"], round(r["score"], 4)) for r in ours.collect())


def test_evaluate(ratings, model):
    row = ops.evaluate(model, ratings.union(ratings.limit(1).withColumn("RATING", F.lit(None).cast("int"))), k=5)
    row = row.first()
    assert row["test_ratings_count"] == 900 and row["model_rank"] == 4 and row["k"] == 5
    assert 0 < row["mae"] <= row["rmse"] < 2
    for metric in ("precision_at_5", "recall_at_5", "ndcg_at_5"):
        assert 0 < row[metric] <= 1


def test_versions(spark, model, tmp_path):
    base = str(tmp_path / "models")
    assert sources.list_versions(spark, base) == []
    with pytest.raises(FileNotFoundError):
        sources.resolve_version(spark, base)
    start = datetime(2025, 9, 30, 21, 23, 27, tzinfo=timezone.utc)
    paths = [sources.save_model(model, base, at=start + timedelta(days=d)) for d in (1, 0)]
    (tmp_path / "models" / "other").mkdir()
    assert sources.resolve_version(spark, base) == paths[0]
    assert sources.version_timestamp(paths[1]) == "20250930_212327"
    assert sources.resolve_version(spark, base, "version_20250930_212327") == paths[1]
    with pytest.raises(FileNotFoundError, match="version_x"):
        sources.resolve_version(spark, base, "version_x")
    assert sources.load_model(spark, base).rank == 4
    assert sources.load_model(spark, path=paths[1]).rank == 4
    assert sources.is_complete(spark, paths[0])
    assert not sources.is_complete(spark, f"{base}/other")
    assert sources.compile_manifests(spark, base) == sorted(paths)
    row = sources.compile_manifest(spark, paths[0]).first()
    assert tuple(row) == (30, 25, 4, "id", "id", "version_20251001_212327")
    assert sources.compile_manifests(spark, base, "version_20250930_212327", force=True) == [paths[1]]


def write_blocks(spark, rows, path):
    lines, item = [], None
    for row in sorted(rows):
        if row[0] != item:
            item = row[0]
            lines.append(f"{item}:")
        lines.append(",".join(map(str, row[1:])))
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def write_csv(rows, path):
    path.mkdir()
    text = "".join(f"{d},{u},{i},{r}\n" for i, u, r, d in rows)
    (path / "a.csv").write_text("DATE,CUST_ID,MOVIE_ID,RATING\n" + text)
    return str(path)


def test_lifecycle(spark, tmp_path):
    base, staged, models = (str(tmp_path / n) for n in ("base", "staged", "models"))
    rows = data()
    first = plans.run_initial(
        spark,
        write_blocks(spark, rows[:700], tmp_path / "train.txt"),
        write_blocks(spark, rows[700:], tmp_path / "test.txt"),
        base,
        models,
        future_file=write_blocks(spark, rows[:50], tmp_path / "future.txt"),
        replay_path=str(tmp_path / "replay"),
        als_options=OPTIONS,
    )
    assert first.retrained and first.evaluation["rmse"] > 0
    assert sources.read_ratings_csv(spark, str(tmp_path / "replay")).count() == 50

    same = write_csv([(i, u + 100, r, d) for i, u, r, d in rows], tmp_path / "same")
    calm = plans.run_drift_cycle(spark, same, str(tmp_path / "calm"), base, models, decision_options={"kl_threshold": 5.0, "mean_shift_threshold": 5.0, "median_shift_threshold": 5.0})
    assert not calm.retrained and calm.model_path == first.model_path and calm.evaluation is None

    before = sources.read_ratings(spark, f"{base}/train").count()
    later = write_csv([(i, u + 50, r, d) for i, u, r, d in data(shift=1)] , tmp_path / "later")
    cycle = plans.run_drift_cycle(spark, later, staged, base, models, remove_source=True, als_options=OPTIONS)
    assert cycle.retrained and cycle.decision["reasons"]
    assert sources.read_ratings(spark, f"{base}/train").count() > before
    assert not (tmp_path / "later").exists() and not (tmp_path / "staged" / "train").exists()
    assert plans.merge_staged(spark, staged, base) == plans.MergeReport(False, False)


def test_drift_without_model(spark, ratings, tmp_path):
    base, staged = str(tmp_path / "base"), str(tmp_path / "staged")
    for folder in (base, staged):
        sources.write_ratings(ratings, f"{folder}/train")
    report = plans.detect_drift(spark, base, staged)
    assert report.columns == ["data_drift"] and report.first()["data_drift"]["kl_divergence"] == 0.0


def test_stream_of_arrivals_equals_batch(spark, tmp_path):
    source = write_csv(data(200), tmp_path / "in")
    batch, stream = str(tmp_path / "batch"), str(tmp_path / "stream")
    plans.stage_arrivals(spark, source, batch)
    for _ in range(2):
        plans.stage_arrivals_stream(spark, source, stream, str(tmp_path / "checkpoint")).awaitTermination()
    for one, other in zip(plans.split_paths(batch), plans.split_paths(stream)):
        got = [sorted(map(str, sources.read_ratings(spark, p).collect())) for p in (one, other)]
        assert got[0] == got[1] and got[0]


def test_held_out_ratings_are_read_as_they_are_stored(spark):
    """Queries read them several times: no job but the first joins and cleans all ratings."""
    from catalog import queries, views

    model, test = queries.fitted(spark, "/root/testdata/sf0.001")
    plan = test._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    _, wanted = ops.split_by_key(ops.keep_max(views.ratings(spark, "/root/testdata/sf0.001")))
    assert test.exceptAll(wanted.select(test.columns)).isEmpty() and test.count() == wanted.count()
