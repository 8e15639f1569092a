from __future__ import annotations

import sys
from collections import Counter
from datetime import date
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from factorframe import operators as ops, sources
from factorframe.sources import storage


def rows(df, *columns):
    return Counter(tuple(r) for r in df.select(*(columns or df.columns)).collect())


KEY = ("MOVIE_ID", "CUST_ID", "RATING", "DATE")


def files_of(path: Path) -> dict[str, int]:
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_csv_drops_incomplete_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "DATE,CUST_ID,MOVIE_ID,RATING\n2005-01-01,1,2,3\n2005-01-01,x,2,3\n2005-01-02,1,2\n"
        "2005-01-03,4,5,1,9\nsoon,1,2,3\n"
    )
    got = rows(sources.read_ratings_csv(spark, str(tmp_path)), "DATE", "CUST_ID", "MOVIE_ID", "RATING")
    assert got == Counter([(date(2005, 1, 1), 1, 2, 3), (date(2005, 1, 3), 4, 5, 1)])


def test_upsert_keeps_highest_and_drops_incomplete(make_ratings, tmp_path):
    path = str(tmp_path / "r")
    first = make_ratings([(1, 1, 2, "2005-01-01"), (1, 2, None, "2005-01-01"), (None, 2, 3, "2005-01-01")])
    assert rows(sources.upsert_ratings(first, path), *KEY) == Counter([(1, 1, 2, date(2005, 1, 1))])
    later = make_ratings([(1, 1, 5, "2005-01-01"), (1, 1, 1, "2005-01-01"), (2, 2, 4, "2005-03-01")])
    expected = Counter([(1, 1, 5, date(2005, 1, 1)), (2, 2, 4, date(2005, 3, 1))])
    assert rows(sources.upsert_ratings(later, path), *KEY) == expected
    assert rows(sources.upsert_ratings(later, path), *KEY) == expected
    assert rows(sources.upsert_ratings(first, path), *KEY) == expected
    assert not [p for p in tmp_path.iterdir() if p.name.startswith(".")]


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_upsert_rewrites_only_touched_partitions(make_ratings, tmp_path, conf, aqe):
    conf("spark.sql.adaptive.enabled", aqe)
    path = tmp_path / "r"
    sources.upsert_ratings(
        make_ratings([(1, 1, 2, "2005-01-01"), (1, 1, 3, "2005-02-01"), (1, 1, 4, "2006-01-01")]), str(path)
    )
    before = files_of(path)
    merged = sources.upsert_ratings(make_ratings([(9, 9, 1, "2005-02-05")]), str(path))
    after = files_of(path)
    kept = {f for f in before if before[f] == after.get(f)}
    assert {str(Path(f).parent) for f in kept} == {"year=2005/month=1", "year=2006/month=1"}
    assert merged.count() == 4


def test_upsert_without_date_in_key_moves_rows_between_partitions(make_ratings, tmp_path):
    path = str(tmp_path / "r")
    key = ("MOVIE_ID", "CUST_ID")
    sources.upsert_ratings(make_ratings([(1, 1, 2, "2005-01-01")]), path, keys=key)
    merged = sources.upsert_ratings(make_ratings([(1, 1, 5, "2006-07-01")]), path, keys=key)
    assert rows(merged, *KEY) == Counter([(1, 1, 5, date(2006, 7, 1))])


def test_upsert_new_column_reaches_every_partition(make_ratings, tmp_path):
    path = str(tmp_path / "r")
    sources.upsert_ratings(make_ratings([(1, 1, 2, "2005-01-01")]), path)
    wider = make_ratings([(1, 1, 3, "2006-01-01")]).withColumn("source", F.lit("web"))
    merged = sources.upsert_ratings(wider, path)
    assert rows(merged, "MOVIE_ID", "RATING", "source") == Counter([(1, 2, None), (1, 3, "web")])


def test_upsert_all_cleans_a_foreign_dataset(make_ratings, tmp_path):
    path = str(tmp_path / "r")
    dirty = make_ratings([(1, 1, 2, "2005-01-01"), (1, 1, 4, "2005-01-01"), (1, 2, None, "2005-02-01")])
    sources.write_ratings(dirty, path)
    merged = sources.upsert_ratings(make_ratings([(3, 3, 3, "2006-01-01")]), path, rewrite="all")
    assert rows(merged, *KEY) == Counter([(1, 1, 4, date(2005, 1, 1)), (3, 3, 3, date(2006, 1, 1))])
    assert "month=2" not in {p.name for p in Path(path).rglob("month=*")}


def test_upsert_order_does_not_matter(make_ratings, tmp_path):
    parts = [
        [(1, 1, 2, "2005-01-01"), (2, 1, 3, "2005-02-01"), (3, 1, None, "2005-02-01")],
        [(1, 1, 5, "2005-01-01"), (2, 2, 1, "2006-02-01")],
        [(1, 1, 4, "2005-01-01"), (2, 1, 1, "2005-02-01"), (4, 4, 4, "2005-02-09")],
    ]
    results = []
    for n, order in enumerate([(0, 1, 2), (2, 1, 0), (1, 0, 2, 1)]):
        path = str(tmp_path / str(n))
        for i in order:
            merged = sources.upsert_ratings(make_ratings(parts[i]), path)
        results.append(rows(merged, *KEY))
    everything = make_ratings(sum(parts, []))
    assert results == [rows(ops.keep_max(everything.dropna()), *KEY)] * 3


def test_upsert_of_a_stored_dataset_needs_no_staging(spark, make_ratings, tmp_path):
    new, path = str(tmp_path / "new"), str(tmp_path / "r")
    sources.upsert_ratings(make_ratings([(1, 1, 5, "2005-01-01"), (2, 2, 2, "2007-01-01")]), new)
    sources.upsert_ratings(make_ratings([(1, 1, 3, "2005-01-01"), (1, 1, 3, "2006-01-01")]), path)
    before = files_of(tmp_path / "r")
    merged = sources.upsert_ratings(sources.read_ratings(spark, new), path, stage=False)
    assert sorted(r["RATING"] for r in merged.collect()) == [2, 3, 5]
    kept = {f for f, t in files_of(tmp_path / "r").items() if before.get(f) == t}
    assert {str(Path(f).parent) for f in kept} == {"year=2006/month=1"}


def test_upsert_onto_a_dataset_deduplicates_once(make_ratings, tmp_path, monkeypatch):
    """What is staged goes through the merge anyway: no aggregation and shuffle of its own."""
    path = str(tmp_path / "r")
    sources.upsert_ratings(make_ratings([(1, 1, 2, "2005-01-01")]), path)
    module, calls = sys.modules[sources.upsert_ratings.__module__], []
    keep_max = module.keep_max
    monkeypatch.setattr(module, "keep_max", lambda *a: calls.append(a) or keep_max(*a))
    later = make_ratings([(1, 1, 3, "2005-01-01"), (1, 1, 4, "2005-01-01"), (2, 1, None, "2005-02-01"), (2, 1, 1, "2005-02-01")])
    merged = sources.upsert_ratings(later, path)
    assert len(calls) == 1
    assert rows(merged, *KEY) == Counter([(1, 1, 4, date(2005, 1, 1)), (2, 1, 1, date(2005, 2, 1))])


def test_upsert_of_nothing(make_ratings, tmp_path):
    path = str(tmp_path / "r")
    empty = make_ratings([(1, 1, None, "2005-01-01")])
    assert sources.upsert_ratings(empty, path).count() == 0
    full = make_ratings([(1, 1, 2, "2005-01-01")])
    assert sources.upsert_ratings(full, path).count() == 1
    assert sources.upsert_ratings(empty, path).count() == 1
    with pytest.raises(ValueError):
        sources.upsert_ratings(full, path, rewrite="some")


def test_missing_dataset_is_none_but_other_errors_show(spark, tmp_path):
    assert sources.read_ratings_if_exists(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        sources.read_ratings_if_exists(spark, str(tmp_path / "bad")).count()


def test_partition_filter_prunes_folders(spark, make_ratings, tmp_path):
    path = str(tmp_path / "r")
    sources.write_ratings(make_ratings([(1, 1, 2, f"2005-{m:02d}-01") for m in range(1, 13)]), path)
    df = sources.read_ratings(spark, path).where("year = 2005 and month = 3").select("RATING")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "ReadSchema: struct<RATING:int>" in plan
    assert df.count() == 1


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", 20_000)
    path = tmp_path / "r"
    hot = spark.range(20_000).select(
        F.col("id").cast("int").alias("MOVIE_ID"),
        F.hash("id").alias("CUST_ID"),
        F.lit(3).alias("RATING"),
        F.lit("2005-01-01").cast("date").alias("DATE"),
    )
    sources.write_ratings(hot, str(path))
    assert len(list((path / "year=2005" / "month=1").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(path)).count() == 20_000


def test_named_table_sees_new_partitions(spark, make_ratings, tmp_path):
    path = str(tmp_path / "r")
    sources.upsert_ratings(make_ratings([(1, 1, 2, "2005-01-01")]), path, table_name="stored_ratings")
    assert spark.table("stored_ratings").count() == 1
    sources.upsert_ratings(make_ratings([(1, 1, 2, "2006-01-01")]), path, table_name="stored_ratings")
    assert spark.table("stored_ratings").count() == 2
    spark.sql("DROP TABLE stored_ratings")


@pytest.mark.parametrize("single", [True, False])
def test_replay_is_in_date_order_across_files(make_ratings, tmp_path, single):
    data = [(i % 7, i, i % 5 + 1, f"2005-{i % 12 + 1:02d}-{i % 28 + 1:02d}") for i in range(500)]
    path = tmp_path / "replay"
    sources.write_replay_csv(make_ratings([*data, (1, 1, None, "2005-01-01")]), str(path), single_file=single)
    files = sorted(path.glob("part-*.csv"))
    lines = []
    for f in files:
        header, *body = f.read_text().splitlines()
        assert header == "DATE,CUST_ID,MOVIE_ID,RATING"
        lines += body
    assert len(lines) == 500 and [x[:10] for x in lines] == sorted(x[:10] for x in lines)
    assert len(files) == 1 or not single


def test_remove_sources_only_what_is_there(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x")
    assert sources.remove_sources(spark, [str(tmp_path / "a.csv"), str(tmp_path / "none")]) == []
    assert not (tmp_path / "a.csv").exists()
    assert not storage.exists(spark, str(tmp_path / "a.csv"))


def test_keep_max_is_one_aggregation_without_window(make_ratings):
    df = ops.keep_max(make_ratings([(1, 1, 2, "2005-01-01"), (1, 1, 3, "2005-01-01")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max" in plan
    assert rows(df) == Counter([(1, 1, 3, date(2005, 1, 1))])


def test_keep_max_ties_go_to_the_latest_date(make_ratings):
    df = make_ratings([(1, 1, 3, "2005-01-01"), (1, 1, 3, "2005-05-01"), (1, 1, 2, "2006-01-01"), (1, 1, 3, None)])
    assert rows(ops.keep_max(df, ("MOVIE_ID", "CUST_ID"))) == Counter([(1, 1, 3, date(2005, 5, 1))])
    mapped = df.withColumn("m", F.create_map(F.lit("a"), F.col("RATING")))
    assert rows(ops.keep_max(mapped, ("MOVIE_ID", "CUST_ID")).drop("m")) == Counter([(1, 1, 3, date(2005, 5, 1))])


def test_split_is_stable_and_keeps_keys_together(make_ratings):
    data = [(i % 50, i, i % 5 + 1, "2005-01-01") for i in range(2000)]
    train, test = ops.split_by_key(make_ratings(data), 0.8, seed=3)
    again, _ = ops.split_by_key(make_ratings(data[::-1]).repartition(5), 0.8, seed=3)
    assert rows(train) == rows(again)
    assert train.count() + test.count() == 2000 and 1500 < train.count() < 1700
    other, _ = ops.split_by_key(make_ratings(data), 0.8, seed=4)
    assert rows(train) != rows(other)
    for ratio in (0.0, 1.0, -1, 2):
        with pytest.raises(ValueError):
            ops.split_by_key(train, ratio)


@pytest.mark.parametrize("rewrite", ["touched", "all"])
@pytest.mark.parametrize("broken_at", range(1, 9))
def test_upsert_that_breaks_off_loses_nothing(spark, make_ratings, tmp_path, monkeypatch, rewrite, broken_at):
    """The driver dies before, between or after the moves of folders; the next call finds every row."""
    path = str(tmp_path / "ratings")
    old = [(i, u, 1, f"200{y}-0{m}-01") for i in range(3) for u in range(2) for y in (4, 5) for m in (1, 2)]
    new = [(i, 9, 5, f"2005-0{m}-02") for i in range(3) for m in (1, 2)]
    sources.upsert_ratings(make_ratings(old), path)
    moves, rename = [], storage.rename

    def dying(*args):
        moves.append(args)
        if len(moves) == broken_at:
            raise KeyboardInterrupt
        rename(*args)

    monkeypatch.setattr(storage, "rename", dying)
    broke = False
    try:
        sources.upsert_ratings(make_ratings(new), path, rewrite=rewrite)
    except KeyboardInterrupt:
        broke = True
    assert broke == (len(moves) >= broken_at)
    monkeypatch.setattr(storage, "rename", rename)
    got = sources.upsert_ratings(make_ratings([(7, 7, 7, "2006-01-01")]), path)
    assert got.count() == len(old) + len(new) + 1
    assert [p.name for p in tmp_path.iterdir()] == ["ratings"]


def test_nothing_stays_behind_after_an_error(spark, make_ratings, tmp_path):
    path = str(tmp_path / "ratings")
    sources.upsert_ratings(make_ratings([(1, 1, 1, "2005-01-01")]), path)
    bad = make_ratings([(1, 2, 3, "2005-01-01")]).withColumn("RATING", F.raise_error(F.lit("no rating")).cast("int"))
    with pytest.raises(Exception, match="no rating"):
        sources.upsert_ratings(bad, path)
    assert [p.name for p in tmp_path.iterdir()] == ["ratings"] and sources.read_ratings(spark, path).count() == 1
