"""Merging by files: what is rewritten and what is not, commits, broken-off merges, clearing up."""

from __future__ import annotations

import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from factorframe import sources
from factorframe.sources import storage


def stored(df):
    return sorted((r["MOVIE_ID"], r["CUST_ID"], str(r["DATE"]), r["RATING"]) for r in df.collect())


def best(*batches):
    out = {}
    for rows in batches:
        for item, user, rating, date in rows:
            if None not in (item, user, rating, date):
                out[item, user, date] = max(rating, out.get((item, user, date), rating))
    return sorted((*k, v) for k, v in out.items())


def times(table):
    """Modification times of the live files."""
    root = Path(table.path) / "data"
    return {f: os.stat(root / f).st_mtime_ns for f in table.files()}


@pytest.fixture
def table(spark, tmp_path):
    return sources.VersionedRatings(spark, str(tmp_path / "ratings"))


def test_random_merges_against_a_dict(spark, table, make_ratings):
    rng = random.Random(2)
    batches = []
    for _ in range(4):
        rows = [
            (rng.randint(1, 6), rng.randint(1, 6), rng.choice([1, 2, 3, 4, 5, None]), f"200{rng.randint(4, 5)}-0{rng.randint(1, 2)}-1{rng.randint(0, 3)}")
            for _ in range(60)
        ]
        batches.append(rows + [(None, 1, 1, "2004-01-01")])
        table.merge(make_ratings(batches[-1]).repartition(3))
        assert stored(table.read()) == best(*batches)
    for commit in table.commits():
        assert stored(table.read(commit)) == best(*batches[:commit])
    parts = table.read().select("DATE", "year", "month")
    assert parts.where("year <> year(DATE) OR month <> month(DATE)").count() == 0


def test_only_files_with_a_risen_rating_are_rewritten(spark, conf, table, make_ratings):
    conf("spark.sql.files.maxRecordsPerFile", 700)  # several files a month
    rows = [(i, u, 3, f"2005-0{1 + u % 2}-01") for i in range(300) for u in range(20)]
    first = table.merge(make_ratings(rows))
    before = times(table)
    assert first.replaced == 0 and first.added == len(before) >= 6
    last_write = max(before.values())

    one = table.merge(make_ratings([(7, 4, 5, "2005-01-01"), (8, 4, 1, "2005-01-01")]))
    after = times(table)
    assert (one.replaced, one.added) == (1, 1)
    assert len(set(before) - set(after)) == 1 and len(set(after) - set(before)) == 1
    assert all(after[f] == before[f] for f in set(before) & set(after))
    assert one.untouched == sum("month=1" in f for f in before) - 1
    assert stored(table.read()) == best(rows, [(7, 4, 5, "2005-01-01")])

    inserted = table.merge(make_ratings([(9999, 4, 2, "2005-01-01"), (9999, 4, 2, "2011-03-01")]))
    assert (inserted.replaced, inserted.added) == (0, 2)
    assert set(after) <= set(times(table))
    nothing = table.merge(make_ratings([(7, 4, 2, "2005-01-01"), (9999, 4, 2, "2011-03-01")]))
    assert (nothing.replaced, nothing.added) == (0, 0)
    assert last_write == max(before.values())


def test_filters_prune_files(spark, conf, table, make_ratings):
    conf("spark.sql.maxMetadataStringLength", 5000)
    table.merge(make_ratings([(1, 1, 3, "2004-01-01"), (1, 1, 3, "2005-02-01"), (2, 1, 3, "2005-03-01")]))
    some = table.read().where("year = 2005 AND month = 2")
    assert "PartitionFilters: [isnotnull(year" in some._jdf.queryExecution().executedPlan().toString()
    assert some.select(F.input_file_name()).distinct().count() == 1
    assert table.read(months=[(2005, 2), (1999, 1)]).count() == 1
    assert len(table.files(months=[(2005, 2)])) == 1


def test_merge_that_breaks_off_changes_nothing(spark, table, make_ratings, monkeypatch):
    rows = [(1, 1, 3, "2004-01-01"), (2, 1, 3, "2005-02-01")]
    table.merge(make_ratings(rows))
    later = make_ratings([(1, 1, 5, "2004-01-01"), (3, 1, 4, "2004-01-01")])
    write = storage.write_text

    def lost(spark, path, text):
        if "root-" in path:
            raise OSError("lost")
        write(spark, path, text)

    monkeypatch.setattr(storage, "write_text", lost)
    with pytest.raises(OSError, match="lost"):
        table.merge(later)
    monkeypatch.undo()
    assert table.commits() == [1] and stored(table.read()) == best(rows)
    assert table.vacuum(1) == []  # the next merge deletes what the lost one wrote
    counts = table.merge(later)
    assert counts.commit == 2 and stored(table.read()) == best(rows, [(1, 1, 5, "2004-01-01"), (3, 1, 4, "2004-01-01")])
    assert [p.name for p in Path(table.path).parent.iterdir()] == ["ratings"]


def test_vacuum_keeps_what_kept_commits_name(spark, table, make_ratings):
    batches = [[(1, u, 1 + n, "2004-01-01") for u in range(5)] + [(2, n, 1, f"200{n}-05-05")] for n in range(4)]
    for rows in batches:
        table.merge(make_ratings(rows))
    expected = {c: stored(table.read(c)) for c in (3, 4)}
    gone = table.vacuum(2)
    assert len(gone) == 2 and table.commits() == [3, 4]
    assert {c: stored(table.read(c)) for c in (3, 4)} == expected
    on_disk = {str(p.relative_to(Path(table.path) / "data")) for p in Path(table.path).glob("data/**/*.parquet")}
    assert on_disk == set(table.files(3)) | set(table.files(4))
    with pytest.raises(FileNotFoundError):
        table.read(1)
    with pytest.raises(ValueError):
        table.vacuum(0)


def test_empty_tables_and_merges(spark, table, make_ratings):
    assert table.read().count() == 0 and table.vacuum() == []
    none = make_ratings([(1, 1, 3, "2004-01-01")]).where("false")
    assert table.merge(none) == sources.MergeCounts(1, 0, 0, 0)
    assert table.read().columns == ["MOVIE_ID", "CUST_ID", "DATE", "RATING", "year", "month"]
    table.merge(make_ratings([(1, 1, 3, "2004-01-01")]))
    assert table.merge(none).untouched == 0 and table.read().count() == 1


def test_changes_take_one_join_and_no_file_names(spark, table, make_ratings, monkeypatch):
    """The rows that are new come from the join that finds the risen ones; names of files move as numbers."""
    table.merge(make_ratings([(1, u, 3, "2000-01-02") for u in range(20)]))
    seen = []
    changes = type(table)._changes

    def spied(self, staged, before, matched_path):
        replaced, changed = changes(self, staged, before, matched_path)
        seen.append((spark.read.parquet(matched_path).schema["file"].dataType.simpleString(), changed._jdf.queryExecution().optimizedPlan().toString()))
        return replaced, changed

    monkeypatch.setattr(type(table), "_changes", spied)
    counts = table.merge(make_ratings([(1, 3, 5, "2000-01-02"), (1, 4, 1, "2000-01-02"), (2, 3, 4, "2000-01-03")]))
    assert (counts.replaced, table.read().count()) == (1, 21)
    (kind, plan), = seen
    assert kind == "bigint" and "LeftAnti" not in plan
    assert table.read().agg({"RATING": "sum"}).first()[0] == 20 * 3 + 2 + 4
