"""The result table by arrival hour: merging, repeats, expiry, pruned scans."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from factorframe import streaming
from factorframe.schema import RESULT
from factorframe.sources import storage

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def results(spark, rows):
    """Rows of job, status, seq."""
    df = spark.createDataFrame(rows, "job_id string, status string, seq int")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in RESULT.fields if f.name not in df.columns]
    return df.select("*", *missing)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_random_batches_against_a_dict(spark, tmp_path):
    rng = random.Random(4)
    table = streaming.StatusTable(spark, str(tmp_path / "t"), ttl_seconds=3600, fan_in=2, shards=8)
    arrived: dict[str, tuple] = {}
    for batch in range(11):
        now = START + timedelta(minutes=25 * batch)
        rows = [(rng.choice("abcdefgh"), f"S{batch}.{seq}", seq) for seq in range(rng.randint(0, 5))]
        assert table.append(results(spark, rows), batch, now=now)
        assert not table.append(results(spark, rows), batch, now=now + timedelta(minutes=40))
        for job, status, _ in rows:
            arrived[job] = (status, now)
        expected = {j: s for j, (s, at) in arrived.items() if at >= now - timedelta(hours=1)}
        assert {r["job_id"]: r["status"] for r in table.latest(now).collect()} == expected
        table.expire(now)
        assert {r["job_id"]: r["status"] for r in table.latest(now).collect()} == expected
        some = table.find(["a", "b", "zzz"], now).collect()
        assert {r["job_id"]: r["status"] for r in some} == {j: s for j, s in expected.items() if j in "ab"}
        assert len(table.hours()) <= 3


def test_runs_grow_as_a_logarithm(spark, tmp_path):
    table = streaming.StatusTable(spark, str(tmp_path / "t"), fan_in=2, shards=4)
    for batch in range(7):
        table.append(results(spark, [("a", f"S{batch}", 0), ("b", "x", 0)]), batch, now=START)
    (hour,) = table.hours()
    assert [r.name for r in table.current_runs(hour)] == ["level2-0-3", "level1-4-5", "level0-6-6"]
    assert table.live(START).count() == 6
    assert {r["job_id"]: (r["status"], r["batch"]) for r in table.latest(START).collect()} == {"a": ("S6", 6), "b": ("x", 6)}


def test_scan_is_pruned_to_live_hours_and_current_runs(spark, conf, tmp_path):
    conf("spark.sql.maxMetadataStringLength", 5000)
    table = streaming.StatusTable(spark, str(tmp_path / "t"), ttl_seconds=3600, fan_in=2)
    for batch in range(6):
        table.append(results(spark, [(j, "DONE", 0) for j in "abc"]), batch, now=START + timedelta(hours=batch // 2))
    now = START + timedelta(hours=2)
    rows = table.live(now)
    folders = {f.split("hour=")[1].rsplit("/", 1)[0] for f in rows.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    first = int(START.timestamp()) // 3600
    assert folders == {f"{first + 1}/run=level1-2-3", f"{first + 2}/run=level1-4-5"}
    assert "PartitionFilters: [" in plan(rows) and "run#" in plan(rows).split("PartitionFilters: [")[1].split("]")[0]
    found = plan(table.find(["a"], now))
    assert "In(job_id" in found or "EqualTo(job_id,a)" in found
    assert "EqualTo(shard" in found or "In(shard" in found


def test_a_broken_off_write_leaves_nothing(spark, tmp_path):
    table = streaming.StatusTable(spark, str(tmp_path / "t"), ttl_seconds=3600)
    assert table.latest(START) is None and table.hours() == []
    bad = results(spark, [("a", "DONE", 0)]).withColumn("seq", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        table.append(bad, 0, now=START)
    assert table.hours() == [] and table.latest(START) is None
    # What a lost driver left aside is no run, and goes with the next expiry.
    results(spark, [("a", "DONE", 0)]).write.parquet(str(tmp_path / "t" / ".aside-level0-0-0-x"))
    assert table.append(results(spark, [("a", "RUNNING", 0)]), 0, now=START)
    table.expire(START)
    assert [d for d in storage.list_dirs(spark, str(tmp_path / "t")) if d.startswith(".")] == []
    assert [r["status"] for r in table.latest(START).collect()] == ["RUNNING"]


def test_merge_that_broke_off_is_done_by_the_next_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    streaming.StatusTable(spark, path, fan_in=100).append(results(spark, [("a", "S0", 0)]), 0, now=START)
    streaming.StatusTable(spark, path, fan_in=100).append(results(spark, [("a", "S1", 0)]), 1, now=START)
    table = streaming.StatusTable(spark, path, fan_in=2)
    table.append(results(spark, [("b", "S2", 0)]), 2, now=START)
    (hour,) = table.hours()
    assert [r.name for r in table.current_runs(hour)] == ["level1-0-1", "level0-2-2"]


def test_messages_into_the_table(spark, tmp_path):
    table = streaming.StatusTable(spark, str(tmp_path / "t"))
    rows = [
        (0, "a", json.dumps({"job_id": "a", "status": "RUNNING"})),
        (1, "a", json.dumps({"job_id": "a", "status": "FAILED", "error": "no"})),
        (2, "b", "{"),
    ]
    store = table.message_sink()
    store(spark.createDataFrame(rows, "offset bigint, key string, value string"), 0)
    latest = table.latest()
    assert {r["job_id"]: (r["status"], r["error"]) for r in latest.collect()} == {"a": ("FAILED", "no")}
    ids = spark.createDataFrame([("a",), ("b",)], "job_id string")
    assert {r["job_id"]: r["status"] for r in streaming.lookup_status(ids, latest).collect()} == {"a": "FAILED", "b": "PENDING"}


def test_parameters_are_checked(spark, tmp_path):
    for wrong in ({"fan_in": 1}, {"shards": 0}, {"ttl_seconds": 0}):
        with pytest.raises(ValueError):
            streaming.StatusTable(spark, str(tmp_path), **wrong)
