"""Resuming: the ledger, a cycle that is lost at every step, models that are half written."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from test_model import OPTIONS, data, write_csv

from catalog.queries import LosingLedger, LostDriver
from factorframe import operators as ops, plans, sources, streaming
from factorframe.sources import storage


def test_ledger_keeps_results_and_refuses_other_inputs(spark, tmp_path):
    ledger = plans.Ledger(spark, str(tmp_path / "book"))
    calls = []

    def work():
        calls.append(1)
        return {"x": (1, 2), "é": float("nan")}

    first = ledger.run("a", {"path": "p", "n": (1,)}, work)
    again = plans.Ledger(spark, str(tmp_path / "book")).run("a", {"path": "p", "n": [1]}, work)
    assert calls == [1] and first["x"] == again["x"] == [1, 2] and str(first) == str(again)
    with pytest.raises(ValueError, match="was done with"):
        ledger.run("a", {"path": "q", "n": [1]}, work)
    with pytest.raises(ZeroDivisionError):
        ledger.run("b", {}, lambda: 1 / 0)
    assert ledger.steps() == ["a"] and ledger.find("b") is None
    assert [f.name for f in (tmp_path / "book").iterdir() if not f.name.endswith(".crc")] == ["a.json"]


@pytest.fixture(scope="module")
def started(spark, tmp_path_factory):
    """A dataset with a model; arrivals lie further down the scale."""
    folder = tmp_path_factory.mktemp("cycle")
    csv = write_csv(data(), folder / "first")
    df = sources.read_ratings_csv(spark, csv)

    def start(name):
        base, models = str(folder / name / "base"), str(folder / name / "models")
        for part, path in zip(ops.split_by_key(df), plans.split_paths(base)):
            sources.upsert_ratings(part, path)
        plans.train_model(spark, plans.split_paths(base)[0], models, at=datetime(2020, 1, 1, tzinfo=timezone.utc), **OPTIONS)
        later = write_csv([(i, u + 50, r, d) for i, u, r, d in data(shift=1)], folder / name / "later")
        return later, str(folder / name / "staged"), base, models, str(folder / name / "book")

    return start


def outcome(spark, report, base):
    stored = [sorted(map(str, sources.read_ratings(spark, p).collect())) for p in plans.split_paths(base)]
    return report.retrained, report.decision, report.evaluation, stored


def test_one_outcome_wherever_the_driver_is_lost(spark, started):
    later, staged, base, models, _ = started("whole")
    whole = plans.run_drift_cycle(spark, later, staged, base, models, remove_source=True, als_options=OPTIONS)
    expected = outcome(spark, whole, base)

    *paths, book = started("lost")
    arguments = dict(remove_source=True, als_options=OPTIONS)
    for step in plans.CYCLE_STEPS:
        for recorded in (False, True):
            with pytest.raises(LostDriver):
                plans.run_drift_cycle(spark, *paths, **arguments, ledger=LosingLedger(spark, book, step, recorded))
    report = plans.run_drift_cycle(spark, *paths, **arguments, ledger=book)
    assert outcome(spark, report, paths[2]) == expected
    assert len(sources.list_versions(spark, paths[3])) == 2 and sources.resolve_version(spark, paths[3]) == report.model_path
    assert plans.run_drift_cycle(spark, *paths, **arguments, ledger=book) == report
    with pytest.raises(ValueError, match="was done with"):
        plans.run_drift_cycle(spark, *paths, train_ratio=0.5, ledger=book)
    assert sources.read_ratings_if_exists(spark, plans.split_paths(paths[1])[0]) is None


def test_a_cycle_without_drift_ends_with_its_decision(spark, started):
    *paths, book = started("calm")
    calm = {"kl_threshold": 99.0, "mean_shift_threshold": 99.0, "median_shift_threshold": 99.0}
    first = plans.run_drift_cycle(spark, *paths, decision_options=calm, ledger=book)
    assert not first.retrained and first.evaluation is None
    assert plans.run_drift_cycle(spark, *paths, decision_options=calm, ledger=book) == first
    assert plans.Ledger(spark, book).steps() == ["current", "decide", "stage"]


def test_half_written_versions_are_passed_over(spark, started, tmp_path):
    *_, models, _ = started("half")
    complete = sources.resolve_version(spark, models)
    users, items = sources.read_model_factors(spark, complete)
    users.write.parquet(f"{models}/version_20990101_000000/userFactors")
    assert sources.resolve_version(spark, models) == complete
    items.write.parquet(f"{models}/version_20990101_000000/itemFactors")
    storage.delete(spark, f"{models}/version_20990101_000000/itemFactors/_SUCCESS")
    provider = streaming.LatestFactors(spark, models)
    assert sources.resolve_version(spark, models) == complete and provider()[2].rows == items.count()
    provider.release()
    storage.write_text(spark, f"{models}/version_20990101_000000/itemFactors/_SUCCESS", "")
    assert sources.resolve_version(spark, models).endswith("version_20990101_000000")
    with pytest.raises(FileNotFoundError, match="no complete"):
        sources.resolve_version(spark, str(tmp_path))


def test_save_that_fails_leaves_no_version(spark, started, monkeypatch):
    *_, models, _ = started("fails")
    model = sources.load_model(spark, models)
    before = sources.list_versions(spark, models)
    monkeypatch.setattr(storage, "rename", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        sources.save_model(model, models)
    assert storage.list_dirs(spark, models) == before
