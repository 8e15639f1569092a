"""Chat formatting: Viterbi in slices against plain Viterbi, and the awkward rows."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pytest
from conftest import TESTDATA

from factorframe.llm import chat
from factorframe.llm.common import saved


def plain_viterbi(model, seen):
    score, back = model.start + seen[0], []
    for e in seen[1:]:
        options = score[:, None] + model.step
        back.append(options.argmax(0))
        score = options.max(0) + e
    path = [int(score.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1], score.max()


@pytest.fixture(scope="module")
def lines(spark):
    if not TESTDATA.exists():
        pytest.skip("the test tables are not here")
    return saved(chat.transcripts(spark.read.parquet(str(TESTDATA / "conversations.parquet"))), "lines")


@pytest.mark.parametrize("slice_turns", [1, 2, 64])
def test_slices_find_the_best_path(lines, slice_turns):
    model = chat.learn(lines)
    found = chat.find_roles(lines, model, slice_turns=slice_turns).toPandas()
    want = lines.select("conv", "turn", "tie", "at", *[f.alias(k) for k, f in chat._features().items()]).toPandas()
    order = ["conv", "turn", "tie", "at"]
    found, want = found.sort_values(order), want.sort_values(order)
    assert len(found) == len(want)
    for conv, rows in want.groupby("conv"):
        seen = model.emissions(rows)
        path = found[found["conv"] == conv]["state"].tolist()
        score = model.start[path[0]] + seen[0][path[0]] + sum(model.step[a, b] for a, b in zip(path, path[1:], strict=False))
        score += sum(seen[i][s] for i, s in enumerate(path) if i)
        assert abs(score - plain_viterbi(model, seen)[1]) < 1e-9


def test_roles_are_recovered(spark, lines):
    turns = chat.canonical_turns(chat.find_roles(lines, chat.learn(lines))).toPandas()
    truth = spark.read.parquet(str(TESTDATA / "conversations.parquet")).toPandas()
    merged = truth.assign(conv_id=truth["conv_id"].astype(str)).merge(turns, on=["conv_id", "turn"], suffixes=("", "_found"))
    assert len(merged) > 0.85 * len(truth) and (merged["role"] == merged["role_found"]).mean() > 0.85
    assert (turns.groupby("conv_id")["turn"].max() + 1 == turns.groupby("conv_id").size()).all()
    assert turns["rendered"].str.match(r"<\|(system|user|assistant)\|>\n").all()


def test_roles_of_held_out_conversations(spark):
    """Nothing that is measured was learnt from."""
    given = spark.read.parquet(str(TESTDATA.with_name("sf0.01") / "conversations.parquet"))
    lines = saved(chat.transcripts(given), "lines")
    unseen = lines.where(chat.held_out())
    turns = chat.canonical_turns(chat.find_roles(unseen, chat.learn(lines.where(~chat.held_out())))).toPandas()
    truth = given.toPandas()
    truth = truth[[zlib.crc32(str(c).encode()) % 5 == 0 for c in truth["conv_id"]]]
    merged = truth.assign(conv_id=truth["conv_id"].astype(str)).merge(turns, on=["conv_id", "turn"], how="left", suffixes=("", "_found"))
    assert 0.1 * given.count() < len(truth) < 0.3 * given.count() and set(turns["conv_id"]) == set(merged["conv_id"])
    assert (merged["role"] == merged["role_found"]).mean() > 0.85


def test_rows_of_one_turn_keep_one_order(spark):
    rows = [(1, 0, "user", w) for w in ("alpha", "bravo", "charlie", "delta", "echo", "echo")]
    found = set()
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        lines = chat.transcripts(spark.createDataFrame(order, "conv_id long, turn long, role string, text string").repartition(3))
        found.add(tuple(r["line"] for r in lines.orderBy("turn", "tie", "at", "line").collect()))
    assert len(found) == 1


@pytest.mark.parametrize(("first", "apart"), [(0, 1), (1, 1), (5, 100), (1_700_000_000, 64)])
def test_every_transition_is_learnt(spark, first, apart):
    """Across slices too, and from the least turn whatever the numbers are."""
    roles = ["system"] + ["user", "assistant"] * 70 + ["user"]
    texts = ["one\ntwo\nthree" if i % 3 == 0 else "one" for i in range(len(roles))]
    rows = [(c, first + apart * i, r, t) for c in (1, 2) for i, (r, t) in enumerate(zip(roles, texts, strict=True))]
    rows += [(3, first, None, "who"), (3, first + apart, "user", "me")]  # starts with nobody known
    lines = saved(chat.transcripts(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), "lines")
    n, start, step = len(chat.ROLES), np.ones(chat.STATES), np.ones((chat.STATES, chat.STATES))
    states = []
    for r, t in zip(roles, texts, strict=True):
        k = chat.ROLES.index(r)
        states += [k] + [k + n] * t.count("\n")
    start[states[0]] += 2
    for a, b in zip(states, states[1:], strict=False):
        step[a, b] += 2
    model = chat.learn(lines)
    assert np.allclose(np.exp(model.start), start / start.sum())
    assert np.allclose(np.exp(model.step), step / step.sum(1, keepdims=True))


def test_awkward_rows(spark):
    rows = [
        (1, 0, "user", "hi"),
        (1, 0, "user", "hi"),
        (1, 1, None, None),
        (1, None, "assistant", ""),
        (2, 0, "narrator", "once\n\nupon"),
        (None, 0, "user", "Q: what?"),
        (None, None, None, None),
        (3, 200, "assistant", "far\non"),
        (3, 2, "user", "near?"),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, line string, state int")
    lines = saved(chat.transcripts(frame), "lines")
    got = chat.canonical_turns(chat.find_roles(lines, chat.learn(lines))).toPandas()
    assert got["n_lines"].sum() == lines.count() and got["conv_id"].nunique() == 5
    assert {"once", "upon"} <= set("\n".join(got["text"]).split())
    none = spark.createDataFrame([], frame.schema)
    lines = saved(chat.transcripts(none), "lines")
    assert chat.canonical_turns(chat.find_roles(lines, chat.learn(lines))).count() == 0
    assert isinstance(chat.learn(lines), chat.Model) and isinstance(got, pd.DataFrame) and np.isfinite(chat.learn(lines).step).all()
