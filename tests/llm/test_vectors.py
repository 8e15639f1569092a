"""Nearest neighbours: recall and scores against brute force, bounds, and the awkward rows."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import TESTDATA

from factorframe.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k=20, every=20):
    """(query_id, rank) -> (vec_id, score), for unique ids."""
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], float)
    out = {}
    for at in np.flatnonzero(ids % every == 0):
        scores = vectors @ vectors[at]
        order = [x for x in np.lexsort((ids, -scores)) if x != at][:k]
        out |= {(int(ids[at]), rank): (int(ids[x]), scores[x]) for rank, x in enumerate(order, 1)}
    return out


def found(df):
    rows = df.collect()
    out = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in rows}
    assert len(out) == len(rows)
    return out


def recall(got, expected):
    wanted = {(q, v) for (q, _), (v, _) in expected.items()}
    return len(wanted & {(q, v) for (q, _), (v, _) in got.items()}) / len(wanted)


def test_given_vectors(spark):
    if not TESTDATA.exists():
        pytest.skip("the test tables are not here")
    rows = spark.read.parquet(str(TESTDATA / "embeddings.parquet"))
    got, expected = found(neighbours.nearest_neighbours(rows)), plain([(r["vec_id"], r["embedding"]) for r in rows.collect()])
    assert recall(got, expected) >= 0.99
    assert set(got) == set(expected)
    assert max(abs(got[x][1] - expected[x][1]) for x in got) < 1e-2  # a missed neighbour moves the ranks below it


@pytest.mark.parametrize("block", [300, 65_536])
def test_clustered_vectors_with_lengths(spark, block):
    """Different lengths, many cells and blocks, copies of one vector."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 24)) * 3
    vectors = centres[rng.integers(0, 12, 6000)] + rng.standard_normal((6000, 24)) * rng.uniform(0.1, 2, (6000, 1))
    vectors[1000:1400] = vectors[1000]
    vectors = vectors.astype(np.float32)
    rows = list(enumerate(vectors.tolist()))
    df = neighbours.usable(spark.createDataFrame(rows, SCHEMA).repartition(4), "vec_id", "embedding")
    codes = neighbours.fit(df, sample=2048)
    index = neighbours.build_index(df, codes, block=block)
    assert index.parts.sum() == index.blocks.count() and len(codes.centres) == 16
    got = found(neighbours.search(index, df.where("vec_id % 20 = 0")).drop("query_hash"))
    expected = plain(rows)
    assert recall(got, expected) >= 0.99
    same = np.array(rows[1000][1])
    copies = [v for (q, r), (v, s) in sorted(got.items()) if q == 1000 and np.isclose(s, same @ same, rtol=1e-6)]
    assert copies == sorted(copies)


def test_estimates_keep_to_their_bound():
    """Unbiased over random rotations, and within three deviations but for one in a thousand or so."""
    rng = np.random.default_rng(0)
    vectors = rng.standard_normal((1000, 32))
    query = rng.standard_normal(32)
    inside, mean = [], []
    for _ in range(40):
        rotation = np.linalg.qr(rng.standard_normal((128, 128)))[0][:32]
        codes = neighbours.Codes(rotation, vectors[:4], vectors[:4])
        cells = codes.cell_of(vectors)
        bits, scale, error, length = codes.encode(vectors, cells)
        signs = np.unpackbits(bits, axis=1) * 2.0 - 1
        off = codes.centres[cells] @ query + (signs * scale[:, None]) @ (query @ rotation) - vectors @ query
        inside.append((np.abs(off) <= 3 * error * np.linalg.norm(query) + 1e-9).mean())
        mean.append(off.mean())
        assert np.allclose(length, np.linalg.norm(vectors - codes.centres[cells], axis=1))
    assert np.mean(inside) > 0.995
    assert abs(np.mean(mean)) < 4 * np.std(mean) / np.sqrt(len(mean))


NAN, INF = float("nan"), float("inf")
ROWS = [
    (0, [1.0, 0.0]),
    (0, [1.0, 0.0]),
    (1, [0.5, 0.5]),
    (2, None),
    (3, []),
    (4, [0.0, 0.0]),
    (5, [1.0, None]),
    (6, [NAN, 1.0]),
    (7, [INF, 1.0]),
    (8, [0.5, 0.5]),
    (9, [1.0, 2.0, 3.0]),
    (None, [9.0, 9.0]),
    (-20, [-1.0, 0.25]),
    (20, [2.0, -1.0]),
    (40, None),
]


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("clash", [False, True])
def test_awkward_vectors(spark, kind, clash):
    rows = spark.createDataFrame(ROWS, f"vec_id long, embedding array<{kind}>")
    if clash:
        for name in ("vector", "hash", "cell", "block", "rank", "score", "query_id"):
            rows = rows.selectExpr("*", f"'x' AS {name}")
    good = {0: [1.0, 0.0], 1: [0.5, 0.5], 8: [0.5, 0.5], -20: [-1.0, 0.25], 20: [2.0, -1.0]}
    assert found(neighbours.nearest_neighbours(rows)) == plain(sorted(good.items()))


def test_two_vectors_under_one_id(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 1.0])], SCHEMA)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in neighbours.nearest_neighbours(rows).collect())
    assert got == [(0, 1, 1, 1.0), (0, 1, 1, 1.0), (0, 2, 0, 0.0), (0, 2, 0, 0.0)]


def test_no_vectors(spark):
    for rows in ([], [(0, None), (20, [0.0])]):
        assert neighbours.nearest_neighbours(spark.createDataFrame(rows, SCHEMA)).collect() == []
