"""Phrases and spelling variants: brute force on small fixtures and the smallest tables, and the awkward rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from conftest import TESTDATA

from factorframe.llm import phrases, variants

SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def given(spark):
    if not TESTDATA.exists():
        pytest.skip("the test tables are not here")
    return spark.read.parquet(str(TESTDATA / "documents.parquet"))


# --- phrases


def plain_phrases(rows, least=10, share=50, top=2000):
    total, counts = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", folded):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for size in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {p[i : i + 2] for p, a in candidates.items() if len(p) == 3 for i in (0, 1) if 100 * a >= share * f[p[i : i + 2]]}
        rows = []
        for p, a in candidates.items():
            if p not in gone:
                score, _, l, r = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


CONTRACT = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def phrase_rows(df):
    return sorted(tuple(r[c] for c in CONTRACT) for r in df.collect())


def test_phrases_as_brute_force(given):
    rows = [(r["text"], r["lang"]) for r in given.collect()]
    assert phrase_rows(phrases.collocations(given)) == plain_phrases(rows)
    assert phrase_rows(phrases.collocations(given, least=3, top=50)) == plain_phrases(rows, least=3, top=50)


@pytest.mark.parametrize("seed", range(3))
def test_phrases_of_few_words(spark, seed):
    """Few words make many repeats, overlaps, loops and unary paths."""
    rng = random.Random(seed)
    parts = ["a b", "b", "A", "a a a a", "c d e f g h", "x, y", "c d e", "é\tÉ", "."]
    rows = [(i, " ".join(rng.choices(parts, k=rng.randint(0, 30))), rng.choice(["en", None, "und"])) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for share in (50, 100, 1):
        got = phrase_rows(phrases.collocations(docs, least=5, share=share))
        assert got == plain_phrases([r[1:] for r in rows], least=5, share=share)


def test_phrase_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([(3 * 10**14, 4 * 10**14, 5 * 10**14)], "a long, l long, r long")
    row = df.select(phrases._score("a", "l", "r").alias("s")).first()
    assert row["s"] == 1000000 * (3 * 10**14) ** 2 // (4 * 10**14 * 5 * 10**14)


def test_counts_from_flow_and_ends(spark):
    docs = spark.createDataFrame([(1, "a b c a b. a b", "en"), (2, "b", "en")], SCHEMA)
    grams = phrases.longest_grams(docs, 3)
    assert {r["gram"]: r["n"] for r in grams.collect()} == {"a b c": 1, "b c a": 1, "c a b": 1, "a b": 2, "b": 3}
    assert {r["gram"]: r["n"] for r in phrases.flow(grams, 2).collect()} == {"a b": 3, "b c": 1, "c a": 1}
    assert {r["gram"]: r["n"] for r in phrases.flow(grams, 1).collect()} == {"a": 3, "b": 4, "c": 1}


@pytest.mark.parametrize("held", (1, 7, 400_000))
def test_edges_and_nodes_from_one_shuffle(spark, monkeypatch, held):
    """What ``frequent`` finds is what the flows of all grams give, wherever the batches of a task are cut."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["a", "b", "é", "c.", "d"], k=rng.randint(0, 40))), rng.choice(["en", None])) for i in range(80)]
    docs = spark.createDataFrame(rows, SCHEMA)
    grams = phrases.longest_grams(docs, 3).cache()
    triples = grams.where(phrases._size("gram") == 3).where("n >= 4")
    expected = {(size, r["lang"], r["gram"], r["n"]) for size, df in ((3, triples), (2, phrases.flow(grams, 2, 4)), (1, phrases.flow(grams, 1))) for r in df.collect()}
    monkeypatch.setattr(phrases, "HELD", held)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        found = phrases.frequent(docs, 4).groupBy("size", "lang", "gram").agg({"n": "sum"}).collect()
        parts = phrases.frequent(docs, 4).where("size > 1").count()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {tuple(r) for r in found} == expected
    assert parts == sum(size > 1 for size, *_ in expected)  # each edge and node once


def test_unary_paths_are_compacted(spark):
    long = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, long, "en"), (2, long, "en"), (3, "w10 w11 other", "en")], SCHEMA)
    grams = phrases.longest_grams(docs, 3)
    edges = phrases.compact(phrases.graph(grams, phrases.flow(grams, 2), 3, 2))
    found = {(r["phrase"], r["n"], r["n_edges"]) for r in phrases.paths(edges).collect()}
    cut = [" ".join(f"w{i}" for i in range(a, b)) for a, b in ((0, 12), (10, 40))]
    assert found == {(cut[0], 2, 10), (cut[1], 2, 28)}


# --- spelling variants


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words):
    near = defaultdict(set)
    shapes = defaultdict(set)
    for w in words:  # two words one apart share a shape: one of them, or both, without one code point
        for shape in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            shapes[shape].add(w)
    for group in shapes.values():
        for a, b in combinations(group, 2):
            if one_apart(a, b):
                near[a].add(b)
                near[b].add(a)
    forms = {}
    for w, n in words.items():
        best = min(((-words[x], x) for x in near[w]), default=(0, None))
        forms[w] = best[1] if -best[0] >= 2 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (forms[w], root, n, len(near[w]), words[forms[w]] if forms[w] else None)
    return out


def variant_rows(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_variants_as_brute_force(given):
    rows = [(r["doc_id"], r["text"]) for r in given.collect()]
    got = variant_rows(variants.spelling_variants(given))
    assert got == plain_variants(plain_words(rows))
    assert any(f is not None and f != root for f, root, *_ in got.values())


@pytest.mark.parametrize("key_words", [2, 1024])
def test_near_words_of_few_letters(spark, key_words):
    """Few letters make words with many near ones, repeated bigrams and ties; small keys are salted."""
    rng = random.Random(5)
    words = {"".join(rng.choices("abcé", k=rng.randint(5, 8))): rng.randint(3, 40) for _ in range(700)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {(r["word"], r["other"], r["n"], r["n_other"]) for r in variants.near_words(df, key_words=key_words).collect()}
    assert got == {(a, b, words[a], words[b]) for a in words for b in words if one_apart(a, b)}


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(4, 9)
        costs = [rng.randint(1, 30) for _ in range(n)]
        orders = [c * 100 + rng.randint(0, 3) for c in costs]
        rarest = sorted(range(n), key=lambda i: (orders[i], i))[:3]
        p, q = variants.pivots(orders, costs)
        assert q - p >= 2 and {p, q} <= set(rarest)
        assert costs[p] + costs[q] == min(costs[a] + costs[b] for a in rarest for b in rarest if b - a >= 2)


def test_long_chains_of_forms(spark):
    steps = [(f"w{i}", f"w{i + 1}") for i in range(40)]
    roots = variants.follow(spark.createDataFrame(steps, "word string, form string")).collect()
    assert {r["word"]: r["root"] for r in roots} == {a: "w40" for a, _ in steps}


# --- both

AWKWARD = [
    (1, None, "en"),
    (2, "", None),
    (3, " \t\n.,;", "en"),
    (None, "colour colour colour color", "en"),
    (4, "the same row twice here", "en"),
    (4, "the same row twice here", "en"),
    (5, "Größe grösse GRÖSSE × ÷ naïve " * 12, "de"),
    (6, "a long text of words without an end " * 30_000, None),
    (7, "colour " * 2 + "colours " * 9 + "kolour " * 4, "en"),
]


@pytest.mark.parametrize("clash", [False, True])
def test_awkward_texts(spark, clash):
    docs = spark.createDataFrame(AWKWARD, SCHEMA)
    if clash:
        for name in ("n", "gram", "word", "path", "key", "score", "rank"):
            docs = docs.selectExpr("*", f"'x' AS {name}")
    assert phrase_rows(phrases.collocations(docs)) == plain_phrases([r[1:] for r in AWKWARD])
    assert variant_rows(variants.spelling_variants(docs)) == plain_variants(plain_words([r[:2] for r in AWKWARD]))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    nothing = spark.createDataFrame([(1, None, None), (2, "", "en")], SCHEMA)
    for docs in (empty, nothing):
        assert phrases.collocations(docs).collect() == []
        assert variants.spelling_variants(docs).collect() == []
