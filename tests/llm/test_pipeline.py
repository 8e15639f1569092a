"""The pipeline, stage by stage, against plain versions on a small corpus."""

from __future__ import annotations

import pytest
from conftest import TESTDATA
from test_documents import check_packing, plain_components, plain_language

import corpus_pipeline
from factorframe.llm import language_id, stages, tokens
from factorframe.llm.common import saved


@pytest.fixture(scope="module")
def outputs(spark):
    if not TESTDATA.exists():
        pytest.skip("the test tables are not here")
    docs = spark.read.parquet(str(TESTDATA / "documents.parquet"))
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(saved(stage(spark, out[-1], str(TESTDATA)), name))
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages(outputs):
    docs, known, cut, one, clean, packed = outputs
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "minhash_near_dup", "benchmark_decontamination", "best_fit_packing"]
    for df in (known, cut, one, clean):
        assert df.columns == docs.columns
    profiles = language_id.learn_profiles(docs.where(~language_id.held_out(docs["doc_id"])))
    want = {i for i, r in rows(docs).items() if (p := plain_language(r["text"], profiles))[0] != "und" and p[1] >= language_id.LEAST_SCORE}
    assert set(rows(known)) == want

    seen, left = set(), {}
    for i, r in sorted(rows(known).items()):
        parts = r["text"].split("\n")
        full = [(k, x.strip(" \t\r\f\v")) for k, x in enumerate(parts) if x.strip(" \t\r\f\v")]
        gone = set()
        for three in zip(full, full[1:], full[2:], strict=False):
            body = tuple(x for _, x in three)
            if body in seen:
                gone |= {k for k, _ in three}
            seen.add(body)
        text = "\n".join(x for k, x in enumerate(parts) if k not in gone)
        if not gone or text.split():
            left[i] = text
    assert {i: r["text"] for i, r in rows(cut).items()} == left

    groups = plain_components(left.items(), 5, 80)
    assert set(rows(one)) == {i for i, (_, c) in groups.items() if c == i}
    assert set(rows(clean)) <= set(rows(one)) and len(rows(one)) - len(rows(clean)) <= 5

    pieces = packed.collect()
    check_packing(pieces, 2048)
    encode = tokens.Encoder().tokenizer
    assert {r["doc_id"] for r in pieces} == set(rows(clean))
    assert sum(r["length"] for r in pieces) == sum(len(encode.encode(r["text"], add_special_tokens=False).ids) + 1 for r in rows(clean).values())


def test_run_gives_the_last_stage(spark, outputs):
    got = corpus_pipeline.run(spark, str(TESTDATA))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, outputs[-1].select(columns).collect()))


def test_awkward_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, n_lines string"
    text = "words of a line here\nand of another line\nand of the third line"
    rows_ = [(1, text, "en", None, None), (1, text, "en", None, None), (None, text, None, "a", 3), (2, None, "en", "a", 0), (3, "", None, None, 0), (4, "..", "en", "b", 2)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows_], schema)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = saved(stage(spark, docs, str(TESTDATA)), name)
        assert docs.columns == columns
    assert sorted(str(r["doc_id"]) for r in docs.collect()) in (["1"], ["None"], ["1", "None"])
    none = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(TESTDATA)).count() == 0
    assert stages.pack_sequences(spark, docs, "").count() >= 1
