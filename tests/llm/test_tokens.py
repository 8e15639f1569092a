"""Ids against a tokenizer that nothing has been changed on."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from factorframe.llm import packing, token_counts, tokens
from factorframe.llm.common import saved

TEXTS = [
    "a <|endoftext|> b",
    "<|endoftext|>",
    "<|endoftext|><|endoftext|>x",
    "日本 <|endoftext|> テキスト",
    "no special <|endoftext |> <|end",
    "plain words only",
    "",
    None,
    "x <|endoftext|> " * 3000,
]


@pytest.fixture(scope="module")
def untouched():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("own_file", [False, True])
def test_ids_are_those_of_the_call(untouched, own_file):
    e = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json") if own_file else None)
    for text in TEXTS:
        assert e.encode(text).tolist() == untouched.encode(text or "", add_special_tokens=False).ids
    assert 50256 in e.encode(TEXTS[0]).tolist()


def test_strict_ids_are_never_special():
    e = tokens.Encoder(strict=True)
    for text in TEXTS:
        ids = e.encode(text).tolist()
        assert 50256 not in ids and e.tokenizer.decode(ids) == (text or "")


def test_packed_pieces_have_these_ids(spark, untouched):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = packing.pack(saved(packing.pieces(docs, with_ids=True), "pieces")).collect()
    for doc_id, text in enumerate(TEXTS):
        own = sorted((r for r in rows if r["doc_id"] == doc_id), key=lambda r: r["piece"])
        assert [i for r in own for i in r["ids"]] == [*untouched.encode(text or "", add_special_tokens=False).ids, 0]
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in own)


def test_counts_are_not_split_by_special_strings(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = token_counts.count_tokens(saved(token_counts.write_blocks(docs, block_tokens=11), "blocks")).collect()
    strict = tokens.Encoder(strict=True)
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {i: len(strict.encode(t)) for i, t in enumerate(TEXTS)}
