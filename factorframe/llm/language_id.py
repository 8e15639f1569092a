"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent character n-grams. A document's own
most frequent n-grams are compared to each profile by the out-of-place distance: for every
one of them, how many places apart the two ranks are, or the length of the list if the
profile lacks it. The smallest distance wins.

Defined results: a null text and one without a letter are ``und`` with score 0, as is every
text when no profile could be learnt. Ties between languages go to the first by name, ties in
frequency to the smaller n-gram. Repeated rows are predicted alike. A null doc_id counts as not held out
and teaches nothing. Columns other than doc_id, text and (for learning) lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from factorframe.llm.common import table

UNKNOWN = "und"
#: N-grams in a profile and of a document.
PROFILE_SIZE = 300
#: Labelled documents to learn a language from, about: a hash of the id picks them.
SAMPLE_PER_LANGUAGE = 2_000
#: Texts that score less are like no language known: hardly any of their n-grams is in a profile.
LEAST_SCORE = 0.15
#: More languages than this are refused, so that the profiles are small.
MOST_LANGUAGES = 2_000
_EDGE = 1  # stands before, between and after words


@cache
def _letters() -> np.ndarray:
    """By code point: the lower-case letter's code point, 0 for what is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    return out


def ranked_grams(text: str | None, size: int | None = PROFILE_SIZE) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent 1- to 3-grams of a text, most frequent first, and their counts; all if size is None."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if not text:
        return none
    s = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    s = np.concatenate([[0], s, [0]]).astype(np.uint64)
    s = s[(s != 0) | np.append(s[1:] != 0, False) | (np.arange(len(s)) == len(s) - 1)]
    if len(s) < 3:
        return none
    s[s == 0] = _EDGE
    inner = s[1:-1] != _EDGE
    two = s[:-1] << np.uint64(21) | s[1:]
    three = (s[:-2] << np.uint64(42) | two[1:])[inner]
    codes, counts = np.unique(np.concatenate([s[1:-1][inner], two, three]), return_counts=True)
    if size is not None and len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        more = np.flatnonzero(counts > least)
        ties = np.flatnonzero(counts == least)[: size - len(more)]
        chosen = np.sort(np.concatenate([more, ties]))
        codes, counts = codes[chosen], counts[chosen]
    order = np.argsort(-counts, kind="stable")
    return codes[order], counts[order]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per language and n-gram, of each batch."""
    for batch in batches:
        by: dict[str, list] = {}
        for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
            by.setdefault(lang.as_py(), []).append(ranked_grams(text.as_py(), None))
        for lang, parts in by.items():
            codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(where, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(n)],
                names=["lang", "code", "n"],
            )


def learn_profiles(
    labelled: DataFrame, *, size: int = PROFILE_SIZE, per_language: int = SAMPLE_PER_LANGUAGE
) -> dict[str, np.ndarray]:
    """Profiles from rows of doc_id, text and lang, by language.

    At most about ``per_language`` documents of each language are counted, those of the
    smallest share of a hash of their ids.
    """
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text", "lang")
    found = rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not found:
        return {}
    share = F.create_map(*[F.lit(x) for r in found for x in (r["lang"], min(1.0, per_language / r["count"]))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    grams = (
        rows.where(draw < share[F.col("lang")])
        .select("lang", "text")
        .mapInArrow(_count_grams, "lang string, code long, n long")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    top = grams.withColumn("rank", rank).where(F.col("rank") <= size).collect()
    profiles: dict[str, list] = {}
    for r in sorted(top, key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(r["lang"], []).append(r["code"])
    return {lang: np.array(codes, np.uint64) for lang, codes in profiles.items()}


class RankOrder:
    """Profiles laid out for comparison: the rank of each known n-gram in each language."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int = PROFILE_SIZE) -> None:
        self.langs, self.size = sorted(profiles), size
        known = [np.asarray(profiles[k], np.uint64) for k in self.langs]
        self.codes = np.unique(np.concatenate([*known, np.zeros(1, np.uint64)]))
        self.ranks = np.full((len(self.codes), len(self.langs)), -1, np.int64)
        for j, codes in enumerate(known):
            self.ranks[np.searchsorted(self.codes, codes), j] = np.arange(len(codes))

    def predict(self, text: str | None) -> tuple[str, float]:
        codes, _ = ranked_grams(text, self.size)
        if not len(codes) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, codes)
        at[at == len(self.codes)] = 0
        ranks = np.where((self.codes[at] == codes)[:, None], self.ranks[at], -1)
        apart = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(codes))[:, None])).sum(0)
        best = int(apart.argmin())
        return self.langs[best], float(1 - apart[best] / (self.size * len(codes)))


def language_of(text: Column, profiles: dict[str, np.ndarray], *, size: int = PROFILE_SIZE) -> Column:
    """A struct of the predicted language and its score."""

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = RankOrder(profiles, size)
        for texts in batches:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predicted(text)


def accepted(predicted: Column, least_score: float = LEAST_SCORE) -> Column:
    """Whether a prediction names a language, and the text is nearer to its profile than ``least_score``."""
    return (predicted["lang_pred"] != UNKNOWN) & (predicted["score"] >= least_score)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo five, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, profiles: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        language_of(F.col("text"), profiles).alias("p"),
    ).select("doc_id", "held_out", "p.lang_pred", "p.score")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn_profiles(docs.where(~held_out(F.col("doc_id")))))
