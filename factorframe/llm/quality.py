"""Quality rules: counts of words and repeats, and compression bands that the corpus itself sets.

A text is compressed as a whole and in chunks with zstandard, every byte in one of them: fixed chunks, and
what is left at the end. The last chunk is judged by its own length; a rest too short to judge belongs to the chunk
before it. A ratio (compressed over plain bytes) below its band means repetition, above it means noise. Short texts
compress less, so each class of lengths has a band of its own, one for whole texts and one for chunks. The whole text
must be inside its band, and so must the chunks of all but a small share of its bytes.

Where a band ends is learnt from every text that the base rule keeps. Their ratios, in thousandths, are counted in a
histogram; a band reaches beyond the 5 % and 95 % quantiles by one and a half times their distance from the median, so
that a clean text at the end of the range stays, and at least a stated distance from the median, so that a corpus of
copies does not make it a point. It never reaches beyond the fixed outer
limits, and it is these alone where a class has too few texts to learn from. Histograms are exact counts,
so bands do not depend on the order or partitioning of rows.

Defined results: a null or empty text has no words, all counts 0, a null ratio, and is not kept. Repeated rows are
judged alike; a null doc_id is carried through. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from factorframe.llm.common import Batcher, id_texts, rows_of, saved, table

_SPACES = " \t\n\v\f\r"
_SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """How texts are cut, and what their bands are learnt with.

    ``limits`` has the classes of lengths and their outer limits: (from so many bytes, least ratio,
    largest ratio, in thousandths) in rising order. What is shorter than the first is too short to judge. At most
    ``odd_bytes`` of a text may lie in chunks outside their band.
    """

    limits: tuple[tuple[int, int, int], ...] = (
        (200, 250, 950),
        (300, 250, 950),
        (500, 200, 850),
        (700, 200, 850),
        (1_000, 160, 750),
        (1_400, 160, 750),
        (2_000, 130, 680),
        (2_800, 130, 680),
        (4_000, 100, 620),
        (8_000, 100, 620),
        (16_000, 70, 580),
        (64_000, 70, 580),
    )
    chunk: int = 4_000
    odd_bytes: float = 0.1
    level: int = 3
    tail: float = 0.05  # the quantiles, from either end, that a band starts from
    stretch: float = 1.5  # a band goes so many times the distance of quantile and median beyond the quantile
    width: int = 50  # thousandths that a band reaches from the median, at least
    least_texts: int = 100  # so many texts or chunks must be in a class to learn from it

    def learnt(self, number: int, histogram: dict[int, int]) -> tuple[int, int]:
        """Least and largest ratio of a class, from the counts of its ratios."""
        _, least, most = self.limits[number]
        total = sum(histogram.values())
        if total < self.least_texts:
            return least, most
        below, quantiles = 0, []
        for ratio in sorted(histogram):
            below += histogram[ratio]
            while len(quantiles) < 3 and below >= (self.tail, 0.5, 1 - self.tail)[len(quantiles)] * total:
                quantiles.append(ratio)
        low, middle, high = quantiles
        return (
            max(least, min(low - int(self.stretch * (middle - low)), middle - self.width)),
            min(most, max(high + int(self.stretch * (high - middle)), middle + self.width)),
        )


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
    )


def repeat_words(words: list[bytes]) -> int:
    """How many words stand in a 3-word window that occurs twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    # Pairs are numbered anew, so no product of vocabulary sizes overflows.
    _, pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
    _, where, counts = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    starts = counts[where] > 1
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : i + len(starts)] |= starts
    return int(covered.sum())


def packed_sizes(data: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple[int, list[int]]:
    """Compressed sizes of the whole and of each chunk; a text of one chunk is that chunk."""
    whole = len(packer.compress(data))
    full, rest = divmod(len(data), bands.chunk)
    chunks = max(1, full + (rest >= bands.limits[0][0]))
    if chunks == 1:
        return whole, [whole]
    view, last = memoryview(data), (chunks - 1) * bands.chunk
    cuts = [view[at : at + bands.chunk] for at in range(0, last, bands.chunk)] + [view[last:]]
    return whole, [len(packer.compress(x)) for x in cuts]


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        *[(c, pa.int64()) for c in _COUNTS],
        ("base_failed", pa.bool_()),
        ("n_bytes", pa.int64()),
        ("packed", pa.int64()),
        ("chunks", pa.list_(pa.int64())),
    ]
)


def measure(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """Counts of every document, its length and its compressed sizes: ``packed``, and one of ``chunks`` each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, packer = Batcher(_SCHEMA), zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            for doc_id, text in rows_of(batch):
                text = text or ""
                counts = base_counts(text)
                failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
                data = text.encode("utf-8", "surrogatepass")
                whole, chunks = packed_sizes(data, bands, packer) if data else (None, [])
                if full := out.add(doc_id, *counts, failed, len(data), whole, chunks, weight=8 * len(chunks)):
                    yield full
        yield out.flush()

    counts = ", ".join(f"{c} long" for c in _COUNTS)
    return id_texts(docs).mapInArrow(
        run, f"doc_id long, {counts}, base_failed boolean, n_bytes long, packed long, chunks array<long>"
    )


def _length_class(size: Column, bands: Bands) -> Column:
    """Place of the class in ``limits``; -1 for what is too short."""
    return sum((F.when(size >= least, 1).otherwise(0) for least, _, _ in bands.limits), F.lit(-1))


def _thousandths(packed: Column, size: Column) -> Column:
    return F.floor(packed * 1000 / size).cast("int")


def _last_size(bands: Bands) -> Column:
    return F.col("n_bytes") - bands.chunk * (F.size("chunks") - 1)


def _chunk_ratios(bands: Bands) -> Column:
    """(class, thousandths) of every chunk."""
    last = F.size("chunks") - 1

    def one(packed: Column, i: Column) -> Column:
        size = F.when(i < last, bands.chunk).otherwise(_last_size(bands))
        return F.struct(
            _length_class(size, bands).alias("number"), _thousandths(packed, size).alias("ratio"), size.cast("long").alias("size")
        )

    return F.transform("chunks", one)


def learn_bands(measured: DataFrame, bands: Bands = Bands()) -> dict[str, list[tuple[int, int]]]:
    """Limits of each class for whole texts (``whole``) and chunks (``chunk``), from all texts that pass the base rule.

    What reaches the driver is a histogram of at most some thousand bins a class, whatever the corpus is.
    """
    whole = F.array(
        F.struct(F.lit("whole").alias("kind"), _length_class(F.col("n_bytes"), bands).alias("number"), _thousandths(F.col("packed"), F.col("n_bytes")).alias("ratio"))
    )
    chunks = F.transform(
        _chunk_ratios(bands), lambda x: F.struct(F.lit("chunk").alias("kind"), x["number"].alias("number"), x["ratio"].alias("ratio"))
    )
    bins = (
        measured.where(~F.col("base_failed"))
        .select(F.inline(F.concat(whole, chunks)))
        .where("number >= 0")
        .groupBy("kind", "number", "ratio")
        .count()
    )
    histograms: dict[tuple[str, int], dict[int, int]] = defaultdict(dict)
    for kind, number, ratio, count in bins.collect():
        histograms[kind, number][ratio] = count
    return {
        kind: [bands.learnt(i, histograms[kind, i]) for i in range(len(bands.limits))] for kind in ("whole", "chunk")
    }


def judge(measured: DataFrame, limits: dict[str, list[tuple[int, int]]], bands: Bands = Bands()) -> DataFrame:
    """The verdict of every measured document, by the limits that ``learn_bands`` gave."""

    def outside(kind: str, number: Column, ratio: Column) -> Column:
        low, high = (F.array(*[F.lit(x[i]) for x in limits[kind]]) for i in (0, 1))
        return (number >= 0) & ((ratio < F.get(low, number)) | (ratio > F.get(high, number)))

    odd = F.filter(_chunk_ratios(bands), lambda x: outside("chunk", x["number"], x["ratio"]))
    odd_bytes = F.aggregate("odd", F.lit(0).cast("long"), lambda n, x: n + x["size"])
    whole = outside("whole", _length_class(F.col("n_bytes"), bands), _thousandths(F.col("packed"), F.col("n_bytes")))
    fine = ~F.col("whole_odd") & (F.col("n_odd_bytes") <= bands.odd_bytes * F.col("n_bytes"))
    return (
        measured.withColumn("odd", odd)
        .withColumns({"n_odd_bytes": odd_bytes, "whole_odd": F.coalesce(whole, F.lit(False))})
        .select(
            "doc_id",
            *_COUNTS,
            "base_failed",
            (~F.col("base_failed") & (F.col("n_bytes") > 0) & fine).alias("kept"),
            (F.col("packed") / F.col("n_bytes")).alias("ratio"),
            F.size("chunks").cast("long").alias("n_chunks"),
            F.size("odd").cast("long").alias("n_odd_chunks"),
            "n_odd_bytes",
        )
    )


def quality(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """Counts and verdict of every document. Texts are read once; bands and verdicts need only the table of sizes."""
    measured = saved(measure(docs, bands), "quality")
    return judge(measured, learn_bands(measured, bands), bands)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))
