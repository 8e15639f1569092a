"""Repeated byte strings by column-wise construction over many documents at once.

Every string of ``SPAN`` bytes that also starts in a document with a smaller id is removed; what is
left of each document is concatenated.

*Segments.* A span's minimizer is the k-mer with the least hash inside it, the leftmost if several are equal.
Equal spans have the same one at the same place. Consecutive spans with one minimizer form a segment, at most
``2 * SPAN - K`` bytes, and segments of one minimizer meet in one partition, so every two equal spans do.

*Columns.* In a partition the segments are lined up at their minimizers. From the last column to the first, one
symbol of each segment is inserted per round, as BCR does for collections: the segments' order by what follows is
divided by the new symbol, stably, which gives the order by what starts here, and the symbols before it in that order are the next
column of the Burrows-Wheeler transform. The common prefixes of neighbours are updated along: one more than the least of those
between them if their symbols agree, else none. Equal spans start in one column, so only a column's own
order is needed, one row per segment. Where neighbours share ``SPAN`` symbols they are one class, and its spans but
those of the least document are removed.

*Which segments.* A minimizer of one document only has no equal spans elsewhere. So the minimizers' hashes go ahead:
each partition tells documents which of theirs others have too, and only those segments follow.

The external files are Spark's: segments travel in shuffle files, compressed and ordered by partition, and each
partition is read once, in a row, by one task. A batch of documents first merges its own equal segments and
settles all but the least document's by itself, so a passage that every document has is one segment per
batch. A passage's edges are in different segments everywhere; a minimizer that would fill a partition alone that way is
told from a sample, and its spans travel each by itself, by a hash of all their bytes. That changes only which partition
compares them, never the result.

Defined results: null and empty texts have no bytes, nothing removed, and the digest of no bytes. Texts below
``SPAN`` bytes lose nothing. Rows that repeat a doc_id are one document, and must have the same text. A null doc_id
neither removes nor loses bytes. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from factorframe.llm.common import Batcher, drop_saved, id_texts, mix, rows_of, saved, spread, table

SPAN = 50
K = 16
#: Spans that can have the same minimizer, and the columns of a segment: its minimizer starts in column ``_LEFT``.
_SPANS = SPAN - K + 1
_LEFT = _SPANS - 1
_COLUMNS = _LEFT + SPAN
_HALF = np.uint64(32)
_ROW = 88  # columns, filled up to whole 64-bit words
_BATCH_BYTES = 2 << 20
#: One document in so many is looked at to find minimizers that are everywhere.
SAMPLE = 64

_SENT = pa.schema([("part", pa.int32()), ("doc_ids", pa.binary()), ("starts", pa.binary()), ("ends", pa.binary()), ("rows", pa.binary())])
_SENT_SQL = "part int, doc_ids binary, starts binary, ends binary, rows binary"
_PARCELS = pa.schema([("part", pa.int32()), ("doc_ids", pa.binary()), ("words", pa.binary())])


def kmer_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the K = 16 bytes from each place; ``data`` has K - 1 bytes to spare at its end."""
    w = data.astype(np.uint64)
    for i in (1, 2, 4):
        w = w[:-i] | w[i:] << np.uint64(8 * i)
    return mix(mix(w[:-8] + np.uint64(0x9E3779B97F4A7C15)) ^ w[8:])


def segments(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All segments of some documents: document's number, first span, number of spans, place of the minimizer, its hash.

    Places are in the texts' concatenation.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    total = int(lengths.sum())
    if total < SPAN:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    data = np.frombuffer(b"".join(texts) + bytes(SPAN), np.uint8)
    hashes = kmer_hashes(data)[:total]
    # Half a hash in the upper bits and the place in the lower: the least is the leftmost of the least.
    least = (hashes >> _HALF << _HALF) | np.arange(total, dtype=np.uint64)
    least = np.append(least, np.full(SPAN, np.uint64(0xFFFFFFFFFFFFFFFF)))
    width = 1
    while 2 * width <= _SPANS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: total - SPAN + 1], least[_SPANS - width : _SPANS - width + total - SPAN + 1])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ends = lengths.cumsum()
    doc = np.repeat(np.arange(len(texts)), lengths)[: len(at)]
    whole = ends[doc] - np.arange(len(at)) >= SPAN
    change = np.ones(len(at), bool)
    change[1:] = (at[1:] != at[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(change & whole)
    stop = np.append(np.flatnonzero(change), len(at))
    count = stop[np.searchsorted(stop, first, side="right")] - first
    return doc[first], first, count, at[first], hashes[at[first]]


def _rows(data: np.ndarray, first: np.ndarray, count: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Segments as rows of columns around their minimizers, 0 outside."""
    column = np.arange(_ROW)
    left, right = _LEFT - (at - first), _LEFT + first + count - 1 + SPAN - at
    out = np.zeros((len(first), _ROW), np.uint8)
    for a in range(0, len(first), 10_000):
        part = slice(a, a + 10_000)
        place = at[part, None] - _LEFT + column
        inside = (column >= left[part, None]) & (column < right[part, None])
        out[part] = np.where(inside, data[np.where(inside, place, 0)], 0)
    return out


def _equal_runs(rows: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows in which equal ones (with equal ``more``) are neighbours, and where each run starts."""
    words = rows.view(np.uint64)
    h = more.astype(np.uint64)
    for i in range(words.shape[1]):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[:, i])
    order = np.argsort(h, kind="stable")
    h, words, more = h[order], words[order], more[order]
    new = np.ones(len(order), bool)
    # Merged only if every byte agrees.
    new[1:] = (h[1:] != h[:-1]) | (more[1:] != more[:-1]) | (words[1:] != words[:-1]).any(1)
    return order, np.flatnonzero(new)


def _settled(order: np.ndarray, runs: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which rows are of a document above the least of their run."""
    least = np.minimum.reduceat(docs[order], runs)
    out = np.zeros(len(docs), bool)
    out[order] = docs[order] > np.repeat(least, np.diff(np.append(runs, len(order))))
    return out


def _parcels(docs: np.ndarray, words: np.ndarray, parts: int, out: Batcher) -> Iterator[pa.RecordBatch]:
    """64-bit words for documents, one row for each partition that their documents go to."""
    part = (mix(docs.astype(np.int64).view(np.uint64)) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    part, docs, words = part[order], docs[order], words[order]
    bounds = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True) if len(part) else ():
        row = int(part[a]), np.ascontiguousarray(docs[a:b]).tobytes(), np.ascontiguousarray(words[a:b]).tobytes()
        if full := out.add(*row, weight=len(row[1]) + len(row[2])):
            yield full


def _delivered(parcels: DataFrame, parts: int, width: int) -> DataFrame:
    """doc_id and all its ``words`` of so many columns, one row per document."""
    schema = pa.schema([("doc_id", pa.int64()), ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, docs, words = Batcher(schema), [np.zeros(0, np.int64)], [np.zeros((0, width), np.int64)]
        for batch in batches:
            for row in batch.to_pylist():
                docs.append(np.frombuffer(row["doc_ids"], np.int64))
                words.append(np.frombuffer(row["words"], np.int64).reshape(-1, width))
        doc, word = np.concatenate(docs), np.concatenate(words)
        order = np.argsort(doc, kind="stable")
        doc, word = doc[order], word[order]
        bounds = np.append(np.flatnonzero(np.append(True, doc[1:] != doc[:-1])), len(doc))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True) if len(doc) else ():
            if full := out.add(int(doc[a]), word[a:b].tobytes(), weight=8 * width * int(b - a)):
                yield full
        yield out.flush()

    return parcels.repartition(parts, "part").mapInArrow(run, "doc_id long, words binary")


def _spans_of(docs: np.ndarray, starts: np.ndarray, ends: np.ndarray, parts: int, out: Batcher) -> Iterator[pa.RecordBatch]:
    """Byte ranges of documents on their way, merged where they touch."""
    if not len(docs):
        return
    order = np.lexsort((starts, docs))
    docs, starts, ends = docs[order], starts[order], ends[order]
    new = np.append(True, docs[1:] != docs[:-1])
    apart = (new.cumsum() - 1) << 40  # so ranges of different documents never touch
    s, e = merged(starts + apart, ends + apart)
    own = docs[new][s >> 40]
    yield from _parcels(own, np.column_stack([s, e]) & ((1 << 40) - 1), parts, out)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges sorted by start, merged where they touch."""
    reach = np.maximum.accumulate(ends)
    new = np.append(True, starts[1:] > reach[:-1])
    return starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)]


_ASKED = pa.schema([("part", pa.int32()), ("doc_ids", pa.binary()), ("kmers", pa.binary()), ("several", pa.binary())])
_PARCELS_SQL = "part int, doc_ids binary, words binary"
_ASKED_SQL = "part int, doc_ids binary, kmers binary, several binary"
_SHORT = np.uint64(16)  # bits of a hash that stay at home


def _documents(batches: Iterator[pa.RecordBatch], column: str | None = None) -> Iterator[tuple[list[int], list[bytes], list]]:
    """Ids, texts and another column of documents that can have spans, some megabytes of text at a time."""
    ids, texts, more, size = [], [], [], 0
    for batch in batches:
        others = batch.column(column) if column else [None] * batch.num_rows
        for (doc_id, text), other in zip(rows_of(batch), others, strict=True):
            if doc_id is None or not text:
                continue
            ids.append(doc_id)
            texts.append(text.encode("utf-8", "surrogatepass"))
            more.append(other)
            size += len(texts[-1])
            if size >= _BATCH_BYTES:
                yield ids, texts, more
                ids, texts, more, size = [], [], [], 0
    if ids:
        yield ids, texts, more


def _ask(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Each minimizer of some documents once, with one of the documents that have it; ``several`` says that more do.

    What several documents of the batch have is told to them at once, in rows without ``several``.
    """
    out, packer = Batcher(_ASKED), zstandard.ZstdCompressor(level=1)
    for ids, texts, _ in _documents(batches):
        number, _, _, _, kmer = segments(texts)
        if not len(kmer):
            continue
        kmer, doc = kmer >> _SHORT, np.array(ids, np.int64)[number]
        order = np.lexsort((doc, kmer))
        kmer, doc = kmer[order], doc[order]
        new = np.append(True, (kmer[1:] != kmer[:-1]) | (doc[1:] != doc[:-1]))
        kmer, doc = kmer[new], doc[new]
        first = np.flatnonzero(np.append(True, kmer[1:] != kmer[:-1]))
        several = np.diff(np.append(first, len(kmer))) > 1
        known = np.repeat(several, np.diff(np.append(first, len(kmer))))
        if known.any():
            where = int(number[0] + len(kmer)) % parts
            if full := out.add(where, doc[known].tobytes(), kmer[known].tobytes(), None, weight=16 * int(known.sum())):
                yield full
        kmer, doc = kmer[first], doc[first]
        part = (mix(kmer) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        bounds = np.append(np.flatnonzero(np.append(True, np.diff(part[order]) > 0)), len(part))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            own = order[a:b]
            # Six bytes of each hash, column by column of bytes, which packs better.
            short = np.ascontiguousarray(kmer[own].view(np.uint8).reshape(-1, 8)[:, :6].T)
            row = (int(part[own[0]]), packer.compress(doc[own].tobytes()), packer.compress(short.tobytes()), packer.compress(several[own].tobytes()))
            if full := out.add(*row, weight=sum(map(len, row[1:]))):
                yield full
    yield out.flush()


def _tell(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """To each document the minimizers that others have too."""
    out, unpacker = Batcher(_PARCELS), zstandard.ZstdDecompressor()
    docs, kmers, several = [], [], []

    for batch in batches:
        for row in batch.to_pylist():
            if row["several"] is None:
                yield from _parcels(np.frombuffer(row["doc_ids"], np.int64), np.frombuffer(row["kmers"], np.uint64), parts, out)
                continue
            docs.append(np.frombuffer(unpacker.decompress(row["doc_ids"]), np.int64))
            short = np.frombuffer(unpacker.decompress(row["kmers"]), np.uint8).reshape(6, -1)
            kmers.append(np.pad(short.T, ((0, 0), (0, 2))).copy().view(np.uint64)[:, 0])
            several.append(np.frombuffer(unpacker.decompress(row["several"]), bool))
    if docs:
        doc, kmer, more = np.concatenate(docs), np.concatenate(kmers), np.concatenate(several)
        order = np.argsort(kmer, kind="stable")
        doc, kmer, more = doc[order], kmer[order], more[order]
        first = np.flatnonzero(np.append(True, kmer[1:] != kmer[:-1]))
        shared = np.logical_or.reduceat(more, first) | (np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first))
        shared = np.repeat(shared, np.diff(np.append(first, len(kmer)))) & ~more  # those with more have been told
        yield from _parcels(doc[shared], kmer[shared], parts, out)
    yield out.flush()


def shared_minimizers(docs: DataFrame, parts: int) -> DataFrame:
    """doc_id and ``words``, hashes (without their last bits) of the minimizers it shares with other documents."""
    ends = spread(docs)
    asked = id_texts(docs).mapInArrow(lambda batches: _ask(batches, parts), _ASKED_SQL)
    told = asked.repartition(parts, "part").mapInArrow(lambda batches: _tell(batches, ends), _PARCELS_SQL)
    return _delivered(told, ends, 1)


def _send(docs: DataFrame, parts: int, hot: np.ndarray) -> DataFrame:
    """Segments on their way to their partitions, and ranges already settled (with no rows), going anywhere.

    ``docs`` has the shared minimizers of each document, too.
    """

    def pack(ids: list[int], texts: list[bytes], shared: list, out: Batcher) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        number, first, count, at, kmer = segments(texts)
        known = [np.frombuffer(x.as_py(), np.uint64) for x in shared]
        whose = np.repeat(np.arange(len(known), dtype=np.uint64), [len(k) for k in known])
        both = lambda k, n: mix(mix(k) + n.astype(np.uint64))
        keep = np.isin(both(kmer >> _SHORT, number), both(np.concatenate(known), whose))
        number, first, count, at, kmer = (x[keep] for x in (number, first, count, at, kmer))
        if not len(first):
            return
        data = np.frombuffer(b"".join(texts), np.uint8)
        if len(hot):
            apart = np.isin(kmer, hot)
            n = np.where(apart, count, 1)
            each = np.arange(n.sum()) - np.repeat(n.cumsum() - n, n)
            number, at, apart, kmer = (np.repeat(x, n) for x in (number, at, apart, kmer))
            first, count = np.repeat(first, n) + each, np.where(apart, 1, np.repeat(count, n))
        rows = _rows(data, first, count, at)
        if len(hot) and apart.any():
            h = np.zeros(int(apart.sum()), np.uint64)
            for i in range(_ROW // 8):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + rows[apart].view(np.uint64)[:, i])
            kmer[apart] = h
        doc = np.array(ids, np.int64)[number]
        begin = np.append(0, np.cumsum([len(t) for t in texts]))[number]
        shape = ((at - first) << 8) | count
        settled = _settled(*_equal_runs(rows, shape), doc)
        start, end = first - begin, first - begin + count - 1 + SPAN
        some = np.flatnonzero(settled)
        if len(some):
            if full := out.add(int(number[some[0]] % parts), doc[some].tobytes(), start[some].tobytes(), end[some].tobytes(), None, weight=24 * len(some)):
                yield full
        some = np.flatnonzero(~settled)
        part = (mix(kmer[some]) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        some, part = some[order], part[order]
        bounds = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            own = some[a:b]
            body = packer.compress(np.column_stack([shape[own].astype("<u2").view(np.uint8).reshape(-1, 2), rows[own]]).tobytes())
            if full := out.add(int(part[a]), doc[own].tobytes(), start[own].tobytes(), end[own].tobytes(), body, weight=len(body) + 24 * len(own)):
                yield full

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batcher(_SENT)
        for ids, texts, shared in _documents(batches, "words"):
            yield from pack(ids, texts, shared, out)
        yield out.flush()

    return docs.mapInArrow(run, _SENT_SQL)


def _range_least(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least of values[a..b], for many ranges: from tables of doubling width, one at a time."""
    out = np.zeros(len(a), values.dtype)
    level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
    table, width = values, 1
    for k in range(int(level.max(initial=-1)) + 1):
        own = np.flatnonzero(level == k)
        out[own] = np.minimum(table[a[own]], table[b[own] - width + 1])
        table = np.minimum(table[:-width], table[width:]) if width < len(table) else table
        width *= 2
    return out


class Columns:
    """The order of segments by what starts in a column, with the common prefixes of neighbours."""

    def __init__(self, n: int) -> None:
        self.order, self.common = np.arange(n), np.zeros(n, np.uint8)

    def insert(self, symbols: np.ndarray) -> None:
        """One symbol of every segment goes before what is in order; ``symbols`` in that order is the transform's column."""
        transform = symbols[self.order]
        by = np.argsort(transform, kind="stable")
        symbol = transform[by]
        common = np.zeros(len(by), np.uint8)
        same = np.flatnonzero(symbol[1:] == symbol[:-1]) + 1
        common[same] = np.minimum(_range_least(self.common, by[same - 1] + 1, by[same]) + 1, SPAN)
        self.order, self.common = self.order[by], common

    def classes(self) -> np.ndarray:
        """Where each class of segments that share SPAN symbols from here starts, in the order."""
        return np.flatnonzero(self.common < SPAN)


def repeated_spans(rows: np.ndarray, shape: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each segment and span (by column) whether a smaller document has it too."""
    out = np.zeros((len(rows), _SPANS), bool)
    left, count = shape >> 8, shape & 255
    columns, largest = Columns(len(rows)), np.iinfo(np.int64).max
    for column in range(_COLUMNS - 1, -1, -1):
        columns.insert(rows[:, column])
        if column > _LEFT:
            continue
        back = _LEFT - column  # spans starting so far before the minimizer
        valid = (back <= left) & (back > left - count)
        own = np.where(valid, docs, largest)[columns.order]
        starts = columns.classes()
        least = np.repeat(np.minimum.reduceat(own, starts), np.diff(np.append(starts, len(own))))
        out[columns.order, column] = (own > least) & (own < largest)
    return out


def _receive(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Byte ranges to remove, from the segments of a partition."""
    out, unpacker = Batcher(_PARCELS), zstandard.ZstdDecompressor()
    docs, starts, bodies = [], [], []
    for batch in batches:
        for row in batch.to_pylist():
            d, s, e = (np.frombuffer(row[c], np.int64) for c in ("doc_ids", "starts", "ends"))
            if row["rows"] is None:
                yield from _spans_of(d, s, e, parts, out)
            else:
                docs.append(d)
                starts.append(s)
                bodies.append(np.frombuffer(unpacker.decompress(row["rows"]), np.uint8).reshape(-1, _ROW + 2))
    if docs:
        docs, starts, bodies = np.concatenate(docs), np.concatenate(starts), np.concatenate(bodies)
        # Minimizers of one document only have no equal spans elsewhere.
        kmer = np.ascontiguousarray(bodies[:, 2 + _LEFT : 2 + _LEFT + K]).view(np.uint64)
        kmer = mix(kmer[:, 0]) ^ kmer[:, 1]
        order = np.argsort(kmer, kind="stable")
        runs = np.flatnonzero(np.append(True, kmer[order][1:] != kmer[order][:-1]))
        sizes = np.diff(np.append(runs, len(order)))
        several = np.minimum.reduceat(docs[order], runs) < np.maximum.reduceat(docs[order], runs)
        keep = np.sort(order[np.repeat(several, sizes)])
        docs, starts, bodies = docs[keep], starts[keep], bodies[keep]
    if len(docs):
        shape = np.ascontiguousarray(bodies[:, :2]).view("<u2")[:, 0].astype(np.int64)
        rows = np.ascontiguousarray(bodies[:, 2:])
        count = shape & 255
        # Equal segments: all but the least document's are settled; one of each goes on.
        order, runs = _equal_runs(rows, shape)
        settled = _settled(order, runs, docs)
        yield from _spans_of(docs[settled], starts[settled], starts[settled] + count[settled] - 1 + SPAN, parts, out)
        one = order[runs]
        least = np.minimum.reduceat(docs[order], runs)
        hit = repeated_spans(rows[one], shape[one], least)
        # The least document's own segments, which may be in it more than once.
        run_of = np.empty(len(order), np.int64)
        run_of[order] = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, len(order))))
        left = np.flatnonzero(~settled)
        left = left[hit[run_of[left]].any(1)]
        at, column = np.nonzero(hit[run_of[left]])
        own = left[at]
        start = starts[own] + column - (_LEFT - (shape[own] >> 8))
        yield from _spans_of(docs[own], start, start + SPAN, parts, out)
    yield out.flush()


def _hot_minimizers(docs: DataFrame, parts: int) -> np.ndarray:
    """Minimizers that as many documents of the sample have as an even partition would get segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(segments([text.encode("utf-8", "surrogatepass")])[4]) for _, text in rows_of(batch) if text]
            kmers, n = np.unique(np.concatenate([*found, np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kmers.view(np.int64)), pa.array(n.astype(np.int64))], names=["kmer", "n"])

    drawn = id_texts(docs).where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(SAMPLE)) == 0)
    counts = saved(drawn.mapInArrow(run, "kmer long, n long").groupBy("kmer").agg(F.sum("n").alias("n")), "minimizers")
    total = counts.agg(F.sum("n")).first()[0] or 0
    # No more than there are partitions, as each has more than a partition's share.
    found = counts.where((F.col("n") >= 8) & (F.col("n") * parts > total)).select("kmer").collect()
    drop_saved(counts)
    return np.unique(np.array([r["kmer"] for r in found], np.int64).view(np.uint64))


def removed_ranges(docs: DataFrame, *, parts: int | None = None) -> DataFrame:
    """doc_id and ``words``, pairs of start and end of the byte ranges to remove: a written table, one row per document."""
    parts, ends = parts or spread(docs, 2), spread(docs)
    shared = saved(shared_minimizers(docs, parts), "minimizers")
    sent = _send(id_texts(docs).join(shared, "doc_id"), parts, _hot_minimizers(docs, parts))
    found = sent.repartition(parts, "part").mapInArrow(lambda batches: _receive(batches, ends), _PARCELS_SQL)
    ranges = saved(_delivered(found, ends, 2), "ranges")
    drop_saved(shared)
    return ranges


def remove_repeats(docs: DataFrame, *, with_text: bool = False, parts: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256; with ``with_text`` also ``kept``, the remaining bytes."""
    ranges = removed_ranges(docs, parts=parts)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    kinds = [pa.int64()] * 4 + [pa.string()]
    schema = pa.schema(list(zip(names, kinds, strict=True)) + [("kept", pa.binary())] * with_text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batcher(schema)
        for batch in batches:
            for (doc_id, text), spans in zip(rows_of(batch), batch.column("words"), strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                kept, removed, n = data, 0, 0
                if spans.is_valid:
                    both = np.frombuffer(spans.as_py(), np.int64).reshape(-1, 2)
                    both = both[np.argsort(both[:, 0], kind="stable")]
                    s, e = merged(both[:, 0], np.minimum(both[:, 1], len(data)))
                    kept = b"".join(data[a:b] for a, b in zip([0, *e], [*s, len(data)], strict=True))
                    removed, n = len(data) - len(kept), len(s)
                if full := out.add(doc_id, len(data), removed, n, sha256(kept).hexdigest(), *[kept] * with_text, weight=len(kept) * with_text):
                    yield full
        yield out.flush()

    sql = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return id_texts(docs).join(ranges, "doc_id", "left").mapInArrow(cut, sql)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
