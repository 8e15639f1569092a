"""Benchmark decontamination: BM25 over test items with block-max WAND, then overlap of question and answer.

The inverted index is made of the test items, not of the corpus. Impacts are BM25 scores divided by the score that the
item gives itself, so 1 means that a passage has all its terms, and one threshold serves every item. Items
are grouped by length (up to 32 words, 64, 128, ...); for each group the passages are windows of twice that
length, moved by once, so any run of words as long as an item lies inside one.

Every passage of every document is a query, and all items above the threshold are wanted, not the best few:

* Block-max: items lie in blocks, the short ones together, and each term has its largest impact in each block. The sum
  over a passage's terms bounds what any item of the block can score. A document is cut into tiles of half a passage; the
  bounds of its tiles are summed at once, and two neighbours bound their passage. Where no block reaches the
  threshold the passage is done.
* WAND: in the blocks that do reach it, the exact scores of their items are summed from the inverted lists alone.
* Hits are verified by the words that lie in three-word runs that the passage shares with the item. A passage is a leak
  if it has ``OVERLAP`` of the question's words and of the answer's (the last sentence), or ``WHOLE_OVERLAP`` of all the
  item's words, or, where the answer has fewer than ``ANSWER_LEAST`` words and says nothing by itself, ``WHOLE_OVERLAP`` of
  the question's. So a long question counts with its answer cut or changed.

The index is kept in shards of at most ``SHARD_POSTINGS`` postings, and each is broadcast by itself, with one pass over the
documents, so the size of a broadcast does not grow with the benchmark.

Defined results: null and empty texts, and items without a word, meet nothing. Items that are equal are each reported. Repeated rows of a
document are reported each. A null doc_id or item_id is carried through.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from factorframe.llm.common import Batcher, id_texts, rows_of, saved, table

K1, B = 1.2, 0.75
#: Share of an item's own score that a passage must reach.
THRESHOLD = 0.5
#: Share of the words of question and answer that must lie in shared runs.
OVERLAP = 0.6
#: Share of all words, or of the question's beside a short answer, that is enough whatever the answer's share is.
WHOLE_OVERLAP = 0.8
#: An answer of fewer words is not judged by itself: one word changed may leave it no run.
ANSWER_LEAST = 4
RUN = 3
SHARD_POSTINGS = 250_000
_SHORTEST = 32
#: Items of a block at least, and blocks at most.
_BLOCK, _BLOCKS = 8, 64

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def answer_words(text: str) -> int:
    """How many words the last sentence has, if there is one before it; else 0: the item is all question."""
    sentences = [n for s in _SENTENCE.split(text) if (n := len(words_of(s)))]
    return sentences[-1] if len(sentences) > 1 else 0


def length_class(n: int) -> int:
    size = _SHORTEST
    while size < n:
        size *= 2
    return size


def build_index(items: DataFrame) -> DataFrame:
    """Postings (item, item_id, text, size, words, impacts), one row per item: a written table.

    Document frequencies and lengths are of all items.
    """

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            words = [words_of(t) for t in rows["text"]]
            yield pd.DataFrame(
                {
                    "item": rows["item"],
                    "item_id": rows["item_id"],
                    "text": rows["text"],
                    "length": [len(w) for w in words],
                    "size": [length_class(len(w)) for w in words],
                    "words": words,
                }
            )

    numbered = items.select(
        F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text IS NOT NULL")
    split_items = saved(
        numbered.mapInPandas(split, "item long, item_id long, text string, length long, size long, words array<string>").where("length > 0"),
        "items",
    )
    totals = split_items.agg(F.count("*").alias("n"), F.avg("length").alias("mean")).first()
    terms = split_items.select("item", "length", F.explode("words").alias("word")).groupBy("item", "length", "word").agg(F.count("*").alias("tf"))
    frequency = terms.groupBy("word").agg(F.count("*").alias("df"))
    idf = F.log1p((F.lit(float(totals["n"])) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = K1 * (1 - B + B * F.col("length") / F.lit(totals["mean"] or 1.0))
    scored = terms.join(frequency, "word").select("item", "word", (idf * F.col("tf") * (K1 + 1) / (F.col("tf") + norm)).alias("impact"))
    lists = scored.groupBy("item").agg(F.sort_array(F.collect_list(F.struct("word", "impact"))).alias("postings"))
    own = F.aggregate("postings", F.lit(0.0), lambda x, p: x + p["impact"])
    return saved(
        split_items.select("item", "item_id", "text", "size").join(lists, "item").select(
            "item",
            "item_id",
            "text",
            "size",
            F.col("postings.word").alias("words"),
            F.transform("postings", lambda p: p["impact"] / own).alias("impacts"),
        ),
        "index",
    )


class _Postings:
    """The inverted lists of one length class, with the largest impacts of terms in blocks."""

    def __init__(self, items: list[dict]) -> None:
        self.items = items = sorted(items, key=lambda x: (len(x["words"]), x["item"]))
        self.terms: dict[str, int] = {}
        term = np.array([self.terms.setdefault(w, len(self.terms) + 1) for x in items for w in x["words"]], np.int64)
        self.item = np.repeat(np.arange(len(items)), [len(x["words"]) for x in items])
        self.impact = np.concatenate([np.asarray(x["impacts"], np.float64) for x in items])
        self.block = np.arange(len(items)) // max(_BLOCK, -(-len(items) // _BLOCKS))
        self.most = np.zeros((len(self.terms) + 1, int(self.block[-1]) + 1), np.float32)  # nothing for term 0: no item's
        np.maximum.at(self.most, (term, self.block[self.item]), self.impact.astype(np.float32))
        order = np.lexsort((self.item, term))
        term, self.item, self.impact = term[order], self.item[order], self.impact[order]
        self.start = np.searchsorted(term, np.arange(len(self.terms) + 2))

    def bounds(self, ids: np.ndarray, size: int) -> np.ndarray:
        """For each tile of so many words and each block: the sum of its distinct terms' largest impacts."""
        n, place = len(self.most), ids.nonzero()[0]
        out = np.zeros((max(1, -(-len(ids) // size)), self.most.shape[1]), np.float32)
        if len(place):
            pairs = np.unique(place // size * n + ids[place])
            tile = pairs // n
            first = np.flatnonzero(np.append(True, tile[1:] != tile[:-1]))
            out[tile[first]] = np.add.reduceat(self.most[pairs % n], first, axis=0)
        return out

    def above(self, terms: np.ndarray, threshold: float, blocks: np.ndarray | None = None) -> list[tuple[int, float]]:
        """Items (of the blocks) with their scores for a passage of these distinct, known terms."""
        n = self.start[terms + 1] - self.start[terms]
        end = n.cumsum()
        at = np.repeat(self.start[terms] - (end - n), n) + np.arange(end[-1] if len(end) else 0)
        if blocks is not None:
            at = at[blocks[self.block[self.item[at]]]]
        score = np.bincount(self.item[at], self.impact[at])
        return [(int(i), float(score[i])) for i in np.flatnonzero(score >= threshold)]


def overlaps(item: list[str], answer: int, passage: list[str]) -> tuple[float, float, float]:
    """Shares of question, answer and all words that lie in runs the passage has too."""
    n = min(RUN, len(item))
    there = set(zip(*[passage[i:] for i in range(n)], strict=False))
    covered = np.zeros(len(item), bool)
    for i, run in enumerate(zip(*[item[j:] for j in range(n)], strict=False)):
        if run in there:
            covered[i : i + n] = True
    split = len(item) - answer
    question = float(covered[:split].mean())
    return question, float(covered[split:].mean()) if answer else question, float(covered.mean())


def is_leak(question: float, answer: float, whole: float, answer_words: int, overlap: float = OVERLAP) -> bool:
    """Whether these shares make a passage a leak of its item."""
    enough = max(overlap, WHOLE_OVERLAP)
    return min(question, answer) >= overlap or whole >= enough or (answer_words < ANSWER_LEAST and question >= enough)


class Searcher:
    """Finds the leaked items of a text in one shard of the index."""

    def __init__(self, shard: list[dict], threshold: float = THRESHOLD, overlap: float = OVERLAP) -> None:
        self.threshold, self.overlap = threshold - 1e-9, overlap
        sizes = sorted({x["size"] for x in shard})
        self.classes = [(s, _Postings([x for x in shard if x["size"] == s])) for s in sizes]
        self.parsed = {x["item"]: (words_of(x["text"]), answer_words(x["text"])) for x in shard}

    def leaks(self, text: str | None) -> dict[int, tuple[int | None, float, float, float]]:
        """By item: its id, the best score and the overlaps of that passage."""
        out: dict[int, tuple] = {}
        words = words_of(text)
        if not words:
            return out
        for size, index in self.classes:
            ids = np.fromiter(map(index.terms.get, words, repeat(0)), np.int64, len(words))
            tiles = index.bounds(ids, size)
            passages = tiles[:-1] + tiles[1:] if len(tiles) > 1 else tiles
            reach = passages >= self.threshold - 1e-4  # single precision
            for k in np.flatnonzero(reach.any(1)):
                a, b = int(k) * size, (int(k) + 2) * size
                terms = np.unique(ids[a:b])
                for i, score in index.above(terms[terms > 0], self.threshold, reach[k]):
                    item = index.items[i]
                    item_words, answer = self.parsed[item["item"]]
                    *found, whole = overlaps(item_words, answer, words[a:b])
                    leak = is_leak(*found, whole, answer, self.overlap)
                    if leak and score > out.get(item["item"], (None, -1.0))[1]:
                        out[item["item"]] = (item["item_id"], score, *found)
        return out


def shards(index: DataFrame, postings: int = SHARD_POSTINGS) -> Iterator[list[dict]]:
    """The index in parts of about so many postings at most, each brought to the driver by itself."""
    total = index.agg(F.sum(F.size("words"))).first()[0] or 0
    n = -(-total // postings)
    for k in range(n):
        part = index if n == 1 else index.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k)
        yield [r.asDict() for r in part.orderBy("item").collect()]


_HITS = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64())] + [(c, pa.float64()) for c in ("score", "question_overlap", "answer_overlap")]
)


def _searching(spark: SparkSession, shard: list[dict], threshold: float, overlap: float) -> Callable[[], Searcher]:
    sent = spark.sparkContext.broadcast(shard)
    return lambda: Searcher(sent.value, threshold, overlap)


def find_leaks(docs: DataFrame, items: DataFrame, *, threshold: float = THRESHOLD, overlap: float = OVERLAP, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """doc_id, item_id, score, question_overlap and answer_overlap of every item that a document holds."""

    def search(shard: list[dict]) -> DataFrame:
        searcher = _searching(docs.sparkSession, shard, threshold, overlap)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out, found = Batcher(_HITS), searcher()
            for batch in batches:
                for doc_id, text in rows_of(batch):
                    for hit in found.leaks(text).values():
                        if full := out.add(doc_id, *hit):
                            yield full
            yield out.flush()

        return id_texts(docs).mapInArrow(run, "doc_id long, item_id long, score double, question_overlap double, answer_overlap double")

    parts = [search(s) for s in shards(build_index(items), shard_postings)]
    if not parts:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, score double, question_overlap double, answer_overlap double")
    return reduce(DataFrame.union, parts)


def without_leaks(docs: DataFrame, items: DataFrame, *, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """The documents, with all their columns, that hold no test item: a filter, without a shuffle."""

    def clean(shard: list[dict]) -> Column:
        searcher = _searching(docs.sparkSession, shard, threshold, overlap)

        @F.pandas_udf("boolean")
        def free(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            found = searcher()
            for texts in batches:
                yield pd.Series([not found.leaks(t) for t in texts], dtype=bool)

        return free(F.col("text"))

    for shard in shards(build_index(items)):
        docs = docs.where(clean(shard))
    return docs


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
