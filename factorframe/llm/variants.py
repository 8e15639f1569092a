"""Spelling variants: words that differ by one code point, found by pivotal bigrams.

Words are counted in one aggregation. The bigrams of a word are ordered from rare to common by the number of words that
have them. A word's *prefix* is its three rarest bigrams and whatever else is no more common than the third; its
*pivots* are two disjoint ones of the three, chosen by dynamic programming for the least number of words that have them.
One edit spoils at most one pivot, so of two near words the one whose prefix ends at the rarer bigram has
a pivot in the other's prefix.

Where it lies is limited too, as all on one side of the edit is untouched. With pivots at p and q, p < q, an edit

* before p leaves everything from p on,
* between p and the end of p's bigram, or between the two, leaves everything from q on, and what is before p,
* inside q's bigram leaves everything up to the end of p's, and what comes after q's,
* after q's bigram leaves everything up to its end.

So the index holds, for each bigram of a prefix, the word up to its end and the word from its start, alone and with the
two code points at the word's other end; and a pivot is looked up by what the edit leaves, in the lengths that it
allows. What is found is verified by edit distance. Keys that very many words share are split by a salt, and pivots are
looked up under each. No cap is set on candidates.

Defined results: null and empty texts have no runs; each row of a repeated document counts; a null doc_id is written as
nothing before the colon. Ties go to the word that is first in code-point order. Very long texts are read whole. An empty table gives no
rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from factorframe.llm.common import Batcher, drop_saved, id_texts, saved, table

#: Code points and occurrences that make a word, and how many times as frequent a form must be.
LEAST_LENGTH = 5
LEAST_COUNT = 3
TIMES = 2
#: One run in so many of a document, by hash, loses a code point.
DAMAGED = 97
#: Different words that a task holds, and words under one key of the index before it is split.
HELD = 400_000
KEY_WORDS = 1024

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def damage(doc_id: int | None, run: str) -> str:
    """A lower-cased run as it is read: without one code point if its hash says so."""
    return _damage(zlib.crc32(b"%s:" % (b"" if doc_id is None else b"%d" % doc_id)), run)


def _damage(seed: int, run: str) -> str:
    h = zlib.crc32(run.encode(), seed)
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counter(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def flush(counts: Counter) -> pa.RecordBatch:
        columns = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                doc_id, folded = doc_id.as_py(), text.as_py().encode().translate(_FOLD).decode()
                seed = zlib.crc32(b"%s:" % (b"" if doc_id is None else b"%d" % doc_id))
                for found, n in Counter(_RUN.findall(folded)).items():
                    # A shorter run cannot become a word, whether it loses a code point or not.
                    if len(found) >= least and len(word := _damage(seed, found)) >= least:
                        counts[word] += n
                if len(counts) > HELD:
                    yield flush(counts)
                    counts.clear()
        yield flush(counts)

    return run


def count_words(docs: DataFrame, *, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: the words of all texts that are long and frequent enough."""
    texts = id_texts(docs).where(F.length("text") > 0)
    counted = texts.mapInArrow(_counter(least_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def bigrams(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Each bigram's place from rare to common, and how many words have it. Of 90 letters there are 8,100 at most."""
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(2)))
    counts = words.select(F.explode(F.array_distinct(grams)).alias("gram")).groupBy("gram").count()
    ordered = sorted(counts.collect(), key=lambda r: (r["count"], r["gram"]))
    return {r["gram"]: (i, r["count"]) for i, r in enumerate(ordered)}


def pivots(orders: list[int], costs: list[int], count: int = 2) -> list[int]:
    """Places of ``count`` disjoint bigrams among the rarest, with the least sum of costs.

    ``orders`` are those of a word's bigrams. With e edits the 2e + 1 rarest are looked at and e + 1 chosen.
    The table holds, for each number of chosen bigrams, the best choice among the places seen so far.
    """
    rarest = sorted(sorted(range(len(orders)), key=lambda i: (orders[i], i))[: 2 * count - 1])
    tables: list[list[tuple[int, list[int]] | None]] = [[(0, [])] + [None] * count]
    for seen, at in enumerate(rarest):
        # The bigram just before overlaps this one; take the table from before it.
        free = tables[seen - 1] if seen and rarest[seen - 1] == at - 1 else tables[seen]
        row = list(tables[seen])
        for chosen in range(1, count + 1):
            if free[chosen - 1] is not None:
                cost, places = free[chosen - 1]
                if row[chosen] is None or cost + costs[at] < row[chosen][0]:
                    row[chosen] = (cost + costs[at], [*places, at])
        tables.append(row)
    return tables[-1][count][1]


def _key(side: str, part: str, far: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{side}{part} {far}".encode()) - (1 << 63)


_ENTRY = pa.schema(
    [("key", pa.int64()), ("length", pa.int32()), ("word", pa.string()), ("n", pa.int64()), ("last", pa.int32()), ("letters", pa.int64())]
)
_ENTRY_SQL = "key long, length int, word string, n long, last int, letters long"


def _letters(word: str) -> int:
    """A bit for each letter there is, by its code point modulo 64."""
    bits = 0
    for c in word:
        bits |= 1 << (ord(c) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


def _entries(known: dict[str, tuple[int, int]], *, asking: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of the index, or with ``asking`` the keys under which a word's pivots are looked up."""

    def prefix_keys(w: str, orders: list[int], last: int) -> Iterator[tuple[int, int]]:
        for i, order in enumerate(orders):
            if order <= last:
                for far in ("", w[-2:]):
                    yield _key("L", w[: i + 2], far), len(w)
                for far in ("", w[:2]):
                    yield _key("R", w[i:], far), len(w)

    def pivot_keys(w: str, orders: list[int], costs: list[int]) -> Iterator[tuple[int, int]]:
        p, q = pivots(orders, costs)
        keys = (
            _key("R", w[p:], ""),
            _key("L", w[: q + 2], ""),
            _key("R", w[q:], w[:2] if p >= 2 else ""),
            _key("L", w[: p + 2], w[-2:] if len(w) - q - 2 >= 2 else ""),
        )
        for key in dict.fromkeys(keys):
            for length in (len(w) - 1, len(w), len(w) + 1):
                yield key, length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Batcher(_ENTRY)
        for batch in batches:
            for w, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                grams = [w[i : i + 2] for i in range(len(w) - 1)]
                orders = [known[g][0] for g in grams]
                last, letters = sorted(orders)[2], _letters(w)
                keys = pivot_keys(w, orders, [known[g][1] for g in grams]) if asking else prefix_keys(w, orders, last)
                for key, length in keys:
                    if (full := out.add(key, length, w, n, last, letters)) is not None:
                        yield full
        yield out.flush()

    return run


def near_words(words: DataFrame, *, key_words: int = KEY_WORDS) -> DataFrame:
    """word, other, n, n_other: pairs of words, both ways, that differ by one code point.

    ``words`` are unique, of at least four code points, in rows of word and n.
    """
    known = bigrams(words)
    index = saved(words.mapInArrow(_entries(known, asking=False), _ENTRY_SQL), "grams")
    hot = (
        index.groupBy("key", "length")
        .agg(F.count("*").alias("words"))
        .where(F.col("words") > key_words)
        .select("key", "length", F.ceil(F.col("words") / key_words).cast("int").alias("salts"))
    )
    hot = saved(hot, "hot")
    asked = words.mapInArrow(_entries(known, asking=True), _ENTRY_SQL)
    asked = asked.join(hot, ["key", "length"], "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
    )
    entries = index.join(hot, ["key", "length"], "left").withColumn(
        "salt", F.coalesce(F.pmod(F.xxhash64("word"), F.col("salts")), F.lit(0)).cast("int")
    )
    a, b = asked.alias("a"), entries.alias("b")
    same_key = (F.col("a.key") == F.col("b.key")) & (F.col("a.length") == F.col("b.length")) & (F.col("a.salt") == F.col("b.salt"))
    # An edit takes one letter out of the set, or puts one in, or both.
    alike = F.bit_count(F.col("a.letters").bitwiseXOR(F.col("b.letters"))) <= 2
    maybe = (F.col("a.last") <= F.col("b.last")) & alike & (F.col("a.word") != F.col("b.word"))
    near = F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1
    found = a.join(b, same_key & maybe & near).select(
        F.col("a.word").alias("word"), F.col("b.word").alias("other"), F.col("a.n").alias("n"), F.col("b.n").alias("n_other")
    )
    back = [F.col(x).alias(y) for x, y in (("other", "word"), ("word", "other"), ("n_other", "n"), ("n", "n_other"))]
    ways = F.array(F.struct("word", "other", "n", "n_other"), F.struct(*back))
    return found.select(F.explode(ways).alias("way")).select("way.*").distinct()


def follow(links: DataFrame) -> DataFrame:
    """word, root of each word of ``links`` (word, form): the last word on its way along the forms.

    Each round doubles the way. A form is at least twice as frequent as its word, so no way has
    more than 63 steps, nor more than six rounds.
    """
    state = saved(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        after = saved(
            state.join(further, "root", "left").select(
                "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")
            ),
            "roots",
        )
        moved = not after.where("moved").isEmpty()
        drop_saved(state)
        state = after.drop("moved")
        state.saved_path = after.saved_path
        if not moved:
            return state


def spelling_variants(docs: DataFrame, *, times: int = TIMES) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of ``docs``."""
    words = saved(count_words(docs), "words")
    best = F.min(F.struct((-F.col("n_other")).alias("n"), F.col("other").alias("word")))
    near = near_words(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    chosen = F.when(-F.col("best.n") >= times * F.col("n"), F.col("best"))
    forms = saved(
        near.select("word", "n_near", chosen["word"].alias("form"), (-chosen["n"]).alias("form_n")), "forms"
    )
    roots = follow(forms.where("form is not null"))
    return (
        words.join(forms, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
        )
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of ``documents`` with the form it is a variant of, and the root of its forms."""
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))
