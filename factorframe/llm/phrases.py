"""Phrase collocations from a weighted de Bruijn graph of words.

Texts are cut into pieces and pieces into words. Each word occurrence starts exactly one gram: itself and the words
after it, ``longest`` in all, or fewer where the piece ends. These grams are counted in one aggregation, the only one
over occurrences. Those of full length are the edges of a graph whose nodes are the grams of one word less:
"a b c" goes from "a b" to "b c" and weighs its count. The shorter ones are the corrections for the ends of pieces.
All grams of one head, "a b", meet in one task, so their shuffle counts the edges and the nodes alike, and of both only
what occurs often enough is written.

* Every shorter count is a flow: a gram occurs as often as the edges and the piece ends that begin with it say.
* A node through which one edge leads in and one out, both as heavy as the node's own flow, is unary. Chains of edges
  over unary nodes are compacted to paths by pointer doubling, in as many rounds as the logarithm of the longest. The
  phrase of a path occurs as often as each of its edges.
* What is then left to compare are the ends of paths: a unary node lies inside an edge that is as frequent as
  itself, so it is no phrase of its own, and any other node meets only the first and last edges of paths.

Scores are exact: products are decimals of 38 digits, which hold counts up to 10 ** 15.

Defined results: null and empty texts have no words; a null language is ``und``. Rows that repeat a document count as often as they are there. Equal
scores are ordered by count, then by phrase as UTF-8 bytes. Very long texts are counted whole, in batches. An empty
table gives no rows. Columns other than text and lang are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from factorframe.llm.common import drop_saved, saved, table

#: A candidate occurs so often, and the parts of a hundred of a phrase that make a longer one stand for it.
MIN_COUNT = 10
SHARE = 50
TOP = 2000
#: Different grams that a task holds before it gives them out or adds them up.
HELD = 400_000

#: A-Z become small, a tab a blank, and what ends a piece a line feed.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")
_GRAMS = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])
_COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("size", pa.int32()), ("n", pa.int64())])


def _starts(words: list[bytes], longest: int) -> Iterator[bytes]:
    """For each word the gram that starts there."""
    yield from map(b" ".join, zip(*(words[i:] for i in range(longest))))
    for i in range(max(0, len(words) - longest + 1), len(words)):
        yield b" ".join(words[i:])


def _counter(longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def flush(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            if counts:
                grams = pa.array(counts.keys(), pa.binary()).cast(pa.string())
                columns = [pa.array([lang] * len(grams), pa.string()), grams, pa.array(counts.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=_GRAMS)
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang"), strict=True):
                counts = held.setdefault(lang.as_py(), Counter())
                for piece in text.as_py().encode().translate(_FOLD).split(b"\n"):
                    if words := piece.split():
                        counts.update(_starts(words, longest))
                if sum(map(len, held.values())) > HELD:
                    yield from flush(held)
        yield from flush(held)

    return run


def _occurring(docs: DataFrame, longest: int) -> DataFrame:
    """lang, gram, n of the grams that start somewhere, as each task has counted them."""
    texts = docs.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    return texts.where(F.length("text") > 0).mapInArrow(_counter(longest), "lang string, gram string, n long")


def longest_grams(docs: DataFrame, longest: int = 3) -> DataFrame:
    """lang, gram (words joined by blanks), n: grams of ``longest`` words, and the shorter ones that end a piece."""
    return _occurring(docs, longest).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _summed(rows: pa.Table, keys: list[str]) -> pa.Table:
    """``keys`` and n, summed."""
    return rows.group_by(keys, use_threads=False).aggregate([("n", "sum")]).rename_columns([*keys, "n"])


def _heads(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From rows sorted by the place of their head: the edges and the nodes that are frequent, and counts of first words."""

    def sized(rows: pa.Table, gram: pa.ChunkedArray, size: int) -> Iterator[pa.RecordBatch]:
        sizes = pa.array(np.full(len(rows), size, np.int32))
        yield from pa.table([rows["lang"], gram, sizes, rows["n"]], schema=_COUNTS).to_batches()

    def of_whole_heads(rows: pa.Table) -> tuple[pa.Table, Iterator[pa.RecordBatch]]:
        grams = _summed(rows, ["lang", "head", "last"])
        nodes = _summed(grams, ["lang", "head"])
        first = pc.list_element(pc.split_pattern(nodes["head"], " ", max_splits=1), 0)
        edges = grams.filter(pc.and_(pc.greater_equal(grams["n"], least), pc.not_equal(grams["last"], "")))
        nodes_out = nodes.filter(pc.and_(pc.greater_equal(nodes["n"], least), pc.match_substring(nodes["head"], " ")))
        words = _summed(pa.table({"lang": nodes["lang"], "gram": first, "n": nodes["n"]}), ["lang", "gram"])
        whole = pc.binary_join_element_wise(edges["head"], edges["last"], " ")
        return words, chain(sized(edges, whole, 3), sized(nodes_out, nodes_out["head"], 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        words: list[pa.Table] = []
        n_held, full = 0, HELD

        def count(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            counted, found = of_whole_heads(rows)
            words.append(counted)
            yield from found
            if sum(map(len, words)) > HELD:
                together = _summed(pa.concat_tables(words), ["lang", "gram"])
                words[:] = [together]
                if len(together) > HELD // 2:
                    yield from sized(together, together["gram"], 1)
                    words.clear()

        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            n_held += len(batch)
            if n_held < full:
                continue
            rows = pa.concat_tables(held)
            place = rows["place"].to_numpy()
            cut = int(np.searchsorted(place, place[-1]))  # the last head may go on in the next batch
            if cut:
                yield from count(rows.slice(0, cut))
            rest = _summed(rows.slice(cut), ["place", "lang", "head", "last"])
            held, n_held = [rest], len(rest)
            full = n_held + HELD
        if n_held:
            yield from count(pa.concat_tables(held))
        if words:
            together = _summed(pa.concat_tables(words), ["lang", "gram"])
            yield from sized(together, together["gram"], 1)

    return run


def frequent(docs: DataFrame, least: int) -> DataFrame:
    """lang, gram, size, n: all grams of two and three words that occur ``least`` times, and parts of the counts of words."""
    head = F.substring_index("gram", " ", 2)
    met = _occurring(docs, 3).repartition("lang", head).select(
        "lang", head.alias("head"), F.expr("substring(gram, length(substring_index(gram, ' ', 2)) + 2)").alias("last"), "n"
    )
    placed = met.withColumn("place", F.xxhash64("lang", "head")).sortWithinPartitions("place")
    return placed.select("place", "lang", "head", "last", "n").mapInArrow(_heads(least), "lang string, gram string, size int, n long")


def _size(gram: str | Column) -> Column:
    """Number of words."""
    gram = F.col(gram) if isinstance(gram, str) else gram
    return F.length(gram) - F.length(F.replace(gram, F.lit(" "))) + 1


def _first(gram: str, words: int) -> Column:
    return F.substring_index(gram, " ", words)


def _rest(gram: str, words: int) -> Column:
    """The gram without its first words."""
    return F.expr(f"substring({gram}, length(substring_index({gram}, ' ', {words})) + 2)")


def flow(grams: DataFrame, words: int, least: int = 1) -> DataFrame:
    """lang, gram, n of all grams of so many words that occur ``least`` times: edges and piece ends that begin with them."""
    long_enough = grams.where(_size("gram") >= words) if words > 1 else grams
    return (
        long_enough.groupBy("lang", _first("gram", words).alias("gram"))
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
    )


def graph(grams: DataFrame, nodes: DataFrame, longest: int, least: int) -> DataFrame:
    """lang, gram, n, head, tail, n_head, n_tail of the edges that occur ``least`` times: their nodes and those's flow."""
    edges = grams.where((_size("gram") == longest) & (F.col("n") >= least)).withColumns(
        {"head": _first("gram", longest - 1), "tail": _rest("gram", 1)}
    )
    for side in ("head", "tail"):
        edges = edges.join(nodes.select("lang", F.col("gram").alias(side), F.col("n").alias(f"n_{side}")), ["lang", side])
    return edges.select("lang", "gram", "n", "head", "tail", "n_head", "n_tail")


def compact(edges: DataFrame) -> DataFrame:
    """``edges`` with path (its first edge) and place (from 0): chains over unary nodes are one path.

    Each round doubles the distance that an edge looks back; no chain is a circle, as some piece begins it.
    """
    into = edges.where("n = n_tail").select("lang", F.col("tail").alias("head"), F.col("gram").alias("path"))
    state = saved(
        edges.join(into.withColumn("place", F.lit(1).cast("long")), ["lang", "head"], "left").select(
            *edges.columns,
            F.when(F.col("n") == F.col("n_head"), F.col("path")).alias("path"),
            F.when(F.col("n") == F.col("n_head"), F.col("place")).alias("place"),
        ).withColumns({"path": F.coalesce("path", "gram"), "place": F.coalesce("place", F.lit(0))}),
        "paths",
    )
    while True:
        back = state.where("place > 0").select("lang", F.col("gram").alias("path"), F.col("path").alias("earlier"), F.col("place").alias("more"))
        jumped = state.join(back, ["lang", "path"], "left").select(
            *edges.columns,
            F.coalesce("earlier", "path").alias("path"),
            (F.col("place") + F.coalesce("more", F.lit(0))).alias("place"),
            F.col("more").isNotNull().alias("moved"),
        )
        after = saved(jumped, "paths")
        moved = not after.where("moved").isEmpty()
        drop_saved(state)
        state = after
        if not moved:
            return state.drop("moved")


def paths(edges: DataFrame) -> DataFrame:
    """lang, path, phrase, n_edges, n, head, tail of each path of ``compact``'s result: its words and end nodes."""
    step = F.struct("place", F.substring_index("gram", " ", -1).alias("word"))
    grouped = edges.groupBy("lang", "path").agg(
        F.max("n").alias("n"),
        F.count("*").alias("n_edges"),
        F.min_by("head", "place").alias("head"),
        F.max_by("tail", "place").alias("tail"),
        F.sort_array(F.collect_list(step)).alias("steps"),
    )
    words = F.transform("steps", lambda s: s["word"])
    return grouped.select("lang", "path", F.concat_ws(" ", "head", words).alias("phrase"), "n_edges", "n", "head", "tail")


def _score(a: str, left: str, right: str) -> Column:
    wide = {c: f"cast({c} as decimal(38,0))" for c in (a, left, right)}
    return F.expr(f"(cast(1000000 as decimal(38,0)) * {wide[a]} * {wide[a]}) div ({wide[left]} * {wide[right]})")


def collocations(docs: DataFrame, *, least: int = MIN_COUNT, share: int = SHARE, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, path of each language's first phrases of two and three words.

    ``path`` is the phrase of the compacted path that a phrase of three words lies on.
    """
    counts = saved(frequent(docs, least), "counts")
    every_word = saved(counts.where("size = 1").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "words")
    totals = every_word.groupBy("lang").agg(F.sum("n").alias("total"))
    words = every_word.where(F.col("n") >= least)
    pairs = counts.where("size = 2").drop("size")
    edges = compact(graph(counts.where("size = 3").drop("size"), pairs, 3, least))
    chains = saved(paths(edges), "chains")

    # Nodes inside a path are in an edge as frequent as they are; the others are held against the ends of paths.
    inside = edges.where("place > 0").select("lang", F.col("head").alias("gram"))
    ends = chains.select("lang", F.explode(F.array("head", "tail")).alias("gram"), F.col("n").alias("around"))
    heaviest = ends.groupBy("lang", "gram").agg(F.max("around").alias("around"))
    stands = 100 * F.col("around").cast("decimal(38,0)") >= share * F.col("n").cast("decimal(38,0)")
    alone = (
        pairs.join(inside, ["lang", "gram"], "left_anti")
        .join(heaviest, ["lang", "gram"], "left")
        .where(~F.coalesce(stands, F.lit(False)))
    )

    def with_word(df: DataFrame, word: Column, name: str) -> DataFrame:
        """The count of one word of each row, as ``name``."""
        found = words.select(F.col("lang"), F.col("gram").alias("_word"), F.col("n").alias(name))
        return df.withColumn("_word", word).join(found, ["lang", "_word"]).drop("_word")

    two = with_word(with_word(alone, _first("gram", 1), "l"), F.substring_index("gram", " ", -1), "r")
    two = two.select("lang", F.col("gram").alias("phrase"), F.col("n").alias("a"), "l", "r", _score("n", "l", "r").alias("score"), F.lit(None).cast("string").alias("path"))
    three = with_word(with_word(edges, _first("gram", 1), "n_first"), F.substring_index("gram", " ", -1), "n_last")
    cuts = F.array(
        F.struct(_score("n", "n_first", "n_tail").alias("score"), F.lit(1).alias("k"), F.col("n_first").alias("l"), F.col("n_tail").alias("r")),
        F.struct(_score("n", "n_head", "n_last").alias("score"), F.lit(2).alias("k"), F.col("n_head").alias("l"), F.col("n_last").alias("r")),
    )
    three = three.withColumn("cut", F.array_min(cuts)).join(chains.select("lang", "path", F.col("phrase").alias("chain")), ["lang", "path"])
    three = three.select("lang", F.col("gram").alias("phrase"), F.col("n").alias("a"), "cut.l", "cut.r", "cut.score", F.col("chain").alias("path"))

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = two.unionByName(three).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score", "path"
    )


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language, with their counts and scores."""
    return collocations(table(spark, sf_dir, "documents").select("text", "lang")).drop("path")


ORACLE_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, [w FOR w IN regexp_split_to_array(piece, '[ \t]+') IF w <> ''] AS ws FROM pieces
), occurrences AS (
    SELECT lang, size, array_to_string(ws[i:i + size - 1], ' ') AS phrase
    FROM worded, unnest(range(1, len(ws) + 1)) AS p(i), (VALUES (1), (2), (3)) AS s(size)
    WHERE i + size - 1 <= len(ws)
), counted AS (
    SELECT lang, size, phrase, count(*) AS f, str_split(phrase, ' ') AS ws FROM occurrences GROUP BY lang, size, phrase
), totals AS (
    SELECT lang, sum(len(ws)) AS n FROM worded GROUP BY lang
), candidates AS (
    SELECT * FROM counted WHERE size > 1 AND f >= 10
), dropped AS (
    SELECT lang, array_to_string(ws[i:i + 1], ' ') AS phrase, max(f) AS longer
    FROM candidates, (VALUES (1), (2)) AS s(i) WHERE size = 3 GROUP BY ALL
), stays AS (
    SELECT c.* FROM candidates c LEFT JOIN dropped d USING (lang, phrase)
    WHERE c.size = 3 OR d.longer IS NULL OR 100 * d.longer < 50 * c.f
), cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r,
        (1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS score
    FROM stays c JOIN (VALUES (1), (2)) AS s(k) ON k < c.size
    JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:k], ' ')
    JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[k + 1:c.size], ' ')
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER w AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM lowest JOIN totals USING (lang)
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY rank <= 2000
"""
