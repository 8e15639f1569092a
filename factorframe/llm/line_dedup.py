"""Line de-duplication by overlapping three-line windows.

Every run of three consecutive lines that hold a word is a window, known by a 128-bit hash of its lines. A
window that occurs more than once in the corpus stays where it occurs first (by doc_id, then by place) and
is removed wherever it comes later. Windows overlap, so the removed positions of a document are merged
into ranges before its text is cut. Windows are judged on the input, not on what is left.

Blank lines (no character but white space) take no part: they do not interrupt a window and are never removed. Lines
are compared without white space at their ends.

Defined results: a null text stays null, an empty one stays empty, and both have nothing removed; so have
texts of fewer than three lines with a word. Equal windows inside one document count too, the first stays; lines
that the first shares with a later one that overlaps it go with the later one.
Rows that repeat a doc_id with an equal text are the same document and are treated alike; with another text they are
ordered by a hash of it. A null doc_id comes before all others. Columns other than doc_id and text are carried along.

All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from factorframe.llm.common import table, whole_rows

#: White space at the ends of a line, for SQL's ``trim``.
_BLANK = " \t\r\f\v"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _windows(docs: DataFrame, size: int) -> DataFrame:
    """Per document (_id, _text_hash): hash of each window and the positions of its lines."""
    kept = F.filter(
        F.transform(_lines(F.col("_text")), lambda x, i: F.struct(i.alias("at"), F.btrim(x, F.lit(_BLANK)).alias("line"))),
        lambda x: x["line"] != "",
    )
    n = F.size("_l") - (size - 1)
    runs = F.arrays_zip(*[F.slice("_l", i + 1, n).alias(f"l{i}") for i in range(size)])
    hashes = F.transform(
        runs,
        lambda r: F.struct(
            F.unhex(F.md5(F.concat_ws("\n", *[r[f"l{i}"]["line"] for i in range(size)]))).alias("hash"),
            F.array(*[r[f"l{i}"]["at"] for i in range(size)]).alias("places"),
        ),
    )
    return (
        docs.select("_id", "_text_hash", kept.alias("_l"))
        .select("_id", "_text_hash", F.explode(F.when(n > 0, hashes)).alias("w"))
        .select("_id", "_text_hash", "w.hash", "w.places")
    )


def _removed_ranges(windows: DataFrame) -> DataFrame:
    """Per document the ranges of removed positions, (first, last), merged and in order."""
    spot = F.struct(F.col("_id"), F.col("_text_hash"), F.col("places")[0].alias("at"))
    repeated = (
        windows.groupBy("hash")
        .agg(F.min(spot).alias("first"), F.max(spot).alias("final"))
        .where("first <> final")
        .select("hash", "first")
    )
    later = windows.join(repeated, "hash").where(spot != F.col("first"))
    doc = Window.partitionBy("_id", "_text_hash").orderBy("at")
    return (
        later.select("_id", "_text_hash", F.explode("places").alias("at"))
        .distinct()
        .withColumn("island", F.col("at") - F.row_number().over(doc))
        .groupBy("_id", "_text_hash", "island")
        .agg(F.min("at").alias("from"), F.max("at").alias("to"))
        .groupBy("_id", "_text_hash")
        .agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("_gone"))
    )


def dedup_lines(docs: DataFrame, *, size: int = 3, keep_names: bool = False) -> DataFrame:
    """All documents with the columns they have, ``text`` cut, and n_lines and n_removed_lines (long) added.

    The added columns replace ones of the same name; with ``keep_names`` all columns as they were are in
    the struct ``row``, beside text, n_lines and n_removed_lines.
    """
    own = docs.columns
    keyed = docs.select(
        whole_rows(docs),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_id"),
        F.col("text").alias("_text"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("_text_hash"),
    )
    gone = _removed_ranges(_windows(keyed.select("_id", "_text_hash", "_text"), size))
    joined = keyed.join(gone, ["_id", "_text_hash"], "left")
    lines = _lines(F.col("_text"))
    n = F.size("_lines")
    # What stays lies between the ranges: from the end of one to the start of the next.
    starts = F.concat(F.array(F.lit(0)), F.transform("_gone", lambda g: g["to"] + 1))
    ends = F.concat(F.transform("_gone", lambda g: g["from"]), F.array(n))
    stays = F.filter(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda s: s["a"] < s["b"])
    parts = F.transform(stays, lambda s: F.array_join(F.slice("_lines", s["a"] + 1, s["b"] - s["a"]), "\n"))
    gone_lines = F.aggregate("_gone", F.lit(0).cast("long"), lambda x, g: x + (g["to"] - g["from"] + 1))
    cut = joined.withColumns(
        {
            "_lines": F.when(F.col("_gone").isNotNull(), lines),
            "n_lines": _count_lines(F.col("_text")),
            "n_removed_lines": F.coalesce(gone_lines, F.lit(0)).cast("long"),
        }
    ).withColumn("text", F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(parts, "\n")))
    made = ("n_lines", "n_removed_lines")
    if keep_names:
        return cut.select("row", "text", *made)
    kept = [F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in own if c not in made]
    return cut.select(*kept, *made)


def _count_lines(text: Column) -> Column:
    return F.coalesce(F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1, F.lit(0)).cast("long")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed_lines and the text that is left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed_lines", "text")


ORACLE_SQL = r"""
WITH split AS (
    SELECT doc_id, text, str_split(text, chr(10)) AS parts FROM documents
), numbered AS (
    SELECT doc_id, u.pos - 1 AS pos, trim(parts[u.pos], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line
    FROM split, unnest(range(1, len(parts) + 1)) AS u(pos)
), windows AS (
    SELECT doc_id, pos,
        lead(pos, 1) OVER w AS pos2, lead(pos, 2) OVER w AS pos3,
        line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS body
    FROM numbered WHERE line <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, pos) AS nth FROM windows WHERE body IS NOT NULL
), gone AS (
    SELECT DISTINCT doc_id, unnest([pos, pos2, pos3]) AS pos FROM ranked WHERE nth > 1
), counted AS (
    SELECT doc_id, count(*) AS n, list(pos) AS places FROM gone GROUP BY doc_id
)
SELECT s.doc_id, coalesce(len(s.parts), 0)::BIGINT AS n_lines, coalesce(g.n, 0)::BIGINT AS n_removed_lines,
    CASE WHEN g.n IS NULL THEN s.text
         ELSE coalesce(array_to_string([p FOR p, i IN s.parts IF NOT list_contains(g.places, i - 1)], chr(10)), '') END AS text
FROM split s LEFT JOIN counted g USING (doc_id)
"""
