"""Secret scans with ownership frequency over the corpus.

Candidates are matches of four kinds: the three base kinds (assignments, access keys, long
hexadecimal runs) and ``opaque``, other unbroken tokens of 20 characters or more that mix letters
and digits. For every candidate value the corpus is asked how many repositories and how many owners
it occurs in. An owner is a source. A repository is a distinct text, so copies of one text, under whatever owner, are one.

A value is a widely copied example if both counts say so: at least ``EXAMPLE_OWNERS`` owners and
``EXAMPLE_REPOSITORIES`` repositories. So a key whose only other occurrence is a copy of its text is still live. A value
in ``PLACEHOLDER_REPOSITORIES`` repositories or more is an example even with a single owner. All others look live.

Base spans are always reported. The method adds the opaque spans whose values look live, and says of
every value which it is: n_live and n_example count the reported spans of a document.

Places are running sums over the matches of a document, and opaque spans meet base spans in order of their starts,
so the time of a text grows with its matches and not with their square. Values meet by a 128-bit hash. Owners and
repositories are counted apart and before the values are brought together, so a value that a third of all documents
carry is spread by its repositories.

Defined results: a null or empty text has no spans. A null owner is an owner of its own. Rows that repeat a
doc_id, null or not, are reported each, and are one repository if their texts are equal. Columns
other than doc_id, text and source are not read. A text's spans must fit in a task.

All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from factorframe.llm.common import saved, table

#: Letters match in either case, ASCII ones only. Of an assignment the second group is the value.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
# A longest run of 18 or 16 characters is what the shorter patterns with a check of the length would find.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
OPAQUE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "opaque")
#: So many owners and so many repositories, both, make a value an example.
EXAMPLE_OWNERS = 2
EXAMPLE_REPOSITORIES = 3
#: So many repositories do it whoever owns them.
PLACEHOLDER_REPOSITORIES = 100


_PATTERNS = (ASSIGN, ACCESS, HEX, OPAQUE)
_MARKS = "array<struct<kind:int,nth:int,gap:int,length:int,value:binary,wanted:boolean>>"


def _marks(kind: int, found: Column, secret=lambda match: match, wanted=lambda value: F.lit(True)) -> Column:
    """The matches ``found`` of a pattern in the text, in order, each with the gap before it.

    The parts between matches and the matches themselves, in turn, are the text; their lengths give the places. Matches
    that are not ``wanted`` are among them, as the places of later ones need them. A text without matches is not split.
    """
    gaps = F.slice(F.split("text", _PATTERNS[kind], -1), 1, F.size(found))
    steps = F.zip_with(gaps, found, lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m).alias("length"), secret(m).alias("value")))
    marks = F.transform(
        steps,
        lambda s, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("nth"),
            s["gap"].alias("gap"),
            s["length"].alias("length"),
            F.unhex(F.md5(s["value"])).alias("value"),
            wanted(s["value"]).alias("wanted"),
        ),
    )
    return F.when(F.size(found) > 0, marks).otherwise(F.array().cast(_MARKS))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, owner, repository (both hashed), and ``marks``, its matches of all kinds."""
    group = lambda m: F.regexp_extract(m, ASSIGN, 2)
    # The matches are columns of their own: they are used more than once, and each text is searched once a pattern.
    searched = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("owner"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).select("*", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(k) for k, p in zip(KINDS, _PATTERNS, strict=True)])
    return searched.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.unhex(F.md5("owner")).alias("owner"),
        F.unhex(F.md5("text")).alias("repository"),
        F.concat(
            _marks(0, F.col("assign"), group, lambda v: F.length(v) >= ASSIGN_LEAST),
            _marks(1, F.col("access")),
            _marks(2, F.col("hex")),
            _marks(3, F.col("opaque"), wanted=lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]")),
        ).alias("marks"),
    )


def candidates(scanned: DataFrame) -> DataFrame:
    """row, owner, repository, kind, start, end and value of every candidate of a table that ``scan`` gave."""
    per_kind = Window.partitionBy("row", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    # Both frames run from the first row on: spans that start no later, and spans that start no earlier.
    before = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("row").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0)
    is_base = F.col("kind") < 3
    return (
        scanned.where(F.size("marks") > 0)
        .select("row", "owner", "repository", F.inline("marks"))
        .repartition("row")
        .withColumn("end", F.sum(F.col("gap") + F.col("length")).over(per_kind))
        .withColumn("start", F.col("end") - F.col("length"))
        .where("wanted")
        .withColumn("last_end", F.max(F.when(is_base, F.col("end"))).over(before))
        .withColumn("next_start", F.min(F.when(is_base, F.col("start"))).over(after))
        .where(
            is_base
            | (
                F.coalesce(F.col("last_end") <= F.col("start"), F.lit(True))
                & F.coalesce(F.col("next_start") >= F.col("end"), F.lit(True))
            )
        )
        .select("row", "owner", "repository", "kind", "start", "end", "value")
    )


def ownership(found: DataFrame) -> DataFrame:
    """value, owners and repositories of every candidate value."""
    return found.groupBy("value").agg(
        F.count_distinct("owner").alias("owners"), F.count_distinct("repository").alias("repositories")
    )


def scan_secrets(
    docs: DataFrame,
    *,
    example_owners: int = EXAMPLE_OWNERS,
    example_repositories: int = EXAMPLE_REPOSITORIES,
    placeholder_repositories: int = PLACEHOLDER_REPOSITORIES,
) -> DataFrame:
    """Per document: counts of the base kinds, base and all spans as text, counts of live and example spans."""
    scanned = saved(scan(docs), "secrets")
    found = saved(candidates(scanned), "spans")
    copied = (F.col("owners") >= example_owners) & (F.col("repositories") >= example_repositories)
    example = copied | (F.col("repositories") >= placeholder_repositories)
    of_kind = lambda kind: F.count_if(F.col("kind") == kind)
    judged = (
        found.join(ownership(found).select("value", example.alias("example")), "value")
        .where((F.col("kind") < 3) | ~F.col("example"))
        .groupBy("row")
        .agg(
            F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"),
            of_kind(0).alias("n_assign"),
            of_kind(1).alias("n_access"),
            of_kind(2).alias("n_hex"),
            F.count_if(~F.col("example")).alias("n_live"),
            F.count_if("example").alias("n_example"),
        )
    )
    name = lambda s: F.concat(
        F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1), F.lit(":"), s["start"], F.lit(":"), s["end"]
    )
    joined = lambda spans: F.coalesce(F.array_join(F.transform(spans, name), ","), F.lit(""))
    count = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    out = scanned.select("row", "doc_id").join(judged, "row", "left")
    return out.select(
        "doc_id",
        *map(count, ("n_assign", "n_access", "n_hex")),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] < 3)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        *map(count, ("n_live", "n_example")),
    )


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def _sql_spans(kind: int, pattern: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
    SELECT doc_id, source, repository, {kind} AS kind, m AS found,
        (list_sum([length(x) FOR x IN gaps[1:i]]) + coalesce(list_sum([length(x) FOR x IN hits[1:i - 1]]), 0))::BIGINT AS start
    FROM (
        SELECT doc_id, source, md5(text) AS repository,
            regexp_extract_all(text, '{quoted}') AS hits, string_split_regex(text, '{quoted}') AS gaps
        FROM documents WHERE regexp_matches(text, '{quoted}')
    ), unnest(range(1, len(hits) + 1)) AS n(i), unnest([hits[i]]) AS h(m)"""


# Patterns and bounds are written out here, so that an error in those above shows.
_SQL_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)"""
_SQL_PATTERNS = (_SQL_ASSIGN, "AKIA[A-Z0-9]+", "[0-9a-f]{16,}", "[A-Za-z0-9+/_=-]{20,}")
ORACLE_SQL = f"""
WITH found AS (
    {" UNION ALL ".join(_sql_spans(k, p) for k, p in enumerate(_SQL_PATTERNS))}
), measured AS (
    SELECT doc_id, source, repository, kind, start, start + length(found) AS stop,
        CASE kind WHEN 0 THEN regexp_extract(found, '{_SQL_ASSIGN.replace("'", "''")}', 2) ELSE found END AS value
    FROM found
), base AS (
    SELECT * FROM measured WHERE kind = 2 OR kind = 1 AND length(value) >= 18 OR kind = 0 AND length(value) >= 12
), opaque AS (
    SELECT m.* FROM measured m
    WHERE m.kind = 3 AND regexp_matches(m.value, '[0-9]') AND regexp_matches(m.value, '[A-Za-z]')
        AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = m.doc_id AND b.start < m.stop AND m.start < b.stop)
), spans AS (
    SELECT * FROM base UNION ALL SELECT * FROM opaque
), counted AS (
    SELECT value, count(DISTINCT coalesce('=' || source, '')) AS owners, count(DISTINCT repository) AS repositories
    FROM spans GROUP BY value
), judged AS (
    SELECT s.*, NOT (c.owners >= 2 AND c.repositories >= 3 OR c.repositories >= 100) AS live,
        ['assign', 'access', 'hex', 'opaque'][kind + 1] || ':' || start || ':' || stop AS name
    FROM spans s JOIN counted c USING (value)
), reported AS (
    SELECT * FROM judged WHERE kind < 3 OR live
), listed AS (
    SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
        count(*) FILTER (kind = 2) AS n_hex,
        string_agg(name, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
        string_agg(name, ',' ORDER BY start, kind) AS spans,
        count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example
    FROM reported GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
    coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM documents d LEFT JOIN listed USING (doc_id)
"""
