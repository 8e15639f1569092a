"""Near-duplicate groups by MinHash, with sequential Bayesian verification.

1. A document becomes its set of n-word shingles, and that a MinHash signature. Documents with the
   same set are one class; only the least id of a class goes on.
2. Signatures are cut into bands. In a bucket (equal bands) every member is paired with the bucket's
   centre, the least member: as many pairs as members.
3. A pair's signatures are compared batch by batch. After each batch the posterior of the similarity (a
   uniform prior, so Beta) tells how likely it still reaches the threshold; below ``miss`` the pair is dropped.
4. The survivors are verified on the full sets. Links are confirmed only there.
5. A bucket whose members are all in one component needs nothing more. In the others, members of
   different components may be linked past the centre: these buckets are cut into blocks, blocks meet in
   pairs in a task, and pairs across components take steps 3 and 4 there. Only links leave the task, and
   only those that join components.
6. Components of all links; their least id names them.

Bands are as many as keep the chance to miss a pair at the threshold below ``miss``.

Defined results: texts without words, and null ones, have no shingles and are linked with nothing. A document of fewer
than n words has one shingle, all its words. Rows under one doc_id are one document. A null doc_id is never linked: its
component is null and it is kept. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from math import ceil, comb, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from factorframe.llm.common import Batcher, WordHashes, drop_saved, id_texts, mix, rows_of, saved, shingle_set, spread, table
from factorframe.llm.components import components

_BLOCK = 256


@dataclass(frozen=True)
class Rule:
    """Similarity of ``percent`` or more over ``words``-word shingles; ``miss`` bounds each step's chance to lose a link."""

    words: int = 5
    percent: int = 80
    miss: float = 1e-5
    band_rows: int = 5
    batch: int = 25

    @property
    def bands(self) -> int:
        return ceil(log(self.miss) / log(1 - (self.percent / 100) ** self.band_rows))

    @property
    def hashes(self) -> int:
        return self.bands * self.band_rows

    def least_matches(self) -> list[tuple[int, int]]:
        """After so many hashes compared, how many must have matched for the pair to go on."""
        t, out = self.percent / 100, []
        for n in range(self.batch, self.hashes + 1, self.batch):
            # With m matches the posterior is Beta(m + 1, n - m + 1): it exceeds t as often as n + 1 draws give at most m.
            chance, m = 0.0, -1
            while m < n and chance < self.miss:
                m += 1
                chance += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            out.append((n, m))
        return out


_SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("signature", pa.binary())])


def minhash(shingles: np.ndarray, hashes: int) -> np.ndarray:
    """The least of each of so many hash functions over a set."""
    k = np.arange(1, hashes + 1, dtype=np.uint64)
    a = (mix(k * np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    b = mix(k + np.uint64(1 << 40)).astype(np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(hashes, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        np.minimum(out, (a[:, None] * x[None, at : at + 2048] + b[:, None]).min(1), out=out)
    return out


def signatures(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, number of shingles, a digest of the set and the signature; both null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, hashes = Batcher(_SETS, 10_000), WordHashes()
        for batch in batches:
            for doc_id, text in rows_of(batch):
                words = (text or "").encode("utf-8", "surrogatepass").lower().split()
                found = shingle_set(hashes.of(words), rule.words)
                digest = blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None
                signature = minhash(found, rule.hashes).tobytes() if len(found) else None
                if full := out.add(doc_id, len(found), digest, signature):
                    yield full
        yield out.flush()

    return id_texts(docs).mapInArrow(run, "doc_id long, n long, digest binary, signature binary")


def _shingle_sets(docs: DataFrame, rule: Rule) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, hashes = Batcher(schema, 10_000, 8 << 20), WordHashes()
        for batch in batches:
            for doc_id, text in rows_of(batch):
                words = (text or "").encode("utf-8", "surrogatepass").lower().split()
                found = shingle_set(hashes.of(words), rule.words).tobytes()
                if full := out.add(doc_id, found, weight=len(found)):
                    yield full
        yield out.flush()

    return docs.mapInArrow(run, "doc_id long, shingles binary")


def _surviving(x: np.ndarray, y: np.ndarray, rule: Rule) -> np.ndarray:
    """Which rows of two signature matrices go on after all batches."""
    alive, matched, before = np.arange(len(x)), np.zeros(len(x), np.int64), 0
    for n, least in rule.least_matches():
        matched[alive] += (x[alive, before:n] == y[alive, before:n]).sum(1)
        alive, before = alive[matched[alive] >= least], n
        if not len(alive):
            break
    return alive


def _matrix(signatures, rule: Rule) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), np.uint32).reshape(-1, rule.hashes)


def _promising(x: Column, y: Column, rule: Rule) -> Column:
    """Whether a pair of signatures survives the batches."""

    @F.pandas_udf("boolean")
    def compare(x: pd.Series, y: pd.Series) -> pd.Series:
        out = np.zeros(len(x), bool)
        for at in range(0, len(x), 2_000):
            part = slice(at, at + 2_000)
            out[at + _surviving(_matrix(x[part], rule), _matrix(y[part], rule), rule)] = True
        return pd.Series(out)

    return compare(x, y)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    both = np.sort(np.concatenate([a, b]), kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _shared(x: Column, y: Column) -> Column:
    """Size of the intersection of two sets of shingles."""

    @F.pandas_udf("long")
    def count(x: pd.Series, y: pd.Series) -> pd.Series:
        pairs = zip(x, y, strict=True)
        return pd.Series([_common(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in pairs], dtype="int64")

    return count(x, y)


def _sets_of(wanted: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id and full set of the wanted ids, written."""
    return saved(_shingle_sets(id_texts(docs).join(wanted.distinct(), "doc_id", "left_semi"), rule), "shingles")


def _confirmed(pairs: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), docs, rule)
    size = lambda c: (F.length(c) / 8).cast("long")
    both = (
        pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b")
        .join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a")
        .select("a", "b", (size("sa") + size("sb")).alias("total"), _shared(F.col("sa"), F.col("sb")).alias("shared"))
    )
    links = saved(
        both.where(100 * F.col("shared") >= rule.percent * (F.col("total") - F.col("shared"))).select("a", "b"), "links"
    )
    drop_saved(sets)
    return links


def _across(mixed: DataFrame, rule: Rule) -> DataFrame:
    """Links between components in the buckets of ``mixed`` (key, band, members, doc_id, n, component, signature, shingles).

    A bucket of more than a block's rows is cut by a hash of the id; each pair of blocks is a group, of
    bounded size whatever the bucket's. A pair is looked at in the first band that it shares only, and not at
    all once other links have joined its components, so a group gives fewer links than it has rows.
    """
    blocks = F.ceil(F.col("members") / _BLOCK).cast("int")
    own = F.pmod(F.xxhash64("doc_id", F.lit(7)), blocks).cast("int")
    columns = ["band", "own", "doc_id", "n", "component", "signature", "shingles"]
    groups = (
        mixed.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *columns)
        .repartition(spread(mixed, 2), "key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
    )

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        sig, ids = _matrix(rows["signature"], rule), rows["doc_id"].to_numpy()
        comp, n, own = (rows[c].to_numpy().copy() for c in ("component", "n", "own"))
        sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
        one_block = rows["i"].iat[0] == rows["j"].iat[0]
        earlier = sig[:, : int(rows["band"].iat[0]) * rule.band_rows].reshape(len(rows), -1, rule.band_rows)
        a, b = [], []
        for k in range(len(rows) - 1):
            rest = slice(k + 1, None)
            fit = (comp[rest] != comp[k]) & (100 * np.minimum(n[rest], n[k]) >= rule.percent * np.maximum(n[rest], n[k]))
            if not one_block:
                fit &= own[rest] != own[k]
            at = k + 1 + np.flatnonzero(fit)
            at = at[~(earlier[at] == earlier[k]).all(2).any(1)]
            if len(at):
                at = at[_surviving(np.broadcast_to(sig[k], (len(at), rule.hashes)), sig[at], rule)]
            for v in at:
                if comp[v] == comp[k]:
                    continue
                shared = _common(sets[k], sets[v])
                if 100 * shared >= rule.percent * (len(sets[k]) + len(sets[v]) - shared):
                    a.append(min(ids[k], ids[v]))
                    b.append(max(ids[k], ids[v]))
                    comp[comp == comp[v]] = comp[k]
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for rows in batches:
            if rows.empty:
                continue
            if held is not None:
                rows = pd.concat([held, rows], ignore_index=True)
            last = rows[["key", "i", "j"]].iloc[-1]
            tail = (rows[["key", "i", "j"]] == last).all(axis=1).to_numpy()
            held = rows[tail]
            for _, group in rows[~tail].groupby(["key", "i", "j"], sort=False):
                yield meet(group)
        if held is not None:
            yield meet(held)

    return groups.mapInPandas(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    base = saved(signatures(docs, rule), "signatures")
    classes = base.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    classes = saved(classes, "classes")
    reps = base.where("digest IS NOT NULL").join(
        classes.select(F.col("rep").alias("doc_id"), "digest"), ["doc_id", "digest"], "left_semi"
    )
    reps = saved(reps.select("doc_id", "n", "signature").dropDuplicates(["doc_id"]), "representatives")

    width = 4 * rule.band_rows
    keys = F.array(
        *[F.xxhash64(F.lit(i), F.substring("signature", i * width + 1, width)) for i in range(rule.bands)]
    )
    banded = reps.select("doc_id", "n", F.posexplode(keys).alias("band", "key"))
    buckets = banded.groupBy("key").agg(F.min("doc_id").alias("centre"), F.count("*").alias("members")).where("members > 1")
    members = saved(banded.join(buckets, "key"), "buckets")

    star = members.where("doc_id <> centre").select(F.col("centre").alias("a"), F.col("doc_id").alias("b")).distinct()
    of = lambda c: reps.select(F.col("doc_id").alias(c), F.col("n").alias(f"n{c}"), F.col("signature").alias(f"s{c}"))
    fit = 100 * F.least("na", "nb") >= rule.percent * F.greatest("na", "nb")
    tried = star.join(of("b"), "b").join(of("a"), "a").where(fit).where(_promising(F.col("sa"), F.col("sb"), rule))
    tried = saved(tried.select("a", "b"), "pairs")
    links = _confirmed(tried, docs, rule)
    joined = components(links)

    # Buckets of three and more that are not yet one component.
    component = joined.select(F.col("u").alias("doc_id"), F.col("v").alias("component"))
    labelled = members.where("members > 2").join(component, "doc_id", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "doc_id")).drop("centre")
    split = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    mixed = saved(labelled.join(split.select("key"), "key", "left_semi"), "mixed")
    if not mixed.isEmpty():
        sets = _sets_of(mixed.select("doc_id"), docs, rule)
        full = mixed.join(reps.select("doc_id", "signature").join(sets.dropDuplicates(["doc_id"]), "doc_id"), "doc_id")
        more = saved(_across(full, rule), "links")
        if not more.isEmpty():
            first = joined
            joined = components(first.select(F.col("u").alias("a"), F.col("v").alias("b")).union(more))
            drop_saved(first)
        drop_saved(sets, more)
    drop_saved(members, mixed, tried, links, reps)

    named = (
        base.select("doc_id", "n", "digest")
        .join(classes, "digest", "left")
        .join(joined.select(F.col("u").alias("rep"), F.col("v").alias("least")), "rep", "left")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "rep", "doc_id"))
    return named.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def op10_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Rule(words=3, percent=85))


ORACLE_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS shingle FROM words, unnest(range(1, len(w) - 1)) AS u(i)
    UNION ALL
    SELECT doc_id, array_to_string(w, ' ') FROM words WHERE len(w) BETWEEN 1 AND 2
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM shingles a JOIN shingles b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)
), ways AS (
    SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
    SELECT DISTINCT x AS doc_id, x AS other FROM ways
    UNION
    SELECT r.doc_id, w.y FROM reach r JOIN ways w ON w.x = r.other
), components AS (
    SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(c.least, d.doc_id) AS component_id,
    coalesce(c.least, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN components c USING (doc_id)
"""
