"""Approximate nearest neighbours by inner product, from randomly rotated one-bit codes.

A vector is its cell's centre and a residual. The residual's direction is padded with zeros, turned by a random
rotation and kept as the signs of what comes out: one bit a dimension, ``BITS`` bits for each dimension of the vector.
Two scalars belong to a code: how long the residual is over how well the signs point its way (the correction), and how
far the estimate may be off. The inner product of a turned query with the corrected signs is an unbiased estimate of
the one with the residual, and its error is that of a random direction: within ``SPREADS`` standard deviations of the
bound that the scalar gives, but for about one in a thousand.

* **Index.** Centres and rotation are fitted on a bounded sample (``SAMPLE`` rows, the first by a hash of their id) and
  sent with the tasks. Every vector is coded. Codes lie in blocks of about ``BLOCK`` vectors of one cell, a row each:
  ids, packed bits, scalars and the vectors for reranking. A cell with many vectors, or many copies of one, has many blocks.
* **Search.** The sample gives each query a bar, a score that 2k vectors reach: more than are asked for, so that a bound that
  fails does not leave a query with fewer than k. Cells that cannot reach it by their radius are left out. Queries meet the other blocks in tiles, one task each: bits are unpacked, all estimates
  of a tile are one matrix product, and only vectors whose upper bound reaches the query's bar are scored on the original
  vectors, in double precision. A tile emits k rows a query at most.

Defined results: vectors that are null, empty, zero or hold a null or a component that is no finite number take no part, nor do rows
without a vec_id or with another number of components than most rows (the larger of two as frequent). Rows equal in
vec_id and vector are one; different vectors under one vec_id are different candidates, and different queries whose
ranks each start at 1. Ties go to the smaller vec_id. With fewer than k others a query gets them all. An empty table gives no
rows. Columns other than vec_id and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from factorframe.llm.common import saved, table

SAMPLE = 8192
CELLS = 64
#: Bits of a code for each dimension, and standard deviations of an estimate that the bound allows for.
BITS = 4
SPREADS = 3.0
BLOCK = 65_536
#: Queries of a tile at most, and estimates and pairs that a task holds at a time.
TILE_QUERIES = 50_000
_CHUNK = 1 << 22
_PAIRS = 1 << 16

_BLOCKS = "block int, cell int, ids binary, bits binary, scale binary, error binary, vectors binary"
_FOUND = "query_id long, query_hash long, vec_id long, score double"


@dataclass(frozen=True)
class Codes:
    """What a task needs to code vectors: turned centres and the rotation, dimensions first."""

    rotation: np.ndarray
    centres: np.ndarray
    sample: np.ndarray

    @property
    def dims(self) -> int:
        return len(self.rotation)

    def cell_of(self, vectors: np.ndarray) -> np.ndarray:
        """The nearest centre of each vector."""
        return np.argmin((self.centres**2).sum(1) - 2 * (vectors @ self.centres.T), axis=1)

    def encode(self, vectors: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Packed bits, correction, error of one deviation, and length of each residual."""
        residual = vectors - self.centres[cells]
        length = np.sqrt((residual**2).sum(1))
        turned = (residual / np.where(length > 0, length, 1)[:, None]) @ self.rotation
        width = turned.shape[1]
        along = np.abs(turned).sum(1) / np.sqrt(width)
        along = np.where(length > 0, along, 1)
        off = np.sqrt(np.maximum(0, 1 - along**2)) / along / np.sqrt(max(1, width - 1))
        return np.packbits(turned > 0, axis=1), length / along / np.sqrt(width), length * off, length


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, vector and hash of the rows that take part, each once."""
    kind = rows.schema[vector_col].dataType
    wide = isinstance(kind, ArrayType) and isinstance(kind.elementType, DoubleType)
    cast = rows.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<double>" if wide else "array<float>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = cast.where(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0))
    return good.withColumn("hash", F.xxhash64("vector")).dropDuplicates(["vec_id", "hash", "vector"])


def fit(vectors: DataFrame, *, cells: int = CELLS, sample: int = SAMPLE, bits: int = BITS, seed: int = 7) -> Codes | None:
    """Rotation and centres from the first ``sample`` rows by a hash; None when there is no vector."""
    top = vectors.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if top is None:
        return None
    some = vectors.where(F.size("vector") == top["dims"]).orderBy(F.xxhash64("vec_id", "hash"), "vec_id", "hash").limit(sample)
    known = np.array([r["vector"] for r in some.select("vector").collect()], float)
    rng = np.random.default_rng(seed)
    width = ceil(top["dims"] * bits / 8) * 8
    rotation = np.linalg.qr(rng.standard_normal((width, width)))[0][: top["dims"]]
    centres = known[rng.permutation(len(known))[: max(1, min(cells, len(known) // 128))]]
    for _ in range(10):
        nearest = np.argmin((centres**2).sum(1) - 2 * (known @ centres.T), axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, known)
        size = np.bincount(nearest, minlength=len(centres))
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    return Codes(rotation, centres, known)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _assigned(codes: Codes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector")) if len(batch) else np.zeros((0, codes.dims))
            cells = codes.cell_of(vectors.astype(float))
            length = np.sqrt(((vectors - codes.centres[cells]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.int32()), pa.array(length, pa.float64())],
                names=[*batch.schema.names, "cell", "length"],
            )

    return run


def _packed(codes: Codes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of a partition, sorted by block, as one row for each block."""

    def pack(block: int, cell: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        ids, vectors = (np.concatenate(x) for x in zip(*parts, strict=True))
        bits, scale, error, _ = codes.encode(vectors.astype(float), np.full(len(ids), cell))
        packed = [ids.astype("<i8"), bits, scale.astype("<f4"), error.astype("<f4"), vectors]
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([cell], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in packed)],
            names=["block", "cell", "ids", "bits", "scale", "error", "vectors"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            blocks, cells = (batch.column(c).to_numpy() for c in ("block", "cell"))
            cuts = [0, *np.flatnonzero(np.diff(blocks)) + 1, len(blocks)]
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                if start == stop:
                    continue
                if now is not None and now[0] != blocks[start]:
                    yield pack(*now, parts)
                    parts = []
                now = (int(blocks[start]), int(cells[start]))
                here = batch.slice(start, stop - start)
                parts.append((here.column("vec_id").to_numpy(), _matrix(here.column("vector"))))
        if now is not None:
            yield pack(*now, parts)

    return run


@dataclass(frozen=True)
class Index:
    """The written blocks, and per cell (never more than ``CELLS``) the radius, first block and number of blocks."""

    codes: Codes
    blocks: DataFrame
    wide: bool
    radius: np.ndarray
    first: np.ndarray
    parts: np.ndarray


def build_index(vectors: DataFrame, codes: Codes, *, block: int = BLOCK) -> Index:
    """Every row of ``usable`` that has the codes' number of components, in blocks."""
    kind = vectors.schema["vector"].dataType.simpleString()
    fitting = vectors.where(F.size("vector") == codes.dims)
    placed = fitting.mapInArrow(_assigned(codes), f"vec_id long, vector {kind}, hash long, cell int, length double")
    placed = saved(placed, "cells")
    cells = len(codes.centres)
    parts, radius = np.zeros(cells, int), np.zeros(cells)
    for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("length").alias("radius")).collect():
        parts[r["cell"]], radius[r["cell"]] = ceil(r["n"] / block), r["radius"]
    first = np.concatenate([[0], np.cumsum(parts)[:-1]])
    # By a hash of id and vector, so that a cell's blocks are about equally large whatever they hold.
    starts, widths = (F.array(*[F.lit(int(x)) for x in xs])[F.col("cell")] for xs in (first, parts))
    by_block = placed.withColumn("block", (starts + F.pmod(F.xxhash64("vec_id", "hash"), widths)).cast("int"))
    packed = (
        by_block.repartition(max(1, int(parts.sum())), "block")
        .sortWithinPartitions("block", "vec_id", "hash")
        .select("block", "cell", "vec_id", "vector")
        .mapInArrow(_packed(codes), _BLOCKS)
    )
    return Index(codes, saved(packed, "codes"), "double" in kind, radius, first, parts)


def _routed(codes: Codes, radius: np.ndarray, filled: np.ndarray, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Queries with the bar that 2k neighbours reach, and the cells that may reach it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queries = (_matrix(batch.column("vector")) if len(batch) else np.zeros((0, codes.dims))).astype(float)
            norms = np.sqrt((queries**2).sum(1))
            bars = np.full(len(queries), -np.inf)
            nth = 2 * k + 1  # the query itself may be one of them
            if len(codes.sample) >= nth:
                step = max(1, _CHUNK // len(codes.sample))
                for i in range(0, len(queries), step):
                    scores = queries[i : i + step] @ codes.sample.T
                    bars[i : i + step] = np.partition(scores, -nth, axis=1)[:, -nth]
            bars -= 1e-9 * norms * np.sqrt((codes.sample**2).sum(1).max())
            reach = queries @ codes.centres.T + norms[:, None] * radius * (1 + 1e-9)
            open_ = (reach >= bars[:, None]) & filled
            offsets = np.concatenate([[0], np.cumsum(open_.sum(1))])
            cells = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.nonzero(open_)[1], pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(bars, pa.float64()), cells], names=[*batch.schema.names, "bar", "cells"]
            )

    return run


def _searched(codes: Codes, k: int, spreads: float, dtype: str) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    rotation = codes.rotation.astype(np.float32)
    centres = (codes.centres @ codes.rotation).astype(np.float32)

    def best(row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Places of the k best of each row, ties by id."""
        order = np.lexsort((ids, -score, row))
        first = np.searchsorted(row[order], row[order])
        return order[np.arange(len(order)) - first < k]

    def scored(queries: np.ndarray, vectors: np.ndarray, row: np.ndarray, at: np.ndarray, bar: np.ndarray):
        """Pairs whose inner product reaches the bar, and the product: components are added in their order."""
        for i in range(0, len(row), _PAIRS):
            r, a = row[i : i + _PAIRS], at[i : i + _PAIRS]
            rough = np.einsum("ij,ij->i", queries[r], vectors[a], dtype=float)
            near = rough >= bar[r]
            r, a = r[near], a[near]
            exact = np.zeros(len(r))
            for j in range(vectors.shape[1]):
                exact += queries[r, j].astype(float) * vectors[a, j]
            yield r, a, exact

    def run(key: tuple, block: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[], [], []]
        if len(block) and len(asked):
            cell = block.column("cell")[0].as_py()
            raw = {c: block.column(c)[0].as_py() for c in ("ids", "bits", "scale", "error", "vectors")}
            ids = np.frombuffer(raw["ids"], "<i8")
            n = len(ids)
            vectors = np.frombuffer(raw["vectors"], dtype).reshape(n, -1)
            scale, error = (np.frombuffer(raw[c], "<f4") for c in ("scale", "error"))
            signs = np.unpackbits(np.frombuffer(raw["bits"], np.uint8).reshape(n, -1), axis=1)
            codewords = (signs.astype(np.float32) * 2 - 1) * scale[:, None]
            queries = _matrix(asked.column("vector").combine_chunks())
            bars, query_ids, query_hashes = (asked.column(c).to_numpy() for c in ("bar", "query_id", "query_hash"))
            norms = np.sqrt(np.einsum("ij,ij->i", queries, queries, dtype=float))
            # What single precision may be off, besides the bound of the estimate.
            reach = np.abs(centres[cell]).max() + (scale.max() if n else 0) + 1e-30
            slack = 4e-6 * codewords.shape[1] * reach
            step = max(1, _CHUNK // n)
            for i in range(0, len(queries), step):
                turned = queries[i : i + step].astype(np.float32) @ rotation
                size = norms[i : i + step, None].astype(np.float32)
                upper = turned @ codewords.T
                upper += (turned @ centres[cell])[:, None] + size * (np.float32(spreads) * error + np.float32(slack))
                row, at = np.divmod(np.flatnonzero(upper >= bars[i : i + step, None]), n)
                own = query_ids[i + row] == ids[at]
                own[own] = (queries[i + row[own]] == vectors[at[own]]).all(1)
                pairs = [[*x] for x in zip(*scored(queries[i : i + step], vectors, row[~own], at[~own], bars[i : i + step]), strict=True)]
                if pairs:
                    row, at, score = map(np.concatenate, pairs)
                    kept = best(row, ids[at], score)
                    for whole, part in zip(found, (i + row[kept], ids[at[kept]], score[kept]), strict=True):
                        whole.append(part)
        if not found[0]:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64())], names=["query_id", "query_hash", "vec_id", "score"])
        row, near, score = map(np.concatenate, found)
        return pa.table([query_ids[row], query_hashes[row], near, score], names=["query_id", "query_hash", "vec_id", "score"])

    return run


def search(index: Index, queries: DataFrame, k: int = 20, *, spreads: float = SPREADS) -> DataFrame:
    """query_id, query_hash, rank, vec_id, score: the k nearest of the index for rows of ``usable``, but themselves."""
    codes, kind = index.codes, queries.schema["vector"].dataType.simpleString()
    fitting = queries.where(F.size("vector") == codes.dims).select(
        F.col("vec_id").alias("query_id"), F.col("hash").alias("query_hash"), "vector"
    )
    routed = saved(
        fitting.mapInArrow(_routed(codes, index.radius, index.parts > 0, k), f"query_id long, query_hash long, vector {kind}, bar double, cells array<int>"),
        "queries",
    )
    slices = max(1, ceil(routed.count() / TILE_QUERIES))
    start, parts = (F.array(*[F.lit(int(x)) for x in xs]) for xs in (index.first, index.parts))
    at = F.explode(F.flatten(F.transform("cells", lambda c: F.sequence(start[c], start[c] + parts[c] - 1))))
    own_slice = F.pmod(F.xxhash64("query_id", "query_hash"), F.lit(slices)).cast("int")
    asked = routed.select(at.alias("block"), own_slice.alias("slice"), "query_id", "query_hash", "vector", "bar")
    blocks = index.blocks.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    dtype = "<f8" if index.wide else "<f4"
    met = blocks.groupBy("block", "slice").cogroup(asked.groupBy("block", "slice"))
    found = met.applyInArrow(_searched(codes, k, spreads, dtype), _FOUND)
    nearest = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranked.select("query_id", "query_hash", "rank", "vec_id", "score")


def nearest_neighbours(rows: DataFrame, k: int = 20, *, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest of all rows for each whose id is divisible by ``every``."""
    vectors = saved(usable(rows, id_col, vector_col), "vectors")
    codes = fit(vectors)
    if codes is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = search(build_index(vectors, codes), vectors.where(F.col("vec_id") % every == 0), k)
    return found.select("query_id", "rank", "vec_id", "score")


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all vectors for each of those whose vec_id is divisible by 20."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


#: The search is approximate; on the test tables it finds all neighbours, so the SQL for them holds.
ORACLE_SQL = """
WITH usable AS (
    SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        AND len([x FOR x IN embedding IF x <> 0]) > 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) AS score
    FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, row_number() OVER w AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 20
"""
