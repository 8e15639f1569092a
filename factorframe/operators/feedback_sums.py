"""Normal equations kept between batches of feedback.

The equations of a query are sums over its feedback, so what a batch adds can be summed by itself and added to what is stored: the
upper triangle of v·vᵀ, packed, and the right-hand side. A batch then costs its own feedback, and only its queries are
solved again. Each batch is a part; the one that would be the last of ``fan_in`` is added to the others instead, in the tasks that
sum it, and all become one part: its own sums are neither written nor moved. A part is written aside and renamed, so
a batch that is repeated is found to be there or is made as a whole.

The sums belong to the item vectors that they were made with: a new model version needs a new folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import FOLD_IN_LAMBDA
from ..sources import storage
from ..sources.factors import FactorShape, factor_shape
from .foldin import _SOLVE_ROWS, _batched, _by_query, _peek, _solve, _sums, item_gram, weighted_feedback

_SUMS_SQL = "n long, gram array<double>, rhs array<double>"
_DOUBLES = pa.list_(pa.float64())


def packed_equations(
    feedback: DataFrame, items: DataFrame, *, implicit_prefs: bool = False, alpha: float = 1.0, shape: FactorShape | None = None
) -> DataFrame:
    """``query_id, n, gram, rhs`` of each query with usable feedback; ``gram`` is the upper triangle, row by row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type, batches = _peek(batches)
        rows = ((q, n, gram[np.triu_indices(len(rhs))], rhs) for q, gram, rhs, n in _sums(batches))
        return _batched(rows, [id_type, pa.int64(), _DOUBLES, _DOUBLES], ["query_id", "n", "gram", "rhs"])

    used = _by_query(weighted_feedback(feedback, implicit_prefs=implicit_prefs, alpha=alpha), items, shape)
    id_type = feedback.schema["query_id"].dataType.simpleString()
    return used.mapInArrow(pack, f"query_id {id_type}, {_SUMS_SQL}")


def _with_feedback(
    stored: DataFrame, feedback: DataFrame, items: DataFrame, shape: FactorShape, *, implicit_prefs: bool = False, alpha: float = 1.0
) -> DataFrame:
    """``stored`` sums and those of more feedback as one row per query: a query's rows of both kinds meet in one task."""
    id_type = stored.schema["query_id"].dataType
    weighted = weighted_feedback(feedback, implicit_prefs=implicit_prefs, alpha=alpha)
    weighted = weighted.withColumn("query_id", F.col("query_id").cast(id_type))
    vectors = items.select("id", "features")
    if not shape.broadcastable:
        weighted = weighted.join(vectors, "id")
    rows = weighted.unionByName(stored, allowMissingColumns=True).repartition("query_id")
    if shape.broadcastable:
        rows = rows.join(F.broadcast(vectors), "id", "left").where("gram is not null or features is not null")
    rows = rows.select("query_id", "n", "weight", "target", "features", "gram", "rhs").sortWithinPartitions("query_id")
    return rows.mapInArrow(_added_to, f"query_id {id_type.simpleString()}, {_SUMS_SQL}")


def _added_to(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    id_type, batches = _peek(batches)
    return _batched(_mixed_totals(batches), [id_type, pa.int64(), _DOUBLES, _DOUBLES], ["query_id", "n", "gram", "rhs"])


def _mixed_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The sums of each query over sorted rows, some of them sums and some feedback; only the current query is held."""
    current = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        encoded = batch.column("query_id").dictionary_encode()
        codes, names = encoded.indices.to_numpy(), encoded.dictionary.to_pylist()
        is_sum = batch.column("gram").is_valid().to_numpy(zero_copy_only=False)
        n, weight, target = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "weight", "target"))
        sums, new = (batch.filter(pa.array(x)) for x in (is_sum, ~is_sum))
        gram, rhs = (sums.column(c).flatten().to_numpy().reshape(sums.num_rows, -1) if sums.num_rows else None for c in ("gram", "rhs"))
        vectors = new.column("features").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        vectors = vectors.reshape(new.num_rows, -1) if new.num_rows else None
        place = np.where(is_sum, np.cumsum(is_sum), np.cumsum(~is_sum)) - 1
        begins = np.flatnonzero(np.diff(codes, prepend=-1))
        for begin, end in zip(begins, [*begins[1:], len(codes)]):
            name, count, g, r = names[codes[begin]], int(n[begin:end].sum()), 0.0, 0.0
            mine = np.arange(begin, end)
            for i in place[mine[is_sum[mine]]]:
                g, r = g + gram[i], r + rhs[i]
            fed = mine[~is_sum[mine]]
            if len(fed):
                v = vectors[place[fed]]
                g = g + (v.T @ (v * weight[fed, None]))[np.triu_indices(v.shape[1])]
                r = r + v.T @ target[fed]
            if current is not None and current[0] == name:
                current = (name, current[1] + count, current[2] + g, current[3] + r)
            else:
                if current is not None:
                    yield current
                current = (name, count, g, r)
    if current is not None:
        yield current


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The sums of each query over rows sorted by query; only the current one is held."""
    current = None
    for batch in batches:
        ids, n = batch.column("query_id").to_pylist(), batch.column("n").to_numpy()
        gram, rhs = (batch.column(c).flatten().to_numpy().reshape(len(ids), -1) for c in ("gram", "rhs")) if ids else (None, None)
        for i, query in enumerate(ids):
            if current is not None and current[0] == query:
                current = (query, current[1] + n[i], current[2] + gram[i], current[3] + rhs[i])
            else:
                if current is not None:
                    yield current
                current = (query, n[i], gram[i], rhs[i])
    if current is not None:
        yield current


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    id_type, batches = _peek(batches)
    return _batched(_totals(batches), [id_type, pa.int64(), _DOUBLES, _DOUBLES], ["query_id", "n", "gram", "rhs"])


class FeedbackSums:
    """The sums stored below ``path``, for one table of item vectors."""

    def __init__(
        self, spark: SparkSession, path: str, items: DataFrame, *, implicit_prefs: bool = False, alpha: float = 1.0, fan_in: int = 8
    ):
        if fan_in < 2:
            raise ValueError("fan_in must be 2 or more")
        self.spark, self.path, self.items, self.fan_in = spark, path.rstrip("/"), items, fan_in
        self.kind = {"implicit_prefs": implicit_prefs, "alpha": alpha}
        self._shape: FactorShape | None = None

    def parts(self) -> list[tuple[int, int]]:
        """First and last batch of each part that no larger one covers."""
        names = [d.removeprefix("part-") for d in storage.list_dirs(self.spark, self.path) if d.startswith("part-")]
        found = [tuple(map(int, n.split("-"))) for n in names]
        return sorted(p for p in found if not any(o != p and o[0] <= p[0] and p[1] <= o[1] for o in found))

    def add(self, feedback: DataFrame, batch_id: int) -> bool:
        """Add the feedback of a batch (``query_id, item_id, rating``); False when it is in the sums already."""
        parts = self.parts()
        if any(first <= batch_id <= last for first, last in parts):
            return False
        self._shape = self._shape or factor_shape(self.items)
        if len(parts) + 1 < self.fan_in:
            self._write(packed_equations(feedback, self.items, **self.kind, shape=self._shape), (batch_id, batch_id))
            return True
        merged = _with_feedback(self._stored(parts), feedback, self.items, self._shape, **self.kind)
        self._write(merged, (min(parts[0][0], batch_id), max(parts[-1][1], batch_id)))
        for part in parts:
            storage.delete(self.spark, self._folder(part))
        return True

    def _folder(self, part: tuple[int, int]) -> str:
        return f"{self.path}/part-{part[0]}-{part[1]}"

    def _write(self, rows: DataFrame, part: tuple[int, int]) -> None:
        aside = storage.sibling(self._folder(part), "aside")
        try:
            rows.write.parquet(aside)
            storage.rename(self.spark, aside, self._folder(part))
        finally:
            storage.delete(self.spark, aside)

    def _stored(self, parts: list[tuple[int, int]]) -> DataFrame:
        return self.spark.read.parquet(*[self._folder(p) for p in parts]).select("query_id", "n", "gram", "rhs")

    def sums(self, users: DataFrame | None = None) -> DataFrame:
        """``query_id, n, gram, rhs`` over all batches, of all queries or of those in ``users``."""
        parts = self.parts()
        if not parts:
            raise FileNotFoundError(f"no feedback has been added to {self.path}")
        rows = self._stored(parts)
        if users is not None:
            rows = rows.join(users.select("query_id").distinct(), "query_id", "left_semi")
        if len(parts) == 1:
            return rows
        id_type = rows.schema["query_id"].dataType.simpleString()
        return rows.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(_added, f"query_id {id_type}, {_SUMS_SQL}")

    def solve(
        self, users: DataFrame | None = None, *, lam: float = FOLD_IN_LAMBDA, scale_by_count: bool = False, nonnegative: bool = False
    ) -> DataFrame:
        """``query_id, features`` as :func:`fold_in` gives for all feedback so far, of queries with usable feedback."""
        shared = item_gram(self.items) if self.kind["implicit_prefs"] else None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            id_type, batches = _peek(batches)

            def solved():
                rows = _totals(batches)
                while some := list(islice(rows, _SOLVE_ROWS)):
                    b = np.stack([rhs for *_, rhs in some])
                    rank = b.shape[1]
                    a = np.zeros((len(some), rank, rank))
                    i, j = np.triu_indices(rank)
                    a[:, i, j] = a[:, j, i] = np.stack([gram for _, _, gram, _ in some])
                    scale = np.array([n if scale_by_count else 1 for _, n, _, _ in some], float)
                    a += lam * scale[:, None, None] * np.eye(rank) + (0.0 if shared is None else shared)
                    yield from zip([q for q, *_ in some], _solve(a, b, nonnegative).astype(np.float32))

            return _batched(solved(), [id_type, pa.list_(pa.float32())], ["query_id", "features"])

        sums = self.sums(users)
        return sums.mapInArrow(run, f"query_id {sums.schema['query_id'].dataType.simpleString()}, features array<float>")
