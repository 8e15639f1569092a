"""Best-fit packing of token sequences by linear grouping.

Documents become pieces of at most ``size`` tokens; how many pieces there are of each length is
a table of at most ``size`` rows, and that is all the driver sees. From it the plan is made:

1. lengths over 45 % of ``size`` are put into groups of about equally many pieces, and each rounded up
   to the longest of its group;
2. for these few sizes, the best mix of configurations (sets of sizes that fit a sequence) is found
   by column generation;
3. the pieces themselves take the places of their group, which frees what rounding had added;
4. short pieces, and the few long ones that whole configurations left over, go best-fit, longest
   first, into what is free, and into new sequences if nothing is.

The plan says for each length which of its pieces (by number) go to which sequences and where in
them. Spark numbers the pieces and looks their places up; no piece is collected or moved by length.

Defined results: null and empty texts have the separator as their only token. Repeated rows are
packed each. A null doc_id is carried through. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from factorframe.llm.common import Batcher, id_texts, rows_of, saved, table
from factorframe.llm.tokens import encoder

SIZE = 2048
SEPARATOR = 0
GROUPS = 96
_ROUNDS = 3_000

_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("part", pa.int32()),
        ("nth", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ]
)


def pieces(docs: DataFrame, *, size: int = SIZE, separator: int = SEPARATOR, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Documents as pieces of at most ``size`` tokens; the first of a long one is the odd one.

    ``part`` and ``nth`` number the pieces of a length: so many came before in the same task.
    ``ids`` is left out unless ``with_ids``.
    """
    schema = _PIECES if with_ids else pa.schema(list(_PIECES)[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, encode = Batcher(schema, 50_000), encoder(tokenizer).encode
        part, seen = TaskContext.get().partitionId(), [0] * (size + 1)
        for batch in batches:
            for doc_id, text in rows_of(batch):
                ids = np.append(encode(text), np.uint32(separator)).astype("<u4")
                first = (len(ids) - 1) % size + 1
                for piece, end in enumerate(range(first, len(ids) + 1, size)):
                    start = max(0, end - size)
                    own = ids[start:end]
                    row = (doc_id, piece, start, len(own), zlib.crc32(own.tobytes()), part, seen[len(own)])
                    seen[len(own)] += 1
                    if full := out.add(*row, *[own.astype(np.int32)] * with_ids, weight=4 * len(own) * with_ids):
                        yield full
        yield out.flush()

    columns = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
    return id_texts(docs).mapInArrow(run, columns + ", ids array<int>" * with_ids)


def best_configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations of few sizes and how often to use each, in whole numbers, rounded down.

    Minimises the number of sequences over fractional uses by column generation: the dual prices of the sizes
    are put into a knapsack, whose best filling enters the basis while it is worth more than one sequence.
    """
    k = len(sizes)
    if not k:
        return []
    basis = np.diag(capacity // sizes).astype(float)
    inverse = np.linalg.inv(basis)
    use = inverse @ demand
    rising = np.argsort(sizes)
    small = sizes[rising]
    fits = np.searchsorted(small, np.arange(capacity + 1), side="right")
    for _ in range(_ROUNDS):
        price = np.maximum(inverse.sum(0), 0)[rising]
        worth, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for c in range(int(small[0]), capacity + 1):
            options = worth[c - small[: fits[c]]] + price[: fits[c]]
            best = int(options.argmax())
            worth[c], last[c] = options[best], best
        if worth[capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(k), capacity
        while last[c] >= 0:
            column[rising[last[c]]] += 1
            c -= int(small[last[c]])
        step = inverse @ column
        ratio = np.where(step > 1e-9, use / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = column
        inverse = np.linalg.inv(basis)
        use = np.maximum(inverse @ demand, 0)
    return [(basis[:, j].astype(int), int(use[j] + 1e-6)) for j in range(k) if int(use[j] + 1e-6)]


class Plan:
    """Places for the pieces of each length: rows of length, first piece, number of pieces, first sequence, offset."""

    def __init__(self, counts: dict[int, int], size: int = SIZE, groups: int = GROUPS, long: int | None = None) -> None:
        self.long = size * 9 // 20 if long is None else long
        self.size, self.rows, self.sequences = size, [], 0
        self.left = {n: [0, c] for n, c in counts.items()}  # by length: the first piece without a place, the end
        #: Free tokens of used sequences: ranges of sequences that are equally full.
        self.free: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self._configure(groups)
        self._best_fit()

    def _place(self, length: int, first: int, n: int, sequence: int, used: int) -> None:
        self.rows.append((length, first, n, sequence, used))

    def _configure(self, groups: int) -> None:
        long = sorted((n for n in self.left if self.long < n < self.size), reverse=True)
        total, grouped = sum(self.left[n][1] for n in long), []
        want = max(1, -(-total // groups))
        for n in long:  # longest first, so a group's size is its first length
            if not grouped or grouped[-1][1] + self.left[n][1] / 2 > want:
                grouped.append([[], 0])
            grouped[-1][0].append(n)
            grouped[-1][1] += self.left[n][1]
        sizes = np.array([g[0][0] for g in grouped], np.int64)
        demand = np.array([g[1] for g in grouped], float)
        for configuration, times in best_configurations(sizes, demand, self.size):
            slots = [self._take(grouped[g][0], times) for g in np.flatnonzero(configuration) for _ in range(configuration[g])]
            slots = [s for s in slots if s]
            ends = sorted({e for s in slots for e, _, _ in s} | {times})
            begin, at = 0, [0] * len(slots)
            for end in ends:  # equal lengths from begin to end in each slot
                used = 0
                for j, slot in enumerate(slots):
                    while at[j] < len(slot) and slot[at[j]][0] <= begin:
                        at[j] += 1
                    if at[j] < len(slot):
                        upto, length, first = slot[at[j]]
                        came = slot[at[j] - 1][0] if at[j] else 0
                        self._place(length, first + begin - came, end - begin, self.sequences + begin, used)
                        used += length
                self.free[self.size - used].append((self.sequences + begin, end - begin))
                begin = end
            self.sequences += times

    def _take(self, lengths: list[int], n: int) -> list[tuple[int, int, int]]:
        """The next ``n`` pieces of a group: (end, length, first piece) in a row."""
        out, end = [], 0
        for length in lengths:
            first, last = self.left[length]
            got = min(n - end, last - first)
            if got:
                end += got
                out.append((end, length, first))
                self.left[length][0] += got
        return out

    def _best_fit(self) -> None:
        spaces = [f for f, ranges in self.free.items() if ranges]
        heapq.heapify(spaces)
        for length in sorted(self.left, reverse=True):
            first, last = self.left[length]
            for space in sorted(f for f, ranges in self.free.items() if ranges and f >= length):
                # In one space after another, the tightest first, as often as the length fits.
                while first < last and self.free[space]:
                    sequence, n = self.free[space].pop()
                    take = min(n, last - first)
                    if take < n:
                        self.free[space].append((sequence + take, n - take))
                    used, room = self.size - space, space
                    deep = min(room // length, -(-(last - first) // take))
                    for _ in range(deep):
                        part = min(take, last - first)
                        if part < take:
                            self.free[room].append((sequence + part, take - part))
                            take = part
                        self._place(length, first, take, sequence, used)
                        first, used, room = first + take, used + length, room - length
                        if first == last:
                            break
                    self.free[room].append((sequence, take))
                if first == last:
                    break
            while first < last:
                deep = self.size // length
                n = max(1, (last - first) // deep)
                sequence, used = self.sequences, 0
                self.sequences += n
                for _ in range(deep):
                    take = min(n, last - first)
                    if take < n:
                        self.free[self.size - used].append((sequence + take, n - take))
                        n = take
                    if not n:
                        break
                    self._place(length, first, n, sequence, used)
                    first, used = first + n, used + length
                if n:
                    self.free[self.size - used].append((sequence, n))
            self.left[length][0] = first

    def lookup(self) -> np.ndarray:
        """The rows, sorted by length and first piece."""
        return np.array(sorted(self.rows), np.int64).reshape(-1, 5)


def pack(found: DataFrame, *, size: int = SIZE, groups: int = GROUPS) -> DataFrame:
    """Pieces (written, from ``pieces``) with ``sequence_id`` and ``offset``."""
    by_part = found.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = Plan(counts, size, groups).lookup()
    # One number for (length, piece), so that a single sorted search finds the row.
    key = plan[:, 0] * (1 << 48) + plan[:, 1] if len(plan) else np.zeros(0, np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            row = np.searchsorted(key, length * (1 << 48) + number, side="right") - 1
            sequence = plan[row, 3] + number - plan[row, 1]
            yield (
                batch.drop_columns(["number"])
                .append_column("sequence_id", pa.array(sequence, pa.int64()))
                .append_column("offset", pa.array(plan[row, 4], pa.int64()))
            )

    kept = [f for f in found.schema if f.name not in ("part", "nth")]
    numbered = found.join(offsets, ["length", "part"]).select(
        *[f.name for f in kept], (F.col("nth") + F.col("before")).alias("number")
    )
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return numbered.mapInArrow(place, columns + ", sequence_id long, offset long")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(saved(pieces(table(spark, sf_dir, "documents")), "pieces"))
