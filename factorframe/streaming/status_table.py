"""A table of results that keeps itself small: arrival hours, merged runs, latest per job.

Results are appended batch by batch into the folder of the hour they arrive in. A batch is a *run* of its own;
when ``fan_in`` runs of one level have come together in an hour, they are merged into one of the next level that
holds the last result of each job, ordered by a hash of the job. So a result is written again as many times as
the logarithm of the batches of its hour, and a reader meets fewer than ``fan_in`` runs of each level.

* Readers list the hours that can hold a live result and take of each the runs that no larger run covers: both are
  partition folders, so nothing else is scanned. Looking up a few jobs also skips by their hashes.
* A run is written aside and renamed, so it is there as a whole or not at all. Runs that a larger one covers stay until their hour goes, so no
  reader loses a file it has planned to read. A batch that is repeated, in whatever hour, is found to be there.
* Expiry deletes whole hours. The driver handles names of hours and runs, never of jobs or files.

One writer at a time, as ``foreachBatch`` has it; batch numbers must rise, and each must always stand for the same results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from ..schema import RESULT_TTL_SECONDS
from ..sources import storage
from .envelopes import decode_results
from .status import latest_status
from .worker import BATCH

HOUR, RUN, SHARD = "hour", "run", "shard"
_HOUR_SECONDS = 3600
_ORDER = (BATCH, "seq")


@dataclass(frozen=True, order=True)
class Run:
    """The results of batches ``first`` to ``last`` that arrived in one hour; level 0 is a batch as it came."""

    first: int
    last: int
    level: int

    @property
    def name(self) -> str:
        return f"level{self.level}-{self.first}-{self.last}"

    @staticmethod
    def parse(name: str) -> Run:
        level, first, last = name.removeprefix("level").split("-")
        return Run(int(first), int(last), int(level))

    def covers(self, other: Run) -> bool:
        return self.level > other.level and self.first <= other.first and other.last <= self.last


class StatusTable:
    """The results below ``path``; ``ttl_seconds`` is how long one lives after its arrival."""

    def __init__(
        self, spark: SparkSession, path: str, *, ttl_seconds: int = RESULT_TTL_SECONDS, fan_in: int = 8, shards: int = 256
    ):
        if fan_in < 2 or shards < 1 or ttl_seconds < 1:
            raise ValueError("fan_in must be 2 or more, shards and ttl_seconds 1 or more")
        self.spark, self.path = spark, path.rstrip("/")
        self.ttl, self.fan_in, self.shards = timedelta(seconds=ttl_seconds), fan_in, shards

    # --- what is there

    def hours(self) -> list[int]:
        """Arrival hours that have a folder, counted from 1970."""
        return sorted(int(d.removeprefix(f"{HOUR}=")) for d in storage.list_dirs(self.spark, self.path) if d.startswith(f"{HOUR}="))

    def runs(self, hour: int) -> list[Run]:
        """All runs of an hour, by their batches."""
        names = storage.list_dirs(self.spark, f"{self.path}/{HOUR}={hour}")
        return sorted(Run.parse(d.removeprefix(f"{RUN}=")) for d in names if d.startswith(f"{RUN}="))

    def current_runs(self, hour: int) -> list[Run]:
        """The runs of an hour that no larger one covers: together they hold each of its batches once."""
        runs = self.runs(hour)
        return [r for r in runs if not any(other.covers(r) for other in runs)]

    def _hour(self, at: datetime) -> int:
        return int(at.timestamp()) // _HOUR_SECONDS

    def _live_hours(self, now: datetime) -> list[int]:
        first = self._hour(now - self.ttl)
        return [h for h in self.hours() if h >= first]

    # --- writing

    def append(self, results: DataFrame, batch_id: int, *, now: datetime | None = None) -> bool:
        """Keep the results of a batch as arrived now; False when they are there already.

        ``results`` has a ``job_id`` and a ``seq`` that puts the results of a job in order.
        """
        now = now or datetime.now(timezone.utc)
        there = (r for h in self._live_hours(now) for r in self.current_runs(h))
        if any(r.first <= batch_id <= r.last for r in there):
            return False
        stamped = results.withColumns({BATCH: F.lit(batch_id).cast("long"), "arrived_at": F.lit(now).cast("timestamp")})
        self._write(stamped, self._hour(now), Run(batch_id, batch_id, 0))
        self.merge(self._hour(now))
        return True

    def _shard(self, job_id: Column) -> Column:
        return F.pmod(F.xxhash64(job_id.cast("string")), F.lit(self.shards)).cast("int")

    def _write(self, rows: DataFrame, hour: int, run: Run) -> None:
        """Rows by shard, so that the files of a run and their row groups hold few shards each."""
        aside = storage.sibling(f"{self.path}/{run.name}", "aside")
        try:
            sharded = rows.withColumn(SHARD, self._shard(F.col("job_id")))
            # Ranges of shard and job: a shard that most results fall into is divided too.
            sharded.repartitionByRange(SHARD, "job_id").sortWithinPartitions(SHARD, "job_id").write.parquet(aside)
            storage.rename(self.spark, aside, f"{self.path}/{HOUR}={hour}/{RUN}={run.name}")
        finally:
            storage.delete(self.spark, aside)

    def merge(self, hour: int) -> list[Run]:
        """Merge runs of an hour while ``fan_in`` of one level are there; returns the new ones."""
        made = []
        while (group := self._mergeable(hour)) is not None:
            run = Run(group[0].first, group[-1].last, group[0].level + 1)
            rows = self._read({hour: group})
            fields = [c for c in rows.columns if c not in (HOUR, RUN, SHARD, "job_id")]
            last = rows.groupBy("job_id").agg(F.max_by(F.struct(*fields), F.struct(*_ORDER)).alias("last"))
            self._write(last.select("job_id", "last.*"), hour, run)
            made.append(run)
        return made

    def _mergeable(self, hour: int) -> list[Run] | None:
        """Neighbouring runs of one level, as many as are merged at once."""
        group: list[Run] = []
        for run in self.current_runs(hour):
            group = [*group, run] if group and group[-1].level == run.level else [run]
            if len(group) == self.fan_in:
                return group
        return None

    def expire(self, now: datetime | None = None) -> list[int]:
        """Delete the hours whose last moment is older than the lifetime, and whatever broke off; returns the hours."""
        gone = [h for h in self.hours() if h < self._hour((now or datetime.now(timezone.utc)) - self.ttl)]
        for hour in gone:
            storage.delete(self.spark, f"{self.path}/{HOUR}={hour}")
        for name in storage.list_dirs(self.spark, self.path):
            if name.startswith(".aside-"):
                storage.delete(self.spark, f"{self.path}/{name}")
        return gone

    def sink(self) -> Callable[[DataFrame, int], None]:
        """A sink for :func:`answer_stream`: keeps the batch, merges, drops what has expired."""

        def store(results: DataFrame, batch_id: int) -> None:
            self.append(results, batch_id)
            self.expire()

        return store

    def message_sink(self) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function for result messages, which have an ``offset`` within their ``partition``."""
        store = self.sink()
        return lambda messages, batch_id: store(decode_results(messages).withColumn("seq", F.col("offset")), batch_id)

    # --- reading

    def _read(self, runs: dict[int, list[Run]]) -> DataFrame | None:
        if not any(runs.values()):
            return None
        wanted = F.lit(False)
        for hour, some in runs.items():
            wanted = wanted | ((F.col(HOUR) == hour) & F.col(RUN).isin([r.name for r in some]))
        some_run = next(f"{self.path}/{HOUR}={h}/{RUN}={some[-1].name}" for h, some in runs.items() if some)
        schema = self.spark.read.parquet(some_run).schema
        schema = StructType([f for f in schema if f.name not in (HOUR, RUN)]).add(HOUR, IntegerType()).add(RUN, StringType())
        # Only folders of these hours are listed, and of them only the runs that are wanted are read.
        paths = [f"{self.path}/{HOUR}={h}" for h, some in runs.items() if some]
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths).where(wanted)

    def live(self, now: datetime | None = None) -> DataFrame | None:
        """Results that have not expired, several of a job perhaps; None when there is no run."""
        now = now or datetime.now(timezone.utc)
        rows = self._read({h: self.current_runs(h) for h in self._live_hours(now)})
        return None if rows is None else rows.where(F.col("arrived_at") >= F.lit(now - self.ttl))

    def latest(self, now: datetime | None = None) -> DataFrame | None:
        """The last live result of each job; None when there is no run."""
        now = now or datetime.now(timezone.utc)
        rows = self.live(now)
        if rows is None:
            return None
        return latest_status(rows.drop(HOUR, RUN, SHARD), _ORDER, now=now, ttl_seconds=int(self.ttl.total_seconds()))

    def find(self, job_ids: list[str], now: datetime | None = None) -> DataFrame | None:
        """As :meth:`latest` for a few jobs: their shards and ids reach the scan."""
        now = now or datetime.now(timezone.utc)
        rows = self.live(now)
        if rows is None:
            return None
        ids = self.spark.createDataFrame([(i,) for i in job_ids], "job_id string")
        shards = [r[0] for r in ids.select(self._shard(F.col("job_id"))).distinct().collect()]
        mine = rows.where(F.col(SHARD).isin(shards) & F.col("job_id").isin(list(job_ids)))
        return latest_status(mine.drop(HOUR, RUN, SHARD), _ORDER, now=now, ttl_seconds=int(self.ttl.total_seconds()))
