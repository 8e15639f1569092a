"""A rating dataset whose merges rewrite files, not months, and switch by a manifest.

Data files lie in a folder per commit and, below it, per month; they are never changed. A manifest per month
lists the files of the month that are live, and one root manifest per commit names the manifests of all months. A merge
writes its new files first, then the manifests of the months it touches, then the root, by one rename: readers see all of
it or nothing, and a merge that broke off leaves files that no manifest names.

Which files must be rewritten is found by one join of the new rows with the keys of the months they fall into, with the file
that each key lies in (``_metadata.file_path``, hashed): those in which a rating rises. Rows whose key is nowhere become added files;
rows that change nothing cost no write. So one late row costs one file, however large its month is.

One merge at a time. The driver handles names of months and files.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.quality import complete_rows, drop_columns, keep_max, with_date_parts
from ..schema import DATE, ITEM, MONTH, PARTITION_COLS, RATING, RATING_KEY, USER, YEAR
from . import storage
from .ratings import write_ratings

COMMIT = "commit"
#: Rows of data files; the last three are folders.
STORED = T.StructType(
    [
        T.StructField(ITEM, T.IntegerType()),
        T.StructField(USER, T.IntegerType()),
        T.StructField(DATE, T.DateType()),
        T.StructField(RATING, T.IntegerType()),
        T.StructField(COMMIT, T.LongType()),
        T.StructField(YEAR, T.IntegerType()),
        T.StructField(MONTH, T.IntegerType()),
    ]
)
_COLUMNS = [ITEM, USER, DATE, RATING]

Month = tuple[int, int]


@dataclass(frozen=True)
class MergeCounts:
    """What a merge did: its commit, and how many files it replaced, added and left alone."""

    commit: int
    replaced: int
    added: int
    untouched: int


class VersionedRatings:
    """The dataset below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # --- manifests

    @property
    def _data(self) -> str:
        return f"{self.path}/data"

    def _file(self, name: str) -> str:
        return f"{self.path}/manifests/{name}.json"

    def commits(self) -> list[int]:
        """Commits that can be read, oldest first."""
        names = storage.list_files(self.spark, f"{self.path}/manifests")
        return sorted(int(n[5:-5]) for n in names if n.startswith("root-") and n.endswith(".json"))

    def _root(self, commit: int | None = None) -> dict[Month, int]:
        """Per month the commit that wrote its manifest."""
        commits = self.commits()
        if commit is None:
            if not commits:
                return {}
            commit = commits[-1]
        elif commit not in commits:
            raise FileNotFoundError(f"no commit {commit} in {self.path}; there are {commits}")
        return {(y, m): c for y, m, c in json.loads(storage.read_text(self.spark, self._file(f"root-{commit}")))}

    def _files_of(self, month: Month, written: int) -> list[str]:
        return json.loads(storage.read_text(self.spark, self._file(f"month-{month[0]}-{month[1]}-{written}")))

    def files(self, commit: int | None = None, months: Iterable[Month] | None = None) -> list[str]:
        """Live data files, relative to the data folder, of all months or of some."""
        root = self._root(commit)
        wanted = root if months is None else [m for m in months if m in root]
        return sorted(f for m in wanted for f in self._files_of(m, root[m]))

    # --- reading

    def read(self, commit: int | None = None, months: Iterable[Month] | None = None) -> DataFrame:
        """The ratings of the newest commit or of an earlier one; filters on ``year`` and ``month`` prune files."""
        return self._rows(self.files(commit, months)).select(*_COLUMNS, *PARTITION_COLS)

    def _rows(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], STORED)
        reader = self.spark.read.schema(STORED).option("basePath", self._data)
        return reader.parquet(*[f"{self._data}/{f}" for f in files])

    # --- merging

    def merge(self, new: DataFrame) -> MergeCounts:
        """Keep the highest rating of each key; rows with a null in key or rating go."""
        commits = self.commits()
        commit = commits[-1] + 1 if commits else 1
        storage.delete(self.spark, f"{self._data}/{COMMIT}={commit}")  # of a merge that broke off
        staged_path, matched_path = (storage.sibling(self.path, x) for x in ("staged", "matched"))
        try:
            rows = keep_max(complete_rows(drop_columns(new, PARTITION_COLS).select(*_COLUMNS)))
            with_date_parts(rows).write.parquet(staged_path)
            staged = self.spark.read.schema(_without_commit()).parquet(staged_path)
            months = [(r[YEAR], r[MONTH]) for r in staged.select(*PARTITION_COLS).distinct().collect()]
            before = self.files(months=months)
            replaced, changed = self._changes(staged, before, matched_path)
            write_ratings(changed, f"{self._data}/{COMMIT}={commit}", mode="append")
            return self._commit(commit, months, set(replaced))
        finally:
            for path in (staged_path, matched_path):
                storage.delete(self.spark, path)

    def _changes(self, staged: DataFrame, before: list[str], matched_path: str) -> tuple[list[str], DataFrame]:
        """Files in which a rating rises, and the rows that take their place together with those that are new."""
        if not before:
            return [], staged
        # A month follows from the date of the key. The name of a file moves as a number; two files under one number would
        # both be rewritten, which changes none of their rows.
        keys = list(RATING_KEY)
        name = F.substring_index(F.col("_metadata.file_path"), f"/data/{COMMIT}=", -1)
        stored = self._rows(before).select(*keys, RATING, F.xxhash64(name).alias("file"))
        incoming = staged.select(*keys, F.col(RATING).alias("offered"))
        # As many rows as were staged, those of no file included: they are new. What follows streams the files to be rewritten.
        incoming.join(stored, keys, "left").write.parquet(matched_path)
        matched = self.spark.read.parquet(matched_path)
        rising = matched.where(F.col("offered") > F.col(RATING))
        found = {r["file"] for r in rising.select("file").distinct().collect()}
        named = self.spark.createDataFrame([(f, f.removeprefix(f"{COMMIT}=")) for f in before], "path string, name string")
        replaced = sorted(r["path"] for r in named.select("path", F.xxhash64("name").alias("file")).collect() if r["file"] in found)
        inserted = matched.where(F.col("file").isNull()).select(*keys, F.col("offered").alias(RATING))
        offers = rising.select(*keys, "offered")
        rewritten = self._rows(replaced).select(*_COLUMNS).join(offers, keys, "left")
        risen = rewritten.select(*_COLUMNS[:-1], F.greatest(RATING, "offered").alias(RATING))
        return replaced, risen.unionByName(inserted.select(risen.columns))

    def _commit(self, commit: int, months: list[Month], replaced: set[str]) -> MergeCounts:
        root, folder = self._root(), f"{COMMIT}={commit}"
        added = untouched = 0
        for month in sorted(months):
            old = self._files_of(month, root[month]) if month in root else []
            below = f"{folder}/{YEAR}={month[0]}/{MONTH}={month[1]}"
            names = [n for n in storage.list_files(self.spark, f"{self._data}/{below}") if n.endswith(".parquet")]
            live = [f for f in old if f not in replaced] + [f"{below}/{n}" for n in names]
            added, untouched = added + len(names), untouched + len(live) - len(names)
            if live != old:
                storage.write_text(self.spark, self._file(f"month-{month[0]}-{month[1]}-{commit}"), json.dumps(live))
                root[month] = commit
        storage.write_text(self.spark, self._file(f"root-{commit}"), json.dumps([[*m, c] for m, c in sorted(root.items())]))
        return MergeCounts(commit, len(replaced), added, untouched)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete what none of the last ``keep`` commits names: their readers lose nothing. Returns the data files."""
        if keep < 1:
            raise ValueError("keep at least the newest commit")
        commits = self.commits()
        kept, old = commits[-keep:], commits[:-keep]
        if not kept:
            return []
        roots = {c: self._root(c) for c in kept}
        live = {f for c in kept for f in self.files(c)}
        names = {f"month-{y}-{m}-{c}.json" for root in roots.values() for (y, m), c in root.items()}
        for commit in old:
            storage.delete(self.spark, self._file(f"root-{commit}"))
        for name in storage.list_files(self.spark, f"{self.path}/manifests"):
            if name.startswith("month-") and name not in names:
                storage.delete(self.spark, f"{self.path}/manifests/{name}")
        gone = []
        for commit_dir in storage.list_dirs(self.spark, self._data):
            # A commit beyond the newest is one that broke off, or one that is being written.
            if int(commit_dir.removeprefix(f"{COMMIT}=")) > commits[-1]:
                continue
            for year in storage.list_dirs(self.spark, f"{self._data}/{commit_dir}"):
                for month in storage.list_dirs(self.spark, f"{self._data}/{commit_dir}/{year}"):
                    below = f"{commit_dir}/{year}/{month}"
                    for name in storage.list_files(self.spark, f"{self._data}/{below}"):
                        if name.endswith(".parquet") and f"{below}/{name}" not in live:
                            storage.delete(self.spark, f"{self._data}/{below}/{name}")
                            gone.append(f"{below}/{name}")
        return gone


def _without_commit() -> T.StructType:
    return T.StructType([f for f in STORED if f.name != COMMIT])
