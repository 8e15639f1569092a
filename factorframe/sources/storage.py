"""Paths on whatever filesystem Spark is configured for, and the scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_LOCAL_CHECKPOINTS: list[str] = []


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a path with all below it; False when there was nothing."""
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, src = _fs(spark, source)
    dst = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not rename {source} to {target}")


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, sorted."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in ``path``, sorted; none when there is no such folder."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, there as a whole or not at all; it replaces one that is there."""
    aside = sibling(path, "aside")
    fs, p = _fs(spark, aside)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    delete(spark, path)
    rename(spark, aside, path)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


def sibling(path: str, label: str) -> str:
    """A fresh hidden path next to ``path``, so a rename stays on one filesystem."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{label}-{name}-{uuid.uuid4().hex}" if parent else f".{label}-{name}-{uuid.uuid4().hex}"


def read_parquet_if_exists(spark: SparkSession, path: str, **options: str) -> DataFrame | None:
    """The dataset, or None when the path is missing or holds no file.

    Any other analysis error (a schema clash, say) is raised.
    """
    try:
        return spark.read.options(**options).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if not _LOCAL_CHECKPOINTS:
        _LOCAL_CHECKPOINTS.append(tempfile.mkdtemp(prefix="factorframe-"))
    return _LOCAL_CHECKPOINTS[0]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative jobs a place to cut their lineage, unless they have one."""
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
