"""Paths on the cluster's shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
# The folder of a local session that names none, by application.
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A local session without that setting gets a fresh temporary folder, kept for
    the session. On a cluster a machine-local folder would be lost with its
    machine, so the setting is required there.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="ragtables-")
    return _LOCAL[app]


def _path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _path(spark, path)
    return fs.exists(jpath)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True if a write to this folder was committed."""
    return exists(spark, path.rstrip("/") + "/_SUCCESS")


def delete(spark: SparkSession, path: str) -> bool:
    fs, jpath = _path(spark, path)
    return fs.delete(jpath, True)


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Put a table in the place of another one, which ``write`` may still read.

    The new table is written beside the old one. If the run ends between the two
    steps that follow, ``finish_replacing`` does the rest.
    """
    beside = path.rstrip("/") + ".new"
    delete(spark, beside)
    write(beside)
    delete(spark, path)
    finish_replacing(spark, path)


def finish_replacing(spark: SparkSession, path: str) -> None:
    """Put a whole new table in its place if the old one is gone."""
    beside = path.rstrip("/") + ".new"
    if not exists(spark, path) and is_complete(spark, beside):
        fs, jpath = _path(spark, path)
        fs.rename(_path(spark, beside)[1], jpath)


def file_states(df: DataFrame) -> str | None:
    """A digest of the paths, lengths and times of a table's input files, whatever
    their order; None if it reads no files.

    The list stays in the JVM, where Spark has it for the plan anyway, and is listed
    and summed by a Spark job.
    """
    spark = df.sparkSession
    files = df._jdf.inputFiles()
    if not len(files):
        return None
    reader = spark._jsparkSession.read().format("binaryFile")
    listed = DataFrame(reader.option("recursiveFileLookup", "true").load(files), spark)
    state = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    row = listed.agg(F.count(F.lit(1)), F.sum(state)).first()
    return f"{row[0]}:{row[1]}"


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{kind}/{uuid.uuid4().hex}"


# The scopes that are open, and the tables stored in each.
_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that are materialized inside when it ends. For a job whose
    results are stored by then."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            delete(spark, path)


def materialize(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it back.

    For an intermediate result that is used more than once and dear to compute:
    it outlives lost executors, and the plan starts anew from the files. Within
    ``scratch`` the table goes when that ends; one to ``keep`` belongs to the scope
    around it, if there is any.
    """
    path = fresh_path(df.sparkSession, "tables")
    scopes = _SCRATCH[:-1] if keep else _SCRATCH
    if scopes:
        scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
