"""Readers and writers: question tables, corpora, predictions, results, indexes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ragtables.operators.columns import require
from ragtables.sources import storage
from ragtables.sources.predictions import PredictionStore, prediction_schema

# Ids of documents are sent to all tasks up to this many bytes.
SENT_BYTES = 32_000_000

RESULTS = T.StructType(
    [
        T.StructField("scope", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def load_table(
    spark: SparkSession,
    source: str,
    format: str | None = None,
    split: str | None = None,
    split_column: str = "split",
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """A catalog table, or files when a ``format`` is given.

    ``split`` keeps the rows with that value in ``split_column``; where the table
    is partitioned by it, only that partition is read.
    """
    if format is None:
        df = spark.table(source)
    else:
        reader = spark.read.format(format).options(**options)
        df = (reader.schema(schema) if schema is not None else reader).load(source)
    if split is None:
        return df
    require(df, [split_column])
    return df.filter(F.col(split_column) == split)


def balanced(df: DataFrame) -> DataFrame:
    """Spread a table over the cores if its files have far fewer splits than that.

    For a few files that cannot be split, read by a job that computes much per
    row. A table with enough splits, as any large one has, is left as it is. Call
    it on a plain scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df


def load_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """JSON lines. Without a schema Spark reads all files once more to infer it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def jsonl_path(
    prefix: str, table: str, filename: str | None = None, directory: str | None = None
) -> str:
    name = f"{prefix}-{filename or table}.jsonl"
    return f"{directory.rstrip('/')}/{name}" if directory else name


def write_jsonl(
    frames: Mapping[str, DataFrame],
    inputs: Sequence[str],
    prefix: str,
    filename: str | None = None,
    directory: str | None = None,
) -> dict[str, str]:
    """Write each named table as a folder of JSON lines; returns the folders.

    Every task writes its own file. Two tables with one target are refused.
    """
    paths = {n: jsonl_path(prefix, n, filename, directory) for n in inputs}
    if len(set(paths.values())) < len(paths):
        raise ValueError(f"tables {list(paths)} would overwrite each other")
    for name, path in paths.items():
        frames[name].write.mode("overwrite").json(path)
    return paths


def publish(
    df: DataFrame, name: str, format: str = "parquet", path: str | None = None
) -> None:
    """Publish a table in the catalog under a name, at ``path`` if one is given."""
    writer = df.write.mode("overwrite").format(format)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def read_text_folder(
    spark: SparkSession, folder: str, pattern: str = "*.txt"
) -> DataFrame:
    """One row per text file of a folder: ``doc_id`` (its path), ``title``, ``content``.

    Files carry no title, so it is null.
    """
    files = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True)
    return files.select(
        F.col("_metadata.file_path").alias("doc_id"),
        F.lit(None).cast("string").alias("title"),
        F.col("value").alias("content"),
    )


def append_predictions(
    df: DataFrame,
    path: str,
    key: str = "row_id",
    extra: Sequence[str] = (),
    batch: str | None = None,
) -> None:
    """Add ``key``, ``text``, ``target``, ``error`` (and extra columns) to a prediction
    store, as a new batch or in the place of that ``batch``. Rows without an ``error``
    column are successes."""
    if "error" not in df.columns:
        df = df.withColumn("error", F.lit(None).cast("string"))
    schema = prediction_schema(df, key, "target", extra)
    PredictionStore(df.sparkSession, path, schema, key).write(df, batch)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Predictions, one per key.

    A key may have been written more than once, by a restarted job or after a
    failure. A success wins over a failure, an answer over an empty one, and then
    the least text, whatever the order of the files. The store is grouped by its
    buckets, without a shuffle.
    """
    return PredictionStore(spark, path).best()


def write_results(results: DataFrame, path: str) -> None:
    """Write ``(scope, metric, value)`` rows as one JSON file.

    One row per metric: a handful, whatever the size of the evaluated table.
    """
    results.select("scope", "metric", "value").coalesce(1).write.mode(
        "overwrite"
    ).json(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESULTS).json(path)


def _write_chunks(chunks: DataFrame, path: str, mode: str, **options: str) -> None:
    """Chunks with a ``cell`` are gathered by it first, so that a cell is a file or, if it
    is large, a few: Spark splits a cell that exceeds its advised partition size."""
    if "cell" in chunks.columns:
        chunks.hint("rebalance", "cell").write.mode(mode).options(**options).partitionBy(
            "cell"
        ).parquet(path)
    else:
        chunks.write.mode(mode).options(**options).parquet(path)


def _replace_in_cells(
    stored: DataFrame, chunks: DataFrame, known: DataFrame, again: DataFrame, path: str
) -> None:
    """Replace documents in the cells that hold them; no other cell is read or written.

    A cell's new content takes the old one's place when the whole job commits, and a run
    that ends between the steps is mended by doing the same again.
    """
    spark = chunks.sparkSession
    # A number per folder of the table, all of which Spark lists on the driver anyway.
    met = {r["cell"] for r in known.select("cell").distinct().collect()}
    cell = F.col("cell")
    touched = cell.isin([c for c in met if c is not None])
    if None in met:
        touched = touched | cell.isNull()
    touched = F.coalesce(touched, F.lit(False))
    # Ids that are few enough are sent to the stored chunks, which then move only once.
    width = F.coalesce(F.octet_length(F.col("doc_id").cast("string")), F.lit(0)) + 32
    size = again.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    if size <= SENT_BYTES:
        again = F.broadcast(again)
    kept = stored.filter(touched).join(again, "doc_id", "left_anti").select(*chunks.columns)
    # Only the cells that are written change, and only when the whole job commits, so that
    # the table may be read meanwhile.
    content = kept.union(chunks.filter(touched))
    filled = {r["cell"] for r in content.select("cell").distinct().collect()}
    _write_chunks(content, path, "overwrite", partitionOverwriteMode="dynamic")
    for empty in met - filled:
        name = "__HIVE_DEFAULT_PARTITION__" if empty is None else empty
        storage.delete(spark, f"{path}/cell={name}")
    _write_chunks(chunks.filter(~touched), path, "append")


def write_index(chunks: DataFrame, path: str, recreate: bool = False) -> None:
    """Store embedded chunks; ``recreate`` replaces what is there, else they are added.

    Chunks with a ``cell`` are stored by cell, so that a search reads only the cells
    it probes. A document that is written again replaces its earlier chunks: in a table
    by cell, the cells that hold some of them are written anew and the others left as
    they are; else what stays and what is new are written as a whole table, which then
    takes the old one's place.
    """
    spark = chunks.sparkSession
    columns = ["chunk_id", "doc_id", "title", "content", "embedding"]
    require(chunks, columns)
    by = ["cell"] if "cell" in chunks.columns else []
    chunks = chunks.select(*columns, *by)
    storage.finish_replacing(spark, path)
    if recreate or not storage.is_complete(spark, path):
        _write_chunks(chunks, path, "overwrite")
        return
    stored = read_index(spark, path)
    if stored.columns != chunks.columns:
        raise ValueError(f"the index has columns {stored.columns}, not {chunks.columns}")
    chunks = storage.materialize(chunks)
    again = chunks.select("doc_id").distinct()
    known = stored.join(again, "doc_id", "left_semi")
    if known.isEmpty():
        _write_chunks(chunks, path, "append")
    elif by and isinstance(stored.schema["cell"].dataType, T.IntegralType):
        _replace_in_cells(stored, chunks, known, again, path)
    else:
        kept = stored.join(again, "doc_id", "left_anti").select(*chunks.columns)
        storage.replace(
            spark, path, lambda to: _write_chunks(kept.union(chunks), to, "overwrite")
        )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    storage.finish_replacing(spark, path)
    return spark.read.parquet(path)
