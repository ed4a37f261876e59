"""Registry of this subpackage's queries, and helpers that its operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else. Pure ASCII takes the fast way."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def crc_remainder(doc_id: Column, modulus: int = 4) -> Column:
    """crc32 of the id as text, modulo ``modulus``: the fold of a document."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def put(df: DataFrame, **columns: Column) -> DataFrame:
    """Columns added under names that replace equal ones in any letter case."""
    taken = {name.lower() for name in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in columns.items()])


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SMALL_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2_000) -> Iterator[None]:
    """Jobs that run inside hand whole texts to Python in batches of at most so many
    rows and about ``SMALL_BYTES``, which bounds what a task holds on either side. A
    longer text is a batch of its own."""
    before = {name: spark.conf.get(name) for name in (_BATCH_ROWS, _BATCH_BYTES)}
    known = int(before[_BATCH_ROWS])
    spark.conf.set(_BATCH_ROWS, str(min(rows, known) if known > 0 else rows))
    spark.conf.set(_BATCH_BYTES, f"{SMALL_BYTES}b")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def released(function: Batches) -> Batches:
    """``function``, after which the worker, which Spark keeps, gives memory back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return run


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as make it a new column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# A table of at most this many narrow rows (some tens of bytes) may be broadcast.
BROADCAST_ROWS = 500_000


def sent(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else as it is.

    Counts the rows, so give it a stored table of narrow rows.
    """
    return F.broadcast(df) if df.count() <= rows else df
