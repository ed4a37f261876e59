"""The stored predictions that batch jobs and streams share.

A store is a folder bucketed and sorted by the row's key, with a partition for each
batch of a job or stream. A batch that is written again replaces itself, so nothing
needs a log of what was committed, and whatever wrote a batch, every reader sees it.
What is done is found by an anti-join that reads the store bucket by bucket without
moving it; only the keys of the table that asks are moved.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ragtables.operators.columns import quoted, require
from ragtables.sources import storage

PART = "stored_in"
BUCKETS = 8
# Batches beyond which a store is worth compacting.
MANY_BATCHES = 100


def prediction_schema(df: DataFrame, key: str, target: str, extra: Sequence[str] = ()) -> T.StructType:
    """``key, text, target, error`` and further columns, typed as in ``df``."""
    fields = [(key, df.schema[key].dataType), ("text", T.StringType()), ("target", df.schema[target].dataType)]
    fields += [("error", T.StringType()), *((e, df.schema[e].dataType) for e in extra)]
    return T.StructType([T.StructField(n, t) for n, t in fields])


class PredictionStore:
    """A store at a path of the shared storage.

    A new one needs the ``schema`` of its rows; one that is there has its own, and the
    key and number of buckets it was made with, which are kept beside it.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType | None = None,
        key: str = "row_id",
        buckets: int | None = None,
    ) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        layout = f"{self.path}_layout"
        if storage.exists(spark, f"{self.path}/_spark_metadata"):
            raise ValueError(f"{path} has a stream's sink log, which would hide every other batch")
        if not storage.is_complete(spark, layout):
            if schema is None:
                raise FileNotFoundError(f"no predictions at {path}")
            if storage.exists(spark, self.path):
                raise ValueError(f"{path} is there, but is no store of predictions")
            buckets = buckets or max(BUCKETS, spark.sparkContext.defaultParallelism)
            made = json.dumps({"key": key, "buckets": buckets, "schema": json.loads(schema.json())})
            row = spark.createDataFrame([(made,)], "layout string")
            row.coalesce(1).write.mode("overwrite").text(layout)
        known = json.loads(spark.read.text(layout).first()[0])
        self.key, self.buckets = known["key"], known["buckets"]
        self.schema = T.StructType.fromJson(known["schema"])
        if schema is not None and [(f.name, f.dataType) for f in schema] != [
            (f.name, f.dataType) for f in self.schema
        ]:
            raise ValueError(f"the store has {self.schema.simpleString()}, not {schema.simpleString()}")
        self.name = f"predictions_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        place = self.path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, {PART} string) USING parquet"
            f" PARTITIONED BY ({PART}) CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`)"
            f" INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )

    def _refresh(self) -> None:
        if storage.exists(self.spark, self.path):  # nothing is written yet otherwise
            self.spark.sql(f"MSCK REPAIR TABLE {self.name} SYNC PARTITIONS")
        self.spark.catalog.refreshTable(self.name)

    def batches(self) -> list[str]:
        self._refresh()
        return [r[0].split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()]

    def table(self) -> DataFrame:
        """All stored rows; a key may stand in several batches."""
        self._refresh()
        return self.spark.table(self.name).drop(PART)

    def write(self, rows: DataFrame, batch: str | None = None, placed: bool = False) -> None:
        """Stores rows as ``batch``, in the place of what it held; by default a new one.
        Rows ``placed`` by key already are not moved."""
        spark = rows.sparkSession
        require(rows, self.schema.names)
        rows = rows.select(*[quoted(n) for n in self.schema.names])
        if not placed:
            rows = rows.repartition(self.buckets, quoted(self.key))
        how = "OVERWRITE" if batch else "INTO"  # a new one has nothing to replace
        batch = batch or f"run-{uuid.uuid4().hex}"
        view = f"new_{uuid.uuid4().hex}"
        rows.createOrReplaceTempView(view)
        try:
            spark.sql(f"INSERT {how} TABLE {self.name} PARTITION ({PART}='{batch}') SELECT * FROM {view}")
        finally:
            spark.catalog.dropTempView(view)

    def remaining(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` without a stored answer. A failed one does not count."""
        done = self.table()
        if "error" in self.schema.names:
            done = done.filter(F.col("error").isNull())
        done = done.select(quoted(self.key))
        return df.hint("merge").join(done.hint("merge"), self.key, "left_anti")

    def best(self, rows: DataFrame | None = None) -> DataFrame:
        """One row a key: a success wins over a failure, an answer over an empty one,
        and then the least text, whatever the order of the batches."""
        rest = [n for n in self.schema.names if n != self.key]
        failed = F.col("error").isNotNull() if "error" in rest else F.lit(False)
        empty = F.coalesce(F.col("text") == "", F.lit(True))
        row = F.min_by(F.struct(*[quoted(n) for n in rest]), F.struct(failed, empty, "text")).alias("_row")
        rows = self.table() if rows is None else rows
        return rows.groupBy(quoted(self.key)).agg(row).select(quoted(self.key), "_row.*")

    def compact(self) -> None:
        """Puts the best row of each key into one batch, with a file a bucket. The old
        batches go after that; if the run ends in between, both hold the same."""
        old = self.batches()
        held = self.spark.table(self.name).filter(F.col(PART).isin(old)).drop(PART)
        self.write(self.best(held), placed=True)
        for batch in old:
            storage.delete(self.spark, f"{self.path}/{PART}={batch}")
        self._refresh()
