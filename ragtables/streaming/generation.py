"""Generation over a growing folder: new rows only, progress kept over restarts.

A stream writes to the store that batch jobs write to, each micro-batch as a batch of
its own that a repetition replaces. With ``tries`` a failed prompt stays in the
stream's state, and a timer asks again.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ragtables.operators.columns import quoted, require
from ragtables.operators.generation import Model, _call, generate
from ragtables.sources.predictions import PredictionStore, prediction_schema

# Groups of keys that wait together, so that the model is asked in batches.
GROUPS = 32
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Asking(StatefulProcessor):
    """Answers prompts; those that fail wait and are asked again."""

    def __init__(
        self, make_model: Callable[[], Model], batch_size: int, pause: float, tries: int, wait_ms: int, key_type: str
    ) -> None:
        self.make_model, self.batch_size, self.pause = make_model, batch_size, pause
        self.tries, self.wait_ms, self.key_type = tries, wait_ms, key_type

    def init(self, handle) -> None:
        self.handle, self.model = handle, self.make_model()
        self.waiting = handle.getMapState("waiting", f"key {self.key_type}", "asked string, kept string, tries int")

    def _ask(self, rows: list[tuple], timers) -> Iterator[pd.DataFrame]:
        """``rows`` of key, prompt, what else to keep, and tries so far."""
        out, left = [], False
        for start in range(0, len(rows), self.batch_size):
            part = rows[start : start + self.batch_size]
            prompts = [json.loads(asked)["p"] if asked else None for _, asked, _, _ in part]
            for (key, asked, kept, tries), (text, error) in zip(part, _call(self.model, prompts, self.pause)):
                if error is not None and tries + 1 < self.tries:
                    self.waiting.updateValue((key,), (asked, kept, tries + 1))
                    left = True
                    continue
                if tries:
                    self.waiting.removeKey((key,))
                out.append((key, text, kept, error, tries + 1))
        if left:
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.wait_ms)
        yield pd.DataFrame(out, columns=["key", "text", "kept", "error", "tries"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            new = [(k, a, o, 0) for k, a, o in zip(part["key"].tolist(), part["asked"], part["kept"])]
            yield from self._ask(new, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rows = [(k[0], *value) for k, value in self.waiting.iterator()]
        yield from self._ask(rows, timerValues)

    def close(self) -> None:
        pass


def _asked_again(
    stream: DataFrame, input_key: str, target_key: str, key: str, make_model, batch_size: int, pause: float,
    tries: int, wait: float,
) -> DataFrame:
    """``key, text, target, error`` of the stream's rows, each once it is answered or
    has failed ``tries`` times. Prompt and target travel and wait as JSON."""
    target = stream.schema[target_key].dataType
    key_type = stream.schema[key].dataType.simpleString()
    rows = stream.select(
        quoted(key).alias("key"),
        F.to_json(F.struct(quoted(input_key).alias("p"))).alias("asked"),
        F.to_json(F.struct(quoted(target_key).alias("t"))).alias("kept"),
        F.pmod(F.xxhash64(quoted(key)), F.lit(GROUPS)).alias("group"),
    )
    asking = _Asking(make_model, batch_size, pause, tries, int(1000 * wait), key_type)
    answered = rows.groupBy("group").transformWithStateInPandas(
        asking, f"key {key_type}, text string, kept string, error string, tries int", "append", "processingTime"
    )
    kept = F.from_json("kept", T.StructType([T.StructField("t", target)]))["t"]
    return answered.select(F.col("key").alias(key), "text", kept.alias("target"), "error")


def stream_generate(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    input_key: str,
    target_key: str,
    make_model: Callable[[], Model],
    key: str = "row_id",
    batch_size: int = 16,
    pause: float = 0.0,
    interval: str | None = None,
    tries: int = 1,
    wait: float = 1.0,
) -> StreamingQuery:
    """Start a query that answers new rows and stores ``key, text, target, error``.

    ``path`` is a prediction store, which batch jobs may read and add to as well.
    ``checkpoint`` names what was read and committed; a micro-batch that is repeated
    after a failure replaces itself, so a rerun adds nothing.

    With ``tries`` of one, a failed prompt is stored with its error and a null text, and
    ``generate_resumable`` on a table of the same rows and this ``path`` asks again;
    without ``interval`` the query works off what is there, in batches of the source's
    own size limit, and ends. With more ``tries``, a failed prompt is asked again
    after ``wait`` seconds, by the query or by the next one on this checkpoint, and
    stored when it is answered or has failed that often. Such a query goes on until it
    is stopped; ``run_until_answered`` does that.
    """
    if not stream.isStreaming:
        raise ValueError("stream_generate needs a streaming table")
    require(stream, [key, input_key, target_key])
    store = PredictionStore(stream.sparkSession, path, prediction_schema(stream, key, target_key), key)
    if tries > 1:
        rows = _asked_again(stream, input_key, target_key, key, make_model, batch_size, pause, tries, wait)
        trigger = {"processingTime": interval or "0 seconds"}
    else:
        answered = generate(
            stream, input_key, "_text", make_model, batch_size, pause, error_key="_error"
        )
        rows = answered.select(
            quoted(key).alias(key),
            F.col("_text").alias("text"),
            quoted(target_key).alias("target"),
            F.col("_error").alias("error"),
        )
        trigger = {"processingTime": interval} if interval else {"availableNow": True}

    def keep(batch: DataFrame, number: int) -> None:
        # The checkpoint's own id: batch numbers start anew with another checkpoint.
        own = json.loads(batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        store.write(batch, f"stream-{own}-{number}")

    writer = rows.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    conf = stream.sparkSession.conf
    before = conf.get(_STATE_STORE)
    try:
        if tries > 1:
            conf.set(_STATE_STORE, _ROCKS)  # a started query keeps its own settings
        return writer.trigger(**trigger).start()
    finally:
        conf.set(_STATE_STORE, before)


def run_until_answered(query: StreamingQuery, seconds: float | None = None) -> bool:
    """Waits until a query with ``tries`` has read all there is and no prompt waits,
    then stops it. False if that took longer than ``seconds``."""
    end = time.monotonic() + seconds if seconds is not None else None
    while query.isActive:
        seen = query.lastProgress
        if seen and not seen["numInputRows"] and not sum(s["numRowsTotal"] for s in seen["stateOperators"]):
            query.stop()
            return True
        if end is not None and time.monotonic() > end:
            query.stop()
            return False
        time.sleep(0.1)
    query.awaitTermination()  # raises what ended it
    return False
