"""Batch calls to a user-supplied model, resumable."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ragtables.operators.columns import quoted, require
from ragtables.operators.prompts import inference_messages
from ragtables.sources import storage
from ragtables.sources.predictions import MANY_BATCHES, PredictionStore, prediction_schema

Model = Callable[[list], Sequence[str]]

log = logging.getLogger(__name__)

_ANSWER = T.StructType(
    [T.StructField("answer", T.StringType()), T.StructField("error", T.StringType())]
)


def _call(model: Model, prompts: list, pause: float) -> list[tuple[str | None, str | None]]:
    """Answers of one batch; if the batch fails, each prompt is tried alone."""
    if pause:
        time.sleep(pause)
    try:
        answers = list(model(prompts))
        if len(answers) != len(prompts):
            raise ValueError(f"{len(answers)} answers to {len(prompts)} prompts")
        return [(a, None) for a in answers]
    except Exception as error:
        if len(prompts) == 1:
            log.info("model call failed: %s", error)
            return [(None, f"{type(error).__name__}: {error}")]
        return [pair for p in prompts for pair in _call(model, [p], pause)]


def generate(
    df: DataFrame,
    input_key: str,
    output_key: str,
    make_model: Callable[[], Model],
    batch_size: int = 16,
    pause: float = 0.0,
    error_key: str | None = None,
) -> DataFrame:
    """Add the model's answer to each prompt (a string, or chat messages).

    ``make_model`` runs once per task, on the executor. Only the prompt travels to
    Python. A failed prompt gets a null answer, and its reason in ``error_key``;
    the job goes on. ``pause`` seconds pass before each call, so the call rate is
    at most (number of running tasks) / pause.
    """
    require(df, [input_key])

    @F.pandas_udf(_ANSWER)
    def answers(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for prompts in batches:
            prompts = prompts.tolist()
            made = []
            for start in range(0, len(prompts), batch_size):
                made.extend(_call(model, prompts[start : start + batch_size], pause))
            yield pd.DataFrame(made, columns=["answer", "error"])

    # A model call is a side effect: keep the optimizer from repeating it.
    call = answers.asNondeterministic()
    done = df.withColumn("_call", call(quoted(input_key)))
    columns = {output_key: F.col("_call.answer")}
    if error_key:
        columns[error_key] = F.col("_call.error")
    return done.withColumns(columns).drop("_call")


def chat(
    df: DataFrame,
    prompt_key: str,
    answer_key: str,
    make_model: Callable[[], Model],
    instruction: str | None = None,
    batch_size: int = 1,
    pause: float = 1.0,
    error_key: str | None = None,
) -> DataFrame:
    """Ask a chat service with a system instruction; a failed call answers ``""``.

    A prompt that is a list of messages already is sent as it is.
    """
    require(df, [prompt_key])
    if isinstance(df.schema[prompt_key].dataType, T.ArrayType):
        asked = df.withColumn("_messages", quoted(prompt_key))
    else:
        asked = inference_messages(df, prompt_key, instruction, output_key="_messages")
    done = generate(
        asked, "_messages", answer_key, make_model, batch_size, pause, error_key
    )
    answer = F.coalesce(quoted(answer_key), F.lit(""))
    return done.withColumn(answer_key, answer).drop("_messages")


def generate_resumable(
    df: DataFrame,
    path: str,
    input_key: str,
    target_key: str,
    make_model: Callable[[], Model],
    key: str = "row_id",
    rounds: int = 1,
    batch_size: int = 16,
    pause: float = 0.0,
    failed_share: float = 0.0,
) -> DataFrame:
    """Generate what a prediction store lacks, add it, and return the predictions.

    What is lacking is found once, without moving the store. Each of the ``rounds``
    handles an even share of it and commits on its own, so that a broken run loses one
    round at most. A failed prompt is stored with its ``error`` and a null text, and
    counts as lacking: the next run asks again. If more than ``failed_share`` of a
    round's prompts fail, the run ends with an error once that round is stored. A
    store of very many batches is compacted first.
    """
    spark: SparkSession = df.sparkSession
    require(df, [key, input_key, target_key])
    store = PredictionStore(spark, path, prediction_schema(df, key, target_key), key)
    batches = store.batches()
    if len(batches) > MANY_BATCHES:
        store.compact()
    lacking = store.remaining(df) if batches else df
    if rounds > 1:
        share = F.pmod(F.xxhash64(quoted(key)), F.lit(rounds)).alias("_round")
        asked = lacking.select(quoted(key), quoted(input_key), quoted(target_key), share)
        lacking = storage.materialize(asked)
    for number in range(rounds):
        todo = lacking.filter(F.col("_round") == number).drop("_round") if rounds > 1 else lacking
        if rounds > 1 or not batches:  # else they come by bucket from the anti-join
            todo = todo.repartition(store.buckets, quoted(key))
        answered = generate(
            todo, input_key, "text", make_model, batch_size, pause, error_key="error"
        )
        seen = Observation()
        answered = answered.withColumn("target", quoted(target_key)).observe(
            seen,
            F.count(F.lit(1)).alias("asked"),
            F.count("error").alias("failed"),
        )
        store.write(answered, placed=True)
        asked, failed = (seen.get.get(n, 0) for n in ("asked", "failed"))
        if failed > failed_share * asked:
            raise RuntimeError(
                f"{failed} of {asked} prompts failed; answers are stored, and a"
                " further run asks for the others"
            )
    return store.best()
