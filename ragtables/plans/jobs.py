"""The jobs of a run, from stored tables to stored tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ragtables.operators import prompts, sampling
from ragtables.operators.corpus import Embedder, build_index
from ragtables.operators.evaluation import (
    GlobalMetric,
    LocalMetric,
    Processor,
    align_predictions,
    evaluate,
)
from ragtables.operators.generation import Model, generate_resumable
from ragtables.sources import storage, tables


def index_folder(
    spark: SparkSession,
    folder: str,
    path: str,
    make_model: Callable[[], Embedder],
    recreate: bool = False,
    length: int = 200,
    overlap: int = 20,
) -> DataFrame:
    """Index the text files of a folder; returns the stored index."""
    documents = tables.read_text_folder(spark, folder)
    chunks = build_index(documents, make_model, length=length, overlap=overlap)
    with storage.scratch(spark):
        tables.write_index(chunks, path, recreate)
    return tables.read_index(spark, path)


def training_tables(
    data: DataFrame,
    key: str,
    input_key: str,
    output_key: str,
    instruction: str,
    dev_share: float,
    seed: int | None = None,
    limit: int | None = None,
    instruction_in_prompt: bool = False,
    template: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Shuffle, limit, build chat messages (or ``text`` by a template), split.

    The shuffled rows are stored, since both parts and the split's passes read them.
    """
    data = storage.materialize(sampling.shuffle_select(data, key, seed, limit))
    if template is None:
        data = prompts.training_messages(
            data, input_key, output_key, instruction, instruction_in_prompt
        )
    else:
        data = prompts.training_text(
            data, template, input_key, output_key, instruction, instruction_in_prompt
        )
    return sampling.train_dev_split(data, key, dev_share, seed or 0)


def generate_answers(
    data: DataFrame,
    path: str,
    make_model: Callable[[], Model],
    instruction: str,
    input_key: str = "prompt",
    target_key: str = "answers",
    key: str = "row_id",
    limit: int | None = None,
    instruction_in_prompt: bool = False,
    template: str | None = None,
    rounds: int = 1,
    batch_size: int = 16,
    failed_share: float = 0.0,
) -> DataFrame:
    """Ask the model for what the prediction table lacks; returns the table.

    The model gets chat messages, or one text if there is a template.
    """
    if limit is not None:
        data = sampling.shuffle_select(data, key, limit=limit)
    if template is None:
        data = prompts.inference_messages(
            data, input_key, instruction, instruction_in_prompt, "_asked"
        )
    else:
        data = prompts.inference_text(data, template, instruction, input_key, "_asked")
    return generate_resumable(
        data,
        path,
        "_asked",
        target_key,
        make_model,
        key,
        rounds,
        batch_size,
        failed_share=failed_share,
    )


def evaluate_answers(
    data: DataFrame,
    predictions: DataFrame,
    path: str,
    local: Sequence[LocalMetric] = (),
    whole: Sequence[GlobalMetric] = (),
    processor: Processor | None = None,
    key: str = "row_id",
    limit: int | None = None,
) -> DataFrame:
    """Score stored predictions against the data; returns the stored results."""
    with storage.scratch(data.sparkSession):
        aligned = align_predictions(
            data, predictions, key, processor=processor, limit=limit
        )
        tables.write_results(evaluate(aligned, local, whole), path)
    return tables.read_results(data.sparkSession, path)
