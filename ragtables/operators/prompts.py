"""Prompts, few-shot blocks and chat messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ragtables.functions.templates import fill
from ragtables.operators.columns import quoted, require

# Fixed value: the system text of a chat without an instruction.
DEFAULT_INSTRUCTION = "You are an AI assistant that helps people find information."


def _types(schema: T.StructType) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in schema.fields}


def text_prompt(
    df: DataFrame, template: str, mapping: Mapping[str, str], output_key: str = "prompt"
) -> DataFrame:
    """Fill a template from the columns of each row."""
    return df.withColumn(
        output_key, fill(template, mapping, _types(df.schema), quoted)
    )


def fewshot_prompt(
    df: DataFrame,
    template: str,
    fewshot_key: str,
    mapping: Mapping[str, str],
    output_key: str,
) -> DataFrame:
    """Fill a template once per example and join the texts with a blank line."""
    require(df, [fewshot_key])
    dtype = df.schema[fewshot_key].dataType
    if not isinstance(dtype, T.ArrayType) or not isinstance(
        dtype.elementType, T.StructType
    ):
        raise TypeError(f"column {fewshot_key!r} must be an array of structs")
    types = _types(dtype.elementType)
    texts = F.transform(
        quoted(fewshot_key), lambda e: fill(template, mapping, types, lambda f: e[f])
    )
    return df.withColumn(output_key, F.array_join(texts, "\n\n"))


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def first_answer(df: DataFrame, key: str) -> Column:
    """The first list element or the string itself; null and nothing become ``""``."""
    value = quoted(key)
    if isinstance(df.schema[key].dataType, T.ArrayType):
        value = F.get(value, 0)
    return F.coalesce(value, F.lit(""))


def _user_text(query: Column, instruction: str, in_prompt: bool) -> Column:
    return F.concat(F.lit(instruction + "\n"), query) if in_prompt else query


def training_messages(
    df: DataFrame,
    input_key: str,
    output_key: str,
    instruction: str,
    instruction_in_prompt: bool = False,
) -> DataFrame:
    """Add ``messages``: system, user and assistant turn of one training record."""
    require(df, [input_key, output_key])
    query = _user_text(quoted(input_key), instruction, instruction_in_prompt)
    return df.withColumn(
        "messages",
        F.array(
            message("system", F.lit(instruction)),
            message("user", query),
            message("assistant", first_answer(df, output_key)),
        ),
    )


def training_text(
    df: DataFrame,
    template: str,
    input_key: str,
    output_key: str,
    instruction: str = "",
    instruction_in_prompt: bool = False,
) -> DataFrame:
    """Add ``text``: a template with ``{query}`` and ``{output}`` filled."""
    require(df, [input_key, output_key])
    values = {
        "query": _user_text(quoted(input_key), instruction, instruction_in_prompt),
        "output": first_answer(df, output_key),
    }
    types = dict.fromkeys(values, T.StringType())
    return df.withColumn(
        "text", fill(template, {n: n for n in values}, types, values.__getitem__)
    )


def inference_text(
    df: DataFrame, template: str, instruction: str, prompt_key: str, output_key: str
) -> DataFrame:
    """Fill a template with ``{instruction}`` and ``{query}``."""
    require(df, [prompt_key])
    values = {"instruction": F.lit(instruction), "query": quoted(prompt_key)}
    types = {"instruction": T.StringType(), "query": df.schema[prompt_key].dataType}
    return df.withColumn(
        output_key, fill(template, {n: n for n in values}, types, values.__getitem__)
    )


def inference_messages(
    df: DataFrame,
    prompt_key: str,
    instruction: str | None = None,
    instruction_in_prompt: bool = False,
    output_key: str = "messages",
) -> DataFrame:
    """Add the system and user turn for a chat model."""
    require(df, [prompt_key])
    system = instruction or DEFAULT_INSTRUCTION
    query = _user_text(quoted(prompt_key), system, instruction_in_prompt)
    return df.withColumn(
        output_key, F.array(message("system", F.lit(system)), message("user", query))
    )
