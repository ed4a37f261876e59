"""Prompt templates with ``{name}`` placeholders, compiled to one ``concat``.

A template is split once, on the driver. Per row only the literals and the
columns are joined, inside generated code.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The plain layouts, whose text and placeholder names are part of the
# interface.
QA = "Question: {question}\nContext:\n{context}"
QA_SHORT = "Question: {query}"
QA_WITH_ANSWER = "Question: {question}\nContext:\n{context}\nAnswer: {answer}"
QA_FEWSHOT = "Examples:\n{fewshot}\n\nQuestion: {question}\nContext:\n{context}"

# Our own wording, but for the fixed marks ##begin_quote##, ##end_quote## and <ANSWER>:.
_REASONING = (
    "\n\nUse only the context. Explain your reasoning first and put every"
    " sentence copied from the context between ##begin_quote## and"
    " ##end_quote##. Finish with a brief result written as"
    " <ANSWER>: $answer"
)
COT = QA + _REASONING
COT_FEWSHOT = QA_FEWSHOT + _REASONING
FACT_STATEMENT = "Source [{i}] says: {content}"
REASON_BEFORE_ANSWER = "{reasoning}\nSo the answer is:"

INSTRUCTION_QA = "Answer the question with the help of the given context."
INSTRUCTION_QA_SHORT = INSTRUCTION_QA + " Reply with a few words only."
INSTRUCTION_YES_NO = INSTRUCTION_QA + " Reply with yes or no."
INSTRUCTION_YES_NO_MAYBE = (
    INSTRUCTION_QA + " Reply with yes or no, or with maybe if the context does"
    " not settle it."
)


def split_template(template: str) -> list[tuple[str, str | None]]:
    """``(literal, placeholder or None)`` pairs; doubled braces are unescaped."""
    parts = []
    for literal, name, spec, conversion in Formatter().parse(template):
        if name is not None and (not name.isidentifier() or spec or conversion):
            raise ValueError(f"only plain {{name}} placeholders are supported: {name!r}")
        parts.append((literal, name))
    return parts


def as_text(value: Column, dtype: T.DataType) -> Column:
    """A value the way a template shows it: null as ``None``, truth capitalised."""
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        raise TypeError(f"a placeholder needs a plain value, not {dtype.simpleString()}")
    if isinstance(dtype, T.BooleanType):
        value = F.when(value, "True").otherwise(F.when(~value, "False"))
    return F.coalesce(value.cast("string"), F.lit("None"))


def fill(
    template: str,
    mapping: Mapping[str, str],
    types: Mapping[str, T.DataType],
    get: Callable[[str], Column],
) -> Column:
    """The filled template.

    ``mapping`` names a field for each placeholder. A field that is missing from
    ``types`` is filled with nothing; a placeholder missing from ``mapping`` is
    an error. Mapping entries that the template does not use are ignored.
    """
    pieces = []
    for literal, name in split_template(template):
        if literal:
            pieces.append(F.lit(literal))
        if name is None:
            continue
        if name not in mapping:
            raise KeyError(f"no mapping for placeholder {name!r}")
        field = mapping[name]
        if field in types:
            pieces.append(as_text(get(field), types[field]))
    return F.concat(*pieces) if pieces else F.lit("")
