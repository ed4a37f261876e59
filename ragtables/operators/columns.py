"""Column selection, copying, constants, list joins and filters."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """A column by its literal name, also with a dot or a hyphen in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def require(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")


def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep the named columns, in that order."""
    require(df, columns)
    return df.select(*[quoted(c) for c in columns])


def update_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Copy columns ``{from: to}`` in mapping order.

    A later entry reads what an earlier one wrote. The copies are resolved here,
    so the plan gets one projection however long the mapping is.
    """
    current = {name: quoted(name) for name in df.columns}
    for source, target in mapping.items():
        if source not in current:
            raise ValueError(f"missing column {source!r}; there are {list(current)}")
        current[target] = current[source]
    return df.select(*[column.alias(name) for name, column in current.items()])


def constant(value: Any) -> Column:
    """A literal; lists become arrays and dicts become structs."""
    if isinstance(value, Mapping):
        return F.struct(*[constant(v).alias(k) for k, v in value.items()])
    if isinstance(value, (list, tuple)):
        return F.array(*[constant(v) for v in value])
    return F.lit(value)


def set_field(df: DataFrame, key: str, value: Any) -> DataFrame:
    """Set a column to a constant."""
    return df.withColumn(key, constant(value))


def tag(df: DataFrame, name: str, keyword: str = "source") -> DataFrame:
    """Add the table's name as a column."""
    return df.withColumn(keyword, F.lit(name))


def _array_of(df: DataFrame, key: str, element: type[T.DataType]) -> T.DataType:
    require(df, [key])
    dtype = df.schema[key].dataType
    if not isinstance(dtype, T.ArrayType) or not isinstance(dtype.elementType, element):
        raise TypeError(
            f"column {key!r} must be an array of {element.typeName()},"
            f" not {dtype.simpleString()}"
        )
    return dtype.elementType


def flatten_list(
    df: DataFrame, input_key: str, output_key: str, separator: str = ", "
) -> DataFrame:
    """Join an array of strings into one string. Null elements are skipped."""
    _array_of(df, input_key, T.StringType)
    return df.withColumn(output_key, F.array_join(quoted(input_key), separator))


def title_documents(
    df: DataFrame, docs_key: str, title_key: str = "title", text_key: str = "content"
) -> DataFrame:
    """Turn each document struct into ``"title: text"``, in place.

    A null title or text shows as ``None``.
    """
    fields = _array_of(df, docs_key, T.StructType).fieldNames()
    for name in (title_key, text_key):
        if name not in fields:
            raise ValueError(f"documents have no field {name!r}; they have {fields}")

    def render(doc: Column) -> Column:
        title = F.coalesce(doc[title_key].cast("string"), F.lit("None"))
        text = F.coalesce(doc[text_key].cast("string"), F.lit("None"))
        return F.concat(title, F.lit(": "), text)

    return df.withColumn(docs_key, F.transform(quoted(docs_key), render))


def join_documents(
    df: DataFrame, docs_key: str, k: int | None = None, separator: str = "\n"
) -> DataFrame:
    """Join the first ``k`` documents (all without ``k``) into one string, in place."""
    _array_of(df, docs_key, T.StringType)
    docs = quoted(docs_key)
    if k is not None:
        docs = F.slice(docs, 1, k)
    return df.withColumn(docs_key, F.array_join(docs, separator))


def has_selected_passage() -> Column:
    """At least one passage is marked as selected."""
    return F.array_contains(F.col("passages.is_selected"), 1)


# Named row predicates; users add their own with ``register_filter``. Fixed value: the
# name of the first.
FILTERS: dict[str, Callable[[], Column]] = {"MSMARCO": has_selected_passage}


def register_filter(name: str, predicate: Callable[[], Column]) -> None:
    if name in FILTERS:
        raise ValueError(f"there is a filter {name!r} already")
    FILTERS[name] = predicate


def filter_rows(df: DataFrame, name: str) -> DataFrame:
    """Keep the rows for which a registered predicate holds."""
    return df.filter(FILTERS[name]())
