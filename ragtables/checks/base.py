"""Registry of the checked queries, and the inputs they share.

A query is a function ``(spark, folder) -> DataFrame`` over the given tables. Its
SQL, where there is one, computes the same rows in another engine. The shared
inputs are built once here for Spark and once, independently, as SQL text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ragtables.functions.text import PUNCTUATION, chunk_words
from ragtables.sources.tables import balanced

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ---------------------------------------------------------------- Spark inputs


def qa(spark: SparkSession, folder: str) -> DataFrame:
    """User turns with the assistant's next turn: ``row_id, conv_id, turn, query,
    answer``. The join key is unique even where one conversation is huge."""
    turns = balanced(table(spark, folder, "conversations"))
    users = turns.filter("role = 'user'").select(
        "conv_id", "turn", F.col("text").alias("query")
    )
    replies = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return users.join(replies, ["conv_id", "turn"]).select(
        F.concat_ws(":", "conv_id", "turn").alias("row_id"),
        "conv_id",
        "turn",
        "query",
        "answer",
    )


def predictions(rows: DataFrame) -> DataFrame:
    """Made-up model answers: right but decorated, too long, or in reverse order."""
    answer, query = F.col("answer"), F.col("query")
    text = (
        F.when(
            F.length(answer) < 2 * F.length(query),
            F.concat(F.lit('The "'), answer, F.lit('"!')),
        )
        .when(F.length(answer) < 4 * F.length(query), F.concat_ws(" ", query, answer))
        .otherwise(F.array_join(F.reverse(F.split(answer, " ")), " "))
    )
    return rows.select("row_id", text.alias("text"), answer.alias("target"))


def passages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with all their 50-word pieces: ``doc_id, source, passages``."""
    return balanced(table(spark, folder, "documents")).select(
        "doc_id", "source", chunk_words("text", 50, 0).alias("passages")
    )


def titled(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as ``doc_id, title, content``; some have no title."""
    return balanced(table(spark, folder, "documents")).select(
        "doc_id",
        F.nullif(F.col("source"), F.lit("src0")).alias("title"),
        F.col("text").alias("content"),
    )


# ------------------------------------------------------------------ SQL inputs

SQL_QA = """qa AS (
  SELECT u.conv_id || ':' || u.turn AS row_id, u.conv_id, u.turn,
         u.text AS query, a.text AS answer
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

SQL_PRED = """pred AS (
  SELECT row_id, query, answer,
         CASE WHEN length(answer) < 2 * length(query) THEN 'The "' || answer || '"!'
              WHEN length(answer) < 4 * length(query) THEN query || ' ' || answer
              ELSE array_to_string(list_reverse(string_split(answer, ' ')), ' ')
         END AS text
  FROM qa)"""


def sql_chunks(words: str, length: int, overlap: int) -> str:
    """SQL for the word windows of a list of words."""
    step = length - overlap
    return (
        f"list_filter(list_transform(range(0, CASE WHEN len({words}) <= {length} THEN 1"
        f" ELSE CAST(ceil((len({words}) - {length}) / {step}.0) AS BIGINT) * {step} + 1"
        f" END, {step}), lambda s: array_to_string({words}[s + 1 : s + {length}], ' ')),"
        " lambda c: trim(c) <> '')"
    )


SQL_PASSAGES = f"""words AS (
  SELECT doc_id, source, string_split(text, ' ') AS w FROM documents),
passages AS (
  SELECT doc_id, source, {sql_chunks("w", 50, 0)} AS passages FROM words)"""

SQL_TITLED = """titled AS (
  SELECT doc_id, nullif(source, 'src0') AS title, text AS content FROM documents)"""


def sql_normalize(text: str) -> str:
    marks = PUNCTUATION.replace("'", "''")
    bare = f"translate(lower({text}), '{marks}', '')"
    return (
        f"array_to_string(list_filter(string_split_regex({bare}, '\\s+'),"
        " lambda w: w NOT IN ('a', 'an', 'the', '')), ' ')"
    )


def sql_words(text: str) -> str:
    return f"list_filter(string_split({text}, ' '), lambda w: w <> '')"


def sql_hash(seed: int | str, key: str) -> str:
    """SQL for the 60-bit keyed hash; ``key`` is a string expression."""
    return f"CAST('0x' || substr(md5('{seed}:' || {key}), 1, 15) AS BIGINT)"


def sql_overlap_f(left: str, right: str) -> str:
    """SQL for the F-measure of two word lists by multiset overlap."""
    hits = (
        f"coalesce(list_sum(list_transform(list_distinct({left}),"
        f" lambda t: least(len(list_filter({left}, lambda x: x = t)),"
        f" len(list_filter({right}, lambda y: y = t))))), 0)"
    )
    # 2pr/(p+r) with p = hits/|left| and r = hits/|right|
    return (
        f"CASE WHEN {hits} = 0 THEN 0.0 ELSE"
        f" 2.0 * {hits} / (len({left}) + len({right})) END"
    )
