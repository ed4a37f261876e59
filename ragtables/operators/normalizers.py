"""Bring public question-answering layouts to ``query``, ``answers`` and passages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragtables.functions.text import normalize_text


def normalize_asqa(df: DataFrame) -> DataFrame:
    """Long answers as they are, short answers normalised per question pair."""
    long_answers = F.col("annotations.long_answer")
    short_answers = F.transform(
        "qa_pairs", lambda pair: F.transform(pair["short_answers"], normalize_text)
    )
    return df.withColumns(
        {
            "answer-long": long_answers,
            "answer-short": short_answers,
            "answers": long_answers,
            "query": F.col("ambiguous_question"),
        }
    )


def normalize_hotpot(df: DataFrame) -> DataFrame:
    """One answer; passages are titled paragraphs, as many as both lists have."""
    titles, paragraphs = F.col("context.title"), F.col("context.sentences")
    paired = F.slice(
        F.arrays_zip(titles.alias("title"), paragraphs.alias("lines")),
        F.lit(1),
        F.least(F.size(titles), F.size(paragraphs)),
    )
    passages = F.transform(
        paired,
        lambda p: F.concat(
            F.coalesce(p["title"], F.lit("None")),
            F.lit(": "),
            F.array_join(p["lines"], ""),
        ),
    )
    return df.withColumns(
        {
            "answers": F.array("answer"),
            "query": F.col("question"),
            "positive_passages": passages,
        }
    )


def normalize_arc(df: DataFrame) -> DataFrame:
    """Multiple choice: the options, and the key of the right one as a string."""
    return df.withColumns(
        {
            "query": F.col("question"),
            "options": F.col("choices.text"),
            "answers": F.col("answerKey"),
        }
    )


def normalize_pubmed(df: DataFrame) -> DataFrame:
    """Yes/no/maybe decision with its abstract sections as passages."""
    return df.withColumns(
        {
            "query": F.col("QUESTION"),
            "answers": F.array("final_decision"),
            "positive_passages": F.col("CONTEXTS"),
        }
    )
