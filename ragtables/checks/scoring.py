"""Checked queries: answer processing and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ragtables.checks.base import (
    SQL_PRED,
    SQL_QA,
    check,
    predictions,
    qa,
    sql_normalize,
    sql_overlap_f,
    sql_words,
    table,
)
from ragtables.functions.text import normalize_text, regex_answer
from ragtables.operators import evaluation
from ragtables.sources import storage
from ragtables.sources.tables import read_results, write_results


def _aligned(spark: SparkSession, folder: str) -> DataFrame:
    """Questions with two accepted answers, answer groups and a prediction."""
    rows = qa(spark, folder)
    data = rows.withColumns(
        {
            "answers": F.array("answer", "query"),
            "groups": F.array(
                F.array(normalize_text("answer"), F.col("answer")),
                F.array(normalize_text("query")),
                F.array(F.element_at(F.split(F.col("query"), " "), -1)),
            ),
        }
    )
    return evaluation.align_predictions(data, predictions(rows))


def _round(results: DataFrame) -> DataFrame:
    return results.withColumn("value", F.round("value", 6))


def _scores(df: DataFrame, *metrics: evaluation.LocalMetric) -> DataFrame:
    scored, names = evaluation.row_scores(df, metrics)
    return scored.select(
        "row_id", *[F.round(F.col(n).cast("double"), 6).alias(n) for n in names]
    )


def _sql_scores(ctes: str, expressions: dict[str, str]) -> str:
    columns = ", ".join(f"round(CAST({e} AS DOUBLE), 6) AS {n}" for n, e in expressions.items())
    return f"WITH {SQL_QA}, {SQL_PRED}, {ctes} SELECT row_id, {columns} FROM prepared"


def _sql_means(ctes: str, expressions: dict[str, str]) -> str:
    """SQL for the means as ``(scope, metric, value)`` rows."""
    columns = ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in expressions.items())
    parts = " UNION ALL ".join(
        f"SELECT 'local' AS scope, '{n}' AS metric, round(avg({n}), 6) AS value FROM scored"
        for n in expressions
    )
    return (
        f"WITH {SQL_QA}, {SQL_PRED}, {ctes},"
        f" scored AS (SELECT {columns} FROM prepared) {parts}"
    )


_LEXICAL = f"""norms AS (
  SELECT *, {sql_normalize("text")} AS p, {sql_normalize("answer")} AS a,
         {sql_normalize("query")} AS q FROM pred),
prepared AS (
  SELECT *, {sql_words("p")} AS pw, {sql_words("a")} AS aw, {sql_words("q")} AS qw
  FROM norms)"""

_EM_F1 = {
    "F1": f"greatest({sql_overlap_f('pw', 'aw')}, {sql_overlap_f('pw', 'qw')})",
    "EM": "CASE WHEN p IN (a, q) THEN 1.0 ELSE 0.0 END",
}


@check(_sql_scores(_LEXICAL, _EM_F1))
def score_em_f1(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(
        _aligned(spark, folder),
        evaluation.f1("answers"),
        evaluation.exact_match("answers"),
    )


@check(_sql_means(_LEXICAL, _EM_F1))
def eval_em_f1(spark: SparkSession, folder: str) -> DataFrame:
    metrics = [evaluation.f1("answers"), evaluation.exact_match("answers")]
    return _round(evaluation.evaluate(_aligned(spark, folder), metrics))


_STRING_EM = {
    "StringEM": """(CASE WHEN contains(p, a) OR contains(p, answer) THEN 1 ELSE 0 END
      + CASE WHEN contains(p, q) THEN 1 ELSE 0 END
      + CASE WHEN contains(p, string_split(query, ' ')[-1]) THEN 1 ELSE 0 END) / 3.0"""
}


@check(_sql_scores(_LEXICAL, _STRING_EM))
def score_string_em(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(_aligned(spark, folder), evaluation.string_match("groups"))


@check(_sql_means(_LEXICAL, _STRING_EM))
def eval_string_em(spark: SparkSession, folder: str) -> DataFrame:
    metrics = [evaluation.string_match("groups")]
    return _round(evaluation.evaluate(_aligned(spark, folder), metrics))


def _sql_tokens(text: str) -> str:
    """SQL for the recall tokens of a text, joined and padded by blanks."""
    return (
        f"' ' || array_to_string(list_transform(regexp_extract_all({text},"
        " '[\\p{L}\\p{N}\\p{M}]+|[^\\p{Z}\\p{C}]'), lambda t: lower(t)), ' ') || ' '"
    )


# The given texts are composed (NFC); their tokens match alike with and without
# decomposing them.
_TOKENS = f"""prepared AS (
  SELECT row_id, {_sql_tokens("text")} AS p, {_sql_tokens("answer")} AS a,
         {_sql_tokens("query")} AS q FROM pred)"""

_RECALL = {
    "recallEM": """CASE WHEN a = '  ' OR q = '  ' OR contains(p, a) OR contains(p, q)
      THEN 1.0 ELSE 0.0 END"""
}


@check(_sql_scores(_TOKENS, _RECALL))
def score_recall_em(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(_aligned(spark, folder), evaluation.recall_match("answers"))


@check(_sql_means(_TOKENS, _RECALL))
def eval_recall_em(spark: SparkSession, folder: str) -> DataFrame:
    metrics = [evaluation.recall_match("answers")]
    return _round(evaluation.evaluate(_aligned(spark, folder), metrics))


def _sql_rouge_words(text: str) -> str:
    return (
        f"list_filter(string_split(regexp_replace(lower({text}), '[^a-z0-9]+', ' ', 'g'),"
        " ' '), lambda w: w <> '')"
    )


def _sql_bigrams(words: str) -> str:
    return (
        f"list_transform(range(1, len({words})),"
        f" lambda i: {words}[i] || ' ' || {words}[i + 1])"
    )


_ROUGE = f"""grams AS (
  SELECT row_id, {_sql_rouge_words("text")} AS p1, {_sql_rouge_words("answer")} AS a1,
         {_sql_rouge_words("query")} AS q1 FROM pred),
prepared AS (
  SELECT *, {_sql_bigrams("p1")} AS p2, {_sql_bigrams("a1")} AS a2,
         {_sql_bigrams("q1")} AS q2 FROM grams)"""

_ROUGE12 = {
    f"rouge{n}": f"greatest({sql_overlap_f(f'p{n}', f'a{n}')}, {sql_overlap_f(f'p{n}', f'q{n}')})"
    for n in (1, 2)
}


@check(_sql_scores(_ROUGE, _ROUGE12))
def score_rouge12(spark: SparkSession, folder: str) -> DataFrame:
    metric = evaluation.rouge("answers", names=["rouge1", "rouge2"])
    return _scores(_aligned(spark, folder), metric)


@check(_sql_means(_ROUGE, _ROUGE12))
def eval_rouge12(spark: SparkSession, folder: str) -> DataFrame:
    metric = evaluation.rouge("answers", names=["rouge1", "rouge2"])
    return _round(evaluation.evaluate(_aligned(spark, folder), [metric]))


def _sql_common(left: str, right: str) -> str:
    """SQL for the longest common subsequence of two word lists.

    It is the longest rising run of right positions over all matches, ordered by
    left position and, within it, by falling right position. The state holds the
    least end of a run of each length.
    """
    matches = (
        f"flatten(list_transform({left}, lambda w: list_transform(list_filter("
        f"range(len({right}), 0, -1), lambda j: {right}[j] = w), lambda j: [j])))"
    )
    return (
        f"len(list_reduce({matches}, lambda ends, j:"
        " list_concat(list_filter(ends, lambda e: e < j[1]), j,"
        " list_filter(ends, lambda e: e >= j[1])[2:]), CAST([] AS BIGINT[])))"
    )


def _sql_common_f(left: str, right: str) -> str:
    return f"coalesce(2.0 * {_sql_common(left, right)} / (len({left}) + len({right})), 0)"


@check(
    _sql_scores(
        _ROUGE,
        {"rougeL": f"greatest({_sql_common_f('p1', 'a1')}, {_sql_common_f('p1', 'q1')})"},
    )
)
def score_rouge_l(spark: SparkSession, folder: str) -> DataFrame:
    metric = evaluation.rouge("answers", names=["rougeL"])
    return _scores(_aligned(spark, folder), metric)


@check()
def eval_rouge_l(spark: SparkSession, folder: str) -> DataFrame:
    """With ROUGE-Lsum, the union over lines, which has no short form in SQL."""
    metric = evaluation.rouge("answers", names=["rougeL", "rougeLsum"])
    return _round(evaluation.evaluate(_aligned(spark, folder), [metric]))


@check(
    f"""WITH {SQL_QA}, marked AS (
          SELECT row_id, 'Some steps.' || chr(10) || CASE WHEN length(answer) > 500
                   THEN '<ANSWER>: ' ELSE '' END || answer AS text FROM qa),
        found AS (
          SELECT row_id, CASE WHEN regexp_matches(text, '<ANSWER>: ((?s).*)')
                   THEN regexp_extract(text, '<ANSWER>: ((?s).*)', 1) ELSE text END AS text
          FROM marked)
        SELECT row_id, string_split_regex(text, '[,.;]')[1] AS answer FROM found"""
)
def regex_answers(spark: SparkSession, folder: str) -> DataFrame:
    mark = F.when(F.length("answer") > 500, "<ANSWER>: ").otherwise("")
    text = F.concat(F.lit("Some steps.\n"), mark, F.col("answer"))
    return qa(spark, folder).select(
        "row_id", regex_answer("<ANSWER>: (.*)", "[,.;]")(text).alias("answer")
    )


@check(
    """WITH rows_ AS (
         SELECT CASE WHEN l.toxic = 1 THEN 2 WHEN l.quality = 1 THEN 1 ELSE 0 END AS target,
                CASE WHEN d.n_chars > 1500 THEN 1 WHEN d.n_chars > 500 THEN 0 ELSE 2 END AS said
         FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
       classes AS (
         SELECT c, sum(CASE WHEN target = c AND said = c THEN 1.0 ELSE 0 END) AS tp,
                sum(CASE WHEN target = c THEN 1.0 ELSE 0 END) AS t,
                sum(CASE WHEN said = c THEN 1.0 ELSE 0 END) AS s
         FROM rows_, range(3) AS r(c) GROUP BY c),
       seen AS (SELECT * FROM classes WHERE t + s > 0)
       SELECT 'global' AS scope, 'accuracy' AS metric, round(sum(tp) / sum(t), 6) AS value
       FROM seen
       UNION ALL SELECT 'global', 'precision',
         round(avg(CASE WHEN s > 0 THEN tp / s ELSE 0 END), 6) FROM seen
       UNION ALL SELECT 'global', 'recall',
         round(avg(CASE WHEN t > 0 THEN tp / t ELSE 0 END), 6) FROM seen
       UNION ALL SELECT 'global', 'f1', round(avg(2 * tp / (t + s)), 6) FROM seen"""
)
def eval_classification(spark: SparkSession, folder: str) -> DataFrame:
    label = (
        F.when(F.col("toxic") == 1, "It depends")
        .when(F.col("quality") == 1, "Yes!")
        .otherwise("the No")
    )
    said = (
        F.when(F.col("n_chars") > 1500, "Yes, it is.")
        .when(F.col("n_chars") > 500, "I know.")
        .otherwise("Unclear")
    )
    rows = (
        table(spark, folder, "labels")
        .join(table(spark, folder, "documents").select("doc_id", "n_chars"), "doc_id")
        .select(F.array(label).alias("answers"), said.alias("generated"))
    )
    metric = evaluation.classification("answers", {"yes": 1, "no": 0})
    return _round(evaluation.evaluate(rows, whole=[metric]))


@check(
    """SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[],
         b.embedding::DOUBLE[]), 6) AS similarity
       FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"""
)
def embedding_similarity(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector against the next one."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    following = vectors.select(
        (F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("label")
    )
    metric = evaluation.embedding_similarity("label", "embedding")
    scored, _ = evaluation.row_scores(vectors.join(following, "vec_id"), [metric])
    return scored.select("vec_id", F.round("similarity", 6).alias("similarity"))


def _ratio(df: DataFrame) -> dict[str, Column]:
    """A row metric of a user's own."""
    return {"ratio": F.length("generated") / F.length("answer")}


def longest(df: DataFrame) -> DataFrame:
    """A whole-table metric of a user's own."""
    return df.agg(F.max(F.length("generated")).cast("double").alias("value")).select(
        F.lit("longest").alias("metric"), "value"
    )


@check(
    f"""WITH {SQL_QA}, {SQL_PRED}, few AS (
          SELECT row_id, replace(lower(text), 'e', 'ee') AS said, answer FROM pred
          ORDER BY row_id LIMIT 60)
        SELECT 'local' AS scope, 'ratio' AS metric,
               round(avg(length(said) / length(answer)), 6) AS value FROM few
        UNION ALL
        SELECT 'global', 'longest', CAST(max(length(said)) AS DOUBLE) FROM few"""
)
def eval_own_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """A limit, an answer processor, and metrics of the user's own."""
    rows = qa(spark, folder)
    aligned = evaluation.align_predictions(
        rows,
        predictions(rows),
        processor=lambda said: F.replace(F.lower(said), F.lit("e"), F.lit("ee")),
        limit=60,
    )
    return _round(evaluation.evaluate(aligned, [_ratio], [longest]))


@check(
    f"""WITH {SQL_QA}, {SQL_PRED}, said AS (
          SELECT replace(lower(text), 'e', 'ee') AS said, answer FROM pred)
        SELECT 'local' AS scope, 'ratio' AS metric,
               round(avg(length(said) / length(answer)), 6) AS value FROM said
        UNION ALL
        SELECT 'global', 'longest', CAST(max(length(said)) AS DOUBLE) FROM said"""
)
def eval_own_metrics_whole(spark: SparkSession, folder: str) -> DataFrame:
    """An answer processor and metrics of the user's own, over all rows."""
    rows = qa(spark, folder)
    aligned = evaluation.align_predictions(
        rows,
        predictions(rows),
        processor=lambda said: F.replace(F.lower(said), F.lit("e"), F.lit("ee")),
    )
    return _round(evaluation.evaluate(aligned, [_ratio], [longest]))


def length_scorer():
    """Stand-in for a similarity model: the ratio of the text lengths."""

    def score(said: list[str], wanted: list[str]) -> list[float]:
        return [min(len(a), len(b)) / max(len(a), len(b)) for a, b in zip(said, wanted)]

    return score


def context_judge():
    """Stand-in for a judge of (question, answer, contexts)."""

    def score(queries: list, answers: list, contexts: list) -> list[float]:
        return [
            sum(len(c) > len(a) for c in cs) / len(cs) if len(q) > 60 else float("nan")
            for q, a, cs in zip(queries, answers, contexts)
        ]

    return score


def answer_judge():
    """Stand-in for a judge of (answer, contexts) that fails on some rows."""

    def score(answers: list, contexts: list) -> list[float]:
        if any(len(a) > 1000 for a in answers):
            raise RuntimeError("too long")
        return [1 / (1 + len(a) + len(cs)) for a, cs in zip(answers, contexts)]

    return score


_RATIO = "least(length(text), length({0})) / CAST(greatest(length(text), length({0})) AS DOUBLE)"
_BEST = f"greatest({_RATIO.format('answer')}, {_RATIO.format('query')})"
_JUDGE = """CASE WHEN length(query) <= 60 THEN 0.0 ELSE
  (CASE WHEN length(answer) > length({0}) THEN 1 ELSE 0 END
   + CASE WHEN length(query) > length({0}) THEN 1 ELSE 0 END) / 2.0 END"""
_SAID = "coalesce(nullif(said, ''), 'No answer.')"


@check(
    _sql_scores(
        """prepared AS (SELECT *, CASE WHEN length(answer) < 2 * length(query) THEN ''
             ELSE text END AS said FROM pred)""",
        {
            '"BERTScore-F1"': _BEST,
            "Semantic": _BEST,
            "faithfulness": _JUDGE.format(_SAID),
            "relevancy": _JUDGE.format(_SAID),
            "hallucination": "CASE WHEN length(said) > 1000 THEN 0.0 ELSE"
            " 1.0 / (3 + length(said)) END",
            "faithfulness_failed": "0",
            "relevancy_failed": "0",
            "hallucination_failed": "CASE WHEN length(said) > 1000 THEN 1 ELSE 0 END",
        },
    )
)
def score_with_models(spark: SparkSession, folder: str) -> DataFrame:
    """The model-based metrics around stand-in models: best reference, empty
    answers, undefined scores and failing calls."""
    rows = _aligned(spark, folder).withColumns(
        {
            "said": F.when(
                F.length("answer") < 2 * F.length("query"), F.lit("")
            ).otherwise(F.col("generated")),
            "context": F.col("answers"),
        }
    )
    return _scores(
        rows,
        evaluation.bert_score(length_scorer, "answers"),
        evaluation.semantic(length_scorer, "answers"),
        evaluation.faithfulness(context_judge, generated="said"),
        evaluation.relevancy(context_judge, generated="said"),
        evaluation.hallucination(answer_judge, generated="said"),
    )


@check(_sql_means(_LEXICAL, _EM_F1))
def results_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Results written to the shared folder and read back."""
    metrics = [evaluation.f1("answers"), evaluation.exact_match("answers")]
    path = storage.fresh_path(spark, "results")
    write_results(evaluation.evaluate(_aligned(spark, folder), metrics), path)
    return _round(read_results(spark, path))
