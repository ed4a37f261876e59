"""Scoring predictions against labels.

All per-row metrics of a run share one pass and one aggregate; whole-table
metrics are small follow-up aggregates.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ragtables.functions import scores
from ragtables.functions.text import decompose, decompose_all, normalize_text
from ragtables.operators.columns import quoted, require
from ragtables.operators.sampling import shuffle_select
from ragtables.sources.storage import materialize

log = logging.getLogger(__name__)

# A per-row metric names its scores; a whole-table metric makes (metric, value) rows.
# Any function will do; ``Prepared`` is for metrics that share prepared columns.
LocalMetric = Callable[[DataFrame], Mapping[str, Column]]
GlobalMetric = Callable[[DataFrame], DataFrame]
Processor = Callable[[Column], Column]

# Fixed value: what two of the judged metrics are given for an empty answer.
NO_ANSWER = "No answer."


def align_predictions(
    data: DataFrame,
    predictions: DataFrame,
    key: str = "row_id",
    text_key: str = "text",
    generated: str = "generated",
    processor: Processor | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Add each row's prediction, by key; the processor works on it alone.

    A row without a prediction, or with more than one, fails the job, inside the
    one plan. Predictions for other rows are ignored.
    """
    require(data, [key])
    if limit is not None:
        data = shuffle_select(data, key, limit=limit)
    answer = F.col(text_key)
    if processor is not None:
        answer = processor(answer)
    answers = predictions.groupBy(quoted(key).alias("_key")).agg(
        F.struct(
            F.any_value(quoted(text_key)).alias(text_key), F.count(F.lit(1)).alias("_rows")
        ).alias("_said")
    )
    answers = answers.select("_key", "_said", quoted("_said")[text_key].alias(text_key))
    answers = answers.select("_key", "_said", answer.alias("_text"))
    joined = data.join(answers, quoted(key) == F.col("_key"), "left")

    def failure(what: str) -> Column:
        named = F.concat(F.lit(f"{what} for row "), quoted(key).cast("string"))
        return F.raise_error(named).cast("string")

    said = (
        F.when(F.col("_said").isNull(), failure("no prediction"))
        .when(F.col("_said._rows") > 1, failure("more than one prediction"))
        .otherwise(F.col("_text"))
    )
    return joined.withColumn(generated, said).drop("_key", "_said", "_text")


def references(df: DataFrame, label: str) -> Column:
    """A label as an array of accepted answers."""
    value = quoted(label)
    if isinstance(df.schema[label].dataType, T.ArrayType):
        return value
    return F.array(value)


@dataclass(frozen=True)
class Prepared:
    """A per-row metric on prepared columns.

    ``columns`` says how to make them. ``row_scores`` adds each name once, before
    any score, for all metrics that ask for it: a normalised answer is computed
    one time, however many metrics compare it.
    """

    columns: Mapping[str, Callable[[DataFrame], Column]]
    measure: LocalMetric

    def __call__(self, df: DataFrame) -> Mapping[str, Column]:
        return self.measure(df)


def _is_list(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.ArrayType)


def _normalized(column: str) -> tuple[str, Callable[[DataFrame], Column]]:
    def make(df: DataFrame) -> Column:
        if _is_list(df, column):
            return F.transform(quoted(column), normalize_text)
        return normalize_text(quoted(column))

    return f"_normalized_{column}", make


def _decomposed(column: str) -> tuple[str, Callable[[DataFrame], Column]]:
    def make(df: DataFrame) -> Column:
        if _is_list(df, column):
            return decompose_all(quoted(column))
        return decompose(quoted(column))

    return f"_decomposed_{column}", make


def _lexical(
    name: str,
    score: Callable[[Column, Column], Column],
    prepare: Callable[[str], tuple[str, Callable[[DataFrame], Column]]],
    label: str,
    generated: str,
) -> LocalMetric:
    said, wanted = prepare(generated), prepare(label)

    def measure(df: DataFrame) -> dict[str, Column]:
        return {name: score(quoted(said[0]), references(df, wanted[0]))}

    return Prepared(dict([said, wanted]), measure)


def f1(label: str, generated: str = "generated") -> LocalMetric:
    return _lexical("F1", scores.f1_normalized, _normalized, label, generated)


def exact_match(label: str, generated: str = "generated") -> LocalMetric:
    return _lexical("EM", scores.exact_match_normalized, _normalized, label, generated)


def recall_match(label: str, generated: str = "generated") -> LocalMetric:
    return _lexical("recallEM", scores.recall_match, _decomposed, label, generated)


def string_match(label: str, generated: str = "generated") -> LocalMetric:
    said = _normalized(generated)

    def measure(df: DataFrame) -> dict[str, Column]:
        found = scores.string_match_normalized(quoted(said[0]), quoted(label))
        return {"StringEM": found}

    return Prepared(dict([said]), measure)


def rouge(
    label: str, generated: str = "generated", names: Sequence[str] = scores.ROUGE
) -> LocalMetric:
    """ROUGE F-measures, each of the best reference; all in one call per batch."""
    column = f"_rouge_{label}_{'_'.join(names)}"

    def make(df: DataFrame) -> Column:
        return scores.rouge(quoted(generated), references(df, label), names)

    return Prepared(
        {column: make}, lambda df: {name: quoted(column)[name] for name in names}
    )


def embedding_similarity(
    label_vector: str, generated_vector: str, name: str = "similarity"
) -> LocalMetric:
    """Cosine of the vectors of answer and label."""
    return lambda df: {name: scores.cosine(generated_vector, label_vector)}


Scorer = Callable[..., Sequence[float]]


def _scores(
    scorer: Scorer, columns: list[list], forgiving: bool
) -> list[tuple[float, bool]]:
    """Scores of a batch, and whether each failed; an undefined one is 0. With
    ``forgiving`` a failed batch is tried again row by row, and a failed row is 0."""
    size = len(columns[0])
    try:
        made = [float(v) for v in scorer(*columns)]
        if len(made) != size:
            raise ValueError(f"{len(made)} scores for {size} rows")
        return [(0.0 if math.isnan(v) else v, False) for v in made]
    except Exception as error:
        if not forgiving:
            raise
        if size == 1:
            log.warning("scoring failed: %s", error)
            return [(0.0, True)]
        rows = zip(*columns)
        return [_scores(scorer, [[v] for v in row], True)[0] for row in rows]


def scored_metric(
    name: str,
    make_scorer: Callable[[], Scorer],
    inputs: Sequence[Callable[[DataFrame], Column]],
    best_over: int | None = None,
    batch_size: int = 64,
    forgiving: bool = False,
) -> LocalMetric:
    """A metric computed by a user-supplied model.

    An exception of the scorer ends the run; with ``forgiving`` the row scores 0, and
    ``{name}_failed`` tells the share of such rows.

    The scorer gets one list per input. ``best_over`` is the position of an input
    that is an array of references: each is scored on its own, and the best counts.
    Pairs are flattened and regrouped inside a batch, so no shuffle is needed.
    ``make_scorer`` runs once per task.
    """

    @F.pandas_udf("score double, failed double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for batch in batches:
            columns = [list(s) for s in (batch if isinstance(batch, tuple) else (batch,))]
            sizes = None
            if best_over is not None:
                lists = [[] if v is None else list(v) for v in columns[best_over]]
                sizes = [len(v) for v in lists]
                columns = [
                    [v for vs in lists for v in vs]
                    if position == best_over
                    else [v for v, n in zip(column, sizes) for _ in range(n)]
                    for position, column in enumerate(columns)
                ]
            made: list[tuple[float, bool]] = []
            for start in range(0, len(columns[0]), batch_size):
                part = [c[start : start + batch_size] for c in columns]
                made.extend(_scores(scorer, part, forgiving))
            if sizes is not None:
                ends = iter(made)
                groups = [[next(ends) for _ in range(n)] for n in sizes]
                made = [
                    (max([v for v, _ in g], default=0.0), any(f for _, f in g))
                    for g in groups
                ]
            yield pd.DataFrame(made, columns=["score", "failed"]).astype("float64")

    score = score.asNondeterministic()
    column = f"_scored_{name}"

    def measure(df: DataFrame) -> Mapping[str, Column]:
        found = {name: F.col(f"`{column}`.score")}
        if forgiving:
            found[f"{name}_failed"] = F.col(f"`{column}`.failed")
        return found

    return Prepared({column: lambda df: score(*[get(df) for get in inputs])}, measure)


def _pair_metric(
    name: str, make_scorer: Callable[[], Scorer], label: str, generated: str
) -> LocalMetric:
    inputs = [lambda df: quoted(generated), lambda df: references(df, label)]
    return scored_metric(name, make_scorer, inputs, best_over=1)


def bert_score(
    make_scorer: Callable[[], Scorer], label: str, generated: str = "generated"
) -> LocalMetric:
    """A similarity model's F1 on (prediction, reference)."""
    return _pair_metric("BERTScore-F1", make_scorer, label, generated)


def semantic(
    make_scorer: Callable[[], Scorer], label: str, generated: str = "generated"
) -> LocalMetric:
    """A cross-encoder's score on (prediction, reference)."""
    return _pair_metric("Semantic", make_scorer, label, generated)


def _answer_or_none(generated: str) -> Callable[[DataFrame], Column]:
    said = quoted(generated)
    empty = said.isNull() | (said == "")
    return lambda df: F.when(empty, NO_ANSWER).otherwise(said)


def _judged(
    name: str,
    make_judge: Callable[[], Scorer],
    query: str,
    context: str,
    generated: str,
) -> LocalMetric:
    inputs = [
        lambda df: quoted(query),
        _answer_or_none(generated),
        lambda df: references(df, context),
    ]
    return scored_metric(name, make_judge, inputs, forgiving=True)


def faithfulness(
    make_judge: Callable[[], Scorer],
    query: str = "query",
    context: str = "context",
    generated: str = "generated",
) -> LocalMetric:
    """A judge on (query, answer, context passages)."""
    return _judged("faithfulness", make_judge, query, context, generated)


def relevancy(
    make_judge: Callable[[], Scorer],
    query: str = "query",
    context: str = "context",
    generated: str = "generated",
) -> LocalMetric:
    """A judge of how well the answer fits the question: (query, answer, context)."""
    return _judged("relevancy", make_judge, query, context, generated)


def hallucination(
    make_judge: Callable[[], Scorer],
    context: str = "context",
    generated: str = "generated",
) -> LocalMetric:
    """A judge on (answer, context passages)."""
    inputs = [lambda df: quoted(generated), lambda df: references(df, context)]
    return scored_metric("hallucination", make_judge, inputs, forgiving=True)


def classification(
    label: str,
    mapping: Mapping[str, int],
    else_value: int = 2,
    generated: str = "generated",
) -> GlobalMetric:
    """Accuracy and macro precision, recall and F1 of the answer's class.

    The classes are those seen in targets or predictions. The table shrinks to its
    class pairs in one aggregate; the rest works on at most classes squared rows.
    """

    def measure(df: DataFrame) -> DataFrame:
        target = quoted(label)
        if isinstance(df.schema[label].dataType, T.ArrayType):
            target = F.get(target, 0)
        pairs = (
            df.select(
                normalize_text(target).alias("target"),
                normalize_text(quoted(generated)).alias("said"),
            )
            .select(
                scores.label_class("target", dict(mapping), else_value).alias("target"),
                scores.yes_no_class("said").alias("said"),
            )
            .groupBy("target", "said")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        # Each pair counts for its target class and, if another, for the said one.
        sides = F.array_distinct(F.array("target", "said"))
        classes = (
            pairs.withColumn("class", F.explode(sides))
            .groupBy("class")
            .agg(
                F.sum(F.when(F.col("target") == F.col("class"), F.col("n"))).alias("a"),
                F.sum(F.when(F.col("said") == F.col("class"), F.col("n"))).alias("b"),
                F.sum(
                    F.when(F.col("target") == F.col("said"), F.col("n"))
                ).alias("c"),
            )
            .select(*[F.coalesce(c, F.lit(0)).alias(c) for c in "abc"])
        )
        wanted, said, right = F.col("a"), F.col("b"), F.col("c")

        def ratio(over: Column, under: Column) -> Column:
            return F.avg(F.when(under > 0, over / under).otherwise(F.lit(0.0)))

        made = classes.agg(
            (F.sum(right) / F.sum(wanted)).alias("accuracy"),
            ratio(right, said).alias("precision"),
            ratio(right, wanted).alias("recall"),
            ratio(2 * right, said + wanted).alias("f1"),
        )
        return unpivot(made)

    return measure


def unpivot(row: DataFrame) -> DataFrame:
    """One row of named values as ``(metric, value)`` rows."""
    pairs = [
        F.struct(F.lit(n).alias("metric"), quoted(n).cast("double").alias("value"))
        for n in row.columns
    ]
    return row.select(F.inline(F.array(*pairs)))


def row_scores(df: DataFrame, metrics: Sequence[LocalMetric]) -> tuple[DataFrame, list[str]]:
    """Add all scores as columns, each name once."""
    columns: dict[str, Column] = {}
    taken = set(df.columns)
    shared = {
        name: make
        for metric in metrics
        if isinstance(metric, Prepared)
        for name, make in metric.columns.items()
    }
    df = df.withColumns({name: make(df) for name, make in shared.items()})
    for metric in metrics:
        for name, column in metric(df).items():
            if name in columns:
                raise ValueError(f"two metrics are called {name!r}")
            columns[name] = column
    if taken & set(columns):
        raise ValueError(f"scores would replace columns {sorted(taken & set(columns))}")
    scored = df.withColumns(columns).drop(*shared)
    return scored, list(columns)


def local_means(df: DataFrame, metrics: Sequence[LocalMetric]) -> DataFrame:
    """Mean of every per-row score over all rows: ``(metric, value)``."""
    scored, names = row_scores(df, metrics)
    rows = F.count(F.lit(1))
    total = scored.agg(
        *[(F.sum(quoted(n).cast("double")) / rows).alias(n) for n in names]
    )
    return unpivot(total)


def evaluate(
    aligned: DataFrame,
    local: Sequence[LocalMetric] = (),
    whole: Sequence[GlobalMetric] = (),
) -> DataFrame:
    """All metrics of a run as ``(scope, metric, value)`` rows.

    With whole-table metrics the aligned rows are stored once and read by each pass,
    so that neither the answers nor a model call behind them are computed again.
    """
    if whole and len(whole) + bool(local) > 1:
        aligned = materialize(aligned)
    parts = [("local", local_means(aligned, local))] if local else []
    parts += [("global", metric(aligned)) for metric in whole]
    if not parts:
        raise ValueError("no metrics")
    tables = [
        df.select(F.lit(scope).alias("scope"), "metric", "value") for scope, df in parts
    ]
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result
