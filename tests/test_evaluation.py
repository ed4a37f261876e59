import random

import pytest
from pyspark.sql import functions as F

from ragtables.functions.text import normalize_text, regex_answer
from ragtables.operators import evaluation


@pytest.fixture(scope="module")
def aligned(spark):
    return spark.createDataFrame(
        [
            (1, "The answer is Rome.", ["Rome", "answer is rome"], [["rome"], ["x"]], "q", "c"),
            (2, "", [], [], "q", "c"),
            (3, "know", ["no"], [["no"]], "q", "c"),
        ],
        "row_id int, generated string, answers array<string>,"
        "groups array<array<string>>, query string, context string",
    )


def values(df):
    return {r.metric: r.value for r in df.collect()}


def test_alignment_by_key(spark):
    data = spark.createDataFrame([(i, f"a{i}") for i in range(5)], "row_id int, answer string")
    said = spark.createDataFrame(
        [(i, f"so <A>: {i}, x") for i in reversed(range(9))], "row_id int, text string"
    )
    df = evaluation.align_predictions(data, said, processor=regex_answer("<A>: (.*)", ","))
    assert {r.row_id: r.generated for r in df.collect()} == {i: str(i) for i in range(5)}
    assert df.columns == ["row_id", "answer", "generated"]
    df = evaluation.align_predictions(data, said, limit=2)
    assert sorted(r.row_id for r in df.collect()) == [0, 1]


def test_a_missing_prediction_is_an_error(spark):
    data = spark.createDataFrame([(i,) for i in range(5)], "row_id int")
    said = spark.createDataFrame([(i, None) for i in range(4)], "row_id int, text string")
    df = evaluation.align_predictions(data, said)
    with pytest.raises(Exception, match="no prediction for row 4"):
        df.collect()
    rows = evaluation.align_predictions(data.filter("row_id < 4"), said).collect()
    assert [r.generated for r in rows] == [None] * 4


def test_all_lexical_metrics_share_one_pass(aligned):
    metrics = [
        evaluation.f1("answers"),
        evaluation.exact_match("answers"),
        evaluation.string_match("groups"),
        evaluation.recall_match("answers"),
        evaluation.rouge("answers"),
    ]
    df = evaluation.evaluate(aligned, metrics)
    found = values(df)
    assert found["EM"] == pytest.approx(1 / 3)
    assert found["F1"] == pytest.approx(1 / 3)
    assert found["StringEM"] == pytest.approx((0.5 + 0 + 1) / 3)
    assert found["recallEM"] == pytest.approx(1 / 3)
    assert set(found) == {"EM", "F1", "StringEM", "recallEM", "rouge1", "rouge2", "rougeL", "rougeLsum"}
    assert all(0 <= v <= 1 for v in found.values())
    # One scan; the answer is cleaned once for all that compare it normalised,
    # and once, in its own way, for ROUGE.
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1
    assert plan.count("regexp_replace(lower(generated#") == 1


def test_string_label(aligned):
    df = aligned.withColumn("label", F.lit("rome"))
    found = values(evaluation.local_means(df, [evaluation.f1("label"), evaluation.rouge("label")]))
    assert found["F1"] == pytest.approx((2 * (1 / 3) / (1 / 3 + 1)) / 3)


def test_scores_need_names_of_their_own(aligned):
    with pytest.raises(ValueError):
        evaluation.row_scores(aligned, [evaluation.f1("answers")] * 2)
    with pytest.raises(ValueError):
        evaluation.row_scores(aligned, [lambda df: {"query": F.lit(1)}])
    with pytest.raises(ValueError):
        evaluation.evaluate(aligned)


def test_user_metrics(aligned):
    df = evaluation.evaluate(
        aligned,
        [lambda df: {"length": F.length("generated")}],
        [lambda df: df.agg(F.lit("rows").alias("metric"), F.count("*").alias("value"))],
    )
    assert sorted(tuple(r) for r in df.collect()) == [
        ("global", "rows", 3.0),
        ("local", "length", pytest.approx(23 / 3)),
    ]


def test_an_empty_table_has_null_means(aligned):
    found = values(evaluation.local_means(aligned.limit(0), [evaluation.f1("answers")]))
    assert found == {"F1": None}


def plain_classes(targets, said):
    classes, rows = sorted(set(targets) | set(said)), []
    for c in classes:
        tp = sum(t == s == c for t, s in zip(targets, said))
        t, s = targets.count(c), said.count(c)
        rows.append((tp / s if s else 0, tp / t if t else 0, 2 * tp / (t + s)))
    means = [sum(r[i] for r in rows) / len(rows) for i in range(3)]
    return [sum(t == s for t, s in zip(targets, said)) / len(targets), *means]


@pytest.mark.parametrize("seed", range(3))
def test_classification(spark, seed):
    rng = random.Random(seed)
    labels = ["Yes", "the no!", "maybe", "other", None]
    texts = ["Yes.", "I know", "eyes", "No!", "unclear", ""]
    rows = [(rng.choice(labels), rng.choice(texts)) for _ in range(rng.choice([1, 5, 200]))]
    df = spark.createDataFrame(rows, "label string, generated string")
    targets = [{"Yes": 1, "the no!": 0, "maybe": 5}.get(t, 2) for t, _ in rows]
    classes = {"Yes.": 1, "I know": 0, "eyes": 1, "No!": 0}
    wanted = plain_classes(targets, [classes.get(s, 2) for _, s in rows])
    mapping = {"yes": 1, "no": 0, "maybe": 5}
    for frame, label in ((df, "label"), (df.withColumn("list", F.array("label")), "list")):
        found = values(evaluation.classification(label, mapping)(frame))
        assert [found[n] for n in ("accuracy", "precision", "recall", "f1")] == pytest.approx(wanted)


def test_scored_metrics(aligned):
    def scorer():
        def score(said, wanted):
            return [float("nan") if w == "Rome" else len(w) / 100 for s, w in zip(said, wanted)]

        return score

    def failing(said, contexts):
        if any(x == "" for x in said):
            raise RuntimeError("no answer")
        return [len(x) for x in said]

    def judge():
        return lambda q, a, c: [len(x) if isinstance(y, str) else len(y) for x, y in zip(a, c)]

    scored, names = evaluation.row_scores(
        aligned,
        [
            evaluation.bert_score(scorer, "answers"),
            evaluation.semantic(scorer, "answers"),
            evaluation.faithfulness(lambda: lambda q, a, c: [len(x) for x in a]),
            evaluation.relevancy(judge),
            evaluation.hallucination(lambda: failing),
        ],
    )
    rows = [r.asDict() for r in scored.orderBy("row_id").collect()]
    judged = ["faithfulness", "relevancy", "hallucination"]
    assert names == ["BERTScore-F1", "Semantic", *[n + e for n in judged for e in ("", "_failed")]]
    assert [r["BERTScore-F1"] for r in rows] == [0.14, 0.0, 0.02]
    assert [r["Semantic"] for r in rows] == [0.14, 0.0, 0.02]
    assert [r["faithfulness"] for r in rows] == [19.0, len("No answer."), 4.0]
    assert [r["relevancy"] for r in rows] == [1.0, 1.0, 1.0]
    assert [r["hallucination"] for r in rows] == [19.0, 0.0, 4.0]
    assert [r["hallucination_failed"] for r in rows] == [0.0, 1.0, 0.0]


def test_a_similarity_model_that_fails_ends_the_run(aligned):
    def scorer():
        def score(said, wanted):
            raise RuntimeError("model is gone")

        return score

    with pytest.raises(Exception, match="model is gone"):
        evaluation.local_means(aligned, [evaluation.bert_score(scorer, "answers")]).collect()


def test_two_predictions_for_a_row_are_an_error(spark):
    data = spark.createDataFrame([(1, "a"), (2, "b")], "row_id long, answers string")
    said = [(1, "a"), (1, "x"), (2, "b")]
    table = spark.createDataFrame(said, "row_id long, text string")
    with pytest.raises(Exception, match="more than one prediction for row 1"):
        evaluation.align_predictions(data, table).collect()


def test_whole_metrics_read_the_answers_once(spark):
    """A prediction that is drawn anew each time would differ between the metrics."""
    data = spark.range(50).select(F.col("id").alias("row_id"))
    said = data.select("row_id", F.expr("uuid()").alias("text"))
    aligned = evaluation.align_predictions(data, said)

    def least(df):
        return df.agg(F.min("generated").alias("v")).select(
            F.lit("m").alias("metric"), F.conv(F.substring("v", 1, 8), 16, 10).cast("double").alias("value")
        )

    found = evaluation.evaluate(aligned, whole=[least, least]).collect()
    assert found[0].value == found[1].value

def test_similarity(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.6, 0.8])], "a array<double>, b array<double>")
    found = values(evaluation.local_means(df, [evaluation.embedding_similarity("a", "b")]))
    assert found == {"similarity": pytest.approx(0.6)}


def test_normalised_columns_do_not_stay(aligned):
    scored, _ = evaluation.row_scores(aligned, [evaluation.exact_match("answers")])
    assert scored.columns == [*aligned.columns, "EM"]
    assert scored.select(normalize_text("generated")).first()[0] == "answer is rome"
