import pytest
from pyspark.sql import functions as F

from ragtables.functions import templates
from ragtables.operators import prompts


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(
        [(1, "q1", None, True, ["a1", "a2"]), (2, "q2", "c2", None, []), (3, "q3", "", False, None)],
        "id int, query string, context string, flag boolean, answers array<string>",
    )


def made(df, column):
    return [r[0] for r in df.orderBy("id").select(column).collect()]


def test_text_prompt(frame):
    df = prompts.text_prompt(
        frame,
        "{{x}} {a}|{b}|{c}|{d}|{e}",
        {"a": "query", "b": "context", "c": "flag", "d": "id", "e": "missing", "f": "x"},
    )
    assert made(df, "prompt") == [
        "{x} q1|None|True|1|",
        "{x} q2|c2|None|2|",
        "{x} q3||False|3|",
    ]


def test_text_prompt_errors(frame):
    with pytest.raises(KeyError):
        prompts.text_prompt(frame, "{a}", {})
    with pytest.raises(TypeError):
        prompts.text_prompt(frame, "{a}", {"a": "answers"})
    for template in ("{a.b}", "{a[0]}", "{a:>5}", "{a!r}", "{}"):
        with pytest.raises(ValueError):
            prompts.text_prompt(frame, template, {"a": "query"})
    assert made(prompts.text_prompt(frame, "", {}), "prompt") == ["", "", ""]


def test_fewshot_prompt(spark):
    df = spark.createDataFrame(
        [(1, [("q1", None), ("q2", "a2")]), (2, [])],
        "id int, shots array<struct<query:string,answer:string>>",
    )
    df = prompts.fewshot_prompt(
        df, "Q{q} A{a}{z}", "shots", {"q": "query", "a": "answer", "z": "missing"}, "shots"
    )
    assert made(df, "shots") == ["Qq1 ANone\n\nQq2 Aa2", ""]


def test_training_messages(frame):
    df = prompts.training_messages(frame, "query", "answers", "Be kind.")
    rows = [[tuple(m) for m in ms] for ms in made(df, "messages")]
    assert rows[0] == [("system", "Be kind."), ("user", "q1"), ("assistant", "a1")]
    assert [r[2][1] for r in rows] == ["a1", "", ""]
    df = prompts.training_messages(frame, "query", "context", "Be kind.", True)
    rows = made(df, "messages")
    assert rows[0][1].content == "Be kind.\nq1"
    assert [r[2].content for r in rows] == ["", "c2", ""]


def test_templates_for_training_and_inference(frame):
    df = prompts.training_text(frame, "{query}->{output}", "query", "answers", "I", True)
    assert made(df, "text") == ["I\nq1->a1", "I\nq2->", "I\nq3->"]
    df = prompts.inference_text(frame, "{instruction}/{query}", "I", "query", "p")
    assert made(df, "p") == ["I/q1", "I/q2", "I/q3"]


def test_inference_messages(frame):
    rows = made(prompts.inference_messages(frame, "query"), "messages")
    assert rows[0][0].content == prompts.DEFAULT_INSTRUCTION
    rows = made(prompts.inference_messages(frame, "query", "I", True), "messages")
    assert [tuple(m) for m in rows[0]] == [("system", "I"), ("user", "I\nq1")]


def test_every_template_has_its_placeholders():
    wanted = {
        "QA": {"question", "context"},
        "QA_SHORT": {"query"},
        "QA_WITH_ANSWER": {"question", "context", "answer"},
        "QA_FEWSHOT": {"question", "context", "fewshot"},
        "COT": {"question", "context"},
        "COT_FEWSHOT": {"question", "context", "fewshot"},
        "FACT_STATEMENT": {"i", "content"},
        "REASON_BEFORE_ANSWER": {"reasoning"},
    }
    for name, names in wanted.items():
        parts = templates.split_template(getattr(templates, name))
        assert {p for _, p in parts if p} == names


def test_a_template_is_one_projection(frame):
    df = prompts.text_prompt(frame, templates.QA, {"question": "query", "context": "context"})
    plan = df.select(F.col("prompt"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") <= 1 and "UDF" not in plan
