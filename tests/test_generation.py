import os

import pytest
from pyspark.sql import functions as F

from ragtables.operators import generation
from ragtables.sources import tables
from ragtables.sources.predictions import PredictionStore
from ragtables.streaming.generation import run_until_answered, stream_generate


def counting_model(folder):
    """A model that leaves one file per prompt it answers."""

    def make():
        def answer(prompts):
            for prompt in prompts:
                with open(os.path.join(folder, f"{prompt}"), "a") as f:
                    f.write("x")
            return [f"re: {p}" for p in prompts]

        return answer

    return make


def failing_model():
    # Nested, so that it travels to the tasks with its code.
    def make():
        def answer(prompts):
            if any("bad" in p for p in prompts):
                raise RuntimeError("no")
            return [p.upper() for p in prompts]

        return answer

    return make


@pytest.fixture
def data(spark):
    return spark.range(40).select(
        F.concat(F.lit("r"), "id").alias("row_id"),
        F.concat(F.lit("p"), "id").alias("prompt"),
        F.array(F.lit("t")).alias("answers"),
    ).repartition(4)


def calls(folder):
    return {name: os.path.getsize(os.path.join(folder, name)) for name in os.listdir(folder)}


def test_a_failed_prompt_fails_alone(spark):
    df = spark.createDataFrame(
        [(i, "bad" if i in (3, 4) else f"p{i}") for i in range(9)], "id int, prompt string"
    )
    df = generation.generate(
        df, "prompt", "answer", failing_model(), batch_size=4, error_key="error"
    )
    rows = {r.id: (r.answer, r.error) for r in df.collect()}
    assert rows[3] == rows[4] == (None, "RuntimeError: no")
    assert rows[0] == ("P0", None) and len(rows) == 9
    assert "_call" not in df.columns


def test_a_model_must_answer_every_prompt(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, prompt string").coalesce(1)
    df = generation.generate(df, "prompt", "answer", lambda: lambda ps: ps[:1])
    # The batch of two is refused, then each prompt is asked alone.
    assert [r.answer for r in df.collect()] == ["a", "b"]


def test_the_model_runs_once_per_row_though_the_answer_is_used_twice(spark, data, tmp_path):
    df = generation.generate(data, "prompt", "answer", counting_model(str(tmp_path)))
    df.select(F.length("answer"), F.upper("answer"), "answer").collect()
    assert calls(tmp_path) == {f"p{i}": 1 for i in range(40)}


def test_chat(spark):
    df = spark.createDataFrame([(1, "hello"), (2, "fail")], "id int, prompt string")

    def client():
        def answer(chats):
            assert all([m["role"] for m in c] == ["system", "user"] for c in chats)
            if any(c[1]["content"] == "fail" for c in chats):
                raise RuntimeError
            return [c[0]["content"] + c[1]["content"] for c in chats]

        return answer

    df = generation.chat(df, "prompt", "answer", client, "Be kind. ", pause=0.01)
    assert df.columns == ["id", "prompt", "answer"]
    assert {r.id: r.answer for r in df.collect()} == {1: "Be kind. hello", 2: ""}


@pytest.mark.parametrize("rounds", [1, 3])
def test_resume(spark, data, tmp_path, rounds):
    path, log = str(tmp_path / "predictions"), str(tmp_path / "log")
    os.mkdir(log)

    def run(df):
        return generation.generate_resumable(
            df, path, "prompt", "answers", counting_model(log), rounds=rounds
        )

    first = run(data.limit(15).filter("row_id < 'r5'"))
    done = first.count()
    assert len(calls(log)) == done
    rows = {r.row_id: (r.text, r.target) for r in run(data).collect()}
    assert rows == {f"r{i}": (f"re: p{i}", ["t"]) for i in range(40)}
    again = {r.row_id: (r.text, r.target) for r in run(data).collect()}
    assert again == rows
    assert calls(log) == {f"p{i}": 1 for i in range(40)}


def test_predictions_written_twice_count_once(spark, data, tmp_path):
    path = str(tmp_path / "predictions")
    df = data.select("row_id", F.col("prompt").alias("text"), F.col("answers").alias("target"))
    tables.append_predictions(df, path)
    tables.append_predictions(df.withColumn("text", F.lit("zz")), path)
    rows = tables.read_predictions(spark, path).collect()
    assert len(rows) == 40 and all(r.text.startswith("p") for r in rows)


def test_a_failure_is_asked_again(spark, tmp_path):
    path = str(tmp_path / "predictions")
    rows = spark.createDataFrame(
        [(i, "bad" if i < 3 else f"p{i}", "t") for i in range(10)],
        "row_id int, prompt string, answers string",
    )

    def run(model, **options):
        return generation.generate_resumable(
            rows, path, "prompt", "answers", model, **options
        )

    with pytest.raises(RuntimeError, match="3 of 10"):
        run(failing_model())
    kept = {r.row_id: (r.text, r.error) for r in tables.read_predictions(spark, path).collect()}
    assert kept[0] == (None, "RuntimeError: no") and kept[5] == ("P5", None)
    assert run(failing_model(), failed_share=1.0).filter("error is not null").count() == 3
    done = run(lambda: lambda prompts: ["second"] * len(prompts)).collect()
    assert {r.row_id: r.text for r in done} == {
        i: "second" if i < 3 else f"P{i}" for i in range(10)
    }
    assert all(r.error is None for r in done)


def test_an_answer_wins_over_a_blank(spark, tmp_path):
    path = str(tmp_path / "predictions")
    rows = [(1, "", {"a": 1}, None), (1, "real", {"a": 2}, None), (2, None, {}, "down")]
    tables.append_predictions(
        spark.createDataFrame(
            rows, "row_id int, text string, target map<string,int>, error string"
        ),
        path,
    )
    got = {r.row_id: (r.text, r.error) for r in tables.read_predictions(spark, path).collect()}
    assert got == {1: ("real", None), 2: (None, "down")}


def test_chat_takes_messages(spark):
    df = spark.createDataFrame(
        [(1, [("system", "a"), ("user", "b"), ("assistant", "c"), ("user", "d")])],
        "id int, prompt array<struct<role:string,content:string>>",
    )

    def client():
        return lambda chats: ["".join(m["content"] for m in c) for c in chats]

    df = generation.chat(df, "prompt", "answer", client, "unused", pause=0)
    assert [r.answer for r in df.collect()] == ["abcd"]


def test_stream_takes_new_files_only(spark, data, tmp_path):
    source, sink, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    os.mkdir(log)

    def run():
        stream = spark.readStream.schema(data.schema).json(source)
        stream_generate(
            stream, sink, str(tmp_path / "progress"), "prompt", "answers", counting_model(log)
        ).awaitTermination()
        return PredictionStore(spark, sink).table().count()

    data.filter("row_id < 'r2'").write.json(source)
    first = run()
    assert first == data.filter("row_id < 'r2'").count() and run() == first
    data.filter("row_id >= 'r2'").write.mode("append").json(source)
    assert run() == 40
    assert calls(log) == {f"p{i}": 1 for i in range(40)}
    assert tables.read_predictions(spark, sink).count() == 40


def test_stream_needs_a_stream(data):
    with pytest.raises(ValueError):
        stream_generate(data, "x", "y", "prompt", "answers", failing_model())


def stream_of(spark, df, folder):
    df.write.json(folder)
    return spark.readStream.schema(df.schema).json(folder)


def test_batch_and_stream_share_a_store(spark, tmp_path):
    """No answer is lost and none is asked for twice, whichever wrote it."""
    path = str(tmp_path / "predictions")
    rows = spark.createDataFrame(
        [(i, "bad" if i < 4 else f"p{i}", "t") for i in range(20)], "row_id int, prompt string, answers string"
    )
    stream = stream_of(spark, rows, str(tmp_path / "in"))
    stream_generate(stream, path, str(tmp_path / "one"), "prompt", "answers", failing_model()).awaitTermination()
    assert tables.read_predictions(spark, path).filter("error is not null").count() == 4
    log = str(tmp_path / "log")
    os.mkdir(log)
    for _ in range(2):
        done = generation.generate_resumable(rows, path, "prompt", "answers", counting_model(log))
        assert {r.row_id: r.text for r in done.collect()} == {
            i: "re: bad" if i < 4 else f"P{i}" for i in range(20)
        }
    assert calls(log) == {"bad": 4}
    # Another checkpoint starts its batch numbers anew, and must not replace the first's.
    again = spark.readStream.schema(rows.schema).json(str(tmp_path / "in"))
    stream_generate(again, path, str(tmp_path / "two"), "prompt", "answers", failing_model()).awaitTermination()
    assert PredictionStore(spark, path).table().count() == 20 + 4 + 20
    assert tables.read_predictions(spark, path).filter("error is not null").count() == 0


def test_a_batch_written_again_replaces_itself(spark, data, tmp_path):
    path = str(tmp_path / "predictions")
    rows = data.selectExpr("row_id", "prompt AS text", "answers AS target")
    for _ in range(2):
        tables.append_predictions(rows, path, batch="one")
    tables.append_predictions(rows.filter("row_id < 'r2'"), path, batch="two")
    store = PredictionStore(spark, path)
    assert store.batches() == ["one", "two"]
    assert store.table().count() == 40 + rows.filter("row_id < 'r2'").count()


def test_what_is_done_is_not_moved(spark, data, tmp_path):
    path = str(tmp_path / "predictions")
    tables.append_predictions(data.selectExpr("row_id", "prompt AS text", "answers AS target"), path)
    store = PredictionStore(spark, path)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    lacking = plan(store.remaining(data))
    assert "LeftAnti" in lacking and "Bucketed: true" in lacking
    assert sum("Exchange hashpartitioning(row_id" in line for line in lacking.splitlines()) == 1
    assert "Exchange" not in plan(store.best())


def test_compacting_keeps_the_best_row_of_each_key(spark, data, tmp_path):
    path = str(tmp_path / "predictions")
    for n in range(3):
        rows = data.selectExpr("row_id", f"if(row_id < 'r{n}', null, concat(prompt, {n})) AS text", "answers AS target",
                               f"if(row_id < 'r{n}', 'down', null) AS error")
        tables.append_predictions(rows, path, batch=f"b{n}")
    before = sorted(map(tuple, tables.read_predictions(spark, path).collect()))
    store = PredictionStore(spark, path, buckets=99)
    store.compact()
    assert len(store.batches()) == 1 and store.table().count() == 40
    assert sorted(map(tuple, tables.read_predictions(spark, path).collect())) == before
    folder = os.path.join(path, f"stored_in={store.batches()[0]}")
    assert sum(n.endswith(".parquet") for n in os.listdir(folder)) <= store.buckets < 99


def test_stores_are_told_apart_from_other_folders(spark, data, tmp_path):
    rows = data.selectExpr("row_id", "prompt AS text", "answers AS target")
    rows.write.parquet(str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="no store"):
        tables.append_predictions(rows, str(tmp_path / "plain"))
    os.makedirs(str(tmp_path / "sunk" / "_spark_metadata"))
    with pytest.raises(ValueError, match="sink log"):
        tables.append_predictions(rows, str(tmp_path / "sunk"))
    tables.append_predictions(rows, str(tmp_path / "kept"))
    with pytest.raises(ValueError, match="the store has"):
        tables.append_predictions(rows.withColumn("target", F.lit(1)), str(tmp_path / "kept"))
    with pytest.raises(FileNotFoundError):
        tables.read_predictions(spark, str(tmp_path / "nowhere"))


def failing_first(folder, times):
    """A model that fails ``times`` times for each prompt with a 3, and counts its calls."""

    def make():
        def answer(prompts):
            out = []
            for p in prompts:
                path = os.path.join(folder, str(p))
                seen = os.path.getsize(path) if os.path.exists(path) else 0
                if len(prompts) > 1 and any("3" in str(q) for q in prompts):
                    raise RuntimeError("batch")  # each is then asked alone
                with open(path, "a") as f:
                    f.write("x")
                if "3" in str(p) and seen < times:
                    raise RuntimeError("down")
                out.append(f"re: {p}")
            return out

        return answer

    return make


def test_a_stream_asks_again(spark, data, tmp_path):
    log, path = str(tmp_path / "log"), str(tmp_path / "out")
    os.mkdir(log)
    stream = stream_of(spark, data, str(tmp_path / "in"))
    for _ in range(2):  # the restart finds nothing to do
        query = stream_generate(
            stream, path, str(tmp_path / "progress"), "prompt", "answers", failing_first(log, 2), tries=5, wait=0.1
        )
        assert run_until_answered(query, 120)
    rows = {r.row_id: (r.text, r.target, r.error) for r in PredictionStore(spark, path).table().collect()}
    assert rows == {f"r{i}": (f"re: p{i}", ["t"], None) for i in range(40)}
    assert PredictionStore(spark, path).table().count() == 40
    assert calls(log) == {f"p{i}": 3 if "3" in str(i) else 1 for i in range(40)}


def test_a_prompt_that_always_fails_is_stored_with_its_error(spark, tmp_path):
    rows = spark.createDataFrame(
        [(i, [("user", "bad" if i == 2 else f"p{i}")], {"a": i}) for i in range(6)],
        "row_id bigint, prompt array<struct<role:string,content:string>>, answers map<string,int>",
    )

    def model():
        def answer(chats):
            if any(c[0]["content"] == "bad" for c in chats):
                raise RuntimeError("no")
            return [c[0]["content"].upper() for c in chats]

        return answer

    path = str(tmp_path / "out")
    query = stream_generate(
        stream_of(spark, rows, str(tmp_path / "in")), path, str(tmp_path / "progress"), "prompt", "answers", model,
        tries=3, wait=0.1,
    )
    assert run_until_answered(query, 120)
    got = {r.row_id: (r.text, r.target, r.error) for r in PredictionStore(spark, path).table().collect()}
    assert got == {
        i: (None, {"a": 2}, "RuntimeError: no") if i == 2 else (f"P{i}", {"a": i}, None) for i in range(6)
    }
