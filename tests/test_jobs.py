from pyspark.sql import functions as F

from ragtables.functions import templates
from ragtables.functions.text import normalize_text
from ragtables.operators import columns, evaluation, prompts
from ragtables.operators.corpus import HashingEmbedder
from ragtables.operators.retrieval import assign_cells, cell_centres, retrieve
from ragtables.plans import jobs


def test_from_text_files_to_scores(spark, tmp_path):
    """Index, retrieve, prompt, generate, evaluate - and train on the same rows."""
    for name, words in (("rome", "rome is the capital of italy"), ("oslo", "oslo lies in norway")):
        (tmp_path / f"{name}.txt").write_text(words)
    path = str(tmp_path / "index")
    index = jobs.index_folder(spark, str(tmp_path), path, HashingEmbedder, recreate=True)
    data = spark.createDataFrame(
        [(1, "capital of italy", ["rome"]), (2, "what lies in norway", ["oslo"])],
        "row_id long, query string, answers array<string>",
    )
    data = retrieve(data, index, HashingEmbedder, "row_id", k=1)
    data = columns.title_documents(data, "positive_passages")
    data = columns.join_documents(data, "positive_passages")
    data = prompts.text_prompt(
        data, templates.QA, {"question": "query", "context": "positive_passages"}
    )

    def reader():
        def answer(chats):
            return [c[1]["content"].split("None: ")[1].split()[0] + ". Sure." for c in chats]

        return answer

    def run():
        return jobs.generate_answers(data, str(tmp_path / "said"), reader, "Be brief.")

    assert {r.row_id: r.text for r in run().collect()} == {1: "rome. Sure.", 2: "oslo. Sure."}
    results = jobs.evaluate_answers(
        data,
        run(),
        str(tmp_path / "results"),
        [evaluation.exact_match("answers"), evaluation.f1("answers")],
        [evaluation.classification("answers", {"rome": 2})],
        processor=lambda text: F.split(text, "[.]")[0],
    )
    found = {(r.scope, r.metric): r.value for r in results.collect()}
    assert found[("local", "EM")] == found[("local", "F1")] == 1.0
    assert found[("global", "accuracy")] == 1.0


def test_retrieval_by_cells(spark):
    index = spark.range(60).select(
        F.concat(F.lit("c"), "id").alias("chunk_id"),
        F.concat(F.lit("d"), "id").alias("doc_id"),
        F.lit(None).cast("string").alias("title"),
        F.concat_ws(" ", F.lit("w"), F.col("id")).alias("content"),
    )
    from ragtables.operators.corpus import embed

    index = embed(index, "content", HashingEmbedder)
    centres = cell_centres(index, 4, "chunk_id")
    stored = assign_cells(index, centres)
    rows = spark.createDataFrame([(i, f"{i} w") for i in range(5)], "id long, query string")
    plain = retrieve(rows, index, HashingEmbedder, "id", k=2)
    near = retrieve(rows, stored, HashingEmbedder, "id", k=2, centres=centres, probes=4)
    assert sorted(plain.collect()) == sorted(near.collect())
    assert all(r.positive_passages[0].content.split()[1] == str(r.id) for r in plain.collect())


def test_training_tables(spark):
    data = spark.range(50).select("id", F.concat(F.lit("q"), "id").alias("prompt"), F.lit("a").alias("answer"))
    train, dev = jobs.training_tables(data, "id", "prompt", "answer", "I", 0.2, seed=1, limit=30)
    assert train.count() == 24 and dev.count() == 6
    assert [m.role for m in dev.first().messages] == ["system", "user", "assistant"]
    train, _ = jobs.training_tables(
        data, "id", "prompt", "answer", "I", 0.2, template="{query}: {output}"
    )
    assert train.count() == 40 and train.filter("text = prompt || ': a'").count() == 40


def test_row_operators_work_on_a_stream(spark, tmp_path):
    rows = spark.createDataFrame([(1, "The Rome!", ["a", "b"])], "id int, query string, list array<string>")
    rows.write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).json(str(tmp_path / "in"))
    df = columns.flatten_list(stream, "list", "context")
    df = prompts.text_prompt(df, templates.QA_SHORT, {"query": "query"})
    df = prompts.training_messages(df, "prompt", "list", "I")
    df = df.withColumn("clean", normalize_text("query"))
    query = (
        df.writeStream.format("memory").queryName("streamed").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    row = spark.table("streamed").first()
    assert (row.context, row.prompt, row.clean) == ("a, b", "Question: The Rome!", "rome")
