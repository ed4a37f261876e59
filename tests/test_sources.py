import os
from functools import partial
from types import ModuleType

import numpy as np
import pytest
from pyspark.sql import functions as F

from ragtables.operators import columns, corpus, retrieval, sampling
from ragtables.plans.prepare import Checkpoints, Step, describe, fingerprint, run_steps
from ragtables.sources import storage, tables


@pytest.fixture
def docs(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.range(20).select("id", F.concat(F.lit("t"), "id").alias("text")).write.parquet(path)
    return spark.read.parquet(path)


def test_load_table(spark, docs, tmp_path):
    path = str(tmp_path / "split")
    split = F.when(F.col("id") < 5, "dev").otherwise("train").alias("split")
    docs.select("*", split).write.partitionBy("split").parquet(path)
    dev = tables.load_table(spark, path, "parquet", split="dev")
    assert sorted(r.id for r in dev.collect()) == [0, 1, 2, 3, 4]
    plan = dev._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    csv = str(tmp_path / "csv")
    docs.write.option("header", True).csv(csv)
    assert tables.load_table(spark, csv, "csv", schema="id long, text string", header="true").count() == 20
    with pytest.raises(ValueError):
        tables.load_table(spark, path, "parquet", split="x", split_column="nowhere")


def test_jsonl(spark, docs, tmp_path):
    frames = {"train": docs, "dev": docs.limit(2)}
    paths = tables.write_jsonl(frames, ["train", "dev"], "asqa", directory=str(tmp_path))
    assert [os.path.basename(p) for p in paths.values()] == ["asqa-train.jsonl", "asqa-dev.jsonl"]
    assert tables.load_json(spark, paths["dev"], docs.schema).count() == 2
    assert tables.load_json(spark, list(paths.values())).count() == 22
    with pytest.raises(ValueError):
        tables.write_jsonl(frames, ["train", "dev"], "asqa", "same", str(tmp_path))
    one = tables.write_jsonl(frames, ["dev"], "asqa", "name", str(tmp_path))
    assert one["dev"].endswith("asqa-name.jsonl")


def test_publish(spark, docs, tmp_path):
    tables.publish(docs, "published_docs", path=str(tmp_path / "published"))
    assert tables.load_table(spark, "published_docs").count() == 20
    spark.sql("DROP TABLE published_docs")


def test_text_folder(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n\ntwo  words\n")
    (tmp_path / "b.txt").write_text("three")
    (tmp_path / "c.md").write_text("no")
    df = tables.read_text_folder(spark, str(tmp_path))
    rows = {os.path.basename(r.doc_id): (r.title, r.content) for r in df.collect()}
    assert rows == {"a.txt": (None, "one\n\ntwo  words\n"), "b.txt": (None, "three")}
    index = corpus.build_index(df, corpus.HashingEmbedder)
    assert sorted(r.content for r in index.collect()) == ["one\ntwo words", "three"]


def test_index_is_added_to_or_made_anew(spark, tmp_path):
    docs = spark.createDataFrame(
        [("d1", None, "w " * 300), ("d2", "t", ""), ("d3", "t", "x")],
        "doc_id string, title string, content string",
    )
    index, path = corpus.build_index(docs, corpus.HashingEmbedder), str(tmp_path / "index")
    tables.write_index(index, path)
    rows = tables.read_index(spark, path).orderBy("chunk_id").collect()
    assert [r.chunk_id for r in rows] == ["d1:0", "d1:1", "d3:0"]
    assert [len(r.content.split()) for r in rows] == [200, 120, 1]
    # Chunks of a document that is written again are replaced.
    tables.write_index(index.filter("doc_id = 'd1'").withColumn("title", F.lit("new")), path)
    rows = tables.read_index(spark, path).orderBy("chunk_id").collect()
    assert [(r.chunk_id, r.title) for r in rows] == [("d1:0", "new"), ("d1:1", "new"), ("d3:0", "t")]
    tables.write_index(index.filter("doc_id = 'd3'"), path, recreate=True)
    assert tables.read_index(spark, path).count() == 1
    tables.write_index(index.filter("doc_id = 'd1'"), path)
    assert tables.read_index(spark, path).count() == 3
    # A run that ended between the two steps of a replacement.
    os.rename(path, path + ".new")
    assert tables.read_index(spark, path).count() == 3


def test_index_is_stored_by_cell(spark, tmp_path):
    docs = spark.createDataFrame(
        [(f"d{i}", "t", f"w{i % 3} " * 5) for i in range(30)],
        "doc_id string, title string, content string",
    )
    index, path = corpus.build_index(docs, corpus.HashingEmbedder), str(tmp_path / "index")
    centres = retrieval.cell_centres(index, 3, "chunk_id")
    tables.write_index(retrieval.assign_cells(index, centres), path)
    assert len([n for n in os.listdir(path) if n.startswith("cell=")]) == 3
    stored = tables.read_index(spark, path)
    plan = stored.filter("cell = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan
    with pytest.raises(ValueError):
        tables.write_index(index, path)


def _cells(path):
    """The files of each cell, with their times."""
    return {
        name: {
            f: os.stat(f"{path}/{name}/{f}").st_mtime_ns
            for f in os.listdir(f"{path}/{name}")
            if f.endswith(".parquet")
        }
        for name in os.listdir(path)
        if name.startswith("cell=")
    }


def test_documents_are_replaced_in_their_cells(spark, tmp_path):
    def chunks(rows):
        kind = "doc_id string, cell int, title string"
        return spark.createDataFrame(rows, kind).selectExpr(
            "concat(doc_id, ':', coalesce(cell, -1)) AS chunk_id", "doc_id", "title",
            "'words' AS content", "array(1f, 0f) AS embedding", "cell",
        )

    def stored():
        rows = tables.read_index(spark, path).collect()
        return sorted((r.doc_id, -1 if r.cell is None else r.cell, r.title) for r in rows)

    path = str(tmp_path / "index")
    first = [(f"d{i}", i % 20, "old") for i in range(400)] + [("n", None, "old"), ("alone", 77, "old")]
    tables.write_index(chunks(first).repartition(8), path)
    before = _cells(path)
    assert len(before) == 22 and sum(map(len, before.values())) <= 30  # not one a task and cell
    # One stays in its cell, one moves to another, one to a new one; two cells go empty.
    moved = [("d3", 3, "new"), ("d4", 9, "new"), ("d5", 50, "new"), ("n", 7, "new"), ("alone", 9, "new")]
    moved += [("d4", 60, "new"), ("fresh", None, "new")]
    for _ in range(2):  # doing it again changes nothing
        tables.write_index(chunks(moved), path)
        names = {m[0] for m in moved}
        want = [r for r in first if r[0] not in names] + moved
        assert stored() == sorted((d, -1 if c is None else c, t) for d, c, t in want)
    after = _cells(path)
    assert "cell=77" not in after and {"cell=50", "cell=60"} <= set(after)
    for name in (f"cell={c}" for c in (0, 1, 2, 6, 8, 10, 19)):
        assert after[name] == before[name]


def test_embedder(spark):
    df = spark.createDataFrame([("a b", "t"), ("", None), (None, "t")], "x string, t string")

    def lengths():
        return lambda texts: [[len(t), texts.index(t)] for t in texts]

    plain = [r.e for r in corpus.embed(df.coalesce(1), "x", lengths, "e").collect()]
    assert plain == [[3.0, 0.0], [0.0, 1.0], [0.0, 1.0]]
    df = corpus.embed(df, "x", lengths, "e", title_key="t", prefix="p: ", batch_size=1)
    assert [r.e for r in df.collect()] == [[8.0, 0.0], [3.0, 0.0], [4.0, 0.0]]
    vectors = corpus.HashingEmbedder(8)(["a b c d", "", "d c b a"])
    assert abs((vectors[0] ** 2).sum() - 1) < 1e-12 and not vectors[1].any()
    assert (vectors[0] == vectors[2]).all()


def test_results(spark, tmp_path):
    df = spark.createDataFrame([("local", "F1", 0.5), ("global", "f1", None)], tables.RESULTS)
    tables.write_results(df, str(tmp_path / "r"))
    assert sorted(map(tuple, tables.read_results(spark, str(tmp_path / "r")).collect())) == [
        ("global", "f1", None),
        ("local", "F1", 0.5),
    ]


def test_balanced(spark, docs):
    few = tables.balanced(docs.coalesce(1))
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 8)
    assert tables.balanced(many) is many


def test_materialize_starts_a_new_plan(spark, docs):
    df = storage.materialize(docs.filter("id > 3"))
    assert df.count() == 16 and storage.shared_dir(spark) in df.inputFiles()[0]
    assert "Filter" not in df._jdf.queryExecution().analyzed().toString()


# A module, since the values of other globals are part of a step's identity.
record = ModuleType("record")
record.calls = []


def mark(df, value):
    record.calls.append(value)
    return df.withColumn("m", F.lit(value))


def runs(frames, steps, kept):
    record.calls.clear()
    made = run_steps(frames, steps, kept)
    return list(record.calls), made


def test_checkpoints_are_reused_until_something_changes(spark, docs, tmp_path):
    kept = Checkpoints(spark, "run", str(tmp_path / "kept"))

    def steps(first=1, second=2):
        return [
            Step(mark, "docs", {"value": first}),
            Step(mark, "docs", {"value": second}),
        ]

    assert runs({"docs": docs}, steps(), kept)[0] == [1, 2]
    calls, made = runs({"docs": docs}, steps(), kept)
    assert calls == [] and [r.m for r in made["docs"].collect()] == [2] * 20
    # A later step alone, then an earlier one, which changes all that follow.
    assert runs({"docs": docs}, steps(1, 3), kept)[0] == [3]
    assert runs({"docs": docs}, steps(4, 2), kept)[0] == [4, 2]
    # Another input with the same steps.
    assert runs({"docs": docs.filter("id > 3")}, steps(), kept)[0] == [1, 2]
    # A torn write is not reused, and what follows it is computed again.
    assert runs({"docs": docs}, steps(), kept)[0] == []
    for name in os.listdir(tmp_path / "kept/run/0-mark"):
        os.remove(tmp_path / "kept/run/0-mark" / name / "docs/_SUCCESS")
    assert runs({"docs": docs}, steps(), kept)[0] == [1, 2]
    assert kept.delete() and not os.path.exists(tmp_path / "kept/run")
    assert runs({"docs": docs}, steps(), kept)[0] == [1, 2]


def test_a_changed_loader_changes_what_follows(spark, docs, tmp_path):
    kept = Checkpoints(spark, "run", str(tmp_path / "kept"))
    other = str(tmp_path / "other")
    docs.filter("id < 3").write.parquet(other)

    def load(frames, path):
        return {"main": spark.read.parquet(path)}

    def steps(path):
        return [
            Step(load, "main", {"path": path}, whole=True, keep=False),
            Step(mark, "main", {"value": 1}),
        ]

    first = docs.inputFiles()[0].rsplit("/", 1)[0]
    assert runs({}, steps(first), kept)[0] == [1]
    assert runs({}, steps(first), kept)[0] == []
    calls, made = runs({}, steps(other), kept)
    assert calls == [1] and made["main"].count() == 3
    # More files in the same folder count as a change, too.
    docs.filter("id = 9").write.mode("append").parquet(other)
    calls, made = runs({}, steps(other), kept)
    assert calls == [1] and made["main"].count() == 4


FACTOR = 2


def scale(df, *, offset=1):
    return df.withColumn("m", F.col("id") * FACTOR + offset)


def test_what_a_step_names_is_part_of_it(spark, docs, tmp_path, monkeypatch):
    kept = Checkpoints(spark, "run", str(tmp_path / "kept"))

    def run():
        made = run_steps({"docs": docs}, [Step(scale, "docs")], kept)["docs"]
        return made.agg(F.max("m")).first()[0]

    assert run() == 39
    monkeypatch.setitem(globals(), "FACTOR", 3)
    assert run() == 58
    monkeypatch.setattr(scale, "__kwdefaults__", {"offset": 5})
    assert run() == 62


def test_a_file_rewritten_in_place_is_read_again(spark, tmp_path):
    kept, path = Checkpoints(spark, "run", str(tmp_path / "kept")), str(tmp_path / "in.jsonl")

    def run(lines):
        with open(path, "w") as f:
            f.write("".join(f'{{"id": {i}}}\n' for i in lines))
        os.utime(path, (1_000_000, 1_000_000 + len(lines)))
        docs = tables.load_json(spark, path, "id long")
        return runs({"docs": docs}, [Step(mark, "docs", {"value": 1})], kept)[0]

    assert run([1, 2]) == [1] and run([1, 2]) == []
    assert run([3, 4, 5]) == [1]


def test_scratch_tables_go_at_the_end(spark, docs):
    with storage.scratch(spark):
        kept = storage.materialize(docs)
        path = kept.inputFiles()[0].rsplit("/", 1)[0]
        assert kept.count() == 20 and storage.exists(spark, path)
    assert not storage.exists(spark, path)


def test_two_functions_never_share_a_fingerprint():
    def make(n):
        return lambda df: df.filter(F.col("id") > n)

    marks = {
        fingerprint(make(1)),
        fingerprint(make(2)),
        fingerprint(lambda df: df.filter(F.col("id") < 1)),
        fingerprint(lambda df: df.filter(F.col("x") < 1)),
    }
    assert len(marks) == 4 and fingerprint(make(1)) in marks
    with pytest.raises(TypeError):
        describe(object())
    assert describe(np.zeros(2)) != describe(np.ones(2))
    assert fingerprint(corpus.HashingEmbedder) == fingerprint(corpus.HashingEmbedder)
    assert describe(partial(make, 1)) != describe(partial(make, 2))


def test_steps_over_several_tables(docs):
    steps = [
        Step(columns.set_field, ["a", "b"], {"key": "k", "value": 1}),
        Step(
            lambda frames: {"c": sampling.merge_tables([frames["a"], frames["b"]])},
            ["a", "b"],
            whole=True,
            outputs=["c"],
            keep=False,
        ),
    ]
    made = run_steps({"a": docs, "b": docs.limit(3)}, steps)
    assert made["c"].count() == 23 and made["a"].columns == ["id", "text", "k"]
    with pytest.raises(ValueError):
        Step(columns.set_field, []).names()
    with pytest.raises(ValueError):
        run_steps({"a": docs}, [Step(lambda f: {"x": f["a"]}, "a", whole=True)])


def test_shared_folder_is_required_on_a_cluster():
    class Conf:
        def get(self, name, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://somewhere"
            applicationId = "test"

    with pytest.raises(RuntimeError):
        storage.shared_dir(Session())
    Session.sparkContext.master = "local[2]"
    local = storage.shared_dir(Session())
    assert os.path.isdir(local) and storage.shared_dir(Session()) == local


def test_replacing_stores_no_copy_of_the_touched_cells(spark, tmp_path, monkeypatch):
    def chunks(title, ids):
        return spark.createDataFrame([(f"d{i}", i % 4, title) for i in ids], "doc_id string, cell int, title string").selectExpr(
            "concat(doc_id, ':0') AS chunk_id", "doc_id", "title",
            "'words' AS content", "array(1f, 0f) AS embedding", "cell",
        )

    path, kept = str(tmp_path / "index"), []
    tables.write_index(chunks("old", range(200)), path)

    def counting(df, *options, plain=storage.materialize):
        kept.append(df.count())
        return plain(df, *options)

    monkeypatch.setattr(storage, "materialize", counting)
    tables.write_index(chunks("new", range(0, 200, 5)), path)
    assert sum(kept) == 40  # the new chunks alone
    rows = {r.doc_id: r.title for r in tables.read_index(spark, path).collect()}
    assert rows == {f"d{i}": "old" if i % 5 else "new" for i in range(200)}
