import pytest
from pyspark.sql import functions as F

from ragtables.operators import columns, normalizers


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(
        [("x", ["a", None, "b"], [("t", "c"), (None, "d")])],
        "`q-1` string, list array<string>, docs array<struct<title:string,content:string>>",
    )


def test_select_columns(frame):
    assert columns.select_columns(frame, ["list", "q-1"]).columns == ["list", "q-1"]
    with pytest.raises(ValueError):
        columns.select_columns(frame, ["nowhere"])


def test_update_columns_runs_in_mapping_order(spark):
    df = spark.createDataFrame([("x", "y")], "a string, b string")
    found = columns.update_columns(df, {"a": "b", "b": "c", "c": "a"})
    assert found.first().asDict() == {"a": "x", "b": "x", "c": "x"}
    with pytest.raises(ValueError):
        columns.update_columns(df, {"c": "a"})


def test_set_field_and_tag(frame):
    row = columns.set_field(frame, "k", [1, 2]).first()
    assert row.k == [1, 2]
    assert columns.set_field(frame, "k", {"a": "b", "c": None}).first().k.a == "b"
    assert columns.tag(frame, "train").first().source == "train"


def test_flatten_list_skips_nulls_and_refuses_strings(frame):
    assert columns.flatten_list(frame, "list", "flat").first().flat == "a, b"
    with pytest.raises(TypeError):
        columns.flatten_list(frame, "q-1", "flat")


def test_documents(frame):
    titled = columns.title_documents(frame, "docs")
    assert titled.first().docs == ["t: c", "None: d"]
    assert columns.join_documents(titled, "docs").first().docs == "t: c\nNone: d"
    assert columns.join_documents(titled, "docs", 1, "|").first().docs == "t: c"
    assert columns.join_documents(titled, "docs", 0).first().docs == ""
    with pytest.raises(ValueError):
        columns.title_documents(frame, "docs", text_key="text")
    with pytest.raises(TypeError):
        columns.title_documents(frame, "list")


def test_filters(spark):
    df = spark.createDataFrame(
        [(1, ([0, 1],)), (2, ([0],)), (3, ([],)), (4, None)],
        "id int, passages struct<is_selected:array<int>>",
    )
    assert [r.id for r in columns.filter_rows(df, "MSMARCO").collect()] == [1]
    columns.register_filter("test_even", lambda: F.col("id") % 2 == 0)
    assert [r.id for r in columns.filter_rows(df, "test_even").collect()] == [2, 4]
    with pytest.raises(ValueError):
        columns.register_filter("test_even", lambda: F.lit(True))
    with pytest.raises(KeyError):
        columns.filter_rows(df, "unknown")


def test_normalize_asqa(spark):
    df = spark.createDataFrame(
        [("who?", [("long one",), ("two",)], [(["The A!", "b"],), ([],)])],
        "ambiguous_question string, annotations array<struct<long_answer:string>>,"
        "qa_pairs array<struct<short_answers:array<string>>>",
    )
    row = normalizers.normalize_asqa(df).first().asDict()
    assert row["query"] == "who?"
    assert row["answers"] == row["answer-long"] == ["long one", "two"]
    assert row["answer-short"] == [["", "b"], []]


def test_normalize_hotpot_zips_to_the_shorter_list(spark):
    df = spark.createDataFrame(
        [
            ("q", "a", (["T", None, "extra"], [["x.", " y"], ["z"]])),
            ("q", "a", (["T"], [[], ["z"]])),
            ("q", "a", ([], [])),
        ],
        "question string, answer string,"
        "context struct<title:array<string>,sentences:array<array<string>>>",
    )
    rows = normalizers.normalize_hotpot(df).collect()
    assert [r.positive_passages for r in rows] == [["T: x. y", "None: z"], ["T: "], []]
    assert rows[0].answers == ["a"] and rows[0].query == "q"


def test_normalize_arc_and_pubmed(spark):
    arc = spark.createDataFrame(
        [("q", (["x", "y"],), "B")],
        "question string, choices struct<text:array<string>>, answerKey string",
    )
    row = normalizers.normalize_arc(arc).first()
    assert (row.query, row.options, row.answers) == ("q", ["x", "y"], "B")
    pubmed = spark.createDataFrame(
        [("q", "yes", ["c1", "c2"])],
        "QUESTION string, final_decision string, CONTEXTS array<string>",
    )
    row = normalizers.normalize_pubmed(pubmed).first()
    assert row.query == "q" and row.answers == ["yes"]
    assert row.positive_passages == ["c1", "c2"]
