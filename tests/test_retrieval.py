import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ragtables.operators import retrieval
from ragtables.operators.joins import lookup_join


def frame(spark, ids, vectors, key="id"):
    rows = [(i, [float(x) for x in v]) for i, v in zip(ids, vectors)]
    kind = "string" if isinstance(ids[0], str) else "long"
    return spark.createDataFrame(rows, f"{key} {kind}, embedding array<float>").repartition(3)


def search(ids, queries, doc_ids, docs, k, skip):
    """Brute force in plain loops, summing in order."""
    found = []
    for q, v in zip(ids, queries):
        scored = []
        for d, w in zip(doc_ids, docs):
            total = 0.0
            for x, y in zip(v, w):
                total += float(np.float32(x)) * float(np.float32(y))
            if not (skip and q == d):
                scored.append((-total, d))
        found += [(q, d, -s, r) for r, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found)


def rows(df):
    return sorted((r.query_id, r.doc_id, r.score, r.rank) for r in df.collect())


@pytest.fixture(scope="module")
def vectors():
    made = np.random.default_rng(1).normal(size=(120, 12))
    made[40:80] = made[40]  # a third of the corpus are copies of one vector
    made[90] = 0
    return made


@pytest.mark.parametrize("sent", [retrieval.SENT_COMPONENTS, 12 * 50])
@pytest.mark.parametrize("k", [1, 7, 200])
def test_exact_search_in_both_ways(spark, vectors, monkeypatch, sent, k):
    # Several products per block, and several blocks on either side.
    monkeypatch.setattr(retrieval, "QUERY_ROWS", 7)
    monkeypatch.setattr(retrieval, "DOC_ROWS", 9)
    monkeypatch.setattr(retrieval, "BLOCK_COMPONENTS", 16 * 12)
    ids = list(range(120))
    df = frame(spark, ids, vectors)
    found = retrieval.dense_topk(df, df, k, "id", "id", skip_equal_ids=True, sent_components=sent)
    assert rows(found) == search(ids, vectors, ids, vectors, k, True)


def test_many_sets_of_queries_are_not_a_job_each(spark, vectors):
    df = frame(spark, list(range(120)), vectors)
    spark.sparkContext.setJobGroup("many sets", "")
    found = retrieval.dense_topk(df, df, 5, "id", "id", sent_components=12 * 2)
    assert found.count() == 600
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("many sets")) < 60
    spark.sparkContext.setJobGroup("others", "")


@pytest.mark.parametrize("k", [1, 2, 600])
def test_large_sets_of_queries_scan_with_floors(spark, monkeypatch, k):
    """Of forty partitions each would hand out k hits a query, and blocks would do so too."""
    monkeypatch.setattr(retrieval, "SCAN_PAIRS", 0, raising=False)
    monkeypatch.setattr(retrieval, "BLOCK_COMPONENTS", 50 * 12)
    made = np.random.default_rng(4).normal(size=(2000, 12))
    docs = frame(spark, list(range(2000)), made).repartition(40)
    queries = frame(spark, list(range(30)), made[:30])
    handed, ranked = [], retrieval._ranked

    def counted(found, k):
        handed.append(found.count())
        return ranked(found, k)

    monkeypatch.setattr(retrieval, "_ranked", counted)
    found = retrieval.dense_topk(
        queries, docs, k, "id", "id", skip_equal_ids=True, sent_components=12 * 20
    )
    assert rows(found) == search(range(30), made[:30], range(2000), made, k, True)
    assert k == 600 or sum(handed) < 30 * 30 * k


def test_sets_of_queries_without_enough_documents_or_partitions(spark, vectors, monkeypatch):
    monkeypatch.setattr(retrieval, "SCAN_PAIRS", 0)
    names = [f"d{i:03}" for i in range(120)]
    docs, queries = frame(spark, names, vectors).coalesce(1), frame(spark, [1, 2, 3], vectors[:3], "q")
    for k in (5, 200):
        found = retrieval.dense_topk(queries, docs, k, "q", "id", sent_components=12)
        assert rows(found) == search([1, 2, 3], vectors[:3], names, vectors, k, False)
    bad = docs.withColumn("embedding", F.when(F.col("id") != "d007", F.col("embedding")))
    with pytest.raises(Exception, match="d007"):
        retrieval.dense_topk(queries, bad, 5, "q", "id", sent_components=12)
    found = retrieval.dense_topk(queries, bad, 5, "q", "id", sent_components=12, skip_invalid=True)
    left = [i for i in range(120) if i != 7]
    want = search([1, 2, 3], vectors[:3], [names[i] for i in left], vectors[left], 5, False)
    assert rows(found) == want


def test_search_in_single_precision_is_exact(vectors, monkeypatch):
    """Vectors stay as they are, products are small, and ties go to the lower id however
    the documents come."""
    monkeypatch.setattr(retrieval, "QUERY_ROWS", 16)
    monkeypatch.setattr(retrieval, "DOC_ROWS", 10)
    narrow = vectors.astype(np.float32)
    ids = np.array([f"d{i % 119:03}" for i in range(120)], object)
    for k, skip in ((1, False), (7, True), (200, False)):
        seen = retrieval._Search(ids, narrow, k, skip)
        assert seen.vectors is narrow and seen.narrow is narrow
        order = np.random.default_rng(5).permutation(120)
        for part in np.array_split(order, 5):
            seen.see(ids[part], narrow[part])
            assert seen.space.size <= 16 * 10
        for i in range(120):
            hits = search([ids[i]], vectors[i : i + 1], ids, vectors, k, skip)
            hits.sort(key=lambda h: h[3])
            kept = seen.scores[i] > -np.inf
            assert list(zip(seen.docs[i][kept], seen.scores[i][kept])) == [h[1:3] for h in hits]


def test_best_rows_with_equal_scores_and_without_ids():
    found = pd.DataFrame(
        {
            "row": [1, 0, 0, 0, 1, 0],
            "score": [2.0, 1.0, 1.0, 3.0, 2.0, 1.0],
            "doc_id": ["b", None, "c", "z", "a", "b"],
        }
    )
    best = retrieval.best_per_row(found, 3)
    assert best["row"].tolist() == [0, 0, 0, 1, 1]
    assert best["doc_id"].tolist() == ["z", "b", "c", "a", "b"]
    assert retrieval.best_per_row(found, 4)["doc_id"].isna().tolist()[3]


def test_string_ids_and_small_slices(spark, vectors, monkeypatch):
    monkeypatch.setattr(retrieval, "_SLICE", 5)
    names = [f"d{i:03}" for i in range(120)]
    docs, queries = frame(spark, names, vectors), frame(spark, [1, 2], vectors[:2], "q")
    found = retrieval.dense_topk(queries, docs, 5, "q", "id")
    assert rows(found) == search([1, 2], vectors[:2], names, vectors, 5, False)


def test_a_floor_from_some_partitions_changes_nothing(spark, vectors, monkeypatch):
    monkeypatch.setattr(retrieval, "FLOOR_PARTITIONS", 4)
    ids = list(range(120))
    df = frame(spark, ids, vectors).repartition(9)
    for k in (1, 7, 60):
        found = retrieval.dense_topk(df, df, k, "id", "id")
        assert rows(found) == search(ids, vectors, ids, vectors, k, False)


BROKEN = {
    "null": None,
    "short": [1.0] * 11,
    "undefined": [1.0] * 11 + [float("nan")],
    "infinite": [1.0] * 11 + [float("inf")],
    "hole": [1.0] * 11 + [None],
}


@pytest.mark.parametrize("kind", list(BROKEN))
def test_a_broken_vector_is_named_or_left_out(spark, vectors, kind):
    good = frame(spark, list(range(30)), vectors[:30])
    bad = spark.createDataFrame([(777, BROKEN[kind])], good.schema)
    mixed = good.union(bad).repartition(3)
    ids = list(range(30))
    want = search(ids, vectors[:30], ids, vectors[:30], 5, False)
    centres = retrieval.cell_centres(good, 3, "id")

    def exact(queries, corpus, **options):
        return retrieval.dense_topk(queries, corpus, 5, "id", "id", **options)

    def cells(queries, corpus, **options):
        return retrieval.cell_topk(queries, corpus, centres, 5, 3, "id", "id", **options)

    for run in (exact, cells):
        for queries, corpus in ((good, mixed), (mixed, good)):
            with pytest.raises(Exception, match="777"):
                run(queries, corpus).collect()
            assert rows(run(queries, corpus, skip_invalid=True)) == want
    many = retrieval.dense_topk(mixed, mixed, 5, "id", "id", sent_components=12 * 9, skip_invalid=True)
    assert rows(many) == want


def test_further_cells_until_there_are_enough(spark, vectors):
    ids = list(range(120))
    df = frame(spark, ids, vectors)
    centres = retrieval.cell_centres(df, 30, "id")
    found = retrieval.cell_topk(df, df, centres, 50, 1, "id", "id", skip_equal_ids=True)
    assert {r["count"] for r in found.groupBy("query_id").count().collect()} == {50}
    found = retrieval.cell_topk(df, df, centres, 500, 1, "id", "id")
    assert rows(found) == search(ids, vectors, ids, vectors, 500, False)


def test_search_without_queries_or_documents(spark, vectors):
    df = frame(spark, list(range(10)), vectors[:10])
    none = df.filter("id < 0")
    for sent in (retrieval.SENT_COMPONENTS, 12 * 4):
        assert retrieval.dense_topk(none, df, 3, "id", "id", sent_components=sent).count() == 0
        assert retrieval.dense_topk(df, none, 3, "id", "id", sent_components=sent).count() == 0


def test_cells_are_exact_with_all_probes(spark, vectors, monkeypatch):
    # The copies fill several blocks.
    monkeypatch.setattr(retrieval, "BLOCK_COMPONENTS", 8 * 12)
    ids = list(range(120))
    df = frame(spark, ids, vectors)
    centres = retrieval.cell_centres(df, 5, "id")
    found = retrieval.cell_topk(df, df, centres, 6, 5, "id", "id", skip_equal_ids=True)
    assert rows(found) == search(ids, vectors, ids, vectors, 6, True)


def test_cells_find_most(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(8, 16))
    made = np.repeat(centre, 50, axis=0) + rng.normal(scale=0.3, size=(400, 16))
    df = frame(spark, list(range(400)), made)
    exact = retrieval.dense_topk(df, df, 10, "id", "id")
    centres = retrieval.cell_centres(df, 8, "id")
    stored = retrieval.assign_cells(df, centres)
    near = [
        retrieval.recall_at_k(
            retrieval.cell_topk(df, stored, centres, 10, p, "id", "id"), exact
        ).first().recall
        for p in (1, 3, 8)
    ]
    assert near == sorted(near) and near[1] > 0.8 and near[2] == 1.0


def test_probes_are_chosen_by_recall(spark):
    """Vectors without clusters, where four probes of 16 find too little."""
    made = np.random.default_rng(3).normal(size=(600, 24))
    df = frame(spark, list(range(600)), made)
    asked = df.filter("id % 10 = 0")
    exact = retrieval.dense_topk(asked, df, 10, "id", "id", skip_equal_ids=True)
    centres = retrieval.cell_centres(df, 16, "id")
    stored = retrieval.assign_cells(df, centres)

    def recall(queries, probes):
        found = retrieval.cell_topk(queries, stored, centres, 10, probes, "id", "id", skip_equal_ids=True)
        return retrieval.recall_at_k(found, exact).first().recall

    probes, said = retrieval.probes_for_recall(asked, stored, centres, 10, 0.9, "id", "id", skip_equal_ids=True)
    assert recall(asked, 4) < 0.8 and recall(asked, probes - 1) < 0.9
    assert said >= 0.9 and recall(asked, probes) == pytest.approx(said)
    assert recall(asked, None) >= 0.9  # the default: fewer queries than a sample has
    none = df.filter("id < 0")
    assert retrieval.probes_for_recall(none, stored, centres, 10, 0.9, "id", "id") == (16, 1.0)


def test_top_k_is_cut_before_the_shuffle(spark, vectors):
    df = frame(spark, list(range(120)), vectors)
    plan = retrieval.dense_topk(df, df, 3, "id", "id")._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("WindowGroupLimit") == 2 and "Cartesian" not in text
    assert "NestedLoop" not in text


@pytest.mark.parametrize("sent", [retrieval.SENT_BYTES, 0])
def test_attach_documents(spark, sent):
    queries = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "qid long, query string")
    hits = spark.createDataFrame(
        [(1, "x", 2, 0.1), (1, "y", 1, 0.2), (2, "x", 1, 0.3), (2, "gone", 2, 0.1)],
        "query_id long, doc_id string, rank int, score double",
    )
    docs = spark.createDataFrame(
        [("x", "X", None), ("y", "Y", "why"), ("z", "Z", "zed")],
        "id string, content string, title string",
    )
    df = retrieval.attach_documents(queries, hits, docs, "qid", "id", sent_bytes=sent)
    assert df.columns == ["qid", "query", "docs"]
    found = {r.qid: [tuple(d) for d in r.docs] for r in df.collect()}
    assert found == {1: [("Y", "why"), ("X", None)], 2: [("X", None)], 3: []}
    both = retrieval.concat_branches(
        df.withColumn("other", F.col("docs")), ["docs", "other"], "all"
    )
    assert {r.qid: len(r["all"]) for r in both.collect()} == {1: 4, 2: 2, 3: 0}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_spreads_hot_keys(spark, how):
    # Key 0 holds a third of the rows, and another third has no key at all.
    uses = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0)
        .when(F.col("id") % 3 == 1, F.col("id"))
        .cast("long")
        .alias("key"),
    )
    lookup = spark.range(2000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    plain = uses.join(lookup, "key", how)
    found = lookup_join(uses, lookup, "key", how, hot_rows=50)
    assert found.columns == plain.columns
    assert sorted(found.collect(), key=str) == sorted(plain.collect(), key=str)
    assert "_salt" in found._jdf.queryExecution().analyzed().toString()
