import numpy as np
import pytest
from pyspark.sql import functions as F

from ragtables.operators import codes, retrieval
from test_retrieval import frame, rows, search


@pytest.fixture(scope="module")
def vectors():
    made = np.random.default_rng(5).normal(size=(300, 10)).astype(np.float32)
    made[40:140] = made[40]  # a third of the corpus are copies of one vector
    made[200] = 0
    return made


@pytest.fixture(scope="module")
def coded(spark, vectors):
    df = frame(spark, list(range(300)), vectors)
    book = codes.learn_codebook(df, 4, "id")
    return df, book, codes.encode_vectors(df, book).select("id", "code")


def approximate(book, queries, docs):
    """Scores by decoding each code, in plain loops."""
    out = np.zeros((len(queries), len(docs)))
    for j, doc in enumerate(docs):
        at, decoded = 0, []
        for centres in book.centres:
            part = doc[at : at + centres.shape[1]]
            at += centres.shape[1]
            decoded += centres[int(np.argmin([((part - c) ** 2).sum() for c in centres]))].tolist()
        for i, query in enumerate(queries):
            out[i, j] = sum(float(a) * b for a, b in zip(query, decoded))
    return out


def test_codes_are_the_nearest_centres_of_uneven_parts(coded, vectors):
    df, book, table = coded
    assert [c.shape[1] for c in book.centres] == [3, 3, 2, 2]
    stored = {r["id"]: list(r["code"]) for r in table.collect()}
    for i, vector in enumerate(vectors[:150:7]):
        at = 0
        for part, centres in enumerate(book.centres):
            own = vector[at : at + centres.shape[1]].astype(np.float64)
            at += centres.shape[1]
            far = ((centres - own) ** 2).sum(axis=1)
            assert far[stored[7 * i][part]] == pytest.approx(far.min())


@pytest.mark.parametrize("block", [codes.SCORES, 900])
def test_candidates_are_those_of_plain_decoding(coded, vectors, monkeypatch, block):
    monkeypatch.setattr(codes, "SCORES", block)  # several blocks a batch
    df, book, table = coded
    near = codes.code_topk(
        df.filter("id < 30"), df, table, book, 5, 12, "id", "id", skip_equal_ids=True, exact_scores=False
    )
    want = approximate(book, vectors[:30], vectors)
    found = {}
    for r in near.collect():
        found.setdefault(r.query_id, []).append((r.rank, r.doc_id, r.score))
    for query in range(30):
        scores = {d: want[query, d] for d in range(300) if d != query}
        got = sorted(found[query])
        assert len(got) == 12 and query not in [d for _, d, _ in got]
        assert [s for _, _, s in got] == pytest.approx(sorted(scores.values(), reverse=True)[:12])
        assert all(s == pytest.approx(scores[d]) for _, d, s in got)


def test_a_task_holds_a_bounded_number_of_candidates(coded, vectors, monkeypatch):
    sent = []

    class Counted(codes._Sent):
        def __init__(self, *given):
            super().__init__(*given)
            sent.append(len(self.ids))

    monkeypatch.setattr(codes, "HELD_CANDIDATES", 240, raising=False)
    monkeypatch.setattr(codes, "_Sent", Counted)
    df, book, table = coded
    asked = df.filter("id < 9")
    found = codes.code_topk(asked, df, table, book, 6, 80, "id", "id", exact_scores=False)
    assert len(found.collect()) == 9 * 80
    assert sum(sent) == 9 and max(sent) * 80 <= 240


@pytest.mark.parametrize("numbers", [codes.TABLE_NUMBERS, 50_000])
def test_with_all_candidates_the_search_is_exact(coded, vectors, numbers):
    df, book, table = coded
    ids = list(range(300))
    found = codes.code_topk(
        df, df, table, book, 6, 300, "id", "id", skip_equal_ids=True, table_numbers=numbers
    )
    assert rows(found) == search(ids, vectors, ids, vectors, 6, True)


def test_few_candidates_find_most_and_read_little(spark):
    made = np.random.default_rng(6).normal(size=(3000, 32)).astype(np.float32)
    df = frame(spark, list(range(3000)), made)
    book = codes.learn_codebook(df, 8, "id")
    table = codes.encode_vectors(df, book).select("id", "code")
    asked = df.filter("id % 300 = 0")
    many, said = codes.candidates_for_recall(asked, df, table, book, 10, 0.9, "id", "id", skip_equal_ids=True)
    exact = retrieval.dense_topk(asked, df, 10, "id", "id", skip_equal_ids=True)

    def recall(n, k=10):
        found = codes.code_topk(asked, df, table, book, k, n, "id", "id", skip_equal_ids=True)
        return retrieval.recall_at_k(found, exact).first().recall

    assert said >= 0.9 and recall(many) == pytest.approx(said)
    assert many == 10 or recall(many - 1) < 0.9
    assert recall(None) >= 0.9
    near = codes.code_topk(
        asked, df, table, book, 10, many, "id", "id", skip_equal_ids=True, exact_scores=False
    )
    share = codes.read_share(near, 3000, book)
    distinct = len({r.doc_id for r in near.collect()})
    assert share == pytest.approx(8 / 128 + distinct / 3000) and share < 0.5


def test_learning_repeats_and_is_stored(spark, coded):
    df, book, _ = coded
    again = codes.learn_codebook(df.repartition(5), 4, "id")
    stored = codes.codebook_from(book.to_table(spark))
    for other in (again, stored):
        assert all(np.array_equal(a, b) for a, b in zip(book.centres, other.centres))
    small = codes.learn_codebook(df, 4, "id", learning_rows=30)
    assert all(len(c) < 100 for c in small.centres)
    with pytest.raises(ValueError, match="cannot be cut"):
        codes.learn_codebook(df, 11, "id")


def test_broken_vectors_are_named_or_have_no_code(spark, coded, vectors):
    df, book, _ = coded
    bad = spark.createDataFrame([(777, None), (778, [1.0] * 9)], df.schema)
    mixed = df.unionByName(bad)
    with pytest.raises(Exception, match="10 finite numbers"):
        codes.encode_vectors(mixed, book).collect()
    table = codes.encode_vectors(mixed, book, skip_invalid=True).select("id", "code")
    assert {r["id"] for r in table.filter("code is null").collect()} == {777, 778}
    with pytest.raises(Exception, match="777|778"):
        codes.code_topk(mixed, mixed, table, book, 3, 9, "id", "id").collect()
    found = codes.code_topk(mixed, mixed, table, book, 3, 302, "id", "id", skip_invalid=True)
    ids = list(range(300))
    assert rows(found) == search(ids, vectors, ids, vectors, 3, False)


def test_string_ids_and_empty_sides(spark, coded, vectors):
    df, book, table = coded
    name = F.format_string("d%03d", "id").alias("id")
    docs, cells = df.select(name, "embedding"), table.select(name, "code")
    asked = df.filter("id < 3")
    found = codes.code_topk(asked, docs, cells, book, 4, 300, "id", "id")
    names = [f"d{i:03}" for i in range(300)]
    assert rows(found) == search([0, 1, 2], vectors[:3], names, vectors, 4, False)
    none, no_codes = df.filter("id < 0"), table.filter("id < 0")
    assert codes.code_topk(none, df, table, book, 3, 9, "id", "id").count() == 0
    assert codes.code_topk(df, none, no_codes, book, 3, 9, "id", "id").count() == 0
    assert codes.candidates_for_recall(none, df, table, book, 3, 0.9, "id", "id") == (3, 1.0)
    assert codes.learn_codebook(none, 1, "id").centres[0].shape == (1, 1)
