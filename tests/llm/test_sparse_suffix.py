import collections
import random

import pytest

import fixtures
from ragtables.llm import sparse_suffix as ss


def plain(rows, least):
    """Maximal runs of windows that another document has too."""
    docs = sorted({(r[0], r[1]) for r in rows}, key=str)
    holders = collections.defaultdict(set)
    for n, (_, text) in enumerate(docs):
        w = fixtures.spaced(text)
        for i in range(len(w) - least + 1):
            holders[tuple(w[i : i + least])].add(n)
    out = []
    for doc_id, text in docs:
        w = fixtures.spaced(text)
        run = None
        for i in range(len(w) - least + 2):
            shared = i <= len(w) - least and len(holders[tuple(w[i : i + least])]) > 1
            if shared and run is None:
                run = i
            if not shared and run is not None:
                out.append((str(doc_id), run, i - 2 + least))
                run = None
    return sorted(out)


def found(df):
    return sorted((str(r.doc_id), r.first_word, r.last_word) for r in df.collect())


@pytest.mark.parametrize("hot", [2, 20_000])
def test_matches_all_windows(odd, monkeypatch, hot):
    monkeypatch.setattr(ss, "HOT", hot)
    want = plain(fixtures.rows(), 50)
    assert len(want) > 10 and found(ss.shared_passages(odd)) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_mixed_pieces(spark, monkeypatch, seed):
    """Documents cut from common passages at random, so that matches of all lengths
    and partners overlap; batches are small, so that grams lie at their ends."""
    monkeypatch.setattr(ss, "BATCH", 40)
    draw = random.Random(seed)
    pool = [[f"p{p}w{i}" for i in range(90)] for p in range(6)]
    rows = []
    for n in range(60):
        words = []
        for _ in range(draw.randint(1, 4)):
            passage, a = draw.choice(pool), draw.randint(0, 50)
            words += passage[a : a + draw.randint(20, 90)] + [f"d{n}x{draw.randint(0, 9)}"]
        rows.append((n, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(ss.shared_passages(docs)) == plain(rows, 50)


@pytest.mark.parametrize("hot", [2, 20_000])
def test_copies_are_exact(spark, monkeypatch, hot):
    monkeypatch.setattr(ss, "HOT", hot)
    rows, want = [], {}
    for p, n in enumerate((150, 233, 310)):
        passage = " ".join(f"p{p}w{i}" for i in range(60))
        for i in range(n):
            rows += [(len(rows), f"d{len(rows)} {passage} {passage}")]
            want[rows[-1][0]] = n
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.copies for r in ss.shared_passages(docs).collect()} == want


def test_empty_table(none):
    assert ss.shared_passages(none).count() == 0
