import numpy as np
import pytest

import fixtures
from ragtables.llm import ngram_join as nj
from ragtables.llm.connected import components
from ragtables.llm.ngram_join import ngram_join, one_of_each


def test_matches_all_pairs(odd):
    rows = fixtures.rows()
    group = fixtures.groups([r[1] for r in rows])
    least = {}
    for r, g in zip(rows, group):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    want = sorted(
        (str(r[0]), len(fixtures.shingles(r[1])), str(least.get(g, r[0]))) for r, g in zip(rows, group)
    )
    found = ngram_join(odd).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == want


def test_texts_without_words_stay_alone(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " "), (4, "a"), (5, "a")], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_join(docs).collect()}
    assert found == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4}


def test_one_of_each_keeps_all_columns_and_clean_rows(odd):
    rows = fixtures.rows()
    group = fixtures.groups([r[1] for r in rows])
    kept = one_of_each(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    least = {}
    for r, g in zip(rows, group):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    want = sorted(set(least.values()))
    assert sorted(i for i in ids if i is not None) == want and ids.count(None) == 2


def test_one_of_each_with_repeated_ids(spark):
    words = [f"w{i}" for i in range(60)]
    one, other = " ".join(words), " ".join(f"x{i}" for i in range(60))
    rows = [(1, one), (1, one.upper()), (1, one.replace(" ", "  ")), (1, one), (2, one + " end"), (1, other), (7, other)]
    kept = one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # One document a component, also where two components have the same least id.
    assert sorted((r.doc_id, r.text.split()[0].lower()) for r in kept) == [(1, "w0"), (1, "x0")]


def test_empty_table(none):
    assert ngram_join(none).count() == 0 and one_of_each(none).count() == 0


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """A chain in which neighbours are linked and far ones are not, dealt to parts."""
    monkeypatch.setattr(nj, "HOT", 4)
    monkeypatch.setattr(nj, "ROUNDS", 1)
    monkeypatch.setattr(nj, "GROUP", 7)
    monkeypatch.setattr(nj, "BATCH", 50)
    words = [f"w{i}" for i in range(700)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 100])) for i in range(200)]
    rows += [(1000 + i, " ".join(f"u{i}_{j}" for j in range(20))) for i in range(50)]
    found = ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in found if r.doc_id < 1000} == {0}
    assert all(r.component_id == r.doc_id for r in found if r.doc_id >= 1000)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_similar_sets_share_enough_of_their_prefixes(seed):
    draw = np.random.default_rng(seed)
    levels = nj.Frequencies(
        draw.integers(0, 20, nj.BUCKETS).astype(np.uint8), draw.integers(0, 9, nj.FINE).astype(np.uint8)
    )
    for _ in range(200):
        n = int(draw.integers(1, 120))
        a = np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64))
        b = a.copy()
        edits = int(draw.integers(0, 1 + n // 8))
        b[draw.choice(len(b), min(edits, len(b)), replace=False)] = draw.integers(0, 1 << 63, min(edits, len(b)), dtype=np.uint64)
        b = np.unique(b)
        shared = len(np.intersect1d(a, b))
        if 100 * shared < 80 * (len(a) + len(b) - shared):
            continue
        la, pa, _ = nj._prefix(a, levels)
        lb, pb, _ = nj._prefix(b, levels)
        assert len(np.intersect1d(pa, pb)) >= min(la, lb)
        apart = nj._apart(nj._signature(a), nj._signature(b))
        assert apart <= len(a) + len(b) - 2 * shared
        assert 180 * apart <= 20 * (len(a) + len(b))


def test_short_signatures_keep_links_and_part_most_others():
    draw = np.random.default_rng(4)
    base = [np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (3, 60, 700, 1_500, 9_000, 40_000)]
    sets = []
    for b in base:
        near = b.copy()
        near[: len(b) // 10] = draw.integers(0, 1 << 63, len(b) // 10, dtype=np.uint64)
        sets += [b, np.unique(near), np.unique(draw.integers(0, 1 << 63, len(b), dtype=np.uint64))]
    signed = nj._Signatures([nj._short(s) for s in sets])
    x, y = (i.ravel() for i in np.meshgrid(range(len(sets)), range(len(sets))))
    size = np.array([len(s) for s in sets])
    near = signed.near(x, y, size[x] + size[y])
    for i, j, kept in zip(x.tolist(), y.tolist(), near):
        shared = len(np.intersect1d(sets[i], sets[j]))
        if 100 * shared >= 80 * (size[i] + size[j] - shared):
            assert kept
        elif 60 <= size[i] < 10_000 and 80 * size[i] <= 100 * size[j] <= 125 * size[i]:
            assert not kept


def test_columns_with_the_helpers_names_stay(spark):
    text = "one two three four five six seven"
    rows = [(1, text, "x", "y"), (2, text, "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, extra_id_ string, Extra_Hash_ string")
    assert [tuple(r) for r in nj.one_of_each(df).collect()] == rows[:1]


def test_components(spark):
    links = [(1, 2), (3, 2), (5, 4), (7, 7), (None, 1)] + [(100 + i, 101 + i) for i in range(60)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    roots = {r.node: r.root for r in found}
    assert len(found) == len(roots)
    assert roots == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4} | {100 + i: 100 for i in range(61)}
