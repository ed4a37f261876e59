import hashlib
from collections import Counter
from functools import partial

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import fixtures
from ragtables.llm import alignment

public_tokenizers = pytest.importorskip("public_tokenizers")
MAKE_A = partial(alignment.byte_level, public_tokenizers.path("byte_bpe_50k.json"))
MAKE_B = partial(alignment.sentence_pieces, public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def sides():
    return MAKE_A(), MAKE_B()


def plain(texts, sides):
    """Rows by whole texts and offsets, without units, pointers or packed pairs."""
    a, b = sides
    docs, links = [], []
    for text in texts:
        ids_a = a.encode([text])[0] if text else []
        ids_b = b.encode([text])[0] if text else []
        want = b" " + (text or "").encode()
        if not text or any(
            b"".join(s.pieces[i] for i in ids) != want for s, ids in zip(sides, (ids_a, ids_b))
        ):
            docs.append((0, 0, 0, ""))
            links.append([])
            continue
        ends = [np.cumsum([len(s.pieces[i]) for i in ids]).tolist() for s, ids in zip(sides, (ids_a, ids_b))]
        groups, pairs, i, j = [], [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            k, m = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
            groups.append(",".join(map(str, ids_a[i:k])) + "|" + ",".join(map(str, ids_b[j:m])))
            pairs.append((ids_a[k - 1], ids_b[m - 1]))
            i, j = k, m
        docs.append((len(ids_a), len(ids_b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append(pairs)
    count = Counter(p for pairs in links for p in pairs)
    most = {}
    for (x, y), n in count.items():
        most[y] = max(most.get(y, 0), n)
    return [
        (n_a, n_b, n, n, sum(count[p] == most[p[1]] for p in pairs), sum(count[p] for p in pairs), digest)
        for (n_a, n_b, n, digest), pairs in zip(docs, links)
    ]


def found(df):
    rows = alignment.align_tokens(df, MAKE_A, MAKE_B).collect()
    return sorted(map(str, rows)), rows


ODD = [
    "<|endoftext|> and <s> or </s>", " leading", "trailing ", "a  b   c", "tab\there", "line\nbreak\r\n", "naïve café déjà",
    "日本語 の テキスト", "emoji 🙂👍🏽 done", "it's we'll I've", "x\u00a0y z", "zero\x00byte here", "1 234 567,89", "a ▁ b ▁c", "\ufffd \u0301x",
    "<0x41> <unk> x", " ", "  ", "\n", "don't  stop ...  now !!", "e\u0301 a \u0301b",
]


@pytest.mark.parametrize("frequent", [alignment.SENT_PAIRS, 40, 0])
def test_like_whole_texts(spark, sides, monkeypatch, frequent):
    """Also with few or no pairs sent to the tasks, the others joined."""
    monkeypatch.setattr(alignment, "SENT_PAIRS", frequent)
    texts = [t for t in (r[1] for r in fixtures.rows()) if t is None or len(t) < 20_000] + ODD
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    _, rows = found(df)
    got = {r.doc_id: tuple(r)[1:] for r in rows}
    assert got == dict(enumerate(plain(texts, sides)))


def test_little_memory_changes_nothing(spark, odd, monkeypatch, sides):
    make, cells = alignment._aligned(MAKE_A, MAKE_B), []
    monkeypatch.setattr(alignment, "MEMORY_BYTES", 1)
    batches = odd.select("doc_id", "text").toArrow().to_batches()
    for _ in range(2):
        cells.append([b.to_pydict() for b in make(iter(batches))])
        monkeypatch.setattr(alignment, "MEMORY_BYTES", 10**9)
    assert cells[0] == cells[1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=40), st.randoms())
def test_terminals(sizes, draw):
    ends_a = np.cumsum(sizes)
    inner = [p for p in range(1, int(ends_a[-1])) if draw.random() < 0.4]
    ends_b = np.array([*inner, int(ends_a[-1])])
    label_a, label_b = alignment.terminals(ends_a, ends_b)
    common = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    for ends, label in ((ends_a, label_a), (ends_b, label_b)):
        for end, own in zip(ends, label):
            assert ends_a[own] == next(c for c in common if c >= end)


def test_one_long_component():
    ends_a = np.append(np.arange(2, 200_001, 2), 200_001)
    ends_b = np.append(np.arange(1, 200_000, 2), 200_001)
    label_a, label_b = alignment.terminals(ends_a, ends_b)
    assert len(set(label_a.tolist()) | set(label_b.tolist())) == 1


def test_special_strings_are_plain_text(sides):
    assert 50256 not in sides[0].encode(["<|endoftext|>"])[0]


def test_ids_repeated_clashing_columns_and_no_rows(spark, odd, none):
    assert alignment.align_tokens(odd, MAKE_A, MAKE_B).count() == odd.count()
    assert alignment.align_tokens(none, MAKE_A, MAKE_B).count() == 0
    clash = odd.selectExpr("doc_id", "text", "1 AS pairs", "2 AS row", "3 AS n", "4 AS best", "5 AS n_a")
    assert found(clash)[0] == found(odd)[0]
