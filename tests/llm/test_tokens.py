import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import fixtures
from ragtables.llm import rans, token_store
from ragtables.llm.token_store import WordEncoder, read_span, read_tokens, write_tokens
from ragtables.sources.storage import fresh_path

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("n", [0, 1, 7, 200, 5_000, 600_000])
def test_blocks_round_trip(n):
    draw = np.random.default_rng(n)
    ids = np.minimum(draw.zipf(1.3, n), 49_000).astype(np.uint32)
    table = rans.Table.from_counts(np.bincount(ids, minlength=10))
    block = rans.encode(ids, table)
    decoder = rans.Decoder(table)
    assert (decoder.decode(block) == ids).all()
    lanes, count, steps, segments = decoder.open(block)
    assert count == n
    for s in reversed(range(segments)):  # each segment by itself
        assert (decoder.segment(block, s) == ids[s * steps * lanes : (s + 1) * steps * lanes]).all()


def test_damage_is_noticed():
    ids = np.arange(5_000, dtype=np.uint32) % 50
    table = rans.Table.from_counts(np.bincount(ids))
    block = bytearray(rans.encode(ids, table))
    block[len(block) // 2] ^= 4
    with pytest.raises(ValueError):
        rans.Decoder(table).decode(bytes(block))
    other = rans.Table.from_counts(np.bincount(ids) + np.arange(50))
    with pytest.raises(ValueError):
        rans.Decoder(other).decode(rans.encode(ids, table))


def test_rare_ids_keep_a_frequency():
    counts = np.ones(60_000, np.int64)
    counts[7] = 10**12
    table = rans.Table.from_counts(counts)
    assert table.frequencies.min() == 1 and table.frequencies.sum() == 1 << rans.PRECISION
    one = rans.Table.from_counts(np.array([0, 0, 5]))
    ids = np.full(3_000, 2, np.uint32)
    assert (rans.Decoder(one).decode(rans.encode(ids, one)) == ids).all()


def encoded(encoder, texts):
    out = []
    for start, rows in encoder.encode(pa.array(texts, pa.string()), 2):
        assert start == len(out)
        out += [r.tolist() for r in rows]
    return out


@pytest.fixture(scope="module", params=["word_bpe_49k.json", "byte_bpe_50k.json"])
def pair(request):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(request.param)
    return Tokenizer.from_file(path), WordEncoder(path)


SAMPLES = [
    None, "", " ", "Hello  World\n\tAGAIN", "<|endoftext|> <|ENDOFTEXT|> a<|endoftext|>b", "x\u00a0y\u2003z \u0301a e\u0301",
    "caf\u00c9 STRASSE \u1e9e \u0130", "it's we'll 12 345 ...!?", "\u65e5\u672c\u8a9e text", "\x00\x1c\x85", "a" * 3_000,
]


def test_what_parts_words(pair):
    """A file that keeps spaces must not be taken for one that drops them."""
    tokenizer, encoder = pair
    assert encoder.by_word == (tokenizer.get_vocab_size() == 49_408)


def test_samples_encode_like_whole_texts(pair):
    tokenizer, encoder = pair
    for samples in ([t for t in SAMPLES if "<|" not in (t or "")], SAMPLES, SAMPLES):  # the last from memory
        want = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in samples]
        assert encoded(encoder, samples) == want
    assert encoded(encoder, []) == []


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.text(st.characters(exclude_categories=["Cs"]), max_size=40)
        | st.text("aZs't.,-'\u00e9\u0301 1<|>\n", max_size=30),
        max_size=5,
    )
)
def test_words_encode_like_whole_texts(pair, texts):
    tokenizer, encoder = pair
    want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert encoded(encoder, texts) == want


def test_forgetting_changes_nothing(monkeypatch, tokenizer):
    monkeypatch.setattr(token_store, "REMEMBERED_BYTES", 100)
    monkeypatch.setattr(token_store, "PIECE_BYTES", 50)
    encoder = WordEncoder(PATH)
    texts = [f"some words {i % 7} again and again {i}" for i in range(60)]
    assert encoded(encoder, texts) == [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]


def test_a_store_of_another_tokenizer(spark, odd):
    from tokenizers import Tokenizer

    path, file = fresh_path(spark, "test"), public_tokenizers.path("byte_bpe_50k.json")
    write_tokens(odd, path, file)
    whole = Tokenizer.from_file(file)
    want = sorted(len(whole.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in fixtures.rows())
    assert sorted(r.n_tokens for r in read_tokens(spark, path).collect()) == want


def test_store_matches_the_library(spark, odd, tokenizer):
    path = fresh_path(spark, "test")
    write_tokens(odd, path, PATH, block_ids=1_000)
    rows = sorted(fixtures.rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    want, start, whole = {}, 0, []
    wide = []
    for r in rows:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        wide.append((str(r[0]), len(ids), crc))
        if r[0] is not None:
            want.setdefault(str(r[0]), set()).add(start)
        start += len(ids)
        whole += ids
    got = read_tokens(spark, path, with_ids=True).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(wide)
    assert all(r.start in want[str(r.doc_id)] for r in got if r.doc_id is not None)
    by_start = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(by_start, by_start[1:]))
    assert spark.read.parquet(f"{path}/blocks").count() > 3
    # A span needs only the segments in reach. Rows without an id may stand in either order.
    first = max(s for s, n in by_start[:3]) + 50
    pieces = read_span(spark, path, first, first + 4_000).orderBy("start").collect()
    assert pieces[0].start == first
    ids = np.concatenate([np.frombuffer(p.ids, "<u4") for p in pieces])
    assert ids.tolist() == whole[first : first + 4_000]


def test_empty_table(spark, none):
    path = fresh_path(spark, "test")
    write_tokens(none, path, PATH)
    assert read_tokens(spark, path).count() == 0


def test_copies_side_by_side(spark, tokenizer):
    """Runs of equal rows travel once and are stored as often as they stood there."""
    again = [(4, "one two three")] * 7 + [(4, "one two")] + [(4, "one two three")] * 2
    rows = again + [(None, "x y")] * 3 + [(5, None)] * 3 + [(5, "")] * 2 + [(6, "a " * 90)] * 40
    path = fresh_path(spark, "test")
    write_tokens(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), path, PATH, block_ids=500)
    got = read_tokens(spark, path, with_ids=True).orderBy("start").collect()
    want = [
        (i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows
    ]
    found = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got]
    by_id = [r[0] for r in found]
    assert by_id == sorted(by_id, key=lambda i: -1 if i is None else i)
    key = lambda r: (-1 if r[0] is None else r[0], r[1])
    assert sorted(found, key=key) == sorted(want, key=key)
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got][:-1]]).tolist()


def test_runs_of_rows():
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": pa.array([1, 1, 2, 2, None, None, 3]), "text": pa.array(["a", "a", "a", "b", "c", "c", None])}
    )
    first, copies = token_store._runs(batch)
    assert first["doc_id"].to_pylist() == [1, 2, 2, None, None, 3]
    assert copies.tolist() == [2, 1, 1, 1, 1, 1]
    assert token_store._runs(batch.slice(0, 0))[1].tolist() == []
