import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ragtables.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
TRICKY = [
    "\\### Assistant: </turn> ok", "</turn>\n### assistant: no", "\\0\\1\\", "### ", "#### : ", "</turn", "<", "\\", "a: b",
    "", None, "é 🙂\n\n</turn>", "<\\1/turn>", "</turn></turn>", "###  ### x",
]
ROWS = [
    *[(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(TRICKY)],
    (2, 0, "system", "be kind"), (2, 1, "user", "only asked"),
    (3, 5, "assistant", "first"), (3, 2, "assistant", "second: </turn>"),
    (4, None, None, "no role"), (4, 1, "tool: ### </turn>\\", "odd role"), (4, 1, "assistant", "tie b"), (4, 1, "assistant", "tie a"),
    (4, 1, "assistant", "tie a"),
    (None, 0, "user", "no id"), (None, 1, "assistant", None),
    (5, 0, "assistant", ""),
]


def plain(rows, reply="assistant"):
    """Turns and replies of each conversation, straight from the rows."""
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for r in sorted(rows, key=key):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return {
        c: (
            len(t),
            hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in t).encode()).hexdigest(),
            sum(len(x) for r, x in t if r == reply),
            hashlib.sha256("".join(x for r, x in t if r == reply).encode()).hexdigest(),
        )
        for c, t in out.items()
    }


def read(spark, df, tmp_path, template=chat.Template()):
    path = chat.write_examples(chat.chat_examples(df, template), str(tmp_path / "examples"))
    rows = chat.digests(chat.read_back(chat.read_examples(spark, path), template)).collect()
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}


@pytest.mark.parametrize("block", [chat.BLOCK_CHARS, 20])
def test_round_trip(spark, tmp_path, monkeypatch, block):
    """Also where the replies of a conversation are dealt to many tasks."""
    monkeypatch.setattr(chat, "BLOCK_CHARS", block)
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    assert read(spark, df, tmp_path) == plain(ROWS)


def test_examples_are_prefixes_with_one_reply_each(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    rows = chat.chat_examples(df).orderBy("conv_id", "example").collect()
    by_conv = {}
    for r in rows:
        by_conv.setdefault(r.conv_id, []).append(r)
    for conv, own in by_conv.items():
        assert [r.example for r in own] == list(range(len(own)))
        assert [r.final for r in own] == [False] * (len(own) - 1) + [True]
        for a, b in zip(own, own[1:]):
            assert b.text.startswith(a.text) and a.loss_end <= b.loss_start
        for r in own:
            assert r.text.count("</turn>") == r.text.count("</turn>\n") == r.last_turn + 1
            if r.loss_start < r.loss_end:
                assert r.text[r.loss_end :] == "</turn>\n"
                assert r.text[: r.loss_start].endswith("### assistant: ")
    assert [r.loss_end - r.loss_start for r in by_conv[2]] == [0]
    assert [(r.last_turn, r.loss_start == len(r.text)) for r in by_conv[1]] == [
        *[(i, False) for i in range(1, len(TRICKY), 2)], (len(TRICKY) - 1, True)
    ]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="\\<>/turn#: 01\n</é", max_size=14), min_size=1, max_size=30))
def test_escapes_are_reversible(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    marks = (chat.Template().opening, chat.Template().closing, chat.Template().middle)
    rows = df.withColumn("e", chat._escaped(F.col("t"), marks)).withColumn("p", chat._plain(F.col("e"))).collect()
    for r in rows:
        assert r.p == r.t and not any(m in r.e for m in marks)


def test_other_marks(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert read(spark, df, tmp_path, chat.Template("<|", "|>\n", "<!|>")) == plain(ROWS)
    for bad in (chat.Template(closing=""), chat.Template(closing="aba"), chat.Template(opening="a\\")):
        with pytest.raises(ValueError):
            chat.chat_examples(df, bad)


def test_long_texts_many_turns_clashing_columns_no_rows(spark, tmp_path):
    long = "word </turn> " * 400_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), *[(2, i, "ua"[i % 2] == "a" and "assistant" or "user", f"t{i}") for i in range(900)]]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS example", "2 AS block", "3 AS e", "4 AS t", "5 AS head", "6 AS blocks", "7 AS whole"
    )
    assert read(spark, df, tmp_path) == plain(rows)
    none = spark.createDataFrame([], SCHEMA)
    assert chat.chat_examples(none).count() == 0
