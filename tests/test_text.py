import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from ragtables.functions import text

ODD = [
    "",
    "   ",
    "The cat, a dog -- an owl!",
    "A-the an",
    "bananas and theatre",
    "know\tyes\x1cno\x85x y　z",
    "á thé école",
    "« a » —the—",
    "the_the a_b",
    "İSTANBUL ΟΔΟΣ É",
    "x\r\ny\n\nthe",
    "a1 1a a 1",
]


def random_texts(count=300, seed=1):
    rng = random.Random(seed)
    pieces = ["a", "an", "the", "The", "cat", "é", "é", "1", " ", "  ", "\n",
              "\t", ".", ",", "-", "_", "—", " ", "\x1d", "no", "yes", "а"]
    return ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(count)]


def column(spark, values, make):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, t string").repartition(4)
    return [r[1] for r in sorted(df.select("i", make(F.col("t"))).collect())]


# Worked by hand.
NORMALIZED = {
    "": "",
    "  \t\n ": "",
    "The cat, the dog!": "cat dog",
    "A  an THE": "",
    "an apple a day": "apple day",
    "theory of a-n": "theory of",
    "U.S.A.": "usa",
    "the_cat": "thecat",
    "—the—": "— —",
    "a1 a": "a1",
    "x\x1dthe\x1dy": "x y",
    "Élan the Été": "élan été",
    "another atheist": "another atheist",
    "(a) {b} [c] 'the' \"an\"": "b c",
    "1,000.5 %": "10005",
}


def test_normalize_text(spark):
    values = list(NORMALIZED)
    assert column(spark, values, text.normalize_text) == list(NORMALIZED.values())


def test_tokenize_equals_regex(spark):
    regex = pytest.importorskip("regex")
    pattern = regex.compile(r"([\p{L}\p{N}\p{M}]+)|([^\p{Z}\p{C}])")
    values = ODD + random_texts(seed=2)
    wanted = [[m.group().lower() for m in pattern.finditer(v)] for v in values]
    assert column(spark, values, text.tokenize) == wanted


def test_decompose(spark):
    values = ODD + random_texts(seed=3) + [None]
    wanted = [v and unicodedata.normalize("NFD", v) for v in values]
    assert column(spark, values, text.decompose) == wanted


def test_decompose_all(spark):
    df = spark.createDataFrame(
        [(["é", "x", None],), (["x"],), ([],), (None,)], "t array<string>"
    )
    found = [r[0] for r in df.select(text.decompose_all("t")).collect()]
    assert found == [["é", "x", None], ["x"], [], None]


@pytest.mark.parametrize(
    "capture, stop, value, wanted",
    [
        ("<ANSWER>: (.*)", "[,.;]", "so\n<ANSWER>: Rome, Italy", "Rome"),
        ("<ANSWER>: (.*)", None, "<ANSWER>: one\ntwo", "one\ntwo"),
        ("<ANSWER>: (.*)", None, "nothing here", "nothing here"),
        ("^b(.)$", None, "a\nbc\nd", "c"),
        ("(x*)y", None, "ay", ""),
        ("", "", "as. is", "as. is"),
        (None, "[,.;]", ".starts with a stop", ""),
        (None, "(and|or)", "this and that or", "this "),
        (r"n=(\d+)", None, "n=٣٤", "٣٤"),
        (None, "a.b", "xa\rby", "x"),
    ],
)
def test_regex_answer(spark, capture, stop, value, wanted):
    assert column(spark, [value], text.regex_answer(capture, stop)) == [wanted]


def test_regex_answer_refuses(spark):
    with pytest.raises(ValueError):
        text.regex_answer(None, "x*")
    with pytest.raises(ValueError):
        text.regex_answer("no group")


def test_clean_document(spark):
    values = ["a  b\t c\n\n  \n d ", "", "\n\n", "one"]
    assert column(spark, values, text.clean_document) == ["a b c\nd", "", "", "one"]


@pytest.mark.parametrize("length, overlap", [(200, 20), (3, 1), (2, 0), (5, 4)])
def test_chunk_words(spark, length, overlap):
    counts = [0, 1, 2, 3, 4, 5, 6, 7, 199, 200, 201, 380, 381, 1000]
    values = [" ".join(f"w{i}" for i in range(n)) for n in counts]

    def windows(value):
        parts, step, made, start = value.split(" ") if value else [], length - overlap, [], 0
        while parts:
            made.append(" ".join(parts[start : start + length]))
            if start + length >= len(parts):
                break
            start += step
        return made

    found = column(spark, values, lambda c: text.chunk_words(c, length, overlap))
    assert found == [windows(v) for v in values]


def test_chunk_words_checks_its_numbers():
    with pytest.raises(ValueError):
        text.chunk_words("t", 20, 20)
