import random
import tracemalloc
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_text import ODD, random_texts

from ragtables.functions import scores


def pairs(seed, count=150):
    rng = random.Random(seed)
    values = ODD + random_texts(seed=seed)
    return [
        (rng.choice(values), [rng.choice(values) for _ in range(rng.randint(0, 3))])
        for _ in range(count)
    ]


def score(spark, rows, column):
    rows = [(i, p, r) for i, (p, r) in enumerate(rows)]
    df = spark.createDataFrame(rows, "i int, p string, r array<string>").repartition(3)
    return [r[1] for r in sorted(df.select("i", column).collect())]


# Worked by hand: answer, references, F1, exact match.
JUDGED = [
    ("the cat sat", ["cat sat"], 1, 1),
    ("cat dog", ["cat"], 2 / 3, 0),
    ("cat dog", ["The cat!", "bird"], 2 / 3, 0),
    ("cat cat dog", ["cat dog dog"], 2 / 3, 0),
    ("x y z w", ["x"], 0.4, 0),
    ("red apple", ["green pear", "apple"], 2 / 3, 0),
    ("The Cat!", ["dog", "cat"], 1, 1),
    ("cat.", ["a cat"], 1, 1),
    ("dog cat", ["cat dog"], 1, 0),
    ("cats", ["cat"], 0, 0),
    ("", ["the"], 0, 1),
    ("", ["x"], 0, 0),
    ("x", [], 0, 0),
]


def test_f1(spark):
    rows = [(p, rs) for p, rs, _, _ in JUDGED]
    assert score(spark, rows, scores.f1("p", "r")) == pytest.approx([f for *_, f, _ in JUDGED])


def test_exact_match(spark):
    rows = [(p, rs) for p, rs, _, _ in JUDGED]
    assert score(spark, rows, scores.exact_match("p", "r")) == [e for *_, e in JUDGED]


def test_string_match_takes_candidates_as_they_are(spark):
    df = spark.createDataFrame(
        [
            ("The Rome of Italy", [["Rome", "rome"], ["italy"], ["paris"]]),
            ("Rome", [["Rome"]]),
            ("Rome", []),
            ("x", [[], [""]]),
        ],
        "p string, g array<array<string>>",
    )
    found = [r[0] for r in df.select(scores.string_match("p", "g")).collect()]
    assert found == [2 / 3, 0.0, 0.0, 0.5]


# Worked by hand: answer, references, whether one stands in it as whole tokens.
RECALLED = [
    ("The capital is New York City.", ["new york"], 1),
    ("The capital is New York City.", ["new city"], 0),
    ("The capital is New York City.", ["york, city"], 0),
    ("The capital is New York City.", ["york city ."], 1),
    ("The capital is New York City.", ["CITY"], 1),
    ("The capital is New York City.", ["cit"], 0),
    ("The capital is New York City.", ["rome", "is new"], 1),
    ("a b a c", ["a c"], 1),
    ("a b", ["a b c"], 0),
    ("well-known", ["well - known"], 1),
    ("well-known", ["well known"], 0),
    ("x", [], 0),
    ("", ["x"], 0),
]


def test_recall_match(spark):
    rows = [(p, rs) for p, rs, _ in RECALLED]
    assert score(spark, rows, scores.recall_match("p", "r")) == [w for *_, w in RECALLED]


def test_yes_no_class(spark):
    values = ["yes", "I know", "yes and no", "maybe", "eyes", ""]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    found = [r[0] for r in df.select(scores.yes_no_class("t")).collect()]
    assert found == [1, 0, 1, 2, 1, 2]


def table(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            rows[i][j] = (
                rows[i - 1][j - 1] + 1 if x == y else max(rows[i - 1][j], rows[i][j - 1])
            )
    return rows


def walk(a, b):
    rows, i, j, kept = table(a, b), len(a), len(b), []
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            kept.append(i)
        elif rows[i][j - 1] > rows[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return kept


def test_common_subsequences_equal_the_plain_table():
    rng = random.Random(4)
    for _ in range(500):
        a = rng.choices("abcde", k=rng.randint(0, 15))
        b = rng.choices("abcdf", k=rng.randint(0, 15))
        assert scores.lcs_length(a, b) == table(a, b)[-1][-1]
        assert scores.lcs_positions(a, b) == walk(a, b)


def test_long_lines_need_little_memory():
    """Of two lines of 12,000 words, both tables of bits would be 36 MB."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    a, b = rng.choices(words, k=12_000), rng.choices(words, k=12_000)
    tracemalloc.start()
    kept = scores.lcs_positions(a, b)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 8_000_000
    assert len(kept) == scores.lcs_length(a, b)
    shared = iter(b)  # they are a subsequence of the other line
    assert all(a[p] in shared for p in reversed(kept))


def test_rouge_lsum_by_hand():
    # The first line shares "a b", the second "d": 3 hits of 4 wanted, 4 said.
    said, wanted = [["a", "b"], ["d", "x"]], [["a", "b"], ["c", "d"]]
    assert scores.lcs_lines_f(said, wanted) == 0.75
    # The union over predicted lines counts every token of a line once.
    assert scores.lcs_lines_f([["a"], ["b"], ["a"]], [["a", "b"]]) == 0.8


def test_rouge_lsum_equals_the_plain_union():
    rng = random.Random(5)

    def lines():
        return [rng.choices("abcdef", k=rng.randint(1, 8)) for _ in range(rng.randint(1, 4))]

    for _ in range(300):
        said, wanted = lines(), lines()
        spare, open_ = Counter(sum(said, [])), Counter(sum(wanted, []))
        sizes, hits = (spare.total(), open_.total()), 0
        for line in wanted:
            for p in sorted(set().union(*[walk(line, other) for other in said])):
                if spare[line[p]] and open_[line[p]]:
                    spare[line[p]] -= 1
                    open_[line[p]] -= 1
                    hits += 1
        wanted_f = scores.f_measure(hits, *sizes)
        assert scores.lcs_lines_f(said, wanted) == wanted_f


def test_rouge(spark):
    rows = [
        ("The cat sat on the mat.", ["the cat was on the mat", "x"]),
        ("one two\nthree four", ["three four\none two"]),
        ("", ["a"]),
        ("a", []),
        ("École", ["cole"]),
    ]
    found = score(spark, rows, scores.rouge("p", "r"))
    assert found[0].rouge1 == pytest.approx(10 / 12)
    assert found[0].rouge2 == pytest.approx(6 / 10)
    assert found[0].rougeL == pytest.approx(10 / 12)
    assert found[0].rougeLsum == pytest.approx(10 / 12)
    assert found[1].rougeL == pytest.approx(0.5)
    assert found[1].rougeLsum == 1.0
    assert tuple(found[2]) == tuple(found[3]) == (0.0,) * 4
    assert found[4].rouge1 == 1.0


def test_cosine(spark):
    df = spark.createDataFrame(
        [([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>"
    )
    found = [r[0] for r in df.select(scores.cosine("a", "b")).collect()]
    assert found == [pytest.approx(2**-0.5), 0.0]
    assert df.select(F.round(scores.dot("a", "b"), 6)).first()[0] == 1.0
