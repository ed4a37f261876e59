import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import fixtures
from ragtables.llm import collocations as own

SCHEMA = "lang string, text string"


def plain(rows, longest=3, least=10, percent=50, top=2000):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, longest + 1):
                for i in range(len(w) - n + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        many = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        covered = Counter()
        for p, n in many.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    covered[p[i : i + size]] = max(covered[p[i : i + size]], n)
        found = []
        for p, a in many.items():
            if p in covered and 100 * covered[p] >= percent * a:
                continue
            score, _, left, right = min(
                (10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
            )
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def texts(seed=5, n=400):
    draw = random.Random(seed)
    vocabulary = [*"abcdefgh", "É", "ß", "日本", "x-y", "it's", "a b", "�z"]
    marks = [" ", " ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\r\n", "!", " ;"]
    rows = []
    for i in range(n):
        t = "".join(draw.choice(vocabulary) + draw.choice(marks) for _ in range(draw.randint(0, 60)))
        rows.append((draw.choice(["en", "en", "fr", None, "und"]), t.upper() if i % 7 == 0 else t))
    copied = "the quick brown fox jumps over the lazy dog and runs away from here"
    return rows + [("en", copied)] * 40 + [("en", copied + ". " + copied)] * 3 + [("fr", None), (None, ""), ("de", " .,; ")]


@pytest.mark.parametrize("longest,least,percent,top", [(3, 10, 50, 2000), (2, 3, 50, 7), (4, 4, 80, 50)])
def test_like_counting_all(spark, longest, least, percent, top):
    rows = texts()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = own.collocations(df, longest, least, percent, top).collect()
    assert sorted(map(tuple, got)) == plain(rows, longest, least, percent, top)


@pytest.mark.parametrize("stride", [1, 3, 10**9])
def test_wherever_chunks_are_cut(spark, stride):
    """Each phrase counts once, in whatever chunks it lies."""
    rows = texts(9, 150)
    dictionary = own.chunk_dictionary(
        spark.createDataFrame([(a or "und", t) for a, t in rows], SCHEMA), 3, stride
    ).cache()
    totals, counts = own.phrase_counts(dictionary, 3, 1)
    want = Counter()
    for _, _, p, a, *_ in plain(rows, 3, 1, 1000, 10**9):
        want[p] += a
    got = Counter()
    for r in counts.filter("size > 1").collect():
        got[r.phrase] += r.f
    assert got == want
    assert {r.lang: r.n for r in totals.collect()} == {x[0]: x[6] for x in plain(rows, 3, 1)}


def test_a_repeated_passage_is_stored_once(spark):
    draw = random.Random(1)
    passage = " ".join(f"w{draw.randint(0, 999)}" for _ in range(400))
    rows = [("en", f"own{i} start {passage} end{i} here") for i in range(50)]
    dictionary = own.chunk_dictionary(spark.createDataFrame(rows, SCHEMA), 3, 8)
    assert dictionary.count() < 3 * 50 + 400 and dictionary.agg(F.max("freq")).first()[0] >= 50


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rows = texts(3, 200)
    monkeypatch.setattr(own, "FILTER_BITS", 1 << 4)
    monkeypatch.setattr(own, "HELD_WORDS", 50)
    got = own.collocations(spark.createDataFrame(rows, SCHEMA).repartition(2), least=4).collect()
    assert sorted(map(tuple, got)) == plain(rows, least=4)


def test_products_beyond_64_bits(spark):
    rows = [("en", 1, "a", 4 * 10**12), ("en", 1, "b", 3 * 10**12 + 1), ("en", 2, "a b", 2 * 10**12 + 7)]
    counts = spark.createDataFrame(rows, "lang string, size int, phrase string, f long")
    r = own._scored(counts, 2).first()
    assert r.score == 10**6 * rows[2][3] ** 2 // (rows[0][3] * rows[1][3])


def test_odd_rows_clashing_columns_long_texts_no_rows(spark, odd, none):
    rows = [(r[2], r[1]) for r in fixtures.rows()]
    clash = odd.selectExpr("*", "1 AS chunk", "2 AS own", "3 AS freq", "4 AS phrase", "5 AS f", "6 AS rank")
    assert sorted(map(tuple, own.collocations(clash, least=2).collect())) == plain(rows, least=2)
    assert own.collocations(none).count() == 0
    long = [("en", "so many words here " * 300_000)]
    assert sorted(map(tuple, own.collocations(spark.createDataFrame(long, SCHEMA)).collect())) == plain(long)
    with pytest.raises(ValueError):
        own.collocations(odd, longest=1)
