import random
import re

import pytest

import fixtures
from ragtables.llm.toxicity import Lexicon, acceptable, evidence, automaton, fold, folding_table, learn_lexicon, score_of, score_toxicity

CLEAN = ["house", "river", "stone", "cloud", "market", "garden", "window", "letter", "summer", "paper"] + [
    "w" + "".join(random.Random(i).choices("bcdfgmnp", k=6)) for i in range(400)
]
RUDE = ["blorgh", "snarfle", "grumpkin"]


@pytest.fixture(scope="module")
def labelled(spark):
    draw = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        words = draw.choices(CLEAN, k=draw.randint(20, 120))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(1 + len(words) // 20):
                words.insert(draw.randrange(len(words)), draw.choice(RUDE) + draw.choice(["", "s", "ish"]))
        if not toxic and i % 7 == 0:  # a harmless phrase
            at = draw.randrange(len(words))
            words[at:at] = ["mister", "grumpkin"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_learns_terms_exceptions_and_threshold(spark, labelled):
    docs, labels = labelled
    lexicon = learn_lexicon(docs, labels.filter("doc_id % 4 <> 2"))
    table = folding_table()
    for word in RUDE[:2]:
        assert any(fold(word, table).startswith(t) for t in lexicon.weights)
    assert "mister grumpkin" in lexicon.exceptions
    found = {r.doc_id: r for r in score_toxicity(docs, lexicon).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [i for i in truth if i % 4 == 2]
    assert all((found[i].score >= 0.3) == bool(truth[i]) for i in held)


def test_scores_match_a_plain_search(odd):
    lexicon = Lexicon({"idiot": 4.0, "idiots": 5.0, "moron": 3.0}, frozenset({"no idiot"}), 0.5)
    table, terms = folding_table(), automaton(lexicon)
    for text in (
        "", "You 1D10T!", "an ídíöt", "ïdiots and m0r0ns", "no idiot here", "xidiot", "i​diot",
        "аn idіоt", "MORON moron", "iDiOt" * 3, "ｉｄｉｏｔ",
    ):
        words = fold(text, table).split()
        total = 0.0
        for i, w in enumerate(words):
            before = " ".join(words[max(0, i - 1) : i + 1])
            for term in sorted(lexicon.weights, key=len, reverse=True):
                if re.match(re.escape(term), w):
                    if before not in lexicon.exceptions:
                        total += lexicon.weights[term]
                    break
        found, _, n = evidence(text, lexicon, terms, table)
        assert n == len(words) and found == pytest.approx(total / (n + 20) ** 0.5)
    assert score_of(0.5, 0.5) == pytest.approx(0.3)
    hits = score_toxicity(odd, lexicon)
    assert hits.count() == odd.count() and "Score" not in hits.columns
    assert hits.filter("score > 0").count() == 0
    kept = acceptable(odd, lexicon)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert kept.filter("Score like 's%'").count() == odd.filter("Score like 's%'").count()


def test_nothing_to_learn_from(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    lexicon = learn_lexicon(odd, labels)
    assert lexicon.weights == {} and score_toxicity(odd, lexicon).filter("score <> 0").count() == 0
    assert learn_lexicon(none, labels).weights == {} and score_toxicity(none, lexicon).count() == 0
    odd_labels = spark.createDataFrame([(None, 1), (101, None), (103, 1), (103, 0), (104, 0)], "doc_id long, toxic int")
    learn_lexicon(odd, odd_labels)
    assert len(fixtures.rows()) == score_toxicity(odd, lexicon).count()


def test_a_clean_original_does_not_hide_its_toxic_copies(spark):
    draw = random.Random(9)
    rows, labels = [], []
    for i in range(60):
        words = draw.choices(CLEAN, k=60)
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words + ["blorgh", "blorgh"]))]
        labels += [(2 * i, 0), (2 * i + 1, 1)]
    lexicon = learn_lexicon(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    )
    word = fold("blorgh", folding_table())
    assert any(word.startswith(t) for t in lexicon.weights)


def test_neighbours_are_whole_words_however_long(spark):
    long = "z" * 5_000
    lexicon = Lexicon({"moron": 3.0}, frozenset({f"{long} moron", f"moron {long}"}), 0.5)
    table, terms = folding_table(), automaton(lexicon)
    for text, n in ((f"{long} moron", 0), (f"{long}  moron", 0), (f"moron {long}", 0), (f"z{long} moron", 1), ("moron", 1)):
        assert evidence(text, lexicon, terms, table)[1] == n
    df = spark.createDataFrame([(1, "you moron", "mine")], "doc_id long, text string, toxicity_ string")
    row = score_toxicity(df, lexicon).first()
    assert row.toxicity_ == "mine" and row.n_hits == 1
