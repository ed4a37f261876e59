import os

import numpy as np
import pytest

from ragtables.llm import language as lang
from ragtables.llm.queries import op4_language_kernels, table

FOLDER = "/root/testdata/sf0.01"


def plain_kernel(a: bytes, b: bytes) -> float:
    def places(t: bytes) -> set:
        out = set()
        for n in lang.GRAMS:
            for i in range(len(t) - n + 1):
                code = n
                for c in t[i : i + n]:
                    code = ((code * 0x01000193) & 0xFFFFFFFF) ^ c
                out.add(((code * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - (lang.FEATURES.bit_length() - 1)))
        return out

    def unit(t: bytes) -> list:
        return [places(t[i : i + lang.SEGMENT]) for i in range(0, len(t), lang.SEGMENT)]

    other = places(b)
    total = sum(
        len(p & other) / max(1, (len(p) * len(other)) ** 0.5) * len(a[i * lang.SEGMENT : (i + 1) * lang.SEGMENT])
        for i, p in enumerate(unit(a))
    )
    return total / max(1, len(a))


def test_kernels_match_sets():
    texts = [b"", b"a", b"the house", b"der hund und die katze", b"x" * 10]
    marks, _, _ = lang.presence([b"the house and the dog", b"die katze"])
    found = lang.kernels(texts, np.ascontiguousarray(marks.T))
    for i, t in enumerate(texts):
        for j, m in enumerate((b"the house and the dog", b"die katze")):
            assert found[i, j] == pytest.approx(plain_kernel(t, m), abs=1e-5)


def test_long_texts_count_whole(spark):
    docs = spark.createDataFrame(
        [(i, ("the of and with this " if i % 2 else "der die das und nicht ") * 30, "en" if i % 2 else "de") for i in range(40)]
        + [(90, None, "en"), (91, "", "de"), (92, "words", None)],
        "doc_id long, text string, lang string",
    )
    model = lang.learn_languages(docs)
    text = "the of and with this " * 20 + "der die das und nicht " * 2_000
    probe = spark.createDataFrame(
        [(1, text, "x"), (2, None, "x"), (3, "", "x"), (4, "123 .,!", "x"), (5, "the of and this", "x"), (5, "the of and this", "x")],
        "doc_id long, text string, Lang_Pred string",
    )
    got = lang.identify_language(probe, model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score"]
    found = sorted((r.doc_id, r.lang_pred) for r in got.collect())
    assert found == [(1, "de"), (2, "und"), (3, "und"), (4, "und"), (5, "en"), (5, "en")]
    assert all(0 <= r.score <= 1 for r in got.collect())


def test_nothing_to_learn_from(odd, none):
    assert lang.learn_languages(none) is None
    assert lang.identify_language(none, None).count() == 0
    assert lang.identify_language(odd, None).filter("lang_pred <> 'und' or score <> 0").count() == 0
    assert lang.identify_language(odd, lang.learn_languages(odd)).count() == odd.count()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_held_out_accuracy(spark):
    found = op4_language_kernels(spark, FOLDER).join(table(spark, FOLDER, "documents").select("doc_id", "lang"), "doc_id")
    rows = found.filter("held_out").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_landmarks_are_not_all_headers(spark):
    """Documents that open with one header, in two languages told apart by the rest."""
    header = "all rights reserved see the notice " * 80
    assert len(header) > lang.SEGMENT
    docs = spark.createDataFrame(
        [(i, header + ("the of and with this " if i % 2 else "der die das und nicht ") * 900, "en" if i % 2 else "de") for i in range(40)],
        "doc_id long, text string, lang string",
    )
    model = lang.learn_languages(docs)
    opening, _, _ = lang.presence([lang._lowered(header, lang._plain())[: lang.SEGMENT]])
    of_header = np.isclose(opening @ model.landmarks, 1, atol=1e-3).sum()
    assert of_header < model.landmarks.shape[1] / 2
