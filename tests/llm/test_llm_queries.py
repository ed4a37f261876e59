"""The registered queries against their SQL or plain versions, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
import fixtures
from oracle import connect, difference, sql_rows
from ragtables.llm.base import ORACLES, QUERIES, table
from ragtables.llm.toxicity import learn_lexicon, score_toxicity
from ragtables.llm.queries import learnable
from ragtables.sources.storage import materialize
from test_decontaminate import plain as plain_contamination
from test_fair_queue import place, plain_mix

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_one_query_for_each_operator():
    assert sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0])) == [
        "op1_ngram_jaccard_join", "op2_token_ids", "op3_toxicity", "op4_language_kernels",
        "op5_benchmark_decontamination", "op6_warc_revisits", "op7_license_scan",
        "op8_digest_index_dedup", "op9_fair_queue_mixing", "op10_sparse_suffix_dedup",
        "op11_phrase_collocations", "op12_token_alignment", "op13_chat_formatting",
    ]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(QUERIES) - set(ORACLES) == {"op2_token_ids", "op3_toxicity", "op4_language_kernels", "op7_license_scan",
        "op12_token_alignment",
    }


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        columns, types, rows = sql_rows(connect(FOLDER), ORACLES[name])
        assert rows and difference(df, columns, types, rows) is None
    else:
        assert df.count() == table(spark, FOLDER, "documents").count()


def test_pipeline_stage_by_stage(spark):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_ids"]

    def ids(df):
        return sorted(r.doc_id for r in df.select("doc_id").collect())

    def step(name):
        out = materialize(stages[name](spark, docs, FOLDER))
        if name != "token_ids":
            assert out.columns == columns
        return out

    lexicon = learn_lexicon(docs, learnable(table(spark, FOLDER, "labels")))
    want = ids(score_toxicity(docs, lexicon).filter("score < 0.3"))
    docs = step("toxicity")
    assert ids(docs) == want

    rows = docs.select("doc_id", "text").collect()
    group = fixtures.groups([r.text for r in rows])
    least = {}
    for r, g in zip(rows, group):
        least[g] = min(least.get(g, r.doc_id), r.doc_id)
    docs = step("near_duplicates")
    assert ids(docs) == sorted(least.values())

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    want = sorted(int(w[0]) for w in plain_contamination(rows, items) if not w[5])
    docs = step("decontamination")
    assert ids(docs) == want

    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    _, _, taken = plain_mix(rows)
    want = sorted(d for d, t, s in rows for _ in range(taken[(s, place(d, t))]))
    docs = step("mixing")
    assert ids(docs) == want

    found = step("token_ids")
    assert ids(found) == want
    spans = sorted((r.start, r.n_tokens) for r in found.collect())
    assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
