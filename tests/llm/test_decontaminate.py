import hashlib

import fixtures
from ragtables.llm.decontaminate import clean_documents, contamination


def plain(docs, items):
    windows = {}
    for item, text in items:
        w = fixtures.lettered(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w = fixtures.lettered(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i : i + n]))
                if own:
                    hit.update(range(i, i + n))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((str(doc), len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def found(docs, items):
    return sorted(
        (
            str(r.doc_id), r.n_words, r.n_hit, r.n_items,
            hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated,
        )
        for r in contamination(docs, items).collect()
    )


def test_matches_a_search_of_all_windows(spark, odd):
    rows = fixtures.rows()
    texts = [r[1] for r in rows]
    items = [
        (1, None), (2, ""), (3, "..."), (4, texts[3]), (5, texts[4]), (6, texts[8]), (7, texts[8]),
        (10, " ".join(fixtures.lettered(texts[17])[5:40])), (11, "again again"),
        (12, " ".join(["again"] * 20)), (13, "two, words!"), (14, " ".join(fixtures.lettered(texts[20])[10:22])),
    ]
    table = spark.createDataFrame(items, "item_id long, text string")
    want = plain([(r[0], r[1]) for r in rows], items)
    assert found(odd, table) == want
    assert sum(w[2] > 0 for w in want) > 8
    kept = clean_documents(odd, table)
    assert kept.columns == odd.columns
    clash = odd.selectExpr("*", "1 AS bad_id_", "2 AS bad_hash_")
    assert clean_documents(clash, table).columns == clash.columns
    assert kept.count() == sum(not w[5] for w in want)


def test_a_share_of_one_in_twenty(spark):
    span = [f"b{i}" for i in range(13)]
    docs = [(n, " ".join(span + [f"c{n}x{i}" for i in range(n - 13)])) for n in (13, 259, 260, 261)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(span))], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.contaminated) for r in contamination(table, items).collect()}
    assert got == {13: (13, True), 259: (13, True), 260: (13, True), 261: (13, False)}


def test_empty_tables(spark, odd, none):
    items = spark.createDataFrame([], "item_id long, text string")
    assert contamination(none, items).count() == 0
    assert contamination(odd, items).filter("contaminated or n_hit > 0").count() == 0
    assert clean_documents(odd, items).count() == odd.count()
