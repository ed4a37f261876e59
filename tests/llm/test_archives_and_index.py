import base64
import hashlib
import re

import fixtures
from ragtables.llm.digest_index import DigestIndex, deduplicate, distinct_documents
from ragtables.llm.warc import page_records, read_archives, resolved_headers, write_archives
from ragtables.sources.storage import fresh_path

PAGES = [
    (5, "http://a/5", "<p>é</p>"), (3, None, "<p>é</p>"), (9, "http://a/9\r\nX: y", "<p>é</p>"), (1, "u", None), (2, "u", ""),
    (7, "u", "a\r\n\r\nWARC/1.1\r\n\r\nb"), (8, "u", "x" * 300_000), (10, "u", "x" * 300_000), (10, "u", "x" * 300_000),
    (11, "u", "\r\n\r\n"), (None, "u", "lone"), (None, "u", "x" * 300_000),
]


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def headers(df):
    return sorted(
        (str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in df.collect()
    )


def wanted(pages, least=0):
    first = {}
    for p, _, html in pages:
        if p is not None:
            first[html or ""] = min(first.get(html or "", p), p)
    out = []
    for p, _, html in pages:
        text = html or ""
        size = len(text.encode())
        own = first.get(text)
        if own is None or own == p or size < least:
            out.append((str(p), size, sha(text), "response", "None"))
        else:
            out.append((str(p), size, sha(text), "revisit", str(own)))
    return sorted(out)


def test_archives_store_equal_payloads_once(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'x' as payload")
    for least in (0, 10):
        path = fresh_path(spark, "test")
        write_archives(page_records(pages), path, least, per_file=3)
        records = read_archives(spark, path)
        assert headers(resolved_headers(records)) == wanted(PAGES, least)
    stored = {r.page_id: r.payload for r in records.filter("record_type = 'response' and page_id > 4").collect()}
    assert stored[7] == PAGES[5][2] and stored[11] == "\r\n\r\n" and stored[8] == "x" * 300_000


def test_existing_archives_are_resolved_again(spark):
    one, two = fresh_path(spark, "test"), fresh_path(spark, "test")
    pages = spark.createDataFrame(PAGES[:7], "page_id long, url string, html string")
    more = spark.createDataFrame(PAGES[7:10], "page_id long, url string, html string")
    write_archives(page_records(pages), one)
    old = read_archives(spark, one)
    write_archives(old.unionByName(page_records(more).select(old.columns)), two)
    assert headers(resolved_headers(read_archives(spark, two))) == wanted(PAGES[:10])


def test_no_pages(spark):
    path = fresh_path(spark, "test")
    write_archives(page_records(spark.createDataFrame([], "page_id long, url string, html string")), path)
    assert read_archives(spark, path).count() == 0


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(normal(r[1]), []).append(r[0])
    out = []
    for r in rows:
        own = by[normal(r[1])]
        keep = min((i for i in own if i is not None), default=None)
        out.append((str(r[0]), str(keep), len(own), r[0] == keep, hashlib.sha256(normal(r[1]).encode()).hexdigest()))
    return sorted(out)


def found(df):
    return sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in df.collect())


def test_index_dedups_within_and_across_batches(spark, odd):
    rows = fixtures.rows()
    index = DigestIndex(spark, fresh_path(spark, "test"), buckets=4)
    assert found(deduplicate(odd, index, "one")) == plain(rows)
    size = index.table().count()
    assert size == len({normal(r[1]) for r in rows})
    # The same batch again adds nothing and gives the same rows.
    assert found(deduplicate(odd, index, "one")) == plain(rows) and index.table().count() == size
    # A later batch is held against the index.
    late = [(1, rows[9][1], "new"), (2, "never seen", "new"), (2, "never  seen", "new"), (3, "never\nseen", "x")]
    batch = spark.createDataFrame(late, "doc_id long, text string, Own_Digest_ string")
    got = {(r.doc_id, r.keep_id, r.kept) for r in deduplicate(batch, index, "two").collect()}
    assert got == {(1, 108, False), (2, 2, True), (3, 2, False)}
    assert index.table().count() == size + 1
    kept = distinct_documents(batch, DigestIndex(spark, fresh_path(spark, "test")), "b")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]


def test_index_opens_by_path_and_joins_without_a_shuffle_of_it(spark, odd):
    path = fresh_path(spark, "test")
    index = DigestIndex(spark, path, buckets=4)
    deduplicate(odd, index, "one")
    index.drop()
    again = DigestIndex(spark, path, buckets=16)  # has the number it was made with
    assert again.buckets == 4
    assert again.table().count() > 10
    batch = again.table().select("digest", "keep_id").limit(3)
    plan = again.unseen(batch)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Bucketed: true" in plan
    assert again.unseen(batch).count() == 0


def test_all_known_texts_are_found_whatever_bucket_count_is_asked_for(spark):
    path = fresh_path(spark, "test")
    rows = spark.range(200).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    first = DigestIndex(spark, path, buckets=16)
    assert deduplicate(rows, first, "one").filter("kept").count() == 200
    first.drop()
    for number, asked in enumerate((None, 7)):
        other = DigestIndex(spark, path, buckets=asked, expected_rows=10**9)
        assert deduplicate(rows, other, f"again{number}").filter("kept").count() == 0
        assert other.buckets == 16 and other.table().count() == 200
        other.drop()
    sized = DigestIndex(spark, fresh_path(spark, "test"), expected_rows=10**9)
    assert sized.buckets == 250


def test_columns_with_the_helpers_names_stay(spark, odd):
    names = ["keep_id_", "digest_", "own_digest_"]
    clash = odd.selectExpr("*", *[f"'mine' AS {n}" for n in names])
    kept = distinct_documents(clash, DigestIndex(spark, fresh_path(spark, "test")), "b")
    assert kept.columns == clash.columns
    assert {tuple(r[n] for n in names) for r in kept.collect()} == {("mine",) * 3}


def test_empty_batch(spark, none):
    index = DigestIndex(spark, fresh_path(spark, "test"), buckets=2)
    assert deduplicate(none, index, "one").count() == 0 and index.table().count() == 0
