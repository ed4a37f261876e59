"""The registered queries of this subpackage, with their SQL where there is one."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ragtables.llm.alignment import align_tokens, byte_level, sentence_pieces
from ragtables.llm.base import ORACLES, QUERIES, UPPER, crc_remainder, query, table
from ragtables.llm.chat import chat_examples, digests, read_back, read_examples, write_examples
from ragtables.llm.collocations import collocations
from ragtables.llm.decontaminate import contamination
from ragtables.llm.digest_index import DigestIndex, deduplicate
from ragtables.llm.fair_queue import SEED, fair_mix
from ragtables.llm.language import identify_language, learn_languages
from ragtables.llm.licenses import license_scan
from ragtables.llm.ngram_join import ngram_join
from ragtables.llm.sparse_suffix import shared_passages
from ragtables.llm.token_store import read_tokens, write_tokens
from ragtables.llm.toxicity import DECISION, learn_lexicon, score_toxicity
from ragtables.llm.warc import BASE32, page_records, read_archives, resolved_headers, write_archives
from ragtables.sources.storage import fresh_path

__all__ = ["ORACLES", "QUERIES"]

SQL_LOWER = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
SQL_SPACED = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
SQL_LETTERS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer's file, which every machine has."""
    import public_tokenizers

    return public_tokenizers.path(name)


def learnable(df: DataFrame) -> DataFrame:
    """Rows whose labels and languages may be learned from."""
    return df.filter(crc_remainder(F.col("doc_id")) != 2)


def held_out() -> Column:
    return F.coalesce(crc_remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out")


@query()
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    lexicon = learn_lexicon(docs, learnable(table(spark, folder, "labels")))
    return score_toxicity(docs.select("doc_id", "text"), lexicon).select(
        "doc_id",
        held_out(),
        "score",
        (F.col("score") >= DECISION).cast("int").alias("predicted"),
        "n_hits",
        "n_words",
    )


@query(
    f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {SQL_SPACED.format(SQL_LOWER)} AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
    END) AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.other) AS component_id
FROM s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.s
"""
)
def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join(table(spark, folder, "documents")).drop("text_hash")


@query(
    f"""
WITH iw AS (SELECT item_id, {SQL_LETTERS.format(SQL_LOWER)} AS w FROM benchmark),
win AS (
  SELECT item_id, least(len(w), 13) AS n,
         unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2),
                lambda i: array_to_string(w[i : i + least(len(w), 13) - 1], ' '))) AS s
  FROM iw WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, {SQL_LETTERS.format(SQL_LOWER)} AS w FROM documents),
dn AS (
  SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i
  FROM dw CROSS JOIN lens WHERE len(w) >= n),
hit AS (
  SELECT DISTINCT d.doc_id, d.i, d.n, v.item_id
  FROM dn d JOIN win v ON v.n = d.n AND v.s = array_to_string(d.w[d.i : d.i + d.n - 1], ' ')),
pos AS (
  SELECT doc_id, count(*) AS n_hit FROM (
    SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items,
         string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
)
def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query(
    f"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len({SQL_SPACED.format("coalesce(text, '')")}) AS BIGINT) AS size,
         CAST('0x' || substr(md5('{SEED}:' || doc_id), 1, 15) AS BIGINT) AS place
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
  FROM sized GROUP BY source),
lev AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap, ([3.0::DOUBLE, 1.0, 2.0])[sid % 3 + 1] AS weight
  FROM src),
open_ AS (
  SELECT *, cap / weight AS level,
         (sum(source_size) OVER () * 1.5::DOUBLE
          - coalesce(sum(cap) OVER (ORDER BY cap / weight, sid
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
         / sum(weight) OVER (ORDER BY cap / weight, sid
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_level
  FROM lev),
tgt AS (
  SELECT source, sid, source_size,
         least(cap, weight * coalesce((min(CASE WHEN level > open_level THEN
           struct_pack(l := level, s := sid, o := open_level) END) OVER ()).o,
           'infinity'::DOUBLE)) AS target
  FROM open_),
cum AS (
  SELECT doc_id, s.size, s.place, t.*,
         CAST(sum(s.size) OVER (PARTITION BY t.sid ORDER BY s.place) AS BIGINT) AS upto
  FROM sized s JOIN tgt t ON s.source IS NOT DISTINCT FROM t.source),
times AS (
  SELECT *, CASE WHEN target > 0 THEN (upto + p * source_size) / target ELSE 0.0 END AS finish
  FROM cum CROSS JOIN (SELECT unnest([0, 1]) AS p)),
run AS (
  SELECT *, sum(size) OVER (ORDER BY finish, sid, p) AS upto_all,
         sum(size) OVER () / 2 * 1.5 AS most
  FROM times)
SELECT doc_id, size, source_size, target,
       CAST(sum(CASE WHEN upto_all <= most THEN size ELSE 0 END) AS BIGINT) AS taken
FROM run GROUP BY doc_id, size, source_size, target
"""
)
def op9_fair_queue_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return fair_mix(table(spark, folder, "documents")).drop("copies")


@query()
def op2_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "token_stores")
    write_tokens(table(spark, folder, "documents"), path, tokenizer_path())
    return read_tokens(spark, path)


@query(
    f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         CAST(unhex(sha1(coalesce(html, ''))) AS BIT)::VARCHAR AS bits FROM pages),
d AS (
  SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
         array_to_string(list_transform(range(0, 32), lambda i: substr('{BASE32}',
           list_sum(list_transform(range(0, 5), lambda j:
             CAST(substr(bits, 5 * i + j + 1, 1) AS INTEGER) * (16 >> j)))::INTEGER + 1, 1)), '')
           AS payload_digest
  FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
)
def op6_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "archives")
    write_archives(page_records(table(spark, folder, "pages")), path)
    return resolved_headers(read_archives(spark, path)).drop("url")


@query(
    r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
         AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
)
def op8_digest_index_dedup(spark: SparkSession, folder: str) -> DataFrame:
    index = DigestIndex(spark, fresh_path(spark, "digest_indexes"))
    found = deduplicate(table(spark, folder, "documents"), index, "documents")
    return found


@query()
def op4_language_kernels(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = learn_languages(learnable(docs))
    found = identify_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(), "lang_pred", "score")


@query()
def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = license_scan(table(spark, folder, "documents").select("doc_id", "text"))
    return found.drop("text", "spans")


@query(
    f"""
WITH w AS (SELECT doc_id, {SQL_SPACED.format(SQL_LOWER)} AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i + 1 : i + 50], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS i FROM w WHERE len(w) >= 50)),
many AS (SELECT h FROM win GROUP BY h HAVING count(DISTINCT doc_id) > 1),
hit AS (SELECT doc_id, i FROM win SEMI JOIN many USING (h)),
marked AS (
  SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hit)
SELECT doc_id, min(i) AS first_word, max(i) + 49 AS last_word,
       max(i) - min(i) + 50 AS n_words
FROM marked GROUP BY doc_id, run
"""
)
def op10_sparse_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return shared_passages(table(spark, folder, "documents")).drop("copies")


@query(
    r"""
WITH rows_ AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
                   (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
sized AS (
  SELECT *, 14 + length(role) + length(text)
    + length(text) - length(replace(text, '\', ''))
    + 2 * (length(text) - length(replace(text, '### ', ''))) // 4
    + 2 * (length(text) - length(replace(text, '</turn>', ''))) // 7 AS chars FROM rows_),
upto AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text
              ROWS UNBOUNDED PRECEDING) AS upto,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text)
           = count(*) OVER (PARTITION BY conv_id) AS last_one
  FROM sized)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
         FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR last_one) AS BIGINT) AS formatted_chars
FROM upto GROUP BY conv_id
"""
)
def op13_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    tricky = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame(
        [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)],
        "conv_id long, turn long, role string, text string",
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    path = write_examples(chat_examples(turns.unionByName(own)), fresh_path(spark, "examples"))
    return digests(read_back(read_examples(spark, path)))


@query()
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align_tokens(
        table(spark, folder, "documents"),
        partial(byte_level, tokenizer_path("byte_bpe_50k.json")),
        partial(sentence_pieces, tokenizer_path("piece_bpe_32k.model")),
    )


@query(
    rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex({SQL_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS MATERIALIZED (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS p, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM w CROSS JOIN (VALUES (1), (2), (3)) t(k) WHERE len(w) >= k)
  GROUP BY ALL),
c AS MATERIALIZED (
  SELECT lang, k, p, f AS a, string_split(p, ' ') AS ws FROM g WHERE k > 1 AND f >= 10),
parts AS MATERIALIZED (
  SELECT lang, k, p, a, j, 
         lang || chr(10) || array_to_string(ws[1 : j], ' ') AS lp,
         lang || chr(10) || array_to_string(ws[j + 1 :], ' ') AS rp
  FROM c CROSS JOIN (VALUES (1), (2)) t(j) WHERE j < k),
keyed AS MATERIALIZED (SELECT lang || chr(10) || p AS key, f FROM g),
cuts AS (
  SELECT s.lang, s.k, s.p, a, j, x.f AS l, y.f AS r,
         (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
  FROM parts s JOIN keyed x ON x.key = lp JOIN keyed y ON y.key = rp),
inside AS (
  SELECT lang, p, max(a) AS longer FROM (
    SELECT lang, a, unnest([array_to_string(ws[1 : 2], ' '), array_to_string(ws[2 : 3], ' ')]) AS p
    FROM c WHERE k = 3) GROUP BY lang, p),
best AS (
  SELECT cuts.* FROM cuts LEFT JOIN inside USING (lang, p)
  WHERE k = 3 OR coalesce(100 * longer < 50 * a, true)
  QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank,
       p AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM best JOIN total USING (lang) QUALIFY rank <= 2000
"""
)
def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))
