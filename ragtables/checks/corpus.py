"""Checked queries: cleaning, chunking, embedding, retrieval."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ragtables.checks.base import (
    SQL_QA,
    SQL_TITLED,
    check,
    qa,
    sql_chunks,
    table,
    titled,
)
from ragtables.functions import templates
from ragtables.operators import codes, columns, corpus, prompts, retrieval
from ragtables.sources.storage import materialize

SQL_CLEAN = f"""{SQL_TITLED}, cleaned AS (
  SELECT doc_id, title, array_to_string(list_filter(list_transform(
           string_split(content, chr(10)),
           lambda l: trim(regexp_replace(l, '[ \\t]+', ' ', 'g'))), lambda l: l <> ''),
         chr(10)) AS content FROM titled)"""

SQL_CHUNKS = f"""{SQL_CLEAN}, cut AS (
  SELECT doc_id, title, {sql_chunks("w", 200, 20)} AS c
  FROM (SELECT *, string_split(content, ' ') AS w FROM cleaned)),
chunks AS (
  SELECT doc_id || ':' || (p - 1) AS chunk_id, doc_id, title, CAST(p - 1 AS INTEGER) AS chunk_no,
         c[p] AS content
  FROM (SELECT *, unnest(range(1, len(c) + 1)) AS p FROM cut))"""


def sql_embed(table_: str, key: str, text: str, made: str) -> str:
    """SQL for the 64 components of the hashing embedder: ``made(key, e)``."""
    return f"""{made}_tokens AS (
  SELECT {key} AS k, CAST('0x' || substr(md5(w), 1, 15) AS BIGINT) AS h
  FROM (SELECT {key}, unnest(string_split_regex(lower({text}), '\\s+')) AS w FROM {table_})
  WHERE w <> ''),
{made}_sums AS (
  SELECT k, (h // 2) % 64 AS d, sum(CASE WHEN h % 2 = 1 THEN 1.0 ELSE -1.0 END) AS v
  FROM {made}_tokens GROUP BY ALL),
{made}_norms AS (SELECT k, sqrt(sum(v * v)) AS n FROM {made}_sums GROUP BY k),
{made} AS (
  SELECT t.{key} AS k, list(CAST(CAST(CASE WHEN coalesce(n.n, 0) > 0
           THEN coalesce(s.v, 0) / n.n ELSE 0 END AS FLOAT) AS DOUBLE) ORDER BY r.d) AS e
  FROM {table_} t CROSS JOIN range(64) AS r(d)
  LEFT JOIN {made}_sums s ON s.k = t.{key} AND s.d = r.d
  LEFT JOIN {made}_norms n ON n.k = t.{key} GROUP BY t.{key})"""


@check(f"WITH {SQL_CHUNKS} SELECT chunk_id, doc_id, chunk_no, title, content FROM chunks")
def corpus_chunks(spark: SparkSession, folder: str) -> DataFrame:
    chunks = corpus.chunk_documents(corpus.clean_documents(titled(spark, folder)))
    return chunks.select("chunk_id", "doc_id", "chunk_no", "title", "content")


@check(
    f"""WITH {SQL_CHUNKS}, texts AS (
          SELECT chunk_id, concat_ws(chr(10), title, content) AS t FROM chunks),
        {sql_embed("texts", "chunk_id", "t", "vectors")}
        SELECT k AS chunk_id, CAST(p - 1 AS INTEGER) AS position, round(e[p], 6) AS value
        FROM (SELECT k, e, unnest(range(1, 65)) AS p FROM vectors) WHERE e[p] <> 0"""
)
def corpus_embed(spark: SparkSession, folder: str) -> DataFrame:
    index = corpus.build_index(titled(spark, folder), corpus.HashingEmbedder)
    flat = index.select("chunk_id", F.posexplode("embedding").alias("position", "value"))
    return flat.filter("value <> 0").withColumn(
        "value", F.round(F.col("value").cast("double"), 6)
    )


_SQL_PAIRS = """pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id AS doc_id,
         list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS score
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
  FROM pairs)"""


def _rounded(found: DataFrame) -> DataFrame:
    return found.select(
        "query_id", "doc_id", F.round("score", 6).alias("score"), "rank"
    )


@check(
    f"""WITH {_SQL_PAIRS}
        SELECT query_id, doc_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE rank <= 10"""
)
def dense_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return _rounded(
        retrieval.dense_topk(
            vectors, vectors, 10, "vec_id", "vec_id", skip_equal_ids=True
        )
    )


@check(
    f"""WITH {_SQL_PAIRS}
        SELECT query_id, doc_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE rank <= 10"""
)
def dense_topk_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the queries sent in several sets, as for a large query set."""
    vectors = table(spark, folder, "embeddings")
    return _rounded(
        retrieval.dense_topk(
            vectors,
            vectors,
            10,
            "vec_id",
            "vec_id",
            skip_equal_ids=True,
            sent_components=64 * 200,
        )
    )


@check(
    f"""WITH {_SQL_PAIRS.replace("a.vec_id <> b.vec_id", "a.vec_id <> b.vec_id AND a.vec_id % 7 <> 0 AND b.vec_id % 7 <> 0")}
        SELECT query_id, doc_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE rank <= 10"""
)
def dense_topk_valid(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh vector is broken, each in one of three ways, and is left out."""
    vectors = table(spark, folder, "embeddings")
    kind, whole = F.col("vec_id") % 21, F.col("embedding")
    undefined = F.transform(whole, lambda x, i: F.when(i == 5, float("nan")).otherwise(x))
    broken = (
        F.when(kind == 0, F.slice(whole, 1, 60))
        .when(kind == 7, undefined.cast("array<float>"))
        .when(kind != 14, whole)
        .otherwise(F.lit(None))
    )
    broken = F.when(F.col("vec_id") % 7 == 0, broken).otherwise(whole)
    vectors = vectors.withColumn("embedding", broken)
    return _rounded(
        retrieval.dense_topk(
            vectors, vectors, 10, "vec_id", "vec_id", skip_equal_ids=True, skip_invalid=True
        )
    )


_SQL_CELLS = """centres AS (
  SELECT label, list(m ORDER BY p) AS c FROM (
    SELECT label, p, avg(CAST(embedding[p] AS DOUBLE)) AS m
    FROM (SELECT label, embedding, unnest(range(1, 65)) AS p FROM embeddings)
    GROUP BY label, p) GROUP BY label),
near AS (
  SELECT vec_id, embedding::DOUBLE[] AS e, label AS cell, row_number() OVER (
           PARTITION BY vec_id ORDER BY list_dot_product(embedding::DOUBLE[], c)
             - list_dot_product(c, c) / 2 DESC, label) AS place
  FROM (SELECT e.vec_id, e.embedding, c.label, c.c FROM embeddings e CROSS JOIN centres c)),
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id AS doc_id, list_dot_product(a.e, b.e) AS score
  FROM near a JOIN near b ON a.cell = b.cell AND a.vec_id <> b.vec_id
  WHERE a.place <= 3 AND b.place = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
  FROM pairs)"""


@check(
    f"""WITH {_SQL_CELLS}
        SELECT query_id, doc_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE rank <= 10"""
)
def cell_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Cell-wise search around the mean vector of every label."""
    vectors = table(spark, folder, "embeddings")
    parts = vectors.select("label", F.posexplode("embedding").alias("p", "x"))
    means = parts.groupBy("label", "p").agg(F.avg(F.col("x").cast("double")).alias("m"))
    # One row per label.
    rows = (
        means.groupBy("label")
        .agg(F.sort_array(F.collect_list(F.struct("p", "m"))).alias("c"))
        .orderBy("label")
        .select("c.m")
        .collect()
    )
    centres = np.array([r["m"] for r in rows])
    return _rounded(
        retrieval.cell_topk(
            vectors, vectors, centres, 10, 3, "vec_id", "vec_id", skip_equal_ids=True
        )
    )


# The queries whose recall is measured.
_QUERY_SET = "vec_id % 100 = 0"


@check(
    f"""WITH {_SQL_PAIRS}
        SELECT query_id, doc_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank,
               true AS few_probes_find_most
        FROM ranked WHERE rank <= 10"""
)
def ann_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Cells fitted on all vectors by iterative clustering. With all of them probed
    the search is exact; as many as were chosen for it find at least 0.9 of the hits
    of the query set (``ann_topk_measured`` returns approximate hits)."""
    vectors = table(spark, folder, "embeddings")
    cells = 16
    centres = retrieval.cell_centres(vectors, cells, "vec_id")
    stored = materialize(retrieval.assign_cells(vectors, centres))
    search = (vectors, stored, centres, 10)
    exact = materialize(
        retrieval.cell_topk(*search, cells, "vec_id", "vec_id", skip_equal_ids=True)
    )
    asked = vectors.filter(_QUERY_SET)
    probes, _ = retrieval.probes_for_recall(
        asked, stored, centres, 10, 0.9, "vec_id", "vec_id", skip_equal_ids=True
    )
    few = retrieval.cell_topk(
        asked, stored, centres, 10, probes, "vec_id", "vec_id", skip_equal_ids=True
    )
    of_set = exact.filter("query_id % 100 = 0")
    recall = retrieval.recall_at_k(few, of_set).first()["recall"]
    return _rounded(exact).withColumn("few_probes_find_most", F.lit(recall >= 0.9))


def _fixed_centres(vectors: DataFrame, cells: int) -> np.ndarray:
    """The first vectors as centres, which SQL knows too."""
    rows = vectors.filter(F.col("vec_id") < cells).orderBy("vec_id").select("embedding")
    return np.array([r["embedding"] for r in rows.collect()], np.float64)


def _sql_fixed_cells(cells: int) -> str:
    """SQL for every pair with the place of the document's cell: ``placed``."""
    return f"""{_SQL_PAIRS}, centres AS (
  SELECT vec_id AS cell, embedding::DOUBLE[] AS c FROM embeddings WHERE vec_id < {cells}),
near AS (
  SELECT vec_id, cell, row_number() OVER (
           PARTITION BY vec_id ORDER BY list_dot_product(embedding::DOUBLE[], c)
             - list_dot_product(c, c) / 2 DESC, cell) AS place
  FROM embeddings CROSS JOIN centres),
placed AS (
  SELECT r.query_id, r.doc_id, r.score, r.rank, n.place
  FROM ranked r JOIN near o ON o.vec_id = r.doc_id AND o.place = 1
  JOIN near n ON n.vec_id = r.query_id AND n.cell = o.cell)"""


@check(
    f"""WITH {_sql_fixed_cells(16)}, recalls AS (
          SELECT probes, avg(CAST(place <= probes AS DOUBLE)) AS recall
          FROM placed CROSS JOIN range(1, 17) AS r(probes)
          WHERE rank <= 10 AND query_id % 100 = 0 GROUP BY probes),
        chosen AS (
          SELECT probes, recall FROM recalls WHERE recall >= 0.9 ORDER BY probes LIMIT 1),
        found AS (
          SELECT query_id, doc_id, score, probes, recall, row_number() OVER (
                   PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
          FROM placed CROSS JOIN chosen WHERE place <= probes)
        SELECT query_id, doc_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank,
               CAST(probes AS INTEGER) AS probes, round(recall, 6) AS recall,
               true AS recall_is_enough
        FROM found WHERE rank <= 10"""
)
def ann_topk_measured(spark: SparkSession, folder: str) -> DataFrame:
    """Approximate hits, with as many probes as reach a recall of 0.9 on the query
    set, and the recall their search has there against exact search."""
    vectors = table(spark, folder, "embeddings")
    centres = _fixed_centres(vectors, 16)
    stored = materialize(retrieval.assign_cells(vectors, centres))
    asked = vectors.filter(_QUERY_SET)
    ids = ("vec_id", "vec_id")
    probes, _ = retrieval.probes_for_recall(
        asked, stored, centres, 10, 0.9, *ids, skip_equal_ids=True
    )
    found = materialize(
        retrieval.cell_topk(
            vectors, stored, centres, 10, probes, *ids, skip_equal_ids=True
        )
    )
    exact = retrieval.dense_topk(asked, vectors, 10, *ids, skip_equal_ids=True)
    recall = retrieval.recall_at_k(found, exact).first()["recall"]
    return (
        _rounded(found)
        .withColumn("probes", F.lit(probes))
        .withColumn("recall", F.round(F.lit(recall), 6))
        .withColumn("recall_is_enough", F.lit(recall >= 0.9))
    )


# Cuts of the vectors, and of them the centres that SQL knows too: the parts of the first.
_PARTS, _FIRST = 16, 64


def _read(found: DataFrame, many: int, recall: float, share: float) -> DataFrame:
    return (
        found.withColumn("candidates", F.lit(many))
        .withColumn("recall", F.round(F.lit(recall), 6))
        .withColumn("read_share", F.round(F.lit(share), 6))
    )


@check(
    f"""WITH {_SQL_PAIRS}, parts AS (
          SELECT vec_id, p, e[4 * p + 1 : 4 * p + 4] AS v
          FROM (SELECT vec_id, embedding::DOUBLE[] AS e, unnest(range({_PARTS})) AS p
                FROM embeddings)),
        coded AS (
          SELECT vec_id, flatten(list(centre ORDER BY p)) AS d FROM (
            SELECT a.vec_id, a.p, c.v AS centre, row_number() OVER (PARTITION BY a.vec_id, a.p
                     ORDER BY list_dot_product(a.v, c.v) - list_dot_product(c.v, c.v) / 2 DESC,
                     c.vec_id) AS place
            FROM parts a JOIN parts c ON c.p = a.p AND c.vec_id < {_FIRST})
          WHERE place = 1 GROUP BY vec_id),
        near AS (
          SELECT q.vec_id AS query_id, c.vec_id AS doc_id, row_number() OVER (
                   PARTITION BY q.vec_id ORDER BY list_dot_product(q.embedding::DOUBLE[], c.d) DESC,
                   c.vec_id) AS place
          FROM embeddings q JOIN coded c ON c.vec_id <> q.vec_id WHERE q.{_QUERY_SET}),
        recalls AS (
          SELECT n, avg(CAST(place <= n AS DOUBLE)) AS recall
          FROM ranked JOIN near USING (query_id, doc_id)
          CROSS JOIN range(10, (SELECT count(*) + 1 FROM embeddings)) AS r(n)
          WHERE rank <= 10 GROUP BY n),
        chosen AS (SELECT n, recall FROM recalls WHERE recall >= 0.9 ORDER BY n LIMIT 1),
        read AS (
          SELECT ((SELECT count(*) FROM embeddings) * {_PARTS}
                   + count(DISTINCT doc_id) * 256.0) / ((SELECT count(*) FROM embeddings) * 256) AS share
          FROM near CROSS JOIN chosen WHERE place <= n),
        found AS (
          SELECT query_id, doc_id, score, n, recall, row_number() OVER (
                   PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
          FROM ranked JOIN near USING (query_id, doc_id) CROSS JOIN chosen WHERE place <= n)
        SELECT query_id, doc_id, round(score, 6) AS score, CAST(found.rank AS INTEGER) AS rank,
               CAST(n AS INTEGER) AS candidates, round(recall, 6) AS recall,
               round(share, 6) AS read_share
        FROM found CROSS JOIN read WHERE found.rank <= 10"""
)
def code_topk_measured(spark: SparkSession, folder: str) -> DataFrame:
    """Search in codes around fixed centres: the hits of the query set, the candidates
    that a recall of 0.9 takes, and the share of the vectors' bytes that they and the
    codes have."""
    vectors = table(spark, folder, "embeddings")
    first = _fixed_centres(vectors, _FIRST)
    book = codes.Codebook(tuple(np.split(first, _PARTS, axis=1)))
    return _searched_codes(vectors, book)


def _searched_codes(vectors: DataFrame, book: codes.Codebook) -> DataFrame:
    stored = materialize(codes.encode_vectors(vectors, book).select("vec_id", "code"))
    search = (vectors.filter(_QUERY_SET), vectors, stored, book, 10)
    ids = ("vec_id", "vec_id")
    many, recall = codes.candidates_for_recall(*search, 0.9, *ids, skip_equal_ids=True)
    near = codes.code_topk(*search, many, *ids, skip_equal_ids=True, exact_scores=False)
    share = codes.read_share(near, vectors.count(), book)
    found = codes.code_topk(*search, many, *ids, skip_equal_ids=True)
    return _read(_rounded(found), many, recall, share)


@check(
    f"""SELECT vec_id AS query_id, 10 AS hits, true AS recall_is_enough, true AS reads_a_quarter
        FROM embeddings WHERE {_QUERY_SET}"""
)
def code_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The same with learned centres, which find as much with fewer candidates."""
    vectors = table(spark, folder, "embeddings")
    book = codes.learn_codebook(vectors, _PARTS, "vec_id")
    found = _searched_codes(vectors, book)
    return found.groupBy("query_id").agg(
        F.count(F.lit(1)).cast("int").alias("hits"),
        (F.min("recall") >= 0.9).alias("recall_is_enough"),
        (F.max("read_share") <= 0.25).alias("reads_a_quarter"),
    )


@check(
    "SELECT vec_id AS query_id, 40 AS hits FROM embeddings"
)
def cell_topk_further(spark: SparkSession, folder: str) -> DataFrame:
    """Many small cells, of which one holds fewer documents than are asked for."""
    vectors = table(spark, folder, "embeddings")
    centres = retrieval.cell_centres(vectors, 64, "vec_id")
    found = retrieval.cell_topk(vectors, vectors, centres, 40, 1, "vec_id", "vec_id")
    return found.groupBy("query_id").agg(F.count(F.lit(1)).cast("int").alias("hits"))


@check(
    f"""WITH {_sql_fixed_cells(64)}, sizes AS (
          SELECT cell, count(*) AS n FROM near WHERE place = 1 GROUP BY cell),
        held AS (
          SELECT vec_id, place, coalesce(sum(coalesce(n, 0)) OVER (PARTITION BY vec_id
                   ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nearer
          FROM near LEFT JOIN sizes USING (cell)),
        found AS (
          SELECT p.query_id, p.doc_id, p.score, p.rank AS exact_rank, row_number() OVER (
                   PARTITION BY p.query_id ORDER BY p.score DESC, p.doc_id) AS rank
          FROM placed p JOIN held h ON h.vec_id = p.query_id AND h.place = p.place
          WHERE h.nearer < 41)
        SELECT query_id, doc_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank,
               exact_rank <= 40 AS is_among_exact
        FROM found WHERE rank <= 40"""
)
def cell_topk_further_hits(spark: SparkSession, folder: str) -> DataFrame:
    """The hits themselves, around fixed centres, and which of them exact search has."""
    vectors = table(spark, folder, "embeddings")
    centres = _fixed_centres(vectors, 64)
    found = retrieval.cell_topk(
        vectors, vectors, centres, 40, 1, "vec_id", "vec_id", skip_equal_ids=True
    )
    exact = retrieval.dense_topk(
        vectors, vectors, 40, "vec_id", "vec_id", skip_equal_ids=True
    )
    exact = exact.select("query_id", "doc_id", F.lit(True).alias("in_exact"))
    return _rounded(found).join(exact, ["query_id", "doc_id"], "left").select(
        "query_id",
        "doc_id",
        "score",
        "rank",
        F.coalesce("in_exact", F.lit(False)).alias("is_among_exact"),
    )


@check(
    f"""WITH {_SQL_PAIRS}, {SQL_TITLED}, back AS (
          SELECT a.vec_id AS query_id, b.vec_id AS doc_id, row_number() OVER (
                   PARTITION BY a.vec_id ORDER BY list_dot_product(a.embedding::DOUBLE[],
                     list_reverse(b.embedding)::DOUBLE[]) DESC, b.vec_id) AS rank
          FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
        hits AS (
          SELECT query_id, doc_id, rank, 1 AS branch FROM ranked WHERE rank <= 3
          UNION ALL SELECT query_id, doc_id, rank, 2 FROM back WHERE rank <= 2)
        SELECT h.query_id, CAST(row_number() OVER (PARTITION BY h.query_id
                 ORDER BY branch, rank) - 1 AS INTEGER) AS position, t.title, t.content
        FROM hits h JOIN titled t ON t.doc_id = h.doc_id"""
)
def multi_branch(spark: SparkSession, folder: str) -> DataFrame:
    """Two retrieval branches over all vectors, their documents one after the other."""
    vectors = table(spark, folder, "embeddings")
    documents = titled(spark, folder)
    turned = vectors.withColumn("embedding", F.reverse("embedding"))
    rows = vectors.select(F.col("vec_id").alias("query_id"))
    for name, side, k in (("one", vectors, 3), ("two", turned, 2)):
        hits = retrieval.dense_topk(
            vectors, side, k, "vec_id", "vec_id", skip_equal_ids=True
        )
        rows = retrieval.attach_documents(rows, hits, documents, output_key=name)
    rows = retrieval.concat_branches(rows, ["one", "two"])
    flat = rows.select("query_id", F.posexplode("docs").alias("position", "doc"))
    return flat.select("query_id", "position", "doc.title", "doc.content")


_PREFIX = "Find passages for: "


@check(
    f"""WITH {SQL_QA}, {SQL_CHUNKS}, texts AS (
          SELECT chunk_id, concat_ws(chr(10), title, content) AS t FROM chunks),
        {sql_embed("texts", "chunk_id", "t", "c")},
        asked AS (SELECT row_id, '{_PREFIX}' || query AS t FROM qa),
        {sql_embed("asked", "row_id", "t", "q")},
        ranked AS (
          SELECT q.k AS row_id, c.k AS chunk_id, row_number() OVER (PARTITION BY q.k
                   ORDER BY list_dot_product(q.e, c.e) DESC, c.k) AS rank
          FROM q CROSS JOIN c),
        found AS (
          SELECT r.row_id, string_agg(coalesce(c.title, 'None') || ': ' || c.content, chr(10)
                   ORDER BY r.rank) AS context
          FROM ranked r JOIN chunks c ON c.chunk_id = r.chunk_id
          WHERE r.rank <= 3 GROUP BY r.row_id)
        SELECT q.row_id, 'Question: ' || q.query || chr(10) || 'Context:' || chr(10)
                 || f.context AS prompt
        FROM qa q JOIN found f ON f.row_id = q.row_id"""
)
def retrieve_prompt(spark: SparkSession, folder: str) -> DataFrame:
    """Index the documents, find passages for every question, build its prompt."""
    index = materialize(corpus.build_index(titled(spark, folder), corpus.HashingEmbedder))
    rows = qa(spark, folder).select("row_id", "query")
    rows = retrieval.retrieve(
        rows, index, corpus.HashingEmbedder, "row_id", k=3, prefix=_PREFIX
    )
    rows = columns.title_documents(rows, "positive_passages")
    rows = columns.join_documents(rows, "positive_passages")
    rows = prompts.text_prompt(
        rows, templates.QA, {"question": "query", "context": "positive_passages"}
    )
    return rows.select("row_id", "prompt")
