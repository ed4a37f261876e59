"""Search in product-quantised codes, with the best candidates scored in full.

A vector is cut into parts, and each part is stored as the number of its nearest
centre, one byte a part. A query's dot product with a code is a sum of one number a
part, from a table of the query's products with all centres. That scan reads the codes
alone; only the best candidates of each query are then looked up and scored in full.

* The centres are learned from a bounded sample (``LEARNING_ROWS`` rows in expectation),
  each part in a task of its own. All vectors are encoded.
* How many candidates a query needs is measured: ``candidates_for_recall``.

Defined cases: a vector that is null, of another length or not finite ends encoding and
search with an error that names it, or with ``skip_invalid`` has no code, is no
candidate, and as a query has no hits. Ties go to the lower id. Empty tables give no
hits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ragtables.functions.draws import keyed_uniform
from ragtables.operators.columns import quoted, require
from ragtables.operators.retrieval import (
    LEAST_RECALL,
    MEASURED_QUERIES,
    SENT_BYTES,
    SENT_ROWS,
    _arrow_schema,
    _checked,
    _dimension,
    _lower_edge,
    _ordered_scores,
    _ranked,
    _refuse,
    _result_schema,
    _sides,
    best_per_row,
    dense_topk,
)
from ragtables.operators.sampling import row_index
from ragtables.sources.storage import fresh_path, materialize

# Rows, in expectation, from which centres are learned.
LEARNING_ROWS = 20_000
CENTRES = 256  # what a byte can tell apart
ITERATIONS = 15
# Numbers in the tables of the queries that are sent at once (32 MB), and in one block
# of approximate scores.
TABLE_NUMBERS = 4_000_000
SCORES = 4_000_000
# Candidates of all queries that a task holds (96 MB, and a few times that to sort them).
HELD_CANDIDATES = 4_000_000


@dataclass(frozen=True)
class Codebook:
    """The centres of each part of a vector, ``(at most 256, width)`` a part."""

    centres: tuple[np.ndarray, ...]

    @property
    def dimension(self) -> int:
        return sum(c.shape[1] for c in self.centres)

    def parts(self, matrix: np.ndarray) -> list[np.ndarray]:
        ends = np.cumsum([c.shape[1] for c in self.centres])
        return np.split(matrix, ends[:-1], axis=1)

    def encode(self, matrix: np.ndarray) -> np.ndarray:
        """The nearest centre of each part of each row, the lower one of a tie."""
        codes = np.empty((len(matrix), len(self.centres)), np.uint8)
        step = max(1, SCORES // CENTRES)
        for start in range(0, len(matrix), step):
            rows = slice(start, start + step)
            for i, (part, centres) in enumerate(zip(self.parts(matrix[rows]), self.centres)):
                half = (centres * centres).sum(axis=1) / 2
                codes[rows, i] = np.argmax(part @ centres.T - half, axis=1)
        return codes

    def tables(self, queries: np.ndarray) -> list[np.ndarray]:
        """Each query's products with the centres, ``(queries, centres)`` a part."""
        return [
            np.cumsum(part[:, None, :] * centres[None], axis=2)[:, :, -1]
            for part, centres in zip(self.parts(queries), self.centres)
        ]

    def to_table(self, spark: SparkSession) -> DataFrame:
        """The codebook as rows to store: ``part, centres``."""
        rows = [(i, c.tolist()) for i, c in enumerate(self.centres)]
        return spark.createDataFrame(rows, "part int, centres array<array<double>>")


def codebook_from(table: DataFrame) -> Codebook:
    """The codebook of a table with ``part, centres``, a row a part."""
    rows = sorted((r["part"], r["centres"]) for r in table.select("part", "centres").collect())
    return Codebook(tuple(np.array(c, np.float64) for _, c in rows))


def _fitted(points: np.ndarray, seed: int) -> np.ndarray:
    """Centres of some points, by Lloyd's iteration from distinct ones."""
    distinct = np.unique(points, axis=0)
    draws = np.random.default_rng(seed)
    chosen = draws.choice(len(distinct), min(CENTRES, len(distinct)), replace=False)
    centres = distinct[np.sort(chosen)]
    for _ in range(ITERATIONS):
        half = (centres * centres).sum(axis=1) / 2
        nearest = np.argmax(points @ centres.T - half, axis=1)
        sizes = np.bincount(nearest, minlength=len(centres))
        sums = np.stack(
            [np.bincount(nearest, column, minlength=len(centres)) for column in points.T], axis=1
        )
        moved = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres


def learn_codebook(
    corpus: DataFrame,
    parts: int,
    doc_key: str = "doc_id",
    doc_vector: str = "embedding",
    seed: int = 0,
    learning_rows: int = LEARNING_ROWS,
) -> Codebook:
    """Centres of ``parts`` parts from about ``learning_rows`` whole vectors, drawn by
    their id. A part is fitted in one task, from that sample alone."""
    require(corpus, [doc_key, doc_vector])
    vectors = corpus.select(quoted(doc_key).alias("id"), quoted(doc_vector).alias("vector"))
    dimension = _dimension(vectors, "vector")
    if not 0 < parts <= dimension:
        raise ValueError(f"{dimension} components cannot be cut into {parts} parts")
    ends = [len(a) for a in np.array_split(np.arange(dimension), parts)]
    starts = np.cumsum([0, *ends])
    share = learning_rows / max(1, vectors.count())
    drawn = vectors.filter(keyed_uniform(seed, F.col("id")) < share)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, matrix = _checked(batch["id"], batch["vector"], dimension, skip_invalid=True)
            for part in range(parts):
                own = matrix[:, starts[part] : starts[part + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(own), pa.int32()), pa.array(list(own), pa.list_(pa.float64()))],
                    ["part", "point"],
                )

    def fit(key: tuple[pa.Scalar, ...], points: pa.Table) -> pa.Table:
        # Rows come in any order; sorting makes the sums the same in every run.
        rows = np.array(points["point"].to_pylist())
        centres = _fitted(rows[np.lexsort(rows.T)], seed)
        return pa.table(
            {
                "part": pa.array([key[0].as_py()], pa.int32()),
                "centres": pa.array([centres.tolist()], pa.list_(pa.list_(pa.float64()))),
            }
        )

    fitted = (
        drawn.mapInArrow(cut, "part int, point array<double>")
        .groupBy("part")
        .applyInArrow(fit, "part int, centres array<array<double>>")
    )
    book = codebook_from(fitted)  # 256 centres a part at most
    if not book.centres:
        return Codebook(tuple(np.zeros((1, n)) for n in ends))
    return book


def encode_vectors(
    corpus: DataFrame, book: Codebook, doc_vector: str = "embedding", skip_invalid: bool = False
) -> DataFrame:
    """Add the ``code`` of each vector, a byte a part. Store the ids and codes as a table
    of their own, so that the scan of codes reads nothing else."""
    dimension = book.dimension

    @F.arrow_udf("binary")
    def code(vectors: pa.Array) -> pa.Array:
        rows = pa.array(range(len(vectors)), pa.int64())
        whole, matrix = _checked(rows, vectors, dimension, skip_invalid)
        found: list[bytes | None] = [None] * len(vectors)
        for row, own in zip(whole, book.encode(matrix)):
            found[row] = own.tobytes()
        return pa.array(found, pa.binary())

    return corpus.withColumn("code", code(quoted(doc_vector)))


class _Sent:
    """A counted set of queries, as all tasks get it."""

    def __init__(self, queries: DataFrame, dimension: int, skip_invalid: bool) -> None:
        found = queries.toArrow()
        self.ids, self.vectors = _checked(
            found["query_id"], found["query_vector"], dimension, skip_invalid
        )


def _nearest_codes(
    sent: _Sent, codes: DataFrame, book: Codebook, many: int, skip_equal_ids: bool, schema
) -> DataFrame:
    """The ``many`` best codes of each query in every task."""
    shared = codes.sparkSession.sparkContext.broadcast((sent.ids, book.tables(sent.vectors)))
    arrow, parts = _arrow_schema(schema), len(book.centres)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, tables = shared.value
        step = max(1, SCORES // max(1, len(ids)))
        kept = None
        floor = np.full(len(ids), np.finfo(np.float64).min)
        place = pd.Series(np.arange(len(ids)), index=ids)
        for batch in batches:
            names = batch["doc_id"].to_numpy(zero_copy_only=False)
            cells = np.frombuffer(b"".join(batch["code"].to_pylist()), np.uint8).reshape(-1, parts)
            for start in range(0, len(names) if len(ids) else 0, step):
                own, name = cells[start : start + step], names[start : start + step]
                scores = np.zeros((len(ids), len(own)))
                for i, known in enumerate(tables):
                    scores += known[:, own[:, i]]
                if skip_equal_ids:
                    at = place.reindex(name).to_numpy()
                    equal = np.flatnonzero(~np.isnan(at))
                    scores[at[equal].astype(np.int64), equal] = -np.inf
                edge = np.maximum(_lower_edge(scores, many), floor)
                rows, columns = np.nonzero(scores >= edge[:, None])
                found = pd.DataFrame(
                    {"row": rows, "doc_id": name[columns], "score": scores[rows, columns]}
                )
                both = found if kept is None else pd.concat([kept, found])
                kept = best_per_row(both, many)
                worst = kept.groupby("row")["score"].agg(["size", "min"])
                worst = worst[worst["size"] == many]
                floor[worst.index] = worst["min"]
        if kept is not None and len(kept):
            columns = [ids[kept["row"]], kept["doc_id"], kept["score"]]
            arrays = [pa.array(c, type=f.type) for c, f in zip(columns, arrow)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return codes.select("doc_id", "code").mapInArrow(scan, schema)


def _scored(
    sent: _Sent, candidates: DataFrame, docs: DataFrame, dimension: int, schema, skip_invalid: bool
) -> DataFrame:
    """Candidates with their exact scores. A document is looked up once, with the list
    of the queries that ask for it, which is no longer than the set that is sent."""
    candidates = materialize(candidates.select("query_id", "doc_id"))
    asked = candidates.groupBy("doc_id").agg(F.collect_list("query_id").alias("asking"))
    width = F.octet_length(F.concat_ws(",", "query_id", "doc_id")) + 32
    size = candidates.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    if size <= SENT_BYTES:
        asked = F.broadcast(asked)
    shared = docs.sparkSession.sparkContext.broadcast((sent.ids, sent.vectors))
    arrow = _arrow_schema(schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = shared.value
        place = pd.Series(np.arange(len(ids)), index=ids)
        for batch in batches:
            rows = pa.array(range(batch.num_rows), pa.int64())
            whole, matrix = _checked(rows, batch["doc_vector"], dimension, skip_invalid)
            for row, vector in zip(whole, matrix):
                asking = batch["asking"][row].values.to_numpy(zero_copy_only=False)
                exact = _ordered_scores(vectors[place.loc[asking].to_numpy()], vector[None])
                names = [batch["doc_id"][row].as_py()] * len(asking)
                arrays = [pa.array(c, type=f.type) for c, f in zip((asking, names, exact), arrow)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return docs.join(asked, "doc_id").mapInArrow(score, schema)


def code_topk(
    queries: DataFrame,
    corpus: DataFrame,
    codes: DataFrame,
    book: Codebook,
    k: int = 10,
    candidates: int | None = None,
    query_key: str = "query_id",
    doc_key: str = "doc_id",
    query_vector: str = "embedding",
    doc_vector: str = "embedding",
    skip_equal_ids: bool = False,
    skip_invalid: bool = False,
    exact_scores: bool = True,
    table_numbers: int = TABLE_NUMBERS,
) -> DataFrame:
    """Approximate top ``k``: ``query_id, doc_id, score, rank``.

    ``codes`` holds the id and ``code`` of every vector of ``corpus``. The ``candidates``
    best codes of a query are scored in full; without a number it is the least that finds
    ``LEAST_RECALL`` of the exact hits of a sample of the queries. Without
    ``exact_scores`` the candidates themselves are returned, by approximate score.
    More queries than may be sent at once go in several sets, with one scan each.
    """
    schema = _result_schema(queries, query_key, corpus, doc_key)
    left, docs = _sides(queries, corpus, query_key, doc_key, query_vector, doc_vector)
    require(codes, [doc_key, "code"])
    cells = codes.select(quoted(doc_key).alias("doc_id"), "code").filter("code is not null")
    spark = corpus.sparkSession
    dimension = book.dimension
    if not skip_invalid:
        _refuse(left, "query_id", "query_vector", dimension)
    if candidates is None:
        left = materialize(left)  # sampled and searched
        share = MEASURED_QUERIES / max(1, left.count())
        candidates, _ = candidates_for_recall(
            left.filter(keyed_uniform(0, F.col("query_id")) < share),
            corpus, codes, book, k, LEAST_RECALL, "query_id", doc_key, "query_vector",
            doc_vector, skip_equal_ids, skip_invalid,
        )
    many = max(k, candidates)

    def one_set(part: DataFrame) -> DataFrame:
        sent = _Sent(part, dimension, skip_invalid)
        near = _ranked(_nearest_codes(sent, cells, book, many, skip_equal_ids, schema), many)
        if not exact_scores:
            return near
        return _ranked(_scored(sent, near, docs, dimension, schema, skip_invalid), k)

    numbers = sum(len(c) for c in book.centres) + dimension
    allowed = max(1, min(SENT_ROWS, table_numbers // numbers, HELD_CANDIDATES // many))
    if left.limit(allowed + 1).count() <= allowed:
        return one_set(left)
    numbered = materialize(row_index(left, "query_id"))
    path = fresh_path(spark, "hits")
    kind = _ranked(spark.createDataFrame([], schema), k).schema
    for number in range(math.ceil(numbered.count() / allowed)):
        own = (F.col("idx") >= number * allowed) & (F.col("idx") < (number + 1) * allowed)
        one_set(numbered.filter(own).drop("idx")).write.mode("append").parquet(path)
    return spark.read.schema(kind).parquet(path)


def candidates_for_recall(
    queries: DataFrame,
    corpus: DataFrame,
    codes: DataFrame,
    book: Codebook,
    k: int = 10,
    least: float = LEAST_RECALL,
    query_key: str = "query_id",
    doc_key: str = "doc_id",
    query_vector: str = "embedding",
    doc_vector: str = "embedding",
    skip_equal_ids: bool = False,
    skip_invalid: bool = False,
) -> tuple[int, float]:
    """The fewest candidates a query that hold at least ``least`` of the exact hits of
    ``queries``, and the share they hold. Without hits it is ``k``.

    A candidate is scored in full, so an exact hit is found just when it is a candidate:
    its place among the codes tells for every number. Longer lists are tried until one
    is long enough, or holds the corpus.
    """
    names = (query_key, doc_key, query_vector, doc_vector, skip_equal_ids)
    exact = materialize(dense_topk(queries, corpus, k, *names, skip_invalid=skip_invalid))
    wanted, held = exact.count(), corpus.count()
    if not wanted:
        return k, 1.0
    many = 4 * k
    while True:
        near = code_topk(
            queries, corpus, codes, book, k, many, *names, skip_invalid, exact_scores=False
        )
        places = near.select("query_id", "doc_id", F.col("rank").alias("place"))
        hits = exact.select("query_id", "doc_id").join(places, ["query_id", "doc_id"])
        counted = hits.groupBy("place").count().collect()  # a row per place at most
        found = np.zeros(many, np.int64)
        for r in counted:
            found[r["place"] - 1] = r["count"]
        recall = np.cumsum(found) / wanted
        if recall[-1] >= least or many >= held:
            number = int(np.argmax(recall >= least)) + 1 if recall[-1] >= least else many
            number = max(k, number)
            return number, float(recall[number - 1])
        many *= 4


def read_share(candidates: DataFrame, corpus_rows: int, book: Codebook, component_bytes: int = 4) -> float:
    """Bytes of all codes and of the vectors that are candidates, as a share of the bytes
    of all vectors: what is decoded and scored. The files that hold a candidate are
    scanned for it, so fewer bytes leave the disk only where candidates lie together."""
    vector = book.dimension * component_bytes
    looked_up = candidates.select("doc_id").distinct().count()
    return (corpus_rows * len(book.centres) + looked_up * vector) / max(1, corpus_rows * vector)
