"""Dense retrieval: the ``top_k`` corpus vectors of each query by dot product.

Scores come from block matrix products, and a block gives out no more than its
own best ``k`` per query, so no pair of vectors ever becomes a row.

* ``dense_topk`` is exact. A counted set of queries is sent to the corpus, which
  then is scanned in place without a shuffle. More queries are sent in several sets where
  each gives a scan enough to do; of the corpus a share is searched first, and what it
  finds is a floor for the rest. Otherwise both sides are cut into blocks, and every block
  meets every other in one job.
* ``cell_topk`` is approximate. Vectors belong to the cell of their nearest
  centre, and a query looks only into its nearest cells, and into further ones
  until they hold ``k`` documents. A cell is cut into blocks by its counted size, so
  a cell with a third of the corpus is no hot spot.

Candidates are found with the fast matrix product and then scored again in a
fixed order of summation, so ties and results do not depend on block borders.

A vector that is null, has another length than the others or holds an undefined or
infinite number ends the search with an error that names its id; with
``skip_invalid`` such a document is no candidate, and such a query has no hits.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast, TaskContext
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ragtables.functions.draws import keyed_uniform
from ragtables.operators.columns import quoted, require
from ragtables.operators.corpus import Embedder, embed
from ragtables.operators.joins import lookup_join
from ragtables.operators.sampling import row_index
from ragtables.sources.storage import fresh_path, materialize

# Rows on either side of one matrix product, whose scores stay near the processor.
QUERY_ROWS = 1024
DOC_ROWS = 1024
# A block of a cell's documents is not cut finer than this to use all cores.
BLOCK_ROWS = 8192
# Vector components in one block of a side (64 MB in double precision); twice as many of
# documents in single precision.
BLOCK_COMPONENTS = 8_000_000
# Queries are sent to all tasks up to this many rows and vector components (32 MB).
SENT_ROWS = 16_384
SENT_COMPONENTS = 4_000_000
# A set of queries is worth a scan of its own from this many pairs with documents on, and
# this part of the documents is searched first.
SCAN_PAIRS = 4_000_000_000
FLOOR_SHARE = 8
# Hits are sent to all tasks up to this many bytes.
SENT_BYTES = 32_000_000
# Pairs scored again at a time.
_SLICE = 200_000
# Single precision is used for vectors no longer than this, whose products it holds. What
# it takes for zero is, times the length of the other vector, far less than _LOST.
_SINGLE_LENGTH = 1e15
_LOST = 1e-20


def _checked(
    ids: pa.Array | pa.ChunkedArray,
    vectors: pa.Array | pa.ChunkedArray,
    dimension: int,
    skip_invalid: bool,
    single: bool = False,
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and the matrix of their vectors, all of them whole.

    ``single`` leaves vectors in single precision as they are.
    """
    if isinstance(vectors, pa.ChunkedArray):
        ids, vectors = ids.combine_chunks(), vectors.combine_chunks()
    size = pa.compute.fill_null(pa.compute.list_value_length(vectors), -1)
    fits = size.to_numpy(zero_copy_only=False) == dimension
    kept = vectors if fits.all() else vectors.filter(pa.array(fits))
    flat = kept.flatten().to_numpy(zero_copy_only=False)
    if not single or flat.dtype != np.float32:
        flat = flat.astype(np.float64, copy=False)
    matrix = flat.reshape(-1, dimension)
    whole = np.isfinite(matrix).all(axis=1)
    names = ids.to_numpy(zero_copy_only=False)
    if fits.all() and whole.all():
        return names, matrix
    if not skip_invalid:
        bad = names[~fits][0] if not fits.all() else names[fits][~whole][0]
        raise ValueError(f"the vector of {bad!r} is not {dimension} finite numbers")
    return names[fits][whole], matrix[whole]


def _ordered_scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row-wise dot products, summed from the first component to the last."""
    return np.cumsum(np.multiply(left, right, dtype=np.float64), axis=1)[:, -1]


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64))


def _lower_edge(scores: np.ndarray, k: int) -> np.ndarray:
    """A value per row that at least ``k`` scores of the row reach.

    The best of each of many strips is a score, so the ``k``-th of those bests will
    do; finding it reads the scores once instead of sorting them in part.
    """
    rows, columns = scores.shape
    if columns <= k:
        return np.full(rows, -np.inf)
    width = columns // (8 * k)
    if width > 1:
        whole = columns - columns % width
        scores = scores[:, :whole].reshape(rows, -1, width).max(axis=2)
    return np.partition(scores, -k, axis=1)[:, -k]


def _places(
    rows: np.ndarray, scores: np.ndarray, doc_ids: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The order by row, falling score and id, and the place of each within its row."""
    order = np.lexsort((-scores, rows))
    row, score = rows[order], scores[order]
    first = np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    # Ids, which may be dear to compare, are looked at where scores are equal.
    equal = ~(score[1:] < score[:-1]) & ~first[1:]
    if equal.any():
        tied = np.zeros(len(row), bool)
        tied[1:] = equal
        tied[:-1] |= equal
        at = order[tied]
        codes = pd.factorize(doc_ids[at], sort=True)[0]
        rank = np.where(codes < 0, len(codes), codes)  # null comes last
        order[tied] = at[np.lexsort((rank, -scores[at], rows[at]))]
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, len(row)))
    return order, np.arange(len(row)) - np.repeat(starts, sizes)


def best_per_row(found: pd.DataFrame, k: int) -> pd.DataFrame:
    order, place = _places(
        found["row"].to_numpy(), found["score"].to_numpy(), found["doc_id"].to_numpy()
    )
    return found.iloc[order[place < k]]


class _Search:
    """The best ``k`` documents per query over all documents seen so far."""

    def __init__(
        self,
        ids: np.ndarray,
        vectors: np.ndarray,
        k: int,
        skip: bool,
        floor: np.ndarray | None = None,
    ):
        self.ids, self.vectors, self.k, self.skip = ids, vectors, k, skip
        self.lengths = _lengths(vectors)
        self.narrow = self._narrow(vectors, self.lengths)
        # Documents that score below a query's floor are of no interest.
        self.floor = np.full(len(ids), -np.inf) if floor is None else floor.copy()
        starts = range(0, len(ids), QUERY_ROWS)
        self.parts = [slice(start, start + QUERY_ROWS) for start in starts]
        self.scores = np.full((len(ids), k), -np.inf)
        self.docs: np.ndarray | None = None
        self.waiting: list[list[tuple[np.ndarray, ...]]] = [[] for _ in self.parts]
        self.space = np.empty(0, np.float32)

    @staticmethod
    def _narrow(vectors: np.ndarray, lengths: np.ndarray) -> np.ndarray | None:
        """The vectors in single precision, where that holds their products."""
        if lengths.max(initial=0) < _SINGLE_LENGTH:
            return vectors.astype(np.float32, copy=False)
        return None

    def see(self, doc_ids: np.ndarray, docs: np.ndarray) -> None:
        """Searches some documents, if any."""
        if not len(doc_ids) or not len(self.ids):
            return
        if self.docs is None:
            self.docs = np.empty(self.scores.shape, doc_ids.dtype)
        elif self.docs.dtype != doc_ids.dtype:
            self.docs = self.docs.astype(np.result_type(self.docs, doc_ids))
        lengths = _lengths(docs)
        narrow = self._narrow(docs, lengths)
        own = self._own(doc_ids) if self.skip else None
        for start in range(0, len(doc_ids), DOC_ROWS):
            rows = slice(start, start + DOC_ROWS)
            length = lengths[rows].max()
            for number, part in enumerate(self.parts):
                if narrow is None or self.narrow is None:
                    left = self.vectors[part].astype(np.float64, copy=False)
                    scores = left @ docs[rows].T.astype(np.float64, copy=False)
                else:
                    left, right = self.narrow[part], narrow[rows]
                    shape = len(left), len(right)
                    if self.space.size < shape[0] * shape[1]:
                        self.space = np.empty(shape[0] * shape[1], np.float32)
                    scores = self.space[: shape[0] * shape[1]].reshape(shape)
                    np.matmul(left, right.T, out=scores)
                if own is not None:
                    pair = own[start // DOC_ROWS, number]
                    scores[pair["row"] - part.start, pair["column"] - start] = -np.inf
                at, columns = self._reaching(scores, part, length)
                self._score(number, at + part.start, columns + start, doc_ids, docs)
        for number in range(len(self.parts)):
            self._merge(number)

    def _own(self, doc_ids: np.ndarray) -> dict[tuple[int, int], pd.DataFrame]:
        """Pairs of a query and a document with one id, by their matrix product."""
        own = pd.merge(
            pd.DataFrame({"id": self.ids, "row": np.arange(len(self.ids))}),
            pd.DataFrame({"id": doc_ids, "column": np.arange(len(doc_ids))}),
            on="id",
        )
        none = own.iloc[:0]
        by = [own["column"] // DOC_ROWS, own["row"] // QUERY_ROWS]
        return defaultdict(lambda: none, iter(own.groupby(by)))

    def _reaching(
        self, scores: np.ndarray, part: slice, length: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """Where a product may reach the floor or, where that lets too much through,
        be among the block's best ``k``."""
        kind = scores.dtype
        # The product differs from the ordered sum by less than half of this: a rounding
        # of each component and one an addition, and once more for the edge itself.
        rounding = 2 * (self.vectors.shape[1] + 4) * np.finfo(kind).eps
        slack = rounding * self.lengths[part] * length + _LOST
        # Skipped pairs lie below every finite edge.
        least = np.finfo(kind).min

        def above(edge: np.ndarray) -> np.ndarray:
            with np.errstate(over="ignore"):
                return np.maximum(edge - slack, least).astype(kind)

        floor = self.floor[part]
        edge = above(floor)
        if kind == np.float32:
            # In most products few queries, if any, have a document that gets so far.
            asked = np.flatnonzero(scores.max(axis=1) >= edge)
            if len(asked) < len(scores):
                scores, floor, edge, slack = scores[asked], floor[asked], edge[asked], slack[asked]
        else:
            asked = np.arange(len(scores))  # products may be undefined
        near = scores >= edge[:, None] if np.isfinite(floor).all() else None
        if near is None or np.count_nonzero(near) > self.k * len(scores):
            edge = above(np.maximum(_lower_edge(scores, self.k), floor))
            near = scores >= edge[:, None]
        rows, columns = np.divmod(np.flatnonzero(near), scores.shape[1])
        return asked[rows], columns

    def _score(
        self,
        number: int,
        rows: np.ndarray,
        columns: np.ndarray,
        doc_ids: np.ndarray,
        docs: np.ndarray,
    ) -> None:
        """Scores pairs again, in order; those that reach the floor wait to be merged."""
        for start in range(0, len(rows), _SLICE):
            row, column = rows[start : start + _SLICE], columns[start : start + _SLICE]
            score = _ordered_scores(self.vectors[row], docs[column])
            reach = score >= self.floor[row]
            found = row[reach], score[reach], doc_ids[column[reach]]
            self.waiting[number].append(found)
        part = self.parts[number]
        if sum(len(f[0]) for f in self.waiting[number]) >= len(self.floor[part]):
            self._merge(number)

    def _merge(self, number: int) -> None:
        """Puts what waits among the best and raises the floors."""
        if not self.waiting[number]:
            return
        rows, scores, names = (np.concatenate(c) for c in zip(*self.waiting[number]))
        self.waiting[number] = []
        touched = np.unique(rows)
        had, place = np.nonzero(self.scores[touched] > -np.inf)
        kept = touched[had], place
        rows = np.concatenate([kept[0], rows])
        scores = np.concatenate([self.scores[kept], scores])
        names = np.concatenate([self.docs[kept], names])
        order, place = _places(rows, scores, names)
        best = order[place < self.k]
        at = rows[best], place[place < self.k]
        self.scores[at], self.docs[at] = scores[best], names[best]
        # The worst score of each query that has k documents already.
        self.floor[touched] = np.maximum(self.floor[touched], self.scores[touched, -1])

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for part in self.parts:
            rows, place = np.nonzero(self.scores[part] > -np.inf)
            if len(rows):
                columns = [
                    self.ids[part][rows],
                    self.docs[part][rows, place],
                    self.scores[part][rows, place],
                ]
                arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def _result_schema(
    queries: DataFrame, query_key: str, corpus: DataFrame, doc_key: str
) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema[query_key].dataType),
            T.StructField("doc_id", corpus.schema[doc_key].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """Merge the blocks' best to the best ``k`` per query, ranked from 1.

    Spark keeps ``k`` rows per query before the shuffle (WindowGroupLimit).
    """
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k)


def _dimension(df: DataFrame, vector_key: str) -> int:
    """The usual length of a vector: that of most rows, the larger one of a tie."""
    sizes = df.groupBy(F.array_size(quoted(vector_key)).alias("n")).count()
    usual = sizes.filter("n > 0").orderBy(F.desc("count"), F.desc("n")).first()
    return usual["n"] if usual else 1


def _sides(
    queries: DataFrame,
    corpus: DataFrame,
    query_key: str,
    doc_key: str,
    query_vector: str,
    doc_vector: str,
) -> tuple[DataFrame, DataFrame]:
    require(queries, [query_key, query_vector])
    require(corpus, [doc_key, doc_vector])
    return (
        queries.select(
            quoted(query_key).alias("query_id"), quoted(query_vector).alias("query_vector")
        ),
        corpus.select(
            quoted(doc_key).alias("doc_id"), quoted(doc_vector).alias("doc_vector")
        ),
    )


def dense_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 10,
    query_key: str = "query_id",
    doc_key: str = "doc_id",
    query_vector: str = "embedding",
    doc_vector: str = "embedding",
    skip_equal_ids: bool = False,
    sent_components: int = SENT_COMPONENTS,
    skip_invalid: bool = False,
) -> DataFrame:
    """Exact top ``k``: ``query_id, doc_id, score, rank``; ties go to the lower id.

    ``skip_equal_ids`` leaves out a document with the query's own id. With more
    queries than may be sent at once, the hits are computed and stored here.
    """
    schema = _result_schema(queries, query_key, corpus, doc_key)
    left, right = _sides(
        queries, corpus, query_key, doc_key, query_vector, doc_vector
    )
    dimension = _dimension(left, "query_vector")
    allowed = max(1, min(SENT_ROWS, sent_components // dimension))
    options = (right, k, skip_equal_ids, skip_invalid, schema, dimension)
    few = left.limit(allowed + 1).count()
    if not few:
        return _ranked(corpus.sparkSession.createDataFrame([], schema), k)
    if few <= allowed:
        return _ranked(_scan(left, *options), k)
    numbered = materialize(row_index(left, "query_id"))
    if not skip_invalid:
        _refuse(numbered, "query_id", "query_vector", dimension)
    rows = max(1, sent_components // dimension)
    if min(rows, numbered.count()) * right.count() >= SCAN_PAIRS:
        return _scan_sets(numbered, rows, *options)
    one = F.lit(0).alias("cell")
    found = _grid(
        numbered.select(one, "*"),
        right.select(one, "*"),
        k,
        skip_equal_ids,
        skip_invalid,
        schema,
        dimension,
        query_number=F.col("idx"),
    )
    path = fresh_path(corpus.sparkSession, "hits")
    hits = _ranked(found, k)
    hits.write.parquet(path)
    return corpus.sparkSession.read.schema(hits.schema).parquet(path)


# With fewer partitions than this, a floor for the scores is not worth a pass.
FLOOR_PARTITIONS = 64


def _scan(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    skip_equal_ids: bool,
    skip_invalid: bool,
    schema: T.StructType,
    dimension: int,
) -> DataFrame:
    """Send the few queries to every task and read the corpus in place.

    Every task would hand out ``k`` hits a query. With many partitions, some of them
    are searched first; their ``k``-th best score is a floor that the others need not
    go below. It skips what cannot win, so the result is the same.
    """
    context = corpus.sparkSession.sparkContext
    options = (k, skip_equal_ids, skip_invalid, schema, dimension)
    # At most SENT_ROWS rows and SENT_COMPONENTS components: the caller counted.
    ids, vectors = _collected(queries, dimension, skip_invalid)
    sent = context.broadcast((ids, vectors))
    partitions = corpus.rdd.getNumPartitions()
    if partitions < FLOOR_PARTITIONS:
        return corpus.mapInArrow(_searching(sent, None, *options), schema)
    step = math.isqrt(partitions)
    some = corpus.mapInArrow(_searching(sent, None, *options, step), schema)
    floors = context.broadcast(_floors(_ranked(some, k), ids, k))
    return corpus.mapInArrow(_searching(sent, floors, *options), schema)


def _scan_sets(
    numbered: DataFrame,
    rows: int,
    corpus: DataFrame,
    k: int,
    skip_equal_ids: bool,
    skip_invalid: bool,
    schema: T.StructType,
    dimension: int,
) -> DataFrame:
    """The hits of all queries, a set of at most ``rows`` of them after the other, stored.

    Nothing but hits is shuffled. A share of the documents is searched by a few tasks;
    the ``k``-th best score there is a floor, and from the other documents the many tasks
    of a scan hand out only what reaches it. The corpus is read twice for each set.
    """
    spark = corpus.sparkSession
    tasks = 2 * spark.sparkContext.defaultParallelism
    options = (k, skip_equal_ids, skip_invalid, schema, dimension)
    if corpus.rdd.getNumPartitions() < tasks:
        corpus = corpus.repartition(2 * tasks, "doc_id")
    is_first = F.pmod(F.xxhash64("doc_id", F.lit("floor")), F.lit(FLOOR_SHARE)) == 0
    paths = []
    for number in range(math.ceil(numbered.count() / rows)):
        one = numbered.filter(F.col("idx").between(number * rows, (number + 1) * rows - 1))
        ids, vectors = _collected(one, dimension, skip_invalid)
        sent = spark.sparkContext.broadcast((ids, vectors))
        search = _searching(sent, None, *options)
        share = corpus.filter(is_first).coalesce(tasks)
        first = materialize(_ranked(share.mapInArrow(search, schema), k))
        floors = spark.sparkContext.broadcast(_floors(first, ids, k))
        search = _searching(sent, floors, *options)
        rest = corpus.filter(~is_first).mapInArrow(search, schema)
        hits = _ranked(rest.unionByName(first.drop("rank")), k)
        paths.append(fresh_path(spark, "hits"))
        hits.write.parquet(paths[-1])
        floors.destroy()
        sent.destroy()
    return spark.read.schema(hits.schema).parquet(*paths)


def _collected(
    queries: DataFrame, dimension: int, skip_invalid: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of queries that the caller has counted."""
    table = queries.select("query_id", "query_vector").toArrow()
    return _checked(
        table["query_id"], table["query_vector"], dimension, skip_invalid, single=True
    )


def _floors(ranked: DataFrame, ids: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th best score of each query, where it has so many hits."""
    last = ranked.filter(F.col("rank") == k).select("query_id", "score")
    found = last.toArrow()  # a row per query sent
    known = dict(zip(found["query_id"].to_pylist(), found["score"].to_pylist()))
    return np.array([known.get(i, -np.inf) for i in ids.tolist()], np.float64)


def _searching(
    sent: Broadcast,
    floors: Broadcast | None,
    k: int,
    skip_equal_ids: bool,
    skip_invalid: bool,
    schema: T.StructType,
    dimension: int,
    step: int = 0,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A search of a task's documents, or of those of every ``step``-th task only."""
    arrow = _arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if step and TaskContext.get().partitionId() % step:
            return
        floor = None if floors is None else floors.value
        search = _Search(*sent.value, k, skip_equal_ids, floor)
        for batch in batches:
            search.see(
                *_checked(
                    batch.column("doc_id"),
                    batch.column("doc_vector"),
                    dimension,
                    skip_invalid,
                    single=True,
                )
            )
        yield from search.batches(arrow)

    return scan


def _arrow_type(dtype: T.DataType) -> pa.DataType:
    known = {
        T.LongType(): pa.int64(),
        T.IntegerType(): pa.int32(),
        T.StringType(): pa.string(),
    }
    if dtype not in known:
        raise TypeError(f"an id must be a long, an int or a string, not {dtype}")
    return known[dtype]


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    return pa.schema(
        [
            ("query_id", _arrow_type(schema["query_id"].dataType)),
            ("doc_id", _arrow_type(schema["doc_id"].dataType)),
            ("score", pa.float64()),
        ]
    )


def _doc_rows(corpus: DataFrame, dimension: int) -> int:
    """The most documents in one block."""
    kind = corpus.schema["doc_vector"].dataType
    narrow = isinstance(kind, T.ArrayType) and kind.elementType == T.FloatType()
    return max(1, (2 if narrow else 1) * BLOCK_COMPONENTS // dimension)


def _grid(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    skip_equal_ids: bool,
    skip_invalid: bool,
    schema: T.StructType,
    dimension: int,
    query_number: Column | None = None,
) -> DataFrame:
    """Cut each cell's queries and documents into blocks and match block with block.

    The number of blocks follows the counted size of a cell, on either side, so
    every group is bounded however full its cell is. Every block of documents is
    sent to each block of queries and the other way round, so blocks are as large
    as a task can hold; only small tables are cut finer, to use all cores. The
    counts have one row per cell, a number the caller chose.

    A ``query_number``, where there is one, says that all are of one cell, and deals the
    queries out evenly instead of a hash of their id.
    """
    cores = corpus.sparkSession.sparkContext.defaultParallelism
    most_docs = _doc_rows(corpus, dimension)
    most = max(1, BLOCK_COMPONENTS // dimension)
    docs, asked = corpus.count(), queries.count()
    if query_number is None:
        tasks = 2 * cores
        doc_rows = min(most_docs, max(BLOCK_ROWS, math.ceil(docs / tasks)))
        share = asked * math.ceil(docs / doc_rows) / tasks
        query_rows = min(most, max(QUERY_ROWS, math.ceil(share)))
    else:
        # A block of queries takes a copy of all documents; one of documents takes all
        # queries and hands out k hits for each.
        tasks = 4 * cores
        cuts = max(1, math.isqrt(tasks * asked * (1 + k) // max(1, docs)))
        query_rows = min(most, max(QUERY_ROWS, math.ceil(asked / cuts)))
        share = docs * math.ceil(asked / query_rows) / tasks
        doc_rows = min(most_docs, max(BLOCK_ROWS, math.ceil(share)))

    def blocks(side: DataFrame, rows: int, name: str) -> DataFrame:
        return side.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / rows).alias(name))

    sizes = F.broadcast(
        blocks(queries, query_rows, "query_blocks").join(
            blocks(corpus, doc_rows, "doc_blocks"), "cell"
        )
    )

    def own_block(number: Column, blocks: str) -> Column:
        return F.pmod(number, F.col(blocks))

    def every_block(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(blocks) - 1))

    left = queries.join(sizes, "cell").select(
        "cell",
        own_block(
            F.xxhash64("query_id") if query_number is None else query_number, "query_blocks"
        ).alias("query_block"),
        every_block("doc_blocks").alias("doc_block"),
        "query_id",
        "query_vector",
    )
    right = corpus.join(sizes, "cell").select(
        "cell",
        every_block("query_blocks").alias("query_block"),
        own_block(F.xxhash64("doc_id"), "doc_blocks").alias("doc_block"),
        "doc_id",
        "doc_vector",
    )
    arrow = _arrow_schema(schema)

    def match(one: pa.Table, other: pa.Table) -> pa.Table:
        if not one.num_rows or not other.num_rows:
            return arrow.empty_table()
        queries = _checked(
            one["query_id"], one["query_vector"], dimension, skip_invalid, single=True
        )
        search = _Search(*queries, min(k, other.num_rows), skip_equal_ids)
        for batch in other.to_batches():  # without a copy of the whole block
            search.see(
                *_checked(
                    batch.column("doc_id"),
                    batch.column("doc_vector"),
                    dimension,
                    skip_invalid,
                    single=True,
                )
            )
        return pa.Table.from_batches(search.batches(arrow), schema=arrow)

    on = ["cell", "query_block", "doc_block"]
    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(match, schema)


def cell_centres(
    corpus: DataFrame,
    cells: int,
    doc_key: str = "doc_id",
    doc_vector: str = "embedding",
    seed: int = 0,
    iterations: int = 10,
) -> np.ndarray:
    """Centres of ``cells`` clusters, by distributed k-means over all vectors."""
    require(corpus, [doc_key, doc_vector])
    features = corpus.select(array_to_vector(quoted(doc_vector)).alias("features"))
    model = KMeans(k=cells, seed=seed, maxIter=iterations, initSteps=2).fit(features)
    return np.array(model.clusterCenters())


# Scores of vectors against centres that are held at a time.
_CELL_SCORES = 4_000_000


def nearest_cells(
    vector: Column,
    centres: np.ndarray,
    probes: int,
    sizes: np.ndarray | None = None,
    needed: int = 0,
) -> Column:
    """The ``probes`` cells whose centres are nearest to a vector, nearest first.

    With the ``sizes`` of the cells, further ones follow until all hold ``needed``
    documents. A vector that is not of the centres' length, or not finite, has none.
    """
    half = (centres * centres).sum(axis=1) / 2
    dimension = centres.shape[1]
    probes = min(probes, len(centres))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def cells(vectors: pa.Array) -> pa.Array:
        rows = pa.array(range(len(vectors)), pa.int64())
        whole, matrix = _checked(rows, vectors, dimension, skip_invalid=True)
        found: list[list[int]] = [[] for _ in range(len(vectors))]
        step = max(1, _CELL_SCORES // len(centres))
        for start in range(0, len(whole), step):
            near = matrix[start : start + step] @ centres.T - half
            order = np.argsort(-near, axis=1, kind="stable")
            count = np.full(len(order), probes)
            if sizes is not None:
                held = np.cumsum(sizes[order], axis=1)
                count = np.maximum(count, (held < needed).sum(axis=1) + 1)
            for row, cell, n in zip(whole[start : start + step], order, count):
                found[row] = cell[:n].tolist()
        return pa.array(found, pa.list_(pa.int32()))

    return cells(vector)


def assign_cells(
    corpus: DataFrame, centres: np.ndarray, doc_vector: str = "embedding"
) -> DataFrame:
    """Add the ``cell`` of each vector; null for one that is not whole. ``write_index``
    stores the table by ``cell``, so that a search reads only the cells it probes."""
    cell = F.get(nearest_cells(quoted(doc_vector), centres, 1), F.lit(0))
    return corpus.withColumn("cell", cell)


# Share of the exact hits that a cell-wise search is to find, and the queries (in
# expectation) that measure it where no number of probes is given.
LEAST_RECALL = 0.9
MEASURED_QUERIES = 200


def probes_for_recall(
    queries: DataFrame,
    corpus: DataFrame,
    centres: np.ndarray,
    k: int = 10,
    least: float = LEAST_RECALL,
    query_key: str = "query_id",
    doc_key: str = "doc_id",
    query_vector: str = "embedding",
    doc_vector: str = "embedding",
    skip_equal_ids: bool = False,
    skip_invalid: bool = False,
) -> tuple[int, float]:
    """The fewest probes that find at least ``least`` of the exact hits of
    ``queries``, and the share they find. Without hits all cells are probed.

    A cell-wise search is exact within the cells it probes, so an exact hit is found
    just when its cell is probed: one exact search measures every number of probes.
    """
    if "cell" not in corpus.columns:
        corpus = materialize(assign_cells(corpus, centres, doc_vector))
    exact = dense_topk(
        queries, corpus, k, query_key, doc_key, query_vector, doc_vector,
        skip_equal_ids=skip_equal_ids, skip_invalid=skip_invalid,
    )
    near = nearest_cells(quoted(query_vector), centres, len(centres))
    places = queries.select(
        quoted(query_key).alias("query_id"), F.posexplode(near).alias("place", "cell")
    )
    cells = corpus.select(quoted(doc_key).alias("doc_id"), "cell")
    hits = exact.select("query_id", "doc_id").join(cells, "doc_id")
    counted = hits.join(places, ["query_id", "cell"]).groupBy("place").count().collect()
    found = np.zeros(len(centres), np.int64)
    for r in counted:  # at most a row per cell
        found[r["place"]] = r["count"]
    if not found.sum():
        return len(centres), 1.0
    recall = np.cumsum(found) / found.sum()
    probes = int(np.argmax(recall >= least))
    return probes + 1, float(recall[probes])


def cell_topk(
    queries: DataFrame,
    corpus: DataFrame,
    centres: np.ndarray,
    k: int = 10,
    probes: int | None = None,
    query_key: str = "query_id",
    doc_key: str = "doc_id",
    query_vector: str = "embedding",
    doc_vector: str = "embedding",
    skip_equal_ids: bool = False,
    skip_invalid: bool = False,
) -> DataFrame:
    """Approximate top ``k``: exact among the documents of the nearest cells.

    ``centres`` come from ``cell_centres``. A corpus without a ``cell`` column is
    assigned here, and stored. A query whose ``probes`` cells hold fewer than ``k``
    documents looks into further cells. Without ``probes`` their number is the least
    that finds ``LEAST_RECALL`` of the exact hits of a sample of the queries.
    """
    schema = _result_schema(queries, query_key, corpus, doc_key)
    left, _ = _sides(queries, corpus, query_key, doc_key, query_vector, doc_vector)
    names = [quoted(doc_key).alias("doc_id"), quoted(doc_vector).alias("doc_vector")]
    if "cell" in corpus.columns:
        right = corpus.select("cell", *names)
    else:
        right = materialize(assign_cells(corpus, centres, doc_vector).select("cell", *names))
    dimension = centres.shape[1]
    if not skip_invalid:
        for side, name in ((left, "query"), (right.filter("cell is null"), "doc")):
            _refuse(side, f"{name}_id", f"{name}_vector", dimension)
    counted = right.groupBy("cell").count().collect()  # a row per cell
    sizes = np.zeros(len(centres), np.int64)
    for r in counted:
        if r["cell"] is not None:
            sizes[r["cell"]] = r["count"]
    needed = min(k + skip_equal_ids, int(sizes.sum()))
    if probes is None:
        left = materialize(left)  # sampled and searched
        share = MEASURED_QUERIES / max(1, left.count())
        asked = left.filter(keyed_uniform(0, F.col("query_id")) < share)
        names = ("query_id", "doc_id", "query_vector", "doc_vector")
        probes, _ = probes_for_recall(
            asked, right, centres, k, LEAST_RECALL, *names, skip_equal_ids, skip_invalid
        )
    near = nearest_cells(F.col("query_vector"), centres, probes, sizes, needed)
    # Used for counts and for blocks: embedded and assigned once.
    left = materialize(left.withColumn("cell", F.explode(near)))
    found = _grid(
        left, right, k, skip_equal_ids, skip_invalid, schema, dimension
    )
    return _ranked(found, k)


def _refuse(side: DataFrame, key: str, vector: str, dimension: int) -> None:
    """An error that names a row whose vector is not whole, if there is one."""

    def bad(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _checked(batch.column(key), batch.column(vector), dimension, False)
            yield batch.slice(0, 0)

    side.select(key, vector).mapInArrow(bad, side.select(key, vector).schema).count()


def recall_at_k(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact hits that were found: one row ``recall``."""
    pair = ["query_id", "doc_id"]
    hits = exact.select(*pair).join(
        found.select(*pair).withColumn("_hit", F.lit(1)), pair, "left"
    )
    return hits.agg((F.count("_hit") / F.count(F.lit(1))).alias("recall"))


def attach_documents(
    queries: DataFrame,
    hits: DataFrame,
    documents: DataFrame,
    query_key: str = "query_id",
    doc_key: str = "doc_id",
    output_key: str = "docs",
    title_key: str = "title",
    text_key: str = "content",
    sent_bytes: int = SENT_BYTES,
) -> DataFrame:
    """Add the hits of each query as an array of ``{content, title}``, best first.

    The hits are written once, so that measuring and joining them does not search
    twice. Few hits are sent to the documents, which then are read in place. With
    many, the documents are shuffled, and one that very many queries hit is copied
    to several tasks. A query without hits gets an empty array.
    """
    hits = materialize(hits.select("query_id", "doc_id", "rank"))
    texts = documents.select(
        quoted(doc_key).alias("doc_id"),
        F.struct(
            quoted(text_key).alias("content"), quoted(title_key).alias("title")
        ).alias("_doc"),
    )
    width = F.octet_length(F.concat_ws(",", "query_id", "doc_id")) + 32
    size = hits.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    if size <= sent_bytes:
        found = texts.join(F.broadcast(hits), "doc_id")
    else:
        found = lookup_join(hits, texts, "doc_id")
    lists = found.groupBy("query_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "_doc"))).alias("_hits")
    )
    docs = F.transform("_hits", lambda h: h["_doc"])
    lists = lists.withColumnRenamed("query_id", "_query")
    joined = queries.join(lists, quoted(query_key) == F.col("_query"), "left")
    joined = joined.drop("_query")
    empty = F.array().cast("array<struct<content:string,title:string>>")
    return joined.withColumn(output_key, F.coalesce(docs, empty)).drop("_hits")


def retrieve(
    df: DataFrame,
    index: DataFrame,
    make_model: Callable[[], Embedder],
    key: str,
    query_key: str = "query",
    docs_key: str = "positive_passages",
    k: int = 10,
    prefix: str = "",
    batch_size: int = 64,
    centres: np.ndarray | None = None,
    probes: int | None = None,
) -> DataFrame:
    """Add the ``k`` best chunks for each row's query, as ``{content, title}``.

    ``index`` is a stored chunk table. With ``centres`` the search is limited to
    the nearest cells; store the index with ``assign_cells`` then. Without ``probes``
    their number is chosen by measured recall, as in ``cell_topk``.
    """
    require(df, [key, query_key])
    asked = embed(
        df.select(quoted(key), quoted(query_key)),
        query_key,
        make_model,
        "_embedding",
        prefix=prefix,
        batch_size=batch_size,
    )
    # Queries are counted before they are matched: embed them once.
    asked = materialize(asked.select(key, "_embedding"))
    if centres is None:
        hits = dense_topk(asked, index, k, key, "chunk_id", "_embedding")
    else:
        hits = cell_topk(
            asked, index, centres, k, probes, key, "chunk_id", "_embedding"
        )
    return attach_documents(df, hits, index, key, "chunk_id", docs_key)


def concat_branches(
    df: DataFrame, branch_keys: Sequence[str], output_key: str = "docs"
) -> DataFrame:
    """Documents of several retrieval branches, one after the other, none dropped."""
    require(df, branch_keys)
    return df.withColumn(output_key, F.concat(*[quoted(b) for b in branch_keys]))
