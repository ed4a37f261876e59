"""Corpus preparation: clean, chunk, embed."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ragtables.functions.text import chunk_words, clean_document
from ragtables.operators.columns import quoted, require

Embedder = Callable[[list[str]], Sequence[Sequence[float]]]


def clean_documents(df: DataFrame, text_key: str = "content") -> DataFrame:
    """Drop empty lines and squeeze blanks, in place."""
    require(df, [text_key])
    return df.withColumn(text_key, clean_document(quoted(text_key)))


def chunk_documents(
    df: DataFrame,
    doc_key: str = "doc_id",
    text_key: str = "content",
    length: int = 200,
    overlap: int = 20,
) -> DataFrame:
    """One row per word window: the document's columns with ``content`` replaced,
    plus ``chunk_no`` (from 0) and ``chunk_id`` (``doc:number``)."""
    require(df, [doc_key, text_key])
    kept = [quoted(c) for c in df.columns if c != text_key]
    chunks = df.select(
        *kept,
        F.posexplode(chunk_words(quoted(text_key), length, overlap)).alias(
            "chunk_no", text_key
        ),
    )
    chunk_id = F.concat_ws(":", quoted(doc_key).cast("string"), F.col("chunk_no"))
    return chunks.withColumn("chunk_id", chunk_id)


def embed(
    df: DataFrame,
    text_key: str,
    make_model: Callable[[], Embedder],
    output_key: str = "embedding",
    title_key: str | None = None,
    prefix: str = "",
    batch_size: int = 64,
) -> DataFrame:
    """Add a vector per row from a user-supplied ``texts -> vectors`` function.

    ``make_model`` runs once per task. Only the text travels to Python. A title,
    where there is one, is put on a line before the text; a prefix before both.
    """
    text = quoted(text_key)
    if title_key is not None:
        text = F.concat_ws("\n", quoted(title_key), text)
    if prefix:
        text = F.concat(F.lit(prefix), text)

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = make_model()
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            parts = [
                np.asarray(model(texts[start : start + batch_size]), np.float32)
                for start in range(0, len(texts), batch_size)
            ]
            made = np.concatenate(parts) if parts else np.zeros((0, 0), np.float32)
            if len(made) != len(texts):
                raise ValueError(f"{len(made)} vectors for {len(texts)} texts")
            offsets = np.arange(len(made) + 1, dtype=np.int32) * made.shape[1]
            yield pa.ListArray.from_arrays(offsets, made.ravel())

    return df.withColumn(output_key, vectors(text))


class _Codes(dict):
    """Token to twice its dimension plus its sign bit, worked out on first use."""

    def __init__(self, dimension: int):
        self.dimension = dimension

    def __missing__(self, token: str) -> int:
        number = int(hashlib.md5(token.encode()).hexdigest()[:15], 16)
        code = number // 2 % self.dimension * 2 + number % 2
        if len(self) > 500_000:
            self.clear()
        self[token] = code
        return code


class HashingEmbedder:
    """Deterministic embedder without a model: signed token hashing.

    The first hex digits of a token's md5 name its dimension and its sign; a text
    is the unit-length sum of its tokens. Good for tests and as a lexical baseline.
    """

    def __init__(self, dimension: int = 64):
        self.dimension = dimension
        self.codes = _Codes(dimension)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        result = []
        for text in texts:
            codes = np.array(list(map(self.codes.__getitem__, text.lower().split())), np.int64)
            counts = np.bincount(codes, minlength=2 * self.dimension)
            signed = counts.reshape(-1, 2).astype(np.int64)
            vector = (signed[:, 1] - signed[:, 0]).astype(float)
            norm = np.sqrt(np.dot(vector, vector))
            result.append(vector / norm if norm else vector)
        return result


def build_index(
    documents: DataFrame,
    make_model: Callable[[], Embedder],
    doc_key: str = "doc_id",
    length: int = 200,
    overlap: int = 20,
    batch_size: int = 64,
) -> DataFrame:
    """Documents (``doc_id, title, content``) to ``chunk_id, doc_id, title, content,
    embedding``: clean, chunk, embed. Row by row, without a shuffle."""
    chunks = chunk_documents(clean_documents(documents), doc_key, "content", length, overlap)
    embedded = embed(
        chunks, "content", make_model, title_key="title", batch_size=batch_size
    )
    return embedded.select(
        "chunk_id", quoted(doc_key).alias("doc_id"), "title", "content", "embedding"
    )
