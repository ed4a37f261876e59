"""Language by string kernels.

A text is cut in segments of ``SEGMENT`` bytes. A segment is the set of its byte
2-, 3- and 4-grams, hashed to ``FEATURES`` places; the kernel of two segments is the
normalised size of what their sets share. A document's kernel with a landmark is the
mean over its segments, weighted by length, so whole texts count and long ones do not
fill up. Landmarks are segments, drawn by a keyed hash, of labelled documents; the Nystrom map turns kernel
values into features, and kernel ridge regression, one language against the rest, is
solved from summed products that the tasks send. Scoring is a product of the batch's
presence matrix with the landmarks and one with the weights.

Learning looks at a bounded number of labelled rows (``MAX_LABELLED``, in
expectation); landmarks are ``LANDMARKS`` in all.

Defined cases: null texts and texts without a letter are ``und`` with score 0; with
nothing to learn from all are ``und``; repeated rows are scored alike; extra columns
pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragtables.functions.draws import keyed_hash, keyed_uniform
from ragtables.llm.base import put
from ragtables.sources.storage import materialize

GRAMS = (2, 3, 4)
FEATURES = 8192
SEGMENT = 2048
LANDMARKS = 128
MAX_LABELLED = 6_000
RIDGE = 1e-2
UNKNOWN = "und"


class Model(NamedTuple):
    """``landmarks`` (places x landmarks, unit columns), ``weights`` (landmarks x
    languages, with the Nystrom map multiplied in) and the languages."""

    landmarks: np.ndarray
    weights: np.ndarray
    languages: tuple[str, ...]


def _plain() -> bytes:
    """ASCII characters that are no letters become spaces."""
    return bytes(b if b >= 0x80 or 97 <= b <= 122 else 0x20 for b in range(256))


def _lowered(text: str | None, table: bytes) -> bytes:
    return (text or "").lower().encode("utf-8", "replace").translate(table)


def presence(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A unit row of presence per segment, its text's number, and its bytes."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.cumsum(counts) - counts
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint32)
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.arange(len(data)) - start
    left = np.repeat(sizes, sizes) - at
    segment = np.repeat(first, sizes) + at // SEGMENT
    out = np.zeros((len(owner), FEATURES), np.float32)
    flat = out.reshape(-1)
    bits = FEATURES.bit_length() - 1
    for n in GRAMS:
        code = np.full(max(0, len(data) - n + 1), n, np.uint32)
        for j in range(n):
            code = code * np.uint32(0x01000193) ^ data[j : len(data) - n + 1 + j]
        code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
        whole = left[: len(code)] >= n
        flat[segment[: len(code)][whole] * FEATURES + code[whole]] = 1
    weight = np.minimum(SEGMENT, np.repeat(sizes, counts) - (np.arange(len(owner)) - first[owner]) * SEGMENT)
    norm = np.sqrt(out.sum(axis=1))
    out /= np.maximum(norm, 1)[:, None]
    return out, owner, weight


def kernels(texts: list[bytes], landmarks: np.ndarray) -> np.ndarray:
    """The kernel of each text with each landmark."""
    rows, owner, weight = presence(texts)
    by_segment = (rows @ landmarks).astype(np.float64) * weight[:, None]
    out = np.zeros((len(texts), landmarks.shape[1]))
    np.add.at(out, owner, by_segment)
    return out / np.maximum(1, [len(t) for t in texts])[:, None]


def _slices(texts: list[bytes], limit: int = 1_000_000) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > limit:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def _products(landmarks, languages: tuple[str, ...]):
    """Sums over this task's rows of K'K and K'Y."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = landmarks.value, _plain()
        number = {lang: i for i, lang in enumerate(languages)}
        square = np.zeros((known.shape[1], known.shape[1]))
        cross = np.zeros((known.shape[1], len(languages)))
        for batch in batches:
            texts = [_lowered(t, table) for t in batch["text"].to_pylist()]
            labels = np.array([number[v] for v in batch["lang"].to_pylist()], np.int64)
            for a, b in _slices(texts):
                k = kernels(texts[a:b], known)
                y = np.full((b - a, len(languages)), -1.0)
                y[np.arange(b - a), labels[a:b]] = 1.0
                square += k.T @ k
                cross += k.T @ y
        yield pa.RecordBatch.from_arrays(
            [pa.array([square.tobytes()], pa.binary()), pa.array([cross.tobytes()], pa.binary())],
            ["square", "cross"],
        )

    return run


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: list = [0.0, 0.0]
    for batch in batches:
        for i, name in enumerate(("square", "cross")):
            for value in batch[name]:
                sums[i] = sums[i] + np.frombuffer(value.as_buffer())
    if isinstance(sums[0], np.ndarray):
        yield pa.RecordBatch.from_arrays(
            [pa.array([s.tobytes()], pa.binary()) for s in sums], ["square", "cross"]
        )


def _segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One segment of each text, that around a drawn byte."""
    table = _plain()
    for batch in batches:
        cut = []
        for text, place in zip(batch["text"].to_pylist(), batch["place"].to_pylist()):
            data = _lowered(text, table)
            first = (place or 0) % max(1, len(data)) // SEGMENT * SEGMENT
            cut.append(data[first : first + SEGMENT])
        yield pa.RecordBatch.from_arrays([pa.array(cut, pa.binary())], ["t"])


def learn_languages(
    docs: DataFrame, max_rows: int = MAX_LABELLED, landmarks: int = LANDMARKS, seed: int = 5
) -> Model | None:
    """A model from ``docs`` (``doc_id, text, lang``); None without labelled texts."""
    rows = docs.filter("lang is not null and text is not null and length(trim(text)) > 0")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = tuple(sorted(counts))
    if not languages:
        return None
    share = F.lit(0.0)
    for lang in languages:
        share = F.when(F.col("lang") == lang, min(1.0, max_rows / len(languages) / counts[lang])).otherwise(share)
    sample = materialize(
        rows.filter(keyed_uniform(seed, F.col("doc_id")) < share).select(
            "doc_id", "text", "lang", keyed_hash(seed + 1, F.col("doc_id")).alias("draw"),
            keyed_hash(seed + 2, F.col("doc_id")).alias("place"),
        )
    )
    chosen = []
    per = max(1, landmarks // len(languages))
    for lang in languages:
        own = sample.filter(F.col("lang") == lang).orderBy("draw").limit(per).select("text", "place")
        chosen += [bytes(r["t"]) for r in own.mapInArrow(_segment, "t binary").collect()]
    vectors, owner, _ = presence([c for c in chosen if c.strip()])
    if not len(vectors):
        return None
    sent = sample.sparkSession.sparkContext.broadcast(np.ascontiguousarray(vectors.T))
    kind = "square binary, cross binary"
    sums = (
        sample.select("text", "lang").mapInArrow(_products(sent, languages), kind)
        .repartition(1).mapInArrow(_sum, kind)  # a few numbers a task
        .first()
    )
    m = vectors.shape[0]
    square = np.frombuffer(sums["square"]).reshape(m, m)
    cross = np.frombuffer(sums["cross"]).reshape(m, len(languages))
    # Nystrom: features are kernel values times the inverse root of the landmarks' own.
    values, axes = np.linalg.eigh((vectors @ vectors.T).astype(np.float64))
    root = axes / np.sqrt(np.maximum(values, 1e-6)) @ axes.T
    n = max(1, sum(min(counts[v], max_rows // len(languages)) for v in languages))
    gram = root.T @ square @ root
    weights = root @ np.linalg.solve(gram + RIDGE * n * np.eye(m) / m, root.T @ cross)
    return Model(np.ascontiguousarray(vectors.T), weights, languages)


def _predicted(model: Model | None, text: str) -> Column:
    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table, letter = _plain(), re.compile(r"[^\W\d_]")
        for values in batches:
            texts = values.to_pylist()
            lang = [UNKNOWN] * len(texts)
            score = np.zeros(len(texts))
            told = [i for i, t in enumerate(texts) if t and letter.search(t)] if model else []
            data = [_lowered(texts[i], table) for i in told]
            for a, b in _slices(data):
                found = kernels(data[a:b], model.landmarks) @ model.weights
                best = found.argmax(axis=1)
                for i, which, value in zip(told[a:b], best, found.max(axis=1)):
                    lang[i] = model.languages[which]
                    score[i] = min(1.0, max(0.0, (value + 1) / 2))
            yield pa.StructArray.from_arrays(
                [pa.array(lang, pa.string()), pa.array(score)], ["lang_pred", "score"]
            )

    return run(F.col(f"`{text}`"))


def identify_language(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0..1)."""
    rows = put(docs, language_=_predicted(model, text))
    return put(rows, lang_pred=F.col("language_.lang_pred"), score=F.col("language_.score")).drop("language_")
