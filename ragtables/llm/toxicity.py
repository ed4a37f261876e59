"""Toxicity by a weighted lexicon.

Text is folded: lower case, homoglyphs, accents, digits and signs that stand for
letters become plain letters, other signs become spaces. An Aho-Corasick automaton
finds the lexicon's terms at word starts. A hit inside an exception phrase does not
count. The summed weights are divided by the root of the length in words and mapped
to 0..1 so that the chosen threshold falls on the decision score 0.3.

Terms, weights, exceptions and threshold are learned from labelled rows. A term is
the start of a word that toxic documents have far more often, made as long as it
can be without losing its documents; so both whole words and stems are found.

Defined cases: null and empty texts score 0; without toxic rows to learn from the
lexicon is empty and all scores are 0; repeated rows are scored alike, and near
copies of one label count once in learning; extra columns pass through.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragtables.functions.draws import keyed_uniform
from ragtables.llm import words
from ragtables.llm.base import free_name, put, released
from ragtables.sources.storage import materialize

# Characters that stand for letters.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
LOOKALIKES = dict(
    zip("абвгеёзікмнорстухѕјԁһαβγεικνορτυχω", "abbreeeikmhopctyxsjdhabyeiknoptuxw")
)
HIDDEN = "­​‌‍⁠﻿"

# Learning looks at this many labelled rows at most (in expectation), half of them toxic.
MAX_LABELLED = 12_000
SHORTEST, LONGEST = 4, 12
DECISION = 0.3


class Lexicon(NamedTuple):
    """Folded terms with weights, folded exception phrases, and the evidence that
    scores 0.3."""

    weights: dict[str, float]
    exceptions: frozenset[str] = frozenset()
    threshold: float = 1.0


def folding_table() -> dict[int, str | None]:
    """For ``str.translate`` on lower-case text. ``l`` and ``i`` become one letter,
    because ``1`` may stand for either."""
    out: dict[int, str | None] = {c: " " for c in range(0x80) if not chr(c).isalnum()}
    for c in range(0xA0, 0x250):
        base = unicodedata.normalize("NFKD", chr(c))[0]
        if base.isascii() and base.isalpha():
            out[c] = base.lower()
    for c in range(0xFF10, 0xFF5B):  # full width
        plain = unicodedata.normalize("NFKC", chr(c)).lower()
        out[c] = DIGITS.get(plain, plain if plain.isalnum() else " ")
    out.update({ord(k): v for k, v in (DIGITS | LOOKALIKES).items()})
    out.update(dict.fromkeys(map(ord, HIDDEN)))
    out.update(dict.fromkeys(range(0x2000, 0x200B), " "))
    return {k: "i" if v == "l" else v for k, v in out.items()} | {ord("l"): "i"}


def fold(text: str, table: dict[int, str | None]) -> str:
    return text.lower().translate(table)


def _sample(labelled: DataFrame, seed: int, rows: int) -> DataFrame:
    """``doc_id, toxic`` of at most about ``rows`` documents, half of them toxic."""
    labels = (
        labelled.filter("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    counts = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("toxic") == label, min(1.0, rows / 2 / n)).otherwise(share)
    return labels.filter(keyed_uniform(seed, F.col("doc_id")) < share)


def _family(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the least shingle hash, which near copies mostly share."""
    for batch in batches:
        least = np.zeros(batch.num_rows, np.int64)
        for piece in words.pieces(batch["text"], words.NO_LETTERS):
            for i in range(len(piece.offsets) - 1):
                own = piece.hashes[piece.offsets[i] : piece.offsets[i + 1]]
                found = words.shingle_hashes(own, min(5, len(own))) if len(own) else own
                least[piece.first + i] = found.min().astype(np.int64) if len(found) else 0
        yield pa.RecordBatch.from_arrays(
            [batch["text"], batch["toxic"], pa.array(least)], ["text", "toxic", "family"]
        )


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = folding_table()
    seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
            own = set(fold(text or "", table).split())
            seen[int(toxic > 0)].update(
                {w[:n] for w in own for n in range(SHORTEST, min(len(w), LONGEST) + 1)}
            )
    for toxic, counts in seen.items():
        terms = list(counts)
        for at in range(0, len(terms), 50_000):
            part = terms[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part, pa.string()),
                    pa.array([counts[t] * toxic for t in part], pa.int64()),
                    pa.array([counts[t] * (1 - toxic) for t in part], pa.int64()),
                ],
                ["term", "pos", "neg"],
            )


def _chosen(rows: list, n_pos: int, n_neg: int, least_odds: float) -> dict[str, float]:
    """Stems with enough evidence. Of a stem and a longer one that keeps most of its
    documents the longer stays; of nested stems that both remain, the shorter."""
    odds = {}
    pos = {}
    for r in rows:
        weight = math.log((r["pos"] + 0.5) / (n_pos - r["pos"] + 0.5)) - math.log(
            (r["neg"] + 0.5) / (n_neg - r["neg"] + 0.5)
        )
        if weight >= least_odds:
            odds[r["term"]], pos[r["term"]] = weight, r["pos"]
    longer: dict[str, int] = {}
    for term, n in pos.items():
        longer[term[:-1]] = max(longer.get(term[:-1], 0), n)
    closed = [t for t in pos if longer.get(t, 0) < 0.7 * pos[t]]
    out: dict[str, float] = {}
    for term in sorted(closed, key=lambda t: (len(t), t)):
        if not any(term[:n] in out for n in range(SHORTEST, len(term))):
            out[term] = round(odds[term], 6)
    return out


def automaton(lexicon: Lexicon) -> ahocorasick.Automaton:
    """Finds the terms where a word starts."""
    found = ahocorasick.Automaton()
    for term, weight in sorted(lexicon.weights.items()):
        found.add_word(" " + term, (len(term), weight))
    if len(found):
        found.make_automaton()
    return found


def hits(folded: str, terms: ahocorasick.Automaton) -> Iterator[tuple[float, str, str]]:
    """Weight and phrases (with the word before, with the word after) of each hit;
    at one word the longest term counts."""
    if not len(terms):
        return
    text = f" {folded} "
    best: dict[int, tuple[int, float]] = {}
    for end, (size, weight) in terms.iter(text):
        start = end - size + 1
        best[start] = max(best.get(start, (0, 0.0)), (size, weight))
    for start, (_, weight) in best.items():
        stop = text.index(" ", start)
        word = text[start:stop]
        before, after = _neighbours(text, start, stop)
        yield weight, f"{before} {word}" if before else word, f"{word} {after}" if after else word


_WORD = re.compile(r"\S+")


def _neighbours(text: str, start: int, stop: int) -> tuple[str, str]:
    """The whole words before ``start`` and after ``stop``, however long; empty at the
    edge of the text."""
    end = start
    while end and text[end - 1].isspace():
        end -= 1
    begin = end
    while begin and not text[begin - 1].isspace():
        begin -= 1
    after = _WORD.search(text, stop)
    return text[begin:end], after[0] if after else ""


def _phrases(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, terms = folding_table(), automaton(lexicon)
        for batch in batches:
            out: list[tuple[str, int]] = []
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                own = {p for h in hits(fold(text or "", table), terms) for p in h[1:]}
                out += [(p, int(toxic > 0)) for p in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in out], pa.string()), pa.array([t for _, t in out], pa.int32())],
                ["phrase", "toxic"],
            )

    return run


def evidence(text: str | None, lexicon: Lexicon, terms, table) -> tuple[float, int, int]:
    """Length-normalised evidence, counted hits, and words."""
    folded = fold(text or "", table)
    n_words = len(folded.split())
    total, n = 0.0, 0
    for weight, before, after in hits(folded, terms):
        if before not in lexicon.exceptions and after not in lexicon.exceptions:
            total, n = total + weight, n + 1
    return total / math.sqrt(n_words + 20), n, n_words


def score_of(found: float, threshold: float) -> float:
    return found / (found + threshold * (1 - DECISION) / DECISION) if found else 0.0


def scored(lexicon: Lexicon, text: str) -> Column:
    """A struct ``score, n_hits, n_words`` for a text column."""

    @F.arrow_udf("struct<score: double, n_hits: long, n_words: long>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table, terms = folding_table(), automaton(lexicon)
        for texts in batches:
            rows = []
            for value in texts:
                found, n, n_words = evidence(value.as_py(), lexicon, terms, table)
                rows.append((score_of(found, lexicon.threshold), n, n_words))
            yield pa.StructArray.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.float64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.int64()),
                ],
                ["score", "n_hits", "n_words"],
            )

    return run(F.col(f"`{text}`"))


def acceptable(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not judged toxic, as they are."""
    return docs.filter(scored(lexicon, text)["score"] < DECISION)


def _threshold(found: DataFrame) -> float:
    """The evidence that best parts toxic from clean rows, in the middle of the gap
    around it. ``found`` has a row per evidence level, bounded by the sample."""
    levels = found.groupBy(F.round("found", 3).alias("x")).agg(
        F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg")
    )
    rows = sorted((r["x"], r["pos"], r["neg"]) for r in levels.collect())
    n_pos = sum(r[1] for r in rows)
    best, place = -1.0, 1.0
    pos, neg, above = 0, 0, None
    for x, p, n in reversed(rows):
        if x <= 0:
            break
        pos, neg = pos + p, neg + n
        f1 = 2 * pos / (pos + neg + n_pos) if n_pos else 0.0
        if f1 > best:
            best, above = f1, x
    if above is None:
        return place
    below = max([r[0] for r in rows if 0 < r[0] < above], default=above / 2)
    return math.sqrt(above * max(below, above / 4))


def learn_lexicon(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = MAX_LABELLED,
    seed: int = 7,
    exceptions: tuple[str, ...] = (),
    least_odds: float = 2.5,
) -> Lexicon:
    """A lexicon from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``).

    ``exceptions`` are phrases of two words to add to the learned ones.
    """
    chosen = F.broadcast(_sample(labels, seed, max_rows))  # bounded by max_rows
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "toxic")
    rows = materialize(
        rows.mapInArrow(released(_family), "text string, toxic int, family long")
        .groupBy("family", "toxic")
        .agg(F.min("text").alias("text"))
        .select("text", "toxic")
    )
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_pos, n_neg = counts.get(1, 0), counts.get(0, 0)
    table = folding_table()
    fixed = frozenset(" ".join(fold(p, table).split()) for p in exceptions)
    if not n_pos:
        return Lexicon({}, fixed)
    terms = (
        rows.mapInArrow(released(_count_terms), "term string, pos long, neg long")
        .groupBy("term")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .filter((F.col("pos") >= max(4.0, 0.01 * n_pos)) & (F.col("pos") * n_neg > F.col("neg") * n_pos * 3))
        .collect()  # bounded by the sample
    )
    lexicon = Lexicon(_chosen(terms, n_pos, n_neg, least_odds), fixed)
    benign = (
        rows.mapInArrow(released(_phrases(lexicon)), "phrase string, toxic int")
        .groupBy("phrase")
        .agg(F.sum("toxic").alias("pos"), F.count("*").alias("n"))
        .filter((F.col("n") >= 5) & (F.col("pos") < 0.1 * F.col("n")))
        .collect()
    )
    lexicon = lexicon._replace(exceptions=fixed | {r["phrase"] for r in benign})
    unit = lexicon._replace(threshold=DECISION / (1 - DECISION))  # then score = x / (x + 1)
    found = rows.select("toxic", scored(unit, "text")["score"].alias("s")).select(
        "toxic", (F.col("s") / (1 - F.col("s"))).alias("found")
    )
    return lexicon._replace(threshold=_threshold(found))


def score_toxicity(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0..1), ``n_hits`` and ``n_words`` (folded words)."""
    own = free_name(docs, "toxicity_")
    rows = put(docs, **{own: scored(lexicon, text)})
    found = {n: F.col(f"{own}.{n}") for n in ("score", "n_hits", "n_words")}
    return put(rows, **found).drop(own)
