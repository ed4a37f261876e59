"""Phrase collocations by prefix-free parsing.

Texts are cut into pieces at marks and pieces into words. Within a piece, a pair of
words whose hash is a multiple of ``STRIDE`` is a trigger, and chunks reach from one
trigger to the next, triggers included: where they are cut depends on the words there
alone, so a passage that occurs again is cut alike. Neighbouring chunks overlap by the
words of the trigger (``longest - 1`` of them). The dictionary holds every distinct
chunk of a language once, with its frequency in the parse.

Phrases are then counted in the dictionary, each with its chunk's frequency. A phrase
belongs to the chunk in which it starts before the overlap, so what lies in an overlap
is counted once. No phrase is rarer than its parts, so level by level, only phrases
whose two parts (all words but the last, all but the first) are frequent are handed
out; a filter sized by the number of frequent phrases tells which may be. The filter lets some
others through, which cost shuffle but are dropped by their counts.

Defined cases: a null text has no words; a null language is ``und``; repeated rows
count each; phrases that tie in score and count follow in the byte order of their
text; an empty table has no phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ragtables.llm import words
from ragtables.llm.base import sent
from ragtables.sources.storage import materialize

# What separates words, and what ends a piece.
BLANKS = bytes([0x20, 0x09])
MARKS = b".,;:!?" + bytes(range(0x0A, 0x0E))

LONGEST = 3
# One pair of words in so many cuts.
STRIDE = 16
# Own words whose phrases a task sums up before it hands out their counts.
HELD_WORDS = 1_500_000
# Bits of a filter for each frequent phrase, and at most: 16 MB are sent to a task.
FILTER_SHARE = 16
FILTER_BITS = 1 << 27
SCALE = 1_000_000
# Parts of a language that are ranked by themselves before it is ranked as a whole.
RANKED_PARTS = 64


# --------------------------------------------------------------------- parsing


def _gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, firsts: np.ndarray, lasts: np.ndarray) -> pa.Array:
    """For each i the words ``firsts[i] .. lasts[i] - 1``, joined by spaces."""
    sizes = lasts - firsts
    word = np.repeat(firsts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    length = ends[word] - starts[word] + 1  # with the space after it
    begin = np.cumsum(length) - length
    total = int(length.sum())
    at = np.repeat(starts[word] - begin, length) + np.arange(total)
    out = data[np.minimum(at, len(data) - 1)] if len(data) else data
    out[begin + length - 1] = 0x20
    stops = np.append(begin, total)[np.cumsum(sizes)]  # where each phrase's last space ends
    keep = np.ones(total, bool)
    keep[stops - 1] = False
    offsets = np.concatenate([[0], stops - np.arange(1, len(stops) + 1)]).astype(np.int64)
    values = pa.py_buffer(np.ascontiguousarray(out[keep]))
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), values).cast(pa.string())


def _runs(piece: words.Words) -> np.ndarray:
    """For each word, whether it is the first of its row or stands after a mark."""
    data = np.frombuffer(piece.data, np.uint8)
    is_mark = np.zeros(256, bool)
    is_mark[np.frombuffer(MARKS, np.uint8)] = True
    marks = np.concatenate([[0], np.cumsum(is_mark[data])])
    new = np.zeros(len(piece.starts), bool)
    before = marks[piece.starts]
    new[1:] = before[1:] != before[:-1]
    heads = piece.offsets[:-1][np.diff(piece.offsets) > 0]
    new[heads] = True
    return new


def _chunks(longest: int, stride: int):
    """``lang, chunk, own``: the chunks of texts, in order. The first ``own`` words of a
    chunk come before the overlap with the next one."""
    overlap = longest - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch["lang"]
            for piece in words.pieces(batch["text"], BLANKS + MARKS):
                n = len(piece.starts)
                if not n:
                    continue
                new = _runs(piece)
                run_of = np.cumsum(new) - 1
                run_end = np.append(np.flatnonzero(new)[1:], n)[run_of]
                window = words.shingle_hashes(piece.hashes, overlap)
                cut = new.copy()
                cut[: len(window)] |= (window % np.uint64(stride) == 0) & (
                    np.arange(len(window)) + overlap <= run_end[: len(window)]
                )
                firsts = np.flatnonzero(cut)
                own_end = np.append(firsts[1:], n)
                lasts = np.minimum(own_end + overlap, run_end[firsts])
                rows = np.searchsorted(piece.offsets, firsts, side="right") - 1 + piece.first
                data = np.frombuffer(piece.data, np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        langs.take(pa.array(rows)),
                        _gathered(data, piece.starts, piece.ends, firsts, lasts),
                        pa.array((own_end - firsts).astype(np.int32)),
                    ],
                    ["lang", "chunk", "own"],
                )

    return run


def chunk_dictionary(docs: DataFrame, longest: int = LONGEST, stride: int = STRIDE) -> DataFrame:
    """``lang, chunk, own, freq``: the distinct chunks of ``lang, text``, how many of
    their words come before the overlap, and how often the parse holds them."""
    kind = f"lang {docs.schema['lang'].dataType.simpleString()}, chunk string, own int"
    return (
        docs.select("lang", "text")
        .mapInArrow(_chunks(longest, stride), kind)
        .groupBy("lang", "chunk", "own")
        .agg(F.count("*").alias("freq"))
    )


# -------------------------------------------------------------------- counting


def _place(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (words.mix(hashes) & np.uint64(bits - 1)).astype(np.int64)


def _in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = _place(hashes, 8 * len(bits))
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0


def _tagged(lang: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return words.mix(hashes + lang * np.uint64(0x9E3779B97F4A7C15))


def _phrase_sums(size: int, filtered) -> object:
    """Counts of the phrases of ``size`` words that start among a chunk's own words
    and whose parts may be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None
        if filtered is not None:
            bits = np.frombuffer(filtered.value, np.uint8)
        held: list[pa.RecordBatch] = []
        held_words = 0

        def summed() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            names = table["lang"].combine_chunks().dictionary_encode()
            lang = names.indices.to_numpy(zero_copy_only=False)
            own, freq = table["own"].to_numpy(), table["freq"].to_numpy()
            tags = _lang_hashes(names.dictionary)
            for piece in words.pieces(table["chunk"], BLANKS):
                counts = np.diff(piece.offsets)
                row = np.repeat(np.arange(len(counts)), counts)
                place = np.arange(len(row)) - piece.offsets[row]
                starts = np.flatnonzero(
                    (place < own[piece.first + row]) & (place + size <= counts[row])
                )
                of = piece.first + row[starts]
                tag = tags[lang[of]]
                if bits is not None:
                    part = words.shingle_hashes(piece.hashes, size - 1)
                    first, second = _tagged(tag, part[starts]), _tagged(tag, part[starts + 1])
                    may = _in_filter(bits, first) & _in_filter(bits, second)
                    starts, of, tag = starts[may], of[may], tag[may]
                if not len(starts):
                    continue
                key = _tagged(tag, words.shingle_hashes(piece.hashes, size)[starts])
                _, at, back = np.unique(key, return_index=True, return_inverse=True)
                sums = np.zeros(len(at), np.int64)
                np.add.at(sums, back, freq[of])
                data = np.frombuffer(piece.data, np.uint8)
                begin = starts[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        names.dictionary.take(pa.array(lang[of[at]])),
                        _gathered(data, piece.starts, piece.ends, begin, begin + size),
                        pa.array(sums),
                    ],
                    ["lang", "phrase", "f"],
                )

        for batch in batches:
            held.append(batch)
            held_words += int(pa.compute.sum(batch["own"]).as_py() or 0)
            if held_words >= HELD_WORDS:
                yield from summed()
                held, held_words = [], 0
        if held:
            yield from summed()

    return run


def _lang_hashes(names: pa.Array) -> np.ndarray:
    """A hash of each language, alike in all tasks."""
    at, raw = words.text_buffers(names.cast(pa.string()))
    data = raw[at[0] : at[-1]] if len(at) else raw
    return words.span_hashes(data, at[:-1] - at[0], at[1:] - at[0]) if len(data) else np.zeros(len(names), np.uint64)


def _filter_slices(size: int, bits: int):
    """``slice, place``: the distinct places of the filter's bits, by slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch["lang"].dictionary_encode()
            tags = _lang_hashes(names.dictionary)
            lang = names.indices.to_numpy(zero_copy_only=False)
            for piece in words.pieces(batch["phrase"], BLANKS):
                at = piece.offsets[:-1]
                rows = piece.first + np.arange(len(at))
                key = _tagged(tags[lang[rows]], words.shingle_hashes(piece.hashes, size)[at])
                place = np.unique(_place(key, bits))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((place >> 20).astype(np.int32)), pa.array(place & ((1 << 20) - 1))], ["slice", "place"]
                )

    return run


def _filter_bits(bits: int):
    """A row for each slice, which come together."""
    width = min(bits, 1 << 20)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[int, np.ndarray] = {}
        for batch in batches:
            number, place = batch["slice"].to_numpy(), batch["place"].to_numpy()
            for s in np.unique(number).tolist():
                slices.setdefault(s, np.zeros(width, bool))[place[number == s]] = True
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(slices), pa.int32()),
                pa.array([np.packbits(v).tobytes() for v in slices.values()], pa.binary()),
            ],
            ["slice", "bits"],
        )

    return run


def _filter(frequent: DataFrame, size: int, rows: int):
    """The filter of the frequent phrases of ``size`` words, sent to the executors."""
    bits = min(FILTER_BITS, max(1 << 10, 1 << (FILTER_SHARE * max(rows, 1) - 1).bit_length()))
    width = min(bits, 1 << 20)
    made = (
        frequent.select("lang", "phrase")
        .mapInArrow(_filter_slices(size, bits), "slice int, place long")
        .repartition("slice")
        .mapInArrow(_filter_bits(bits), "slice int, bits binary")
        .collect()  # FILTER_BITS at most
    )
    out = np.zeros((bits // width, width // 8), np.uint8)
    for r in made:
        out[r["slice"]] = np.frombuffer(r["bits"], np.uint8)
    return frequent.sparkSession.sparkContext.broadcast(out.tobytes())


def phrase_counts(dictionary: DataFrame, longest: int = LONGEST, least: int = 10) -> tuple[DataFrame, DataFrame]:
    """``lang, n`` (all words), and ``lang, size, phrase, f`` of all phrases of up to
    ``longest`` words that occur at least ``least`` times."""
    lang_type = dictionary.schema["lang"].dataType.simpleString()
    kind = f"lang {lang_type}, phrase string, f long"
    totals, levels, filtered = None, [], None
    for size in range(1, longest + 1):
        sums = (
            dictionary.mapInArrow(_phrase_sums(size, filtered), kind)
            .groupBy("lang", "phrase")
            .agg(F.sum("f").alias("f"))
        )
        if size == 1:
            sums = materialize(sums)
            totals = materialize(sums.groupBy("lang").agg(F.sum("f").alias("n")))
        frequent = materialize(sums.filter(F.col("f") >= least))
        if filtered is not None:
            filtered.destroy()
        levels.append(frequent.select("lang", F.lit(size).alias("size"), "phrase", "f"))
        if size < longest:
            filtered = _filter(frequent, size, frequent.count())
    counts = levels[0]
    for level in levels[1:]:
        counts = counts.union(level)
    return totals, counts


# --------------------------------------------------------------------- scoring


def _words_of(phrase: Column, first: int, last: int) -> Column:
    """Words ``first .. last - 1`` of a phrase that is joined by spaces."""
    return F.array_join(F.slice(F.split(phrase, " "), first + 1, last - first), " ")


def _scored(counts: DataFrame, size: int) -> DataFrame:
    """The candidates of ``size`` words with the lowest-scoring cut: ``l, r, score``."""
    out = counts.filter(F.col("size") == size).select("lang", "phrase", F.col("f").alias("a"))
    cuts = []
    for k in range(1, size):
        for name, part, n in ((f"l{k}", _words_of("phrase", 0, k), k), (f"r{k}", _words_of("phrase", k, size), size - k)):
            own = counts.filter(F.col("size") == n).select(
                "lang", F.col("phrase").alias("part"), F.col("f").alias(name)
            )
            out = out.withColumn("part", part).join(own, ["lang", "part"]).drop("part")
        a, left, right = (F.col(c).cast("decimal(38,0)") for c in ("a", f"l{k}", f"r{k}"))
        score = F.call_function("div", F.lit(SCALE).cast("decimal(38,0)") * a * a, left * right)
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    return out.withColumn("c", F.least(*cuts) if len(cuts) > 1 else cuts[0]).select(
        "lang", "phrase", "a", "c.l", "c.r", "c.score"
    )


def _covered(counts: DataFrame, size: int, longest: int) -> DataFrame:
    """``lang, phrase, longer``: the highest count of a longer candidate around each
    phrase of ``size`` words."""
    inner = None
    for n in range(size + 1, longest + 1):
        parts = F.array(*[_words_of("phrase", i, i + size) for i in range(n - size + 1)])
        rows = counts.filter(F.col("size") == n).select("lang", F.explode(parts).alias("phrase"), "f")
        inner = rows if inner is None else inner.union(rows)
    return inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = 10,
    inside_percent: int = 50,
    top: int = 2_000,
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of 2 to ``longest``
    words of each language.

    ``a``, ``l`` and ``r`` count the phrase and its two parts at the cut with the lowest
    score ``floor(10^6 a^2 / (l r))``, ``n`` all words. Phrases that occur fewer than
    ``least`` times, or at least ``inside_percent`` of whose count a longer one around
    them reaches, are left out.
    """
    if longest < 2:
        raise ValueError("a phrase has two words at least")
    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text")
    )
    dictionary = materialize(chunk_dictionary(rows, longest))
    totals, counts = phrase_counts(dictionary, longest, least)
    found = None
    for size in range(2, longest + 1):
        scored = _scored(counts, size)
        if size < longest:
            around = _covered(counts, size, longest)
            scored = scored.join(around, ["lang", "phrase"], "left").filter(
                F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a"))
            ).drop("longer")
        found = scored if found is None else found.union(scored)
    # The first of each part of a language, then of those the first of the language.
    order = (F.desc("score"), F.desc("a"), F.col("phrase"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANKED_PARTS)).alias("part")
    in_part = Window.partitionBy("lang", "part").orderBy(*order)
    first = (
        found.select("*", part)
        .withColumn("rank", F.row_number().over(in_part))
        .filter(F.col("rank") <= top)
    )
    return (
        first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
        .filter(F.col("rank") <= top)
        .join(sent(totals), "lang")
        .select(
            F.col("lang").alias("lang"),
            F.col("rank").cast("bigint").alias("rank"),
            "phrase", "a", "l", "r", "n", "score",
        )
    )
