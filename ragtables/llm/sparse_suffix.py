"""Passages that documents share word for word, by sparse suffix arrays.

Of every window of ``LEAST`` words, the position whose eight-word gram has the least
hash is kept; so a passage of that length selects the same positions wherever it
stands. Only positions whose gram occurs again matter. Their suffixes are sorted, and
neighbours compared: a run of neighbours that agree in enough words to the right,
and of these rows those that agree in the words to the left, share a window. The
windows that a position was kept for are all tried, so every shared window is found,
and shared windows that overlap join to passages.

Grams are counted over all documents. Two bit filters of a fixed size tell the tasks
which grams occur again and which are so frequent (``HOT``) that their suffixes would
be too many for one task; windows of those are counted by hash instead, combined
before the shuffle. Either way gives the same passages. Words are compared by 32 bits
of hash each, at least ``LEAST`` in a row.

Defined cases: texts with fewer than ``LEAST`` words, empty and null texts share
nothing; a passage that repeats only within one document is not shared; rows that
agree in id and text are one document; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragtables.llm import words
from ragtables.sources.storage import materialize

LEAST = 50
GRAM = 8
HOT = 20_000
FILTER_BITS = 1 << 25
# Suffixes are compared in batches of about this many.
BATCH = 50_000

_MULTIPLIER = 0xD6E8FEB86659FD93


def _kept(piece: words.Words, least: int) -> tuple[np.ndarray, ...]:
    """Row, position, and first and last window start of each kept position, with
    the gram there; positions count in the whole piece."""
    grams = words.shingle_hashes(piece.hashes, GRAM)
    rows = np.repeat(np.arange(len(piece.offsets) - 1), np.diff(piece.offsets))
    n = len(piece.hashes) - least + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros(0, np.uint64)
    starts = np.flatnonzero(rows[:n] == rows[least - 1 :])
    view = sliding_window_view(grams, least - GRAM + 1)
    place = np.zeros(len(starts), np.int64)
    for a in range(0, len(starts), 100_000):
        part = starts[a : a + 100_000]
        place[a : a + 100_000] = part + view[part].argmin(axis=1)
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (rows[starts[1:]] != rows[starts[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1 if len(first) else first
    at = place[first]
    return rows[starts[first]], at, starts[first], starts[last], grams[at]


def _grams(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch["text"], words.SPACES):
                found = _kept(piece, least)[4]
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64))], ["gram"])

    return run


def _bit(grams: np.ndarray) -> np.ndarray:
    return (words.mix(grams) >> np.uint64(7)) % np.uint64(FILTER_BITS)


def _filter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for batch in batches:
        if "bits" in batch.schema.names:
            for value in batch["bits"]:
                bits |= np.frombuffer(value.as_buffer(), np.uint8)
        else:
            place = _bit(batch["gram"].to_numpy(zero_copy_only=False).astype(np.uint64))
            np.bitwise_or.at(bits, place >> np.uint64(3), (1 << (place & np.uint64(7))).astype(np.uint8))
    yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], ["bits"])


def _sent_filter(grams: DataFrame):
    """A broadcast of FILTER_BITS bits that has every gram of the table."""
    found = grams.select("gram").mapInArrow(_filter, "bits binary").repartition(1)
    row = found.mapInArrow(_filter, "bits binary").first()
    return grams.sparkSession.sparkContext.broadcast(row["bits"] if row else bytes(FILTER_BITS // 8))


def _has(bits: np.ndarray, grams: np.ndarray) -> np.ndarray:
    place = _bit(grams)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _window_hashes(hashes: np.ndarray, starts: np.ndarray, least: int) -> np.ndarray:
    power = np.full(len(hashes) + 1, _MULTIPLIER, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    inverse = np.full(len(hashes) + 1, pow(_MULTIPLIER, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * power[:-1], out=sums[1:])
    return words.mix((sums[starts + least] - sums[starts]) * inverse[starts])


def _suffixes(again, hot, least: int):
    """Rows of kept positions whose gram occurs again. For a hot gram a row for each
    of its windows, with the window's hash; else one with its words to the right and,
    backwards, to the left, as far as its windows reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated = np.frombuffer(again.value, np.uint8)
        frequent = np.frombuffer(hot.value, np.uint8)
        for batch in batches:
            keys = batch["key"].to_numpy(zero_copy_only=False)
            for piece in words.pieces(batch["text"], words.SPACES):
                row, at, first, last, gram = _kept(piece, least)
                keep = _has(repeated, gram)
                row, at, first, last, gram = (x[keep] for x in (row, at, first, last, gram))
                short = (piece.hashes & np.uint64(0xFFFFFFFF)).astype(">u4")
                back = short[::-1].copy()
                begin = piece.offsets[row]
                key = keys[piece.first + row]
                often = _has(frequent, gram) if len(gram) else keep[:0]
                own = np.flatnonzero(~often)
                right = [short[a : b + least].tobytes() for a, b in zip(at[own], last[own])]
                n = len(back)
                left = [back[n - a : n - b].tobytes() for a, b in zip(at[own], first[own])]
                many = np.flatnonzero(often)
                size = (last - first + 1)[many]
                which = np.repeat(many, size)
                starts = np.repeat(first[many], size) + (
                    np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                )
                window = _window_hashes(piece.hashes, starts, least) if len(starts) else gram[:0]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([key[own], key[which]])),
                        pa.array(np.concatenate([gram[own], window]).astype(np.int64)),
                        pa.array(np.concatenate([(at - begin)[own], starts - begin[which]])),
                        pa.array(right + [None] * len(which), pa.binary()),
                        pa.array(left + [None] * len(which), pa.binary()),
                        pa.array(np.concatenate([(at - last)[own], np.zeros(len(which), np.int64)])),
                    ],
                    ["key", "gram", "place", "right", "left", "low"],
                )

    return run


def _matrix(cells: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of words padded with 0, and their lengths."""
    cells = cells.cast(pa.large_binary())
    offsets = np.frombuffer(cells.buffers()[1], np.int64)[cells.offset : cells.offset + len(cells) + 1] // 4
    size = np.diff(offsets)
    data = cells.buffers()[2]
    flat = np.frombuffer(data, ">u4") if data is not None and data.size else np.zeros(0, ">u4")
    out = np.zeros((len(cells), width), np.uint64)
    row = np.repeat(np.arange(len(cells)), size)
    col = np.arange(size.sum()) - np.repeat(offsets[:-1] - offsets[0], size)
    out[row, col] = flat[offsets[0] : offsets[-1]]
    return out, size


def _shared(table: pa.Table, least: int) -> pa.RecordBatch:
    """Passages that rows, in the order of their suffixes, share with others."""
    table = table.combine_chunks()
    column = {n: table[n].chunk(0) if table[n].num_chunks else pa.array([], table[n].type) for n in table.column_names}
    key = column["key"].to_numpy(zero_copy_only=False)
    place = column["place"].to_numpy(zero_copy_only=False)
    low = column["low"].to_numpy(zero_copy_only=False)
    right, right_size = _matrix(column["right"], least)
    left, left_size = _matrix(column["left"], least)
    # Words that a row has in common with the row before, to the right.
    equal = (right[1:] == right[:-1]) & (
        np.arange(least) < np.minimum(right_size[1:], right_size[:-1])[:, None]
    )
    common = np.where(equal.all(axis=1), least, equal.argmin(axis=1))
    before = np.zeros(len(key), np.uint64)  # hash of the words to the left so far
    starts: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    copies: list[np.ndarray] = []
    for j in range(least - GRAM + 1):
        if j:
            before = words.mix(before * np.uint64(_MULTIPLIER) + left[:, j - 1] + np.uint64(1))
        run = np.concatenate([[0], np.cumsum(common < least - j)]).astype(np.uint64)
        rows = np.flatnonzero((low <= j) & (j <= left_size))
        if len(rows) < 2:
            continue
        group = words.mix(before[rows] ^ words.mix(run[rows] + np.uint64(1)))
        order = np.lexsort((key[rows], group))
        group, rows = group[order], rows[order]
        head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.append(head, len(rows)))
        own = key[rows]
        other = np.concatenate([[True], own[1:] != own[:-1]])
        other[head] = True
        docs = np.add.reduceat(other.astype(np.int64), head)
        docs = np.repeat(docs, size)
        keep = docs > 1
        owners.append(own[keep])
        starts.append(place[rows[keep]] - j)
        copies.append(docs[keep])
    none = np.zeros(0, np.int64)
    owner, start, n = (np.concatenate(x) if x else none for x in (owners, starts, copies))
    order = np.lexsort((start, owner))
    owner, start, n = owner[order], start[order], n[order]
    # Windows of one document that begin next to each other join.
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] > start[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(owner)) - 1 if len(head) else head
    most = np.maximum.reduceat(n, head) if len(head) else n
    return pa.RecordBatch.from_arrays(
        [
            pa.array(owner[head].astype(np.int64)),
            pa.array(start[head].astype(np.int64)),
            pa.array((start[tail] + least).astype(np.int64)),
            pa.array(most.astype(np.int64)),
        ],
        ["key", "start", "stop", "copies"],
    )


def _compare(least: int):
    """Takes sorted suffixes, whole grams at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= BATCH:
                whole = pa.Table.from_batches(held)
                grams = whole["gram"].to_numpy()
                cut = int(np.searchsorted(grams, grams[-1]))  # the last gram may go on
                if cut:
                    yield _shared(whole.slice(0, cut), least)
                held = whole.slice(cut).combine_chunks().to_batches()
                rows = whole.num_rows - cut
        if rows:
            yield _shared(pa.Table.from_batches(held), least)

    return run


def shared_passages(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id, first_word, last_word, n_words, copies``: a row for each maximal run
    of words in which every window of ``least`` words stands in another document too.
    ``copies`` is the largest number of documents that share one of its windows.

    ``docs`` has ``doc_id, text``.
    """
    rows = docs.select(
        "doc_id", F.xxhash64("doc_id", F.xxhash64("text")).alias("key"), "text"
    )
    counts = materialize(
        rows.select("text").mapInArrow(_grams(least), "gram long")
        .groupBy("gram").count().filter("count > 1")
    )
    again = _sent_filter(counts)
    hot = _sent_filter(counts.filter(F.col("count") > HOT))
    found = materialize(
        rows.select("key", "text").mapInArrow(
            _suffixes(again, hot, least),
            "key long, gram long, place long, right binary, left binary, low long",
        )
    )
    kind = "key long, start long, stop long, copies long"
    passages = (
        found.filter("right is not null")
        .repartition("gram")
        .sortWithinPartitions("gram", "right")
        .mapInArrow(_compare(least), kind)
    )
    windows = found.filter("right is null").select("key", "gram", "place")
    # A document's windows are combined before the shuffle, and so are counts.
    held = windows.select("gram", "key").distinct()
    shared = held.groupBy("gram").agg(F.count("*").alias("copies")).filter("copies > 1")
    passages = passages.unionByName(
        windows.join(shared, "gram").select(
            "key", F.col("place").alias("start"), (F.col("place") + least).alias("stop"), "copies"
        )
    )
    step = lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["stop"] >= s["start"] + least - 1),
        F.concat(
            F.slice(acc, 1, F.size(acc) - 1),
            F.array(
                F.struct(
                    F.element_at(acc, -1)["start"].alias("start"),
                    F.greatest(F.element_at(acc, -1)["stop"], s["stop"]).alias("stop"),
                    F.greatest(F.element_at(acc, -1)["copies"], s["copies"]).alias("copies"),
                )
            ),
        ),
    ).otherwise(F.concat(acc, F.array(s)))
    joined = passages.groupBy("key").agg(
        F.sort_array(F.collect_set(F.struct("start", "stop", "copies"))).alias("spans")
    ).select(
        "key",
        F.explode(
            F.aggregate("spans", F.array().cast("array<struct<start: bigint, stop: bigint, copies: bigint>>"), step)
        ).alias("s"),
    )
    named = rows.select("doc_id", "key").distinct()
    return joined.join(named, "key").select(
        "doc_id",
        F.col("s.start").alias("first_word"),
        (F.col("s.stop") - 1).alias("last_word"),
        (F.col("s.stop") - F.col("s.start")).alias("n_words"),
        F.col("s.copies").alias("copies"),
    )
