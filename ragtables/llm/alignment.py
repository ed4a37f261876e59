"""Alignment of two tokenizers' tokens over the same bytes, by pointer jumping.

Both tokenizers cut the bytes of space + text. Every token points to the token of the
other side that overlaps it and reaches farthest right, or to itself where none reaches
farther. Replacing each pointer by its target's pointer halves the way that is left, so
after some rounds over whole arrays all tokens of a component point to its terminal
token, which labels the group: a stretch between two places where both sides end.

Spaces between printable ASCII characters end a token on both sides, whatever stands
around them. Texts are cut there into units, and each distinct unit is tokenised and
aligned once per task; a document's tokens, groups and links are those of its units in
order. A tokenizer file without that property gets whole texts as units.

Links are the pairs of tokens that end together. How often each pair of ids is linked
in the whole corpus comes from sums by pair; documents then need the counts of their
pairs. The most frequent pairs, of which there is a bounded number, are sent to all
tasks. What is not among them is joined by key.

Defined cases: a null or empty text, and one whose joined token bytes differ from
space + text on either side (a tokenizer that drops or replaces something), has no
tokens: zeros, and an empty digest. Rows count each for itself, repeated ids and null
ids too. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragtables.llm import words
from ragtables.llm.base import sent
from ragtables.sources.storage import materialize

# A task forgets its units when they, and what is known of them, exceed this.
MEMORY_BYTES = 150_000_000
# Pairs of ids whose counts are sent to all tasks, at 17 bytes each.
SENT_PAIRS = 2_000_000
# Links that a task sums up before it hands out their counts.
HELD_LINKS = 6_000_000


# ------------------------------------------------------------- pointer jumping


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terminal token of each token of A and of B, as an index into A.

    Ends are ascending byte places; both sides start at 0 and end at the same place,
    and no token is empty.
    """
    n = len(ends_a)
    # The last token of the other side that starts before this one ends.
    right_a = np.searchsorted(np.concatenate([[0], ends_b[:-1]]), ends_a) - 1
    right_b = np.searchsorted(np.concatenate([[0], ends_a[:-1]]), ends_b) - 1
    jump = np.concatenate(
        [np.where(ends_b[right_a] > ends_a, n + right_a, np.arange(n)), right_b]
    )
    while True:
        further = jump[jump]
        if (further == jump).all():
            return jump[:n], jump[n:]
        jump = further


# ------------------------------------------------------------------ tokenizers


class Side(NamedTuple):
    """A tokenizer: ids of texts that follow a space, and the bytes of each id."""

    encode: Callable[[list[str]], list[list[int]]]
    pieces: list[bytes]
    spaces_cut: bool


def _byte_letters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_level(path: str) -> Side:
    """A byte-level BPE of the tokenizers library; special tokens are plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    letters = _byte_letters()
    pieces = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
        known = all(c in letters for c in token)
        pieces[i] = bytes(letters[c] for c in token) if known else token.encode()

    def encode(texts: list[str]) -> list[list[int]]:
        found = tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [f.ids for f in found]

    state = tokenizer.pre_tokenizer.__getstate__() if tokenizer.pre_tokenizer else b""
    cut = tokenizer.normalizer is None and b'"ByteLevel"' in state and b'"use_regex":true' in state
    return Side(encode, pieces, cut)


def sentence_pieces(path: str) -> Side:
    """A sentencepiece model that puts a space before each text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    pieces = [
        bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode()
        for i, name in enumerate(names)
    ]

    def encode(texts: list[str]) -> list[list[int]]:
        return model.encode(texts, num_threads=1)

    # Where no piece holds a space after something else, none reaches across one.
    return Side(encode, pieces, not any("▁" in n.lstrip("▁") for n in names))


# ----------------------------------------------------------------------- units


def _units(texts: pa.Array, cut: bool) -> Iterator[tuple]:
    """Some rows at a time: first row, first unit of each row and one more, and hash,
    start and end of each unit. A unit is what follows a space that cuts."""
    at, raw = words.text_buffers(texts)
    n, row = len(at) - 1, 0
    printable = np.zeros(256, bool)
    printable[0x21:0x7F] = True
    while row < n:
        stop = int(np.searchsorted(at, at[row] + words.PIECE_BYTES, side="right")) - 1
        stop = min(n, max(stop, row + 1))
        data = raw[at[row] : at[stop]]
        edges = at[row : stop + 1] - at[row]
        places = np.zeros(0, np.int64)
        if cut and len(data) > 2:
            inner = (data[1:-1] == 0x20) & printable[data[:-2]] & printable[data[2:]]
            places = np.flatnonzero(inner) + 1
            # Not next to the edge of a row: the neighbour is another text's.
            row_of = np.searchsorted(edges, places, side="right")
            places = places[(places > edges[row_of - 1]) & (places + 1 < edges[row_of])]
        heads = edges[:-1][np.diff(edges) > 0]
        starts = np.concatenate([heads, places + 1])
        after_space = np.repeat([0, 1], [len(heads), len(places)])
        order = np.argsort(starts, kind="stable")
        starts, after_space = starts[order], after_space[order]
        ends = np.append(starts[1:] - after_space[1:], len(data))[: len(starts)]
        firsts = np.searchsorted(starts, edges)
        yield row, firsts, words.span_hashes(data, starts, ends), data.tobytes(), starts, ends
        row = stop


class Units:
    """What is known of the distinct units of a task."""

    def __init__(self, make_a, make_b) -> None:
        self.a, self.b = make_a(), make_b()
        self.cut = self.a.spaces_cut and self.b.spaces_cut
        self.radix = len(self.b.pieces)
        self._clear()

    def _clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # sorted
        self.place = np.zeros(0, np.int64)
        self.n_a = self.n_b = self.n_links = np.zeros(0, np.int64)
        self.good = np.zeros(0, bool)
        self.shown: list[str] = []
        self.bytes = 0
        self.flat = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)

    def find(self, hashes: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each unit; new ones are tokenised and aligned."""
        if self.bytes > MEMORY_BYTES:
            self._clear()
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        numbers = np.empty(len(distinct), np.int64)
        numbers[known] = self.place[at[known]]
        numbers[new] = len(self.shown) + np.arange(len(new))
        if len(new):
            rows = first[new]
            self._learn([data[s:e].decode() for s, e in zip(starts[rows].tolist(), ends[rows].tolist())])
            self.hashes = np.insert(self.hashes, at[new], distinct[new])
            self.place = np.insert(self.place, at[new], numbers[new])
        return numbers[back]

    def _learn(self, texts: list[str]) -> None:
        ids_a, ids_b = self.a.encode(texts), self.b.encode(texts)
        pa_, pb = self.a.pieces, self.b.pieces
        want = [b" " + t.encode() for t in texts]
        good = np.array(
            [
                b"".join([pa_[i] for i in a]) == w and b"".join([pb[i] for i in b]) == w
                for a, b, w in zip(ids_a, ids_b, want)
            ],
            bool,
        )
        keep = np.flatnonzero(good).tolist()
        n_a, n_b = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        n_a[keep], n_b[keep] = [len(ids_a[i]) for i in keep], [len(ids_b[i]) for i in keep]
        flat_a = np.array([x for i in keep for x in ids_a[i]], np.int64)
        flat_b = np.array([x for i in keep for x in ids_b[i]], np.int64)
        # Ends over all new units, one after the other: no group reaches across two.
        ends_a = np.cumsum(np.fromiter((len(pa_[i]) for i in flat_a.tolist()), np.int64, len(flat_a)))
        ends_b = np.cumsum(np.fromiter((len(pb[i]) for i in flat_b.tolist()), np.int64, len(flat_b)))
        if len(flat_a):
            label_a, label_b = terminals(ends_a, ends_b)
        else:
            label_a, label_b = flat_a, flat_b
        unit_a = np.repeat(np.arange(len(texts)), n_a)
        # A terminal token and the other side's token that ends with it are a link.
        last_a = np.flatnonzero(label_a == np.arange(len(label_a)))
        last_b = np.searchsorted(ends_b, ends_a[last_a]) if len(last_a) else last_a
        links = np.bincount(unit_a[last_a], minlength=len(texts)).astype(np.int64)
        code = flat_a[last_a] * self.radix + flat_b[last_b]
        self.shown += _shown(flat_a, label_a, flat_b, label_b, n_a, n_b)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(links) - links])
        self.flat = np.concatenate([self.flat, code])
        self.n_a = np.concatenate([self.n_a, n_a])
        self.n_b = np.concatenate([self.n_b, n_b])
        self.n_links = np.concatenate([self.n_links, links])
        self.good = np.concatenate([self.good, good])
        self.bytes += 150 * len(texts) + 8 * len(code) + sum(map(len, self.shown[-len(texts) :]))


def _shown(
    ids_a: np.ndarray, label_a: np.ndarray, ids_b: np.ndarray, label_b: np.ndarray,
    n_a: np.ndarray, n_b: np.ndarray,
) -> list[str]:
    """``a,a|b;a|b,b`` of each unit."""
    ids = np.concatenate([ids_a, ids_b])
    label = np.concatenate([label_a, label_b])
    side = np.repeat([0, 1], [len(ids_a), len(ids_b)])
    unit = np.concatenate([np.repeat(np.arange(len(n_a)), n_a), np.repeat(np.arange(len(n_b)), n_b)])
    order = np.lexsort((side, label))  # keeps the order within a side
    ids, label, side, unit = ids[order], label[order], side[order], unit[order]
    sign = np.full(len(ids), ",")
    sign[:-1][side[1:] != side[:-1]] = "|"
    sign[:-1][label[1:] != label[:-1]] = ";"
    sign[:-1][unit[1:] != unit[:-1]] = "\n"
    if len(sign):
        sign[-1] = ""
    said = iter("".join(map("".join, zip(map(str, ids.tolist()), sign.tolist()))).split("\n"))
    return [next(said) if n else "" for n in n_a.tolist()]


# ----------------------------------------------------------------------- tasks


def _pack(codes: np.ndarray, counts: np.ndarray) -> bytes:
    """Distinct codes in ascending order, as differences, and their counts."""
    if not len(codes):
        return b""
    steps = np.diff(codes, prepend=0)
    kind = "<u4" if steps.max() < 1 << 32 else "<u8"
    many = "<u1" if counts.max() < 256 else "<u4"
    raw = steps.astype(kind).tobytes() + counts.astype(many).tobytes()
    return f"{kind[-1]}{many[-1]}".encode() + pa.compress(raw, "zstd", asbytes=True)


def _unpack(cell: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    wide, many = int(cell[:1]), int(cell[1:2])
    raw = pa.decompress(cell[2:], n * (wide + many), "zstd", asbytes=True)
    steps = np.frombuffer(raw, f"<u{wide}", n)
    counts = np.frombuffer(raw, f"<u{many}", n, n * wide)
    return np.cumsum(steps.astype(np.int64)), counts.astype(np.int64)


def _distinct(of: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct codes of each row in ascending order, and how often they occur."""
    if not len(code):
        return of, code, code
    top = int(code.max()) + 1
    if top * (int(of[-1]) + 1) < 1 << 63:
        both = np.sort(of * top + code)
        of, code = both // top, both % top
    else:
        order = np.lexsort((code, of))
        of, code = of[order], code[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    return of[at], code[at], np.diff(np.append(at, len(code)))


def _aligned(make_a, make_b):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = None
        for batch in batches:
            units = units or Units(make_a, make_b)
            for row, firsts, hashes, data, starts, ends in _units(batch["text"], units.cut):
                rows = len(firsts) - 1
                found = units.find(hashes, data, starts, ends)
                owner = np.repeat(np.arange(rows), np.diff(firsts))
                bad = np.bincount(owner, ~units.good[found], minlength=rows) > 0
                held = found[~bad[owner]]
                owner = owner[~bad[owner]]

                def total(each: np.ndarray) -> np.ndarray:
                    return np.bincount(owner, each[held], minlength=rows).astype(np.int64)

                n_a, n_b, n_links = total(units.n_a), total(units.n_b), total(units.n_links)
                sizes = units.n_links[held]
                shift = units.starts[held] - (np.cumsum(sizes) - sizes)
                code = units.flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]
                # Distinct codes of each row.
                of, code, counts = _distinct(np.repeat(owner, sizes), code)
                cuts = np.searchsorted(of, np.arange(rows + 1))
                shown, first = units.shown, np.searchsorted(owner, np.arange(rows + 1)).tolist()
                held = held.tolist()
                digests = [
                    hashlib.sha256(";".join([shown[i] for i in held[s:e]]).encode()).hexdigest() if e > s else ""
                    for s, e in zip(first[:-1], first[1:])
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(row, rows),
                        pa.array(n_a),
                        pa.array(n_b),
                        pa.array(n_links),
                        pa.array(digests, pa.string()),
                        pa.array(np.diff(cuts)),
                        pa.array([_pack(code[s:e], counts[s:e]) for s, e in zip(cuts[:-1], cuts[1:])], pa.binary()),
                    ],
                    ["doc_id", "n_a", "n_b", "n_links", "groups_sha256", "n_pairs", "pairs"],
                )

    return run


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of pairs, summed over many documents before they are handed out."""

    def summed() -> pa.RecordBatch:
        code, back = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
        n = np.bincount(back, np.concatenate([n for _, n in held])).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["pair", "n"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        for cell, n in zip(batch["pairs"].to_pylist(), batch["n_pairs"].to_pylist()):
            held.append(_unpack(cell, n))
            size += n
            if size >= HELD_LINKS:
                yield summed()
                held, size = [], 0
    if size:
        yield summed()


_KEPT = ["doc_id", "n_a", "n_b", "n_links", "groups_sha256", "row"]


def _scored(sent_pairs):
    """Sums over the pairs that were sent; the others, to be joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, count = sent_pairs.value
        code = np.frombuffer(raw, np.int64, count)
        n = np.frombuffer(raw, np.int64, count, 8 * count)
        best = np.frombuffer(raw, np.uint8, count, 16 * count).astype(np.int64)
        for batch in batches:
            cells = [_unpack(c, m) for c, m in zip(batch["pairs"].to_pylist(), batch["n_pairs"].to_pylist())]
            cuts = np.cumsum([0, *(len(c) for c, _ in cells)])
            own = np.concatenate([np.zeros(0, np.int64), *[c for c, _ in cells]])
            many = np.concatenate([np.zeros(0, np.int64), *[m for _, m in cells]])
            at = np.minimum(np.searchsorted(code, own), max(count - 1, 0))
            hit = code[at] == own if count else np.zeros(len(own), bool)

            def total(each: np.ndarray) -> pa.Array:
                sums = np.zeros(len(own) + 1, np.int64)
                if count:
                    np.cumsum(np.where(hit, many * each[at], 0), out=sums[1:])
                return pa.array(sums[cuts[1:]] - sums[cuts[:-1]])

            left = pa.StructArray.from_arrays([pa.array(own[~hit]), pa.array(many[~hit])], ["pair", "m"])
            misses = np.concatenate([[0], np.cumsum(~hit)])[cuts].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[c] for c in _KEPT),
                    total(best),
                    total(n),
                    pa.ListArray.from_arrays(pa.array(misses), left),
                ],
                [*_KEPT, "n_best", "count_sum", "left"],
            )

    return run


# ------------------------------------------------------------------- operators


def pair_counts(aligned: DataFrame, radix: int) -> DataFrame:
    """``pair, n, best``: how many links hold a pair, and whether no other pair of its
    B id is linked more often. ``pair`` is the A id times ``radix`` plus the B id."""
    counts = materialize(
        aligned.select("pairs", "n_pairs")
        .mapInArrow(_pair_sums, "pair long, n long")
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
    )
    b = (F.col("pair") % radix).alias("b")
    most = counts.groupBy(b).agg(F.max("n").alias("most"))  # a row per id of B
    return materialize(
        counts.withColumn("b", F.col("pair") % radix)
        .join(sent(most), "b")
        .select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    )


def _frequent(counts: DataFrame) -> tuple[int, bool]:
    """The least count such that at most ``SENT_PAIRS`` pairs reach it, to a power of
    two, and whether any pair does not."""
    level = F.floor(F.log2("n")).cast("int")
    rows = {r["level"]: r["count"] for r in counts.groupBy(level.alias("level")).count().collect()}
    least, held = 0, 0
    for at in sorted(rows, reverse=True):  # at most 63 levels
        if held + rows[at] > SENT_PAIRS:
            least = at + 1
            break
        held += rows[at]
    return 1 << least, least > 0


def align_tokens(
    docs: DataFrame,
    make_a: Callable[[], Side],
    make_b: Callable[[], Side],
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each
    row. ``make_a`` and ``make_b`` open a tokenizer, on the executors too."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    kept = f"doc_id {id_type}, n_a long, n_b long, n_links long, groups_sha256 string"
    aligned = materialize(
        rows.mapInArrow(_aligned(make_a, make_b), f"{kept}, n_pairs long, pairs binary").withColumn(
            "row", F.monotonically_increasing_id()  # fixed by being stored
        )
    )
    counts = pair_counts(aligned, len(make_b().pieces))
    least, more = _frequent(counts)
    top = counts.filter(F.col("n") >= least).toPandas().sort_values("pair")  # SENT_PAIRS rows
    raw = b"".join(
        top[c].to_numpy().astype(kind).tobytes() for c, kind in (("pair", "<i8"), ("n", "<i8"), ("best", "u1"))
    )
    shared = spark.sparkContext.broadcast((raw, len(top)))
    left = "left array<struct<pair: long, m: long>>"
    found = aligned.mapInArrow(_scored(shared), f"{kept}, row long, n_best long, count_sum long, {left}")
    if more:
        found = materialize(found)
        rest = (
            found.select("row", F.explode("left").alias("l"))
            .select("row", "l.pair", "l.m")
            .join(counts.filter(F.col("n") < least), "pair")
            .groupBy("row")
            .agg(
                F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("more_best"),
                F.sum(F.col("m") * F.col("n")).alias("more_sum"),
            )
        )
        found = found.join(rest, "row", "left").withColumns(
            {
                "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
                "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0)),
            }
        )
    return found.select(
        "doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "groups_sha256"
    )
