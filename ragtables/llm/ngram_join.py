"""Near-duplicate documents: a Jaccard join on word shingles, and its components.

A document is the set of its distinct five-word shingles, as 64-bit hashes. All sets
are ordered alike, rare shingles first. Of a set of n shingles, the first
``n - ceil(t n) + l`` are its l-prefix, and two sets with similarity t or more share
at least l shingles of their l-prefixes. Each document chooses its own l: a longer
prefix costs more lookups but asks for more shared shingles before a pair is
verified, so the choice weighs both by estimated shingle frequencies. A pair is
verified if it shares ``min(l, l')`` emitted shingles.

Before sets are compared, signatures are: a bit is the parity of the shingles that
hash to it, so two signatures differ in at most as many bits as the sets differ in
shingles. A pair whose signatures differ in too many bits cannot be a link. Short ones, of
about a bit a shingle, go with the classes of a shingle to where they are matched.

Frequencies come from one pass over all documents into counters of a fixed number:
many small ones that end at 255 (``FINE``), and fewer large ones for what is more
frequent (``BUCKETS``). They set the order and the lengths, thus the cost, never the
result.

Equal sets become one class first. Pairs within a component need no verification, so
links are found in steps: first, some times over, each class is tried with the few
partners in other components that it shares most shingles with, then all candidate
pairs between the components that are left are tried. A large
group of copies costs in proportion to its size, and no link between components is
lost. Hashes of 64 bits stand for shingles and classes.

Defined cases: a text with fewer words than five is one shingle of all its words; a
null text or one without words has no shingle and is linked with nothing, not even
with its like; equal rows are linked; every input row gives one output row.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ragtables.llm import words
from ragtables.llm.base import free_name, released, sent, small_batches
from ragtables.llm.connected import components
from ragtables.sources.storage import materialize, scratch

SHINGLE = 5
# The similarity 0.8 as integers: 100 * intersection >= 80 * union.
PERCENT = 80
BUCKETS = 1 << 20
FINE = 1 << 24
SLICES = 64
# A shingle estimated beyond this is dealt to several tasks.
HOT = 1 << 18
LONGEST_EXTRA = 6
# Cost of verifying a pair, in units of looking up one posting.
VERIFY_COST = 8.0
BLOOM_BITS = 1 << 24
# Times that partners are proposed before all candidate pairs are tried.
ROUNDS = 3
# Classes of one shingle that are matched in one group, and rows matched at a time.
GROUP = 4_000
BATCH = 30_000
BATCH_BYTES = 1 << 25
# Pairs that a task holds to count them before it hands them out.
HELD_PAIRS = 2_000_000
# Bits of a short signature, at least and at most.
SHORT_BITS = 512
SHORT_MOST = 1 << 13
# Bits of a signature for each shingle, at least.
SIGNATURE_SHARE = 4


def _sets(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingle hashes."""
    for piece in words.pieces(batch[column], words.SPACES):
        at = piece.offsets
        whole = words.shingle_hashes(piece.hashes, SHINGLE)
        for i in range(len(at) - 1):
            n = at[i + 1] - at[i]
            if n >= SHINGLE:
                yield piece.first + i, np.unique(whole[at[i] : at[i + 1] - SHINGLE + 1])
            elif n:
                own = piece.hashes[at[i] : at[i + 1]]
                yield piece.first + i, words.shingle_hashes(own, len(own))
            else:
                yield piece.first + i, piece.hashes[:0]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, np.int64)
    fine = np.zeros(FINE, np.uint8)
    for batch in batches:
        for piece in words.pieces(batch["text"], words.SPACES):
            found = words.shingle_hashes(piece.hashes, SHINGLE)
            row = np.repeat(np.arange(len(piece.offsets) - 1), np.diff(piece.offsets))
            inside = row[: len(found)] == row[SHINGLE - 1 :][: len(found)]
            found = found[inside]
            counts += np.bincount(_bucket(found), minlength=BUCKETS)
            place, n = np.unique(_fine(found), return_counts=True)
            fine[place] = np.minimum(255, fine[place] + n)
    for part, pair in enumerate(zip(counts.reshape(SLICES, -1), fine.reshape(SLICES, -1))):
        yield _slice(part, *pair)


def _slice(part: int, counts: np.ndarray, fine: np.ndarray) -> pa.RecordBatch:
    """A row with one slice of the counters, most of which are small numbers."""
    cells = [pa.compress(c.tobytes(), "zstd", asbytes=True) for c in (counts, fine)]
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), *[pa.array([c], pa.binary()) for c in cells]],
        ["slice", "counts", "fine"],
    )


def _counters(cell: bytes, size: int, kind: type) -> np.ndarray:
    """The ``size // SLICES`` counters of a cell."""
    n = size // SLICES
    return np.frombuffer(pa.decompress(cell, n * np.dtype(kind).itemsize, "zstd"), kind)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the counters of each slice that this task holds."""
    sums: dict[int, np.ndarray] = {}
    fine: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, part in enumerate(batch["slice"].to_pylist()):
            sums[part] = sums.get(part, 0) + _counters(batch["counts"][i].as_py(), BUCKETS, np.int64)
            more = _counters(batch["fine"][i].as_py(), FINE, np.uint8).astype(np.uint16)
            fine[part] = np.minimum(255, fine.get(part, 0) + more).astype(np.uint8)
    for part in sums:
        yield _slice(part, sums[part], fine[part])


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)


def _fine(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) & (FINE - 1)


def _levels(counts: np.ndarray) -> np.ndarray:
    """Binary logarithms of how often a shingle is thought to occur; 0 where the
    count is no more than chance."""
    mean = counts.mean()
    excess = np.where(counts > mean + 4 * np.sqrt(mean) + 1, counts - mean, 0)
    return np.round(np.log2(1 + excess)).astype(np.uint8)


class Frequencies(NamedTuple):
    """Levels by counter; a byte each."""

    coarse: np.ndarray
    fine: np.ndarray

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        low = self.fine[_fine(hashes)]
        return np.where(low >= 7, np.maximum(low, self.coarse[_bucket(hashes)]), low)


def frequencies(texts: DataFrame) -> Frequencies:
    """Levels of all shingles of the texts."""
    kind = "slice int, counts binary, fine binary"
    rows = (
        texts.mapInArrow(released(_count), kind)
        .repartition("slice")
        .mapInArrow(released(_add), kind)
        .collect()  # BUCKETS and FINE counters
    )
    counts = np.zeros((SLICES, BUCKETS // SLICES), np.int64)
    fine = np.zeros((SLICES, FINE // SLICES), np.uint8)
    for r in rows:
        counts[r["slice"]] = _counters(r["counts"], BUCKETS, np.int64)
        fine[r["slice"]] = _counters(r["fine"], FINE, np.uint8)
    return Frequencies(_levels(counts).reshape(-1), _fine_levels(fine))


def _fine_levels(fine: np.ndarray) -> np.ndarray:
    """The same for small counters, of which there are 256 kinds."""
    each = np.bincount(fine.reshape(-1), minlength=256)
    mean = float((each * np.arange(256)).sum() / fine.size)
    n = np.arange(256)
    excess = np.where(n > mean + 4 * np.sqrt(mean) + 1, n - mean, 0)
    return np.round(np.log2(1 + excess)).astype(np.uint8)[fine.reshape(-1)]


def _prefix(found: np.ndarray, known: Frequencies) -> tuple[int, np.ndarray, np.ndarray]:
    """The chosen l, the prefix in the common order, and its frequency levels."""
    n = len(found)
    level = known.levels(found)
    key = (level.astype(np.uint64) << np.uint64(56)) | (words.mix(found) >> np.uint64(8))
    order = np.argsort(key, kind="stable")
    least = -(-PERCENT * n // 100)  # the overlap that any partner must have
    most = min(least, LONGEST_EXTRA)
    base = n - least
    often = np.where(level[order[: base + most]] > 0, 2.0 ** level[order[: base + most]], 0.0)
    lookups = np.cumsum(often)[base : base + most]
    extra = np.arange(1, most + 1)
    cost = lookups + VERIFY_COST * lookups / extra + base + extra
    chosen = int(np.argmin(cost)) + 1
    order = order[: base + chosen]
    return chosen, found[order], level[order]


def _signature(found: np.ndarray) -> bytes:
    """Parity bits; their number is a power of two, so a longer signature folds to
    the length of a shorter one."""
    size = max(64, 1 << (SIGNATURE_SHARE * len(found) - 1).bit_length())
    bit = (words.mix(~found) >> np.uint64(20)) & np.uint64(size - 1)
    parity = np.bincount(bit.astype(np.int64), minlength=size) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes()


def _short(found: np.ndarray) -> bytes:
    """A signature of about a bit a shingle, between ``SHORT_BITS`` and ``SHORT_MOST``."""
    size = min(SHORT_MOST, max(SHORT_BITS, 1 << (len(found) - 1).bit_length()))
    bit = (words.mix(~found) >> np.uint64(20)) & np.uint64(size - 1)
    parity = np.bincount(bit.astype(np.int64), minlength=size) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes()


def _apart(a: bytes, b: bytes) -> int:
    """A number of shingles that two sets differ in at least."""
    one, other = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(one), len(other))
    one, other = (np.bitwise_xor.reduce(x.reshape(-1, size), axis=0) for x in (one, other))
    return int(np.bitwise_count(one ^ other).sum())


def _describe(levels) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = levels.value
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            c = np.zeros((2, batch.num_rows), np.int64)
            extra = np.zeros(batch.num_rows, np.int32)
            bits: list[bytes | None] = [None] * batch.num_rows
            short: list[bytes | None] = [None] * batch.num_rows
            tokens, salts, sizes = [], [], np.zeros(batch.num_rows + 1, np.int32)
            for i, found in _sets(batch, "text"):
                n[i] = len(found)
                if len(found):
                    bits[i], short[i] = _signature(found), _short(found)
                    c[0, i] = words.mix(found).sum(dtype=np.uint64).astype(np.int64)
                    c[1, i] = np.bitwise_xor.reduce(words.mix(~found)).astype(np.int64)
                    extra[i], own, level = _prefix(found, known)
                    parts = np.maximum(1, (1 << level.astype(np.int64)) // HOT)
                    tokens.append(own.astype(np.int64))
                    part = 1 + (c[1, i].astype(np.uint64) % parts.astype(np.uint64)).astype(np.int32)
                    salts.append(np.where(parts > 1, part, 0).astype(np.int32))
                    sizes[i + 1] = len(own)
            offsets = pa.array(np.cumsum(sizes, dtype=np.int32))
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
            salt = np.concatenate(salts) if salts else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["text_hash"],
                    pa.array(n),
                    pa.array(c[0], mask=n == 0),
                    pa.array(c[1], mask=n == 0),
                    pa.array(extra),
                    pa.array(bits, pa.binary()),
                    pa.array(short, pa.binary()),
                    pa.ListArray.from_arrays(
                        offsets, pa.StructArray.from_arrays([pa.array(flat), pa.array(salt)], ["token", "salt"])
                    ),
                ],
                ["doc_id", "text_hash", "n", "c", "c2", "extra", "bits", "short", "prefix"],
            )

    return run


def _bloom(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(BLOOM_BITS, bool)
    for batch in batches:
        keys = batch["key"].to_numpy(zero_copy_only=False).astype(np.uint64)
        bits[(words.mix(keys) % np.uint64(BLOOM_BITS)).astype(np.int64)] = True
    yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], ["bits"])


def _or(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(BLOOM_BITS // 8, np.uint8)
    for batch in batches:
        for value in batch["bits"].to_pylist():
            bits |= np.frombuffer(value, np.uint8)
    yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], ["bits"])


def _wanted_sets(wanted) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(wanted.value, np.uint8)).astype(bool)
        for batch in batches:
            keys = batch["key"].to_numpy(zero_copy_only=False).astype(np.uint64)
            keep = bits[(words.mix(keys) % np.uint64(BLOOM_BITS)).astype(np.int64)]
            batch = batch.filter(pa.array(keep))
            sets = [found.tobytes() for _, found in _sets(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch["key"], pa.array(sets, pa.binary())], ["key", "found"]
            )

    return run


def _sets_of(pairs: DataFrame, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """``c, found``: the sets of the classes in ``pairs``, from one document of each.

    A filter of a fixed number of bits picks the documents where they are read, so
    that few other sets are made; a join by key is exact.
    """
    spark = pairs.sparkSession
    named = pairs.select(F.col("a").alias("c")).union(pairs.select("b")).distinct()
    wanted = materialize(classes.select("c", "key").join(named, "c", "left_semi"))
    bits = wanted.mapInArrow(released(_bloom), "bits binary").repartition(1).mapInArrow(released(_or), "bits binary").first()
    shared = spark.sparkContext.broadcast(bits["bits"] if bits else bytes(BLOOM_BITS // 8))
    sets = materialize(
        rows.select("key", "text")
        .mapInArrow(released(_wanted_sets(shared)), "key long, found binary")
        .join(sent(wanted), "key")
        .select("c", "found")
        .dropDuplicates(["c"])
    )
    shared.destroy()
    return sets


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = zip(batch["size_a"].to_pylist(), batch["size_b"].to_pylist())
        bits = zip(batch["bits_a"].to_pylist(), batch["bits_b"].to_pylist())
        keep = [
            (100 + PERCENT) * _apart(a, b) <= (100 - PERCENT) * (m + n)
            for (a, b), (m, n) in zip(bits, sizes)
        ]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _signed(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose signatures do not rule out a link."""
    for side in ("a", "b"):
        own = classes.select(
            F.col("c").alias(side), F.col("size").alias(f"size_{side}"), F.col("bits").alias(f"bits_{side}")
        )
        pairs = pairs.join(own, side)
    return pairs.mapInArrow(released(_possible), "a long, b long")


def _verify(percent: int) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (a, b) in enumerate(zip(batch["found_a"], batch["found_b"])):
                left = np.frombuffer(a.as_buffer(), np.uint64)
                right = np.frombuffer(b.as_buffer(), np.uint64)
                shared = len(np.intersect1d(left, right, assume_unique=True))
                keep[i] = 100 * shared >= percent * (len(left) + len(right) - shared)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _linked(pairs: DataFrame, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar enough."""
    pairs = materialize(_signed(pairs, classes))
    sets = _sets_of(pairs, classes, rows)
    left = sets.select(F.col("c").alias("b"), F.col("found").alias("found_b"))
    right = sets.select(F.col("c").alias("a"), F.col("found").alias("found_a"))
    full = pairs.join(left, "b").join(right, "a")
    return full.select("a", "b", "found_a", "found_b").mapInArrow(
        released(_verify(PERCENT)), "a long, b long"
    )


def _proposals(labelled: DataFrame, turn: int) -> DataFrame:
    """For each class, the neighbour and the first of its shingle lists, in an order
    that changes from turn to turn, that are in other components and that it shares
    most shingles with: three pairs a class at most."""
    rows = labelled.withColumn("order", F.xxhash64("c", F.lit(turn)) if turn else F.col("size"))
    own = Window.partitionBy("token", "salt").orderBy("order", "c")
    listed = rows.select(
        "token",
        "c",
        "root",
        F.lag(F.struct("c", "root")).over(own).alias("before"),
        F.first(F.struct("c", "root")).over(own).alias("first"),
    )
    # The lists of a hot shingle's parts are tied by their first classes.
    heads = listed.filter("before is null").select("token", "c", "root")
    tie = F.lag(F.struct("c", "root")).over(Window.partitionBy("token").orderBy("c"))
    chain = heads.select("c", "root", F.lit(2).alias("kind"), tie.alias("p"))
    kinds = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("before").alias("p")),
        F.struct(F.lit(1).alias("kind"), F.col("first").alias("p")),
    )
    pairs = (
        listed.select("c", "root", F.explode(kinds).alias("k"))
        .select("c", "root", "k.kind", "k.p")
        .union(chain)
        .filter("p is not null and p.root <> root")
        .select("c", "kind", F.col("p.c").alias("partner"))
    )
    best = (
        pairs.groupBy("c", "kind", "partner")
        .count()
        .groupBy("c", "kind")
        .agg(F.max_by("partner", F.struct("count", "partner")).alias("partner"))
    )
    return best.select(F.least("c", "partner").alias("a"), F.greatest("c", "partner").alias("b")).distinct()


def _open(shared: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The rows of shingles that stand in more than one component, with ``root``, the
    number of classes of the shingle (``listed``) and the least of them (``head``)."""
    if roots is None:
        return shared.withColumn("root", F.col("c"))
    rows = shared.join(roots.select(F.col("node").alias("c"), "root"), "c", "left")
    rows = rows.withColumn("root", F.coalesce("root", "c"))
    mixed = (
        rows.groupBy("token")
        .agg(
            F.min("root").alias("lo"),
            F.max("root").alias("hi"),
            F.count("*").alias("listed"),
            F.min("c").alias("head"),
        )
        .filter("lo <> hi")
        .select("token", "listed", "head")
    )
    return materialize(rows.join(mixed, "token"))


class _Signatures:
    """Short signatures of a batch, by length; each length is a power of two."""

    def __init__(self, cells: list[bytes]) -> None:
        self.length = np.array([len(c) for c in cells])
        self.place = np.zeros(len(cells), np.int64)
        self.table: dict[int, np.ndarray] = {}
        self.least = np.zeros((len(cells), SHORT_BITS // 64), np.uint64)
        for length in np.unique(self.length).tolist():
            rows = np.flatnonzero(self.length == length)
            raw = np.frombuffer(b"".join([cells[i] for i in rows.tolist()]), np.uint64)
            self.place[rows] = np.arange(len(rows))
            self.table[length] = raw.reshape(len(rows), -1)
            self.least[rows] = _folded(self.table[length], SHORT_BITS // 8)

    def near(self, x: np.ndarray, y: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which of the pairs may be links. ``sizes`` are those of both sets together."""
        most = (100 - PERCENT) * sizes // (100 + PERCENT)
        apart = np.bitwise_count(self.least[x] ^ self.least[y]).sum(axis=1, dtype=np.int64)
        left = np.flatnonzero(apart <= most)
        keep = np.zeros(len(x), bool)
        kinds = self.length[x[left]] * (1 << 20) + self.length[y[left]]
        for kind in np.unique(kinds).tolist():
            one, other = kind >> 20, kind & ((1 << 20) - 1)
            rows = left[kinds == kind]
            step = max(1, (1 << 23) // max(one, other))
            for part in (rows[i : i + step] for i in range(0, len(rows), step)):
                a = _folded(self.table[one][self.place[x[part]]], min(one, other))
                b = _folded(self.table[other][self.place[y[part]]], min(one, other))
                keep[part] = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64) <= most[part]
        return keep


def _folded(bits: np.ndarray, length: int) -> np.ndarray:
    """Signatures of ``length`` bytes out of longer ones."""
    if bits.shape[1] * 8 == length:
        return bits
    return np.bitwise_xor.reduce(bits.reshape(len(bits), -1, length // 8), axis=1)


def _crossed(table: pa.Table) -> pa.RecordBatch:
    """Pairs of rows of a group that may be links; rows are sorted by group."""
    table = table.combine_chunks()
    column = {
        n: table[n].to_numpy(zero_copy_only=False)
        for n in ("token", "i", "j", "block", "c", "size", "extra", "root")
    }
    signed = _Signatures(table["short"].to_pylist())
    c, size, extra, root, block = (column[n] for n in ("c", "size", "extra", "root", "block"))
    new = np.ones(len(c), bool)
    for n in ("token", "i", "j"):
        new[1:] &= column[n][1:] == column[n][:-1]
    new[1:] = ~new[1:]
    head = np.flatnonzero(new)
    end = np.repeat(np.append(head[1:], len(c)), np.diff(np.append(head, len(c))))
    inside = column["i"] == column["j"]
    rows = np.arange(len(c))
    out = []
    for step in range(1, len(c)):
        rows = rows[rows + step < end[rows]]
        if not len(rows):
            break
        other = rows + step
        fine = (root[rows] != root[other]) & (inside[rows] | (block[rows] != block[other]))
        least, most = np.minimum(size[rows], size[other]), np.maximum(size[rows], size[other])
        fine &= 100 * least >= PERCENT * most
        x, y = rows[fine], other[fine]
        fine = signed.near(x, y, size[x] + size[y])
        out.append((x[fine], y[fine]))
    x = np.concatenate([p for p, _ in out]) if out else rows[:0]
    y = np.concatenate([p for _, p in out]) if out else rows[:0]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.minimum(c[x], c[y])),
            pa.array(np.maximum(c[x], c[y])),
            pa.array(np.minimum(extra[x], extra[y])),
        ],
        ["a", "b", "needed"],
    )


def _combined(found: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Pairs with the number of shingles that they were found by."""
    pairs = pa.Table.from_batches(found).group_by(["a", "b"])
    sums = pairs.aggregate([("needed", "min"), ("needed", "count")])
    sums = sums.rename_columns(["a", "b", "needed", "hits"]).combine_chunks()
    return pa.RecordBatch.from_arrays([c.combine_chunks() for c in sums.columns], sums.column_names)


def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Takes sorted rows, whole groups at a time."""
    held: list[pa.RecordBatch] = []
    found: list[pa.RecordBatch] = []
    rows = size = pairs = 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= BATCH or size >= BATCH_BYTES:
            whole = pa.Table.from_batches(held)
            tokens = whole["token"].to_numpy()
            others = np.flatnonzero(tokens != tokens[-1])
            cut = int(others[-1]) + 1 if len(others) else 0  # the last one may go on
            if cut:
                found.append(_crossed(whole.slice(0, cut)))
                pairs += found[-1].num_rows
            held = whole.slice(cut).combine_chunks().to_batches()
            rows, size = whole.num_rows - cut, sum(b.nbytes for b in held)
            if pairs >= HELD_PAIRS:
                yield _combined(found)
                found, pairs = [], 0
    if rows:
        found.append(_crossed(pa.Table.from_batches(held)))
    if found:
        yield _combined(found)


def _candidates(labelled: DataFrame, classes: DataFrame) -> DataFrame:
    """All pairs of classes of different components that share enough shingles and
    whose short signatures do not rule out a link.

    The classes of a shingle are matched within a task, which hands out what may be
    a link and nothing else. Shingles with the same least class, as those of a passage
    have, meet in one task, which counts their pairs before it hands them out. A
    shingle with more than ``GROUP`` classes is cut into blocks, and each pair of
    blocks is a group of its own.
    """
    rows = labelled.join(classes.select("c", "short"), "c")
    blocks = F.ceil(F.col("listed") / GROUP).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("c"), blocks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    rows = rows.withColumn("other", other).select(
        "head",
        "token",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "block", "c", "size", "extra", "root", "short",
    )
    return (
        rows.repartition("head", "i", "j")
        .sortWithinPartitions("head", "token", "i", "j")
        .mapInArrow(released(_cross), "a long, b long, needed int, hits long")
        .groupBy("a", "b")
        .agg(F.sum("hits").alias("hits"), F.min("needed").alias("needed"))
        .filter("hits >= needed")
        .select("a", "b")
    )


def ngram_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, text_hash`` for every row of ``docs``: set
    size, and least id among the documents reachable by links."""
    return _joined(docs, doc_id, text).drop("root")


def _joined(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The same with the ``root`` of each component, null for a text without words.
    Components may have the same least id where ids are repeated."""
    with small_batches(docs.sparkSession):
        return _components_of(docs, doc_id, text)


def _components_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{text}`").alias("text"),
        F.xxhash64(f"`{text}`").alias("text_hash"),
    )
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text_hash"))
    levels = spark.sparkContext.broadcast(frequencies(rows.select("text")))  # BUCKETS bytes
    id_type = rows.schema["doc_id"].dataType.simpleString()
    described = materialize(
        rows.drop("key").mapInArrow(
            released(_describe(levels)),
            f"doc_id {id_type}, text_hash long, n long, c long, c2 long, extra int,"
            " bits binary, short binary, prefix array<struct<token: long, salt: int>>",
        )
    )
    levels.destroy()
    first = (
        described.filter("n > 0")
        .groupBy("c", "c2")
        .agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    )
    again = materialize(
        described.filter("n > 0")
        .select("doc_id", "c", "c2")
        .join(first.filter("copies > 1"), ["c", "c2"])
        .filter("doc_id <> least")
        .select("doc_id", "c")
    )
    only = described.filter("n > 0").join(sent(again), ["doc_id", "c"], "left_anti")
    classes = materialize(
        only.select(
            "c",
            F.xxhash64("doc_id", "text_hash").alias("key"),
            F.col("n").alias("size"),
            "extra",
            "bits",
            "short",
        ).dropDuplicates(["c"])
    )
    postings = only.select("c", F.explode("prefix").alias("p")).select("p.token", "p.salt", "c")
    in_list = Window.partitionBy("token", "salt").orderBy("c")
    shared = postings.select(
        "token",
        "salt",
        "c",
        F.coalesce(F.lag("c").over(in_list), F.lead("c").over(in_list)).alias("other"),
    ).filter("other is not null or salt > 0")
    shared = materialize(
        shared.select("token", "salt", "c").distinct().join(classes.select("c", "size", "extra"), "c")
    )
    links, roots, tried = None, None, None
    for turn in range(ROUNDS):
        pairs = materialize(_proposals(_open(shared, roots), turn))
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        tried = pairs if tried is None else tried.union(pairs)
        found = materialize(_linked(pairs, classes, rows))
        if found.isEmpty() and turn:
            break
        links = found if links is None else links.union(found)
        roots = components(links)
    pairs = _candidates(_open(shared, roots), classes).join(tried, ["a", "b"], "left_anti")
    more = _linked(pairs, classes, rows)
    roots = components(links.union(materialize(more)))
    least = (
        first.join(roots.select(F.col("node").alias("c"), "root"), "c", "left")
        .select("c", "c2", "least", F.coalesce("root", "c").alias("root"))
    )
    by_root = least.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = least.join(by_root, "root").select("c", "c2", "component_id", "root")
    return (
        described.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "c", "c2")
        .join(by_class, ["c", "c2"], "left")
        .select(
            F.col("doc_id").alias(doc_id),
            "n_shingles",
            F.coalesce("component_id", "doc_id").alias("component_id"),
            "text_hash",
            "root",
        )
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (``doc_id, text``, and what else there is) with one
    document of each component: that with the least id and, where several have it,
    the least hash of its text. Rows that agree in id and text are one document."""
    extra_id, extra_hash = free_name(docs, "extra_id_"), free_name(docs, "extra_hash_")
    with scratch(docs.sparkSession):
        found = materialize(_joined(docs))
        several = materialize(
            found.filter("doc_id = component_id and root is not null")
            .groupBy("root")
            .agg(F.min("text_hash").alias("kept_hash"), F.max("text_hash").alias("last_hash"))
            .filter("kept_hash < last_hash")
        )
        same_id = found.join(sent(several), "root").filter("doc_id = component_id and text_hash <> kept_hash")
        other_id = found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
        extra = materialize(
            other_id.select("doc_id", "text_hash")
            .unionByName(same_id.select("doc_id", "text_hash"))
            .select(F.col("doc_id").alias(extra_id), F.col("text_hash").alias(extra_hash))
            .distinct(),
            keep=True,
        )
        repeated = not found.groupBy("doc_id", "text_hash").count().filter("count > 1").isEmpty()
    own = docs["doc_id"].eqNullSafe(F.col(extra_id)) & (F.xxhash64(docs["text"]) == F.col(extra_hash))
    kept = docs.join(sent(extra), own, "left_anti")
    return kept.dropDuplicates(["doc_id", "text"]) if repeated else kept
