"""Token ids of a corpus in compressed blocks, and back.

A store is a folder with three tables: ``blocks`` (compressed ids of whole documents,
in ascending id order within a part, parts in ascending order), ``parts`` (where each
part starts in the whole sequence) and ``frequencies`` (the table that all blocks
share). Blocks decode independently, and within a block every segment does.

Texts are tokenised once, and ids go through Spark as binary cells; of rows that agree
in id and text and lie side by side one cell goes, with their number. Where white space
separates the tokenizer's words, which its file tells, a task encodes every distinct
word once with the library and gathers the rest; any other tokenizer gets whole texts.

Defined cases: null and empty texts have only the end id; rows with one id follow
each other in order of their ids; a null id comes first; an empty table gives an
empty store.
"""

from __future__ import annotations

import itertools
import json
import os
import string
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ragtables.llm import words
from ragtables.llm.base import released, small_batches
from ragtables.llm.rans import Decoder, Table, encode
from ragtables.sources.storage import materialize, scratch

# A block is coded in arrays of 64-bit numbers, several of its length at once.
BLOCK_IDS = 1 << 18
# A task forgets its words when what it keeps of them exceeds this.
REMEMBERED_BYTES = 16_000_000
# Texts whose words are looked up at a time, in bytes.
PIECE_BYTES = 500_000

# Fixed value: the word pattern of a public tokenizer's file. By it, a word also ends
# between an ASCII letter and an ASCII mark other than the apostrophe.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_KINDS = np.zeros(256, np.uint8)
_KINDS[np.frombuffer(string.ascii_letters.encode(), np.uint8)] = 1
_KINDS[np.frombuffer(string.punctuation.replace("'", "").encode(), np.uint8)] = 2


def splits_at_spaces(tokenizer) -> bool:
    """Whether white space parts a tokenizer's words and leaves no trace: then a text's
    ids are those of its words, one after the other."""
    state = json.loads(tokenizer.to_str())

    def steps(part: dict | None, list_name: str) -> list[dict]:
        if part is None:
            return []
        return part[list_name] if part["type"] == "Sequence" else [part]

    for step in steps(state["normalizer"], "normalizers"):
        spaced = step["type"] == "Replace" and step["pattern"] == {"Regex": "\\s+"} and step["content"] == " "
        if not spaced and step["type"] not in ("NFC", "NFD", "Lowercase"):
            return False
    first, *rest = steps(state["pre_tokenizer"], "pretokenizers") or [{"type": None}]
    if first["type"] == "Split":
        # What the pattern does not match is dropped; it must match no white space.
        pattern = first["pattern"].get("Regex", "")
        kept = regex.sub(r"\[\^[^\]]*\\s[^\]]*\]", "", pattern)  # [^\s...] matches none
        if first["behavior"] != "Removed" or not first["invert"] or not pattern:
            return False
        if regex.search(r"\s|\\[sSWDPvnrt]|(?<!\\)\.|\[\^", kept):
            return False
    elif first["type"] not in ("Whitespace", "WhitespaceSplit"):
        return False
    for step in rest:
        if step["type"] != "ByteLevel" or step["add_prefix_space"]:
            return False
    marks = [t for t in state["added_tokens"] if t["lstrip"] or t["rstrip"] or t["single_word"]]
    texts = "".join(t["content"] for t in state["added_tokens"])
    return not marks and not regex.search(r"\s", texts)


class Kind(NamedTuple):
    """What is to know of a tokenizer file before texts are cut for it."""

    by_word: bool
    fold: bool
    marks: bool  # words also end between letters and marks
    special: tuple[str, ...]


def kind_of(path: str) -> Kind:
    """Reads the file's steps, once for a job; the tasks need not hold them."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    state = json.loads(tokenizer.to_str())
    return Kind(
        splits_at_spaces(tokenizer),
        '"Lowercase"' in json.dumps(state["normalizer"]),
        WORD_PATTERN in json.dumps(state["pre_tokenizer"]).replace("\\\\", "\\"),
        tuple(t["content"] for t in state["added_tokens"]),
    )


class WordEncoder:
    """Ids of texts. Where white space parts the tokenizer's words, a task encodes each
    distinct word once, known by its hash, and gathers the rest by array arithmetic;
    else it encodes whole texts."""

    def __init__(self, path: str, kind: Kind | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.by_word, self.fold, marks, self.special = kind or kind_of(path)
        self.kinds = _KINDS if marks else None
        self._clear()

    def _clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # ascending
        self.place = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.starts = self.sizes = np.zeros(0, np.int64)

    def _ids(self, texts: list[str], folded: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts and how many each has."""
        if folded:  # a word of plain letters passes the steps before the model as it is
            found: list = [None] * len(texts)
            asked, model = [], self.model
            for i, text in enumerate(texts):
                if text.isascii() and text.isalpha():
                    found[i] = [t.id for t in model.tokenize(text)]
                else:
                    asked.append(i)
            rest = self.tokenizer.encode_batch_fast([texts[i] for i in asked], add_special_tokens=False)
            for i, f in zip(asked, rest):
                found[i] = f.ids
        else:
            found = [f.ids for f in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _numbers(self, piece: words.Words, folded: bool) -> np.ndarray:
        """The number of each word; new ones are encoded."""
        distinct, first, back = np.unique(piece.hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        numbers = np.empty(len(distinct), np.int64)
        numbers[known] = self.place[at[known]]
        numbers[new] = len(self.sizes) + np.arange(len(new))
        if len(new):
            spans = zip(piece.starts[first[new]].tolist(), piece.ends[first[new]].tolist())
            flat, sizes = self._ids([piece.data[s:e].decode() for s, e in spans], folded)
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.flat = np.concatenate([self.flat, flat])
            self.hashes = np.insert(self.hashes, at[new], distinct[new])
            self.place = np.insert(self.place, at[new], numbers[new])
        return numbers[back]

    def encode(self, texts: pa.Array, end: int) -> Iterator[tuple[int, list[np.ndarray]]]:
        """Some rows at a time: the first row, and each row's ids with the end id."""
        if not self.by_word:
            for start, stop in _groups(texts):
                flat, sizes = self._ids([t or "" for t in texts.slice(start, stop - start).to_pylist()])
                yield start, _cut(flat, sizes, end)
            return
        # A special token is one as it is written: nothing is cut or folded near it.
        plain = not any(
            pa.compute.any(pa.compute.match_substring(texts, t, ignore_case=True)).as_py() for t in self.special
        )
        kinds = self.kinds if plain else None
        for piece in words.pieces(texts, words.SPACES, plain and self.fold, kinds, PIECE_BYTES):
            if 8 * 4 * len(self.sizes) + 4 * len(self.flat) > REMEMBERED_BYTES:
                self._clear()
            numbers = self._numbers(piece, plain and self.fold and self.kinds is not None)
            each = self.sizes[numbers]
            sums = np.concatenate([[0], np.cumsum(each)])
            shift = self.starts[numbers] - sums[:-1]
            flat = self.flat[np.repeat(shift, each) + np.arange(int(sums[-1]))]
            yield piece.first, _cut(flat, np.diff(sums[piece.offsets]), end)


def _cut(flat: np.ndarray, sizes: np.ndarray, end: int) -> list[np.ndarray]:
    """The ids of each row, with the end id."""
    if not len(sizes):
        return []
    ends = np.cumsum(sizes)
    return np.split(np.insert(flat, ends, end), ends[:-1] + np.arange(1, len(ends)))


def _packed(ids: np.ndarray) -> bytes:
    """Ids in a cell between steps: their width, then compressed."""
    kind = "<u2" if not len(ids) or ids.max() < 1 << 16 else "<u4"
    codec = pa.Codec("zstd", compression_level=6)
    return kind[-1].encode() + codec.compress(ids.astype(kind).tobytes(), asbytes=True)


def _unpacked(cell: bytes, n: int) -> np.ndarray:
    kind = "<u" + cell[:1].decode()
    raw = pa.decompress(cell[1:], n * int(kind[-1]), "zstd", asbytes=True)
    return np.frombuffer(raw, kind).astype(np.uint32)


def _groups(texts: pa.Array, limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Slices of rows of about ``limit`` bytes."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    number = (np.cumsum(sizes) - sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(sizes)]
    yield from zip(cuts[:-1], cuts[1:])


def _runs(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
    """The first row of each run of rows that agree in id and text, and the rows of each
    run. A mix that takes a document twice has its copies side by side."""
    n = batch.num_rows
    first = np.ones(n, bool)
    for row in ("doc_id", "text") if n > 1 else ():
        column = batch[row]
        same = pa.compute.fill_null(pa.compute.equal(column.slice(1), column.slice(0, n - 1)), False)
        differs = ~same.to_numpy(zero_copy_only=False)
        first[1:] = differs if row == "doc_id" else first[1:] | differs
    starts = np.flatnonzero(first)
    return batch.filter(pa.array(first)), np.diff(np.append(starts, n))


def _tokenise(path: str, kind: Kind, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or WordEncoder(path, kind)
            batch, copies = _runs(batch)
            for start, ids in encoder.encode(batch["text"], end):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(start, len(ids)),
                        pa.array(copies[start : start + len(ids)], pa.int64()),
                        pa.array([len(i) for i in ids], pa.int64()),
                        pa.array([_packed(i) for i in ids], pa.binary()),
                    ],
                    ["doc_id", "copies", "n_tokens", "ids"],
                )

    return run


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(0, np.int64)
    for batch in batches:
        sizes, copies = batch["n_tokens"].to_pylist(), batch["copies"].to_numpy()
        for start in range(0, len(sizes), 500):
            times = copies[start : start + 500]
            for often in np.unique(times):
                rows = (start + np.flatnonzero(times == often)).tolist()
                cells = [_unpacked(batch["ids"][r].as_py(), sizes[r]) for r in rows]
                found = np.bincount(np.concatenate(cells)) * often
                if len(found) > len(counts):
                    counts = np.concatenate([counts, np.zeros(len(found) - len(counts), np.int64)])
                counts[: len(found)] += found
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["id", "n"])


def _blocks(table, block_ids: int):
    """Blocks of whole documents. Needs rows in order; one part per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Table(table.value)
        part = TaskContext.get().partitionId()
        start = number = 0
        names: list = []
        docs: list[np.ndarray] = []
        kind = None

        def block() -> pa.RecordBatch:
            sizes = [len(d) for d in docs]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([number], pa.int64()),
                    pa.array([start], pa.int64()),
                    pa.array([sum(sizes)], pa.int64()),
                    pa.array([names], pa.list_(kind)),
                    pa.array([sizes], pa.list_(pa.int64())),
                    pa.array([encode(np.concatenate(docs), known)], pa.binary()),
                ],
                ["part", "block", "start", "n_tokens", "doc_ids", "sizes", "payload"],
            )

        held = 0
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            cells = zip(
                batch["doc_id"].to_pylist(),
                batch["copies"].to_pylist(),
                batch["ids"],
                batch["n_tokens"].to_pylist(),
            )
            for name, copies, cell, n in cells:
                ids = _unpacked(cell.as_py(), n)
                for _ in range(copies):
                    names.append(name)
                    docs.append(ids)
                    held += n
                    if held >= block_ids:
                        yield block()
                        start, number, held = start + held, number + 1, 0
                        names, docs = [], []
        if docs:
            yield block()

    return run


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end: int = 2, block_ids: int = BLOCK_IDS
) -> str:
    """Encodes ``doc_id, text`` with the tokenizer file and writes the store."""
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    with scratch(spark):
        with small_batches(spark):
            tokens = materialize(
                docs.select("doc_id", "text").mapInArrow(
                    released(_tokenise(tokenizer, kind_of(tokenizer), end)),
                    f"doc_id {id_type}, copies long, n_tokens long, ids binary",
                )
            )
        counted = (
            tokens.select("ids", "n_tokens", "copies")
            .mapInArrow(released(_histogram), "id long, n long")
            .groupBy("id")
            .agg(F.sum("n").alias("n"))
        ).collect()  # a row per id of the vocabulary
        counts = np.zeros(max([r["id"] for r in counted], default=0) + 1, np.int64)
        for r in counted:
            counts[r["id"]] = r["n"]
        table = Table.from_counts(counts)
        spark.createDataFrame(
            [(table.crc, table.frequencies.astype("<u8").tobytes())], "crc long, frequencies binary"
        ).coalesce(1).write.parquet(f"{path}/frequencies")
        shared = spark.sparkContext.broadcast(table.frequencies)
        kind = (
            f"part int, block long, start long, n_tokens long, doc_ids array<{id_type}>,"
            " sizes array<long>, payload binary"
        )
        ordered = tokens.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
        ordered.mapInArrow(released(_blocks(shared, block_ids)), kind).write.option(
            "compression", "none"
        ).parquet(f"{path}/blocks")
        shared.destroy()
    blocks = spark.read.parquet(f"{path}/blocks").select("part", "n_tokens")
    sums = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums.select(  # a row per part
        "part", "n_tokens", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("offset")
    ).write.parquet(f"{path}/parts")
    return path


def _read(table, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Table(np.frombuffer(table.value, "<u8")))
        for batch in batches:
            for row in range(batch.num_rows):
                ids = decoder.decode(batch["payload"][row].as_py())
                sizes = np.array(batch["sizes"][row].as_py(), np.int64)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                cells = [ids[a:b].astype("<u4").tobytes() for a, b in zip(starts, ends)]
                columns = [
                    pa.array([batch["part"][row].as_py()] * len(sizes), pa.int32()),
                    batch["doc_ids"][row].values,
                    pa.array(starts + batch["start"][row].as_py()),
                    pa.array(sizes),
                    pa.array([zlib.crc32(c) for c in cells], pa.int64()),
                ]
                names = ["part", "doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(cells, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every stored document, and on demand
    its ``ids`` as little-endian unsigned 32-bit integers."""
    table = spark.read.parquet(f"{path}/frequencies").first()["frequencies"]
    blocks = spark.read.parquet(f"{path}/blocks")
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    kind = f"part int, doc_id {id_type}, start long, n_tokens long, ids_crc32 long"
    rows = blocks.mapInArrow(
        _read(spark.sparkContext.broadcast(table), with_ids), kind + ", ids binary" * with_ids
    )
    parts = spark.read.parquet(f"{path}/parts").select("part", "offset")
    return rows.join(F.broadcast(parts), "part").select(  # a row per part
        "doc_id",
        (F.col("start") + F.col("offset")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["ids"] if with_ids else []),
    )


def _read_span(table, first: int, stop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Table(np.frombuffer(table.value, "<u8")))
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch["payload"][row].as_py()
                at = batch["at"][row].as_py()
                lanes, n, steps, segments = decoder.open(block)
                per = steps * lanes
                for s in range(max(0, first - at) // per, segments):
                    low = at + s * per
                    if low >= stop:
                        break
                    ids = decoder.segment(block, s)
                    cut = ids[max(0, first - low) : max(0, stop - low)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([max(first, low)]), pa.array([cut.astype("<u4").tobytes()], pa.binary())],
                        ["start", "ids"],
                    )

    return run


def read_span(spark: SparkSession, path: str, first: int, stop: int) -> DataFrame:
    """``start, ids``: the ids ``first .. stop - 1`` of the whole sequence in pieces.
    Only the blocks in reach are read, and of them only the segments in reach are
    decoded."""
    table = spark.read.parquet(f"{path}/frequencies").first()["frequencies"]
    parts = spark.read.parquet(f"{path}/parts").select("part", "offset")
    blocks = (
        spark.read.parquet(f"{path}/blocks")
        .join(F.broadcast(parts), "part")
        .withColumn("at", F.col("start") + F.col("offset"))
        .filter((F.col("at") < stop) & (F.col("at") + F.col("n_tokens") > first))
    )
    return blocks.select("at", "payload").mapInArrow(
        _read_span(spark.sparkContext.broadcast(table), first, stop), "start long, ids binary"
    )
