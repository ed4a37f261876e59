"""Benchmark decontamination by winnowing.

Of every window of 13 words, the least hash of its 7-word grams is kept; any span of
13 shared words therefore shares a kept hash. The distinct kept hashes of documents
meet those of the benchmark; only documents with a common one are read again, and
only their windows whose kept hash was met are compared, whole, with the benchmark's
windows (by 128 bits of hash over their words). Windows that match extend into spans.

Items with fewer than 13 words are one window each. Winnowing cannot promise to keep
a hash of theirs, so for each such length that occurs, all spans of that length are
compared.

Only DataFrame functions are used. A side is broadcast only after its rows are
counted; beyond the bound the same joins shuffle.

Defined cases: null and empty texts have no words and hit nothing; items without
words match nothing; repeated documents give a row each; repeated items count each
by its id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragtables.functions.text import let
from ragtables.llm.base import free_name, lower_ascii, sent
from ragtables.sources.storage import materialize, scratch

WINDOW = 13
GRAM = 7
# A document is contaminated if at least one word in this many is hit.
ONE_IN = 20
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_NONE = "array<bigint>"


def word_array(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.array_remove(F.split(lower_ascii(text), SEPARATORS), "")


def _each(first: Column, count: Column, body) -> Column:
    """``body`` of ``first ..``, ``count`` numbers; an empty array for none."""
    numbers = F.sequence(first, first + count - 1)
    return F.when(count > 0, F.transform(numbers, body)).otherwise(F.array().cast(_NONE))


def _kept(hashes: Column) -> Column:
    """For each window of 13 words its least gram hash."""
    grams = _each(F.lit(1), F.size(hashes) - GRAM + 1, lambda i: F.xxhash64(F.slice(hashes, i, GRAM)))
    per = WINDOW - GRAM + 1
    return let(
        grams,
        lambda g: _each(F.lit(1), F.size(g) - per + 1, lambda i: F.array_min(F.slice(g, i, per))),
    )


def _word_hashes(text: str = "text") -> Column:
    return F.transform(word_array(F.col(text)), lambda w: F.xxhash64(w))


def _span(hashes: Column, start: Column, size: int) -> Column:
    """128 bits for the words ``start ..`` (from 1), and their number."""
    own = F.slice(hashes, start, size)
    return F.struct(
        F.xxhash64(own).alias("h1"),
        F.xxhash64(F.lit(size), F.reverse(own)).alias("h2"),
        F.lit(size).alias("size"),
        (start - 1).cast("long").alias("start"),
    )


def _spans(hashes: Column, starts: Column, size: int) -> Column:
    return F.transform(starts, lambda i: _span(hashes, i, size))


def _all_starts(hashes: Column, size: int) -> Column:
    count = F.size(hashes) - size + 1
    return F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))


def _benchmark(items: DataFrame) -> tuple[DataFrame, DataFrame, list[int]]:
    """Kept hashes; windows ``h1, h2, size, item_id``; lengths of short items."""
    rows = materialize(
        items.select(F.col("item_id"), _word_hashes().alias("hashes")).filter(F.size("hashes") > 0)
    )
    long_ = rows.filter(F.size("hashes") >= WINDOW)
    short = rows.filter(F.size("hashes") < WINDOW)
    lengths = sorted(
        r["n"] for r in short.select(F.size("hashes").alias("n")).distinct().collect()
    )  # twelve at most
    kept = long_.select(F.explode(F.array_distinct(_kept(F.col("hashes")))).alias("kept")).distinct()
    hashes = F.col("hashes")
    windows = long_.select("item_id", F.explode(_spans(hashes, _all_starts(hashes, WINDOW), WINDOW)).alias("s"))
    for n in lengths:
        own = short.filter(F.size("hashes") == n)
        windows = windows.unionByName(own.select("item_id", _span(hashes, F.lit(1), n).alias("s")))
    windows = windows.select("item_id", "s.h1", "s.h2", "s.size").distinct()
    return materialize(kept), materialize(windows), lengths


def _covered(spans: Column) -> Column:
    """Number of words in the union of sorted spans ``start, size``."""
    zero = F.lit(0).cast("long")
    done = F.aggregate(
        spans,
        F.struct(zero.alias("n"), zero.alias("reach")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(s["start"] + s["size"] - F.greatest(s["start"], acc["reach"]), zero)).alias("n"),
            F.greatest(acc["reach"], s["start"] + s["size"]).alias("reach"),
        ),
    )
    return done["n"]


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """For every row of ``docs`` (``doc_id, text``) against ``items`` (``item_id,
    text``): ``doc_id, text_hash, n_words, n_hit, n_items, items, spans,
    contaminated``. ``spans`` are the matched windows (``start, size``, from word 0).
    """
    kept, windows, lengths = _benchmark(items.select("item_id", "text"))
    key = [F.col("doc_id"), F.xxhash64("text").alias("text_hash")]
    described = materialize(
        docs.select(*key, _word_hashes().alias("hashes")).select(
            "doc_id",
            "text_hash",
            F.size("hashes").cast("long").alias("n_words"),
            F.array_distinct(_kept(F.col("hashes"))).alias("kept"),
        )
    )
    met = materialize(
        described.select("doc_id", "text_hash", F.explode("kept").alias("kept"))
        .join(sent(kept), "kept", "left_semi")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("kept").alias("met"))
    )
    hashes = F.col("hashes")
    met_side = met.select(F.col("doc_id").alias("met_id"), F.col("text_hash").alias("met_hash"), "met")
    again = (
        docs.select(*key, "text")
        .join(
            sent(met_side),
            F.col("doc_id").eqNullSafe(F.col("met_id")) & (F.col("text_hash") == F.col("met_hash")),
        )
        .select("doc_id", "text_hash", "met", _word_hashes().alias("hashes"))
        .withColumn("kept", _kept(hashes))
    )
    starts = F.filter(
        _all_starts(hashes, WINDOW), lambda i: F.array_contains(F.col("met"), F.get(F.col("kept"), i - 1))
    )
    found = again.select("doc_id", "text_hash", F.explode(_spans(hashes, starts, WINDOW)).alias("s"))
    if lengths:
        every = docs.select(*key, _word_hashes().alias("hashes"))
        for n in lengths:
            found = found.unionByName(
                every.select("doc_id", "text_hash", F.explode(_spans(hashes, _all_starts(hashes, n), n)).alias("s"))
            )
    found = found.select("doc_id", "text_hash", "s.*")
    same = ["h1", "h2", "size"]
    hits = materialize(
        found.join(sent(windows.select(*same).distinct()), same, "left_semi").distinct()
    )
    spans = hits.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("start", "size"))).alias("spans")
    )
    items_of = (
        hits.select("doc_id", "text_hash", *same)
        .distinct()
        .join(sent(windows), same)
        .select("doc_id", "text_hash", F.col("item_id").cast("string").alias("item"))
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    per_doc = spans.join(
        items_of.withColumnRenamed("doc_id", "other_id").withColumnRenamed("text_hash", "other_hash"),
        F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("text_hash") == F.col("other_hash")),
    ).select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "spans", "items")
    n_hit = F.coalesce(_covered(F.col("spans")), F.lit(0).cast("long"))
    return (
        described.drop("kept")
        .join(
            per_doc,
            F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")),
            "left",
        )
        .withColumn("n_hit", n_hit)
        .select(
            "doc_id",
            "text_hash",
            "n_words",
            "n_hit",
            F.coalesce(F.array_size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            "spans",
            ((F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        )
    )


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns kept."""
    bad_id, bad_hash = free_name(docs, "bad_id_"), free_name(docs, "bad_hash_")
    with scratch(docs.sparkSession):
        bad = materialize(
            contamination(docs, items)
            .filter("contaminated")
            .select(F.col("doc_id").alias(bad_id), F.col("text_hash").alias(bad_hash))
            .distinct(),
            keep=True,
        )
    kept = docs.join(
        sent(bad),
        docs["doc_id"].eqNullSafe(F.col(bad_id)) & (F.xxhash64(docs["text"]) == F.col(bad_hash)),
        "left_anti",
    )
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
