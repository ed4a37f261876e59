"""Row index, seeded shuffle, split, example sampling, distractor mixing, merge.

Spark rows have no position. Every operator takes the name of a unique key
column, and "random" always means a keyed hash of it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ragtables.functions.draws import (
    DRAW_BITS,
    distinct_draws,
    keyed_hash,
    keyed_uniform,
)
from ragtables.operators.columns import quoted, require, tag
from ragtables.operators.joins import copies_for
from ragtables.sources.storage import materialize

# Rows are numbered bucket by bucket. 65,536 buckets cut 100 TB into pieces of
# about 1.5 GB, and the table of bucket sizes never has more rows than that.
INDEX_BITS = 16
KEY_BITS = 14
# Keys that the splitters are chosen from: so many a range that none is far larger.
SAMPLED_KEYS = 1 << 18
_SAMPLE_SEED = 6_151


def _hash_bucket(key: str, seed: int) -> tuple[Column, Column]:
    h = keyed_hash(seed, quoted(key))
    return h, F.shiftright(h, DRAW_BITS - INDEX_BITS).cast("int")


def _splitters(df: DataFrame, key: str) -> Column:
    """A constant, ascending array of about ``2**KEY_BITS`` keys that part the table
    into even ranges: every so many-th of a keyed sample.

    The sample has about ``SAMPLED_KEYS`` keys of a table of any size and is ranked in
    one task; the driver gets the splitters alone. They are sent as text, since thousands of
    literals would slow every step of the optimizer. Where a type does not come back
    from text as it was, they part the table a little elsewhere, which is as good.
    """
    keys = df.select(quoted(key).alias("k")).filter("k IS NOT NULL")
    rows = keys.count()
    if rows > SAMPLED_KEYS:
        keys = keys.filter(keyed_uniform(_SAMPLE_SEED, F.col("k")) < SAMPLED_KEYS / rows)
    ranked = keys.withColumn("n", F.row_number().over(Window.orderBy("k")))
    step = -(-min(rows, SAMPLED_KEYS) // (1 << KEY_BITS)) or 1
    chosen = ranked.filter(F.col("n") % step == 0).select(F.col("k").cast("string"))
    found = [r[0] for r in chosen.collect()]
    kind = T.ArrayType(df.schema[key].dataType)
    if not found:
        return F.array().cast(kind)
    used = set("".join(found))
    between = next(chr(c) for c in range(0xE000, 0x110000) if chr(c) not in used)
    # Functions that the optimizer computes once, so that the rows meet a constant.
    return F.sort_array(F.split(F.lit(between.join(found)), between).cast(kind))


def _key_bucket(df: DataFrame, key: str) -> Column:
    """Number of the range a key lies in, by binary search."""
    bounds = _splitters(df, key)
    # One step more than KEY_BITS, for a sample that came out larger than meant.
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(KEY_BITS + 1))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda low, step: F.when(
            F.get(bounds, low + step - 1) <= quoted(key), low + step
        ).otherwise(low),
    )


def _one_row(key: Column, repeated: Column, value: Column) -> Column:
    """``value``, or an error that names a key that is null or not the only one."""
    null = F.raise_error(F.lit("a row has no key")).cast("bigint")
    again = F.concat(F.lit("more than one row has the key "), key.cast("string"))
    return (
        F.when(key.isNull(), null)
        .when(repeated, F.raise_error(again).cast("bigint"))
        .otherwise(value)
    )


def unique_keys(df: DataFrame, key: str, output: str = "_key") -> DataFrame:
    """The keys alone; a key that is null or repeated is an error in the plan."""
    counted = df.groupBy(quoted(key).alias("_each")).agg(F.count(F.lit(1)).alias("_rows"))
    fine = _one_row(F.col("_each"), F.col("_rows") > 1, F.lit(1).cast("bigint"))
    # The check is part of what is kept, so that it cannot be left out.
    return counted.filter(fine == 1).select(F.col("_each").alias(output))


def row_index(
    df: DataFrame, key: str, seed: int = 0, order: str = "hash", output: str = "idx"
) -> DataFrame:
    """Number the rows 0, 1, 2, ... without gaps; ``key`` must be unique. A null or
    repeated key is an error when the rows are read.

    ``order="hash"`` numbers them in seeded random order, ``order="key"`` by key.
    Rows fall into many small, even buckets by hash or by range; a first pass
    counts the buckets, and the second numbers each bucket from its offset. No
    task sees all rows, and nothing depends on how rows are spread over
    partitions. Only the columns of ``df`` are moved: give it the key alone where
    that is enough.
    """
    require(df, [key])
    if order == "hash":
        rank, bucket = _hash_bucket(key, seed)
    elif order == "key":
        rank = quoted(key)
        bucket = _key_bucket(df, key)
    else:
        raise ValueError('order must be "hash" or "key"')
    bucket = F.coalesce(bucket, F.lit(0))
    sizes = df.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_size"))
    # At most 2**INDEX_BITS rows of two numbers (or one a range), for any input.
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # Matched by a cast number: of two plain columns that are equal the optimizer infers
    # that the one here is the bucket of a key, which this side does not have, and with
    # some numbers of columns it puts that filter here, where it ends the query.
    offsets = sizes.select(
        F.col("_bucket").cast("bigint").alias("_range"),
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
    )
    inside = Window.partitionBy("_bucket").orderBy("_rank", quoted(key))
    return (
        df.withColumns({"_bucket": bucket, "_rank": rank})
        .join(F.broadcast(offsets), F.col("_bucket").cast("bigint") == F.col("_range"))
        .withColumn(
            output,
            _one_row(
                quoted(key),
                F.coalesce(F.lag(quoted(key)).over(inside) == quoted(key), F.lit(False)),
                F.col("_offset") + F.row_number().over(inside).cast("bigint") - 1,
            ),
        )
        .drop("_bucket", "_range", "_rank", "_offset")
    )


def first_by_hash(df: DataFrame, key: str, seed: int, wanted: int) -> Column:
    """A condition that holds for the ``wanted`` rows that come first in the seeded
    order, and for no others.

    It compares with the last of those rows, which is found from the bucket sizes
    and one bucket's keys. So any number of rows is chosen by a plain filter,
    without moving or sorting the table.
    """
    h, bucket = _hash_bucket(key, seed)
    keys = df.select(h.alias("h"), bucket.alias("bucket"), quoted(key).alias("key"))
    # At most 2**INDEX_BITS rows.
    sizes = keys.groupBy("bucket").count().collect()
    left = wanted
    for number, size in sorted((r["bucket"], r["count"]) for r in sizes):
        if left <= size:
            break
        left -= size
    else:
        return F.lit(wanted > 0)
    if left < 1:
        return F.lit(False)
    inside = keys.filter(F.col("bucket") == number).orderBy("h", "key").limit(left)
    last = inside.agg(F.max(F.struct("h", "key")).alias("last")).first()["last"]
    if last["key"] is None:
        raise ValueError("a row has no key")
    return (h < last["h"]) | ((h == last["h"]) & (quoted(key) <= F.lit(last["key"])))


def first_by_key(df: DataFrame, key: str, wanted: int) -> Column:
    """A condition that holds for the ``wanted`` rows with the lowest keys."""
    if wanted < 1:
        return F.lit(False)
    numbered = row_index(df.select(quoted(key)), key, order="key")
    last = numbered.filter(F.col("idx") == wanted - 1).first()
    return F.lit(True) if last is None else quoted(key) <= F.lit(last[key])


def shuffle_select(
    df: DataFrame, key: str, seed: int | None = None, limit: int | None = None
) -> DataFrame:
    """Optional seeded shuffle, then at most ``limit`` rows.

    Without a seed the rows come in key order. ``None`` switches a part off. A limit
    of any size finds the last key that counts and then is a plain filter; ``key``
    must be unique for it.
    """
    require(df, [key])
    column = quoted(key)
    order = [column] if seed is None else [keyed_hash(seed, column), column]
    if limit is None:
        return df if seed is None else df.orderBy(*order)
    if seed is None:
        return df.filter(first_by_key(df, key, limit)).orderBy(*order)
    return df.filter(first_by_hash(df, key, seed, limit)).orderBy(*order)


def split_column(
    df: DataFrame,
    key: str,
    dev_share: float,
    seed: int = 0,
    exact: bool = True,
    output: str = "split",
) -> DataFrame:
    """Add ``train`` or ``dev``; no row is moved for it.

    ``exact`` gives the dev part ``ceil(rows * dev_share)`` rows, after two passes
    over the keys; otherwise each row is drawn on its own, without any.
    """
    if not 0 < dev_share < 1:
        raise ValueError("dev_share must lie between 0 and 1")
    require(df, [key])
    if exact:
        # A product like 0.07 * 100 must not be rounded up by its last bit.
        wanted = math.ceil(round(df.select(quoted(key)).count() * dev_share, 9))
        is_dev = first_by_hash(df, key, seed, wanted)
    else:
        is_dev = keyed_uniform(seed, quoted(key)) < dev_share
    return df.withColumn(output, F.when(is_dev, "dev").otherwise("train"))


def train_dev_split(
    df: DataFrame, key: str, dev_share: float, seed: int = 0, exact: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The train and the dev table."""
    both = split_column(df, key, dev_share, seed, exact, "_split")
    return tuple(
        both.filter(F.col("_split") == part).drop("_split") for part in ("train", "dev")
    )


def sample_rows(
    df: DataFrame,
    k: int,
    key: str,
    seed: int = 0,
    output_key: str = "fewshot",
    input_key: str | None = None,
    columns: Sequence[str] | None = None,
    source: DataFrame | None = None,
    source_key: str | None = None,
    unwrap: bool = True,
    flatten: bool = False,
) -> DataFrame:
    """Give every row ``k`` different random rows of the same or another table.

    Without ``source`` the rows come from ``df`` and never include the row
    itself. A sample is the value of ``input_key``, or a struct of ``columns``
    (all columns if not given). The result is an array, or with ``k=1`` and
    ``unwrap`` the single sample. ``flatten`` joins array samples into one array.
    """
    own = source is None
    source = df if own else source
    source_key = key if own else source_key or key
    require(df, [key])
    require(source, [source_key])
    if input_key is not None:
        require(source, [input_key])
        sample = quoted(input_key)
    else:
        kept = list(columns) if columns is not None else source.columns
        require(source, kept)
        sample = F.struct(*[quoted(c) for c in kept])
    # The keys are read and numbered once; counts and lookups use the stored table.
    index = materialize(
        row_index(
            materialize(source.select(quoted(source_key).alias("_id_key"))), "_id_key", seed
        )
    )
    rows = index.count()
    copies = copies_for(rows)

    # Ids are uniform, so none is hot - unless there are only a few of them:
    # a small table is copied to several salts.
    def bank(frame: DataFrame) -> DataFrame:
        salts = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        return frame.withColumn("_salt", salts) if copies > 1 else frame

    def salted(frame: DataFrame) -> DataFrame:
        salt = F.pmod(F.xxhash64("_key"), F.lit(copies)).cast("int")
        return frame.withColumn("_salt", salt) if copies > 1 else frame

    salt_key = ["_salt"] if copies > 1 else []

    # Numbering, drawing and the first lookup touch keys only; the samples are
    # moved once to their drawers, and each row once to its samples.
    if own:
        keys = index.select(F.col("_id_key").alias("_key"), F.col("idx").alias("_own"))
    else:
        keys = unique_keys(df, key)
    draws = distinct_draws(k, rows, seed, F.col("_key"), F.col("_own") if own else None)
    wanted = keys.select("_key", F.posexplode(draws).alias("_pos", "_id"))
    index = index.withColumnRenamed("idx", "_id")
    samples = source.select(quoted(source_key).alias("_id_key"), sample.alias("_sample"))
    picked = (
        salted(wanted)
        .join(bank(index), ["_id", *salt_key])
        .join(bank(samples), ["_id_key", *salt_key])
    )
    if k == 1 and unwrap:
        found = picked.select("_key", F.col("_sample").alias("_result"))
    else:
        entries = F.map_from_entries(F.collect_list(F.struct("_pos", "_sample")))
        found = picked.groupBy("_key").agg(entries.alias("_entries"))
        listed = F.transform(
            F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.col("_entries")[i]
        )
        found = found.select(
            "_key", (F.flatten(listed) if flatten else listed).alias("_result")
        )
    joined = df.join(found, quoted(key) == F.col("_key")).drop("_key")
    return joined.withColumn(output_key, F.col("_result")).drop("_result")


def few_shot(
    df: DataFrame,
    k: int,
    key: str,
    seed: int = 0,
    output_key: str = "fewshot",
    columns: Sequence[str] | None = None,
    source: DataFrame | None = None,
    source_key: str | None = None,
) -> DataFrame:
    """``k`` example rows as an array of structs, also for ``k=1``.

    Name the ``columns`` a template needs: the examples then carry only those.
    """
    return sample_rows(
        df,
        k,
        key,
        seed,
        output_key,
        columns=columns,
        source=source,
        source_key=source_key,
        unwrap=False,
    )


def mix_distractors(
    df: DataFrame,
    key: str,
    seed: int = 0,
    k: int = 5,
    raft_p: float = 0.5,
    neg_docs_num: int = 5,
    positive_key: str = "positive_passages",
    negative_key: str = "negative_passages",
    output_key: str = "docs",
) -> DataFrame:
    """Documents for training: distractors, with the positive passages in front
    for the rows whose draw exceeds ``raft_p``."""
    require(df, [key, positive_key])
    positive = F.slice(quoted(positive_key), 1, k)
    if negative_key in df.columns:
        empty = F.array().cast(df.schema[negative_key].dataType)
        negative = F.slice(F.coalesce(quoted(negative_key), empty), 1, neg_docs_num)
    else:
        negative = F.array().cast(df.schema[positive_key].dataType)
    keep_positive = keyed_uniform(seed, quoted(key)) > raft_p
    return df.withColumn(
        output_key,
        F.when(keep_positive, F.concat(positive, negative)).otherwise(negative),
    )


def merge_tables(
    frames: Sequence[DataFrame] | Mapping[str, DataFrame],
    seed: int | None = None,
    key: str | None = None,
    keyword: str | None = None,
) -> DataFrame:
    """Put tables below each other, keeping duplicates; missing columns are null.

    A mapping with ``keyword`` also tags each row with its table's name. With a
    seed the rows are shuffled by a hash of ``key`` (and of the tag, if any).
    """
    if isinstance(frames, Mapping):
        tagged = [tag(f, n, keyword) if keyword else f for n, f in frames.items()]
    else:
        tagged = list(frames)
    merged = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged
    )
    if seed is None:
        return merged
    if key is None:
        raise ValueError("a shuffle needs a key")
    keys = [quoted(key)] + ([quoted(keyword)] if keyword else [])
    return merged.orderBy(keyed_hash(seed, *keys), *keys)
