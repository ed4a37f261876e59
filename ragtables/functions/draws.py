"""Keyed randomness.

A draw is a function of a seed and the row's own key, never of a task, a
partition or a row position. A retried task, another partition count or another
engine therefore draws the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ragtables.functions.text import let

DRAW_BITS = 60


def keyed_hash(seed: int, *keys: Column) -> Column:
    """60 uniform bits: the first 15 hex digits of ``md5("seed:key:...")``."""
    text = F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys])
    digits = F.substring(F.md5(text), 1, DRAW_BITS // 4)
    return F.conv(digits, 16, 10).cast("bigint")


def keyed_uniform(seed: int, *keys: Column) -> Column:
    """A uniform number in [0, 1)."""
    return keyed_hash(seed, *keys) / F.lit(float(2**DRAW_BITS))


def distinct_draws(
    k: int, size: int, seed: int, key: Column, own_index: Column | None = None
) -> Column:
    """``k`` different numbers out of ``0 .. size-1``, in random order.

    Floyd's sampling: exactly ``k`` draws, no rejection loop. With ``own_index``
    that number is left out of the range.
    """
    room = size - 1 if own_index is not None else size
    if k < 1 or k > room:
        raise ValueError(f"cannot draw {k} distinct rows out of {room}")

    def pick(taken: Column, top: Column) -> Column:
        chosen = let(
            keyed_hash(seed, key, top) % (top + 1),
            lambda draw: F.when(F.array_contains(taken, draw), top).otherwise(draw),
        )
        return F.concat(taken, F.array(chosen))

    tops = F.sequence(
        F.lit(room - k).cast("bigint"), F.lit(room - 1).cast("bigint")
    )
    ids = F.aggregate(tops, F.array().cast("array<bigint>"), pick)
    if own_index is not None:
        ids = F.transform(ids, lambda i: F.when(i >= own_index, i + 1).otherwise(i))
    # Floyd's set is uniform but its order is not: order it by a second draw.
    ordered = F.sort_array(
        F.transform(
            ids,
            lambda i: F.struct(keyed_hash(seed + 1, key, i).alias("h"), i.alias("id")),
        )
    )
    return F.transform(ordered, lambda s: s["id"])
