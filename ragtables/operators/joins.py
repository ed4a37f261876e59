"""Join on a key that may be very unevenly used."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragtables.operators.columns import quoted

# A key used by more than 1/HOT_SHARE of the rows is hot, so there are fewer
# than HOT_SHARE hot keys whatever the table size: their list is safe to
# broadcast.
HOT_SHARE = 1000
# Below this many rows a key is never hot: one task copes with them.
HOT_ROWS = 100_000


def lookup_join(
    uses: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``uses`` to the row of ``lookup`` with the same key.

    ``key`` is unique in ``lookup``, but one key may hold a third of ``uses``.
    Rows of a hot key are dealt out over several salts, and only that key's
    lookup row is copied to each salt; all other rows join as they are. The
    counting pass reads nothing but the key and combines before its shuffle.
    Salts hash the whole row, so the rows of ``uses`` should differ.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    column = quoted(key)
    total = uses.count()
    floor = max(hot_rows, total // HOT_SHARE)
    if total <= floor:
        return uses.join(lookup, key, how)
    per_key = uses.filter(column.isNotNull()).groupBy(column).count()
    salts = F.ceil(F.col("count") / floor).cast("int").alias("_salts")
    hot = F.broadcast(per_key.filter(F.col("count") > floor).select(column, salts))
    # Null keys match nothing but must not all land in one task either.
    wanted = F.when(column.isNull(), HOT_SHARE).otherwise(
        F.coalesce(F.col("_salts"), F.lit(1))
    )
    whole_row = F.xxhash64(*[quoted(c) for c in uses.columns])
    spread = uses.join(hot, key, "left").withColumn(
        "_salt", F.pmod(whole_row, wanted).cast("int")
    )
    copied = lookup.join(hot, key, "left").withColumn(
        "_salt",
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)),
    )
    joined = spread.drop("_salts").join(copied.drop("_salts"), [key, "_salt"], how)
    return joined.drop("_salt")


def copies_for(rows: int, wanted: int = 4096) -> int:
    """How often to copy a small lookup table so that it has ``wanted`` rows."""
    return max(1, math.ceil(wanted / rows)) if rows < wanted else 1
