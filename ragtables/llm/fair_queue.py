"""Mixing sources to target weights by weighted fair queueing.

Within each source documents are shuffled by a keyed hash, and a document's virtual
finish time is the running sum of its source's words divided by the source's target.
All documents, each once per allowed pass, are ordered by finish time, and the order
is cut where the running sum of words reaches the budget. A second pass over a source
repeats its order, so its finish times need no second sum.

Nothing is summed in one task: a source's words are summed by hash range and then
within each range; finish times are summed by fine time slots, and only the slot
that the budget ends in is sorted. What a source gets is thus the start of its
shuffled order, known by one cut (pass and hash) a source, and a document's copies
follow from its hash alone, without moving texts.

Only DataFrame functions are used.

Defined cases: null text has size 0; a null source is a source, last in order; a
document of size 0 is taken 0 words; rows with one id lie next to each other in the
order and are taken alike; rows without an id are ordered by their text; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ragtables.functions.draws import DRAW_BITS, keyed_hash
from ragtables.sources.storage import materialize, scratch

SEED = 11
RANGES = 4096
# Slots per unit of finish time, and the time from which all share one slot.
SLOTS, END = 65_536, 4
WEIGHTS = (3, 1, 2)
BUDGET = 1.5
PASSES = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def place(seed: int, doc_id: Column, text: Column) -> Column:
    """A document's place in the shuffled order."""
    return F.when(doc_id.isNull(), keyed_hash(seed, F.coalesce(text, F.lit("")))).otherwise(
        keyed_hash(seed, doc_id)
    )


def source_targets(
    sizes: DataFrame, weights: Sequence[float], budget: float, passes: int
) -> DataFrame:
    """``source, sid, source_size, target``: the budget (as a share of all sizes)
    dealt by weight, no target above ``passes`` times its source.

    Sources are ordered by the level at which they are full; those full at or below
    the level of the rest are capped. One row a source.
    """
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).select(
        "source", "source_size", (F.row_number().over(by_source) - 1).alias("sid")
    )
    listed = F.array(*[F.lit(float(w)) for w in weights])
    filled = Window.orderBy("level", "sid")
    rest = filled.rowsBetween(0, Window.unboundedFollowing)
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    return (
        ranked.withColumn("weight", F.get(listed, F.col("sid") % len(weights)))
        .withColumn("cap", F.col("source_size") * float(passes))
        .withColumn("level", F.col("cap") / F.col("weight"))
        .withColumn(
            "open_level",
            (F.sum("source_size").over(whole) * budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / F.sum("weight").over(rest),
        )
        .withColumn(
            "common",  # the open level of the first source that it does not fill
            F.min(
                F.when(F.col("level") > F.col("open_level"), F.struct("level", "sid", "open_level"))
            ).over(whole)["open_level"],
        )
        .withColumn(
            "target",
            F.when(F.col("common").isNull(), F.col("cap")).otherwise(
                F.least(F.col("cap"), F.col("weight") * F.col("common"))
            ),
        )
        .select("source", "sid", "source_size", "target")
    )


def _finish_times(sized: DataFrame, targets: DataFrame, passes: int) -> DataFrame:
    """``sid, pass, place, size, finish``, a row per document and pass."""
    rows = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).select(
        "sid", "source_size", "target", "size", "place",
        F.shiftright("place", DRAW_BITS - RANGES.bit_length() + 1).alias("range"),
    )
    starts = rows.groupBy("sid", "range").agg(F.sum("size").alias("words")).select(
        "sid",
        "range",
        F.coalesce(
            F.sum("words").over(
                Window.partitionBy("sid").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("start"),
    )
    # The default frame ends with the last row of an equal place.
    inside = F.sum("size").over(Window.partitionBy("sid", "range").orderBy("place"))
    sums = rows.withColumn("inside", inside).join(starts, ["sid", "range"])
    total = F.col("start") + F.col("inside") + F.col("pass") * F.col("source_size")
    return (
        sums.withColumn("pass", F.explode(F.array(*[F.lit(p).cast("long") for p in range(passes)])))
        .select(
            "sid", "pass", "place", "size",
            F.when(F.col("target") > 0, total / F.col("target")).otherwise(0.0).alias("finish"),
        )
        .withColumn("slot", F.least(F.floor(F.col("finish") * SLOTS), F.lit(SLOTS * END)).cast("long"))
    )


def source_cuts(sized: DataFrame, targets: DataFrame, budget: float, passes: int) -> DataFrame:
    """``targets`` with ``last_pass, last_place``: where each source's share ends."""
    times = materialize(_finish_times(sized, targets, passes))
    slots = times.groupBy("slot").agg(F.sum("size").alias("words"))  # SLOTS * END rows
    sums = slots.withColumn("upto", F.sum("words").over(Window.orderBy("slot")))
    most = sized.agg((F.coalesce(F.sum("size"), F.lit(0)) * budget).alias("most")).first()["most"]
    full = sums.filter(F.col("upto") > most).orderBy("slot").select("slot", (F.col("upto") - F.col("words")).alias("before")).first()
    taken = times
    if full is not None:
        last = times.filter(F.col("slot") == full["slot"])
        upto = F.sum("size").over(Window.partitionBy("slot").orderBy("finish", "sid", "pass"))
        last = last.withColumn("upto", upto).filter(F.col("upto") + full["before"] <= most)
        taken = times.filter(F.col("slot") < full["slot"]).unionByName(last.drop("upto"))
    cuts = taken.groupBy("sid").agg(F.max(F.struct("pass", "place")).alias("cut"))
    return targets.join(cuts, "sid", "left").select(
        "source", "source_size", "target",
        F.col("cut.pass").alias("last_pass"), F.col("cut.place").alias("last_place"),
    )


def _copies(place_: Column) -> Column:
    """How often a document at this place is taken: in every pass before the last,
    and in the last one if it is not beyond the cut."""
    last = F.col("last_pass") + (place_ <= F.col("last_place")).cast("long")
    return F.coalesce(last, F.lit(0)).cast("long")


def _plan(
    docs: DataFrame, weights: Sequence[float], budget: float, passes: int, seed: int
) -> tuple[DataFrame, DataFrame]:
    sized = materialize(
        docs.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            place(seed, F.col("doc_id"), F.col("text")).alias("place"),
        )
    )
    targets = materialize(source_targets(sized, weights, budget, passes))
    return sized, materialize(source_cuts(sized, targets, budget, passes))


def fair_mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    passes: int = PASSES,
    seed: int = SEED,
) -> DataFrame:
    """A row per document: ``doc_id, size, source_size, target, taken, copies``."""
    sized, cuts = _plan(docs, weights, budget, passes, seed)
    same = sized["source"].eqNullSafe(cuts["source"])
    return (
        sized.join(cuts, same)
        .withColumn("copies", _copies(F.col("place")))
        .select(
            "doc_id", "size", "source_size", "target",
            (F.col("size") * F.col("copies")).alias("taken"), "copies",
        )
    )


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    passes: int = PASSES,
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. Texts are not moved:
    each row meets its source's cut where it is read."""
    with scratch(docs.sparkSession):
        _, cuts = _plan(docs, weights, budget, passes, seed)
        cuts = cuts.select(F.col("source").alias("cut_source_"), "last_pass", "last_place")
        cuts = materialize(cuts, keep=True)
    names = [F.col(f"`{c}`") for c in docs.columns]
    base = docs.select(
        F.struct(*names).alias("row_"),
        F.col("source").alias("row_source_"),
        place(seed, F.col("doc_id"), F.col("text")).alias("place_"),
    )
    joined = base.join(cuts, F.col("row_source_").eqNullSafe(F.col("cut_source_")))
    times = F.array_repeat(F.lit(0), _copies(F.col("place_")).cast("int"))
    return joined.select("row_", F.explode(times).alias("copy_")).select("row_.*")
