"""Chat formatting by prefix-target expansion, with DataFrame functions alone.

Every assistant turn becomes an example of its own: the formatted text of all turns
up to it, of which only that reply is trainable. A template marks the turns; where a
text holds one of its control strings, that is escaped, so that every turn can be read
back from an example and no text can pass for a turn.

An example is stored as whole text. The texts of a conversation stand one after the
other in a file and are compressed with a window that holds several of them, so a
prefix that is repeated costs next to nothing on disk. A conversation with very many
replies is dealt to several tasks by the size of what it expands to. The turns of a
conversation are one array, and an example one cell; Spark holds up to 2 GB in either.

Defined cases: a null or empty text is an empty turn, and an empty reply an example
with an empty mask; a null role reads as the empty one; turns are ordered by number,
then role, then text, a null number first; a repeated turn counts each time; a null
conversation id is a conversation; turns after the last reply, or a conversation
without one, give a last example without any trainable text, so that no turn is lost;
an empty table has no examples.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ESCAPE = "\\"
# Characters of formatted text that a task makes of one conversation, about.
BLOCK_CHARS = 1 << 26


class Template(NamedTuple):
    """``opening role middle text closing``, and a line feed, for each turn."""

    opening: str = "### "
    middle: str = ": "
    closing: str = "</turn>"

    def check(self) -> None:
        for mark in self:
            if not mark or ESCAPE in mark:
                raise ValueError(f"no mark may be empty or hold {ESCAPE}: {mark!r}")
            if any(mark[:n] == mark[-n:] for n in range(1, len(mark))):
                raise ValueError(f"a mark must not begin as it ends: {mark!r}")

    @property
    def end(self) -> str:
        return self.closing + "\n"


def _escaped(text: Column, marks: tuple[str, ...]) -> Column:
    """The escape sign becomes sign and 0; sign and 1 go into each mark."""
    out = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "0"))
    for mark in marks:
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + ESCAPE + "1" + mark[1:]))
    return out


def _plain(text: Column) -> Column:
    out = F.replace(text, F.lit(ESCAPE + "1"), F.lit(""))
    return F.replace(out, F.lit(ESCAPE + "0"), F.lit(ESCAPE))


def chat_examples(
    turns: DataFrame,
    template: Template = Template(),
    reply: str = "assistant",
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``conv_id, example, last_turn, final, text, loss_start, loss_end``: the examples
    of each conversation, numbered from 0.

    ``text`` ends with turn number ``last_turn`` (from 0). Its characters (code points)
    ``loss_start .. loss_end - 1`` are the escaped reply. ``final`` marks the example
    that holds all turns.
    """
    template.check()
    marks = (template.opening, template.closing)
    said = F.struct(
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    whole = (
        turns.select(F.col(f"`{conv_id}`").alias("conv_id"), said.alias("t"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("t"))
    )
    body = F.transform("t", lambda t: _escaped(t["text"], marks))
    head = F.transform("t", lambda t: _escaped(t["role"], (*marks, template.middle)))
    formatted = F.zip_with(
        "head",
        "body",
        lambda h, b: F.concat(F.lit(template.opening), h, F.lit(template.middle), b, F.lit(template.end)),
    )
    ends = F.filter(
        F.sequence(F.lit(0), F.size("t") - 1),
        lambda p: (F.get("t", p)["role"] == reply) | (p == F.size("t") - 1),
    )
    chars = F.aggregate("t", F.lit(0).cast("bigint"), lambda s, t: s + F.length(t["text"]))
    blocks = F.floor(chars * F.size("ends") / F.lit(2 * BLOCK_CHARS))
    dealt = (
        whole.select("conv_id", "t", ends.alias("ends"))
        .select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks)).alias("block"), blocks.alias("blocks"))
        .repartition("conv_id", "block")
    )
    made = dealt.select("conv_id", "t", "ends", "block", "blocks", head.alias("head"), body.alias("body")).select(
        "conv_id",
        formatted.alias("formatted"),
        F.transform("body", lambda b: F.length(b)).alias("sizes"),
        F.transform("t", lambda t: t["role"] == reply).alias("replies"),
        F.filter(
            F.transform("ends", lambda p, i: F.struct(i.alias("example"), p.alias("last_turn"))),
            lambda e: F.pmod(e["example"].cast("bigint"), F.col("blocks") + 1) == F.col("block"),
        ).alias("own"),
    )
    prefix = F.array_join(F.slice("formatted", F.lit(1), F.col("e.last_turn") + 1), "")
    one = made.select(
        "conv_id", "sizes", "replies", "formatted", F.explode("own").alias("e")
    ).select(
        "conv_id",
        F.col("e.example").alias("example"),
        F.col("e.last_turn").alias("last_turn"),
        (F.col("e.last_turn") == F.size("formatted") - 1).alias("final"),
        F.get("sizes", F.col("e.last_turn")).alias("size"),
        F.get("replies", F.col("e.last_turn")).alias("reply"),
        prefix.alias("text"),
    )
    after = F.length("text") - len(template.end)
    return one.select(
        "conv_id",
        "example",
        "last_turn",
        "final",
        "text",
        F.when(F.col("reply"), after - F.col("size")).otherwise(F.length("text")).alias("loss_start"),
        F.when(F.col("reply"), after).otherwise(F.length("text")).alias("loss_end"),
    )


def write_examples(examples: DataFrame, path: str) -> str:
    examples.write.option("compression", "zstd").parquet(path)
    return path


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def turns_of(text: Column, template: Template = Template()) -> Column:
    """The turns (array of ``role, text``) that a formatted text holds, unescaped."""
    parts = F.split(text, "\\Q" + template.end + "\\E", -1)
    parts = F.slice(parts, 1, F.size(parts) - 1)  # nothing follows the last end
    bare = F.transform(parts, lambda p: F.substring(p, len(template.opening) + 1, 1 << 30))
    return F.transform(
        bare,
        lambda p: F.struct(
            _plain(F.substring_index(p, template.middle, 1)).alias("role"),
            _plain(
                F.substr(p, F.length(F.substring_index(p, template.middle, 1)) + len(template.middle) + 1)
            ).alias("text"),
        ),
    )


def read_back(examples: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, turns, loss, formatted_chars`` of each conversation, from its examples
    alone: all turns, the unescaped text under the masks in order, and the length of
    all examples. Only the masked parts and each longest text are moved."""
    size = F.col("loss_end") - F.col("loss_start")
    masked = _plain(F.substr("text", F.col("loss_start") + 1, size))
    parts = examples.select(
        "conv_id",
        F.struct("example", masked.alias("loss")).alias("part"),
        F.when(F.col("final"), F.col("text")).alias("whole"),
        F.length("text").cast("bigint").alias("chars"),
    )
    grouped = parts.groupBy("conv_id").agg(
        F.sort_array(F.collect_list("part")).alias("parts"),
        F.first("whole", ignorenulls=True).alias("whole"),
        F.sum("chars").alias("formatted_chars"),
    )
    return grouped.select(
        "conv_id",
        turns_of(F.col("whole"), template).alias("turns"),
        F.array_join(F.transform("parts", lambda p: p["loss"]), "").alias("loss"),
        "formatted_chars",
    )


def digests(conversations: DataFrame) -> DataFrame:
    """Sizes and checksums of what ``read_back`` found."""
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return conversations.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
