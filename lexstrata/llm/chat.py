"""Operator 10: chat formatting, with cumulative snapshots of one conversation collapsed.

Loggers write a conversation again after each turn. A conversation all of whose turns begin a
longer one is dropped, and of equal conversations the one with the smallest conv_id stays.

1. Every turn is hashed before anything is shuffled; the hashes of a conversation, in order,
   give the rolling hash of each prefix (hash of the hash before and the turn's).
2. An anti-join drops the conversations whose last hash is a proper prefix of another. Equal
   conversations and equal prefixes are grouped before it, so a first turn or a conversation that a third
   of the log shares makes no hot key.
3. Only what is left is rendered from its texts.

Turns are ordered by (turn, role, text), nulls first; exactly repeated turn rows count once.
Null role and null text differ from empty ones in the comparison and render as empty. Rows
with a null conv_id form one conversation, which counts as having the greatest id. Empty tables
give no rows; further columns are ignored. Rendering needs a conversation's turns together: memory is
bounded by the longest conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexstrata.llm.shared import only, stored

OPEN, MIDDLE, CLOSE = "<|", "|>\n", "\n<|end|>\n"
SLOT = ("conv_id", "turn", "role")


def part(x: Column) -> Column:
    """A text with its length, so that neighbours can't run together; null differs from empty."""
    return F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-"))


def rendered(turns: Column) -> Column:
    """The text of an ordered array of turns."""
    empty = F.lit("")
    shown = F.transform(turns, lambda t: F.concat(F.lit(OPEN), F.coalesce(t["role"], empty), F.lit(MIDDLE), F.coalesce(t["text"], empty), F.lit(CLOSE)))
    return F.array_join(shown, "")


def same(a: DataFrame, b: DataFrame, columns: tuple[str, ...]) -> Column:
    out = F.lit(True)
    for c in columns:
        out &= a[c].eqNullSafe(b[c])
    return out


def hashed_turns(turns: DataFrame) -> DataFrame:
    """conv_id, hashes: those of a conversation's turns in order. Texts are shuffled only where two share turn and role."""
    own = turns.withColumn("hash", F.md5(F.concat(part(F.col("role")), part(F.col("text"))).cast("binary")))
    slots = own.groupBy(*SLOT).agg(F.collect_set("hash").alias("hashes"))
    tied = slots.where("size(hashes) > 1").select(*SLOT)
    several = own.join(tied, same(own, tied, SLOT), "left_semi").groupBy(*SLOT).agg(F.collect_set(F.struct("text", "hash")).alias("texts"))
    several = several.select(*SLOT, F.sort_array("texts")["hash"].alias("hashes"))
    slots = slots.where("size(hashes) = 1").unionByName(several)
    ordered = slots.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "hashes"))).alias("slots"))
    return ordered.select("conv_id", F.flatten(F.col("slots")["hashes"]).alias("hashes"))


def rolling(hashes: Column) -> Column:
    """The rolling hash of every prefix, shortest first."""
    start = F.array().cast("array<string>")
    return F.aggregate(hashes, start, lambda done, h: F.concat(done, F.array(F.md5(F.concat(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit("")), h).cast("binary")))))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, rendered of the conversations that no longer one begins with."""
    turns = only(turns, "conv_id", "turn", "role", "text")
    logged = stored(hashed_turns(turns).select("conv_id", rolling(F.col("hashes")).alias("prefixes")), "conversations")
    wholes = logged.groupBy(F.element_at("prefixes", -1).alias("whole")).agg(F.min_by(F.struct("conv_id"), F.struct(F.col("conv_id").isNull(), "conv_id")).alias("first"))
    longer = logged.select(F.explode(F.slice("prefixes", 1, F.size("prefixes") - 1)).alias("whole")).distinct()
    kept = wholes.join(longer, "whole", "left_anti").select("first.conv_id")
    left = turns.join(kept, turns.conv_id.eqNullSafe(kept.conv_id), "left_semi")
    ordered = left.groupBy("conv_id").agg(F.sort_array(F.collect_set(F.struct("turn", "role", "text"))).alias("turns"))
    return ordered.select("conv_id", F.size("turns").alias("n_turns"), rendered(F.col("turns")).alias("rendered"))
