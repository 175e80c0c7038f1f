"""Operator 13: shards of near equal bytes by a histogram sort. Built-in functions only.

Rows have a key (by default a hash of the text, so that equal texts are neighbours) and, below it, a hash
of the whole row. Shards are ranges of that order. Their borders are found by counting: a round lays
evenly spaced probes over every open range, counts exact bytes between them in all partitions at once,
and keeps for each border the one interval that holds its target; a border is settled when a probe
is within the tolerance, else the interval, shrunk to the keys that occur, is probed in the next round.
An interval of a single key (many copies of one text) is probed by the row hash instead, so a text
goes to more than one shard only if no border between texts is near enough. At most a few thousand counts a round reach the driver.

Then rows are exchanged once, by shard and by the high bits of the row hash, many cells a shard. A cell's first slot
is the number of rows in the cells before it; within it rows are numbered in the order of the row hash. So slots
don't follow the input's order, and no task has a whole shard.

A null text has no bytes. Null keys go first. Rows alike in every column can't be told apart and stay on one side of a border. With fewer rows
than shards some shards are empty. Empty tables give none. Further columns are part of the row hash (maps
aside) and are returned by `sharded`. Rows that don't fit the tolerance are put to the nearer side.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexstrata.llm.shared import partitions, stored

PROBES = 256
FIRST_PROBES = 4096
TOLERANCE = 0.002  # of a shard's bytes
CELL_ROWS = 1_000_000
HASH_BITS = 62
ROUNDS = 64  # a round divides every open range by PROBES or more, so none takes as many


@dataclass(frozen=True)
class Border:
    """Rows at or after (key, tie) lie behind it; a tie of -1 is before all rows of the key."""

    key: int
    tie: int


@dataclass(frozen=True)
class Range:
    """Rows with a key from low to high or, where key is set, with that key and a tie from low to high; `below` bytes lie before."""

    low: int
    high: int
    below: int
    key: int | None = None
    probes: int = PROBES

    @property
    def step(self) -> int:
        return (self.high - self.low) // self.probes + 1

    def holds(self) -> Column:
        inside = F.col("_tie" if self.key is not None else "_key").between(self.low, self.high)
        return inside if self.key is None else inside & (F.col("_key") == self.key)

    def interval(self) -> Column:
        return F.call_function("div", F.col("_tie" if self.key is not None else "_key") - F.lit(self.low).cast("long"), F.lit(self.step).cast("long"))


def hashed(*columns: Column | str) -> Column:
    """A hash from 0 to 2**62 - 1."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - HASH_BITS)


def keyed(docs: DataFrame, text: str = "text", key: Column | None = None) -> DataFrame:
    """docs with _size, _key (from -2**62 to 2**62) and _tie."""
    told = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, T.MapType)]
    size = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long") + 1
    place = F.coalesce(hashed(F.col(f"`{text}`")) if key is None else key.cast("long"), F.lit(-(2**62)).cast("long"))
    return docs.select("*", size.alias("_size"), place.alias("_key"), hashed(*told).alias("_tie"))


def histogram(rows: DataFrame, ranges: list[Range]) -> dict[int, list]:
    """For each range, its occupied intervals in order, with exact bytes and the least and greatest key and tie."""
    which = reduce(lambda c, k: c.when(ranges[k].holds(), F.lit(k)), range(len(ranges)), F.when(F.lit(False), F.lit(-1)))
    place = reduce(lambda c, k: c.when(F.col("_range") == k, ranges[k].interval()), range(len(ranges)), F.when(F.lit(False), F.lit(-1).cast("long")))
    met = rows.select("_size", "_key", "_tie", which.alias("_range")).where("_range IS NOT NULL")
    counts = met.groupBy("_range", place.alias("at")).agg(
        F.sum("_size").alias("bytes"), F.min("_key").alias("k0"), F.max("_key").alias("k1"), F.min("_tie").alias("t0"), F.max("_tie").alias("t1")
    )
    out = {k: [] for k in range(len(ranges))}
    for r in sorted(counts.collect(), key=lambda r: r["at"]):  # at most probes + 1 rows for each range
        out[r["_range"]].append(r)
    return out


def borders(rows: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[Border]:
    """The shards - 1 borders of rows (with _size, _key, _tie), in order."""
    whole = rows.agg(F.sum("_size").alias("bytes"), F.min("_key").alias("low"), F.max("_key").alias("high")).first()
    if not whole.bytes:
        return []
    near = tolerance * whole.bytes / shards
    first = Range(whole.low, whole.high, 0, probes=FIRST_PROBES)
    open_, settled = {k: first for k in range(1, shards)}, {}
    for _ in range(ROUNDS):
        if not open_:
            break
        ranges = sorted(set(open_.values()), key=lambda r: r.below)
        counted = histogram(rows, ranges)
        for k, held in list(open_.items()):
            settled_at, next_range = probed(counted[ranges.index(held)], held, k * whole.bytes / shards, near)
            if settled_at is None:
                open_[k] = next_range
            else:
                settled[k] = settled_at
                del open_[k]
    if open_:
        raise RuntimeError(f"borders {sorted(open_)} still open after {ROUNDS} rounds")
    return [settled[k] for k in range(1, shards)]


def probed(intervals: list, held: Range, target: float, near: float) -> tuple[Border | None, Range | None]:
    """The border at a probe near enough to the target, or else the range to probe next."""
    below = held.below
    for r in intervals:
        if below + r["bytes"] >= target:
            break
        below += r["bytes"]
    before, behind = target - below, below + r["bytes"] - target
    if held.key is None:
        sides = Border(r["k0"], -1), Border(r["k1"] + 1, -1)
        narrower = Range(r["k0"], r["k1"], below) if r["k0"] < r["k1"] else Range(r["t0"], r["t1"], below, key=r["k0"])
        single = r["k0"] == r["k1"] and r["t0"] == r["t1"]
    else:
        sides = Border(held.key, r["t0"]), Border(held.key, r["t1"] + 1)
        narrower, single = Range(r["t0"], r["t1"], below, key=held.key), r["t0"] == r["t1"]
    if single or min(before, behind) <= near:
        return sides[0 if before <= behind else 1], None
    return None, narrower


def shard_of(found: list[Border]) -> Column:
    """The number of borders at or before a row."""
    behind = [(F.col("_key") > b.key) | ((F.col("_key") == b.key) & (F.col("_tie") >= b.tie)) for b in found]
    return reduce(lambda n, c: n + c.cast("int"), behind, F.lit(0))


def dealt(rows: DataFrame, keys: DataFrame, found: list[Border], shards: int) -> DataFrame:
    """rows with shard and slot, by one exchange; keys has the same rows' _key and _tie, in as few columns as there are."""
    spark = rows.sparkSession
    n = keys.count()
    bits = 0
    while bits < HASH_BITS and ((1 << bits) * shards < 8 * partitions(spark) or (n >> bits) > CELL_ROWS * shards):
        bits += 1
    cell = F.shiftright("_tie", HASH_BITS - bits).cast("int")
    placed = lambda df: df.withColumn("shard", shard_of(found)).withColumn("_cell", cell)
    counts = placed(keys).groupBy("shard", "_cell").agg(F.count("*").alias("_n"))
    so_far = Window.partitionBy("shard").orderBy("_cell")  # a row for each cell
    before = counts.select("shard", "_cell", (F.sum("_n").over(so_far) - F.col("_n")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("shard", "_cell").orderBy("_tie", "_key"))
    numbered = placed(rows).withColumn("_place", within).join(before, ["shard", "_cell"])
    return numbered.withColumn("slot", F.col("_before") + F.col("_place") - 1).drop("_cell", "_place", "_before")


def sharded(docs: DataFrame, shards: int = 16, text: str = "text", key: Column | None = None, tolerance: float = TOLERANCE) -> DataFrame:
    """All columns of docs with shard and slot, from shards of near equal bytes. `key` is a column of whole numbers from -2**62 to 2**62."""
    rows = keyed(docs, text, key)
    keys = stored(rows.select("_size", "_key", "_tie"), "keys")
    out = dealt(rows, keys, borders(keys, shards, tolerance), shards)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], "shard", "slot")


def shard_digests(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document; texts don't travel."""
    rows = keyed(docs)
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    keys = stored(rows.select("doc_id", "_size", "_key", "_tie", crc.alias("text_crc32")), "keys")
    out = dealt(keys, keys, borders(keys, shards), shards)
    return out.select("doc_id", F.col("_size").alias("size"), "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
