"""Hierarchies: closure, plans, paths, identity and the repairs of item tables.

An item table has item_id, parent_item_id, item_type, item_number. Ancestor closures are found by
doubling path length, so a depth of d takes log2(d) joins; cycles end because pairs are distinct.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexstrata.functions.numbers import number_tuple
from lexstrata.functions.text import type_rank
from lexstrata.session import cut, numbered


def closure(items: DataFrame) -> DataFrame:
    """item_id, ancestor_id, distance (1: the parent); the shortest where several ways lead up."""
    out = items.where("parent_item_id IS NOT NULL").select("item_id", F.col("parent_item_id").alias("ancestor_id"), F.lit(1).alias("distance")).distinct()
    reach = 1
    while True:
        if reach >= 4:  # each round reads the last one twice
            out = cut(out)
            if out.where(F.col("distance") > reach // 2).isEmpty():  # then none is further either
                break
        up = out.select(F.col("item_id").alias("ancestor_id"), F.col("ancestor_id").alias("higher"), F.col("distance").alias("more"))
        far = out.join(up, "ancestor_id").select("item_id", F.col("higher").alias("ancestor_id"), (F.col("distance") + F.col("more")).alias("distance"))
        out = out.unionByName(far).groupBy("item_id", "ancestor_id").agg(F.min("distance").alias("distance"))
        reach *= 2
    return out.where("item_id <> ancestor_id")


def descendants(items: DataFrame, roots: DataFrame) -> DataFrame:
    """item_id, ancestor_id, distance of the items below `roots` (ancestor_id): the rows of `closure` with these ancestors, without those of all others.

    A round goes one level down, so shallow trees are walked cheaply; each level is written once.
    """
    kids = items.where("parent_item_id IS NOT NULL").select("item_id", F.col("parent_item_id").alias("up")).distinct()
    at = roots.select("ancestor_id", F.col("ancestor_id").alias("up")).distinct()
    levels: list[DataFrame] = []
    while True:
        found = at.join(kids, "up").where("item_id <> ancestor_id").select("item_id", "ancestor_id").distinct()
        for level in levels:  # a cycle ends
            found = found.join(level, ["item_id", "ancestor_id"], "left_anti")
        found = cut(found.withColumn("distance", F.lit(len(levels) + 1)))
        levels.append(found)
        if found.isEmpty():
            return reduce(DataFrame.unionByName, levels)
        at = found.select("ancestor_id", F.col("item_id").alias("up"))


def ancestors(items: DataFrame, below: DataFrame) -> DataFrame:
    """item_id, ancestor_id, distance of the ancestors of `below` (item_id): the rows of `closure` for these items, without those of all others.

    A round goes one level up and is written once; way: the ancestors met so far, so a cycle ends.
    """
    edges = items.where("parent_item_id IS NOT NULL").select(F.col("item_id").alias("ancestor_id"), F.col("parent_item_id").alias("up")).dropDuplicates()
    at = below.select("item_id", F.col("item_id").alias("ancestor_id"), F.array("item_id").alias("way")).distinct()
    levels: list[DataFrame] = []
    while True:
        met = at.join(edges, "ancestor_id").where("NOT array_contains(way, up)").select("item_id", F.col("up").alias("ancestor_id"), F.concat("way", F.array("up")).alias("way"))
        at = cut(met.dropDuplicates(["item_id", "ancestor_id"]))
        levels.append(at.select("item_id", "ancestor_id", F.lit(len(levels) + 1).alias("distance")))
        if at.isEmpty():
            return reduce(DataFrame.unionByName, levels).groupBy("item_id", "ancestor_id").agg(F.min("distance").alias("distance"))


def depths(items: DataFrame, closed: DataFrame) -> DataFrame:
    """item_id, depth (1 at a root)."""
    n = closed.groupBy("item_id").agg(F.max("distance").alias("d"))
    return items.select("item_id").join(n, "item_id", "left").select("item_id", (F.coalesce("d", F.lit(0)) + 1).alias("depth"))


def subtree_sizes(items: DataFrame, closed: DataFrame) -> DataFrame:
    """item_id, n_descendants."""
    n = closed.groupBy(F.col("ancestor_id").alias("a")).agg(F.count("*").alias("n"))
    return items.select("item_id").join(n, F.col("item_id") == F.col("a"), "left").select("item_id", F.coalesce("n", F.lit(0)).alias("n_descendants"))


def dominating(requested: DataFrame, closed: DataFrame) -> DataFrame:
    """Requested items without a requested ancestor."""
    upper = requested.select(F.col("item_id").alias("ancestor_id"))
    covered = closed.join(upper, "ancestor_id", "left_semi").select("item_id").distinct()
    return requested.select("item_id").distinct().join(covered, "item_id", "left_anti")


def rebuild_plan(items: DataFrame, requested: DataFrame, closed: DataFrame, with_ancestors: bool = True) -> DataFrame:
    """Known requested items that no other covers and, if asked for, all their ancestors, with step: deepest first, then by id.

    The closure is read several times, so it is kept.
    """
    closed = cut(closed)
    known = requested.join(items.select("item_id"), "item_id", "left_semi") if not with_ancestors else requested
    top = dominating(known, closed)
    plan = top
    if with_ancestors:
        plan = top.unionByName(closed.join(top, "item_id", "left_semi").select(F.col("ancestor_id").alias("item_id"))).distinct()
    return numbered(plan.join(depths(items, closed), "item_id"), "step", F.desc("depth"), F.asc("item_id"))


def duplicate_ids(items: DataFrame) -> DataFrame:
    """item_id, n of ids that stand more than once."""
    return items.groupBy("item_id").agg(F.count("*").alias("n")).where("n > 1")


def renamed_duplicates(items: DataFrame, *order: Column) -> DataFrame:
    """new_id: the second and later of one id, in `order`, end in _double_2, _double_3 ..."""
    k = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return items.withColumn("copy", k).withColumn("new_id", F.when(F.col("copy") > 1, F.concat("item_id", F.lit("_double_"), "copy")).otherwise(F.col("item_id")))


def repaired_levels(items: DataFrame, level: str, depth: str) -> DataFrame:
    """Rows whose level isn't their depth, with the right one."""
    return items.where(F.col(level).isNotNull() & (F.col(level) != F.col(depth))).withColumn("new_level", F.col(depth))


def sibling_places(items: DataFrame, *ties: Column) -> DataFrame:
    """place of each item among its siblings: by type, then number, then `ties`."""
    w = Window.partitionBy("parent_item_id").orderBy(type_rank(F.col("item_type")), number_tuple(F.col("item_number")), *ties)
    return items.withColumn("place", F.row_number().over(w))


def broken_refs(refs: DataFrame, items: DataFrame) -> DataFrame:
    """References to items that aren't there."""
    return refs.join(items.select(F.col("item_id").alias("ref_item_id")).hint("merge"), "ref_item_id", "left_anti")


def unreferenced_children(items: DataFrame, refs: DataFrame) -> DataFrame:
    """Children that no revision of their parent refers to."""
    known = refs.select(F.col("item_id").alias("p"), F.col("ref_item_id").alias("r"))
    return items.where("parent_item_id IS NOT NULL").join(known.hint("merge"), (F.col("item_id") == F.col("r")) & (F.col("parent_item_id") == F.col("p")), "left_anti")


def disordered_bodies(blocks: DataFrame, keys: list[str], place: str) -> DataFrame:
    """Bodies whose places, sorted, aren't 1, 2, ... n."""
    found = blocks.groupBy(*keys).agg(F.array_sort(F.collect_list(place)).alias("places"))
    return found.where(F.col("places") != F.sequence(F.lit(1), F.size("places"))).select(*keys, F.size("places").alias("n_blocks"))


def fingerprints(lines: DataFrame, keys: list[str], *parts: str) -> DataFrame:
    """One hash for each key over its rows' parts, in the order of the parts: equal for identical subtrees."""
    row = F.concat_ws("|", *[F.coalesce(F.col(p).cast("string"), F.lit("~")) for p in parts])
    return lines.groupBy(*keys).agg(F.md5(F.array_join(F.array_sort(F.collect_list(row)), ";")).alias("fingerprint"))


def merge_actions(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys with action: keep, change, add or close, by a full outer join on the siblings' keys."""
    o = old.select(*keys, F.col(value).alias("old_value"), F.lit(True).alias("in_old"))
    n = new.select(*keys, F.col(value).alias("new_value"), F.lit(True).alias("in_new"))
    action = F.when(F.col("in_old").isNull(), "add").when(F.col("in_new").isNull(), "close").when(F.col("old_value").eqNullSafe(F.col("new_value")), "keep").otherwise("change")
    return o.join(n, keys, "full_outer").withColumn("action", action).drop("in_old", "in_new")
