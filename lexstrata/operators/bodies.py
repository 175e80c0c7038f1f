"""Bodies of revisions (blocks in order) and the siblings they refer to."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexstrata.functions.numbers import number_tuple
from lexstrata.session import cut


def renumbered(blocks: DataFrame, keys: list[str], *order) -> DataFrame:
    """blocks with ord 1, 2, ... in `order` within each body."""
    return blocks.withColumn("ord", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("int"))


def with_references(blocks: DataFrame, additions: DataFrame, places: DataFrame, *kept: str) -> DataFrame:
    """Bodies (item_id, ord, ref_item_id and kept columns) with references to added children (item_id, ref_item_id).

    places (ref_item_id, place) orders siblings. A reference goes after that of the nearest sibling before
    it, else before that of the nearest after it, else to the end.
    """
    known = blocks.where("ref_item_id IS NOT NULL").join(places, "ref_item_id").select("item_id", F.lit(None).cast(additions.schema["ref_item_id"].dataType).alias("ref_item_id"), "place", F.col("ord").alias("at"), F.lit(1).alias("old"))
    new = additions.join(places, "ref_item_id").select("item_id", "ref_item_id", "place", F.lit(None).cast("int").alias("at"), F.lit(0).alias("old"))
    w = Window.partitionBy("item_id")
    below, above = (w.orderBy("place", k, F.col("at")) for k in (F.asc("old"), F.desc("old")))  # siblings of one place count for neither side
    near = known.unionByName(new).withColumn("after", F.last("at", ignorenulls=True).over(below.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    near = near.withColumn("before", F.first("at", ignorenulls=True).over(above.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    held = near.where("old = 0").select("item_id", "ref_item_id", "place", "after", "before")
    ends = blocks.groupBy("item_id").agg(F.max("ord").alias("top"))
    placed = held.join(ends, "item_id", "left").select("item_id", "ref_item_id", F.coalesce(F.col("after") + 0.5, F.col("before") - 0.5, F.col("top") + 0.5, F.lit(1.0)).alias("spot"), "place")
    old = blocks.select("item_id", "ref_item_id", F.col("ord").cast("double").alias("spot"), F.lit(0).cast("int").alias("place"), *kept)
    every = old.unionByName(placed.withColumn("place", F.col("place").cast("int")), allowMissingColumns=True)
    return renumbered(every, ["item_id"], "spot", "place").select("item_id", "ord", "ref_item_id", *kept)


def rewritten(blocks: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """New paragraphs (key, pos, html_text) followed by the references of the old body, renumbered."""
    new = texts.select(key, F.lit(0).alias("kind"), F.col("pos").alias("spot"), "html_text", F.lit(None).cast("string").alias("ref_item_id"))
    old = blocks.where("ref_item_id IS NOT NULL").join(texts.select(key).distinct(), key, "left_semi").select(key, F.lit(1).alias("kind"), F.col("ord").alias("spot"), F.lit(None).cast("string").alias("html_text"), F.col("ref_item_id").cast("string").alias("ref_item_id"))
    return renumbered(new.unionByName(old), [key], "kind", "spot").select(key, "ord", "html_text", "ref_item_id")


TAGS = "\\s*((?:</?[^>]*>\\s*)*)$"


def ending(text, mark: str):
    return F.coalesce(text, F.lit("")).rlike(f"[{mark}]{TAGS}")


def after_addition(siblings: DataFrame) -> DataFrame:
    """Texts (plain or markup) of siblings (parent_item_id, item_number, text, added) after additions at the end, one after another by number.

    The item before an added last one ends in ';' instead of '.', if a sibling before the added one ends in ';'.
    """
    w = Window.partitionBy("parent_item_id").orderBy(number_tuple(F.col("item_number")), "item_number")
    listed = F.max(ending(F.col("text"), ";")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    follows = F.min("added").over(w.rowsBetween(1, Window.unboundedFollowing))
    hit = F.coalesce(follows & listed, F.lit(False)) & ending(F.col("text"), ".")
    return siblings.withColumn("new_text", F.when(hit, F.regexp_replace("text", f"\\.{TAGS}", ";$1")).otherwise(F.col("text")))


def after_deletion(siblings: DataFrame) -> DataFrame:
    """Texts of siblings (parent_item_id, item_number, text, deleted) after deletions.

    Where the last one is deleted and ended in '.', the new last one ends in '.' instead of ';'.
    """
    w = Window.partitionBy("parent_item_id").orderBy(number_tuple(F.col("item_number")), "item_number")
    below = w.rowsBetween(1, Window.unboundedFollowing)
    left_below = F.coalesce(F.max(~F.col("deleted")).over(below), F.lit(False))
    last = F.last("deleted").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    stop = F.last(ending(F.col("text"), ".")).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    hit = ~F.col("deleted") & ~left_below & last & stop & ending(F.col("text"), ";")
    return siblings.withColumn("new_text", F.when(hit, F.regexp_replace("text", ";\\s*$", ".")).otherwise(F.col("text")))


def new_ids(additions: DataFrame, items: DataFrame) -> DataFrame:
    """item_id of added elements (parent_item_id, item_type, item_number): parent_type_number, then _2, _3 ... where taken."""
    base = F.concat_ws("_", "parent_item_id", "item_type", F.regexp_replace(F.regexp_replace(F.coalesce(F.col("item_number"), F.lit("")), "[.)]+$", ""), "\\.", "_"))
    named = additions.withColumn("base", base)
    stems = items.select(F.regexp_replace("item_id", "_\\d+$", "").alias("stem"), "item_id")
    taken = items.select(F.col("item_id").alias("base"), F.lit(1).alias("n")).unionByName(stems.where("stem <> item_id").select(F.col("stem").alias("base"), F.regexp_extract("item_id", "_(\\d+)$", 1).cast("int").alias("n")))
    known = taken.join(named.select("base").distinct(), "base", "left_semi").join(items.select(F.col("item_id").alias("base")), "base", "left_semi").groupBy("base").agg(F.max("n").alias("used"))
    k = F.row_number().over(Window.partitionBy("base").orderBy("seq")) + F.coalesce("used", F.lit(0))
    numbered = named.join(known, "base", "left").withColumn("k", k)
    return numbered.withColumn("item_id", F.when(F.col("k") == 1, F.col("base")).otherwise(F.concat_ws("_", "base", "k"))).drop("k", "used", "base")


def containers(sections: DataFrame, wanted: DataFrame) -> DataFrame:
    """Of numbered containers (container_id, parent_item_id, top: their greatest child number) the one for each wanted number:
    that with the greatest top not above it."""
    none = F.lit(None).cast(sections.schema["container_id"].dataType)
    both = sections.select("parent_item_id", F.col("top").alias("number"), "container_id", F.lit(0).alias("kind")).unionByName(wanted.select("parent_item_id", "number", none.alias("container_id"), F.lit(1).alias("kind")))
    w = Window.partitionBy("parent_item_id").orderBy("number", "kind", "container_id")
    found = both.withColumn("container_id", F.last("container_id", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return found.where("kind = 1 AND container_id IS NOT NULL").select("parent_item_id", "number", "container_id").distinct()


def rendered_tree(roots: DataFrame, blocks: DataFrame, most_levels: int = 16) -> DataFrame:
    """root_id, html: the texts of a root's body and, at the place of each reference, those of what it refers to.

    Level by level, along the references alone: a row carries the places that lead to it. Texts are met once, by the items of
    all levels, and put together in their order. A reference to an item that leads to it is left out. From most_levels on, each
    level is written once and looked at before it is taken. blocks are read twice.
    """
    refs = cut(blocks.where("ref_item_id IS NOT NULL").select("item_id", "ord", "ref_item_id"))
    texts = blocks.where("html_text IS NOT NULL").select("item_id", "ord", "html_text")
    at = roots.select("root_id", F.col("root_id").alias("item_id"), F.expr("cast(array() AS array<int>)").alias("path"), F.array("root_id").alias("above"))
    met = None
    for level in count():
        if level >= most_levels and (at := cut(at)).isEmpty():
            break
        own = at.select("root_id", "item_id", "path")
        met = own if met is None else met.unionByName(own)
        further = at.join(refs, "item_id").where("NOT array_contains(above, ref_item_id)")
        at = further.select("root_id", F.col("ref_item_id").alias("item_id"), F.concat("path", F.array(F.col("ord").cast("int"))).alias("path"), F.concat("above", F.array("ref_item_id")).alias("above"))
    out = met.join(texts, "item_id").select("root_id", F.concat("path", F.array(F.col("ord").cast("int"))).alias("path"), "html_text")
    ordered = F.array_sort(F.collect_list(F.struct("path", "html_text")))
    return out.groupBy("root_id").agg(F.array_join(F.transform(ordered, lambda x: x["html_text"]), "\n").alias("html"))


def selected(blocks, spec):
    """Of an array of blocks those that 'a-b,c' names, counted from 1, in its order; 'all' or blank takes all, places beyond the end none."""
    from lexstrata.functions.text import listed_numbers

    picked = F.transform(F.filter(listed_numbers(spec), lambda k: (k >= 1) & (k <= F.size(blocks))), lambda k: F.get(blocks, k - 1))
    return F.when(F.coalesce(F.trim(spec), F.lit("")).isin("", "all"), blocks).otherwise(picked)


def reorganised(points: DataFrame, triggers: DataFrame, additions: DataFrame) -> DataFrame:
    """Points (item_id, parent_item_id, item_number) of triggered articles moved under a new part 1, with further new parts.

    triggers: parent_item_id; additions: parent_item_id, item_number of new parts from 2 on. Returns item_id (new),
    old_id, parent_item_id, item_type, item_number; articles that aren't triggered are left as they are.
    """
    part = F.concat_ws("_", F.col("parent_item_id"), F.lit("part"), F.lit("1"))
    bare = F.regexp_replace("item_number", "[.)]+$", "")
    moved = points.join(triggers, "parent_item_id", "left_semi").select(F.concat_ws("_", part, F.lit("point"), bare).alias("item_id"), F.col("item_id").alias("old_id"), part.alias("parent_item_id"), F.lit("point").alias("item_type"), "item_number")
    none = F.lit(None).cast("string")
    first = triggers.select(part.alias("item_id"), none.alias("old_id"), "parent_item_id", F.lit("part").alias("item_type"), F.lit("1").alias("item_number"))
    more = additions.join(triggers, "parent_item_id", "left_semi").select(F.concat_ws("_", "parent_item_id", F.lit("part"), bare).alias("item_id"), none.alias("old_id"), "parent_item_id", F.lit("part").alias("item_type"), bare.alias("item_number"))
    return moved.unionByName(first).unionByName(more)
