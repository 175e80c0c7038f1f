"""Articles that are cut into parts: found from the changes of a document, and carried out with bodies and timelines.

items: npa_id, item_id, parent_item_id, item_type, item_number, item_level, place. blocks: open bodies (item_id, ord, type, html_text,
ref_item_id). changes: change_id (unique), npa_id, seq, type, structural (path text), description, item_id (what the path leads to, or null),
new (what is added, 'часть 2'), html (the markup of an addition), valid_from (date), modified_by_id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexstrata.functions.dates import closing_date
from lexstrata.functions.numbers import clean_number
from lexstrata.functions.text import without_leading_number
from lexstrata.operators.paths import named_addition
from lexstrata.operators.quotations import source_blocks
from lexstrata.session import cut

# What a change says that puts the number of a first part before an article's text, and how it names old and new words.
NUMBER_COMES = "(?:заменить|дополнить) словами\\s+[«\"]1\\.\\s"
WORDS = "слова\\s+[«\"](.+?)[»\"]\\s+заменить словами\\s+[«\"](.+?)[»\"]"


@dataclass(frozen=True)
class Reorganised:
    """items: new ones (npa_id, item_id, old_id, parent_item_id, item_type, item_number, item_level, place, mod_type, valid_from, modified_by_id).
    closed: item_id, valid_to of the revisions that end. blocks: bodies from then on, of the articles and the new items. taken: change_id of the changes this does."""

    items: DataFrame
    closed: DataFrame
    blocks: DataFrame
    taken: DataFrame


def triggers(changes: DataFrame, items: DataFrame) -> DataFrame:
    """changes that cut an article into parts: in each document the first that puts '1.' before an article's text, if its path leads to an item with children."""
    said = (F.col("type") == "change") & F.contains(F.lower("structural"), F.lit("статья")) & F.col("description").rlike(NUMBER_COMES)
    w = Window.partitionBy("npa_id").orderBy("seq", "change_id")
    first = changes.where(said).withColumn("k", F.row_number().over(w)).where("k = 1").drop("k")
    return first.join(items.select("npa_id", F.col("parent_item_id").alias("item_id")), ["npa_id", "item_id"], "left_semi")


def replaced_once(text: Column, description: Column) -> Column:
    """text with the first words that the description names replaced, at their first place; as it is where it names none or they aren't there."""
    old, new = (F.regexp_extract(description, WORDS, k) for k in (1, 2))
    at = F.position(old, text)
    return F.when((old != "") & (at > 0), F.concat(F.substring(text, F.lit(1), at - 1), new, F.substring(text, at + F.length(old), F.length(text)))).otherwise(text)


def _bare(number: Column) -> Column:
    return F.regexp_replace(F.coalesce(number, F.lit("")), "[.)]+$", "")


def reorganised(items: DataFrame, blocks: DataFrame, changes: DataFrame) -> Reorganised:
    """Each triggered article refers to its parts only. Part 1 takes its first paragraph, with the words replaced, and new copies of the children its
    open body refers to (what a copied body refers to stays where it is); other children stay as they are, without a reference. Additions with the very path text of the trigger come in too: parts
    beside part 1, all else below it behind the copies. What has a number that is there, or that an addition before it had, or no
    type, is left to others (not `taken`). Articles that aren't triggered are not touched.
    """
    hit = cut(triggers(changes, items).join(items.select("npa_id", "item_id", F.col("item_level").cast("int").alias("level")), ["npa_id", "item_id"]))
    part_one = F.concat_ws("_", "article", F.lit("part_1")).alias("part_one")
    at = hit.select("npa_id", F.col("item_id").alias("article"), "level", F.trim("structural").alias("path"), "description", "valid_from", "modified_by_id").select("*", part_one)
    dated = [F.col("valid_from"), F.col("modified_by_id")]
    none = F.lit(None).cast("string")

    bodies = blocks.join(at.select(F.col("article").alias("item_id"), "part_one", "npa_id", "level", "description", *dated), "item_id")
    bodies = cut(bodies.where("ref_item_id IS NOT NULL OR type = 'paragraph'"))
    live = bodies.where("ref_item_id IS NOT NULL").select(F.col("item_id").alias("parent_item_id"), F.col("ref_item_id").alias("item_id"), "part_one", "level", *dated).distinct()
    kids = items.select("npa_id", "item_id", "parent_item_id", "item_type", "item_number", F.col("place").cast("long").alias("place")).join(live, ["parent_item_id", "item_id"])
    copies = cut(kids.select(
        "npa_id", F.concat_ws("_", "part_one", "item_type", F.nullif(_bare(F.col("item_number")), F.lit(""))).alias("item_id"), F.col("item_id").alias("old_id"), F.col("part_one").alias("parent_item_id"),
        "item_type", "item_number", (F.col("level") + 2).alias("item_level"), "place", F.lit("change").alias("mod_type"), *dated,
    ))

    named = changes.where("type = 'add'").select("change_id", "npa_id", "seq", F.trim("structural").alias("path"), named_addition(F.col("new")).alias("what"), "html", F.col("modified_by_id").alias("by"))
    asked = named.where("what.type IS NOT NULL").join(at.drop("description"), ["npa_id", "path"])
    asked = asked.select("*", F.col("what.type").alias("item_type"), F.coalesce("what.number", F.lit("")).alias("item_number"))
    asked = asked.withColumn("parent_item_id", F.when(F.col("item_type") == "part", F.col("article")).otherwise(F.col("part_one"))).withColumn("number_key", clean_number(F.col("item_number")))
    there = copies.select("parent_item_id", "item_type", clean_number(F.col("item_number")).alias("number_key"))
    ones = at.select(F.col("article").alias("parent_item_id"), F.lit("part").alias("item_type"), F.lit("1").alias("number_key"))
    asked = asked.join(there.unionByName(ones).distinct(), ["parent_item_id", "item_type", "number_key"], "left_anti")
    alike = Window.partitionBy("parent_item_id", "item_type", "number_key").orderBy("seq", "change_id")
    fresh = asked.withColumn("k", F.row_number().over(alike)).where("k = 1")
    turn = F.row_number().over(Window.partitionBy("parent_item_id").orderBy("seq", "change_id"))
    behind = copies.groupBy("parent_item_id").agg(F.max("place").alias("behind"))
    fresh = fresh.withColumn("turn", turn).join(behind, "parent_item_id", "left")
    is_part = F.col("item_type") == "part"
    fresh = cut(fresh.select(
        "change_id", "html", "npa_id", F.concat_ws("_", "parent_item_id", "item_type", F.nullif(_bare(F.col("item_number")), F.lit(""))).alias("item_id"), none.alias("old_id"), "parent_item_id", "item_type", "item_number",
        (F.col("level") + F.when(is_part, 1).otherwise(2)).alias("item_level"), (F.when(is_part, F.lit(1)).otherwise(F.coalesce("behind", F.lit(0))) + F.col("turn")).cast("long").alias("place"),
        F.lit("add").alias("mod_type"), "valid_from", F.coalesce("by", "modified_by_id").alias("modified_by_id"),
    ))
    ones = at.select("npa_id", F.col("part_one").alias("item_id"), none.alias("old_id"), F.col("article").alias("parent_item_id"), F.lit("part").alias("item_type"), F.lit("1").alias("item_number"), (F.col("level") + 1).alias("item_level"), F.lit(1).cast("long").alias("place"), F.lit("change").alias("mod_type"), *dated)
    come = ones.unionByName(copies).unionByName(fresh.select(ones.columns))

    end = closing_date(F.col("valid_from")).alias("valid_to")
    closed = at.select(F.col("article").alias("item_id"), end).unionByName(copies.select(F.col("old_id").alias("item_id"), end))

    texts = bodies.where("type = 'paragraph'").groupBy("part_one").agg(F.min_by("html_text", "ord").alias("html_text"))
    first = at.join(texts, "part_one", "left").select(F.col("part_one").alias("item_id"), F.lit(0).cast("long").alias("spot"), F.lit("paragraph").alias("type"), replaced_once(F.coalesce("html_text", F.lit("")), F.col("description")).alias("html_text"), none.alias("ref_item_id"))
    refs = come.select(F.col("parent_item_id").alias("item_id"), F.col("place").alias("spot"), F.lit("child_ref").alias("type"), none.alias("html_text"), F.col("item_id").alias("ref_item_id"))
    moved = blocks.join(copies.select(F.col("old_id").alias("item_id"), F.col("item_id").alias("new_id")), "item_id").select(F.col("new_id").alias("item_id"), F.col("ord").cast("long").alias("spot"), "type", "html_text", "ref_item_id")
    said = source_blocks(fresh.select(F.col("item_id").alias("key"), "html")).join(fresh.select(F.col("item_id").alias("key"), "item_type", "item_number"), "key")
    bare = F.when((F.col("pos") == 1) & ~is_part, without_leading_number(F.col("html"), F.col("item_number"))).otherwise(F.col("html"))
    new = said.select(F.col("key").alias("item_id"), F.col("pos").cast("long").alias("spot"), F.when(F.startswith(F.lower("html"), F.lit("<table")), "table_fragment").otherwise("paragraph").alias("type"), bare.alias("html_text"), none.alias("ref_item_id"))
    whole = first.unionByName(refs).unionByName(moved).unionByName(new)
    order = F.row_number().over(Window.partitionBy("item_id").orderBy("spot", "ref_item_id"))
    bodies_after = whole.select("item_id", order.alias("ord"), "type", "html_text", "ref_item_id")
    return Reorganised(come, closed, bodies_after, hit.select("change_id").unionByName(fresh.select("change_id")))
