"""Flat tables back to nested JSON documents, from the deepest items up; the counterpart of `documents.flatten_items`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexstrata.session import cut

ITEM_FIELDS = ("item_id", "item_type", "item_number", "item_level")


def with_list(object_json: Column, name: str, parts: Column) -> Column:
    """A JSON object with a further field: a list of JSON texts; none where parts is null or empty."""
    filled = F.concat(F.regexp_replace(object_json, "\\}$", ""), F.when(object_json == "{}", "").otherwise(","), F.lit(f'"{name}":['), F.array_join(parts, ","), F.lit("]}"))
    return F.when(F.coalesce(F.size(parts), F.lit(0)) > 0, filled).otherwise(object_json)


def ordered(value: Column, *order: str) -> Column:
    """The values of a group in order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(*order, value.alias("_value")))), lambda x: x["_value"])


def block_lists(blocks: DataFrame) -> DataFrame:
    """path, item_id, rev_idx, body: the blocks as JSON texts in order."""
    block = F.to_json(F.struct(F.col("block_type").alias("type"), "html_text", F.col("ref_item_id").alias("item_id"), F.col("ord").alias("order")))
    return blocks.groupBy("path", "item_id", "rev_idx").agg(ordered(block, "ord").alias("body"))


def revision_lists(revisions: DataFrame, blocks: DataFrame | None = None) -> DataFrame:
    """path, item_id, revisions: as JSON texts in order. Dates are written as yyyy-MM-dd."""
    names = [c for c in revisions.columns if c not in ("path", "item_id", "rev_idx", "body")]
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c) if revisions.schema[c].dataType.typeName() == "date" else F.col(c)
    own = revisions.select("path", "item_id", "rev_idx", F.to_json(F.struct(*[day(c) for c in names])).alias("j"))
    if blocks is not None:
        own = own.join(block_lists(blocks), ["path", "item_id", "rev_idx"], "left").withColumn("j", with_list(F.col("j"), "body", F.col("body")))
    return own.groupBy("path", "item_id").agg(ordered(F.col("j"), "rev_idx").alias("revisions"))


def nested_documents(items: DataFrame, revisions: DataFrame | None = None, blocks: DataFrame | None = None) -> DataFrame:
    """path, raw: documents with their trees, to any depth.

    items: path, sort_path (unique in a path; its length is the depth) and the item's fields; revisions and blocks as
    `documents` reads them. Level by level from the deepest, children are put into their parents in the order of sort_path, so no task holds more
    than one document. An item whose parent is missing is left out.
    """
    fields = [c for c in ITEM_FIELDS if c in items.columns]
    own = items.select("path", "item_id", "sort_path", F.to_json(F.struct(*fields)).alias("j"))
    if revisions is not None:
        told = own.join(revision_lists(revisions, blocks), ["path", "item_id"], "left")
        own = told.select("path", "item_id", "sort_path", with_list(F.col("j"), "revisions", F.col("revisions")).alias("j"))
    own = cut(own.withColumn("depth", F.size("sort_path")))
    deepest = own.agg(F.max("depth")).first()[0] or 0
    below = None
    for depth in range(deepest, 0, -1):
        at = own.where(F.col("depth") == depth)
        if below is not None:
            kids = below.groupBy("path", "up").agg(ordered(F.col("j"), "sort_path").alias("kids"))
            at = at.join(kids.withColumnRenamed("up", "sort_path"), ["path", "sort_path"], "left").withColumn("j", with_list(F.col("j"), "item_children", F.col("kids")))
        below = at.select("path", "sort_path", F.slice("sort_path", F.lit(1), F.lit(depth - 1)).alias("up"), "j")
        if (deepest - depth) % 4 == 3:
            below = cut(below)
    if below is None:
        return items.select("path", F.lit("").alias("raw")).where("false")
    tops = below.groupBy("path").agg(ordered(F.col("j"), "sort_path").alias("tops"))
    return tops.select("path", with_list(F.lit("{}"), "npa_items_revision", F.col("tops")).alias("raw"))


def write_documents(docs: DataFrame, folder: str) -> None:
    """Documents (name, raw), each in a folder of its own name."""
    docs.select("name", "raw").write.mode("overwrite").partitionBy("name").text(folder)
