"""Nested JSON documents to flat tables and back."""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexstrata.session import cut

AT_ONCE = 4


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """path, raw, doc (VARIANT; null where the file isn't JSON), broken."""
    rows = spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("path"), F.col("value").alias("raw"))
    return parsed(rows)


def parsed(rows: DataFrame) -> DataFrame:
    """rows (path, raw) with doc and broken."""
    doc = F.try_parse_json("raw")
    return rows.withColumn("doc", doc).withColumn("broken", doc.isNull())


def flatten_items(docs: DataFrame, most_levels: int = 16) -> DataFrame:
    """A row for each item of the trees: path, item_id, parent_item_id, item_type, item_number, item_level, depth, sort_path, item.

    The first levels, most_levels or AT_ONCE, are taken in one pass over the documents, so each is parsed once: a row of the deepest level so far
    gives itself and its children. sort_path orders items as they stand in the document. From there on, each level
    is looked at before it is taken.
    """
    kids = lambda item: F.variant_get(item, "$.item_children", "array<variant>")
    tops = docs.where("NOT broken").select("path", F.posexplode(F.variant_get("doc", "$.npa_items_revision", "array<variant>")).alias("k", "item"))
    at = tops.select("path", F.lit(None).cast("string").alias("parent_item_id"), F.lit(1).alias("depth"), F.array("k").alias("sort_path"), "item")
    most_levels = min(most_levels, AT_ONCE)
    for depth in range(1, most_levels):
        none = F.array(F.lit(None).cast("variant"))  # place 0: the item itself
        down = F.when(F.col("depth") == depth, F.concat(none, F.coalesce(kids(F.col("item")), F.expr("cast(array() AS array<variant>)")))).otherwise(none)
        rows = at.select("*", F.posexplode(down).alias("k", "kid"))
        new = F.col("k") > 0
        at = rows.select(
            "path", F.when(new, F.variant_get("item", "$.item_id", "string")).otherwise(F.col("parent_item_id")).alias("parent_item_id"), F.when(new, depth + 1).otherwise(F.col("depth")).alias("depth"),
            F.when(new, F.concat("sort_path", F.array(F.col("k") - 1))).otherwise(F.col("sort_path")).alias("sort_path"), F.when(new, F.col("kid")).otherwise(F.col("item")).alias("item"),
        )
    levels = [at]
    for depth in count(most_levels):
        at = at.where(F.col("depth") == depth).select("path", kids(F.col("item")).alias("children"), F.variant_get("item", "$.item_id", "string").alias("parent_item_id"), "sort_path").where("size(children) > 0")
        if (at := cut(at)).isEmpty():
            break
        at = at.select("path", "parent_item_id", F.lit(depth + 1).alias("depth"), "sort_path", F.posexplode("children").alias("k", "item")).withColumn("sort_path", F.concat("sort_path", F.array("k"))).drop("k")
        levels.append(at)
    out = reduce(DataFrame.unionByName, levels)
    text = lambda name: F.variant_get("item", f"$.{name}", "string").alias(name)
    return out.select("path", text("item_id"), "parent_item_id", text("item_type"), text("item_number"), F.try_variant_get("item", "$.item_level", "int").alias("item_level"), "depth", "sort_path", "item")


def revisions_of(items: DataFrame) -> DataFrame:
    """path, item_id, rev_idx, valid_from, valid_to, mod_type, modified_by_id, not_valid, body."""
    from lexstrata.functions.dates import parse_date

    rows = items.select("path", "item_id", F.posexplode(F.variant_get("item", "$.revisions", "array<variant>")).alias("rev_idx", "r"))
    text = lambda name: F.try_variant_get("r", f"$.{name}", "string")
    return rows.select("path", "item_id", "rev_idx", parse_date(text("valid_from")).alias("valid_from"), parse_date(text("valid_to")).alias("valid_to"), text("mod_type").alias("mod_type"), text("modified_by_id").alias("modified_by_id"), text("not_valid").alias("not_valid"), F.variant_get("r", "$.body", "array<variant>").alias("body"))


def blocks_of(revisions: DataFrame) -> DataFrame:
    """path, item_id, rev_idx, ord, block_type, html_text, ref_item_id."""
    rows = revisions.select("path", "item_id", "rev_idx", F.posexplode("body").alias("k", "b"))
    text = lambda name: F.try_variant_get("b", f"$.{name}", "string")
    return rows.select("path", "item_id", "rev_idx", F.coalesce(F.try_variant_get("b", "$.order", "int"), F.col("k") + 1).alias("ord"), text("type").alias("block_type"), text("html_text").alias("html_text"), text("item_id").alias("ref_item_id"))


def rendered(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """keys, html: texts of the blocks in order."""
    return blocks.where("html_text IS NOT NULL").groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "html_text"))), lambda x: x["html_text"]), "\n").alias("html"))


def write_json(df: DataFrame, path: str) -> None:
    """A JSON object a line; the committer makes the write appear at once."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def result_name(number: str, date: str, by_number: str, by_date: str):
    """'{number}_{date}_izm_{number}_{date}.json' as a column."""
    from lexstrata.functions.text import file_number

    day = lambda c: F.date_format(c, "yyyy_MM_dd")
    return F.format_string("%s_%s_izm_%s_%s.json", file_number(F.col(number)), day(date), file_number(F.col(by_number)), day(by_date))


def file_date(doc_type: Column, signed: Column, passed: Column, registered: Column) -> Column:
    """yyyy_MM_dd of a law's signing, or of the first of a regulation's passing, registration and signing; '' if none is a date."""
    from lexstrata.functions.dates import parse_date

    day = F.when(doc_type == "law", parse_date(signed)).otherwise(F.coalesce(parse_date(passed), parse_date(registered), parse_date(signed)))
    return F.coalesce(F.date_format(day, "yyyy_MM_dd"), F.lit(""))


def read_answers(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of the JSON lists in the files of a path, in the order of file and place: file, pos, broken and the schema's fields.

    A file that isn't a list gives one row with broken true, so a strict caller can refuse it.
    """
    rows = spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("file"), "value")
    listed = rows.select("file", F.from_json("value", f"array<struct<{schema}>>").alias("list"), F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("ARRAY"), F.lit(False)).alias("ok"))
    good = listed.where("ok").select("file", F.posexplode("list").alias("pos", "row")).select("file", "pos", F.lit(False).alias("broken"), "row.*")
    return good.unionByName(listed.where("NOT ok").select("file", F.lit(0).alias("pos"), F.lit(True).alias("broken")), allowMissingColumns=True)
