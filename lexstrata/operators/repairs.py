"""Repairs of item and body tables, each with the rows it changed, and the driver that runs them in their fixed order.

As in `verify`, joins whose sides both grow with the document are sorted ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexstrata.operators.bodies import renumbered


def with_missing_refs(blocks: DataFrame, children: DataFrame, active: DataFrame) -> DataFrame:
    """Bodies of active revisions with references to the children they lack, at the end in the children's order.

    blocks: item_id, rev_idx, ord, ref_item_id (and more); children: item_id (the child), parent_item_id, place; active:
    item_id, rev_idx, mod_type. A new wording is left as it is.
    """
    held = blocks.where("ref_item_id IS NOT NULL").select(F.col("item_id").alias("parent_item_id"), "rev_idx", F.col("ref_item_id").alias("child"))
    open_ = active.where("mod_type IS NULL OR mod_type <> 'new_redaction'").select(F.col("item_id").alias("parent_item_id"), "rev_idx")
    wanted = children.where("parent_item_id IS NOT NULL").select("parent_item_id", F.col("item_id").alias("child"), "place").join(open_.hint("merge"), "parent_item_id")
    missing = wanted.join(held.hint("merge"), ["parent_item_id", "rev_idx", "child"], "left_anti")
    last = blocks.groupBy("item_id", "rev_idx").agg(F.max("ord").alias("top"))
    k = F.row_number().over(Window.partitionBy("parent_item_id", "rev_idx").orderBy("place", "child"))
    rows = missing.withColumn("k", k).withColumnRenamed("parent_item_id", "item_id").join(last.hint("merge"), ["item_id", "rev_idx"], "left")
    new = rows.select("item_id", "rev_idx", (F.coalesce("top", F.lit(0)) + F.col("k")).cast("int").alias("ord"), F.col("child").alias("ref_item_id"))
    return blocks.unionByName(new, allowMissingColumns=True)


def without_broken_refs(blocks: DataFrame, items: DataFrame, timeline: DataFrame) -> DataFrame:
    """Blocks without references to unknown items in open revisions, renumbered; closed revisions stay as they are."""
    known = items.select(F.col("item_id").alias("known")).distinct()
    open_ = timeline.select("item_id", "rev_idx", F.col("valid_to").isNull().alias("is_open"))
    refs, texts = blocks.where("ref_item_id IS NOT NULL"), blocks.where("ref_item_id IS NULL")  # texts have no key, so they would all meet in one task
    told = refs.join(known.hint("merge"), F.col("ref_item_id") == F.col("known"), "left").unionByName(texts.withColumn("known", F.lit(None).cast(known.schema["known"].dataType)))
    looked = told.join(open_.hint("merge"), ["item_id", "rev_idx"], "left")
    broken = F.col("ref_item_id").isNotNull() & F.col("known").isNull() & F.coalesce("is_open", F.lit(False))
    return renumbered(looked.where(~broken).drop("known", "is_open"), ["item_id", "rev_idx"], "ord").select(*blocks.columns)


def without_empty_copies(items: DataFrame, *filled: DataFrame) -> DataFrame:
    """Items without the renamed copies (_double_N) that no other table (each with item_id) has rows of."""
    copies = items.where(F.col("item_id").rlike("_double_[0-9]+$")).select("item_id")
    for t in filled:
        copies = copies.join(t.select("item_id").distinct().hint("merge"), "item_id", "left_anti")
    return items.join(copies.hint("merge"), "item_id", "left_anti")


def run_fixes(tables: dict, fixes: list[tuple[str, Callable[[dict], dict]]], verify: Callable[[dict], DataFrame | int], keep: Callable[[DataFrame, str], DataFrame]) -> tuple[dict, DataFrame]:
    """Tables after all fixes, one after another, and a row for each: step, fix, issues_before, issues_after.

    A fix takes the tables and returns those it changed; `keep` writes a changed table where all executors see it. verify gives issue rows or their number.
    """
    spark = next(iter(tables.values())).sparkSession
    count = lambda found: found if isinstance(found, int) else found.count()
    log, before = [], count(verify(tables))
    for k, (name, fix) in enumerate(fixes):
        changed = {t: keep(df, f"fix_{k}_{t}") for t, df in fix(tables).items()}
        tables = {**tables, **changed}
        after = count(verify(tables))
        log.append((k + 1, name, before, after))
        before = after
    return tables, spark.createDataFrame(log, "step int, fix string, issues_before long, issues_after long")
