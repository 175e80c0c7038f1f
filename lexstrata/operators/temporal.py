"""As-of queries over revision timelines.

A timeline has a row for each revision: item_id, rev_idx (place in the item's list), valid_from,
valid_to (null: open). Both ends of an interval count. Everything is partitioned by item_id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexstrata.functions.dates import closing_date
from lexstrata.session import cut


def first_of(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def covers(date: Column) -> Column:
    return (F.col("valid_from") <= date) & (F.col("valid_to").isNull() | (date <= F.col("valid_to")))


def effective_revision(timeline: DataFrame, date: Column) -> DataFrame:
    """The revision of each item in force on a date: of several the latest, of equals the first in the list. Undated ones never."""
    return first_of(timeline.where(covers(date)), ["item_id"], F.desc("valid_from"), F.asc("rev_idx"))


def effective_grid(timeline: DataFrame, dates: DataFrame) -> DataFrame:
    """effective_revision for each as_of date of a calendar.

    The calendar's days go into every task as one array, so each revision looks up its own days and
    no nested loop runs; a calendar has a bounded number of days.
    """
    days = dates.agg(F.array_sort(F.collect_set("as_of"))).scalar()
    held = F.filter("_days", lambda day: (F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (day <= F.col("valid_to"))))
    joined = timeline.withColumn("_days", days).withColumn("as_of", F.explode(held)).drop("_days")
    return first_of(joined, ["item_id", "as_of"], F.desc("valid_from"), F.asc("rev_idx"))


def latest_revision(timeline: DataFrame) -> DataFrame:
    """The revision with the greatest valid_from (of equals the first), or the last in the list if none is dated."""
    dated = F.col("valid_from").isNotNull()
    return first_of(timeline, ["item_id"], F.desc_nulls_last("valid_from"), F.when(dated, F.col("rev_idx")).otherwise(-F.col("rev_idx")))


def active_for_reading(timeline: DataFrame) -> DataFrame:
    """The last open revision in the list, else the last."""
    return first_of(timeline, ["item_id"], F.desc(F.col("valid_to").isNull()), F.desc("rev_idx"))


def active_for_writing(timeline: DataFrame) -> DataFrame:
    """The first open revision in the list, else the last."""
    is_open = F.col("valid_to").isNull()
    return first_of(timeline, ["item_id"], F.desc(is_open), F.when(is_open, F.col("rev_idx")).otherwise(-F.col("rev_idx")))


def expected_ends(timeline: DataFrame) -> DataFrame:
    """expected_to: the day before the next revision in the list starts."""
    w = Window.partitionBy("item_id").orderBy("rev_idx")
    return timeline.withColumn("expected_to", closing_date(F.lead("valid_from").over(w)))


def continuity_gaps(timeline: DataFrame) -> DataFrame:
    """Revisions whose end isn't the day before the next one's start, where both dates are there."""
    return expected_ends(timeline).where("valid_to IS NOT NULL AND expected_to IS NOT NULL AND valid_to <> expected_to")


def active_conflicts(timeline: DataFrame) -> DataFrame:
    """Items with more than one open revision."""
    return timeline.groupBy("item_id").agg(F.count_if(F.col("valid_to").isNull()).alias("n_open")).where("n_open > 1")


def dated(timeline: DataFrame, amendment: Column, document: Column) -> DataFrame:
    """Missing valid_from filled: the amendment's date where a revision tells its change or changer, else the document's."""
    amended = F.col("mod_type").isNotNull() | F.col("modified_by_id").isNotNull()
    return timeline.withColumn("filled", F.col("valid_from").isNull()).withColumn("valid_from", F.coalesce("valid_from", F.when(amended, amendment).otherwise(document)))


def missing_children(parents: DataFrame, children: DataFrame) -> DataFrame:
    """References (parent revisions with child_id and valid_from) whose child has no revision in force on that day.

    category: stale_child_revision if the child has any dated revision, else revision_child_missing.
    """
    refs = parents.where("valid_from IS NOT NULL").select("item_id", "child_id", "valid_from").distinct()
    spans = children.select(F.col("item_id").alias("c"), F.col("valid_from").alias("c_from"), F.col("valid_to").alias("c_to"))
    held = (F.col("child_id") == F.col("c")) & (F.col("c_from") <= F.col("valid_from")) & (F.col("c_to").isNull() | (F.col("valid_from") <= F.col("c_to")))
    missing = refs.join(spans.hint("merge"), held, "left_anti")
    known = spans.where("c_from IS NOT NULL").select("c").distinct()
    return missing.join(known.hint("merge"), missing.child_id == known.c, "left").select("item_id", "child_id", "valid_from", F.when(F.col("c").isNotNull(), "stale_child_revision").otherwise("revision_child_missing").alias("category"))


def synced_children(parents: DataFrame, children: DataFrame, date: Column) -> DataFrame:
    """Revisions that bring children up to parents' revisions of a date, one for each child that has some revision.

    The child's open revision (`closes`) ends the day before; the new one copies its body, or that of
    the latest. A second run finds nothing to do. Deeper levels follow by calling it level by level.
    """
    missing = missing_children(parents.where(F.col("valid_from") == date), children)
    changer = parents.where(F.col("valid_from") == date).groupBy("child_id").agg(F.min("modified_by_id").alias("modified_by_id"))
    wanted = missing.select("child_id").distinct().join(changer, "child_id")
    source = latest_revision(children).select(F.col("item_id").alias("child_id"), F.col("rev_idx").alias("latest_idx"))
    open_ = first_of(children.where("valid_to IS NULL"), ["item_id"], F.asc("rev_idx")).select(F.col("item_id").alias("o"), F.col("rev_idx").alias("closes"))
    joined = wanted.join(source, "child_id").join(open_, F.col("child_id") == F.col("o"), "left")
    return joined.select(F.col("child_id").alias("item_id"), "closes", F.coalesce("closes", "latest_idx").alias("copies"), date.alias("valid_from"), F.lit("change").alias("mod_type"), "modified_by_id")


def synced_tree(timeline: DataFrame, refs: DataFrame, date: Column) -> DataFrame:
    """`synced_children` through all levels: a revision made for a child refers to what the copied one did, and so on down.

    timeline: item_id, rev_idx, valid_from, valid_to, modified_by_id; refs: item_id, rev_idx, child_id. Each item gets one
    revision at most, so cycles end. All parents are of one day, so what a child would get is worked out once for all levels.
    """
    refs = cut(refs.select("item_id", "rev_idx", "child_id"))
    dated_ = F.col("valid_from").isNotNull()
    latest = F.max_by("rev_idx", F.struct("valid_from", F.when(dated_, -F.col("rev_idx")).otherwise(F.col("rev_idx"))))
    open_ = F.min(F.when(F.col("valid_to").isNull(), F.col("rev_idx")))
    told = timeline.groupBy(F.col("item_id").alias("child_id")).agg(F.coalesce(F.bool_or(covers(date)), F.lit(False)).alias("held"), open_.alias("closes"), latest.alias("latest_idx"))
    stale = cut(told.where("NOT held").drop("held"))
    at = timeline.where(F.col("valid_from") == date).join(refs, ["item_id", "rev_idx"]).select("child_id", "modified_by_id")
    made: list[DataFrame] = []
    while True:
        new = at.groupBy("child_id").agg(F.min("modified_by_id").alias("modified_by_id")).join(stale, "child_id")
        new = new.select(F.col("child_id").alias("item_id"), "closes", F.coalesce("closes", "latest_idx").alias("copies"), date.alias("valid_from"), F.lit("change").alias("mod_type"), "modified_by_id")
        for level in made:
            new = new.join(level.select("item_id"), "item_id", "left_anti")
        made.append(new := cut(new))
        if new.isEmpty():
            return reduce(DataFrame.unionByName, made)
        at = new.join(refs.withColumnRenamed("rev_idx", "copies"), ["item_id", "copies"]).select("child_id", "modified_by_id")
