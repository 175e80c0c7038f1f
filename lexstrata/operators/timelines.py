"""Timelines beside an item's text: titles, prefixes, numbers and notes, their histories, their transfer and their alignment.

A timeline has item_id, rev_idx, value, valid_from, valid_to, mod_type, modified_by_id. The active row is the first open one, else the last.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexstrata.functions.dates import closing_date
from lexstrata.session import cut

COLUMNS = ("item_id", "rev_idx", "value", "valid_from", "valid_to", "mod_type", "modified_by_id")


def active_rows(timeline: DataFrame) -> DataFrame:
    """item_id, active_idx, active (its value), is_open, last_idx."""
    first_open = F.min(F.when(F.col("valid_to").isNull(), F.struct("rev_idx", "value")))
    last = F.max(F.struct("rev_idx", "value"))
    per = timeline.groupBy("item_id").agg(first_open.alias("o"), last.alias("l"))
    at = F.coalesce(F.col("o"), F.col("l"))
    return per.select("item_id", at["rev_idx"].alias("active_idx"), at["value"].alias("active"), F.col("o").isNotNull().alias("is_open"), F.col("l.rev_idx").alias("last_idx"))


def _after(timeline: DataFrame, told: DataFrame, date: Column, modified_by: Column, kind: Column, dated: Column, named: Column) -> DataFrame:
    """The timeline with the active rows of told's items closed and a new row (value) for each; told has the columns of `active_rows`."""
    hit = told.where("active_idx IS NOT NULL").select("item_id", F.col("active_idx").alias("rev_idx"), F.lit(True).alias("_hit"))
    closed = timeline.join(hit, ["item_id", "rev_idx"], "left").withColumn("valid_to", F.when(F.col("_hit") & F.col("valid_to").isNull(), closing_date(date)).otherwise(F.col("valid_to")))
    fresh = told.select(
        "item_id", (F.coalesce("last_idx", F.lit(0)) + 1).cast("int").alias("rev_idx"), "value", F.when(dated, date).alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
        F.when(named, kind).alias("mod_type"), F.when(named, modified_by).alias("modified_by_id"),
    )
    return closed.select(*COLUMNS).unionByName(fresh)


def titles_after(timeline: DataFrame, wanted: DataFrame, date: Column, modified_by: Column, override: str | None = None) -> DataFrame:
    """Titles after a merge: wanted (item_id, value) differs from the active title, or there is none.

    A title that comes with an added item or a new redaction bears no mark of its own; else a first title is an addition, dated, and
    a later one a change, to be dated with the item's revisions.
    """
    told = wanted.where("value IS NOT NULL AND value <> ''").join(active_rows(timeline), "item_id", "left").where("NOT (active <=> value)")
    kind = F.lit(override) if override else F.when(F.col("active_idx").isNull(), "add").otherwise("change")
    named = F.lit(override not in ("add", "new_redaction"))
    return _after(timeline, told, date, modified_by, kind, named & (kind == "add"), named)


def prefixes_after(timeline: DataFrame, wanted: DataFrame, date: Column, modified_by: Column, override: str | None = None) -> DataFrame:
    """Prefixes of appendices after a merge; wanted has a row for each appendix, with a null value where the new text has no prefix."""
    told = wanted.join(active_rows(timeline), "item_id", "left").where("NOT (active <=> value)")
    kind = F.when(F.col("active").isNull(), "add").when(F.col("value").isNull(), "delete").otherwise(F.lit(override or "change"))
    return _after(timeline, told.withColumn("kind", kind).withColumn("value", F.coalesce("value", F.lit(""))), date, modified_by, F.col("kind"), F.col("kind") == "add", F.lit(True))


def numbers_after(timeline: DataFrame, items: DataFrame, wanted: DataFrame, first_dates: DataFrame, date: Column, modified_by: Column, override: str | None = None) -> DataFrame:
    """Numbers of rows of tables after a merge: items (item_id, item_number), wanted (item_id, value); an item without a history of
    its number first gets the old one, from its own first date (first_dates: item_id, valid_from) on."""
    changed = wanted.where("value IS NOT NULL AND value <> ''").join(items.select("item_id", F.col("item_number").alias("old")), "item_id").where("NOT (old <=> value)")
    none = changed.join(timeline.select("item_id").distinct(), "item_id", "left_anti").join(first_dates.select("item_id", F.col("valid_from").alias("begun")), "item_id", "left")
    before = none.select("item_id", F.lit(1).alias("rev_idx"), F.col("old").alias("value"), F.coalesce("begun", date).alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(None).cast("string").alias("mod_type"), F.lit(None).cast("string").alias("modified_by_id"))
    whole = timeline.select(*COLUMNS).unionByName(before)
    told = changed.select("item_id", "value").join(active_rows(whole), "item_id", "left")
    kind = F.lit("new_redaction" if override == "new_redaction" else "change")
    return _after(whole, told, date, modified_by, kind, F.lit(True), F.lit(True))


# --- transfer


def paired_below(old: DataFrame, new: DataFrame, pairs: DataFrame) -> DataFrame:
    """old_id, new_id of pairs and, at any depth below them, of children of equal type and number (of several equal ones the last)."""
    side = lambda t, c: t.groupBy(F.col("parent_item_id").alias(f"{c}_up"), "item_type", F.coalesce("item_number", F.lit("")).alias("number")).agg(F.max_by("item_id", F.struct("place", "item_id")).alias(f"{c}_id"))
    o, n = cut(side(old, "old")), cut(side(new, "new"))
    at = cut(pairs.select("old_id", "new_id").distinct())
    levels, seen = [at], at
    for _ in count():
        up = at.select(F.col("old_id").alias("old_up"), F.col("new_id").alias("new_up"))
        found = o.join(up, "old_up").join(n, ["new_up", "item_type", "number"]).select("old_id", "new_id")
        at = cut(found.join(seen, ["old_id", "new_id"], "left_anti"))  # a tree with a cycle ends, too
        if at.isEmpty():
            return reduce(DataFrame.unionByName, levels)
        levels.append(at)
        seen = reduce(DataFrame.unionByName, levels)


def transferred(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """rows (of any table with item_id: a timeline, notes, staged markup) of the new items of pairs replaced by those of the old
    ones, where these have any. The old items' own rows stay with them. Each new_id stands once in pairs."""
    has = rows.select(F.col("item_id").alias("old_id")).distinct()
    taken = pairs.join(has, "old_id", "left_semi")
    moved = rows.join(taken.withColumnRenamed("old_id", "item_id"), "item_id").withColumn("item_id", F.col("new_id")).select(rows.columns)
    kept = rows.join(taken.select(F.col("new_id").alias("item_id")), "item_id", "left_anti")
    return kept.unionByName(moved)


def moved_pairs(old: DataFrame, new: DataFrame, gone: DataFrame, prints: tuple[DataFrame, DataFrame]) -> DataFrame:
    """old_id, new_id: old items that are gone (item_id, new_root) and the first equal one (type, number and fingerprint) anywhere below new_root.

    prints: item_id, fingerprint of both trees (`merge.fingerprints`). Each new item is taken once, by the smallest old id.
    """
    from lexstrata.operators.tree import descendants

    key = ["new_root", "item_type", "number", "fingerprint"]
    number = F.coalesce("item_number", F.lit("")).alias("number")
    o = gone.join(old.select("item_id", "item_type", number), "item_id").join(prints[0], "item_id").withColumnRenamed("item_id", "old_id")
    below = descendants(new, gone.select(F.col("new_root").alias("ancestor_id"))).select("item_id", F.col("ancestor_id").alias("new_root"), "distance")
    n = below.join(new.select("item_id", "item_type", number, "place"), "item_id").join(prints[1], "item_id")
    nth = lambda t, *order: t.withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return nth(o, "old_id").join(nth(n, "distance", "place", "item_id"), [*key, "nth"]).select("old_id", F.col("item_id").alias("new_id"))


# --- alignment


def aligned(timelines: dict[str, DataFrame]) -> DataFrame:
    """item_id, valid_from, valid_to and a column for each timeline: its value in that stretch, null where it has none.

    Every day on which a row of any timeline begins, or the day after one ends, begins a stretch. Of rows of one timeline that
    overlap, the one that began last holds (of equal ones the last in the list). One exchange by item serves all.
    Stretches in which nothing holds are left out; undated rows take no part.
    """
    events = []
    for name, t in timelines.items():
        row = F.struct("valid_from", "rev_idx", "valid_to", F.col("value").cast("string").alias("value"))
        begins = t.where("valid_from IS NOT NULL").select("item_id", F.col("valid_from").alias("day"), F.lit(name).alias("facet"), row.alias("row"))
        ends = t.where("valid_from IS NOT NULL AND valid_to IS NOT NULL").select("item_id", F.date_add("valid_to", 1).alias("day"), F.lit(None).cast("string").alias("facet"), F.lit(None).cast(begins.schema["row"].dataType).alias("row"))
        events += [begins, ends]
    each = reduce(DataFrame.unionByName, events)
    days = each.groupBy("item_id", "day").agg(*[F.max(F.when(F.col("facet") == name, F.col("row"))).alias(name) for name in timelines])
    w = Window.partitionBy("item_id").orderBy("day")
    held = days.select("item_id", F.col("day").alias("valid_from"), F.date_sub(F.lead("day").over(w), 1).alias("valid_to"), *[F.last(name, ignorenulls=True).over(w).alias(name) for name in timelines])
    value = lambda name: F.when(F.col(f"{name}.valid_to").isNull() | (F.col(f"{name}.valid_to") >= F.col("valid_from")), F.col(f"{name}.value")).alias(name)
    out = held.select("item_id", "valid_from", "valid_to", *[value(name) for name in timelines])
    return out.where(reduce(lambda a, b: a | b, [F.col(name).isNotNull() for name in timelines]))
