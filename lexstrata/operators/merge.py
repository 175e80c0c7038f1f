"""Identity of subtrees and the merge of a tree with a new version of it, history kept.

Item tables: item_id, parent_item_id, item_type, item_number, place, text (the cleaned paragraphs of the active
revision), head. A merge gives actions; `history_rows` turns them into ends and new revisions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexstrata.functions.dates import closing_date
from lexstrata.functions.numbers import item_number
from lexstrata.functions.text import squeezed
from lexstrata.session import cut


def canonical(value: Column) -> Column:
    return squeezed(F.regexp_replace(F.coalesce(value, F.lit("")), "<[^>]+>", ""))


def fingerprints(items: DataFrame) -> DataFrame:
    """item_id, fingerprint: equal for subtrees with equal types, numbers and texts in the same order; heads and references don't count.

    Level by level from the leaves: a round prints every item all of whose children are printed. Items
    of a cycle get none.
    """
    own = items.select("item_id", "parent_item_id", "place", F.concat_ws("|", "item_type", item_number(F.col("item_type"), F.col("item_number")), canonical(F.col("text"))).alias("own"))
    n = own.where("parent_item_id IS NOT NULL").groupBy(F.col("parent_item_id").alias("item_id")).agg(F.count("*").alias("n"))
    none = F.expr("cast(array() AS array<struct<place: bigint, fingerprint: string>>)").cast(T.ArrayType(T.StructType([items.schema["place"], T.StructField("fingerprint", T.StringType())])))
    left = cut(own.join(n, "item_id", "left").select("item_id", "parent_item_id", "place", "own", F.coalesce("n", F.lit(0)).alias("n"), none.alias("kids")))
    ready = left.where("n = 0").select("item_id", "parent_item_id", "place", F.md5("own").alias("fingerprint"))
    left = left.where("n > 0")
    printed = []
    while not ready.isEmpty():
        printed.append(ready.select("item_id", "fingerprint"))
        more = ready.where("parent_item_id IS NOT NULL").groupBy(F.col("parent_item_id").alias("item_id")).agg(F.collect_list(F.struct("place", "fingerprint")).alias("more"))
        # an item keeps its children's prints until all are there: prints aren't gathered again each round
        told = cut(left.join(more, "item_id", "left").withColumn("kids", F.concat("kids", F.coalesce("more", none))).drop("more"))
        below = F.array_join(F.transform(F.array_sort("kids"), lambda x: x["fingerprint"]), "")
        ready = told.where(F.size("kids") == F.col("n")).select("item_id", "parent_item_id", "place", F.md5(F.concat("own", F.lit("/"), below)).alias("fingerprint"))
        left = told.where(F.size("kids") < F.col("n"))
    return reduce(DataFrame.unionByName, printed) if printed else ready.select("item_id", "fingerprint")


def identical(a: DataFrame, b: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (old_id, new_id) with identical: equal fingerprints, and equal heads where both have one."""
    side = lambda items, c: items.select(F.col("item_id").alias(f"{c}_id"), canonical(F.col("head")).alias(f"{c}_head")).join(fingerprints(items).select(F.col("item_id").alias(f"{c}_id"), F.col("fingerprint").alias(f"{c}_print")), f"{c}_id")
    both = pairs.join(side(a, "old"), "old_id").join(side(b, "new"), "new_id")
    heads = (F.col("old_head") == "") | (F.col("new_head") == "") | (F.col("old_head") == F.col("new_head"))
    return both.select("old_id", "new_id", (heads & (F.col("old_print") == F.col("new_print"))).alias("identical"))


def merged(old: DataFrame, new: DataFrame, roots: DataFrame) -> DataFrame:
    """Actions of a merge below pairs of roots (old_id, new_id): old_id, new_id, action, top, head_changed, depth.

    Children of a pair are paired by (type, number), of several equal ones the first with the first and so
    on. keep, change (its text differs, or a child is added), add (new only, with all below it), close (old
    only: it ends and is not valid, what is below stays as it is), moved (old only, but its like stands
    elsewhere below the same new parent: it ends, the new one begins).
    """
    nth = lambda t: t.withColumn("nth", F.row_number().over(Window.partitionBy("parent_item_id", "item_type", "item_number").orderBy("place", "item_id")))
    o = cut(nth(old).select(F.col("item_id").alias("old_id"), F.col("parent_item_id").alias("old_up"), "item_type", "item_number", "nth", canonical(F.col("text")).alias("old_text"), canonical(F.col("head")).alias("old_head")))
    n = cut(nth(new).select(F.col("item_id").alias("new_id"), F.col("parent_item_id").alias("new_up"), "item_type", "item_number", "nth", canonical(F.col("text")).alias("new_text"), canonical(F.col("head")).alias("new_head")))
    at = cut(roots.select("old_id", "new_id", F.lit(1).alias("depth"), F.lit(True).alias("top")))
    levels = [at]
    while True:
        pairs = at.where("old_id IS NOT NULL AND new_id IS NOT NULL").select(F.col("old_id").alias("old_up"), F.col("new_id").alias("new_up"))
        added = at.where("old_id IS NULL").select("new_id")
        below_old = o.join(pairs, "old_up").select("old_up", "new_up", "old_id", "item_type", "item_number", "nth")
        below_new = n.join(pairs, "new_up").select("old_up", "new_up", "new_id", "item_type", "item_number", "nth")
        keys = ["old_up", "new_up", "item_type", "item_number", "nth"]
        safe = lambda t: t.withColumn("item_number", F.coalesce("item_number", F.lit("\u0000")))
        both = safe(below_old).join(safe(below_new), keys, "full_outer").select("old_id", "new_id")
        inside = n.join(added.select(F.col("new_id").alias("new_up")), "new_up").select(F.lit(None).cast("string").alias("old_id"), "new_id")
        at = both.unionByName(inside).select("old_id", "new_id", F.lit(len(levels) + 1).alias("depth"), F.lit(False).alias("top"))
        seen = reduce(DataFrame.unionByName, levels).select(F.col("old_id").alias("o"), F.col("new_id").alias("n"))
        at = cut(at.join(seen, F.col("old_id").eqNullSafe(F.col("o")) & F.col("new_id").eqNullSafe(F.col("n")), "left_anti"))  # an item below itself ends the walk
        if at.isEmpty():
            break
        levels.append(at)
    rows = reduce(DataFrame.unionByName, levels).join(o.drop("item_type", "item_number", "nth"), "old_id", "left").join(n.drop("item_type", "item_number", "nth"), "new_id", "left")
    rows = cut(rows)
    grown = rows.where("old_id IS NULL").select(F.col("new_up").alias("new_id")).distinct().withColumn("grown", F.lit(True))
    likes = n.where("item_type <> ''").select("new_id", "item_type", "item_number", "new_text")
    gone = rows.where("new_id IS NULL").select("old_id", "old_up", "old_text").join(o.select("old_id", "item_type", "item_number"), "old_id")
    kin = rows.where("old_id IS NULL").select("new_id", "new_up").join(likes, "new_id")
    # the pair of an old item's parent, and what is new below that pair's new item, one or two levels down
    up = rows.where("old_id IS NOT NULL AND new_id IS NOT NULL").select(F.col("old_id").alias("old_up"), F.col("new_id").alias("pair_id"))
    fresh = kin.select(F.col("new_up").alias("pair_id"), "item_type", "item_number", "new_text").unionByName(kin.join(n.select(F.col("new_id").alias("new_up"), F.col("new_up").alias("pair_id")), "new_up").select("pair_id", "item_type", "item_number", "new_text"))
    moved = gone.join(up, "old_up").join(fresh.distinct(), ["pair_id", "item_type", "item_number"], "inner").where("old_text = new_text").select("old_id").distinct().withColumn("is_moved", F.lit(True))
    out = rows.join(grown, "new_id", "left").join(moved, "old_id", "left")
    paired = F.col("old_id").isNotNull() & F.col("new_id").isNotNull()
    differs = (F.col("old_text") != F.col("new_text")) | F.coalesce("grown", F.lit(False))
    action = F.when(paired & differs, "change").when(paired, "keep").when(F.col("old_id").isNull(), "add").when(F.coalesce("is_moved", F.lit(False)), "moved").otherwise("close")
    head = paired & (F.col("new_head") != "") & (F.col("old_head") != F.col("new_head"))
    return out.select("old_id", "new_id", action.alias("action"), "top", head.alias("head_changed"), "depth")


def history_rows(actions: DataFrame, timeline: DataFrame, date: Column, modified_by: Column, placeholders: DataFrame | None = None) -> DataFrame:
    """The timeline of merged items after a merge: nothing is lost.

    timeline: item_id, rev_idx, valid_from, valid_to, mod_type, modified_by_id, not_valid. change closes the last
    open revision the day before and appends one (new_redaction at the top, change below); add appends
    the first one; close and moved end the open one, not valid. Other items stay as they are. The open revision of a placeholder (item_id),
    made for an addition before its content was known, never was in force: it ends as not valid when the content comes.
    """
    last = timeline.groupBy("item_id").agg(F.max("rev_idx").alias("last_idx"), F.max(F.when(F.col("valid_to").isNull(), F.col("rev_idx"))).alias("open_idx"))
    acts = actions.where("action <> 'keep'").select(F.coalesce("old_id", "new_id").alias("item_id"), "action", "top")
    joined = timeline.join(acts, "item_id", "left").join(last.select("item_id", "open_idx"), "item_id", "left")
    stubs = (placeholders if placeholders is not None else acts.where("false")).select("item_id", F.lit(True).alias("stub")).distinct()
    joined = joined.join(stubs, "item_id", "left").withColumn("stub", F.coalesce("stub", F.lit(False)))
    hit = F.col("action").isin("change", "close", "moved") & (F.col("rev_idx") == F.col("open_idx"))
    hit = F.coalesce(hit, F.lit(False))
    closed = joined.withColumn("valid_to", F.when(hit, closing_date(date)).otherwise(F.col("valid_to"))).withColumn("not_valid", F.when(hit & (F.col("action").isin("close", "moved") | F.col("stub")), F.date_format(date, "yyyy-MM-dd")).otherwise(F.col("not_valid")))
    kind = F.when(F.col("action") == "add", "add").when(F.col("top"), "new_redaction").otherwise("change")
    fresh = acts.where("action IN ('change', 'add')").join(last, "item_id", "left").select("item_id", (F.coalesce("last_idx", F.lit(0)) + 1).cast("int").alias("rev_idx"), date.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), kind.alias("mod_type"), modified_by.alias("modified_by_id"), F.lit(None).cast("string").alias("not_valid"))
    return closed.select(*fresh.columns).unionByName(fresh)


def earliest_dated(timeline: DataFrame, otherwise: Column) -> DataFrame:
    """item_id, valid_from: that of the first dated revision in the list, else the given date."""
    first = timeline.groupBy("item_id").agg(F.min_by("valid_from", F.when(F.col("valid_from").isNotNull(), F.col("rev_idx"))).alias("d"))
    return first.select("item_id", F.coalesce("d", otherwise).alias("valid_from"))


def with_first_dates(timeline: DataFrame, date: Column, modified_by: Column, mod_type: str = "add") -> DataFrame:
    """Items none of whose revisions is dated get date, changer and kind in their first one."""
    w = Window.partitionBy("item_id")
    bare = F.count("valid_from").over(w) == 0
    hit = bare & (F.col("rev_idx") == F.min("rev_idx").over(w))
    marked = timeline.withColumn("hit", hit)
    put = lambda c, v: F.when(F.col("hit"), v).otherwise(F.col(c))
    return marked.withColumn("valid_from", put("valid_from", date)).withColumn("modified_by_id", put("modified_by_id", modified_by)).withColumn("mod_type", F.when(F.col("hit"), F.coalesce("mod_type", F.lit(mod_type))).otherwise(F.col("mod_type"))).drop("hit")
