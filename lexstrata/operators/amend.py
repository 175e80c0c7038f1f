"""Amendments as slowly changing history: a revision is closed, never lost.

Changes: item_id, seq, type (add, change, new_redaction, delete), new_value, valid_from. Timelines
as in `temporal`, with value, mod_type, modified_by_id, not_valid. All functions return the rows
to append and, where they close some, those with their new end; `applied` gives the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexstrata.functions.dates import closing_date, parse_date
from lexstrata.operators.temporal import active_for_writing, first_of


def applied(timeline: DataFrame, changes: DataFrame) -> DataFrame:
    """The timeline after the changes of all items, several for one item in the order of seq.

    delete closes the active revision and marks it not valid; change and new_redaction close it and
    append one; add appends. What is open, from before or from additions among the changes, closes at the first later
    change that is no addition. A change other than add of an item without revisions is left out here
    (see `unresolved`). A revision already closed keeps its end.
    """
    active = active_for_writing(timeline).select(F.col("item_id").alias("a_item"), F.col("rev_idx").alias("a_idx"))
    known = changes.join(active, F.col("item_id") == F.col("a_item"), "left").where("a_item IS NOT NULL OR type = 'add'")
    w = Window.partitionBy("item_id").orderBy("seq")
    later = F.first(F.when(F.col("type") != "add", F.struct("type", "valid_from")), ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    closing = F.when(F.col("type") != "add", F.row_number().over(Window.partitionBy("item_id", F.col("type") == "add").orderBy("seq")))
    steps = known.withColumn("next", later).withColumn("k", closing)
    first = steps.where("k = 1").select("item_id", F.col("type").alias("c_type"), F.col("valid_from").alias("c_from"), "a_idx")
    closed = timeline.join(first, "item_id", "left")
    hit = F.col("a_idx").isNotNull() & (F.col("rev_idx") == F.col("a_idx"))
    closed = closed.withColumn("valid_to", F.when(hit & F.col("valid_to").isNull(), closing_date(F.col("c_from"))).otherwise(F.col("valid_to")))
    closed = closed.withColumn("not_valid", F.when(hit & (F.col("c_type") == "delete"), F.date_format("c_from", "yyyy-MM-dd")).otherwise(F.col("not_valid"))).select(*timeline.columns)
    last = timeline.groupBy("item_id").agg(F.max("rev_idx").alias("last_idx"))
    fresh = steps.where("type <> 'delete'").join(last, "item_id", "left")
    place = F.coalesce("last_idx", F.lit(0)) + F.row_number().over(Window.partitionBy("item_id").orderBy("seq"))
    ends = closing_date(F.col("next.valid_from"))
    gone = F.when(F.col("next.type") == "delete", F.date_format("next.valid_from", "yyyy-MM-dd"))
    rows = fresh.withColumn("rev_idx", place).withColumn("valid_to", ends).withColumn("not_valid", gone)
    new = rows.select("item_id", F.col("rev_idx").cast("int").alias("rev_idx"), "valid_from", "valid_to", F.col("new_value").alias("value"), F.col("type").alias("mod_type"), "modified_by_id", "not_valid")
    return closed.select(new.columns).unionByName(new)


def unresolved(timeline: DataFrame, changes: DataFrame) -> DataFrame:
    """Changes, other than additions, of items that aren't there: issues, never writes."""
    return changes.where("type <> 'add'").join(timeline.select("item_id").distinct(), "item_id", "left_anti")


def revoked(timeline: DataFrame, revocations: DataFrame) -> DataFrame:
    """Revocations (item_id, valid_from): the open revision closes and is not valid; an empty delete revision follows."""
    r = revocations.select("item_id", F.col("valid_from").alias("r_from"))
    active = active_for_writing(timeline).join(r, "item_id")
    closed = active.select("item_id", "rev_idx", F.lit("closed").alias("step"), F.col("valid_from"), F.coalesce("valid_to", closing_date(F.col("r_from"))).alias("valid_to"), F.lit(True).alias("not_valid"))
    added = active.select("item_id", (F.col("rev_idx") + 1).alias("rev_idx"), F.lit("delete").alias("step"), F.col("r_from").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(False).alias("not_valid"))
    return closed.unionByName(added)


def specially_dated(timeline: DataFrame, dates: DataFrame) -> DataFrame:
    """Special dates (item_id, valid_from): the open revision closes the day before, an empty new wording starts."""
    r = dates.select("item_id", F.col("valid_from").alias("r_from"))
    active = active_for_writing(timeline).join(r, "item_id")
    closed = active.select("item_id", "rev_idx", F.lit("closed").alias("step"), "valid_from", closing_date(F.col("r_from")).alias("valid_to"))
    return closed.unionByName(active.select("item_id", (F.col("rev_idx") + 1).alias("rev_idx"), F.lit("new_redaction").alias("step"), F.col("r_from").alias("valid_from"), F.lit(None).cast("date").alias("valid_to")))


def with_notes(notes: DataFrame, dates: DataFrame, text: Column) -> DataFrame:
    """Notes with one more for each retroactive date."""
    return notes.unionByName(dates.select("item_id", text.alias("note"), "valid_from"))


def outcomes(changes: DataFrame, timeline: DataFrame) -> DataFrame:
    """item_id, seq, passed: a change passes if the item has a revision of its kind from its date on (a deletion: one not valid)."""
    t = timeline.select(F.col("item_id").alias("t_item"), F.col("mod_type"), F.col("valid_from").alias("t_from"), "not_valid")
    fits = F.when(F.col("type") == "delete", F.col("not_valid").isNotNull()).otherwise((F.col("mod_type") == F.col("type")) & (F.col("t_from") == F.col("valid_from")))
    joined = changes.join(t, F.col("item_id") == F.col("t_item"), "left")
    return joined.groupBy("item_id", "seq", "type").agg(F.coalesce(F.bool_or(fits), F.lit(False)).alias("passed"))


def chain_order(documents: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """step of each document among those of its chain; 1 is the target, the rest amend it in turn."""
    return documents.withColumn("step", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def document_number(number: Column) -> Column:
    """The first run of digits of a document's number, else 0."""
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(F.coalesce(number, F.lit("")), "(\\d{1,18})", 1), F.lit("")), F.lit("999999999999999999")).cast("long"), F.lit(0).cast("long"))


def document_date(*texts: Column) -> Column:
    """The first of several written dates that is one, else the last day there is."""
    return F.coalesce(*[parse_date(t) for t in texts], F.lit("9999-12-31").cast("date"))


def chain_scan(documents: DataFrame, folder: str, name: str) -> DataFrame:
    """Documents (number, date_signed, date_pub, valid_from, is_target) with step among those of their folder.

    1 is the target: the flagged one, else the first by date, number and name; the others amend it in that order.
    """
    order = (F.desc("is_target"), document_date(F.col("date_signed"), F.col("date_pub"), F.col("valid_from")), document_number(F.col("number")), F.col(name))
    return chain_order(documents, [folder], *order)


def stage_answers(changes: DataFrame, answers: DataFrame) -> DataFrame:
    """Each change with the next unused answer of its key: the n-th change of a key takes the n-th answer."""
    k = F.row_number().over(Window.partitionBy("base_key").orderBy("seq")) - 1
    return changes.withColumn("pos", k.cast("int")).join(answers, ["base_key", "pos"], "left")


def newest_of(rows: DataFrame, keys: list[str], when: str) -> DataFrame:
    return first_of(rows, keys, F.desc(when))
