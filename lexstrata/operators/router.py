"""Where a change goes: document title, element title, preamble, prefix, content, or nowhere; and its history there.

Changes: change_id, seq, type, structural (path text), item_id (what the path leads to, or null), new_value,
valid_from, modified_by_id. All kinds of targets share one form of timeline, keyed by (scope, item_id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexstrata.functions.text import squeezed, without_tags
from lexstrata.operators.amend import applied

TITLE, ELEMENT_TITLE, PREAMBLE, PREFIX, CONTENT, ROOT_ADDITION, UNRESOLVED = "title", "element_title", "preamble", "prefix", "content", "root_addition", "unresolved"


def scope(structural: Column, kind: Column, item_id: Column) -> Column:
    """The target of a change, first rule that fits. The prefix is asked for before the content that bears it."""
    low = F.lower(squeezed(structural))
    return (
        F.when(low.endswith(" префикс"), PREFIX)
        .when(low == "наименование", TITLE)
        .when(low.endswith(" наименование"), ELEMENT_TITLE)
        .when(low.startswith("преамбул"), PREAMBLE)
        .when((kind == "add") & (low == "нпа"), ROOT_ADDITION)
        .when(item_id.isNotNull(), CONTENT)
        .otherwise(UNRESOLVED)
    )


def routed(changes: DataFrame) -> DataFrame:
    """changes with scope. Titles and the preamble belong to the document: their item_id is the npa_id."""
    where = scope(F.col("structural"), F.col("type"), F.col("item_id"))
    own = changes.withColumn("scope", where)
    return own.withColumn("item_id", F.when(F.col("scope").isin(TITLE, PREAMBLE, ROOT_ADDITION), F.col("npa_id").cast("string")).otherwise(F.col("item_id")))


def target_path(structural: Column) -> Column:
    """The path text of the element whose title or prefix a change names."""
    return F.regexp_replace(squeezed(structural), "(?iu)\\s+(наименование|префикс)$", "")


def refused(changes: DataFrame) -> DataFrame:
    """Routed changes that write nothing: unresolved ones, and titles or prefixes that are to be deleted."""
    return changes.where((F.col("scope") == UNRESOLVED) | F.col("item_id").isNull() | (F.col("scope").isin(TITLE, ELEMENT_TITLE) & ~F.col("type").isin("change", "new_redaction")))


def applied_everywhere(timelines: DataFrame, changes: DataFrame) -> DataFrame:
    """timelines (scope, item_id, rev_idx, valid_from, valid_to, value, mod_type, modified_by_id, not_valid) after routed changes.

    Titles are written without tags. A prefix or title that is what it was already writes nothing.
    """
    live = changes.join(refused(changes).select("change_id"), "change_id", "left_anti")
    text = F.when(F.col("scope").isin(TITLE, ELEMENT_TITLE, PREFIX), without_tags(F.col("new_value"))).otherwise(F.col("new_value"))
    live = live.withColumn("new_value", text)
    now = timelines.where("valid_to IS NULL").groupBy("scope", "item_id").agg(F.max_by("value", "rev_idx").alias("now"))
    live = live.join(now, ["scope", "item_id"], "left").where(~(F.col("scope").isin(TITLE, ELEMENT_TITLE, PREFIX) & F.coalesce(F.col("now") == F.col("new_value"), F.lit(False))))
    key = F.concat_ws("\u0001", "scope", "item_id")
    rows = applied(timelines.withColumn("item_id", key).drop("scope"), live.select(key.alias("item_id"), "seq", "type", "new_value", "valid_from", "modified_by_id"))
    parts = F.split("item_id", "\u0001")
    return rows.withColumn("scope", parts[0]).withColumn("item_id", parts[1]).select("scope", *[c for c in rows.columns])


def recovered(failed: DataFrame, mappings: DataFrame, again: DataFrame) -> DataFrame:
    """Failed changes (change_id, element) that may be tried again: with the item a reliable mapping knows, else the one found anew.

    mappings: element, item_id; again: change_id, item_id.
    """
    known = mappings.select("element", F.col("item_id").alias("known"))
    found = again.select("change_id", F.col("item_id").alias("anew"))
    out = failed.join(known, "element", "left").join(found, "change_id", "left")
    return out.select("change_id", "element", F.coalesce("known", "anew").alias("item_id"), F.when(F.col("known").isNotNull(), "mapping").otherwise("path").alias("source")).where("item_id IS NOT NULL")
