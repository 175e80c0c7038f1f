"""A document's tables as a whole: all checks in one call, and the repairs in their fixed order.

Tables: items (item_id, parent_item_id, item_type, item_number, item_level, depth, place), timeline (item_id, rev_idx, valid_from,
valid_to, mod_type, modified_by_id, highlights), blocks (item_id, rev_idx, ord, block_type, html_text, ref_item_id) and heads (item_id,
rev_idx, valid_to). Where ids may stand twice, all of them have `copy` (1 for the first holder of an id), so that rows
of one id are told apart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexstrata.operators import repairs, temporal, tree, verify

TABLES = ("items", "timeline", "blocks", "heads")


def refs_of(blocks: DataFrame) -> DataFrame:
    return blocks.where("ref_item_id IS NOT NULL").select("item_id", "rev_idx", "ref_item_id")


def reference_checks(items: DataFrame, blocks: DataFrame) -> DataFrame:
    """References to nothing, and children that no revision refers to."""
    refs = refs_of(blocks)
    return verify.union([
        verify.issues(tree.broken_refs(refs, items), "child_ref_broken", F.col("item_id")),
        verify.issues(tree.unreferenced_children(items, refs), "child_ref_missing", F.col("item_id"), "warning"),
    ])


def body_checks(blocks: DataFrame) -> DataFrame:
    """Bodies out of order, and blocks that hold nothing or are of no known type."""
    return verify.union([verify.issues(tree.disordered_bodies(blocks, ["item_id", "rev_idx"], "ord"), "body_order_invalid", F.col("item_id")), verify.block_checks(blocks)])


def sync_checks(timeline: DataFrame, blocks: DataFrame) -> DataFrame:
    """References of dated revisions whose child has no revision in force on their day."""
    parents = timeline.select("item_id", "rev_idx", "valid_from").join(refs_of(blocks).withColumnRenamed("ref_item_id", "child_id").hint("merge"), ["item_id", "rev_idx"])
    found = temporal.missing_children(parents, timeline)
    return found.select("category", F.lit("error").alias("severity"), F.col("item_id").cast("string").alias("element"), F.lit("").alias("message"))


def verify_document(tables: dict[str, DataFrame], changes: DataFrame | None = None, outcomes: DataFrame | None = None, log: DataFrame | None = None) -> DataFrame:
    """category, severity, element, message, step of all issues; the checks of changes (change_id, type, description), their outcomes
    (change_id, passed) and the change log (change_id, applied) run where these are given. Steps keep their numbers."""
    found = [(step, check(*(tables[t] for t in reads))) for step, reads, check in CHECKS]
    if outcomes is not None:
        found.append((8, verify.failed_changes(outcomes)))
    if log is not None:
        found.append((9, verify.change_log_checks(log)))
    if changes is not None:
        found.append((11, verify.description_checks(changes)))
    return verify.union([c.withColumn("step", F.lit(k)) for k, c in sorted(found, key=lambda x: x[0])])


#: step, the tables a check reads, and the check.
CHECKS = (
    (1, ("items",), verify.item_checks), (2, ("items", "blocks"), reference_checks), (2, ("blocks",), body_checks), (3, ("timeline", "blocks"), sync_checks),
    (4, ("items", "timeline"), verify.revision_checks), (5, ("heads",), verify.head_checks), (6, ("timeline",), verify.changer_checks), (7, ("timeline",), verify.highlight_checks),
    (10, ("blocks",), verify.inlined_children), (12, ("blocks", "timeline"), verify.inherited_references),
)


class IssueCounter:
    """Numbers of issues of one state of the tables after another: a check runs again only where a table that it reads is another one."""

    def __init__(self) -> None:
        self.known: dict[int, tuple[list[DataFrame], int]] = {}

    def __call__(self, tables: dict[str, DataFrame]) -> int:
        due = []
        for k, (_, reads, check) in enumerate(CHECKS):
            given = [tables[t] for t in reads]
            if k not in self.known or any(a is not b for a, b in zip(given, self.known[k][0], strict=True)):
                due.append(check(*given).select(F.lit(k).alias("k")))
                self.known[k] = (given, 0)
        if due:
            for k, n in verify.union(due).groupBy("k").agg(F.count("*").alias("n")).collect():
                self.known[k] = (self.known[k][0], n)
        return sum(n for _, n in self.known.values())


def fixes(amendment: Column, document: Column) -> list[tuple[str, Callable[[dict], dict]]]:
    """The repairs in their order: an id is renamed before references are looked at, so a reference still means the id's first holder."""

    def dates(t: dict) -> dict:
        return {"timeline": temporal.dated(t["timeline"], amendment, document).drop("filled")}

    def ids(t: dict) -> dict:
        if "copy" not in t["items"].columns:
            return {}
        name = F.when(F.col("copy") > 1, F.concat("item_id", F.lit("_double_"), (F.col("copy") - 1).cast("string"))).otherwise(F.col("item_id"))
        return {k: t[k].withColumn("item_id", name).withColumn("copy", F.lit(1)) for k in TABLES}

    def missing_refs(t: dict) -> dict:
        active = temporal.active_for_reading(t["timeline"]).select("item_id", "rev_idx", "mod_type")
        filled = repairs.with_missing_refs(t["blocks"], t["items"], active)
        return {"blocks": filled.withColumn("block_type", F.coalesce("block_type", F.lit("child_ref")))}

    def broken_refs(t: dict) -> dict:
        return {"blocks": repairs.without_broken_refs(t["blocks"], t["items"], t["timeline"])}

    def copies(t: dict) -> dict:
        held = t["items"].where("parent_item_id IS NOT NULL").select(F.col("parent_item_id").alias("item_id"))
        return {"items": repairs.without_empty_copies(t["items"], t["blocks"], t["heads"], held)}

    def levels(t: dict) -> dict:
        return {"items": t["items"].withColumn("item_level", F.when(F.col("item_level") != F.col("depth"), F.col("depth")).otherwise(F.col("item_level")))}

    return [("revision_valid_from_missing", dates), ("item_id_duplicate", ids), ("child_ref_missing", missing_refs), ("child_ref_broken", broken_refs), ("duplicate_item_id_empty", copies), ("item_level_invalid", levels)]


def repaired_document(tables: dict[str, DataFrame], amendment: Column, document: Column, keep: Callable[[DataFrame, str], DataFrame]) -> tuple[dict, DataFrame]:
    """The tables after all repairs, and a row for each: step, fix, issues_before, issues_after. A second run changes nothing."""
    return repairs.run_fixes(tables, fixes(amendment, document), IssueCounter(), keep)
