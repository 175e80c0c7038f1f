"""Checks that return issue rows (category, severity, element, message) and their counts.

Joins whose sides both grow with the document are sorted ones: of packed tables Spark's size check sees the files' bytes alone, so it
would gather millions of ids in the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexstrata.functions.dates import bad_date, valid_format

# Item types and changes a document may have.
ITEM_TYPES = ("section", "chapter", "article", "part", "point", "subpoint", "preamble", "appendix", "nested_appendix", "structured_table", "paragraph")
MOD_TYPES = ("add", "change", "new_redaction", "delete")
BLOCK_TYPES = ("paragraph", "table", "table_header", "table_fragment", "child_ref")


def issues(rows: DataFrame, category: str, element: Column, severity: str = "error", message: str = "") -> DataFrame:
    return rows.select(F.lit(category).alias("category"), F.lit(severity).alias("severity"), element.cast("string").alias("element"), F.lit(message).alias("message"))


def union(found: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, found)


def item_checks(items: DataFrame) -> DataFrame:
    """Ids that are missing or stand twice (one issue for each further one), types and levels that are wrong."""
    own = F.col("item_id")
    twice = items.where("item_id IS NOT NULL").groupBy("item_id").agg(F.count("*").alias("n")).where("n > 1").withColumn("_", F.explode(F.sequence(F.lit(2), F.col("n"))))
    return union([
        issues(items.where("item_id IS NULL"), "item_id_missing", F.lit(None)),
        issues(twice, "item_id_duplicate", own),
        issues(items.where(~F.coalesce(F.col("item_type").isin(*ITEM_TYPES), F.lit(False))), "item_type_invalid", own),
        issues(items.where("item_level IS NULL OR item_level <> depth"), "item_level_invalid", own),
    ])


def revision_checks(items: DataFrame, timeline: DataFrame) -> DataFrame:
    """Items without revisions, revisions without a date, written dates of a wrong form, more than one open revision, gaps."""
    from lexstrata.operators.temporal import active_conflicts, continuity_gaps

    own = F.col("item_id")
    return union([
        issues(items.select("item_id").distinct().join(timeline.select("item_id").distinct().hint("merge"), "item_id", "left_anti"), "revision_missing", own),
        issues(timeline.where("valid_from IS NULL"), "revision_valid_from_missing", own),
        issues(active_conflicts(timeline), "revision_active_conflict", own),
        issues(continuity_gaps(timeline), "date_continuity", own, "warning"),
    ])


def date_form_checks(rows: DataFrame, key: str, *texts: str) -> DataFrame:
    return union([issues(rows.where(~valid_format(F.col(t))), "date_format_invalid", F.col(key)) for t in texts])


def preflight_dates(sources: DataFrame, key: str, text: str) -> DataFrame:
    """Source documents whose date is missing or isn't one."""
    blank = F.trim(F.coalesce(F.col(text), F.lit(""))) == ""
    return union([issues(sources.where(blank), "source_date_missing", F.col(key)), issues(sources.where(bad_date(F.col(text))), "source_date_invalid", F.col(key))])


def changer_checks(timeline: DataFrame) -> DataFrame:
    """modified_by_id that is a bare number, or isn't a list of ids of the form number_type_number..."""
    given = timeline.where("modified_by_id IS NOT NULL")
    bare = F.col("modified_by_id").rlike("^\\d+$")
    form = F.forall(F.split("modified_by_id", ",\\s*"), lambda x: x.rlike("^\\d+(_[a-z]+(_[0-9]+)*)+$"))
    return union([issues(given.where(bare), "modified_by_id_bare", F.col("item_id")), issues(given.where(~bare & ~form), "modified_by_id_format", F.col("item_id"), "warning")])


def description_checks(changes: DataFrame, long: int = 500) -> DataFrame:
    """Instructions that hold whole fragments: long ones (warning), any for a new wording (error)."""
    whole = F.col("description").rlike("(?is)<p[^>]*>.*</p>")
    return union([
        issues(changes.where(whole & (F.length("description") > long)), "description_contains_full_html", F.col("change_id"), "warning"),
        issues(changes.where(whole & (F.col("type") == "new_redaction")), "description_contains_full_html_for_new_redaction", F.col("change_id")),
    ])


def inlined_children(blocks: DataFrame) -> DataFrame:
    """Revisions with references that also hold a block of more than one paragraph."""
    many = F.size(F.regexp_extract_all("html_text", F.lit("(?i)<p[ >]"), 0)) > 1
    found = blocks.groupBy("item_id", "rev_idx").agg(F.bool_or(F.col("ref_item_id").isNotNull()).alias("refers"), F.bool_or(F.coalesce(many, F.lit(False))).alias("many"))
    return issues(found.where("refers AND many"), "children_inlined_in_body", F.col("item_id"), "warning")


def block_checks(blocks: DataFrame) -> DataFrame:
    """Blocks of an unknown type, and blocks that hold neither text nor a reference."""
    known = F.coalesce(F.col("block_type").isin(*BLOCK_TYPES), F.lit(False))
    empty = F.when(F.col("block_type") == "child_ref", F.col("ref_item_id").isNull()).otherwise(F.col("html_text").isNull())
    return union([issues(blocks.where(~known), "body_block_type_unknown", F.col("item_id")), issues(blocks.where(known & empty), "body_block_invalid", F.col("item_id"), "warning")])


def head_checks(heads: DataFrame) -> DataFrame:
    """Titles with more than one open revision."""
    from lexstrata.operators.temporal import active_conflicts

    return issues(active_conflicts(heads), "head_revision_active_conflict", F.col("item_id"), "warning")


def highlight_checks(timeline: DataFrame) -> DataFrame:
    """Highlights (JSON text) that aren't an object."""
    kind = F.schema_of_variant(F.try_parse_json("highlights"))
    return issues(timeline.where(F.col("highlights").isNotNull() & ~F.coalesce(kind.startswith("OBJECT"), F.lit(False))), "highlights_invalid", F.col("item_id"), "warning")


def inherited_references(blocks: DataFrame, timeline: DataFrame) -> DataFrame:
    """References of a new wording that the revision before it had too, though the child has no open revision."""
    refs = blocks.where("ref_item_id IS NOT NULL").select("item_id", "rev_idx", "ref_item_id").distinct()
    listed = Window.partitionBy("item_id").orderBy("rev_idx")
    next_ = timeline.select("item_id", "rev_idx").distinct().withColumn("next_idx", F.lead("rev_idx").over(listed))  # places may have gaps
    before = refs.join(next_.where("next_idx IS NOT NULL").hint("merge"), ["item_id", "rev_idx"]).select("item_id", F.col("next_idx").alias("rev_idx"), "ref_item_id")
    wordings = timeline.where("mod_type = 'new_redaction'").select("item_id", "rev_idx")
    kept = refs.join(wordings.hint("merge"), ["item_id", "rev_idx"]).join(before.hint("merge"), ["item_id", "rev_idx", "ref_item_id"], "left_semi")
    open_ = timeline.where("valid_to IS NULL").select(F.col("item_id").alias("ref_item_id")).distinct()
    return issues(kept.join(open_.hint("merge"), "ref_item_id", "left_anti"), "revision_body_source_violation", F.col("item_id"))


def change_log_checks(log: DataFrame) -> DataFrame:
    """Changes that were not applied."""
    return issues(log.where(~F.coalesce(F.col("applied"), F.lit(False))), "change_skipped", F.col("change_id"), "warning")


def change_log_counts(log: DataFrame) -> DataFrame:
    return log.groupBy(F.coalesce("type", F.lit("unknown")).alias("type")).agg(F.count("*").alias("n"))


def outcomes_by_kind(changes: DataFrame, timelines: DataFrame) -> DataFrame:
    """change_id, passed of routed changes (see `router`): what each kind of target must show afterwards.

    A prefix always passes. A deletion needs a revision that is deleted or not valid, a title one of a change or
    new wording, a preamble its active one of any change, an addition at the root any added item, content
    a revision of the change's own kind from the change's day on. Unresolved changes fail.
    """
    from lexstrata.operators.temporal import active_for_reading

    key = F.concat_ws("\u0001", "scope", "item_id")
    t = timelines.withColumn("key", key)
    active = active_for_reading(t.withColumn("item_id", F.col("key"))).select("key", "rev_idx", F.lit(True).alias("active"))
    shown = t.join(active, ["key", "rev_idx"], "left").select("key", F.col("mod_type"), F.col("not_valid"), F.col("valid_from").alias("since"), F.coalesce("active", F.lit(False)).alias("active"))
    joined = changes.withColumn("key", key).join(shown, "key", "left")
    fits = (
        F.when(F.col("type") == "delete", (F.col("mod_type") == "delete") | F.col("not_valid").isNotNull())
        .when(F.col("scope").isin("title", "element_title"), F.col("mod_type").isin("change", "new_redaction"))
        .when(F.col("scope") == "preamble", F.col("active") & F.col("mod_type").isin("new_redaction", "change", "delete"))
        .when(F.col("scope") == "root_addition", F.col("mod_type") == "add")
        .otherwise((F.col("mod_type") == F.when(F.col("type").isin(*MOD_TYPES), F.col("type")).otherwise("new_redaction")) & (F.col("since") >= F.col("valid_from")))
    )
    passed_ = F.when(F.col("scope") == "prefix", True).when((F.col("scope") == "unresolved") | F.col("item_id").isNull(), False).otherwise(F.coalesce(F.col("fits"), F.lit(False)))
    return joined.withColumn("fits", fits).withColumn("ok", passed_).groupBy("change_id").agg(F.bool_or("ok").alias("passed"))


def failed_changes(outcomes: DataFrame) -> DataFrame:
    return issues(outcomes.where("NOT passed"), "change_not_applied", F.col("change_id"))


def reference_issues(items: DataFrame, refs: DataFrame) -> DataFrame:
    """Duplicate ids and references to nothing."""
    from lexstrata.operators.tree import broken_refs, duplicate_ids

    return union([issues(duplicate_ids(items), "duplicate_item_id", F.col("item_id")), issues(broken_refs(refs, items), "broken_child_ref", F.col("ref_item_id"))])


def preflight(sources: DataFrame, key: str, text: str, items: DataFrame, refs: DataFrame) -> DataFrame:
    """Everything that must hold before a run."""
    return preflight_dates(sources, key, text).unionByName(reference_issues(items, refs))


def verified(checks: list[DataFrame]) -> DataFrame:
    """All issues of checks in their fixed order, with step."""
    return union([c.withColumn("step", F.lit(k + 1)) for k, c in enumerate(checks)])


def as_json(found: DataFrame) -> DataFrame:
    """issue: each row as a JSON object."""
    return found.select(F.to_json(F.struct(*found.columns)).alias("issue"))


def stats(found: DataFrame) -> DataFrame:
    """severity, category, n; with subtotals (null category) and the total (null severity)."""
    return found.rollup("severity", "category").agg(F.count("*").alias("n"))


def passed(found: DataFrame) -> DataFrame:
    """One row: whether there is no error."""
    return found.agg(F.coalesce(~F.bool_or(F.col("severity") == "error"), F.lit(True)).alias("passed"))
