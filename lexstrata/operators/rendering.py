"""Items as whole markup, and the markup that a rebuild of pending items starts from.

items: item_id, parent_item_id, item_type, item_number; heads and prefixes: timelines of item_id, rev_idx, valid_to and
head_text or prefix_text; revisions: item_id, rev_idx, valid_to; blocks: item_id, rev_idx, ord, type, html_text,
ref_item_id. Only open revisions are shown; where several are open, the last in the list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexstrata.functions import numbers, text
from lexstrata.operators.bodies import rendered_tree, renumbered
from lexstrata.operators.tree import ancestors
from lexstrata.session import cut

HEADED = ("article", "chapter", "section", "appendix")
COUNTED = ("part", "point", "subpoint")
SHOWN = ("paragraph", "table_fragment", "table_header")


def newest_open(timeline: DataFrame, *columns: str, blank_is_open: bool = False) -> DataFrame:
    """item_id and columns of each item's last open row."""
    is_open = F.col("valid_to").isNull()
    if blank_is_open:
        is_open = is_open | (F.trim(F.col("valid_to").cast("string")) == "")
    row = F.max_by(F.struct(*columns), "rev_idx")
    return timeline.where(is_open).groupBy("item_id").agg(row.alias("r")).select("item_id", "r.*")


def current_heads(items: DataFrame, heads: DataFrame, revisions: DataFrame) -> DataFrame:
    """item_id, head: the last open title, else the last title; items without titles take the item_head of their revision likewise; else ''."""
    last = lambda df, c: df.groupBy("item_id").agg(F.max_by(c, "rev_idx").alias("last"))
    own = newest_open(heads, "head_text", blank_is_open=True).withColumnRenamed("head_text", "open").join(last(heads, "head_text"), "item_id", "right")
    inner = newest_open(revisions, "item_head", blank_is_open=True).withColumnRenamed("item_head", "r_open").join(last(revisions, "item_head").withColumnRenamed("last", "r_last"), "item_id", "right")
    titled = own.select("item_id", F.lit(True).alias("titled"), F.coalesce("open", "last").alias("title"))
    both = items.select("item_id").join(titled, "item_id", "left").join(inner, "item_id", "left")
    return both.select("item_id", F.coalesce(F.when(F.col("titled"), F.col("title")).otherwise(F.coalesce("r_open", "r_last")), F.lit("")).alias("head"))


def active_prefixes(items: DataFrame, prefixes: DataFrame) -> DataFrame:
    """item_id, prefix of appendices: the last open one, else the last."""
    last = prefixes.groupBy("item_id").agg(F.max_by("prefix_text", "rev_idx").alias("last"))
    both = items.where("item_type = 'appendix'").select("item_id").join(last, "item_id").join(newest_open(prefixes, "prefix_text"), "item_id", "left")
    return both.select("item_id", F.coalesce("prefix_text", "last").alias("prefix"))


def open_blocks(revisions: DataFrame, blocks: DataFrame) -> DataFrame:
    """The blocks of each item's last open revision."""
    at = newest_open(revisions.withColumn("at", F.col("rev_idx")), "at")
    return blocks.join(at.withColumnRenamed("at", "rev_idx"), ["item_id", "rev_idx"], "left_semi")


def header_line(item_type: Column, number: Column, head: Column, prefix: Column) -> Column:
    """'<p><b>Type N. Title</b></p>' of headed items; an appendix with a prefix has that instead; else null."""
    words = {t: w.capitalize() for w, t in text.TYPE_NAMES.items() if t in HEADED}
    titled = F.coalesce(F.trim(head), F.lit("")) != ""
    shown = numbers.shown_number(number, F.lit(True), titled)
    line = F.concat(F.lit("<p><b>"), F.element_at(text.literal_map(words), item_type), F.lit(" "), shown, F.when(titled, F.concat(F.lit(" "), F.trim(head))).otherwise(""), F.lit("</b></p>"))
    own = (item_type == "appendix") & (F.coalesce(prefix, F.lit("")) != "")
    return F.when(item_type.isin(*HEADED), F.when(own, prefix).otherwise(line))


def shown_blocks(items: DataFrame, blocks: DataFrame, heads: DataFrame, prefixes: DataFrame, bare: DataFrame | None = None) -> DataFrame:
    """item_id, ord, html_text, ref_item_id as rendered: headed items begin with their line (not those in `bare`), counted ones with
    their number before the first paragraph; references to other than own children are left out."""
    told = items.where(F.col("item_type").isin(*HEADED)).join(heads, "item_id", "left").join(prefixes, "item_id", "left")
    if bare is not None:
        told = told.join(bare.select("item_id", F.lit(True).alias("_bare")), "item_id", "left").withColumn("_bare", F.coalesce("_bare", F.lit(False)))
    else:
        told = told.withColumn("_bare", F.lit(False))
    line = F.when(~F.col("_bare"), header_line(F.col("item_type"), F.col("item_number"), F.col("head"), F.col("prefix")))
    none = F.lit(None).cast("string")
    ref_none = F.lit(None).cast(blocks.schema["ref_item_id"].dataType)
    headers = told.select("item_id", F.lit(-1).alias("ord"), line.alias("html_text"), ref_none.alias("ref_item_id")).where("html_text IS NOT NULL")

    children = items.select(F.col("item_id").alias("ref_item_id"), F.col("parent_item_id").alias("item_id"))
    refs = blocks.where("type = 'child_ref'").join(children, ["item_id", "ref_item_id"], "left_semi").select("item_id", "ord", none.alias("html_text"), "ref_item_id")

    number = numbers.shown_number(F.col("item_number"), F.lit(False), F.lit(False))
    counted = items.where(F.col("item_type").isin(*COUNTED)).select("item_id", F.lit(None).cast(blocks.schema["ord"].dataType).alias("ord"), none.alias("type"), none.alias("html_text"), number.alias("number"))
    texts = blocks.where(F.col("type").isin(*SHOWN)).select("item_id", "ord", "type", "html_text", none.alias("number"))
    own = Window.partitionBy("item_id")  # numbers and texts of an item meet in one exchange
    both = counted.unionByName(texts).select("*", F.max("number").over(own).alias("said"), F.min(F.when(F.col("type") == "paragraph", F.col("ord"))).over(own).alias("first"))
    tag = F.regexp_extract("html_text", "(?is)^(<p[^>]*>)", 1)
    with_number = F.concat(tag, F.col("said"), F.lit(" "), F.substring(F.col("html_text"), F.length(tag) + F.lit(1), F.length("html_text")))
    numbered = F.when((F.col("type") == "paragraph") & (F.col("ord") == F.col("first")) & F.col("said").isNotNull(), with_number).otherwise(F.col("html_text"))
    line = F.when(F.col("type").isNotNull(), numbered).when(F.col("first").isNull(), F.concat("said", F.lit(" ")))
    shown = both.select("item_id", F.coalesce("ord", F.lit(0)).alias("ord"), line.alias("html_text"), ref_none.alias("ref_item_id")).where("html_text IS NOT NULL")
    return headers.unionByName(shown).unionByName(refs)


def rendered_items(roots: DataFrame, items: DataFrame, blocks: DataFrame, heads: DataFrame, prefixes: DataFrame, bare: DataFrame | None = None) -> DataFrame:
    """root_id, html of whole items (roots: root_id), children in the places of their references."""
    return rendered_tree(roots, shown_blocks(items, blocks, heads, prefixes, bare), most_levels=1)


def texts_below(roots: DataFrame, items: DataFrame, blocks: DataFrame) -> DataFrame:
    """root_id, text: the paragraphs of an item without markup and then those of its children, in order of `place`, at any depth."""
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "html_text"))), lambda b: F.regexp_replace(b["html_text"], "<[^>]+>", "")), " ")
    own = blocks.where("type = 'paragraph'").groupBy("item_id").agg(F.trim(said).alias("html_text"))
    texts = own.select("item_id", F.lit(-1).alias("ord"), "html_text", F.lit(None).cast("string").alias("ref_item_id"))
    below = items.where("parent_item_id IS NOT NULL").select(F.col("parent_item_id").alias("item_id"), F.col("place").cast("int").alias("ord"), F.lit(None).cast("string").alias("html_text"), F.col("item_id").alias("ref_item_id"))
    return rendered_tree(roots, texts.unionByName(below), most_levels=1).select("root_id", F.replace("html", F.lit("\n"), F.lit(" ")).alias("text"))


# --- pending items


def pending_ids(items: DataFrame, pending: DataFrame) -> DataFrame:
    """The items for which markup is staged."""
    return items.select("item_id").join(pending.where("html IS NOT NULL AND html <> ''"), "item_id", "left_semi").distinct()


def rebuild_steps(items: DataFrame, requested: DataFrame, pending: DataFrame) -> DataFrame:
    """item_id, depth, step of the requested items that have staged markup or no requested ancestor; deepest first, then by id."""
    from lexstrata.session import numbered

    items = cut(items.select("item_id", "parent_item_id"))
    asked = cut(requested.select("item_id").distinct())
    upper = asked.select(F.col("item_id").alias("ancestor_id"), F.lit(True).alias("asked"))
    above = ancestors(items, asked).join(upper, "ancestor_id", "left")
    above = above.groupBy("item_id").agg(F.max("distance").alias("distance"), F.coalesce(F.max("asked"), F.lit(False)).alias("covered"))
    staged = pending.where("html IS NOT NULL AND html <> ''").select("item_id").distinct().withColumn("staged", F.lit(True))
    told = items.select("item_id").join(asked, "item_id").join(staged, "item_id", "left").join(above, "item_id", "left")
    kept = told.where("staged OR NOT coalesce(covered, false)").select("item_id", (F.coalesce("distance", F.lit(0)) + 1).alias("depth"))
    return numbered(kept, "step", F.desc("depth"), F.asc("item_id"))


def staged_blocks(blocks: DataFrame, pending: DataFrame) -> DataFrame:
    """Bodies as they will be: staged markup's blocks in place of an item's texts, before its references."""
    from lexstrata.functions.html import blocks_and_gaps

    parts = pending.where("html IS NOT NULL AND html <> ''").select("item_id", F.posexplode(blocks_and_gaps(F.col("html"))).alias("k", "html_text"))
    new = parts.select("item_id", F.lit(0).alias("side"), F.col("k").alias("ord"), F.lit("paragraph").alias("type"), "html_text", F.lit(None).cast("string").alias("ref_item_id"))
    staged = new.select("item_id").distinct().withColumn("_staged", F.lit(True))
    left = blocks.join(staged, "item_id", "left").where("_staged IS NULL OR type = 'child_ref'")
    left = left.select("item_id", F.lit(1).alias("side"), "ord", "type", "html_text", "ref_item_id")
    return renumbered(new.unionByName(left), ["item_id"], "side", "ord").drop("side")


def pending_markup(items: DataFrame, blocks: DataFrame, heads: DataFrame, prefixes: DataFrame, pending: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """item_id, html from which each pending item is rebuilt.

    items have a place among their siblings; pending: item_id, mod_type, html. A new redaction takes its own markup. A change of an item
    with rebuilt descendants takes its own markup and then their new paragraphs, in document order, at any depth; without
    markup of its own it takes the whole of itself as rendered with what was rebuilt below it, without its number.
    """
    items, pending = cut(items), cut(pending)
    new = cut(staged_blocks(blocks, pending))
    below = ancestors(items, rebuilt.select("item_id").distinct()).join(pending.where("mod_type = 'change'").select(F.col("item_id").alias("ancestor_id")), "ancestor_id", "left_semi")
    below = cut(below.select("item_id", "ancestor_id"))
    paths = _document_order(items)
    has = below.select(F.col("ancestor_id").alias("item_id")).distinct().withColumn("has", F.lit(True))
    told = pending.join(has, "item_id", "left").withColumn("has", F.coalesce("has", F.lit(False)))
    own = F.coalesce("html", F.lit("")) != ""

    texts = new.where("type IN ('paragraph', 'table_fragment')").groupBy("item_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "html_text"))), lambda b: b["html_text"]), "\n").alias("t"))
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sort_path", "item_id", "t"))), lambda x: x["t"]), "\n")
    added = below.join(texts, "item_id").join(paths, "item_id").groupBy(F.col("ancestor_id").alias("item_id")).agg(ordered.alias("added"))
    augmented = told.join(added, "item_id", "left").where(own).select("item_id", F.concat_ws("\n", "html", F.when(F.col("has"), F.col("added"))).alias("html"))

    whole = told.where(~own & F.col("has"))
    html = rendered_items(whole.select(F.col("item_id").alias("root_id")), items, new, heads, prefixes)
    numbered = html.join(items.select(F.col("item_id").alias("root_id"), "item_number", "item_type"), "root_id")
    bare = F.when(F.col("item_type").isin(*COUNTED), text.without_leading_number(F.col("html"), F.col("item_number"))).otherwise(F.col("html"))
    return augmented.unionByName(numbered.select(F.col("root_id").alias("item_id"), bare.alias("html")))


def _document_order(items: DataFrame) -> DataFrame:
    """item_id, sort_path: places from the root down."""
    at = items.where("parent_item_id IS NULL").select("item_id", F.array(F.col("place").cast("long")).alias("sort_path"))
    kids = items.where("parent_item_id IS NOT NULL").select("item_id", F.col("parent_item_id").alias("up"), F.col("place").cast("long").alias("place"))
    out = at
    while True:  # each level is written once
        at = kids.join(at.withColumnRenamed("item_id", "up"), "up").where(F.size("sort_path") < F.lit(10_000)).select("item_id", F.concat("sort_path", F.array("place")).alias("sort_path"))
        at = cut(at)
        if at.isEmpty():
            return out
        out = out.unionByName(at)


def places(items: DataFrame) -> DataFrame:
    """items with place 1, 2, ... among siblings, by number."""
    w = Window.partitionBy("parent_item_id").orderBy(numbers.number_tuple(F.col("item_number")), "item_number", "item_id")
    return items.withColumn("place", F.row_number().over(w))
