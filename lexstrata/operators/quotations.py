"""Blocks of a source chosen by number or by quotation, and the places of quoted texts.

blocks: key, pos (from 1), html. A quotation begins at a block that starts with an opening guillemet and ends at the first
block, from there on, that holds a closing one. Windows within a key find them; no block meets another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexstrata.functions import html as markup
from lexstrata.functions import text

ENDING = "[\\s;,.!?…]"


def source_blocks(sources: DataFrame) -> DataFrame:
    """key, pos, html of sources (key, html)."""
    return sources.select("key", F.posexplode(markup.blocks_and_gaps(F.col("html"))).alias("k", "html")).select("key", (F.col("k") + 1).alias("pos"), "html")


def with_quotations(blocks: DataFrame) -> DataFrame:
    """blocks with said (its text) and quotation (1, 2, ... within the key; null outside of quotations)."""
    w = Window.partitionBy("key").orderBy("pos")
    said = blocks.withColumn("said", markup.bare_text(F.col("html")))
    begun = said.withColumn("q", F.sum(F.startswith("said", F.lit("«")).cast("int")).over(w))
    inside = Window.partitionBy("key", "q").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.coalesce(F.max(F.contains("said", F.lit("»"))).over(inside), F.lit(False))
    return begun.withColumn("quotation", F.when((F.col("q") > 0) & ~ended, F.col("q"))).drop("q")


def chosen(sources: DataFrame) -> DataFrame:
    """key, pos, html of the blocks that each source's spec names. sources: key, html, spec.

    'all', blank or markup as spec: from the first block that starts with a quotation (else the first that holds an
    opening guillemet) to the last that holds a closing one; without both, all. Numbers ('2-4,7'): those blocks that
    exist. If none does, quotations: the only one is searched for the number as a marker; otherwise all of them are taken.
    If nothing is left, all blocks.
    """
    spec = F.lower(F.trim(F.coalesce("spec", F.lit(""))))
    whole = spec.isin("", "all") | spec.rlike("<(p|div|table)")
    told = sources.select("key", F.when(whole, "all").otherwise(spec).alias("spec"), F.when(~whole, F.array_distinct(text.listed_numbers(spec))).alias("wanted"))
    rows = with_quotations(source_blocks(sources)).join(told, "key")
    every = Window.partitionBy("key")
    at = lambda f, hit: f(F.when(hit, F.col("pos"))).over(every)
    opens, closes = F.contains("said", F.lit("«")), F.contains("said", F.lit("»"))
    first = F.coalesce(at(F.min, F.startswith("said", F.lit("«"))), at(F.min, opens))
    told = rows.withColumn("first", first).withColumn("last", at(F.max, closes)).withColumn("quotations", F.max("quotation").over(every))
    quoted = F.coalesce(F.col("last") >= F.col("first"), F.lit(False))
    listed = F.coalesce(F.array_contains("wanted", F.col("pos")), F.lit(False))
    told = told.withColumn("numbered", listed).withColumn("any_number", F.max(listed).over(every))
    pick = (
        F.when(F.col("spec") == "all", ~quoted | F.col("pos").between(F.col("first"), F.col("last")))
        .when(F.col("any_number"), F.col("numbered"))
        .otherwise(F.col("quotations").isNull() | F.col("quotation").isNotNull())
    )
    plain = told.where(pick)
    alone = (F.col("spec") != "all") & ~F.col("any_number") & (F.col("quotations") == 1)
    return _marked_parts(plain.withColumn("alone", F.coalesce(alone, F.lit(False)))).select("key", "pos", "html")


def _marked_parts(rows: DataFrame) -> DataFrame:
    """Of keys with one quotation alone, the stretch that starts with the spec as its marker, if there is one."""
    w = Window.partitionBy("key").orderBy("pos")
    bare = F.lower(markup.unquoted(F.col("said")))
    mark = F.nullif(F.regexp_extract(bare, markup.LEADING, 1), F.lit(""))
    stretch = F.last(mark, ignorenulls=True).over(w)
    told = rows.withColumn("hit", F.col("alone") & F.coalesce(stretch == F.regexp_replace("spec", "[.)]+$", ""), F.lit(False)))
    return told.withColumn("any_hit", F.max("hit").over(Window.partitionBy("key"))).where("NOT alone OR hit OR NOT any_hit")


def without_outer_quotes(blocks: DataFrame) -> DataFrame:
    """Chosen blocks without the guillemet that the first quoted block begins with and the one the last ends with (and marks behind it); a last block left empty goes."""
    every = Window.partitionBy("key")
    said = blocks.withColumn("said", markup.bare_text(F.col("html")))
    begins = F.startswith("said", F.lit("«"))
    ends = F.col("said").rlike(f"»{ENDING}*$")
    told = said.withColumn("first", F.min(F.when(begins, F.col("pos"))).over(every)).withColumn("last", F.max(F.when(ends, F.col("pos"))).over(every))
    opened = F.when(F.col("pos") == F.col("first"), F.regexp_replace("html", "^((?:<[^>]*>|\\s)*)«", "$1")).otherwise(F.col("html"))
    closed = told.withColumn("html", opened).withColumn("html", F.when(F.col("pos") == F.col("last"), F.regexp_replace("html", f"»{ENDING}*((?:<[^>]*>|\\s)*)$", "$1")).otherwise(F.col("html")))
    kept = closed.where(~F.coalesce((F.col("pos") == F.col("last")) & (markup.bare_text(F.col("html")) == ""), F.lit(False)))
    return kept.select("key", "pos", F.regexp_replace("html", ";{2,}", ";").alias("html"))


def selected_markup(sources: DataFrame) -> DataFrame:
    """key, html: what each source's spec names, in one piece; '' where nothing is left."""
    parts = without_outer_quotes(chosen(sources))
    joined = parts.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "html"))), lambda b: b["html"]), "\n").alias("html"))
    return sources.select("key").join(joined, "key", "left").select("key", F.coalesce("html", F.lit("")).alias("html"))


def offsets(said: Column, part: Column) -> Column:
    """Where a part stands in a text, from 0, one place after another without overlap."""
    pieces = F.split(said, F.concat(F.lit("\\Q"), F.replace(part, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")), -1)
    ends = F.aggregate(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1), F.struct(F.lit(0).alias("at"), F.expr("cast(array() AS array<int>)").alias("found")),
        lambda a, p: F.struct((a["at"] + F.length(p) + F.length(part)).alias("at"), F.array_append(a["found"], a["at"] + F.length(p)).alias("found")),
    )
    return F.when(F.length(part) > 0, ends["found"]).otherwise(F.expr("cast(array() AS array<int>)"))


def quoted_places(blocks: DataFrame, quotations: DataFrame) -> DataFrame:
    """key, quote_id, place (1, 2, ...), start_pos, start, end_pos, end of quoted texts (key, quote_id, quoted) in the blocks of their key.

    Texts are compared with white space squeezed; a quotation may begin and end inside blocks and run over their borders, which
    count as a space. start and end are offsets from 0 in the squeezed texts of their blocks, end behind the last character. Each key's blocks make one text with a
    list of the places where blocks begin, so a quotation is looked for once and not in each block.
    """
    said = blocks.select("key", "pos", text.squeezed(markup.bare_text(F.col("html"))).alias("said"))
    listed = said.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("pos", "said"))).alias("bs"))
    begins = F.aggregate(
        "bs", F.struct(F.lit(0).alias("at"), F.expr("cast(array() AS array<struct<at: int, pos: int>>)").alias("list")),
        lambda a, b: F.struct((a["at"] + F.length(b["said"]) + 1).alias("at"), F.array_append(a["list"], F.struct(a["at"].alias("at"), b["pos"].cast("int").alias("pos"))).alias("list")),
    )
    whole = listed.select("key", F.array_join(F.transform("bs", lambda b: b["said"]), " ").alias("whole"), begins["list"].alias("begins"))
    wanted = quotations.select("key", "quote_id", text.squeezed(F.col("quoted")).alias("quoted"))
    found = wanted.join(whole, "key").withColumn("found", offsets(F.col("whole"), F.col("quoted")))
    each = found.select("key", "quote_id", F.length("quoted").alias("n"), "begins", F.posexplode("found").alias("place", "at"))
    block_at = lambda c: F.element_at(F.filter("begins", lambda b: b["at"] <= c), -1)
    told = each.withColumn("s", block_at(F.col("at"))).withColumn("e", block_at(F.col("at") + F.col("n") - 1))
    return told.select("key", "quote_id", (F.col("place") + 1).alias("place"), F.col("s.pos").alias("start_pos"), (F.col("at") - F.col("s.at")).alias("start"), F.col("e.pos").alias("end_pos"), (F.col("at") + F.col("n") - F.col("e.at")).alias("end"))


def paragraph_with(blocks: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, pos: the first block whose text holds the wanted one (key, wanted) or is part of it, without regard to case and white space; null if none."""
    clean = lambda c: F.lower(text.squeezed(c))
    told = wanted.select("key", clean(F.col("wanted")).alias("w")).where("w <> ''").join(blocks.select("key", "pos", clean(markup.bare_text(F.col("html"))).alias("said")), "key")
    hits = told.where(F.contains("said", F.col("w")) | F.contains("w", F.col("said"))).groupBy("key").agg(F.min("pos").alias("pos"))
    return wanted.select("key").join(hits, "key", "left")


def source_markup(changes: DataFrame, resolved: DataFrame, rendered: DataFrame) -> DataFrame:
    """change_id, html: the markup of the first of a change's numbered sources that resolves, or of its target where it names no number; else null.

    changes: change_id, target_id, numbered; resolved: change_id, seq, source_id; rendered: root_id, html without header (`rendering.rendered_items`).
    """
    first = resolved.where("source_id IS NOT NULL").groupBy("change_id").agg(F.min_by("source_id", "seq").alias("source_id"))
    told = changes.join(first, "change_id", "left").select("change_id", F.when(F.col("numbered"), F.col("source_id")).otherwise(F.col("target_id")).alias("root_id"))
    return told.join(rendered, "root_id", "left").select("change_id", "html")
