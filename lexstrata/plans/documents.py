"""Queries of whole documents: all checks in one call, and all repairs. An order is an item with its lines as children."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexstrata.operators import document
from lexstrata.plans.catalogue import query, table
from lexstrata.session import cut


def spoiled(spark, d) -> dict[str, DataFrame]:
    """Orders with faults: even ones have a wrong level, those divisible by 3 no date, by 4 an empty second holder of their id, by 5 a
    reference to nothing; the last line of every order is not referred to."""
    o = table(spark, d, "orders")
    li = cut(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").distinct())
    k = F.col("o_orderkey")
    name = lambda c: F.concat(F.lit("o"), F.col(c).cast("string"))
    line = F.concat(name("l_orderkey"), F.lit("_"), F.col("l_linenumber").cast("string"))
    none = F.lit(None).cast("string")
    items = o.select(name("o_orderkey").alias("item_id"), none.alias("parent_item_id"), F.lit("part").alias("item_type"), k.cast("string").alias("item_number"), F.when(k % 2 == 0, 7).otherwise(1).alias("item_level"), F.lit(1).alias("depth"), F.lit(1).alias("place"), F.lit(1).alias("copy"))
    items = items.unionByName(items.where("CAST(item_number AS BIGINT) % 4 = 0").withColumn("copy", F.lit(2)).withColumn("item_level", F.lit(1)))
    items = items.unionByName(li.select(line.alias("item_id"), name("l_orderkey").alias("parent_item_id"), F.lit("point").alias("item_type"), F.col("l_linenumber").cast("string").alias("item_number"), F.lit(2).alias("item_level"), F.lit(2).alias("depth"), F.col("l_linenumber").cast("int").alias("place"), F.lit(1).alias("copy")))
    row = lambda i, since: [i.alias("item_id"), F.lit(1).alias("rev_idx"), since.cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), none.alias("mod_type"), none.alias("modified_by_id"), none.alias("highlights"), F.lit(1).alias("copy")]
    timeline = o.select(*row(name("o_orderkey"), F.when(k % 3 > 0, "1999-01-01"))).unionByName(li.select(*row(line, F.lit("1999-01-01"))))
    refs = li.join(li.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("top")).hint("merge"), "l_orderkey").where("l_linenumber < top").select(name("l_orderkey").alias("item_id"), F.col("l_linenumber").alias("n"), line.alias("ref_item_id"))
    refs = refs.unionByName(o.where("o_orderkey % 5 = 0").select(name("o_orderkey").alias("item_id"), F.lit(0).alias("n"), F.lit("nothing").alias("ref_item_id")))
    from pyspark.sql import Window

    order = F.row_number().over(Window.partitionBy("item_id").orderBy("n")).cast("int")
    blocks = refs.select("item_id", F.lit(1).alias("rev_idx"), order.alias("ord"), F.lit("child_ref").alias("block_type"), none.alias("html_text"), "ref_item_id", F.lit(1).alias("copy"))
    heads = timeline.where("false").select("item_id", "rev_idx", "valid_to", "copy")
    return {name_: cut(t) for name_, t in (("items", items), ("timeline", timeline), ("blocks", blocks), ("heads", heads))}


@query("""WITH l AS (SELECT l_orderkey AS k, max(l_linenumber) AS top FROM lineitem GROUP BY ALL)
    SELECT 'item_id_duplicate' AS category, 'error' AS severity, 'o' || o_orderkey AS element, 1 AS step FROM orders WHERE o_orderkey % 4 = 0
    UNION ALL SELECT 'item_level_invalid', 'error', 'o' || o_orderkey, 1 FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT 'child_ref_broken', 'error', 'o' || o_orderkey, 2 FROM orders WHERE o_orderkey % 5 = 0
    UNION ALL SELECT 'child_ref_missing', 'warning', 'o' || k || '_' || top, 2 FROM l
    UNION ALL SELECT 'revision_child_missing', 'error', 'o' || o_orderkey, 3 FROM orders WHERE o_orderkey % 5 = 0 AND o_orderkey % 3 > 0
    UNION ALL SELECT 'revision_valid_from_missing', 'error', 'o' || o_orderkey, 4 FROM orders WHERE o_orderkey % 3 = 0""")
def document_verified(spark, d):
    return document.verify_document(spoiled(spark, d)).select("category", "severity", "element", "step")


@query("""WITH c AS (SELECT count(*) FILTER (o_orderkey % 3 = 0) AS dates, count(*) FILTER (o_orderkey % 4 = 0) AS ids, count(*) FILTER (o_orderkey % 5 = 0) AS broken, count(*) FILTER (o_orderkey % 15 = 0) AS fresh,
        count(*) FILTER (o_orderkey % 5 = 0 AND o_orderkey % 3 > 0) AS lost, count(*) FILTER (o_orderkey % 2 = 0) AS levels FROM orders), l AS (SELECT count(DISTINCT l_orderkey) AS refs FROM lineitem),
    s AS (SELECT dates + ids + broken + lost + levels + refs AS n0, n0 - dates + fresh AS n1, n1 - ids + ids AS n2, n2 - refs AS n3, n3 - broken - lost - fresh AS n4, n4 - ids AS n5, n5 - levels AS n6 FROM c, l)
    SELECT step, fix, before AS issues_before, after AS issues_after FROM s, LATERAL (VALUES (1, 'revision_valid_from_missing', n0, n1), (2, 'item_id_duplicate', n1, n2), (3, 'child_ref_missing', n2, n3),
        (4, 'child_ref_broken', n3, n4), (5, 'duplicate_item_id_empty', n4, n5), (6, 'item_level_invalid', n5, n6)) AS t(step, fix, before, after)""")
def document_repaired(spark, d):
    """What each repair leaves. A renamed second holder has no revision, an issue of its own until it goes as an empty copy."""
    day = lambda s: F.lit(s).cast("date")
    return document.repaired_document(spoiled(spark, d), day("2001-01-01"), day("1999-06-01"), lambda df, _: cut(df))[1]
