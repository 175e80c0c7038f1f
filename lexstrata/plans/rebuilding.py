"""Queries of rendering and of pending rebuilds. Customers are articles, their orders parts and the orders' lines points; SQL puts the same texts together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexstrata.operators import rendering
from lexstrata.plans.catalogue import query, table
from lexstrata.session import cut

S = "cast({} AS string)"


def tree(spark, d) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """items (with place), open blocks, heads, prefixes."""
    c, o, li = table(spark, d, "customer"), table(spark, d, "orders"), table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_suppkey").alias("s"))
    li = cut(li.join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey"))
    none = F.lit(None).cast("string")
    a = lambda k: F.concat(F.lit("c"), F.col(k).cast("string"))
    p = lambda k, ok: F.concat(a(k), F.lit("_o"), F.col(ok).cast("string"))
    q = F.concat(p("o_custkey", "l_orderkey"), F.lit("_l"), F.col("l_linenumber").cast("string"))
    items = c.select(a("c_custkey").alias("item_id"), none.alias("parent_item_id"), F.lit("article").alias("item_type"), F.col("c_custkey").cast("string").alias("item_number"), F.col("c_custkey").alias("place"))
    items = items.unionByName(o.select(p("o_custkey", "o_orderkey").alias("item_id"), a("o_custkey").alias("parent_item_id"), F.lit("part").alias("item_type"), F.col("o_orderkey").cast("string").alias("item_number"), F.col("o_orderkey").alias("place")))
    items = items.unionByName(li.select(q.alias("item_id"), p("o_custkey", "l_orderkey").alias("parent_item_id"), F.lit("point").alias("item_type"), F.concat(F.col("l_linenumber").cast("string"), F.lit(")")).alias("item_number"), F.col("l_linenumber").cast("long").alias("place")))
    say = lambda *x: F.concat(F.lit("<p>"), *x, F.lit("</p>"))
    texts = c.select(a("c_custkey").alias("item_id"), F.lit(0).cast("long").alias("ord"), F.lit("paragraph").alias("type"), say("c_name").alias("html_text"))
    texts = texts.unionByName(o.select(p("o_custkey", "o_orderkey").alias("item_id"), F.lit(0).cast("long").alias("ord"), F.lit("paragraph").alias("type"), say("o_orderstatus", F.lit(" & "), "o_orderpriority").alias("html_text")))
    texts = texts.unionByName(li.where("s % 3 > 0").select(q.alias("item_id"), F.lit(0).cast("long").alias("ord"), F.when(F.col("s") % 3 == 1, "paragraph").otherwise("table_fragment").alias("type"), say(F.col("s").cast("string")).alias("html_text")))
    refs = items.where("parent_item_id IS NOT NULL").select(F.col("parent_item_id").alias("item_id"), F.col("place").alias("ord"), F.lit("child_ref").alias("type"), none.alias("html_text"), F.col("item_id").alias("ref_item_id"))
    heads = c.select(a("c_custkey").alias("item_id"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("head"))
    prefixes = heads.where("false").withColumnRenamed("head", "prefix")
    return items, texts.withColumn("ref_item_id", none).unionByName(refs), heads, prefixes


TEXTS = """
    li AS (SELECT l_orderkey AS o, l_linenumber AS n, min(l_suppkey) AS s FROM lineitem GROUP BY ALL),
    points AS (SELECT o, n, s, CASE s % 3 WHEN 1 THEN '<p>' || n || ') ' || s || '</p>' WHEN 2 THEN n || ') ' || chr(10) || '<p>' || s || '</p>' ELSE n || ') ' END AS t FROM li),
    parts AS (SELECT o_custkey AS c, o_orderkey AS o, o_orderstatus AS st, '<p>' || o_orderkey || '. ' || o_orderstatus || ' & ' || o_orderpriority || '</p>'
        || coalesce(chr(10) || (SELECT string_agg(t, chr(10) ORDER BY n) FROM points p WHERE p.o = o_orderkey), '') AS t FROM orders),
    heads AS (SELECT c_custkey AS c, '<p><b>Статья ' || c_custkey || CASE WHEN c_custkey % 2 = 0 THEN '. ' || c_mktsegment ELSE '' END || '</b></p>' AS head, '<p>' || c_name || '</p>' AS t FROM customer)
"""


@query(f"""WITH {TEXTS} SELECT 'c' || c AS root_id, head || chr(10) || t || coalesce(chr(10) || (SELECT string_agg(p.t, chr(10) ORDER BY p.o) FROM parts p WHERE p.c = h.c), '') AS html FROM heads h""")
def whole_articles(spark, d):
    items, blocks, heads, prefixes = tree(spark, d)
    return rendering.rendered_items(items.where("parent_item_id IS NULL").select(F.col("item_id").alias("root_id")), items, blocks, heads, prefixes)


@query("""WITH li AS (SELECT l_orderkey AS o, l_linenumber AS n, min(l_suppkey) AS s FROM lineitem GROUP BY ALL),
    x AS (SELECT o_custkey AS c, o_orderkey AS o, -1 AS n, o_orderstatus || ' & ' || o_orderpriority AS t FROM orders UNION ALL SELECT o_custkey, o, n, CAST(s AS VARCHAR) FROM li JOIN orders ON o_orderkey = o WHERE s % 3 = 1)
    SELECT 'c' || c_custkey AS root_id, c_name || coalesce(' ' || (SELECT string_agg(t, ' ' ORDER BY o, n) FROM x WHERE x.c = c_custkey), '') AS text FROM customer""")
def article_texts(spark, d):
    items, blocks, _, _ = tree(spark, d)
    return rendering.texts_below(items.where("parent_item_id IS NULL").select(F.col("item_id").alias("root_id")), items, blocks)


def staged(spark, d):
    """Finished orders and the lines of suppliers divisible by 4 are pending with markup, as are all articles of even number (without) and odd number divisible by 5 (with)."""
    items, blocks, heads, prefixes = tree(spark, d)
    o = table(spark, d, "orders")
    li = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_suppkey").alias("s")).where("s % 4 = 0").join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    parts = o.where("o_orderstatus = 'F'").selectExpr("concat('c', o_custkey, '_o', o_orderkey) AS item_id", "'new_redaction' AS mod_type", "concat('<p>part ', o_orderkey, '</p><p>more</p>') AS html")
    points = li.selectExpr("concat('c', o_custkey, '_o', l_orderkey, '_l', l_linenumber) AS item_id", "'change' AS mod_type", "concat('<p>point ', s, '</p>') AS html")
    tops = table(spark, d, "customer").where("c_custkey % 2 = 0 OR c_custkey % 5 = 0").selectExpr("concat('c', c_custkey) AS item_id", "'change' AS mod_type", "CASE WHEN c_custkey % 2 = 1 THEN concat('<p>new ', c_custkey, '</p>') END AS html")
    return items, blocks, heads, prefixes, parts.unionByName(points).unionByName(tops)


PENDING = """
    li AS (SELECT l_orderkey AS o, l_linenumber AS n, min(l_suppkey) AS s FROM lineitem GROUP BY ALL),
    points AS (SELECT o_custkey AS c, li.*, s % 4 = 0 AS hit, 'c' || o_custkey || '_o' || o || '_l' || n AS id FROM li JOIN orders ON o_orderkey = o),
    parts AS (SELECT o_custkey AS c, o_orderkey AS o, o_orderstatus = 'F' AS hit, 'c' || o_custkey || '_o' || o_orderkey AS id, o_orderstatus || ' & ' || o_orderpriority AS old FROM orders)
"""


@query(f"""WITH {PENDING},
    rebuilt AS (SELECT c, o, -1 AS n, '<p>part ' || o || '</p>' || chr(10) || '<p>more</p>' AS t FROM parts WHERE hit UNION ALL SELECT c, o, n, '<p>point ' || s || '</p>' FROM points WHERE hit),
    point_html AS (SELECT o, n, CASE WHEN hit THEN '<p>' || n || ') point ' || s || '</p>' WHEN s % 3 = 1 THEN '<p>' || n || ') ' || s || '</p>' WHEN s % 3 = 2 THEN n || ') ' || chr(10) || '<p>' || s || '</p>' ELSE n || ') ' END AS t FROM points),
    part_html AS (SELECT c, o, '<p>' || o || '. ' || CASE WHEN hit THEN 'part ' || o || '</p>' || chr(10) || '<p>more</p>' ELSE old || '</p>' END
        || coalesce(chr(10) || (SELECT string_agg(t, chr(10) ORDER BY n) FROM point_html p WHERE p.o = parts.o), '') AS t FROM parts),
    whole AS (SELECT 'c' || c_custkey AS item_id, '<p><b>Статья ' || c_custkey || '. ' || c_mktsegment || '</b></p>' || chr(10) || '<p>' || c_name || '</p>' || chr(10) || (SELECT string_agg(t, chr(10) ORDER BY o) FROM part_html p WHERE p.c = c_custkey) AS html
        FROM customer WHERE c_custkey % 2 = 0 AND c_custkey IN (SELECT c FROM rebuilt)),
    appended AS (SELECT 'c' || c_custkey AS item_id, '<p>new ' || c_custkey || '</p>' || coalesce(chr(10) || (SELECT string_agg(t, chr(10) ORDER BY o, n) FROM rebuilt r WHERE r.c = c_custkey), '') AS html FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 5 = 0)
    SELECT * FROM whole UNION ALL SELECT * FROM appended UNION ALL SELECT id, '<p>part ' || o || '</p><p>more</p>' FROM parts WHERE hit UNION ALL SELECT id, '<p>point ' || s || '</p>' FROM points WHERE hit""")
def pending_markup(spark, d):
    items, blocks, heads, prefixes, pending = staged(spark, d)
    below = pending.where("item_id LIKE '%\\\\_o%'").select("item_id")
    return rendering.pending_markup(items, blocks, heads, prefixes, pending, below)


@query(f"""WITH {PENDING},
    kept AS (SELECT id, 3 AS depth FROM points WHERE hit UNION ALL SELECT id, 2 FROM parts WHERE hit UNION ALL SELECT 'c' || c_custkey, 1 FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 5 = 0)
    SELECT id AS item_id, depth, row_number() OVER (ORDER BY depth DESC, id) AS step FROM kept""")
def pending_steps(spark, d):
    items, _, _, _, pending = staged(spark, d)
    return rendering.rebuild_steps(items, pending.select("item_id"), pending).select("item_id", "depth", "step")
