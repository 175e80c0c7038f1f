"""Queries of timelines beside the text. A customer's orders of different priorities are the histories of its text, title and number."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexstrata.functions.dates import closing_date
from lexstrata.operators import merge, timelines
from lexstrata.plans.catalogue import day, query, table

DAY = "2001-09-10"


def facet(spark, d, priority: str):
    """The customer's orders of a priority, one a day, as a timeline; every third ends a month early."""
    o = table(spark, d, "orders").where(F.startswith("o_orderpriority", F.lit(priority)))
    one = o.groupBy(F.col("o_custkey").alias("item_id"), F.col("o_orderdate").cast("date").alias("valid_from")).agg(F.min("o_orderkey").alias("value"))
    w = Window.partitionBy("item_id").orderBy("valid_from")
    ends = F.when(F.col("value") % 3 == 0, F.least(closing_date(F.lead("valid_from").over(w)), F.date_add("valid_from", 30))).otherwise(closing_date(F.lead("valid_from").over(w)))
    none = F.lit(None).cast("string")
    return one.select("item_id", F.row_number().over(w).cast("int").alias("rev_idx"), F.col("value").cast("string").alias("value"), "valid_from", ends.alias("valid_to"), none.alias("mod_type"), none.alias("modified_by_id"))


FACETS = """
    o AS (SELECT o_custkey AS item_id, CAST(o_orderdate AS DATE) AS f, substr(o_orderpriority, 1, 1) AS p, min(o_orderkey) AS v FROM orders GROUP BY ALL),
    n AS (SELECT *, lead(f) OVER w - 1 AS nxt, row_number() OVER w AS k FROM o WINDOW w AS (PARTITION BY item_id, p ORDER BY f)),
    rows AS (SELECT item_id, p, k, CAST(v AS VARCHAR) AS v, f, CASE WHEN v % 3 = 0 THEN least(nxt, f + 30) ELSE nxt END AS t FROM n)
"""


@query(f"""WITH {FACETS}, r AS (SELECT * FROM rows WHERE p IN ('1', '2', '3')),
    days AS (SELECT item_id, f AS day FROM r UNION SELECT item_id, t + 1 FROM r WHERE t IS NOT NULL),
    s AS (SELECT item_id, day AS a, lead(day) OVER (PARTITION BY item_id ORDER BY day) - 1 AS b FROM days),
    v AS (SELECT s.item_id, a, b, max(v) FILTER (p = '1') AS said, max(v) FILTER (p = '2') AS title, max(v) FILTER (p = '3') AS number FROM s JOIN r ON r.item_id = s.item_id AND f <= a AND (t IS NULL OR t >= a) GROUP BY ALL)
    SELECT item_id, CAST(a AS VARCHAR) AS valid_from, CAST(b AS VARCHAR) AS valid_to, said, title, number FROM v""")
def timelines_aligned(spark, d):
    return timelines.aligned({"said": facet(spark, d, "1"), "title": facet(spark, d, "2"), "number": facet(spark, d, "3")}).select("item_id", day("valid_from"), day("valid_to"), "said", "title", "number")


@query(f"""WITH {FACETS}, r AS (SELECT * FROM rows WHERE p = '2'),
    act AS (SELECT item_id, coalesce(min(k) FILTER (t IS NULL), max(k)) AS k, max(k) AS top FROM r GROUP BY ALL),
    want AS (SELECT c_custkey AS item_id, CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment END AS w FROM customer),
    hit AS (SELECT want.item_id, w, act.k, top FROM want LEFT JOIN act USING (item_id) LEFT JOIN r ON r.item_id = want.item_id AND r.k = act.k WHERE w IS NOT NULL AND v IS DISTINCT FROM w)
    SELECT r.item_id, CAST(r.k AS INTEGER) AS rev_idx, v AS value, CAST(f AS VARCHAR) AS valid_from, CAST(CASE WHEN h.k IS NOT NULL AND t IS NULL THEN DATE '{DAY}' - 1 ELSE t END AS VARCHAR) AS valid_to, NULL AS mod_type
        FROM r LEFT JOIN hit h ON h.item_id = r.item_id AND h.k = r.k
    UNION ALL SELECT item_id, CAST(coalesce(top, 0) + 1 AS INTEGER), w, CASE WHEN k IS NULL THEN '{DAY}' END, NULL, CASE WHEN k IS NULL THEN 'add' ELSE 'change' END FROM hit""")
def titles_after_merge(spark, d):
    wanted = table(spark, d, "customer").select(F.col("c_custkey").alias("item_id"), F.when(F.col("c_custkey") % 4 > 0, F.col("c_mktsegment")).alias("value"))
    out = timelines.titles_after(facet(spark, d, "2"), wanted, F.lit(DAY).cast("date"), F.lit("by"))
    return out.select("item_id", "rev_idx", "value", day("valid_from"), day("valid_to"), "mod_type")


@query(f"""WITH {FACETS}, r AS (SELECT * FROM rows WHERE p = '3'),
    act AS (SELECT item_id, coalesce(min(k) FILTER (t IS NULL), max(k)) AS k, max(k) AS top FROM r GROUP BY ALL),
    want AS (SELECT c_custkey AS item_id, CAST(c_custkey AS VARCHAR) AS old, CASE WHEN c_custkey % 5 > 0 THEN c_custkey || '.1' ELSE CAST(c_custkey AS VARCHAR) END AS w FROM customer),
    hit AS (SELECT item_id, old, w, coalesce(k, 1) AS k, coalesce(top, 1) AS top, k IS NULL AS none FROM want LEFT JOIN act USING (item_id) WHERE w <> old),
    whole AS (SELECT item_id, k, v, f, t FROM r UNION ALL SELECT item_id, 1, old, DATE '1990-01-01', NULL FROM hit WHERE none)
    SELECT w.item_id, CAST(w.k AS INTEGER) AS rev_idx, v AS value, CAST(f AS VARCHAR) AS valid_from, CAST(CASE WHEN h.k IS NOT NULL AND t IS NULL THEN DATE '{DAY}' - 1 ELSE t END AS VARCHAR) AS valid_to, NULL AS mod_type
        FROM whole w LEFT JOIN hit h ON h.item_id = w.item_id AND h.k = w.k
    UNION ALL SELECT item_id, CAST(top + 1 AS INTEGER), w, '{DAY}', NULL, 'change' FROM hit""")
def numbers_after_merge(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("item_id"), F.col("c_custkey").cast("string").alias("item_number"))
    wanted = c.select("item_id", F.when(F.col("item_id") % 5 > 0, F.concat("item_number", F.lit(".1"))).otherwise(F.col("item_number")).alias("value"))
    out = timelines.numbers_after(facet(spark, d, "3"), c, wanted, c.select("item_id", F.lit("1990-01-01").cast("date").alias("valid_from")), F.lit(DAY).cast("date"), F.lit("by"))
    return out.select("item_id", "rev_idx", "value", day("valid_from"), day("valid_to"), "mod_type")


@query("""SELECT 'n' || o_custkey || '_p_' || o_orderkey AS item_id, o_orderkey AS value FROM orders
    UNION ALL SELECT 'n' || o_custkey || '_p_' || o_orderkey || '_1', -o_orderkey FROM orders
    UNION ALL SELECT 'o' || o_custkey || '_' || o_orderkey, o_orderkey FROM orders UNION ALL SELECT 'o' || o_custkey || '_' || o_orderkey || '_1', -o_orderkey FROM orders""")
def state_transferred(spark, d):
    """The points of every article come to stand below a new part: their histories, and those of what is below them, come along."""
    o = table(spark, d, "orders")
    c = o.select("o_custkey").distinct()
    s = lambda *x: F.concat(*[F.col(v).cast("string") if v.startswith("o_") else F.lit(v) for v in x])
    none = F.lit(None).cast("string")
    item = lambda df, i, up, t, n, place: df.select(i.alias("item_id"), up.alias("parent_item_id"), F.lit(t).alias("item_type"), n.alias("item_number"), place.cast("long").alias("place"), F.col("txt").alias("text"), none.alias("head"))
    co, oo = c.withColumn("txt", F.lit("")), o.withColumn("txt", F.col("o_orderpriority"))
    key = F.col("o_orderkey").cast("string")
    old = item(co, s("o", "o_custkey"), none, "article", none, F.lit(1)).unionByName(item(oo, s("o", "o_custkey", "_", "o_orderkey"), s("o", "o_custkey"), "point", key, F.col("o_orderkey"))).unionByName(item(oo, s("o", "o_custkey", "_", "o_orderkey", "_1"), s("o", "o_custkey", "_", "o_orderkey"), "subpoint", F.lit("1"), F.lit(1)))
    new = item(co, s("n", "o_custkey"), none, "article", none, F.lit(1)).unionByName(item(co, s("n", "o_custkey", "_p"), s("n", "o_custkey"), "part", F.lit("1"), F.lit(1)))
    new = new.unionByName(item(oo, s("n", "o_custkey", "_p", "_", "o_orderkey"), s("n", "o_custkey", "_p"), "point", key, F.col("o_orderkey"))).unionByName(item(oo, s("n", "o_custkey", "_p", "_", "o_orderkey", "_1"), s("n", "o_custkey", "_p", "_", "o_orderkey"), "subpoint", F.lit("1"), F.lit(1)))
    state = oo.select(s("o", "o_custkey", "_", "o_orderkey").alias("item_id"), F.col("o_orderkey").alias("value")).unionByName(oo.select(s("o", "o_custkey", "_", "o_orderkey", "_1").alias("item_id"), (-F.col("o_orderkey")).alias("value")))
    state = state.unionByName(oo.select(s("n", "o_custkey", "_p", "_", "o_orderkey").alias("item_id"), F.lit(0).cast("long").alias("value")))
    gone = oo.select(s("o", "o_custkey", "_", "o_orderkey").alias("item_id"), s("n", "o_custkey").alias("new_root"))
    pairs = timelines.moved_pairs(old, new, gone, (merge.fingerprints(old), merge.fingerprints(new)))
    return timelines.transferred(state, timelines.paired_below(old, new, pairs))
