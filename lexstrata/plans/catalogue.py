"""Every operator as a query over the driver's tables, with the SQL that gives the same rows.

Derivations: an item is a customer and its revisions are its orders, one a day (the order with the
smallest key). Trees are region > nation > customer. Outcome logs are events. Dates are shown as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexstrata.functions import dates, numbers, text
from lexstrata.operators import amend, highlights, history, paths, temporal, tree, verify

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def day(name: str):
    return F.date_format(name, "yyyy-MM-dd").alias(name)


def orders(spark, d) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_custkey").alias("item_id"), F.col("o_orderkey").alias("rev_key"), F.col("o_orderdate").cast("date").alias("valid_from"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))


def timeline(spark, d) -> DataFrame:
    from pyspark.sql import Window

    one = orders(spark, d).groupBy("item_id", "valid_from").agg(F.min(F.struct("rev_key", "status", "priority")).alias("r")).select("item_id", "valid_from", "r.*")
    w = Window.partitionBy("item_id").orderBy("valid_from")
    return one.withColumn("valid_to", dates.closing_date(F.lead("valid_from").over(w))).withColumn("rev_idx", F.row_number().over(w))


TIMELINE = """
    o AS (SELECT o_custkey AS item_id, o_orderkey AS rev_key, CAST(o_orderdate AS DATE) AS valid_from, o_orderstatus AS status, o_orderpriority AS priority FROM orders),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id, valid_from ORDER BY rev_key, status, priority) AS k FROM o),
    tl AS (SELECT item_id, rev_key, valid_from, status, priority, lead(valid_from) OVER w - 1 AS valid_to, row_number() OVER w AS rev_idx FROM ranked WHERE k = 1 WINDOW w AS (PARTITION BY item_id ORDER BY valid_from))
"""
AS_OF = "DATE '1998-04-17'"


@query(f"WITH {TIMELINE} SELECT item_id, rev_key, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to FROM tl WHERE valid_from <= {AS_OF} AND (valid_to IS NULL OR {AS_OF} <= valid_to)")
def effective_revision_asof(spark, d):
    found = temporal.effective_revision(timeline(spark, d), F.lit("1998-04-17").cast("date"))
    return found.select("item_id", "rev_key", day("valid_from"), day("valid_to"))


CALENDAR = ("1995-06-30", "1996-06-30", "1997-06-30", "1998-06-30", "1999-06-30", "2000-06-30", "2001-06-30")


@query(f"WITH {TIMELINE}, cal AS (SELECT unnest([{', '.join(f'DATE {c!r}' for c in CALENDAR)}]) AS as_of) SELECT CAST(as_of AS VARCHAR) AS as_of, item_id, rev_key FROM tl JOIN cal ON valid_from <= as_of AND (valid_to IS NULL OR as_of <= valid_to)")
def effective_revision_grid(spark, d):
    cal = spark.createDataFrame([(c,) for c in CALENDAR], "as_of string").select(F.col("as_of").cast("date").alias("as_of"))
    return temporal.effective_grid(timeline(spark, d), cal).select(day("as_of"), "item_id", "rev_key")


OPEN = "raw AS (SELECT o_custkey AS item_id, o_orderkey AS rev_key, CAST(o_orderdate AS DATE) AS valid_from, CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 30 END AS valid_to, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, o_orderdate, o_orderstatus) AS rev_idx FROM orders)"


def listed(spark, d) -> DataFrame:
    """Orders in key order as a list of revisions; those of status O are open."""
    from pyspark.sql import Window

    o = orders(spark, d)
    w = Window.partitionBy("item_id").orderBy("rev_key", "valid_from", "status")
    return o.withColumn("rev_idx", F.row_number().over(w)).withColumn("valid_to", F.when(F.col("status") != "O", F.date_add("valid_from", 30)))


@query(f"WITH {OPEN} SELECT item_id, rev_key FROM raw QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY valid_from DESC, rev_idx) = 1")
def latest_revision(spark, d):
    return temporal.latest_revision(listed(spark, d)).select("item_id", "rev_key")


@query(f"WITH {OPEN} SELECT item_id, rev_key FROM raw QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY (valid_to IS NULL) DESC, rev_idx DESC) = 1")
def active_revision_read(spark, d):
    return temporal.active_for_reading(listed(spark, d)).select("item_id", "rev_key")


@query(f"WITH {OPEN} SELECT item_id, rev_key FROM raw QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY (valid_to IS NULL) DESC, CASE WHEN valid_to IS NULL THEN rev_idx ELSE -rev_idx END) = 1")
def active_revision_write(spark, d):
    return temporal.active_for_writing(listed(spark, d)).select("item_id", "rev_key")


@query(f"WITH {TIMELINE} SELECT item_id, rev_key, CAST(valid_to AS VARCHAR) AS expected_to FROM tl")
def close_previous_revision(spark, d):
    return temporal.expected_ends(timeline(spark, d)).select("item_id", "rev_key", day("expected_to"))


@query(f"WITH {TIMELINE} SELECT item_id, rev_key, CAST(valid_to - 1 AS VARCHAR) AS valid_to, CAST(valid_to AS VARCHAR) AS expected_to FROM tl WHERE rev_key % 7 = 0 AND valid_to IS NOT NULL")
def timeline_gaps(spark, d):
    moved = timeline(spark, d).withColumn("valid_to", F.when(F.col("rev_key") % 7 == 0, F.date_sub("valid_to", 1)).otherwise(F.col("valid_to")))
    return temporal.continuity_gaps(moved).select("item_id", "rev_key", day("valid_to"), day("expected_to"))


@query(f"WITH {OPEN} SELECT item_id, count(*) AS n_open FROM raw WHERE valid_to IS NULL GROUP BY item_id HAVING count(*) > 1")
def active_conflict(spark, d):
    return temporal.active_conflicts(listed(spark, d))


@query(f"WITH {OPEN} SELECT item_id, rev_key, rev_key % 3 = 0 AS filled, CAST(CASE WHEN rev_key % 3 <> 0 THEN valid_from WHEN rev_key % 2 = 0 THEN DATE '2017-12-15' ELSE DATE '2016-08-08' END AS VARCHAR) AS valid_from FROM raw")
def missing_valid_from(spark, d):
    t = listed(spark, d).withColumn("valid_from", F.when(F.col("rev_key") % 3 != 0, F.col("valid_from")))
    t = t.withColumn("mod_type", F.when(F.col("rev_key") % 2 == 0, "change")).withColumn("modified_by_id", F.lit(None).cast("string"))
    return temporal.dated(t, F.lit("2017-12-15").cast("date"), F.lit("2016-08-08").cast("date")).select("item_id", "rev_key", "filled", day("valid_from"))


def family(spark, d):
    """Nations' revisions (a month each) refer to their customers; the customers' revisions last 40 days."""
    o = orders(spark, d).join(table(spark, d, "customer").select(F.col("c_custkey").alias("item_id"), "c_nationkey"), "item_id")
    parents = o.where("rev_key % 50 = 0").select(F.col("c_nationkey").alias("item_id"), F.col("item_id").alias("child_id"), F.date_add("valid_from", 20).alias("valid_from"), F.concat(F.lit("n"), F.col("c_nationkey")).alias("modified_by_id"))
    children = listed(spark, d).where("item_id % 10 <> 3").withColumn("valid_to", F.when(F.col("status") != "O", F.date_add("valid_from", 40)))
    return parents, children


FAMILY = """
    par AS (SELECT DISTINCT c_nationkey AS item_id, c_custkey AS child_id, CAST(o_orderdate AS DATE) + 20 AS valid_from FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 50 = 0),
    ch AS (SELECT o_custkey AS c, CAST(o_orderdate AS DATE) AS c_from, CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 40 END AS c_to, o_orderkey AS rev_key,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, o_orderdate, o_orderstatus) AS rev_idx FROM orders WHERE o_custkey % 10 <> 3),
    miss AS (SELECT * FROM par p WHERE NOT EXISTS (SELECT 1 FROM ch WHERE c = child_id AND c_from <= valid_from AND (c_to IS NULL OR valid_from <= c_to)))
"""


@query(f"WITH {FAMILY} SELECT item_id, child_id, CAST(valid_from AS VARCHAR) AS valid_from, CASE WHEN child_id IN (SELECT c FROM ch) THEN 'stale_child_revision' ELSE 'revision_child_missing' END AS category FROM miss")
def stale_child_revision(spark, d):
    return temporal.missing_children(*family(spark, d)).select("item_id", "child_id", day("valid_from"), "category")


SYNC_DAY = "1997-03-21"


@query(f"""WITH {FAMILY}, wanted AS (SELECT child_id, min('n' || item_id) AS modified_by_id FROM par WHERE valid_from <= DATE '{SYNC_DAY}' GROUP BY child_id),
    m AS (SELECT DISTINCT child_id FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM ch WHERE c = child_id AND c_from <= DATE '{SYNC_DAY}' AND (c_to IS NULL OR DATE '{SYNC_DAY}' <= c_to))),
    latest AS (SELECT c, rev_idx FROM ch QUALIFY row_number() OVER (PARTITION BY c ORDER BY c_from DESC, rev_idx) = 1),
    opened AS (SELECT c, min(rev_idx) AS closes FROM ch WHERE c_to IS NULL GROUP BY c)
    SELECT child_id AS item_id, CAST(closes AS VARCHAR) AS closes, coalesce(closes, rev_idx) AS copies, '{SYNC_DAY}' AS valid_from, 'change' AS mod_type, modified_by_id
    FROM m JOIN wanted USING (child_id) JOIN latest ON latest.c = child_id LEFT JOIN opened ON opened.c = child_id""")
def sync_revision_tree(spark, d):
    parents, children = family(spark, d)
    at = F.lit(SYNC_DAY).cast("date")
    parents = parents.where(F.col("valid_from") <= at).withColumn("valid_from", at)
    return temporal.synced_children(parents, children, at).select("item_id", F.col("closes").cast("string").alias("closes"), "copies", day("valid_from"), "mod_type", "modified_by_id")


def items(spark, d) -> DataFrame:
    r = table(spark, d, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("item_id"), F.lit(None).cast("string").alias("parent_item_id"), F.lit("section").alias("item_type"), F.col("r_name").alias("item_number"))
    n = table(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey"), F.concat(F.lit("r"), "n_regionkey"), F.lit("chapter"), "n_name")
    c = table(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey"), F.concat(F.lit("n"), "c_nationkey"), F.lit("article"), "c_mktsegment")
    return r.union(n).union(c)


ITEMS = """
    items AS (SELECT 'r' || r_regionkey AS item_id, NULL AS parent_item_id, 'section' AS item_type, r_name AS item_number FROM region
        UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 'chapter', n_name FROM nation
        UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, 'article', c_mktsegment FROM customer),
    clo AS (SELECT item_id, parent_item_id AS ancestor_id, 1 AS distance FROM items WHERE parent_item_id IS NOT NULL
        UNION ALL SELECT clo.item_id, items.parent_item_id, distance + 1 FROM clo JOIN items ON items.item_id = clo.ancestor_id WHERE items.parent_item_id IS NOT NULL),
    dep AS (SELECT item_id, 1 + coalesce((SELECT max(distance) FROM clo WHERE clo.item_id = items.item_id), 0) AS depth FROM items)
"""


@query(f"WITH RECURSIVE {ITEMS} SELECT item_id, parent_item_id, item_type, item_number, depth FROM items JOIN dep USING (item_id)")
def tree_flatten(spark, d):
    i = items(spark, d)
    return i.join(tree.depths(i, tree.closure(i)), "item_id").select("item_id", "parent_item_id", "item_type", "item_number", "depth")


@query(f"WITH RECURSIVE {ITEMS} SELECT item_id, ancestor_id, distance FROM clo")
def tree_ancestors(spark, d):
    return tree.closure(items(spark, d))


@query(f"WITH RECURSIVE {ITEMS} SELECT item_id, (SELECT count(*) FROM clo WHERE ancestor_id = items.item_id) AS n_descendants FROM items")
def subtree_sizes(spark, d):
    i = items(spark, d)
    return tree.subtree_sizes(i, tree.closure(i))


REQUESTED = "req AS (SELECT 'c' || c_custkey AS item_id FROM customer WHERE c_custkey % 97 = 0 UNION SELECT 'n' || n_nationkey FROM nation WHERE n_nationkey % 9 = 0 UNION SELECT 'x1'), top AS (SELECT item_id FROM req WHERE item_id NOT IN (SELECT item_id FROM clo WHERE ancestor_id IN (SELECT item_id FROM req)))"


def requested(spark, d) -> DataFrame:
    c = table(spark, d, "customer").where("c_custkey % 97 = 0").select(F.concat(F.lit("c"), "c_custkey").alias("item_id"))
    n = table(spark, d, "nation").where("n_nationkey % 9 = 0").select(F.concat(F.lit("n"), "n_nationkey").alias("item_id"))
    return c.union(n).union(spark.createDataFrame([("x1",)], "item_id string"))


@query(f"WITH RECURSIVE {ITEMS}, {REQUESTED}, plan AS (SELECT item_id FROM top UNION SELECT ancestor_id FROM clo WHERE item_id IN (SELECT item_id FROM top)) SELECT item_id, depth, row_number() OVER (ORDER BY depth DESC, item_id) AS step FROM plan JOIN dep USING (item_id)")
def rebuild_order(spark, d):
    i = items(spark, d)
    return tree.rebuild_plan(i, requested(spark, d), tree.closure(i))


@query(f"WITH RECURSIVE {ITEMS}, {REQUESTED} SELECT item_id, depth, row_number() OVER (ORDER BY depth DESC, item_id) AS step FROM top JOIN dep USING (item_id)")
def rebuild_plan(spark, d):
    i = items(spark, d)
    return tree.rebuild_plan(i, requested(spark, d), tree.closure(i), with_ancestors=False)


def regional_items(spark, d) -> DataFrame:
    """items with the region as the document."""
    n = table(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("n"), "n_regionkey")
    i = items(spark, d)
    above = F.when(F.col("item_type") == "article", F.col("parent_item_id")).when(F.col("item_type") == "chapter", F.col("item_id"))
    joined = i.withColumn("above", above).join(n, F.col("above") == F.col("n"), "left")
    return joined.withColumn("npa_id", F.coalesce("n_regionkey", F.substring("item_id", 2, 9).cast("int"))).select("npa_id", *i.columns)


def path_table(spark, d) -> DataFrame:
    """Full paths, and for each nation one that skips its region and names a kind of customer."""
    full = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.concat(F.lit("f"), "n_nationkey").alias("path_id"), F.col("n_regionkey").alias("npa_id"), F.array(F.struct(F.lit("section").alias("type"), F.col("r_name").alias("number")), F.struct(F.lit("chapter").alias("type"), F.col("n_name").alias("number"))).alias("tokens"))
    loose = table(spark, d, "nation").select(F.concat(F.lit("l"), "n_nationkey").alias("path_id"), F.col("n_regionkey").alias("npa_id"), F.array(F.struct(F.lit("chapter").alias("type"), F.col("n_name").alias("number")), F.struct(F.lit("article").alias("type"), F.lit("BUILDING").alias("number"))).alias("tokens"))
    return full.union(loose)


PATHS = "found AS (SELECT 'f' || n_nationkey AS path_id, 'n' || n_nationkey AS item_id FROM nation UNION ALL SELECT 'l' || n_nationkey, 'c' || c_custkey FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING')"


@query(f"WITH {PATHS} SELECT path_id, item_id, count(*) OVER (PARTITION BY path_id) AS n_matches FROM found")
def path_resolve(spark, d):
    return paths.resolved(regional_items(spark, d), path_table(spark, d))


@query(f"WITH {PATHS} SELECT path_id, count(*) AS n_matches FROM found GROUP BY path_id HAVING count(*) > 1")
def ambiguity_report(spark, d):
    found = paths.resolved(regional_items(spark, d), path_table(spark, d))
    return found.where("n_matches > 1").select("path_id", "n_matches").distinct()


@query("SELECT o_orderkey AS item_id, o_custkey AS ref_item_id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 11 <> 0)")
def child_ref_broken(spark, d):
    refs = table(spark, d, "orders").select(F.col("o_orderkey").alias("item_id"), F.col("o_custkey").alias("ref_item_id"))
    return tree.broken_refs(refs, table(spark, d, "customer").where("c_custkey % 11 <> 0").select(F.col("c_custkey").alias("item_id"))).select("item_id", "ref_item_id")


@query("SELECT c_custkey AS item_id, c_nationkey AS parent_item_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 5 = 0)")
def child_ref_missing(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("item_id"), F.col("c_nationkey").alias("parent_item_id"))
    refs = table(spark, d, "orders").where("o_orderkey % 5 = 0").join(c, F.col("o_custkey") == F.col("item_id")).select(F.col("parent_item_id").alias("item_id"), F.col("o_custkey").alias("ref_item_id"))
    return tree.unreferenced_children(c, refs).select("item_id", "parent_item_id")


def lines(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").withColumn("item_id", F.concat_ws("_", "l_orderkey", "l_linenumber"))


@query("SELECT l_orderkey || '_' || l_linenumber AS item_id, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def duplicate_item_id(spark, d):
    return tree.duplicate_ids(lines(spark, d).select("item_id"))


@query("""WITH l AS (SELECT *, l_orderkey || '_' || l_linenumber AS item_id FROM lineitem), k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag) AS copy FROM l)
    SELECT item_id, l_partkey, CASE WHEN copy > 1 THEN item_id || '_double_' || copy ELSE item_id END AS new_id FROM k""")
def double_suffix_repair(spark, d):
    order = [F.col(c) for c in ("l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag")]
    return tree.renamed_duplicates(lines(spark, d), *order).select("item_id", "l_partkey", "new_id")


@query("WITH r AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem), k AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS depth FROM r) SELECT l_orderkey, l_linenumber, CAST(depth AS INTEGER) AS new_level FROM k WHERE l_linenumber <> depth")
def level_repair(spark, d):
    from pyspark.sql import Window

    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    rows = rows.withColumn("depth", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber")))
    return tree.repaired_levels(rows, "l_linenumber", "depth").select("l_orderkey", "l_linenumber", "new_level")


@query("SELECT l_orderkey, CAST(count(*) AS INTEGER) AS n_blocks FROM lineitem GROUP BY l_orderkey HAVING list_sort(list(CAST(l_linenumber AS BIGINT))) <> range(1, count(*) + 1)")
def body_order_invalid(spark, d):
    return tree.disordered_bodies(table(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("""WITH p AS (SELECT *, CASE p_type WHEN 'ECONOMY' THEN 'article' WHEN 'STANDARD' THEN 'part' WHEN 'PROMO' THEN 'point' ELSE 'other' END AS t FROM part)
    SELECT p_partkey AS item_id, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY CASE t WHEN 'article' THEN 3 WHEN 'part' THEN 4 WHEN 'point' THEN 5 ELSE 10 END, p_size, p_partkey) AS INTEGER) AS place FROM p""")
def sibling_order(spark, d):
    kind = F.coalesce(F.try_element_at(text.literal_map({"ECONOMY": "article", "STANDARD": "part", "PROMO": "point"}), F.col("p_type")), F.lit("other"))
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_brand").alias("parent_item_id"), kind.alias("item_type"), F.concat("p_size", F.lit(")")).alias("item_number"))
    return tree.sibling_places(rows, F.col("item_id")).select("item_id", "place")


@query("""WITH l AS (SELECT l_orderkey, l_partkey || '|' || l_linenumber || '|' || coalesce(l_returnflag, '~') AS row FROM lineitem)
    SELECT l_orderkey, md5(string_agg(row, ';' ORDER BY row)) AS fingerprint FROM l GROUP BY l_orderkey""")
def identical_subtree(spark, d):
    return tree.fingerprints(table(spark, d, "lineitem"), ["l_orderkey"], "l_partkey", "l_linenumber", "l_returnflag")


@query("""WITH o AS (SELECT o_orderkey, o_orderpriority AS old_value FROM orders WHERE o_orderkey % 7 <> 0), n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '0-NEW' ELSE o_orderpriority END AS new_value FROM orders WHERE o_orderkey % 11 <> 0)
    SELECT o_orderkey, old_value, new_value, CASE WHEN o.o_orderkey IS NULL THEN 'add' WHEN n.o_orderkey IS NULL THEN 'close' WHEN old_value IS NOT DISTINCT FROM new_value THEN 'keep' ELSE 'change' END AS action FROM o FULL JOIN n USING (o_orderkey)""")
def tree_merge(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("v"))
    new = o.where("o_orderkey % 11 <> 0").withColumn("v", F.when(F.col("o_orderkey") % 5 == 0, "0-NEW").otherwise(F.col("v")))
    return tree.merge_actions(o.where("o_orderkey % 7 <> 0"), new, ["o_orderkey"], "v")


@query("""WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 7 <> 0), n AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 11 <> 0)
    SELECT o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'added' WHEN n.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change FROM o FULL JOIN n USING (o_orderkey)
    WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.o_custkey IS DISTINCT FROM n.o_custkey OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus""")
def snapshot_diff(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    new = o.where("o_orderkey % 11 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")))
    return history.snapshot_diff(o.where("o_orderkey % 7 <> 0"), new, "o_orderkey", ["o_custkey", "o_orderstatus"])


def amendments(spark, d) -> DataFrame:
    """A change for each customer but those divisible by 4, of a kind by key; some of unknown items."""
    c = table(spark, d, "customer").select((F.col("c_custkey") + F.when(F.col("c_custkey") % 13 == 0, 10_000_000).otherwise(0)).alias("item_id"), F.col("c_custkey").alias("seq")).where("seq % 4 <> 0")
    kind = F.element_at(F.array(*map(F.lit, ("add", "change", "new_redaction", "delete"))), (F.col("seq") % 5 % 4 + 1).cast("int"))
    return c.select("item_id", "seq", kind.alias("type"), F.concat(F.lit("v"), "seq").alias("new_value"), F.lit("2017-12-15").cast("date").alias("valid_from"), F.lit("s1").alias("modified_by_id"))


AMENDED = f"""{TIMELINE},
    ch AS (SELECT c_custkey + CASE WHEN c_custkey % 13 = 0 THEN 10000000 ELSE 0 END AS item_id, c_custkey AS seq, ['add', 'change', 'new_redaction', 'delete'][c_custkey % 5 % 4 + 1] AS type FROM customer WHERE c_custkey % 4 <> 0),
    ok AS (SELECT * FROM ch WHERE type = 'add' OR item_id IN (SELECT item_id FROM tl)),
    closed AS (SELECT tl.item_id, rev_idx, valid_from, CASE WHEN valid_to IS NULL AND type <> 'add' THEN DATE '2017-12-14' ELSE valid_to END AS valid_to, status AS value, NULL AS mod_type,
        CASE WHEN valid_to IS NULL AND type = 'delete' THEN '2017-12-15' END AS not_valid FROM tl LEFT JOIN ok ON ok.item_id = tl.item_id),
    fresh AS (SELECT item_id, coalesce((SELECT max(rev_idx) FROM tl WHERE tl.item_id = ok.item_id), 0) + 1 AS rev_idx, DATE '2017-12-15' AS valid_from, CAST(NULL AS DATE) AS valid_to, 'v' || seq AS value, type AS mod_type, NULL AS not_valid FROM ok WHERE type <> 'delete'),
    after AS (SELECT * FROM closed UNION ALL SELECT * FROM fresh)"""


def amended(spark, d) -> DataFrame:
    none = F.lit(None).cast("string")
    t = timeline(spark, d).select("item_id", "rev_idx", "valid_from", "valid_to", F.col("status").alias("value"), none.alias("mod_type"), none.alias("modified_by_id"), none.alias("not_valid"))
    return amend.applied(t, amendments(spark, d))


@query(f"WITH {AMENDED} SELECT item_id, CAST(rev_idx AS INTEGER) AS rev_idx, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to, value, mod_type, not_valid FROM after")
def amendment_scd2(spark, d):
    return amended(spark, d).select("item_id", "rev_idx", day("valid_from"), day("valid_to"), "value", "mod_type", "not_valid")


@query(f"WITH {AMENDED} SELECT item_id, seq, type FROM ch WHERE type <> 'add' AND item_id NOT IN (SELECT item_id FROM tl)")
def change_unresolved(spark, d):
    return amend.unresolved(timeline(spark, d), amendments(spark, d)).select("item_id", "seq", "type")


@query(f"WITH {AMENDED} SELECT item_id, seq, type, type = 'add' OR item_id IN (SELECT item_id FROM tl) AS passed FROM ch")
def change_outcomes(spark, d):
    return amend.outcomes(amendments(spark, d), amended(spark, d))


REV = "act AS (SELECT * FROM tl WHERE valid_to IS NULL AND item_id % 6 = 0)"


@query(f"WITH {TIMELINE}, {REV} SELECT item_id, CAST(rev_idx AS INTEGER) AS rev_idx, 'closed' AS step, CAST(valid_from AS VARCHAR) AS valid_from, '2019-12-31' AS valid_to, TRUE AS not_valid FROM act UNION ALL SELECT item_id, CAST(rev_idx + 1 AS INTEGER), 'delete', '2020-01-01', NULL, FALSE FROM act")
def revocation(spark, d):
    r = table(spark, d, "customer").where("c_custkey % 6 = 0").select(F.col("c_custkey").alias("item_id"), F.lit("2020-01-01").cast("date").alias("valid_from"))
    return amend.revoked(timeline(spark, d), r).select("item_id", "rev_idx", "step", day("valid_from"), day("valid_to"), "not_valid")


@query(f"WITH {TIMELINE}, {REV} SELECT item_id, CAST(rev_idx AS INTEGER) AS rev_idx, 'closed' AS step, CAST(valid_from AS VARCHAR) AS valid_from, '2019-12-31' AS valid_to FROM act UNION ALL SELECT item_id, CAST(rev_idx + 1 AS INTEGER), 'new_redaction', '2020-01-01', NULL FROM act")
def special_valid_from(spark, d):
    r = table(spark, d, "customer").where("c_custkey % 6 = 0").select(F.col("c_custkey").alias("item_id"), F.lit("2020-01-01").cast("date").alias("valid_from"))
    return amend.specially_dated(timeline(spark, d), r).select("item_id", "rev_idx", "step", day("valid_from"), day("valid_to"))


@query("SELECT c_custkey AS item_id, 'own' AS note, NULL AS valid_from FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, 'applies from 1999-01-01', '1999-01-01' FROM customer WHERE c_custkey % 8 = 0")
def retroactive_note(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("item_id"))
    notes = c.where("item_id % 3 = 0").select("item_id", F.lit("own").alias("note"), F.lit(None).cast("date").alias("valid_from"))
    found = amend.with_notes(notes, c.where("item_id % 8 = 0").withColumn("valid_from", F.lit("1999-01-01").cast("date")), F.concat(F.lit("applies from "), dates.format_iso(F.col("valid_from"))))
    return found.select("item_id", "note", day("valid_from"))


@query("""WITH c AS (SELECT o_orderkey AS seq, o_orderpriority AS base_key, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey, o_custkey) - 1 AS pos FROM orders),
    a AS (SELECT p_partkey, p_name, ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'][p_partkey % 5 + 1] AS base_key, p_partkey // 5 AS pos FROM part)
    SELECT seq, base_key, CAST(pos AS INTEGER) AS pos, p_name AS answer FROM c LEFT JOIN a USING (base_key, pos)""")
def stage_answer_lookup(spark, d):
    c = table(spark, d, "orders").select(F.col("o_orderkey").alias("seq"), F.col("o_orderpriority").alias("base_key"))
    keys = F.array(*map(F.lit, ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")))
    a = table(spark, d, "part").select(F.element_at(keys, (F.col("p_partkey") % 5 + 1).cast("int")).alias("base_key"), F.floor(F.col("p_partkey") / 5).cast("int").alias("pos"), F.col("p_name").alias("answer"))
    return amend.stage_answers(c, a).select("seq", "base_key", "pos", "answer")


@query("SELECT doc_id, source, CAST(row_number() OVER (PARTITION BY source ORDER BY lang, n_chars, doc_id) AS INTEGER) AS step FROM documents")
def chain_order(spark, d):
    return amend.chain_order(table(spark, d, "documents"), ["source"], F.col("lang"), F.col("n_chars"), F.col("doc_id")).select("doc_id", "source", "step")


def log(spark, d) -> DataFrame:
    kinds = text.literal_map({"purchase": "verified_success", "error": "verified_failure", "signup": "apply_failure", "click": "resolved"})
    return table(spark, d, "events").select(F.concat(F.lit("u"), "user_id").alias("element"), F.get_json_object("props", "$.k").cast("int").alias("k"), F.coalesce(F.try_element_at(kinds, F.col("event_type")), F.lit("unknown")).alias("outcome"), F.col("event_id").alias("item_id"), F.col("event_id").alias("ts"))


LOG = """log AS (SELECT 'u' || user_id AS element, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_id AS ts,
    CASE event_type WHEN 'purchase' THEN 'verified_success' WHEN 'error' THEN 'verified_failure' WHEN 'signup' THEN 'apply_failure' WHEN 'click' THEN 'resolved' ELSE 'unknown' END AS outcome FROM events),
    m AS (SELECT element, count(*) FILTER (outcome = 'verified_success') AS success, count(*) FILTER (outcome = 'verified_failure') AS failure, count(*) FILTER (outcome = 'apply_failure') AS apply_failure,
    count(*) FILTER (outcome = 'resolved') AS telemetry FROM log GROUP BY element)"""


@query(f"WITH {LOG} SELECT outcome, count(*) AS n, count(DISTINCT element) AS n_elements FROM log GROUP BY outcome")
def outcome_stats(spark, d):
    return log(spark, d).groupBy("outcome").agg(F.count("*").alias("n"), F.countDistinct("element").alias("n_elements"))


@query(f"WITH {LOG} SELECT element, CAST(k % 7 AS VARCHAR) AS category, count(*) AS n, max(ts) AS last_ts FROM log WHERE outcome IN ('verified_failure', 'apply_failure') GROUP BY 1, 2 ORDER BY n DESC, element, category LIMIT 10")
def failure_topk(spark, d):
    return history.failure_patterns(log(spark, d).withColumn("category", (F.col("k") % 7).cast("string")), 10)


@query(f"WITH {LOG} SELECT element, success, failure, apply_failure, telemetry, round(success / (success + failure + apply_failure + 2), 6) AS confidence FROM m")
def mapping_confidence(spark, d):
    return history.mapping_counts(log(spark, d), ["element"]).withColumn("confidence", F.round("confidence", 6))


@query(f"WITH {LOG} SELECT element, success, failure + apply_failure AS failures FROM m WHERE success > 0 AND failure + apply_failure > 0")
def contested_mapping(spark, d):
    return history.contested_mappings(log(spark, d), ["element"]).select("element", "success", (F.col("failure") + F.col("apply_failure")).alias("failures"))


@query(f"WITH {LOG} SELECT element, (SELECT max(ts) FROM log l WHERE l.element = m.element AND outcome = 'verified_success') AS item_id FROM m WHERE success > 0 AND success / (success + failure + apply_failure + 2) >= 0.33")
def reliable_mapping(spark, d):
    return history.reliable_mappings(log(spark, d), ["element"]).select("element", "item_id")


@query(f"WITH {LOG}, r AS (SELECT element, CAST(k % 7 AS VARCHAR) AS category, count(*) FILTER (k % 2 = 0) AS s, count(*) FILTER (k % 2 <> 0) AS f, arg_max('try ' || k, ts) AS suggestion FROM log GROUP BY 1, 2) SELECT element, category, suggestion FROM r WHERE s > 0 AND s >= f")
def recovery_success(spark, d):
    rows = log(spark, d).select("element", (F.col("k") % 7).cast("string").alias("category"), (F.col("k") % 2 == 0).alias("success"), F.concat(F.lit("try "), "k").alias("suggestion"), "ts")
    return history.recovery_suggestions(rows)


@query(f"WITH {LOG} SELECT element || '_' || (k % 10) AS run, bool_or(outcome = 'verified_success') AND NOT bool_or(outcome NOT IN ('verified_success', 'resolved')) AS trusted FROM log GROUP BY 1")
def run_trust_flags(spark, d):
    return history.run_trust(log(spark, d).withColumn("run", F.concat_ws("_", "element", F.col("k") % 10)), "run")


@query("""WITH t AS (SELECT o_orderkey, o_orderkey % 4 <> 3 AS good, CAST(o_orderdate AS DATE) AS dt FROM orders)
    SELECT o_orderkey, CASE WHEN good THEN CAST(dt AS VARCHAR) END AS parsed, CASE WHEN good THEN strftime(dt, '%d.%m.%Y') ELSE '' END AS shown, NOT good AS bad FROM t""")
def date_parse(spark, d):
    k = F.col("o_orderkey") % 4
    written = F.when(k == 0, F.date_format("o_orderdate", "dd.MM.yyyy")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 2, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.concat(F.lit("99."), F.date_format("o_orderdate", "MM.yyyy")))
    rows = table(spark, d, "orders").select("o_orderkey", written.alias("w"))
    return rows.select("o_orderkey", F.date_format(dates.parse_date(F.col("w")), "yyyy-MM-dd").alias("parsed"), dates.format_date(dates.parse_date(F.col("w"))).alias("shown"), dates.bad_date(F.col("w")).alias("bad"))


@query("SELECT p_partkey, CAST(p_size AS VARCHAR) AS clean, CAST(p_size AS VARCHAR) || ')' AS shown, CAST(CAST(p_size AS VARCHAR) || CAST(p_partkey % 9 AS VARCHAR) AS BIGINT) AS pair FROM part")
def number_normalize(spark, d):
    rows = table(spark, d, "part").select("p_partkey", F.concat(F.lit("«"), "p_size", F.element_at(F.array(*map(F.lit, (")", ".", "", ".)"))), (F.col("p_partkey") % 4 + 1).cast("int"))).alias("n"), F.col("p_size"))
    pair = numbers.number_tuple(F.concat("p_size", F.lit("."), F.col("p_partkey") % 9, F.lit(")")))
    return rows.select("p_partkey", numbers.clean_number(F.col("n")).alias("clean"), numbers.item_number(F.lit("point"), F.col("p_size")).alias("shown"), F.concat(*[F.element_at(pair, i).cast("string") for i in (1, 2)]).cast("long").alias("pair"))


@query("""WITH RECURSIVE v(val, sym, i) AS (VALUES (1000,'M',1),(900,'CM',2),(500,'D',3),(400,'CD',4),(100,'C',5),(90,'XC',6),(50,'L',7),(40,'XL',8),(10,'X',9),(9,'IX',10),(5,'V',11),(4,'IV',12),(1,'I',13)),
    p AS (SELECT p_partkey, p_partkey % 399 + 1 AS n FROM part), r AS (SELECT DISTINCT n, n AS rest, '' AS s FROM p UNION ALL SELECT n, rest - val, s || sym FROM r JOIN v ON val = (SELECT max(val) FROM v WHERE val <= rest) WHERE rest > 0)
    SELECT p_partkey, s AS roman, n AS value FROM p JOIN r USING (n) WHERE rest = 0""")
def roman_numbers(spark, d):
    place = lambda unit, one, five, ten: F.element_at(F.array(*map(F.lit, ("", one, one * 2, one * 3, one + five, five, five + one, five + one * 2, five + one * 3, one + ten))), (F.floor(F.col("n") / unit) % 10 + 1).cast("int"))
    rows = table(spark, d, "part").select("p_partkey", (F.col("p_partkey") % 399 + 1).alias("n"))
    roman = F.concat(place(100, "C", "D", "M"), place(10, "X", "L", "C"), place(1, "I", "V", "X"))
    return rows.select("p_partkey", roman.alias("roman"), numbers.roman_value(roman).cast("long").alias("value"))


@query(r"SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '[\s\x{00A0}\x{0085}\x{2000}-\x{200A}\x{2028}\x{2029}\x{3000}]+', ' ', 'g')) AS txt FROM pages")
def text_clean(spark, d):
    return table(spark, d, "pages").select("page_id", text.without_tags(F.col("html")).alias("txt"))


SPACES = r"[\s\x{00A0}\x{0085}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


@query(rf"""WITH p AS (SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '{SPACES}', ' ', 'g')) AS whole,
    list_filter(list_transform(regexp_extract_all(html, '(?is)<p[^>]*>(.*?)</p>', 1), lambda x: trim(regexp_replace(regexp_replace(x, '<[^>]+>', '', 'g'), '{SPACES}', ' ', 'g'))), lambda x: x <> '') AS found FROM pages)
    SELECT page_id, md5(array_to_string(CASE WHEN len(found) > 0 THEN found WHEN whole <> '' THEN [whole] ELSE [] END, '|')) AS h, CASE WHEN len(found) > 0 THEN len(found) WHEN whole <> '' THEN 1 ELSE 0 END AS n FROM p""")
def html_paragraphs(spark, d):
    found = text.paragraphs(F.col("html"))
    return table(spark, d, "pages").select("page_id", F.md5(F.array_join(found, "|")).alias("h"), F.size(found).cast("long").alias("n"))


@query("""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS paragraph, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents) SELECT doc_id, CAST(pos AS INTEGER) AS pos, md5(paragraph) AS h FROM p""")
def paragraph_split(spark, d):
    rows = highlights.paragraph_rows(table(spark, d, "documents"), "doc_id", F.split("text", "\n"))
    return rows.select("doc_id", "pos", F.md5("paragraph").alias("h"))


@query("""WITH o AS (SELECT o_orderkey, o_orderkey % 3 + 1 AS n FROM orders), a AS (SELECT o_orderkey, unnest(range(1, n + 1)) AS pos FROM o), b AS (SELECT o_orderkey, unnest(range(1, o_orderkey % 2 + 2)) AS pos FROM o),
    j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(a.pos, b.pos) AS pos, a.pos IS NULL AS no_a, b.pos IS NULL AS no_b FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey AND a.pos = b.pos)
    SELECT o_orderkey, CAST(pos AS INTEGER) AS pos, CASE WHEN no_a THEN 'addition' WHEN no_b THEN 'deletion' ELSE 'difference' END AS side,
    CASE WHEN no_a THEN '' WHEN no_b THEN 'the old text' ELSE 'old' END AS old_text, CASE WHEN no_a THEN 'the new text' WHEN no_b THEN '' ELSE 'new' END AS new_text FROM j""")
def paragraph_diff(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    old = highlights.paragraph_rows(o, "o_orderkey", F.array_repeat(F.lit("the old text"), (F.col("o_orderkey") % 3 + 1).cast("int")))
    new = highlights.paragraph_rows(o, "o_orderkey", F.array_repeat(F.lit("the new text"), (F.col("o_orderkey") % 2 + 1).cast("int")))
    return highlights.differences(old, new, "o_orderkey")


@query("SELECT o_orderkey, 'a' || o_custkey AS old, 'b' || o_orderkey AS new FROM orders UNION ALL SELECT o_orderkey, 'c', 'd' FROM orders WHERE o_orderkey % 2 = 0")
def replacement_pairs(spark, d):
    told = F.concat(F.lit("слова «a"), "o_custkey", F.lit("» заменить словами «b"), "o_orderkey", F.lit("»"), F.when(F.col("o_orderkey") % 2 == 0, ", цифру «c» заменить «d»").otherwise(""))
    rows = table(spark, d, "orders").select("o_orderkey", F.explode(text.replacement_pairs(told)).alias("p"))
    return rows.select("o_orderkey", "p.old", "p.new")


KINDS = ("слова «a» заменить словами «b»", "пункт 3 исключить", "статью 5 изложить в следующей редакции", "дополнить пунктом 7", "исключить это", "иное")


@query("SELECT o_orderkey, ['change', 'delete', 'new_redaction', 'add', 'change', 'change'][o_orderkey % 6 + 1] AS kind FROM orders")
def change_type_classify(spark, d):
    told = F.element_at(F.array(*map(F.lit, KINDS)), (F.col("o_orderkey") % 6 + 1).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", text.change_type(told).alias("kind"))


@query("SELECT o_orderkey, CAST(unnest(list_concat(range(o_orderkey % 9 + 1, o_orderkey % 9 + 4), [20])) AS INTEGER) AS number FROM orders")
def plural_delete_split(spark, d):
    a = F.col("o_orderkey") % 9 + 1
    told = F.concat(F.lit("пункты "), a, F.lit("-"), a + 2, F.lit(", 20"))
    return table(spark, d, "orders").select("o_orderkey", F.explode(text.listed_numbers(told)).alias("number"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN (c_custkey % 50 + 2) || '-1' ELSE (c_custkey % 50) || '-1' END AS position FROM customer WHERE c_custkey % 50 >= 0 AND (c_custkey % 3 <> 0 OR c_custkey % 50 >= 0)")
def shift_highlights(spark, d):
    k = F.col("c_custkey") % 50
    return table(spark, d, "customer").select("c_custkey", numbers.shift_position(F.concat(k, F.lit("-1")), F.when(F.col("c_custkey") % 3 == 0, F.lit(0)).otherwise(F.lit(999)), F.lit(2)).alias("position"))


@query("SELECT o_orderkey, unnest(CASE o_orderkey % 3 WHEN 0 THEN ['1-1', '2-all'] WHEN 1 THEN ['1-' || (o_orderkey % 5)] ELSE ['3-2'] END) AS position FROM orders")
def highlight_positions(spark, d):
    k = F.col("o_orderkey") % 3
    rows = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 5).alias("seq"), F.when(k == 0, "1-1, 2-all").when(k == 1, "").otherwise("3-2").alias("position"))
    return highlights.normal_positions(rows).select("o_orderkey", "position")


def issue_rows(spark, d) -> DataFrame:
    i = items(spark, d)
    i = i.join(tree.depths(i, tree.closure(i)), "item_id").withColumn("item_level", F.when(F.col("item_id").endswith("7"), F.lit(None)).otherwise(F.col("depth"))).withColumn("item_type", F.when(F.col("item_id").endswith("9"), "odd").otherwise(F.col("item_type")))
    return verify.item_checks(i)


ISSUES = "issues AS (SELECT 'item_level_invalid' AS category, 'error' AS severity, item_id AS element FROM items WHERE item_id LIKE '%7' UNION ALL SELECT 'item_type_invalid', 'error', item_id FROM items WHERE item_id LIKE '%9')"


@query(f"WITH RECURSIVE {ITEMS}, {ISSUES} SELECT * FROM issues")
def verify_items(spark, d):
    return issue_rows(spark, d).drop("message")


@query(f"WITH RECURSIVE {ITEMS}, {ISSUES} SELECT severity, category, count(*) AS n FROM issues GROUP BY ROLLUP (severity, category)")
def verification_stats(spark, d):
    return verify.stats(issue_rows(spark, d))


@query(f"WITH {OPEN}, l AS (SELECT *, lead(valid_from) OVER (PARTITION BY item_id ORDER BY rev_idx) - 1 AS e FROM raw) SELECT 'date_continuity' AS category, CAST(item_id AS VARCHAR) AS element FROM l WHERE valid_to IS NOT NULL AND e IS NOT NULL AND valid_to <> e UNION ALL SELECT 'revision_active_conflict', CAST(item_id AS VARCHAR) FROM raw WHERE valid_to IS NULL GROUP BY item_id HAVING count(*) > 1 UNION ALL SELECT 'revision_missing', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey NOT IN (SELECT item_id FROM raw)")
def verify_revisions(spark, d):
    return verify.revision_checks(table(spark, d, "customer").select(F.col("c_custkey").alias("item_id")), listed(spark, d)).select("category", "element")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS element, CASE WHEN o_orderkey % 3 = 0 THEN 'modified_by_id_bare' ELSE 'modified_by_id_format' END AS category FROM orders WHERE o_orderkey % 3 <> 1")
def modified_by_format(spark, d):
    k = F.col("o_orderkey") % 3
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("item_id"), F.when(k == 0, F.col("o_custkey").cast("string")).when(k == 1, F.concat("o_custkey", F.lit("_article_4_part_1, 5_point_2"))).otherwise("Article 4").alias("modified_by_id"))
    return verify.changer_checks(rows).select("element", "category")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS element, CASE WHEN o_orderkey % 4 = 1 THEN 'source_date_missing' ELSE 'source_date_invalid' END AS category FROM orders WHERE o_orderkey % 4 IN (1, 2)")
def preflight_source_dates(spark, d):
    k = F.col("o_orderkey") % 4
    rows = table(spark, d, "orders").select("o_orderkey", F.when(k == 1, " ").when(k == 2, "not-a-date").otherwise(F.date_format("o_orderdate", "dd.MM.yyyy")).alias("w"))
    return verify.preflight_dates(rows, "o_orderkey", "w").select("element", "category")


@query("SELECT 'description_contains_full_html' AS category, CAST(doc_id AS VARCHAR) AS element FROM documents WHERE n_chars + 7 > 500 AND doc_id % 2 = 0 AND length(text) + 7 > 500 UNION ALL SELECT 'description_contains_full_html_for_new_redaction', CAST(doc_id AS VARCHAR) FROM documents WHERE doc_id % 6 = 0")
def verify_descriptions(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("change_id"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<p>"), "text", F.lit("</p>"))).otherwise(F.col("text")).alias("description"), F.when(F.col("doc_id") % 3 == 0, "new_redaction").otherwise("change").alias("type"))
    return verify.description_checks(rows).select("category", "element")


@query("SELECT o_orderkey, o_orderkey || '_' || strftime(o_orderdate, '%Y_%m_%d') || '_izm_' || o_custkey || '_' || strftime(CAST(o_orderdate AS DATE) + 9, '%Y_%m_%d') || '.json' AS name FROM orders")
def result_names(spark, d):
    from lexstrata.sources.documents import result_name

    rows = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("№ "), "o_orderkey", F.lit("-зс")).alias("a"), F.col("o_orderdate").alias("b"), F.col("o_custkey").cast("string").alias("c"), F.date_add(F.col("o_orderdate").cast("date"), 9).alias("e"))
    return rows.select("o_orderkey", result_name("a", "b", "c", "e").alias("name"))


@query("SELECT 'order_' || o_orderkey AS path, 'i' || o_orderkey AS item_id, NULL AS parent_item_id, 'article' AS item_type, CAST(o_custkey AS VARCHAR) AS item_number, 1 AS depth, '0' AS place FROM orders UNION ALL SELECT 'order_' || o_orderkey, 'i' || o_orderkey || '_p', 'i' || o_orderkey, 'point', '1)', 2, '0.0' FROM orders")
def json_ingest(spark, d):
    from lexstrata.sources.documents import flatten_items, parsed

    raw = F.format_string('{"npa_items_revision": [{"item_id": "i%d", "item_type": "article", "item_number": "%d", "item_level": 1, "item_children": [{"item_id": "i%d_p", "item_type": "point", "item_number": "1)", "item_level": 2}]}]}', "o_orderkey", "o_custkey", "o_orderkey")
    docs = parsed(table(spark, d, "orders").select(F.concat(F.lit("order_"), "o_orderkey").alias("path"), raw.alias("raw")))
    return flatten_items(docs, 3).select("path", "item_id", "parent_item_id", "item_type", "item_number", "depth", F.array_join(F.transform("sort_path", lambda x: x.cast("string")), ".").alias("place"))


@query("""WITH b AS (SELECT l_orderkey AS item_id, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ord FROM lineitem WHERE l_linenumber <> 3),
    n AS (SELECT DISTINCT l_orderkey AS item_id FROM lineitem WHERE l_linenumber = 3)
    SELECT 1 AS k, count(*) AS n_blocks, CAST(sum(CASE WHEN l_linenumber < 3 THEN 1 ELSE 0 END) AS BIGINT) AS before FROM b WHERE item_id IN (SELECT item_id FROM n)""")
def child_ref_insert(spark, d):
    from pyspark.sql import Window

    from lexstrata.operators.bodies import with_references

    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("item_id"), F.col("l_linenumber").alias("ref_item_id"), "l_partkey", "l_suppkey", "l_extendedprice")
    w = Window.partitionBy("item_id").orderBy("ref_item_id", "l_partkey", "l_suppkey", "l_extendedprice")
    old = rows.where("ref_item_id <> 3").withColumn("ord", F.row_number().over(w)).select("item_id", "ord", "ref_item_id")
    places = rows.select("ref_item_id", F.col("ref_item_id").alias("place")).distinct()
    new = with_references(old, rows.where("ref_item_id = 3").select("item_id", "ref_item_id").distinct(), places)
    added = new.where("ref_item_id = 3").select("item_id", F.col("ord").alias("own"))
    return new.join(added, "item_id").where("ref_item_id <> 3").agg(F.lit(1).alias("k"), F.count("*").alias("n_blocks"), F.sum((F.col("ord") < F.col("own")).cast("long")).alias("before"))


@query("SELECT o_orderkey, unnest(CASE WHEN o_orderkey % 3 = 0 THEN ['p1', 'p2', CAST(o_custkey AS VARCHAR)] ELSE ['p1', CAST(o_custkey AS VARCHAR)] END) AS block, unnest(CASE WHEN o_orderkey % 3 = 0 THEN [1, 2, 3] ELSE [1, 2] END) AS ord FROM orders")
def body_rewrite(spark, d):
    from lexstrata.operators.bodies import rewritten

    o = table(spark, d, "orders")
    old = o.select("o_orderkey", F.lit(4).alias("ord"), F.col("o_custkey").alias("ref_item_id"))
    texts = highlights.paragraph_rows(o, "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit("p1"), F.lit("p2"))).otherwise(F.array(F.lit("p1")))).withColumnRenamed("paragraph", "html_text")
    return rewritten(old, texts, "o_orderkey").select("o_orderkey", F.coalesce("html_text", "ref_item_id").alias("block"), "ord")


POINTS = ("a;", "b;", "c.", "d.")


@query("SELECT c_custkey AS parent_item_id, unnest(['1)', '2)', '3)', '4)']) AS item_number, unnest(['a;', 'b;', 'c;', 'd.']) AS new_text FROM customer")
def punctuation_after_addition(spark, d):
    from lexstrata.operators.bodies import after_addition

    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("parent_item_id"), F.posexplode(F.array(*map(F.lit, POINTS))).alias("k", "text"))
    rows = rows.select("parent_item_id", F.concat(F.col("k") + 1, F.lit(")")).alias("item_number"), "text", (F.col("k") == 3).alias("added"))
    return after_addition(rows).select("parent_item_id", "item_number", "new_text")


@query("SELECT c_custkey AS parent_item_id, unnest(['1)', '2)', '3)']) AS item_number, unnest(['a;', CASE WHEN c_custkey % 2 = 0 THEN 'b.' ELSE 'b;' END, 'c.']) AS new_text FROM customer")
def punctuation_after_deletion(spark, d):
    from lexstrata.operators.bodies import after_deletion

    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("parent_item_id"), F.posexplode(F.array(*map(F.lit, POINTS[:3]))).alias("k", "text"))
    rows = rows.select("parent_item_id", F.concat(F.col("k") + 1, F.lit(")")).alias("item_number"), "text", ((F.col("k") == 2) & (F.col("parent_item_id") % 2 == 0)).alias("deleted"))
    return after_deletion(rows).select("parent_item_id", "item_number", "new_text")


@query("WITH p AS (SELECT p_partkey, p_brand, p_size, row_number() OVER (PARTITION BY p_brand, p_size ORDER BY p_partkey) + CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END AS k FROM part) SELECT p_partkey AS seq, p_brand || '_point_' || p_size || CASE WHEN k > 1 THEN '_' || k ELSE '' END AS item_id FROM p")
def new_item_ids(spark, d):
    from lexstrata.operators.bodies import new_ids

    p = table(spark, d, "part")
    known = p.where("p_size % 2 = 0").select(F.concat_ws("_", "p_brand", F.lit("point"), "p_size").alias("item_id")).distinct()
    added = p.select(F.col("p_partkey").alias("seq"), F.col("p_brand").alias("parent_item_id"), F.lit("point").alias("item_type"), F.concat("p_size", F.lit(")")).alias("item_number"))
    return new_ids(added, known).select("seq", "item_id")


@query("WITH s AS (SELECT n_nationkey AS c, n_regionkey AS r, n_nationkey * 10 AS top FROM nation), w AS (SELECT DISTINCT c_nationkey % 5 AS r, c_custkey % 260 AS number FROM customer) SELECT w.r AS parent_item_id, number, arg_max(c, top) AS container_id FROM w JOIN s ON s.r = w.r AND top <= number GROUP BY 1, 2")
def container_choice(spark, d):
    from lexstrata.operators.bodies import containers

    s = table(spark, d, "nation").select(F.col("n_nationkey").alias("container_id"), F.col("n_regionkey").alias("parent_item_id"), (F.col("n_nationkey") * 10).alias("top"))
    w = table(spark, d, "customer").select((F.col("c_nationkey") % 5).alias("parent_item_id"), (F.col("c_custkey") % 260).alias("number")).distinct()
    return containers(s, w)


@query("""WITH n AS (SELECT n_regionkey, n_nationkey, n_name || coalesce((SELECT string_agg(chr(10) || c_name, '' ORDER BY c_custkey) FROM customer WHERE c_nationkey = n_nationkey), '') AS t FROM nation)
    SELECT 'r' || r_regionkey AS root_id, md5(r_name || (SELECT string_agg(chr(10) || t, '' ORDER BY n_nationkey) FROM n WHERE n_regionkey = r_regionkey)) AS h FROM region""")
def render_tree(spark, d):
    from lexstrata.operators.bodies import rendered_tree

    none = F.lit(None).cast("string")
    own = lambda t, i, text_: table(spark, d, t).select(F.concat(F.lit(t[0]), i).alias("item_id"), F.lit(0).alias("ord"), F.col(text_).alias("html_text"), none.alias("ref_item_id"))
    ref = lambda t, i, up, p: table(spark, d, t).select(F.concat(F.lit(p), up).alias("item_id"), (F.col(i) + 1).cast("int").alias("ord"), none.alias("html_text"), F.concat(F.lit(t[0]), i).alias("ref_item_id"))
    blocks = own("region", "r_regionkey", "r_name").union(own("nation", "n_nationkey", "n_name")).union(own("customer", "c_custkey", "c_name")).union(ref("nation", "n_nationkey", "n_regionkey", "r")).union(ref("customer", "c_custkey", "c_nationkey", "n"))
    roots = table(spark, d, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("root_id"))
    return rendered_tree(roots, blocks, 3).select("root_id", F.md5("html").alias("h"))


@query(r"WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS b FROM documents) SELECT doc_id, md5(array_to_string(CASE WHEN doc_id % 3 = 0 THEN b ELSE list_concat(b[1:2], b[4:4]) END, '|')) AS h FROM p")
def paragraph_select(spark, d):
    from lexstrata.operators.bodies import selected

    spec = F.when(F.col("doc_id") % 3 == 0, "all").otherwise("1-2,4")
    return table(spark, d, "documents").select("doc_id", F.md5(F.array_join(selected(F.split("text", "\n"), spec), "|")).alias("h"))


@query("""WITH p AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 10 = 0), a AS (SELECT DISTINCT l_orderkey FROM p)
    SELECT 'a' || l_orderkey || '_part_1_point_' || l_linenumber AS item_id, 'a' || l_orderkey || '_part_1' AS parent_item_id, 'point' AS item_type FROM p
    UNION ALL SELECT 'a' || l_orderkey || '_part_1', 'a' || l_orderkey, 'part' FROM a UNION ALL SELECT 'a' || l_orderkey || '_part_2', 'a' || l_orderkey, 'part' FROM a""")
def reorganisation(spark, d):
    from lexstrata.operators.bodies import reorganised

    rows = table(spark, d, "lineitem").select(F.concat(F.lit("a"), "l_orderkey").alias("parent_item_id"), "l_orderkey", "l_linenumber").distinct()
    points = rows.select(F.concat_ws("_", "parent_item_id", F.lit("point"), "l_linenumber").alias("item_id"), "parent_item_id", F.concat("l_linenumber", F.lit(")")).alias("item_number"))
    hit = rows.where("l_orderkey % 10 = 0").select("parent_item_id").distinct()
    return reorganised(points, hit, hit.withColumn("item_number", F.lit("2."))).select("item_id", "parent_item_id", "item_type")


@query("""WITH o AS (SELECT o_orderkey, o_orderkey % 3 + 1 AS a, o_orderkey % 4 AS b FROM orders), k AS (SELECT o_orderkey, unnest(range(1, least(a, b) + 1)) AS k FROM o)
    SELECT o_orderkey, 'old' AS old_text, 'fresh' AS new_text, '1-' || k AS position FROM k""")
def declared_replacement(spark, d):
    pairs = F.array(F.struct(F.lit("old").alias("old"), F.lit("fresh").alias("new")))
    rows = table(spark, d, "orders").select("o_orderkey", F.lit(1).alias("pos"), F.repeat(F.lit("an old "), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("old"), F.repeat(F.lit("a fresh "), (F.col("o_orderkey") % 4).cast("int")).alias("new"), pairs.alias("pairs"))
    return highlights.declared_replacements(rows, "o_orderkey").select("o_orderkey", "old_text", "new_text", "position")


from lexstrata.plans import adding, documents, editing, logs, parsing, rebuilding, running, scalars, structure, timing  # noqa: E402, F401  (they register more queries)
