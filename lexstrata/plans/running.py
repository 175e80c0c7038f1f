"""Queries of the restartable chain and of nested documents."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lexstrata.operators.amend import applied
from lexstrata.operators.chain import Chain, Step
from lexstrata.plans.catalogue import TIMELINE, day, query, table, timeline
from lexstrata.session import cut, shared_folder
from lexstrata.sources import documents, egest


@query(f"""WITH {TIMELINE}, kept AS (SELECT *, lead(valid_from) OVER (PARTITION BY item_id ORDER BY rev_idx) - 1 AS ends FROM tl WHERE rev_idx <= 4)
    SELECT item_id, CAST(rev_idx AS INTEGER) AS rev_idx, CAST(valid_from AS VARCHAR) AS valid_from, CAST(ends AS VARCHAR) AS valid_to, rev_key AS value, CASE WHEN rev_idx = 1 THEN 'add' ELSE 'change' END AS mod_type FROM kept""")
def chain_resumed(spark, d):
    """Three amendments of all customers. The first run breaks in the second amendment; the next run takes up after the first and is told of it again."""
    revisions = cut(timeline(spark, d))
    none = F.lit(None).cast("string")
    target = revisions.where("rev_idx = 1").select("item_id", F.col("rev_idx").cast("int").alias("rev_idx"), "valid_from", F.lit(None).cast("date").alias("valid_to"), F.col("rev_key").alias("value"), F.lit("add").alias("mod_type"), none.alias("modified_by_id"), none.alias("not_valid"))

    def changes(k: int):
        return revisions.where(F.col("rev_idx") == k + 1).select("item_id", F.lit(1).alias("seq"), F.lit("change").alias("type"), F.col("rev_key").alias("new_value"), "valid_from", F.lit(f"a{k}").alias("modified_by_id"))

    def broken():
        raise ConnectionError("the second amendment can't be read")

    chain = Chain(spark, f"{shared_folder(spark)}/chains/{uuid.uuid4().hex}")
    chain.run(target, [Step("a1", lambda: changes(1)), Step("a2", broken), Step("a3", lambda: changes(3))], applied)
    table_, _ = chain.run(target, [Step(f"a{k}", lambda k=k: changes(k)) for k in (1, 2, 3)], applied)
    return table_.select("item_id", "rev_idx", day("valid_from"), day("valid_to"), "value", "mod_type")


@query("""WITH l AS (SELECT l_orderkey AS o, l_linenumber AS n, min(l_suppkey) AS s FROM lineitem GROUP BY ALL),
    i AS (SELECT o_custkey AS c, 'c' || o_custkey AS item_id, NULL AS parent_item_id, 1 AS depth, NULL AS html_text FROM orders GROUP BY ALL
        UNION ALL SELECT o_custkey, 'o' || o_orderkey, 'c' || o_custkey, 2, o_orderstatus || ' "' || o_orderpriority || '"' FROM orders
        UNION ALL SELECT o_custkey, 'o' || o || '_' || n, 'o' || o, 3, 's' || s FROM l JOIN orders ON o_orderkey = o)
    SELECT 'd' || c AS path, item_id, parent_item_id, depth, html_text FROM i""")
def nested_round_trip(spark, d):
    """Customers, orders and lines written as nested documents and read again."""
    o = table(spark, d, "orders")
    li = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_suppkey").alias("s")).join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    ints = lambda *c: F.array(*[F.col(x).cast("int") for x in c])
    name = lambda *c: F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in c])
    s = lambda c: F.col(c).cast("string")
    rows = o.select("o_custkey").distinct().select(name("d", s("o_custkey")).alias("path"), name("c", s("o_custkey")).alias("item_id"), ints("o_custkey").alias("sort_path"), F.lit(None).cast("string").alias("t"))
    rows = rows.unionByName(o.select(name("d", s("o_custkey")).alias("path"), name("o", s("o_orderkey")).alias("item_id"), ints("o_custkey", "o_orderkey").alias("sort_path"), name(F.col("o_orderstatus"), ' "', F.col("o_orderpriority"), '"').alias("t")))
    rows = rows.unionByName(li.select(name("d", s("o_custkey")).alias("path"), name("o", s("l_orderkey"), "_", s("l_linenumber")).alias("item_id"), ints("o_custkey", "l_orderkey", "l_linenumber").alias("sort_path"), name("s", s("s")).alias("t")))
    revisions = rows.where("t IS NOT NULL").select("path", "item_id", F.lit(0).alias("rev_idx"), F.lit("add").alias("mod_type"))
    blocks = rows.where("t IS NOT NULL").select("path", "item_id", F.lit(0).alias("rev_idx"), F.lit(1).alias("ord"), F.lit("paragraph").alias("block_type"), F.col("t").alias("html_text"), F.lit(None).cast("string").alias("ref_item_id"))
    written = egest.nested_documents(rows.withColumn("item_type", F.lit("point")), revisions, blocks)
    items = documents.flatten_items(documents.parsed(cut(written)), 3)
    said = documents.blocks_of(documents.revisions_of(items)).select("path", "item_id", "html_text")
    return items.join(said, ["path", "item_id"], "left").select("path", "item_id", "parent_item_id", "depth", "html_text")
