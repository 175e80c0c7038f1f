"""Queries of the logs and what is made of them; outcomes are events."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lexstrata.operators import records
from lexstrata.plans.catalogue import query, table

FAILED = "event_type IN ('click', 'view')"


def outcomes(spark, d):
    """Events as outcomes: the element is the user's last digit, the category the user's last but one."""
    e = table(spark, d, "events")
    kind = F.when(F.col("event_id") % 3 == 0, "verified_success").when(F.col("event_id") % 3 == 1, "verified_failure").otherwise("apply_failure")
    category = F.get(F.array(*[F.lit(c) for c in sorted(records.ADVICE)]), (F.col("user_id") % len(records.ADVICE)).cast("int"))
    return e.select(F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("e"), F.col("user_id") % 10).alias("element"), kind.alias("outcome"), category.alias("category"), F.concat(F.lit("i"), "event_id").alias("item_id"))


OUTCOMES = f"o AS (SELECT 'e' || user_id % 10 AS element, event_id % 3 AS r, [{', '.join(repr(c) for c in sorted(records.ADVICE))}][1 + user_id % {len(records.ADVICE)}] AS category FROM events)"


def logged(spark, d):
    """The outcomes written to a log in two appends, and read."""
    from lexstrata.session import shared_folder

    log = records.Records(spark, f"{shared_folder(spark)}/lexstrata/{uuid.uuid4().hex}/records")
    rows = outcomes(spark, d)
    log.append("outcome", rows.where("outcome = 'verified_success'"))
    log.append("outcome", rows.where("outcome <> 'verified_success'"))
    return log.read("outcome")


@query(f"WITH {OUTCOMES} SELECT element, category, count(*) AS n, CAST(sum(CASE WHEN r = 0 THEN 1 ELSE 0 END) AS BIGINT) AS good FROM o GROUP BY ALL")
def outcome_log(spark, d):
    return logged(spark, d).groupBy("element", "category").agg(F.count("*").alias("n"), F.count_if(F.col("outcome") == "verified_success").alias("good"))


@query(f"WITH {OUTCOMES}, a AS (SELECT unnest([{', '.join(repr(c) for c in sorted(records.ADVICE))}]) AS category, unnest([{', '.join(repr(records.ADVICE[c]) for c in sorted(records.ADVICE))}]) AS advice) SELECT element, category, count(*) AS n, advice FROM o JOIN a USING (category) WHERE r <> 0 GROUP BY ALL")
def failure_advice(spark, d):
    return records.suggestions(outcomes(spark, d))


@query("WITH o AS (SELECT 'e' || user_id % 10 AS element, event_id % 3 = 0 AS good FROM events WHERE event_id % 3 = 0 OR event_id % 9 = 1) SELECT element FROM o GROUP BY element HAVING count(*) FILTER (WHERE good) > count(*) FILTER (WHERE NOT good)")
def reliable_anywhere(spark, d):
    rows = outcomes(spark, d).where("outcome = 'verified_success' OR substring(item_id, 2) % 9 = 1")
    return records.reliable_without_context(rows).select("element")


@query("SELECT DISTINCT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN 'el' ELSE 'el' || chr(1) || o_orderkey || chr(1) || chr(1) || CASE WHEN o_orderkey % 4 = 1 THEN 'change' ELSE '' END || chr(1) END AS key FROM orders")
def mapping_keys(spark, d):
    k, none = F.col("o_orderkey"), F.lit(None).cast("string")
    return table(spark, d, "orders").select(k.alias("k"), records.mapping_key(F.lit("el"), F.when(k % 4 != 0, k), none, F.when(k % 4 == 1, "change"), none).alias("key")).distinct()


@query("""WITH o AS (SELECT 'e' || user_id % 10 AS element, user_id % 3 AS target, event_id % 3 AS r FROM events), m AS (SELECT element, target, count(*) FILTER (WHERE r = 0) AS s, count(*) FILTER (WHERE r <> 0) AS f FROM o GROUP BY ALL), d AS (SELECT DISTINCT o_orderkey AS k FROM orders)
    SELECT (SELECT count(*) FROM d) AS total_runs, (SELECT CAST(sum(k % 5) AS BIGINT) FROM d) AS total_changes_applied, (SELECT CAST(sum(k % 2) AS BIGINT) FROM d) AS total_changes_failed, (SELECT CAST(sum(k % 3) AS BIGINT) FROM d) AS total_manual_corrections,
    (SELECT count(*) FROM m WHERE s / (s + f + 2) >= 0.33 AND s > 0) AS reliable_mappings, (SELECT count(*) FROM m WHERE s > 0 AND f > 0) AS contested_mappings, (SELECT count(*) FROM m) AS total_mappings, (SELECT count(*) FROM m WHERE f > 0) AS mappings_with_failures,
    (SELECT count(*) FROM d WHERE k % 2 = 0) AS total_verification_passes, (SELECT count(*) FROM d WHERE k % 2 = 1) AS total_verification_fails, (SELECT count(DISTINCT k % 7) FROM d) AS total_recoveries_attempted, (SELECT count(*) FROM (SELECT k % 7 AS e FROM d GROUP BY e HAVING count(*) FILTER (WHERE k % 3 > 0) > count(*) FILTER (WHERE k % 3 = 0))) AS total_recoveries_successful""")
def log_totals(spark, d):
    return totals_of(spark, d)


def totals_of(spark, d):
    k = F.col("k")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k")).distinct()
    runs = o.select((k % 5).alias("changes_applied"), (k % 2).alias("changes_failed"), (k % 3).alias("corrections"))
    rows = outcomes(spark, d).withColumn("user", F.substring("element", 2, 1))
    targets = table(spark, d, "events").select(F.concat(F.lit("i"), "event_id").alias("item_id"), (F.col("user_id") % 3).alias("target_id"))
    rows = rows.join(targets, "item_id")
    return records.totals(runs, rows, o.select((k % 2 == 0).alias("passed")), o.select((k % 7).alias("element"), F.lit("c").alias("category"), (k % 3 > 0).alias("success")), ["element", "target_id"])


@query("WITH d AS (SELECT DISTINCT o_orderkey AS k FROM orders) SELECT '- total_runs: ' || count(*) AS first_line, 14 AS n_lines FROM d")
def agent_summary(spark, d):
    patterns = records.suggestions(outcomes(spark, d)).orderBy(F.desc("n"), "element", "category").limit(2)
    lines = F.split(records.summary(totals_of(spark, d), patterns).select("text").limit(1).scalar(), "\n")
    return spark.range(1).select(lines[0].alias("first_line"), F.size(lines).alias("n_lines"))


@query("SELECT string_agg(k || '. in' || n_nationkey || ' -> ' || n_name, chr(10) ORDER BY k) AS text FROM (SELECT *, row_number() OVER (ORDER BY n_nationkey) AS k FROM nation WHERE n_nationkey % 2 = 0 ORDER BY n_nationkey LIMIT 5)")
def training_context(spark, d):
    n = F.col("n_nationkey")
    seeds = table(spark, d, "nation").select(n.alias("id"), F.when(n % 2 == 0, "highlights").otherwise("structure").alias("category"), F.lit("s").alias("subcategory"), F.concat(F.lit("in"), n).alias("input"), F.col("n_name").alias("output"))
    return records.prompt_supplement(seeds, 4)


@query("SELECT event_id FROM events WHERE user_id % 10 = 3 AND event_id % 3 <> 0 ORDER BY CAST(ts AS TIMESTAMP) DESC, event_id LIMIT 20")
def newest_examples(spark, d):
    rows = outcomes(spark, d).where("outcome <> 'verified_success'").select("ts", "element", "category", F.lpad(F.substring("item_id", 2, 20), 20, "0").alias("message"))
    return records.newest_examples(rows, "e3", None, 20).select(F.col("message").cast("long").alias("event_id"))


@query("SELECT status, count(*) AS n, '| ' || status || ' | ' || count(*) || ' |' AS line FROM (SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'failed' ELSE 'applied' END AS status FROM orders) GROUP BY status")
def chain_report(spark, d):
    steps = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 10 == 0, "failed").otherwise("applied").alias("status"))
    return records.chain_report(steps)


@query("""WITH o AS (SELECT o_orderkey AS k, o_custkey % 7 AS folder, CAST(o_orderdate AS DATE) AS d FROM orders), f AS (SELECT *, CASE WHEN k % 3 = 0 THEN DATE '9999-12-31' ELSE d END AS since, CASE WHEN k % 4 = 0 THEN 0 ELSE k % 100 END AS n, k % 500 = 1 AS flagged FROM o)
    SELECT folder, k, CAST(row_number() OVER (PARTITION BY folder ORDER BY flagged DESC, since, n, k) AS INTEGER) AS step FROM f""")
def chain_scan(spark, d):
    """Documents of folders: the flagged one is the target, else the earliest; bad dates come last, bad numbers count 0."""
    from lexstrata.operators.amend import chain_scan as scan

    k = F.col("o_orderkey")
    date = F.when(k % 3 == 0, "never").otherwise(F.date_format("o_orderdate", "dd.MM.yyyy"))
    docs = table(spark, d, "orders").select((F.col("o_custkey") % 7).alias("folder"), k.alias("k"), F.when(k % 4 == 0, "б/н").otherwise(F.concat(F.lit("№ "), (k % 100).cast("string"), F.lit("-зс 7"))).alias("number"), F.lit(None).cast("string").alias("date_signed"), F.when(k % 2 == 0, date).alias("date_pub"), date.alias("valid_from"), (k % 500 == 1).alias("is_target"))
    return scan(docs, "folder", "k").select("folder", "k", "step")


@query("""WITH o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders) SELECT DISTINCT k, CASE WHEN k % 2 = 0 THEN strftime(d, '%Y_%m_%d') WHEN k % 3 = 0 THEN strftime(d + 1, '%Y_%m_%d') ELSE strftime(d + 2, '%Y_%m_%d') END AS day FROM o""")
def file_dates(spark, d):
    """Laws are named by the day they were signed, regulations by the first of passed, registered and signed."""
    from lexstrata.sources.documents import file_date

    k, at = F.col("o_orderkey"), lambda n: F.date_format(F.date_add(F.col("o_orderdate").cast("date"), n), "dd.MM.yyyy")
    shown = file_date(F.when(k % 2 == 0, "law").otherwise("regulation"), F.when(k % 2 == 0, at(0)).otherwise(at(5)), F.when(k % 3 == 0, at(1)), at(2))
    return table(spark, d, "orders").select(k.alias("k"), shown.alias("day")).distinct()
