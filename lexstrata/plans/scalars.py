"""Queries of column functions and small body operators, with inputs put together from keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexstrata.functions import dates, numbers, text
from lexstrata.operators import highlights, verify
from lexstrata.plans.catalogue import query, table
from lexstrata.plans.structure import pick, sql_pick
from lexstrata.sources import documents

SUPER = "⁰¹²³⁴⁵⁶⁷⁸⁹"
FORMS, BASES, TYPES = ["статьи", "Части", "пунктов", "главу", "приложению"], ["статья", "часть", "пункт", "глава", "приложение"], ["article", "part", "point", "chapter", "appendix"]
ORDINALS = ["первый", "второго", "третьем", "четвертая", "пятую"]


def c(*x):
    return F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])


@query(f"""SELECT p_partkey AS k, p_name AS thought, '5' || {sql_pick(SUPER, 'p_partkey % 10')} || ')' AS raised, p_name || ' x 7' AS searched, 'Имя ' || p_partkey AS head, {sql_pick(BASES, 'p_partkey % 5')} AS base, {sql_pick(TYPES, 'p_partkey % 5')} AS kind,
    p_partkey % 4 - 1 AS depth, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE '<p>' || p_name || '</p>' END AS bare, 'b' AS replaced FROM part""")
def scalar_texts(spark, d):
    k, name = F.col("p_partkey"), F.col("p_name")
    numbered = F.when(k % 2 == 0, c(k, ") ", name)).otherwise(c("<p>  ", k, ". ", name, "</p>"))
    return table(spark, d, "part").select(
        k.alias("k"), text.without_thinking(c("<think>plan\n", k, "</think>", name, "\n```")).alias("thought"), numbers.sup_tags_to_unicode(c("5<sup>", k % 10, "</sup>)")).alias("raised"), text.for_search(c(F.upper(name), ",  «X»; 7!")).alias("searched"),
        text.head_text(c("<b>«Статья ", k, ". Имя ", k, "»</b>"), F.lit("Статья"), k).alias("head"), text.base_type(pick(FORMS, k % 5)).alias("base"), text.element_type(pick(FORMS, k % 5)).alias("kind"),
        text.quote_depth(c(F.repeat(F.lit("«"), (k % 4).cast("int")), "»")).cast("long").alias("depth"), text.without_leading_number(numbered, k).alias("bare"), F.regexp_replace(F.coalesce(F.lit(None).cast("string"), F.lit("a")), "a", "b").alias("replaced"))


@query(f"""SELECT p_partkey AS k, CAST(p_partkey % 5 + 1 AS INTEGER) AS ordinal, '1/' || p_partkey || '/а' AS path, CASE p_partkey % 4 WHEN 0 THEN p_partkey || '.' WHEN 1 THEN CAST(p_partkey AS VARCHAR) WHEN 2 THEN p_partkey || ')' ELSE p_partkey || '.' END AS shown,
    CASE p_partkey % 3 WHEN 0 THEN '<p>' || p_partkey || '. t</p>' WHEN 1 THEN '<p>' || p_partkey || ') t</p>' ELSE '<p>t</p>' END AS led, p_partkey % 2 = 0 AS empty, CAST(p_partkey AS VARCHAR) AS cleaned, p_partkey % 3 > 0 AS marked FROM part""")
def scalar_numbers(spark, d):
    k = F.col("p_partkey")
    kind = pick(["point", "subpoint", "article"], k % 3)
    written = F.when(k % 4 == 2, c(k, ")")).when(k % 4 == 1, c(k, ".")).otherwise(k.cast("string"))
    marks = F.when(k % 2 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("m")))
    given = F.when(k % 3 == 0, c("<p>", k, ". t</p>")).otherwise("<p>t</p>")  # points bear their number already
    return table(spark, d, "part").select(
        k.alias("k"), numbers.ordinal(F.when(k % 2 == 0, pick(ORDINALS, k % 5)).otherwise((k % 5 + 1).cast("string"))).alias("ordinal"), F.array_join(numbers.number_path(c("1) -> пункт ", k, ".→а)")), "/").alias("path"),
        numbers.shown_number(written, k % 4 < 2, k % 4 == 0).alias("shown"), text.with_number(given, k, kind).alias("led"), highlights.empty_marks(marks, F.lit(None).cast("array<string>")).alias("empty"), numbers.clean_number(c(" <b>«", k, "»</b>.) ")).alias("cleaned"),
        highlights.pairs_marked(F.array(F.struct(F.lit("a").alias("old"), F.lit("b").alias("new"))), F.array(F.struct(F.lit("x").alias("old_text"), F.lit("b").alias("new_text")), F.struct(F.when(k % 3 > 0, "a").otherwise("y").alias("old_text"), F.lit("b").alias("new_text")))).alias("marked"))


@query("""WITH o AS (SELECT DISTINCT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders)
    SELECT k, k % 3 = 0 AS earlier, k % 4 <> 1 AS valid, CAST(CASE WHEN k % 4 = 1 THEN DATE '2020-01-15' ELSE d END AS VARCHAR) AS changed, CASE WHEN k % 4 = 1 THEN 'bad' WHEN k % 4 = 2 THEN 'open' ELSE 'fine' END AS state FROM o""")
def scalar_dates(spark, d):
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    shown = F.when(k % 4 == 1, "15.1.20xx").otherwise(F.date_format(day, "dd.MM.yyyy"))
    state = F.when(dates.bad_date(shown), "bad").when(dates.opened(F.when(k % 4 == 2, " ").otherwise(shown)), "open").otherwise("fine")
    return table(spark, d, "orders").select(k.alias("k"), dates.before(day, F.when(k % 3 == 0, F.date_add(day, 1)).when(k % 3 == 1, day)).alias("earlier"), dates.valid_format(shown).alias("valid"), dates.date_or(shown, F.lit("2020-01-15").cast("date")).cast("string").alias("changed"), state.alias("state")).distinct()


@query("""WITH l AS (SELECT l_orderkey AS k, l_linenumber AS n, min(l_partkey) AS p FROM lineitem GROUP BY ALL)
    SELECT k AS item_id, md5(string_agg('<p>' || p || '</p>', chr(10) ORDER BY n)) AS h FROM l WHERE p % 4 <> 0 GROUP BY k""")
def body_texts(spark, d):
    """Bodies of orders: a paragraph for each line, references for every fourth part."""
    return documents.rendered(line_blocks(spark, d), ["item_id"]).select("item_id", F.md5("html").alias("h"))


def line_blocks(spark, d):
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("item_id"), F.col("l_linenumber").alias("ord")).agg(F.min("l_partkey").alias("p"))
    ref = F.col("p") % 4 == 0
    return lines.select("item_id", F.lit(1).alias("rev_idx"), "ord", "p", F.when(~ref, c("<p>", F.col("p"), "</p>")).alias("html_text"), F.when(ref, F.col("p").cast("string")).alias("ref_item_id"))


@query("""WITH l AS (SELECT l_orderkey AS k, l_linenumber AS n, min(l_partkey) AS p FROM lineitem GROUP BY ALL)
    SELECT 'children_inlined_in_body' AS category, CAST(k AS VARCHAR) AS element, true AS passed FROM l GROUP BY k HAVING bool_or(p % 4 = 0) AND bool_or(p % 4 <> 0 AND p % 5 = 0)""")
def inlined_children(spark, d):
    """Every fifth part's block holds two paragraphs."""
    blocks = line_blocks(spark, d).withColumn("html_text", F.when(F.col("p") % 5 == 0, F.concat("html_text", "html_text")).otherwise(F.col("html_text")))
    found = verify.inlined_children(blocks)
    return found.crossJoin(F.broadcast(verify.passed(found))).select("category", "element", "passed")  # one row: warnings are no errors


@query("WITH o AS (SELECT DISTINCT o_orderkey AS k FROM orders) SELECT 'date_format_invalid' AS category, CAST(k AS VARCHAR) AS element, false AS passed FROM o WHERE k % 6 = 1 UNION ALL SELECT 'date_format_invalid', CAST(k AS VARCHAR), false FROM o WHERE k % 4 = 3")
def root_dates(spark, d):
    k = F.col("k")
    docs = table(spark, d, "orders").select(F.col("o_orderkey").alias("k")).distinct().select("k", F.when(k % 6 == 1, "2020-01-15").otherwise("15.01.2020").alias("date_reg"), F.when(k % 4 == 3, "1.1.2020").when(k % 4 == 2, "").alias("date_passed"))
    found = verify.date_form_checks(docs, "k", "date_reg", "date_passed")
    return found.crossJoin(F.broadcast(verify.passed(found))).select("category", "element", "passed")
