"""Queries of quotations, edits and marks, over the lines of `documents` and over orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexstrata.operators import edits, quotations
from lexstrata.plans.catalogue import query, table

LINES = """
    d AS (SELECT doc_id AS k, string_split(translate(coalesce(text, ''), '«»<>&', '     '), chr(10)) AS w FROM documents),
    places AS (SELECT k, w, len(w) AS n, 1 + k % len(w) AS a FROM d),
    chosen AS (SELECT k, w, n, a, a + (k // 7) % (n - a + 1) AS b FROM places)
"""


def lines(spark, d):
    """key, w (lines of the text without guillemets and signs of markup), n, a, b: a stretch of lines."""
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("key"), F.split(F.translate(F.coalesce("text", F.lit("")), "«»<>&", "     "), "\n").alias("w"))
    told = rows.withColumn("n", F.size("w")).withColumn("a", 1 + F.col("key") % F.col("n"))
    return told.withColumn("b", F.col("a") + F.floor(F.col("key") / 7) % (F.col("n") - F.col("a") + 1))


def quoted(rows):
    w = F.transform("w", lambda x, i: F.concat(F.lit("<p>"), F.when(i + 1 == F.col("a"), "«").otherwise(""), x, F.when(i + 1 == F.col("b"), "»;").otherwise(""), F.lit("</p>")))
    return rows.withColumn("html", F.array_join(w, ""))


@query(f"""WITH {LINES}, cut AS (SELECT k, list_transform(CASE WHEN regexp_matches(w[b], '^\\s*$') THEN w[a:b - 1] ELSE w[a:b] END, lambda x: '<p>' || x || '</p>') AS p FROM chosen)
    SELECT k AS key, md5(regexp_replace(array_to_string(p, chr(10)), ';{{2,}}', ';', 'g')) AS h FROM cut""")
def quotation_selected(spark, d):
    rows = quoted(lines(spark, d)).select("key", "html", F.lit("all").alias("spec"))
    return quotations.selected_markup(rows).select("key", F.md5("html").alias("h"))


@query(f"""WITH {LINES}, cut AS (SELECT k, list_transform(w[a:b], lambda x: '<p>' || x || '</p>') AS p FROM chosen)
    SELECT k AS key, md5(regexp_replace(array_to_string(p, chr(10)), ';{{2,}}', ';', 'g')) AS h FROM cut""")
def blocks_by_number(spark, d):
    rows = lines(spark, d).withColumn("html", F.array_join(F.transform("w", lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>"))), ""))
    spec = F.concat_ws("-", F.col("a").cast("string"), F.col("b").cast("string"))
    return quotations.selected_markup(rows.select("key", "html", spec.alias("spec"))).select("key", F.md5("html").alias("h"))


@query(f"""WITH {LINES},
    said AS (SELECT k, list_transform(w, lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))) AS w FROM chosen),
    whole AS (SELECT k, w, array_to_string(w, ' ') AS t FROM said),
    q AS (SELECT k, w, t, trim(regexp_replace(substr(t, CAST(1 + k % greatest(length(t) - 30, 1) AS BIGINT), CAST(30 + k % 200 AS BIGINT)), '\\s+', ' ', 'g')) AS q FROM whole),
    hits AS (SELECT k, w, q, strpos(t, q) - 1 AS s FROM q WHERE q <> '' AND contains(t, q)),
    ends AS (SELECT *, list_transform(range(1, len(w) + 1), lambda i: CAST(list_sum(list_transform(w[1:i], lambda x: length(x) + 1)) - length(w[i]) - 1 AS BIGINT)) AS b FROM hits),
    found AS (SELECT k, s, length(q) AS n, b, len(list_filter(b, lambda x: x <= s)) AS i, len(list_filter(b, lambda x: x <= s + length(q) - 1)) AS j FROM ends)
    SELECT k AS key, CAST(i AS INTEGER) AS start_pos, CAST(s - b[i] AS INTEGER) AS "start", CAST(j AS INTEGER) AS end_pos, CAST(s + n - b[j] AS INTEGER) AS "end" FROM found""")
def quotation_places(spark, d):
    """A stretch of each document's text, from inside a line to inside another: where it stands first."""
    rows = lines(spark, d)
    squeezed = F.transform("w", lambda x: F.trim(F.regexp_replace(x, "\\s+", " ")))
    whole = rows.withColumn("t", F.array_join(squeezed, " "))
    part = F.substring("t", (1 + F.col("key") % F.greatest(F.length("t") - 30, F.lit(1))).cast("int"), (30 + F.col("key") % 200).cast("int"))
    wanted = whole.select("key", F.lit(1).alias("quote_id"), part.alias("quoted"))
    blocks = rows.select("key", F.posexplode("w").alias("k", "x")).select("key", (F.col("k") + 1).alias("pos"), F.concat(F.lit("<p>"), "x", F.lit("</p>")).alias("html"))
    found = quotations.quoted_places(blocks, wanted).where("place = 1")
    return found.select("key", "start_pos", "start", "end_pos", "end")


@query("""WITH t AS (SELECT doc_id AS key, coalesce(text, '') AS t FROM documents),
    marked AS (SELECT key, string_split(replace(t, 'e ', chr(1)), 'an') AS p FROM t),
    cut AS (SELECT key, CASE WHEN len(p) > 2 THEN p[1] || 'an' || array_to_string(p[2:3], '') || CASE WHEN len(p) > 3 THEN 'an' || array_to_string(p[4:], 'an') ELSE '' END ELSE array_to_string(p, 'an') END AS t FROM marked)
    SELECT key, md5(replace(t, chr(1), 'E ') || '[end]') AS h FROM cut""")
def edits_applied(spark, d):
    """In every text all 'e ' become 'E ', the second 'an' goes, a mark comes to the end; a fourth edit meets only what the first has taken."""
    texts = table(spark, d, "documents").select(F.col("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("said"))
    kinds = [(1, "replace", "e ", "E ", None), (2, "delete", "an", None, 2), (3, "insert", None, "[end]", None), (4, "delete", "e ", None, 1)]
    told = F.explode(F.array(*[F.struct(F.lit(s).alias("seq"), F.lit(k).alias("kind"), F.lit(o).cast("string").alias("old"), F.lit(n).cast("string").alias("new"), F.lit(c).cast("int").alias("nth"), F.lit(None).cast("int").alias("sentence")) for s, k, o, n, c in kinds]))
    return edits.edited(texts, texts.select("key", told.alias("e")).select("key", "e.*")).select("key", F.md5("said").alias("h"))


@query("""WITH m AS (SELECT l_orderkey AS key, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, l_extendedprice AS x FROM lineitem),
    o AS (SELECT o_orderkey AS key, 1 + o_orderkey % 4 AS a, 2 + o_orderkey % 3 AS b FROM orders),
    one AS (SELECT m.*, CASE WHEN n >= a THEN n + 1 ELSE n END AS n1, b FROM m JOIN o USING (key))
    SELECT key, p AS said, CAST(CASE WHEN n1 >= b THEN n1 - 1 ELSE n1 END AS VARCHAR) || '-all' AS position FROM one""")
def marks_shifted(spark, d):
    """Marks of an order's lines after a paragraph came and another went."""
    marks = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_partkey").alias("said"), F.concat(F.col("l_linenumber").cast("string"), F.lit("-all")).alias("position"))
    o = F.col("o_orderkey")
    steps = F.explode(F.array(F.struct(F.lit(1).alias("seq"), (1 + o % 4).cast("int").alias("at"), F.lit(1).alias("delta")), F.struct(F.lit(2).alias("seq"), (2 + o % 3).cast("int").alias("at"), F.lit(-1).alias("delta"))))
    return edits.shifted_in_turn(marks, table(spark, d, "orders").select(o.alias("key"), steps.alias("s")).select("key", "s.*"))


@query("""WITH s AS (SELECT l_orderkey AS key, l_linenumber AS from_n, CASE WHEN l_suppkey % 2 = 0 THEN 1 ELSE -1 END AS delta FROM lineitem)
    SELECT l_orderkey AS key, l_partkey AS said, CAST(l_linenumber + (SELECT sum(delta) FROM s WHERE s.key = l_orderkey AND from_n <= l_linenumber) AS VARCHAR) || '-1' AS position FROM lineitem""")
def marks_shifted_at_once(spark, d):
    li = table(spark, d, "lineitem")
    marks = li.select(F.col("l_orderkey").alias("key"), F.col("l_partkey").alias("said"), F.concat(F.col("l_linenumber").cast("string"), F.lit("-1")).alias("position"))
    return edits.shifted_at_once(marks, li.select(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("at"), F.when(F.col("l_suppkey") % 2 == 0, 1).otherwise(-1).alias("delta")))


@query("""WITH li AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem), old AS (SELECT k, n, row_number() OVER (PARTITION BY k ORDER BY n) AS i, max(n) OVER (PARTITION BY k) AS top FROM li),
    kept AS (SELECT k, count(*) FILTER (n % 4 <> 0) + 1 AS j, max(top) % 4 = 0 AS last FROM old GROUP BY k)
    SELECT k AS key, 'previous' AS edition, CASE WHEN n = top THEN 'difference' ELSE 'deletion' END AS category, CAST(i AS VARCHAR) AS position FROM old WHERE n % 4 = 0
    UNION ALL SELECT k, 'current', CASE WHEN last THEN 'difference' ELSE 'addition' END, CAST(j AS VARCHAR) FROM kept""")
def table_rows_marked(spark, d):
    """Tables of an order's lines: every fourth goes, a row comes at the end."""
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("n")).distinct()
    ordered = F.array_sort(F.collect_list("n"))
    row = lambda x: F.concat(F.lit("<tr><td>"), x.cast("string"), F.lit("</td></tr>"))
    both = li.groupBy("key").agg(ordered.alias("ns"))
    old = F.array_join(F.transform("ns", row), "")
    new = F.concat(F.array_join(F.transform(F.filter("ns", lambda x: x % 4 != 0), row), ""), F.lit("<tr><td>new</td></tr>"))
    return edits.table_row_marks(both.select("key", old.alias("old"), new.alias("new"))).drop("said")


@query("""WITH m AS (SELECT l_orderkey AS key, l_suppkey % 3 AS said, l_linenumber AS n, l_partkey % 2 + 1 AS k FROM lineitem)
    SELECT key, said, string_agg(n || '-' || k, ',' ORDER BY n, k) AS position FROM (SELECT DISTINCT * FROM m) GROUP BY key, said""")
def positions_merged(spark, d):
    marks = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), (F.col("l_suppkey") % 3).alias("said"), F.concat_ws("-", F.col("l_linenumber").cast("string"), (F.col("l_partkey") % 2 + 1).cast("string")).alias("position"))
    return edits.merged_positions(marks, ["key", "said"])
