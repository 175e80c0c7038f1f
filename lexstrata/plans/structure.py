"""Queries of paths, markup, merges, routed changes, repairs and further checks.

Their inputs are derived from keys, so the SQL states the results from the same keys and not by the
operators' rules. Documents are orders, their parts and points lines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lexstrata.functions import html
from lexstrata.operators import bodies, merge, paths, repairs, router, tree, verify
from lexstrata.plans.catalogue import day, query, table
from lexstrata.session import cut

ROMAN = ["I", "II", "III", "IV", "V", "VI", "VII"]
pick = lambda values, at: F.get(F.array(*[F.lit(v) for v in values]), at.cast("int"))


def sql_pick(values, at: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][1 + {at}]"


def orders(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("k"))


ARTICLE_FORMS = ["Статья ", "статьи «", "в СТАТЬЕ  ", "статье "]
ENDS = ["", "»", ".", ","]


@query(f"""SELECT k, unnest(t).type AS type, unnest(t).number AS number FROM (SELECT o_orderkey AS k, list_concat(
        [{{'type': 'section', 'number': {sql_pick(ROMAN, 'o_orderkey % 7')}}}, {{'type': 'article', 'number': CAST(o_orderkey % 90 + 1 AS VARCHAR) || CASE WHEN o_orderkey % 3 = 0 THEN '.2' ELSE '' END}}],
        CASE WHEN o_orderkey % 5 = 0 THEN [{{'type': 'part', 'number': NULL}}] ELSE [{{'type': 'subpoint', 'number': {sql_pick('абвг', 'o_orderkey % 4')}}}] END) AS t FROM orders)""")
def structural_tokens(spark, d):
    """Path texts with inflected words, quotes, marks and unknown words."""
    k = F.col("k")
    number = F.concat((k % 90 + 1).cast("string"), F.when(k % 3 == 0, ".2").otherwise(""))
    tail = F.when(k % 5 == 0, " части настоящего").otherwise(F.concat(F.lit(" подпункта "), pick("абвг", k % 4), F.lit(")")))
    text = F.concat(F.lit("Раздел "), F.lower(pick(ROMAN, k % 7)), F.lit("; закона "), pick(ARTICLE_FORMS, k % 4), number, pick(ENDS, k % 4), tail)
    return orders(spark, d).select("k", F.explode(paths.structural_tokens(text)).alias("t")).select("k", "t.type", "t.number")


WORDS = ["первый", "второй", "третий", "четвертый", "пятый", "шестой", "седьмой", "восьмой", "девятый", "десятый"]


@query(f"SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE CAST(o_orderkey % 10 + 1 AS INTEGER) END AS n, CASE WHEN o_orderkey % 3 = 2 THEN 'point' ELSE 'paragraph' END AS added FROM orders")
def paragraph_order(spark, d):
    k = F.col("k")
    text = F.when(k % 3 == 2, "пункт 4").when(k % 3 == 1, F.concat(F.lit("Абзац "), pick(WORDS, k % 10))).otherwise(F.concat(F.lit("абзаце "), (k % 10 + 1).cast("string")))
    return orders(spark, d).select("k", paths.paragraph_order(text).alias("n"), paths.named_addition(text)["type"].alias("added"))


def legal_items(spark, d, below: str = "l_linenumber"):
    """Orders as articles with Roman or marked numbers, their distinct lines as points; every order is a document of its own."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k")).distinct()
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).distinct()
    a = o.select(F.col("k").alias("npa_id"), F.concat(F.lit("a"), "k").alias("item_id"), F.lit(None).cast("string").alias("parent_item_id"), F.lit("article").alias("item_type"), F.concat(pick(ROMAN, F.col("k") % 7), F.lit(".")).alias("item_number"), F.lit(1).alias("place"))
    p = lines.select(F.col("k").alias("npa_id"), F.concat_ws("_", F.concat(F.lit("a"), "k"), F.lit("point"), "n").alias("item_id"), F.concat(F.lit("a"), "k").alias("parent_item_id"), F.lit("point").alias("item_type"), F.concat("n", F.lit(")")).alias("item_number"), F.col("n").alias("place"))
    return a.unionByName(p)


def legal_paths(spark, d):
    """The path to point 3 of every order's article, with a point 2 of it that nowhere is for one in four."""
    k = F.col("k")
    tokens = F.array(F.struct(F.lit("article").alias("type"), (k % 7 + 1).cast("string").alias("number")), F.struct(F.lit("point").alias("type"), F.lit("3").alias("number")))
    more = F.array(F.struct(F.lit("subpoint").alias("type"), F.lit("б").alias("number")))
    wrong = F.array(F.struct(F.lit("article").alias("type"), F.lit("99").alias("number")), F.struct(F.lit("part").alias("type"), F.lit("1").alias("number")))
    return orders(spark, d).distinct().select(k.alias("path_id"), k.alias("npa_id"), F.when(k % 4 == 0, F.concat(tokens, more)).when(k % 4 == 1, wrong).otherwise(tokens).alias("tokens"))


THREE = "o AS (SELECT DISTINCT o_orderkey AS k FROM orders), three AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_linenumber = 3)"


@query(f"""WITH {THREE} SELECT k AS path_id, CASE WHEN k % 4 = 1 THEN NULL WHEN k IN (SELECT k FROM three) THEN 'a' || k || '_point_3' ELSE 'a' || k END AS item_id,
    CASE WHEN k % 4 = 1 THEN NULL WHEN k IN (SELECT k FROM three) THEN CASE WHEN k % 4 = 0 THEN 'subpoint' END ELSE CASE WHEN k % 4 = 0 THEN 'point,subpoint' ELSE 'point' END END AS deferred FROM o""")
def addition_parents(spark, d):
    found = paths.parents_for_additions(legal_items(spark, d), legal_paths(spark, d))
    return found.select("path_id", "item_id", F.array_join(F.transform("deferred", lambda t: t["type"]), ",").alias("deferred"))


@query(f"""WITH {THREE}, s AS (SELECT 'a' || k || '_point_3_subpoint_б' AS item_id, 'a' || k || '_point_3' AS parent_item_id, 'subpoint' AS item_type, 'б)' AS item_number FROM o WHERE k % 4 = 0),
    p AS (SELECT 'a' || k || '_point_3' AS item_id, 'a' || k AS parent_item_id, 'point' AS item_type, '3)' AS item_number FROM o WHERE k % 4 <> 1 AND k NOT IN (SELECT k FROM three)),
    w AS (SELECT k || '_article_99' AS item_id, NULL AS parent_item_id, 'article' AS item_type, '99' AS item_number FROM o WHERE k % 4 = 1 UNION ALL SELECT k || '_article_99_part_1', k || '_article_99', 'part', '1' FROM o WHERE k % 4 = 1)
    SELECT *, 'add' AS mod_type, '2020-01-15' AS valid_from FROM (FROM s UNION ALL FROM p UNION ALL FROM w)""")
def created_paths(spark, d):
    out = paths.created_paths(legal_items(spark, d), legal_paths(spark, d), F.lit("2020-01-15").cast("date"), F.lit("380"))
    return out.select("item_id", "parent_item_id", "item_type", "item_number", "mod_type", day("valid_from"))


@query("WITH o AS (SELECT DISTINCT o_orderkey AS k FROM orders), l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem) SELECT o.k AS path_id, 'a' || l.k || '_point_' || n AS item_id FROM o LEFT JOIN l ON l.k = o.k AND n = o.k % 5 + 1")
def source_by_numbers(spark, d):
    asked = orders(spark, d).distinct().select(F.col("k").alias("path_id"), F.col("k").alias("npa_id"), F.array((F.col("k") % 7 + 1).cast("string"), F.concat((F.col("k") % 5 + 1).cast("string"), F.lit("."))).alias("numbers"))
    return paths.by_numbers(legal_items(spark, d), asked)


@query("WITH o AS (SELECT DISTINCT o_orderkey AS k FROM orders), l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem WHERE l_linenumber < 4), s AS (SELECT k, string_agg('a' || k || '_point_' || n, ', ' ORDER BY n) AS ids FROM l GROUP BY k) SELECT o.k AS change_id, CASE WHEN o.k % 3 = 0 THEN 'src' || o.k ELSE ids END AS modified_by_id FROM o LEFT JOIN s USING (k)")
def changer_ids(spark, d):
    k = F.col("k")
    changes = orders(spark, d).distinct().select(k.alias("change_id"), F.when(k % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("1"), F.lit("2"), F.lit("3"))).alias("numbers"), F.concat(F.lit("src"), k).alias("source_item_id"))
    asked = changes.select("change_id", F.posexplode("numbers").alias("pos", "n")).select(F.concat_ws("/", "change_id", "pos").alias("path_id"), F.col("change_id").alias("npa_id"), F.array((F.col("change_id") % 7 + 1).cast("string"), F.col("n")).alias("numbers"))
    found = paths.by_numbers(legal_items(spark, d), asked).select(F.split("path_id", "/")[0].cast("long").alias("change_id"), F.split("path_id", "/")[1].cast("int").alias("pos"), "item_id")
    return paths.changer_ids(found, changes)


@query("WITH l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem) SELECT k || '/' || n AS want_id, 'a' || k || '_point_' || n AS item_id, 1 AS n_matches FROM l WHERE n % 2 = 1")
def child_by_number(spark, d):
    i = cut(legal_items(spark, d))
    wanted = i.where("item_type = 'point' AND place % 2 = 1").select(F.concat_ws("/", "npa_id", "place").alias("want_id"), "npa_id", "parent_item_id", "item_type", F.concat(F.lit("«"), "place", F.lit("».")).alias("item_number"))
    found = paths.matching(i, wanted).unionByName(paths.matching_anywhere(i, wanted))
    return found.distinct().select("want_id", "item_id", F.col("n_matches").cast("int").alias("n_matches"))


@query("""WITH w AS (SELECT DISTINCT c_custkey % 300 AS n, c_nationkey % 5 AS r FROM customer), c AS (SELECT r_regionkey AS r, unnest(range(0, 4)) AS b FROM region), e AS (SELECT r, b, unnest(range(b * 20 + 3, b * 20 + 9)) AS x FROM c)
    SELECT 'r' || w.r || '/' || n AS want_id, CASE WHEN n % 80 BETWEEN 3 AND 2 THEN '' ELSE 'r' || w.r || '_c' || coalesce((SELECT max(b) FROM c WHERE c.r = w.r AND b * 20 + 8 <= n), (SELECT min(b) FROM e WHERE e.r = w.r AND x = n), 0) END AS container_id, NULL AS item_id FROM w WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.r = w.r AND x = n)
    UNION ALL SELECT 'r' || w.r || '/' || n, 'r' || w.r || '_c' || e.b, 'r' || w.r || '_c' || e.b || '_' || n FROM w JOIN e ON e.r = w.r AND x = n
    UNION ALL SELECT 'r' || r || '/' || x || '.1', 'r' || r || '_c' || b, NULL FROM e WHERE x % 20 = 4""")
def number_in_chapters(spark, d):
    """Chapters b = 0 to 3 of every region hold the articles 20b + 3 to 20b + 8."""
    r = table(spark, d, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("r"))
    c = r.select("r", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("b")).withColumn("c", F.concat(F.col("r"), F.lit("_c"), F.col("b")))
    e = c.select("c", F.explode(F.sequence(F.col("b") * 20 + 3, F.col("b") * 20 + 8)).alias("x"))
    chapters = c.select(F.col("c").alias("item_id"), F.col("r").alias("parent_item_id"), F.lit("chapter").alias("item_type"), (F.col("b") + 1).cast("string").alias("item_number"), F.col("b").alias("place"))
    articles = e.select(F.concat_ws("_", "c", "x").alias("item_id"), F.col("c").alias("parent_item_id"), F.lit("article").alias("item_type"), F.col("x").cast("string").alias("item_number"), F.col("x").alias("place"))
    w = table(spark, d, "customer").select(F.concat(F.lit("r"), F.col("c_nationkey") % 5).alias("r"), (F.col("c_custkey") % 300).cast("string").alias("n")).distinct()
    dotted = r.select("r", F.explode(F.array(*[F.lit(f"{20 * b + 4}.1") for b in range(4)])).alias("n"))
    wanted = w.unionByName(dotted).select(F.concat_ws("/", "r", "n").alias("want_id"), F.col("r").alias("parent_item_id"), F.lit("article").alias("item_type"), F.col("n").alias("item_number"))
    return paths.in_containers(chapters.unionByName(articles), wanted)


@query("WITH l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem) SELECT k AS want_id, min('app' || k || '_' || n) AS item_id FROM l WHERE n = 2 GROUP BY k")
def appendix_by_number(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("npa_id"), F.col("l_linenumber").alias("n")).distinct()
    i = lines.select("npa_id", F.concat(F.lit("app"), "npa_id", F.lit("_"), "n").alias("item_id"), F.lit("appendix").alias("item_type"), F.concat(F.lit("№ "), "n").alias("raw"), "n").select("npa_id", "item_id", "item_type", F.regexp_replace("raw", "№ ", "").alias("item_number"), F.col("n").alias("place"))
    return paths.appendix_by_number(i, lines.select(F.col("npa_id").alias("want_id"), "npa_id", F.lit("2.").alias("item_number")).distinct())


@query("""WITH l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem), m AS (SELECT k, max(n) AS n FROM l GROUP BY k), o AS (SELECT DISTINCT o_orderkey AS k, o_orderkey % 3 + 2 AS w FROM orders)
    SELECT 'a' || o.k AS want_id, 'a' || o.k || CASE WHEN EXISTS (SELECT 1 FROM l WHERE l.k = o.k AND l.n = w) THEN '_point_' || w WHEN m.n > 1 AND m.n < w THEN '_point_' || m.n ELSE '' END AS item_id FROM o LEFT JOIN m ON m.k = o.k""")
def narrowed_source(spark, d):
    """Point n tells of 'пункт n'; asked for point k % 3 + 2. The last point of an order tells of every number after its own."""
    i = cut(legal_items(spark, d))
    last = i.where("item_type = 'point'").groupBy("parent_item_id").agg(F.max("place").alias("last"))
    points = i.where("item_type = 'point'").join(last, "parent_item_id")
    told = F.when(F.col("place") == F.col("last"), F.sequence(F.col("place"), F.greatest(F.col("place"), F.lit(9)))).otherwise(F.array("place"))
    topic = F.array_join(F.transform(told, lambda n: F.concat(F.lit("<p>в Пункте "), n, F.lit(" закона"))), ", ")
    topics = points.select("item_id", F.when(F.col("last") == 1, "<p>без номера").otherwise(F.concat(topic, F.lit(" слова «пункт 2» заменить</p>"))).alias("html"), F.col("place").alias("preorder"))
    asks = i.where("item_type = 'article'").select(F.col("item_id").alias("want_id"), "item_id", F.concat(F.lit("статья 40 пункт «"), F.col("npa_id") % 3 + 2, F.lit("»")).alias("text"))
    return paths.narrowed(topics, tree.descendants(i, asks.select(F.col("item_id").alias("ancestor_id"))), asks)


@query("WITH l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem) SELECT k AS npa_id, 'a' || k || '_point_' || min(n) AS item_id FROM l WHERE k % 2 = 0 OR n % 2 = 0 GROUP BY k")
def target_item(spark, d):
    """Laws are named by every point, regulations by the even ones."""
    i = legal_items(spark, d).where("item_type = 'point'")
    law = F.col("npa_id") % 2 == 0
    text = F.when(law, F.concat(F.lit("<b>Закон</b> № "), "npa_id")).when(F.col("place") % 2 == 0, F.concat(F.lit("Постановление от 2016 года N "), "npa_id")).otherwise(F.concat(F.lit("постановление N "), "npa_id", F.lit(" без года")))
    targets = i.select("npa_id", F.concat("npa_id", F.lit("-зс")).alias("number"), F.when(law, "law").otherwise("regulation").alias("doc_type"), F.lit(2016).alias("year")).distinct()
    year_free = i.where("NOT (npa_id LIKE '%2016%' AND npa_id % 2 = 1)")
    return paths.target_items(year_free.select("npa_id", "item_id", text.alias("text"), F.col("place").alias("preorder")), targets).unionByName(
        paths.target_items(i.where("npa_id LIKE '%2016%' AND npa_id % 2 = 1 AND place % 2 = 0").select("npa_id", "item_id", text.alias("text"), F.col("place").alias("preorder")), targets))


@query("WITH l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem) SELECT 'a' || k AS root_id, 'point' AS item_type, k % 7 + 1 || ')' AS item_number FROM l WHERE n = k % 7 + 1")
def keys_below(spark, d):
    i = legal_items(spark, d)
    wanted = i.where("item_type = 'article'").select(F.col("item_id").alias("root_id"), F.lit("point").alias("item_type"), F.concat(F.col("npa_id") % 7 + 1, F.lit(")")).alias("item_number"))
    return paths.keys_below(i, tree.closure(i), wanted, "item_type", "item_number")


@query("WITH l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem WHERE l_orderkey % 9 = 0) SELECT 'a' || k || '_point_' || n AS item_id, n AS preorder FROM l")
def item_lookup(spark, d):
    i = legal_items(spark, d).where("item_type = 'point'").select("item_id", F.col("place").alias("preorder"), "npa_id")
    twice = i.unionByName(i.withColumn("preorder", F.col("preorder") + 100))
    return paths.found_by_id(twice, i.where("npa_id % 9 = 0")).select("item_id", "preorder")


@query(r"""SELECT p_partkey AS k, '<p class="x">' || p_name || '</p>' AS trimmed, CASE WHEN p_partkey % 3 = 0 THEN '<tr><td>' || p_partkey || '</td></tr>' || chr(10) || '<tr><td>b</td></tr>' ELSE p_name END AS rows,
    CASE p_partkey % 3 WHEN 0 THEN CAST(p_partkey AS VARCHAR) WHEN 1 THEN 'б' END AS leading, '<p>' || p_name || '</p>' AS described, p_name AS bare, '<div class="table"><table border="1">' || p_partkey || '</table></div>x' AS wrapped, '<p> ' || p_name AS one_space FROM part""")
def markup(spark, d):
    k, name = F.col("p_partkey"), F.col("p_name")
    c = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])
    led = F.when(k % 3 == 0, c("<div><b>«", k, ".</b> text</div><p>9) no</p>")).when(k % 3 == 1, c("<p>б) ", name, "</p>")).otherwise(c("<p>plain ", k, ") ", name, "</p>"))
    return table(spark, d, "part").select(
        k.alias("k"), html.trimmed(c("<p> &nbsp;</p>\n<P><br></P><p class=\"x\">", name, "</p> <p>\n</p>")).alias("trimmed"), html.trimmed(F.when(k % 3 == 0, c("<table a=1><tr><td>", k, "</td></tr> <tr><td>b</td></tr></table>")).otherwise(name), k % 3 == 0).alias("rows"),
        html.leading_number(led).alias("leading"), html.description(c("  <p>  \n", name, "</p> ")).alias("described"), html.bare_text(c("<p>\n", F.regexp_replace(name, " ", "<b> </b> "), " </p>")).alias("bare"),
        html.wrapped_tables(c("<table border=\"1\">", k, "</table>x")).alias("wrapped"), html.without_one_space(c("<p>  ", name)).alias("one_space"))


@query(r"""WITH p AS (SELECT p_partkey AS k, p_name AS n FROM part)
    SELECT k, array_to_string(['<p>a ' || k || '</p>', 'gap', '<P id="2">' || n || '</P>', 'end'], '|') AS blocks, CASE k % 3 WHEN 0 THEN '1=<p>1. ' || n || '</p>' || chr(10) || '<p>more</p>;3=<p>3) c</p>' WHEN 1 THEN '1=no numbers' ELSE 'б=<p>«б) ' || n || '</p>' END AS fragments FROM p""")
def markup_blocks(spark, d):
    k, name = F.col("p_partkey"), F.col("p_name")
    c = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])
    numbered = F.when(k % 3 == 0, c("<p>head</p><p>1. ", name, "</p> <p>more</p><p>2) b</p><p>3) c</p>")).when(k % 3 == 1, "no numbers").otherwise(c("<p>«б) ", name, "</p>"))
    found = html.fragments_by_number(numbered, F.array(F.lit("1."), F.lit("3)"), F.lit("б)")))
    shown = F.array_join(F.transform(found, lambda x: F.concat(F.regexp_replace(x["marker"], "[.)]+$", ""), F.lit("="), x["html"])), ";")
    return table(spark, d, "part").select(k.alias("k"), F.array_join(html.blocks_and_gaps(c(" <p>a ", k, "</p> gap <P id=\"2\">", name, "</P>end")), "|").alias("blocks"), shown.alias("fragments"))


@query("""SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN '<p>' || p_partkey || '; x</p>' WHEN 1 THEN 'just ' || p_partkey ELSE '[1]' END AS html, CASE p_partkey % 3 WHEN 0 THEN '{"current":[]}' END AS highlights,
    'type' || (p_partkey % 4 + 1) || CASE WHEN p_partkey % 5 = 0 THEN '_extended' ELSE '' END AS kind, p_partkey % 5 = 0 AS goes_on, 'XIV 5.1' AS plain FROM part""")
def answers_and_numbering(spark, d):
    k = F.col("p_partkey")
    c = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])
    text = F.when(k % 3 == 0, c("<think>hm</think>```json\n{\"html\": \"<p>", k, ";;  x</p>\", \"highlights\": {\"current\": []}}\n```")).when(k % 3 == 1, c("just ", k)).otherwise("[1]")
    base = F.when(k % 4 < 2, "5").otherwise("а")
    number = F.when(k % 5 == 0, c(base, ".1")).otherwise(base)
    return table(spark, d, "part").select(k.alias("k"), html.answer(text).alias("a"), html.numbering_kind(number, F.when(k % 2 == 0, ".").otherwise(")")).alias("kind"), html.extends(c(base, ")"), c(number, ".")).alias("goes_on"), html.plain(html.joined_roman(F.lit("X I V&nbsp; 5 . 1"))).alias("plain")).select("k", "a.html", "a.highlights", "kind", "goes_on", "plain")


@query("WITH l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem) SELECT k || '_article_' || n || '_1_part_2_point_3' AS item_id, 'article ' || n || '.1,part 2,point 3' AS path FROM l")
def id_path(spark, d):
    i = table(spark, d, "lineitem").select(F.concat("l_orderkey", F.lit("_article_"), "l_linenumber", F.lit("_1_part_2_point_3")).alias("item_id")).distinct()
    shown = F.array_join(F.transform(html.path_of_id(F.concat("item_id", F.lit("_double_2"))), lambda t: F.concat_ws(" ", t["type"], t["number"])), ",")
    return i.select("item_id", shown.alias("path"))


def versions(spark, d):
    """A tree of customers (articles), orders (parts), lines (points), and a new version of it."""
    c = table(spark, d, "customer").where("c_custkey % 4 = 0").select("c_custkey")
    o = table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_custkey").distinct()
    lines = table(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"))
    none = F.lit(None).cast("string")

    def item(rows, id_, up, kind, number, place, text, head=none):
        return rows.select(id_.alias("item_id"), up.alias("parent_item_id"), F.lit(kind).alias("item_type"), number.cast("string").alias("item_number"), place.cast("int").alias("place"), text.cast("string").alias("text"), head.alias("head"))

    s = lambda x, *more: F.concat_ws("_", F.lit(x), *more)

    def tree_of(v: str, o, lines, text, head):
        a = item(c, s(f"{v}c", "c_custkey"), none, "article", F.col("c_custkey"), F.lit(1), F.concat(F.lit("<p>art "), "c_custkey"), head)
        b = item(o, s(f"{v}o", "o_orderkey"), s(f"{v}c", "o_custkey"), "part", F.col("o_orderkey"), F.col("o_orderkey"), F.lit("part"))
        return a.unionByName(b).unionByName(item(lines, s(f"{v}l", "o_orderkey", "l_linenumber"), s(f"{v}o", "o_orderkey"), "point", F.col("l_linenumber"), F.col("l_linenumber"), text))

    old = tree_of("old", o.where("o_orderkey % 8 <> 3"), lines.where("o_orderkey % 8 <> 3 AND l_linenumber <> 6"), F.col("p"), F.lit("Title"))
    kept = lines.where("o_orderkey % 8 <> 5 AND p % 9 <> 1")
    new = tree_of("new", o.where("o_orderkey % 8 <> 5"), kept, F.when(F.col("p") % 7 == 2, F.concat("p", F.lit(" new"))).otherwise(F.col("p").cast("string")), F.when(F.col("c_custkey") % 8 == 0, "<b>Other</b>").otherwise("Title"))
    roots = c.select(s("oldc", "c_custkey").alias("old_id"), s("newc", "c_custkey").alias("new_id"))
    return old, new, roots


VERSIONS = """c AS (SELECT c_custkey FROM customer WHERE c_custkey % 4 = 0), o AS (SELECT DISTINCT o_orderkey, o_custkey FROM orders JOIN c ON o_custkey = c_custkey),
    l AS (SELECT o_orderkey, l_linenumber AS n, min(l_partkey) AS p FROM lineitem JOIN o ON l_orderkey = o_orderkey GROUP BY ALL),
    lines AS (SELECT *, o_orderkey % 8 <> 3 AND n <> 6 AS in_old, o_orderkey % 8 <> 5 AND p % 9 <> 1 AS in_new FROM l),
    la AS (SELECT o_orderkey, n, CASE WHEN NOT in_old THEN 'add' WHEN NOT in_new THEN 'close' WHEN p % 7 = 2 THEN 'change' ELSE 'keep' END AS action, in_old, in_new FROM lines WHERE (in_old AND o_orderkey % 8 <> 5) OR in_new),
    oa AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 8 = 3 THEN 'add' WHEN o_orderkey % 8 = 5 THEN 'close' WHEN EXISTS (SELECT 1 FROM la WHERE la.o_orderkey = o.o_orderkey AND action = 'add') THEN 'change' ELSE 'keep' END AS action FROM o),
    ca AS (SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM oa WHERE o_custkey = c_custkey AND action = 'add') THEN 'change' ELSE 'keep' END AS action FROM c),
    acts AS (SELECT 'oldc_' || c_custkey AS old_id, 'newc_' || c_custkey AS new_id, action, true AS top, c_custkey % 8 = 0 AS head_changed, 1 AS depth FROM ca
        UNION ALL SELECT CASE WHEN action <> 'add' THEN 'oldo_' || o_orderkey END, CASE WHEN action <> 'close' THEN 'newo_' || o_orderkey END, action, false, false, 2 FROM oa
        UNION ALL SELECT CASE WHEN in_old THEN 'oldl_' || o_orderkey || '_' || n END, CASE WHEN in_new THEN 'newl_' || o_orderkey || '_' || n END, action, false, false, 3 FROM la)"""


@query(f"WITH {VERSIONS} FROM acts")
def tree_merge_deep(spark, d):
    return merge.merged(*versions(spark, d))


@query(f"""WITH {VERSIONS}, t AS (SELECT 'oldc_' || c_custkey AS item_id FROM c UNION ALL SELECT 'oldo_' || o_orderkey FROM o WHERE o_orderkey % 8 <> 3 UNION ALL SELECT 'oldl_' || o_orderkey || '_' || n FROM lines WHERE in_old),
    hit AS (SELECT item_id, action, top FROM t LEFT JOIN acts ON old_id = item_id)
    SELECT item_id, 1 AS rev_idx, '2016-08-08' AS valid_from, CASE WHEN action IN ('change', 'close') THEN '2020-01-14' END AS valid_to, 'add' AS mod_type, CASE WHEN action = 'close' THEN '2020-01-15' END AS not_valid FROM hit
    UNION ALL SELECT item_id, 2, '2020-01-15', NULL, CASE WHEN top THEN 'new_redaction' ELSE 'change' END, NULL FROM hit WHERE action = 'change'
    UNION ALL SELECT new_id, 1, '2020-01-15', NULL, 'add', NULL FROM acts WHERE action = 'add'""")
def rebuild_history(spark, d):
    old, new, roots = versions(spark, d)
    none = F.lit(None).cast("string")
    t = old.select("item_id", F.lit(1).alias("rev_idx"), F.lit("2016-08-08").cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit("add").alias("mod_type"), none.alias("modified_by_id"), none.alias("not_valid"))
    out = merge.history_rows(merge.merged(old, new, roots), t, F.lit("2020-01-15").cast("date"), F.lit("380"))
    return out.select("item_id", "rev_idx", day("valid_from"), day("valid_to"), "mod_type", "not_valid")


@query(f"""WITH {VERSIONS}, bad AS (SELECT DISTINCT o_custkey FROM oa WHERE action <> 'keep' UNION SELECT o_custkey FROM la JOIN o USING (o_orderkey) WHERE action <> 'keep')
    SELECT 'oldc_' || c_custkey AS old_id, 'newc_' || c_custkey AS new_id, c_custkey % 8 <> 0 AND c_custkey NOT IN (SELECT o_custkey FROM bad) AS identical FROM c""")
def identical_trees(spark, d):
    return merge.identical(*versions(spark, d))


@query("WITH o AS (SELECT o_custkey AS item_id, o_orderkey AS k, CAST(o_orderdate AS DATE) AS f, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, o_orderdate) AS i FROM orders) SELECT item_id, CAST(coalesce(arg_min(f, i) FILTER (WHERE k % 3 <> 0), DATE '2020-01-15') AS VARCHAR) AS valid_from, max(CASE WHEN i = 1 THEN k END) FILTER (WHERE TRUE) AS first_key, CASE WHEN count(*) FILTER (WHERE k % 3 <> 0) = 0 THEN 1 ELSE 0 END AS n_filled FROM o GROUP BY item_id")
def first_dates(spark, d):
    from lexstrata.plans.catalogue import listed

    t = listed(spark, d).withColumn("valid_from", F.when(F.col("rev_key") % 3 != 0, F.col("valid_from"))).withColumn("mod_type", F.lit(None).cast("string")).withColumn("modified_by_id", F.lit(None).cast("string"))
    at = F.lit("2020-01-15").cast("date")
    filled = merge.with_first_dates(t, at, F.lit("380")).groupBy("item_id").agg(F.count_if(F.col("mod_type") == "add").cast("int").alias("n_filled"), F.min_by("rev_key", "rev_idx").alias("first_key"))
    return merge.earliest_dated(t, at).join(filled, "item_id").select("item_id", day("valid_from"), "first_key", "n_filled")


KINDS = ["Наименование", "Статья 2 наименование", "Преамбула", "Приложение 1 префикс", "статья 3 пункт 1", "статья 9", "нпа"]


def changes(spark, d):
    k = F.col("k")
    named = orders(spark, d).distinct().select(k.alias("change_id"), k.alias("seq"), k.alias("npa_id"), pick(KINDS, k % 7).alias("structural"), (k % 7).alias("kind"))
    own = F.when(F.col("kind").isin(1, 3, 4), F.concat(F.lit("i"), "change_id"))
    kind = F.when(F.col("kind") == 6, "add").when(F.col("change_id") % 5 == 0, "delete").otherwise("change")
    value = F.when(F.col("change_id") % 3 == 0, "<b>same</b>").otherwise("<b>new</b> text")
    return named.select("change_id", "seq", "npa_id", "structural", kind.alias("type"), own.alias("item_id"), value.alias("new_value"), F.lit("2020-01-15").cast("date").alias("valid_from"), F.lit("380").alias("modified_by_id"))


def targets(spark, d):
    """Every target has one open revision, 'same'."""
    r = router.routed(changes(spark, d)).where("item_id IS NOT NULL AND scope <> 'root_addition'")
    none = F.lit(None).cast("string")
    return r.select("scope", "item_id", F.lit(1).alias("rev_idx"), F.lit("2016-08-08").cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit("same").alias("value"), F.lit("add").alias("mod_type"), none.alias("modified_by_id"), none.alias("not_valid"))


CHANGES = f"""o AS (SELECT DISTINCT o_orderkey AS k FROM orders), ch AS (SELECT k, k % 7 AS n, CASE WHEN k % 7 = 6 THEN 'add' WHEN k % 5 = 0 THEN 'delete' ELSE 'change' END AS type, k % 3 = 0 AS same,
        {sql_pick(['title', 'element_title', 'preamble', 'prefix', 'content', 'unresolved', 'root_addition'], 'k % 7')} AS scope, CASE WHEN k % 7 IN (0, 2, 6) THEN CAST(k AS VARCHAR) WHEN k % 7 IN (1, 3, 4) THEN 'i' || k END AS item_id FROM o),
    ch2 AS (SELECT *, item_id IS NOT NULL AND NOT (n < 2 AND type <> 'change') AS writes, n IN (0, 1, 3) AND same AS idle FROM ch)"""


@query(f"""WITH {CHANGES}, held AS (SELECT *, writes AND NOT idle AS hit FROM ch2 WHERE item_id IS NOT NULL)
    SELECT scope, item_id, 1 AS rev_idx, '2016-08-08' AS valid_from, CASE WHEN hit THEN '2020-01-14' END AS valid_to, 'same' AS value, 'add' AS mod_type, CASE WHEN hit AND type = 'delete' THEN '2020-01-15' END AS not_valid FROM held WHERE n <> 6
    UNION ALL SELECT scope, item_id, CASE WHEN n = 6 THEN 1 ELSE 2 END, '2020-01-15', NULL, CASE WHEN n IN (0, 1, 3) THEN CASE WHEN same THEN 'same' ELSE 'new text' END ELSE CASE WHEN same THEN '<b>same</b>' ELSE '<b>new</b> text' END END, type, NULL FROM held WHERE hit AND type <> 'delete'""")
def routed_changes(spark, d):
    """Title, element title, preamble, prefix, content and root additions, all at once."""
    out = router.applied_everywhere(targets(spark, d), router.routed(changes(spark, d)))
    return out.select("scope", "item_id", "rev_idx", day("valid_from"), day("valid_to"), "value", "mod_type", "not_valid")


@query(f"WITH {CHANGES} SELECT k AS change_id, scope FROM ch2 WHERE NOT writes")
def refused_changes(spark, d):
    return router.refused(router.routed(changes(spark, d))).select("change_id", "scope")


@query(f"""WITH {CHANGES} SELECT k AS change_id, CASE WHEN n = 3 THEN true WHEN item_id IS NULL THEN false WHEN n = 6 THEN true WHEN n < 2 THEN type = 'change' AND NOT same WHEN n = 2 AND type = 'change' THEN true ELSE true END AS passed FROM ch2""")
def outcomes_by_kind(spark, d):
    r = router.routed(changes(spark, d))
    return verify.outcomes_by_kind(r, router.applied_everywhere(targets(spark, d), r))


@query("SELECT DISTINCT o_orderkey AS change_id, CASE WHEN o_orderkey % 2 = 0 THEN 'known' || o_orderkey % 5 ELSE 'anew' || o_orderkey END AS item_id, CASE WHEN o_orderkey % 2 = 0 THEN 'mapping' ELSE 'path' END AS source FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0")
def recovered_changes(spark, d):
    o = orders(spark, d).distinct()
    failed = o.select(F.col("k").alias("change_id"), F.when(F.col("k") % 2 == 0, F.concat(F.lit("e"), F.col("k") % 5)).otherwise("x").alias("element"))
    known = spark.createDataFrame([(f"e{k}", f"known{k}") for k in range(5)], "element string, item_id string")
    again = o.where("k % 3 = 0").select(F.col("k").alias("change_id"), F.concat(F.lit("anew"), "k").alias("item_id"))
    return router.recovered(failed, known, again).select("change_id", "item_id", "source")


def line_bodies(spark, d):
    """Bodies of orders: a paragraph, then references to their lines but every fourth part's; two revisions of each."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"))
    w = F.concat_ws("_", "l_orderkey", "l_linenumber")
    children = lines.select(w.alias("item_id"), F.col("l_orderkey").cast("string").alias("parent_item_id"), F.col("l_linenumber").alias("place"), "p")
    revs = children.select(F.col("parent_item_id").alias("item_id")).distinct().withColumn("rev_idx", F.explode(F.array(F.lit(1), F.lit(2))))
    timeline = revs.select("item_id", "rev_idx", F.when(F.col("rev_idx") == 1, F.lit("2020-01-14").cast("date")).alias("valid_to"), F.when(F.col("item_id") % 6 == 0, "new_redaction").otherwise("change").alias("mod_type"))
    paragraphs = revs.select("item_id", "rev_idx", F.lit(1).alias("ord"), F.lit(None).cast("string").alias("ref_item_id"))
    refs = children.where("p % 4 <> 0").withColumnRenamed("item_id", "ref").withColumn("item_id", F.col("parent_item_id")).join(revs, "item_id").select("item_id", "rev_idx", (F.col("place") + 1).alias("ord"), F.col("ref").alias("ref_item_id"))
    return children, timeline, paragraphs.unionByName(refs)


LINES = "l AS (SELECT CAST(l_orderkey AS VARCHAR) AS item_id, l_linenumber AS n, min(l_partkey) AS p FROM lineitem GROUP BY ALL), r AS (SELECT item_id, unnest([1, 2]) AS rev_idx FROM (SELECT DISTINCT item_id FROM l))"


@query(f"""WITH {LINES}, h AS (SELECT item_id, n, p % 4 <> 0 AS held FROM l), t AS (SELECT item_id, 1 + max(CASE WHEN held THEN n ELSE 0 END) AS top FROM h GROUP BY item_id)
    SELECT item_id, rev_idx, 1 AS ord, NULL AS ref_item_id FROM r UNION ALL SELECT item_id, rev_idx, n + 1, item_id || '_' || n FROM h JOIN r USING (item_id) WHERE held
    UNION ALL SELECT item_id, 2, CAST(CASE WHEN top = 1 THEN 1 ELSE top END + row_number() OVER (PARTITION BY item_id ORDER BY n) AS INTEGER), item_id || '_' || n FROM h JOIN t USING (item_id) WHERE NOT held AND CAST(item_id AS BIGINT) % 6 <> 0""")
def missing_refs_added(spark, d):
    children, timeline, blocks = line_bodies(spark, d)
    return repairs.with_missing_refs(blocks, children, timeline.where("valid_to IS NULL"))


@query(f"""WITH {LINES}, b AS (SELECT item_id, rev_idx, 0 AS n, NULL AS ref_item_id FROM r UNION ALL SELECT item_id, rev_idx, n, item_id || '_' || n FROM l JOIN r USING (item_id) WHERE p % 4 <> 0 AND NOT (rev_idx = 2 AND n % 3 = 0))
    SELECT item_id, rev_idx, CAST(row_number() OVER (PARTITION BY item_id, rev_idx ORDER BY n) AS INTEGER) AS ord, ref_item_id FROM b""")
def broken_refs_dropped(spark, d):
    children, timeline, blocks = line_bodies(spark, d)
    known = children.where("place % 3 <> 0").select("item_id")
    dense = bodies.renumbered(blocks, ["item_id", "rev_idx"], "ord").select(*blocks.columns)
    return repairs.without_broken_refs(dense, known, timeline)


@query(f"WITH {LINES} SELECT item_id || '_' || n || CASE WHEN n % 2 = 0 THEN '_double_2' ELSE '' END AS item_id FROM l WHERE n % 2 = 1 OR p % 3 = 0")
def empty_copies_dropped(spark, d):
    children, _, _ = line_bodies(spark, d)
    renamed = children.select(F.concat("item_id", F.when(F.col("place") % 2 == 0, "_double_2").otherwise("")).alias("item_id"), "p")
    return repairs.without_empty_copies(renamed.select("item_id"), renamed.where("p % 3 = 0"), renamed.where("false"))


@query(f"""WITH {LINES}, k AS (SELECT DISTINCT item_id FROM r), v AS (SELECT item_id FROM l WHERE CAST(item_id AS BIGINT) % 6 = 0 AND p % 4 <> 0)
    SELECT 'revision_body_source_violation' AS category, 'error' AS severity, item_id AS element, 1 AS step FROM v
    UNION ALL SELECT 'body_block_type_unknown', 'error', item_id, 2 FROM l WHERE p % 10 = 0 UNION ALL SELECT 'body_block_invalid', 'warning', item_id, 2 FROM l WHERE p % 10 = 1
    UNION ALL SELECT 'head_revision_active_conflict', 'warning', item_id, 3 FROM k WHERE CAST(item_id AS BIGINT) % 4 = 0
    UNION ALL SELECT 'highlights_invalid', 'warning', item_id, 4 FROM k WHERE CAST(item_id AS BIGINT) % 5 < 2
    UNION ALL SELECT 'change_skipped', 'warning', item_id, 5 FROM k WHERE CAST(item_id AS BIGINT) % 3 <> 0""")
def verify_all(spark, d):
    """Checks in their fixed order: sources of new wordings, blocks, titles, highlights, the change log."""
    children, timeline, blocks = line_bodies(spark, d)
    orders_ = timeline.select("item_id").distinct()
    k = F.col("item_id").cast("long")
    typed = children.select(F.col("parent_item_id").alias("item_id"), F.when(F.col("p") % 10 == 0, "picture").when(F.col("p") % 2 == 0, "child_ref").otherwise("paragraph").alias("block_type"), F.when(F.col("p") % 10 != 1, "x").alias("html_text"), F.lit("r").alias("ref_item_id"))
    heads = orders_.withColumn("valid_to", F.explode(F.when(k % 4 == 0, F.array(F.lit(None).cast("date"), F.lit(None).cast("date"))).otherwise(F.array(F.lit(None).cast("date")))))
    marks = orders_.withColumn("highlights", F.when(k % 5 == 0, "[1]").when(k % 5 == 1, "{bad").when(k % 5 == 2, '{"current": {}}'))
    log = orders_.select(F.col("item_id").alias("change_id"), F.when(k % 3 == 0, True).when(k % 3 == 1, False).alias("applied"), F.lit("change").alias("type"))
    found = verify.verified([verify.inherited_references(blocks, timeline), verify.block_checks(typed), verify.head_checks(heads), verify.highlight_checks(marks), verify.change_log_checks(log)])
    return found.select("category", "severity", "element", "step")


@query("""WITH o AS (SELECT DISTINCT o_orderkey AS k FROM orders), found AS (SELECT 'source_date_missing' AS category, 'error' AS severity, CAST(k AS VARCHAR) AS element, '' AS message FROM o WHERE k % 5 = 0
    UNION ALL SELECT 'source_date_invalid', 'error', CAST(k AS VARCHAR), '' FROM o WHERE k % 5 = 1 UNION ALL SELECT 'duplicate_item_id', 'error', 'i' || k, '' FROM o WHERE k % 7 = 0 UNION ALL SELECT 'broken_child_ref', 'error', 'x' || k, '' FROM o WHERE k % 2 = 0)
    SELECT '{"category":"' || category || '","severity":"' || severity || '","element":"' || element || '","message":"' || message || '"}' AS issue FROM found""")
def preflight_all(spark, d):
    o = orders(spark, d).distinct()
    k = F.col("k")
    sources = o.select("k", F.when(k % 5 == 0, " ").when(k % 5 == 1, "not-a-date").otherwise("15.01.2020").alias("valid_from"))
    items = o.select(F.concat(F.lit("i"), k).alias("item_id")).unionByName(o.where("k % 7 = 0").select(F.concat(F.lit("i"), k).alias("item_id")))
    refs = o.select(F.lit("p").alias("item_id"), F.concat(F.when(k % 2 == 0, "x").otherwise("i"), k).alias("ref_item_id"))
    return verify.as_json(verify.preflight(sources, "k", "valid_from", items, refs))


@query("""WITH o AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 2 = 0), l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem)
    SELECT 'o' || k AS item_id, '1' AS closes, 1 AS copies, '2020-01-15' AS valid_from, 'change' AS mod_type, 'm' AS modified_by_id FROM o
    UNION ALL SELECT 'l' || k || '_' || n, CASE WHEN n % 4 = 0 THEN '1' END, 1, '2020-01-15', 'change', 'm' FROM o JOIN l USING (k) WHERE n % 2 = 0""")
def sync_cascade(spark, d):
    """Customers' revisions of a day refer to their even orders, these to their lines; of both some have no revision in force that day.

    A third of the orders is in force and passes nothing on. Of stale items, orders and every fourth line are open from a later day on.
    """
    from lexstrata.operators.temporal import synced_tree

    at, early, late = (F.lit(x).cast("date") for x in ("2020-01-15", "2019-01-01", "2020-02-02"))
    none = F.lit(None).cast("date")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey").distinct()
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    n, k = F.col("l_linenumber"), F.col("o_orderkey")
    name = lambda x, *more: F.concat(F.lit(x), F.concat_ws("_", *more))
    t = o.select(name("c", "o_custkey").alias("item_id"), at.alias("valid_from"), none.alias("valid_to")).distinct()
    t = t.unionByName(o.select(name("o", "o_orderkey").alias("item_id"), F.when(k % 3 == 0, early).otherwise(late).alias("valid_from"), none.alias("valid_to")))
    t = t.unionByName(lines.select(name("l", "l_orderkey", "l_linenumber").alias("item_id"), F.when(n % 4 == 0, late).otherwise(early).alias("valid_from"), F.when(n % 4 == 2, F.date_sub(at, 1)).alias("valid_to")))
    t = t.withColumn("rev_idx", F.lit(1)).withColumn("modified_by_id", F.lit("m"))
    refs = o.where("o_orderkey % 2 = 0").select(name("c", "o_custkey").alias("item_id"), name("o", "o_orderkey").alias("child_id")).unionByName(lines.select(name("o", "l_orderkey").alias("item_id"), name("l", "l_orderkey", "l_linenumber").alias("child_id")))
    out = synced_tree(t, refs.withColumn("rev_idx", F.lit(1)), at)
    return out.select("item_id", F.col("closes").cast("string").alias("closes"), "copies", day("valid_from"), "mod_type", "modified_by_id")
