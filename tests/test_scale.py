"""What keeps the cost of shared steps in proportion to their input."""

from pyspark.sql import functions as F

from lexstrata.functions import numbers
from lexstrata.session import cut


def test_cut_works_a_table_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    found = cut(spark.range(100).mapInArrow(run, "id long"))
    assert found.count() == 100 and seen.value == 100


def test_cut_keeps_rows_with_untyped_columns(spark):
    assert [tuple(r) for r in cut(spark.sql("SELECT 1 AS a, NULL AS b")).collect()] == [(1, None)]


def test_a_number_is_cleaned_once(spark):
    plan = spark.range(1).select(numbers.clean_number(F.col("id")).alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<[^>]+>") == 1


def test_a_fragment_is_dealt_once(spark):
    from lexstrata.operators import fragments

    rows = spark.createDataFrame([("k", "d_article_1", "<p>1. x</p>")], "key string, element_id string, html string")
    found = fragments.events(fragments.classified(fragments.blocks(fragments._told(rows))))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_long_rows_are_unpacked_a_few_at_a_time():
    import pyarrow as pa

    from lexstrata.session import row_dicts

    sizes = []

    class Batch:
        num_rows = 1000

        def slice(self, at, size):
            sizes.append(min(size, 1000 - at))
            return pa.RecordBatch.from_pylist([{"x": i} for i in range(at, min(at + size, 1000))])

    assert [r["x"] for r in row_dicts([Batch()])] == list(range(1000)) and max(sizes) <= 256


def test_prints_gather_children_of_uneven_depth(spark):
    from lexstrata.operators import merge

    tree = [("a", None, 1), ("b", "a", 1), ("c", "a", 2), ("d", "b", 1), ("x", None, 1), ("y", "x", 1), ("z", "x", 2), ("w", "y", 1), ("l", "m", 1), ("m", "l", 1)]
    rows = spark.createDataFrame([(i, up, "part", None, place, "") for i, up, place in tree], "item_id string, parent_item_id string, item_type string, item_number string, place int, text string")
    found = dict(merge.fingerprints(rows).collect())
    assert found["a"] == found["x"] != found["b"] == found["y"] and set(found) == set("abcdxyzw")


def test_only_rows_below_the_roots_are_walked(spark):
    from lexstrata.operators import tree

    edges = [("a", None), ("b", "a"), ("c", "b"), ("d", "c"), ("e", None), ("f", "e"), ("p", "q"), ("q", "p")]
    items = spark.createDataFrame(edges, "item_id string, parent_item_id string")
    roots = spark.createDataFrame([("a",), ("c",), ("p",)], "ancestor_id string")
    want = {r for r in tree.closure(items).collect() if r.ancestor_id in ("a", "c", "p")}
    assert set(tree.descendants(items, roots).collect()) == want


def test_only_checks_of_changed_tables_run_again(spark, monkeypatch):
    from lexstrata.operators import document

    ran = []
    spy = lambda step, reads, check: (step, reads, lambda *t: ran.append(step) or check(*t))
    monkeypatch.setattr(document, "CHECKS", tuple(spy(*c) for c in document.CHECKS))
    tables = {
        "items": spark.sql("SELECT 'a' AS item_id, CAST(NULL AS STRING) AS parent_item_id, 'part' AS item_type, '1' AS item_number, 2 AS item_level, 1 AS depth, 1 AS place"),
        "timeline": spark.sql("SELECT 'a' AS item_id, 1 AS rev_idx, CAST(NULL AS DATE) AS valid_from, CAST(NULL AS DATE) AS valid_to, 'add' AS mod_type, CAST(NULL AS STRING) AS modified_by_id, CAST(NULL AS STRING) AS highlights"),
        "blocks": spark.sql("SELECT 'a' AS item_id, 1 AS rev_idx, 1 AS ord, 'child_ref' AS block_type, CAST(NULL AS STRING) AS html_text, 'b' AS ref_item_id"),
        "heads": spark.sql("SELECT 'a' AS item_id, 1 AS rev_idx, CAST(NULL AS DATE) AS valid_to"),
    }
    count = document.IssueCounter()
    assert count(tables) == document.verify_document(tables).count() == 3
    del ran[:]
    tables["items"] = tables["items"].withColumn("item_level", tables["items"]["depth"])
    assert count(tables) == 2 and sorted(ran) == [1, 2, 4]


def test_fragments_with_a_fixed_id_are_parsed(spark):
    from lexstrata.operators import fragments

    rows = spark.sql("SELECT 1L AS key, '<p>2) x</p>' AS html, 'd_article_1_part_1' AS element_id")
    assert [r.item_id for r in fragments.parse(rows).items.orderBy("pos").collect()] == ["d_article_1_part_1", "d_article_1_part_1_part_2"]


def test_only_rows_above_the_items_are_walked(spark):
    from lexstrata.operators import rendering, tree

    edges = [("a", None), ("b", "a"), ("c", "b"), ("d", "c"), ("d", "a"), ("e", None), ("f", "e"), ("p", "q"), ("q", "p"), ("o", "gone")]
    items = spark.createDataFrame(edges, "item_id string, parent_item_id string")
    below = spark.createDataFrame([("d",), ("p",), ("o",), ("none",)], "item_id string")
    want = {r for r in tree.closure(items).collect() if r.item_id in ("d", "p", "o")}
    assert set(tree.ancestors(items, below).collect()) == want
    pending = spark.createDataFrame([("d", "<p>x</p>"), ("f", "")], "item_id string, html string")
    asked = spark.createDataFrame([("b",), ("d",), ("c",), ("o",), ("none",), ("f",)], "item_id string")
    steps = [(r.item_id, r.depth, r.step) for r in rendering.rebuild_steps(items, asked, pending).orderBy("step").collect()]
    assert steps[0][:2] == ("d", 3) and {s[:2] for s in steps} == {("d", 3), ("b", 2), ("f", 2), ("o", 2)} and len(steps) == 5


def test_bodies_meet_staged_markup_once(spark):
    from lexstrata.operators import rendering

    blocks = spark.createDataFrame([("a", 1, "paragraph", "<p>old</p>", None), ("a", 2, "child_ref", None, "b"), ("b", 1, "paragraph", "<p>b</p>", None), ("c", 1, None, "x", None)], "item_id string, ord long, type string, html_text string, ref_item_id string")
    pending = spark.createDataFrame([("a", "<p>new</p>"), ("a", "<p>new</p>"), ("b", ""), ("z", "<p>z</p>")], "item_id string, html string")
    found = rendering.staged_blocks(blocks, pending)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Left") == 1 and "LeftSemi" not in plan and "LeftAnti" not in plan
    got = sorted((r.item_id, r.ord, r.html_text, r.ref_item_id) for r in found.collect() if r.item_id != "a")
    assert got == [("b", 1, "<p>b</p>", None), ("c", 1, "x", None), ("z", 1, "<p>z</p>", None)]
    assert [r.ref_item_id for r in found.where("item_id = 'a'").orderBy("ord").collect()] == [None, None, "b"]


def test_documents_are_parsed_in_one_pass(spark):
    from lexstrata.sources import documents

    deep = '{"item_id":"g"}'
    for i in "fedcb":
        deep = f'{{"item_id":"{i}","item_children":[{deep},null]}}'
    raw = f'{{"npa_items_revision":[{{"item_id":"a","item_level":"x"}},{deep}]}}'
    docs = documents.parsed(spark.createDataFrame([("p", raw), ("q", "{"), ("r", "{}")], "path string, raw string"))
    three = documents.flatten_items(docs, 3)
    plan = three._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("npa_items_revision") <= 2
    want = [("a", None, 1, [0]), ("b", None, 1, [1]), ("c", "b", 2, [1, 0]), (None, "b", 2, [1, 1]), ("d", "c", 3, [1, 0, 0])]
    for found in (three, documents.flatten_items(docs)):
        got = {(r.item_id, r.parent_item_id, r.depth, tuple(r.sort_path)) for r in found.select("item_id", "parent_item_id", "depth", "sort_path").collect()}
        assert {(i, up, d, tuple(at)) for i, up, d, at in want} <= got and ("g", "f", 6, (1, 0, 0, 0, 0, 0)) in got and len(got) == 12


def test_additions_write_their_tables_once(spark, monkeypatch):
    from lexstrata.operators import additions

    written, real = [], additions.cut
    monkeypatch.setattr(additions, "cut", lambda df: (written.append(tuple(df.columns)), real(df))[1])
    items = spark.createDataFrame([(1, "a", None, "article", "1", 1, 1), (1, "p", "a", "point", "2)", 2, 1)], "npa_id long, item_id string, parent_item_id string, item_type string, item_number string, item_level int, place int")
    blocks = spark.createDataFrame([("a", 1, "child_ref", None, "p"), ("p", 1, "paragraph", "<p>x.</p>", None)], "item_id string, ord int, type string, html_text string, ref_item_id string")
    new = spark.createDataFrame([(7, 1, 1, "a", "point", "3", "<p>3) y.</p>", "01.02.2024", "m")], "change_id long, npa_id long, seq int, parent_item_id string, item_type string, item_number string, html string, valid_from string, modified_by_id string")
    out = additions.added(items, blocks, new)
    assert sorted((r.item_id, r.ord, r.html_text, r.ref_item_id) for r in out.blocks.where("item_id = 'a'").collect()) == [("a", 1, None, "p"), ("a", 2, None, "a_point_3")]
    assert ("npa_id", "item_id", "parent_item_id", "item_type", "item_number", "item_level", "place") in written
    assert written.count(("item_id", "ord", "type", "html_text", "ref_item_id")) == 2  # bodies as they were, and with what came


def test_texts_are_not_carried_along_references(spark, monkeypatch):
    from lexstrata.operators import bodies, rendering

    written = []
    for module in (bodies, rendering):
        monkeypatch.setattr(module, "cut", lambda df: written.append(df.columns) or cut(df))
    items = spark.createDataFrame([("a", None, "article", "1", 1), ("p", "a", "part", "2", 1), ("q", "a", "part", "3", 2)], "item_id string, parent_item_id string, item_type string, item_number string, place int")
    rows = [("a", 1, "paragraph", "<p>A</p>", None), ("a", 2, "child_ref", None, "q"), ("a", 3, "child_ref", None, "p"), ("p", 2, "paragraph", "<p>B</p>", None), ("p", 1, "table_fragment", "<t>", None), ("q", 1, "table_fragment", "<u>", None)]
    blocks = spark.createDataFrame(rows, "item_id string, ord int, type string, html_text string, ref_item_id string")
    none = items.where("false").select("item_id", F.lit("").alias("head"))
    out = rendering.rendered_items(items.limit(1).select(F.col("item_id").alias("root_id")), items, blocks, none, none.withColumnRenamed("head", "prefix"))
    assert out.first().html == "\n".join(["<p><b>Статья 1</b></p>", "<p>A</p>", "3. ", "<u>", "<t>", "<p>2. B</p>"])
    assert written and not any("html_text" in columns for columns in written)


def test_matches_are_counted_where_they_are_met(spark):
    from lexstrata.operators import paths

    items = spark.createDataFrame([("a", "u", "point", "1)"), ("b", "u", "point", "1."), ("c", "v", "point", "2")], "item_id string, parent_item_id string, item_type string, item_number string")
    wanted = spark.createDataFrame([("w1", "u", "point", "1"), ("w2", "v", "point", "«2»"), ("w3", "v", "point", "3")], "want_id string, parent_item_id string, item_type string, item_number string")
    found = paths.matching(items, wanted)
    assert {tuple(r) for r in found.collect()} == {("w1", "a", 2), ("w1", "b", 2), ("w2", "c", 1)}
    assert "hashpartitioning(want_id" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_synced_tree_ranks_no_revisions(spark, monkeypatch):
    from lexstrata.operators import temporal

    monkeypatch.setattr(temporal, "latest_revision", None)  # what a child would get is worked out once, not by level
    day = lambda s: F.lit(s).cast("date")
    rows = [("p", 1, "2020-01-15", None, "m"), ("o", 1, "2019-01-01", "2019-06-01", None), ("o", 2, "2019-03-01", "2019-05-01", None), ("l", 1, None, "2018-01-01", None), ("l", 2, None, None, None), ("h", 1, "2019-01-01", None, None)]
    timeline = spark.createDataFrame(rows, "item_id string, rev_idx int, valid_from string, valid_to string, modified_by_id string").withColumn("valid_from", F.col("valid_from").cast("date")).withColumn("valid_to", F.col("valid_to").cast("date"))
    refs = spark.createDataFrame([("p", 1, "o"), ("p", 1, "h"), ("p", 1, "gone"), ("o", 2, "l"), ("l", 2, "o")], "item_id string, rev_idx int, child_id string")
    found = temporal.synced_tree(timeline, refs, day("2020-01-15"))
    assert {(r.item_id, r.closes, r.copies, r.modified_by_id) for r in found.collect()} == {("o", None, 2, "m"), ("l", 2, 2, "m")}


def test_lines_of_additions_are_grouped_once(spark):
    from lexstrata.plans import adding

    items, blocks, _ = adding.asked(spark, "/root/testdata/sf0.001")
    assert not any("Exchange" in t._jdf.queryExecution().executedPlan().toString() for t in (items, blocks))


def test_checks_gather_no_ids_in_the_driver(spark):
    from lexstrata.operators import document
    from lexstrata.plans import documents

    found = document.verify_document(documents.spoiled(spark, "/root/testdata/sf0.001"))
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()


def test_repairs_gather_no_ids_in_the_driver(spark):
    from lexstrata.operators import repairs
    from lexstrata.plans import documents

    t = documents.spoiled(spark, "/root/testdata/sf0.001")
    found = (repairs.with_missing_refs(t["blocks"], t["items"], t["timeline"]), repairs.without_broken_refs(t["blocks"], t["items"], t["timeline"]), repairs.without_empty_copies(t["items"], t["blocks"], t["heads"]))
    assert ["BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString() for df in found] == [False] * 3


def test_broken_references_go_and_texts_stay(spark):
    from lexstrata.operators import repairs

    blocks = spark.createDataFrame([("a", 1, 1, None, "x"), ("a", 1, 2, "gone", None), ("a", 1, 3, "b", None), ("a", 0, 1, "gone", None), ("c", 1, 1, None, "y")], "item_id string, rev_idx int, ord int, ref_item_id string, html_text string")
    items = spark.createDataFrame([("a",), ("b",), ("c",)], "item_id string")
    timeline = spark.sql("SELECT * FROM VALUES ('a', 0, DATE'2001-01-01'), ('a', 1, NULL), ('c', 1, NULL) AS t(item_id, rev_idx, valid_to)")
    got = sorted(tuple(r) for r in repairs.without_broken_refs(blocks, items, timeline).select("item_id", "rev_idx", "ord", F.coalesce("ref_item_id", "html_text")).collect())
    assert got == [("a", 0, 1, "gone"), ("a", 1, 1, "x"), ("a", 1, 2, "b"), ("c", 1, 1, "y")]


def test_a_fragments_level_and_answers_are_not_broadcast(spark, monkeypatch):
    from lexstrata.operators import fragments

    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(fragments, "cut", kept)
    html = "<table><tr><td>1.</td><td>a</td></tr></table>"
    rows = spark.createDataFrame([("k", "d_article_1_structured_table_1", html), ("m", "d_article_2", f"<p>x</p>{html}")], "key string, element_id string, html string")
    decisions = spark.createDataFrame([("p", "part", "child")], "pattern string, parent_kind string, relation string")
    found = fragments.parse(rows, decisions).items.where("item_type = 'point'").select("item_id", "item_level").collect()
    assert sorted(map(tuple, found)) == [("d_article_1_structured_table_1_point_1", 3), ("d_article_2_structured_table_1_point_1", 3)]
    assert "BroadcastHashJoin" not in plans[0] and "Join" not in plans[1]
