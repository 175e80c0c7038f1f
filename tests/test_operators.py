import datetime

from pyspark.sql import functions as F

from lexstrata.operators import amend, highlights, history, temporal, tree, verify
from lexstrata.operators.paths import resolved
from lexstrata.sources import documents


def day(s):
    return datetime.date.fromisoformat(s) if s else None


TIMELINE = "item_id string, rev_idx int, valid_from date, valid_to date"


def timeline(spark, *rows):
    return spark.createDataFrame([(i, k, day(a), day(b)) for i, k, a, b in rows], TIMELINE)


def effective(df, date):
    return {r.item_id: r.rev_idx for r in temporal.effective_revision(df, F.lit(date).cast("date")).collect()}


def test_as_of_ends_count(spark):
    t = timeline(spark, ("n", 0, "2003-02-27", "2003-02-28"), ("n", 1, "2003-03-01", "2003-03-01"), ("n", 2, "2003-03-02", None))
    want = {"2003-02-26": {}, "2003-02-27": {"n": 0}, "2003-02-28": {"n": 0}, "2003-03-01": {"n": 1}, "2003-03-02": {"n": 2}, "2103-03-02": {"n": 2}}
    assert {d: effective(t, d) for d in want} == want


def test_as_of_overlap_tie_and_undated(spark):
    rows = [("undated", 0, None, None), ("tie", 0, "1999-07-05", "2001-01-01"), ("tie", 1, "1999-07-05", None), ("overlap", 0, "1998-05-05", "2010-01-01"), ("overlap", 1, "1999-06-06", "2000-12-31"), ("overlap", 2, "2000-12-31", None)]
    t = timeline(spark, *rows)
    assert [effective(t, d) for d in ("2000-01-01", "2000-12-31", "2001-01-02")] == [{"tie": 0, "overlap": 1}, {"tie": 0, "overlap": 2}, {"tie": 1, "overlap": 2}]


def test_latest_and_active(spark):
    t = timeline(spark, ("a", 0, "2020-01-01", None), ("a", 1, "2019-01-01", None), ("b", 0, None, "2020-01-01"), ("b", 1, None, "2020-01-01"))
    ids = lambda df: {r.item_id: r.rev_idx for r in df.collect()}
    assert ids(temporal.latest_revision(t)) == {"a": 0, "b": 1}
    assert ids(temporal.active_for_reading(t)) == {"a": 1, "b": 1}
    assert ids(temporal.active_for_writing(t)) == {"a": 0, "b": 1}


def test_missing_children_and_sync_is_idempotent(spark):
    parents = spark.createDataFrame([("p", "c", day("2020-01-01"), "s1"), ("p", "none", day("2020-01-01"), "s1")], "item_id string, child_id string, valid_from date, modified_by_id string")
    stale = timeline(spark, ("c", 0, "2019-01-01", "2019-12-31"))
    assert {(r.child_id, r.category) for r in temporal.missing_children(parents, stale).collect()} == {("c", "stale_child_revision"), ("none", "revision_child_missing")}
    at = F.lit("2020-01-01").cast("date")
    new = temporal.synced_children(parents, stale, at)
    assert [(r.item_id, r.copies, r.mod_type) for r in new.collect()] == [("c", 0, "change")]
    after = stale.unionByName(new.select("item_id", F.lit(1).alias("rev_idx"), "valid_from", F.lit(None).cast("date").alias("valid_to")))
    assert temporal.synced_children(parents, after, at).count() == 0


ITEMS = "item_id string, parent_item_id string, item_type string, item_number string"


def test_plan_with_cycle_and_dominance(spark):
    i = spark.createDataFrame([("a", None, "article", "1"), ("p", "a", "part", "1"), ("q", "p", "point", "1"), ("b", None, "article", "2"), ("r", "b", "point", "1")], ITEMS)
    c = tree.closure(i)
    ask = lambda *x: spark.createDataFrame([(v,) for v in x], "item_id string")
    assert {r.item_id for r in tree.rebuild_plan(i, ask("a", "p", "q"), c).collect()} == {"a"}
    assert {(r.item_id, r.depth) for r in tree.rebuild_plan(i, ask("q", "r"), c).collect()} == {("q", 3), ("r", 2), ("p", 2), ("a", 1), ("b", 1)}
    loop = spark.createDataFrame([("a", "b", "x", None), ("b", "a", "x", None)], ITEMS)
    assert {(r.item_id, r.ancestor_id) for r in tree.closure(loop).collect()} == {("a", "b"), ("b", "a")}


def test_paths_pass_through_containers(spark):
    i = spark.createDataFrame([("s", None, "section", "1"), ("a", "s", "article", "1"), ("p", "a", "point", "1"), ("p2", "a", "point", "1")], ITEMS).withColumn("npa_id", F.lit(1))
    tokens = "path_id string, npa_id int, tokens array<struct<type: string, number: string>>"
    paths = spark.createDataFrame([("x", 1, [("article", "1"), ("point", "1")]), ("y", 1, [("article", "1")]), ("z", 1, [("article", "9")]), ("w", 2, [("article", "1")])], tokens)
    got = {(r.path_id, r.item_id, r.n_matches) for r in resolved(i, paths).collect()}
    assert got == {("x", "p", 2), ("x", "p2", 2), ("y", "a", 1)}


def test_amendments_close_and_append(spark):
    full = TIMELINE + ", value string, mod_type string, modified_by_id string, not_valid string"
    t = spark.createDataFrame([("a", 0, day("2016-08-08"), None, "old", None, None, None), ("d", 0, day("2016-08-08"), None, "old", None, None, None)], full)
    changes = spark.createDataFrame([("a", 1, "change", "v1", day("2017-12-15"), "s"), ("a", 2, "new_redaction", "v2", day("2018-01-01"), "s"), ("d", 1, "delete", None, day("2017-12-15"), "s"), ("x", 1, "change", "v", day("2017-12-15"), "s")], "item_id string, seq int, type string, new_value string, valid_from date, modified_by_id string")
    got = {(r.item_id, r.value, str(r.valid_from), str(r.valid_to), r.not_valid) for r in amend.applied(t, changes).collect()}
    assert got == {("a", "old", "2016-08-08", "2017-12-14", None), ("a", "v1", "2017-12-15", "2017-12-31", None), ("a", "v2", "2018-01-01", "None", None), ("d", "old", "2016-08-08", "2017-12-14", "2017-12-15")}
    assert [r.item_id for r in amend.unresolved(t, changes).collect()] == ["x"]


def test_confidence_and_trust(spark):
    log = spark.createDataFrame([("e", "verified_success", "i", 1), ("f", "resolved", "j", 2), *[("g", "verified_failure", None, k) for k in range(10)], ("g", "verified_success", "k", 11)], "element string, outcome string, item_id string, ts int")
    got = {r.element: (r.success, r.failure, r.telemetry, round(r.confidence, 4)) for r in history.mapping_counts(log, ["element"]).collect()}
    assert got == {"e": (1, 0, 0, 0.3333), "f": (0, 0, 1, 0.0), "g": (1, 10, 0, round(1 / 13, 4))}
    assert {r.element for r in history.reliable_mappings(log, ["element"]).collect()} == {"e"}
    assert {r.element for r in history.contested_mappings(log, ["element"]).collect()} == {"g"}
    assert {r.element: r.trusted for r in history.run_trust(log, "element").collect()} == {"e": True, "f": False, "g": False}


def test_differences(spark):
    schema = "k int, pos int, paragraph string"
    old = spark.createDataFrame([(1, 1, "the old text"), (1, 2, "same"), (1, 3, "gone")], schema)
    new = spark.createDataFrame([(1, 1, "the newer text"), (1, 2, "same"), (2, 1, "fresh")], schema)
    got = {(r.k, r.pos, r.side, r.old_text, r.new_text) for r in highlights.differences(old, new, "k").collect()}
    assert got == {(1, 1, "difference", "old", "newer"), (1, 3, "deletion", "gone", ""), (2, 1, "addition", "", "fresh")}


def test_json_round_trip(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"npa_items_revision": [{"item_id": "a", "item_type": "article", "item_number": 1, "item_children": [{"item_id": "b", "item_type": "point", "revisions": [{"valid_from": "08.08.2016", "valid_to": "", "body": [{"type": "paragraph", "html_text": "<p>x</p>", "order": 1}, {"type": "child_ref", "item_id": "c", "order": 2}]}]}]}]}')
    (tmp_path / "in/bad.json").write_text("{")
    docs = documents.read_json(spark, str(tmp_path / "in"))
    assert docs.where("broken").count() == 1
    items = documents.flatten_items(docs, 3)
    assert {(r.item_id, r.parent_item_id, r.depth) for r in items.collect()} == {("a", None, 1), ("b", "a", 2)}
    revisions = documents.revisions_of(items)
    assert [(r.item_id, str(r.valid_from), r.valid_to) for r in revisions.collect()] == [("b", "2016-08-08", None)]
    blocks = documents.blocks_of(revisions)
    assert {(r.block_type, r.ref_item_id) for r in blocks.collect()} == {("paragraph", None), ("child_ref", "c")}
    assert documents.rendered(blocks, ["item_id"]).first().html == "<p>x</p>"
    assert verify.passed(verify.inlined_children(blocks)).first().passed


def test_trees_of_any_depth(spark):
    import json

    from lexstrata.operators import bodies, tree
    from lexstrata.sources import documents

    n = 150
    chain = spark.createDataFrame([(f"i{k}", f"i{k - 1}" if k else None) for k in range(n)], "item_id string, parent_item_id string")
    assert tree.closure(chain).count() == n * (n - 1) // 2
    blocks = spark.createDataFrame([x for k in range(8) for x in ((f"i{k}", 1, f"t{k}", None), (f"i{k}", 2, None, f"i{(k + 1) % 8}"))], "item_id string, ord int, html_text string, ref_item_id string")
    roots = spark.createDataFrame([("i0",)], "root_id string")
    assert bodies.rendered_tree(roots, blocks, 3).first().html == "\n".join(f"t{k}" for k in range(8))
    item = None
    for k in reversed(range(8)):
        item = {"item_id": f"i{k}", "item_children": [item] if item else []}
    docs = documents.parsed(spark.createDataFrame([("p", json.dumps({"npa_items_revision": [item]}))], "path string, raw string"))
    assert documents.flatten_items(docs, 3).count() == 8
