"""Merges, paths, records and repairs on small cases of their own."""

import datetime

import pytest
from pyspark.sql import functions as F

from lexstrata.functions import html
from lexstrata.operators import bodies, merge, paths, records, repairs
from lexstrata.session import numbered
from lexstrata.sources import documents

ITEM = "item_id string, parent_item_id string, item_type string, item_number string, place int, text string, head string"
REV = "item_id string, rev_idx int, valid_from date, valid_to date, mod_type string, modified_by_id string, not_valid string"
DAY = datetime.date(2011, 4, 9)


def tree(spark, v, *rows):
    return spark.createDataFrame([(v + i, v + up if up else None, t, n, k, text, None) for k, (i, up, t, n, text) in enumerate(rows)], ITEM)


def merge_of(spark, old, new):
    o, n = tree(spark, "o", *old), tree(spark, "n", *new)
    acts = merge.merged(o, n, spark.createDataFrame([("oa", "na")], "old_id string, new_id string"))
    t = spark.createDataFrame([("o" + r[0], 1, datetime.date(2005, 1, 1), None, "add", None, None) for r in old], REV)
    out = merge.history_rows(acts, t, F.lit(DAY), F.lit("src"))
    found = {}
    for r in out.collect():
        found.setdefault(r.item_id, []).append((r.rev_idx, r.mod_type, r.valid_to, r.not_valid))
    return {r.old_id or r.new_id: r.action for r in acts.collect()}, {k: sorted(v) for k, v in found.items()}


A, OPEN = ("a", None, "article", "7", "Body"), (1, "add", None, None)
ENDED = (1, "add", DAY - datetime.timedelta(1), None)


def test_merge_of_equal_and_changed_children(spark):
    acts, revs = merge_of(spark, [A, ("p", "a", "point", "1)", "Same  text")], [A, ("p", "a", "point", "1)", "<p>Same text</p>")])
    assert acts == {"oa": "keep", "op": "keep"} and revs == {"oa": [OPEN], "op": [OPEN]}
    acts, revs = merge_of(spark, [A, ("p", "a", "point", "1)", "x"), ("s", "p", "subpoint", "a)", "deep")], [A, ("p", "a", "point", "1)", "x"), ("s", "p", "subpoint", "a)", "other")])
    assert acts == {"oa": "keep", "op": "keep", "os": "change"} and revs["os"] == [ENDED, (2, "change", None, None)] and revs["oa"] == [OPEN]


def test_merge_of_added_removed_and_moved_children(spark):
    acts, revs = merge_of(spark, [A, ("p", "a", "point", "1)", "x")], [A, ("p", "a", "point", "1)", "x"), ("q", "a", "point", "2)", "y"), ("s", "q", "subpoint", "a)", "z")])
    assert acts == {"oa": "change", "op": "keep", "nq": "add", "ns": "add"}
    assert revs["oa"] == [ENDED, (2, "new_redaction", None, None)] and revs["nq"] == revs["ns"] == [OPEN]
    acts, revs = merge_of(spark, [A, ("p", "a", "point", "1)", "x"), ("q", "a", "point", "2)", "y")], [A, ("p", "a", "point", "1)", "x")])
    assert acts == {"oa": "keep", "op": "keep", "oq": "close"} and revs["oq"] == [(*ENDED[:3], "2011-04-09")] and revs["oa"] == [OPEN]
    acts, _ = merge_of(spark, [A, ("p", "a", "point", "1)", "x")], [A, ("r", "a", "part", "1", "new part"), ("p", "r", "point", "1)", "x")])
    assert acts == {"oa": "change", "op": "moved", "nr": "add", "np": "add"}


def test_repeated_keys_are_paired_in_order(spark):
    acts, _ = merge_of(spark, [A, ("p", "a", "point", None, "x"), ("q", "a", "point", None, "y")], [A, ("p", "a", "point", None, "x"), ("q", "a", "point", None, "z")])
    assert acts == {"oa": "keep", "op": "keep", "oq": "change"}


def test_fingerprints_leave_cycles_out_and_heads_count_apart(spark):
    rows = [("a", None, "article", "1", 1, "t", "H"), ("b", "a", "point", "1", 1, "u", None), ("c", None, "article", "1", 1, "<b>t</b>", "other"), ("d", "c", "point", "1)", 9, "u", None), ("x", "y", "point", "1", 1, "", None), ("y", "x", "point", "1", 1, "", None)]
    items = spark.createDataFrame(rows, ITEM)
    prints = {r.item_id: r.fingerprint for r in merge.fingerprints(items).collect()}
    assert set(prints) == {"a", "b", "c", "d"} and prints["b"] == prints["d"] and prints["a"] == prints["c"]
    pairs = spark.createDataFrame([("a", "c"), ("b", "d")], "old_id string, new_id string")
    assert {r.old_id: r.identical for r in merge.identical(items, items, pairs).collect()} == {"a": False, "b": True}
    assert merge.fingerprints(items.where("false")).count() == 0


def test_paths_skip_containers_and_stop_at_ambiguity(spark):
    rows = [(1, "s", None, "section", "I", 1), (1, "c", "s", "chapter", "2.", 1), (1, "a", "c", "article", "5", 1), (1, "b", "c", "article", "5.", 2), (1, "p", "a", "point", "1)", 1)]
    items = spark.createDataFrame(rows, "npa_id long, item_id string, parent_item_id string, item_type string, item_number string, place int")
    texts = spark.createDataFrame([(1, 1, "статья 5"), (2, 1, "Раздел 1 глава 2 статья 5 пункт 1"), (3, 1, "слово"), (4, 1, None)], "path_id long, npa_id long, text string")
    asked = texts.select("path_id", "npa_id", paths.structural_tokens(F.col("text")).alias("tokens"))
    got = sorted((r.path_id, r.item_id, r.n_matches) for r in paths.resolved(items, asked).collect())
    assert got == [(1, "a", 2), (1, "b", 2), (2, "p", 1)]
    far = {r.path_id: (r.item_id, len(r.remaining)) for r in paths.deepest_ancestors(items, asked).collect()}
    assert far == {1: (None, 1), 2: ("p", 0), 3: (None, 0), 4: (None, 0)}


def test_records_and_snapshots(spark, tmp_path):
    log = records.Records(spark, f"file://{tmp_path}/r")
    assert log.read("run").count() == 0 and log.list_snapshots("1") == []
    log.append("run", spark.range(2).select(F.lit("t").alias("target_npa_id"), F.col("id").alias("changes_applied")))
    log.append("run", spark.range(1).select(F.lit(5).alias("changes_failed")))
    assert sorted((r.target_npa_id or "", r.changes_applied, r.changes_failed) for r in log.read("run").collect()) == [("", None, 5), ("t", 0, None), ("t", 1, None)] or log.read("run").count() == 3
    with pytest.raises(ValueError):
        log.append("run", spark.range(1))
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "item_id string, rev_idx int")
    for k, s in enumerate(("s1", "s2", "s3")):
        log.save_snapshot("1", s, "label", rows.where(F.col("rev_idx") <= k + 1), f"2020-01-0{k + 1}")
    assert log.list_snapshots("1") == ["s1", "s2", "s3"] and log.load_snapshot("1", "s2").count() == 2
    hashes = {r.snapshot_id: r.source_hash for r in log.read("snapshot").collect()}
    assert hashes["s2"] == hashes["s3"] != hashes["s1"]
    assert log.drop_snapshots("1") == [] and log.drop_snapshots("1", ["s3"]) == ["s1", "s2"] and log.load_snapshot("1", "s3").count() == 2


def test_fixes_are_logged(spark):
    rows = spark.createDataFrame([("a", 3), ("b", None), ("c", 1)], "item_id string, level int")
    fixes = [("fill", lambda t: {"items": t["items"].fillna({"level": 3})}), ("lower", lambda t: {"items": t["items"].withColumn("level", F.lit(1))})]
    tables, log = repairs.run_fixes({"items": rows}, fixes, lambda t: t["items"].where("level IS NULL OR level > 1"), lambda df, name: df.checkpoint())
    assert [tuple(r) for r in log.orderBy("step").collect()] == [(1, "fill", 2, 2), (2, "lower", 2, 0)] and tables["items"].where("level > 1").count() == 0


def test_answers_of_files(spark, tmp_path):
    (tmp_path / "prompt_1_answer.json").write_text('[{"type": "add", "new": "x"}, {"type": "delete"}]')
    (tmp_path / "prompt_2_answer.json").write_text("not json")
    got = documents.read_answers(spark, f"file://{tmp_path}/*.json", "type string, new string").orderBy("file", "pos").collect()
    assert [(r.pos, r.broken, r.type, r.new) for r in got] == [(0, False, "add", "x"), (1, False, "delete", None), (0, True, None, None)]


def test_numbers_over_ranges_and_nearest_references(spark):
    df = spark.range(200).select((F.col("id") * 37 % 200).alias("v")).repartition(7)
    assert sorted((r.v, r.n) for r in numbered(df, "n", F.asc("v")).collect()) == [(k, k + 1) for k in range(200)]
    blocks = spark.createDataFrame([("i", 1, None), ("i", 2, "c"), ("i", 3, "g")], "item_id string, ord int, ref_item_id string")
    places = spark.createDataFrame([(x, k) for k, x in enumerate("abcdefgh")], "ref_item_id string, place int")
    added = spark.createDataFrame([("i", "a"), ("i", "d"), ("i", "h"), ("j", "b")], "item_id string, ref_item_id string")
    got = bodies.with_references(blocks, added, places).orderBy("item_id", "ord").collect()
    assert [(r.item_id, r.ref_item_id) for r in got] == [("i", None), ("i", "a"), ("i", "c"), ("i", "d"), ("i", "g"), ("i", "h"), ("j", "b")]


def test_markup_of_nulls(spark):
    none = spark.range(1).select(F.lit(None).cast("string").alias("h"))
    r = none.select(html.trimmed(F.col("h")).alias("a"), html.leading_number(F.col("h")).alias("b"), html.blocks_and_gaps(F.col("h")).alias("c"), html.fragments_by_number(F.col("h"), F.array(F.lit("1"))).alias("d"), html.answer(F.col("h")).alias("e")).first()
    assert (r.a, r.b, r.c, r.d, r.e.html) == ("", None, [], [], "")


def test_reports_as_text(spark, tmp_path):
    steps = spark.createDataFrame([("applied",), ("applied",), ("failed",)], "status string")
    records.write_text(records.chain_report(steps).orderBy("status").select("line"), f"file://{tmp_path}/report")
    assert "".join(p.read_text() for p in (tmp_path / "report").glob("part-*")).splitlines() == ["| applied | 2 |", "| failed | 1 |"]
