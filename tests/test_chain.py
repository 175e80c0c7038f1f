"""The restartable chain and nested documents."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from lexstrata.operators import amend
from lexstrata.operators.chain import Chain, Step, ordered_steps, run_documents
from lexstrata.sources import documents, egest

REV = "item_id string, rev_idx int, valid_from date, valid_to date, value string, mod_type string, modified_by_id string, not_valid string"
CHANGE = "item_id string, seq int, type string, new_value string, valid_from date, modified_by_id string"
day = datetime.date


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("a", 1, day(2000, 1, 1), None, "v0", "add", None, None)], REV)


def step(spark, k, seen):
    def changes():
        seen.append(k)
        return spark.createDataFrame([("a", 1, "change", f"v{k}", day(2000 + k, 1, 1), f"by{k}")], CHANGE)

    return Step(f"am{k}", changes)


def values(table):
    return [(r.value, r.valid_to) for r in table.orderBy("rev_idx").collect()]


def test_goes_on_where_it_stopped(spark, target, tmp_path):
    seen = []

    def broken():
        raise KeyboardInterrupt  # as if the driver were killed amid the step

    chain = Chain(spark, f"file://{tmp_path}/c")
    with pytest.raises(KeyboardInterrupt):
        chain.run(target, [step(spark, 1, seen), Step("am2", broken)], amend.applied)
    table, report = Chain(spark, f"file://{tmp_path}/c").run(target, [step(spark, k, seen) for k in (1, 2, 3)], amend.applied)
    assert seen == [1, 2, 3]
    assert values(table) == [("v0", day(2000, 12, 31)), ("v1", day(2001, 12, 31)), ("v2", day(2002, 12, 31)), ("v3", None)]
    assert [(r.step, r.amendment, r.status) for r in report.orderBy("step").collect()] == [(1, "am1", "earlier"), (2, "am2", "success"), (3, "am3", "success")]
    again, report = chain.run(target, [step(spark, k, seen) for k in (3, 1, 2)], amend.applied)
    assert values(again) == values(table) and {r.status for r in report.collect()} == {"earlier"} and seen == [1, 2, 3]


def test_failed_steps(spark, target, tmp_path):
    def bad():
        raise ValueError("no list")

    steps = lambda seen: [step(spark, 1, seen), Step("bad", bad), step(spark, 2, seen)]
    stopped, report = Chain(spark, f"file://{tmp_path}/s").run(target, steps([]), amend.applied)
    assert [r.status for r in report.orderBy("step").collect()] == ["success", "failed"] and values(stopped)[-1][0] == "v1"
    went_on, report = Chain(spark, f"file://{tmp_path}/g").run(target, steps([]), amend.applied, continue_on_error=True)
    assert sorted((r.amendment, r.status) for r in report.collect()) == [("am1", "success"), ("am2", "success"), ("bad", "failed")] and values(went_on)[-1][0] == "v2"
    assert "no list" in report.where("status = 'failed'").first().error


def test_two_drivers_commit_once(spark, tmp_path):
    one, two = Chain(spark, f"file://{tmp_path}/r"), Chain(spark, f"file://{tmp_path}/r")
    entry = {"step": 1, "amendment": "am/1", "result": "x"}
    assert one.publish(entry) and not two.publish(entry) and two.commits() == [entry]


def test_steps_of_a_folder(spark):
    scanned = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "step int, name string")
    assert [ordered_steps(scanned, None)[0], [s.name for s in ordered_steps(scanned, None)[1]]] == ["a", ["b", "c"]]
    assert [s.name for s in ordered_steps(scanned, None, explicit_target="c")[1]] == ["a", "b"]
    assert ordered_steps(scanned.where("false"), None) == (None, [])


def test_additions_before_a_change_close_too(spark, target):
    rows = [("a", 1, "add", "x", day(2001, 1, 1), None), ("a", 2, "add", "y", day(2002, 1, 1), None), ("a", 3, "change", "z", day(2003, 1, 1), None), ("a", 4, "add", "w", day(2004, 1, 1), None)]
    end = day(2002, 12, 31)
    assert values(amend.applied(target, spark.createDataFrame(rows, CHANGE))) == [("v0", end), ("x", end), ("y", end), ("z", None), ("w", None)]


DOC = {"npa_items_revision": [
    {"item_id": "a", "item_type": "article", "item_number": "1", "item_level": 1, "revisions": [{"valid_from": "2000-01-01", "mod_type": "add", "body": [{"type": "paragraph", "html_text": "<p>\"x\" \\ é</p>", "order": 1}, {"type": "child_ref", "item_id": "b", "order": 2}]}],
     "item_children": [{"item_id": "b", "item_type": "part", "item_number": "1", "item_level": 2, "item_children": [{"item_id": "c", "item_type": "point", "item_number": "1)", "item_level": 3}]}, {"item_id": "d", "item_type": "part", "item_level": 2}]},
    {"item_id": "e", "item_type": "article"},
]}


def test_written_and_read_again(spark):
    docs = documents.parsed(spark.createDataFrame([("p", json.dumps(DOC, ensure_ascii=False))], "path string, raw string"))
    items = documents.flatten_items(docs)
    revisions = documents.revisions_of(items)
    written = egest.nested_documents(items, revisions, documents.blocks_of(revisions)).first()
    got = json.loads(written.raw)
    assert got == DOC
    assert egest.nested_documents(items.where("false")).count() == 0


def test_from_files_to_files(spark, tmp_path):
    for name, rows in (("in/doc.json", DOC), ("answers/1.json", [{"item_id": "a", "seq": 1, "type": "change", "new_value": "n", "valid_from": "2003-03-03", "modified_by_id": "m"}]), ("answers/2.json", [])):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(json.dumps(rows, ensure_ascii=False))

    def apply(table, changes):
        told = table.withColumn("value", F.lit(None).cast("string"))
        return amend.applied(told, changes).withColumn("path", F.lit(f"file://{tmp_path}/in/doc.json"))

    report = run_documents(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/answers", f"file://{tmp_path}/out", apply, CHANGE, f"file://{tmp_path}/chain")
    assert [r.status for r in report.orderBy("step").collect()] == ["success"]
    got = json.loads(spark.read.text(f"file://{tmp_path}/out").first().value)
    first, second = got["npa_items_revision"][0]["revisions"]
    assert (first["valid_to"], second["mod_type"], second["modified_by_id"]) == ("2003-03-02", "change", "m")
    assert got["npa_items_revision"][0]["item_children"] == DOC["npa_items_revision"][0]["item_children"]
