"""Timelines beside the text, transfer of state, placeholders and trees with cycles."""

import datetime

from pyspark.sql import functions as F

from lexstrata.operators import merge, timelines

day = datetime.date
T = "item_id string, rev_idx int, value string, valid_from date, valid_to date, mod_type string, modified_by_id string"
ITEM = "item_id string, parent_item_id string, item_type string, item_number string, place int, text string, head string"

def at_by():
    return F.lit(day(2010, 5, 5)), F.lit("by")


END = day(2010, 5, 4)


def line(spark, *rows):
    return spark.createDataFrame([(i, k, v, a, b, None, None) for i, k, v, a, b in rows], T)


def shown(df):
    return sorted((r.item_id, r.rev_idx, r.value, r.valid_from, r.valid_to, r.mod_type) for r in df.collect())


def test_titles(spark):
    t = line(spark, ("a", 1, "x", day(2000, 1, 1), None), ("a", 2, "y", day(2001, 1, 1), None), ("b", 1, "z", None, day(2002, 1, 1)), ("c", 1, "same", None, None))
    wanted = spark.createDataFrame([("a", "n"), ("b", "n"), ("c", "same"), ("d", "n"), ("e", ""), ("f", None)], "item_id string, value string")
    got = shown(timelines.titles_after(t, wanted, *at_by()))
    assert got == [
        ("a", 1, "x", day(2000, 1, 1), END, None), ("a", 2, "y", day(2001, 1, 1), None, None), ("a", 3, "n", None, None, "change"),  # the first open one closes
        ("b", 1, "z", None, day(2002, 1, 1), None), ("b", 2, "n", None, None, "change"), ("c", 1, "same", None, None, None), ("d", 1, "n", day(2010, 5, 5), None, "add"),
    ]
    quiet = timelines.titles_after(t, wanted.where("item_id = 'd'"), *at_by(), override="new_redaction").where("item_id = 'd'").first()
    assert (quiet.mod_type, quiet.valid_from, quiet.modified_by_id) == (None, None, None)


def test_prefixes(spark):
    t = line(spark, ("a", 1, "x", None, None), ("b", 1, "y", None, None))
    wanted = spark.createDataFrame([("a", None), ("b", "y"), ("c", "n"), ("d", None)], "item_id string, value string")
    got = shown(timelines.prefixes_after(t, wanted, *at_by()))
    assert got == [("a", 1, "x", None, END, None), ("a", 2, "", None, None, "delete"), ("b", 1, "y", None, None, None), ("c", 1, "n", day(2010, 5, 5), None, "add")]


def test_numbers(spark):
    items = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "item_id string, item_number string")
    wanted = spark.createDataFrame([("a", "1.1"), ("b", "2"), ("c", "3.1")], "item_id string, value string")
    begun = spark.createDataFrame([("a", day(1999, 1, 1))], "item_id string, valid_from date")
    t = line(spark, ("c", 1, "2", day(1999, 1, 1), day(1999, 2, 2)), ("c", 2, "3", day(1999, 2, 3), None))
    got = shown(timelines.numbers_after(t, items, wanted, begun, *at_by()))
    assert got == [
        ("a", 1, "1", day(1999, 1, 1), END, None), ("a", 2, "1.1", day(2010, 5, 5), None, "change"),
        ("c", 1, "2", day(1999, 1, 1), day(1999, 2, 2), None), ("c", 2, "3", day(1999, 2, 3), END, None), ("c", 3, "3.1", day(2010, 5, 5), None, "change"),
    ]


def test_alignment(spark):
    a = line(spark, ("i", 1, "a1", day(2000, 1, 1), day(2000, 1, 31)), ("i", 2, "a2", day(2000, 3, 1), None), ("u", 1, "undated", None, None))
    b = line(spark, ("i", 1, "b1", day(2000, 1, 15), None), ("i", 2, "late", day(2000, 1, 15), None))
    got = [tuple(r)[1:] for r in timelines.aligned({"a": a, "b": b}).orderBy("valid_from").collect()]
    assert got == [
        (day(2000, 1, 1), day(2000, 1, 14), "a1", None), (day(2000, 1, 15), day(2000, 1, 31), "a1", "late"),
        (day(2000, 2, 1), day(2000, 2, 29), None, "late"), (day(2000, 3, 1), None, "a2", "late"),
    ]


def test_state_moves_with_a_subtree(spark):
    item = lambda *rows: spark.createDataFrame([(i, up, t, n, k, x, None) for k, (i, up, t, n, x) in enumerate(rows)], ITEM)
    old = item(("o", None, "article", "1", ""), ("op", "o", "point", "1)", "same"), ("os", "op", "subpoint", "a", "s"), ("oq", "o", "point", "2)", "other"))
    new = item(("n", None, "article", "1", ""), ("np", "n", "part", "1", ""), ("nq", "np", "point", "1)", "same"), ("ns", "nq", "subpoint", "a", "s"), ("nr", "np", "point", "2)", "changed"))
    gone = spark.createDataFrame([("op", "n"), ("oq", "n")], "item_id string, new_root string")
    pairs = timelines.moved_pairs(old, new, gone, (merge.fingerprints(old), merge.fingerprints(new)))
    assert [tuple(r) for r in pairs.collect()] == [("op", "nq")]
    all_pairs = timelines.paired_below(old, new, pairs)
    assert sorted(tuple(r) for r in all_pairs.collect()) == [("op", "nq"), ("os", "ns")]
    notes = spark.createDataFrame([("op", "note"), ("os", "deep"), ("nq", "fresh"), ("nr", "stays")], "item_id string, note string")
    assert sorted(tuple(r) for r in timelines.transferred(notes, all_pairs).collect()) == [("nq", "note"), ("nr", "stays"), ("ns", "deep"), ("op", "note"), ("os", "deep")]


def test_placeholders_were_never_in_force(spark):
    rev = "item_id string, rev_idx int, valid_from date, valid_to date, mod_type string, modified_by_id string, not_valid string"
    t = spark.createDataFrame([("a", 1, day(2000, 1, 1), None, "add", None, None), ("b", 1, day(2000, 1, 1), None, "add", None, None)], rev)
    acts = spark.createDataFrame([("a", "x", "change", True), ("b", "y", "change", False)], "old_id string, new_id string, action string, top boolean")
    out = merge.history_rows(acts, t, *at_by(), placeholders=spark.createDataFrame([("a",)], "item_id string"))
    got = sorted((r.item_id, r.rev_idx, r.valid_to, r.not_valid, r.mod_type) for r in out.collect())
    assert got == [("a", 1, END, "2010-05-05", "add"), ("a", 2, None, None, "new_redaction"), ("b", 1, END, None, "add"), ("b", 2, None, None, "change")]


def test_walks_end_on_cycles(spark):
    loop = spark.createDataFrame([("r", None, "article", "1", 0, "", None), ("a", "r", "part", "1", 0, "", None), ("a", "a", "part", "1", 0, "", None)], ITEM)
    pairs = spark.createDataFrame([("r", "r")], "old_id string, new_id string")
    assert merge.merged(loop, loop, pairs).count() >= 2
    assert timelines.paired_below(loop, loop, pairs).count() == 2
