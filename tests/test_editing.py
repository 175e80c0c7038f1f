"""Quotations, edits, marks and rendering on small cases of their own."""

import pytest
from pyspark.sql import functions as F

from lexstrata.operators import edits, quotations, rendering


def markup(spark, html, spec):
    rows = spark.createDataFrame([(1, html, spec)], "key int, html string, spec string")
    return quotations.selected_markup(rows).first().html


QUOTED = "<p>Изложить закон «О чём-то» так:</p><p>«1. Раз.</p><p>2. Два.»;</p><p>Конец</p>"


@pytest.mark.parametrize("html, spec, want", [
    (QUOTED, "all", "<p>1. Раз.</p>\n<p>2. Два.</p>"),
    (QUOTED, None, "<p>1. Раз.</p>\n<p>2. Два.</p>"),
    (QUOTED, "<p>x</p>", "<p>1. Раз.</p>\n<p>2. Два.</p>"),
    (QUOTED, "4,1", "<p>Изложить закон «О чём-то» так:</p>\n<p>Конец</p>"),
    (QUOTED, "3-9", "<p>2. Два.</p>\n<p>Конец</p>"),
    (QUOTED, "9", "<p>1. Раз.</p>\n<p>2. Два.</p>"),
    ("<p>x</p><p>«5) пять</p><p>6) шесть»</p>", "6)", "<p>6) шесть</p>"),
    ("<p>«а»</p><p>между</p><p>«б</p><p>в».</p>", "77", "<p>а»</p>\n<p>«б</p>\n<p>в</p>"),
    ("<p>внутри «слова» тут</p><p>дальше</p>", "all", "<p>внутри «слова» тут</p>"),
    ("<p>нет</p><p>ничего;;</p>", "all", "<p>нет</p>\n<p>ничего;</p>"),
    ("<p>«раз</p><p>»;</p>", "all", "<p>раз</p>"),
    ("", "all", ""), (None, "1", ""),
])
def test_chosen_blocks(spark, html, spec, want):
    assert markup(spark, html, spec) == want


def test_places_over_borders(spark):
    blocks = spark.createDataFrame([(1, 1, "<p>один  два</p>"), (1, 2, "<p>три <b>два</b></p>"), (1, 3, "<p>три a.b(c</p>")], "key int, pos int, html string")
    wanted = [(1, 1, "два три"), (1, 2, "a.b("), (1, 3, "нет"), (1, 4, ""), (1, 5, "\\E два"), (2, 6, "два")]
    got = quotations.quoted_places(blocks, spark.createDataFrame(wanted, "key int, quote_id int, quoted string")).collect()
    assert sorted(tuple(r)[1:] for r in got) == [(1, 1, 1, 5, 2, 3), (1, 2, 2, 4, 3, 3), (2, 1, 3, 4, 3, 8)]


def test_paragraph_with(spark):
    blocks = spark.createDataFrame([(1, 1, "<p>Первый</p>"), (1, 2, "<p>ВТОРОЙ абзац</p>")], "key int, pos int, html string")
    wanted = spark.createDataFrame([(1, "второй  Абзац"), (2, "x")], "key int, wanted string")
    assert {tuple(r) for r in quotations.paragraph_with(blocks, wanted).collect()} == {(1, 2), (2, None)}
    longer = spark.createDataFrame([(1, "и Первый, и ещё")], "key int, wanted string")
    assert quotations.paragraph_with(blocks, longer).first().pos == 1


def test_sources_of_changes(spark):
    changes = spark.createDataFrame([("a", "t", True), ("b", "t", False), ("c", "t", True)], "change_id string, target_id string, numbered boolean")
    resolved = spark.createDataFrame([("a", 1, None), ("a", 2, "s")], "change_id string, seq int, source_id string")
    shown = spark.createDataFrame([("s", "<p>s</p>"), ("t", "<p>t</p>")], "root_id string, html string")
    assert {tuple(r) for r in quotations.source_markup(changes, resolved, shown).collect()} == {("a", "<p>s</p>"), ("b", "<p>t</p>"), ("c", None)}


def edit(seq, kind, old=None, new=None, nth=None, sentence=None):
    return {"seq": seq, "kind": kind, "old": old, "new": new, "nth": nth, "sentence": sentence}


@pytest.mark.parametrize("said, listed, want", [
    ("a b a b", [edit(1, "replace", "a", "b"), edit(2, "replace", "b", "a")], "b a b a"),  # neither sees the other's output
    ("aa aa", [edit(1, "replace", "a", "x", nth=3)], "aa xa"),
    ("abc", [edit(1, "delete", "bc"), edit(2, "replace", "b", "x")], "a"),  # the first keeps its place
    ("One. Two! Three", [edit(1, "insert", new=" more", sentence=2), edit(2, "insert", new=".")], "One. Two more! Three."),
    ("x y", [edit(2, "insert", "x", "2"), edit(1, "insert", "x", "1")], "x12 y"),
    ("x", [edit(1, "replace", "z", "w"), edit(2, "insert", new="e", sentence=9)], "xe"),
    ("", [edit(1, "insert", new="e")], "e"),
    ("abab", [], "abab"),
])
def test_edits(said, listed, want):
    got, done = edits.edit_text(said, listed)
    assert got == want and [d["start"] for d in done] == sorted(d["start"] for d in done)


def test_edits_of_rows(spark):
    texts = spark.createDataFrame([(1, "aba"), (2, None), (3, "zz")], "key int, said string")
    listed = spark.createDataFrame([(1, 1, "replace", "a", "x", 2, None), (2, 1, "insert", None, "n", None, None)], "key int, seq int, kind string, old string, new string, nth int, sentence int")
    assert {(r.key, r.said, len(r.done)) for r in edits.edited(texts, listed).collect()} == {(1, "abx", 1), (2, "n", 1), (3, "zz", 0)}


def test_marks(spark):
    marks = spark.createDataFrame([(1, "2-1"), (1, "3-all"), (1, "table"), (2, "1-1")], "key int, position string")
    steps = spark.createDataFrame([(1, 1, 2, 1), (1, 2, 4, -1)], "key int, seq int, at int, delta int")
    assert sorted(tuple(r) for r in edits.shifted_in_turn(marks, steps).collect()) == [(1, "3-1"), (1, "3-all"), (1, "table"), (2, "1-1")]
    assert sorted(tuple(r) for r in edits.shifted_at_once(marks, steps).collect()) == [(1, "3-1"), (1, "4-all"), (1, "table"), (2, "1-1")]
    merged = edits.merged_positions(spark.createDataFrame([("a", "10-1"), ("a", "2-1"), ("a", "2-1"), ("a", "all")], "k string, position string"), ["k"]).first()
    assert merged.position == "all,2-1,10-1"


def test_marks_of_paragraphs(spark):
    schema = "key int, kind string, at int, before string, after string, item_type string, item_number string"
    rows = [(1, "add", 1, None, "<p>нов</p>", "part", "3"), (2, "delete", 2, "<p>стар</p>", None, "part", "3"), (3, "change", 1, "a", "b", "article", "1")]
    got = {tuple(r) for r in edits.paragraph_marks(spark.createDataFrame(rows, schema)).collect()}
    assert got == {(1, "current", "addition", "3. нов", "1-all"), (2, "previous", "deletion", "стар", "2-all"), (3, "previous", "deletion", "a", "1-all"), (3, "current", "addition", "b", "1-all")}


def test_rows_of_tables():
    got = [tuple(m.values()) for m in edits.row_differences(["a", "b", "c", "d"], ["a", "x", "y", "z", "d", "e"])]
    assert got == [("previous", "difference", "table", "2"), ("previous", "difference", "table", "3"), ("current", "difference", "table", "2"), ("current", "difference", "table", "3"), ("current", "addition", "table", "4"), ("current", "addition", "table", "6")]
    assert not list(edits.row_differences([], ["a"])) and not list(edits.row_differences(["a"], ["a"]))


ITEM = "item_id string, parent_item_id string, item_type string, item_number string, place int"
BLOCK = "item_id string, rev_idx int, ord int, type string, html_text string, ref_item_id string"


@pytest.fixture(scope="module")
def law(spark):
    items = spark.createDataFrame([("a", None, "article", "5", 1), ("p", "a", "part", "1", 1), ("q", "p", "point", "2)", 1), ("x", None, "appendix", "1", 2), ("e", "a", "part", "2", 2)], ITEM)
    revisions = spark.createDataFrame([("a", 1, None, None), ("p", 1, "2001-01-01", None), ("p", 2, None, None), ("q", 1, None, None), ("x", 1, None, "in"), ("e", 1, "2001-01-01", None)], "item_id string, rev_idx int, valid_to string, item_head string")
    blocks = spark.createDataFrame([
        ("a", 1, 1, "child_ref", None, "p"), ("a", 1, 2, "child_ref", None, "q"), ("a", 1, 3, "child_ref", None, "e"), ("p", 1, 1, "paragraph", "<p>old</p>", None), ("p", 2, 1, "paragraph", "<P class='c'>new</P>", None), ("p", 2, 2, "child_ref", None, "q"),
        ("q", 1, 1, "table_fragment", "<tr/>", None), ("x", 1, 1, "paragraph", "<p>in x</p>", None), ("e", 1, 1, "paragraph", "<p>closed</p>", None),
    ], BLOCK)
    heads = spark.createDataFrame([("a", 1, "2001-01-01", "Old"), ("a", 2, None, "Name"), ("x", 1, "2001-01-01", "Gone")], "item_id string, rev_idx int, valid_to string, head_text string")
    prefixes = spark.createDataFrame([("x", 1, "2001-01-01", "<p>P1</p>"), ("x", 2, "2001-01-01", "<p>P2</p>")], "item_id string, rev_idx int, valid_to string, prefix_text string")
    return items, revisions, blocks, heads, prefixes


def test_whole_rendering(spark, law):
    items, revisions, blocks, heads, prefixes = law
    now = rendering.open_blocks(revisions, blocks)
    names = rendering.newest_open(heads, "head_text").withColumnRenamed("head_text", "head")
    roots = items.where("parent_item_id IS NULL").select(F.col("item_id").alias("root_id"))
    got = {r.root_id: r.html for r in rendering.rendered_items(roots, items, now, names, rendering.active_prefixes(items, prefixes)).collect()}
    assert got["a"].split("\n") == ["<p><b>Статья 5. Name</b></p>", "<P class='c'>1. new</P>", "2) ", "<tr/>", "2. "]  # q only below its own parent
    assert got["x"].split("\n") == ["<p>P2</p>", "<p>in x</p>"]
    bare = rendering.rendered_items(roots, items, now, names, rendering.active_prefixes(items, prefixes), bare=items.where("item_id = 'a'"))
    assert {r.root_id: r.html for r in bare.collect()}["a"].startswith("<P class='c'>1. new")
    assert {tuple(r) for r in rendering.current_heads(items, heads, revisions).collect()} == {("a", "Name"), ("p", ""), ("q", ""), ("x", "Gone"), ("e", "")}
    assert {r.root_id: r.text for r in rendering.texts_below(roots, items, now).collect()}["a"] == "new"


def test_pending_markup(spark, law):
    items, revisions, blocks, _, _ = law
    none = spark.createDataFrame([], "item_id string, head string"), spark.createDataFrame([], "item_id string, prefix string")
    now = rendering.open_blocks(revisions, blocks).drop("rev_idx")
    pending = spark.createDataFrame([("a", "change", None), ("p", "change", "<p>P</p>"), ("q", "new_redaction", "<p>Q</p>"), ("x", "change", "<p>X</p>")], "item_id string, mod_type string, html string")
    got = {r.item_id: r.html for r in rendering.pending_markup(items, now, *none, pending, pending.where("item_id IN ('p', 'q')")).collect()}
    assert got == {"a": "<p><b>Статья 5</b></p>\n<p>1. P</p>\n<p>2) Q</p>\n2. ", "p": "<p>P</p>\n<p>Q</p>", "q": "<p>Q</p>", "x": "<p>X</p>"}
    steps = rendering.rebuild_steps(items, items.where("item_id <> 'x'").select("item_id"), pending)
    assert [r.item_id for r in steps.orderBy("step").collect()] == ["q", "p", "a"]
