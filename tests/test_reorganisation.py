"""Articles cut into parts: what counts as the sign, which children move, which changes are taken."""

import datetime as dt

from lexstrata.operators import reorganisation

ITEMS = "npa_id int, item_id string, parent_item_id string, item_type string, item_number string, item_level int, place int"
BLOCKS = "item_id string, ord int, type string, html_text string, ref_item_id string"
CHANGES = "change_id int, npa_id int, seq int, type string, structural string, description string, item_id string, new string, html string, valid_from date, modified_by_id string"
SIGN = "в абзаце первом слова «Орган» заменить словами «1. Орган власти»"
TREE = [(1, "a", None, "article", "1", 1, 1), (1, "a1", "a", "point", "1)", 2, 1), (1, "a2", "a", "subpoint", "б)", 2, 2), (1, "a3", "a", "point", "3)", 2, 3), (1, "b", None, "article", "2", 1, 2), (2, "c", None, "article", "1", 1, 1), (2, "c1", "c", "point", "1)", 2, 1)]
BODIES = [("a", 1, "paragraph", "<p>Орган и Орган:</p>", None), ("a", 2, "child_ref", None, "a1"), ("a", 3, "child_ref", None, "a3"), ("a1", 1, "paragraph", "<p>раз</p>", None), ("a1", 2, "child_ref", None, "deep"), ("c", 1, "child_ref", None, "c1")]


def run(spark, *changes):
    rows = [(k, *c, dt.date(2024, 3, 1), f"m{k}") for k, c in enumerate(changes)]
    out = reorganisation.reorganised(spark.createDataFrame(TREE, ITEMS), spark.createDataFrame(BODIES, BLOCKS), spark.createDataFrame(rows, CHANGES))
    bodies = {}
    for r in out.blocks.orderBy("item_id", "ord").collect():
        bodies.setdefault(r.item_id, []).append(r.ref_item_id or r.html_text)
    return {r.item_id: r for r in out.items.collect()}, bodies, {r.item_id: str(r.valid_to) for r in out.closed.collect()}, sorted(r.change_id for r in out.taken.collect())


def change(npa_id, seq, said, item, path="статья 1"):
    return (npa_id, seq, "change", path, said, item, None, None)


def add(seq, what, html, path="статья 1", npa_id=1):
    return (npa_id, seq, "add", path, None, None, what, html)


def test_article_into_parts(spark):
    items, bodies, closed, taken = run(
        spark, change(1, 1, SIGN, "a"), add(2, "часть 2", "<p>2. Вторая</p>"), add(3, "пункт 5", "<p>5) пять</p><table><tr><td>x</td></tr></table>"), add(4, "пункт 3", "<p>3) есть</p>"),
        add(5, "пункт 5", "<p>снова</p>"), add(6, "часть 3", None), add(7, "слово", "<p>x</p>"), add(8, "часть 4", "<p>x</p>", "статья 2"), add(9, "часть 4", "<p>x</p>", npa_id=2),
    )
    assert set(items) == {"a_part_1", "a_part_2", "a_part_3", "a_part_1_point_1", "a_part_1_point_3", "a_part_1_point_5"}
    assert bodies == {
        "a": ["a_part_1", "a_part_2", "a_part_3"], "a_part_1": ["<p>1. Орган власти и Орган:</p>", "a_part_1_point_1", "a_part_1_point_3", "a_part_1_point_5"], "a_part_1_point_1": ["<p>раз</p>", "deep"],
        "a_part_2": ["<p>2. Вторая</p>"], "a_part_1_point_5": ["<p>пять</p>", "<table><tr><td>x</td></tr></table>"],
    }
    assert closed == {"a": "2024-02-29", "a1": "2024-02-29", "a3": "2024-02-29"} and taken == [0, 1, 2, 5]
    five, one = items["a_part_1_point_5"], items["a_part_1_point_1"]
    assert (five.item_level, five.mod_type, five.modified_by_id, one.item_level, one.old_id, one.mod_type, one.modified_by_id) == (3, "add", "m2", 3, "a1", "change", "m0")


def test_what_is_no_sign(spark):
    none = ({}, {}, {}, [])
    assert run(spark, change(1, 1, "слова «а» заменить словами «10. б»", "a"), change(2, 1, "дополнить словами «2. б»", "c"), add(2, "часть 2", "<p>x</p>")) == none
    assert run(spark, change(1, 1, SIGN, "b"), change(1, 2, SIGN, "a"), change(2, 1, SIGN, None)) == none  # the first sign leads to no article with children
    assert run(spark, change(1, 1, SIGN, "a", "пункт 1"), change(2, 1, None, "c")) == none and run(spark) == none


def test_words_that_are_not_there(spark):
    items, bodies, closed, taken = run(spark, change(2, 2, "дополнить словами «1. Всё»", "c"), change(2, 3, SIGN, "c"))
    assert bodies["c_part_1"] == ["", "c_part_1_point_1"] and taken == [0] and "c_part_1_point_1" not in bodies
