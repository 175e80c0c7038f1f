"""Edits of texts by places in the text as it was, and marks that move with the paragraphs around them.

An edit never sees what another put in: all places are found first, those that overlap an earlier edit's are
left out, and the text is put together once.
"""

from __future__ import annotations

import difflib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexstrata.functions import numbers, text
from lexstrata.session import arrow_shape

SENTENCE_END = re.compile(r"[.!?…]+(?=\s|$)")
DONE = "array<struct<start: int, stop: int, seq: int, put: string, nth: int>>"


def places(said: str, edit: dict) -> Iterator[tuple[int, int, str, int]]:
    """start, stop, what is put there and the number of each place of an edit."""
    kind, old, put = edit["kind"], edit["old"] or "", "" if edit["kind"] == "delete" else edit["new"] or ""
    if not old:
        if kind == "insert":
            ends = [m.start() for m in SENTENCE_END.finditer(said)]
            n = edit["sentence"]
            at = ends[n - 1] if n and 1 <= n <= len(ends) else len(said)
            yield at, at, put, 1
        return
    nth, at = 1, said.find(old)
    while at >= 0:
        if edit["nth"] in (None, nth):
            yield at + len(old) * (kind == "insert"), at + len(old), put, nth
        nth, at = nth + 1, said.find(old, at + len(old))


def edit_text(said: str, listed: list[dict]) -> tuple[str, list[dict]]:
    """The text after all edits, by seq, and the places edited. What overlaps an earlier edit's place is left out; insertions at one place stand by seq."""
    taken: list[tuple[int, int, int, str, int]] = []  # in order of place, none overlapping
    for e in sorted(listed, key=lambda e: e["seq"]):
        new = []
        for start, stop, put, nth in places(said, e):
            k = bisect_left(taken, (start, stop, e["seq"]))
            before, behind = taken[k - 1] if k else None, taken[k] if k < len(taken) else None
            if not (before and before[1] > start or behind and behind[0] < stop):
                new.append((start, stop, e["seq"], put, nth))
        taken = sorted([*taken, *new])
    parts, at = [], 0
    for start, stop, _, put, _ in taken:
        parts += [said[at:start], put]
        at = stop
    names = ("start", "stop", "seq", "put", "nth")
    return "".join(parts) + said[at:], [dict(zip(names, t, strict=True)) for t in taken]


def edited(texts: DataFrame, edits: DataFrame) -> DataFrame:
    """key, said (edited), done (start, stop, seq, put, nth of the places edited, in order of place). texts: key, said.

    edits: key, seq, kind (replace, delete, insert), old, new, nth (which place; null: all), sentence. An insertion goes behind its anchor
    `old`; without one, before the end mark of the sentence of that number; else to the end of the text. A null text counts as empty.
    """
    one = F.struct(F.col("seq").cast("int").alias("seq"), "kind", "old", "new", F.col("nth").cast("int").alias("nth"), F.col("sentence").cast("int").alias("sentence"))
    told = texts.select("key", "said").join(edits.groupBy("key").agg(F.collect_list(one).alias("edits")), "key", "left")
    shape, arrow = arrow_shape(told, f"said string, done {DONE}", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = ((r["key"], *edit_text(r["said"] or "", r["edits"] or [])) for r in b.to_pylist())
            yield pa.RecordBatch.from_pylist([{"key": k, "said": said, "done": done} for k, said, done in rows], schema=arrow)

    return told.mapInArrow(run, shape)


def merged_positions(marks: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each of keys with its positions in order, by commas."""
    number = lambda c, k: F.regexp_extract(c, "^(\\d{1,9})(?:-(\\d{1,9}))?", k)
    order = F.struct(number("position", 1).try_cast("int").alias("p"), number("position", 2).try_cast("int").alias("k"), F.col("position").alias("position"))
    return marks.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_set(order)), lambda x: x["position"]), ",").alias("position"))


# --- marks


def shifted_in_turn(marks: DataFrame, steps: DataFrame) -> DataFrame:
    """marks (key, position 'M-N', ...) after steps (key, seq, at, delta), one after another: each moves the marks from paragraph `at` on, as
    counted when it is taken. Positions of another form stay."""
    listed = steps.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("seq", "at", "delta"))).alias("steps"))
    moved = F.aggregate("steps", F.col("position"), lambda p, s: numbers.shift_position(p, s["at"], s["delta"]))
    return marks.join(listed, "key", "left").withColumn("position", F.when(F.col("steps").isNull(), F.col("position")).otherwise(moved)).drop("steps")


def shifted_at_once(marks: DataFrame, steps: DataFrame) -> DataFrame:
    """marks after steps (key, at, delta) whose paragraphs are all counted in the old text: the deltas up to a mark sum to its shift.
    Marks and steps are put in one order, so a key may have many of both; positions of another form stay."""
    at = F.regexp_extract("position", "^(\\d{1,9})-", 1).try_cast("int")
    both = marks.withColumn("_at", at).withColumn("_delta", F.lit(0)).unionByName(steps.select("key", F.col("at").cast("int").alias("_at"), F.col("delta").cast("int").alias("_delta"), F.lit(True).alias("_step")), allowMissingColumns=True)
    w = Window.partitionBy("key").orderBy(F.col("_at").asc_nulls_first(), F.coalesce("_step", F.lit(False)).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = both.withColumn("_sum", F.sum("_delta").over(w)).where("_step IS NULL")
    moved = F.concat((F.col("_at") + F.col("_sum")).cast("string"), F.regexp_extract("position", "^\\d+(-.*)$", 1))
    return told.withColumn("position", F.when(F.col("_at").isNull(), F.col("position")).otherwise(moved)).select(marks.columns)


def paragraph_marks(steps: DataFrame) -> DataFrame:
    """key, edition, category, said, position of changed paragraphs (key, kind, at, before, after, item_type, item_number): what goes is marked in the
    previous edition, what comes in the current one. The first paragraph of a part, point or subpoint is told with its number."""
    first = (F.col("at") == 1) & F.col("item_type").isin("part", "point", "subpoint") & (F.coalesce("item_number", F.lit("")) != "")
    said = lambda c: text.without_tags(F.when(first & (F.coalesce(c, F.lit("")) != ""), text.with_number(F.col(c), F.col("item_number"), F.col("item_type"))).otherwise(F.col(c)))
    position = F.concat(F.col("at").cast("string"), F.lit("-all"))
    row = lambda edition, category, c: F.struct(F.lit(edition).alias("edition"), F.lit(category).alias("category"), said(c).alias("said"))
    gone, came = row("previous", "deletion", "before"), row("current", "addition", "after")
    rows = F.when(F.col("kind") == "add", F.array(came)).when(F.col("kind") == "delete", F.array(gone)).otherwise(F.array(gone, came))
    return steps.select("key", F.explode(rows).alias("m"), position.alias("position")).select("key", "m.*", "position")


def table_row_marks(pairs: DataFrame) -> DataFrame:
    """key, edition, category, said 'table', position (number of the row) of rows that differ between two wordings (key, old, new) of tables.

    Rows put in the place of others are differences, pair by pair; further ones are deletions or additions. Rows are aligned
    by their longest common stretches. A wording without rows gives no marks.
    """
    rows = lambda c: F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("(?is)<tr\\b.*?</tr>"), F.lit(0)), lambda r: F.trim(r))
    told = pairs.select("key", rows("old").alias("old"), rows("new").alias("new"))
    shape, arrow = arrow_shape(told, "edition string, category string, said string, position string", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [{"key": r["key"], **m} for r in b.to_pylist() for m in row_differences(r["old"], r["new"])]
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return told.mapInArrow(run, shape)


def row_differences(old: list[str], new: list[str]) -> Iterator[dict]:
    if not old or not new:
        return
    for tag, a, b, c, d in difflib.SequenceMatcher(None, old, new).get_opcodes():
        paired = min(b - a, d - c) if tag == "replace" else 0
        sides = (("previous", "deletion", range(a, b)), ("current", "addition", range(c, d))) if tag != "equal" else ()
        for edition, other, places in sides:
            for n, k in enumerate(places):
                yield {"edition": edition, "category": "difference" if n < paired else other, "said": "table", "position": str(k + 1)}
