"""Repeated windows of texts, found by anchors that windows choose for themselves.

A window (a fixed number of words or bytes) chooses one anchor inside it by its own content
alone, so equal windows choose equal anchors at equal places. Neighbouring windows with the
same anchor form a superwindow: (name of the anchor, hash of all it spans, place, number of
windows). Equal superwindows hold equal windows, and equal windows lie in superwindows of one
name. So a window can repeat only if its superwindow's name does, and one shuffle of superwindows
tells which to look at: those that share a name and half a window of context, left or right of the
anchor, with another ("asked"): of two equal windows around one anchor one side is that long. Where
the names and contents of superwindows are sure enough (`settle`), equal ones are known as repeats at
once, and only those are asked about that share such a side with another content.

Which occurrence is the first: `by_document` compares documents only (occurrences in the first
document all stay); otherwise places count too. Before the shuffle each task keeps, of equal
superwindows, those that may be first, and passes the others on as repeats already; a passage
that a third of all documents share thus reaches its reducer once a task, not once a document.
A name that one batch has more than CROWD times with different contents is crowded: its rows are
dealt by content, and all that share it are asked about. So neither a common passage nor a common anchor
brings its rows to one task.

Documents are known by doc (doc_id; null counts as greater than all) and rid (a hash of the text,
so that rows with one doc_id but different texts stay apart; such rows count as one document).
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexstrata.llm.kernels import batches, blocks, mix, union_runs
from lexstrata.llm.shared import marked, partitions, stored

NO_ID = 2**63 - 1
PLAIN, CROWDED, MARKER, REPEAT = range(4)
SENT = pa.schema([("kind", pa.int8()), ("name", pa.int64()), ("content", pa.int64()), ("doc", pa.int64()), ("rid", pa.int32()), ("at", pa.int64()), ("sides", pa.int32())])
SENT_DDL = "kind byte, name long, content long, doc long, rid int, at long, sides int"
KNOWN, ASKED, ASKED_CROWDED = range(3)
FOUND = pa.schema([("kind", pa.int8()), ("name", pa.int64()), ("doc", pa.int64()), ("rid", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
FOUND_DDL = "kind byte, name long, doc long, rid int, start long, end long"
COUNT_BITS = 16
CROWD = 256
AT_ONCE = 1 << 19
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def keyed(docs: DataFrame) -> DataFrame:
    """doc, rid, doc_id, text of documents; null texts are empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("doc"), F.hash(text).alias("rid"), "doc_id", text.alias("text"))


def later(doc: np.ndarray, at: np.ndarray, new: np.ndarray, by_document: bool) -> np.ndarray:
    """Of rows sorted by (group, doc, at), with `new` true at each group's first: which come after the first."""
    first = firsts(new)
    after = doc > doc[first]
    return after if by_document else after | ((doc == doc[first]) & (at > at[first]))


def firsts(new: np.ndarray) -> np.ndarray:
    """The place of each one's group's first."""
    return np.flatnonzero(new)[np.cumsum(new) - 1] if len(new) else np.zeros(0, np.int64)


def changes(*columns: np.ndarray) -> np.ndarray:
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def merged(doc: np.ndarray, rid: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Intervals of each document, those that touch joined."""
    if not len(doc):
        return doc, rid, start, end
    order = np.lexsort((start, rid, doc))
    doc, rid, start, end = doc[order], rid[order], start[order], end[order]
    new = changes(doc, rid)
    shift = np.cumsum(new) * (np.int64(1) << 40)
    s, e = union_runs(start + shift, end + shift)
    at = np.searchsorted(start + shift, s)
    return doc[at], rid[at], s - shift[at], e - shift[at]


def sender(find: Callable, by_document: bool, same: Callable | None = None) -> Callable:
    """mapInArrow function over (doc, rid, text): superwindows for the shuffle.

    find(bytes, offsets) gives names, contents, row numbers, first windows, numbers of windows, sides (16 bits of a
    hash of the context left and right of the anchor, 0 where there isn't half a window of it).
    same(bytes, places of superwindows, places of others, numbers of windows), if given, says which
    are equal indeed; places count in the batch's bytes.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            docs, rids = (np.asarray(part.column(i)) for i in (0, 1))
            held, raw, base = [], [], 0
            for lo, hi, data, offs in blocks(part.column(2)):
                name, content, row, start, count, sides = find(data, offs)
                held.append((name, content, docs[lo:hi][row], rids[lo:hi][row], start, count, sides, base + offs[row] + start))
                raw.append(data)
                base += len(data)
            if held:
                name, content, doc, rid, start, count, sides, place = (np.concatenate(x) for x in zip(*held, strict=True))
                whole = np.concatenate(raw) if same else None
                check = (lambda i, j: same(whole, place[i], place[j], count[i])) if same else None  # noqa: B023
                yield from send(name, content, doc, rid, start, count, sides, by_document, check)

    return run


def send(name, content, doc, rid, start, count, sides, by_document: bool, check: Callable | None = None) -> Iterator[pa.RecordBatch]:
    """SENT rows of superwindows. check(i, j) says which of the places i are equal to those of j."""
    name, content = name.view(np.uint64), content.view(np.uint64)
    key = name ^ (content * SPREAD)
    order = np.argsort(key)
    twin = ~changes(key[order])
    twin[:-1] |= twin[1:]
    some = order[twin]
    drop = np.zeros(len(name), bool)
    if len(some):
        some = some[np.lexsort((start[some], doc[some], content[some], name[some]))]
        new = changes(name[some], content[some])
        late = later(doc[some], start[some], new, by_document)
        if check:
            late &= check(some, some[firsts(new)])
        drop[some[late]] = True
    keep = np.flatnonzero(~drop)
    own, inverse = np.unique(name[keep], return_inverse=True)
    n = np.bincount(inverse[np.unique(key[keep], return_index=True)[1]], minlength=len(own))  # contents of each name
    crowd = n[inverse] > CROWD
    shown = np.where(crowd, mix(name[keep] + content[keep] * SPREAD), name[keep])
    yield from batches(SENT, [crowd.astype(np.int8), shown.view(np.int64), content[keep].view(np.int64), doc[keep], rid[keep], (start[keep] << COUNT_BITS) | count[keep], sides[keep]])
    if crowd.any():
        marked = own[n > CROWD].view(np.int64)
        zero = np.zeros(len(marked), np.int64)
        yield from batches(SENT, [np.full(len(marked), MARKER, np.int8), marked, zero, zero, zero.astype(np.int32), zero, zero.astype(np.int32)])
    if drop.any():
        d, r, s, e = merged(doc[drop], rid[drop], start[drop], (start + count)[drop])
        yield from batches(SENT, [np.full(len(d), REPEAT, np.int8), d ^ (s << 20), e, d, r, s, np.zeros(len(d), np.int32)])


def beside(name: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """Of rows sorted by name: which share a side with another of their name."""
    group = np.cumsum(changes(name)).astype(np.int64) << 16
    near = np.zeros(len(name), bool)
    for side in ((sides >> 16) & 0xFFFF, sides & 0xFFFF):
        _, inverse, n = np.unique(group | side, return_inverse=True, return_counts=True)
        near |= (n[inverse] > 1) & (side > 0)
    return near


def resolve(rows: list[np.ndarray], by_document: bool, settle: bool) -> Iterator[pa.RecordBatch]:
    """FOUND rows of all SENT rows of some names."""
    kind, name, content, doc, rid, at, sides = rows
    known = kind == REPEAT
    ends = [(doc[known], rid[known], at[known], content[known])]
    crowded = np.unique(name[(kind == MARKER) | (kind == CROWDED)])
    own = np.flatnonzero(kind <= CROWDED)
    new = changes(name[own])
    shared = ~new
    shared[:-1] |= ~new[1:]
    shared |= np.isin(name[own], crowded)
    own = own[shared]
    if len(own):
        own = own[np.lexsort((at[own], doc[own], content[own], name[own]))]
        name, content, doc, rid, at, sides = (x[own] for x in (name, content, doc, rid, at, sides))
        start, count = at >> COUNT_BITS, at & ((1 << COUNT_BITS) - 1)
        crowd = np.isin(name, crowded)
        if settle:
            new = changes(name, content)
            late = later(doc, start, new, by_document)
            ends.append((doc[late], rid[late], start[late], (start + count)[late]))
            one = np.flatnonzero(new)  # each content once
            ask = ~late & (crowd | beside(name[one], sides[one])[np.cumsum(new) - 1])
        else:
            ask = crowd | beside(name, sides)
        yield from batches(FOUND, [(ASKED + crowd[ask]).astype(np.int8), name[ask], doc[ask], rid[ask], start[ask], (start + count)[ask]])
    d, r, s, e = merged(*(np.concatenate(x) for x in zip(*ends, strict=True)))
    yield from batches(FOUND, [np.full(len(d), KNOWN, np.int8), np.zeros(len(d), np.int64), d, r, s, e])


def resolver(by_document: bool, settle: bool) -> Callable:
    """mapInArrow function over SENT rows sorted by name; whole names are held, AT_ONCE rows or so."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in parts:
            held.append([np.asarray(c) for c in part.columns])
            size += part.num_rows
            if size >= AT_ONCE:
                rows = [np.concatenate(x) for x in zip(*held, strict=True)]
                end = int(np.searchsorted(rows[1], rows[1][-1]))
                if end:
                    yield from resolve([c[:end] for c in rows], by_document, settle)
                held = [[c[end:] for c in rows]]
                size = len(rows[0]) - end
        if held:
            yield from resolve([np.concatenate(x) for x in zip(*held, strict=True)], by_document, settle)

    return run


def dealt(sent: DataFrame, *keys: str) -> DataFrame:
    """Rows of one name in one task, in the order of names."""
    return sent.repartition(partitions(sent.sparkSession), *keys).sortWithinPartitions("name")


def released(spark) -> None:
    """Lets Spark drop the shuffle files of plans that are done: it does when the driver's JVM collects their handles.

    Spark's listeners hold the plan that ended last until another one ends, so a small one comes first.
    """
    spark.range(1).collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def superwindows(docs: DataFrame, find: Callable, by_document: bool, settle: bool, same: Callable | None = None) -> DataFrame:
    """FOUND rows of keyed documents, in windows' numbers."""
    sent = docs.select("doc", "rid", "text").mapInArrow(sender(find, by_document, same), SENT_DDL)
    out = stored(dealt(sent, "name").mapInArrow(resolver(by_document, settle), FOUND_DDL), "superwindows")
    released(docs.sparkSession)
    return out


def with_lists(docs: DataFrame, rows: DataFrame, *columns: str, how: str = "left", keys: DataFrame | None = None) -> DataFrame:
    """Keyed documents with the list of their rows (structs of `columns`), each once.

    Documents that surely have no row of `keys` are not shuffled. Those are stored rows that tell the documents
    of `rows`; by default `rows`, which must be stored ones then, as they are read twice.
    """
    lists = rows.groupBy("doc", "rid").agg(F.collect_set(F.struct(*columns)).alias("list"))
    told = marked(docs, rows if keys is None else keys, "doc", "rid")
    met = told.where("maybe").drop("maybe").join(lists.hint("merge"), ["doc", "rid"], how)
    if how == "inner":
        return met
    none = F.lit(None).cast(lists.schema["list"].dataType)
    return met.unionByName(told.where("NOT maybe").drop("maybe").withColumn("list", none))


def flat_lists(column: pa.Array, *names: str) -> tuple[np.ndarray, ...]:
    """Row numbers and the named fields of a column of lists of structs."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten()
    size = np.asarray(column.value_lengths().fill_null(0))
    return np.repeat(np.arange(len(column)), size), *(np.asarray(flat.field(n)) for n in names)
