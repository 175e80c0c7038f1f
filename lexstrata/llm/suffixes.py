"""Operator 2: substring dedup on bytes by suffix arrays.

A byte is removed if a string of `size` bytes that covers it also starts earlier (in a smaller
doc_id, or earlier in the same document); strings are judged on the input.

1. Strings choose an anchor inside themselves: of the `GRAM`-byte grams, the one with the smallest hash (of
   equals the first). Stretches of strings with one anchor (see `superwindows`) whose anchor stands
   nowhere else, or nowhere with half a string's context in common, can't repeat; all others go, as short
   byte slices, to the shard of their anchor. Within a task equal stretches are compared byte by byte
   before anything is sent, and one goes for all.
2. A shard drops slices that equal one of an earlier place, byte by byte, concatenates the
   others, builds a suffix array by Larsson-Sadakane refinement in numpy, finds common prefixes (as far
   as `size`) by Kasai's method, and reads off classes of equal strings.
3. An anchor with more slices than one shard should hold is split over several; each such shard then sends
   its classes, one row for a class, and the shards' sorted lists are merged by binary search.

Nulls: a null text is empty; a null doc_id counts as greater than all others. Rows with one
doc_id count as one document, and equal places in them remove nothing from each other; each row
is returned. Empty tables give no rows; further columns are ignored. Texts are whole, whatever their length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexstrata.llm.kernels import SEEDS, Prefix, batches, blocks, eights, equal_spans, mix, sliding_min, span_hashes, strings, window_starts
from lexstrata.llm.shared import joined_by_key, only, partitions, stored
from lexstrata.llm.substrings import cut
from lexstrata.llm.superwindows import ASKED, ASKED_CROWDED, FOUND, FOUND_DDL, KNOWN, changes, firsts, flat_lists, keyed, later, merged, released, superwindows, with_lists

GRAM = 32
SHARD_BYTES = 2 << 20
SPLIT_SLICES = 20_000


def finder(size: int):
    """Superwindows of a block of texts, for strings of `size` bytes (8 at least)."""
    gram = min(GRAM, size)

    def find(data: np.ndarray, offs: np.ndarray):
        starts, row = window_starts(offs, size)
        if not len(starts):
            return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int32))
        prefix = Prefix(mix(eights(data)[:-1] ^ np.uint64(SEEDS[0])))  # each stands for eight bytes
        at = np.arange(len(data) - gram + 1)
        hashes = prefix.of(at, at + gram - 7)
        keys = (hashes >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)
        best = sliding_min(keys, size - gram + 1)[starts]
        del at, hashes, keys

        def named(key: np.ndarray) -> np.ndarray:
            low = (key & np.uint64((1 << 32) - 1)).astype(np.int64)
            return prefix.of(low, low + gram - 7)

        return cut(best, starts, row, offs, size, prefix, 0, 32, named, 7, gram)

    return find


def same_strings(size: int):
    """Whether stretches of `count` strings at two places are equal byte by byte."""

    def same(data: np.ndarray, place: np.ndarray, other: np.ndarray, count: np.ndarray) -> np.ndarray:
        return equal_spans(data, place, data, other, count + size - 1)

    return same


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Places of the suffixes in sorted order.

    Larsson-Sadakane: rank by a few symbols, then, doubling that number, sort only inside the
    classes that are not yet single, by the rank of what follows.
    """
    n = len(codes)
    wide = int(codes.max(initial=0)) + 2
    h, key = 1, codes.astype(np.uint64) + np.uint64(1)
    while h < 4 and wide ** (2 * h) < 2**62:
        nxt = np.zeros(n, np.uint64)
        nxt[: n - h] = key[h:]
        key = key * np.uint64(wide**h) + nxt
        h *= 2
    more = 0
    while more < h and wide ** (h + more + 1) < 2**62:
        more += 1
    if more:  # a few symbols of what follows still fit
        nxt = np.zeros(n, np.uint64)
        nxt[: n - h] = key[h:] // np.uint64(wide ** (h - more))
        key, h = key * np.uint64(wide**more) + nxt, h + more
    order = np.argsort(key, kind="stable")
    new = changes(key[order])
    ends = np.append(np.flatnonzero(new)[1:], n) - 1
    sorted_rank = ends[np.cumsum(new) - 1] if n else order
    rank = np.empty(n, np.int64)
    rank[order] = sorted_rank
    place = np.flatnonzero(~(new & np.append(new[1:], True))) if n else order
    own, group = order[place], sorted_rank[place]
    while len(place):  # classes that aren't single yet
        follow = np.where(own + h < n, rank[np.minimum(own + h, n - 1)], -1) + 1
        by = np.argsort(group.astype(np.uint64) * np.uint64(n + 2) + follow.astype(np.uint64), kind="stable")
        own, follow = own[by], follow[by]
        order[place] = own
        first = np.flatnonzero(changes(group, follow))
        size = np.diff(np.append(first, len(place)))
        group = np.repeat(place[first + size - 1], size)
        rank[own] = group
        left = np.repeat(size > 1, size)
        place, own, group = place[left], own[left], group[left]
        h *= 2
    return order


def common_prefixes(codes: np.ndarray, order: np.ndarray, most: int, lane: int | None = None) -> np.ndarray:
    """Kasai: common prefix, up to `most`, of each sorted suffix with the one before it.

    Stretches of `lane` text places run side by side; going on by one place shortens the prefix
    by at most one, so each stretch compares little more than its own length.
    """
    n = len(codes)
    lane = lane or min(256, max(64, n >> 13))
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    padded = np.concatenate([codes.astype(np.int64), np.arange(-2, -2 - most - 2, -1)])
    begin = np.arange(0, n, lane)
    h = np.zeros(len(begin), np.int64)
    for step in range(min(lane, n)):
        i = begin + step
        live = i < n
        i, h = i[live], h[live]
        begin = begin[live]
        j = before[i]
        h[j < 0] = 0
        going = np.flatnonzero((j >= 0) & (h < most))
        while len(going):
            a, b = i[going] + h[going], j[going] + h[going]
            same = padded[a] == padded[np.minimum(b, len(padded) - 1)]
            going = going[same]
            h[going] += 1
            going = going[h[going] < most]
        out[i] = h
        h = np.maximum(h - 1, 0)
    return out[order]


SLICES = pa.schema([("shard", pa.int64()), ("split", pa.bool_()), ("doc", pa.int64()), ("rid", pa.int32()), ("start", pa.int64()), ("bytes", pa.binary())])
SLICES_DDL = "shard long, split boolean, doc long, rid int, start long, bytes binary"


def slicer(size: int):
    """mapInArrow function over (doc, rid, text, list): the slices asked about, by shard."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            docs, rids = (np.asarray(part.column(i)) for i in (0, 1))
            for lo, hi, data, offs in blocks(part.column(2)):
                row, shard, parts_, split, start, end = flat_lists(part.column(3).slice(lo, hi - lo), "name", "parts", "split", "start", "end")
                low = offs[row] + start
                length = end - start + size - 1
                salt = mix(docs[lo:hi][row].view(np.uint64) + (rids[lo:hi][row].astype(np.int64).view(np.uint64) << np.uint64(32))) % np.maximum(parts_, 1).astype(np.uint64)
                shard = shard.view(np.uint64) ^ (salt * np.uint64(0x9E3779B97F4A7C15))
                for a in range(0, len(row), 20_000):
                    own = slice(a, a + 20_000)
                    sums = np.concatenate([[0], np.cumsum(length[own])])
                    flat = data[np.repeat(low[own] - sums[:-1], length[own]) + np.arange(sums[-1])]
                    cells = pa.BinaryArray.from_buffers(pa.binary(), len(sums) - 1, [None, pa.py_buffer(sums.astype(np.int32)), pa.py_buffer(flat)])
                    yield from batches(SLICES, [shard[own].view(np.int64), split[own] | (parts_[own] > 1), docs[lo:hi][row[own]], rids[lo:hi][row[own]], start[own], cells])

    return run


CLASSES = pa.schema([("first", pa.bool_()), ("low", pa.int64()), ("high", pa.int64()), ("doc", pa.int64()), ("rid", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
CLASSES_DDL = "first boolean, low long, high long, doc long, rid int, start long, end long"


def sharder(size: int):
    """mapInArrow function over the slices of some shards: repeats, and for split anchors the
    first of each class with its 128-bit hash, for the merge."""

    def distinct(held: list[pa.RecordBatch]) -> tuple[list[pa.RecordBatch], tuple]:
        """CLASSES rows of slices that equal one of an earlier place; and the others: split, doc, rid, start, length, bytes."""
        table = pa.Table.from_batches(held).combine_chunks()
        split, doc, rid, start = (np.asarray(table[c]) for c in ("split", "doc", "rid", "start"))
        data, offs = strings(table["bytes"])
        length = np.diff(offs)
        hashes = span_hashes(data, offs[:-1], offs[1:])
        by = np.lexsort((start, doc, length, hashes))
        new = changes(hashes[by], length[by])
        first = by[firsts(new)]
        late = later(doc[by], start[by], new, False) & equal_spans(data, offs[by], data, offs[first], length[by])
        gone, left = by[late], np.sort(by[~late])
        out = []
        if len(gone):
            d, r, s, e = merged(doc[gone], rid[gone], start[gone], start[gone] + length[gone] - size + 1)
            zero = np.zeros(len(d), np.int64)
            out = list(batches(CLASSES, [np.zeros(len(d), bool), zero, zero, d, r, s, e]))
        n = length[left]
        own = data[np.repeat(offs[left] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
        return out, (split[left], doc[left], rid[left], start[left], n, own)

    def solve(split, doc, rid, start, length, data) -> Iterator[pa.RecordBatch]:
        if len(doc) < 2 and not split.any():
            return
        low = np.cumsum(length) - length
        at = np.cumsum(length + 1) - (length + 1)
        codes = np.zeros(int((length + 1).sum()), np.int32)  # each slice ends in a 0
        step = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        codes[np.repeat(at, length) + step] = data[np.repeat(low, length) + step].astype(np.int32) + 1
        order = suffix_array(codes)
        prefix = common_prefixes(codes, order, size)
        owner = np.repeat(np.arange(len(length)), length + 1)
        room = length[owner] - (np.arange(len(codes)) - at[owner])
        whole = room[order] >= size  # suffixes with `size` bytes of their own slice
        cls = np.cumsum(prefix < size)[whole]
        own = order[whole]
        o = owner[own]
        d, r, s = doc[o], rid[o], start[o] + own - at[o]
        by = np.lexsort((s, d, cls))
        cls, d, r, s, o, own = (x[by] for x in (cls, d, r, s, o, own))
        new = changes(cls)
        late = later(d, s, new, False)
        if late.any():
            a, b, c, e = merged(d[late], r[late], s[late], s[late] + 1)
            zero = np.zeros(len(a), np.int64)
            yield from batches(CLASSES, [np.zeros(len(a), bool), zero, zero, a, b, c, e])
        ask = ~late & split[o]
        if ask.any():
            p = own[ask]
            raw = np.maximum(codes - 1, 0).astype(np.uint8)
            one, two = (span_hashes(raw, p, p + size, w).view(np.int64) for w in (0, 1))
            yield from batches(CLASSES, [np.ones(len(p), bool), one, two, d[ask], r[ask], s[ask], s[ask] + 1])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slices sorted by shard; neighbouring small shards share one suffix array."""
        held, size_held, last, pending = [], 0, None, []

        def flush(at_end: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size_held, pending
            if held:
                known, left = distinct(held)
                yield from known
                pending.append(left)
                held, size_held = [], 0
            if pending and (at_end or sum(len(p[5]) for p in pending) >= SHARD_BYTES):
                yield from solve(*(np.concatenate(x) for x in zip(*pending, strict=True)))
                pending = []

        for part in parts:
            shard, sums = np.asarray(part.column(0)), np.append(0, np.cumsum(np.diff(strings(part.column(5))[1])))
            new, lo = changes(shard), 0
            new[:1] = len(shard) > 0 and shard[0] != last
            for k in np.flatnonzero(new).tolist():
                if size_held + int(sums[k] - sums[lo]) >= SHARD_BYTES:
                    held.append(part.slice(lo, k - lo))
                    yield from flush(False)
                    lo = k
            held.append(part.slice(lo))
            size_held += int(sums[-1] - sums[lo])
            last = shard[-1] if len(shard) else last
        yield from flush(True)

    return run


def merge_sorted(lists: list[np.ndarray]) -> np.ndarray:
    """One list of lists that are sorted by (low, high, doc, start), two at a time: the places of
    one's rows in the other are found by binary search of `low`; rows of one `low` are ordered after."""
    lists = sorted(lists, key=len)
    while len(lists) > 1:
        a, b, lists = lists[0], lists[1], lists[2:]
        out = np.empty(len(a) + len(b), a.dtype)
        at = np.searchsorted(b["low"], a["low"], "right") + np.arange(len(a))
        rest = np.ones(len(out), bool)
        rest[at] = False
        out[at], out[rest] = a, b
        new = changes(out["low"])
        twin = np.flatnonzero(~new | np.append(~new[1:], False))
        x = out[twin]
        out[twin] = x[np.lexsort((x["start"], x["doc"], x["high"], x["low"]))]
        lists.append(out)
    return lists[0]


def merger(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: classes of split anchors, dealt by hash; those that start earlier in another shard."""
    shape = np.dtype([("low", "i8"), ("high", "i8"), ("doc", "i8"), ("start", "i8"), ("rid", "i4")])
    lists = []
    for part in parts:
        rows = np.empty(part.num_rows, shape)
        for n in shape.names:
            rows[n] = np.asarray(part.column(n))
        lists.append(rows)
    if not lists:
        return
    rows = merge_sorted([x[np.lexsort((x["start"], x["doc"], x["high"], x["low"]))] for x in lists])
    late = later(rows["doc"], rows["start"], changes(rows["low"], rows["high"]), False)
    x = rows[late]
    if len(x):
        d, r, s, e = merged(x["doc"].copy(), x["rid"].copy(), x["start"].copy(), x["start"] + 1)
        yield from batches(FOUND, [np.full(len(d), KNOWN, np.int8), np.zeros(len(d), np.int64), d, r, s, e])


def repeats(docs: DataFrame, size: int) -> DataFrame:
    """doc, rid, start, end: strings of keyed documents that start earlier elsewhere."""
    if size < 8:
        raise ValueError("a string has 8 bytes at least")
    n = partitions(docs.sparkSession)
    found = superwindows(docs, finder(size), False, False, same_strings(size))
    asked = found.where(f"kind >= {ASKED}").withColumn("split", F.col("kind") == ASKED_CROWDED)
    wide = asked.groupBy("name").agg(F.ceil(F.count("*") / F.lit(SPLIT_SLICES)).cast("long").alias("parts")).where("parts > 1")
    named = joined_by_key(asked, stored(wide, "wide"), "name").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    listed = with_lists(docs.select("doc", "rid", "text"), named, "name", "parts", "split", "start", "end", how="inner", keys=asked)
    slices = listed.select("doc", "rid", "text", "list").mapInArrow(slicer(size), SLICES_DDL)
    released(docs.sparkSession)
    classes = stored(slices.repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(sharder(size), CLASSES_DDL), "classes")
    released(docs.sparkSession)
    across = stored(classes.where("first").repartition(n, "low").mapInArrow(merger, FOUND_DDL), "across")
    columns = ("doc", "rid", "start", "end")
    return found.where(f"kind = {KNOWN}").select(*columns).unionByName(classes.where("NOT first").select(*columns)).unionByName(across.select(*columns))


def removed_bytes(offs: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    step = np.zeros(int(offs[-1]) + 1, np.int64)
    np.add.at(step, offs[row] + start, 1)
    np.add.at(step, offs[row] + end + size - 1, -1)
    return np.cumsum(step[:-1]) > 0


def digests(docs: DataFrame, size: int = 100) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    docs = keyed(only(docs, "doc_id", "text"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for lo, hi, data, offs in blocks(part.column(1)):
                drop = removed_bytes(offs, *flat_lists(part.column(2).slice(lo, hi - lo), "start", "end"), size)
                edge = np.zeros(len(drop) + 1, bool)
                edge[offs] = True
                edge = edge[:-1]
                begins = drop.copy()
                begins[1:] &= ~drop[:-1] | edge[1:]
                kept = data[~drop].tobytes()
                removed = np.concatenate([[0], np.cumsum(drop)])[offs]
                spans = np.concatenate([[0], np.cumsum(begins)])[offs]
                ends = (offs - removed).tolist()
                sha = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield from batches(schema, [part.column(0).slice(lo, hi - lo), np.diff(offs), np.diff(removed), np.diff(spans), sha])

    listed = with_lists(docs, repeats(docs, size), "start", "end")
    return listed.select("doc_id", "text", "list").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
