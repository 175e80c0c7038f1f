"""Operator 6: substring dedup by recompression.

Each round of recompression names runs of one symbol, then pairs: symbols fall to a left or a
right side by a bit of their name, and every left symbol followed by a right one becomes a new
symbol. A name is a hash of what it stands for (its left and right symbol, or a symbol and the length of its
run), so all executors give one name to equal substrings without asking each other. A symbol whose
making looked only at words inside a window is an interior symbol of it, and is made in every other
place where the window stands.

1. Every window of `size` words takes as anchor its highest interior symbol, of equals the one
   with the smallest name (words themselves are the symbols of level 0, so there always is one).
2. The first Spark round (`superwindows`) brings the symbols of one name together. A high symbol that
   stands only once ends there, and with it all windows around it. Where a name stands in several
   places, the stretches around it are compared by a second, independent hash: equal ones repeat as a whole.
3. Stretches that share their high symbol and half a window beside it, but differ further out, go to the
   second Spark round, where each of their windows gets a symbol of its own, 128 bits wide, and equal ones meet.

A word is removed if a window that covers it also starts in a document with a smaller doc_id.

Nulls: a null text has no words; a null doc_id counts as greater than all others. Rows with one
doc_id count as one document and remove nothing from each other; each gets a row. Empty tables
give no rows; further columns are ignored. Texts are treated whole whatever their length. Windows of
more than MOST_SIZE words raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexstrata.llm.kernels import BASES, Prefix, Words, batches, blocks, mix, sliding_min, window_starts
from lexstrata.llm.shared import only, stored
from lexstrata.llm.superwindows import ASKED, FOUND_DDL, KNOWN, NO_ID, SENT_DDL, dealt, flat_lists, keyed, released, resolver, send, superwindows, with_lists

PLACE_BITS, LENGTH_BITS, NAME_BITS = 28, 6, 26
MOST_SIZE = 1 << LENGTH_BITS


def rounds_for(size: int) -> int:
    """Rounds of runs and pairs: as many as leave most windows an interior symbol of the last."""
    return 2 if size < 24 else 3


def symbols(name: np.ndarray, row: np.ndarray, rounds: int) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(level, names, first words looked at, ends) of the symbols that each step makes.

    What a symbol's making looked at lies within its row, or the symbol is left out.
    """
    n = len(name)
    out = [(0, name, np.arange(n), np.arange(n) + 1)]
    low, high = np.arange(n), np.arange(n) + 1
    for r in range(rounds):
        # runs: to be one symbol is to differ from both neighbours, so these are looked at
        if len(name) < 2:
            break
        joined = (name[1:] == name[:-1]) & (row[1:] == row[:-1])
        begin = np.flatnonzero(np.concatenate([[True], ~joined]))
        end = np.append(begin[1:], len(name))
        length = end - begin
        edge_low = np.where((begin > 0) & (row[np.maximum(begin - 1, 0)] == row[begin]), low[np.maximum(begin - 1, 0)], -1)
        last = np.minimum(end, len(name) - 1)
        edge_high = np.where((end < len(name)) & (row[last] == row[begin]), high[last], n + 1)
        own = name[begin]
        name = np.where(length > 1, mix(own ^ (length.astype(np.uint64) * np.uint64(BASES[1]))), own)
        row, low, high = row[begin], edge_low, edge_high
        made = length > 1
        out.append((2 * r + 1, name[made], low[made], high[made]))
        if len(name) < 2:
            break
        # pairs: a left symbol before a right one; an unpaired left has looked at what follows it, a right at what comes before
        side = (mix(name + np.uint64(r + 1)) >> np.uint64(17)) & np.uint64(1) == 1
        same = row[1:] == row[:-1]
        pair = ~side[:-1] & side[1:] & same
        first = np.append(pair, False)
        second = np.concatenate([[False], pair])
        new_low, new_high = low.copy(), high.copy()
        new_low[1:] = np.where(side[1:] & same, np.minimum(low[1:], low[:-1]), np.where(side[1:], -1, low[1:]))
        new_low[0] = -1 if side[0] else low[0]
        new_high[:-1] = np.where(~side[:-1] & same, np.maximum(high[:-1], high[1:]), np.where(~side[:-1], n + 1, high[:-1]))
        new_high[-1] = high[-1] if side[-1] else n + 1
        at = np.flatnonzero(first)
        pair_name = mix(name[at] * np.uint64(BASES[0]) + name[at + 1])
        name, new_low[at], new_high[at] = name.copy(), np.minimum(low[at], low[at + 1]), np.maximum(high[at], high[at + 1])
        name[at] = pair_name
        out.append((2 * r + 2, pair_name, new_low[at], new_high[at]))
        stay = ~second
        name, row, low, high = name[stay], row[stay], new_low[stay], new_high[stay]
    return out


def finder(size: int):
    """Superwindows of a block of texts, for windows of `size` words."""
    if not 1 <= size <= MOST_SIZE:
        raise ValueError(f"a window has 1 to {MOST_SIZE} words")
    rounds = rounds_for(size)

    def find(data: np.ndarray, offs: np.ndarray):
        words = Words(data, offs)
        starts, row = window_starts(words.first, size)
        if not len(starts):
            return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int32))
        name, word_row, n = words.hashes(), words.rows(), len(words)
        top = np.iinfo(np.uint64).max
        by_length: dict[int, np.ndarray] = {}
        found = []
        for level, names, low, high in symbols(name, word_row, rounds):
            ok = (low >= 0) & (high <= n) & (high - low <= size)
            ok[ok] = word_row[low[ok]] == word_row[high[ok] - 1]
            low, high, names = low[ok], high[ok], names[ok]
            found.append((level, names, low, high))
            rank = (np.uint64(2 * rounds - level) << np.uint64(60)) | (names >> np.uint64(64 - NAME_BITS) << np.uint64(PLACE_BITS + LENGTH_BITS)) | (low.astype(np.uint64) << np.uint64(LENGTH_BITS))
            for length in np.unique(high - low).tolist():
                k = by_length.setdefault(length, np.full(n, top, np.uint64))
                at = (high - low) == length
                np.minimum.at(k, low[at], rank[at] | np.uint64(length - 1))
        best = np.full(n - size + 1, top, np.uint64)
        for length, k in by_length.items():
            np.minimum(best, sliding_min(k, size - length + 1)[: n - size + 1], out=best)
        # the chosen symbols' own names, of all with their level and extent the one with the key's bits
        names_at, keys_at = (np.concatenate(x) for x in zip(*((names, (np.uint64(2 * rounds - level) << np.uint64(60)) | (names >> np.uint64(64 - NAME_BITS) << np.uint64(PLACE_BITS + LENGTH_BITS)) | (low.astype(np.uint64) << np.uint64(LENGTH_BITS)) | (high - low - 1).astype(np.uint64)) for level, names, low, high in found), strict=True))
        order = np.argsort(keys_at, kind="stable")
        keys_at, names_at = keys_at[order], names_at[order]

        def named(key: np.ndarray) -> np.ndarray:
            return names_at[np.searchsorted(keys_at, key)]

        return cut(best[starts], starts, row, words.first, size, Prefix(words.hashes(which=1), BASES[1]), LENGTH_BITS, PLACE_BITS, named)

    return find


def cut(best: np.ndarray, starts: np.ndarray, row: np.ndarray, first: np.ndarray, size: int, prefix: Prefix, low_bits: int, place_bits: int, named, ahead: int = 0, anchor: int = 1):
    """Superwindows from each window's chosen key (rank, place, low_bits more); named gives the names of keys.

    low_bits hold the anchor's length less `anchor`. prefix: of what contents are made of; ahead: elements
    after its own that a value of it stands for. Sides that are not longer than that are all told as equal.
    """
    new = np.ones(len(starts), bool)
    new[1:] = (best[1:] != best[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(starts)))
    key = best[at]
    low = ((key >> np.uint64(low_bits)) & np.uint64((1 << place_bits) - 1)).astype(np.int64)
    begin = starts[at]
    content = mix(prefix.of(begin, begin + count + size - 1 - ahead) + (low - begin).astype(np.uint64))
    length = (key & np.uint64((1 << low_bits) - 1)).astype(np.int64) + anchor
    half = (size - length + 1) // 2
    seen = np.maximum(half - ahead, 0)
    sides = np.zeros(len(at), np.int64)
    for ok, a, shift in ((low - begin >= half, low - half, 16), (begin + count + size - 1 - low - length >= half, low + length, 0)):
        ok = np.flatnonzero(ok)
        sides[ok] |= ((prefix.of(a[ok], (a + seen)[ok]) >> np.uint64(48)).astype(np.int64) | 1) << shift
    return named(key), content, row[at], begin - first[row[at]], count, sides.astype(np.uint32).view(np.int32)


def window_sender(size: int):
    """mapInArrow function over (doc, rid, text, list): names of the contested windows, for the second round."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            docs, rids = (np.asarray(part.column(i)) for i in (0, 1))
            for lo, hi, data, offs in blocks(part.column(2)):
                words = Words(data, offs)
                a, b = (Prefix(words.hashes(which=w), BASES[w]) for w in (0, 1))
                row, start, end = flat_lists(part.column(3).slice(lo, hi - lo), "start", "end")
                count = end - start
                row, t = np.repeat(row, count), np.repeat(start - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
                at = words.first[row] + t
                yield from send(a.of(at, at + size), b.of(at, at + size), docs[lo:hi][row], rids[lo:hi][row], t, np.ones(len(t), np.int64), np.zeros(len(t), np.int32), True)

    return run


def repeats(docs: DataFrame, size: int) -> DataFrame:
    """doc, rid, start, end: windows of keyed documents that also start in a smaller doc_id."""
    found = superwindows(docs, finder(size), True, True)
    asked = with_lists(docs.select("doc", "rid", "text"), found.where(f"kind >= {ASKED}"), "start", "end", how="inner")
    single = asked.select("doc", "rid", "text", "list").mapInArrow(window_sender(size), SENT_DDL)
    second = stored(dealt(single, "name").mapInArrow(resolver(True, True), FOUND_DDL), "windows")
    released(docs.sparkSession)
    return found.unionByName(second).where(f"kind = {KNOWN}").select("doc", "rid", "start", "end")


def removed_words(words: Words, row: np.ndarray, start: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, words.first[row] + start, 1)
    np.add.at(step, words.first[row] + end + size - 1, -1)
    return np.cumsum(step[:-1]) > 0


def joined(words: Words, keep: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Kept words of each row joined by a space, and the rows' ends; each row has one space too many at its end."""
    start, size = words.start[keep], (words.end - words.start)[keep] + 1
    sums = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(start - sums[:-1], size) + np.arange(sums[-1])
    out = np.concatenate([words.data, [np.uint8(32)]])[np.minimum(at, len(words.data))]
    out[sums[1:] - 1] = 32
    before = np.concatenate([[0], np.cumsum(keep)])
    return out.tobytes(), sums[before[words.first]]


def digests(docs: DataFrame, size: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    docs = keyed(only(docs, "doc_id", "text"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for lo, hi, data, offs in blocks(part.column(1)):
                words = Words(data, offs)
                drop = removed_words(words, *flat_lists(part.column(2).slice(lo, hi - lo), "start", "end"), size)
                raw, ends = joined(words, ~drop)
                sums = np.concatenate([[0], np.cumsum(drop)])[words.first]
                sha = [hashlib.sha256(raw[a : max(a, b - 1)]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                yield from batches(schema, [part.column(0).slice(lo, hi - lo), np.diff(words.first), np.diff(sums), sha])

    listed = with_lists(docs, repeats(docs, size), "start", "end")
    return listed.select("doc_id", "text", "list").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def deduplicated(docs: DataFrame, size: int = 13, text: str = "text") -> DataFrame:
    """docs with the repeated words cut out of their texts; those left without any word go.

    Untouched texts stay byte for byte; a cut takes the white space after each removed word.
    """
    fields = docs.schema.fields
    names = [f.name for f in fields]
    at = names.index(text)
    found = repeats(keyed(only(docs, "doc_id", text).toDF("doc_id", "text")), size)
    safe = docs.toDF(*[f"c{k}" for k in range(len(fields))])  # no name clashes with those added
    keys = F.coalesce(f"c{names.index('doc_id')}", F.lit(NO_ID)).cast("long").alias("doc"), F.hash(F.coalesce(F.col(f"c{at}"), F.lit(""))).alias("rid")
    listed = with_lists(safe.select("*", *keys), found, "start", "end")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for lo, hi, data, offs in blocks(part.column(at)):
                some = part.slice(lo, hi - lo)
                words = Words(data, offs)
                row, start, end = flat_lists(some.column(len(fields)), "start", "end")
                drop = removed_words(words, row, start, end, size)
                stop = np.append(words.start[1:], len(data))  # a removed word goes with the space up to the next one or the row's end
                stop = np.minimum(stop, offs[words.rows() + 1])
                step = np.zeros(len(data) + 1, np.int64)
                np.add.at(step, words.start[drop], 1)
                np.add.at(step, stop[drop], -1)
                keep = np.cumsum(step[:-1]) == 0
                sums = np.concatenate([[0], np.cumsum(keep)])[offs]
                texts = pa.StringArray.from_buffers(hi - lo, pa.py_buffer(sums.astype(np.int32)), pa.py_buffer(data[keep]))
                left = np.diff(np.concatenate([[0], np.cumsum(~drop)])[words.first])
                stays = (left > 0) | (np.diff(words.first) == 0)
                null = np.asarray(some.column(at).is_null())
                texts = pa.array([None if x else t for t, x in zip(texts.to_pylist(), null.tolist(), strict=True)], pa.string()) if null.any() else texts
                columns = [texts if k == at else some.column(k) for k in range(len(fields))]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields]).filter(pa.array(stays))

    return listed.select(*safe.columns, "list").mapInArrow(run, docs.schema)
