"""Operator 8: SentencePiece-style encoding and decoding with a unigram model.

Pieces and scores come from a model file. Its trie is a double array over UTF-8 bytes, built
once on the driver (its size is bounded by the vocabulary) and sent to the tasks. Viterbi finds
the segmentation with the greatest sum of log scores; of equal sums, the one whose last
differing piece starts first. A character that no piece covers becomes the pieces of its bytes.

A space is written as U+2581, and a text starts with one more. Pieces hold U+2581 only at their
start, and none holds a line feed beside other characters, so a text falls into units (a run of
spaces with what follows, or a line feed) that pieces never cross: the best segmentation of a
text is that of its units, one after another. Distinct units are segmented together, many at
a time, and kept.

Files of the merge-based kind hold ranks instead of log scores. The score of rank r is then the
log of a Zipf share, -ln((r + 1) H) with H the harmonic number of the pieces.

Nulls: a null text is an empty text; an empty text has no pieces and decodes to itself. A
U+2581 in a text decodes to a space. Texts of any length are encoded whole. Repeated rows each
get a row; empty tables give none; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexstrata.llm.kernels import batches, blocks
from lexstrata.llm.shared import only
from lexstrata.llm.token_cache import IdCache

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
UNKNOWN_COST = 10.0
LONG_UNIT = 96
MOST_UNITS = 400_000
NONE = -1


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = raw[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, raw[at : at + n]
        at += n


def read_model(path: str) -> tuple[list[str], list[float], list[int], bool]:
    """Pieces, scores, kinds, and whether the file says that scores are log probabilities."""
    pieces, scores, kinds, unigram = [], [], [], True
    with open(path, "rb") as f:
        raw = f.read()
    for number, value in fields(raw):
        if number == 1:
            own = dict(fields(value))
            pieces.append(own.get(1, b"").decode())
            scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
            kinds.append(own.get(3, NORMAL))
        elif number == 2:
            unigram = dict(fields(value)).get(3, 1) == 1
    return pieces, scores, kinds, unigram


def log_scores(scores: list[float], kinds: list[int], unigram: bool) -> list[float]:
    if unigram:
        return scores
    order = sorted((i for i, k in enumerate(kinds) if k in (NORMAL, USER)), key=lambda i: (-scores[i], i))
    h = sum(1 / (r + 1) for r in range(len(order)))
    out = [0.0] * len(scores)
    for r, i in enumerate(order):
        out[i] = -math.log((r + 1) * h)
    return out


class DoubleArray:
    """base, check and piece of each cell; the step from state s by byte c leads to base[s] + c."""

    def __init__(self, keys: list[bytes], values: list[int]):
        tree: list[dict[int, int]] = [{}]
        ends = {}
        for key, value in zip(keys, values, strict=True):
            at = 0
            for c in key:
                nxt = tree[at].get(c)
                if nxt is None:
                    nxt = tree[at][c] = len(tree)
                    tree.append({})
                at = nxt
            ends.setdefault(at, value)
        size = 4 * len(tree) + 65536
        self.base = np.zeros(size, np.int32)
        self.check = np.full(size, NONE, np.int32)
        self.piece = np.full(size, NONE, np.int32)
        free, used = 1, np.zeros(size, bool)
        used[0] = True
        queue = [(0, 0)]
        for node, cell in queue:
            if node in ends:
                self.piece[cell] = ends[node]
            children = sorted(tree[node])
            if not children:
                continue
            while used[free]:
                free += 1
            start, span = max(1, free - children[0]), 64
            if len(children) > 1 and used[free : free + 4096].mean() > 0.9:
                free += 4096  # nearly full: only small nodes would fit, and cells are plenty
            while True:
                fits = ~used[np.add.outer(np.arange(start, start + span), children)].any(1)
                if fits.any():
                    start += int(fits.argmax())
                    break
                start, span = start + span, min(4 * span, 16384)
            self.base[cell] = start
            for c in children:
                used[start + c] = True
                self.check[start + c] = cell
                queue.append((tree[node][c], start + c))
        top = int(np.flatnonzero(used)[-1]) + 257
        self.base, self.check, self.piece = self.base[:top].copy(), self.check[:top].copy(), self.piece[:top].copy()


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        self.names, scores, self.kinds, unigram = read_model(path)
        score = log_scores(scores, self.kinds, unigram)
        usable = [i for i, k in enumerate(self.kinds) if k in (NORMAL, USER)]
        if any(MARK in self.names[i].lstrip(MARK) or ("\n" in self.names[i] and self.names[i] != "\n") for i in usable):
            raise ValueError("a piece crosses units")
        written = {i: self.names[i].replace(MARK, " ").encode() for i in usable}
        self.trie = DoubleArray([written[i] for i in usable], usable)
        self.score = np.array(score)
        self.unknown = min(score[i] for i in usable) - UNKNOWN_COST
        self.bytes = np.zeros(256, np.int32)
        for i, k in enumerate(self.kinds):
            if k == BYTE:
                self.bytes[int(self.names[i][3:5], 16)] = i
                written[i] = bytes([int(self.names[i][3:5], 16)])
        if sum(k == BYTE for k in self.kinds) != 256:
            raise ValueError("the model has no byte pieces")
        self.is_byte = np.array([k == BYTE for k in self.kinds])
        parts = [written.get(i, b"") for i in range(len(self.names))]
        self.size = np.array([len(p) for p in parts], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(parts), np.uint8)
        self.cache = None

    def __getstate__(self):
        return self.__dict__ | {"cache": None}

    def segment_one(self, raw: bytes) -> list[int]:
        """Ids of one unit, position by position."""
        base, check, piece = self.trie.base, self.trie.check, self.trie.piece
        n = len(raw)
        best, back = [-math.inf] * (n + 1), [(0, NONE)] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            if raw[i] & 0xC0 == 0x80:
                continue
            width = 1 if raw[i] < 0x80 else 2 if raw[i] < 0xE0 else 3 if raw[i] < 0xF0 else 4
            state, covered = 0, False
            for j in range(i, n):
                to = int(base[state]) + raw[j]
                if check[to] != state:
                    break
                state = to
                p = int(piece[state])
                if p >= 0:
                    covered |= j + 1 - i == width
                    s = best[i] + float(self.score[p])
                    if s > best[j + 1]:
                        best[j + 1], back[j + 1] = s, (i, p)
            if not covered and best[i] + self.unknown > best[i + width]:
                best[i + width], back[i + width] = best[i] + self.unknown, (i, NONE)
        out, j = [], n
        while j:
            i, p = back[j]
            out += [p] if p >= 0 else [int(self.bytes[c]) for c in reversed(raw[i:j])]
            j = i
        return out[::-1]

    def segment_many(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units one after another, and the number for each; all units step on together."""
        n = len(start)
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        slot = np.cumsum(size + 1) - (size + 1)
        best = np.full(int((size + 1).sum()), -np.inf)
        best[slot] = 0
        prev = np.zeros(len(best), np.int64)
        via = np.full(len(best), NONE, np.int32)
        base, check, piece = self.trie.base, self.trie.check, self.trie.piece
        data = np.concatenate([data, np.zeros(1, np.uint8)])
        for i in range(int(size[0]) if n else 0):
            live = np.arange(int(np.searchsorted(-size, -i, "left")))
            c = data[start[live] + i]
            live = live[(c & 0xC0) != 0x80]
            if not len(live):
                continue
            c = data[start[live] + i]
            width = 1 + (c >= 0xC0).astype(np.int64) + (c >= 0xE0) + (c >= 0xF0)
            open_, state, wide, j = live, np.zeros(len(live), np.int64), width, i
            covered = np.zeros(n, bool)
            while len(open_):
                to = base[state] + data[start[open_] + j]
                ok = (check[to] == state) & (j < size[open_])
                open_, state, wide = open_[ok], to[ok].astype(np.int64), wide[ok]
                j += 1
                p = piece[state]
                hit = p >= 0
                u, p = open_[hit], p[hit]
                covered[u[j - i == wide[hit]]] = True
                s = best[slot[u] + i] + self.score[p]
                better = s > best[slot[u] + j]
                u, p = u[better], p[better]
                best[slot[u] + j] = s[better]
                prev[slot[u] + j] = i
                via[slot[u] + j] = p
            bare = ~covered[live]
            u, w = live[bare], width[bare]
            s = best[slot[u] + i] + self.unknown
            better = s > best[slot[u] + i + w]
            at = (slot[u] + i + w)[better]
            best[at], prev[at], via[at] = s[better], i, NONE
        # back from the ends, one piece of every unit at a time
        j, left = size.copy(), np.arange(n)
        found = []
        while len(left):
            at = slot[left] + j[left]
            found.append((left, prev[at], j[left].copy(), via[at]))
            j[left] = prev[at]
            left = left[j[left] > 0]
        if not found:
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        unit, low, high, ids = (np.concatenate(x) for x in zip(*found, strict=True))
        count = np.where(ids >= 0, 1, high - low)
        by = np.lexsort((low, order[unit]))
        unit, low, ids, count = order[unit][by], low[by], ids[by], count[by]
        place = np.empty(n, np.int64)
        place[order] = start
        flat = np.repeat(ids, count)
        fall = np.flatnonzero(flat < 0)
        if len(fall):
            first = np.repeat(np.cumsum(count) - count, count)
            source = np.repeat(place[unit] + low, count) + np.arange(len(flat)) - first
            flat[fall] = self.bytes[data[source[fall]]]
        return flat.astype(np.uint32), np.bincount(unit, count, n).astype(np.int64)

    def units(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of units, with the end last, and the first unit of each row."""
        n = len(data)
        space, feed = data == 32, data == 10
        new = np.zeros(n + 1, bool)
        new[:n] = feed | space
        new[1:n] &= ~space[:-1] | feed[1:]
        new[1 : n + 1] |= feed
        new[offs] = True
        new[n] = False
        start = np.flatnonzero(new)
        return np.append(start, n), np.searchsorted(start, offs)

    def prepare(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts as the model sees them: a space before each that isn't empty, U+2581 as a space."""
        raw = data.tobytes()
        if MARK.encode() in raw:
            rows = [raw[a:b].replace(MARK.encode(), b" ") for a, b in zip(offs[:-1], offs[1:], strict=True)]
            data = np.frombuffer(b"".join(rows), np.uint8)
            offs = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        full = np.diff(offs) > 0
        shift = np.concatenate([[0], np.cumsum(full)])
        return np.insert(data, offs[:-1][full], 32), offs + shift

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another, and the number for each row."""
        data, offs = self.prepare(data, offs)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offs) - 1, np.int64)
        start, first = self.units(data, offs)
        if self.cache is None:
            self.cache = IdCache(self.segment, MOST_UNITS)
        flat, each = self.cache.counts(data, start[:-1], start[1:])
        sums = np.concatenate([[0], np.cumsum(each)])
        return flat, sums[first[1:]] - sums[first[:-1]]

    def segment(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units one after another, and the number for each."""
        size = np.fromiter(map(len, units), np.int64, len(units))
        short = np.flatnonzero(size <= LONG_UNIT)
        data = np.frombuffer(b"".join(units), np.uint8)
        flat, each = self.segment_many(data, (np.cumsum(size) - size)[short], size[short])
        if len(short) == len(units):
            return flat, each
        lists = [self.segment_one(u) if len(u) > LONG_UNIT else None for u in units]
        own = iter(np.split(flat, np.cumsum(each)[:-1])) if len(short) else iter(())
        lists = [next(own) if x is None else np.array(x, np.uint32) for x in lists]
        return np.concatenate(lists), np.fromiter(map(len, lists), np.int64, len(lists))

    def decode(self, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and offsets of the texts; the first space of each is left out again."""
        size = self.size[ids]
        sums = np.concatenate([[0], np.cumsum(size)])
        flat = self.flat[np.repeat(self.at[ids] - sums[:-1], size) + np.arange(sums[-1])]
        offs = sums[np.concatenate([[0], np.cumsum(count)])]
        full = np.diff(offs) > 0
        first = offs[:-1][full]
        first = first[flat[first] == 32]
        shift = np.searchsorted(first, offs, "left")
        return np.delete(flat, first), offs - shift

    def encode_text(self, text: str) -> list[int]:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        return self.encode(raw, np.array([0, len(raw)]))[0].tolist()

    def decode_ids(self, ids: list[int]) -> str:
        data, _ = self.decode(np.array(ids, np.int64), np.array([len(ids)]))
        return data.tobytes().decode(errors="replace")


def encoded(docs: DataFrame, model: Pieces, text: str = "text") -> DataFrame:
    """docs with piece_ids (array of int) and decoded (the text read back from them).

    Columns of docs that have these names already stay under a name with "_given" behind it.
    """
    taken = set(docs.columns) | {"piece_ids", "decoded"}
    for name in ("piece_ids", "decoded"):
        if name in docs.columns:
            other = f"{name}_given"
            while other in taken:
                other += "_given"
            docs, taken = docs.withColumnRenamed(name, other), taken | {other}
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by the vocabulary
    kept = docs.schema.fields
    at = [f.name for f in kept].index(text)
    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "piece_ids array<int>", "decoded string"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in parts:
            for lo, hi, data, offs in blocks(part.column(at)):
                ids, count = own.encode(data, offs)
                back, ends = own.decode(ids, count)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), pa.array(ids.astype(np.int32)))
                texts = pa.StringArray.from_buffers(hi - lo, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(back))
                some = part.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*some.columns, lists, texts], names=[*part.schema.names, "piece_ids", "decoded"])

    return docs.mapInArrow(run, ddl)


def piece_digests(docs: DataFrame, model: Pieces) -> DataFrame:
    """doc_id, n_pieces, n_byte_pieces, ids_crc32, decoded_sha256 and whether the text came back."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        schema = pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("n_byte_pieces", pa.int64()), ("ids_crc32", pa.int64()), ("decoded_sha256", pa.string()), ("round_trip", pa.bool_())])
        for part in parts:
            for lo, hi, data, offs in blocks(part.column(1)):
                ids, count = own.encode(data, offs)
                back, ends = own.decode(ids, count)
                raw, given, texts = memoryview(ids.astype("<u4").tobytes()), data.tobytes(), back.tobytes()
                sums = np.concatenate([[0], np.cumsum(count)])
                fall = np.concatenate([[0], np.cumsum(own.is_byte[ids])])[sums]
                rows = zip(sums[:-1].tolist(), sums[1:].tolist(), ends[:-1].tolist(), ends[1:].tolist(), offs[:-1].tolist(), offs[1:].tolist(), strict=True)
                found = [(zlib.crc32(raw[4 * a : 4 * b]), hashlib.sha256(t := texts[c:d]).hexdigest(), t == given[e:f]) for a, b, c, d, e, f in rows]
                yield from batches(schema, [part.column(0).slice(lo, hi - lo), count, np.diff(fall), [x[0] for x in found], [x[1] for x in found], [x[2] for x in found]])

    return only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, decoded_sha256 string, round_trip boolean")
