"""Operator 3: benchmark decontamination by latent semantic retrieval.

1. Every text becomes a sequence of word features (bits of the hashes of lower-case words without ASCII
   punctuation), stored once.
2. Document frequencies over all documents give IDF weights of at least LEAST_WEIGHT: no feature is
   left out, however many documents hold it.
3. A randomised SVD of the TF-IDF matrix of all passages: each task adds up its part of
   A'(A R) for a random R, parts are summed by blocks of features, and the right singular
   vectors and singular values come from the sum alone (Nystroem), whose size depends on the number of
   features only. A feature's latent vector is its fold-in, its row of the singular vectors over the
   singular values, at the length of its IDF weight.
4. Passages (PASSAGE words, every STRIDE words) and windows of the benchmark's items are compared by
   cosine in the latent space. The items' windows stand in inverted lists around centroids (`Lists`); a
   passage looks into those of the nearest third of the centroids. Beside these candidates stand those of an
   exact count filter (`overlapping`): every stretch of text that shares as many words with an item as a
   leak must, whatever weights the words have; no leak of the first kind below is missed by either.
5. The longest common subsequence of the item and the text around the passage is taken over whole words
   (64-bit hashes). A leak has at least `share` of the item's words in it, in a stretch of text not much
   longer than the item, and, unless nearly all of the item is there, at least half of the item's last words
   (its answer). A paraphrase, found by its passage's cosine alone, needs PARAPHRASE_SHARE of
   the words and two thirds of the answer. An item under LEAST_WORDS words leaks where all its words stand in a row.

Items are a stated query set: they are read in blocks of MOST_ITEMS, each held against all rows.

Nulls: null and empty texts leak nothing, null or empty items match nothing, and a null doc_id or item_id
is kept as null. Repeated rows of a doc_id give one row for each item. Empty tables give no rows; further
columns are ignored. Texts are whole whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexstrata.llm.kernels import LOWER, Words, batches, blocks, strings
from lexstrata.llm.shared import dropped, only, partitions, stored

FEATURES, RANK = 1 << 14, 64
PASSAGE, STRIDE = 16, 8
LEAST_WEIGHT = 0.1
COSINE, PARAPHRASE_SHARE = 0.5, 0.45
LEAST_WORDS = 8
MOST_ITEMS = 5_000
ROWS_AT_ONCE = 4096
FOLD = LOWER.copy()
FOLD[[c for c in range(33, 127) if not chr(c).isalnum()]] = 32
LEAKS = pa.schema([("doc_id", pa.int64()), ("item", pa.int32()), ("lcs", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
LEAKS_DDL = "doc_id long, item int, lcs int, start long, end long"


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the folded words of all rows, and each row's first."""
    words = Words(FOLD[data], offs)
    return words.hashes(), words.first


def features(hashes: np.ndarray) -> np.ndarray:
    """16-bit features of words."""
    return (hashes >> np.uint64(48)).astype(np.uint16)


def featured(docs: DataFrame) -> DataFrame:
    """doc_id, words (features as bytes)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for lo, hi, data, offs in blocks(part.column(1)):
                h, first = word_hashes(data, offs)
                f = features(h)
                cells = pa.BinaryArray.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer((2 * first).astype(np.int32)), pa.py_buffer(f)])
                yield pa.RecordBatch.from_arrays([part.column(0).slice(lo, hi - lo), cells], names=["doc_id", "words"])

    return stored(only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, words binary"), "features")


def rows_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offs = strings(column)
    return np.frombuffer(data.tobytes(), np.uint16), offs // 2


def pieces_of(f: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of `width` features of each row (the last filled up with FEATURES), their rows and starts."""
    count = -(-np.diff(first) // width)
    row = np.repeat(np.arange(len(count)), count)
    start = first[row] + width * (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count))
    at = start[:, None] + np.arange(width)
    return np.where(at < first[row + 1][:, None], (f % FEATURES)[np.minimum(at, len(f) - 1)], FEATURES), row, start


def with_zero(x: np.ndarray) -> np.ndarray:
    """x with a row of zeros for the filling."""
    return np.concatenate([x, np.zeros((1, x.shape[1]), x.dtype)])


def eights(n: int, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups that begin at `begin` in stretches of eight places (n where there is none), and each one's group."""
    ends = np.append(begin[1:], n)
    count = -(-(ends - begin) // 8)
    group = np.repeat(np.arange(len(begin)), count)
    start = begin[group] + 8 * (np.arange(len(group)) - np.repeat(np.cumsum(count) - count, count))
    at = start[:, None] + np.arange(8)
    return np.where(at < ends[group][:, None], at, n), group


def frequencies(words: DataFrame) -> tuple[np.ndarray, int]:
    """Documents of each feature, and of all. A row for each feature reaches the driver."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, docs = np.zeros(FEATURES, np.int64), 0
        for part in parts:
            f, first = rows_of(part.column(0))
            row = np.repeat(np.arange(len(first) - 1), np.diff(first))
            pairs = row * FEATURES + (f % FEATURES)
            pairs.sort()
            total += np.bincount(pairs[np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]] % FEATURES, minlength=FEATURES)
            docs += len(first) - 1
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(FEATURES), -1)), pa.array(np.append(total, docs))], names=["feature", "n"])

    rows = words.select("words").mapInArrow(run, "feature long, n long").where("n > 0").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(FEATURES, np.int64)
    own = rows[rows.feature >= 0]
    out[own.feature.to_numpy()] = own.n.to_numpy()
    return out, int(rows[rows.feature < 0].n.sum())


def weights(df: np.ndarray, docs: int) -> np.ndarray:
    return np.maximum(np.log((docs + 1) / (df + 1)), LEAST_WEIGHT).astype(np.float32)


def latent_base(words: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """A latent vector for each feature: its fold-in (row of the right singular vectors of the TF-IDF matrix
    of all passages, over the singular values), scaled to its IDF weight."""
    omega = np.random.default_rng(seed).standard_normal((FEATURES, rank)).astype(np.float32)
    weighted, useful = with_zero(omega * idf[:, None]), np.append(idf > 0, False)
    group = 256

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES, rank), np.float32)
        for part in parts:
            f, first = rows_of(part.column(0))
            if not len(f):
                continue
            passages, _, _ = pieces_of(f, first, PASSAGE)
            for at in range(0, len(passages), 1 << 15):
                own = passages[at : at + (1 << 15)]
                sums = with_zero(weighted[own].sum(1))
                flat = own.ravel()
                heavy = np.flatnonzero(useful[flat])
                order = heavy[np.argsort(flat[heavy].astype(np.uint16), kind="stable")]
                # rows of one feature, in stretches of eight filled up with zeros
                names = flat[order]
                begin = np.flatnonzero(np.append(True, names[1:] != names[:-1])[: len(names)])
                at8, member = eights(len(names), begin)
                place = np.append(order // PASSAGE, len(own))
                np.add.at(total, names[begin][member], sums[place[at8]].sum(1))
        total *= idf[:, None]
        yield pa.RecordBatch.from_arrays([pa.array(range(FEATURES // group), pa.int32()), pa.array([x.tobytes() for x in total.reshape(-1, group * rank)], pa.binary())], names=["part", "sums"])

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for part in parts:
            for k, raw in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                x = np.frombuffer(raw.as_buffer(), np.float32)
                found[k] = found[k] + x if k in found else x.astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([x.astype(np.float32).tobytes() for x in found.values()], pa.binary())], names=["part", "sums"])

    ddl = "part int, sums binary"
    rows = words.select("words").mapInArrow(run, ddl).repartition(partitions(words.sparkSession), "part").mapInArrow(add, ddl).collect()  # FEATURES * RANK numbers
    y = np.zeros((FEATURES, rank))
    for r in rows:
        y[r.part * group : (r.part + 1) * group] = np.frombuffer(r.sums, np.float32).reshape(group, rank)
    core = omega.T @ y
    core = (core + core.T) / 2
    shift = 1e-6 * max(1e-12, np.trace(core) / rank)
    low = np.linalg.cholesky(core + (shift + max(0.0, -np.linalg.eigvalsh(core).min() * 1.01)) * np.eye(rank))
    u, values, _ = np.linalg.svd(np.linalg.solve(low, y.T).T, full_matrices=False)
    return (unit(u / np.maximum(values, 1e-3 * max(values[0], 1e-9))) * idf[:, None]).astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


class Lists:
    """Vectors of unit length in inverted lists around centroids."""

    def __init__(self, vectors: np.ndarray, seed: int = 3, rounds: int = 8):
        n = len(vectors)
        k = max(1, int(np.sqrt(n))) if n > 64 else 1
        self.centroids = vectors[np.random.default_rng(seed).choice(n, k, replace=False)] if n else vectors
        for _ in range(rounds if k > 1 else 0):
            own = (vectors @ self.centroids.T).argmax(1)
            sums = np.zeros_like(self.centroids)
            np.add.at(sums, own, vectors)
            held = np.linalg.norm(sums, axis=1) > 1e-6
            self.centroids = np.where(held[:, None], unit(sums), self.centroids).astype(np.float32)
        own = (vectors @ self.centroids.T).argmax(1) if n else np.zeros(0, np.int64)
        self.members = [np.flatnonzero(own == c) for c in range(len(self.centroids))]
        self.vectors = [np.ascontiguousarray(vectors[m].T) for m in self.members]
        self.probes = -(-k // 2)

    def near(self, queries: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, vector and cosine of pairs over `least`."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))]
        k = len(self.centroids)
        if self.probes < k:
            likeness = queries @ self.centroids.T
            looks = np.zeros(likeness.shape, bool)
            np.put_along_axis(looks, np.argpartition(-likeness, self.probes - 1, axis=1)[:, : self.probes], True, axis=1)
        for c in range(k):
            q = np.flatnonzero(looks[:, c]) if self.probes < k else np.arange(len(queries))
            likeness = queries[q] @ self.vectors[c]
            hit = np.flatnonzero(likeness.ravel() > least)
            if len(hit):
                m = len(self.members[c])
                out.append((q[hit // m], self.members[c][hit % m], likeness.ravel()[hit]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def item_windows(items: list[np.ndarray], base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Latent vectors of the items' windows, each one's item and place, and its features."""
    vectors, owner, place, own = [], [], [], []
    for k, f in enumerate(items):
        last = max(0, len(f) - PASSAGE)
        for at in sorted({*range(0, last + 1, STRIDE), last}):
            w = f[at : at + PASSAGE]
            vectors.append(base[w % FEATURES].sum(0))
            owner.append(k)
            place.append(at)
            own.append(w)
    return unit(np.array(vectors, np.float32)), np.array(owner), np.array(place), own


def lcs(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    return bin(lcs_bits(a, b)).count("0") - 1 if len(a) else 0


def lcs_bits(a: np.ndarray, b: np.ndarray) -> int:
    """Row of the dynamic programme after b: zero bits are the places of `a` where it grows; a one bit stands above all."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b.tolist():
        m = masks.get(x)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return v | 1 << len(a)


def fewest(n: int, share: float) -> float:
    """Words of an item of n that a leak, other than a paraphrase, has at least."""
    return n if n < LEAST_WORDS else max(LEAST_WORDS - 1, share * n)


def slack(n: int) -> int:
    """Words before and after an item of n that its stretch of text takes in."""
    return STRIDE + n // 8


def in_a_row(item: np.ndarray, text: np.ndarray) -> bool:
    n = len(item)
    return n <= len(text) and bool((np.lib.stride_tricks.sliding_window_view(text, n) == item).all(1).any())


def leaked(item: np.ndarray, text: np.ndarray, share: float, cosine: float = 0.0) -> int:
    """The common subsequence's length if the text (a stretch of little more than the item) leaks it, or 0."""
    if len(item) < LEAST_WORDS:
        return len(item) if in_a_row(item, text) else 0
    n, tail = lcs(item, text), max(3, len(item) // 5)
    if n >= fewest(len(item), share):
        return n if n >= 0.85 * len(item) or 2 * lcs(item[-tail:], text) >= tail else 0
    if cosine >= COSINE and n >= max(LEAST_WORDS - 1, PARAPHRASE_SHARE * len(item)):
        return n if 3 * lcs(item[-tail:], text) >= 2 * tail else 0
    return 0


@dataclass
class Rarest:
    """Items with stretches of up to `width` words, and where their rarest words stand."""

    width: int
    members: np.ndarray
    begin: np.ndarray  # of each 16-bit feature in `item` and `times`
    item: np.ndarray
    times: np.ndarray
    need: np.ndarray


def rarest(items: list[np.ndarray], idf: np.ndarray, share: float) -> list[Rarest]:
    """An index for `overlapping`. A leak lacks at most `spare` of its item's words, so of any part of
    the item it has all but `spare`; the part taken is that of the rarest words, which few texts hold."""
    widths: dict[int, list[int]] = {}
    for k, f in enumerate(items):
        widths.setdefault(max(64, 1 << (len(f) + 2 * slack(len(f)) - 1).bit_length()), []).append(k)
    out = []
    for width, members in widths.items():
        word, item, times, need = [], [], [], []
        for j, k in enumerate(members):
            f = items[k]
            least = int(np.ceil(fewest(len(f), share) - 1e-9))
            spare = len(f) - least
            u, n = np.unique(f, return_counts=True)
            order = np.argsort(-idf[u % FEATURES], kind="stable")
            total = np.cumsum(n[order])
            order = order[: np.searchsorted(total, spare + (least + 1) // 2) + 1]
            word.append(u[order])
            item.append(np.full(len(order), j))
            times.append(n[order])
            need.append(total[len(order) - 1] - spare)
        word, item, times = (np.concatenate(x) for x in (word, item, times))
        order = np.argsort(word, kind="stable")
        begin = np.append(0, np.cumsum(np.bincount(word, minlength=1 << 16)))
        out.append(Rarest(width, np.array(members), begin, item[order], times[order], np.array(need)))
    return out


def overlapping(f: np.ndarray, first: np.ndarray, index: list[Rarest], items: list[np.ndarray], share: float) -> Iterator[tuple[int, int, int]]:
    """Row, item and place (in f, every STRIDE words of a row) of all stretches that hold enough of the item's words for a leak.

    Rows are cut into segments of two widths, one every width, so each stretch lies whole in that of its first word.
    """
    within = np.zeros(1 << 16, bool)
    for x in index:
        held, m = np.diff(x.begin), len(x.members)
        count = -(-np.diff(first) // x.width)
        base = np.append(0, np.cumsum(count))
        row_of = np.repeat(np.arange(len(count)), count)
        for lo in range(0, len(f), 1 << 18):
            # segments that begin in these words
            a, b = (int(base[r] + -(-(y - first[r]) // x.width)) for y in (lo, min(lo + (1 << 18), len(f))) for r in [min(np.searchsorted(first, y, "right") - 1, len(count) - 1)])
            if a == b:
                continue
            row = row_of[a:b]
            start = first[row] + x.width * (np.arange(a, b) - base[row])
            end = np.minimum(start + 2 * x.width, first[row + 1])
            at = int(start[0]) + np.flatnonzero(held[f[start[0] : end[-1]]])
            # the segment that begins last before a place, and the one before it in the same row
            own = np.searchsorted(start, at, "right") - 1
            before = (own > 0) & (row[own - 1] == row[own]) & (at < end[own - 1])
            inside = at < end[own]
            pairs = np.concatenate([own[inside] << 16 | f[at[inside]], own[before] - 1 << 16 | f[at[before]]])
            pairs.sort()
            pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]]
            segment, word = pairs >> 16, pairs & 0xFFFF
            step = max(1, (1 << 21) // m)
            found = []
            for low in range(0, b - a, step):
                i, j = np.searchsorted(segment, [low, low + step])
                n = held[word[i:j]]
                places = np.repeat(x.begin[word[i:j]] - np.cumsum(n) + n, n) + np.arange(n.sum())
                shared = np.bincount(np.repeat(segment[i:j] - low, n) * m + x.item[places], x.times[places], min(step, b - a - low) * m)
                enough = np.flatnonzero(shared >= np.tile(x.need, min(step, b - a - low)))
                found.append(np.stack([enough % m, enough // m + low]))
            which, where = np.concatenate(found, 1)
            order = np.argsort(which, kind="stable")
            for k in np.unique(which).tolist():
                item = items[x.members[k]]
                within[item] = True
                n, side, least = len(item), slack(len(item)), fewest(len(item), share) - 1e-9
                for seg in where[order[slice(*np.searchsorted(which[order], [k, k + 1]))]].tolist():
                    s, e, r = int(start[seg]), int(end[seg]), int(row[seg])
                    zero, stop = int(first[r]), int(first[r + 1])
                    up = np.append(0, np.cumsum(within[f[s:e]]))
                    begin = zero if s == zero else zero + -(-(s + side - zero) // STRIDE) * STRIDE
                    p = np.arange(begin, min(stop, s + x.width + side), STRIDE)
                    enough = up[np.minimum(p + n + side, stop) - s] - up[np.maximum(p - side, zero) - s] >= least
                    for y in p[enough].tolist():
                        yield r, int(x.members[k]), y
                within[item] = False


def searcher(hashes: list[np.ndarray], base: np.ndarray, idf: np.ndarray, share: float):
    """mapInArrow function over (doc_id, text): leaks of each document."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = [features(x) for x in hashes]
        vectors, owner, place, own = item_windows(items, base)
        wide = np.full((len(own), PASSAGE), 1 << 20, np.int64)
        for k, w in enumerate(own):
            wide[k, : len(w)] = w
        heavy, padded = base.any(1), with_zero(base)
        need = np.maximum(2, np.ceil(0.2 * np.array([int(heavy[np.unique(w) % FEATURES].sum()) for w in own])))
        lists, index = Lists(vectors), rarest(items, idf, share)

        def latent(f: np.ndarray, first: np.ndarray) -> dict[tuple[int, int, int], float]:
            """Row, item and place of passages near an item's window, and their cosine."""
            halves, half_row, half_start = pieces_of(f, first, STRIDE)
            # a passage is a half and the next one of its row; a row's last half alone is one only if it is its first
            n_halves = -(-np.diff(first) // STRIDE)
            last = np.cumsum(n_halves) - 1
            together = np.ones(len(halves), bool)
            together[last[n_halves > 1]] = False
            lone = np.zeros(len(halves), bool)
            lone[last[n_halves == 1]] = True
            found: dict[tuple[int, int, int], float] = {}
            for at in range(0, len(halves), ROWS_AT_ONCE):
                end = min(at + ROWS_AT_ONCE, len(halves))
                values = padded[halves[at : end + 1]].sum(1)
                values = with_zero(values) if end == len(halves) else values
                own_rows = np.flatnonzero(together[at:end])
                sums = values[own_rows] + np.where(lone[at + own_rows], 0, 1).astype(np.float32)[:, None] * values[own_rows + 1]
                row, s = half_row[at + own_rows], half_start[at + own_rows]
                e = np.minimum(s + PASSAGE, first[row + 1])
                p, w, cosine = lists.near(unit(sums), COSINE)
                if len(p):
                    cell = s[p][:, None] + np.arange(PASSAGE)
                    text = np.where(cell < e[p][:, None], f[np.minimum(cell, len(f) - 1)], -1)
                    both = (wide[w][:, :, None] == text[:, None, :]).any(2)
                    both &= heavy[wide[w] % FEATURES]
                    ok = both.sum(1) >= need[w]
                    p, w, cosine = p[ok], w[ok], cosine[ok]
                    for key, c in zip(zip(row[p].tolist(), owner[w].tolist(), (s[p] - place[w]).tolist(), strict=True), cosine.tolist(), strict=True):
                        found[key] = max(c, found.get(key, 0.0))
            return found

        for part in parts:
            for lo, hi, data, offs in blocks(part.column(1)):
                h, first = word_hashes(data, offs)
                if not len(h):
                    continue
                f = features(h)
                near = latent(f, first)
                best: dict[tuple[int, int], tuple[int, int, int]] = {}
                for r, k, p in dict.fromkeys(chain(near, overlapping(f, first, index, items, share))):
                    n_words = len(hashes[k])
                    a = max(first[r], p - slack(n_words))
                    b = min(first[r + 1], p + n_words + slack(n_words))
                    n = leaked(hashes[k], h[a:b], share, near.get((r, k, p), 0.0))
                    if n > best.get((r, k), (0, 0, 0))[0]:
                        best[r, k] = n, int(a - first[r]), int(b - first[r])
                if best:
                    rows = pa.array([lo + k[0] for k in best])
                    yield from batches(LEAKS, [part.column(0).take(rows), [k[1] for k in best], [v[0] for v in best.values()], [v[1] for v in best.values()], [v[2] for v in best.values()]])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = 0.6) -> DataFrame:
    """doc_id, item_id, lcs (words), item_words, start_word, end_word of every leak."""
    spark = docs.sparkSession
    words = featured(docs)
    df, n = frequencies(words)
    idf = weights(df, n)
    base = latent_base(words, idf)
    dropped(words)
    texts, out, block = only(docs, "doc_id", "text"), [], []

    def search(block: list) -> DataFrame:
        items = [x for _, x in block]
        shared = spark.sparkContext.broadcast((items, base, idf))  # MOST_ITEMS items and FEATURES * RANK numbers at most

        def run(parts):
            yield from searcher(*shared.value, share)(parts)

        found = texts.mapInArrow(run, LEAKS_DDL)
        names = spark.createDataFrame([(k, i, len(x)) for k, (i, x) in enumerate(block)], "item int, item_id long, item_words int")
        return stored(found.join(names, "item").select("doc_id", "item_id", "lcs", "item_words", "start", "end"), "leaks")

    for r in only(benchmark, "item_id", "text").where("text IS NOT NULL").toLocalIterator():
        raw = np.frombuffer(r.text.encode(), np.uint8)
        h, _ = word_hashes(raw, np.array([0, len(raw)]))
        if len(h):
            block.append((r.item_id, h))
        if len(block) == MOST_ITEMS:
            out.append(search(block))
            block = []
    if block:
        out.append(search(block))
    if not out:
        return spark.createDataFrame([], "doc_id long, item_id long, lcs int, item_words int, start_word long, end_word long")
    best = F.max(F.struct("lcs", F.col("start").alias("start_word"), F.col("end").alias("end_word"))).alias("best")
    return reduce(DataFrame.unionByName, out).groupBy("doc_id", "item_id", "item_words").agg(best).select("doc_id", "item_id", "best.lcs", "item_words", "best.start_word", "best.end_word")


def decontaminated(docs: DataFrame, benchmark: DataFrame, share: float = 0.6) -> DataFrame:
    """docs without those that leak an item."""
    found = leaks(docs, benchmark, share).select("doc_id").distinct().withColumnRenamed("doc_id", "leaking")
    return docs.join(found, docs.doc_id.eqNullSafe(found.leaking), "left_anti")
