"""Operator 13: shards of near equal bytes, gapless slots, splitters against exact prefix sums."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lexstrata.llm import sharding


def held(rows):
    """Bytes, and the slots, by shard."""
    size, slots = Counter(), defaultdict(list)
    for r in rows:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return size


def digests(docs, shards=16):
    return sharding.shard_digests(docs.selectExpr("*", "'x' AS shard", "1 AS slot", "2 AS size"), shards).collect()


def test_near_equal_bytes_and_gapless_slots(docs_of, words):
    texts = [" ".join(words(20 + k % 90)) for k in range(3000)]
    got = digests(docs_of(texts))
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {(k, len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t in enumerate(texts)}
    size = held(got)
    assert set(size) == set(range(16)) and {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    mean = sum(size.values()) / 16
    assert max(abs(s - mean) for s in size.values()) <= 2 * sharding.TOLERANCE * mean + max(len(t) for t in texts)


def test_a_third_of_the_rows_are_one_text(docs_of, words):
    hot = " ".join(words(60))
    texts = [hot if k % 3 == 0 else " ".join(words(60)) for k in range(3000)]
    got = digests(docs_of(texts))
    size = held(got)
    mean = sum(size.values()) / 16
    assert max(abs(s - mean) for s in size.values()) <= 0.03 * mean
    of = defaultdict(set)
    for r in got:
        of[r.text_crc32].add(r.shard)
    assert sum(len(s) > 1 for s in of.values()) <= 1  # only the hot text is cut
    assert len({r.shard for r in got if r.text_crc32 == zlib.crc32(hot.encode())}) >= 5


@pytest.mark.parametrize("texts", [[], [None], ["a"] * 5, [None, "", "x" * 100_000, "b", "b"], ["x" * 50_000] + ["y"] * 200])
def test_edges(docs_of, texts):
    docs = docs_of([(k % 3 or None, t) for k, t in enumerate(texts)])
    got = digests(docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((k % 3 or None, len(t or "") + 1, zlib.crc32((t or "").encode())) for k, t in enumerate(texts))
    held(got)
    assert all(0 <= r.shard < 16 for r in got)


def test_whole_rows_and_a_key_of_ones_own(docs_of, words):
    docs = docs_of([" ".join(words(30)) for _ in range(800)]).withColumn("shard_key", F.col("doc_id") * 3)
    out = sharding.sharded(docs, shards=4, key=F.col("doc_id"))
    assert out.columns == [*docs.columns, "shard", "slot"]
    rows = out.collect()
    assert sorted(tuple(r)[:-2] for r in rows) == sorted(tuple(r) for r in docs.collect())
    span = [[r.doc_id for r in rows if r.shard == s] for s in range(4)]
    assert all(max(a) < min(b) for a, b in zip(span, span[1:], strict=False))  # ranges of the key


def test_borders_are_those_of_prefix_sums(docs_of, words):
    docs = docs_of([" ".join(words(5 + k % 200)) for k in range(1500)])
    keys = sharding.keyed(docs).select("_size", "_key", "_tie").cache()
    rows = sorted((r._key, r._tie, r._size) for r in keys.collect())
    total, found = sum(r[2] for r in rows), sharding.borders(keys, 8)
    assert [(b.key, b.tie) for b in found] == sorted((b.key, b.tie) for b in found)
    for k, b in enumerate(found, 1):
        below = sum(s for key, tie, s in rows if (key, tie) < (b.key, b.tie))
        assert abs(below - k * total / 8) <= max(sharding.TOLERANCE * total / 8, max(r[2] for r in rows) / 2)


def test_the_main_path_has_no_python_worker(docs_of, words):
    out = sharding.shard_digests(docs_of(["a b", "c"]))
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()
