"""Operators 5, 8, 9 against the libraries, brute force and round trips."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexstrata.llm import queries, token_counts, token_files
from lexstrata.llm.pieces import Pieces

from .conftest import EDGE_TEXTS, TWINS

PATH = queries.tokenizer_path("word_bpe_49k.json")
ODD = ["a<|endoftext|>b c", "ΑΣ ΟΔΟΣ. ́e ́", "it's Σ\tΣ I'LL 's 12 34٣", "e\ń Å", "\x1c\x1d a\x85b", "İstanbul ǅ ﬁ", "<|startoftext|>", "Word. WORD! word,,, w0rd. #$%&", "don't, can't.", "K.. Å. ſ.", "<|ENDOFTEXT|> <|StartOfText|> x<|ENDOFTEXT|>. x<|endoftext|>.", "İ. İ. i̇.", *TWINS]


def test_vocabulary():
    from lexstrata.llm.token_cache import vocabulary_size

    assert vocabulary_size(PATH) == 49_408


@pytest.mark.parametrize("bits", [1, 5, 8, 11, 16, 17, 32])
def test_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1000, dtype=np.uint64).astype(np.uint32)
    raw = token_files.pack(ids, bits)
    assert len(raw) == -(-1000 * bits // 8)
    for start, count in ((0, 1000), (3, 17), (999, 1), (500, 0)):
        assert token_files.unpack(raw, bits, start, count).tolist() == ids[start : start + count].tolist()
    if bits < 32:
        with pytest.raises(ValueError):
            token_files.pack(np.array([2**bits], np.uint32), bits)


def test_plain_files(tmp_path):
    ids = np.arange(50, dtype=np.uint32)
    made = [token_files.make_block([1, None], np.array([20, 30]), ids, 6, 0), token_files.make_block([7], np.array([0]), ids[:0], 6, 50)]
    token_files.write_file(tmp_path / "f", made)
    a, b = token_files.read_file(tmp_path / "f")
    assert a.document(1).tolist() == ids[20:].tolist() and a.null.tolist() == [0, 1] and b.read().tolist() == []


def test_token_files_match_the_library(docs_of):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(PATH)
    docs = [*enumerate(EDGE_TEXTS + ODD), (None, "no id"), (3, "same id")]
    files = token_files.token_files(docs_of(docs), token_files.library_encoder(PATH), token_files.bits_for(49_408), 2)
    got = [tuple(r) for r in token_files.token_rows(files).orderBy("start").collect()]
    want, start = [], 0
    for i, t in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, (d[1] or "").encode())):
        ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    none = docs_of([(1, "x")]).where("false")
    assert token_files.token_rows(token_files.token_files(none, token_files.library_encoder(PATH), 16, 2)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aBİıſKσΣςé\u0301\u0307.,!'<|>endoftx 7\t\x1c#$&", max_size=12) | st.sampled_from(["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "'LL", "x'S"]), max_size=6))
def test_word_ids_match_the_library(parts):
    from tokenizers import Tokenizer

    from lexstrata.llm import token_cache

    library = test_word_ids_match_the_library.__dict__.setdefault("library", Tokenizer.from_file(PATH))
    raw = np.frombuffer("".join(parts).encode(), np.uint8)
    ids, count = token_cache.shared_cache(PATH).encode(raw, np.array([0, len(raw)]))
    assert ids.tolist() == library.encode("".join(parts), add_special_tokens=False).ids and count.tolist() == [len(ids)]


def test_stretches_of_one_hash_keep_their_own_ids(monkeypatch):
    from lexstrata.llm import token_cache

    monkeypatch.setattr(token_cache, "span_hashes", lambda data, start, end: (end - start).astype(np.uint64))
    cache = token_cache.IdCache(lambda words: (np.array([w[0] for w in words], np.uint32), np.ones(len(words), np.int64)), 3)
    for _ in range(2):
        data = np.frombuffer(b"abacdeef", np.uint8)
        start, end = np.array([0, 1, 2, 3, 4, 6, 7]), np.array([1, 2, 3, 4, 6, 7, 8])
        assert cache.counts(data, start, end)[0].tolist() == list(b"abacdef")


@pytest.fixture(scope="module")
def model():
    return Pieces(queries.tokenizer_path("piece_bpe_32k.model"))


def best_score(model, text):
    """Best sum over all segmentations, by every piece at every place."""
    own = {n.replace("▁", " "): s for n, s, k in zip(model.names, model.score, model.kinds) if k in (1, 4)}
    best = [0.0] + [-1e18] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + 16) + 1):
            if text[i:j] in own:
                best[j] = max(best[j], best[i] + own[text[i:j]])
        if text[i] not in own:
            best[i + 1] = max(best[i + 1], best[i] + model.unknown)
    return best[-1]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="thean dof,\n é日🎉\x00", max_size=40))
def test_viterbi_and_round_trip(text):
    model = Pieces(queries.tokenizer_path("piece_bpe_32k.model")) if not hasattr(test_viterbi_and_round_trip, "m") else test_viterbi_and_round_trip.m
    test_viterbi_and_round_trip.m = model
    ids = model.encode_text(text)
    assert model.decode_ids(ids) == text
    if text:
        score, k = 0.0, 0
        while k < len(ids):
            if model.is_byte[ids[k]]:
                first = int(model.names[ids[k]][3:5], 16)
                score, k = score + model.unknown, k + (1 if first < 128 else 2 if first < 224 else 3 if first < 240 else 4)
            else:
                score, k = score + model.score[ids[k]], k + 1
        assert abs(score - best_score(model, " " + text)) < 1e-6


def test_many_units_equal_one_by_one(model):
    rng = np.random.default_rng(0)
    for size in (1, 7, 200):
        text = "".join(rng.choice(list("abc teh日\n"), size))
        data, offs = model.prepare(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
        start, _ = model.units(data, offs)
        assert model.encode_text(text) == [i for a, b in zip(start[:-1], start[1:]) for i in model.segment_one(data[a:b].tobytes())]
    assert model.decode_ids(model.encode_text("a▁b")) == "a b"


def test_piece_tables(docs_of, model):
    from lexstrata.llm.pieces import encoded, piece_digests

    texts = EDGE_TEXTS + TWINS
    docs = docs_of(texts)
    got = {r.doc_id: (r.piece_ids, r.decoded) for r in encoded(docs, model).collect()}
    assert got == {k: (model.encode_text(t or ""), t or "") for k, t in enumerate(texts)}
    clash = encoded(docs.withColumnRenamed("source", "decoded").withColumnRenamed("lang", "decoded_given"), model)
    assert {r.doc_id: (r.decoded, r.decoded_given_given) for r in clash.collect()} == {r.doc_id: (r.text or "", r.source) for r in docs.collect()}
    assert all(r.round_trip for r in piece_digests(docs, model).collect())
    assert piece_digests(docs.where("false"), model).count() == 0


def test_rollup_batches_are_idempotent(spark, tmp_path):
    event = "source string, lang string, version string, sign int, n_tokens long"
    make = lambda *r: spark.createDataFrame(list(r), event)
    r = token_counts.Rollup(spark, f"file://{tmp_path}/r")
    assert r.totals().count() == 0
    first = make(("a", "en", "v1", 1, 10), ("a", "en", "v1", 1, 5), (None, None, "v1", 1, 7), ("b", "de", "v1", 1, None), ("b", "de", "v1", None, 9))
    assert r.commit("b1", first) and not r.commit("b1", first)
    assert r.commit("b2", make(("a", "en", "v1", -1, 5), ("a", "en", "v2", 1, 6))) and r.commit("b3", make())
    want = {("a", "en", "v1", 1, 10), ("a", "en", "v2", 1, 6), (None, None, "v1", 1, 7), ("b", "de", "v1", 1, 0)}
    assert {tuple(x) for x in r.totals().collect()} == want
    (tmp_path / "r/data/dead").mkdir()  # a job that died before it published
    assert {tuple(x) for x in r.totals().collect()} == want and r.commit("b4", make(("b", "de", "v1", -1, 0)))
    assert not r._publish("b4", ["b4\tother"])  # a second driver with the same id comes too late
    other = token_counts.Rollup(spark, f"file://{tmp_path}/s")
    assert r.compact(other, "all") and not r.compact(other, "all")
    left = want - {("b", "de", "v1", 1, 0)}
    assert {tuple(x) for x in other.totals().collect()} == left
    assert not other.commit("b1", first) and other.commit("b5", make(("a", "en", "v2", -1, 6)))
    assert {tuple(x) for x in other.totals().collect()} == left - {("a", "en", "v2", 1, 6)}
    clash = first.selectExpr("*", "'x' AS d", "1 AS n", "2 AS d_docs")
    assert other.commit("b6", clash) and other.totals().where("version = 'v1' AND source = 'a'").first().n_docs == 3


def test_later_copies(spark):
    rows = [(1, "a", "en", b"x", 5), (2, "a", "en", b"x", 5), (2, "b", "de", b"x", 5), (None, None, None, b"x", 5), (3, "b", "de", b"y", 2), (None, "b", "de", b"z", 1), (None, "b", "de", b"z", 1)]
    got = token_counts.later_copies(spark.createDataFrame(rows, "doc_id long, source string, lang string, text_hash binary, n_tokens long")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([("a", "en", 5, 1), ("b", "de", 5, 1), (None, None, 5, 1), ("b", "de", 1, 1)], key=repr)


def test_count_query_equals_recount(spark, docs_of):
    from tokenizers import Tokenizer

    whole, texts = Tokenizer.from_file(PATH), [*EDGE_TEXTS, "a b c d e", "one"]
    docs = docs_of(texts)
    total = {}
    seen = set()
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        copy = (r.text or "") in seen
        seen.add(r.text or "")
        if copy:
            continue
        version = "word_bpe_49k+end" if r.lang == "en" else "word_bpe_49k"
        n = len(whole.encode(r.text or "", add_special_tokens=False).ids) + (r.lang == "en")
        d, t = total.get((r.source, r.lang, version), (0, 0))
        total[r.source, r.lang, version] = d + 1, t + n
    import uuid

    from lexstrata.llm.shared import shared_dir

    rollup = token_counts.Rollup(spark, f"{shared_dir(spark)}/{uuid.uuid4().hex}")
    for b, events in queries.count_events(docs, PATH).items():
        rollup.commit(b, events)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals().collect()} == total


def test_a_batch_that_comes_amid_a_compaction_counts_once(spark, tmp_path, monkeypatch):
    schema = "source string, lang string, version string, sign int, n_tokens long"
    make = lambda n: spark.createDataFrame([("a", "en", "v1", 1, n)], schema)
    one, two = token_counts.Rollup(spark, f"file://{tmp_path}/one"), token_counts.Rollup(spark, f"file://{tmp_path}/two")
    one.commit("b1", make(10))
    read = one.published

    def late():
        found = read()
        monkeypatch.setattr(one, "published", read)
        one.commit("b2", make(5))
        return found

    monkeypatch.setattr(one, "published", late)
    assert one.compact(two, "all")
    assert two.commit("b2", make(5)) and not two.commit("b1", make(10))
    assert [r.n_tokens for r in two.totals().collect()] == [15]
