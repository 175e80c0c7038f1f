"""Columns with clashing names, repeated rows, nulls and very long texts: the same results as without them."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexstrata.llm import chat, kernels, leaks, overlap, queries, quality, substrings, suffixes, token_counts, token_files, toxicity
from lexstrata.llm.pieces import Pieces, piece_digests

from .conftest import EDGE_TEXTS

CLASHING = ["name", "content", "kind", "doc", "rid", "list", "node", "label", "words", "span", "token", "n", "n_tokens", "text_hash", "prefix", "turns", "copies", "score", "hot_key", "start", "end", "item", "leaking", "gone", "c0", "fence", "value"]
PATH = queries.tokenizer_path("word_bpe_49k.json")


@pytest.fixture
def corpus(docs_of, words):
    base = [" ".join(words(70)) for _ in range(6)]
    texts = EDGE_TEXTS + base + [base[0], base[1] + " tail", "you idiot " + base[2], "TEXT " * 400]
    docs = [*enumerate(texts), (3, texts[3]), (12, texts[12]), (12, base[3]), (None, base[4]), (None, None)]
    return docs_of(docs)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["quality", "suffixes", "overlap", "files", "substrings", "toxicity", "pieces", "counts", "leaks"])
def test_clashing_names_change_nothing(spark, corpus, name):
    wide = corpus.select("*", *[F.lit(f"x{k}").alias(c) for k, c in enumerate(CLASHING)])
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine")], "item_id long, text string")
    model = Pieces(queries.tokenizer_path("piece_bpe_32k.model")) if name == "pieces" else None
    run = {
        "quality": lambda d: quality.quality(d), "suffixes": lambda d: suffixes.digests(d), "overlap": lambda d: overlap.similarity_components(d), "substrings": lambda d: substrings.digests(d),
        "files": lambda d: token_files.token_rows(token_files.token_files(d, token_files.library_encoder(PATH), 16, 2)), "toxicity": lambda d: d.select("doc_id", toxicity.score(toxicity.Model(), F.col("text"))),
        "pieces": lambda d: piece_digests(d, model), "counts": lambda d: token_counts.counted(d, PATH), "leaks": lambda d: leaks.leaks(d, bench),
    }[name]
    got = rows(run(wide))
    assert got == rows(run(corpus)) and (len(got) == corpus.count() or name == "leaks")


def test_stages_keep_clashing_columns(spark, corpus, tmp_path):
    spark.createDataFrame([(k, int(k % 2)) for k in range(8)], "doc_id long, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one two three four five six seven eight nine")], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    wide = corpus.select("*", *[F.lit(f"x{k}").alias(c) for k, c in enumerate(CLASHING)])
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.one_of_each_group, corpus_pipeline.cut_repeats, corpus_pipeline.drop_leaks):
        out = stage(spark, wide, f"file://{tmp_path}")
        assert out.columns == wide.columns
        got = out.collect()
        assert 0 < len(got) <= corpus.count() and all(r[c] == f"x{k}" for r in got for k, c in enumerate(CLASHING))


def test_chat_with_clashing_names(spark):
    t = spark.createDataFrame([(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (2, 0, "user", "hi"), (3, 0, "user", "b"), (3, 0, "user", "a"), (4, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    wide = t.select("*", *[F.lit("x").alias(c) for c in ("hash", "hashes", "prefixes", "whole", "first", "turns", "slots", "texts")])
    got = rows(chat.maximal_conversations(wide))
    assert got == rows(chat.maximal_conversations(t)) and [r[0] for r in got] == [2, 3]


def test_texts_over_a_block(docs_of, words, monkeypatch):
    from .test_dedup import brute_bytes, brute_components, brute_words

    monkeypatch.setattr(kernels, "BLOCK_BYTES", 300)
    monkeypatch.setattr(kernels.blocks, "__defaults__", (300,))
    long = " ".join(words(400))
    docs = list(enumerate([long, long[:1500], "x " + long, " ".join(words(30)), long]))
    df = docs_of(docs)
    assert rows(substrings.digests(df)) == brute_words(docs, 13) and rows(suffixes.digests(df)) == brute_bytes(docs, 100)
    assert rows(overlap.similarity_components(df)) == brute_components(docs, 4, 85)


def test_toxicity_against_plain_search(spark):
    """Scores against a search for every entry at every place of the folded text."""
    rng = random.Random(8)
    model = toxicity.Model(weights={"foo": 1.0, "bar baz": 0.5, "qux": 0.25}, exceptions=["no foo", "qux farm"], power=0.5, curve=(-1.0, 3.0))
    stock = ["foo", "F00", "fоо", "bar", "baz", "qux", "farm", "farms", "no", "food", "a", "the", "QUX"]
    texts = [" ".join(rng.choice(stock) for _ in range(rng.randint(1, 12))) for _ in range(200)]

    def plain(text):
        folded = toxicity.fold(text)
        stands = lambda w, plural=False: [m.span() for m in re.finditer(f"(?<![a-z0-9])(?={re.escape(w)}{'s?' if plural else ''}(?![a-z0-9]))", folded)]
        spared = [(a, a + len(w) + (folded[a + len(w) : a + len(w) + 1] == "s")) for w in model.exceptions for a, _ in stands(w, True)]
        total = sum(x for w, x in model.weights.items() for a, _ in stands(w) if not any(p <= a and a + len(w) <= q for p, q in spared))
        return total / max(1, len(folded.split())) ** 0.5

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select("doc_id", toxicity.rated(model)("text").alias("x"))
    got = {r.doc_id: r.x for r in df.collect()}
    assert all(abs(got[k] - plain(t)) < 1e-9 for k, t in enumerate(texts)) and sum(v > 0 for v in got.values()) > 50
