"""Operator 12 against counts in Python integers."""

import random
import re
from collections import Counter, defaultdict

import pytest

from lexstrata.llm import divergence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, least=3, ranks=200):
    groups, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        groups[lang, source].update(found)
        held[lang].update(set(found))
    out = []
    for (lang, source), c in groups.items():
        kept = [t for t, n in held[lang].items() if n >= least]
        shares = {}
        for s in [s for g, s in groups if g == lang]:
            n = sum(groups[lang, s][t] for t in kept)
            shares[s] = {t: 1 + 10**9 * (groups[lang, s][t] + 1) // (n + len(kept)) for t in kept}
        total = Counter()
        for (g, _), x in groups.items():
            total.update(x if g == lang else {})
        n = sum(total[t] for t in kept)
        p, f = shares[source], lambda p, q: (p - q) ** 2 // q
        pairs = [(s, sum(f(p[t], q[t]) for t in kept)) for s, q in shares.items() if s != source]
        of_lang = {t: 1 + 10**9 * (total[t] + 1) // (n + len(kept)) for t in kept}
        terms = [(t, f(p[t], of_lang[t])) for t in kept if c[t] and p[t] > of_lang[t]]
        for part, rows, top in (("pair", pairs, None), ("term", terms, ranks)):
            ranked = sorted(rows, key=lambda r: (-r[1], r[0].encode()))[:top]
            out += [(lang, source, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def got(spark, docs, **options):
    df = spark.createDataFrame([(k, *d) for k, d in enumerate(docs)], "doc_id long, text string, lang string, source string").selectExpr("*", "'x' AS term", "1 AS n", "2 AS docs", "'y' AS item")
    return sorted(tuple(r) for r in divergence.divergences(df.repartition(3), **options).collect())


def corpus(n, seed=2):
    rng = random.Random(seed)
    stock = ["Ünder", "ünder", "THE", "the", "слово", "Слово", "x", "Zz", "日本", "🎉", "a1b", "it's", "K"] + ["w" + chr(97 + k // 26) + chr(97 + k % 26) for k in range(200)]
    return [(" ".join(rng.choices(stock, k=rng.randint(0, 60))) + rng.choice(["", "\x00t\x7f", "\n"]), rng.choice(["de", "en", None]), rng.choice(["s1", "s2", "s3", None])) for _ in range(n)]


@pytest.mark.parametrize("ranks", [200, 5])
def test_equals_plain_counts(spark, ranks):
    docs = corpus(150)
    docs += [(None, "de", "s1"), ("", "en", "only"), ("one of a kind", "fr", "a"), (None, "fr", "b"), (None, None, None), ("the " * 5000, "en", "s1"), docs[0], docs[0]]
    assert got(spark, docs, ranks=ranks) == plain(docs, ranks=ranks)


def test_without_vocabulary_and_without_rows(spark):
    docs = [("a b", "en", "x"), ("c", "en", "y"), (None, "en", None)]
    assert got(spark, docs) == plain(docs) and {r[4] for r in got(spark, docs)} == {0}
    assert got(spark, []) == []


def test_counts_are_told_in_pieces(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "MANY", 3)
    rows = pa.table({"lang": ["en"] * 4, "source": ["a", "a", "b", "a"], "text": [b"a b c A", b"a d", b"a", b"e f g a"]}).to_batches()
    found = Counter(), Counter()
    parts = list(divergence._counted(iter(rows)))
    for b in parts:
        for r in b.to_pylist():
            found[0][r["source"], r["term"].decode()] += r["n"]
            found[1][r["source"], r["term"].decode()] += r["docs"]
    assert len(parts) > 1 and found[0]["a", "a"] == 4 and found[1]["a", "a"] == 3 and found[0]["b", "a"] == 1


def test_shares_beyond_a_long(spark):
    from pyspark.sql import functions as F

    big = 10**15
    row = spark.range(1).select(divergence.share(F.lit(big), F.lit(3 * big), F.lit(7)).alias("p")).first()
    assert row.p == 1 + 10**9 * (big + 1) // (3 * big + 7)
