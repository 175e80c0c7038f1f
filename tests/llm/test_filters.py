"""Operators 1, 3, 7, 10, the SQL of all and the pipeline."""

import os
import random
import re

import numpy as np
import pytest

from lexstrata.llm import chat, leaks, quality, toxicity

from .conftest import EDGE_TEXTS

DATA = "/root/testdata/sf0.001"


def base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    places = {}
    for i in range(len(w) - 2):
        places.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(covered)


def test_quality_measures(docs_of, words):
    rng = random.Random(4)
    texts = [*EDGE_TEXTS, "a\nb\na\n\n\n b\nb", "#1 <b> & %%", "a b c a b c a b", "a a a a", "x y z x y z"]
    for _ in range(20):
        w = words(rng.randint(3, 90))
        w += w[: rng.randint(0, len(w))]
        texts.append("".join(x + rng.choice([" ", "\n", "  ", "\t"]) for x in w))
    got = {r.doc_id: r for r in quality.quality(docs_of(texts)).collect()}
    for k, t in enumerate(texts):
        r, want = got[k], base(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, t
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_quality_rejects_outliers_and_keeps_the_rest(docs_of, words):
    texts = [" ".join(words(80)) for _ in range(60)] + [" ".join(f"{x}###$$" for x in words(80))]
    kept = {r.doc_id for r in quality.quality(docs_of(texts)).where("kept").collect()}
    assert kept == set(range(60))
    assert quality.quality(docs_of(texts).where("false")).count() == 0


def test_quality_fences_follow_the_source(spark, words):
    rng = random.Random(6)
    marked = lambda n: " ".join(words(80) + ["#"] * n)
    long = lambda n: " ".join(x * n for x in words(80))
    rows = [(marked(0), "prose") for _ in range(150)] + [(marked(rng.randint(5, 20)), "code") for _ in range(150)] + [(long(rng.choice([1, 2, 3])), "terms") for _ in range(150)]
    # the same measure in two sources: 12 symbols (a share of 0.03), words of 9 letters on average
    rows += [(marked(12), "prose"), (marked(12), "code"), (long(2), "prose"), (long(2), "terms")]
    docs = spark.createDataFrame([(k, t, "en", s, len(t)) for k, (t, s) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in quality.quality(docs).where("kept").collect()}
    assert kept == set(range(len(rows))) - {450, 452}


def test_leaks(spark, docs_of, words):
    items = [words(n) for n in (12, 20, 45)]
    texts = [" ".join(words(150)) for _ in range(60)]
    for k, item in enumerate(items):
        w = texts[k].split()
        w[20 + 7 * k : 20 + 7 * k] = item
        texts[k] = " ".join(w)
    other = items[2][:]
    for at in (3, 11, 19, 27):
        other[at] = "changed"
    texts[10] = "Start. " + ", ".join(other).upper()
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)] + [(8, None), (9, "too short"), (None, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.leaks(docs_of(texts + EDGE_TEXTS), bench).collect()}
    assert got == {(0, 0), (1, 1), (2, 2), (10, 2)}
    left = {r.doc_id for r in leaks.decontaminated(docs_of(texts), bench).collect()}
    assert left == set(range(60)) - {0, 1, 2, 10}
    assert leaks.leaks(docs_of(texts).where("false"), bench).count() == 0 and leaks.leaks(docs_of(texts), bench.where("false")).count() == 0


def test_leaks_of_common_items(spark, docs_of, words):
    items = [words(n) for n in (10, 14, 34, 60)]
    texts = [" ".join(words(60) + (items[k // 3 % 4] if k % 3 == 0 else []) + words(50)) for k in range(240)]
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    # each item in a twelfth of the documents, then all of them in a third
    assert {(r.doc_id, r.item_id) for r in leaks.leaks(docs_of(texts), bench).collect()} == {(k, k // 3 % 4) for k in range(0, 240, 3)}
    texts = [" ".join(words(60) + (sum(items, []) if k % 3 == 0 else []) + words(50)) for k in range(240)]
    assert {(r.doc_id, r.item_id) for r in leaks.leaks(docs_of(texts), bench).collect()} == {(k, i) for k in range(0, 240, 3) for i in range(4)}
    # long documents, in which every word is common
    texts = [" ".join(words(1500) + (items[k] if k < 4 else []) + words(1500)) for k in range(60)]
    assert {(r.doc_id, r.item_id) for r in leaks.leaks(docs_of(texts), bench).collect()} == {(k, k) for k in range(4)}


def test_leaks_of_short_items_and_paraphrases(spark, docs_of, words):
    item = words(40)
    half = [w if k % 2 or k > 31 else words(1)[0] for k, w in enumerate(item)]  # 24 of 40 words stay, the answer whole
    texts = [" ".join(words(90)) for _ in range(40)]
    texts[3] = " ".join(words(30) + ["quark", "Lepton,", "boson"] + words(30))
    texts[4] = " ".join(words(30) + ["quark", "boson", "lepton"] + words(30))
    texts[5] = " ".join(words(30) + half + words(30))
    bench = spark.createDataFrame([(1, "quark lepton boson"), (2, " ".join(item))], "item_id long, text string")
    docs = docs_of(texts).withColumnRenamed("source", "leaking").withColumnRenamed("lang", "item").withColumnRenamed("n_chars", "words")
    assert {(r.doc_id, r.item_id) for r in leaks.leaks(docs, bench).collect()} == {(3, 1), (5, 2)}
    left = leaks.decontaminated(docs, bench)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == set(range(40)) - {3, 5}
    import numpy as np

    a, b = np.arange(40, dtype=np.uint64), np.arange(40, dtype=np.uint64)
    b[np.arange(0, 32, 2)] += 100
    b[[1, 3]] += 100  # 22 of 40 are left: only a near passage makes it a leak
    assert leaks.leaked(a, b, 0.6) == 0 and leaks.leaked(a, b, 0.6, leaks.COSINE) == 22
    b[-4:] += 100
    assert leaks.leaked(a, b, 0.6, leaks.COSINE) == 0


def test_lists_find_near_vectors():
    import numpy as np

    rng = np.random.default_rng(1)
    x = leaks.unit(rng.standard_normal((900, 64)).astype(np.float32))
    q = leaks.unit(np.concatenate([x[:300] + 0.08 * rng.standard_normal((300, 64)), rng.standard_normal((300, 64))]).astype(np.float32))
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(q @ x.T > leaks.COSINE))}
    a, b, c = leaks.Lists(x).near(q, leaks.COSINE)
    got = set(zip(a.tolist(), b.tolist()))
    assert got <= want and len(got) >= 0.9 * len(want) > 200 and np.allclose(c, (q[a] * x[b]).sum(1), atol=1e-5)
    assert [len(z) for z in leaks.Lists(x[:0]).near(q, 0.5)] == [0, 0, 0]


def test_leaks_recall_against_brute_force(spark, docs_of, words):
    import numpy as np

    rng = random.Random(9)
    items = [words(rng.randint(15, 59)) for _ in range(60)]
    texts = []
    for k in range(360):  # a third verbatim, a third with 20%, a third with 38% of the words substituted
        changed = [rng.choice(words(1)) if rng.random() < (0, 0.2, 0.38)[k % 3] else w for w in items[k // 6]]
        texts.append(" ".join(words(rng.randint(0, 80)) + changed + words(rng.randint(0, 80))))
    seq = lambda t: leaks.word_hashes(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0]
    want = set()
    for k, t in enumerate(texts):
        f, item = seq(t), seq(" ".join(items[k // 6]))
        side = leaks.STRIDE + len(item) // 8
        if any(leaks.leaked(item, f[max(0, p - side) : p + len(item) + side], 0.6) for p in range(0, len(f), leaks.STRIDE)):
            want.add((k, k // 6))
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    assert len(want) > 280 and want <= {(r.doc_id, r.item_id) for r in leaks.leaks(docs_of(texts), bench).collect()}


def test_lcs():
    import numpy as np

    def slow(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.integers(0, 6, rng.integers(0, 30)), rng.integers(0, 6, rng.integers(0, 30))
        assert leaks.lcs(a, b) == slow(a.tolist(), b.tolist())


def test_folding_and_exceptions():
    model = toxicity.Model()
    hits = lambda t: toxicity.matched(t, model.automaton())[0] > 0
    assert all(hits(t) for t in ("you idiot.", "1d10t", "ІDIОT", "tr@sh talk? no, trash", "ｍoron", "l0ser", "(stupid)"))
    assert not any(hits(t) for t in ("idiotic", "trash can", "the trash bags", "guinea pig", "", "1 2 3"))


def test_signs_at_edges_and_in_runs():
    model = toxicity.Model()
    score = lambda t: toxicity.matched(t, model.automaton())[0]
    assert all(score(t) == 1 for t in ("a$$hole", "@sshole", "$tupid", "@$$hole!", "you @sshole, no", "idiot!!", "$cum!", "idio+", "!diot"))
    assert score("$tupid idiot! @sshole") == 3
    assert not any(score(t) for t in ("$5", "a+", "$$$", "wow!", "+rash can", "idiotic!"))


def test_toxicity_learns_and_holds_out(spark, docs_of, words):
    texts = [" ".join([*words(40), *(["zorgbag"] * (k % 4 == 0)), *words(20)]) for k in range(200)] + EDGE_TEXTS
    docs = docs_of(texts)
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(200)] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, in_training=lambda i: i % 5 != 0)
    got = {r.doc_id: r.s for r in docs.select("doc_id", toxicity.score(model, docs.text).alias("s")).collect()}
    assert all((got[k] >= 0.5) == (k % 4 == 0) for k in range(200))
    assert all(0 <= s < 0.5 for k, s in got.items() if k >= 200)
    plain = toxicity.fit(docs, labels.where("false"))
    assert plain.weights == toxicity.Model().weights


def test_toxicity_learns_rare_insults(spark, docs_of, words):
    insults = ["zor" + a + b for a in "abcdefghkmnopqr" for b in "abcdefghkmnopqr"]  # 225, each in six toxic texts
    toxic = [" ".join(words(20) + [insults[(3 * k + i) % 225] for i in range(3)]) for k in range(450)]
    toxic += [" ".join([*words(20), "malquez", *words(5)]) for _ in range(8)]  # under 2% of them
    copied = " ".join(["copied", *words(20)])
    texts = toxic + [copied] * 30 + [" ".join(words(25)) for _ in range(1000)]
    docs = docs_of(texts)
    labels = spark.createDataFrame([(k, int(k < len(toxic) + 30)) for k in range(len(texts))], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert {*map(toxicity.fold, insults), "maiquez"} <= set(model.weights)
    assert "copied" not in model.weights  # one text, whatever its copies
    got = {r.doc_id: r.s for r in docs.select("doc_id", toxicity.score(model, docs.text).alias("s")).collect()}
    assert all(got[k] >= 0.5 for k in range(len(toxic))) and all(got[k] < 0.5 for k in range(len(toxic) + 30, len(texts)))


def test_chat(spark):
    turn = "conv_id long, turn long, role string, text string"
    t = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (4, 0, "user", "hi"), (4, 1, "assistant", "no"), (5, 0, "user", None), (6, 0, "user", ""), (None, 0, "user", "hi"), (None, 1, "assistant", "yo"), (2, 1, "assistant", "yo")]
    got = {r.conv_id: (r.n_turns, r.rendered) for r in chat.maximal_conversations(spark.createDataFrame(t, turn)).collect()}
    assert set(got) == {2, 4, 5, 6} and got[2] == (2, "<|user|>\nhi\n<|end|>\n<|assistant|>\nyo\n<|end|>\n")
    assert chat.maximal_conversations(spark.createDataFrame([], turn)).count() == 0
    assert [r.conv_id for r in chat.maximal_conversations(spark.createDataFrame([(None, 0, "user", "x")], turn)).collect()] == [None]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_sql(spark):
    import duckdb

    from lexstrata.llm.queries import ORACLES, QUERIES

    c = duckdb.connect()
    for t in ("documents", "conversations"):
        c.execute(f"CREATE VIEW {t} AS FROM '{DATA}/{t}.parquet'")
    for name, sql in ORACLES.items():
        got, want = QUERIES[name](spark, DATA).toPandas(), c.execute(sql).fetchdf()
        names = sorted(want.columns)
        assert sorted(got.columns) == names
        assert sorted(got[names].itertuples(index=False, name=None)) == sorted(want[names].itertuples(index=False, name=None)), name


def test_pipeline(spark, docs_of, words, tmp_path):
    import corpus_pipeline

    copy, passage, item = words(120), words(60), words(40)
    near = copy[:]
    near[60] = "other"
    plain = [" ".join(words(90)) for _ in range(40)]
    texts = [" ".join(copy), " ".join(copy), " ".join(near), " ".join(words(80) + passage), " ".join(words(70) + passage), " ".join(words(50) + item + words(30)), " ".join(words(40) + ["idiot", "moron", "scum"] + words(9)), None, "", *plain]
    toxic = [" ".join(words(30) + ["idiot", "scum"]) for _ in range(20)]
    docs_of(texts + toxic).write.parquet(f"{tmp_path}/documents.parquet")
    first = len(texts)
    spark.createDataFrame([(k, 1, int(k >= first)) for k in range(9, first + 20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, " ".join(item))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(rows) == {0, 3, 4, 7, 8, *range(9, first)}
    assert rows[0].text == texts[0] and rows[3].text == texts[3] and rows[7].text is None
    assert rows[4].text.split() == texts[4].split()[:70]
    assert all(rows[k].text == texts[k] and rows[k].decoded == texts[k] for k in range(9, first))


def test_recall_of_paraphrases(spark):
    """Items of 20 to 50 words of which about half are kept in order, the last fifth whole, the others replaced by chance words."""

    rng = random.Random(23)
    stock = [f"{''.join(rng.choice('abcdefghijklm') for _ in range(rng.randint(2, 8)))}{k}" for k in range(4000)]
    weights = [1 / (k + 3) for k in range(4000)]
    words = lambda n: rng.choices(stock, weights, k=n)
    items, docs, planted = [], [], set()
    for k in range(250):
        item = words(rng.randint(20, 50))
        n, tail = len(item), max(3, len(item) // 5)
        kept = {*rng.sample(range(n - tail), max(0, round(rng.uniform(0.46, 0.59) * n) - tail)), *range(n - tail, n)}
        text = [x if i in kept else words(1)[0] for i, x in enumerate(item)]
        number = {w: j for j, w in enumerate(dict.fromkeys(item + text))}
        common = leaks.lcs(np.array([number[x] for x in item]), np.array([number[x] for x in text]))
        if leaks.PARAPHRASE_SHARE * n <= common < 0.6 * n:
            planted.add(k)
        items.append((k, " ".join(item)))
        docs.append((k, " ".join(words(rng.randint(30, 200)) + text + words(rng.randint(30, 200)))))
    docs += [(1000 + k, " ".join(words(rng.randint(50, 400)))) for k in range(200)]
    found = leaks.leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert len(planted) > 200 and len({k for k in planted if (k, k) in got}) >= 0.9 * len(planted)
    assert all(d == i for d, i in got)
