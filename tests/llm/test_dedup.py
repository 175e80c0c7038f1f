"""Operators 2, 4 and 6 against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from lexstrata.llm import overlap, substrings, suffixes

from .conftest import EDGE_TEXTS, TWINS


def order(i):
    return 2**63 if i is None else i


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_bytes(docs, size):
    first = {}
    rows = sorted(docs, key=lambda d: order(d[0]))
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - size + 1):
            s, at = b[p : p + size], (order(i), p)
            first[s] = min(first.get(s, at), at)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        drop = [False] * len(b)
        for p in range(len(b) - size + 1):
            if first[b[p : p + size]] < (order(i), p):
                drop[p : p + size] = [True] * size
        spans = sum(d and (k == 0 or not drop[k - 1]) for k, d in enumerate(drop))
        out.append((i, len(b), sum(drop), spans, hashlib.sha256(bytes(c for c, d in zip(b, drop) if not d)).hexdigest()))
    return sorted(out, key=repr)


def brute_words(docs, size):
    first = {}
    for i, t in docs:
        w = split(t)
        for p in range(len(w) - size + 1):
            s = tuple(w[p : p + size])
            first[s] = min(first.get(s, order(i)), order(i))
    out = []
    for i, t in docs:
        w = split(t)
        drop = [False] * len(w)
        for p in range(len(w) - size + 1):
            if first[tuple(w[p : p + size])] < order(i):
                drop[p : p + size] = [True] * size
        kept = " ".join(x for x, d in zip(w, drop) if not d)
        out.append((i, len(w), sum(drop), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture
def corpus(words):
    rng = random.Random(1)
    passage, texts = words(60), []
    for _ in range(12):
        w = words(rng.randint(20, 120))
        for _ in range(rng.randint(0, 3)):
            at, a = rng.randint(0, len(w)), rng.randint(0, 30)
            w[at:at] = passage[a : a + rng.randint(10, 40)]
        texts.append(" ".join(w))
    texts += [texts[0], texts[3], texts[3] + " tail", "head " + texts[5], "ab " * 200, "ab " * 150, "x " * 14, "y" * 260, texts[2][:300] + texts[2]]
    texts += [" ".join(x) for t in TWINS for x in (texts[0].split()[:20] + [t] + texts[1].split()[:20],)]  # differ in one long word only
    texts += ["v " * 300, "u v v " * 90 + texts[0], "v " * 200]
    return texts + EDGE_TEXTS


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_bytes(docs_of, corpus):
    docs = list(enumerate(corpus)) + [(None, corpus[4])]
    assert rows(suffixes.digests(docs_of(docs), 100)) == brute_bytes(docs, 100)


def test_bytes_over_split_shards(docs_of, corpus, monkeypatch):
    import lexstrata.llm.suffixes as s

    monkeypatch.setattr(s, "SPLIT_SLICES", 2)
    docs = list(enumerate(corpus[:21]))
    assert rows(suffixes.digests(docs_of(docs), 40)) == brute_bytes(docs, 40)


def test_crowded_anchors(docs_of, corpus, monkeypatch):
    from lexstrata.llm import superwindows

    monkeypatch.setattr(superwindows, "CROWD", 1)
    monkeypatch.setattr(superwindows, "AT_ONCE", 50)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 500)
    docs = list(enumerate(corpus)) + [(None, corpus[4]), (3, corpus[5]), (3, corpus[3]), (3, corpus[3])]
    assert rows(suffixes.digests(docs_of(docs), 40)) == brute_bytes(docs, 40)
    assert rows(substrings.digests(docs_of(docs), 13)) == brute_words(docs, 13)


def test_sizes_out_of_range(docs_of):
    with pytest.raises(ValueError):
        substrings.digests(docs_of(["x"]), 65)
    with pytest.raises(ValueError):
        suffixes.digests(docs_of(["x"]), 7)


@pytest.mark.parametrize("size", [13, 5, 40])
def test_words(docs_of, corpus, size):
    docs = list(enumerate(corpus)) + [(None, corpus[4])]
    assert rows(substrings.digests(docs_of(docs), size)) == brute_words(docs, size)


def test_cut_texts(docs_of, words):
    a, b, p = words(30), words(30), words(50)
    texts = ["  " + " ".join(a + p) + "\n", "\n".join(b) + " " + " ".join(p), " ".join(p), None, ""]
    docs = docs_of(texts).withColumnRenamed("source", "list").withColumnRenamed("lang", "doc").withColumnRenamed("n_chars", "rid")
    out = substrings.deduplicated(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {0: texts[0], 1: "\n".join(b) + " ", 3: None, 4: ""}


def test_empty_tables(docs_of):
    none = docs_of([("1", "x")], "doc_id string, text string, lang string, source string, n_chars long").selectExpr("cast(doc_id AS long) AS doc_id", "text", "'z' AS list", "1 AS doc").where("false")
    assert suffixes.digests(none).count() == 0 and substrings.digests(none).count() == 0 and overlap.similarity_components(none).count() == 0


@pytest.mark.parametrize("text", [b"banana", b"mississippi" * 40, b"\0\0\0\0", bytes(np.random.default_rng(0).integers(0, 3, 700, dtype=np.uint8)), b"a"])
def test_suffix_array_and_prefixes(text):
    codes = np.frombuffer(text, np.uint8).astype(np.int32) + 1
    got = suffixes.suffix_array(codes)
    assert got.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    lcp = suffixes.common_prefixes(codes, got, 100, lane=16)

    def common(a, b):
        n = 0
        while n < 100 and n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    assert lcp.tolist() == [0] + [common(text[a:], text[b:]) for a, b in zip(got[:-1], got[1:])]


def brute_components(docs, n, percent):
    sets = []
    for _, t in docs:
        w = split(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(docs):
        least[find(k)] = min(least.get(find(k), order(i)), order(i))
    shown = lambda x: None if x == 2**63 else x
    return sorted(((i, len(sets[k]), shown(least[find(k)]) if sets[k] else i) for k, (i, _) in enumerate(docs)), key=repr)


def near(rng, words, w, share):
    return [words(1)[0] if rng.random() < share else x for x in w]


@pytest.fixture
def families(words):
    rng, texts = random.Random(3), list(EDGE_TEXTS)
    for size, share in ((2, 0.01), (5, 0.02), (60, 0.015), (6, 0.05)):
        base = words(rng.randint(60, 150))
        texts += [" ".join(near(rng, words, base, share)) for _ in range(size)]
    texts += [" ".join(words(40)) for _ in range(10)] + [texts[12].upper(), texts[20]]
    return texts


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_components(docs_of, families, n, percent):
    docs = list(enumerate(families)) + [(None, families[30]), (None, "alone and null here")]
    assert rows(overlap.similarity_components(docs_of(docs), n, percent)) == brute_components(docs, n, percent)


def test_components_over_parts(docs_of, families, monkeypatch):
    monkeypatch.setattr(overlap, "MOST_SHINGLES", 700)
    docs = list(enumerate(families))
    assert rows(overlap.similarity_components(docs_of(docs))) == brute_components(docs, 4, 85)


def test_words_that_look_alike_do_not_link(docs_of):
    docs = [(k, t) for k, t in enumerate(TWINS)] + [(9, TWINS[0])]
    assert rows(overlap.similarity_components(docs_of(docs))) == brute_components(docs, 4, 85)


def test_long_lists_over_tasks(docs_of, families, monkeypatch):
    monkeypatch.setattr(overlap, "SHORT_LIST", 2)
    docs = list(enumerate(families))
    assert rows(overlap.similarity_components(docs_of(docs))) == brute_components(docs, 4, 85)


@pytest.mark.parametrize("least", [1, 2, 3, 5])
def test_heap_merge(least):
    rng = random.Random(least)
    for _ in range(200):
        lists = [sorted(rng.sample(range(12), rng.randint(0, 9))) for _ in range(rng.randint(0, 6))]
        want = [(v, n) for v in range(12) if (n := sum(v in x for x in lists)) >= least]
        assert list(overlap.heap_merged(lists, least)) == want


def test_components_of_edges(spark):
    from lexstrata.llm.components import components

    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(1000, 1200)] + [(rng.randrange(5000, 5400), rng.randrange(5000, 5400)) for _ in range(150)] + [(3, 3), (None, 5)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    assert {tuple(r) for r in components(df).collect()} == {(i, find(i)) for i in list(root)}
    assert components(df.where("false")).count() == 0


def test_divide_skip_is_exact():
    rng = np.random.default_rng(2)
    base = [rng.integers(0, 2**60, 80).astype(np.uint64) for _ in range(4)]
    sets = [np.unique(np.where(rng.random(80) < 0.06, rng.integers(0, 2**60, 80).astype(np.uint64), base[k % 4])) for k in range(60)] + [np.array([7], np.uint64), np.array([7], np.uint64)]
    got = overlap.divide_skip(sets, 85)
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    assert got.tolist() == root


def test_few_rows_that_no_key_equals_are_marked(docs_of):
    from lexstrata.llm.shared import marked

    spark = docs_of([]).sparkSession
    rows = spark.range(20_000).selectExpr("nullif(id, 0) AS doc", "id * 7 AS rid", "'x' AS text")
    told = marked(rows, rows.where("doc IS NULL OR rid % 91 = 0").select("doc", "rid"), "doc", "rid")
    assert told.columns == ["doc", "rid", "text", "maybe"] and told.where("maybe IS NULL").count() == 0
    assert told.where("(doc IS NULL OR rid % 91 = 0) AND NOT maybe").count() == 0 and told.where("maybe").count() < 1600
    assert marked(rows, rows.where("false").select("doc", "rid"), "doc", "rid").where("maybe").count() == 0


def test_texts_outside_all_components_are_not_turned_into_sets(docs_of, monkeypatch):
    made = docs_of([]).sparkSession.sparkContext.accumulator(0)
    spy = overlap.set_maker

    def counting(n):
        run = spy(n)

        def counted(parts):
            for part in parts:
                made.add(part.num_rows)
                yield from run([part])

        return counted

    shuffled = []
    by_key = overlap.sets_of
    monkeypatch.setattr(overlap, "set_maker", counting)
    monkeypatch.setattr(overlap, "sets_of", lambda docs, nodes, n: (shuffled.append(1), by_key(docs, nodes, n))[1])
    docs = [(i, " ".join(f"w{i}_{k}" for k in range(40))) for i in range(50)] + [(100 + i, " ".join(["same"] * 9 + [f"x{k}" for k in range(60)] + [f"y{i}"])) for i in range(3)]
    assert rows(overlap.similarity_components(docs_of(docs))) == brute_components(docs, 4, 85)
    assert made.value == 3 and shuffled == [1]


def test_texts_that_surely_stay_skip_the_join(docs_of, words, monkeypatch):
    import corpus_pipeline

    real, met = corpus_pipeline.marked, []

    def spy(*x):
        met.append(real(*x))
        return met[-1]

    monkeypatch.setattr(corpus_pipeline, "marked", spy)
    a, b = " ".join(words(40)), " ".join(words(40))
    docs = docs_of([(5, a), (3, a), (None, a), (7, b), (None, b), (9, None)] + [(100 + i, " ".join(words(30))) for i in range(60)])
    out = corpus_pipeline.one_of_each_group(docs.sparkSession, docs, "")
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [3, 7, 9, *range(100, 160)]
    assert met[0].where("maybe").count() <= 5


def test_texts_without_repeats_skip_the_join_with_their_lists(docs_of, words, monkeypatch):
    from lexstrata.llm import superwindows

    real, met = superwindows.marked, []

    def spy(*x):
        met.append(real(*x))
        return met[-1]

    monkeypatch.setattr(superwindows, "marked", spy)
    a = " ".join(words(40))
    docs = [(5, a), (3, a), (None, a), (9, None)] + [(100 + i, " ".join(words(30))) for i in range(60)]
    found = sorted((tuple(r) for r in substrings.digests(docs_of(docs)).collect()), key=repr)
    assert found == brute_words(docs, 13)
    assert met and all(m.where("maybe").count() <= 5 for m in met)


def test_texts_without_repeated_bytes_skip_both_joins(docs_of, words, monkeypatch):
    from lexstrata.llm import superwindows

    real, met = superwindows.marked, []

    def spy(*x):
        met.append(real(*x))
        return met[-1]

    monkeypatch.setattr(superwindows, "marked", spy)
    a = " ".join(words(40))
    docs = [(5, a), (3, a), (None, a), (9, None)] + [(100 + i, " ".join(words(30))) for i in range(60)]
    assert rows(suffixes.digests(docs_of(docs))) == brute_bytes(docs, 100)
    assert len(met) == 2 and all(m.where("maybe").count() <= 5 for m in met)


def test_shuffles_of_bytes_are_dropped_before_texts_are_dealt_again(docs_of, monkeypatch):
    real, let_go, steps = suffixes.stored, suffixes.released, []
    monkeypatch.setattr(suffixes, "stored", lambda df, name: (steps.append(name), real(df, name))[1])
    monkeypatch.setattr(suffixes, "released", lambda spark: (steps.append("released"), let_go(spark))[1])
    docs = [(k, "abcdefgh" * 20) for k in range(3)]
    assert rows(suffixes.digests(docs_of(docs))) == brute_bytes(docs, 100)
    assert "released" in steps[steps.index("classes") :]


def test_anchors_without_context_in_common_are_not_asked_about(docs_of):
    from lexstrata.llm.superwindows import ASKED, keyed, superwindows

    rng = random.Random(4)
    some = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    asked = lambda n: superwindows(keyed(docs_of([some(90) + p + some(90) for p in [some(n)] * 20])), suffixes.finder(100), False, False, suffixes.same_strings(100)).where(f"kind >= {ASKED}").count()
    assert asked(60) == 0 and asked(105) > 0


@pytest.mark.parametrize("size", [8, 33, 46, 48, 100])
def test_passages_about_as_long_as_a_string(docs_of, size):
    rng = random.Random(size)
    some = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    docs = []
    for n in (size - 2, size - 1, size, size + 1, size + 9, 2 * size):
        for _ in range(4):
            p = some(n)
            docs += [(len(docs) + k, some(before) + p + some(after)) for k, (before, after) in enumerate([(0, 70), (70, 0), (1, 1), (50, 60)])]
    assert rows(suffixes.digests(docs_of(docs), size)) == brute_bytes(docs, size)


def test_prefixes_and_pairs_go_once_they_are_read(docs_of, monkeypatch):
    made, gone = [], []
    monkeypatch.setattr(overlap, "stored", lambda df, name, keep=overlap.stored: (made.append(name), keep(df, name))[1])
    monkeypatch.setattr(overlap, "dropped", lambda *tables, drop=overlap.dropped: (gone.extend(t._lexstrata_path.rsplit("/", 1)[1] for t in tables), drop(*tables)))
    found = overlap.similarity_components(docs_of([(1, "a b c d e"), (2, "a b c d e"), (3, "x y z v w")]))
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(1, 1), (2, 1), (3, 3)]
    assert {"listed", "pairs", "groups", "links", "nodes"} <= set(gone) and "labels" in gone and made.count("records") == 2 and gone.count("records") == 1
