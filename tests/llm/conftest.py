import pytest

EDGE_TEXTS = [None, "", " \n\t ", "one", "two words", "a b c d e", "a b c d e", "é ü ñ 日本語 🎉 end", "x" * 5000, "w " * 3000]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """documents from texts (or (doc_id, text) pairs)."""

    def make(texts, schema=SCHEMA):
        pairs = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
        rows = [(i, t, ("en", "de", None)[k % 3], ("s1", None)[k % 2], len(t or "")) for k, (i, t) in enumerate(pairs)]
        return spark.createDataFrame(rows, schema).repartition(3)

    return make


def thue_morse(n, a="a", b="b"):
    """A word whose complement has the same polynomial value modulo 2**64 from 1024 letters on."""
    return "".join((a, b)[bin(i).count("1") & 1] for i in range(n))


TWINS = [thue_morse(1024), thue_morse(1024, "b", "a"), thue_morse(2048), thue_morse(2048, "b", "a"), thue_morse(8192), thue_morse(8192, "b", "a")]


@pytest.fixture
def words():
    import random

    rng = random.Random(5)
    stock = ["".join(rng.choice("abcdefghijk") for _ in range(rng.randint(2, 7))) for _ in range(3000)]
    return lambda n: [rng.choice(stock) for _ in range(n)]
