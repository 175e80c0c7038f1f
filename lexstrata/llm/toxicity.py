"""Operator 7: toxicity by a weighted lexicon.

Text is folded (case, look-alike letters of other scripts, accents, digits and signs that stand
for letters), matched with an Aho-Corasick automaton at word borders, and the weights of the
matches are summed. A lexicon entry inside an exception phrase doesn't count. The sum, divided
by a power of the text's length in words, goes through a logistic curve.

The lexicon is a small starting list plus entries found in the labelled training rows: folded
words whose share among toxic rows is far above that among the others, however small the part of
the toxic rows that holds them, so that the insults of a rare language or source count. Copies of
a text are one piece of evidence. Weights are log odds.
The curve is fitted on the same rows. Training takes at most `most_rows` labelled rows, those
with the smallest hash of doc_id; labels of other rows are never read, and neither lang, source
nor doc_id enters a score.

Nulls: a null text is an empty text, which scores as a text without matches. Rows with null
doc_id are scored like others and never used in training. Label rows with nulls are ignored; of
several labels of one doc_id the highest counts. Without usable labels (or only one class) the
starting list and a fixed curve are used. Repeated rows each get a row. Further columns of the
tables are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexstrata.llm.shared import only, stored

#: General English insults and slurs on persons; weights are replaced where the labels say more.
START = "idiot moron imbecile stupid dumb dumbass fool loser scum trash garbage worthless pathetic disgusting clown vermin filth bastard bitch asshole shithead retard scumbag pig jerk freak creep degenerate".split()
#: In these the entry is no insult.
EXCEPTIONS = ["trash can", "trash bin", "trash bag", "garbage can", "garbage collector", "garbage collection", "guinea pig", "pig iron", "clown fish", "fool proof", "dumb bell", "trash talk", "jerk chicken", "control freak"]
#: Look-alikes: letters of other scripts, signs and digits, by the Latin letter they stand for.
LOOK_ALIKES = {
    "a": "а@4αạ", "b": "ьв8β", "c": "сϲ¢", "d": "ԁ", "e": "е3є€ε", "g": "ɡ9", "h": "һн", "i": "і1|ıιl!", "j": "ј", "k": "кκ",
    "m": "м", "n": "пη", "o": "о0οø", "p": "рρ", "s": "ѕ5$", "t": "т7τ+", "u": "υц", "v": "ѵν", "w": "ѡω", "x": "хχ", "y": "уү", "z": "2ʐ",
}
BARE = "!|$@+¢€"  # stand for letters beside letters or digits; at the edges of a word perhaps
FOLD_MOST = 40  # letters kept in a folded word when learning


def fold_table() -> dict[int, str | None]:
    table: dict[int, str | None] = {}
    for latin, others in LOOK_ALIKES.items():
        for c in others:
            if c not in BARE:
                table[ord(c)] = latin
                table[ord(c.upper()[0])] = latin
    for code in range(0xC0, 0x250):
        base = unicodedata.normalize("NFKD", chr(code))[0]
        if base.isascii() and base.isalpha() and code not in table:
            table[code] = "i" if base.lower() == "l" else base.lower()
    for code in [*range(0x300, 0x370), 0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF]:
        table[code] = None
    for code in range(0xFF21, 0xFF5B):  # full width
        c = unicodedata.normalize("NFKC", chr(code)).lower()
        if c.isalpha():
            table[code] = "i" if c == "l" else c
    for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ":
        table[ord(c)] = "i" if c == "L" else c.lower()
    return table


TABLE = fold_table()
SIGNS = {ord(c): latin for latin, others in LOOK_ALIKES.items() for c in others if c in BARE}
ASCII = bytes(TABLE.get(i, chr(i)).encode()[0] if TABLE.get(i, chr(i)) else i for i in range(128)) + bytes(range(128, 256))


RUN = re.compile(f"[{re.escape(BARE)}]+")


def beside(text: str, m: re.Match) -> tuple[bool, bool]:
    """Whether a letter or digit stands before and after a run of signs."""
    return m.start() > 0 and text[m.start() - 1].isalnum(), text[m.end() : m.end() + 1].isalnum()


def fold(text: str, leading: bool = False, trailing: bool = False) -> str:
    """Lower-case skeleton of a text: look-alikes become the Latin letter, l and i are one. Runs of signs within
    words are letters, those at the start or the end of words if asked for. Places stay the same."""

    def spelled(m: re.Match) -> str:
        before, after = beside(text, m)
        return m[0].translate(SIGNS) if before and after or leading and after or trailing and before else m[0]

    if any(c in text for c in BARE):
        text = RUN.sub(spelled, text)
    if text.isascii():
        return text.encode().translate(ASCII).decode()
    return text.translate(TABLE)


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=lambda: {fold(w): 1.0 for w in START})
    exceptions: list[str] = field(default_factory=lambda: [fold(x) for x in EXCEPTIONS])
    power: float = 0.5  # of the length in words that the sum is divided by
    curve: tuple[float, float] = (-3.0, 12.0)

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for w, x in self.weights.items():
            found.add_word(w, (len(w), x))
        for w in self.exceptions:
            found.add_word(w, (len(w), 0.0))
        found.make_automaton()
        return found


def standing(text: str, automaton) -> tuple[list, list]:
    """Places and weights of the entries, and of the exceptions, that stand as words in a folded text."""
    hits, spared = [], []
    for end, (n, weight) in automaton.iter(text):
        low, high = end - n + 1, end + 1
        if not weight and text[high : high + 1] == "s":  # a plural
            high += 1
        if (low and text[low - 1].isalnum()) or (high < len(text) and text[high].isalnum()):
            continue
        (hits if weight else spared).append((low, high, weight))
    return hits, spared


def matched(text: str, automaton) -> tuple[float, int]:
    """Sum of the weights of the entries that stand as words outside exceptions, and words.

    Signs at the edges of words are read bare and as letters; the first reading counts where two find entries.
    """
    plain = fold(text)
    hits, spared = standing(plain, automaton)
    edges = {x for x in (beside(text, m) for m in RUN.finditer(text)) if x[0] != x[1]} if any(c in text for c in BARE) else ()
    for leading, trailing in ((True, False), (False, True), (True, True)):
        if edges and (not leading or (False, True) in edges) and (not trailing or (True, False) in edges):
            more, other = standing(fold(text, leading, trailing), automaton)
            hits += [x for x in more if not any(x[0] < high and low < x[1] for low, high, _ in hits)]
            spared += other
    if spared:
        hits = [x for x in hits if not any(low <= x[0] and x[1] <= high for low, high, _ in spared)]
    return sum(x[2] for x in hits), max(1, len(plain.split()))


def rated(model: Model):
    """Series of texts to the length-normalised weight sums."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = model.automaton()
        for texts in parts:
            out = np.zeros(len(texts))
            for k, t in enumerate(texts):
                if t:
                    s, n = matched(t, automaton)
                    out[k] = s / n**model.power if s else 0.0
            yield pd.Series(out)

    return F.pandas_udf(run, "double")


def score(model: Model, text):
    """Column of scores from 0 to 1."""
    a, b = model.curve
    return 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * rated(model)(text))))


def folded_words():
    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sorted({w for w in (x.strip(".,;:!?\"'()[]") for x in fold(t or "").split()) if w.isalpha() and 2 < len(w) <= FOLD_MOST}))

    return run


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-3) -> tuple[float, float]:
    """Intercept and slope by Newton's method with a small ridge."""
    X, w = np.stack([np.ones_like(x), x], 1), np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(X @ w, -30, 30)))
        h = (X * (p * (1 - p))[:, None]).T @ X + ridge * np.eye(2)
        step = np.linalg.solve(h, X.T @ (y - p) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def training(docs: DataFrame, labels: DataFrame, most_rows: int, in_training) -> DataFrame:
    """Texts and labels of the training rows, the smallest text of each doc_id. The label side is bounded by most_rows, so it is broadcast."""
    labels = only(labels, "doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(in_training(F.col("doc_id")))
    some = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    found = only(docs, "doc_id", "text").join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").cast("int").alias("toxic"))
    return stored(found.select("text", "toxic"), "training")


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = 10_000, least_rows: int = 5, least_odds: float = 3.0, in_training=lambda doc_id: F.lit(True)) -> Model:
    """Learns lexicon, weights and curve.

    most_rows: bound of the labelled sample, and so of the words that can be learned.
    least_rows, least_odds: toxic texts that a learned word stands in, and log odds, at least.
    """
    model = Model()
    rows = training(docs, labels, most_rows, in_training)
    texts = rows.distinct()
    words = texts.select("toxic", F.explode(folded_words()("text")).alias("word"))
    totals = {r.toxic: r.n for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return model
    counted = words.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0))
    found = counted.select("word", "bad", odds.alias("odds"))
    top = found.where((F.col("bad") >= least_rows) & (F.col("odds") >= least_odds)).collect()  # words of most_rows rows at most
    known = {r.word: r.odds for r in found.where(F.col("word").isin(list(model.weights))).where("bad >= 3").collect()}
    model.weights |= {r.word: float(r.odds) for r in top} | {w: max(0.0, float(x)) for w, x in known.items()}
    model.weights = {w: x for w, x in model.weights.items() if x > 0}
    scale = max(model.weights.values())
    model.weights = {w: x / scale for w, x in model.weights.items()}
    seen = rows.select("toxic", rated(model)("text").alias("x")).toPandas()  # most_rows rows of two numbers
    x, y = seen.x.to_numpy(), seen.toxic.to_numpy().astype(float)
    a, b = logistic(x, y)
    if b > 0:
        model.curve = a, b
    return model
