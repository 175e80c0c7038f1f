"""Operator 1: quality rules with adaptive thresholds.

Base measures come from the words of a text; thresholds come from the corpus itself. For every
(lang, source) group, and for every lang and the whole corpus as fallbacks for small groups, a
mergeable quantile sketch of each measure is kept; sketches of groups are merged into those of
languages and of the corpus. A document is rejected if a measure lies beyond the group's upper
fence: the upper quantile plus `reach` times its distance from the median. Where most documents
measure 0 that distance says nothing, so it counts as no less than one step (a symbol, a repeated
line, two windows that repeat each other) makes in the group's median document, and in the document itself.
Documents and thresholds meet in a join. Only built-in functions run.

Nulls: a null text has no words, so it fails the base rules; null lang or source form groups of
their own. Repeated rows each get a row. Empty tables give none; further columns are ignored. Long texts are
measured whole; a text may have up to 2**31 - 1 words. Ties don't matter to a fence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexstrata.llm.shared import only, stored

MEASURES = ("symbol_share", "dup_line_share", "repeat_share", "long_words")
SKETCH_K = 400
SPACES = "[\\x20\\x09-\\x0D]+"


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Windows of three words that occur again are found in two steps: 32-bit window hashes with
    their places packed into one number are sorted, neighbours with equal hashes are candidates,
    and those few are compared as strings.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = docs.select("doc_id", "lang", "source", text.alias("text"), F.array_remove(F.split(text, SPACES), "").alias("w"))
    n = F.size("w")
    packed = F.expr("""
        CASE WHEN size(w) < 4 THEN cast(array() AS array<bigint>) ELSE
        sort_array(transform(sequence(0, size(w) - 3), i -> (shiftleft(cast(hash(w[i], w[i + 1], w[i + 2]) AS bigint), 32) | i))) END""")
    lines = F.split("text", "\n")
    worded = F.filter(lines, lambda x: F.length(F.regexp_replace(x, SPACES, "")) > 0)
    first = words.select(
        "doc_id", "lang", "source", "w", n.cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size(worded) - F.size(F.array_distinct(worded))).cast("long").alias("n_dup_lines"),
        packed.alias("p"),
    )
    likely = F.expr("""
        filter(p, (x, i) -> (i > 0 AND shiftright(x, 32) = shiftright(p[i - 1], 32))
                         OR (i < size(p) - 1 AND shiftright(x, 32) = shiftright(p[i + 1], 32)))""")
    second = first.withColumn("c", likely)
    named = F.expr("sort_array(transform(c, x -> struct(concat_ws(' ', w[cast(x & 4294967295L AS int)], w[cast(x & 4294967295L AS int) + 1], w[cast(x & 4294967295L AS int) + 2]) AS g, cast(x & 4294967295L AS int) AS i)))")
    third = second.withColumn("c", F.when(F.size("c") > 0, named).otherwise(F.expr("cast(array() AS array<struct<g: string, i: int>>)")))
    twice = F.expr("""
        sort_array(transform(filter(c, (x, k) -> (k > 0 AND x.g = c[k - 1].g) OR (k < size(c) - 1 AND x.g = c[k + 1].g)), x -> x.i))""")
    fourth = third.withColumn("c", twice)
    covered = F.expr("aggregate(transform(c, (x, k) -> CASE WHEN k < size(c) - 1 THEN least(3, c[k + 1] - x) ELSE 3 END), 0L, (a, x) -> a + x)")
    return fourth.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words"))


def shares() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbol_share": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
        "dup_line_share": F.col("n_dup_lines") / F.sqrt(n),
        "repeat_share": F.col("n_repeat_words") / n,
        "long_words": F.col("word_chars") / n,
    }


def steps() -> dict[str, Column]:
    """The least by which each measure that is mostly 0 rises above it."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {"symbol_share": 1 / F.greatest(F.col("word_chars"), F.lit(1)), "dup_line_share": 1 / F.sqrt(n), "repeat_share": 6 / n}


def fences(measured: DataFrame, upper: float, least: int) -> DataFrame:
    """lang, source and for each measure its upper quantile and spread; groups of under `least` documents use their language's, or the corpus's."""
    usable = measured.where("NOT base_failed").select("lang", "source", *[c.alias(m) for m, c in shares().items()], *[c.alias(f"{m}_step") for m, c in steps().items()])
    sketched = [*MEASURES, *[f"{m}_step" for m in steps()]]
    groups = usable.groupBy("lang", "source").agg(F.count("*").alias("n"), *[F.kll_sketch_agg_double(m, SKETCH_K).alias(m) for m in sketched])
    groups = stored(groups, "sketches")  # a row for each language and source
    merged = [F.kll_merge_agg_double(m).alias(m) for m in sketched]
    langs = groups.groupBy("lang").agg(F.sum("n").alias("n"), *merged)
    corpus = groups.agg(F.sum("n").alias("n"), *merged)

    def fence(df: DataFrame, by: list[str], prefix: str) -> DataFrame:
        out = [F.col("n").alias(f"{prefix}_n")]
        quantile = lambda m, q: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double(m, F.lit(q)))
        for m in MEASURES:
            high = quantile(m, upper)
            spread = high - quantile(m, 0.5)
            out += [high.alias(f"{prefix}_high_{m}"), (F.greatest(spread, quantile(f"{m}_step", 0.5)) if m in steps() else spread).alias(f"{prefix}_spread_{m}")]
        return df.select(*by, *out)

    g, own = fence(groups, ["lang", "source"], "g"), fence(langs, ["lang"], "l").withColumnRenamed("lang", "l_lang")
    all_ = fence(corpus, [], "c").first()  # one row of numbers
    both = g.join(own, F.col("lang").eqNullSafe(F.col("l_lang")), "left")
    pick = lambda m: F.when(F.col("g_n") >= least, F.col(f"g_{m}")).when(F.col("l_n") >= least, F.col(f"l_{m}")).otherwise(F.lit(all_[f"c_{m}"]).cast("double"))
    return both.select(F.col("lang").alias("f_lang"), F.col("source").alias("f_source"), *[pick(f"{k}_{m}").alias(f"{k}_{m}") for m in MEASURES for k in ("high", "spread")])


def quality(docs: DataFrame, upper: float = 0.75, reach: float = 6.0, least: int = 100) -> DataFrame:
    """Base measures, base_failed and kept of every document."""
    measured = measures(only(docs, "doc_id", "text", "lang", "source"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = stored(measured.withColumn("base_failed", failed), "measures")
    limits, least_spread = fences(measured, upper, least), steps()
    joined = measured.join(limits, F.col("lang").eqNullSafe(F.col("f_lang")) & F.col("source").eqNullSafe(F.col("f_source")), "left")
    spread = lambda m: F.greatest(F.col(f"spread_{m}"), least_spread[m]) if m in least_spread else F.col(f"spread_{m}")
    inside = [F.coalesce(c <= F.col(f"high_{m}") + reach * spread(m), F.lit(True)) for m, c in shares().items()]
    good = inside[0]
    for x in inside[1:]:
        good = good & x
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & good).alias("kept"))
