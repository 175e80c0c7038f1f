"""Operator 12: how far sources of one language diverge in their words.

Plain relational work. Matches of the term pattern are counted by language, source and term,
with the number of documents that hold the term beside them, so one exchange serves both; a task counts the matches of
its rows before they are exchanged, without making a row of each. The terms in enough documents of
a language are its vocabulary. Groups (lang, source) are crossed with their language's vocabulary, which makes
absent terms zeros; the dense table joins itself on lang and term (each two sources once, valued both ways), terms sum to a value for each pair of
sources, and a window ranks. All arithmetic is on integers: the share p of a count is 1 + floor(10**9 * (count + 1) / (N + V)), where
N sums the group's counts and V is the size of the vocabulary, and a term's value is floor((p - q)**2 / q).

A language is a hot key and never a key of an exchange: groups, a row for each language and source, are
copied once for each slice of the terms and join on (lang, slice).

Null text, lang and source count as ''. Every row is a document, even if it repeats another.
Groups without terms take part with V counts of zero; with V = 0 all values are 0. Ties go by the item's bytes. Empty tables give none;
further columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexstrata.llm.shared import only, partitions, ship, stored

#: Over the bytes of UTF-8 this matches what it matches over characters, since all of its limits are ASCII.
MATCH = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
TO_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
MANY = 500_000
UNIT = 1_000_000_000


def plain(docs: DataFrame) -> DataFrame:
    return only(docs, "lang", "source", "text").na.fill("", ["lang", "source", "text"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the matches in the rows at hand, told whenever MANY counts are held."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

    def told() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            if n:
                same = [pa.array([x], pa.string()).take(pa.array(np.zeros(len(n), np.int32))) for x in (lang, source)]
                columns = [pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64()), pa.array(list(map(docs.__getitem__, n)), pa.int64())]
                yield pa.RecordBatch.from_arrays([*same, *columns], names=["lang", "source", "term", "n", "docs"])
        held.clear()

    for b in batches:
        for lang, source, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
            terms = MATCH.findall(text.translate(TO_LOWER))
            n, docs = held[lang, source]
            n.update(terms)
            docs.update(set(terms))
            if len(n) > MANY:
                yield from told()
        if sum(len(n) for n, _ in held.values()) > MANY:
            yield from told()
    yield from told()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents that hold it), dealt by lang and term, so that no later grouping by them exchanges again."""
    rows = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
    found = rows.mapInArrow(_counted, "lang string, source string, term binary, n long, docs long")
    dealt = found.withColumn("term", F.col("term").cast("string")).repartition(partitions(docs.sparkSession), "lang", "term")
    return dealt.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def vocabulary(counts: DataFrame, least_docs: int) -> DataFrame:
    """lang, term, total and held (n by source) of the terms in enough documents of the language."""
    merged = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("source", "n"))).alias("held"))
    return merged.where(F.col("docs") >= least_docs).select("lang", "term", "total", "held")


def share(count: Column, n: Column, v: Column) -> Column:
    """The smoothed share, in whole billionths, at least 1. Counts of which a billion times no longer fits a long take the decimal way."""
    exact = F.call_function("div", F.lit(UNIT).cast("decimal(38,0)") * (count + 1), (n + v).cast("decimal(38,0)"))
    return 1 + F.when(count < 2**63 // UNIT - 1, F.call_function("div", F.lit(UNIT).cast("long") * (count + 1), n + v)).otherwise(exact)


def excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def divergences(docs: DataFrame, least_docs: int = 3, ranks: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank: of every group, the other sources (part `pair`, all of them) and
    the terms it uses more than its language does (part `term`, the first `ranks`)."""
    ship(docs.sparkSession)
    docs = plain(docs)
    kept = stored(vocabulary(term_counts(docs), least_docs), "vocabulary")
    slices = max(1, partitions(docs.sparkSession))

    of_lang = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    of_group = kept.select("lang", F.explode("held").alias("source", "n")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = docs.select("lang", "source").distinct().join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = stored(groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_n", F.lit(0)).alias("lang_n")), "groups")

    sliced = groups.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    in_slices = kept.withColumn("slice", F.pmod(F.hash("term"), F.lit(slices)))
    crossed = in_slices.join(sliced.select("lang", "slice", "source", "n", "v"), ["lang", "slice"])
    count = F.coalesce(F.try_element_at("held", F.col("source")), F.lit(0))
    dense = crossed.select("lang", "term", "source", share(count, F.col("n"), F.col("v")).alias("p")).repartition(slices, "lang", "term")

    pairs = dense.join(dense.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q")), ["lang", "term"]).where("source < item")
    sums = pairs.groupBy("lang", "source", "item").agg(F.sum(excess(F.col("p"), F.col("q"))).alias("there"), F.sum(excess(F.col("q"), F.col("p"))).alias("back"))
    values = sums.select("lang", F.inline(F.array(F.struct("source", "item", F.col("there").alias("value")), F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value")))))
    meant = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pair = meant.join(values, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))

    used = in_slices.select("lang", "slice", "term", "total", F.explode("held").alias("source", "count")).join(sliced, ["lang", "slice", "source"])
    shares = used.select("lang", "source", "term", share(F.col("count"), F.col("n"), F.col("v")).alias("p"), share(F.col("total"), F.col("lang_n"), F.col("v")).alias("q")).where("p > q")
    term = shares.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), excess(F.col("p"), F.col("q")).alias("value"))

    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    top = term.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    return pair.withColumn("rank", F.row_number().over(order)).unionByName(top)
