"""What changed between two wordings, paragraph by paragraph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def paragraph_rows(docs: DataFrame, key: str, paragraphs: Column) -> DataFrame:
    """key, pos (from 1), paragraph."""
    return docs.select(key, F.posexplode(paragraphs).alias("p", "paragraph")).select(key, (F.col("p") + 1).alias("pos"), "paragraph")


def common_prefix(a: Column, b: Column) -> Column:
    """Characters that both start with, by halving: the longest n whose first n characters agree."""
    most = F.least(F.length(a), F.length(b))
    step = lambda acc, k: F.when((acc + k <= most) & (F.substring(a, F.lit(1), acc + k) == F.substring(b, F.lit(1), acc + k)), acc + k).otherwise(acc)
    powers = F.transform(F.sequence(F.lit(30), F.lit(0), F.lit(-1)), lambda e: F.pow(F.lit(2), e).cast("int"))
    return F.aggregate(powers, F.lit(0), step)


def differences(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """key, pos, side (deletion, addition, difference), old_text, new_text for paragraphs that differ.

    Where both are there, the common start and then the common end are left out of the texts.
    """
    o, n = old.withColumnRenamed("paragraph", "o"), new.withColumnRenamed("paragraph", "n")
    both = o.join(n, [key, "pos"], "full_outer").where("NOT (o <=> n)")
    side = F.when(F.col("o").isNull(), "addition").when(F.col("n").isNull(), "deletion")
    p = common_prefix(F.col("o"), F.col("n"))
    cut = both.withColumn("prefix", F.coalesce(p, F.lit(0)))
    rest = lambda c: F.substring(F.col(c), F.col("prefix") + 1, F.length(c))
    cut = cut.withColumn("o2", rest("o")).withColumn("n2", rest("n"))
    s = F.coalesce(common_prefix(F.reverse("o2"), F.reverse("n2")), F.lit(0))
    cut = cut.withColumn("suffix", s)
    middle = lambda c: F.substring(F.col(c), F.lit(1), F.length(c) - F.col("suffix"))
    done = cut.withColumn("old_text", middle("o2")).withColumn("new_text", middle("n2"))
    inner = F.when(F.col("old_text") == "", "addition").when(F.col("new_text") == "", "deletion").otherwise("difference")
    return done.select(key, "pos", F.coalesce(side, inner).alias("side"), F.coalesce("old_text", F.lit("")).alias("old_text"), F.coalesce("new_text", F.lit("")).alias("new_text"))


def normal_positions(entries: DataFrame) -> DataFrame:
    """Entries with 'a,b' positions as one row each; no position is '1-N' with N the place among the item's entries."""
    rows = entries.withColumn("position", F.explode(F.split(F.coalesce(F.nullif(F.trim("position"), F.lit("")), F.concat(F.lit("1-"), F.col("seq").cast("string"))), "\\s*,\\s*")))
    return rows.dropDuplicates()


def empty_marks(*lists: Column) -> Column:
    """Whether all lists are missing or empty."""
    total = F.lit(0)
    for c in lists:
        total = total + F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    return total == 0


def occurrences(text: Column, part: Column) -> Column:
    return F.when(F.length(part) > 0, (F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)).otherwise(0).cast("int")


def declared_replacements(rows: DataFrame, key: str) -> DataFrame:
    """key, pos, old_text, new_text, position of each declared pair: 'i-k' for the k-th of as many places as both wordings have.

    rows: key, pos, old, new (paragraphs), pairs (array of struct old, new).
    """
    each = rows.select(key, "pos", "old", "new", F.explode("pairs").alias("p"))
    times = F.least(occurrences(F.col("old"), F.col("p.old")), occurrences(F.col("new"), F.col("p.new")))
    many = each.withColumn("times", times).where("times > 0").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return many.select(key, "pos", F.col("p.old").alias("old_text"), F.col("p.new").alias("new_text"), F.concat_ws("-", "pos", "k").alias("position"))


def pairs_marked(pairs: Column, marks: Column) -> Column:
    """Whether each declared pair (struct old, new) stands among the marks (struct old_text, new_text)."""
    return F.forall(pairs, lambda p: F.exists(marks, lambda m: (m["old_text"] == p["old"]) & (m["new_text"] == p["new"])))
