"""Snapshots and their differences; outcome logs and what they say of mappings.

An outcome log is append-only: element, outcome (verified_success, verified_failure, apply_failure,
resolved), category, item_id, ts, case_id. Counters are aggregations, never updates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, change (added, removed, changed) of rows of which a field differs; nulls are values."""
    o = old.select(key, F.struct(*fields).alias("o"), F.lit(True).alias("in_o"))
    n = new.select(key, F.struct(*fields).alias("n"), F.lit(True).alias("in_n"))
    change = F.when(F.col("in_o").isNull(), "added").when(F.col("in_n").isNull(), "removed").otherwise("changed")
    return o.join(n, key, "full_outer").where("in_o IS NULL OR in_n IS NULL OR NOT (o <=> n)").select(key, change.alias("change"))


def mapping_counts(log: DataFrame, keys: list[str]) -> DataFrame:
    """Successes, failures and plain resolutions of each key, and its confidence."""
    n = lambda *o: F.count_if(F.col("outcome").isin(*o))
    found = log.groupBy(*keys).agg(n("verified_success").alias("success"), n("verified_failure").alias("failure"), n("apply_failure").alias("apply_failure"), n("resolved").alias("telemetry"))
    return found.withColumn("confidence", F.col("success") / (F.col("success") + F.col("failure") + F.col("apply_failure") + 2))


def reliable_mappings(log: DataFrame, keys: list[str], least: float = 0.33) -> DataFrame:
    """Keys with a success and enough confidence, with the item of the last success."""
    last = log.where("outcome = 'verified_success'").groupBy(*keys).agg(F.max_by("item_id", F.struct("ts", "item_id")).alias("item_id"))
    return mapping_counts(log, keys).where((F.col("success") > 0) & (F.col("confidence") >= least)).join(last, keys)


def contested_mappings(log: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with both successes and failures."""
    return mapping_counts(log, keys).where("success > 0 AND failure + apply_failure > 0")


def failure_patterns(log: DataFrame, limit: int) -> DataFrame:
    """The most frequent (element, category) of failed outcomes; of equals the smaller names."""
    failed = log.where("outcome IN ('verified_failure', 'apply_failure')")
    return failed.groupBy("element", "category").agg(F.count("*").alias("n"), F.max("ts").alias("last_ts")).orderBy(F.desc("n"), "element", "category").limit(limit)


def recovery_suggestions(log: DataFrame) -> DataFrame:
    """element, category, suggestion: the last one, where attempts succeeded at least as often as not."""
    found = log.groupBy("element", "category").agg(F.count_if("success").alias("s"), F.count_if(~F.col("success")).alias("f"), F.max_by("suggestion", F.struct("ts", "suggestion")).alias("suggestion"))
    return found.where("s > 0 AND s >= f").select("element", "category", "suggestion")


def run_trust(log: DataFrame, run: str) -> DataFrame:
    """run, trusted: some verified success, and nothing failed or unknown."""
    good = F.bool_or(F.col("outcome") == "verified_success")
    bad = F.bool_or(~F.coalesce(F.col("outcome").isin("verified_success", "resolved"), F.lit(False)))
    return log.groupBy(run).agg((good & ~bad).alias("trusted"))
