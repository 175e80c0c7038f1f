"""Append-only logs in a folder: runs, outcomes, recoveries, examples, snapshots; and the reports made of them.

Each log is a Parquet folder of its own, so appends never rewrite what is there and counters are
aggregations. `ts` is given by the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexstrata.functions.text import literal_map

LOGS = {
    "run": "ts timestamp, source_npa_id string, target_npa_id string, changes_applied long, changes_failed long, corrections long, elapsed double, notes string",
    "outcome": "ts timestamp, element string, change_type string, outcome string, category string, message string, item_id string, case_id string, target_id string, source_id string, signature string",
    "verification": "ts timestamp, source_npa_id string, target_npa_id string, errors long, warnings long, passed boolean",
    "recovery": "ts timestamp, element string, category string, suggestion string, success boolean",
    "example": "ts timestamp, element string, category string, message string, context string",
    "fix": "ts timestamp, bug string, fix string, issues_before long, issues_after long, success boolean",
    "snapshot": "run_id string, snapshot_id string, ts timestamp, label string, source_hash string",
}
# What to do about a category of issues.
ADVICE = {
    "item_id_duplicate": "rename the later item with a _double_N ending",
    "child_ref_broken": "bring references and children into line after the change",
    "child_ref_missing": "bring references and children into line after the change",
    "item_level_invalid": "count levels anew from the depth in the tree",
    "date_format_invalid": "write dates as dd.mm.yyyy and end a revision the day before the next",
    "date_continuity": "write dates as dd.mm.yyyy and end a revision the day before the next",
    "modified_by_id_format": "name the whole id of the source item",
    "change_not_applied": "look at the path of the change",
    "revision_missing": "look at the path of the change",
}


class Records:
    """Logs under one path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def append(self, log: str, rows: DataFrame) -> None:
        """Adds rows; columns they lack are null, others raise an error."""
        names = [f.split(" ")[0] for f in LOGS[log].split(", ")]
        if extra := set(rows.columns) - set(names):
            raise ValueError(f"{log} has no columns {sorted(extra)}")
        empty = self.spark.createDataFrame([], LOGS[log])
        full = empty.unionByName(rows.select(*[F.col(c).cast(empty.schema[c].dataType).alias(c) for c in rows.columns]), allowMissingColumns=True)
        full.write.mode("append").parquet(f"{self.path}/{log}")

    def read(self, log: str) -> DataFrame:
        """All rows; none where nothing was appended."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{log}")
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(LOGS[log]).parquet(f"{self.path}/{log}") if there else self.spark.createDataFrame([], LOGS[log])

    def save_snapshot(self, run_id: str, snapshot_id: str, label: str, revisions: DataFrame, ts: str) -> None:
        """Revisions under the snapshot's folder, then its row: a half-written one is never listed."""
        revisions.write.mode("overwrite").parquet(f"{self.path}/snapshots/{run_id}/{snapshot_id}")
        row = self.spark.createDataFrame([(run_id, snapshot_id, label)], "run_id string, snapshot_id string, label string")
        hashed = revisions.agg(source_hash(revisions).alias("source_hash"))
        self.append("snapshot", row.crossJoin(F.broadcast(hashed)).withColumn("ts", F.lit(ts).cast("timestamp")))

    def load_snapshot(self, run_id: str, snapshot_id: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/snapshots/{run_id}/{snapshot_id}")

    def list_snapshots(self, run_id: str) -> list[str]:
        return [r.snapshot_id for r in self.read("snapshot").where(F.col("run_id") == run_id).select("ts", "snapshot_id").distinct().orderBy("ts", "snapshot_id").collect()]

    def drop_snapshots(self, run_id: str, keep: list[str] | None = None) -> list[str]:
        """Deletes a run's snapshots but those kept (None keeps all); returns the ids deleted. Their rows stay."""
        gone = [s for s in self.list_snapshots(run_id) if keep is not None and s not in keep]
        for s in gone:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/snapshots/{run_id}/{s}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return gone


def source_hash(rows: DataFrame) -> Column:
    """One hash over all rows, whatever their order: the sum of the rows' hashes, as text."""
    return F.sha2(F.sum(F.xxhash64(F.to_json(F.struct(*sorted(rows.columns)))).cast("decimal(38,0)")).cast("string"), 256)


def mapping_key(element: Column, target: Column, source: Column, kind: Column, signature: Column) -> Column:
    """The element alone, or with all of its context if there is any."""
    rest = [F.coalesce(c.cast("string"), F.lit("")) for c in (target, source, kind, signature)]
    return F.when(F.concat(*rest) == "", element).otherwise(F.concat_ws("\u0001", element, *rest))


def reliable_without_context(log: DataFrame) -> DataFrame:
    """element, item_id of elements that succeeded more often than they failed, whatever their context."""
    n = lambda *o: F.count_if(F.col("outcome").isin(*o))
    last = F.max_by("item_id", F.when(F.col("outcome") == "verified_success", F.struct("ts", "item_id")))
    return log.groupBy("element").agg(n("verified_success").alias("s"), n("verified_failure", "apply_failure").alias("f"), last.alias("item_id")).where("s > f").select("element", "item_id")


def advice(category: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(ADVICE), category), F.lit("note the right item of the element"))


def suggestions(outcomes: DataFrame) -> DataFrame:
    """element, category, n, advice of failed outcomes, the most frequent first within an element."""
    failed = outcomes.where("outcome IN ('verified_failure', 'apply_failure')").groupBy("element", "category").agg(F.count("*").alias("n"))
    return failed.withColumn("advice", advice(F.col("category")))


def newest_examples(examples: DataFrame, element: str | None, category: str | None, limit: int) -> DataFrame:
    """The newest examples of an element and a category (None: any)."""
    found = examples
    for name, value in (("element", element), ("category", category)):
        found = found if value is None else found.where(F.col(name) == value)
    return found.orderBy(F.desc("ts"), "element", "message").limit(limit)


def seed_examples(seeds: DataFrame, category: str, subcategory: str | None, limit: int) -> DataFrame:
    """Seed rows (id, category, subcategory, input, output) of a category, by id."""
    found = seeds.where(F.col("category") == category)
    return (found if subcategory is None else found.where(F.col("subcategory") == subcategory)).orderBy("id").limit(limit)


def training_context(seeds: DataFrame, category: str, limit: int) -> DataFrame:
    """One row: the text of the first seed rows of a category, numbered."""
    rows = seed_examples(seeds, category, None, limit)
    listed = F.array_sort(F.collect_list(F.struct("id", "input", "output")))
    return rows.agg(F.array_join(F.transform(listed, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x["input"], F.lit(" -> "), x["output"])), "\n").alias("text"))


def prompt_supplement(seeds: DataFrame, stage: int, limit: int = 5) -> DataFrame:
    """The training context that a stage is given: structure before the fourth, highlights from it on."""
    return training_context(seeds, "structure" if stage < 4 else "highlights", limit)


def totals(runs: DataFrame, outcomes: DataFrame, verifications: DataFrame, recoveries: DataFrame, keys: list[str]) -> DataFrame:
    """One row with the twelve totals of all logs."""
    from lexstrata.operators.history import mapping_counts

    r = runs.agg(F.count("*").alias("total_runs"), *[F.coalesce(F.sum(a), F.lit(0)).cast("long").alias(b) for a, b in (("changes_applied", "total_changes_applied"), ("changes_failed", "total_changes_failed"), ("corrections", "total_manual_corrections"))])
    m = mapping_counts(outcomes, keys).agg(
        F.count_if((F.col("confidence") >= 0.33) & (F.col("success") > 0)).alias("reliable_mappings"), F.count_if((F.col("success") > 0) & (F.col("failure") + F.col("apply_failure") > 0)).alias("contested_mappings"),
        F.count("*").alias("total_mappings"), F.count_if(F.col("failure") + F.col("apply_failure") > 0).alias("mappings_with_failures"))
    v = verifications.agg(F.count_if("passed").alias("total_verification_passes"), F.count_if(~F.coalesce("passed", F.lit(False))).alias("total_verification_fails"))
    c = recoveries.groupBy("element", "category").agg(F.count_if("success").alias("s"), F.count_if(~F.col("success")).alias("f")).agg(F.count("*").alias("total_recoveries_attempted"), F.count_if(F.col("s") > F.col("f")).alias("total_recoveries_successful"))
    return r.crossJoin(F.broadcast(m)).crossJoin(F.broadcast(v)).crossJoin(F.broadcast(c))  # one row each


def summary(one: DataFrame, patterns: DataFrame) -> DataFrame:
    """One row: the totals and the most frequent failures (element, category, n, advice) as text."""
    head = F.concat_ws("\n", *[F.concat(F.lit(f"- {c}: "), F.col(c).cast("string")) for c in one.columns])
    line = F.concat(F.lit("- "), "element", F.lit(" ["), F.coalesce("category", F.lit("")), F.lit("]: "), F.col("n").cast("string"), F.lit(", "), "advice")
    worst = patterns.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), line.alias("line")))), lambda x: x["line"]), "\n").alias("worst"))
    return one.select(head.alias("head")).crossJoin(F.broadcast(worst)).select(F.concat("head", F.lit("\n"), "worst").alias("text"))


def chain_report(steps: DataFrame) -> DataFrame:
    """status, n of a chain's steps, as the lines of its report."""
    return steps.groupBy("status").agg(F.count("*").alias("n")).withColumn("line", F.concat(F.lit("| "), "status", F.lit(" | "), F.col("n").cast("string"), F.lit(" |")))


def write_text(text: DataFrame, path: str) -> None:
    """The one text column of a few rows as text in one file."""
    text.coalesce(1).write.mode("overwrite").text(path)
