"""A chain of amendments that can be stopped at any time and goes on after the last finished one.

A step's table is written whole before a small file under `commits`, named after the amendment, makes it count; whatever
has no such file is as if it never ran. So a chain started again takes up the last committed table, and an amendment
that is committed is never applied twice, even if the list is longer, or in another order, in the next run.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

REPORT = "step int, amendment string, status string, error string, result string"


@dataclass(frozen=True)
class Step:
    """An amendment: its name, and its changes for the table as it is then (a function, so that nothing is read for finished steps)."""

    name: str
    changes: Callable[[], DataFrame]


class Chain:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop
        self.files = self._at("commits").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *names: str):
        return self.hadoop.fs.Path("/".join([self.path, *names]))

    def commits(self) -> list[dict]:
        """What is committed, in order of step."""
        folder = self._at("commits")
        if not self.files.exists(folder):
            return []
        found = []
        for status in self.files.listStatus(folder):
            if status.getPath().getName().endswith(".json"):
                stream = self.files.open(status.getPath())
                found.append(json.loads(bytes(stream.readAllBytes()).decode()))
                stream.close()
        return sorted(found, key=lambda c: c["step"])

    def publish(self, entry: dict) -> bool:
        """Makes a step count, under its amendment's name; False if that name counts already."""
        name = hashlib.sha256(entry["amendment"].encode()).hexdigest() + ".json"
        draft, final = self._at("drafts", uuid.uuid4().hex), self._at("commits", name)
        self.files.mkdirs(final.getParent())
        stream = self.files.create(draft, False)
        stream.write(json.dumps(entry, ensure_ascii=False).encode())
        stream.close()
        return not self.files.exists(final) and bool(self.files.rename(draft, final))

    def run(self, target: DataFrame, steps: list[Step], apply: Callable[[DataFrame, DataFrame], DataFrame], continue_on_error: bool = False) -> tuple[DataFrame, DataFrame]:
        """The table after all steps, and the report (step, amendment, status, error, result). Status: earlier (committed by a former run), success, failed.

        A failed step leaves the table as it was and ends the chain, unless continue_on_error. The report is not kept: the commits are.
        """
        done = {c["amendment"]: c for c in self.commits()}
        last = max(done.values(), key=lambda c: c["step"], default=None)
        table = self.spark.read.schema(target.schema).parquet(last["result"]) if last else target
        place, report = last["step"] if last else 0, []
        for step in steps:
            if step.name in done:
                report.append((done[step.name]["step"], step.name, "earlier", None, done[step.name]["result"]))
                continue
            place += 1
            result = f"{self.path}/tables/{place:04d}_{uuid.uuid4().hex}"
            try:
                apply(table, step.changes()).select(target.columns).write.parquet(result)
                if not self.publish({"step": place, "amendment": step.name, "result": result}):
                    raise RuntimeError("another run committed this amendment")
            except Exception as e:  # noqa: BLE001  (whatever an amendment's own work raises is its failure)
                report.append((place, step.name, "failed", f"{type(e).__name__}: {e}"[:500], None))
                place -= 1
                if not continue_on_error:
                    break
                continue
            done[step.name] = {"step": place, "result": result}
            report.append((place, step.name, "success", None, result))
            table = self.spark.read.schema(target.schema).parquet(result)
        return table, self.spark.createDataFrame(report, REPORT)


def ordered_steps(scanned: DataFrame, changes: Callable[[str], DataFrame], explicit_target: str | None = None) -> tuple[str | None, list[Step]]:
    """The target's name and the steps of one folder's documents (name, step, is_target as `amend.chain_scan` orders them). A chain's list of
    amendments is short, so its names are read here."""
    rows = sorted(scanned.select("step", "name").collect())
    names = [r.name for r in rows]
    target = explicit_target if explicit_target in names else (names[0] if names else None)
    return target, [Step(n, lambda n=n: changes(n)) for n in names if n != target]


def run_documents(spark: SparkSession, source: str, answers: str, result: str, apply: Callable[[DataFrame, DataFrame], DataFrame], changes_schema: str, path: str) -> DataFrame:
    """From files to files: nested documents in `source`, lists of changes in `answers` (a file for each amendment, in order of name), to
    nested documents in `result`. Returns the report. The chain's tables are kept under `path`."""
    from pyspark.sql import functions as F

    from lexstrata.sources import documents, egest

    docs = documents.read_json(spark, source)
    items = documents.flatten_items(docs)
    timeline = documents.revisions_of(items).drop("body")
    listed = documents.read_answers(spark, answers, changes_schema)
    names = [r.file for r in listed.select("file").distinct().orderBy("file").collect()]  # a file for each amendment
    table, report = Chain(spark, path).run(timeline, [Step(n, lambda n=n: listed.where((F.col("file") == n) & ~F.col("broken"))) for n in names], apply)
    nested = egest.nested_documents(items, table, documents.blocks_of(documents.revisions_of(items)))
    egest.write_documents(nested.select(F.regexp_replace("path", "^.*/|\\.json$", "").alias("name"), "raw"), result)
    return report
