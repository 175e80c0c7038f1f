"""Operator 9: token counts as delta-maintained rollups.

Events are signed rows (source, lang, version, sign, n_tokens): +1 for an insert, -1 for
a delete; a revised count is the old row with -1 and the new one with +1. A column `copies`, where
there is one, says how many equal documents an event stands for. A batch of events is
committed under an id: its deltas, summed by (source, lang, version), are written to a folder of
their own, then published by moving a small file to the batch's name, which fails if that name
is taken. So a batch counts once however often it is told, even by two drivers at once, and a job that
died on the way leaves nothing that counts. Totals are the sums of all published deltas.
`compact` folds them into one batch of another store, which also remembers the ids it holds.

Nulls in source, lang or version form a group of their own; a null n_tokens counts 0 tokens, a
null sign or number of copies is no event. Groups whose documents and tokens both reach 0 are left
out of totals. Empty batches commit. Repeated events count each time: the producer states each event
once a batch. Further columns are ignored.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "version")
DELTA = "source string, lang string, version string, d_docs long, d_tokens long"


def deltas(events: DataFrame) -> DataFrame:
    """Sums of signed events by group; partial sums come before the shuffle, so hot groups are small."""
    copies = F.col("copies").cast("long") if "copies" in events.columns else F.lit(1)
    given = events.select(*[F.col(f"`{k}`").cast("string").alias(k) for k in KEYS], (F.signum("sign").cast("long") * copies).alias("d"), F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n"))
    return given.where("d IS NOT NULL").groupBy(*KEYS).agg(F.sum("d").alias("d_docs"), F.sum(F.col("d") * F.col("n")).alias("d_tokens"))


class Rollup:
    """Totals by source, language and tokenizer version, kept in a folder that Spark reads.

    commits/<id> holds lines "id folder" (one with a folder, and for a compacted batch one without
    for every id it took in); data/<folder> holds the deltas.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _hadoop(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def published(self) -> dict[str, str]:
        """Folder of each batch id, "" for those folded into another. A line for each batch reaches the driver."""
        fs, top = self._hadoop(f"{self.path}/commits")
        if not fs.exists(top) or not fs.listStatus(top):
            return {}
        return dict(r.value.split("\t") for r in self.spark.read.text(f"{self.path}/commits").collect())

    def committed(self) -> list[str]:
        return sorted(self.published())

    def _publish(self, batch: str, lines: list[str]) -> bool:
        """Moves a file of these lines to the batch's name; says whether that was free."""
        jvm = self.spark._jvm.org.apache.hadoop.fs
        fs, made = self._hadoop(f"{self.path}/made/{uuid.uuid4().hex}")
        out = fs.create(made)
        out.write("\n".join(lines).encode())
        out.close()
        _, name = self._hadoop(f"{self.path}/commits/{batch}")
        fs.mkdirs(name.getParent())
        how = self.spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
        how[0] = jvm.Options.Rename.NONE
        try:
            jvm.FileContext.getFileContext(name.toUri(), self.spark._jsc.hadoopConfiguration()).rename(made, name, how)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in str(e.java_exception):
                raise
            fs.delete(made, False)
            return False
        return True

    def _commit(self, batch: str, rows: DataFrame, folded: list[str]) -> bool:
        if not batch.replace("-", "").replace("_", "").isalnum() or batch.startswith(("_", "-")):
            raise ValueError("a batch id is made of letters, digits, - and _, and starts with neither sign")
        if batch in self.published():
            return False
        folder = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/data/{folder}")
        done = self._publish(batch, [f"{batch}\t{folder}", *(f"{x}\t" for x in folded if x != batch)])
        if not done:
            fs, own = self._hadoop(f"{self.path}/data/{folder}")
            fs.delete(own, True)
        return done

    def commit(self, batch: str, events: DataFrame) -> bool:
        """Commits the batch unless its id is known; says whether it did."""
        return self._commit(batch, deltas(events), [])

    def totals(self, of: dict[str, str] | None = None) -> DataFrame:
        """The sums of all batches, or of those of a list read before (`published`)."""
        folders = [f"{self.path}/data/{f}" for f in (self.published() if of is None else of).values() if f]
        rows = self.spark.read.schema(DELTA).parquet(*folders) if folders else self.spark.createDataFrame([], DELTA)
        out = rows.groupBy(*KEYS).agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens"))
        return out.where("n_docs <> 0 OR n_tokens <> 0")

    def compact(self, into: "Rollup", batch: str) -> bool:
        """The totals as one batch of another store, which then knows the ids of all batches in it."""
        known = self.published()  # read once: a batch that comes later is neither in the sums nor among the ids
        return into._commit(batch, self.totals(known).select(*KEYS, F.col("n_docs").alias("d_docs"), F.col("n_tokens").alias("d_tokens")), sorted(known))


def later_copies(rows: DataFrame) -> DataFrame:
    """source, lang, n_tokens, copies of all rows but the first (smallest doc_id, null last) of each text_hash.

    Rows are counted by (text_hash, source, lang) first, so a text that a third of all rows share
    reaches its group as a row for each source and language; no join is needed.
    """
    at = F.struct(F.col("doc_id").isNull(), "doc_id")
    counted = rows.groupBy("text_hash", "source", "lang").agg(F.count("*").alias("n"), F.first("n_tokens").alias("n_tokens"), F.min(at).alias("at"))
    groups = counted.groupBy("text_hash").agg(F.sort_array(F.collect_list(F.struct("at", "source", "lang", "n", "n_tokens"))).alias("groups")).where("size(groups) > 1 OR groups[0].n > 1")
    one = groups.select(F.posexplode("groups").alias("k", "g")).select("g.source", "g.lang", "g.n_tokens", (F.col("g.n") - (F.col("k") == 0).cast("long")).alias("copies"))
    return one.where("copies > 0")


def counted(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, source, lang, n_tokens and text_hash of every text, by a tokenizers file."""
    from lexstrata.llm.shared import only

    def run(parts):
        import pyarrow as pa

        from lexstrata.llm.kernels import blocks
        from lexstrata.llm.token_cache import shared_cache

        cache = shared_cache(path)
        for part in parts:
            for lo, hi, data, offs in blocks(part.column("text")):
                _, n = cache.encode(data, offs, ids=False)
                some = part.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in ("doc_id", "source", "lang", "text_hash")), pa.array(n, pa.int64())], names=["doc_id", "source", "lang", "text_hash", "n_tokens"])

    docs = only(docs, "doc_id", "source", "lang", "text")
    hashed = docs.withColumn("text_hash", F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))))
    return hashed.mapInArrow(run, "doc_id long, source string, lang string, text_hash binary, n_tokens long")
