"""Shared folder, narrow tables, table reading and joins on crowded keys for the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARROW_BATCH = "8m"
HASHED_BITS = 1 << 25


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each application, and bounds the bytes of an Arrow batch."""
    context = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH)
    if getattr(context, "_lexstrata_sent", False):
        return
    top = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="lexstrata-code-"), "lexstrata_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    context.addPyFile(str(path))
    context._lexstrata_sent = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset, a local master (tests) gets a new one; a cluster must name one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lexstrata-")
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lexstrata/{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._lexstrata_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._lexstrata_path).getParent()
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, so that further columns with clashing names can't disturb a plan."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def crowded(rows: DataFrame, key: str) -> DataFrame:
    """The keys that more than one in 4 * partitions of the rows hold: at most 4 * partitions keys, so they may be broadcast."""
    counts = stored(rows.groupBy(key).agg(F.count("*").alias("n")), "counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    out = counts.where(F.col("n") > max(32, total // (4 * partitions(rows.sparkSession)))).select(key)
    return out.where(F.col(key).isNotNull())


def joined_by_key(rows: DataFrame, by_key: DataFrame, key: str, how: str = "left", hot: DataFrame | None = None) -> DataFrame:
    """rows with the columns of by_key, which has one row for each key; how is left or inner.

    Crowded keys (`hot`, or those found now) are joined by broadcast, a bounded number of rows, and
    all others by a shuffle, so no key brings a large share of the rows to one task.
    """
    hot = crowded(rows, key) if hot is None else hot
    few = by_key.join(F.broadcast(hot), key, "left_semi")
    met = rows.join(F.broadcast(hot.withColumnRenamed(key, "hot_key")), F.col(key) == F.col("hot_key"), "left")
    near = met.where("hot_key IS NOT NULL").drop("hot_key").join(F.broadcast(few), key, how)
    rest = met.where("hot_key IS NULL").drop("hot_key").join(by_key, key, how)
    return near.unionByName(rest)


def marked(rows: DataFrame, keys: DataFrame, *names: str) -> DataFrame:
    """rows with `maybe`: false only where no row of keys has the same values (of the same types) under these names.

    Told by hashed bits, 4 MB of them whatever the input, so wide rows that a join can't meet needn't be shuffled for it.
    """
    h = F.pmod(F.xxhash64(*[F.col(f"`{n}`") for n in names]), F.lit(HASHED_BITS))
    place = F.bitmap_bit_position(h)
    bits = keys.groupBy(F.bitmap_bucket_number(h).alias("_bucket")).agg(F.bitmap_construct_agg(place).alias("_bits"))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(place / 8).cast("int") + F.lit(1), F.lit(1))), 16, 10).cast("int")
    maybe = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    return rows.withColumn("_bucket", F.bitmap_bucket_number(h)).join(F.broadcast(bits), "_bucket", "left").withColumn("maybe", maybe).drop("_bucket", "_bits")
