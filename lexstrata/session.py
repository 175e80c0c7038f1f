"""Lineage cuts that outlive executors, and numbers over whole tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import batched

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """The folder spark.checkpoint.dir names. Where that is unset, a local master (tests) gets a new one; a cluster must name one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lexstrata-")
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The table, written to the shared folder as Parquet and read back. (`checkpoint` would work it out twice and write it without packing.)"""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if "void" in df.schema.simpleString():  # Parquet has no such type
        return df.checkpoint()
    path = f"{folder}/lexstrata/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, name: str, *order: Column) -> DataFrame:
    """rows with `name` 1, 2, ... over all of them in `order`, sorted by ranges; no task sees more than its range."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = cut(rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_place", place))
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))  # a row for each range
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return dealt.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_place") + 1).drop("_part", "_place", "_before")


def arrow_shape(df: DataFrame, fields: str, *kept: str) -> tuple[T.StructType, pa.Schema]:
    """The schema of rows with some columns of df and further fields, for Spark and for Arrow batches; every column may be null."""
    from pyspark.sql.pandas.types import to_arrow_schema

    shape = T.StructType([T.StructField(k, df.schema[k].dataType) for k in kept] + T.StructType.fromDDL(fields).fields)
    return shape, to_arrow_schema(shape)


def row_dicts(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[dict]:
    """The rows of Arrow batches, `size` at a time as Python objects: a batch of long rows is never unpacked as a whole."""
    for b in batches:
        for at in range(0, b.num_rows, size):
            yield from b.slice(at, size).to_pylist()


@contextmanager
def bounded_batches(spark: SparkSession, most: str = "8m") -> Iterator[None]:
    """Arrow batches made meanwhile hold `most` bytes, however long their rows are; the setting before comes back."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def in_batches(rows: Iterable[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows in Arrow batches of up to `size`."""
    for part in batched(rows, size):
        yield pa.RecordBatch.from_pylist(list(part), schema=schema)
