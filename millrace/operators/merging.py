"""Novelty, keep-first dedup, shards and splits."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions.keys import bucket
from millrace.functions.settings import shared_dir


def keep_first(rows: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of every key. An aggregate with partial sums rather than a window: a key with a third of all rows
    leaves each task as one row."""
    rest = [c for c in rows.columns if c not in key]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return rows.groupBy(*key).agg(first).select(*key, "_first.*").select(*rows.columns)


def unseen(rows: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key ``seen`` doesn't have."""
    return rows.join(seen.select(key).distinct(), key, "left_anti")


def _stored(rows: DataFrame, name: str) -> DataFrame:
    spark = rows.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def split_sizes(n: int, test: int = fixed.TEST_ROWS, validation: int = fixed.VALIDATION_ROWS) -> tuple[int, int]:
    """(test rows, validation rows) of ``n``."""
    t = min(test, n // 10)
    return t, min(validation, (n - t) // 10)


def assign_splits(rows: DataFrame, key: str, test: int = fixed.TEST_ROWS, validation: int = fixed.VALIDATION_ROWS) -> DataFrame:
    """``rows`` with ``split``: the smallest hash buckets are test, the next validation, ties by key.

    Both are bounded by settings, so a top-n over all tasks finds them and they are small enough to broadcast; the table
    itself is neither sorted nor moved. It is read three times (number, top-n, join), so it is written to the shared folder first
    and what makes it runs once.
    """
    bucketed = _stored(rows.withColumn("bucket", bucket(F.col(key))), "splits")
    t, v = split_sizes(bucketed.count(), test, validation)
    held = bucketed.select(key, "bucket").orderBy("bucket", key).limit(t + v)
    ranked = held.withColumn("_at", F.row_number().over(Window.orderBy("bucket", key))).select(F.col(key).alias("_key"), "_at")
    split = F.when(F.col("_at").isNull(), "train").when(F.col("_at") <= t, "test").otherwise("validation")
    return bucketed.join(F.broadcast(ranked), F.col(key) == F.col("_key"), "left").withColumn("split", split).drop("_key", "_at")


def shard_numbers(rows: DataFrame, writer: str, order: list[str], size: int = fixed.ROWS_PER_SHARD) -> DataFrame:
    """``rows`` with the number of the writer's shard they go to, in order.

    Rows are dealt by ranges of writer and order, so a writer with a third of them is spread over tasks: each range numbers its
    own rows, and starts from the rows of the writer's ranges before it. Ranges come from a sample, so they are
    checkpointed before anything is counted.
    """
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(rows.sparkSession))
    dealt = rows.repartitionByRange(writer, *order).withColumn("_part", F.spark_partition_id()).checkpoint()
    own = Window.partitionBy(writer, "_part")
    earlier = Window.partitionBy("_writer").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    ranges = dealt.groupBy(F.col(writer).alias("_writer"), F.col("_part").alias("_of")).count()
    starts = ranges.select("_writer", "_of", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
    numbered = dealt.withColumn("_at", F.row_number().over(own.orderBy(*order)) - 1)
    joined = numbered.join(starts, (F.col("_part") == F.col("_of")) & F.col(writer).eqNullSafe(F.col("_writer")))
    return joined.select(*[c for c in rows.columns if c != "shard"], F.floor((F.col("_before") + F.col("_at")) / size).cast("long").alias("shard"))
