"""Sinks: manifests, shards, splits and the card of a dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.fixed import ROWS_PER_SHARD
from millrace.operators.merging import unseen


def append_manifest(new: DataFrame, path: str, seen: DataFrame | None = None) -> None:
    """Append the items that the manifest doesn't have yet."""
    (unseen(new, seen, "item_id") if seen is not None else new).write.mode("append").parquet(path)


def part_name(number: Column) -> Column:
    return F.format_string("part-%05d", number)


def write_shards(rows: DataFrame, path: str, size: int = ROWS_PER_SHARD) -> None:
    """JSON lines, at most ``size`` in a file. Appends: what an earlier run wrote stays, and its rows are told by their ids."""
    rows.write.option("maxRecordsPerFile", size).mode("append").json(path)


def resumed(rows: DataFrame, written: DataFrame) -> DataFrame:
    """Rows that no shard has yet."""
    return unseen(rows, written, "id")


def write_corpus(batches: DataFrame, path: str) -> None:
    """Fetched rows as Parquet with a folder for each batch, so that a batch that comes again replaces itself."""
    spark = batches.sparkSession
    was = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        batches.write.mode("overwrite").partitionBy("batch_id").parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", was)


def write_splits(rows: DataFrame, path: str) -> None:
    """Parquet with a folder for each split."""
    rows.write.mode("overwrite").partitionBy("split").parquet(path)


def card(rows: DataFrame) -> str:
    """Markdown with the number of rows of each split, made anew each time."""
    counts = {r["split"]: r["n"] for r in rows.groupBy("split").agg(F.count("*").alias("n")).collect()}
    lines = [f"| {name} | {counts.get(name, 0)} |" for name in ("train", "validation", "test")]
    return "\n".join(["# Dataset", "", "| split | rows |", "|---|---:|", *lines, ""])


def write_card(rows: DataFrame, path: str) -> None:
    """The card as README.md in a folder of any file system that Spark knows."""
    spark = rows.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/README.md")
    sink = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    try:
        sink.write(bytearray(card(rows), "utf-8"))
    finally:
        sink.close()
