"""Incremental ingest: each content once, however often it is offered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.keys import text_item_id


def ingest(spark: SparkSession, path: str, schema, sink: str, checkpoint: str) -> DataFrame:
    """Read what is new below ``path`` since the last call and append items with unseen content to ``sink``.

    State is the set of content hashes, in the checkpoint, so a restart or rescan adds nothing twice. Both folders must be
    shared by all executors.
    """
    texts = spark.readStream.schema(schema).parquet(path)
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    items = texts.select(text_item_id(digest, F.lit(0)).alias("item_id"), digest.alias("file_sha256")).dropDuplicates(["item_id"])
    query = items.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema("item_id string, file_sha256 string").parquet(sink)
