"""What several operators share: cutting lineage, and giving memory back."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_written: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset on one machine (tests), a temporary one is set.

    Executors of a cluster have no folder in common unless one is named, so there it is an error.
    """
    place = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        place = f"file://{tempfile.mkdtemp(prefix='millrace-')}"
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    This ends the lineage, computes an expensive plan once for several readers, and lets a lost
    executor cost no more than its running tasks.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.add(path)
    with shuffles_ended(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_ended(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run within go as each ends, so the disk holds those of one at a time."""
    was = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, was)


def uncut(df: DataFrame) -> None:
    """Delete what ``cut`` wrote for ``df``, once nothing will read it any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Delete all that ``cut`` wrote in this session and that is still there: results that read it must have been used."""
    for path in list(_written):
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    _written.difference_update([x for x in _written if x.rsplit("/", 1)[-1] == path.rsplit("/", 1)[-1]])


def trim() -> None:
    """Give memory that Python, Arrow and the C library hold but don't use back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if (give_back := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
        give_back(0)


def released(stage: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A stage over Arrow batches that trims its worker's memory as it ends: workers live on and serve other stages."""

    @wraps(stage)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from stage(batches)
        finally:
            trim()

    return run
