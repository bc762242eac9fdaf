"""Source files: scan, content hash, text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.fixed import EXTENSIONS, ROW_DDL
from millrace.functions.text import decoded, json_record_text, strip


def extension(path: Column) -> Column:
    """Lower-case extension with its dot, empty if there is none."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))


def modality(path: Column) -> Column:
    """The modality of a file by extension; null if no list has it."""
    out = None
    for name, known in EXTENSIONS.items():
        out = (F.when if out is None else out.when)(extension(path).isin(*known), name)
    return out


def relative(path: Column, root: str) -> Column:
    """The path below ``root``."""
    return F.when(F.startswith(path, F.lit(root.rstrip("/") + "/")), F.substring(path, len(root.rstrip("/")) + 2, 1 << 30)).otherwise(path)


def normal_path(path: Column) -> Column:
    """An absolute path without ``.``, ``..`` and double slashes; ``..`` at the root stays there."""
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, p: F.when(p != "..", F.concat(done, F.array(p))).otherwise(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))))
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def contained(path: Column, root: str) -> Column:
    """Whether a path relative to ``root`` stays below it."""
    base = root.rstrip("/")
    full = normal_path(F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit(base + "/"), path)))
    return (full == base) | F.startswith(full, F.lit(base + "/"))


def path_order(path: Column) -> Column:
    """What paths are sorted by: their parts, so ``a/x`` comes before ``a-b/x``."""
    return F.split(path, "/")


def scan(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """path, length, content, file_sha256 of all files of a modality below ``root``."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return found.filter(extension(F.col("path")).isin(*EXTENSIONS[kind])).select("path", "length", "content", F.sha2("content", 256).alias("file_sha256"))


def file_text(path: Column, content: Column) -> Column:
    """The text of a file; of JSONL, the texts of its records with blank lines between."""
    whole = decoded(content)
    lines = F.filter(F.split(whole, "\n", -1), lambda x: strip(x) != "")
    return F.when(extension(path) == ".jsonl", F.array_join(F.transform(lines, json_record_text), "\n\n")).otherwise(whole)


def read_shards(spark: SparkSession, root: str, ddl: str = ROW_DDL) -> DataFrame:
    """Rows of all ``*/part-*.jsonl`` below ``root`` with worker, part and line, by which they are in path and line order.

    A shard has a bounded number of rows, so each is one task's row at first. Lines that are blank or hold no JSON object give no row.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.jsonl").option("recursiveFileLookup", True).load(root)
    names = F.split("path", "/")
    lines = found.select(F.element_at(names, -2).alias("worker"), F.element_at(names, -1).alias("part"), F.posexplode(F.split(decoded(F.col("content")), "\n", -1)).alias("line", "value"))
    rows = lines.filter(strip(F.col("value")) != "").withColumn("row", F.from_json("value", ddl))
    return rows.filter(F.col("row").isNotNull()).select("row.*", "worker", "part", "line")


def fetch_counts(batches: DataFrame) -> DataFrame:
    """Batches and rows that came, from rows with their ``batch_id``."""
    return batches.agg(F.countDistinct("batch_id").alias("batches"), F.count("*").alias("rows"))


def scan_counts(items: DataFrame, seen: DataFrame) -> DataFrame:
    """One row of counters for a scan: text_chunks, images, audio, skipped_existing, files_scanned, new_items.

    ``items``: modality, item_id, chunk_index; a text file without chunks is a row without either, a media file one without
    ``chunk_index``. An item is skipped if ``seen`` has its id; one that a scan meets twice counts twice.
    """
    known = seen.select("item_id").distinct().withColumn("_old", F.lit(True))
    old, new = F.col("_old").isNotNull(), F.col("item_id").isNotNull() & F.col("_old").isNull()
    counts = [F.count_if(new & (F.col("modality") == kind)).alias(name) for kind, name in (("text", "text_chunks"), ("image", "images"), ("audio", "audio"))]
    files = F.count_if(F.coalesce("chunk_index", F.lit(0)) == 0)
    return items.join(known, "item_id", "left").agg(*counts, F.count_if(old).alias("skipped_existing"), files.alias("files_scanned"), F.count_if(new).alias("new_items"))
