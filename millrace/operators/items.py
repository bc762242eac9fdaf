"""Whole items: from a chunk, an image or a transcript to dataset rows, good ones and rejects."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import fixed, keys
from millrace.functions.text import strip
from millrace.operators.generation import Backend, generate
from millrace.operators.rows import fan_out, prompt, reply_fields, row_errors
from millrace.sources.media import encoded_image

TEMPLATES = {"text": fixed.TEXT_PROMPT, "image": fixed.IMAGE_PROMPT, "audio": fixed.AUDIO_PROMPT}


def picked(items: DataFrame) -> DataFrame:
    """``items`` with a task type by weight and a difficulty, drawn by a hash of the item."""
    uniform = dict.fromkeys(fixed.DIFFICULTIES, 1)
    return items.withColumn("task_type", keys.weighted_pick(F.col("item_id"), "task", fixed.TASK_WEIGHTS)).withColumn("level", keys.weighted_pick(F.col("item_id"), "difficulty", uniform))


def assembled(items: DataFrame, kind: str) -> DataFrame:
    """Dataset columns and ``errors`` from fanned-out items with their reply (``content``, ``thinking``, ``error``).

    A key that the reply lacks gets its default; an audio row without input has its transcript there. A failed call
    is the only error of its row.
    """
    reply = F.coalesce("content", F.lit("{}"))
    defaults = {"category": F.lit("uncategorized"), "type": F.col("task_type"), "instruction": F.lit(""), "input": F.lit(""), "answer": F.lit(""), "difficulty": F.col("level")}
    fields = dict(zip(defaults, reply_fields(reply, defaults), strict=True))
    if kind == "audio":
        fields["input"] = F.when(F.coalesce(fields["input"], F.lit("")) == "", F.col("body")).otherwise(fields["input"]).alias("input")
    choices = F.coalesce(F.from_json(F.get_json_object(reply, "$.choices"), "array<string>"), F.array().cast("array<string>"))
    path = F.lit(None).cast("string") if kind == "text" else F.col("path")
    rows = items.select("id", F.col("path").alias("source"), *fields.values(), choices.alias("choices"), F.coalesce("thinking", F.lit("")).alias("thinking"), "language", F.lit(kind).alias("modality"), path.alias("media_path"), "pair_id", "error")
    return rows.withColumn("errors", F.when(F.col("error").isNotNull(), F.array("error")).otherwise(row_errors())).select(*fixed.ROW_COLUMNS, "errors")


def process(items: DataFrame, kind: str, backend: Callable[[], Backend], **options) -> DataFrame:
    """Dataset rows with ``errors`` for every item and language.

    ``items``: item_id, path, and ``body``: the chunk of a text, the transcript of an audio file (blank ones give no row), or
    the bytes of an image, which goes along scaled down. Prompts are asked once for each item and language.
    """
    body = F.col("body") if kind != "image" else F.lit(None).cast("string")
    wanted = items if kind != "audio" else items.filter(strip(F.col("body")) != "")
    spread = fan_out(picked(wanted))
    asked = spread.withColumn("prompt", prompt(TEMPLATES[kind], F.col("language"), F.col("task_type"), F.col("level"), body))
    if kind == "image":
        asked = asked.withColumn("image", encoded_image(F.col("body")))
    replies = generate(asked, backend, **options)
    return assembled(asked.drop("prompt", "image").join(replies, "id"), kind)


def good(rows: DataFrame) -> DataFrame:
    return rows.filter(F.size("errors") == 0).drop("errors")


def rejects(rows: DataFrame) -> DataFrame:
    """What was dropped and why, a row for each error."""
    return rows.select("id", "source", F.explode("errors").alias("error"))

