"""Media: transcripts with a cache, and image encoding. Models and codecs are optional and injected."""

from __future__ import annotations

import base64
import io
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRANSCRIPT = "item_id string, text string, detected_language string, source string"


def transcribe(audio: DataFrame, model: Callable[[], Callable[[bytes], tuple[list[str], str | None]]], cache: DataFrame | None = None) -> DataFrame:
    """Transcripts of (item_id, content): those in ``cache`` as they are, the others by a model made once a partition.

    The model gives segments and a language; segments are stripped and joined by a space.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hear = model()
        for b in batches:
            rows = []
            for i, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                segments, language = hear(content)
                rows.append((i, " ".join(s.strip() for s in segments).strip(), language, "model"))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(4)], names=["item_id", "text", "detected_language", "source"])

    new = audio.join(cache.select("item_id"), "item_id", "left_anti") if cache is not None else audio
    made = new.select("item_id", "content").mapInArrow(run, TRANSCRIPT)
    return made.unionByName(cache.join(audio.select("item_id"), "item_id", "left_semi").select(*made.columns)) if cache is not None else made


def store_transcripts(transcripts: DataFrame, path: str) -> None:
    """Append transcripts to the cache, so that a later run reads them instead of asking the model."""
    transcripts.select("item_id", "text", "detected_language", "source").write.mode("append").json(path)


def encoded_image(content: Column, longest: int = 1536, quality: int = 90) -> Column:
    """A JPEG of at most ``longest`` pixels a side, never enlarged, in base64. Needs Pillow on the executors."""

    @F.pandas_udf("string")
    def run(raw: pd.Series) -> pd.Series:
        from PIL import Image

        def one(data: bytes | None) -> str | None:
            if data is None:
                return None
            image = Image.open(io.BytesIO(data)).convert("RGB")
            scale = min(1.0, longest / max(image.size))
            if scale < 1:
                image = image.resize(tuple(max(1, int(x * scale)) for x in image.size))
            sink = io.BytesIO()
            image.save(sink, "JPEG", quality=quality)
            return base64.b64encode(sink.getvalue()).decode()

        return raw.map(one)

    return run(content)
