"""Paragraph packing: an ordered fold over the paragraphs of one text.

Memory is bounded by an Arrow batch of texts. The fold is over lengths, so each chunk is joined once.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.fixed import MAX_CHARS, MIN_CHARS

GAP = "\n\n"
BLANK = re.compile(r"\n\s*\n+")


def packed(text: str | None, least: int, most: int) -> list[str] | None:
    """Paragraphs in groups: a fold over their lengths gives the borders, and each group is joined once."""
    if text is None:
        return None
    parts = [p for p in map(str.strip, BLANK.split(text)) if p]
    if not parts:
        return []
    borders, size = [0], 0  # starts of groups; length of the open one, 0 if none is
    for k, p in enumerate(parts):
        if size and size + len(GAP) + len(p) > most:
            borders.append(k)
            size = 0
        size += len(p) + (len(GAP) if size else 0)
        if size >= least and size >= most:
            borders.append(k + 1)
            size = 0
    if not size:
        borders.pop()
    elif len(borders) > 1 and size < least:
        borders.pop()
    return [GAP.join(parts[a:b]) for a, b in zip(borders, [*borders[1:], len(parts)], strict=True)]


def chunks(text: Column, least: int = MIN_CHARS, most: int = MAX_CHARS) -> Column:
    """array<string>: paragraphs packed up to ``most`` code points.

    A paragraph is never split, so one that is longer stands alone; a rest under ``least`` joins the chunk before it. A null
    text gives null, a blank one no chunk. A fold over strings of growing length is dear as a Spark expression, so
    this one runs in Arrow batches.
    """

    @F.arrow_udf("array<string>")
    def pack(texts: pa.Array) -> pa.Array:
        return pa.array([packed(t, least, most) for t in texts.to_pylist()], pa.list_(pa.string()))

    return pack(text)


def chunks_sql(rows: str, key: str, text: str, white: str, least: int = MIN_CHARS, most: int = MAX_CHARS) -> str:
    """CTEs that end in ``chunked`` (key, chunk_index, chunk), in DuckDB SQL; one step a paragraph."""
    gap = "chr(10) || chr(10)"
    stripped = rf"regexp_replace(x, '\A[{white}]+|[{white}]+\z', '', 'g')"
    return rf"""
paras AS MATERIALIZED (SELECT {key} AS k, list_filter(list_transform(regexp_split_to_array({text}, '\n[{white}]*\n+'), lambda x: {stripped}), lambda x: x <> '') AS ps FROM {rows}),
steps AS (
  SELECT k, ps, 0 AS i, CAST([] AS VARCHAR[]) AS done, '' AS buf FROM paras
  UNION ALL
  SELECT k, ps, i + 1,
    CASE WHEN length(nb) >= {least} AND length(nb) >= {most} THEN list_append(nd, nb) ELSE nd END,
    CASE WHEN length(nb) >= {least} AND length(nb) >= {most} THEN '' ELSE nb END
  FROM (
    SELECT k, ps, i,
      CASE WHEN buf <> '' AND length(buf || {gap} || ps[i + 1]) > {most} THEN list_append(done, buf) ELSE done END AS nd,
      CASE WHEN buf = '' OR length(buf || {gap} || ps[i + 1]) > {most} THEN ps[i + 1] ELSE buf || {gap} || ps[i + 1] END AS nb
    FROM steps WHERE i < len(ps)
  )
),
ended AS (SELECT k, CASE WHEN buf = '' THEN done WHEN len(done) > 0 AND length(buf) < {least} THEN list_append(done[:-2], done[-1] || {gap} || buf) ELSE list_append(done, buf) END AS cs FROM steps WHERE i = len(ps)),
chunked AS (SELECT k, unnest(range(0, len(cs))) AS chunk_index, unnest(cs) AS chunk, len(cs) AS total_chunks FROM ended)
"""
