"""Line dedup over windows of three lines, with Spark expressions only.

Every three consecutive lines are a window. Of all occurrences of a window the first, by document id and
position, stays; each later one covers its three lines, and the covered lines go. Windows carry two 64-bit
hashes. The first occurrence of each is an aggregate with partial sums on the map side; occurrences join
only with windows that repeat, and a join can split a window that a third of all documents hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 3


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """The columns of ``docs`` with the text's repeated windows removed, and n_lines, n_removed (long).

    Lines end at ``\\n`` and are compared exactly; other white space is part of a line. A null text stays
    null with 0 lines; an empty one has 1 line. Texts of fewer than three lines have no window and stay. A
    text that is removed whole is empty. Rows with equal id and text are one document given twice: each
    gets the same result. Rows that share an id but not the text are ordered by a hash of the text. Null ids
    come first. Every removed line stands in a kept place earlier. Columns of ``docs`` named n_lines or n_removed are
    replaced; other names can't clash.
    """
    got = _thinned(docs, id_col, text_col, width)
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return got.select(*[_column(c, text_col) for c in own], "n_lines", "n_removed")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """The rows and columns of ``docs`` without repeated windows; a text left without lines goes. ``n_chars`` follows the text."""
    got = _thinned(docs, id_col, text_col, width).filter("n_removed = 0 OR n_removed < n_lines")
    return got.select(*[F.length("thinned").cast("long").alias(c) if c == "n_chars" else _column(c, text_col) for c in docs.columns])


def _column(name: str, text_col: str) -> Column:
    return F.col("thinned").alias(name) if name == text_col else F.col("row").getField(name).alias(name)


def _thinned(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """row (the input's columns), thinned, n_lines, n_removed."""
    keyed = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    lines = F.split("text", "\n", -1)
    hashed = keyed.select("id", "hash", F.transform(lines, lambda x: F.xxhash64(x)).alias("one"), F.transform(lines, lambda x: F.xxhash64(F.lit(29), x)).alias("two")).filter(F.size("one") >= width)
    starts = F.sequence(F.lit(0), F.size("one") - width)
    at = [F.col("at") + k for k in range(width)]
    windows = hashed.select("id", "hash", "one", "two", F.explode(starts).alias("at")).select("id", "hash", "at", F.xxhash64(*[F.get("one", a) for a in at]).alias("h1"), F.xxhash64(*[F.get("two", a) for a in at]).alias("h2"))
    place = F.struct("id", "hash", "at")
    repeated = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first < last").drop("last")
    later = windows.join(repeated, ["h1", "h2"]).filter(place > F.col("first"))
    covered = later.select("id", "hash", F.explode(F.sequence(F.col("at"), F.col("at") + (width - 1))).alias("line")).groupBy("id", "hash").agg(F.collect_set("line").alias("covered"))
    joined = keyed.join(covered, ["id", "hash"], "left")
    count = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("covered"))
    thinned = F.when(F.col("covered").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    removed = F.when(F.col("covered").isNull(), 0).otherwise(F.size("covered"))
    return joined.select("row", thinned.alias("thinned"), count.cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"))


def sql(documents: str = "documents") -> str:
    """The same in DuckDB SQL for distinct ids: every column of the table, n_lines, n_removed."""
    return f"""
WITH l AS MATERIALIZED (SELECT *, string_split(text, chr(10)) AS ls FROM {documents}),
w AS (SELECT doc_id, unnest(range(0, len(ls) - {WIDTH - 1})) AS pos, ls FROM l WHERE len(ls) >= {WIDTH}),
k AS (SELECT doc_id, pos, ls[pos + 1] || chr(10) || ls[pos + 2] || chr(10) || ls[pos + 3] AS win FROM w),
f AS (SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS nth FROM k),
c AS (SELECT doc_id, list_distinct(list(pos + o)) AS gone FROM f, range(0, {WIDTH}) r(o) WHERE nth > 1 GROUP BY doc_id),
j AS (SELECT l.*, c.gone FROM l LEFT JOIN c USING (doc_id))
SELECT doc_id, CASE WHEN gone IS NULL THEN text ELSE array_to_string([ls[i + 1] FOR i IN range(0, len(ls)) IF NOT list_contains(gone, i)], chr(10)) END AS text,
       lang, source, n_chars, coalesce(len(ls), 0) AS n_lines, coalesce(len(gone), 0) AS n_removed
FROM j
"""
