"""Content-hash identities and hash buckets, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SHORT = 24


def short_hash(*parts: Column) -> Column:
    """First 24 hexadecimal digits of SHA-256 of the parts; null if a part is."""
    return F.substring(F.sha2(F.concat(*parts), 256), 1, SHORT)


def text_item_id(file_sha256: Column, chunk_index: Column) -> Column:
    return short_hash(F.lit("text|"), file_sha256, F.lit("|"), chunk_index.cast("string"))


def media_item_id(modality: Column, file_sha256: Column) -> Column:
    return short_hash(modality, F.lit("|"), file_sha256)


def row_id(item_id: Column, language: Column) -> Column:
    return short_hash(item_id, F.lit("||"), language)


def pair_id(item_id: Column, variant: int = 0) -> Column:
    return short_hash(F.lit("pair||"), item_id, F.lit(f"||{variant}"))


def bucket(text: Column, modulus: int = 1_000_000) -> Column:
    """The whole SHA-256 of ``text`` as an integer, modulo ``modulus``; eight steps of 32 bits."""
    digest = F.sha2(text, 256)
    out = F.lit(0).cast("long")
    for k in range(8):
        out = (out * F.lit(2**32) + F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")) % modulus
    return out


def bucket_sql(text: str, modulus: int = 1_000_000) -> str:
    """``bucket`` in DuckDB SQL."""
    out = "0"
    for k in range(8):
        out = f"(({out}) * 4294967296 + CAST('0x' || substr(sha256({text}), {8 * k + 1}, 8) AS BIGINT)) % {modulus}"
    return out


def weighted_pick(key: Column, salt: str, weights: dict[str, int]) -> Column:
    """One of the names by integer weights: a hash of ``key`` stands in for the draw, so reruns agree."""
    draw, upto, out = bucket(F.concat(F.lit(f"{salt}|"), key)) % sum(weights.values()), 0, None
    for name, weight in weights.items():
        upto += weight
        out = (F.when if out is None else out.when)(draw < upto, name)
    return out


def weighted_pick_sql(key: str, salt: str, weights: dict[str, int]) -> str:
    upto, cases = 0, ""
    for name, weight in weights.items():
        upto += weight
        cases += f" WHEN ({bucket_sql(f"'{salt}|' || {key}")}) % {sum(weights.values())} < {upto} THEN '{name}'"
    return f"CASE{cases} END"
