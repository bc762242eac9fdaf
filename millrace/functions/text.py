"""Text semantics that built-in functions don't have by name: Unicode strip, paragraphs, decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every character for which Python's ``str.isspace`` holds, as the inside of a Java or RE2 class.
WHITE = r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def strip(text: Column) -> Column:
    """Without white space at both ends; ``trim`` removes U+0020 only."""
    return F.regexp_replace(text, rf"\A[{WHITE}]+|[{WHITE}]+\z", "")


def strip_sql(text: str) -> str:
    """``strip`` in DuckDB SQL."""
    return rf"regexp_replace({text}, '\A[{WHITE}]+|[{WHITE}]+\z', '', 'g')"


def paragraphs(text: Column) -> Column:
    """Stripped parts between blank lines, without empty ones."""
    return F.filter(F.transform(F.split(text, rf"\n[{WHITE}]*\n+", -1), strip), lambda p: p != "")


def decoded(content: Column) -> Column:
    """Bytes as UTF-8 with replacements for malformed ones, and universal newlines."""
    return F.regexp_replace(F.make_valid_utf8(content.cast("string")), "\r\n?", "\n")


def json_record_text(line: Column) -> Column:
    """What a JSONL record contributes: ``text``, else ``content``, else the record as it stands; a line that is no JSON, itself.

    An empty string, list or object, the number 0, false and null count as missing; the strings "0", "false" and "null" are there.
    A record that names a key twice is read by plain paths, without types.
    """
    clean = strip(line)
    record = F.try_parse_json(clean)

    def present(name: str) -> Column:
        value, kind = F.get_json_object(clean, f"$.{name}"), F.schema_of_variant(F.try_variant_get(record, f"$.{name}", "variant"))
        falsy = F.when(kind == "BOOLEAN", value == "false").when(kind.startswith("BIGINT") | kind.startswith("DECIMAL") | kind.startswith("DOUBLE"), value.try_cast("double") == 0).otherwise(value.isin("", "[]", "{}"))
        return F.when(~F.coalesce(falsy, F.lit(False)), value)

    return F.coalesce(present("text"), present("content"), clean)
