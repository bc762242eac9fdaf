"""Prompts, model replies and validation of dataset rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions.keys import pair_id, row_id
from millrace.functions.text import strip


def _map(values: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[key]


def prompt(template: str, language: Column, task: Column, difficulty: Column, chunk: Column | None = None) -> Column:
    """A prompt template filled in; braces in a chunk are plain text."""
    filled = {"lang": _map(fixed.LANGUAGE_NAMES, language), "type": task, "guidance": _map(fixed.TASK_GUIDANCE, task), "difficulty": difficulty, "chunk": chunk}
    parts: list[Column] = []
    rest = template
    while rest:
        plain, _, tail = rest.partition("{")
        parts.append(F.lit(plain))
        name, _, rest = tail.partition("}")
        if name:
            parts.append(filled[name])
    return F.concat(*parts)


def fan_out(items: DataFrame, languages: tuple[str, ...] = fixed.LANGUAGES) -> DataFrame:
    """A row for every item and language, with the row's id and the id that its languages share."""
    spread = items.withColumn("language", F.explode(F.array(*map(F.lit, languages))))
    return spread.withColumn("id", row_id(F.col("item_id"), F.col("language"))).withColumn("pair_id", pair_id(F.col("item_id")))


def reply_fields(reply: Column, defaults: dict[str, Column]) -> list[Column]:
    """Fields of a JSON reply as strings: a default only where the key is absent, null where it says null."""
    fields = F.from_json(reply, "map<string,string>")
    return [F.when(F.map_contains_key(fields, name), fields[name]).otherwise(value).alias(name) for name, value in defaults.items()]


def row_errors(c=F.col) -> Column:
    """array<string>: what is wrong with a dataset row; empty if nothing is."""

    def known(name: str, values: tuple[str, ...]) -> Column:
        said = F.coalesce(F.concat(F.lit("'"), c(name), F.lit("'")), F.lit("None"))
        return F.when(~c(name).isin(*values) | c(name).isNull(), F.concat(F.lit(f"{name}="), said, F.lit(f" not in {values}")))

    mcq = c("type") == "mcq"
    few = c("choices").isNull() | (F.size("choices") < 2)
    found = F.array(
        known("type", fixed.TASK_TYPES),
        known("modality", fixed.MODALITIES),
        known("language", fixed.LANGUAGES),
        known("difficulty", fixed.DIFFICULTIES),
        F.when(mcq & few, "mcq row needs >=2 choices"),
        F.when(mcq & ~few & ~F.coalesce(F.array_contains("choices", c("answer")), F.lit(False)), "mcq answer must be one of choices verbatim"),
        F.when(c("instruction").isNull() | c("answer").isNull(), "null_field"),
        F.when(strip(c("instruction")) == "", "instruction is empty"),
        F.when((strip(c("answer")) == "") & (c("type") != "dpo"), "answer is empty"),
        F.when(c("modality").isin("image", "audio") & (F.coalesce(c("media_path"), F.lit("")) == ""), F.concat(F.lit("modality="), c("modality"), F.lit(" requires media_path"))),
    )
    return F.filter(found, lambda e: e.isNotNull())


def normalised(rows: DataFrame) -> DataFrame:
    """The dataset's columns in order: missing ones null, others dropped."""
    kinds = dict(zip(fixed.ROW_COLUMNS, (x.split()[1] for x in fixed.ROW_DDL.split(", ")), strict=True))
    return rows.select(*[(F.col(n) if n in rows.columns else F.lit(None)).cast(kinds[n]).alias(n) for n in fixed.ROW_COLUMNS])
