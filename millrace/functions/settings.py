"""Settings: nested values, overridden by environment variables ``PIPELINE_A__B=value``; the folder that executors share."""

from __future__ import annotations

import copy
import os
import re
from collections.abc import Mapping
from tempfile import mkdtemp

from pyspark.sql import SparkSession

PREFIX = "PIPELINE_"
#: Names the settings file itself, so it is no override.
FILE_VARIABLE = "PIPELINE_CONFIG"


def coerced(value: str):
    """true and false as booleans, then integers, then numbers, else the text."""
    if value.lower() in ("true", "false"):
        return value.lower() == "true"
    for kind in (int, float):
        try:
            return kind(value)
        except ValueError:
            pass
    return value


def overridden(settings: Mapping, environment: Mapping[str, str] = os.environ) -> dict:
    """A copy of ``settings`` with the overrides of ``environment``; names are lower-cased, missing levels made."""
    out = copy.deepcopy(dict(settings))
    for name, value in sorted(environment.items()):
        if name.startswith(PREFIX) and name != FILE_VARIABLE:
            *above, last = name[len(PREFIX) :].lower().split("__")
            at = out
            for level in above:
                if not isinstance(at.get(level), dict):
                    at[level] = {}
                at = at[level]
            at[last] = coerced(value)
    return out


def load(path: str, environment: Mapping[str, str] = os.environ) -> dict:
    """Settings from a YAML or JSON file. YAML needs its library; JSON doesn't."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        import json

        return overridden(json.loads(text), environment)
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("YAML settings need the yaml library; use JSON instead") from error
    return overridden(yaml.safe_load(text), environment)


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset on one machine (tests), a temporary one."""
    place = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        place = f"file://{mkdtemp(prefix='millrace-')}"
    return place.rstrip("/")
