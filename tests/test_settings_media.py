import json

from millrace.functions.settings import load, overridden
from millrace.sources.media import transcribe


def test_overrides(tmp_path):
    env = {"PIPELINE_A__B": "3", "PIPELINE_X": "true", "PIPELINE_A__C": "1.5", "PIPELINE_N": "null", "PIPELINE_CONFIG": "f", "OTHER": "1"}
    assert overridden({"a": {"b": 1, "d": 2}}, env) == {"a": {"b": 3, "c": 1.5, "d": 2}, "x": True, "n": "null"}
    (tmp_path / "s.json").write_text(json.dumps({"a": 1}))
    assert load(f"{tmp_path}/s.json", {}) == {"a": 1}


def test_transcripts_use_the_cache(spark):
    audio = spark.createDataFrame([("1", b"a"), ("2", b"b")], "item_id string, content binary")
    cache = spark.createDataFrame([("2", "known", "en", "cache"), ("9", "x", "en", "cache")], "item_id string, text string, detected_language string, source string")
    got = {r["item_id"]: r["text"] for r in transcribe(audio, lambda: lambda data: ([" heard ", data.decode()], "mn"), cache).collect()}
    assert got == {"1": "heard a", "2": "known"}
