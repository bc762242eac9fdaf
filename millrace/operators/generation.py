"""Model calls: a client for each partition, retries, repair of malformed JSON."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Backend(Protocol):
    def models(self) -> list[str]: ...

    def chat(self, messages: list[dict]) -> dict:
        """{"content": str, "thinking": str}; raises ``MissingModel``, or another error that may pass."""


class MissingModel(Exception):
    """The model isn't there; one more try may find it loaded."""


class Echo:
    """A deterministic backend for tests: a question about the prompt's last line."""

    def models(self) -> list[str]:
        return ["echo"]

    def chat(self, messages: list[dict]) -> dict:
        last = messages[0]["content"].strip().rsplit("\n", 1)[-1]
        return {"content": json.dumps({"category": "echo", "type": "qa", "instruction": "Repeat.", "answer": last, "difficulty": "beginner"}), "thinking": ""}


class HttpChat:
    """A chat server over HTTP: ``/api/tags`` lists models, ``/api/chat`` answers with JSON that follows a schema."""

    def __init__(self, url: str, model: str, schema: dict | None = None, think: bool = True, context: int = 16384, timeout: float = 600.0):
        self.url, self.model, self.schema, self.think, self.context, self.timeout = url.rstrip("/"), model, schema, think, context, timeout

    def _call(self, path: str, body: dict | None = None) -> dict:
        data = None if body is None else json.dumps(body).encode()
        request = urllib.request.Request(self.url + path, data, {"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                return json.loads(answer.read())
        except urllib.error.HTTPError as error:
            if error.code == 404:
                raise MissingModel(f"{self.model} at {self.url}") from error
            raise

    def models(self) -> list[str]:
        return [m["name"] for m in self._call("/api/tags").get("models", [])]

    def chat(self, messages: list[dict]) -> dict:
        body = {"model": self.model, "messages": messages, "think": self.think, "stream": False, "options": {"num_ctx": self.context}}
        said = self._call("/api/chat", body | ({"format": self.schema} if self.schema else {})).get("message", {})
        return {"content": said.get("content", ""), "thinking": said.get("thinking") or ""}


def ready(backend: Backend, model: str, tries: int = 1, wait: float = 15.0) -> bool:
    """Whether the model is listed, with or without a tag, asked ``tries`` times."""
    for k in range(tries):
        if any(m == model or m.split(":", 1)[0] == model for m in backend.models()):
            return True
        if k + 1 < tries:
            time.sleep(wait)
    return False


def ask(backend: Backend, prompt: str, tries: int = 3, wait: float = 5.0, sleep: Callable[[float], None] = time.sleep, image: str | None = None) -> dict:
    """A reply whose content is a JSON object. Malformed JSON is sent back for repair at once; errors wait longer each time."""
    messages, last = [{"role": "user", "content": prompt} | ({"images": [image]} if image else {})], "no reply"
    for attempt in range(1, tries + 1):
        try:
            reply = backend.chat(messages)
        except MissingModel:
            if attempt > 1:
                raise
            sleep(wait)
            continue
        except OSError as error:
            last = str(error)
            sleep(wait * attempt)
            continue
        try:
            if isinstance(json.loads(reply["content"]), dict):
                return reply
            last = "not an object"
        except ValueError as error:
            last = str(error)
        messages = [*messages, {"role": "assistant", "content": reply["content"]}, {"role": "user", "content": "That was not a valid JSON object. Send the corrected JSON object only."}]
    raise ValueError(last)


def generate(prompts: DataFrame, backend: Callable[[], Backend], tries: int = 3, wait: float = 5.0, model: str | None = None) -> DataFrame:
    """(id, content, thinking, error) for (id, prompt) or (id, prompt, image in base64). A failed call is a row with an error, so one
    task's retry repeats no other's calls; switch speculation off for backends that cost. With ``model``, a task
    first waits until the backend lists it, and fails if it doesn't."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = backend()
        if model is not None and not ready(client, model, tries, wait):
            raise RuntimeError(f"{model} isn't ready")
        for b in batches:
            rows = []
            for i, text, image in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                try:
                    reply = ask(client, text, tries, wait, image=image)
                    rows.append((i, reply["content"], reply["thinking"], None))
                except (ValueError, MissingModel) as error:
                    rows.append((i, None, None, str(error)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(4)], names=["id", "content", "thinking", "error"])

    image = F.col("image") if "image" in prompts.columns else F.lit(None).cast("string").alias("image")
    return prompts.select("id", "prompt", image).mapInArrow(run, "id string, content string, thinking string, error string")
