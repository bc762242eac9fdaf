"""Remote batches: a data source that reads Arrow streams over HTTP until the server has no more."""

from __future__ import annotations

import os
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

TOKEN = "CORPUS_API_TOKEN"


class _Server:
    def __init__(self, schema, options):
        self.url, self.rows, self.most = options["url"].rstrip("/"), int(options.get("max_rows", 2000)), int(options.get("max_batches", 0))
        self.names = [f.name for f in schema.fields]

    def _call(self, path: str, method: str = "GET"):
        request = urllib.request.Request(self.url + path, method=method)
        if token := os.environ.get(TOKEN):
            request.add_header("Authorization", f"Bearer {token}")
        return urllib.request.urlopen(request, timeout=60)

    def _next(self) -> tuple[str, pa.Table] | None:
        with self._call(f"/v1/batches/next?max_rows={self.rows}") as answer:
            if answer.status == 204:
                return None
            name = answer.headers["X-Batch-Id"]
            table = pa.ipc.open_stream(answer.read()).read_all()
        return name, table.append_column("batch_id", pa.array([name] * table.num_rows, pa.string())).select(self.names)

    def _ack(self, name: str) -> None:
        try:
            self._call(f"/v1/batches/{name}/ack", "POST").close()
        except OSError:
            pass  # the batch has been stored; the server may only list it as open


class BatchReader(_Server, DataSourceReader):
    """The server hands each batch out once, so one partition pulls them. With ``ack`` a batch is acknowledged as its rows are
    given on, before they are stored; a job that must not lose batches reads the stream, or calls ``acknowledge``."""

    def __init__(self, schema, options):
        super().__init__(schema, options)
        self.ack = options.get("ack", "true").lower() == "true"

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        done = 0
        while (not self.most or done < self.most) and (got := self._next()) is not None:
            yield from got[1].to_batches()
            if self.ack:
                self._ack(got[0])
            done += 1


class BatchStream(_Server, SimpleDataSourceStreamReader):
    """One batch after another; each is acknowledged once the micro-batch that holds it is committed."""

    def initialOffset(self) -> dict:
        return {"batches": 0, "names": []}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows: list[tuple] = []
        names: list[str] = []
        while (not self.most or start["batches"] + len(names) < self.most) and len(names) < 16 and (got := self._next()) is not None:
            names.append(got[0])
            rows += zip(*(c.to_pylist() for c in got[1].columns), strict=True)
        return iter(rows), ({"batches": start["batches"] + len(names), "names": names} if names else start)

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """Asked for only after a restart: batches that weren't acknowledged are handed out again by the server."""
        return iter(())

    def commit(self, end: dict) -> None:
        for name in end["names"]:
            self._ack(name)


def acknowledge(stored, url: str) -> int:
    """Acknowledge the batches of a stored table, of which the names alone come to the driver; returns their number."""
    names = [r[0] for r in stored.select("batch_id").distinct().toLocalIterator()]
    server = _Server(stored.schema, {"url": url})
    for name in names:
        server._ack(name)
    return len(names)


class BatchSource(DataSource):
    """``spark.read.format("corpus_batches").schema(...).option("url", ...)``; ``batch_id`` may be a column."""

    @classmethod
    def name(cls) -> str:
        return "corpus_batches"

    def schema(self) -> str:
        return "batch_id string, text string"

    def reader(self, schema) -> DataSourceReader:
        return BatchReader(schema, self.options)

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return BatchStream(schema, self.options)
