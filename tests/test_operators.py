import hashlib
import io
import random
import re
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.functions import fixed, keys
from millrace.functions.text import json_record_text, strip
from millrace.operators import generation, leasing, merging, rows
from millrace.operators.chunking import chunks
from millrace.sources import files
from millrace.sources.outputs import append_manifest, card, write_shards, write_splits

SPACES = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())


def packed(text, least, most):
    """Plain restatement of the packing rules."""
    out, held = [], ""
    for p in [p.strip() for p in re.split(r"\n\s*\n+", text) if p.strip()]:
        if held and len(held) + 2 + len(p) > most:
            out, held = [*out, held], p
        else:
            held = f"{held}\n\n{p}" if held else p
        if len(held) >= max(least, most):
            out, held = [*out, held], ""
    if held and out and len(held) < least:
        return [*out[:-1], f"{out[-1]}\n\n{held}"]
    return [*out, held] if held else out


def test_chunks(spark):
    draw = random.Random(1)
    texts = ["", "   ", None, "x" * 50, "a\n\nb", "a" * 10 + "\n\n" + "b" * 10]
    texts += ["".join(draw.choice("ab \n\n\n" + SPACES) for _ in range(draw.randint(0, 200))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    for r in df.select("t", chunks(F.col("t"), 5, 20).alias("c")).collect():
        assert r["c"] == (None if r["t"] is None else packed(r["t"], 5, 20)), r["t"]


def test_strip_is_unicode(spark):
    df = spark.createDataFrame([(f"{c}a{c}b{c}",) for c in SPACES], "t string")
    assert all(r[0] == r[1].strip() for r in df.select(strip(F.col("t")), "t").collect())


def test_keys(spark):
    df = spark.createDataFrame([("abc",)], "t string").select(keys.bucket(F.col("t")), keys.row_id(F.col("t"), F.lit("mn")), keys.pair_id(F.col("t")), keys.text_item_id(F.col("t"), F.lit(3)), keys.media_item_id(F.lit("image"), F.col("t")))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert tuple(df.first()) == (int(sha("abc"), 16) % 1_000_000, sha("abc||mn")[:24], sha("pair||abc||0")[:24], sha("text|abc|3")[:24], sha("image|abc")[:24])


def test_json_records(spark):
    lines = ['{"text": "a"}', '{"text": "", "content": "b"}', "{}", "not json", '{"text": null}', "[1]", '{"text": 0, "content": "c"}', '{"text": 5}']
    df = spark.createDataFrame([(x,) for x in lines], "t string")
    assert [r[0] for r in df.select(json_record_text(F.col("t"))).collect()] == ["a", "b", "{}", "not json", '{"text": null}', "[1]", "c", "5"]
    kinds = {'{"text": "0", "content": "c"}': "0", '{"text": "false"}': "false", '{"text": "null", "content": 1}': "null", '{"text": false, "content": "x"}': "x", '{"text": 0.0, "content": "x"}': "x", '{"text": [], "content": "x"}': "x", '{"text": true}': "true"}
    df = spark.createDataFrame([(x,) for x in kinds], "t string")
    assert [r[0] for r in df.select(json_record_text(F.col("t"))).collect()] == list(kinds.values())


def test_file_scan(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/x.TXT").write_bytes(b"one\r\ntwo\xff")
    (tmp_path / "a/y.JSONL").write_text('{"text": "p"}\n\n{"content": "q"}\n')
    (tmp_path / "a/z.png").write_bytes(b"\x89")
    found = {r["path"].rsplit("/", 1)[1]: r for r in files.scan(spark, str(tmp_path), "text").withColumn("text", files.file_text(F.col("path"), F.col("content"))).collect()}
    assert {k: r["text"] for k, r in found.items()} == {"x.TXT": "one\ntwo�", "y.JSONL": "p\n\nq"}
    assert found["x.TXT"]["file_sha256"] == hashlib.sha256(b"one\r\ntwo\xff").hexdigest()
    assert files.scan(spark, str(tmp_path), "image").count() == 1


GOOD = dict(id="1", source="s", category="c", type="qa", instruction="i", input="", choices=[], answer="a", thinking="", difficulty="beginner", language="mn", modality="text", media_path=None, pair_id="p")


@pytest.mark.parametrize(
    ("change", "error"),
    [
        ({}, None), ({"type": "x"}, "type='x' not in ('qa', 'mcq'"), ({"modality": "x"}, "modality='x' not in"), ({"language": "x"}, "language='x' not in ('mn', 'en')"), ({"difficulty": None}, "difficulty=None not in"),
        ({"type": "mcq"}, ">=2 choices"), ({"type": "mcq", "choices": ["b", "c"]}, "verbatim"), ({"type": "mcq", "choices": ["a", "c"]}, None),
        ({"instruction": " "}, "instruction is empty"), ({"answer": " "}, "answer is empty"), ({"answer": " ", "type": "dpo"}, None), ({"answer": None}, "null_field"), ({"modality": "image"}, "modality=image requires media_path"),
    ],
)
def test_row_errors(spark, change, error):
    found = spark.createDataFrame([GOOD | change], fixed.ROW_DDL).select(rows.row_errors().alias("e")).first()["e"]
    assert (not found) if error is None else len(found) == 1 and error in found[0]


def test_normalised_rows(spark):
    assert rows.normalised(spark.createDataFrame([("1", 2)], "id string, extra int")).columns == list(fixed.ROW_COLUMNS)


@pytest.mark.parametrize(("n", "sizes"), [(0, (0, 0)), (9, (0, 0)), (10, (1, 0)), (100, (10, 9)), (20_000, (800, 300))])
def test_split_sizes(n, sizes):
    assert merging.split_sizes(n) == sizes


def test_merge_order_is_by_parts_of_the_path(spark):
    df = spark.createDataFrame([("k", "a-b", 0, 0, "late"), ("k", "a", 0, 1, "second"), ("k", "a", 0, 0, "first")], "id string, worker string, part int, line int, v string")
    assert merging.keep_first(df, ["id"], ["worker", "part", "line"]).first()["v"] == "first"


def test_scans_keep_the_first_path_by_its_parts(spark, tmp_path):
    from millrace.__main__ import scan

    for name, text in (("a-b/x.txt", "same"), ("a/x.txt", "same"), ("a/y.TXT", "other"), ("b.md", "\n\n")):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_text(text)
    for _ in range(2):
        scan(spark, f"{tmp_path}/in", f"{tmp_path}/manifest")
        got = spark.read.parquet(f"{tmp_path}/manifest").collect()
        assert sorted(r["path"].split("/in/")[1] for r in got) == ["a/x.txt", "a/y.TXT"]


def test_scan_counts(spark):
    items = spark.createDataFrame([("text", "a", 0), ("text", "b", 1), ("text", "c", 0), ("text", None, None), ("image", "i", None), ("image", "j", None), ("audio", "s", None), ("image", "j", None)], "modality string, item_id string, chunk_index long")
    seen = spark.createDataFrame([("b",), ("b",), ("s",), ("z",), (None,)], "item_id string")
    got = files.scan_counts(items, seen).collect()
    assert [r.asDict() for r in got] == [{"text_chunks": 2, "images": 3, "audio": 0, "skipped_existing": 2, "files_scanned": 7, "new_items": 5}]
    assert files.scan_counts(items.limit(0), seen).first()["files_scanned"] == 0


def test_queue(spark):
    log = [("late", 0, 0, "done"), ("late", 1, 1, "failed"), ("dead", 0, 2, "failed"), ("dead", 1, 3, "oops"), ("dead", 2, 4, "failed"), ("dead", 3, 5, "failed"), ("due", 0, 6, "lease"), ("over", -1, 7, "lease"), ("twice", 0, 8, "done"), ("twice", 1, 9, "done")]
    df = spark.createDataFrame(log, "item string, s int, seq int, message string").withColumn("ts", F.timestamp_seconds("s"))
    items = leasing.replay(df, F.timestamp_seconds(F.lit(10)), ttl=10)
    assert {r["item"]: (r["status"], r["attempts"]) for r in items.collect()} == {"late": ("pending", 1), "dead": ("dead", 4), "due": ("leased", 0), "over": ("pending", 0), "twice": ("done", 0)}
    assert [r["item"] for r in leasing.lease(items, 1).collect()] == ["over"]
    assert {r["status"]: r["n"] for r in leasing.status_counts(items).collect()}["total"] == 5


class Flaky(generation.Echo):
    def __init__(self, *answers):
        self.answers, self.asked = list(answers), []

    def chat(self, messages):
        self.asked.append(len(messages))
        answer = self.answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return {"content": answer, "thinking": ""}


def test_generation_retries_and_repairs(spark):
    waits = []
    client = Flaky(OSError("x"), "not json", "{}")
    assert generation.ask(client, "p", sleep=waits.append)["content"] == "{}"
    assert (waits, client.asked) == ([5.0], [1, 1, 3])
    with pytest.raises(generation.MissingModel):
        generation.ask(Flaky(generation.MissingModel(), "[]", generation.MissingModel()), "p", sleep=waits.append)
    assert generation.ready(generation.Echo(), "echo") and not generation.ready(generation.Echo(), "other")
    made = generation.generate(spark.createDataFrame([("1", "say\nhi")], "id string, prompt string"), generation.Echo).first()
    assert made["error"] is None and '"answer": "hi"' in made["content"]


def test_batches_over_http(spark):
    from millrace.sources.batches import BatchSource

    left, acked = ["b1", "b2"], []

    class Server(BaseHTTPRequestHandler):
        def do_GET(self):
            if not left:
                self.send_response(204)
                self.end_headers()
                return
            sink = io.BytesIO()
            table = pa.table({"text": [f"{left[0]}-{k}" for k in range(3)], "more": [1, 2, 3]})
            with pa.ipc.new_stream(sink, table.schema) as w:
                w.write_table(table)
            self.send_response(200)
            self.send_header("X-Batch-Id", left.pop(0))
            self.end_headers()
            self.wfile.write(sink.getvalue())

        def do_POST(self):
            acked.append(self.path)
            self.send_response(200)
            self.end_headers()

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    spark.dataSource.register(BatchSource)
    got = spark.read.format("corpus_batches").option("url", f"http://127.0.0.1:{server.server_port}").load().collect()
    server.shutdown()
    assert sorted(r["text"] for r in got) == [f"b{b}-{k}" for b in (1, 2) for k in range(3)]
    assert acked == ["/v1/batches/b1/ack", "/v1/batches/b2/ack"]


def test_a_stream_acknowledges_what_is_committed():
    from pyspark.sql.types import StringType, StructField, StructType

    from millrace.sources.batches import BatchStream

    stream = BatchStream(StructType([StructField("batch_id", StringType()), StructField("text", StringType())]), {"url": "http://none"})
    left, acked = [("b1", pa.table({"batch_id": ["b1"], "text": ["x"]})), ("b2", pa.table({"batch_id": ["b2"], "text": ["y"]}))], []
    stream._next, stream._ack = (lambda: left.pop(0) if left else None), acked.append
    rows_, end = stream.read(stream.initialOffset())
    assert list(rows_) == [("b1", "x"), ("b2", "y")] and not acked
    stream.commit(end)
    assert acked == ["b1", "b2"]
    assert stream.read(end)[1] == end


def test_shards_in_path_and_line_order(spark, tmp_path):
    for worker, part, lines in (("w1", 0, ['{"id": "a", "answer": "1"}', "", '{"id": "b"}']), ("w0", 1, ['{"id": "a", "answer": "2"}'])):
        (tmp_path / worker).mkdir()
        (tmp_path / worker / f"part-{part:05d}.jsonl").write_text("\n".join(lines))
    found = files.read_shards(spark, str(tmp_path))
    kept = merging.keep_first(found, ["id"], ["worker", "part", "line"])
    assert sorted((r["id"], r["worker"], r["part"], r["line"], r["answer"]) for r in kept.collect()) == [("a", "w0", "part-00001.jsonl", 0, "2"), ("b", "w1", "part-00000.jsonl", 2, None)]


def test_whole_items_and_rejects(spark):
    from millrace.operators import items

    class Wrong:
        def models(self):
            return ["m:1"]

        def chat(self, messages):
            if "refuse" in messages[0]["content"]:
                return {"content": "no", "thinking": ""}
            return {"content": '{"answer": " ", "instruction": "i", "type": "qa", "difficulty": "beginner"}', "thinking": "t"}

    chunks_ = spark.createDataFrame([("i1", "p1", "text"), ("i2", "p2", "refuse")], "item_id string, path string, body string")
    got = items.process(chunks_, "text", Wrong, wait=0.0, model="m")
    assert items.good(got).count() == 0
    errors = {(r["source"], r["error"]) for r in items.rejects(got).collect()}
    assert ("p1", "answer is empty") in errors and len([e for s, e in errors if s == "p2"]) == 1
    assert got.filter("source = 'p1'").first()["category"] == "uncategorized"
    said = spark.createDataFrame([("i1", "a.mp3", " said "), ("i2", "b.mp3", " \n")], "item_id string, path string, body string")
    audio = items.good(items.process(said, "audio", generation.Echo)).collect()
    assert {(r["input"], r["media_path"], r["language"]) for r in audio} == {(" said ", "a.mp3", "mn"), (" said ", "a.mp3", "en")}


def test_queue_tells_owner_and_unknown_items(spark):
    items_ = spark.createDataFrame([(1, "pending", 5), (2, "done", 6)], "item long, status string, first_seen long")
    given = leasing.leased(items_, "w", F.lit("2024-01-01").cast("timestamp")).collect()
    assert [(r["item"], r["status"], r["owner"], str(r["expires"])) for r in given] == [(1, "leased", "w", "2024-01-01 00:20:00")]
    log = spark.createDataFrame([(9, "done"), (1, "done"), (8, "lease")], "item long, message string")
    assert [r["item"] for r in leasing.unknown_completions(log, items_).collect()] == [9]


def test_shards_of_a_writer_in_many_ranges(spark):
    rows = [(k, "hot" if k % 3 else None if k % 2 else "cold", k) for k in range(3000)]
    table = spark.createDataFrame(rows, "id long, writer string, shard long").repartition(7)
    got = {r["id"]: r["shard"] for r in merging.shard_numbers(table, "writer", ["id"], 10).collect()}
    for writer in ("hot", "cold", None):
        own = [k for k, w, _ in rows if w == writer]
        assert [got[k] for k in own] == [n // 10 for n in range(len(own))]
    assert merging.shard_numbers(table.limit(0), "writer", ["id"], 10).collect() == []


def test_sinks(spark, tmp_path):
    ids = spark.createDataFrame([("a",), ("b",)], "item_id string")
    append_manifest(ids, f"{tmp_path}/m")
    append_manifest(ids.union(spark.createDataFrame([("c",)], "item_id string")), f"{tmp_path}/m", spark.read.parquet(f"{tmp_path}/m"))
    assert sorted(r[0] for r in spark.read.parquet(f"{tmp_path}/m").collect()) == ["a", "b", "c"]
    write_shards(spark.range(25, numPartitions=1), f"{tmp_path}/s", 10)
    assert len(list((tmp_path / "s").glob("part-*"))) == 3
    split = merging.assign_splits(spark.range(100).select(F.col("id").cast("string")), "id")
    write_splits(split, f"{tmp_path}/d")
    assert "| test | 10 |" in card(split) and {p.name for p in (tmp_path / "d").glob("split=*")} == {"split=test", "split=validation", "split=train"}


def test_ingest_twice_adds_nothing(spark, tmp_path):
    from millrace.streaming.ingest import ingest

    spark.createDataFrame([("a",), ("b",), ("a",)], "text string").write.parquet(f"{tmp_path}/in/1")
    at = (f"{tmp_path}/in/*", "text string", f"{tmp_path}/out", f"{tmp_path}/state")
    assert ingest(spark, *at).count() == 2
    assert ingest(spark, *at).count() == 2
    spark.createDataFrame([("b",), ("c",), (None,)], "text string").write.parquet(f"{tmp_path}/in/2")
    assert ingest(spark, *at).count() == 4
