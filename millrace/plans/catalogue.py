"""Registered queries of the dataset-preparation operators, and their DuckDB SQL.

``documents`` stand in for text files and JSONL records, ``conversations`` for transcripts, ``pages`` for media paths and
``events`` for queue messages (view and signup: lease; click and purchase: done; error: failed; item: the user).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import fixed, keys
from millrace.functions.settings import shared_dir
from millrace.functions.text import WHITE, json_record_text, strip, strip_sql
from millrace.operators import items, leasing, merging, rows
from millrace.operators.chunking import chunks, chunks_sql
from millrace.operators.generation import Echo
from millrace.sources import files
from millrace.streaming.ingest import ingest

STRESS = (100, 500)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _digest() -> Column:
    return F.sha2(F.coalesce("text", F.lit("")), 256)


_DIGEST = "sha256(coalesce(text, ''))"


def _chunked(docs: DataFrame, text: Column, least: int, most: int) -> DataFrame:
    packed = docs.select("doc_id", _digest().alias("file_sha256"), chunks(text, least, most).alias("cs"))
    return packed.select("doc_id", "file_sha256", F.size("cs").cast("long").alias("total_chunks"), F.posexplode("cs").alias("at", "chunk")).withColumn("chunk_index", F.col("at").cast("long")).drop("at")


def _items(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "lang", "source", "text", keys.text_item_id(_digest(), F.lit(0)).alias("item_id"))


_ITEM = f"substr(sha256('text|' || {_DIGEST} || '|0'), 1, 24)"


def text_manifest(spark, sf_dir):
    """Every line of a document a paragraph, packed to 600 to 4000 characters."""
    docs = _table(spark, sf_dir, "documents")
    got = _chunked(docs, F.replace("text", F.lit("\n"), F.lit("\n\n")), fixed.MIN_CHARS, fixed.MAX_CHARS)
    return got.select(keys.text_item_id(F.col("file_sha256"), F.col("chunk_index")).alias("item_id"), F.lit("text").alias("modality"), F.concat(F.lit("documents/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), "file_sha256", "chunk_index", "total_chunks")


def chunk_stress(spark, sf_dir):
    got = _chunked(_table(spark, sf_dir, "documents"), F.replace("text", F.lit("\n"), F.lit("\n\n")), *STRESS)
    return got.select("doc_id", "chunk_index", "total_chunks", F.sha2("chunk", 256).alias("chunk_sha256"))


def chunk_stats(spark, sf_dir):
    """Of the chunks of all documents, every line a paragraph."""
    got = _chunked(_table(spark, sf_dir, "documents"), F.replace("text", F.lit("\n"), F.lit("\n\n")), fixed.MIN_CHARS, fixed.MAX_CHARS)
    return got.agg(F.count("*").alias("text_chunks"), F.countDistinct("doc_id").alias("files"), F.max(F.length("chunk")).cast("long").alias("longest"), F.sum(F.length("chunk")).alias("characters"))


def py_strip_lines(spark, sf_dir):
    lines = _table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    return lines.select("doc_id", F.col("at").cast("long").alias("line_no"), strip(F.col("line")).alias("line")).filter("line <> ''")


#: Records with both keys, one, none; of every JSON type; and lines that are no JSON.
_RECORDS = ('{"text": "0", "content": "c"}', '{"text": "false"}', '{"text": 0, "content": "x"}', '{"text": "", "content": "é"}', '{"text": null, "content": 7}', '{"text": true, "content": "y"}', "no json", '{"content": [], "k": 1}', ' {"text": " a "} ')


def jsonl_text_coalesce(spark, sf_dir):
    """The properties of every event as a record, and one of each kind in turn."""
    events = _table(spark, sf_dir, "events")
    made = F.get(F.array(*map(F.lit, _RECORDS)), (F.col("event_id") % len(_RECORDS)).cast("int"))
    return events.select("event_id", json_record_text(F.col("props")).alias("text"), json_record_text(made).alias("made_text"))


def _record_sql(line: str) -> str:
    def present(name: str) -> str:
        value, kind = f"json_extract_string({line}, '$.{name}')", f"json_type({line}, '$.{name}')"
        return f"CASE WHEN {kind} = 'NULL' OR ({kind} = 'BOOLEAN' AND {value} = 'false') OR ({kind} IN ('BIGINT', 'UBIGINT', 'DOUBLE') AND TRY_CAST({value} AS DOUBLE) = 0) OR {value} IN ('', '[]', '{{}}') THEN NULL ELSE {value} END"

    return f"CASE WHEN json_valid({line}) THEN coalesce({present('text')}, {present('content')}, {line}) ELSE {line} END"


def item_ids(spark, sf_dir):
    return rows.fan_out(_items(_table(spark, sf_dir, "documents")).select("doc_id", "item_id"))


def manifest_keep_first(spark, sf_dir):
    listed = _items(_table(spark, sf_dir, "documents")).select("item_id", "doc_id", "source")
    return merging.keep_first(listed, ["item_id"], ["doc_id"])


def manifest_novelty(spark, sf_dir):
    """Contents that the manifest doesn't have: it lists benchmark items and what the first source by name holds."""
    own = _items(_table(spark, sf_dir, "documents")).select("doc_id", "item_id", "source")
    listed = _table(spark, sf_dir, "benchmark").select(keys.text_item_id(_digest(), F.lit(0)).alias("item_id"))
    first = own.agg(F.min("source").alias("source"))
    return merging.unseen(own, listed.unionByName(own.join(F.broadcast(first), "source").select("item_id")), "item_id").select("doc_id", "item_id")


def scan_stats(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select(_digest().alias("d"), F.lit("text").alias("kind"))
    pages = _table(spark, sf_dir, "pages").select(F.sha2(F.coalesce("html", F.lit("")), 256).alias("d"), F.lit("page").alias("kind"))
    return docs.unionByName(pages).groupBy("kind").agg(F.count("*").alias("files_scanned"), F.countDistinct("d").alias("new_items"))


def scan_counters(spark, sf_dir):
    """A scan of documents as text files and of pages as files of all kinds, with a manifest of what the first source by name holds."""
    docs = _table(spark, sf_dir, "documents").select("source", _digest().alias("d"), chunks(F.replace("text", F.lit("\n"), F.lit("\n\n"))).alias("cs"))
    texts = docs.select("source", "d", F.posexplode_outer("cs").alias("chunk_index", "chunk")).select("source", F.lit("text").alias("modality"), F.when(F.col("chunk_index").isNotNull(), keys.text_item_id(F.col("d"), F.col("chunk_index"))).alias("item_id"), F.col("chunk_index").cast("long").alias("chunk_index"))
    media = _paths(spark, sf_dir, F.sha2(F.coalesce("html", F.lit("")), 256).alias("d")).withColumn("modality", files.modality(F.col("path"))).filter(F.col("modality").isin("image", "audio"))
    listed = media.select("modality", keys.media_item_id(F.col("modality"), F.col("d")).alias("item_id"), F.lit(None).cast("long").alias("chunk_index"))
    first = _table(spark, sf_dir, "documents").agg(F.min("source").alias("source"))
    return files.scan_counts(texts.drop("source").unionByName(listed), texts.join(F.broadcast(first), "source"))


def _paths(spark, sf_dir, *more):
    suffixes = F.array(*map(F.lit, (".TXT", ".md", ".JPG", ".webp", ".Mp3", ".opus", ".exe", "")))
    return _table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("/data/in/"), F.col("page_id").cast("string"), F.get(suffixes, (F.col("page_id") % 8).cast("int"))).alias("path"), *more)


def ext_modality(spark, sf_dir):
    return _paths(spark, sf_dir).select("page_id", files.relative(F.col("path"), "/data").alias("path"), files.extension(F.col("path")).alias("extension"), files.modality(F.col("path")).alias("modality"))


def path_containment(spark, sf_dir):
    shapes = F.array(F.lit("a/../b"), F.lit("../x"), F.lit("a//./b"), F.lit("a/../../data/c"), F.lit("/etc/passwd"))
    p = F.concat(F.get(shapes, (F.col("page_id") % 5).cast("int")), F.lit("/"), F.col("page_id").cast("string"))
    return _table(spark, sf_dir, "pages").select("page_id", files.contained(p, "/data").alias("contained"))


def _picked(docs: DataFrame) -> DataFrame:
    return items.picked(_items(docs)).withColumnRenamed("level", "difficulty")


_PICKED = f"""picked AS (SELECT *, {keys.weighted_pick_sql("item_id", "task", fixed.TASK_WEIGHTS)} AS task_type, {keys.weighted_pick_sql("item_id", "difficulty", dict.fromkeys(fixed.DIFFICULTIES, 1))} AS difficulty FROM (SELECT doc_id, lang, source, text, {_ITEM} AS item_id FROM documents))"""


def task_pick(spark, sf_dir):
    return _picked(_table(spark, sf_dir, "documents")).select("doc_id", "item_id", "task_type", "difficulty")


def task_mix_counts(spark, sf_dir):
    return _picked(_table(spark, sf_dir, "documents")).groupBy("task_type", "difficulty").agg(F.count("*").alias("n"))


def text_prompt(spark, sf_dir):
    spread = rows.fan_out(_picked(_table(spark, sf_dir, "documents")))
    made = rows.prompt(fixed.TEXT_PROMPT, F.col("language"), F.col("task_type"), F.col("difficulty"), F.coalesce("text", F.lit("")))
    return spread.select("doc_id", "language", F.length(made).cast("long").alias("n_chars"), F.sha2(made, 256).alias("prompt_sha256"))


def image_prompt(spark, sf_dir):
    spread = rows.fan_out(_picked(_table(spark, sf_dir, "documents")))
    return spread.select("doc_id", "language", F.sha2(rows.prompt(fixed.IMAGE_PROMPT, F.col("language"), F.col("task_type"), F.col("difficulty")), 256).alias("prompt_sha256"))


def transcript_concat(spark, sf_dir):
    """Segments stripped, joined by a space in order, stripped; empty transcripts go."""
    said = _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", strip(F.coalesce("text", F.lit(""))).alias("t")))).alias("s"))
    return said.select("conv_id", strip(F.array_join(F.transform("s", lambda x: x["t"]), " ")).alias("transcript")).filter("transcript <> ''")


def audio_prompt(spark, sf_dir):
    made = rows.prompt(fixed.AUDIO_PROMPT, F.lit("mn"), F.lit("qa"), F.lit("beginner"), F.col("transcript"))
    return transcript_concat(spark, sf_dir).select("conv_id", F.sha2(made, 256).alias("prompt_sha256"))


def _replies(spark, sf_dir):
    """A JSON reply for every document, by id with absent keys, nulls and lists."""
    d = F.col("doc_id")
    reply = (
        F.when(d % 7 == 0, F.lit('{"type": null, "answer": "a"}'))
        .when(d % 7 == 1, F.lit('{"type": "mcq", "choices": ["a", "b"], "answer": "a", "instruction": "i", "difficulty": "beginner"}'))
        .when(d % 7 == 2, F.lit('{"type": "mcq", "choices": ["a"], "answer": "a", "instruction": "i"}'))
        .when(d % 7 == 3, F.lit('{"type": "dpo", "answer": " ", "instruction": "i", "difficulty": "hard"}'))
        .when(d % 7 == 4, F.lit('{"instruction": " ", "answer": "", "input": "", "category": "c"}'))
        .when(d % 7 == 5, F.lit('{"type": "mcq", "choices": ["a", "b"], "answer": "x", "instruction": "i"}'))
        .otherwise(F.lit('{"instruction": "i", "answer": "b"}'))
    )
    return _picked(_table(spark, sf_dir, "documents")).withColumn("reply", reply)


_REPLIES = """replies AS (SELECT *, CASE doc_id % 7
  WHEN 0 THEN '{"type": null, "answer": "a"}'
  WHEN 1 THEN '{"type": "mcq", "choices": ["a", "b"], "answer": "a", "instruction": "i", "difficulty": "beginner"}'
  WHEN 2 THEN '{"type": "mcq", "choices": ["a"], "answer": "a", "instruction": "i"}'
  WHEN 3 THEN '{"type": "dpo", "answer": " ", "instruction": "i", "difficulty": "hard"}'
  WHEN 4 THEN '{"instruction": " ", "answer": "", "input": "", "category": "c"}'
  WHEN 5 THEN '{"type": "mcq", "choices": ["a", "b"], "answer": "x", "instruction": "i"}'
  ELSE '{"instruction": "i", "answer": "b"}' END AS reply FROM picked)"""


_KINDS = ("text", "image", "audio", "video", "text")


def _fields(replies: DataFrame) -> DataFrame:
    defaults = {"category": F.lit("uncategorized"), "type": F.col("task_type"), "instruction": F.lit(""), "input": F.lit(""), "answer": F.lit(""), "difficulty": F.col("difficulty")}
    found = rows.reply_fields(F.col("reply"), defaults)
    choices = F.coalesce(F.from_json(F.get_json_object("reply", "$.choices"), "array<string>"), F.array().cast("array<string>"))
    return replies.select("doc_id", "item_id", F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, "a.png").alias("media_path"), F.get(F.array(*map(F.lit, _KINDS)), (F.col("doc_id") % 5).cast("int")).alias("modality"), choices.alias("choices"), *found)


def model_json_defaults(spark, sf_dir):
    return _fields(_replies(spark, sf_dir)).select("doc_id", "category", "type", "instruction", "input", "answer", "difficulty", F.size("choices").cast("long").alias("n_choices"))


def _default(name: str, value: str) -> str:
    return f"CASE WHEN list_contains(json_keys(reply), '{name}') THEN json_extract_string(reply, '$.{name}') ELSE {value} END AS {name}"


_FIELDS = f"""fields AS (SELECT doc_id, item_id, {_default("category", "'uncategorized'")}, {_default("type", "task_type")}, {_default("instruction", "''")}, {_default("input", "''")}, {_default("answer", "''")}, {_default("difficulty", "difficulty")}, coalesce(CAST(json_extract(reply, '$.choices') AS VARCHAR[]), CAST([] AS VARCHAR[])) AS choices, CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'a.png' END AS media_path, ({list(_KINDS)})[doc_id % 5 + 1] AS modality FROM replies)"""


def _errors(spark, sf_dir):
    both = _fields(_replies(spark, sf_dir)).withColumn("language", F.explode(F.array(F.lit("mn"), F.lit("en"), F.lit("de"))))
    return both.withColumn("errors", rows.row_errors())


def row_validation(spark, sf_dir):
    return _errors(spark, sf_dir).select("doc_id", "language", F.array_join("errors", "; ").alias("errors"))


def row_reject_counts(spark, sf_dir):
    return _errors(spark, sf_dir).select(F.explode("errors").alias("error")).groupBy("error").agg(F.count("*").alias("n"))


def pair_completeness(spark, sf_dir):
    good = _errors(spark, sf_dir).filter(F.size("errors") == 0)
    return good.groupBy("item_id").agg(F.countDistinct("language").alias("n_languages")).groupBy("n_languages").agg(F.count("*").alias("n_items"))


def _known(name: str, values: tuple[str, ...]) -> str:
    said = str(values).replace("'", "''")
    return f"CASE WHEN {name} IS NULL OR {name} NOT IN ({', '.join(repr(v) for v in values)}) THEN '{name}=' || coalesce(chr(39) || {name} || chr(39), 'None') || ' not in {said}' END"


_ERRORS = f"""spoken AS (SELECT *, unnest(['mn', 'en', 'de']) AS language FROM fields), errs AS (SELECT doc_id, item_id, language, list_filter([{_known("type", fixed.TASK_TYPES)}, {_known("modality", fixed.MODALITIES)}, {_known("language", fixed.LANGUAGES)}, {_known("difficulty", fixed.DIFFICULTIES)},
  CASE WHEN type = 'mcq' AND len(choices) < 2 THEN 'mcq row needs >=2 choices' END,
  CASE WHEN type = 'mcq' AND len(choices) >= 2 AND NOT coalesce(list_contains(choices, answer), false) THEN 'mcq answer must be one of choices verbatim' END,
  CASE WHEN instruction IS NULL OR answer IS NULL THEN 'null_field' END,
  CASE WHEN trim(instruction) = '' THEN 'instruction is empty' END,
  CASE WHEN trim(answer) = '' AND type <> 'dpo' THEN 'answer is empty' END,
  CASE WHEN modality IN ('image', 'audio') AND coalesce(media_path, '') = '' THEN 'modality=' || modality || ' requires media_path' END], lambda e: e IS NOT NULL) AS errors FROM spoken)"""


def _echoed(spark, sf_dir):
    """Every document a chunk, asked of a backend that repeats the prompt's last line."""
    chunks_ = _items(_table(spark, sf_dir, "documents")).dropDuplicates(["item_id"]).select("item_id", F.concat(F.lit("documents/"), F.col("item_id")).alias("path"), F.coalesce("text", F.lit("")).alias("body"))
    return items.process(chunks_, "text", Echo)


def text_items(spark, sf_dir):
    return items.good(_echoed(spark, sf_dir)).select("id", "source", "category", "type", "instruction", "input", "answer", "difficulty", "language", "modality", "pair_id")


def audio_items(spark, sf_dir):
    """Every conversation a transcript; a row without input has the transcript there."""
    said = transcript_concat(spark, sf_dir).select(keys.media_item_id(F.lit("audio"), F.sha2("transcript", 256)).alias("item_id"), F.concat(F.lit("a/"), F.col("conv_id").cast("string")).alias("path"), F.col("transcript").alias("body"), "conv_id")
    return items.good(items.process(said, "audio", Echo)).select("source", "media_path", "language", "answer", F.sha2("input", 256).alias("input_sha256"))


def merge_first_wins(spark, sf_dir):
    """Documents as lines of the shards of workers: the first of each content by worker, part and line."""
    shards = _items(_table(spark, sf_dir, "documents")).select("item_id", F.col("source").alias("worker"), F.floor(F.col("doc_id") / 100).cast("long").alias("part"), (F.col("doc_id") % 100).alias("line"))
    return merging.keep_first(shards, ["item_id"], ["worker", "part", "line"])


def split_assign(spark, sf_dir):
    ids = manifest_keep_first(spark, sf_dir).select(keys.row_id(F.col("item_id"), F.lit("en")).alias("id"))
    return merging.assign_splits(ids, "id")


def split_counts(spark, sf_dir):
    return split_assign(spark, sf_dir).groupBy("split").agg(F.count("*").alias("n"))


_SPLIT = f"""ids AS (SELECT DISTINCT substr(sha256({_ITEM} || '||en'), 1, 24) AS id FROM documents),
b AS (SELECT id, {keys.bucket_sql("id")} AS bucket, count(*) OVER () AS n FROM ids),
r AS (SELECT *, row_number() OVER (ORDER BY bucket, id) AS rk, least({fixed.TEST_ROWS}, n // 10) AS t FROM b),
s AS (SELECT id, bucket, CASE WHEN rk <= t THEN 'test' WHEN rk <= t + least({fixed.VALIDATION_ROWS}, (n - t) // 10) THEN 'validation' ELSE 'train' END AS split FROM r)"""


def shard_number(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("w"), (F.col("doc_id") % 64).cast("string")).alias("worker"))
    return merging.shard_numbers(docs, "worker", ["doc_id"], 10)


def _log(spark, sf_dir):
    """All messages; an item is a user's week of a month."""
    message = F.when(F.col("event_type").isin("view", "signup"), "lease").when(F.col("event_type").isin("click", "purchase"), "done").otherwise("failed")
    return _table(spark, sf_dir, "events").select((F.col("user_id") * 10 + F.floor((F.dayofmonth("ts") - 1) / 7)).cast("long").alias("item"), "ts", F.col("event_id").alias("seq"), message.alias("message"))


def _queue(spark, sf_dir):
    """The queue as it stands at the last message."""
    log = _log(spark, sf_dir)
    return leasing.replay(log, F.lit(log.agg(F.max("ts")).first()[0]).cast("timestamp"))


def queue_replay(spark, sf_dir):
    return _queue(spark, sf_dir).select("item", "status", "attempts")


def queue_status(spark, sf_dir):
    return leasing.status_counts(_queue(spark, sf_dir))


def lease_fifo(spark, sf_dir):
    return leasing.lease(_queue(spark, sf_dir)).select("item", F.col("first_seen.seq").alias("seq"))


def dead_letter(spark, sf_dir):
    return _queue(spark, sf_dir).filter("status = 'dead'").select("item", "attempts")


def lease_reap(spark, sf_dir):
    """Leases that the clock alone takes back: items leased if it stood still at the first message."""
    early, now = leasing.replay(_log(spark, sf_dir), F.lit("1970-01-01").cast("timestamp")), _queue(spark, sf_dir)
    return early.filter("status = 'leased'").select("item").join(now.filter("status = 'pending'").select("item"), "item")


_LOG = f"""log AS (SELECT CAST(user_id * 10 + (day(ts) - 1) // 7 AS BIGINT) AS item, ts, event_id AS seq, CASE WHEN event_type IN ('view', 'signup') THEN 'lease' WHEN event_type IN ('click', 'purchase') THEN 'done' ELSE 'failed' END AS message FROM events),
w AS (SELECT item, min(ROW(ts, seq)) AS first_seen, max(ROW(ts, seq)) FILTER (message <> 'lease') AS last_at, arg_max(message, ROW(ts, seq)) FILTER (message <> 'lease') AS last, max(ROW(ts, seq)) FILTER (message = 'lease') AS leased, max(ts) FILTER (message = 'lease') AS lease_ts, count(*) FILTER (message = 'failed') AS attempts FROM log GROUP BY item)"""


_LAST = "(SELECT max(ts) FROM events)"


def _state(now: str, name: str) -> str:
    return f"""{name} AS (SELECT item, arg_min_seq AS seq, attempts, CASE WHEN last = 'done' THEN 'done' WHEN attempts >= {fixed.MOST_FAILURES} THEN 'dead' WHEN open_ AND lease_ts + INTERVAL {fixed.LEASE_SECONDS} SECOND >= {now} THEN 'leased' ELSE 'pending' END AS status, first_seen
FROM (SELECT w.*, leased IS NOT NULL AND (last_at IS NULL OR leased > last_at) AS open_, f.seq AS arg_min_seq FROM w JOIN (SELECT item, arg_min(seq, ROW(ts, seq)) AS seq FROM log GROUP BY item) f USING (item)))"""


def stream_manifest(spark, sf_dir):
    """Distinct contents, read as a stream that ends with what is there. Written below the shared folder."""
    place = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    return ingest(spark, f"{sf_dir}/documents.parque[t]", _table(spark, sf_dir, "documents").schema, f"{place}/sink", f"{place}/state")


QUERIES = {
    f.__name__: f
    for f in (
        text_manifest, chunk_stress, chunk_stats, py_strip_lines, jsonl_text_coalesce, item_ids, manifest_keep_first, manifest_novelty,
        scan_stats, scan_counters, ext_modality, path_containment, task_pick, task_mix_counts, text_prompt, image_prompt, transcript_concat, audio_prompt,
        model_json_defaults, row_validation, row_reject_counts, pair_completeness, text_items, audio_items, merge_first_wins, split_assign, split_counts,
        shard_number, queue_replay, queue_status, lease_fifo, dead_letter, lease_reap, stream_manifest,
    )
}

_DOUBLED = "(SELECT doc_id, replace(text, chr(10), chr(10) || chr(10)) AS text FROM documents)"


def _filled(template: str, lang: str, task: str, difficulty: str, chunk: str = "''") -> str:
    """A prompt template as a DuckDB expression."""
    name = "CASE " + lang + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fixed.LANGUAGE_NAMES.items()) + " END"
    guidance = "CASE " + task + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fixed.TASK_GUIDANCE.items()) + " END"
    out = "'" + template.replace("'", "''") + "'"
    for key, value in (("lang", name), ("type", task), ("guidance", guidance), ("difficulty", difficulty), ("chunk", chunk)):
        out = out.replace("{" + key + "}", f"' || {value} || '")
    return out


_TRANSCRIPT = f"said AS (SELECT conv_id, {strip_sql('s')} AS transcript FROM (SELECT conv_id, string_agg({strip_sql('''coalesce(text, '')''')}, ' ' ORDER BY turn, text) AS s FROM conversations GROUP BY conv_id) WHERE {strip_sql('s')} <> '')"
_SPREAD = "spread AS (SELECT *, unnest(['mn', 'en']) AS language FROM picked)"

ORACLES = {
    "text_manifest": f"""WITH RECURSIVE {chunks_sql(_DOUBLED, "doc_id", "text", WHITE).strip()}, d AS (SELECT doc_id, {_DIGEST} AS file_sha256 FROM documents)
SELECT substr(sha256('text|' || file_sha256 || '|' || chunk_index), 1, 24) AS item_id, 'text' AS modality, 'documents/' || doc_id || '.txt' AS path, file_sha256, chunk_index, total_chunks FROM chunked JOIN d ON k = doc_id""",
    "chunk_stress": f"""WITH RECURSIVE {chunks_sql(_DOUBLED, "doc_id", "text", WHITE, *STRESS).strip()} SELECT k AS doc_id, chunk_index, total_chunks, sha256(chunk) AS chunk_sha256 FROM chunked""",
    "chunk_stats": f"""WITH RECURSIVE {chunks_sql(_DOUBLED, "doc_id", "text", WHITE).strip()} SELECT count(*) AS text_chunks, count(DISTINCT k) AS files, max(length(chunk)) AS longest, CAST(sum(length(chunk)) AS BIGINT) AS characters FROM chunked""",
    "py_strip_lines": f"""WITH l AS (SELECT doc_id, unnest(range(0, len(ls))) AS line_no, unnest(ls) AS x FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))
SELECT doc_id, line_no, {strip_sql("x")} AS line FROM l WHERE {strip_sql("x")} <> ''""",
    "jsonl_text_coalesce": f"WITH e AS (SELECT event_id, props, trim(([{', '.join(repr(r) for r in _RECORDS)}])[event_id % {len(_RECORDS)} + 1]) AS made FROM events) SELECT event_id, {_record_sql('props')} AS text, {_record_sql('made')} AS made_text FROM e",
    "item_ids": f"""WITH i AS (SELECT doc_id, {_ITEM} AS item_id, unnest(['mn', 'en']) AS language FROM documents)
SELECT doc_id, item_id, language, substr(sha256(item_id || '||' || language), 1, 24) AS id, substr(sha256('pair||' || item_id || '||0'), 1, 24) AS pair_id FROM i""",
    "manifest_keep_first": f"SELECT item_id, doc_id, source FROM (SELECT {_ITEM} AS item_id, doc_id, source, row_number() OVER (PARTITION BY {_ITEM} ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1",
    "manifest_novelty": f"WITH i AS (SELECT doc_id, {_ITEM} AS item_id, source FROM documents), m AS (SELECT {_ITEM} AS item_id FROM benchmark UNION SELECT item_id FROM i WHERE source = (SELECT min(source) FROM documents)) SELECT doc_id, item_id FROM i WHERE item_id NOT IN (SELECT item_id FROM m)",
    "scan_stats": f"SELECT 'text' AS kind, count(*) AS files_scanned, count(DISTINCT {_DIGEST}) AS new_items FROM documents UNION ALL SELECT 'page', count(*), count(DISTINCT sha256(coalesce(html, ''))) FROM pages",
    "ext_modality": """WITH p AS (SELECT page_id, 'in/' || page_id || (['.TXT', '.md', '.JPG', '.webp', '.Mp3', '.opus', '.exe', ''])[page_id % 8 + 1] AS path FROM pages), e AS (SELECT *, lower(regexp_extract(path, '[^/](\\.[^./]+)$', 1)) AS extension FROM p)
SELECT *, CASE """.replace("\\\\", "\\") + " ".join(f"WHEN extension IN ({', '.join(repr(x) for x in v)}) THEN '{k}'" for k, v in fixed.EXTENSIONS.items()) + " END AS modality FROM e",
    "scan_counters": f"""WITH RECURSIVE {chunks_sql(_DOUBLED, "doc_id", "text", WHITE).strip()},
t AS (SELECT source, 'text' AS modality, chunk_index, CASE WHEN chunk_index IS NOT NULL THEN substr(sha256('text|' || {_DIGEST} || '|' || chunk_index), 1, 24) END AS item_id FROM documents LEFT JOIN chunked ON k = doc_id),
p AS (SELECT (['text', 'text', 'image', 'image', 'audio', 'audio', '', ''])[page_id % 8 + 1] AS modality, sha256(coalesce(html, '')) AS d FROM pages),
i AS (SELECT modality, chunk_index, item_id FROM t UNION ALL SELECT modality, NULL, substr(sha256(modality || '|' || d), 1, 24) FROM p WHERE modality IN ('image', 'audio')),
s AS (SELECT DISTINCT item_id FROM t WHERE source = (SELECT min(source) FROM documents) AND item_id IS NOT NULL),
n AS (SELECT i.*, s.item_id IS NOT NULL AS old, s.item_id IS NULL AND i.item_id IS NOT NULL AS new FROM i LEFT JOIN s ON i.item_id = s.item_id)
SELECT count_if(new AND modality = 'text') AS text_chunks, count_if(new AND modality = 'image') AS images, count_if(new AND modality = 'audio') AS audio, count_if(old) AS skipped_existing, count_if(coalesce(chunk_index, 0) = 0) AS files_scanned, count_if(new) AS new_items FROM n""",
    "path_containment": """WITH p AS (SELECT page_id, (['a/../b', '../x', 'a//./b', 'a/../../data/c', '/etc/passwd'])[page_id % 5 + 1] || '/' || page_id AS p FROM pages),
n AS (SELECT page_id, list_reduce(list_prepend('', list_filter(string_split(CASE WHEN starts_with(p, '/') THEN p ELSE '/data/' || p END, '/'), lambda x: x NOT IN ('', '.'))), lambda done, x: CASE WHEN x = '..' THEN regexp_replace(done, '/[^/]*$', '') ELSE done || '/' || x END) AS p FROM p)
SELECT page_id, p = '/data' OR starts_with(p, '/data/') AS contained FROM n""",
    "task_pick": f"WITH {_PICKED} SELECT doc_id, item_id, task_type, difficulty FROM picked",
    "task_mix_counts": f"WITH {_PICKED} SELECT task_type, difficulty, count(*) AS n FROM picked GROUP BY ALL",
    "text_prompt": f"WITH {_PICKED}, {_SPREAD}, f AS (SELECT doc_id, language, {_filled(fixed.TEXT_PROMPT, 'language', 'task_type', 'difficulty', '''coalesce(text, '')''')} AS p FROM spread) SELECT doc_id, language, length(p) AS n_chars, sha256(p) AS prompt_sha256 FROM f",
    "image_prompt": f"WITH {_PICKED}, {_SPREAD} SELECT doc_id, language, sha256({_filled(fixed.IMAGE_PROMPT, 'language', 'task_type', 'difficulty')}) AS prompt_sha256 FROM spread",
    "transcript_concat": f"WITH {_TRANSCRIPT} SELECT conv_id, transcript FROM said",
    "audio_prompt": f"""WITH {_TRANSCRIPT} SELECT conv_id, sha256({_filled(fixed.AUDIO_PROMPT, "'mn'", "'qa'", "'beginner'", "transcript")}) AS prompt_sha256 FROM said""",
    "model_json_defaults": f"WITH {_PICKED}, {_REPLIES}, {_FIELDS} SELECT doc_id, category, type, instruction, input, answer, difficulty, len(choices) AS n_choices FROM fields",
    "row_validation": f"WITH {_PICKED}, {_REPLIES}, {_FIELDS}, {_ERRORS} SELECT doc_id, language, array_to_string(errors, '; ') AS errors FROM errs",
    "row_reject_counts": f"WITH {_PICKED}, {_REPLIES}, {_FIELDS}, {_ERRORS} SELECT error, count(*) AS n FROM (SELECT unnest(errors) AS error FROM errs) GROUP BY error",
    "pair_completeness": f"WITH {_PICKED}, {_REPLIES}, {_FIELDS}, {_ERRORS} SELECT n_languages, count(*) AS n_items FROM (SELECT item_id, count(DISTINCT language) AS n_languages FROM errs WHERE len(errors) = 0 GROUP BY item_id) GROUP BY n_languages",
    "text_items": f"""WITH {_PICKED}, one AS (SELECT DISTINCT item_id, task_type, difficulty FROM picked), l AS (SELECT *, unnest(['mn', 'en']) AS language FROM one)
SELECT substr(sha256(item_id || '||' || language), 1, 24) AS id, 'documents/' || item_id AS source, 'echo' AS category, 'qa' AS type, 'Repeat.' AS instruction, '' AS input, 'schema.' AS answer, 'beginner' AS difficulty, language, 'text' AS modality, substr(sha256('pair||' || item_id || '||0'), 1, 24) AS pair_id FROM l""",
    "audio_items": f"WITH {_TRANSCRIPT} SELECT 'a/' || conv_id AS source, 'a/' || conv_id AS media_path, unnest(['mn', 'en']) AS language, 'schema.' AS answer, sha256(transcript) AS input_sha256 FROM said",
    "merge_first_wins": f"SELECT item_id, worker, part, line FROM (SELECT {_ITEM} AS item_id, source AS worker, doc_id // 100 AS part, doc_id % 100 AS line, row_number() OVER (PARTITION BY {_ITEM} ORDER BY source, doc_id) AS rn FROM documents) WHERE rn = 1",
    "split_assign": f"WITH {_SPLIT} SELECT * FROM s",
    "split_counts": f"WITH {_SPLIT} SELECT split, count(*) AS n FROM s GROUP BY split",
    "shard_number": "SELECT doc_id, 'w' || (doc_id % 64) AS worker, (row_number() OVER (PARTITION BY doc_id % 64 ORDER BY doc_id) - 1) // 10 AS shard FROM documents",
    "queue_replay": f"WITH {_LOG}, {_state(_LAST, 'q')} SELECT item, status, attempts FROM q",
    "queue_status": f"WITH {_LOG}, {_state(_LAST, 'q')} SELECT coalesce(status, 'total') AS status, count(*) AS n FROM q GROUP BY ROLLUP (status)",
    "lease_fifo": f"WITH {_LOG}, {_state(_LAST, 'q')} SELECT item, seq FROM q WHERE status = 'pending' ORDER BY first_seen, item LIMIT {fixed.LEASE_ITEMS}",
    "dead_letter": f"WITH {_LOG}, {_state(_LAST, 'q')} SELECT item, attempts FROM q WHERE status = 'dead'",
    "lease_reap": f"WITH {_LOG}, {_state("TIMESTAMP '1970-01-01'", 'e')}, {_state(_LAST, 'q')} SELECT item FROM e JOIN q USING (item) WHERE e.status = 'leased' AND q.status = 'pending'",
    "stream_manifest": f"SELECT DISTINCT {_ITEM} AS item_id, {_DIGEST} AS file_sha256 FROM documents",
}
