"""Mixing sources to target weights by Sainte-Laguë apportionment, with Spark expressions only.

1. Targets: sources share a budget by weight; no target exceeds a multiple of its source, the excess goes
   to the others by weight.
2. Words are allotted in equal blocks, so small that the smallest target has ``FINE`` of them for each of its shards. Highest quotients v / (2j + 1) over the targets give each source an
   integer number of blocks, and over the words of its shards each shard its quota.
3. A shard is a seeded part of a source: its documents in seeded order are one stream of words, cut into
   blocks. The quota takes blocks from the start of the stream, and, past its end, once more. So at most one
   document of a shard is cut, and none is taken more often than the multiple allows.

A shard holds about the square root of the number of documents, so neither shards nor what lies in one
grows with the whole table, and a source with a third of all rows has a third of the shards. Quotients are
ranked only where the rank can be open: a party's seats differ from its exact share by half its part of
the number of parties and a half at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BUDGET, MOST = 1.5, 2
FINE = 256
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _apportioned(parties: DataFrame, group: list[str], party: str, votes: str, seats: str) -> DataFrame:
    """``parties`` with ``quota``: the seats of their group by highest quotients, ties by party."""
    own = Window.partitionBy(*group)
    share = F.when(F.sum(votes).over(own) > 0, F.col(votes) / F.sum(votes).over(own)).otherwise(0.0)
    reach = parties.withColumn("_share", share).withColumn("_slack", F.count("*").over(own) * F.col("_share") / 2 + 1)
    reach = reach.withColumn("_lo", F.greatest(F.lit(0), F.floor(F.col(seats) * F.col("_share") - F.col("_slack"))).cast("long"))
    reach = reach.withColumn("_hi", F.ceil(F.col(seats) * F.col("_share") + F.col("_slack")).cast("long")).withColumn("_open", F.col(seats) - F.sum("_lo").over(own))
    tried = reach.select(*group, party, votes, "_open", F.explode(F.sequence("_lo", "_hi")).alias("_j")).filter(F.col(votes) > 0)
    ranked = tried.withColumn("_rank", F.row_number().over(own.orderBy(F.desc(F.col(votes).cast("double") / (2 * F.col("_j") + 1)), party)))
    won = ranked.filter("_rank <= _open").groupBy(*group, party).agg(F.count("*").alias("_won"))
    won = won.select(F.col(group[0]).alias("_group"), F.col(party).alias("_party"), "_won")
    same = F.col(group[0]).eqNullSafe(F.col("_group")) & F.col(party).eqNullSafe(F.col("_party"))
    return reach.join(won, same, "left").select(*parties.columns, (F.col("_lo") + F.coalesce("_won", F.lit(0))).alias("quota"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, text_hash for every row of ``docs``.

    ``size``: words of the text, 0 for null. Sources by code point, null last, have ``weights`` in turn; a
    null source is one of its own. ``taken`` is in words: whole passes over the document, and a part of one
    for the document where a shard's quota ends. Repeated rows are separate documents; those with equal id
    lie next to each other in the seeded order, by size and text; rows without an id are placed by their texts. An empty table, or one without words, takes 0.
    """
    sizes = cut(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.xxhash64(text_col).alias("text_hash"), F.coalesce(F.col(id_col).cast("long").cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit("")))).alias("own"), word_count(F.col(text_col)).alias("size")), "sizes")
    rank = Window.orderBy(F.asc_nulls_last("source"))
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    sources = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(rank) - 1) % len(weights) + 1).cast("int")))
    everything = Window.partitionBy()
    sources = sources.withColumn("total", F.sum("source_size").over(everything)).withColumn("docs", F.sum("n_docs").over(everything)).withColumn("most", F.col("source_size") * most)
    filling = Window.orderBy(F.col("most") / F.col("weight"), F.asc_nulls_last("source"))
    level = (F.col("total") * budget - F.coalesce(F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) / F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    sources = sources.withColumn("level", level)
    sources = sources.withColumn("level", F.coalesce(F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), F.col("level").alias("level")))).over(everything)["level"], F.lit(0.0)))
    sources = sources.withColumn("target", F.least(F.col("most").cast("double"), F.col("level") * F.col("weight")))
    sources = sources.withColumn("all", F.lit(0)).withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("n_docs") / F.ceil(F.sqrt("docs")))).cast("long"))
    fine = F.min(F.when(F.col("target") > 0, F.floor(F.col("target") / (F.col("shards") * FINE)))).over(everything)
    sources = sources.withColumn("block", F.greatest(F.lit(1), F.coalesce(fine, F.lit(1))).cast("long")).withColumn("blocks", F.floor(F.col("total") * budget / F.col("block") + 0.5).cast("long"))
    sources = cut(_apportioned(sources, ["all"], "source", "target", "blocks").select("source", "source_size", "target", "block", "shards", F.col("quota").alias("source_quota")), "sources")

    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("own")))
    named = sources.withColumnRenamed("source", "_source")
    placed = sizes.withColumn("key", key).join(named, F.col("source").eqNullSafe(F.col("_source"))).select("doc_id", "text_hash", "source", "size", "source_size", "target", "block", "source_quota", (F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % F.col("shards")).alias("shard"), F.substring("key", 9, 24).alias("key"))
    shards = placed.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"), F.first("source_quota").alias("source_quota"))
    quotas = _apportioned(shards, ["source"], "shard", "shard_size", "source_quota").select(F.col("source").alias("s"), F.col("shard").alias("h"), "shard_size", "quota")
    dealt = placed.join(quotas, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("h")))
    stream = Window.partitionBy("source", "shard").orderBy("key", "doc_id", "size", "text_hash")
    dealt = dealt.withColumn("before", F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).withColumn("words", F.least(F.col("quota") * F.col("block"), F.col("shard_size") * most))
    passes, rest = F.expr("words div nullif(shard_size, 0)"), F.expr("words % nullif(shard_size, 0)")
    taken = F.coalesce(passes * F.col("size") + F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("before"))), F.lit(0)).cast("long")
    return dealt.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "text_hash")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of the mix, with the columns of ``docs``: whole copies, and for the document where a shard's
    quota ends its first words with their white space. Documents of which nothing is taken are left out; one without words
    stays once. ``n_chars`` follows the text. Column names can't clash."""
    counts = mix_sources(docs, id_col, text_col, source_col, **options)
    counts = counts.select(F.col("doc_id").alias("id"), "text_hash", "size", "taken", F.row_number().over(Window.partitionBy("doc_id", "text_hash").orderBy("taken")).alias("nth"))
    keyed = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("own_id"), F.xxhash64(text_col).alias("own_hash"), F.col(text_col).alias("text"), F.col(source_col).alias("source"))
    numbered = keyed.withColumn("own_nth", F.row_number().over(Window.partitionBy("own_id", "own_hash").orderBy("source")))
    both = numbered.join(counts, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("text_hash")) & (F.col("own_nth") == F.col("nth")))
    copies = F.expr("if(size = 0, array(0L), filter(concat(array_repeat(size, cast(taken div size as int)), array(taken % size)), x -> x > 0))")
    spread = both.select("row", "text", "size", F.explode(copies).alias("words"))
    leading = F.when(F.col("text").rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    pieces = F.slice(F.split("text", r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])"), 1, (F.col("words") + leading).cast("int"))
    part = spread.select("row", F.when(F.col("words") == F.col("size"), F.col("text")).otherwise(F.array_join(pieces, "")).alias("part"))
    named = {text_col: F.col("part"), "n_chars": F.length("part").cast("long")}
    return part.select(*[named.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def sql(documents: str = "documents") -> str:
    """The same in DuckDB SQL: rows of doc_id, size, source_size, target, taken."""
    weights = " ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(WEIGHTS))

    def apportioned(name: str, parties: str, group: str, party: str, votes: str, seats: str) -> str:
        return f"""
{name}_r AS (SELECT *, CASE WHEN sum({votes}) OVER g > 0 THEN {votes} / sum({votes}) OVER g ELSE 0.0 END AS sh, count(*) OVER g AS np FROM {parties} WINDOW g AS (PARTITION BY {group})),
{name}_l AS (SELECT *, CAST(greatest(0, floor({seats} * sh - (np * sh / 2 + 1))) AS BIGINT) AS lo, CAST(ceil({seats} * sh + (np * sh / 2 + 1)) AS BIGINT) AS hi FROM {name}_r),
{name}_o AS (SELECT *, {seats} - sum(lo) OVER (PARTITION BY {group}) AS op FROM {name}_l),
{name}_j AS (SELECT {group} AS g_, {party} AS p_, {votes} AS v_, op, unnest(range(lo, hi + 1)) AS j FROM {name}_o WHERE {votes} > 0),
{name}_k AS (SELECT *, row_number() OVER (PARTITION BY g_ ORDER BY CAST(v_ AS DOUBLE) / (2 * j + 1) DESC, p_) AS rk FROM {name}_j),
{name}_w AS (SELECT g_, p_, count(*) AS won FROM {name}_k WHERE rk <= op GROUP BY g_, p_),
{name} AS (SELECT o.*, o.lo + coalesce(w.won, 0) AS quota FROM {name}_o o LEFT JOIN {name}_w w ON o.{group} IS NOT DISTINCT FROM w.g_ AND o.{party} IS NOT DISTINCT FROM w.p_)"""

    return f"""
WITH sizes AS MATERIALIZED (SELECT doc_id, source, coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) AS own, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS size FROM {documents}),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs FROM sizes GROUP BY source),
s1 AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} {weights} END AS weight, CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(n_docs) OVER () AS BIGINT) AS docs, source_size * {MOST} AS most FROM s0),
s2 AS (SELECT *, (total * CAST({BUDGET} AS DOUBLE) - coalesce(sum(most) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM s1 WINDOW f AS (ORDER BY most / weight, source NULLS LAST)),
s3 AS (SELECT * EXCLUDE (lv), coalesce((SELECT arg_min(lv, most / weight) FROM s2 WHERE lv * weight <= most), 0.0) AS level FROM s2),
s4 AS (SELECT *, least(CAST(most AS DOUBLE), level * weight) AS target, CAST(greatest(1, ceil(n_docs / ceil(sqrt(docs)))) AS BIGINT) AS shards, 0 AS all_ FROM s3),
s4b AS (SELECT *, CAST(greatest(1, coalesce(min(floor(target / (shards * {FINE}))) FILTER (target > 0) OVER (), 1)) AS BIGINT) AS block FROM s4),
s5 AS (SELECT *, CAST(floor(total * CAST({BUDGET} AS DOUBLE) / block + 0.5) AS BIGINT) AS blocks FROM s4b),
{apportioned("src", "s5", "all_", "source", "target", "blocks").strip()},
p0 AS (SELECT z.doc_id, z.source, z.size, z.own, r.source_size, r.target, r.block, r.quota AS source_quota, r.shards, md5('{SEED}:' || z.own) AS k FROM sizes z JOIN src r ON z.source IS NOT DISTINCT FROM r.source),
placed AS (SELECT * EXCLUDE (k), CAST('0x' || substr(k, 1, 8) AS BIGINT) % shards AS shard, substr(k, 9, 24) AS key FROM p0),
h0 AS (SELECT source, shard, CAST(sum(size) AS BIGINT) AS shard_size, any_value(source_quota) AS source_quota FROM placed GROUP BY source, shard),
{apportioned("sha", "h0", "source", "shard", "shard_size", "source_quota").strip()},
d AS (SELECT p.*, q.shard_size, least(q.quota * p.block, q.shard_size * {MOST}) AS words FROM placed p JOIN sha q ON p.source IS NOT DISTINCT FROM q.source AND p.shard = q.shard),
e AS (SELECT *, sum(size) OVER (PARTITION BY source, shard ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before FROM d)
SELECT doc_id, size, source_size, target, CAST(coalesce((words // nullif(shard_size, 0)) * size + least(size, greatest(0, words % nullif(shard_size, 0) - before)), 0) AS BIGINT) AS taken FROM e
"""
