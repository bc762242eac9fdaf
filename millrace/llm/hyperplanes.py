"""Near-duplicate embeddings by random-hyperplane signatures in several tables.

1. Equal vectors of one label form a class; its smallest id stands for it.
2. Each table hashes a vector to the signs of its projections on the table's random hyperplanes. Vectors
   with equal label and signs in some table are candidates. The number of planes grows with the logarithm
   of the rows, so buckets keep their size; the number of tables follows from the planes, so that a pair
   at the threshold is missed with a probability of ``MISS`` at most.
3. Buckets of several vectors are compared in full: many small ones at once, and large ones block against block of
   bounded size, whatever the size of the bucket. Within a pair of blocks cosines are exact, in double precision. A pair that several tables
   find counts in the first of them. A task gives link counts for each vector and a spanning forest of its
   links, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components, forest
from millrace.llm.shared import cut, released

MISS = 1e-7
BLOCK = 1024
#: Rows of small buckets compared at once, and numbers in one product of them.
GATHERED, PRODUCT = 8192, 1 << 20


def shape(rows: int, threshold: float) -> tuple[int, int]:
    """(planes in a table, tables) for so many rows."""
    planes = max(8, math.ceil(math.log2(max(rows, 2))) - 2)
    same = (1 - math.acos(min(1.0, threshold)) / math.pi) ** planes
    return planes, math.ceil(math.log(MISS) / math.log(1 - same))


def _usable(v: list | None) -> bool:
    return bool(v) and None not in v and all(map(math.isfinite, v)) and any(v)


def _units(raw: list[bytes]) -> np.ndarray:
    """Vectors scaled to length 1, in double precision, the largest component first taken out."""
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as bytes of doubles; null for the others."""
    for b in batches:
        packed = [np.asarray(v, np.float64).tobytes() if _usable(v) else None for v in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(packed, pa.binary())], names=["vec_id", "label", "v"])


def _signed(planes: int, tables: int, seed: int):
    """Adds the signature of every table as bytes of 64-bit keys."""
    made: dict[int, np.ndarray] = {}
    weights = np.left_shift(np.int64(1), np.arange(planes, dtype=np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(2).to_pylist()
            keys: list = [None] * len(raw)
            by_size: dict[int, list[int]] = {}
            for k, v in enumerate(raw):
                by_size.setdefault(len(v) // 8, []).append(k)
            for dims, at in by_size.items():
                if dims not in made:
                    made[dims] = np.random.Generator(np.random.PCG64(seed)).standard_normal((dims, tables * planes))
                signs = (_units([raw[k] for k in at]) @ made[dims]) >= 0
                signature = signs.reshape(len(at), tables, planes).astype(np.int64) @ weights
                for k, s in zip(at, signature, strict=True):
                    keys[k] = s.tolist()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), pa.array(keys, pa.list_(pa.int64()))], names=["vec_id", "label", "v", "copies", "keys"])

    return run


def _compared(threshold: float):
    def run(t: pa.Table) -> pa.Table:
        """Link counts (other = null) and forest links of a pair of blocks of one bucket."""
        t = t.combine_chunks()
        table_no = t.column("tab")[0].as_py()
        size = [len(v) for v in t.column("v").to_pylist()]
        side, ids, copies = (t.column(c).to_numpy() for c in ("side", "vec_id", "copies"))
        keys = np.frombuffer(b"".join(t.column("packed_keys").to_pylist()), np.int64).reshape(len(ids), -1)[:, :table_no]
        raw = t.column("v").to_pylist()
        counts = np.zeros(len(ids), np.int64)
        a: list[int] = []
        b: list[int] = []
        for dims in set(size):
            own = np.flatnonzero(np.asarray(size) == dims)
            left, right = own[side[own] != 1], own[side[own] != 0]
            if not len(left) or not len(right):
                continue
            units = _units([raw[k] for k in right])
            mine = _units([raw[k] for k in left])
            for lo in range(0, len(left), 256):
                part = left[lo : lo + 256]
                close = (mine[lo : lo + 256] @ units.T) >= threshold
                both_in_one = (side[part][:, None] == 2) & (side[right][None, :] == 2)
                close &= ~both_in_one | (ids[part][:, None] < ids[right][None, :])
                i, j = np.nonzero(close)
                i, j = part[i], right[j]
                if len(i) and table_no:
                    fresh = ~(keys[i] == keys[j]).any(axis=1)
                    i, j = i[fresh], j[fresh]
                np.add.at(counts, i, copies[j])
                np.add.at(counts, j, copies[i])
                tree = forest(zip(ids[i].tolist(), ids[j].tolist(), strict=True))
                for x, top in tree.items():
                    if x != top:
                        a.append(x)
                        b.append(top)
        hit = np.flatnonzero(counts)
        return pa.table({"a": pa.array(ids[hit].tolist() + a, pa.int64()), "b": pa.array([None] * len(hit) + b, pa.int64()), "n": pa.array(counts[hit].tolist() + [0] * len(a), pa.int64())})

    return run


def _bucketed(threshold: float):
    """The same for whole buckets, rows sorted by bucket: those of one size and vector length in one product."""

    def links(t: pa.Table) -> pa.RecordBatch:
        ids, copies, tab = (t.column(c).to_numpy() for c in ("vec_id", "copies", "tab"))
        raw = t.column("v").to_pylist()
        keys = np.frombuffer(b"".join(t.column("packed_keys").to_pylist()), np.int64).reshape(len(ids), -1)
        bucket = np.cumsum(_changes(t))
        dims = np.asarray([len(v) // 8 for v in raw])
        counts = np.zeros(len(ids), np.int64)
        a: list[int] = []
        b: list[int] = []
        for d in np.unique(dims).tolist():
            own = np.flatnonzero(dims == d)
            units = _units([raw[k] for k in own.tolist()])
            start = np.flatnonzero(np.concatenate(([True], bucket[own][1:] != bucket[own][:-1])))
            size = np.diff(np.append(start, len(own)))
            for m in np.unique(size[size > 1]).tolist():
                every = start[size == m][:, None] + np.arange(m)
                step = max(1, PRODUCT // (m * max(m, d)))
                upper = np.triu(np.ones((m, m), bool), 1)
                for lo in range(0, len(every), step):
                    part = every[lo : lo + step]
                    x = units[part]
                    k, i, j = np.nonzero((x @ x.transpose(0, 2, 1) >= threshold) & upper)
                    i, j = own[part[k, i]], own[part[k, j]]
                    fresh = ~((keys[i] == keys[j]) & (np.arange(keys.shape[1]) < tab[i][:, None])).any(axis=1)
                    i, j = i[fresh], j[fresh]
                    np.add.at(counts, i, copies[j])
                    np.add.at(counts, j, copies[i])
                    for node, top in forest(zip(ids[i].tolist(), ids[j].tolist(), strict=True)).items():
                        if node != top:
                            a.append(node)
                            b.append(top)
        hit = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays([pa.array(ids[hit].tolist() + a, pa.int64()), pa.array([None] * len(hit) + b, pa.int64()), pa.array(counts[hit].tolist() + [0] * len(a), pa.int64())], names=["a", "b", "n"])

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows >= GATHERED:
                t = pa.Table.from_batches(held).combine_chunks()
                last = int(np.flatnonzero(_changes(t))[-1])  # the last bucket may go on
                if last:
                    yield links(t.slice(0, last))
                held = t.slice(last).to_batches()
                rows = t.num_rows - last
        if rows:
            yield links(pa.Table.from_batches(held).combine_chunks())

    return run


def _changes(t: pa.Table) -> np.ndarray:
    """Whether a row starts a bucket."""
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for name in ("label", "tab", "key"):
        c = t.column(name).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return new


def near_vectors(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", seed: int = 11) -> DataFrame:
    """Links between vectors of equal non-null label at cosine >= ``threshold``, and their components.

    Returns a row for every row of ``vectors``: vec_id, n_links, component_id, kept. Vectors that are null,
    empty, zero or hold null or non-finite components, and those with a null label or id, link with
    nothing; so do vectors of different lengths with each other. Rows that repeat an id are distinct
    vectors for the counts and one node for components. An empty table gives an empty result.
    """
    plain = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    packed = cut(plain.mapInArrow(_packed, "vec_id long, label long, v binary"), "vectors")
    usable = packed.filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").withColumn("v1", F.xxhash64("v")).withColumn("v2", F.xxhash64(F.lit(7), "v"))
    classes = usable.groupBy("label", "v1", "v2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    n_rows = packed.count()
    planes, tables = shape(n_rows, threshold)
    one = usable.join(classes.withColumnRenamed("rep", "vec_id"), ["label", "v1", "v2", "vec_id"]).dropDuplicates(["label", "v1", "v2", "vec_id"]).select("vec_id", "label", "v", "copies")
    reps = cut(one.mapInArrow(_signed(planes, tables, seed), "vec_id long, label long, v binary, copies long, keys array<long>"), "signed")

    spread = reps.select("vec_id", "label", F.posexplode("keys").alias("tab", "key"))
    buckets = spread.groupBy("label", "tab", "key").agg(F.count("*").alias("size")).filter("size > 1").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    members = spread.join(buckets.drop("size"), ["label", "tab", "key"]).withColumn("own", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    large = members.filter("blocks > 1")
    dealt = large.select("label", "tab", "key", "vec_id", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("label", "tab", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"), "vec_id")
    bytes_of = cut(reps.mapInArrow(_key_bytes, "vec_id long, label long, v binary, copies long, packed_keys binary"), "keyed")
    crossed = dealt.join(bytes_of, ["vec_id", "label"]).groupBy("label", "tab", "key", "i", "j").applyInArrow(_compared(threshold), "a long, b long, n long")
    small = members.filter("blocks = 1").select("label", "tab", "key", "vec_id").join(bytes_of, ["vec_id", "label"])
    small = small.select("label", "tab", "key", "vec_id", "copies", "v", "packed_keys").repartition("label", "tab", "key").sortWithinPartitions("label", "tab", "key", "vec_id")
    found = cut(small.mapInArrow(_bucketed(threshold), "a long, b long, n long").unionByName(crossed), "compared")

    own_class = usable.join(classes, ["label", "v1", "v2"]).select("vec_id", "label", "v1", "v2", "rep", "copies")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("outside"))
    member_links = own_class.filter("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    comp = components(found.filter("b IS NOT NULL").select("a", "b").unionByName(member_links))

    linked = own_class.join(counts, "rep", "left").select("vec_id", "v1", "v2", "label", (F.col("copies") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links")).dropDuplicates(["vec_id", "v1", "v2", "label"])
    keyed = packed.withColumn("v1", F.xxhash64("v")).withColumn("v2", F.xxhash64(F.lit(7), "v"))
    out = keyed.join(linked, ["vec_id", "v1", "v2", "label"], "left").join(comp.select(F.col("node").alias("vec_id"), "component"), "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("n_links").isNotNull(), F.coalesce("component", "vec_id")).otherwise(F.col("vec_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _key_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys = [np.asarray(k, np.int64).tobytes() for k in b.column(4).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), pa.array(keys, pa.binary())], names=["vec_id", "label", "v", "copies", "packed_keys"])
