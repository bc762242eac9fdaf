"""Near-duplicate documents by HyperMinHash.

1. Sketch: every distinct 5-word shingle hash falls in one of 256 buckets; a bucket stores the leading
   zeros of its smallest hash and the ten bits after them (a compressed register).
2. Documents with equal shingle sets form a class; the smallest id stands for it.
3. Bands of five registers are the keys of the candidate search; an empty register borrows that of a bucket which isn't
   empty, chosen by a hash of the two, so that small sets have no trivial bands. In every bucket of equal bands each
   member meets the bucket's smallest id (a star: as many pairs as members).
4. Pairs pass a collision-corrected Jaccard estimate from the registers with five standard deviations
   to spare, then the exact test on full shingle sets. Components follow.
5. Buckets whose other members still lie in several components are put together where they share members, so a
   document goes to one such unit and not to each of its bands. Units are compared in full, block against block of
   bounded size, pairs of one component left out. Sets of up to ``WHOLE`` shingles come along, and pairs that pass the
   estimate are tested on them at once, each link joining components for the pairs after it; pairs of larger sets leave the task and are
   tested on whole texts. So every pair of a bucket is linked, or tested, or already connected, whatever its size.

A pair at similarity 0.75 misses all 51 bands with probability 1e-6.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.shared import cut, released, uncut
from millrace.llm.words import U, mix, shingle_sets

BUCKETS, MANTISSA, ROWS = 256, 10, 5
BANDS = BUCKETS // ROWS
EMPTY = 0xFFFF
BLOCK = 1024
WHOLE = 512
#: Documents of a unit; where more hang together through their buckets, each bucket is a unit of its own.
MOST_IN_UNIT = 1 << 16
#: For an empty bucket (row) the order in which it asks the others.
_ASKS = mix(np.arange(BUCKETS * BUCKETS, dtype=U) + U(0x2545F4914F6CDD1D)).reshape(BUCKETS, BUCKETS)
_SALT = np.arange(1, BUCKETS + 1, dtype=U) * U(0x9E3779B97F4A7C15)


def registers(own: np.ndarray) -> np.ndarray:
    """256 registers of a sorted set of hashes: leading zeros << 10 | mantissa, or 0xFFFF if empty."""
    out = np.full(BUCKETS, EMPTY, np.uint16)
    if len(own):
        bucket = (own >> U(56)).astype(np.int64)
        first = np.concatenate(([True], bucket[1:] != bucket[:-1]))
        rest = (own[first] << U(8)) | U(128)
        zeros = 63 - np.floor(np.log2((rest >> U(11)).astype(np.float64))).astype(np.int64) - 11
        mantissa = ((rest << (zeros + 1).astype(U)) >> U(64 - MANTISSA)).astype(np.int64)
        out[bucket[first]] = (zeros << MANTISSA) | mantissa
    return out


def filled(regs: np.ndarray) -> np.ndarray:
    """Rows of registers with empty ones borrowed: the register and bucket that come first in the empty one's order."""
    out = np.atleast_2d(regs).astype(U)
    for row in out:
        full = row != EMPTY
        if full.any() and not full.all():
            there, gone = np.flatnonzero(full), np.flatnonzero(~full)
            lent = there[_ASKS[gone[:, None], there].argmin(axis=1)]
            row[gone] = row[lent] | (lent.astype(U) + U(1)) << U(16)
    return out


def bands(regs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of registers: signed 64-bit keys of their bands, and which rows' bands count (those of sets that aren't empty).

    A key tells bands apart, so equal keys are equal bands.
    """
    regs = np.atleast_2d(regs)
    used = filled(regs)[:, : BANDS * ROWS]
    keys = mix(mix(used + _SALT[: BANDS * ROWS]).reshape(-1, BANDS, ROWS).sum(axis=2, dtype=U)).view(np.int64)
    return keys, np.repeat((regs != EMPTY).any(axis=1)[:, None], BANDS, axis=1)


def estimate(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(Jaccard estimate, number of buckets it rests on) for rows of registers.

    Two different smallest values share a register with a probability that follows from the loads of
    the buckets; the expected share of such collisions is taken out of the agreement.
    """
    used = ((x != EMPTY) | (y != EMPTY)).sum(axis=-1)
    same = ((x == y) & (x != EMPTY)).sum(axis=-1)
    nx, ny = np.maximum(nx, 1) / BUCKETS, np.maximum(ny, 1) / BUCKETS
    chance = 0.72 / (1 << MANTISSA) * nx * ny / (nx + ny) ** 2
    return (same / np.maximum(used, 1) - chance) / (1 - chance), used


def plausible(x, nx, y, ny, threshold: float) -> np.ndarray:
    """Whether a pair may reach ``threshold``: sizes allow it, and the estimate lies within reach.

    The buckets show ``used`` of the union's elements, drawn without replacement, so a sketch that shows nearly
    all of a small union leaves little room.
    """
    j, used = estimate(x, nx, y, ny)
    union = (nx + ny) / (1 + threshold)
    unseen = np.clip((union - used) / np.maximum(union - 1, 1), 0, 1)
    sizes = np.minimum(nx, ny) >= threshold * np.maximum(nx, ny) - 1e-9
    return sizes & (j >= threshold - 5 * np.sqrt(threshold * (1 - threshold) * unseen / np.maximum(used, 1)) - 1.5 / np.maximum(used, 1))


@released
def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, one, two, regs = [], [], [], []
        for own in shingle_sets(b.column(1).to_pylist()):
            n.append(len(own))
            one.append(int(np.bitwise_xor.reduce(mix(own ^ U(0x5851F42D4C957F2D))).view(np.int64)) if len(own) else 0)
            two.append(int(mix(own + U(0x14057B7EF767814F)).sum(dtype=U).view(np.int64)) if len(own) else 0)
            regs.append(registers(own).tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(regs, pa.binary())], names=["doc_id", "n", "s1", "s2", "regs"])


@released
def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, 1000):
            part = b.slice(lo, 1000)
            keys, full = bands(_rows(part.column(1)))
            ids = np.repeat(part.column(0).to_numpy(), full.sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys[full])], names=["doc_id", "key"])


def _rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


def _estimated(threshold: float):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                ok = plausible(_rows(b.column(2)), b.column(4).to_numpy(), _rows(b.column(3)), b.column(5).to_numpy(), threshold)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok))

    return run


def _verified(num: int, den: int):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [linked(x, y, num, den) for x, y in zip(shingle_sets(b.column(2).to_pylist()), shingle_sets(b.column(3).to_pylist()), strict=True)]
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


@released
def _payload(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, whole, body): the sorted shingle hashes, or of larger sets the registers."""
    for b in batches:
        rows: list[tuple] = []
        size = 0
        for i, own in zip(b.column(0).to_pylist(), shingle_sets(b.column(1).to_pylist()), strict=True):
            if len(own):
                rows.append((i, len(own), len(own) <= WHOLE, own.tobytes() if len(own) <= WHOLE else registers(own).tobytes()))
                size += len(rows[-1][3])
            if size > 4 << 20:
                yield _payloads(rows)
                rows, size = [], 0
        if rows:
            yield _payloads(rows)


def _payloads(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.bool_(), pa.binary()), strict=True)], names=["doc_id", "n", "whole", "body"])


def linked(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """Whether two sorted sets have ``den * |x & y| >= num * |x | y|``."""
    if not len(x) or not len(y):
        return False
    both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
    return den * both >= num * (len(x) + len(y) - both)


def _crossed(num: int, den: int):
    """(a, b, sure) within a pair of blocks of one unit: links between components, or pairs still to be tested."""

    def run(table: pa.Table) -> pa.Table:
        ids, n, side, whole = (table.column(c).to_numpy() for c in ("doc_id", "n", "side", "whole"))
        body = table.column("body").to_pylist()
        sets = [np.frombuffer(x, U) if w else None for x, w in zip(body, whole, strict=True)]
        regs = np.stack([np.frombuffer(x, np.uint16) if own is None else registers(own) for x, own in zip(body, sets, strict=True)])
        label = np.unique(table.column("component").to_numpy(), return_inverse=True)[1]
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        out: list[tuple[int, int, bool]] = []
        for i in left.tolist():
            with_ = right[(label[right] != label[i]) & ((side[right] == 1) | (ids[right] > ids[i]))]
            if not len(with_):
                continue
            for g in with_[plausible(regs[i], n[i], regs[with_], n[with_], num / den)].tolist():
                if label[g] == label[i]:
                    continue
                sure = sets[i] is not None and sets[g] is not None
                if not sure or linked(sets[i], sets[g], num, den):
                    out.append((min(ids[i], ids[g]), max(ids[i], ids[g]), sure))
                    if sure:
                        label[label == label[g]] = label[i]
        return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64()), "sure": pa.array([x[2] for x in out], pa.bool_())})

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """Components of documents linked at ``100 * |A & B| >= percent * |A | B|`` on 5-word shingle sets.

    Returns a row for every row of ``docs``: doc_id, n_shingles, component_id, kept. A null or empty
    text, or one without words, has no shingles and links with nothing. A row with a null id links
    with nothing: its component_id is null and it is kept. Rows that repeat an id are one document
    for linking (each row's set is linked); other columns aren't read. No cap applies anywhere.
    """
    threshold = percent / 100
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketch = cut(plain.mapInArrow(_sketch, "doc_id long, n long, s1 long, s2 long, regs binary"), "sketch")

    named = sketch.filter("doc_id IS NOT NULL AND n > 0")
    classes = named.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"))
    member = named.select("doc_id", "n", "s1", "s2").join(classes, ["n", "s1", "s2"]).filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    reps = cut(named.join(classes.withColumnRenamed("rep", "doc_id"), ["n", "s1", "s2", "doc_id"], "left_semi").dropDuplicates(["n", "s1", "s2", "doc_id"]).select("doc_id", "n", "s1", "s2", "regs"), "reps")

    #: A set so small that one more shingle takes it below the threshold links with equal sets only.
    alone = percent / (100 - percent) if percent < 100 else math.inf
    spread = reps.filter(F.col("n") >= alone).select("doc_id", "regs").mapInArrow(_banded, "doc_id long, key long")
    shared = spread.groupBy("key").agg(F.min("doc_id").alias("lead"), F.max("doc_id").alias("last")).filter("lead < last")
    buckets = cut(spread.join(shared.drop("last"), "key"), "buckets")
    star = buckets.filter("doc_id <> lead").select(F.col("lead").alias("a"), F.col("doc_id").alias("b")).distinct()

    sides = reps.select("doc_id", "n", "s1", "s2", "regs")

    def tested(pairs: DataFrame) -> DataFrame:
        """Pairs that pass the exact test on whole texts."""
        word = plain.filter("doc_id IS NOT NULL")
        whole = word.join(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "doc_id", "left_semi")
        with_a = pairs.join(whole.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
        both = with_a.join(whole.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
        return both.select("a", "b", "ta", "tb").mapInArrow(_verified(percent, 100), "a long, b long").distinct()

    side_a = sides.select(F.col("doc_id").alias("a"), F.col("regs").alias("ra"), F.col("n").alias("na"))
    side_b = sides.select(F.col("doc_id").alias("b"), F.col("regs").alias("rb"), F.col("n").alias("nb"))
    hopeful = cut(star.join(side_a, "a").join(side_b, "b").select("a", "b", "ra", "rb", "na", "nb").mapInArrow(_estimated(threshold), "a long, b long").distinct(), "hopeful")
    links = cut(tested(hopeful).unionByName(member), "links")
    first = components(links)

    # pairs with the lead have been tested; what is open lies between other members of several components
    placed = cut(buckets.filter("doc_id <> lead").join(first.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id")).select("key", "doc_id", "component").distinct(), "placed")
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("doc_id").alias("one")).filter("lo < hi")
    open_ = cut(placed.join(mixed.select("key", "one"), "key"), "open")
    near = components(open_.select(F.col("one").alias("a"), F.col("doc_id").alias("b")))
    grouped = open_.join(near.withColumnRenamed("node", "doc_id").withColumnRenamed("component", "unit"), "doc_id")
    wide = near.groupBy(F.col("component").alias("unit")).agg(F.count("*").alias("docs"))
    grouped = grouped.join(wide, "unit").withColumn("large", F.col("docs") > MOST_IN_UNIT)
    members = cut(grouped.select("large", F.when(F.col("large"), F.col("key")).otherwise(F.col("unit")).alias("unit"), "doc_id", "component").distinct(), "members")
    sizes = members.groupBy("large", "unit").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocked = members.join(sizes, ["large", "unit"]).withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    #: Block pairs (i, j), i <= j: a member of block k is on the left of (k, j > k), on the right of (i < k, k), on both sides of (k, k).
    dealt = blocked.select("large", "unit", "doc_id", "component", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("large", "unit", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"), "doc_id", "component")
    bodies = cut(plain.join(members.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(_payload, "doc_id long, n long, whole boolean, body binary"), "bodies")
    crossed = cut(dealt.join(bodies, "doc_id").groupBy("large", "unit", "i", "j").applyInArrow(_crossed(percent, 100), "a long, b long, sure boolean"), "crossed")
    more = tested(crossed.filter("NOT sure").select("a", "b").distinct().join(hopeful.select("a", "b"), ["a", "b"], "left_anti"))
    final = components(first.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(crossed.filter("sure").select("a", "b")).unionByName(more))

    out = sketch.select("doc_id", F.col("n").alias("n_shingles")).join(final.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    out = out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))
    result = cut(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))), "near")
    for done in (sketch, reps, buckets, hopeful, links, placed, open_, members, bodies, crossed):
        uncut(done)
    return result


def expected_miss(j: float, bands_: int = BANDS) -> float:
    """Probability that a pair of similarity ``j`` shares no band."""
    return math.pow(1 - j**ROWS, bands_)
