"""Distributed connected components over a table of links.

Links are first contracted within each partition by union-find, ``CONTRACTED`` at a time,
then alternating large-star and small-star rounds run until nothing changes. Every round is written to
the shared folder, so lineage stays short; links never reach the driver, which sees two numbers a round.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import cut, uncut

CONTRACTED = 200_000


def forest(pairs) -> dict[int, int]:
    """Smallest reachable node for every node in ``pairs``."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in pairs:
        if (x := root(a)) != (y := root(b)):
            parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        found = [(x, top) for x, top in forest(pairs).items() if x != top]
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([t for _, t in found], pa.int64())], names=["a", "b"])

    held: list[tuple[int, int]] = []
    for b in batches:
        held += zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
        if len(held) >= CONTRACTED:
            yield out(held)
            held = []
    yield out(held)


def _to_smallest(links: DataFrame, either_way: bool) -> DataFrame:
    """Hang the neighbours of each node from the smallest of them.

    ``either_way``: look at all neighbours, move the larger ones (large-star); otherwise look at the
    smaller neighbours, move them and the node (small-star).
    """
    ways = links.select("a", "b")
    if either_way:
        ways = ways.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = ways.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = ways.join(least, "a")
    if either_way:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return moved.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (a long, b long), any order, repeats and loops allowed; null ends are ignored.

    Returns (node, component) for every node with a link to another one; component is the smallest
    node reachable. An empty table gives an empty one.
    """
    ordered = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = cut(ordered.mapInArrow(_contract, "a long, b long").distinct(), "links")
    seen = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if state == seen or not state["n"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        seen = state
        new = cut(_to_smallest(_to_smallest(now, True), False), "links")
        uncut(now)
        now = new
