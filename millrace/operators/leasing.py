"""The work queue as aggregates over a log of messages, instead of a fold that one process holds.

Ownership is never checked and a failure counts whatever the state, so an item's state follows from its last completion, its
number of failures and its leases since: all of them aggregates with partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import fixed


def replay(log: DataFrame, now: Column, ttl: int = fixed.LEASE_SECONDS, most: int = fixed.MOST_FAILURES) -> DataFrame:
    """State of every item after a log of (item, ts, seq, message); message is lease, done or failed.

    Any other message counts as failed. A lease takes effect unless the item is done or dead; one that ended before
    ``now`` is taken back without counting as a failure. Returns item, first_seen, status, attempts, expires.
    """
    at, is_lease, is_done = F.struct("ts", "seq"), F.col("message") == "lease", F.col("message") == "done"
    failed = ~is_lease & ~is_done
    items = log.groupBy("item").agg(
        F.min(at).alias("first_seen"),
        F.max(F.when(~is_lease, F.struct(F.col("ts"), F.col("seq"), is_done.alias("done")))).alias("last"),
        F.max(F.when(is_lease, at)).alias("leased"),
        F.count_if(failed).alias("attempts"),
    )
    after = F.col("leased").isNotNull() & (F.col("last").isNull() | (F.col("leased") > F.struct("last.ts", "last.seq")))
    expires = F.when(after, F.col("leased.ts") + F.make_interval(secs=F.lit(ttl)))
    status = F.when(F.col("last.done"), "done").when(F.col("attempts") >= most, "dead").when(after & (expires >= now), "leased").otherwise("pending")
    return items.select("item", "first_seen", status.alias("status"), "attempts", F.when(status == "leased", expires).alias("expires"))


def lease(items: DataFrame, n: int = fixed.LEASE_ITEMS) -> DataFrame:
    """The first ``n`` pending items in order of arrival; the limit is the feature."""
    return items.filter("status = 'pending'").orderBy("first_seen", "item").limit(n)


def status_counts(items: DataFrame) -> DataFrame:
    """Items by status, and all of them under ``total``."""
    return items.rollup("status").agg(F.count("*").alias("n")).select(F.coalesce("status", F.lit("total")).alias("status"), "n")



def leased(items: DataFrame, owner: str, now: Column, n: int = fixed.LEASE_ITEMS, ttl: int = fixed.LEASE_SECONDS) -> DataFrame:
    """What a worker is given: the first ``n`` pending items with their new status, owner and end of the lease."""
    return lease(items, n).withColumn("status", F.lit("leased")).withColumn("owner", F.lit(owner)).withColumn("expires", now + F.make_interval(secs=F.lit(ttl)))


def unknown_completions(log: DataFrame, items: DataFrame) -> DataFrame:
    """Completions of items that the manifest doesn't have."""
    return log.filter("message <> 'lease'").join(items.select("item").distinct(), "item", "left_anti")
