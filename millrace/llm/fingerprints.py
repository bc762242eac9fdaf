"""Document fingerprints: invertible Bloom lookup sketches, with Spark expressions only.

A paragraph is a run between the ends that a pattern gives: line ends and all sentence ends (``SENTENCES``, of the registered
query), or line ends and those before sentences that start with A to D (``PARAGRAPH``, the default of the functions; it leaves a
line without such a sentence whole). Its digest is a 64-bit hash. A sketch has three
rows of cells, and a digest falls in one cell of each; a cell holds the number of digests, their XOR and the XOR of
their check hashes. Subtracting the sketches of two versions cancels what they share; peeling then takes out digests
that are alone in a cell, which uncovers others, until the differing digests of both sides are recovered.

The fingerprint is a table of fixed size. Where the difference of two fingerprints doesn't peel, larger ones
are made: digests are dealt to groups of eight at most, on average, by their bits, and each group has a table that grows from
attempt to attempt. The work grows with the number of paragraphs, and the last attempt, a plain comparison of one
group's digests, is reached with a probability below 1e-6 a group.

Likeness is shared digests over all distinct digests of the two, from the recovered differences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import cut

SENTENCES = r"\n|(?<=[.!?]) +"
PARAGRAPH = SENTENCES + "(?=[A-D])"
ROWS, CELLS, ROUNDS = 3, 8, 8
PER_GROUP = 8
LADDER = ((8, 8), (32, 10), (128, 12))
FIRST = -(2**63)


def digests(text: Column, paragraph: str = PARAGRAPH) -> Column:
    """Distinct digests of the paragraphs of a text that aren't blank; none for null."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), paragraph, -1), lambda p: F.trim(p) != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _hashed(keys: str, size: int) -> str:
    """SQL for the digests with their check hash and, for a table of ``size`` cells a row, the cell of each row."""
    places = ", ".join(f"'p{r}', shiftrightunsigned(h, {9 * r}) & {size - 1}" for r in range(ROWS))
    return f"transform({keys}, q -> transform(array(xxhash64({size}, q)), h -> named_struct('q', q, 'x', xxhash64(q), {places}))[0])"


def _cells(keys: str, size: int) -> str:
    """SQL for the table of ``keys`` (array<bigint>): n, k, c for every cell, row after row."""
    row = (
        "transform(sequence(0, {last}), i -> aggregate(filter(t, s -> s.p{r} = i), named_struct('n', 0, 'k', 0L, 'c', 0L),"
        " (u, s) -> named_struct('n', u.n + 1, 'k', u.k ^ s.q, 'c', u.c ^ s.x)))"
    )
    rows = ", ".join(row.format(last=size - 1, r=r) for r in range(ROWS))
    return f"transform(array({_hashed(keys, size)}), t -> concat({rows}))[0]"


def _subtracted(a: str, b: str) -> str:
    return f"zip_with({a}, {b}, (x, y) -> named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'c', x.c ^ y.c))"


def _peeled(difference: str, size: int, rounds: int) -> str:
    """SQL for struct(mine, theirs) numbers of recovered digests, or null if the table doesn't empty."""
    places = ", ".join(f"'p{r}', {r * size} + (shiftrightunsigned(h, {9 * r}) & {size - 1})" for r in range(ROWS))
    alone = (
        "transform(array_distinct(transform(filter(t.d, x -> abs(x.n) = 1 AND xxhash64(x.k) = x.c), x -> named_struct('k', x.k, 'n', x.n))),"
        f" x -> transform(array(xxhash64({size}, x.k)), h -> named_struct('k', x.k, 'n', x.n, 'c', xxhash64(x.k), {places}))[0])"
    )
    falls = " OR ".join(f"q.p{r} = i" for r in range(ROWS))
    without = f"transform(t.d, (x, i) -> aggregate(filter(p, q -> {falls}), x, (s, q) -> named_struct('n', s.n - q.n, 'k', s.k ^ q.k, 'c', s.c ^ q.c)))"
    counted = "t.mine + size(filter(p, q -> q.n = 1)), 'theirs', t.theirs + size(filter(p, q -> q.n = -1))"
    step = f"transform(array({alone}), p -> if(size(p) = 0, t, named_struct('d', {without}, 'mine', {counted})))[0]"
    return (
        f"aggregate(sequence(1, {rounds}), named_struct('d', {difference}, 'mine', 0, 'theirs', 0), (t, r) -> {step},"
        " t -> if(exists(t.d, x -> x.n <> 0 OR x.k <> 0), null, named_struct('mine', t.mine, 'theirs', t.theirs)))"
    )


def _grouped(keys: str, levels: str) -> str:
    """SQL for the digests dealt to groups, eight at each level, so that the work grows with their number and its logarithm."""
    eight = "transform(sequence(0, 7), g -> filter(ks, q -> (shiftrightunsigned(q, 37 + 3 * l) & 7) = g))"
    return f"aggregate(slice(sequence(1, 8), 1, {levels}), array({keys}), (t, l) -> flatten(transform(t, ks -> {eight})))"


def differences(a: str, b: str, cells_a: str, cells_b: str) -> str:
    """SQL for struct(mine, theirs): digests that only one of two arrays has, through their sketches."""
    attempts = ", ".join(_peeled(_subtracted(_cells("x", s), _cells("y", s)), s, r) for s, r in LADDER)
    one = f"coalesce({attempts}, named_struct('mine', size(array_except(x, y)), 'theirs', size(array_except(y, x))))"
    levels = f"cast(ceil(log2(greatest(size({a}), size({b}), {PER_GROUP}) / {PER_GROUP}) / 3) as int)"
    larger = (
        f"aggregate(zip_with({_grouped(a, levels)}, {_grouped(b, levels)}, (x, y) -> {one}), named_struct('mine', 0, 'theirs', 0),"
        " (s, d) -> named_struct('mine', s.mine + d.mine, 'theirs', s.theirs + d.theirs))"
    )
    return f"coalesce({_peeled(_subtracted(cells_a, cells_b), CELLS, ROUNDS)}, {larger})"


def likeness(a: str, b: str, cells_a: str, cells_b: str) -> Column:
    """Shared over all digests; 1 for two texts without any."""
    d = f"transform(array({differences(a, b, cells_a, cells_b)}), d -> if(size({a}) + d.theirs = 0, 1.0D, (size({a}) - d.mine) / cast(size({a}) + d.theirs as double)))[0]"
    return F.expr(d)


def written(cells: str) -> Column:
    """A table of cells as a string: for each cell its number, XOR and check, in hexadecimal."""
    return F.expr(f"array_join(transform({cells}, x -> concat(hex(x.n), '.', hex(x.k), '.', substr(hex(x.c), -8))), ' ')")


def following(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, hash, next_id, next_hash) for every distinct document: the next by ascending id, then hash.

    The last is followed by the first. Documents are dealt by ranges of ids; only the first of each range goes
    through one task, so no task holds all ids.
    """
    keys = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST)).alias("id"), F.xxhash64(text_col).alias("hash")).distinct()
    parts = max(4, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = cut(keys.repartitionByRange(parts, "id", "hash").withColumn("range", F.spark_partition_id()), "ranges")
    firsts = ranged.groupBy("range").agg(F.min(F.struct("id", "hash")).alias("first"))
    order = Window.orderBy("range")
    after = firsts.select("range", F.coalesce(F.lead("first").over(order), F.first("first").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    within = Window.partitionBy("range").orderBy("id", "hash")
    nxt = F.coalesce(F.lead(F.struct("id", "hash")).over(within), F.col("after"))
    return ranged.join(after, "range").select("id", "hash", nxt["id"].alias("next_id"), nxt["hash"].alias("next_hash"))


def compare_versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", paragraph: str = PARAGRAPH) -> DataFrame:
    """For every row of ``docs`` its fingerprint and those of its edited version and of the next document.

    The edited version has the last half of the code points replaced by as many from the start of the next
    document. Returns doc_id, text, edited, fingerprint, edited_fingerprint, near_edited, near_next. A null text
    is empty and has no paragraphs. Rows with equal id and text are one document and get equal results; rows
    that share an id are ordered by a hash of the text, and null ids come first. A table of one document is its
    own next. Other columns aren't read. The id -2**63 stands for null.
    """
    plain = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST)).alias("id"), F.xxhash64(text_col).alias("hash"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    links = cut(following(docs, id_col, text_col), "following")
    sized = links.join(plain.select("id", "hash", F.length("text").alias("n")).distinct(), ["id", "hash"])
    wanted = sized.select(F.col("next_id").alias("id"), F.col("next_hash").alias("hash"), F.col("id").alias("for_id"), F.col("hash").alias("for_hash"), F.floor(F.col("n") / 2).cast("int").alias("half"))
    # both joins read texts through one exchange, so they are moved once; a row that repeats gives its start twice, and once is kept
    given = plain.join(wanted, ["id", "hash"]).select(F.col("for_id").alias("id"), F.col("for_hash").alias("hash"), F.expr("left(text, half)").alias("start"), digests(F.col("text"), paragraph).alias("c")).dropDuplicates(["id", "hash"])
    both = plain.join(given, ["id", "hash"]).withColumn("doc_id", F.when(F.col("id") != FIRST, F.col("id")))
    both = both.withColumn("edited", F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))"), F.col("start"))).drop("start")
    keyed = both.select("doc_id", "text", "edited", digests(F.col("text"), paragraph).alias("a"), digests(F.col("edited"), paragraph).alias("b"), "c")
    tabled = keyed.selectExpr("doc_id", "text", "edited", "a", "b", "c", f"{_cells('a', CELLS)} as ta", f"{_cells('b', CELLS)} as tb", f"{_cells('c', CELLS)} as tc")
    return tabled.select(
        "doc_id",
        "text",
        "edited",
        written("ta").alias("fingerprint"),
        written("tb").alias("edited_fingerprint"),
        likeness("a", "b", "ta", "tb").alias("near_edited"),
        likeness("a", "c", "ta", "tc").alias("near_next"),
    )
