"""Removal of passages that an earlier document holds, by sparse suffix sorting (deep-shallow).

A byte goes if a 50-byte string that covers it also starts in a document with a smaller id. Sorting all suffixes of
a corpus isn't needed for that: every 50-byte string contains an anchor, the smallest 16-byte gram by a hash, and equal
strings have equal anchors. A run of neighbouring strings with one anchor is a stretch (84 bytes at most).

1. Of equal stretches the one with the smallest id is the owner, first within some megabytes of text, then in
   the task of the anchor, where rows arrive sorted by anchor, stretch and id. All others are covered whole, for
   which hashes of 64 bits suffice.
2. Owners whose anchor has different stretches in different documents go on, with their bytes. The suffixes that start
   in them are sorted by anchor and lead, the way to the anchor, which equal strings share; one that is alone there has
   no equal. Multikey quicksort (three-way, over words of eight bytes) sorts to a depth of 24, then blind tries
   order the groups whose prefixes are still equal; pairs are compared at once. Suffixes that agree in 50 bytes are
   neighbours then, and the smallest id of each such run decides.
3. Covered strings come back to their documents as intervals, which are merged and cut out.

An anchor with more than ``MOST_STRETCHES`` different stretches isn't sorted in one task: its strings go their own ways by
their hash, each to be sorted with those that share it. So the memory of a task is a slice of text and that many
stretches, whatever the table; the rows of a passage in every document are one for each ``ONCE_BYTES`` of text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import cut, released
from millrace.llm.words import _BYTE, U, mix, powers

LENGTH, GRAM = 50, 16
REACH = LENGTH - GRAM + 1
SHALLOW = 24
SEGMENT = 1 << 19
PLACE = 24
LEAD = 8
COUNT = (1 << LEAD) - 1
FIRST = -(2**63)
ONCE_BYTES, FLUSH_ROWS, FLUSH_BYTES = 8 << 20, 200_000, 4 << 20
MOST_STRETCHES = 20_000
#: Where the words begin that cover a string below the shallow depth.
REST = (*range(SHALLOW, LENGTH - 8, 8), LENGTH - 8)


def stretches(raw: Iterable[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Stretches of the texts, slice by slice.

    (text number, first string's start within the text, number of strings and its lead, packed, anchor hash, stretch hash,
    bytes of the slice). The lead is the way from the first string's start to the anchor. A text longer than ``SEGMENT`` is cut into segments that overlap by 49 bytes; slices are small enough for a cache.
    """
    held: list = []
    size = 0
    for k, r in enumerate(raw):
        for at in range(0, max(len(r) - LENGTH + 1, 0), SEGMENT):
            piece = r[at : at + SEGMENT + LENGTH - 1]
            if held and size + len(piece) > SEGMENT // 8:
                yield _sliced(held)
                held, size = [], 0
            held.append((k, at, piece))
            size += len(piece)
    if held:
        yield _sliced(held)


def _sliced(pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    joined = b"".join(p[2] for p in pieces) + bytes(8)
    data = np.frombuffer(joined, np.uint8)
    n = len(data) - 8
    eight = np.ndarray((n,), "<u8", joined, strides=(1,)).astype(U)
    grams = eight[: n - GRAM + 1] * U(0x9E3779B97F4A7C15)
    grams += eight[8 : n - GRAM + 9] * U(0xC2B2AE3D27D4EB4F)
    grams = mix(grams)
    low = U((1 << PLACE) - 1)
    best = grams & ~low
    best |= np.arange(len(grams), dtype=U)
    reach = 1
    while reach * 2 <= REACH:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    if REACH > reach:
        best = np.minimum(best[: -(REACH - reach)], best[REACH - reach :])
    best &= low
    anchor = best.view(np.int64)
    begins = np.cumsum([0, *(len(p[2]) for p in pieces)])
    own = np.ones(len(anchor), bool)
    for end in begins[1:-1].tolist():
        own[max(end - LENGTH + 1, 0) : end] = False
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (own[1:] & ~own[:-1])
    first = np.flatnonzero(new & own)
    ends = np.flatnonzero(own & np.append((new | ~own)[1:], True)) + 1
    up, down = powers(n + 1)
    total = np.zeros(n + 1, U)
    np.cumsum(_BYTE_FULL.take(data[:n]) * up[:n], out=total[1:])
    body = mix((total[ends + LENGTH - 1] - total[first]) * down[first] + U(1))
    lead = (anchor[first] - first).astype(U)
    which = np.searchsorted(begins, first, side="right") - 1
    base = np.asarray([p[1] for p in pieces]) - begins[:-1]
    number = np.asarray([p[0] for p in pieces])
    return number[which], first + base[which], (ends - first) | (anchor[first] - first) << LEAD, grams[anchor[first]].view(np.int64), mix(body + lead * U(0x9E3779B97F4A7C15)).view(np.int64), n


#: Unlike words, bytes here keep their case.
_BYTE_FULL = _BYTE.copy()
_BYTE_FULL[65:91] = mix(np.arange(65, 91, dtype=U)) | U(1)


def _raw(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 texts one by one; null is empty."""
    return (t.as_py() or b"" for t in column.cast(pa.binary()))


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    if not len(columns[0]):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns]))))


def _sizes(start: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(start, n))


def _owners(key: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether a row has the smallest id of its key."""
    if not len(key):
        return np.empty(0, bool)
    order = np.argsort(key)
    start = _starts(key[order])
    least = np.empty(len(key), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(ids[order], start), _sizes(start, len(key)))
    return ids == least


def _joined(ids: np.ndarray, place: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of strings, those of one text that touch or overlap in bytes as one. A place is start << 32 | tie."""
    if not len(ids):
        return ids, place, n
    tie, at = place & 0xFFFFFFFF, place >> 32
    order = np.lexsort((at, tie, ids))
    ids, tie, at, end = ids[order], tie[order], at[order], (at + n)[order]
    # within a text starts rise, and so do ends up to the last one seen
    text = np.cumsum(np.isin(np.arange(len(ids)), _starts(ids, tie)))
    reach = np.maximum.accumulate(end + text * (1 << 33)) - text * (1 << 33)
    new = np.concatenate(([True], (text[1:] != text[:-1]) | (at[1:] > reach[:-1] + LENGTH - 1)))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(ids)) - 1
    return ids[first], (at[first] << 32) | tie[first], reach[last] - at[first]


@released
def _requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(route, key, id, place, n): a stretch with its anchor as route and its lead in n, or, key null, strings known to be covered."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def out() -> pa.RecordBatch:
        h, key, ids, place, n = (np.concatenate([x[k] for x in held]) for k in range(5))
        held.clear()
        mine = _owners(key, ids)
        gone = _joined(ids[~mine], place[~mine], n[~mine] & COUNT)
        none = np.arange(mine.sum() + len(gone[0])) >= mine.sum()
        columns = [np.concatenate(pair) for pair in ((h[mine], mix(gone[0].view(U)).view(np.int64)), (key[mine], gone[0]), (ids[mine], gone[0]), (place[mine], gone[1]), (n[mine], gone[2]))]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64(), mask=none if k == 1 else None) for k, c in enumerate(columns)], names=["route", "key", "id", "place", "n"])

    for b in batches:
        ids, ties = b.column(0).to_numpy(), b.column(1).to_numpy()
        for number, at, n, h, key, width in stretches(_raw(b.column(2))):
            held.append((h, key, ids[number], (at.astype(np.int64) << 32) | ties[number], n.astype(np.int64)))
            size += width
            if size > ONCE_BYTES:
                yield out()
                size = 0
    if held:
        yield out()


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = FLUSH_ROWS) -> Iterator[pa.Table]:
    """Batches put together to about so many rows."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if b.num_rows:
            held.append(b)
            if sum(x.num_rows for x in held) >= rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


@released
def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of requests sorted by (route, key, id): (id, place, n, h, hot). h null: covered; else, n with its lead, to be sorted with others of h.

    Of the last anchor of a batch only owners are held, and beyond ``MOST_STRETCHES`` only those of its last stretch.
    """
    carried: list[np.ndarray] = [np.empty(0, np.int64)] * 5
    known_hot = False

    def out(parts: list[tuple], ends: bool) -> pa.RecordBatch:
        ids, place, n, h, hot, none = (np.concatenate([p[k] for p in parts]) for k in range(6))
        order = np.lexsort((place, ids))
        return pa.RecordBatch.from_arrays([pa.array(ids[order]), pa.array(place[order]), pa.array(n[order]), pa.array(h[order], mask=none[order]), pa.array(hot[order])], names=["id", "place", "n", "h", "hot"])

    def covered(ids, place, n) -> tuple:
        return ids, place, n, ids, np.zeros(len(ids), bool), np.ones(len(ids), bool)

    for table in _ended(_gathered(batches)):
        parts: list[tuple] = []
        if table is not None:
            known = table.column("key").is_null().to_numpy()
            h, key, ids, place, n = (np.concatenate((c, table.column(k).fill_null(0).to_numpy()[~known])) for k, c in enumerate(carried))
            parts.append(covered(*(table.column(k).to_numpy()[known] for k in ("id", "place", "n"))))
        else:
            h, key, ids, place, n = carried
        was_hot, known_hot = known_hot, False
        start = _starts(h, key)
        mine = ids == np.repeat(ids[start], _sizes(start, len(h)))
        parts.append(covered(ids[~mine], place[~mine], n[~mine] & COUNT))
        h, key, ids, place, n = (x[mine] for x in (h, key, ids, place, n))
        start = _starts(h)
        if len(start):
            sizes = _sizes(start, len(h))
            fresh = np.zeros(len(h), np.int64)
            fresh[_starts(h, key)] = 1
            several = np.add.reduceat(fresh, start)
            hot = several > MOST_STRETCHES
            hot[0] |= was_hot and len(carried[0]) > 0 and h[0] == carried[0][0]
            sent = hot | ((several > 1) & (np.minimum.reduceat(ids, start) < np.maximum.reduceat(ids, start)))
            row_sent, row_hot = np.repeat(sent, sizes), np.repeat(hot, sizes)
            left = len(h)
            if table is not None:
                known_hot = bool(hot[-1])
                left = int(_starts(h, key)[-1]) if known_hot else int(start[-1])
            carried = [x[left:] for x in (h, key, ids, place, n)]
            row_sent[left:] = False
            parts.append((ids[row_sent], place[row_sent], n[row_sent], h[row_sent], row_hot[row_sent], np.zeros(row_sent.sum(), bool)))
        if any(len(p[0]) for p in parts):
            yield out(parts, table is None)


def _ended(tables: Iterator[pa.Table]) -> Iterator[pa.Table | None]:
    yield from tables
    yield None


@released
def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (id, tie, text, asked): (g, id, place, n, body) for each stretch, and for each string of those that are hot.

    Strings of which a smaller id of the same batch has an equal one are covered: their body is null.
    """
    names = ["g", "id", "place", "n", "body"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

    for b in batches:
        asked = b.column(3)
        place, n, h, hot = (x.to_numpy(zero_copy_only=False) for x in asked.flatten().flatten())
        sizes = asked.value_lengths().to_numpy()
        owner = np.repeat(b.column(0).to_numpy(), sizes)
        at, count = place >> 32, n & COUNT
        begins, ends = at.tolist(), (at + count + LENGTH - 1).tolist()
        rows = np.cumsum(np.where(hot, count, 1))
        size = np.cumsum(np.where(hot, count * LENGTH, count + LENGTH))

        def out(lo: int, bodies: list[bytes]) -> pa.RecordBatch:
            cold = ~hot[lo : lo + len(bodies)]
            columns: list = [x[lo : lo + len(bodies)][cold] for x in (h, owner, place, n)]
            more = []
            for k in (np.flatnonzero(~cold) + lo).tolist():
                strings = (bodies[k - lo][s : s + LENGTH] for s in range(count[k]))
                more += [(xxhash.xxh3_64_intdigest(x) - (1 << 63), int(owner[k]), int(place[k]) + (s << 32), 1, x) for s, x in enumerate(strings)]
            columns.append([x for x, c in zip(bodies, cold.tolist(), strict=True) if c])
            if more:
                columns = [[*c, *x] for c, x in zip(columns, zip(*_once(more), strict=True), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        lo = done = 0
        bodies: list[bytes] = []
        for text, end in zip(_raw(b.column(2)), np.cumsum(sizes).tolist(), strict=True):
            bodies += [text[x:y] for x, y in zip(begins[done:end], ends[done:end], strict=True)]
            done = end
            if bodies and (rows[end - 1] - (rows[lo - 1] if lo else 0) > FLUSH_ROWS // 4 or size[end - 1] - (size[lo - 1] if lo else 0) > FLUSH_BYTES):
                yield out(lo, bodies)
                lo, bodies = end, []
        if bodies:
            yield out(lo, bodies)


def _once(hot: list[tuple]) -> list[tuple]:
    mine = _owners(np.asarray([x[0] for x in hot]), np.asarray([x[1] for x in hot]))
    return [x if own else (x[1], *x[1:4], None) for x, own in zip(hot, mine.tolist(), strict=True)]


class BlindTrie:
    """Orders byte strings of one length that share a prefix.

    Inner nodes hold the depth at which their strings part, and a child for each byte there; no strings are stored but at the
    leaves. A string first goes down blindly by those bytes; one comparison with the leaf it meets gives the depth at
    which it really parts. Equal strings share a leaf.
    """

    def __init__(self):
        self.root: list | None = None

    def add(self, text: bytes, item: int) -> None:
        """A node is [depth, children] or, as a leaf, [None, text, items]."""
        if self.root is None:
            self.root = [None, text, [item]]
            return
        node = self.root
        while node[0] is not None:
            node = node[1].get(text[node[0]]) or next(iter(node[1].values()))
        if node[1] == text:
            node[2].append(item)
            return
        depth = len(text) - ((int.from_bytes(text) ^ int.from_bytes(node[1])).bit_length() + 7) // 8
        other = node[1][depth]
        above, node = None, self.root
        while node[0] is not None and node[0] < depth:
            above, node = node, node[1][text[node[0]]]
        leaf = [None, text, [item]]
        if node[0] == depth:
            node[1][text[depth]] = leaf
            return
        new = [depth, {text[depth]: leaf, other: node}]
        if above is None:
            self.root = new
        else:
            above[1][text[above[0]]] = new

    def ordered(self) -> Iterator[list[int]]:
        """Items of equal strings, in the order of the strings."""
        stack = [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node[0] is None:
                yield node[2]
            else:
                stack += [node[1][k] for k in sorted(node[1], reverse=True)]


def multikey(words: list[np.ndarray], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Three-way quicksort over words, all parts of one round at once.

    Each part is split by the median of three of its words at the part's depth; the middle goes on one word deeper. Parts of
    two rows are compared at once. Returns (order, whether each row equals the one before it in group and all words).
    """
    table = np.stack(words)
    order = np.argsort(group)
    same = np.zeros(len(order), bool)
    start = _starts(group[order])
    size = _sizes(start, len(order))
    start, size = start[size > 1], size[size > 1]
    depth = np.zeros(len(start), np.int64)
    while True:
        two = size == 2
        same[start[two] + 1] = _paired(words, order, start[two])
        start, size, depth = start[~two], size[~two], depth[~two]
        if not len(start):
            return order, same
        base = np.cumsum(size) - size
        part = np.repeat(np.arange(len(start)), size)
        at = np.arange(len(part)) + (start - base)[part]
        rows = order[at]
        value = table[depth[part], rows]
        a, b, c = value[base], value[base + size // 2], value[base + size - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))[part]
        to, counts, before = np.empty(len(part), np.int64), [], base.copy()
        for which in (value < pivot, value == pivot, value > pivot):
            upto = np.cumsum(which)
            within = upto - (upto[base] - which[base])[part]
            counts.append(upto[base + size - 1] - upto[base] + which[base])
            to[which] = (before[part] + within - 1)[which]
            before += counts[-1]
        order[at[to]] = rows
        n = np.stack(counts, axis=1)
        begin = start[:, None] + np.cumsum(n, axis=1) - n
        deeper = depth[:, None] + np.array([0, 1, 0])
        begin, n, deeper = (x.ravel()[n.ravel() > 1] for x in (begin, n, deeper))
        over = deeper == len(words)
        spot = np.repeat(begin[over] + 1 - np.cumsum(n[over] - 1) + (n[over] - 1), n[over] - 1) + np.arange((n[over] - 1).sum())
        same[spot] = True
        start, size, depth = begin[~over], n[~over], deeper[~over]


def _paired(words: list[np.ndarray], order: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Put the rows of ``order`` at each place and the one after it in the order of their words. Returns whether they are equal."""
    a, b = order[at], order[at + 1]
    more, equal = np.zeros(len(at), bool), np.ones(len(at), bool)
    for w in words:
        x, y = w[a], w[b]
        more |= equal & (x > y)
        equal &= x == y
    order[at[more]], order[at[more] + 1] = b[more], a[more]
    return equal


def _words(buffer: bytes, starts: np.ndarray, at: int) -> np.ndarray:
    return np.ndarray((max(len(buffer) - 7, 0),), ">u8", buffer, strides=(1,))[starts + at].astype(U)


def deep_shallow(buffer: bytes, starts: np.ndarray, group: np.ndarray, who: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sort suffixes of ``buffer`` within groups by their first 50 bytes.

    Returns (order, whether each is equal to the one before it in 50 bytes and group). With ``who``, suffixes that share
    the shallow prefix with none of another owner stay unsorted below it, and count as different.
    """
    order, same = multikey([_words(buffer, starts, at) for at in range(0, SHALLOW, 8)], group)
    equal = np.zeros(len(order), bool)
    runs = np.flatnonzero(~same)
    ends = np.append(runs[1:], len(order))
    deep = ends - runs > 1
    if who is not None and len(runs):
        own = who[order]
        deep &= np.minimum.reduceat(own, runs) < np.maximum.reduceat(own, runs)
    if deep.any():
        # a trie of two strings is one comparison
        two = runs[deep & (ends - runs == 2)]
        pair = np.concatenate((two, two + 1))
        rests = [np.zeros(len(order), U) for _ in REST]
        for w, at in zip(rests, REST, strict=True):
            w[order[pair]] = _words(buffer, starts[order[pair]], at)
        equal[two + 1] = _paired(rests, order, two)
        deep &= ends - runs > 2
        # a group whose rests are all equal is a trie of one leaf
        inside = np.repeat(deep, ends - runs)
        spot = np.flatnonzero(inside & same)
        unlike = np.zeros(len(order), np.int64)
        unlike[spot] = np.any([_words(buffer, starts[order[spot]], at) != _words(buffer, starts[order[spot - 1]], at) for at in REST], axis=0)
        plain = deep & (np.add.reduceat(unlike, runs) == 0)
        equal |= np.repeat(plain, ends - runs) & same
        deep &= ~plain
    for lo, hi in zip(runs[deep].tolist(), ends[deep].tolist(), strict=True):
        trie = BlindTrie()
        for m in order[lo:hi].tolist():
            p = int(starts[m])
            trie.add(buffer[p + SHALLOW : p + LENGTH], m)
        at = lo
        for items in trie.ordered():
            order[at : at + len(items)] = items
            equal[at + 1 : at + len(items)] = True
            at += len(items)
    return order, equal


@released
def _ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (g, id, place, n, body) sorted by g, id, place: (id, place, n) of covered strings.

    Ids rise within a group, so what is smaller has come before: rows are decided as they come, and of a group that goes
    on only different bodies are held.
    """
    parts: list[tuple] = []  # arrays of g, id, place, lead, length, whether decided; bodies in a row
    size = 0

    def flush(ends: bool) -> tuple[np.ndarray, ...]:
        nonlocal parts, size
        g, ids, place, lead, long, old = (np.concatenate([p[k] for p in parts]) for k in range(6))
        buffer, begin = b"".join([p[6] for p in parts]), np.cumsum(long) - long
        start = _starts(g)
        sizes = _sizes(start, len(g))
        active = np.flatnonzero(np.repeat(np.minimum.reduceat(ids, start) < np.maximum.reduceat(ids, start), sizes))
        found = (np.empty(0, np.int64),) * 3
        if len(active):
            count = long[active] - LENGTH + 1
            of = np.repeat(active, count)
            step = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            # equal strings have their anchor at the same place; a string that is alone there has no equal
            group = np.repeat(np.arange(len(start)), sizes)[of] * REACH + lead[of] - step
            shared = np.bincount(group)[group] > 1
            of, step, group = of[shared], step[shared], group[shared]
            if len(of):
                own = ids[of]
                order, equal = deep_shallow(buffer, begin[of] + step, group, own)
                run = np.flatnonzero(~equal)
                least = np.empty(len(of), np.int64)
                least[order] = np.repeat(np.minimum.reduceat(own[order], run), _sizes(run, len(order)))
                hit = (least < own) & ~old[of]
                o, s = of[hit], step[hit]
                if len(o):
                    first = np.flatnonzero(np.concatenate(([True], (o[1:] != o[:-1]) | (s[1:] != s[:-1] + 1))))
                    p = o[first]
                    found = ids[p], place[p] + (s[first] << 32), _sizes(first, len(o))
        parts, size = [], 0
        if not ends:
            held: dict[tuple, int] = {}
            for k in range(int(start[-1]), len(g)):
                held.setdefault((int(lead[k]), buffer[begin[k] : begin[k] + long[k]]), k)
            rest = np.asarray([*held.values()])
            parts.append((*(x[rest] for x in (g, ids, place, lead, long)), np.ones(len(rest), bool), b"".join([x for _, x in held])))
        return found

    def out(found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _joined(*found)], names=["id", "place", "n"])

    for b in batches:
        known = b.column(4).is_null().to_numpy(zero_copy_only=False)
        g, ids, place, n = (b.column(k).to_numpy() for k in range(4))
        if known.any():
            yield out((ids[known], place[known], n[known] & COUNT))
            g, ids, place, n = (x[~known] for x in (g, ids, place, n))
        if len(g):
            bodies = b.column(4).drop_null().cast(pa.large_binary())
            parts.append((g, ids, place, n >> LEAD, pc.binary_length(bodies).to_numpy(), np.zeros(len(g), bool), b"".join(bodies.to_pylist())))
            size += len(parts[-1][6])
        if size > FLUSH_BYTES:
            yield out(flush(False))
    if parts:
        yield out(flush(True))


def _union(text: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Merged intervals of each text, by text and start; those that touch are one."""
    if not len(text):
        return text, lo, hi
    begin, end = text * (1 << 33) + lo, text * (1 << 33) + hi
    order = np.argsort(begin)
    begin, end = begin[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.concatenate(([True], begin[1:] > end[:-1])))
    text = begin[first] >> 33
    return text, begin[first] - text * (1 << 33), end[np.append(first[1:], len(end)) - 1] - text * (1 << 33)


@released
def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        gone = b.column(2)
        place, n = (x.to_numpy() for x in gone.flatten().flatten())
        text, lo, hi = _union(np.repeat(np.arange(len(gone)), gone.value_lengths().fill_null(0).to_numpy()), place >> 32, (place >> 32) + n + LENGTH - 1)
        upto = np.searchsorted(text, np.arange(len(gone) + 1))
        los, his, bounds = lo.tolist(), hi.tolist(), upto.tolist()
        sizes, left = [], []
        for k, raw in enumerate(_raw(b.column(1))):
            kept, at = [], 0
            for j in range(bounds[k], bounds[k + 1]):
                kept.append(raw[at : los[j]])
                at = his[j]
            kept.append(raw[at:])
            sizes.append(len(raw))
            left.append(b"".join(kept))
        spans = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.StructArray.from_arrays([pa.array(lo), pa.array(hi)], names=["start", "end"]))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), spans, pa.array(left, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans array<struct<start,end>> (removed, in bytes), kept binary for every row of ``docs``.

    Texts are UTF-8 bytes, null is empty; matches never cross documents, and texts under 50 bytes stay. Rows that share
    an id are one document for the order: they don't remove from one another; they are told apart by 32 bits of a hash
    of their texts. Null ids come before all others. What is kept is bytes, as a cut may fall within a character. An empty table
    gives an empty result.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST)).alias("id"), F.xxhash64(text_col).bitwiseAND(F.lit(0xFFFFFFFF)).alias("tie"), F.col(text_col).cast("string").alias("text"))
    wanted = plain.filter(F.octet_length("text") >= LENGTH).select("id", "tie", "text").mapInArrow(_requests, "route long, key long, id long, place long, n long")
    decided = cut(wanted.repartition("route").sortWithinPartitions("route", "key", "id").mapInArrow(_decided, "id long, place long, n long, h long, hot boolean"), "decided")
    tie = F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).alias("tie")
    asked = decided.filter("h IS NOT NULL").groupBy("id", tie).agg(F.collect_list(F.struct("place", "n", "h", "hot")).alias("asked"))
    bodies = plain.join(asked, ["id", "tie"]).select("id", "tie", "text", "asked").mapInArrow(_bodies, "g long, id long, place long, n long, body binary")
    sorted_out = cut(bodies.repartition("g").sortWithinPartitions("g", "id", "place").mapInArrow(_ordered, "id long, place long, n long"), "sorted")
    gone = decided.filter("h IS NULL").select("id", "place", "n").unionByName(sorted_out).groupBy("id", tie).agg(F.collect_list(F.struct("place", "n")).alias("gone"))
    return plain.join(gone, ["id", "tie"], "left").select("doc_id", "text", "gone").mapInArrow(_cut_out, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
