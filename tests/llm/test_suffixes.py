"""The stages of suffix dedup in plain Python, with limits so small that every path is taken."""

import random

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import suffixes

LONG = pa.int64()
ASKED = pa.list_(pa.struct([("place", LONG), ("n", LONG), ("h", LONG), ("hot", pa.bool_())]))


def batches(rows, names, types):
    return iter([pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[lo : lo + 7]], t) for k, t in enumerate(types)], names=names) for lo in range(0, len(rows), 7)])


def rows_of(found):
    return [tuple(r.values()) for b in found for r in b.to_pylist()]


def staged(docs, parts):
    """Removed bytes of every document; shuffles are imitated by sorting."""
    plain = [(i, k, t) for k, (i, t) in enumerate(docs)]
    wanted = [r for p in range(parts) for r in rows_of(suffixes._requests(batches(plain[p::parts], ["id", "tie", "text"], [LONG, LONG, pa.string()])))]
    decided = []
    for p in range(parts):
        own = sorted([r for r in wanted if r[0] % parts == p], key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))
        decided += rows_of(suffixes._decided(batches(own, ["route", "key", "id", "place", "n"], [LONG] * 5)))
    gone, asked = {}, {}
    for i, place, n, h, hot in decided:
        if h is None:
            gone.setdefault((i, place & 0xFFFFFFFF), []).append((place, n))
        else:
            asked.setdefault((i, place & 0xFFFFFFFF), []).append({"place": place, "n": n, "h": h, "hot": hot})
    held = [(i, k, t, asked[i, k]) for i, k, t in plain if (i, k) in asked]
    bodies = [r for p in range(parts) for r in rows_of(suffixes._bodies(batches(held[p::parts], ["id", "tie", "text", "asked"], [LONG, LONG, pa.string(), ASKED])))]
    for p in range(parts):
        own = sorted([r for r in bodies if r[0] % parts == p], key=lambda r: r[:3])
        for i, place, n in rows_of(suffixes._ordered(batches(own, ["g", "id", "place", "n", "body"], [LONG] * 4 + [pa.binary()]))):
            gone.setdefault((i, place & 0xFFFFFFFF), []).append((place, n))
    return [{p for place, n in gone.get((i, k), []) for p in range(place >> 32, (place >> 32) + n + 49)} for i, k, _ in plain], any(r[4] for r in decided)


@pytest.mark.parametrize("segment, rows, size, once, most", [(1 << 19, 200_000, 1 << 22, 1 << 23, 20_000), (64, 20, 500, 300, 3), (1 << 19, 10, 300, 1, 0), (100, 200_000, 1 << 22, 1 << 23, 1)])
def test_stages_by_brute_force(monkeypatch, segment, rows, size, once, most):
    for name, value in (("SEGMENT", segment), ("FLUSH_ROWS", rows), ("FLUSH_BYTES", size), ("ONCE_BYTES", once), ("MOST_STRETCHES", most)):
        monkeypatch.setattr(suffixes, name, value)
    monkeypatch.setattr(suffixes._gathered, "__defaults__", (rows,))
    for seed in range(6):
        draw = random.Random(seed)
        some = lambda n, letters="abcd\u00e9 \n": "".join(draw.choice(letters) for _ in range(n))
        base = [some(300) for _ in range(6)]
        docs = []
        for i in range(60):
            parts = []
            for _ in range(draw.randint(0, 4)):
                b, lo = draw.choice(base), draw.randint(0, 250)
                parts.append(draw.choice([b[lo : lo + draw.randint(20, 120)], "ab" * draw.randint(1, 60), some(60, "abc")]))
            docs.append((i, "".join(parts)))
        docs += [(3, docs[4][1] + "zz"), (5, docs[5][1])]
        seen = {}
        for i, t in docs:
            r = t.encode()
            for p in range(len(r) - 49):
                seen[r[p : p + 50]] = min(seen.get(r[p : p + 50], i), i)
        found, hot = staged(docs, 4)
        assert hot == (most < 20_000)
        for (i, t), gone in zip(docs, found, strict=True):
            r = t.encode()
            assert gone == {q for p in range(len(r) - 49) if seen[r[p : p + 50]] < i for q in range(p, p + 50)}


def test_only_strings_that_can_be_equal_are_sorted(monkeypatch):
    draw = random.Random(12)
    some = lambda n: "".join(chr(97 + draw.randrange(26)) for _ in range(n))
    shared = [some(70) for _ in range(40)]
    docs = [(i, "".join(f"{some(60)}{x}" for x in shared)) for i in range(2)]
    sorted_at, made = [], []
    deep_shallow, trie = suffixes.deep_shallow, suffixes.BlindTrie
    monkeypatch.setattr(suffixes, "deep_shallow", lambda buffer, starts, group, who: (sorted_at.append(np.unique(group, return_counts=True)[1]), deep_shallow(buffer, starts, group, who))[1])
    monkeypatch.setattr(suffixes, "BlindTrie", lambda: (made.append(1), trie())[1])
    found, _ = staged(docs, 2)
    first, second = (t.encode() for _, t in docs)
    known = {first[p : p + 50] for p in range(len(first) - 49)}
    assert found == [set(), {q for p in range(len(second) - 49) if second[p : p + 50] in known for q in range(p, p + 50)}]
    assert sorted_at and all((c == 2).all() for c in sorted_at) and not made


def test_pairs_in_order_by_brute_force():
    draw = random.Random(13)
    head = bytes(range(50))
    texts, group = [], []
    for g in range(300):
        x, y = bytearray(head), bytearray(head)
        for t in (x, y):
            if draw.random() < 0.7:
                t[draw.randrange(50)] = draw.randrange(256)
        texts += [bytes(x), bytes(y)]
        group += [g, g]
    starts = np.arange(600) * 50
    for who in (None, np.arange(600)):
        order, equal = suffixes.deep_shallow(b"".join(texts), starts, np.asarray(group), who)
        keys = [(group[k], texts[k]) for k in order]
        assert sorted(order.tolist()) == list(range(600)) and keys == sorted(keys)
        assert equal.tolist() == [False, *(x == y for x, y in zip(keys, keys[1:], strict=False))]


SHARED = "thirty letters that are here. "


@pytest.mark.parametrize("docs", [["a" * 30 + "bc" * 120], ["".join(chr(97 + (k * k + j) % 23) for k in range(j * 300, j * 300 + 300)) for j in range(3)], [f"{c * 90}{SHARED}{c * 90}" for c in "xyz"]])
def test_tasks_without_shared_anchors(spark, docs):
    rows = [(k, t) for k, t in enumerate(docs)]
    got = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted((r["doc_id"], bytes(r["kept"]).decode(), r["spans"]) for r in got) == [(k, t, []) for k, t in rows]
