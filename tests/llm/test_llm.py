import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, chat, language, lines, mixing
from millrace.llm.bpe import WordBpe, encode_documents
from millrace.llm.components import components, forest
from millrace.llm.fingerprints import compare_versions
from millrace.llm.hyperplanes import near_vectors, shape
from millrace.llm.language import fit, identify, keep_identified
from millrace.llm.minhash import bands, expected_miss, near_duplicates, plausible, registers
from millrace.llm.queries import ORACLES, QUERIES, word_bpe_file
from millrace.llm.suffixes import BlindTrie, deep_shallow, remove_repeats
from millrace.llm.wrappers import extract_main_text, main_text, parse, roles, wrapper_of
from tests.llm import brute

#: Nulls, empty and long texts, repeated rows, ties, and extra columns with names that operators use inside.
EXTRA = ", size int, row string, n_links int, component string, hash long, kept string"
DDL = "doc_id long, text string, lang string, source string, n_chars long" + EXTRA
LONG = " ".join(f"word{k % 997}" for k in range(60_000))


def odd_rows():
    own = (1, "r", 2, "c", 3, "k")
    texts = [None, "", "   ", "!!!", "one", "The same line\nof text\nthat repeats", "x\nThe same line\nof text\nthat repeats\ny", LONG, LONG, "é\n\n\n\n\n\n", "a\na\na\na\na", "<|endoftext|> İΣ"]
    rows = [(k, t, ("en", "fr", None)[k % 3], ("b", None, "a", "é")[k % 4], None if k % 2 else 5, *own) for k, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "The same line\nof text\nthat repeats", None, None, None, *own), (None, None, None, None, None, *own), (5, "other text under an id that repeats", "en", "b", 1, *own)]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DDL)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DDL)


OPERATORS = {
    "identify": identify, "keep_identified": keep_identified, "dedup_lines": lines.dedup_lines, "drop_repeated_lines": lines.drop_repeated_lines, "near_duplicates": near_duplicates,
    "mix_sources": mixing.mix_sources, "mixed_documents": mixing.mixed_documents, "remove_repeats": remove_repeats, "compare_versions": compare_versions, "encode": lambda d: encode_documents(d, word_bpe_file()),
}
FILTERS = {"keep_identified", "drop_repeated_lines", "mixed_documents"}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(odd, name):
    got = OPERATORS[name](odd).collect()
    assert len(got) == len(odd_rows()) or name in FILTERS


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(none, name):
    assert OPERATORS[name](none).collect() == []


@pytest.mark.parametrize("name", ["op2_line_dedup", "op5_source_mixing", "op6_chat_formatting"])
def test_native_queries_equal_sql(spark, sf_dir, oracle, rows_of, name):
    assert rows_of(QUERIES[name](spark, sf_dir)) == oracle(ORACLES[name])


def test_components(spark):
    draw = random.Random(2)
    links = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1060)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    assert got == forest((a, b) for a, b in links if a != b)


# language ID


def test_language_accuracy_and_rules(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in got)
    kinds = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(odd).collect()}
    assert all(kinds[k] == ("und", 0.0) for k in range(4)) and kinds[4][0] in ("en", "fr")
    assert {r["doc_id"] for r in keep_identified(odd).collect()} >= {4, 5, 6, 7}
    assert keep_identified(odd).columns == odd.columns


def test_nothing_to_learn_rejects_no_text_with_letters(spark):
    rows = [(1, "ab c", None), (2, "12 !", None), (3, None, None), (4, "é", None), (5, "", None)]
    got = keep_identified(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert sorted(map(tuple, got)) == [(1, "ab c", None), (4, "é", None)]


def test_a_third_of_rows_alike_leaves_the_sample_bounded(spark, monkeypatch):
    rows = [(1, "the same row", "en")] * 400 + [(k, f"wort {k} und", "de") for k in range(2, 9)]
    held = []
    monkeypatch.setattr(language, "train", lambda sampled, *_: held.extend(sampled))
    fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5), sample_rows=800)
    assert sum(r[0] == "en" for r in held) == 400
    held.clear()
    fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5), sample_rows=20)
    assert len(held) <= 20


def test_prediction_depends_on_the_text_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = fit(docs)
    assert (model.weights == 0).mean() > 0.5
    texts = [r["text"] for r in docs.limit(40).collect()] + ["", None, "z"]
    names, scores = model.predict(texts)
    for t, n, s in zip(texts, names, scores, strict=True):
        assert model.predict([t])[0] == [n] and abs(model.predict([t])[1][0] - s) < 1e-6


def test_training_by_plain_restatement(spark):
    draw = random.Random(21)
    words = {lang: ["".join(draw.choice(letters) for _ in range(draw.randint(2, 5))) for _ in range(12)] for lang, letters in (("aa", "abcde"), ("bb", "cdefg"), ("cc", "éİΣωb"))}
    docs = [(k, None if k == 9 else "...".join(draw.choice(words[lang]) for _ in range(draw.randint(0, 9))) + "!" * (k % 2), None if k == 11 else lang) for k, lang in ((k, draw.choice(sorted(words))) for k in range(70))]
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    model = fit(table)
    langs, weights, bias, temperature = brute.language_model(docs)
    assert model.languages == langs and np.allclose(model.bias, bias, atol=1e-9) and math.isclose(model.temperature, temperature)
    plain = np.zeros_like(model.weights)
    for (f, lang), w in weights.items():
        plain[f, langs.index(lang)] = w
    assert np.allclose(model.weights, plain, atol=1e-5) and (plain != 0).sum() > 50
    for r in identify(table).collect():
        found = brute.ngrams(text := docs[r["doc_id"]][1])
        x = sum(n * plain[f].astype(float) for f, n in found.items()) / sum(found.values()) + bias
        p = np.exp(x / temperature - max(x / temperature))
        if any(c.isalpha() for c in text or ""):
            assert r["lang_pred"] == langs[int(p.argmax())] and abs(r["score"] - p.max() / p.sum()) < 1e-5
        else:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 18])
def test_ngrams_of_slices_by_brute_force(monkeypatch, size):
    draw = random.Random(22)
    texts = [None, "", "!!", "a", "Σ", LONG[:5000], *("".join(draw.choice("ab cİΣσ,.\n é'1²漢  ") for _ in range(draw.randint(0, 300))) for _ in range(150))]
    monkeypatch.setattr(language, "SLICE", size)
    got, letters = [{} for _ in texts], [0] * len(texts)
    for owners, bounds, found, own in language.grams(iter(texts)):
        for k, a, b, n in zip(owners, bounds, bounds[1:], own):
            letters[k] += n
            for f in found[:, a:b].ravel().tolist():
                if f < language.FEATURES:
                    got[k][f] = got[k].get(f, 0) + 1
    assert got == [brute.ngrams(t) for t in texts]
    assert letters == [sum(c.isalpha() for c in (t or "").lower()) for t in texts]


# line dedup


def test_lines(spark, odd):
    draw = random.Random(3)
    docs = [(k, None if k == 7 else "\n".join(draw.choice(["a", "b", "", " "]) for _ in range(draw.randint(0, 12)))) for k in range(60)]
    got = {r["doc_id"]: r for r in lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, kept, gone, n in brute.thinned(docs):
        assert (got[i]["n_removed"], got[i]["n_lines"]) == (gone, n) and got[i]["text"] == (None if i == 7 else "\n".join(kept))
    found = lines.drop_repeated_lines(odd)
    assert found.columns == odd.columns
    # the null id comes first, so it keeps the window; both copies of document 5 lose it whole and go
    assert [r["text"] for r in found.filter("doc_id = 5").collect()] == ["other text under an id that repeats"]


# near-duplicates


def test_near_duplicates_by_brute_force(spark):
    draw = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    docs = []
    for k in range(40):
        base = [draw.choice(words) for _ in range(draw.choice([1, 3, 5, 8, 40, 200]))]
        for _ in range(6):
            copy = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 30))):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            docs.append((len(docs) * 3, " ".join(w.upper() if draw.random() < 0.1 else w for w in copy)))
    docs += [(1, ""), (2, None), (4, " \n "), (5, docs[0][1])]
    got = {r["doc_id"]: r for r in near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == brute.near_components(docs)
    assert all(r["n_shingles"] == len(brute.shingles(t)) and r["kept"] == (i == r["component_id"]) for (i, t), r in ((d, got[d[0]]) for d in docs))


def test_a_large_group_of_near_copies_links_whole(spark):
    draw = random.Random(5)
    base = [f"w{draw.randint(0, 5000)}" for _ in range(120)]
    docs = []
    for k in range(700):
        copy = list(base)
        for _ in range(draw.randint(1, 4)):
            copy[draw.randrange(120)] = f"v{draw.randint(0, 10**6)}"
        docs.append((k, " ".join(copy)))
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute.near_components(docs)


def test_sketch_keeps_pairs_at_the_threshold():
    draw = np.random.default_rng(6)
    for n in (6, 30, 130, 700):
        both = math.ceil(2 * n * 0.75 / 1.75)
        for _ in range(150):
            u = draw.integers(0, 2**64, 2 * n - both, dtype=np.uint64)
            x, y = np.sort(u[:n]), np.sort(np.concatenate((u[:both], u[n:])))
            rx, ry = registers(x), registers(y)
            assert plausible(rx[None], np.array([n]), ry[None], np.array([n]), 0.75)[0]
            (kx, fx), (ky, fy) = bands(rx), bands(ry)
            assert ((kx == ky) & fx & fy).any()
    assert expected_miss(0.75) < 2e-6


def test_null_and_repeated_ids(odd):
    got = near_duplicates(odd).collect()
    assert all(r["component_id"] is None and r["kept"] for r in got if r["doc_id"] is None)
    assert {(r["doc_id"], r["component_id"]) for r in got if r["doc_id"] in (7, 8)} == {(7, 7), (8, 7)}


# embeddings


def test_vectors_by_brute_force(spark):
    draw = np.random.default_rng(7)
    centres = draw.standard_normal((12, 16))
    rows = [(k, (centres[k % 12] + draw.standard_normal(16) * 0.08).astype(np.float32).tolist(), k % 3) for k in range(360)]
    rows += [(400 + k, rows[0][1], 0) for k in range(5)] + [(500, None, 0), (501, [0.0] * 16, 0), (502, [float("nan")] * 16, 0), (503, [None] * 16, 0), (504, rows[0][1], None), (505, [1.0], 0), (506, [], 0), (None, rows[0][1], 0)]
    got = {r["vec_id"]: r for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    usable = [(i, np.asarray(v, np.float64), c) for i, v, c in rows if i is not None and c is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = [(i, j) for n, (i, v, c) in enumerate(usable) for j, w, d in usable[:n] if c == d and len(v) == len(w) and v @ w / math.sqrt((v @ v) * (w @ w)) >= 0.98]
    found = forest(links)
    counts = {i: 0 for i, *_ in rows}
    for i, j in links:
        counts[i] += 1
        counts[j] += 1
    for i, r in got.items():
        assert (r["n_links"], r["component_id"]) == (counts[i], found.get(i, i)), i
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []
    assert shape(1 << 20, 0.98)[0] > shape(1 << 10, 0.98)[0]


def test_buckets_of_several_blocks(spark):
    draw = np.random.default_rng(14)
    centre, noise = draw.standard_normal(8), draw.standard_normal((1300, 8)) * 0.12
    x = centre + noise
    rows = [(k, v.tolist(), 1, 5, "c") for k, v in enumerate(x)]
    got = {r["vec_id"]: r for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, tab int, key string")).collect()}
    u = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    close = u @ u.T >= 0.98
    found = forest(zip(*(k.tolist() for k in np.nonzero(np.triu(close, 1))), strict=True))
    assert [(got[k]["n_links"], got[k]["component_id"]) for k in range(1300)] == [(int(close[k].sum()) - 1, found.get(k, k)) for k in range(1300)]


# mixing


def test_mixing(spark, odd):
    draw = random.Random(8)
    docs = [(k, " ".join("w" * draw.randint(1, 3) for _ in range(draw.randint(0, 40))), draw.choice(["a", "b", "c", "d", None])) for k in range(800)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = mixing.mix_sources(df).collect()
    by = {r["doc_id"]: r for r in got}
    total = sum(r["size"] for r in got)
    taken, target, size = {}, {}, {}
    for i, text, source in docs:
        r = by[i]
        assert r["size"] == len(text.split()) and 0 <= r["taken"] <= 2 * r["size"]
        taken[source] = taken.get(source, 0) + r["taken"]
        target[source], size[source] = r["target"], r["source_size"]
    assert abs(sum(target.values()) - 1.5 * total) < 1e-6 * total
    open_ = {s: target[s] / w for s, w in zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2], strict=True) if target[s] < 2 * size[s] - 1e-6}
    assert max(open_.values()) - min(open_.values()) < 1e-6 * max(open_.values())
    assert all(target[s] <= 2 * size[s] + 1e-9 and abs(taken[s] - target[s]) <= 0.01 * target[s] + 5 for s in target)
    assert sorted(map(tuple, mixing.mix_sources(df.repartition(7)).collect())) == sorted(map(tuple, got))
    rows = mixing.mixed_documents(df).collect()
    words = {}
    for r in rows:
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
        assert docs[r["doc_id"]][1].startswith(r["text"])
    assert all(words.get(i, 0) == r["taken"] for i, r in by.items())
    assert mixing.mixed_documents(odd).columns == odd.columns


def test_mixed_documents_repeat_as_often_as_taken(spark):
    docs = [(k, " ".join(f"w{j}" for j in range(k % 7 + 1)), "a" if k < 20 else "b") for k in range(100)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(df, most=3, budget=2.5).collect()}
    words = dict.fromkeys(taken, 0)
    for r in mixing.mixed_documents(df, most=3, budget=2.5).collect():
        words[r["doc_id"]] += len(r["text"].split())
    assert words == taken and max(taken[i] / (i % 7 + 1) for i in taken) == 3


def test_quotas_by_highest_quotients(spark):
    draw = random.Random(13)
    groups = {g: ([draw.choice([0, 1, 7, 7, draw.randint(1, 900)]) for _ in range(draw.randint(1, 9))], draw.randint(0, 400)) for g in range(40)}
    rows = [(g, p, float(v), seats) for g, (votes, seats) in groups.items() for p, v in enumerate(votes)]
    got = {(r["g"], r["p"]): r["quota"] for r in mixing._apportioned(spark.createDataFrame(rows, "g int, p int, v double, seats long"), ["g"], "p", "v", "seats").collect()}
    for g, (votes, seats) in groups.items():
        won = [0] * len(votes)
        for _ in range(seats if any(votes) else 0):
            best = max(range(len(votes)), key=lambda p: (votes[p] / (2 * won[p] + 1), -p))
            won[best] += 1
        assert [got[g, p] for p in range(len(votes))] == won


def test_small_sources_get_their_words(spark):
    docs = [(k, "w " * 4000, "a") for k in range(400)] + [(1000 + k, "w " * 6, "b") for k in range(10)] + [(2000, "w " * 50, "c"), (None, "x y z", "d"), (None, "u v", "d")]
    got = mixing.mix_sources(spark.createDataFrame(docs, "doc_id long, text string, source string")).groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.max("size").alias("longest")).collect()
    assert len(got) == 4 and all(abs(r["taken"] - r["target"]) <= max(r["longest"], 0.01 * r["target"]) for r in got)


# chat


def test_chat_long_empty_and_clashing_names(spark):
    ddl = "conv_id long, turn long, role string, text string, messages string, pieces int, ends long, one string"
    assert chat.format_conversations(spark.createDataFrame([], ddl)).collect() == []
    rows = [(1, k, "assistant" if k % 700 > 3 else "user", f"t{k}", "m", 1, 2, "o") for k in range(3000)] + [(2, 0, "user", "x" * 300_000, None, None, None, None)]
    got = chat.format_conversations(spark.createDataFrame(rows, ddl))
    read = {r["conv_id"]: r for r in got.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert [(t["role"], t["text"]) for t in read[1]["turns"]] == [r[2:4] for r in rows[:-1]]
    assert read[1]["loss"] == "".join(r[3] for r in rows[:-1] if r[2] == "assistant") and len(read[2]["turns"][0]["text"]) == 300_000


def test_chat_round_trip(spark):
    draw = random.Random(9)
    bits = ["<|im_end|>", "<|im_sep|>", "<|im_more|>", "\\", "<\\|", "<", "|", "\n", "x", "é", "$1"]
    rows = [(c, draw.choice([0, 1, 2, 2, None]), draw.choice(["user", "assistant", "assistant", None, "a<|im_sep|>\n"]), None if draw.random() < 0.1 else "".join(draw.choice(bits) for _ in range(draw.randint(0, 6)))) for c in [*range(40), None] for _ in range(6)]
    rows += rows[:3]
    got = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    read = got.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    for r in read:
        own = sorted(((t is not None, t or 0, a or "", x or "") for c, t, a, x in rows if c == r["conv_id"]))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(a, x) for _, _, a, x in own]
        assert r["loss"] == "".join(x for _, _, a, x in own if a == "assistant")
        roles_ = [a for _, _, a, _ in own]
        assert r["formatted"].count(chat.START) == 1 + sum(x != y for x, y in zip(roles_, roles_[1:], strict=False))
    assert len(read) == 41


# suffixes


def test_repeats_by_brute_force(spark):
    draw = random.Random(10)
    base = ["".join(draw.choice("abcdé \n") for _ in range(300)) for _ in range(8)]
    docs = {}
    for i in range(150):
        parts = []
        for _ in range(draw.randint(0, 4)):
            b, lo = draw.choice(base), draw.randint(0, 250)
            parts.append(draw.choice([b[lo : lo + draw.randint(20, 120)], "ab" * draw.randint(1, 60), "".join(draw.choice("abc") for _ in range(60))]))
        docs[i] = "".join(parts)
    docs |= {200: base[0] * 3, 201: "", 202: "x" * 49, 203: "x" * 50, 204: "x" * 51}
    rows = [*docs.items(), (201, None), (150, docs[149]), (150, docs[149])]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    raw = {i: (t or "").encode() for i, t in rows if t is not None}
    want = brute.covered(raw)
    for r in got:
        gone = {p for s in r["spans"] for p in range(s["start"], s["end"])}
        text = raw[r["doc_id"]]
        assert gone == want[r["doc_id"]] and bytes(r["kept"]) == bytes(b for p, b in enumerate(text) if p not in gone)
        assert all(x["end"] < y["start"] for x, y in zip(r["spans"], r["spans"][1:], strict=False))
    assert len(got) == len(rows)


def test_blind_trie_and_sort():
    draw = random.Random(11)
    texts = [bytes(draw.choice(b"ab") for _ in range(12)) for _ in range(300)]
    trie = BlindTrie()
    for k, t in enumerate(texts):
        trie.add(t, k)
    found = list(trie.ordered())
    assert [texts[items[0]] for items in found] == sorted(set(texts)) and sorted(k for x in found for k in x) == list(range(300))
    buffer = bytes(draw.choice(b"ab") for _ in range(40)) * 4 + bytes(100)
    starts = np.arange(0, 150)
    order, equal = deep_shallow(buffer, starts, np.zeros(150, np.int64))
    keys = [buffer[s : s + 50] for s in starts[order]]
    assert keys == sorted(keys) and equal.tolist() == [False, *(x == y for x, y in zip(keys, keys[1:], strict=False))]


# pages


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li></ul></nav>
<!-- ad --><div class="ad">Buy</div><div id="cookie-notice">We use</div>%s<aside>side</aside><div class="sidebar">more</div><footer>&copy; x</footer>"""


def test_pages(spark):
    article = "<article><h1>T &amp; &eacute;</h1><p><b>One\n two<br><p>three &lt;b&gt; <i>fo</i>ur</p><form><p>mail</p></form><div class='comments'><p>nice</p></div><ul><li>x<li>y</ul></article>"
    text = "T & é\nOne two\nthree <b> four\nx\ny"
    rows = [(1, "http://a.b/1", PAGE % article), (2, "http://a.b/2", PAGE % "<article><p>Only.</p></article>"), (3, "http://a.b/3", None), (4, None, "<p>a<p>b"), (5, "x", ""), (6, "HTTP://A.B/9", PAGE % "<article></article>"), (1, "http://a.b/1", PAGE % article)]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r["page_id"], r["text"]) for r in got) == [(1, text), (1, text), (2, "Only."), (3, ""), (4, "a\nb"), (5, ""), (6, "")]
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_pages_with_clashing_names_and_repeated_rows(spark):
    ddl = "page_id long, url string, html string, host string, text string, wrapper binary, n long"
    row = ("http://a.b/1", "<p>" + "long words " * 40_000 + "</p>", "x", "y", b"z", 1)
    got = extract_main_text(spark.createDataFrame([(1, *row), (1, *row), (None, *row), (2, None, None, None, None, None, None)], ddl)).collect()
    assert {(r["page_id"], len(r["text"])) for r in got} == {(1, 439_999), (None, 439_999), (2, 0)} and len(got) == 4


def test_wrapper_is_union_free():
    pages = [f"<body><div class='top'>My site</div><div>{body}</div></body>" for body in ("<p>a</p>", "<p>b</p><p>c</p>", "<h2>d</h2><p>e</p>")]
    from millrace.llm.wrappers import _merged

    now = wrapper_of(parse(pages[0]))
    for p in pages[1:]:
        now = _merged(now, wrapper_of(parse(p)))
    inner = now[4][0][4][1][4]
    assert [(n[0], n[2], n[3]) for n in inner] == [("h2", True, False), ("p", False, True)]
    known = roles(now, 3)
    assert [main_text(p, known) for p in pages] == ["a", "b\nc", "d\ne"]
    main_text("<div>" * 3000 + "deep", {})


def texts_of(spark, pages):
    rows = [(k, "http://a.b/", p) for k, p in enumerate(pages)]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r["text"] for r in sorted(got, key=lambda r: r["page_id"])]


def test_fixed_texts_go_inside_articles_and_beside_them(spark):
    terms = "<div class='terms'>All rights kept</div>"
    inside = [f"<article><p>Same start</p><h2>t{k}</h2><p>x{k}</p>{terms}</article>" for k in range(4)]
    inside[3] = inside[3].replace("</article>", "<blockquote><p>once</p></blockquote></article>")
    want = [f"t{k}\nx{k}" + "\nonce" * (k == 3) for k in range(4)]
    assert texts_of(spark, inside) == want
    plain = [f"<div class='top'>My site</div><div><p>y{k}</p></div>" for k in range(3)]
    mains = [f"<main><p>z{k}</p>{terms}</main>" for k in range(3)]
    assert texts_of(spark, [*inside, *plain, *mains, None]) == [*want, "y0", "y1", "y2", "z0", "z1", "z2", ""]
    assert texts_of(spark, [inside[0]] * 3) == ["Same start\nt0\nx0\nAll rights kept"] * 3


def test_long_fixed_texts_and_deep_articles(spark):
    notice = f"<div class='top'>{'We keep all rights. ' * 20}<!-- c -->End.</div>"
    assert texts_of(spark, [f"{notice}<div><p>y{k}</p></div>" for k in range(3)]) == ["y0", "y1", "y2"]
    for n in (130, 4000):
        deep = [f"<p>beside {k}</p>" + "<div>" * n + f"<article><p>in {k}</p>{notice}</article>" + "</div>" * n for k in range(3)]
        assert texts_of(spark, deep) == ["in 0", "in 1", "in 2"]


def test_the_wrapper_decides(spark):
    pages = [PAGE % f"<article><p>in {k}</p></article>" for k in range(3)]
    assert texts_of(spark, pages) == ["in 0", "in 1", "in 2"]
    assert all("A" in main_text(p, {}) and "Buy" in main_text(p, {}) for p in pages)
    for k, page in enumerate(pages[:1]):
        now = wrapper_of(parse(page))
        assert main_text(page, roles(now, 1)) == f"in {k}"
    # a region that names speak against, but that holds the text of all pages, stays
    assert texts_of(spark, [f"<div class='sidebar'><article><p>long enough {k}</p></article></div><p>x</p>" for k in range(3)]) == [f"long enough {k}" for k in range(3)]
    assert texts_of(spark, ["<div class='sidebar'><article>tease</article></div><div class='text'><p>" + "real words " * 9 + f"{k}</p></div>" for k in range(3)]) == ["real words " * 9 + str(k) for k in range(3)]


@pytest.mark.parametrize(
    "page, text",
    [
        ("<div class='site has-sidebar'><article><p>A</p></article></div>", "A"), ("<div class='layout with-sidebar'><main><p>A</p></main><div class='sidebar'>x</div></div>", "A"),
        ("<div id='content' class='side-by-side'><p>A</p></div>", "A"), ("<article><p class='post-header'>H</p><p class='promo-free'>F</p><div class='user-comments'><p>c</p></div></article>", "H\nF"),
        ("<p don't>He said it's fine</p>", "He said it's fine"), ('<p class="x>Hello</p>', "Hello"), ("<p title='a > b'>x</p>", "x"), ("<div class='AdBox'>x</div><p>y &lt;b&gt;</p>", "y <b>"), ("<!-- never closed <p>x</p>", ""),
        ("<article><p>A long text</p><article class='comment odd'><p>c</p></article><div class='related-posts'>r</div><p>B</p></article>", "A long text\nB"),
        ("<article class='comment'><p>A page that is one remark</p></article>", "A page that is one remark"),
        ("<div class='two-column-sidebar-content'><p>A</p></div><div class='side-bar'>s</div><div class='sb-comment-thread'>c</div>", "A"),
        ("<article><p>A</p><ins class='adsbygoogle'>x</ins><div data-ad-slot='1'>x</div><div aria-label='Advertisement'>x</div><div itemtype='http://schema.org/Comment'>c</div><div data-address='1'>B</div></article>", "A\nB"),
    ],
)
def test_odd_markup(page, text):
    assert main_text(page, roles(wrapper_of(parse(page)), 1)) == text


def test_pages_of_great_length_and_depth():
    for page in ("<div>" * 100_000 + "x", '<p class="x>a' * 50_000, "<p></x>" * 50_000, "<a href='" * 50_000):
        assert parse(page)[0] == ""


# fingerprints


def test_fingerprints_by_set_comparison(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = sorted([*map(tuple, docs.collect()), (10**6, None), (10**6 + 1, "a"), (10**6 + 2, "a")])
    got = sorted(compare_versions(spark.createDataFrame(rows, docs.schema)).collect(), key=lambda r: r["doc_id"])
    parts = lambda t: {x for x in re.split(r"\n|(?<=[.!?]) +(?=[A-D])", t) if x.strip(" ")}
    like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
    texts = [t or "" for _, t in rows]
    for k, r in enumerate(got):
        nxt, half = texts[(k + 1) % len(texts)], len(texts[k]) // 2
        edited = texts[k][: len(texts[k]) - half] + nxt[:half]
        assert r["edited"] == edited
        assert abs(r["near_edited"] - like(parts(texts[k]), parts(edited))) < 1e-9 and abs(r["near_next"] - like(parts(texts[k]), parts(nxt))) < 1e-9
    assert got[-1]["fingerprint"] == got[-2]["fingerprint"] != got[0]["fingerprint"]


def test_registered_fingerprints_cut_at_every_sentence_end(spark, tmp_path):
    rows = [(1, "one two. three four! five six? seven eight. nine ten eleven twelve."), (2, "Éa bé. Нет да. Zet wat.")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(QUERIES["op9_document_fingerprints"](spark, str(tmp_path)).collect(), key=lambda r: r["doc_id"])
    for r, (_, text), (_, other) in zip(got, rows, rows[::-1], strict=True):
        half = len(text) // 2
        a, b = ({p for p in re.split(r"\n|(?<=[.!?]) +", t) if p} for t in (text, text[: len(text) - half] + other[:half]))
        assert len(a & b) > 0 and abs(r["near_edited"] - len(a & b) / len(a | b)) < 1e-9


# tokens


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_bpe_file())


def test_ids_equal_the_library(library):
    model = WordBpe(open(word_bpe_file(), encoding="utf-8").read())
    draw = random.Random(12)
    pools = ["abcdefghijklmnopqrstuvwxyz" * 3 + " '", "aAbB '’0123456789²½٣ §$%&!?.,;-_\t\n\xa0​\x1c\x85﻿", "éèçüößñÀΣσςİıſǅKÅﬁ é̈ñẼ", "日本語한국어ไทยहिन्दी العربية😀👩‍👧", "ᲉꟋࢗ"]
    for k in range(6000):
        s = "".join(draw.choice(draw.choice(pools)) for _ in range(draw.randint(0, 25))) + draw.choice(["", "", "<|endoftext|>", "<|startoftext|>'s A"])
        ids = model.encode(s)
        assert ids == library.encode(s, add_special_tokens=False).ids, s
        assert k % 20 or model.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_words_that_leave_the_cache_are_encoded_again(library, monkeypatch):
    draw = random.Random(9)
    known = ["".join(draw.choice("aeiou éñß") + draw.choice("bcdst") for _ in range(draw.randint(1, 4))) for _ in range(300)]
    texts = [" ".join(draw.choice(known[: draw.choice((20, 300))]) for _ in range(60)) for _ in range(40)]
    monkeypatch.setattr(bpe, "CACHE_BYTES", 30_000)
    model = bpe.WordBpe(open(word_bpe_file(), encoding="utf-8").read())
    for t in texts:
        assert model.encode(t) == library.encode(t, add_special_tokens=False).ids
    assert model.old and len(model.new) + len(model.old) < 300


def test_documents_equal_the_library(spark, odd, library):
    got = encode_documents(odd, word_bpe_file()).collect()
    want = [library.encode(r[1] or "", add_special_tokens=False).ids for r in odd_rows()]
    assert sorted(r["ids"] for r in got) == sorted(want)


# pipeline


def test_pipeline_stages(spark, odd, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = odd
    for k, (_, stage) in enumerate(pipeline.STAGES):
        before = docs
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert k == 4 or docs.columns == before.columns
    assert docs.count() > 0


def test_pipeline_by_brute_force(spark, sf_dir, library):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    kept = {r["doc_id"] for r in identify(spark.read.parquet(f"{sf_dir}/documents.parquet")).filter("lang_pred <> 'und' AND score >= 0.35").collect()}
    assert len(kept) >= 0.99 * len(docs)
    texts = {i: "\n".join(own) for i, own, gone, n in brute.thinned([(i, docs[i]["text"]) for i in kept]) if gone < n or not gone}
    groups = brute.near_components(sorted(texts.items()))
    left = [(i, t, docs[i]["source"]) for i, t in texts.items() if groups[i] == i]
    mix = mixing.mix_sources(spark.createDataFrame(left, "doc_id long, text string, source string")).collect()
    want = []
    for r in mix:
        pieces = re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", texts[r["doc_id"]])
        lead = re.match(r"[\x20\x09-\x0D]*", texts[r["doc_id"]])[0]
        for n in [0] if not r["size"] else [x for x in (min(r["taken"], r["size"]), r["taken"] - r["size"]) if x > 0]:
            text = texts[r["doc_id"]] if n == r["size"] else lead + "".join(pieces[:n])
            ids = library.encode(text, add_special_tokens=False).ids
            want.append((r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    got = pipeline.run(spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["n_tokens"], hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest()) for r in got) == sorted(want)
