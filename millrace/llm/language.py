"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, everything but letters becomes one space, and n-grams of one to three characters fall
into 2**16 hashed features. A feature's value is its share of the text's n-grams times its inverse document
frequency, which counts all training rows. Weights are learned by follow-the-regularised-leader (proximal,
per-coordinate rates) with elastic-net penalties on a bounded sample of labelled rows, so many are exactly zero.
A part of the sample is kept from the fit and calibrates a temperature for the scores.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import cut, released

BITS = 16
FEATURES = 1 << BITS
SCALE = 30.0
#: Characters that n-grams are made of at a time.
SLICE = 1 << 18
#: Languages that a slice is scored for at a time.
COLUMNS = 16
BETWEEN_WORDS = re.compile(r"\w\s\w")
UNKNOWN = "und"
#: Rows of the sample that weights and temperature are fitted on, over all languages.
SAMPLE_ROWS = 6000
#: Weights are broadcast, 256 KB for each language; a table with more distinct labels is refused.
MOST_LANGUAGES = 1000
DRAW = 1 << 62
EPOCHS, ALPHA, BETA, LASSO, RIDGE = 3, 0.5, 1.0, 0.02, 0.01

_letters: list[np.ndarray] = []


def _table() -> np.ndarray:
    """Code point -> itself for a letter, else a space."""
    if not _letters:
        every = np.full(0x110000, 32, np.uint32)
        own = [c for c in range(0x110000) if chr(c).isalpha()]
        every[own] = own
        _letters.append(every)
    return _letters[0]


def _pieces(text: str) -> Iterator[tuple[int, int]]:
    """Where a long text is read in parts: each ends with a letter before white space and a letter, so no word is cut."""
    at = 0
    while len(text) - at > SLICE:
        whole = (m.start() + 1 for m in BETWEEN_WORDS.finditer(text, at + SLICE - 1) if m[0][0].lower()[-1].isalpha() and m[0][2].lower()[0].isalpha())
        end = next(whole, len(text))
        yield at, end
        at = end
    if at < len(text) or not text:
        yield at, len(text)


def grams(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of pieces of texts as (text of each piece, bounds of pieces, features of every n-gram, letters of each piece).

    N-grams don't cross texts; those that would have the feature ``FEATURES``. The three orders are rows of the
    feature array. A text longer than a slice comes in several pieces, which have all n-grams of the whole.
    """
    group: list[tuple[int, str, int, int]] = []
    size = 0
    for k, text in enumerate(texts):
        for a, b in _pieces(text or ""):
            group.append((k, text or "", a, b))
            size += b - a
            if size >= SLICE:
                yield _grams(group)
                group, size = [], 0
    if group:
        yield _grams(group)


def _grams(group: list[tuple[int, str, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    table, space = _table(), " ".encode("utf-32-le")
    parts = [text[a:b].lower().encode("utf-32-le", "surrogatepass") for _, text, a, b in group]
    _, text, _, end = group[-1]
    ahead = text[end + 1 : end + 2].lower().encode("utf-32-le", "surrogatepass")
    codes = table[np.frombuffer(space + space.join(parts) + space + ahead, np.uint32)]
    begins = np.cumsum([0, *(len(p) // 4 + 1 for p in parts)])
    letter = codes != 32
    counts = np.add.reduceat(letter[: begins[-1]], begins[:-1], dtype=np.int64)
    # a run of spaces is one; a border between pieces is always one of its own
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[begins] = True
    short = codes[keep]
    bounds = np.concatenate(([0], np.cumsum(np.add.reduceat(keep, begins, dtype=np.int64))[:-1]))
    own = bounds[-1]
    nxt = np.append(short[1:], np.uint32(32))
    third = np.append(nxt[1:], np.uint32(32))
    found = np.empty((3, own), np.int32)
    found[0] = ((short * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))[:own]
    found[1] = (((short * np.uint32(0x85EBCA77) + nxt * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BITS))[:own]
    found[2] = (((short * np.uint32(0x165667B1) + nxt * np.uint32(0xD3A2646D) + third * np.uint32(0xFD7046C5)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))[:own]
    # a piece owns its opening border and what follows, up to the next border
    last = bounds[1:][[b == len(text) for _, text, _, b in group]] - 1
    found[1:, last] = FEATURES
    found[2, np.maximum(last - 1, 0)] = FEATURES
    return np.array([k for k, *_ in group]), bounds, found, counts


@released
def _learn_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of document frequencies for the task (lang null), and the features of sampled rows."""
    df = np.zeros(FEATURES + 1, np.int64)
    rows = 0

    def made(langs, a, b, n):
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64())], names=["lang", "features", "counts", "n"])

    for batch in batches:
        langs, picked = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        out: list[tuple] = []
        pieces = ((int(k), found[:, a:b].ravel()) for owners, bounds, found, letters in grams(x.as_py() for x in batch.column(0)) for k, a, b, n in zip(owners, bounds, bounds[1:], letters) if n)
        for k, parts in groupby(pieces, key=lambda piece: piece[0]):
            seen = np.zeros(FEATURES + 1, bool)
            counts = np.zeros(FEATURES + 1, np.int64)
            for _, own in parts:
                seen[own] = True
                if picked[k]:
                    counts += np.bincount(own, minlength=FEATURES + 1)
            rows += 1
            df[seen] += 1
            if picked[k]:
                at = np.flatnonzero(seen[:FEATURES])
                out.append((langs[k], at.astype(np.int32).tobytes(), counts[at].astype(np.int32).tobytes(), int(counts[at].sum())))
        if out:
            yield made(*zip(*out, strict=True))
    yield made([None], [df[:FEATURES].tobytes()], [None], [rows])


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.int64) for x in table.column("features").to_pylist())
    return pa.table({"features": pa.array([total.tobytes()], pa.binary()), "n": pa.array([sum(table.column("n").to_pylist())], pa.int64())})


class Model:
    """idf-scaled weights, bias, languages and temperature."""

    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.languages, self.bias, self.temperature = languages, bias, temperature
        self.weights = np.vstack([weights, np.zeros((1, len(languages)))]).astype(np.float32)

    def predict(self, texts: Sequence[str | None] | pa.Array) -> tuple[list[str], list[float]]:
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        total, used, letters = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        blocks = [(slice(c, c + COLUMNS), np.ascontiguousarray(self.weights[:, c : c + COLUMNS])) for c in range(0, len(self.languages), COLUMNS)]
        for owners, bounds, found, own in grams(t.as_py() if isinstance(t, pa.Scalar) else t for t in texts):
            np.add.at(letters, owners, own)
            for row in found:
                np.add.at(used, owners, np.add.reduceat(row < FEATURES, bounds[:-1], dtype=np.int64))
                for columns, weights in blocks:
                    np.add.at(total[:, columns], owners, np.add.reduceat(weights[row], bounds[:-1], axis=0, dtype=np.float64))
        logits = (total / np.maximum(used, 1)[:, None] + self.bias) / self.temperature
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        names = [self.languages[b] if n else UNKNOWN for b, n in zip(best.tolist(), letters.tolist(), strict=True)]
        return names, np.where(letters > 0, p[np.arange(len(best)), best], 0.0).tolist()


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def train(rows: list[tuple[str, bytes, bytes, int]], df: np.ndarray, n_docs: int, seed: int = 3) -> Model:
    """Fit on sampled rows (lang, features, counts, n), in an order that doesn't depend on how they came."""
    rows = sorted(rows)
    languages = sorted({r[0] for r in rows})
    index = {name: k for k, name in enumerate(languages)}
    idf = np.log((1 + n_docs) / (1 + df)) + 1
    data = [(index[lang], f := np.frombuffer(a, np.int32), np.frombuffer(b, np.int32) / n * idf[f] * SCALE) for lang, a, b, n in rows if n]
    rng = np.random.Generator(np.random.PCG64(seed))
    order = rng.permutation(len(data))
    held, fit = order[: len(data) // 5], order[len(data) // 5 :]
    k = len(languages)
    z, n = np.zeros((FEATURES + 1, k)), np.zeros((FEATURES + 1, k))

    def weights(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        return np.where(np.abs(zs) <= LASSO, 0.0, -(zs - np.sign(zs) * LASSO) / ((BETA + np.sqrt(n[at])) / ALPHA + RIDGE))

    for _ in range(EPOCHS):
        for i in rng.permutation(fit).tolist():
            y, f, x = data[i]
            at, xs = np.append(f, FEATURES), np.append(x, 1.0)
            w = weights(at)
            miss = _softmax(xs @ w)
            miss[y] -= 1.0
            g = xs[:, None] * miss[None, :]
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    final = weights(np.arange(FEATURES + 1))
    bias, final = final[FEATURES], final[:FEATURES]
    logits = np.array([x @ final[f] + bias for _, f, x in (data[i] for i in held)]).reshape(-1, k)
    truth = np.array([data[i][0] for i in held], np.int64)
    # a share of doubt as after seeing every language once more keeps a sample without errors from scoring 1
    doubt = k / (len(truth) + k)
    best, temperature = math.inf, 1.0
    for t in np.exp(np.linspace(math.log(0.05), math.log(20), 121)) if len(truth) else ():
        s = logits / t
        top = s.max(axis=1)
        loss = float((np.log(np.exp(s - top[:, None]).sum(axis=1)) + top - (1 - doubt) * s[np.arange(len(truth)), truth] - doubt * s.mean(axis=1)).mean())
        if loss < best - 1e-12:
            best, temperature = loss, float(t)
    return Model(languages, final * idf[:, None] * SCALE, bias, temperature)


def _held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("long").cast("string")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """The model learned from the text and non-null language of rows with ``crc32(doc_id) % 5 <> 0``."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    training = plain.filter(~_held_out("doc_id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in training.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if sizes:
        quota = max(1, sample_rows // len(sizes))
        chance = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, int(min(1.0, quota / n) * DRAW))])
        picked = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(DRAW)) < chance[F.col("lang")]
        passed = cut(training.select("text", "lang", picked.alias("picked")).mapInArrow(_learn_pass, "lang string, features binary, counts binary, n long"), "language")
        # copies of one row are drawn together: they come as one row with their number, of which no more than the language's part counts
        alike = passed.filter("lang IS NOT NULL").groupBy("lang", "features", "counts", "n").agg(F.count("*").alias("copies"))
        sampled = [(r["lang"], r["features"], r["counts"], r["n"]) for r in alike.toLocalIterator() for _ in range(min(r["copies"], quota))]
        sums = passed.filter("lang IS NULL").select("features", "n", F.pmod(F.xxhash64("features", "n"), F.lit(64)).alias("salt")).groupBy("salt").applyInArrow(_add, "features binary, n long")
        whole = sums.withColumn("salt", F.lit(0)).groupBy("salt").applyInArrow(_add, "features binary, n long").first()
        return train(sampled, np.frombuffer(whole["features"], np.int64), whole["n"])
    return Model([], np.zeros((FEATURES, 0)), np.zeros(0), 1.0)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``.

    Learns from the text and non-null language of rows with ``crc32(doc_id) % 5 <> 0``; rows with a null id are
    held out too. Weights and temperature come from about ``sample_rows`` rows in all, equal parts for each language, picked
    by a hash of id and text, copies of a row together and then as one language's part at most; document frequencies count every training row. A text that is null or has no letter is
    ``und`` with score 0, as is every text if nothing can be learned. Repeated rows get equal predictions; of languages with
    equal scores the first by name is predicted. Other columns aren't read. A long text is read whole, in pieces that end
    between words, so memory is bounded but for a text without white space, which is one piece.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, id_col, text_col, lang_col, sample_rows))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, scores = shared.value.predict(b.column(2))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), _held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, text_col: str = "text", least: float = 0.35, **options) -> DataFrame:
    """The rows of ``docs`` whose text has a language with a score of ``least`` or more, with its columns.

    Rejected are texts that are null or have no letter, and those that fit no language: with four languages a text
    that says nothing scores 0.25. Rows are judged one by one, so repeated ones share their fate and ties need no rule;
    a null in any other column than the text plays no part, and an empty table gives an empty result. If no row has a language
    to learn from, no text is rejected but those without letters.
    """
    model = fit(docs, text_col=text_col, **options)
    if not model.languages:
        return docs.filter(F.col(text_col).rlike(r"\p{L}"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, scores = shared.value.predict(b.column(at))
            yield b.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(names, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
