"""Plain versions of operators for small inputs."""

import math
import re
import zlib

import numpy as np

from millrace.llm.components import forest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near_components(docs):
    """{id: smallest id reachable} for [(id, text)], every pair compared through shared shingles."""
    sets = [(i, shingles(t)) for i, t in docs if i is not None]
    at, links = {}, set()
    for k, (_, s) in enumerate(sets):
        seen = {}
        for g in s:
            for other in at.get(g, ()):
                seen[other] = seen.get(other, 0) + 1
            at.setdefault(g, []).append(k)
        for other, both in seen.items():
            if 100 * both >= 75 * (len(s) + len(sets[other][1]) - both):
                links.add((sets[k][0], sets[other][0]))
    found = forest(links)
    return {i: found.get(i, i) for i, _ in sets}


def thinned(docs):
    """[(id, kept lines)] after removal of later three-line windows, for distinct ids in order."""
    seen, out = set(), []
    for i, text in sorted(docs, key=lambda d: d[0]):
        lines = text.split("\n") if text is not None else []
        gone = set()
        for k in range(len(lines) - 2):
            if (w := tuple(lines[k : k + 3])) in seen:
                gone |= {k, k + 1, k + 2}
            seen.add(w)
        out.append((i, [x for k, x in enumerate(lines) if k not in gone], len(gone), len(lines)))
    return out


def covered(docs):
    """{id: removed byte positions} for {id: bytes}."""
    seen, out = set(), {}
    for i in sorted(docs):
        t = docs[i]
        out[i] = {p for s in range(len(t) - 49) if t[s : s + 50] in seen for p in range(s, s + 50)}
        seen |= {t[s : s + 50] for s in range(len(t) - 49)}
    return out


def ngrams(text):
    """{hashed feature: count} of the one to three letters of a text, borders and runs of other characters being one space."""
    plain = re.sub(" +", " ", " " + "".join(c if c.isalpha() else " " for c in (text or "").lower()))
    found = {}
    for n in (1, 2, 3):
        for k in range(len(plain) - n + 1):
            a, b, c = (*map(ord, plain[k : k + n]), 0, 0)[:3]
            h = (a * 0x9E3779B1, (a * 0x85EBCA77 + b * 0xC2B2AE3D) * 0x27D4EB2F, (a * 0x165667B1 + b * 0xD3A2646D + c * 0xFD7046C5) * 0x9E3779B1)[n - 1] % 2**32 >> 16
            found[h] = found.get(h, 0) + 1
    return found


def language_model(docs):
    """(languages, {(feature, language): weight of its share}, bias, temperature) learned from [(id, text, lang)], all in the sample."""
    rows = [(lang, ngrams(text)) for i, text, lang in docs if lang is not None and any(c.isalpha() for c in text or "") and zlib.crc32(str(i).encode()) % 5]
    df = {}
    for _, found in rows:
        for f in found:
            df[f] = df.get(f, 0) + 1
    idf = {f: math.log((1 + len(rows)) / (1 + n)) + 1 for f, n in df.items()}
    arrays = [(lang, np.array(sorted(found), np.int32).tobytes(), np.array([found[f] for f in sorted(found)], np.int32).tobytes(), found) for lang, found in rows]
    arrays.sort(key=lambda r: r[:3])
    langs = sorted({lang for lang, _ in rows})
    data = [(lang, {f: n / sum(found.values()) * idf[f] * 30 for f, n in found.items()} | {"bias": 1.0}) for lang, _, _, found in arrays]
    rng = np.random.Generator(np.random.PCG64(3))
    order = rng.permutation(len(data)).tolist()
    held, fit = order[: len(data) // 5], order[len(data) // 5 :]
    z, n = {}, {}

    def weight(f, lang):
        at = z.get((f, lang), 0.0)
        return 0.0 if abs(at) <= 0.02 else -(at - math.copysign(0.02, at)) / ((1.0 + math.sqrt(n.get((f, lang), 0.0))) / 0.5 + 0.01)

    def logits(x):
        return [sum(v * weight(f, lang) for f, v in x.items()) for lang in langs]

    def probabilities(x, t=1.0):
        e = [math.exp((v - max(x)) / t) for v in x]
        return [v / sum(e) for v in e]

    for _ in range(3):
        for i in rng.permutation(fit).tolist():
            y, x = data[i]
            p = probabilities(logits(x))
            moved = {}
            for k, lang in enumerate(langs):
                for f, v in x.items():
                    g, old = v * (p[k] - (lang == y)), n.get((f, lang), 0.0)
                    moved[f, lang] = (z.get((f, lang), 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / 0.5 * weight(f, lang), old + g * g)
            z.update((at, a) for at, (a, _) in moved.items())
            n.update((at, b) for at, (_, b) in moved.items())
    doubt = len(langs) / (len(held) + len(langs))

    def loss(t):
        lost = 0.0
        for y, x in (data[i] for i in held):
            logs = [math.log(max(p, 1e-300)) for p in probabilities(logits(x), t)]
            lost -= (1 - doubt) * logs[langs.index(y)] + doubt * sum(logs) / len(langs)
        return lost / len(held)

    steps = [math.exp(v) for v in np.linspace(math.log(0.05), math.log(20), 121)]
    weights = {(f, lang): weight(f, lang) * idf[f] * 30 for f in idf for lang in langs}
    return langs, weights, [weight("bias", lang) for lang in langs], min(steps, key=loss)
