"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word the last token of its encoding is unique. An automaton over the vocabulary
gives all tokens that end at a position; a token t that starts at s is the last one of the prefix if t
can stand after the last token of the prefix of length s, that is, if no merge of the two would have
crossed their border. Following the stored last tokens back from the end of the word gives the ids.
The cost is linear in the matches; no priority queue of merges is kept.

The vocabulary file is read once on the driver, and the encoder made from it broadcast; its size doesn't depend on the data.
"""

from __future__ import annotations

import json
import pickle
import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.shared import released

SUFFIX, END = "</w>", "\n"
#: Fixed values of the tokenizer's normalizer and pre-tokenizer: white space, and how words are found.
WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{WHITE}\p{{L}}\p{{N}}]+"
EARLY = 0x0378
#: Bytes that known words may take, entries of known pairs and of transitions that weren't in the trie, and code points encoded at once.
CACHE_BYTES, PAIRS, MISSED = 40 << 20, 200_000, 100_000
SLICE = 1 << 20


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b not in rest else chr(256 + rest.index(b)) for b in range(256)]


def unassigned() -> str:
    """A character class of the code points that Python's Unicode tables don't know.

    Libraries follow different versions of Unicode. Texts with such characters are split into words by
    the tokenizers library itself.
    """
    runs: list[list[int]] = []
    for c in range(0x110000):
        if unicodedata.category(chr(c)) == "Cn":
            if runs and runs[-1][1] == c - 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


def early(pattern: str) -> str:
    """``pattern`` with its classes spelled out below ``EARLY``, for the faster standard module."""
    below = [chr(c) for c in range(EARLY)]
    spelled = {kind: "".join(c for c in below if regex.fullmatch(rf"\p{{{kind}}}", c)) for kind in "LN"}
    return re.sub(r"\\p\{(.)\}", lambda m: spelled[m[1]], pattern)


class SuffixAutomaton:
    """For every prefix of a word, the vocabulary tokens that are its suffixes, longest first.

    A trie with suffix links; a missing transition follows the links once and is then stored, until there are too many.
    """

    def __init__(self, keys: dict[str, int]):
        self.next: list[dict[str, int]] = [{}]
        own: list[int] = [-1]
        depth = [0]
        for key, i in keys.items():
            at = 0
            for letter in key:
                if (to := self.next[at].get(letter)) is None:
                    to = self.next[at][letter] = len(self.next)
                    self.next.append({})
                    own.append(-1)
                    depth.append(depth[at] + 1)
                at = to
            own[at] = i
        self.link = [0] * len(self.next)
        self.ending: list[tuple[tuple[int, int], ...]] = [()] * len(self.next)
        level = [0]
        while level:
            below = []
            for at in level:
                for letter, to in list(self.next[at].items()):
                    self.link[to] = self._follow(self.link[at], letter) if at else 0
                    self.ending[to] = (((own[to], depth[to]),) if own[to] >= 0 else ()) + self.ending[self.link[to]]
                    below.append(to)
            level = below
        self.stored: list[tuple[int, str]] = []

    def _follow(self, at: int, letter: str) -> int:
        while (to := self.next[at].get(letter)) is None:
            if not at:
                return 0
            at = self.link[at]
        return to

    def step(self, at: int, letter: str) -> int:
        if len(self.stored) >= MISSED:
            for state, missed in self.stored:
                del self.next[state][missed]
            self.stored.clear()
        to = self.next[at][letter] = self._follow(at, letter)
        self.stored.append((at, letter))
        return to


def _bytes(word: str, ids: Sequence[int]) -> int:
    """What a known word takes, about."""
    return 250 + len(word) + 8 * len(ids)


class WordBpe:
    """Encoder and decoder for a vocabulary with word-end suffix whose ids follow the merge order."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model = spec["model"]
        ids = model["vocab"]
        self.size = max([*ids.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.names = [""] * self.size
        for name, i in ids.items():
            self.names[i] = name
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for name, i in self.special.items():
            self.names[i] = name
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[int, int] = {}
        for pair in model["merges"]:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            i = ids[left + right]
            self.parts[i] = ids[left], ids[right]
            self.merged[ids[left] << 20 | ids[right]] = i
        self._right: dict[int, list] = {}
        self._left: dict[int, list] = {}
        self.sound = self._sound(sorted(set(ids.values())))
        self.length = [0] * self.size
        keys = {}
        for name, i in ids.items():
            if i in self.sound:
                key = name[: -len(SUFFIX)] + END if name.endswith(SUFFIX) and len(name) > len(SUFFIX) else name
                self.length[i] = len(key)
                keys[key] = i
        self.matches = SuffixAutomaton(keys)
        #: For every token, which others can stand after it as far as that is known; and how many pairs are.
        self.fits: list[dict[int, bool]] = [{} for _ in range(self.size)]
        self.known = 0
        self.first = dict.fromkeys(self.sound, True)
        letters = byte_letters()
        self.letter = {chr(b): letters[b] for b in range(256)}
        self.table = {b: letters[b] for b in range(256) if letters[b] != chr(b)}
        self.word = regex.compile(WORD)
        self.early_word = re.compile(early(WORD))
        self.late = regex.compile(f"[{chr(EARLY)}-\U0010ffff]")
        self.unknown = regex.compile(f"[{unassigned()}]")
        self.definition = definition
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.new: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self.held = 0
        self._right.clear()
        self._left.clear()

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_str(self.definition)

    def _spine(self, i: int, side: int) -> list[tuple[int, int]]:
        """(token, id of the merge that consumes it) along one edge of a token's merge tree."""
        kept = (self._left, self._right)[side]
        if i not in kept:
            found, now, ends = [], i, 1 << 40
            while True:
                found.append((now, ends))
                if now not in self.parts:
                    break
                now, ends = self.parts[now][side], now
            kept[i] = found
        return kept[i]

    def crossing(self, a: int, b: int) -> int:
        """The first merge that crosses the border when a stands before b, or a large number.

        A merge fires while both edge tokens are whole. Of equal merges the leftmost goes first: one
        inside a precedes the crossing one, one inside b follows it.
        """
        first = 1 << 40
        for x, x_ends in self._spine(a, 1):
            for y, y_ends in self._spine(b, 0):
                m = self.merged.get(x << 20 | y, first)
                if m < first and m < x_ends and m <= y_ends:
                    first = m
        return first

    def _apart(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border when a stands before b."""
        merged, right = self.merged.get, self._spine(b, 0)
        for x, x_ends in self._spine(a, 1):
            for y, y_ends in right:
                if (m := merged(x << 20 | y)) is not None and m < x_ends and m <= y_ends:
                    return False
        return True

    def _sound(self, ids: list[int]) -> set[int]:
        """Tokens that are the encoding of their own letters; no other ever appears."""
        good: set[int] = set()
        for i in ids:
            if i not in self.parts or (self.parts[i][0] in good and self.parts[i][1] in good and self.crossing(*self.parts[i]) == i):
                good.add(i)
        return good

    def compatible(self, a: int, b: int) -> bool:
        """Whether b can stand after a; kept in the row of a. Nothing can stand after a prefix without encoding."""
        if a < 0:
            return False
        if self.known >= PAIRS:
            for row in self.fits:
                row.clear()
            self.known = 0
            self._right.clear()
            self._left.clear()
        self.known += 1
        fits = self.fits[a][b] = self._apart(a, b)
        return fits

    def _fill(self, words: set[str]) -> None:
        """Put the encodings of ``words`` into the cache.

        In sorted order neighbours share prefixes, and what is known of a shared prefix is kept.
        """
        table = self.table
        ordered = sorted((w if w.isascii() and w.isprintable() else w.encode("utf-8").decode("latin-1").translate(table), w) for w in words)
        compatible, fits, step, ending, miss = self.compatible, self.fits, self.matches.next, self.matches.ending, self.matches.step
        length, new = self.length, self.new
        # for every prefix its last token, what can stand after that, and the automaton's state; anything can stand at the start
        last, after, states, before = [-1], [self.first], [0], ""
        for letters, word in ordered:
            kept = 0
            for x, y in zip(letters, before):
                if x != y:
                    break
                kept += 1
            del last[kept + 1 :], after[kept + 1 :], states[kept + 1 :]
            state = states[kept]
            for letter in letters[kept:] + END:
                to = step[state].get(letter)
                state = miss(state, letter) if to is None else to
                found = -1
                for i, size in ending[state]:
                    fit = after[-size].get(i)
                    if fit or (fit is None and compatible(last[-size], i)):
                        found = i
                        break
                last.append(found)
                after.append(fits[found] if found >= 0 else {})
                states.append(state)
            out, n = [], len(letters) + 1
            while n:
                i = last[n]
                out.append(i)
                n -= length[i]
            out.reverse()
            new[word] = tuple(out)
            self.held += _bytes(word, out)
            before = letters
            last.pop()
            after.pop()
            states.pop()

    def _words(self, text: str) -> list[str]:
        """Words of a text between special tokens."""
        if text.isascii():
            return self.early_word.findall(text.lower())
        if self.late.search(text) and self.unknown.search(text):
            found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            back = {v: k for k, v in self.letter.items()}
            return [bytes(ord(back[c]) for c in w).decode("utf-8", "replace") for w, _ in found]
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return (self.word if self.late.search(text) else self.early_word).findall(text)

    def encode_all(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of whole texts; strings of special tokens in a text are those tokens."""
        split = []
        for text in texts:
            text = text or ""
            if self.cut is not None and any(s in text for s in self.special):
                split.append([[p] if p in self.special else self._words(p) for p in self.cut.split(text)])
            else:
                split.append([self._words(text)])
        if self.held >= CACHE_BYTES // 2:  # words that come again move on from the older half, the others go with it
            self.old, self.new, self.held = self.new, {}, 0
        new, older = self.new, self.old
        wanted = set(chain.from_iterable(chain.from_iterable(split))).difference(new)
        for word in wanted & older.keys():
            new[word] = older[word]
            self.held += _bytes(word, new[word])
        self._fill(wanted - older.keys())
        out = []
        for pieces in split:
            if len(pieces) == 1:
                out.append(list(chain.from_iterable(map(new.__getitem__, pieces[0]))))
            else:
                out.append([i for words in pieces for i in ([self.special[words[0]]] if len(words) == 1 and words[0] in self.special else chain.from_iterable(map(new.__getitem__, words)))])
        return out

    def encode(self, text: str | None) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> str:
        """Names of the tokens with a space between; this tokenizer file has no decoder step."""
        return " ".join(map(self.names.__getitem__, ids))


def encode_documents(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>, decoded string for every row of ``docs``.

    A null text is encoded as an empty one: no ids, an empty decoded string. Rows are independent, so
    repeated ids and ties need no rule, a null id is returned as it is, and other columns aren't read.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(WordBpe(f.read()), pickle.HIGHEST_PROTOCOL))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None  # a task without rows needs none; it goes with the task, so that workers don't keep it

        def made(ids, tokens, sizes, texts):
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            flat = pa.array(np.concatenate([np.asarray(t, np.int32) for t in tokens]) if tokens else np.empty(0, np.int32))
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(offsets, flat), pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

        for b in batches:
            model = model or pickle.loads(shared.value)
            ids, texts = b.column(0).to_pylist(), b.column(1)
            lo = 0
            while lo < len(ids):
                hi, part, held = lo, [], 0
                while hi < len(ids) and (not part or held < SLICE):
                    part.append(texts[hi].as_py())
                    held += len(part[-1] or "")
                    hi += 1
                found = model.encode_all(part)
                yield made(ids[lo:hi], found, [len(t) for t in found], [model.decode(t) for t in found])
                lo = hi

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id long, ids array<int>, decoded string")
