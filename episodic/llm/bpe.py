"""Byte-pair encoding and decoding with a contiguous rank array.

The vocabulary file is a parameter and is read by each Python worker (it comes
with an installed package, so every executor has it); it is never broadcast.
A word is held as an array of ids between part boundaries and, beside it, the
rank of each adjacent pair; the smallest rank is found by scanning, one boundary
is deleted and the two neighbouring ranks are refreshed. The new words of a group
of texts do this together, as rows of one array each for words of about one
length. Words longer than ``SHORT`` bytes keep their ranks in a heap, with the same
result. Chunks once encoded are remembered during a task (the memory is
emptied at ``CACHE`` entries; results do not depend on it).

Follows the file's own pipeline: canonical composition, white space runs as one
separator, lower case letter by letter, split into contractions, letter runs,
single digits and runs of other signs, bytes as printable signs, word-end mark.
Special tokens in a text become their ids; with ``special_as_text`` they are
ordinary text. Decoding joins the token strings with one blank (the file names
no decoder).

Edge cases: null and empty texts give no tokens and the empty decoded text.
"""

import hashlib
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodic.llm.common import released, slices

VOCAB = "word_bpe_49k.json"
CACHE = 150_000
GROUP = 4 << 20          # characters of text encoded together
SHORT = 48               # bytes of a word that is still scanned

# Unicode white space (what the file's \s means); str.split() would also cut at \x1c-\x1f.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_SPACES = re.compile("[\t-\r \x85\xa0  -     　]+")


# Code points (hexadecimal, ranges inclusive) on which the vocabulary's library and the modules used here
# differ, as these follow other editions of Unicode: here letters, digits and combining marks (or the second part of a
# composition) but not there; and lower cases that only it has.
NOT_LETTERS = """558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959
10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA 18D09-18D20
18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE
1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"""
NOT_DIGITS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"
NOT_MARKS = """7FD 898-89F 8CA-8D3 9FE C3C D3B-D3C EBA 1715 1ABF-1ACE 1DF6-1DFA A82C 10D24-10D27 10EAB-10EAC 10EFD-10EFF
10F46-10F50 10F82-10F85 11070 1133B 1145E 11839-1183A 11930 1193D-1193E 11943 119E0 11A34 11A47 11A99 11D42 11D44-11D45 11D97
11F41-11F42 16FF0-16FF1 1E08F 1E130-1E136 1E2AE 1E2EC-1E2EF 1E4EC-1E4EF"""
LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
LOWER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}


def _set(ranges: str) -> str:
    """A character set of such a list."""
    return "".join("-".join(chr(int(x, 16)) for x in r.split("-")) for r in ranges.split())


_ODD_SIGN = re.compile(f"[{_set(NOT_LETTERS)}{_set(NOT_DIGITS)}]")
_ODD_CASE = re.compile(f"[Σ{''.join(map(chr, LOWER))}]")


_ODD_MARK = re.compile(f"([{_set(NOT_MARKS)}])")


def compose(text: str) -> str:
    """Canonical composition, in which the odd marks stand alone."""
    if text.isascii():
        return text
    if _ODD_MARK.search(text):
        return "".join([unicodedata.normalize("NFC", part) for part in _ODD_MARK.split(text)])
    return unicodedata.normalize("NFC", text)


def lower(text: str) -> str:
    """Lower case sign by sign (no final sigma)."""
    return "".join([chr(LOWER[ord(c)]) if ord(c) in LOWER else c.lower() for c in text]) if _ODD_CASE.search(text) else text.lower()


def _byte_signs() -> list[str]:
    """The printable sign of each byte: itself where printable, else 256 and up in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    extra = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(extra)) for b in range(256)]


class Pairs:
    """Rank and merged id of a pair of ids, looked up for whole arrays: one slot table, a second one for its collisions."""

    BITS = 20

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.merged = np.append(merged, 0).astype(np.int32)          # by rank
        self.key = np.append((left.astype(np.int64) << 32) | right, -1)
        self.none = len(merged)
        rank, self.tables = np.arange(self.none), []
        seed = 0x9E3779B97F4A7C15
        while len(rank):
            slot = np.full(1 << self.BITS, self.none, np.int32)
            at = self._at(self.key[rank], seed)
            slot[at[::-1]] = rank[::-1]
            self.tables.append((seed, slot))
            rank = rank[slot[at] != rank]
            seed = (seed * 0xD1342543DE82EF95 + 1) & 0xFFFFFFFFFFFFFFFF | 1

    def _at(self, key: np.ndarray, seed: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * np.uint64(seed)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right
        out = np.full(key.shape, self.none, np.int32)
        for seed, slot in self.tables:
            r = slot[self._at(key, seed)]
            out = np.where(self.key[r] == key, r, out)
        return out


class Tokenizer:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(pattern)
        self.split_odd = regex.compile(pattern.replace(r"\p{L}", rf"[\p{{L}}--[{_set(NOT_LETTERS)}]]").replace(
            r"[\p{N}]", r"\p{N}").replace(r"\p{N}", rf"[\p{{N}}--[{_set(NOT_DIGITS)}]]"), regex.V1)
        signs = _byte_signs()
        self.byte = np.array([self.vocab[c] for c in signs], np.int32)
        self.last = np.array([self.vocab[c + end] for c in signs], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.pairs = Pairs(*(np.array([self.vocab[x] for x in side], np.int32)
                             for side in ([a for a, _ in merges], [b for _, b in merges], [a + b for a, b in merges])))
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.known: dict[str, tuple[bytes, str]] = {}        # chunk of a text -> ids, decoded
        self.words: dict[str, tuple[bytes, str]] = {}        # word of a chunk -> ids, decoded

    # ------------------------------------------------------------ merging

    def merge(self, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges the first ``size`` ids of each row of ``ids``; returns the rows, moved to the left, and their sizes.

        Every row holds the ids between its part boundaries and, beside them, the ranks of adjacent pairs. In each
        round every row with a known pair deletes the boundary of its leftmost smallest rank and refreshes the two
        ranks next to it.
        """
        none, wide = self.pairs.none, ids.shape[1]
        col = np.arange(wide)
        ranks = np.full(ids.shape, none, np.int32)
        if wide > 1:
            ranks[:, :-1] = np.where(col[1:] < size[:, None], self.pairs(ids[:, :-1], ids[:, 1:]), none)
        out, sizes = ids.copy(), size.copy()
        live = np.arange(len(ids))
        while len(live):
            at = ranks.argmin(axis=1)
            row = np.arange(len(live))
            least = ranks[row, at]
            go = least < none
            if not go.all():
                done = live[~go]
                out[done], sizes[done] = ids[~go], size[~go]
                ids, ranks, size, live, at, least = ids[go], ranks[go], size[go], live[go], at[go], least[go]
                row = row[:len(live)]
                if not len(live):
                    break
            moved = col[None, :-1] > at[:, None]
            ids[:, :-1] = np.where(moved, ids[:, 1:], ids[:, :-1])
            ids[row, at] = self.pairs.merged[least]
            gone = col[None, :-1] >= at[:, None]
            ranks[:, :-1] = np.where(gone, ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = none
            size = size - 1
            right = np.flatnonzero(at + 1 < size)
            ranks[right, at[right]] = self.pairs(ids[right, at[right]], ids[right, at[right] + 1])
            ranks[np.flatnonzero(at + 1 >= size), at[at + 1 >= size]] = none
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.pairs(ids[left, at[left] - 1], ids[left, at[left]])
        return out, sizes

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same for one long word, where scanning would take too long: boundaries as a linked list, ranks in a heap."""
        n, none = len(ids), self.pairs.none
        nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        first = self.pairs(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(r), i) for i, r in enumerate(first) if r < none]
        rank = {i: r for r, i in heap}
        heapq.heapify(heap)
        pair = {(int(k) >> 32, int(k) & 0xFFFFFFFF): r for r, k in enumerate(self.pairs.key[:-1])} if heap else {}
        while heap:
            r, i = heapq.heappop(heap)
            if not alive[i] or rank.get(i) != r:
                continue
            j = nxt[i]
            ids[i] = int(self.pairs.merged[r])
            alive[j] = False
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            for a in (prv[i], i):
                if a < 0:
                    continue
                got = pair.get((ids[a], ids[nxt[a]])) if nxt[a] < n else None
                rank[a] = got
                if got is not None:
                    heapq.heappush(heap, (got, a))
        return [x for x, ok in zip(ids, alive) if ok]

    def _learn_words(self, words: list[str]) -> None:
        """Ids of new words, all words of about one length at once."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        size = np.array([len(b) for b in raw])
        for low, high in ((0, 4), (4, 8), (8, 12), (12, 16), (16, 24), (24, SHORT)):
            some = np.flatnonzero((size > low) & (size <= high))
            for i in range(0, len(some), 65536):
                part = some[i:i + 65536]
                n = size[part]
                data = np.frombuffer(b"".join([raw[k].ljust(high, b"\0") for k in part]), np.uint8).reshape(len(part), high)
                ids = self.byte[data]
                row = np.arange(len(part))
                ids[row, n - 1] = self.last[data[row, n - 1]]
                ids, n = self.merge(ids, n)
                packed, w = ids.astype("<u4").tobytes(), 4 * high
                for k, (j, m, names) in enumerate(zip(part.tolist(), n.tolist(), ids.tolist())):
                    self.words[words[j]] = packed[k * w:k * w + 4 * m], " ".join([self.names[x] for x in names[:m]])
        for j in np.flatnonzero(size > SHORT):
            data = np.frombuffer(raw[j], np.uint8)
            ids = self.merge_long([*self.byte[data[:-1]].tolist(), int(self.last[data[-1]])])
            self.words[words[j]] = struct.pack(f"<{len(ids)}I", *ids), " ".join([self.names[x] for x in ids])

    def learn(self, chunks: set[str]) -> None:
        """Remembers the ids of new chunks (parts of texts between white space)."""
        cut = {}
        for c in chunks:
            if c.isascii():
                low = c.lower()
                body = low[:-1]
                if low.isalpha():
                    cut[c] = (low,)
                elif low[-1] in ".,;:!?" and body.isalpha():
                    cut[c] = (body, low[-1])
                else:
                    cut[c] = self.split.findall(low)
            else:
                low = lower(c)
                cut[c] = (self.split_odd if _ODD_SIGN.search(low) else self.split).findall(low)
        if len(self.words) >= CACHE:
            self.words.clear()
        words = self.words
        self._learn_words(list({w for ws in cut.values() for w in ws if w not in words}))
        for c, ws in cut.items():
            if len(ws) == 1:
                self.known[c] = words[ws[0]]
            else:
                parts = [words[w] for w in ws]
                self.known[c] = b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts])

    # ------------------------------------------------------------ texts

    def _pieces(self, text: str) -> list[str]:
        text = compose(text)
        if _ODD_SPACE.search(text):
            return [p for p in _SPACES.split(text) if p]
        return text.split()

    def encode_many(self, texts, special_as_text: bool = False) -> list[tuple[bytes, str]]:
        """(ids as little-endian 32-bit integers, decoded text) of each text."""
        out, group, held = [], [], 0
        for t in texts:
            group.append(t)
            held += len(t or "")
            if held >= GROUP:
                out += self._encode_group(group, special_as_text)
                group, held = [], 0
        return out + self._encode_group(group, special_as_text)

    def _encode_group(self, texts: list, special_as_text: bool) -> list[tuple[bytes, str]]:
        cut, new = [], set()
        if len(self.known) >= CACHE:
            self.known.clear()
        for t in texts:
            parts = [t or ""] if special_as_text or not t or "<|" not in t else self.cut.split(t)
            pieces = [None if k % 2 else self._pieces(p) for k, p in enumerate(parts)]
            cut.append((parts, pieces))
            for p in pieces:
                if p:
                    new.update(p)
        new -= self.known.keys()
        self.learn(new)
        known, out = self.known, []
        for parts, pieces in cut:
            got = []
            for part, piece in zip(parts, pieces):
                got += [(struct.pack("<I", self.special[part]), part)] if piece is None else [known[p] for p in piece]
            out.append((b"".join([g[0] for g in got]), " ".join([g[1] for g in got if g[0]])))
        for c in [c for c in new if len(c) > 64]:
            del self.known[c]
        return out

    def forget(self) -> None:
        """Gives the remembered chunks back; called at the end of a task, as workers outlive it."""
        self.known, self.words = {}, {}

    def encode(self, text: str | None, special_as_text: bool = False) -> tuple[bytes, str]:
        return self.encode_many([text], special_as_text)[0]


_LOADED: dict[str, Tokenizer] = {}


def tokenizer(path: str | None = None) -> Tokenizer:
    """The tokenizer of a vocabulary file, kept by the worker."""
    path = path or public_tokenizers.path(VOCAB)
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]


def encode(text: Column, path: str | None = None, special_as_text: bool = False) -> Column:
    """Token ids of each text as an array column."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = tokenizer(path)
        for s in batches:
            yield pd.Series([np.frombuffer(x, np.int32) for x, _ in t.encode_many(s, special_as_text)], dtype=object)
        t.forget()

    return ids(text)


def decode(ids: Column, path: str | None = None) -> Column:
    """Decoded text of each id array (ids outside the vocabulary and nulls are left out)."""

    @F.pandas_udf("string")
    def text(s: pd.Series) -> pd.Series:
        names = tokenizer(path).names
        return pd.Series(["" if x is None else " ".join(names[i] for i in x if i in names) for x in s], dtype=object)

    return text(ids)


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document; a worker holds the tokens of ``GROUP`` signs at once."""

    def run(batches):
        t = tokenizer(path)
        for batch in batches:
            for part in slices(batch, "text", GROUP):
                out = [(len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
                       for ids, back in t.encode_many(part.column("text").to_pylist())]
                n, ids, back = zip(*out)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(back)],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        # the vocabulary goes too: an idle worker would hold it through all later stages
        t.forget()
        _LOADED.clear()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(released(run), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
