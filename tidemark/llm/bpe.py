"""Word-level byte-pair encoding and decoding with a public vocabulary.

Each piece of a word is encoded by a segment tree whose leaves are the merge ranks of
adjacent pairs: the root holds the lowest rank, the descent to the left finds its leftmost
pair, and a merge updates three leaves and their ancestors, until the root finds no pair.
Short pieces of a batch go through their trees side by side, a merge each a round; a long
piece has a tree of its own.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches

NONE = np.int32(2**31 - 1)
#: Pieces of up to this many symbols are encoded side by side.
WIDE = 64
#: Words whose ids a worker remembers; past it, it forgets them all and goes on.
REMEMBER = 120_000
#: Text is encoded in parts of about this many characters (whole documents).
PART_CHARS = 1 << 19

#: Unicode white space, as code points.
_SPACE = regex.compile("[" + "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])) + "]+")
#: Control characters that Python, but not Unicode, counts as white space.
_CONTROL = re.compile("[\x1c-\x1f]")
#: Characters from here on may be of another kind in this Python's Unicode version than in
#: the library's; the library's own normaliser and splitter see to texts that have them.
_RECENT = re.compile("[" + chr(0x250) + "-" + chr(0x10FFFF) + "]")


def _byte_letters() -> list[str]:
    """The usual printable stand-in of each byte: itself if it is a visible Latin-1
    character, else the next character from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, more = {}, 256
    for b in range(256):
        if b in seen:
            out[b] = chr(b)
        else:
            out[b], more = chr(more), more + 1
    return [out[b] for b in range(256)]


class WordBpe:
    """Encoder and decoder for a tokenizer file with this make-up: NFC, white space to one
    space, lower case; pieces by a pattern; bytes as letters; merges with a word-end suffix;
    added tokens found in the raw text; no decoder, so that tokens are joined by spaces."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if sys.byteorder != "little":
            raise ValueError("ids are laid out as this machine does, which must be little-endian")
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None or spec["post_processor"] is not None:
            raise ValueError(f"{path}: not a tokenizer of the kind that this encoder knows")
        self.suffix = model["end_of_word_suffix"]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.piece = regex.compile(pattern)
        self.split = tokenizers.pre_tokenizers.Split(tokenizers.Regex(pattern), "removed", invert=True)
        self.normaliser = tokenizers.Tokenizer.from_file(path).normalizer
        vocab: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.find_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        letters = _byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.final = np.array([vocab[c + self.suffix] for c in letters], np.int32)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.base = max(self.token) + 1
        # open addressing: pair -> rank, the lowest rank where a pair is listed twice
        pair = left * self.base + right
        pair, first = np.unique(pair, return_index=True)
        self.bits = max(4, int(len(pair) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        slot, todo = self._slot(pair), np.arange(len(pair))
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = self.keys[slot[todo]] == -1
            _, one = np.unique(slot[todo], return_index=True)
            put = np.zeros(len(todo), bool)
            put[one] = True
            put &= free
            self.keys[slot[todo[put]]] = pair[todo[put]]
            self.ranks[slot[todo[put]]] = first[todo[put]]
            todo = todo[~put]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
        self.rank_of = dict(zip(pair.tolist(), first.tolist(), strict=True))
        self.raw: dict[str, bytes] = {}  # ids of words met, as little-endian unsigned 32-bit integers
        self.text: dict[str, str] = {}

    def _slot(self, pair: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair; NONE for a pair that no merge joins, or a side below 0."""
        pair = a.astype(np.int64) * self.base + b
        slot = self._slot(pair)
        out = np.full(len(pair), NONE, np.int32)
        look = np.flatnonzero((a >= 0) & (b >= 0))
        for _ in range(self.probes):
            if not len(look):
                break
            at = slot[look]
            hit = self.keys[at] == pair[look]
            out[look[hit]] = self.ranks[at[hit]]
            look = look[~hit & (self.keys[at] != -1)]
            slot[look] = (slot[look] + 1) & ((1 << self.bits) - 1)
        return out

    # -- one piece, a tree of its own

    def encode_long(self, raw: bytes) -> list[int]:
        """Ids of one piece (not empty)."""
        ids = [*self.inner[np.frombuffer(raw[:-1], np.uint8)].tolist(), int(self.final[raw[-1]])]
        n, width = len(ids), 1
        while width < n:
            width *= 2
        rank = lambda a, b: self.rank_of.get(a * self.base + b, int(NONE))
        tree = [int(NONE)] * (2 * width)
        tree[width : width + n - 1] = [rank(a, b) for a, b in zip(ids, ids[1:], strict=False)]
        for i in range(width - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(i: int, value: int) -> None:
            i += width
            tree[i] = value
            while i > 1:
                i //= 2
                tree[i] = min(tree[2 * i], tree[2 * i + 1])

        while tree[1] != NONE:
            best, i = tree[1], 1
            while i < width:
                i = 2 * i if tree[2 * i] == best else 2 * i + 1
            i -= width
            j = after[i]
            ids[i], ids[j] = int(self.merged[best]), -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            put(j, int(NONE))
            put(i, rank(ids[i], ids[k]) if k < n else int(NONE))
            if before[i] >= 0:
                put(before[i], rank(ids[before[i]], ids[i]))
        return [x for x in ids if x >= 0]

    # -- many pieces, a merge each a round

    def _encode_wide(self, raws: list[bytes], width: int) -> list[list[int]]:
        n, rows = len(raws), np.arange(len(raws))
        size = np.array([len(r) for r in raws])
        flat = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raws), np.uint8).reshape(n, width)
        ids = np.where(np.arange(width) < size[:, None] - 1, self.inner[flat], -1)
        ids[rows, size - 1] = self.final[flat[rows, size - 1]]
        ids = np.concatenate([ids, np.full((n, 1), -1, ids.dtype)], axis=1)  # no symbol after the last
        tree = np.full((n, 2 * width), NONE, np.int32)
        tree[:, width:] = self._rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width)
        at = width
        while at > 1:
            tree[:, at // 2 : at] = np.minimum(tree[:, at : 2 * at : 2], tree[:, at + 1 : 2 * at : 2])
            at //= 2
        after = np.tile(np.minimum(np.arange(1, width + 2), width), (n, 1))
        before = np.tile(np.arange(-1, width), (n, 1))

        def put(r: np.ndarray, i: np.ndarray, value) -> None:
            i = i + width
            tree[r, i] = value
            while i[0] > 1:
                i = i // 2
                tree[r, i] = np.minimum(tree[r, 2 * i], tree[r, 2 * i + 1])

        r = np.flatnonzero(tree[:, 1] != NONE)
        while len(r):
            best = tree[r, 1]
            i = np.ones(len(r), np.int64)
            while i[0] < width:
                i = 2 * i + (tree[r, 2 * i] != best)
            i -= width
            j = after[r, i]
            k = after[r, j]
            ids[r, i], ids[r, j] = self.merged[best], -1
            after[r, i] = k
            before[r, k] = i  # column ``width`` stands for no symbol
            put(r, j, NONE)
            put(r, i, self._rank(ids[r, i], ids[r, k]))
            h = before[r, i]
            some = np.flatnonzero(h >= 0)
            if len(some):
                put(r[some], h[some], self._rank(ids[r[some], h[some]], ids[r[some], i[some]]))
            r = r[tree[r, 1] != NONE]
        some = ids >= 0
        ends, flat = np.cumsum(some.sum(1)).tolist(), ids[some].tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        raws = [p.encode("utf-8", "replace") for p in pieces]
        out: list[list[int]] = [[] for _ in raws]
        by: dict[int, list[int]] = {}
        for i, raw in enumerate(raws):
            if len(raw) > WIDE:
                out[i] = self.encode_long(raw)
            elif raw:
                by.setdefault(max(2, 1 << (len(raw) - 1).bit_length()), []).append(i)
        for width, members in by.items():
            for at in range(0, len(members), 8192):
                some = members[at : at + 8192]
                for i, ids in zip(some, self._encode_wide([raws[i] for i in some], width), strict=True):
                    out[i] = ids
        return out

    # -- texts

    def normalise(self, text: str) -> str:
        if _RECENT.search(text):
            return self.normaliser.normalize_str(text)
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return text.lower()

    def words(self, text: str | None) -> list[str]:
        """The runs between white space, with added tokens as words of their own (their
        exact content); pieces never span white space."""
        out: list[str] = []
        parts = self.find_added.split(text or "") if self.find_added else [text or ""]
        for k, part in enumerate(parts):
            if k % 2:
                out.append(part)
                continue
            plain = self.normalise(part)
            # split() also splits at four control characters that aren't white space here
            found = [w for w in _SPACE.split(plain) if w] if _CONTROL.search(plain) else plain.split()
            # an added token's content in lower-cased text is text
            out.extend(found if self.added.keys().isdisjoint(found) else ["\0" + w if w in self.added else w for w in found])
        return out

    def pieces(self, word: str) -> list[str]:
        if word.isascii() and word.isalpha():
            return [word]
        return [p for p, _ in self.split.pre_tokenize_str(word)] if _RECENT.search(word) else self.piece.findall(word)

    def learn(self, words: set[str]) -> None:
        """Remember the ids and the decoded text of these words."""
        cut = {w: self.pieces(w[1:] if w[1:] in self.added else w) for w in words if w not in self.added}
        found = list({p for ps in cut.values() for p in ps})
        raw, text = {}, {}
        for piece, ids in zip(found, self.encode_pieces(found), strict=True):
            raw[piece] = array("I", ids).tobytes()
            text[piece] = " ".join([self.token[i] for i in ids])
        for w, ps in cut.items():
            if len(ps) == 1:
                self.raw[w], self.text[w] = raw[ps[0]], text[ps[0]]
            else:
                self.raw[w], self.text[w] = b"".join([raw[p] for p in ps]), " ".join([text[p] for p in ps])
        for w in words & self.added.keys():
            self.raw[w], self.text[w] = array("I", [self.added[w]]).tobytes(), w

    def encode_batch(self, texts: list[str | None]) -> Iterator[tuple[bytes, int, str]]:
        """For each text: its ids as little-endian unsigned 32-bit integers, their number,
        and the decoded text."""
        cut = [self.words(t) for t in texts]
        if len(self.raw) > REMEMBER:
            self.raw.clear()
            self.text.clear()
        self.learn(set().union(*cut) - self.raw.keys())
        for ws in cut:
            raw = b"".join(map(self.raw.__getitem__, ws))
            yield raw, len(raw) // 4, " ".join(filter(None, map(self.text.__getitem__, ws)))

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by spaces; unknown ids are left out."""
        return " ".join(self.token[i] for i in ids if i in self.token)


_LOADED: dict[str, WordBpe] = {}


def loaded(path: str) -> WordBpe:
    """The tokenizer of a file, read once a worker."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and with ``keep_ids`` the ids,
    little-endian unsigned 32-bit integers) of every whole text.

    A null text is as an empty one: no ids, and the hashes of nothing.  Equal ids and
    repeated rows are rows of their own.  ``path`` must exist on every executor."""
    sha = lambda b: hashlib.sha256(b).hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = loaded(path)
        for pdf in batches:
            part = pdf["text"].str.len().fillna(0).to_numpy().cumsum() // PART_CHARS
            for _, rows in pdf.groupby(part, sort=False):
                n, ids_sha, text_sha, ids = [], [], [], []
                for raw, count, decoded in bpe.encode_batch([t if isinstance(t, str) else None for t in rows["text"]]):
                    n.append(count)
                    ids_sha.append(sha(raw))
                    text_sha.append(sha(decoded.encode("utf-8", "replace")))
                    ids.append(raw)
                out = {"doc_id": rows["doc_id"].array, "n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": text_sha}
                yield pd.DataFrame(out | ({"ids": ids} if keep_ids else {})).astype({"doc_id": "Int64"})

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids binary" if keep_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).transform(map_batches, run, schema)
