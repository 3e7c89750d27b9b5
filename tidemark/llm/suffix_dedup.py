"""Removal of long repeated byte strings, by column-wise construction of the Burrows-Wheeler
transform and the common prefixes of many strings.

1. Anchors.  A window is a string of WINDOW bytes.  Its anchor is the smallest hash of the
   short strings in it, so that equal windows have equal anchors.  Consecutive windows with
   one anchor are a run, and the bytes that they span a read, under 2 * WINDOW long.  A
   window can only be repeated if its anchor is, so that runs of unrepeated anchors are done.
2. Equal reads.  Of reads with equal bytes, found by their digests, all but the first have
   every window repeated.  The first ones go on if an anchor with half a window's other bytes,
   before or after it, is that of another such read too: every window has as many on one side.
3. Construction.  Reads are dealt to tasks by anchor.  For a block of them, written in
   symbols of several bytes, the transform of the collection is built column by column: each round inserts one symbol of every read,
   at the place that the rank of that symbol gives, and updates the common prefix lengths
   beside it.  The transform, the prefixes and the suffixes' names are sequential files that
   every round reads and writes once.  Where the common prefix is as long as a window,
   neighbouring suffixes start with equal windows; all but the first of them are repeated.
   Of an anchor with more reads than a block should hold (a common short phrase), the windows
   are compared by their digests instead, so that they spread over all tasks.
4. Every byte under a repeated window is removed.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import cut, map_arrow, map_batches

WINDOW, ANCHOR = 100, 24
#: Beside its anchor, a window has at least this many bytes on one side (ANCHOR is more than
#: half of it, so that three short hashes tell of all bytes of both).
HALF = (WINDOW - ANCHOR) // 2
#: Bytes that make a symbol of the construction (5, or that doubled); a window is a whole
#: number of them.
SYMBOL = 20
#: Reads of one anchor that a block takes, at most, and bytes of reads from which it is full.
ANCHOR_READS, BLOCK_BYTES = 4096, 1 << 18
#: Texts are searched for anchors in parts of about this many bytes (whole documents).
PART_BYTES = 1 << 18

_BASE = 0x100000001B3 | 1
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _short_hashes(b: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` bytes from each position on, by doubling."""
    step = b.astype(np.uint64) + np.uint64(1)
    have, done, size = None, 0, 1
    with np.errstate(over="ignore"):
        while True:
            if length & size:
                if have is None:
                    have, done = step, size
                else:
                    n = len(b) - done - size + 1
                    have = have[:n] * np.uint64(pow(_BASE, size, 1 << 64)) + step[done : done + n]
                    done += size
            if 2 * size > length:
                break
            n = len(step) - size
            step = step[:n] * np.uint64(pow(_BASE, size, 1 << 64)) + step[size : size + n]
            size *= 2
        have = (have ^ (have >> np.uint64(29))) * _MULT
        return have ^ (have >> np.uint64(32))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


def find_runs(raws: list[bytes], context: bool = False) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: text number, first window, end (exclusive), and
    the anchor in 48 bits; with ``context`` also hashes of the anchor with the HALF bytes
    before it, and with those after it (0: the run's read doesn't have as many)."""
    size = np.array([len(r) for r in raws], np.int64)
    long = np.flatnonzero(size >= WINDOW)
    if not len(long):
        return (np.empty(0, np.int64),) * (6 if context else 4)
    ends = np.cumsum(size[long])
    begins = ends - size[long]
    b = np.frombuffer(b"".join([raws[i] for i in long]), np.uint8)
    h = _short_hashes(b, ANCHOR)
    low = _sliding_min(h, WINDOW - ANCHOR + 1)
    edge = np.zeros(len(b) + 1, np.int8)
    edge[begins] = 1
    edge[ends - WINDOW + 1] -= 1
    valid = np.cumsum(edge[: len(low)]) > 0
    new = valid.copy()
    # a run ends where the smallest hash changes, and where its leftmost place drops out
    new[1:] &= ~(valid[:-1] & (low[1:] == low[:-1]) & (h[: len(low) - 1] != low[:-1]))
    lo = np.flatnonzero(new)
    doc = np.searchsorted(ends, lo, side="right")
    hi = np.minimum(np.append(lo[1:], len(b)), ends[doc] - WINDOW + 1)
    runs = long[doc], lo - begins[doc], hi - begins[doc], (low[lo] >> np.uint64(16)).astype(np.int64)
    if not context:
        return runs
    # the anchor's place: the last of the window where the smallest hash has just come down,
    # the first of the run's last window where it is about to drop out, else to be looked for
    width = WINDOW - ANCHOR + 1
    down = np.zeros(len(lo), bool)
    down[1:] = valid[lo[1:] - 1] & (low[lo[1:]] < low[lo[1:] - 1])
    out = h[hi - 1] == low[lo]
    at = np.where(down, lo + width - 1, hi - 1)
    rest = np.flatnonzero(~down & ~out)
    for k in range(0, len(rest), 4096):  # bounds memory
        some = lo[rest[k : k + 4096]]
        at[rest[k : k + 4096]] = some + h[some[:, None] + np.arange(width)].argmin(1)

    def around(i: np.ndarray) -> np.ndarray:
        """Hash of ANCHOR + HALF bytes, of short hashes that overlap."""
        i = np.clip(i, 0, len(h) - HALF - 1)
        with np.errstate(over="ignore"):
            x = (h[i] * _MULT + h[i + HALF // 2]) * _MULT + h[i + HALF]
        return (x ^ (x >> np.uint64(31))).view(np.int64) | 1

    before = np.where(at - HALF >= lo, around(at - HALF), 0)
    after = np.where(at + ANCHOR + HALF <= hi + WINDOW - 1, around(at), 0)
    return *runs, before, after


def _parts(pdf: pd.DataFrame, size: pd.Series) -> Iterator[pd.DataFrame]:
    for _, part in pdf.groupby(size.to_numpy().cumsum() // PART_BYTES, sort=False):
        yield part


def _raw(text) -> bytes:
    return text.encode("utf-8", "replace") if isinstance(text, str) else b""


# -- the construction


class _Files:
    """Three columns of a block, each a sequential file."""

    def __init__(self, folder: str, kind: type):
        self.files = [open(f"{folder}/{k}", "w+b") for k in ("transform", "prefixes", "suffixes")]  # noqa: SIM115
        self.kinds = (kind, np.uint8, np.int32)

    def read(self) -> list[np.ndarray]:
        out = []
        for f, kind in zip(self.files, self.kinds, strict=True):
            f.seek(0)
            out.append(np.fromfile(f, kind))
        return out

    def write(self, *columns: np.ndarray) -> None:
        for f, col in zip(self.files, columns, strict=True):
            f.seek(0)
            col.tofile(f)
            f.truncate()

    def close(self) -> None:
        for f in self.files:
            f.close()


def _range_min(x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minimum of x[first .. last] for each pair, in order of ``first``: the stretches
    between ranges, which are read too, then add up to x at most."""
    if not len(first):
        return np.empty(0, x.dtype)
    order = np.argsort(first)
    pairs = np.stack([first[order], last[order] + 1], axis=1).ravel()
    out = np.empty(len(first), x.dtype)
    out[order] = np.minimum.reduceat(np.append(x, x.dtype.type(255)), pairs)[::2]
    return out


def _stable_order(symbols: np.ndarray) -> np.ndarray:
    """Positions in stable order of symbol; 16 bits at a time, which numpy sorts by radix."""
    order = np.argsort((symbols & 0xFFFF).astype(np.uint16), kind="stable").astype(np.int32)
    if symbols.dtype != np.uint16:
        high = (symbols >> 16).astype(np.uint16)
        order = order[np.argsort(high[order], kind="stable")]
    return order


def build(symbols: np.ndarray, size: np.ndarray, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix length (in symbols) of each suffix of the strings with the one before
    it, and the suffixes as string * 256 + start, in suffix order.

    ``symbols`` holds the strings one after another, of ``size`` symbols each (under 256),
    numbered from 1.  Each string ends in an end mark of its own, in the order of the
    strings, written 0 in the transform.  Before round j the files hold the suffixes of up
    to j - 1 symbols; ``place`` is that of each string's longest one."""
    n = len(size)
    if n and size.max() >= 256:
        raise ValueError("a string must be shorter than 256 symbols")
    kind = np.uint16 if len(symbols) == 0 or symbols.max() < 1 << 16 else np.uint32
    flat = np.append(symbols, 0).astype(kind)
    begins = np.cumsum(size) - size
    symbol_at = lambda r, i: np.where(i >= 0, flat[np.maximum(begins[r] + i, 0)], kind(0))
    files = _Files(folder, kind)
    try:
        every = np.arange(n)
        files.write(symbol_at(every, size - 1), np.zeros(n, np.uint8), (every * 256 + size).astype(np.int32))
        place, active = every.copy(), np.flatnonzero(size > 0)
        for j in range(1, int(size.max(initial=0)) + 1):
            t, p, s = files.read()
            by_symbol = _stable_order(t)
            rank = np.empty(len(t), np.int32)
            rank[by_symbol] = np.arange(len(t), dtype=np.int32)
            at = place[active]
            r = rank[at]
            # end marks' suffixes come first, then all others in the order of symbol and tail
            goes = n + r - np.count_nonzero(t == 0)
            # neighbours that start with the same symbol are that symbol's places before and after
            c = t[at]
            left, right = by_symbol[np.maximum(r - 1, 0)], by_symbol[np.minimum(r + 1, len(t) - 1)]
            has_left, has_right = (r > 0) & (t[left] == c), (r + 1 < len(t)) & (t[right] == c)
            before, after = np.zeros(len(at), np.uint8), np.zeros(len(at), np.uint8)
            before[has_left] = _range_min(p, left[has_left] + 1, at[has_left]) + 1
            after[has_right] = _range_min(p, at[has_right] + 1, right[has_right]) + 1
            old = np.ones(len(t) + len(at), bool)
            old[goes] = False
            old = np.flatnonzero(old)
            columns = []
            for was, new in ((t, symbol_at(active, size[active] - j - 1)), (p, before), (s, active * 256 + size[active] - j)):
                col = np.empty(len(t) + len(at), was.dtype)
                col[old] = was
                col[goes] = new
                columns.append(col)
            follows = goes + 1 < len(columns[1])
            columns[1][goes[follows] + 1] = after[follows]
            files.write(*columns)
            place[active] = goes
            active = active[size[active] > j]
        _, p, s = files.read()
        return p, s
    finally:
        files.close()


def _names(b: np.ndarray) -> np.ndarray:
    """A number for the SYMBOL bytes from each position on, equal only for equal bytes: of
    five bytes first, then of pairs of numbers, twice as many bytes each time."""
    size = 5
    word = np.zeros(max(0, len(b) - size + 1), np.uint64)
    for k in range(size):
        word |= b[k : len(b) - size + 1 + k].astype(np.uint64) << np.uint64(8 * k)
    while True:
        name, _ = pd.factorize(word)
        if size == SYMBOL:
            return name
        word = (name[:-size].astype(np.uint64) << np.uint64(32)) | name[size:].astype(np.uint64)
        size *= 2


def _phases(reads: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The reads as strings of SYMBOL-byte symbols: symbols (numbered from 1), and each
    string's size, read and first byte.

    A read gives a string for each place that a window may have relative to the anchor,
    modulo SYMBOL.  Equal windows are at equal places, so that they are equal substrings of
    strings of the same kind."""
    size = np.array([len(r) for r in reads])
    begins = np.cumsum(size) - size
    b = np.frombuffer(b"".join(reads), np.uint8)
    h = _short_hashes(b, ANCHOR)
    anchor = h[begins[:, None] + np.arange(WINDOW - ANCHOR + 1)].argmin(1)
    read = np.repeat(np.arange(len(reads)), SYMBOL)
    first = (anchor[read] - np.tile(np.arange(SYMBOL), len(reads))) % SYMBOL
    count = (size[read] - first) // SYMBOL
    name = _names(b)
    ends = np.cumsum(count)
    nth = np.arange(ends[-1]) - np.repeat(ends - count, count)
    symbols = name[np.repeat(begins[read] + first, count) + SYMBOL * nth]
    return symbols.astype(np.int64) + 1, count, read, first


def repeated_starts(reads: list[bytes], doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Of reads (of a window at least, with one anchor each) at ``start`` in documents that
    are numbered in order: doc * 2^32 + window start of every window that also starts
    earlier in one of them, sorted."""
    symbols, size, read_of, first_byte = _phases(reads)
    with tempfile.TemporaryDirectory(prefix="columns-") as folder:
        prefix, suffix = build(symbols, size, folder)
    group = np.cumsum(prefix < WINDOW // SYMBOL)
    string, at = suffix >> 8, suffix & 255
    full = size[string] - at >= WINDOW // SYMBOL
    string, at, group = string[full], at[full], group[full]
    read = read_of[string]
    key = (doc[read].astype(np.int64) << 32) + start[read] + first_byte[string] + SYMBOL * at
    if not len(key):
        return key
    first = np.flatnonzero(np.diff(group, prepend=group[0] - 1))
    least = np.repeat(np.minimum.reduceat(key, first), np.diff(np.append(first, len(key))))
    return np.sort(key[key != least])


# -- the operator


def _described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, _text, _tx (a hash of the text) and _r1, _r2, which rows are joined by: the
    id (without one: the text's hash), and a few bits of the text's hash, so that rows of
    one id and different texts spread."""
    return _referenced(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text")))


def _referenced(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("_tx", F.xxhash64("_text"))
    return rows.withColumn("_r1", F.coalesce("doc_id", "_tx")).withColumn("_r2", F.col("_tx").bitwiseAND(F.lit(32767)).cast("int"))


def _packed(rows: DataFrame, others: list[str]) -> DataFrame:
    """The text as compressed UTF-8 bytes (_z), to be shuffled."""
    keep = ["doc_id", "_tx", "_r1", "_r2", *others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            z = pa.array([pack.compress(_raw(t)) for t in batch.column("_text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], z], names=[*keep, "_z"])

    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField("_z", T.BinaryType())])
    return rows.select("_text", *keep).transform(map_arrow, run, schema)


def _unpacked(pdf: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, list[bytes]]]:
    """Parts of a batch of _z rows, with their texts' bytes."""
    unpack = zstandard.ZstdDecompressor()
    rows, raws, size = [], [], 0
    for i, z in enumerate(pdf["_z"]):
        rows.append(i)
        raws.append(unpack.decompress(z))
        size += len(raws[-1])
        if size >= PART_BYTES:
            yield pdf.iloc[rows], raws
            rows, raws, size = [], [], 0
    if rows:
        yield pdf.iloc[rows], raws


def _anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for part in _parts(pdf, pdf["_text"].str.len()):
            doc, _, _, anchor = find_runs([_raw(t) for t in part["_text"]])
            yield pd.DataFrame({"anchor": anchor, "_r1": part["_r1"].to_numpy()[doc], "_r2": part["_r2"].to_numpy()[doc]})


def _runs_of(part: pd.DataFrame, raws: list[bytes], context: bool = False) -> Iterator[tuple]:
    """For each row with repeated anchors (_anchors): row, and what find_runs() says of its
    runs of these."""
    known = [a if a is not None and len(a) else None for a in part["_anchors"]]
    doc, *runs = find_runs([r if a is not None else b"" for r, a in zip(raws, known, strict=True)], context)
    if not len(doc):
        return
    # row and anchor as one number: a part has few rows, and an anchor 48 bits
    listed = np.concatenate([(i << 48) | np.asarray(a, np.int64) for i, a in enumerate(known) if a is not None])
    keep = np.isin((doc << 48) | runs[2], listed)
    doc, runs = doc[keep], [r[keep] for r in runs]
    begin = np.flatnonzero(np.diff(doc, prepend=-1))
    for lo, hi in zip(begin, [*begin[1:], len(doc)], strict=True):
        yield int(doc[lo]), *[r[lo:hi] for r in runs]


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each run of a repeated anchor, with its read's digest."""
    for pdf in batches:
        for part, raws in _unpacked(pdf):
            out = {k: [] for k in ("anchor", "digest", "row", "start", "n", "before", "after")}
            for i, lo, hi, anchor, before, after in _runs_of(part, raws, context=True):
                raw = raws[i]
                out["anchor"].append(anchor)
                out["before"].append(before)
                out["after"].append(after)
                out["digest"].extend([xxhash.xxh3_128_digest(raw[a : b + WINDOW - 1]) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)])
                out["row"].append(np.full(len(lo), i))
                out["start"].append(lo)
                out["n"].append(hi - lo)
            if out["row"]:
                row = np.concatenate(out["row"])
                yield pd.DataFrame({"anchor": np.concatenate(out["anchor"]), "digest": out["digest"], "doc_id": part["doc_id"].array[row], "_tx": part["_tx"].to_numpy()[row], **{k: np.concatenate(out[k]) for k in ("start", "n", "before", "after")}}).astype({"doc_id": "Int64"})


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The reads that _wanted lists (of the row's own text), as bytes."""
    for pdf in batches:
        for part, raws in _unpacked(pdf):
            out = []
            for raw, doc_id, tx, wanted in zip(raws, part["doc_id"], part["_tx"], part["_wanted"], strict=True):
                out.extend((w["anchor"], w["many"], doc_id, tx, w["start"], raw[w["start"] : w["start"] + w["n"] + WINDOW - 1]) for w in wanted if w["_tx"] == tx)
            yield pd.DataFrame(out, columns=["anchor", "many", "doc_id", "_tx", "start", "read"]).astype({"doc_id": "Int64"})


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of whole anchors' reads (sorted by anchor) through the construction: ranges of
    repeated windows."""

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        order = pdf[["doc_id", "_tx"]].assign(none=pdf["doc_id"].isna()).sort_values(["none", "doc_id", "_tx"])
        new = (order[["none", "_tx"]].ne(order[["none", "_tx"]].shift()).any(axis=1) | order["doc_id"].fillna(0).ne(order["doc_id"].fillna(0).shift())).to_numpy()
        doc = np.empty(len(pdf), np.int64)
        doc[order.index.to_numpy()] = np.cumsum(new) - 1
        key = repeated_starts(list(pdf["read"]), doc, pdf["start"].to_numpy(np.int64))
        if not len(key):
            return pd.DataFrame({"doc_id": pd.array([], "Int64"), "_tx": np.empty(0, np.int64), "start": np.empty(0, np.int64), "n": np.empty(0, np.int64)})
        first = np.flatnonzero(np.diff(key, prepend=key[0] - 2) != 1)
        number, start = key[first] >> 32, key[first] & 0xFFFFFFFF
        one = np.empty(int(doc.max()) + 1, np.int64)
        one[doc] = np.arange(len(pdf))
        return pd.DataFrame({"doc_id": pdf["doc_id"].array[one[number]], "_tx": pdf["_tx"].to_numpy()[one[number]], "start": start, "n": np.diff(np.append(first, len(key)))})

    held, size = [], 0
    for pdf in batches:
        pdf = pdf.astype({"doc_id": "Int64"})
        anchor = pdf["anchor"].to_numpy()
        for lo, hi in zip(edges := [0, *(np.flatnonzero(np.diff(anchor)) + 1), len(anchor)], edges[1:], strict=False):
            if size >= BLOCK_BYTES and held[-1]["anchor"].iloc[-1] != anchor[lo]:
                yield compare(pd.concat(held, ignore_index=True))
                held, size = [], 0
            held.append(pdf.iloc[lo:hi])
            size += int(held[-1]["read"].str.len().sum())
    if held:
        yield compare(pd.concat(held, ignore_index=True))


def _window_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for at in range(0, len(pdf), 500):
            part = pdf.iloc[at : at + 500]
            rows = [(xxhash.xxh3_128_digest(read[i : i + WINDOW]), doc_id, tx, start + i) for read, doc_id, tx, start in zip(part["read"], part["doc_id"], part["_tx"], part["start"], strict=True) for i in range(len(read) - WINDOW + 1)]
            yield pd.DataFrame(rows, columns=["digest", "doc_id", "_tx", "start"]).astype({"doc_id": "Int64"})


def removed_bytes(raw: bytes, covered: np.ndarray) -> np.ndarray:
    """Which bytes are under a covered window start."""
    edge = np.zeros(len(raw) + 1, np.int32)
    starts = np.flatnonzero(covered)
    edge[starts] += 1
    edge[starts + WINDOW] -= 1
    return np.cumsum(edge[:-1]) > 0


def _finished(columns: list[str], as_text: bool):
    """The rows' ``columns``, with the digests of what is left or with the text left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pdf = batch.select(["_z", "_tx", "_anchors", "_first_tx", "_firsts", "_ranges", "_copy"]).to_pandas()
            at = 0
            for part, raws in _unpacked(pdf):
                covered: dict[int, np.ndarray] = {}  # of rows with a covered window: rises and falls at window starts
                edge_of = lambda i: covered.setdefault(i, np.zeros(len(raws[i]) + 1, np.int32))  # noqa: B023, E731
                tx = part["_tx"].to_numpy()
                firsts, first_tx = part["_firsts"].tolist(), part["_first_tx"].tolist()
                for i, lo, hi, _ in _runs_of(part, raws):
                    later = np.ones(len(lo), bool) if firsts[i] is None else ~np.isin(lo, firsts[i][first_tx[i] == tx[i]])
                    if later.any():
                        np.add.at(edge_of(i), lo[later], 1)
                        np.add.at(edge_of(i), hi[later], -1)
                for i, some in enumerate(part["_ranges"]):
                    for w in some if some is not None else ():
                        if w["_tx"] == tx[i]:
                            edge_of(i)[w["start"]] += 1
                            edge_of(i)[w["start"] + w["n"]] -= 1
                for i, copy in enumerate(part["_copy"]):
                    if copy > 1 and len(raws[i]) >= WINDOW:
                        edge_of(i)[0] += 1
                        edge_of(i)[len(raws[i]) - WINDOW + 1] -= 1
                gone = {i: removed_bytes(raws[i], np.cumsum(e[: len(raws[i]) - WINDOW + 1]) > 0) for i, e in covered.items()}
                rest = [np.frombuffer(r, np.uint8)[~gone[i]].tobytes() if i in gone else r for i, r in enumerate(raws)]
                spans = {i: int((np.diff(g.astype(np.int8), prepend=0) == 1).sum()) for i, g in gone.items()}
                same = batch.slice(at, len(raws))
                at += len(raws)
                if as_text:
                    had = same.column("_had").to_pylist()
                    # a character of which some bytes are removed is removed
                    new = {"_text": pa.array([b.decode("utf-8", "ignore") if h else None for h, b in zip(had, rest, strict=True)], pa.string())}
                else:
                    new = {
                        "n_bytes": pa.array([len(r) for r in raws], pa.int64()),
                        "n_removed": pa.array([len(r) - len(x) for r, x in zip(raws, rest, strict=True)], pa.int64()),
                        "n_spans": pa.array([spans.get(i, 0) for i in range(len(raws))], pa.int64()),
                        "kept_sha256": pa.array([hashlib.sha256(b).hexdigest() for b in rest], pa.string()),
                    }
                yield pa.RecordBatch.from_arrays([*[same.column(c) for c in columns], *new.values()], names=[*columns, *new])

    return run


def _removal_plan(rows: DataFrame, others: list[str]) -> DataFrame:
    """The packed rows with all that tells their removed bytes: _anchors (the repeated ones),
    _firsts (reads that aren't later copies), _ranges (repeated windows of these), _copy."""
    anchors = rows.where(F.octet_length("_text") >= WINDOW).select("_text", "_r1", "_r2").transform(map_batches, _anchors, "anchor long, _r1 long, _r2 int")
    twice = cut(anchors.groupBy(F.col("anchor").alias("_a")).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("_a"))
    mine = anchors.join(twice, anchors["anchor"] == twice["_a"]).groupBy("_r1", "_r2").agg(F.collect_set("anchor").alias("_anchors"))
    mine = cut(mine.select(F.col("_r1").alias("_m1"), F.col("_r2").alias("_m2"), "_anchors"))
    packed = _packed(rows, others)
    joined = lambda other, how, a="_m1", b="_m2": packed.join(other, (packed["_r1"] == other[a]) & (packed["_r2"] == other[b]), how)

    runs = joined(mine, "inner").select("doc_id", "_tx", "_z", "_anchors").transform(map_batches, _digests, "anchor long, digest binary, doc_id long, _tx long, start int, n int, before long, after long")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_tx", "start", "n", "before", "after")
    first = runs.groupBy("anchor", "digest").agg(F.min(place).alias("f"))
    first = cut(first.select("anchor", *[F.col(f"f.{c}").alias(c) for c in ("doc_id", "_tx", "start", "n", "before", "after")]))
    # which anchors with half a window's other bytes on one side belong to several reads
    sides = [("before", F.lit(0)), ("after", F.lit(1))]
    half = [first.where(f"{c} <> 0").select(F.xxhash64("anchor", c, k).alias("_half")) for c, k in sides]
    shared = cut(half[0].unionByName(half[1]).groupBy("_half").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("_half"))
    keyed = lambda df: df.withColumn("_m1", F.coalesce("doc_id", "_tx")).withColumn("_m2", F.col("_tx").bitwiseAND(F.lit(32767)).cast("int"))
    firsts = keyed(first).groupBy("_m1", "_m2").agg(F.collect_list(F.struct("_tx", "start")).alias("_firsts"))
    firsts = firsts.select("_m1", "_m2", F.col("_firsts._tx").alias("_first_tx"), F.col("_firsts.start").alias("_firsts"))

    either = F.array_compact(F.array(*[F.when(F.col(c) != 0, F.xxhash64("anchor", c, k)) for c, k in sides]))
    wanted = first.select("anchor", "doc_id", "_tx", "start", "n", F.explode(either).alias("_h"))
    wanted = wanted.join(shared, wanted["_h"] == shared["_half"]).drop("_h", "_half").distinct()
    wanted = cut(wanted)
    crowds = cut(wanted.groupBy(F.col("anchor").alias("_a")).agg(F.count(F.lit(1)).alias("_c")).where(f"_c > {ANCHOR_READS}"))
    wanted = wanted.join(crowds, wanted["anchor"] == crowds["_a"], "left").withColumn("many", F.col("_a").isNotNull())
    wanted = keyed(wanted).groupBy("_m1", "_m2").agg(F.collect_list(F.struct("_tx", "anchor", "many", "start", "n")).alias("_wanted"))
    reads = joined(wanted, "inner").select("doc_id", "_tx", "_z", "_wanted").transform(map_batches, _slices, "anchor long, many boolean, doc_id long, _tx long, start int, read binary")
    reads = cut(reads)
    blocks = reads.where("not many").repartition("anchor").sortWithinPartitions("anchor").select("anchor", "doc_id", "_tx", "start", "read")
    ranges = blocks.transform(map_batches, _compared, "doc_id long, _tx long, start int, n int")
    windows = reads.where("many").transform(map_batches, _window_digests, "digest binary, doc_id long, _tx long, start int")
    windows = windows.withColumn("_at", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_tx", "start"))
    least = cut(windows.groupBy(F.col("digest").alias("_d")).agg(F.min("_at").alias("_least"), F.count(F.lit(1)).alias("_c")).where("_c > 1").drop("_c"))
    later = windows.join(least, windows["digest"] == least["_d"]).where("_at <> _least").select("doc_id", "_tx", "start", F.lit(1).alias("n"))
    ranges = keyed(ranges.unionByName(later)).groupBy("_m1", "_m2").agg(F.collect_list(F.struct("_tx", "start", "n")).alias("_ranges"))

    side = mine.join(firsts, ["_m1", "_m2"], "left").join(ranges, ["_m1", "_m2"], "left")
    all_ = joined(side, "left").drop("_m1", "_m2")
    copies = Window.partitionBy("_r1", "_r2", "doc_id", "_tx").orderBy("_tx")
    return all_.withColumn("_copy", F.row_number().over(copies))


def repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document: each byte goes
    that is covered by a string of WINDOW bytes that also starts earlier, in a document with
    a smaller id or earlier in the same one; strings are judged on the input.

    A null text is as an empty one.  Rows without an id come last; rows of equal ids, or
    none, come in the order of a hash of their texts, and of repeated rows one comes first."""
    plan = _removal_plan(_described(docs, id_col, text_col), [])
    return plan.transform(map_arrow, _finished(["doc_id"], False), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its columns, its texts without the bytes that repeated_strings() removes.

    A character that loses some of its bytes goes as a whole; null texts stay null."""
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    extra = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"), F.col(text_col).isNotNull().alias("_had"), *[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(others)])
    rows = _referenced(extra)
    names = [f"_o{i}" for i in range(len(others))]
    plan = _removal_plan(rows, ["_had", *names])
    schema = T.StructType([rows.schema[c] for c in ["doc_id", *names]] + [T.StructField("_text", T.StringType())])
    out = plan.transform(map_arrow, _finished(["doc_id", *names], True), schema)
    back = {id_col: F.col("doc_id"), text_col: F.col("_text")} | {c: F.col(f"_o{i}") for i, c in enumerate(others)}
    return out.select(*[back[c].alias(c) for c in docs.columns])
