"""Repeated runs of words, found by matching texts against suffix automata.

A window is a number of consecutive words of one document; a word goes if a window over it
also starts earlier in the corpus.  A suffix automaton of the earlier texts answers that for
any length: read word by word, its state is the longest suffix that occurred (the matching
statistic), and each state knows where its strings ended first.

No automaton of a whole corpus fits one task.  So texts are cut into reads: the windows of
a document that share an anchor, the smallest hash of five words in the window.  Equal
windows have equal anchors, so that the reads of an anchor are all that a window has to be
matched with, and anchors are dealt to reference shards of bounded size.  Reads that share
no half of a window, which has the anchor in it, with another can't hold repeated windows
and aren't dealt.  In a shard, reads are streamed in the order of their first places
against the automaton of those before them, which then takes them up; equal reads are
streamed once, and all their places are compared with the first ones that it gave.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain
from math import ceil

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, dropped, let_workers_import, map_batches, ordered_offsets, shuffles_go
from tidemark.llm.shingles import mixed

WORDS = 20
#: Words of a reference shard, on average; different reads of one anchor beyond which its
#: windows are dealt one by one.
SHARD_WORDS, CROWD = 120_000, 2048
#: Words that a task's hash table holds, and reads whose places it remembers.
KNOWN_WORDS, KNOWN_READS = 200_000, 200_000
#: Texts are read in pieces of about this many bytes (whole documents) to bound memory.
PIECE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_FORTH, _BACK = [np.ones(1, np.uint64)], [np.ones(1, np.uint64)]


class Automaton:
    """A suffix automaton over several strings of words, with the place where each state's
    strings ended first.  Strings must be added in the order of their places."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.size, self.end = [-1], [0], [-1]

    def _split(self, p: int, word, q: int) -> int:
        """The state of p's longest string and ``word``, cut out of q, whose strings include longer ones."""
        nexts, link = self.next, self.link
        clone = len(nexts)
        nexts.append(nexts[q].copy())
        link.append(link[q])
        self.size.append(self.size[p] + 1)
        self.end.append(self.end[q])
        link[q] = clone
        while p >= 0 and nexts[p].get(word) == q:
            nexts[p][word] = clone
            p = link[p]
        return clone

    def add(self, words: list, place: int, window: int) -> list[int]:
        """Takes up ``words``, which begin at ``place``, and returns for each window of it
        where it ended first: before this string, or in it."""
        nexts, link, size, end = self.next, self.link, self.size, self.end
        last, out = 0, []
        for i, word in enumerate(words):
            q = nexts[last].get(word)
            if q is not None:
                last = q if size[q] == i + 1 else self._split(last, word, q)
            else:
                new, p = len(nexts), last
                nexts.append({})
                size.append(i + 1)
                end.append(place + i)
                link.append(0)
                while p >= 0 and (q := nexts[p].get(word)) is None:
                    nexts[p][word] = new
                    p = link[p]
                if p >= 0:
                    link[new] = q if size[q] == size[p] + 1 else self._split(p, word, q)
                last = new
            if i >= window - 1:
                v = last
                while size[link[v]] >= window:
                    v = link[v]
                out.append(end[v])
        return out

    def matching(self, words: list) -> list[tuple[int, int]]:
        """For each word the longest suffix up to it that the strings hold, as its number
        of words, and the state that it leads to."""
        state, n, out = 0, 0, []
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                n = self.size[state]
            if word in self.next[state]:
                state, n = self.next[state][word], n + 1
            else:
                n = 0
            out.append((n, state))
        return out


def covered(n_words: int, spans) -> np.ndarray:
    """Which words the [start, end) spans cover."""
    step = np.zeros(n_words + 1, np.int64)
    for a, b in spans:
        step[a] += 1
        step[b] -= 1
    return np.cumsum(step[:-1]) > 0


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_FORTH[0]) < n:
        size = max(n, 1 << 16)
        _FORTH[0] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, _BASE, np.uint64))])
        _BACK[0] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, pow(_BASE, -1, 2**64), np.uint64))])
    return _FORTH[0], _BACK[0]


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = h
        return h


class Reads:
    """The reads of several texts (as lists of words), one after another."""

    def __init__(self, texts: list[list[bytes]], window: int, known: _Hashes):
        k = max(1, window // 4)
        span = window - k + 1
        half = span // 2
        self.begin = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        n = int(self.begin[-1])
        h = np.fromiter(map(known.__getitem__, chain.from_iterable(texts)), np.uint64, n)
        forth, back = _powers(n + 1)
        with np.errstate(over="ignore"):
            total = np.concatenate([[np.uint64(0)], np.cumsum(h * forth[:n])])
        self._total, self._back = total, back
        doc = np.repeat(np.arange(len(texts)), np.diff(self.begin))
        starts = np.flatnonzero(doc[: n - window + 1] == doc[window - 1 :]) if n >= window else np.empty(0, np.int64)
        none = np.empty(0, np.int64)
        self.doc, self.anchor, self.start, self.end, self.gram = none, none, none, none, none
        self.left, self.right = none, none  # hashes of the halves, 0: none
        if not len(starts):
            return
        value = self.hashes(np.arange(n - k + 1), k)
        at, width = np.arange(len(value)), 1
        while width < span:  # the leftmost of the smallest
            step = min(width, span - width)
            less = value[step:] < value[:-step]
            at = np.where(less, at[step:], at[:-step])
            value = np.where(less, value[step:], value[:-step])
            width += step
        mine = at[starts]
        fresh = (np.diff(mine, prepend=-1) != 0) | (np.diff(starts, prepend=-2) != 1)
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(starts)) - 1
        self.start, final, self.anchor = starts[first], starts[last], mine[first]
        self.end, self.doc, self.gram = final + window, doc[starts[first]], value[starts[first]]
        longest = n - window + half + 1  # of these, halves end within the texts
        has = self.start <= self.anchor - half
        self.left = np.where(has, self.hashes(np.where(has, self.anchor - half, 0), half + k) | np.uint64(1), np.uint64(0))
        has = final > self.anchor - half
        self.right = np.where(has, self.hashes(np.where(has, np.minimum(self.anchor, longest), 0), window - half + 1) & ~np.uint64(1) | np.uint64(2), np.uint64(0))

    def hashes(self, at: np.ndarray, size) -> np.ndarray:
        """Of the words from ``at`` on."""
        with np.errstate(over="ignore"):
            return mixed((self._total[at + size] - self._total[at]) * self._back[at])

    def digests(self) -> np.ndarray:
        return self.hashes(self.start, self.end - self.start)


def _split_words(text) -> list[bytes]:
    """Runs of anything but ASCII white space, which is what bytes.split() takes for it."""
    return text.encode("utf-8", "replace").split() if isinstance(text, str) else []


def _pieces(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    size = pdf["_text"].str.len().fillna(0).cumsum().to_numpy() // PIECE_BYTES
    bounds = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), len(pdf)]
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        if hi > lo:
            yield pdf.iloc[lo:hi]


def _halves(window: int):
    """(_row, at, key) for the halves of all reads; ``at`` is the anchor's word in its document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Hashes()
        for pdf in batches:
            for part in _pieces(pdf):
                reads = Reads([_split_words(t) for t in part["_text"]], window, known)
                row, at = part["_row"].to_numpy()[reads.doc], (reads.anchor - reads.begin[reads.doc]).astype(np.int32)
                for key in (reads.left, reads.right):
                    some = key != 0
                    yield pd.DataFrame({"_row": row[some], "at": at[some], "key": key[some].view(np.int64)})

    return run


def _wanted(window: int):
    """(gram, digest, place, base, n, body) for the reads at the anchors in ``_at``; the
    body only where the task has seen no earlier place of an equal read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, seen = _Hashes(), {}
        for pdf in batches:
            for part in _pieces(pdf):
                texts = [_split_words(t) for t in part["_text"]]
                reads = Reads(texts, window, known)
                at = np.concatenate([b + np.asarray(a, np.int64) for b, a in zip(reads.begin, part["_at"], strict=False)])
                pick = np.isin(reads.anchor, at)
                doc, gram, digest = reads.doc[pick], reads.gram[pick].view(np.int64), reads.digests()[pick].view(np.int64)
                begin = reads.start[pick] - reads.begin[doc]
                n, base = reads.end[pick] - reads.start[pick], part["_base"].to_numpy()[doc]
                place, body = base + begin, []
                for d, b, m, key, here in zip(doc.tolist(), begin.tolist(), n.tolist(), digest.tolist(), place.tolist(), strict=True):
                    if seen.get(key, here + 1) > here:
                        if len(seen) >= KNOWN_READS:
                            seen.clear()
                        seen[key] = here
                        body.append(b" ".join(texts[d][b : b + m]))
                    else:
                        body.append(None)
                yield pd.DataFrame({"gram": gram, "digest": digest, "place": place, "base": base, "n": n.astype(np.int32), "body": body})

    return run


def _streamed(window: int):
    """Of a shard's reads (gram, digest, place: the first, body): runs of windows from
    ``low`` to ``high`` (in the read) and where the first of them began first."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, automaton, out = pdf.sort_values("place", kind="stable"), Automaton(), []
        for gram, digest, place, body in zip(pdf["gram"], pdf["digest"], pdf["place"].tolist(), pdf["body"], strict=True):
            low, begun = 0, -2
            firsts = automaton.add(body.split(), place, window)
            for j, e in enumerate(firsts):
                if e - (window - 1) - j != begun:
                    if j:
                        out.append((gram, digest, low, j - 1, begun + low))
                    low, begun = j, e - (window - 1) - j
            out.append((gram, digest, low, len(firsts) - 1, begun + low))
        return pd.DataFrame(out, columns=["gram", "digest", "low", "high", "first"])

    return run


_RUNS = "gram long, digest long, low int, high int, first long"


def _matched(reads: DataFrame, window: int) -> DataFrame:
    """Runs of the windows of different reads, by shards; ``reads``: gram, digest, place, n, body."""
    words = reads.agg(F.sum("n").alias("n")).first()["n"] or 0
    shards = ceil(words / SHARD_WORDS) or 1
    dealt = reads.select(F.expr(f"pmod(xxhash64(gram), {shards})").alias("_shard"), "gram", "digest", "place", "body")
    return dealt.groupBy("_shard").applyInPandas(_streamed(window), _RUNS)


def _crowded(reads: DataFrame, window: int) -> DataFrame:
    """The same for reads of anchors that have many different ones: each window is a read of
    its own, equal ones once, so that shards stay bounded; ``reads`` must be materialised."""
    parts = reads.withColumn("_w", F.expr("split(cast(body as string), ' ')"))
    each = parts.select("gram", "digest", "place", F.expr(f"posexplode(transform(sequence(0, size(_w) - {window}), i -> array_join(slice(_w, i + 1, {window}), ' ')))").alias("low", "_one"))
    each = each.select("gram", "digest", "low", (F.col("place") + F.col("low")).alias("place"), "_one", F.xxhash64("_one").alias("_k1"), F.xxhash64(F.lit("2"), "_one").alias("_k2"))
    each = cut(each)
    first = each.groupBy("_k1", "_k2").agg(F.min("place").alias("place"), F.any_value("_one").alias("_one"))
    found = _matched(cut(first.select(F.col("_k1").alias("gram"), F.col("_k2").alias("digest"), "place", F.lit(window).alias("n"), F.col("_one").cast("binary").alias("body"))), window)
    found = cut(found.select(F.col("gram").alias("_j1"), F.col("digest").alias("_j2"), "first"))
    return each.join(found, (F.col("_k1") == F.col("_j1")) & (F.col("_k2") == F.col("_j2"))).select("gram", "digest", "low", F.col("low").alias("high"), "first")


def repeated_spans(docs: DataFrame, window: int = WORDS) -> DataFrame:
    """(_dkey, _spans): for documents (_dkey, _id, _text) with repeated windows, the words
    [start, end) that these cover, as they were found."""
    spark = docs.sparkSession
    rows = docs.withColumn("_row", F.xxhash64("_dkey"))
    with shuffles_go(spark):
        sizes = rows.groupBy("_dkey").agg(F.min("_id").alias("_id"), F.max(F.coalesce(F.octet_length("_text"), F.lit(0)).cast("long") + 1).alias("_size"))
        sizes = sizes.withColumn("_none", F.col("_id").isNull()).withColumn("_id", F.coalesce("_id", F.lit(0)))
        bases = ordered_offsets(sizes, ["_none", "_id", "_dkey"], "_size", "_base").select("_dkey", F.xxhash64("_dkey").alias("_r"), "_base")
        bases = cut(bases)

        halves = cut(rows.select("_row", "_text").transform(map_batches, _halves(window), "_row long, at int, key long"))
        shared = cut(halves.groupBy(F.col("key").alias("_k")).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("_k"))
        wanted = halves.join(shared, halves["key"] == shared["_k"]).groupBy("_row").agg(F.collect_set("at").alias("_at"))  # at most a document's anchors
        wanted = cut(wanted.join(bases, wanted["_row"] == bases["_r"]).select(F.col("_dkey").alias("_d"), "_base", "_at"))
        dropped(halves), dropped(shared)

        some = rows.select("_dkey", "_text").join(wanted, rows["_dkey"] == wanted["_d"]).select("_text", "_base", "_at")
        reads = cut(some.transform(map_batches, _wanted(window), "gram long, digest long, place long, base long, n int, body binary"))
        firsts = reads.groupBy("gram", "digest").agg(F.min("place").alias("_f"), F.max("n").alias("n"))
        firsts = firsts.select(F.col("gram").alias("_g"), F.col("digest").alias("_h"), "_f", "n")
        bodies = reads.where("body is not null").select("gram", "digest", "place", "body")
        same = (F.col("gram") == F.col("_g")) & (F.col("digest") == F.col("_h")) & (F.col("place") == F.col("_f"))
        one = cut(bodies.join(firsts, same).select("gram", "digest", "place", "n", "body").dropDuplicates(["gram", "digest"]))  # repeated rows have equal places

        crowds = cut(one.groupBy(F.col("gram").alias("_g")).agg(F.count(F.lit(1)).alias("c")).where(f"c > {CROWD}").select("_g"))
        if crowds.isEmpty():
            runs = cut(_matched(one, window))
        else:
            usual = _matched(cut(one.join(crowds, one["gram"] == crowds["_g"], "left_anti")), window)
            runs = cut(usual.unionByName(_crowded(cut(one.join(crowds, one["gram"] == crowds["_g"], "left_semi")), window)))
        dropped(one)

        runs = runs.select(F.col("gram").alias("_g"), F.col("digest").alias("_h"), "low", "high", "first")
        later = reads.select("gram", "digest", "place", "base").join(runs, (F.col("gram") == F.col("_g")) & (F.col("digest") == F.col("_h"))).where("first < place + low")
        span = F.struct((F.col("place") + F.col("low") - F.col("base")).cast("int").alias("start"), (F.col("place") + F.col("high") - F.col("base") + window).cast("int").alias("end"))
        spans = later.groupBy("base").agg(F.collect_set(span).alias("_spans"))  # at most a document's windows
        spans = cut(spans.join(bases, spans["base"] == bases["_base"]).select("_dkey", "_spans"))
        dropped(reads)
    return spans


def strip_repeated(docs: DataFrame, window: int = WORDS, texts: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, and with ``texts``
    kept_text (the words that stay, joined by a space) and removed (the spans of words
    [start, end) that go).

    Documents are in the order of their ids, rows without an id last; rows of equal ids
    (or none) are different documents in the order of a hash of their texts, and repeated
    rows (equal id and text) are one document, of which each row gets the result.  A null
    text has no words; texts with fewer words than a window lose none."""
    let_workers_import(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    rows = rows.withColumn("_dkey", F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.col("_id").cast("string"), F.lit("")), F.coalesce("_text", F.lit(""))).cast("binary"))))
    spans = repeated_spans(rows, window).withColumnRenamed("_dkey", "_d")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in _pieces(pdf):
                out = []
                for text, gone in zip(part["_text"], part["_spans"], strict=True):
                    words = _split_words(text)
                    hit = covered(len(words), [(s["start"], s["end"]) for s in gone] if gone is not None else [])
                    kept = b" ".join(w for w, x in zip(words, hit.tolist(), strict=True) if not x)
                    row = [len(words), int(hit.sum()), hashlib.sha256(kept).hexdigest()]
                    if texts:
                        edge = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0)).tolist()
                        row += [kept.decode("utf-8"), [{"start": a, "end": b} for a, b in zip(edge[::2], edge[1::2], strict=True)]]
                    out.append(row)
                yield pd.DataFrame(out, columns=columns).assign(doc_id=part["_id"].array)[["doc_id", *columns]]

    columns = ["n_words", "n_removed", "kept_sha256"] + (["kept_text", "removed"] if texts else [])
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string, removed array<struct<start: int, end: int>>" if texts else "")
    both = rows.join(spans, rows["_dkey"] == spans["_d"], "left").select("_id", "_text", "_spans")
    return both.transform(map_batches, run, schema)


def reference_automata(reference: DataFrame, text_col: str = "text", most_words: int = 2_000_000) -> list[Automaton]:
    """Automata of a reference's shards (texts in the order of their hashes), for a
    broadcast: of at most ``most_words`` words, beyond which this raises an error."""
    words = F.size(F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    n = reference.agg(F.sum(words).alias("n")).first()["n"] or 0
    if n > most_words:
        raise ValueError(f"a reference of {n} words is too large to broadcast; strip_repeated() deals it to shards")
    texts, shards, size = [r[0] for r in reference.select(text_col).distinct().orderBy(F.xxhash64(text_col)).collect()], [], SHARD_WORDS
    for text in texts:
        if size >= SHARD_WORDS:
            shards.append(Automaton())
            size = 0
        part = _split_words(text)
        shards[-1].add(part, 0, len(part) + 1)
        size += len(part)
    return shards


def strip_known(docs: DataFrame, reference: DataFrame, window: int = WORDS, text_col: str = "text", reference_col: str = "text") -> DataFrame:
    """All columns of ``docs``, the text without the runs of ``window`` words or more that
    a text of ``reference`` holds (words then joined by a space; a text that loses none, and
    a null one, stays as it is), and n_removed, which replaces a column of that name."""
    let_workers_import(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(reference_automata(reference, reference_col))

    @F.pandas_udf("text string, n_removed long")
    def strip(column: pd.Series) -> pd.DataFrame:
        out = []
        for text in column:
            words = _split_words(text)
            hit = np.zeros(len(words), bool)
            if len(words) >= window:
                for automaton in sent.value:
                    hit |= covered(len(words), [(i + 1 - n, i + 1) for i, (n, _) in enumerate(automaton.matching(words)) if n >= window])
            n = int(hit.sum())
            out.append((b" ".join(w for w, x in zip(words, hit, strict=True) if not x).decode("utf-8") if n else text, n))
        return pd.DataFrame(out, columns=["text", "n_removed"])

    done = docs.drop("n_removed").withColumn("_done", strip(F.col(text_col).cast("string")))
    return done.withColumn(text_col, F.col("_done.text")).withColumn("n_removed", F.col("_done.n_removed")).drop("_done")
