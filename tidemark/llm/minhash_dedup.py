"""Near-duplicate documents by MinHash bands and odd sketches, confirmed on full sets.

Every text's set of word shingles gets MinHash samples, whose bands name buckets, and an
odd sketch: a bitmap in which each sample flips the bit that it hashes to.  The population
count of two sketches' XOR estimates how many samples differ, precisely so for similar
sets; pairs that meet in a bucket and pass that test are confirmed on their full sets.

Documents with equal sets are compared as one.  In each bucket the members are first
paired with its smallest one.  The members of a bucket that are in different components even
after that are dealt to cells in which every two of them meet, with their texts: there pairs
of different components are tested, from the likeliest on, unless a link has joined the two
by then.  Of buckets with the same members one is dealt, and a pair is tested in the first
bucket that it shares.
So no link that could join two components goes untested, and pairs are never listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cells, components, cut, map_batches
from tidemark.llm.shingles import mixed, shingle_set

#: 32 bands of 4 samples meet at similarity 0.75 but for 5 in a million.
BANDS, ROWS = 32, 4
SKETCH_WORDS = 8
#: A pair is confirmed if its estimate is up to this much below the threshold: more than
#: four standard deviations of samples and sketch together.
MARGIN = 0.2

_rng = np.random.default_rng(20240229)
_ODD = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def samples(shingles: np.ndarray) -> np.ndarray:
    """MinHash samples of a set that isn't empty."""
    out = np.full(len(_ODD), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 2048):  # bounds memory
            out = np.minimum(out, (shingles[at : at + 2048, None] * _ODD + _ADD).min(0))
    return out


def odd_sketch(sample: np.ndarray) -> np.ndarray:
    """The bitmap of a set's samples, as signed 64-bit words."""
    bits = SKETCH_WORDS * 64
    with np.errstate(over="ignore"):
        at = (mixed(sample + np.arange(len(sample), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(at, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8")


def estimate(differing_bits: np.ndarray) -> np.ndarray:
    """Similarity from the population count of two sketches' XOR: of the 2 k (1 - J) sample
    values that only one side has, each flips a bit."""
    bits, k = SKETCH_WORDS * 64, len(_ODD)
    odd = np.minimum(2 * differing_bits / bits, 1 - 1e-9)
    return 1 + bits / 2 * np.log1p(-odd) / (2 * k)


def most_bits(similarity: float) -> int:
    """The largest population count whose estimate is ``similarity`` or more."""
    return int(np.flatnonzero(estimate(np.arange(SKETCH_WORDS * 64 // 2)) >= similarity).max())


def _band_keys(sample: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for col in sample.reshape(BANDS, ROWS).T:
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + col)
    return key.view(np.int64)


def _described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """n_shingles, two hashes that stand for the set, band keys and sketch of each text."""
    for pdf in batches:
        n, s1, s2, bands, sketch = [], [], [], [], []
        for text in pdf["_text"]:
            s = shingle_set(text if isinstance(text, str) else None)
            n.append(len(s))
            if not len(s):
                s1.append(0), s2.append(0), bands.append(None), sketch.append(None)
                continue
            with np.errstate(over="ignore"):
                s1.append(int(mixed(s + np.uint64(11)).sum().view(np.int64)))
                s2.append(int(np.bitwise_xor.reduce(mixed(s + np.uint64(29))).view(np.int64)))
            k = samples(s)
            bands.append(_band_keys(k))
            sketch.append(odd_sketch(k))
        yield pd.DataFrame({"doc_id": pdf["doc_id"].array, "_dkey": pdf["_dkey"].to_numpy(), "n_shingles": n, "_s1": s1, "_s2": s2, "_bands": bands, "_sketch": sketch}).astype({"doc_id": "Int64"})


_DESCRIBED = "doc_id long, _dkey binary, n_shingles long, _s1 long, _s2 long, _bands array<long>, _sketch array<long>"


def _confirm(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 500):  # bounds the sets that are held
                part, sets, sure = pdf.iloc[at : at + 500], {}, []
                for side in ("a", "b"):
                    for rid, text in zip(part[side], part[f"_text_{side}"], strict=True):
                        if rid not in sets:
                            sets[rid] = shingle_set(text)
                for a, b in zip(part["a"], part["b"], strict=True):
                    both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                    sure.append(100 * both >= percent * (len(sets[a]) + len(sets[b]) - both))
                yield part.loc[np.array(sure, bool), ["a", "b"]]

    return run


def _apart(pdf: pd.DataFrame, least: float, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each cell of the frame: pairs (as positions) of members of different components
    whose sizes and sketches allow the similarity, and their sketches' distance."""
    root, n, block = (pdf[c].to_numpy() for c in ("_root", "_n_shingles", "_block"))
    sketch = np.stack(pdf["_sketch"].to_numpy()).view(np.uint64)
    own, cell = pdf["_own"].to_numpy(), pdf["_cell"].to_numpy()
    start = np.flatnonzero(np.diff(cell, prepend=cell[0] - 1))
    for lo, hi in zip(start, [*start[1:], len(cell)], strict=True):
        if (root[lo:hi] == root[lo]).all():
            continue
        left = np.arange(lo, hi) if own[lo] else lo + np.flatnonzero(block[lo:hi] == 0)
        right = np.arange(lo, hi) if own[lo] else lo + np.flatnonzero(block[lo:hi] == 1)
        found = []
        for k in range(0, len(left), 64):  # bounds memory
            rows = left[k : k + 64]
            small, large = np.minimum(n[rows][:, None], n[right]), np.maximum(n[rows][:, None], n[right])
            a, b = np.nonzero((root[rows][:, None] != root[right]) & (small >= least * large))
            a, b = rows[a], right[b]
            if own[lo]:
                a, b = a[a < b], b[a < b]
            differ = np.bitwise_count(sketch[a] ^ sketch[b]).sum(1)
            ok = differ <= bits
            found.append((a[ok], b[ok], differ[ok]))
        yield tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _by_cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole cells at a time: a cell, bounded in size, may go over the end of a batch."""
    rest = None
    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        done = (pdf["_cell"] != pdf["_cell"].iloc[-1]).to_numpy()
        rest = pdf[~done].reset_index(drop=True)
        if done.any():
            yield pdf[done].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest


def _joining(least: float, bits: int, percent: int):
    """Links that join components of a cell, tested on full sets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _by_cell(batches):
            rid, texts, out = pdf["rid"].to_numpy(), pdf["_text"].tolist(), []
            bucket, buckets = pdf["_bucket"].to_numpy(), pdf["_buckets"].tolist()
            for a, b, differ in _apart(pdf, least, bits):
                up: dict = {r: r for r in pdf["_root"].to_numpy()[np.r_[a, b]].tolist()}
                root = pdf["_root"].to_numpy()

                def find(x, up=up):
                    while up[x] != x:
                        up[x] = up[up[x]]
                        x = up[x]
                    return x

                sets: dict[int, frozenset] = {}
                own: dict[int, frozenset] = {}
                for i in np.argsort(differ, kind="stable").tolist():
                    x, y = int(a[i]), int(b[i])
                    p, q = find(int(root[x])), find(int(root[y]))
                    if p == q:
                        continue
                    for m in (x, y):
                        if m not in own:
                            own[m] = frozenset(buckets[m])
                    if min(own[x] & own[y]) != bucket[x]:
                        continue  # the pair meets in that bucket's cell, too
                    for m in (x, y):
                        if m not in sets:
                            sets[m] = frozenset(shingle_set(texts[m]).tolist())
                    both = len(sets[x] & sets[y])
                    if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                        up[max(p, q)] = min(p, q)
                        out.append((max(rid[x], rid[y]), min(rid[x], rid[y])))
            yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


def _key(id_col: str, text_col: str):
    """What tells rows apart that differ in id or text."""
    return F.unhex(F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("binary")))


def _rooted(docs: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, _dkey, n_shingles of every row; _root, a number that rows of one component
    share (null without shingles); component_id, the smallest id of the component."""
    least, bits = percent / 100, most_bits(percent / 100 - MARGIN)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    texts = texts.withColumn("_dkey", _key("doc_id", "_text"))
    rows = cut(texts.transform(map_batches, _described, _DESCRIBED))

    sets = (
        rows.where("n_shingles > 0")
        .groupBy("n_shingles", "_s1", "_s2")
        .agg(F.min("doc_id").alias("_least"), F.min_by("_dkey", F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)), "_dkey")).alias("_dkey"))
        .withColumnRenamed("n_shingles", "_n_shingles")
    )
    sets = cut(sets.withColumn("rid", F.monotonically_increasing_id()))
    mine = rows.select(F.col("_dkey").alias("_d"), "_bands", "_sketch").dropDuplicates(["_d"])
    reps = cut(sets.join(mine, sets["_dkey"] == mine["_d"]).drop("_d"))
    member = reps.select("rid", F.posexplode("_bands").alias("_p", "_bucket")).drop("_p")
    hubs = cut(member.groupBy(F.col("_bucket").alias("_hb")).agg(F.min("rid").alias("_hub"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    member = cut(member.join(hubs, member["_bucket"] == hubs["_hb"]).drop("_hb"))

    # the texts that may be compared, once each
    some = cut(member.select("rid").distinct().join(reps.select("rid", "_dkey", "_n_shingles", "_sketch"), "rid"))
    wanted = some.select("rid", F.col("_dkey").alias("_d"))
    found = texts.select("_dkey", "_text").join(wanted, texts["_dkey"] == wanted["_d"]).select("rid", "_text").dropDuplicates(["rid"])
    found = cut(found)
    light = some.select("rid", "_n_shingles", "_sketch")

    def confirmed(pairs: DataFrame) -> DataFrame:
        left, right = (found.select(F.col("rid").alias(x), F.col("_text").alias(f"_text_{x}")) for x in "ab")
        return cut(pairs.join(left, "a").join(right, "b").select("a", "b", "_text_a", "_text_b").transform(map_batches, _confirm(percent), "a long, b long"))

    star = member.where("rid <> _hub").select(F.col("rid").alias("a"), F.col("_hub").alias("b")).distinct()
    for x in "ab":
        star = star.join(light.select(F.col("rid").alias(x), F.col("_n_shingles").alias(f"_n{x}"), F.col("_sketch").alias(f"_k{x}")), x)
    differ = " + ".join(f"bit_count(_ka[{i}] ^ _kb[{i}])" for i in range(SKETCH_WORDS))
    tested = cut(star.where(f"100 * least(_na, _nb) >= {percent} * greatest(_na, _nb) and {differ} <= {bits}").select("a", "b"))
    links = confirmed(tested)

    roots = cut(components(links).select(F.col("node").alias("_node"), F.col("root").alias("_to")))
    rooted = cut(light.join(roots, light["rid"] == roots["_node"], "left").select("rid", "_n_shingles", "_sketch", F.coalesce("_to", "rid").alias("_root")))
    placed = member.join(rooted.select("rid", "_root"), "rid")
    same = [F.bit_xor(F.xxhash64("rid", F.lit(k))).alias(f"_s{k}") for k in range(2)]
    apart = placed.groupBy("_bucket").agg(F.min("_root").alias("_lo"), F.max("_root").alias("_hi"), F.count(F.lit(1)).alias("_n"), *same).where("_lo <> _hi")
    apart = cut(apart.groupBy("_n", "_s0", "_s1").agg(F.min("_bucket").alias("_mb")).select("_mb"))
    # a bucket's smallest member has met all others
    placed = cut(placed.join(apart, placed["_bucket"] == apart["_mb"]).where("rid <> _hub").select("rid", "_bucket"))
    mine = placed.groupBy("rid").agg(F.collect_list("_bucket").alias("_buckets"))  # BANDS at most
    mine = cut(rooted.join(mine, "rid"))
    dealt = cells(placed, "_bucket", "rid", per_block=512).join(mine, "rid").join(found, "rid")
    dealt = dealt.repartition("_cell").sortWithinPartitions("_cell")
    links = cut(links.unionByName(dealt.transform(map_batches, _joining(least, bits, percent), "a long, b long")))

    roots = cut(components(links).select(F.col("node").alias("_node"), F.col("root").alias("_to")))
    known = sets.join(roots, sets["rid"] == roots["_node"], "left").withColumn("_root", F.coalesce("_to", "rid"))
    known = cut(known.select(F.col("_n_shingles").alias("_j0"), F.col("_s1").alias("_j1"), F.col("_s2").alias("_j2"), "_root", "_least"))
    low = cut(known.groupBy(F.col("_root").alias("_r")).agg(F.min("_least").alias("component_id")))
    known = cut(known.join(low, known["_root"] == low["_r"]).select("_j0", "_j1", "_j2", "_root", "component_id"))
    out = rows.select("doc_id", "_dkey", "n_shingles", "_s1", "_s2").join(known, (F.col("n_shingles") == F.col("_j0")) & (F.col("_s1") == F.col("_j1")) & (F.col("_s2") == F.col("_j2")), "left")
    return out.select("doc_id", "_dkey", "n_shingles", "_root", F.when(F.col("_j0").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def link_documents(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Null texts, and texts without words, have no shingles, link with nothing, and are their
    own component.  Repeated ids are rows of their own.  A row without an id can link
    others; its component is the smallest id that it reaches (null: none), and it isn't
    kept."""
    out = _rooted(docs, percent, id_col, text_col).drop("_dkey", "_root")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, of which one of each component stays: the one with
    the smallest id, then (equal ids, or none) with the smallest hash.  Of rows with equal
    id and text the one with the smallest hash of all columns (but maps) is taken, before
    any shuffle.  Rows without words all stay."""
    rows = cut(_rooted(docs, percent, id_col, text_col).where("_root is not null").select("doc_id", "_dkey", "_root"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_dkey")).alias("f")
    stay = cut(rows.groupBy("_root").agg(first).select(F.col("f._dkey").alias("_stay")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    words = F.coalesce(F.col(text_col).cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = docs.select(F.struct(*columns).alias("_doc"), _key(id_col, text_col).alias("_dkey"), F.xxhash64(*plain).alias("_hash"), words.alias("_words"))
    once = keyed.where("_words").groupBy("_dkey").agg(F.min_by("_doc", "_hash").alias("_doc"))
    kept = once.join(stay, once["_dkey"] == stay["_stay"], "left_semi").select("_doc")
    return kept.unionByName(keyed.where("not _words").select("_doc")).select("_doc.*")
