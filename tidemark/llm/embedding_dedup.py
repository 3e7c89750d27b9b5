"""Embedding near-duplicates by cross-polytope hashing.

Each distinct vector is rotated by three rounds of random signs and a fast Hadamard
transform; the nearest signed axis is its hash, some hashes are a bucket of a table, and
with runners-up in their place they are further buckets that it probes.  Pairs that meet in a bucket of their
label are verified by their cosine in double precision, each in the first table and bucket
where it meets.  Links are counted and merged into components; pairs aren't listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cells, components, cut, map_batches

#: Hashes per bucket: so many that unrelated vectors seldom share one (up to about 10^6
#: vectors a label at 64 dimensions; one more for each factor of a hundred beyond).
TABLES, HASHES, PROBES = 10, 3, 5


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row (a power of two wide), in log2 steps."""
    n, width, h = x.shape[0], x.shape[1], 1
    while h < width:
        y = x.reshape(n, width // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, width)
        h *= 2
    return x


def buckets(x: np.ndarray, tables: int = TABLES, probes: int = PROBES, hashes: int = HASHES, seed: int = 17) -> np.ndarray:
    """(rows, tables, 1 + probes) bucket numbers of unit vectors: the own bucket, then the
    probed ones, in which some of the hashes are runners-up, in order of what they lose."""
    n, d = x.shape
    width = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :d] = x
    out = np.empty((n, tables, 1 + probes), np.int64)
    rng = np.random.default_rng([seed, width])
    rows = np.arange(n)
    swaps = np.array([[s >> i & 1 for i in range(hashes)] for s in range(1 << hashes)])
    for t in range(tables):
        axes, loss = np.empty((n, hashes, 2), np.int64), np.empty((n, hashes))
        for i in range(hashes):
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], width)) / np.sqrt(width)
            size = np.abs(y)
            a = size.argmax(1)
            top = size[rows, a].copy()
            size[rows, a] = -1
            b = size.argmax(1)
            axes[:, i, 0], axes[:, i, 1] = 2 * a + (y[rows, a] < 0), 2 * b + (y[rows, b] < 0)
            loss[:, i] = top - size[rows, b]
        order = np.argsort(loss @ swaps.T, axis=1, kind="stable")[:, : 1 + probes]
        number = np.zeros((n, 1 + probes), np.int64)
        for i in range(hashes):
            number = number * (2 * width) + axes[rows[:, None], i, swaps[order, i]]
        out[:, t] = number
    return out


def _first_meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of pairs of rows of bucket numbers: bucket * 64 + table where they first meet,
    one of the two at home; -1 where they never do."""
    out = np.full(len(a), -1, np.int64)
    for t in range(a.shape[1]):
        none = np.iinfo(np.int64).max
        at = np.where((b[:, t] == a[:, t, :1]).any(1), a[:, t, 0], none)
        at = np.minimum(at, np.where((a[:, t] == b[:, t, :1]).any(1), b[:, t, 0], none))
        out = np.where((out == -1) & (at < none), at * 64 + t, out)
    return out


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position that each of n positions reaches over the links a - b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def link_vectors(vectors: DataFrame, least: float = 0.98, tables: int = TABLES, probes: int = PROBES, hashes: int = HASHES, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Only vectors of one label and length link.  Vectors that are null, empty or zero, that
    hold null or non-finite components, or whose label is null have no links and are their
    own component.  Equal vectors are compared as one and link to each other; a row without
    an id counts as a link of others, and its own component is the smallest id it reaches
    (null: none).  Repeated ids are rows of their own."""
    vec = F.col(vec_col).cast("array<double>")
    ok = F.col(label_col).isNotNull() & F.expr(f"coalesce(size(`{vec_col}`) > 0 and forall(`{vec_col}`, x -> x is not null and not isnan(x) and abs(x) <> double('inf')) and exists(`{vec_col}`, x -> x <> 0), false)")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("_label"), F.when(ok, vec).alias("_vec"))
    # two hashes of 64 bits stand for label and vector where rows are joined
    rows = rows.withColumn("_k1", F.when(F.col("_vec").isNotNull(), F.xxhash64("_label", "_vec"))).withColumn("_k2", F.xxhash64(F.lit("b"), "_vec", "_label"))
    distinct = rows.where("_k1 is not null").groupBy("_k1", "_k2", "_label", "_vec").agg(F.count(F.lit(1)).alias("_copies"), F.min("vec_id").alias("_least"))
    distinct = cut(distinct.withColumn("rid", F.monotonically_increasing_id()))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for d, part in pdf.groupby(pdf["_vec"].str.len(), sort=False):
                x = np.stack(part["_vec"].to_numpy())
                x = x / np.abs(x).max(1, keepdims=True)  # no overflow or underflow in the squares
                x /= np.sqrt((x * x).sum(1, keepdims=True))
                found = buckets(x, tables, probes, hashes)
                yield pd.DataFrame({"rid": part["rid"].to_numpy(), "_label": part["_label"].astype(str).to_numpy(), "_d": d, "_unit": list(x), "_copies": part["_copies"].to_numpy(), "_at": list(found.reshape(len(x), -1))})

    unit = cut(distinct.select("rid", "_label", "_vec", "_copies").transform(map_batches, hashed, "rid long, _label string, _d int, _unit array<double>, _copies long, _at array<long>"))
    # a member of its own buckets and of the ones it probes, by table
    where = F.expr(f"explode(transform(_at, (b, i) -> named_struct('t', i div {1 + probes}, 'b', b, 'own', i % {1 + probes} = 0)))")
    members = unit.select("rid", "_label", "_d", where.alias("_w")).select("rid", F.xxhash64("_label", "_d", "_w.t", "_w.b").alias("_bucket"), (F.col("_w.b") * 64 + F.col("_w.t")).alias("_place"), F.col("_w.own").alias("_at_home"))
    homes = members.groupBy(F.col("_bucket").alias("_hb")).agg(F.max("_at_home").alias("_any"), F.count(F.lit(1)).alias("_n")).where("_any and _n > 1").select("_hb")
    homes = cut(homes)
    members = cut(members.join(homes, members["_bucket"] == homes["_hb"]).drop("_hb", "_at_home"))
    dealt = cells(members, "_bucket", "rid")
    full = dealt.join(unit.select(F.col("rid").alias("_r"), "_unit", "_copies", "_at"), dealt["rid"] == F.col("_r")).drop("_r", "_bucket")
    width = tables * (1 + probes)

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        """Links of whole cells: (rid, links gained, a rid that it is linked with)."""
        x = np.stack(pdf["_unit"].to_numpy())
        at = np.stack(pdf["_at"].to_numpy()).reshape(-1, tables, width // tables)
        rid, copies, block, place = (pdf[c].to_numpy() for c in ("rid", "_copies", "_block", "_place"))
        cell, own = pdf["_cell"].to_numpy(), pdf["_own"].to_numpy()
        ia, ib = [], []
        start = np.flatnonzero(np.diff(cell, prepend=cell[0] - 1))
        for lo, hi in zip(start, [*start[1:], len(cell)], strict=True):
            if own[lo]:
                a, b = np.nonzero(np.triu(x[lo:hi] @ x[lo:hi].T >= least - 1e-9, 1))
                ia.append(a + lo)
                ib.append(b + lo)
            else:
                left, right = lo + np.flatnonzero(block[lo:hi] == 0), lo + np.flatnonzero(block[lo:hi] == 1)
                a, b = np.nonzero(x[left] @ x[right].T >= least - 1e-9)
                ia.append(left[a])
                ib.append(right[b])
        a, b = np.concatenate(ia), np.concatenate(ib)
        sure = np.einsum("ij,ij->i", x[a], x[b]) >= least
        a, b = a[sure], b[sure]
        here = _first_meeting(at[a], at[b]) == place[a]
        a, b = a[here], b[here]
        gained = np.bincount(a, weights=copies[b], minlength=len(rid)) + np.bincount(b, weights=copies[a], minlength=len(rid))
        root = _roots(len(rid), a, b)
        some = np.flatnonzero(gained)
        return pd.DataFrame({"rid": rid[some], "links": gained[some].astype(np.int64), "other": rid[root[some]]})

    def by_cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Whole cells at a time: a cell, bounded in size, may go over the end of a batch."""
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            last = pdf["_cell"].iloc[-1]
            done = (pdf["_cell"] != last).to_numpy()
            rest = pdf[~done].reset_index(drop=True)
            if done.any():
                yield verify(pdf[done].reset_index(drop=True))
        if rest is not None and len(rest):
            yield verify(rest)

    links = cut(full.repartition("_cell").sortWithinPartitions("_cell").transform(map_batches, by_cell, "rid long, links long, other long"))
    gained = links.groupBy("rid").agg(F.sum("links").alias("_gained"))
    roots = components(links.select(F.col("rid").alias("a"), F.col("other").alias("b")))
    known = distinct.select("rid", "_k1", "_k2", "_copies", "_least")
    known = known.join(gained, "rid", "left").join(roots.select(F.col("node").alias("rid"), F.col("root")), "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    known = cut(known)
    least_id = cut(known.groupBy(F.col("root").alias("_root")).agg(F.min("_least").alias("_component")))
    known = known.join(least_id, known["root"] == least_id["_root"])
    known = cut(known.select(F.col("_k1").alias("_j1"), F.col("_k2").alias("_j2"), (F.col("_copies") - 1 + F.coalesce("_gained", F.lit(0))).alias("_links"), "_component"))
    out = rows.drop("_vec", "_label").join(known, (F.col("_k1") == F.col("_j1")) & (F.col("_k2") == F.col("_j2")), "left")
    return out.select(
        "vec_id",
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("_j1").isNotNull(), F.col("_component")).otherwise(F.col("vec_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


#: DuckDB SQL for link_vectors() with its defaults over embeddings.
LINK_SQL = """
with recursive v as (
    select vec_id, label, embedding::double[] as e from embeddings
    where label is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
), l as materialized (
    select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
    where list_cosine_similarity(a.e, b.e) >= 0.98
), reach(vec_id, other) as (
    select vec_id, vec_id from embeddings
    union
    select r.vec_id, l.b from reach r join l on r.other = l.a
), c as (
    select vec_id, min(other) as component_id from reach group by vec_id
)
select c.vec_id, (select count(*) from l where l.a = c.vec_id)::bigint as n_links, c.component_id, c.vec_id = c.component_id as kept
from c
"""
