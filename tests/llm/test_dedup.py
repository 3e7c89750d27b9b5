"""The three deduplications against brute force, and their edge cases."""

import hashlib
import re
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, embedding_dedup, minhash_dedup, suffix_dedup
from tidemark.llm.common import read

SF = "/root/testdata/sf0.001"


def _shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def _near_copies(spark):
    """Chains of copies: each differs from the one before by a word or two, so that the
    ends of a chain aren't near; and groups around one original."""
    rng = np.random.default_rng(5)
    rows = []
    for g in range(12):
        words = [f"w{x}" for x in rng.integers(0, 5000, 60)]
        for k in range(9):
            rows.append(" ".join(words))
            if g % 2:
                words = list(words)
                words[int(rng.integers(0, 60))] = f"n{g}-{k}"
            else:
                edited = list(words)
                edited[int(rng.integers(0, 60))] = f"e{g}-{k}"
                rows.append(" ".join(edited))
    order = rng.permutation(len(rows))
    return spark.createDataFrame([(int(i) * 3, rows[i]) for i in order], "doc_id long, text string")


@pytest.mark.parametrize("which", ["table", "chains"])
def test_minhash_links_are_the_exact_ones(spark, which):
    docs = read(spark, SF, "documents").select("doc_id", "text") if which == "table" else _near_copies(spark)
    rows = sorted(docs.collect())
    sets = [_shingles(r.text) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    assert links
    want = [(r.doc_id, len(s), rows[c].doc_id) for r, s, c in zip(rows, sets, _components(len(rows), links), strict=True)]
    got = sorted(tuple(r) for r in minhash_dedup.link_documents(docs).drop("kept").collect())
    assert got == want


def test_minhash_cells_hold_what_shares_a_bucket(spark, monkeypatch):
    """Each text shares shingles with the next ones, below the threshold: buckets form a
    chain, of which no cell holds more than a few members."""
    words = [f"w{i}" for i in range(6000)]
    docs = spark.createDataFrame([(i, " ".join(words[i * 25 : i * 25 + 104])) for i in range(200)], "doc_id long, text string")
    dealt = []

    def spy(members, key, id_col, **more):
        dealt.extend(r["count"] for r in members.groupBy(key).count().collect())
        return common.cells(members, key, id_col, **more)

    monkeypatch.setattr(minhash_dedup, "cells", spy)
    got = minhash_dedup.link_documents(docs).collect()
    assert all(r.component_id == r.doc_id for r in got) and len(got) == 200
    assert dealt and max(dealt) < 10


def test_minhash_edges(docs, empty):
    rows = minhash_dedup.link_documents(docs).collect()
    assert len(rows) == docs.count()
    by = {(r.doc_id, r.n_shingles): r for r in rows}
    assert by[(2, 9)].component_id == 1 and not by[(2, 9)].kept  # case doesn't count
    assert by[(7, by[(6, max(n for d, n in by if d == 6))].n_shingles)].component_id == 6
    assert all(r.component_id == r.doc_id for r in rows if r.n_shingles == 0)
    assert any(r.doc_id == 2**60 + 1 and r.kept for r in rows)
    named = docs.withColumn("_dkey", F.lit("mine")).withColumn("_doc", F.lit(7)).withColumn("_hash", F.col("score"))
    kept = minhash_dedup.keep_one(named)
    assert kept.columns == named.columns and {(r._dkey, r._doc, r._hash == r.score) for r in kept.collect()} == {("mine", 7, True)}
    left = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in left if x is not None) == [1, 2, 3, 4, 5, 6, 8, 9, 2**60 + 1] and left.count(None) == 2
    assert minhash_dedup.link_documents(empty).count() == 0
    assert minhash_dedup.keep_one(empty).count() == 0


def test_odd_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    for j in (0.95, 0.8, 0.6):
        err = []
        for _ in range(30):
            a = rng.integers(0, 2**63, 1000, dtype=np.uint64)
            k = int(1000 * (1 - j) / (1 + j))
            b = np.concatenate([a[k:], rng.integers(0, 2**63, k, dtype=np.uint64)])
            x, y = (minhash_dedup.odd_sketch(minhash_dedup.samples(np.unique(s))).view(np.uint64) for s in (a, b))
            err.append(minhash_dedup.estimate(np.bitwise_count(x ^ y).sum()) - j)
        assert abs(np.mean(err)) < 0.03 and max(map(abs, err)) < minhash_dedup.MARGIN


def test_components_of_chains_and_hubs(spark):
    rng = np.random.default_rng(2)
    names = rng.permutation(3000)
    links = [(int(names[i]), int(names[i + 1])) for i in range(0, 400)] + [(int(names[500]), int(names[i])) for i in range(501, 1500)] + [(7, 7)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = _components(3000, links)
    for a, b in links[:-1]:
        assert got[a] == got[b] == want[a]
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _repeats(rows, window=100):
    """What is left of (bytes), in order, by brute force."""
    seen, out = set(), []
    for raw in rows:
        covered = np.zeros(len(raw) + 1, int)
        for i in range(len(raw) - window + 1):
            w = raw[i : i + window]
            if w in seen:
                covered[i] += 1
                covered[i + window] -= 1
            seen.add(w)
        gone = np.cumsum(covered[:-1]) > 0
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((len(raw), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def _passages(spark):
    rng = np.random.default_rng(9)
    text = lambda n: "".join(rng.choice(list("abcdefgh ij"), n))
    shared = [text(n) for n in (99, 100, 101, 150, 400)]
    rows = []
    for i in range(60):
        parts = [text(int(rng.integers(0, 90))) for _ in range(4)]
        rows.append(shared[i % 5].join(parts) + ("x" * (i * 7)) + "é" * (i % 3))
    rows += [rows[3], rows[4][10:], "ab" * 200, "b" + "ab" * 60, shared[4]]
    return spark.createDataFrame([(i * 2 + 1, r) for i, r in enumerate(rows)], "doc_id long, text string")


@pytest.mark.parametrize("crowd", [suffix_dedup.ANCHOR_READS, 3])
@pytest.mark.parametrize("which", ["table", "passages"])
def test_repeated_strings_are_the_exact_ones(spark, which, crowd, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "ANCHOR_READS", crowd)
    docs = read(spark, SF, "documents").select("doc_id", "text") if which == "table" else _passages(spark)
    rows = sorted(docs.collect())
    want = _repeats([(r.text or "").encode() for r in rows])
    got = sorted(tuple(r) for r in suffix_dedup.repeated_strings(docs).collect())
    assert [g[1:] for g in got] == want and sum(w[1] for w in want)


def test_suffix_edges(docs, empty):
    rows = suffix_dedup.repeated_strings(docs).collect()
    assert len(rows) == docs.count()
    long = {r.doc_id: r for r in rows if r.doc_id in (6, 7)}
    assert long[7].n_removed == long[7].n_bytes and long[7].kept_sha256 == hashlib.sha256(b"").hexdigest() and long[7].n_spans == 1
    left = suffix_dedup.remove_repeated(docs)
    assert left.columns == docs.columns
    by = {r.score: r for r in left.collect()}
    for i, r in enumerate(docs.collect()):
        if r.doc_id not in (6, 7):
            assert by[i] == r
    assert by[8].text == "" and suffix_dedup.repeated_strings(empty).count() == 0


def test_one_repeated_row_comes_first(spark):
    text = "abcdefghij" * 3 + "".join(chr(97 + i * i % 26) for i in range(120))
    rows = spark.createDataFrame([(None, text), (5, text), (5, text), (None, text)], "doc_id long, text string")
    removed = sorted((r.doc_id is None, r.n_removed) for r in suffix_dedup.repeated_strings(rows).collect())
    n = len(text)
    assert [r for _, r in removed].count(n) == 3 and removed[0] == (False, removed[0][1]) and removed[0][1] < n


def test_construction_is_the_sorted_suffixes():
    rng = np.random.default_rng(4)
    for _ in range(40):
        strings = [rng.integers(1, rng.choice([3, 300, 70000]), rng.integers(1, 30)) for _ in range(rng.integers(1, 12))]
        with tempfile.TemporaryDirectory() as at:
            prefix, suffix = suffix_dedup.build(np.concatenate(strings), np.array([len(s) for s in strings]), at)
        order = sorted(((*[(int(x), 0) for x in s[i:]], (0, j)), j, i) for j, s in enumerate(strings) for i in range(len(s) + 1))
        assert [(int(x) >> 8, int(x) & 255) for x in suffix] == [(j, i) for _, j, i in order]
        common_ = [0] + [next(k for k, (a, b) in enumerate(zip(x[0], y[0], strict=False)) if a != b) for x, y in zip(order, order[1:], strict=False)]
        assert prefix.tolist() == common_


def test_embeddings_link_as_brute_force_does(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(30, 24))
    vecs, labels = [], []
    for i, b in enumerate(base):
        for _ in range(8):
            vecs.append((b + rng.normal(size=24) * rng.choice([0, 0.08, 0.15])) * rng.choice([1.0, 3.0]))
            labels.append(int(i % 3) if rng.random() > 0.05 else None)
    odd = [[0.0] * 24, None, [], [float("nan")] * 24, [1.0, None] * 12, [float("inf")] * 24, [1.0, 0.0]]
    rows = [(i, [float(x) for x in v], k) for i, (v, k) in enumerate(zip(vecs, labels, strict=True))]
    rows += [(1000 + i, v, 0) for i, v in enumerate(odd)] + [(2000, rows[0][1], rows[0][2]), (0, rows[0][1], rows[0][2]), (None, rows[9][1], rows[9][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumnRenamed("label", "label")
    got = sorted(((r.vec_id is None, r.vec_id), r.n_links, r.component_id) for r in embedding_dedup.link_vectors(df).collect())
    ok = [k is not None and v is not None and len(v) == 24 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, k in rows]
    unit = [np.array(v) / np.linalg.norm(v) if o else None for (_, v, _), o in zip(rows, ok, strict=True)]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if ok[i] and ok[j] and rows[i][2] == rows[j][2] and unit[i] @ unit[j] >= 0.98]
    n = np.bincount([x for p in links for x in p], minlength=len(rows))
    root = _components(len(rows), links)
    least = {}
    for i, r in enumerate(root):
        if rows[i][0] is not None:
            least[r] = min(least.get(r, 10**9), rows[i][0])
    want = sorted(((rows[i][0] is None, rows[i][0]), int(n[i]), least.get(root[i])) for i in range(len(rows)))
    assert got == want and n.max() > 3
    assert embedding_dedup.link_vectors(df.limit(0)).count() == 0


def test_hadamard_is_orthogonal():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(embedding_dedup.hadamard(embedding_dedup.hadamard(x)), 16 * x)
