"""Source divergence audit: the skyband, and whole results against plain Python."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import source_audit as A

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def expected(rows, least, top):
    rows = [tuple(x or "" for x in r) for r in rows]  # text, lang, source
    terms = [(t.translate(str.maketrans(A.UPPER, A.LOWER)), lang, s) for t, lang, s in rows]
    out = []
    for lang in {r[1] for r in rows}:
        sources = {r[2] for r in rows if r[1] == lang}
        counts = {s: Counter() for s in sources}
        held = Counter()
        for t, la, s in terms:
            if la == lang:
                found = TERM.findall(t)
                counts[s].update(found)
                held.update(set(found))
        kept = [t for t in held if held[t] >= least]
        total = Counter({t: sum(c[t] for c in counts.values()) for t in kept})
        p = lambda c: {t: 1 + A.SCALE * (c[t] + A.PRIOR) // (sum(c[x] for x in kept) + A.PRIOR * len(kept)) for t in kept}
        q, ps = p(total), {s: p(c) for s, c in counts.items()}
        for s in sources:
            pairs = sorted((-sum(abs(ps[s][t] - ps[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            out += [(lang, s, "pair", o.decode(), -v, i + 1) for i, (v, o) in enumerate(pairs)]
            above = sorted((q[t] - ps[s][t], t.encode()) for t in kept if counts[s][t] and ps[s][t] > q[t])
            out += [(lang, s, "term", t.decode(), -v, i + 1) for i, (v, t) in enumerate(above[:top])]
    return sorted(out)


def test_skyband_is_all_terms_with_fewer_dominators():
    rng = np.random.default_rng(1)
    for size, k in ((0, 3), (1, 1), (200, 1), (200, 7)):
        n, lang = rng.integers(1, 12, size), rng.integers(1, 12, size)
        item = [f"é{x}" if x % 3 else f"w{x}" for x in rng.permutation(size)]
        by = [sum(n[j] >= n[i] and lang[j] <= lang[i] and item[j].encode() < item[i].encode() for j in range(size)) for i in range(size)]
        assert sorted(A.skyband(n, lang, item, k)) == [i for i in range(size) if by[i] < k]


@pytest.mark.parametrize("small_parts", [False, True])
def test_audit_equals_plain_python(spark, docs, monkeypatch, small_parts):
    if small_parts:  # many blocks of terms, many parts and merge rounds
        for name, value in (("BLOCK_TERMS", 16), ("BLOCK_CELLS", 16), ("PART_TERMS", 2), ("FAN_IN", 2), ("TASK_TERMS", 3)):
            monkeypatch.setattr(A, name, value)
    rng = np.random.default_rng(2)
    words = [f"w{chr(97 + i)}" for i in range(26)] + ["É", "é", "WA", "日本"]
    rows = [(" ".join(rng.choice(words, rng.integers(0, 30))), f"l{i % 2}", f"s{i % 5 if i % 3 else 0}") for i in range(120)]
    rows += [r[1:4] for r in [tuple(x) for x in docs.select("doc_id", "text", "lang", "source").collect()]] + rows[:3] + [(None, None, None), ("", "l9", "only")]
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("item", F.lit(1)).withColumn("value", F.lit("x")).withColumn("n", F.lit(2))
    got = sorted(tuple(r) for r in A.audit_sources(df, least_docs=3, top=6).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == expected(rows, 3, 6)


def test_empty_table(spark, empty):
    assert A.audit_sources(empty).collect() == []
