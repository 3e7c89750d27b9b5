"""Repeated runs of words: automata, and whole results against plain Python."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import substring_dedup as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows, window):
    """(doc_id, n_words, n_removed, sha256) by the documented order of rows."""
    key = lambda r: (r[0] is None, r[0] or 0, hashlib.md5(f"{'' if r[0] is None else r[0]}|{r[1] or ''}".encode()).digest())
    seen, done = set(), {}
    for r in sorted(set(rows), key=key):
        words = WORD.findall(r[1] or "")
        hit = [False] * len(words)
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            if w in seen:
                hit[i : i + window] = [True] * window
            seen.add(w)
        kept = " ".join(w for w, x in zip(words, hit, strict=True) if not x)
        done[r] = (r[0], len(words), sum(hit), hashlib.sha256(kept.encode()).hexdigest())
    return sorted((done[r] for r in rows), key=str)


def corpus(seed, n=60):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(6)] + ["É", "日本", "A", "a"]
    make = lambda k: rng.choice(vocabulary, k).tolist()
    common = [make(int(rng.integers(5, 60))) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = [common[rng.integers(5)] if rng.random() < 0.5 else make(int(rng.integers(0, 30))) for _ in range(rng.integers(0, 5))]
        text = (" " if rng.random() < 0.5 else "\t\n").join(w for p in parts for w in p)
        rows.append((int(rng.integers(0, n)) if rng.random() < 0.9 else None, text))
    return rows + rows[:3] + [(3, None), (None, None), (4, "a " * 70), (5, "a " * 90), (6, ""), (7, " \t ")]


def result(df, window):
    got = S.strip_repeated(df, window)
    rows = got.collect()
    for r in rows:
        assert r["n_removed"] == sum(s["end"] - s["start"] for s in r["removed"])
        assert hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"]
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows), key=str)


@pytest.mark.parametrize("case", ["plain", "small_shards", "crowds"])
def test_equals_plain_python(spark, monkeypatch, case):
    if case != "plain":
        monkeypatch.setattr(S, "SHARD_WORDS", 50)
        monkeypatch.setattr(S, "KNOWN_WORDS", 4)
        monkeypatch.setattr(S, "KNOWN_READS", 3)
        monkeypatch.setattr(S, "PIECE_BYTES", 200)
    if case == "crowds":
        monkeypatch.setattr(S, "CROWD", 1)
    window = {"plain": 20, "small_shards": 7, "crowds": 4}[case]
    rows = corpus(len(case))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("place", F.lit("x")).withColumn("base", F.lit(1))
    assert result(df.repartition(7), window) == expected(rows, window)


def test_edge_rows(spark, docs, empty):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert result(docs, 20) == expected(rows, 20)
    assert S.strip_repeated(empty).collect() == []


def test_automaton_matches(spark):
    rng = np.random.default_rng(5)
    for _ in range(30):
        strings = [rng.choice(list("abc"), rng.integers(1, 25)).tolist() for _ in range(8)]
        automaton, place, began = S.Automaton(), 0, []
        for s in strings:
            firsts = automaton.add(s, place, 4)
            began.append((place, s))
            for j, end in enumerate(firsts):
                assert end - 3 == min(p + i for p, t in began for i in range(len(t) - 3) if t[i : i + 4] == s[j : j + 4])
            place += 100
        probe = rng.choice(list("abcd"), 40).tolist()
        held = {tuple(s[i:j]) for s in strings for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        for i, (n, _) in enumerate(automaton.matching(probe)):
            assert n == max(k for k in range(i + 2) if k == 0 or tuple(probe[i + 1 - k : i + 1]) in held)


def test_known_passages_go(spark, docs, empty):
    passage = " ".join(f"p{i}" for i in range(30))
    reference = spark.createDataFrame([(passage,), (None,), ("",)], "text string")
    rows = [(1, f"start {passage} end"), (2, " ".join(passage.split()[:19])), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_removed", F.lit("old"))
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in S.strip_known(df, reference).collect()}
    assert got == {1: ("start end", 30), 2: (rows[1][1], 0), 3: (None, 0), 4: ("", 0)}
    assert S.strip_known(empty, reference).collect() == []
    assert S.strip_known(df, reference.limit(0)).count() == 4
    with pytest.raises(ValueError):
        S.reference_automata(reference, most_words=10)
