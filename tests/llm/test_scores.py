"""Quality and toxicity: held-out accuracy, spans, edge cases."""

import zlib

import numpy as np
import pandas as pd
import pytest

from tidemark.llm import quality, toxicity
from tidemark.llm.common import read

SF = "/root/testdata/sf0.1"


def _held_out(spark, scored, label):
    got = scored.where("held_out").join(read(spark, SF, "labels"), "doc_id").select(label, "predicted").toPandas()
    return got[label].to_numpy(), got["predicted"].to_numpy()


def test_quality_on_held_out_documents(spark):
    out = quality.score_quality(read(spark, SF, "documents"), read(spark, SF, "labels")).cache()
    y, p = _held_out(spark, out, "quality")
    assert (y == p).mean() > 0.97 and p[y == 1].mean() > 0.98 and p[y == 0].mean() < 0.1
    assert out.count() == out.select("doc_id").distinct().count() == 10_000
    assert out.where("score < 0 or score > 1 or score is null").count() == 0


def test_toxicity_on_held_out_documents(spark):
    docs = read(spark, SF, "documents")
    out = toxicity.score_toxicity(docs, read(spark, SF, "labels")).cache()
    y, p = _held_out(spark, out, "toxic")
    assert (y == p).mean() > 0.97 and p[y == 0].mean() < 0.01 and p[y == 1].mean() > 0.85
    spans = out.where("predicted = 1").join(docs, "doc_id").selectExpr("inline(toxic_spans)", "text").limit(500).collect()
    words = {r.text[r.start : r.end].lower() for r in spans}
    assert {"trash", "idiot"} & words


def test_held_out_is_crc32_of_the_id(spark, docs, labels):
    rows = quality.score_quality(docs, labels).collect()
    for r in rows:
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_edge_rows_have_scores(score, docs, empty, labels, no_labels):
    rows = score(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert sum(r.doc_id == 2**60 + 1 for r in rows) == 1  # ids stay exact beside a null
    assert score(empty, labels).count() == 0
    assert {r.score for r in score(docs, no_labels).collect()} == {0.5}


def test_keep_clean_returns_rows_as_they_are(spark, docs):
    text = "you idiot and clown"
    train = spark.createDataFrame([(i, f"{'fine words ' * 3}{i} {'idiot' if i % 2 else 'friend'} {i * 7} and you end") for i in range(400)], "doc_id long, text string")
    marks = spark.range(400).selectExpr("id AS doc_id", "cast(id % 2 as int) AS toxic")
    both = docs.unionByName(spark.createDataFrame([(77, text, "en", "a", 1, 0, "x")], docs.schema))
    sample = toxicity.labelled_sample(train, marks, "toxic", 3, 1, 500, 1000)
    model = toxicity.fit(sample)
    score, spans = toxicity.tag(["all is well", "Ünï: you IDIOT!", None], model)
    assert score[1] > 0.7 > max(score[0], score[2]) and spans[1] == [(9, 14)] and spans[0] == []
    kept = toxicity.keep_clean(both.unionByName(train.selectExpr("doc_id + 1000 AS doc_id", "text", "'e' AS lang", "'s' AS source", "1L AS n_chars", "1 AS score", "'x' AS shard")), marks.selectExpr("doc_id + 1000 AS doc_id", "toxic"))
    assert kept.columns == both.columns and toxicity.keep_clean(docs.limit(0), marks).count() == 0
    left = {r.doc_id for r in kept.collect()}
    assert 77 not in left and 8 not in left and {1, 3, 4, 2**60 + 1, None} <= left


def test_marginals_match_brute_force():
    rng = np.random.default_rng(3)
    e, move = np.exp(rng.normal(size=9)), rng.normal(size=(2, 2))
    chain = np.array([0, 0, 0, 0, 1, 2, 2, 2, 2])
    got, _, _ = toxicity.marginals(e, chain, move)
    for c in np.unique(chain):
        at = np.flatnonzero(chain == c)
        total, on = 0.0, np.zeros(len(at))
        for bits in range(1 << len(at)):
            y = [bits >> i & 1 for i in range(len(at))]
            w = np.prod([e[at[i]] ** y[i] for i in range(len(at))]) * np.exp(sum(move[a, b] for a, b in zip(y, y[1:], strict=False)))
            total += w
            on += w * np.array(y)
        assert np.allclose(got[at], on / total)


def test_no_toxic_word_matches_brute_force():
    rng = np.random.default_rng(4)
    e, move = np.exp(rng.normal(size=7)), rng.normal(size=(2, 2))
    chain, doc = np.array([0, 0, 0, 1, 1, 2, 3]), np.array([0, 0, 0, 0, 0, 1, 2])
    _, r, _ = toxicity.marginals(e, chain, move)
    got = toxicity.log_none(r, chain, doc, move, 4)
    for d in range(4):
        log = 0.0
        for c in np.unique(chain[doc == d]):
            at, total = np.flatnonzero(chain == c), 0.0
            for bits in range(1 << len(at)):
                y = [bits >> i & 1 for i in range(len(at))]
                w = np.prod([e[at[i]] ** y[i] for i in range(len(at))]) * np.exp(sum(move[a, b] for a, b in zip(y, y[1:], strict=False)))
                total += w
                none = w if bits == 0 else none
            log += np.log(none / total)
        assert got[d] == pytest.approx(log)


def test_words_never_seen_are_tagged_by_their_beginnings():
    """No list of words: planted ones are found from document labels, and held-out ones
    with the same beginning."""
    rng = np.random.default_rng(6)
    plain = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ru") for b in ("be", "do", "fi") for c in ("n", "s", "t", "l")]
    stems, ends = ("grobu", "vexat"), [f"{a}{b}" for a in "aeiou" for b in "klmnprst"]
    texts, y = [], []
    for i in range(500):
        words = rng.choice(plain, 25).tolist()
        if i % 2:
            for _ in range(rng.integers(1, 4)):
                words[rng.integers(25)] = rng.choice(stems) + rng.choice(ends[:30])
        texts.append(" ".join(words))
        y.append(i % 2)
    model = toxicity.fit(pd.DataFrame({"text": texts, "y": y, "weight": 1.0}))
    new = " ".join(plain[:10]) + f" grobu{ends[35]} " + " ".join(plain[10:20]) + f". Vexat{ends[36]}"
    score, spans = toxicity.tag([new, " ".join(plain), texts[1]], model)
    assert [new[a:b] for a, b in spans[0]] == [f"grobu{ends[35]}", f"Vexat{ends[36]}"] and spans[1] == []
    assert [texts[1][a:b] for a, b in spans[2]] == [w for w in texts[1].split() if w.startswith(stems)]
    assert score[0] > 0.7 > score[1]
