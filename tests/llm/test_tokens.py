"""Encoding against the tokenizers library, and training order by exact round trip."""

import hashlib
import os
import random
import tempfile
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import bpe, training_order
from tidemark.llm.common import read

WORD = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD)


def _odd_texts():
    rng = random.Random(1)
    out = ["", "  ", "a<|endoftext|>b", "<|startoftext|> <|ENDOFTEXT|>", "ΑΣ ΣΑΣ.Σ", "İstanbul ıI", "é ö", "it's they're WE'LL",
           "x\x1cy\x85z q　r", "½ ²³ 一二三 Ⅳ", "😀👍🏽 ok", "a" * 5000, "ab" * 300 + "'s", "'s't'rex", "́a", "Å", None,
           "\x00\x01<|endoftext|>", "İ" * 70, "don’t stop", "1234567890" * 20, "…" * 90, "\ud800 lone" if False else "plain"]
    for _ in range(400):
        pick = lambda: chr(rng.choice([rng.randint(0, 0x2FF), rng.randint(0, 0xD7FF), rng.randint(32, 126), rng.randint(0xE000, 0x1FFFF), 32]))
        out.append("".join(pick() for _ in range(rng.randint(1, 60))))
    return out


def test_ids_and_text_are_the_librarys(library):
    mine = bpe.loaded(WORD)
    texts = _odd_texts()
    for text, (raw, n, decoded) in zip(texts, mine.encode_batch(texts), strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(raw, "<u4").tolist() == ids and n == len(ids)
        assert decoded == library.decode(ids, skip_special_tokens=False) == mine.decode(ids)


def test_single_and_side_by_side_trees_agree():
    mine = bpe.loaded(WORD)
    rng = random.Random(2)
    pieces = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 64))) for _ in range(500)]
    assert mine.encode_pieces(pieces) == [mine.encode_long(p.encode()) for p in pieces]


def test_forgetting_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBER", 5)
    mine = bpe.WordBpe(WORD)
    for k in range(4):
        texts = [f"word{k} other{k} again", "the same words again"]
        for text, (raw, _, _) in zip(texts, mine.encode_batch(texts), strict=True):
            assert np.frombuffer(raw, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_documents_are_encoded_whole(spark, library, docs, empty):
    for df in (read(spark, "/root/testdata/sf0.001", "documents"), docs):
        want = sorted(
            (r.doc_id is None, r.doc_id or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
            for r in df.collect() for ids in [library.encode(r.text or "", add_special_tokens=False).ids]
        )
        got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_documents(df, WORD).collect())
        assert got == want
    assert bpe.encode_documents(empty, WORD, keep_ids=True).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 100, 4097])
def test_permutation_is_one_to_one(n):
    p = training_order.Permutation(n, "key")
    slots = p.slots(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n)) and (p.numbers(slots) == np.arange(n)).all()
    if n > 50:
        assert (slots != training_order.Permutation(n, "other").slots(np.arange(n))).any() and abs(np.corrcoef(slots, np.arange(n))[0, 1]) < 0.3


def test_order_shards_and_resumed_reads(spark, docs, empty):
    df = read(spark, "/root/testdata/sf0.001", "documents")
    out = training_order.training_order(df, RANKS, length=64, shard_slots=50).cache()
    rows = out.orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(len(rows)))
    assert all((r.shard, r.byte_offset) == (r.slot // 50, r.slot % 50 * 128) for r in rows)
    enc = training_order.encoder(RANKS)
    texts = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.part)):
        texts[r.doc_id] = texts.get(r.doc_id, []) + np.frombuffer(r.record, "<u2").tolist()[: r.n_tokens]
    assert {k: enc.decode(v) for k, v in texts.items()} == {r.doc_id: r.text for r in df.collect() if r.text}
    at = "file://" + tempfile.mkdtemp(prefix="shards-")
    made = {r.shard: r for r in training_order.write_shards(out, at).collect()}
    assert sum(r.n_records for r in made.values()) == len(rows) and len(made) == -(-len(rows) // 50)
    for first, n in ((0, 3), (48, 5), (len(rows) - 2, 10)):
        got = training_order.read_slots(at, first, n, 64, 50)
        assert [x.tobytes() for x in got] == [r.record for r in rows[first : first + n]]
    again = training_order.write_shards(out, at, done=set(made) - {1}).collect()
    assert [(r.shard, r.sha256) for r in again] == [(1, made[1].sha256)]
    assert training_order.training_order(empty, RANKS).count() == 0
    parts = training_order.training_order(docs, RANKS).collect()
    assert {r.doc_id for r in parts} >= {1, 2, 6, 7, None, 2**60 + 1} and 3 not in {r.doc_id for r in parts}


def test_the_query_writes_its_shards(spark, docs, empty, monkeypatch):
    from tidemark.llm.common import shared_dir
    from tidemark.llm.queries import LLM_QUERIES

    folders = lambda: set(Path(shared_dir(spark).removeprefix("file:")).glob("shards-*"))
    had = folders()
    rows = LLM_QUERIES["op5_training_order"](spark, "/root/testdata/sf0.001").collect()
    (made,) = folders() - had
    assert rows == training_order.training_order(read(spark, "/root/testdata/sf0.001", "documents"), RANKS).collect()
    assert [r.slot for r in rows] == list(range(len(rows)))
    assert [p.name for p in sorted(made.glob("*.bin"))] == ["shard-00000000.bin"]
    assert (made / "shard-00000000.bin").read_bytes() == b"".join(r.record for r in rows)
    monkeypatch.setattr(training_order, "WAVE_SHARDS", 2)  # several waves, of several shards
    df = read(spark, "/root/testdata/sf0.001", "documents")
    at = "file://" + tempfile.mkdtemp(prefix="shards-")
    want = training_order.training_order(df, RANKS, length=64, shard_slots=50).collect()
    got = training_order.materialise(df, RANKS, at, length=64, shard_slots=50)
    assert got.collect() == want and [x.tobytes() for x in training_order.read_slots(at, 0, len(want), 64, 50)] == [r.record for r in want]
    (Path(at.removeprefix("file://")) / "shard-00000002.bin").write_bytes(bytes(50 * 128))
    assert sum(not any(r.record) for r in got.collect()) == 50  # what is returned is what the files hold
    order = lambda rows: sorted(rows, key=str)
    assert order(training_order.materialise(docs, RANKS).collect()) == order(training_order.training_order(docs, RANKS).collect())
    assert training_order.materialise(empty, RANKS).count() == 0


def test_shards_need_whole_partitions(spark):
    out = training_order.training_order(read(spark, "/root/testdata/sf0.001", "documents"), RANKS, length=64, shard_slots=50)
    with pytest.raises(Exception, match="whole shards in slot order"):
        training_order.write_shards(out.where("slot <> 60"), "file://" + tempfile.mkdtemp(prefix="shards-")).collect()


def test_slots_follow_from_corpus_and_key(spark, docs):
    """Not from partitions; and a restart keeps the shards that are finished."""
    df = docs.select("doc_id", "text").unionByName(read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text"))
    df = df.unionByName(df.where("doc_id = 1"))
    places = lambda rows: sorted((r.slot, r.doc_id or -1, r.part, bytes(r.record)) for r in rows)
    want, *others = [places(training_order.training_order(df.repartition(n), RANKS, length=64, shard_slots=50).collect()) for n in (2, 3, 211)]
    assert all(x == want for x in others)
    assert want != places(training_order.training_order(df, RANKS, key="other", length=64, shard_slots=50).collect())
    at = Path(tempfile.mkdtemp(prefix="shards-"))
    run = lambda frame, **more: training_order.materialise(frame, RANKS, f"file://{at}", length=64, shard_slots=50, **more)
    assert places(run(df.repartition(5)).collect()) == want
    (at / "shard-00000001.bin").unlink()
    (at / "shard-00000002.bin").write_bytes(b"kept")
    first = {p.name: p.stat().st_mtime_ns for p in at.glob("shard-*.bin")}
    run(df.repartition(9))
    assert {p.name: p.stat().st_mtime_ns for p in at.glob("shard-*.bin") if p.name != "shard-00000001.bin"} == first
    assert (at / "shard-00000001.bin").stat().st_size == 50 * 128
    for other in ({"key": "other"},), ({},):
        with pytest.raises(ValueError, match="another order"):
            run(df.limit(3) if not other[0] else df, **other[0])
