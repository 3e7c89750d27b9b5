"""The corpus pipeline, stage by stage, on planted documents."""

import hashlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tidemark.llm.common import read

SF = "/root/testdata/sf0.01"


def test_all_queries_are_registered():
    names = set(__spark_entry__.queries())
    assert {"pipeline"} | {f"op{n}" for n in range(1, 14)} == {"pipeline"} | {n.split("_")[0] for n in names if n.startswith("op")} and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= names


def test_stages_take_effect(spark):
    docs = read(spark, SF, "documents")
    rng = np.random.default_rng(1)
    words = lambda n: " ".join("q" + "".join(rng.choice(list("bcdfgklm"), 6)) for _ in range(n))
    original, passage = words(80), words(60)
    edited = original.split()
    edited[40] = "changed"
    planted = [(10**6, original), (10**6 + 1, original), (10**6 + 2, " ".join(edited)), (10**6 + 3, words(50) + " idiot trash moron " + words(50)),
               (10**6 + 4, words(40) + " " + passage), (10**6 + 5, words(40) + " " + passage + " " + words(10)), (10**6 + 6, words(30))]
    schema = docs.schema
    docs = docs.unionByName(spark.createDataFrame([(i, t, "en", "planted", len(t)) for i, t in planted], schema))
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == schema.names, name
        left = {r.doc_id: r for r in docs.where("source = 'planted'").collect()}
        if name == "drop_toxic":
            assert set(left) == {10**6 + i for i in (0, 1, 2, 4, 5, 6)}
        else:
            assert set(left) == {10**6 + i for i in (0, 4, 5, 6)}
    assert passage in left[10**6 + 4].text and passage not in left[10**6 + 5].text
    assert left[10**6 + 6].text == planted[6][1] and all(r.n_chars == len(r.text) for r in left.values())
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, SF).cache()
    assert mixed.columns == schema.names and mixed.count() > 0
    out = corpus_pipeline.STAGES[4][1](spark, mixed, SF)
    assert out.count() == mixed.count()
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in out.join(mixed.dropDuplicates(["doc_id"]), "doc_id").orderBy(F.rand(1)).limit(30).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == lib.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(r.ids).hexdigest()


def test_edge_tables_run_through(spark, docs, empty, labels, tmp_path):
    """Null texts and ids, texts without words, repeated rows, further columns; and nothing at all."""
    for name, table in (("odd", docs), ("none", empty)):
        at = tmp_path / name
        table.write.parquet(str(at / "documents.parquet"))
        labels.write.parquet(str(at / "labels.parquet"))
        out = corpus_pipeline.run(spark, str(at)).collect()
        assert bool(out) == (name == "odd")
        if out:
            assert {1, None} <= {r.doc_id for r in out} and all(r.n_tokens == len(r.ids) // 4 for r in out)
