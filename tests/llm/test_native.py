"""Mixing, sharding and fingerprints: built-in functions only, checked against SQL or
brute force."""

import hashlib

import duckdb
import pytest
import xxhash
from oracle_harness import compare
from pyspark.sql import functions as F

from tidemark.llm import fingerprints, mixing, sharding
from tidemark.llm.common import read

SF = "/root/testdata/sf0.001"


def test_no_python_in_the_plans(spark, docs):
    for df in (mixing.mix(docs), fingerprints.fingerprint_edits(docs), sharding.shard_documents(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_mix_draws_the_target_rates(spark):
    docs = spark.range(40_000).selectExpr("id AS doc_id", "repeat('x', 100) AS text", "CASE WHEN id % 8 = 0 THEN 'rare' WHEN id % 8 = 1 THEN NULL ELSE 'big' END AS source")
    out = mixing.mix(docs, {"rare": 3, "big": 1, None: 0}).cache()
    got = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert got.keys() == {"rare", "big"}
    assert abs(got["rare"] / 30_000 - 1) < 0.03 and abs(got["big"] / 10_000 - 1) < 0.05
    counts = out.where("source = 'rare'").groupBy("doc_id").count()
    mean, var = counts.agg(F.sum("count") / 5000, F.sum(F.col("count") ** 2) / 5000).first()
    assert abs(var - mean**2 - mean) < 0.4  # as a Poisson distribution's
    again = mixing.mix(docs, {"rare": 3, "big": 1, None: 0})
    assert again.exceptAll(out).count() == 0
    keys = [r.shuffle_key for r in out.select("shuffle_key").collect()]
    assert keys == sorted(keys)


def test_mix_of_a_large_rate(spark):
    docs = spark.createDataFrame([(i, "z" * (1 if i == 0 else 1000), "tiny" if i == 0 else "big") for i in range(50)], "doc_id long, text string, source string")
    n = mixing.mix(docs, {"tiny": 1, "big": 99}, seed="s").where("source = 'tiny'").count()
    assert 400 < n < 620  # mean 490 copies of the one byte


@pytest.mark.parametrize("most_broadcast", [10_000, 0])
def test_mix_equals_its_sql_with_repeated_rows(spark, docs, tmp_path, monkeypatch, most_broadcast):
    monkeypatch.setattr(mixing, "MOST_BROADCAST", most_broadcast)
    some = docs.select("doc_id", "text", "lang", "source", "n_chars")
    some.unionByName(some).unionByName(some.where("source = 'a'")).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    ok, msg = compare(mixing.mix(spark.read.parquet(str(tmp_path / "documents.parquet"))), con, mixing.MIX_SQL)
    assert ok, msg


def test_mix_edges(docs, empty):
    out = mixing.mix(docs.withColumn("rate", F.lit(1)).withColumn("parts", F.lit("p")))
    assert set(docs.columns) < set(out.columns) and "parts" in out.columns
    assert mixing.mix(empty).count() == 0
    ids = [r.doc_id for r in mixing.mix(docs, budget_bytes=10**7).select("doc_id").distinct().collect()]
    assert 6 in ids and 2**60 + 1 in ids


def test_shards_are_even_and_keep_groups(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    out = sharding.shard_documents(docs).toPandas()
    per = out.groupby("shard")["size"].sum()
    assert len(per) == 8 and per.max() - per.min() <= out["size"].max()
    for _, s in out.groupby("shard"):
        assert sorted(s["slot"]) == list(range(len(s)))
    linked = out[out["group_rows"] > 1].groupby(["text_crc32", "size"])["shard"].nunique()
    assert len(linked) > 20 and (linked == 1).mean() > 0.9
    assert set(out["law"]) == {"bytes"} and out["grown_shard"].isna().all()


def test_a_third_of_all_rows_as_one_group(spark):
    rows = spark.range(6000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN repeat('copy ', 20) ELSE concat('own ', id, repeat('y', 90)) END AS text")
    out = sharding.shard_documents(rows).toPandas()
    per = out.groupby("shard")["size"].sum()
    assert per.max() / per.min() < 1.01
    hot = out[out["group_rows"] > 1].groupby("shard").size()
    assert 3 <= (hot > 20).sum() <= 5  # as few shards as the quotas allow, or nearly


def test_sharding_edges(docs, empty):
    rows = sharding.shard_documents(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r.shard < 8 for r in rows)
    null = next(r for r in rows if r.doc_id == 3)
    assert (null.size, null.text_crc32, null.group_rows) == (1, 0, 1)
    assert sharding.shard_documents(empty).count() == 0


def _sketch(text, k):
    import struct

    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    signed = lambda h: h - 2**64 if h >= 2**63 else h
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]

    def chain(xs):
        seed = 42
        for x in xs:
            seed = xxhash.xxh64_intdigest(struct.pack("<Q", x), seed)
        return signed(seed)

    if not h:
        return []
    hashes = {chain(h)} if len(h) < 5 else {chain(h[i : i + 5]) for i in range(len(h) - 4)}
    return sorted(hashes)[:k]


def test_fingerprints_against_brute_force(spark):
    docs = read(spark, SF, "documents").select("doc_id", "text")
    rows = sorted(docs.collect(), reverse=True)
    k = fingerprints.K
    hex_ = lambda s: "".join(f"{x & (2**64 - 1):016X}" for x in s)
    near = lambda a, b: 1.0 if not a and not b else len((m := set(sorted({*a, *b})[:k])) & {*a} & {*b}) / len(m)
    got = {r.doc_id: r for r in fingerprints.fingerprint_edits(docs).collect()}
    assert len(got) == len(rows)
    for i, r in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)].text
        e = len(r.text) // 3
        edited = r.text[: len(r.text) - e] + nxt[:e]
        a, b, c = _sketch(r.text, k), _sketch(edited, k), _sketch(nxt, k)
        g = got[r.doc_id]
        assert (g.n_chars, g.edited_sha256) == (len(r.text), hashlib.sha256(edited.encode()).hexdigest())
        assert (g.fingerprint, g.edited_fingerprint) == (hex_(a), hex_(b))
        assert g.near_edited == pytest.approx(near(a, b)) and g.near_next == pytest.approx(near(a, c))


def test_sketches_merge_and_estimate(spark):
    df = spark.range(3000).selectExpr("id", "concat('w', id, ' ', 'v', id + 1) AS t", "id % 2 AS half")
    whole = df.selectExpr("1 AS g", "half", "t").groupBy("g", "half").agg(F.array_join(F.collect_list("t"), " ").alias("t"))
    a = fingerprints.with_sketch(whole, "t", "s").select("g", "half", "s")
    merged = fingerprints.merge_all(a, ["g"], "s").first()["s"]
    both = [r.s for r in a.collect()]
    assert merged == sorted({*both[0], *both[1]})[: fingerprints.K]
    one = a.where("half = 0").select(F.col("s").alias("x")).crossJoin(a.where("half = 1").select(F.col("s").alias("y")))
    n, r, c = one.select(fingerprints.n_distinct(F.col("x")), fingerprints.resemblance(F.col("x"), F.col("x")), fingerprints.containment(F.col("x"), fingerprints.merge(F.col("x"), F.col("y")))).first()
    assert 2200 < n < 3900 and r == 1.0 and c > 0.75


def test_fingerprint_edges(docs, empty):
    rows = fingerprints.fingerprint_edits(docs).collect()
    assert len(rows) == docs.count()
    same = [r for r in rows if r.doc_id in (6, 7)]
    assert same[0].fingerprint == same[1].fingerprint
    none = [r for r in rows if r.n_chars == 0]
    assert len(none) == 3 and all(r.fingerprint == "" for r in none)
    assert fingerprints.fingerprint_edits(empty).count() == 0
    one = fingerprints.fingerprint_edits(docs.where("doc_id = 8")).first()
    assert one.near_next == 1.0  # the only document is its own next


@pytest.mark.parametrize("hot", [None, 500, 0, 2**63 - 1])
def test_fingerprint_buckets_split_equal_ids(spark, hot):
    rows = [(hot if i % 3 == 0 else i % 900, f"text {i} " * (i % 7)) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_tie", F.xxhash64("text"))
    sizes = [r["count"] for r in fingerprints._order_buckets(docs.where("text <> ''"), "doc_id", "_tie").groupBy("_b").count().collect()]
    assert max(sizes) < 0.1 * sum(sizes)
    order = sorted(docs.collect(), key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r._tie))
    want = []
    for r, after in zip(order, [*order[1:], order[0]], strict=True):
        e = len(r.text) // 3
        want.append((str(r.doc_id), hashlib.sha256((r.text[: len(r.text) - e] + after.text[:e]).encode()).hexdigest()))
    got = [(str(r.doc_id), r.edited_sha256) for r in fingerprints.fingerprint_edits(docs.drop("_tie")).collect()]
    assert sorted(got) == sorted(want)
