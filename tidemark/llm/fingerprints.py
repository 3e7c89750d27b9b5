"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the sorted array of the k smallest distinct 64-bit hashes of a text's
shingles (five words; fewer words: the whole sequence; no words: an empty sketch).
Sketches of parts merge into that of the union, and estimate resemblance, containment
and the number of distinct shingles.  Built-in functions only.
"""

from __future__ import annotations

from collections import Counter
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 128
WORDS = 5
#: Distinct values of the order column per bucket, and the most buckets.
BUCKET_ROWS, FAN = 64, 64
#: Bits of a bucket's number that are a share of the tie hashes.
SHARES = 13


def with_sketch(df: DataFrame, text: str, out: str, k: int = K, words: int = WORDS) -> DataFrame:
    """Adds the sketch of ``text`` (null: as empty).  Words are lower-cased runs of
    anything but ASCII white space.  The steps are columns of their own, so that the word
    hashes are made once and not for each shingle."""
    five = ", ".join(f"_h[i + {j}]" for j in range(words))
    return (
        df.withColumn("_h", F.expr(f"transform(filter(split(lower(coalesce(`{text}`, '')), '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> ''), w -> xxhash64(w))"))
        .withColumn(
            out,
            F.expr(
                f"""slice(sort_array(array_distinct(case
                    when size(_h) = 0 then cast(array() as array<bigint>)
                    when size(_h) < {words} then array(xxhash64(_h))
                    else transform(sequence(0, size(_h) - {words}), i -> xxhash64({five})) end)), 1, {k})"""
            ),
        )
        .drop("_h")
    )


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two sketched sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_all(df: DataFrame, by: list[str], sketch: str, k: int = K, salts: int = 64) -> DataFrame:
    """One merged sketch per group.  Each distinct hash is kept once a group; then each of
    ``salts`` shares of a group is cut to its k smallest, and these to the k smallest, so
    that no task ranks all of a hot group's hashes.  Groups without hashes have no row."""
    rest = df.select(*by, F.explode(sketch).alias("_v")).distinct().withColumn("_salt", F.pmod("_v", F.lit(salts)))
    for part in (["_salt"], []):
        w = Window.partitionBy(*by, *part).orderBy("_v")
        rest = rest.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")
    return rest.groupBy(*by).agg(F.sort_array(F.collect_list("_v")).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated |A & B| / |A | B|; of two empty sets 1, of one empty set 0."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def n_distinct(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact while the sketch isn't full."""
    kth = (F.element_at(a, k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / kth)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated |A & B| / |A|; 1 for an empty A."""
    est = resemblance(a, b, k) * n_distinct(merge(a, b, k), k) / n_distinct(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), est))


def digest(a: Column) -> Column:
    """The sketch as text: its hashes in hex, in ascending order."""
    return F.array_join(F.transform(a, lambda v: F.lpad(F.hex(v), 16, "0")), "")


def _order_buckets(docs: DataFrame, order: str, tie: str) -> DataFrame:
    """``docs`` with ``_b``, a bucket that grows as ``order`` falls, dealt by approximate
    quantiles.  A value that several quantiles fall on has buckets of its own, as many as
    quantiles at least, dealt by the tie hash's first bits; so have rows without ``order``,
    which come last.  ``_by_tie``: whether the row's bucket is of that kind."""
    n = docs.select(order).count()
    side = max(2, min(FAN, ceil((n / BUCKET_ROWS) ** 0.5)))
    found = docs.agg(F.percentile_approx(order, [i / side**2 for i in range(1, side**2)], 100_000).alias("q"), F.count(order).alias("n")).first()
    bits = {c: times.bit_length() for c, times in Counter(found["q"] or []).items() if times > 1}
    cuts = sorted({*(found["q"] or []), *(c + 1 for c in bits if c < 2**63 - 1)})
    outer, inner = cuts[side - 1 :: side], [cuts[i : i + side - 1] for i in range(0, len(cuts) + 1, side)]
    longs = lambda xs: "array(" + ", ".join(f"{x}L" for x in xs) + ")" if xs else "cast(array() as array<bigint>)"
    nested = "array(" + ", ".join(longs(x) for x in inner) + ")"
    df = docs.withColumn("_c", F.expr(f"size(filter({longs(outer)}, c -> c <= `{order}`))"))
    rank = f"_c * {side} + size(filter(element_at({nested}, _c + 1), c -> c <= `{order}`))"
    df = df.withColumn("_b", F.expr(f"case when `{order}` is null then {len(cuts) + 1} else {len(cuts)} - ({rank}) end"))
    none = max(6, ((n - found["n"]) * side**2 // max(1, n)).bit_length())
    many = F.element_at(F.create_map(*[F.lit(x) for pair in bits.items() for x in pair]), F.col(order)) if bits else F.lit(0)
    df = df.withColumn("_bits", F.when(F.col(order).isNull(), none).otherwise(F.coalesce(many, F.lit(0))))
    share = f"case when _bits = 0 then 0 else cast(shiftright(`{tie}`, 64 - _bits) as int) + shiftleft(1, _bits - 1) end"
    return df.withColumn("_b", F.expr(f"_b * {1 << SHARES} + {share}")).withColumn("_by_tie", F.col("_bits") > 0).drop("_c", "_bits")


def _with_first_of_next(dealt: DataFrame, order: str, tie: str) -> DataFrame:
    """The rows, and in each bucket a copy of the next bucket's first row (``_extra``);
    after the last bucket comes the first."""
    firsts = dealt.groupBy("_b").agg(F.max(order).alias("o"), F.min(tie).alias("t")).orderBy("_b").collect()  # a row a bucket: a few times FAN squared at most
    if not firsts:
        return dealt.drop("_by_tie").withColumn("_extra", F.lit(False))
    lookup = lambda key: F.element_at(F.create_map(*[F.lit(x) for i, r in enumerate(firsts) if r[key] is not None for x in (r["_b"], firsts[i - 1]["_b"] if key == "_b" else r[key])] or [F.lit(0), F.lit(0).cast("long")]), F.col("_b"))
    is_first = F.when(F.col("_by_tie"), F.col(tie) == lookup("t")).otherwise(F.col(order) == lookup("o"))
    here = F.struct(F.col("_b").alias("b"), F.lit(False).alias("x"))
    there = F.struct(lookup("_b").alias("b"), F.lit(True).alias("x"))
    out = dealt.withColumn("_to", F.explode(F.when(is_first, F.array(here, there)).otherwise(F.array(here))))
    return out.withColumn("_b", F.col("_to.b")).withColumn("_extra", F.col("_to.x")).drop("_to", "_by_tie")


def fingerprint_edits(docs: DataFrame, k: int = K, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last third (code points,
    rounded down) is replaced by the next document's first as many; next means descending
    id, and after the last the first.

    A null text is as an empty one.  Rows without an id come last.  Among equal ids (or
    none) the order is that of the texts' hashes, and equal rows follow each other."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")).withColumn("_tie", F.xxhash64("_text"))
    rows = _with_first_of_next(_order_buckets(base, "doc_id", "_tie"), "doc_id", "_tie")
    w = Window.partitionBy("_b").orderBy("_extra", F.col("doc_id").desc_nulls_last(), "_tie")
    rows = rows.withColumn("n_chars", F.length("_text").cast("long"))
    rows = rows.withColumn("_next", F.coalesce(F.lead("_text").over(w), F.lit("")))
    rows = rows.withColumn("_edited", F.expr("concat(left(_text, cast(n_chars - n_chars div 3 as int)), left(_next, cast(n_chars div 3 as int)))"))
    rows = rows.withColumn("edited_sha256", F.sha2("_edited", 256)).drop("_next")
    rows = with_sketch(with_sketch(rows, "_text", "_a", k), "_edited", "_e", k).drop("_text", "_edited")
    rows = rows.withColumn("_n", F.lead("_a").over(w)).where("not _extra")
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        digest(F.col("_a")).alias("fingerprint"),
        digest(F.col("_e")).alias("edited_fingerprint"),
        resemblance(F.col("_a"), F.col("_e"), k).alias("near_edited"),
        resemblance(F.col("_a"), F.col("_n"), k).alias("near_next"),
    )
