"""Bounded, documented samples of labelled documents for fitting classifiers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; null for a null id."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(mod))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, held_out: int, per_class: int, max_chars: int):
    """Up to ``per_class`` (text, y, weight) rows of each class as a pandas frame, chosen by a
    hash of the id among the labelled rows that may be learnt from (remainder other than
    ``held_out``, label 0 or 1, id not null, at most ``max_chars`` characters); the bound is
    2 * per_class * max_chars.  A row's weight is the number of labelled ids that it stands
    for.  Ids with contradicting labels are left out."""
    y = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (remainder(F.col("doc_id"), mod) != held_out))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.min(label).cast("int").alias("y"), F.max(label).cast("int").alias("_hi"))
        .where("y = _hi")
        .drop("_hi")
        .withColumn("_order", F.xxhash64("_id"))
    )
    n = {r["y"]: r["count"] for r in y.groupBy("y").count().collect()}
    # few enough ids before the texts are read: a share of each class by hash, with room for texts that are too long
    keep = F.lit(False)
    for k in (0, 1):
        cutoff = int(-(2**63) + min(1.0, 1.5 * per_class / max(1, n.get(k, 0))) * (2**64 - 1))
        keep = keep | ((F.col("y") == k) & (F.col("_order") <= F.lit(min(cutoff, 2**63 - 1))))
    few = y.where(keep)
    both = docs.where(F.length("text") <= max_chars).join(few, docs["doc_id"] == few["_id"]).select("text", "y", "_order", F.col("_id"))
    parts = [both.where(F.col("y") == k).orderBy("_order", "text").limit(per_class).toPandas() for k in (0, 1)]
    return pd.concat([p.assign(weight=n.get(k, 0) / max(1, len(p))) for k, p in enumerate(parts)], ignore_index=True)
