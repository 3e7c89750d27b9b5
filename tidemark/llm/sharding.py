"""Sharding by balanced label propagation.

Documents start in a shard that a hash deals out.  In each round every linked document
prefers the shard where most bytes of its group are or could be, and moves there as far as
the quotas allow: the room left in that shard plus what leaves it in exchange.  Which of
the documents that want to move may do so is decided on a histogram of hashes (group
first, so that a group moves as one; then document, so that a group larger than a shard
splits).  At the end the documents without links fill each shard up to an equal share of
all bytes.  Built-in functions only; nothing but per-shard totals reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, prefix_sums

GROUP_BINS, ROW_BINS = 512, 64
#: A shard has room if this share of it is free.
ROOMY = 0.05


def _totals(df: DataFrame, shards: int) -> list[int]:
    got = {r["shard"]: r["s"] for r in df.groupBy("shard").agg(F.sum("size").alias("s")).collect()}  # a row a shard
    return [int(got.get(i) or 0) for i in range(shards)]


def propagate(linked: DataFrame, shards: int, share: float, rounds: int) -> DataFrame:
    """``linked``: (rid, grp, size, shard), materialised.  The same rows with their shards
    after ``rounds`` rounds; no shard's bytes grow beyond ``share`` but by what an exchange
    of unequal documents adds."""
    per_shard = lambda xs: F.element_at(F.array(*[F.lit(float(x)) for x in xs]), F.col("_to") + 1)
    load = None
    for _ in range(rounds):
        before, load = load, _totals(linked, shards)
        if load == before:
            break  # the last round moved nothing
        room = [max(0.0, share - x) for x in load]
        held = cut(linked.groupBy("grp", "shard").agg(F.sum("size").alias("s")))
        whole = held.groupBy(F.col("grp").alias("_w")).agg(F.sum("s").alias("_whole"), F.count(F.lit(1)).alias("_in")).where("_in > 1")
        held = cut(held.join(cut(whole), held["grp"] == F.col("_w")).drop("_w", "_in"))
        # the shard with room where most of the group can be: what is there, and what fits in;
        # where no shard has room, documents are only exchanged
        free = F.element_at(F.array(*[F.lit(x) for x in room]), F.col("shard") + 1)
        roomy = F.lit(True) if max(room) < ROOMY * share else free >= ROOMY * share
        rank = F.struct(roomy.alias("r"), (F.col("s") + F.least(free, F.col("_whole") - F.col("s"))).alias("p"), F.col("s"), F.xxhash64("grp", "shard").alias("h"))
        goal = cut(held.groupBy(F.col("grp").alias("_g")).agg(F.max_by("shard", rank).alias("_to"), F.max_by("s", rank).alias("_there")))
        # documents leave the shards that hold less of the group than the goal does
        moves = held.join(goal, held["grp"] == goal["_g"]).where("shard <> _to and s <= _there")
        moves = cut(moves.select("_g", F.col("shard").alias("_from"), "_to"))  # tables of their own, so that a hot group's partition of a join can be split
        want = (
            linked.join(moves, (linked["grp"] == moves["_g"]) & (linked["shard"] == moves["_from"]), "left")
            .drop("_g", "_from")
            .withColumn("_bin", F.pmod(F.xxhash64("grp"), F.lit(GROUP_BINS)) * ROW_BINS + F.pmod(F.xxhash64("rid", F.lit("bin")), F.lit(ROW_BINS)))
        )
        want = cut(want)
        bins = want.where("_to is not null").groupBy("shard", "_to", "_bin").agg(F.sum("size").alias("s"))
        flows = bins.groupBy("shard", "_to").agg(F.sum("s").alias("flow"))
        back = flows.select(F.col("shard").alias("_f2"), F.col("_to").alias("_t2"), F.col("flow").alias("_back"))
        quota = (
            flows.withColumn("_all", F.sum("flow").over(Window.partitionBy("_to")))
            .join(back, (F.col("shard") == F.col("_t2")) & (F.col("_to") == F.col("_f2")), "left")
            .select(
                F.col("shard").alias("_qf"),
                F.col("_to").alias("_qt"),
                (F.least(F.col("flow"), F.coalesce("_back", F.lit(0))) + per_shard(room) * F.col("flow") / F.col("_all")).alias("quota"),
            )
        )
        upto = Window.partitionBy("shard", "_to").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
        # a row per pair of shards and bin: bounded by shards squared times bins
        taken = (
            bins.withColumn("_cum", F.sum("s").over(upto))
            .join(quota, (F.col("shard") == F.col("_qf")) & (F.col("_to") == F.col("_qt")))
            .where("_cum <= quota")
            .select(F.col("shard").alias("_kf"), F.col("_to").alias("_kt"), F.col("_bin").alias("_kb"))
        )
        moved = want.join(taken, (want["shard"] == taken["_kf"]) & (want["_to"] == taken["_kt"]) & (want["_bin"] == taken["_kb"]), "left")
        linked = cut(moved.select("rid", "grp", "size", F.coalesce("_kt", "shard").alias("shard")))
    return linked


def shard_documents(docs: DataFrame, shards: int = 8, rounds: int = 6, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes plus 1), text_crc32, law ``bytes``,
    shard, slot (gapless in the shard), grown_shard (null: the law is not ``key``), and
    group_rows (rows with an equal text).

    Links join equal texts, empty ones included.  Null texts have size 1, the crc32 of
    nothing (0) and no links.  Equal ids and repeated rows are rows of their own."""
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(F.col(text).cast("binary"))).alias("grp"),
    )
    base = cut(base.withColumn("rid", F.monotonically_increasing_id()))
    total = base.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("s")).first()
    groups = base.where("grp is not null").groupBy("grp").agg(F.count(F.lit(1)).alias("group_rows")).where("group_rows > 1").withColumnRenamed("grp", "_g")
    groups = cut(groups)
    rows = cut(base.join(groups, base["grp"] == groups["_g"], "left").drop("_g").withColumn("group_rows", F.coalesce("group_rows", F.lit(1))))
    linked = rows.where("group_rows > 1").select("rid", "grp", "size", F.pmod(F.xxhash64("rid"), F.lit(shards)).cast("int").alias("shard"))
    share = total["s"] / shards
    linked = propagate(cut(linked), shards, share, rounds)
    ends, at = [], 0.0
    for x in _totals(linked, shards):
        ends.append(at := at + max(0.0, share - x))
    free = rows.where("group_rows = 1").select("rid", "size")
    laid = prefix_sums(free, [], ["rid"], total["n"], "size")
    ends = ", ".join(f"{x!r}D" for x in ends[:-1]) or "double('inf')"
    free = laid.select("rid", F.expr(f"size(filter(array({ends}), e -> e <= _before + size / 2))").alias("shard"))
    placed = linked.select("rid", "shard").unionByName(free)
    placed = cut(placed.withColumnRenamed("rid", "_rid"))
    slots = prefix_sums(placed, ["shard"], ["_rid"], total["n"]).select("_rid", "shard", F.col("_pos").cast("long").alias("slot"))
    return rows.join(slots, rows["rid"] == slots["_rid"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), "slot", F.lit(None).cast("int").alias("grown_shard"), "group_rows"
    )
