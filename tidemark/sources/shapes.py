"""The source-query shapes the load configs document (joins, aggregates,
filters feeding a load), as DataFrame plans over the driver's tables.

Each is equivalent to the plain SQL kept as its oracle in ``plans/oracle.py``.  Where
the plain form joins first and aggregates after, these aggregate the large
side on its join key first (map-side partial aggregation, then one
exchange), so the join sees one row per key instead of one per order or
line item.  That also keeps a customer with a third of all orders from
landing in a single join task.  Catalyst does not push aggregates below
joins by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _customer_groups(customer: DataFrame, cols) -> DataFrame:
    # GROUP BY over the customer columns; ``_m`` counts identical rows so the
    # per-customer totals can be scaled exactly as the plain join would.
    return customer.groupBy(*cols).agg(F.count(F.lit(1)).alias("_m"))


def customer_orders(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """customer LEFT JOIN orders, GROUP BY customer: order count, amount, last date."""
    per_cust = orders.groupBy(F.col("o_custkey")).agg(
        F.count("o_orderkey").alias("_n"),
        F.sum(F.col("o_totalprice").cast(MONEY)).alias("_amt"),
        F.max("o_orderdate").alias("last_order_date"),
    )
    cols = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    c = _customer_groups(customer, cols)
    j = c.join(per_cust, c.c_custkey == per_cust.o_custkey, "left")
    return j.select(
        *cols,
        (F.coalesce(F.col("_n"), F.lit(0)) * F.col("_m")).cast("long").alias("total_orders"),
        (F.col("_amt") * F.col("_m")).cast("decimal(38,2)").alias("total_amount"),
        "last_order_date",
    )


def active_tier(customer_flagged: DataFrame, orders: DataFrame, as_of_date: str, days: int = 30) -> DataFrame:
    """Recent, not-deleted customers with an upper-cased name and a tier by
    order count (> 10 VIP, > 5 Regular, else New)."""
    base = customer_orders(customer_flagged.filter(F.col("is_deleted") == "N"), orders)
    since = F.date_sub(F.to_date(F.lit(as_of_date)), days)
    recent = base.filter(F.col("last_order_date") >= since.cast("timestamp_ntz"))
    n = F.col("total_orders")
    return recent.select(
        "c_custkey",
        F.upper("c_name").alias("c_name_upper"),
        "c_nationkey",
        F.when(n > 10, "VIP").when(n > 5, "Regular").otherwise("New").alias("customer_tier"),
    )


def customer_360(
    customer: DataFrame, orders: DataFrame, lineitem: DataFrame, part: DataFrame, as_of_date: str
) -> DataFrame:
    """customer LEFT JOIN orders LEFT JOIN lineitem LEFT JOIN part, grouped by
    customer.  As in the plain query, amounts are summed after the line-item
    join, so each order's amount counts once per line item (at least once).

    Plan: line items meet the parts once and are reduced to (order, part)
    with the rows each stands for; both the lines per order and the known
    parts per order are read from that one exchange, so the fan-out is
    arithmetic (amount x lines) rather than rows.

    Groups as many as the rows hold an aggregate in a struct, so that Spark
    sorts the rows and needs about a quarter of a hash table's memory, and what
    is grouped or joined next by the first of their keys reads them as they lie.
    """
    li = lineitem.select("l_orderkey", "l_partkey")
    # Parts per key (1 when keys are unique): each line fans out that many
    # times in the plain join, or once when its part is unknown.
    pc = part.groupBy(F.col("p_partkey")).agg(F.count(F.lit(1)).alias("_pn"))
    pairs = li.join(pc, li.l_partkey == pc.p_partkey, "left").groupBy("l_orderkey", "l_partkey").agg(
        F.sum(F.coalesce(F.col("_pn"), F.lit(1))).alias("_rows"), F.max(F.struct("_pn"))["_pn"].alias("_known")
    )
    lines = pairs.groupBy("l_orderkey").agg(
        F.max(F.struct("_known")).alias("_any"), F.sum(F.when(F.coalesce("_known", F.lit(1)) > 0, F.col("_rows"))).alias("_lines")
    ).where("_any IS NOT NULL")
    # both branches use both aggregates, so that they are the same subplan
    known = pairs.filter("_known IS NOT NULL AND _rows > 0")
    o = orders.select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast(MONEY).alias("_amt"), "o_orderdate"
    )
    ol = o.join(lines, o.o_orderkey == lines.l_orderkey, "left").withColumn(
        "_fan", F.coalesce(F.col("_lines"), F.lit(1))
    )
    per_order = ol.groupBy("o_custkey", "o_orderkey").agg(
        F.sum(F.col("_amt") * F.col("_fan")).alias("_ltv"),
        F.sum(F.when(F.col("_amt").isNotNull(), F.col("_fan"))).alias("_n_amt"),
        F.max(F.struct("o_orderdate"))["o_orderdate"].alias("_date"),
    )
    per_cust = per_order.groupBy("o_custkey").agg(
        F.count("o_orderkey").alias("_orders"),
        F.sum("_ltv").alias("_ltv"),
        F.sum("_n_amt").alias("_n_amt"),
        F.max("_date").alias("last_purchase_date"),
    )
    cust_parts = (
        known.select("l_orderkey", "l_partkey")
        .join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("_pc"), "l_partkey")
        .agg(F.max(F.struct("o_custkey")).alias("_any"))
        .where("_any IS NOT NULL")
        .groupBy("_pc")
        .agg(F.count("l_partkey").alias("_parts"))
    )
    cols = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    c = _customer_groups(customer.filter(F.col("is_deleted") == "N"), cols)
    j = c.join(per_cust, c.c_custkey == per_cust.o_custkey, "left").join(
        cust_parts, F.col("c_custkey") == F.col("_pc"), "left"
    )
    m = F.col("_m")
    ltv = (F.col("_ltv") * m).cast("decimal(38,2)")
    return j.select(
        *cols,
        F.coalesce(F.col("_orders"), F.lit(0)).cast("long").alias("order_count"),
        ltv.alias("lifetime_value"),
        F.coalesce(F.col("_parts"), F.lit(0)).cast("long").alias("unique_products"),
        "last_purchase_date",
        F.datediff(F.to_date(F.lit(as_of_date)), F.to_date("last_purchase_date")).alias("days_since_purchase"),
        (F.col("_ltv").cast("double") / F.col("_n_amt").cast("double")).alias("avg_order_value"),
    )


def enriched_events(events: DataFrame, customer: DataFrame, since: str) -> DataFrame:
    """events LEFT JOIN customer, events since a time (filter pushed to the scan)."""
    e = events.filter(F.col("ts") >= F.to_timestamp_ntz(F.lit(since)))
    c = customer.select("c_custkey", "c_name", "c_mktsegment")
    return e.join(c, e.user_id == c.c_custkey, "left").select(
        "event_id",
        "event_type",
        F.col("ts").alias("event_date"),
        F.col("user_id").alias("customer_id"),
        "c_name",
        "c_mktsegment",
        F.col("value").cast(MONEY).alias("event_value"),
    )


# A small literal lookup relation (segment -> tier), the shape
# of an inline VALUES source.
SEGMENT_TIERS = [
    ("AUTOMOBILE", "B"),
    ("BUILDING", "A"),
    ("FURNITURE", "C"),
    ("HOUSEHOLD", "C"),
    ("MACHINERY", "A"),
]


def segment_tiers(customer: DataFrame) -> DataFrame:
    """customer joined with an inline VALUES relation (S3).  The literal side
    has a fixed, proven size (five rows), so it is broadcast."""
    spark = customer.sparkSession
    v = spark.createDataFrame(SEGMENT_TIERS, "segment string, segment_tier string")
    return customer.join(F.broadcast(v), customer.c_mktsegment == v.segment, "left").select(
        "c_custkey", "c_mktsegment", "segment_tier"
    )
