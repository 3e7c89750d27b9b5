"""Report queries over the results and details tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LATEST_COLUMNS = [
    "recon_id",
    "recon_name",
    "status",
    "source_count",
    "target_count",
    "matched_count",
    "match_rate",
    "missing_count",
    "extra_count",
    "mismatch_count",
    "summary",
]


def latest_results(results: DataFrame, n: int = 10) -> DataFrame:
    """Newest n runs (ties on time broken by recon_id, newest id first).
    A top-n: each task keeps its n best rows, one task merges them."""
    return results.orderBy(F.col("execution_time").desc(), F.col("recon_id").desc()).limit(n).select(*LATEST_COLUMNS)


def details_for(details: DataFrame, recon_name: str, issue_type: str, n: int | None = None) -> DataFrame:
    """Detail rows of one reconciliation and issue type, newest first."""
    d = details.filter((F.col("recon_name") == recon_name) & (F.col("issue_type") == issue_type))
    d = d.orderBy(F.col("execution_time").desc(), F.col("recon_id").desc(), F.col("record_keys"))
    return d.limit(n) if n is not None else d


def match_rate_trend(results: DataFrame) -> DataFrame:
    """Average match rate and run count per reconciliation and day.

    Rates carry two decimals, so they are summed exactly as decimals; the
    average is that sum over the count of non-NULL rates."""
    day = F.to_date("execution_time").alias("run_date")
    return results.groupBy("recon_name", day).agg(
        F.try_divide(
            F.sum(F.col("match_rate").cast("decimal(18,2)")).cast("double"), F.count("match_rate").cast("double")
        ).alias("avg_match_rate"),
        F.count(F.lit(1)).alias("run_count"),
    )


def issue_counts(details: DataFrame, day: str) -> DataFrame:
    """Issues of one day counted by reconciliation and type.  Of a table that
    is partitioned by day, that day's files are read."""
    ran = F.col("execution_day") if "execution_day" in details.columns else F.to_date("execution_time")
    d = details.filter(ran == F.to_date(F.lit(day)))
    return d.groupBy("recon_name", "issue_type").agg(F.count(F.lit(1)).alias("issue_count"))
