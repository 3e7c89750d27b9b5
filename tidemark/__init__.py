"""tidemark: keep tables correct with Spark.

Loads (incremental, SCD type 1, SCD type 2, full refresh) and reconciliation
(schema drift, counts, duplicate / missing / extra keys, value mismatches,
match rate, thresholds) as functions from DataFrames to DataFrames.
"""

__version__ = "0.1.0"
