"""Derived inputs that several readers share."""

from oracle_harness import SF_SMALL
from tidemark.plans import named as N


def test_clean_line_items_are_grouped_once(spark):
    history = N.result_history(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "min(l_" not in history and "lineitem_clean" in history
