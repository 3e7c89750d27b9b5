import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    wh = tempfile.mkdtemp(prefix="tidemark-wh-")
    s = (
        SparkSession.builder.master("local[4]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", wh)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from tidemark.session import checkpoint_dir

    checkpoint_dir(s)
    yield s
    s.stop()
