import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4,2]")  # one retry per task
        .appName("homestats-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from homestats.session import ensure_checkpoint_dir, release_scratch

    ensure_checkpoint_dir(s)  # keeps a configured spark.checkpoint.dir; a temp folder only when unset
    yield s
    release_scratch(s)
    s.stop()


GOLDEN_ROWS = [
    ("1", "A", "100", 100.0, 34.0, -118.0, "2024-01-05", "2024-01-10", "2024-02-01"),
    ("2", "A", "0", 90.0, 0.0, 0.0, "2024-02-10", "2024-02-12", "2024-02-01"),
    ("3", "A", "60000000", 100.0, 34.0, 118.0, "2024-01-01", "2024-01-20", "2024-01-15"),
    ("4", "B", "$5", 100.0, 34.0, None, None, "2024-02-01", "2024-03-01"),
    ("5", "B", None, 100.0, None, -117.0, "bad", None, "2024-03-01"),
    ("6", "B", "200", 250.0, 34.0, -118.0, "2024-03-01", "2024-02-20", "2024-04-01"),
    ("7", None, "300", 0.0, 34.0, -118.0, "2024-03-05", "2024-03-20", None),
    ("7", "C", "-1", None, 34.0, -118.0, "2024-03-01", "2024-03-02", "2024-04-01"),
    (None, "C", "400", 300.0, 34.0, -118.0, "2024-04-01", "2024-04-02", "2024-05-01"),
    (None, "B", "150", 150.0, 34.0, -118.0, "2024-05-01", "2024-05-02", "2024-07-01"),
]
GOLDEN_SCHEMA = (
    "ListingKey string, CountyOrParish string, ClosePrice string, ListPrice double, Latitude double, "
    "Longitude double, ListingContractDate string, PurchaseContractDate string, CloseDate string"
)


@pytest.fixture(scope="session")
def golden(spark):
    """The 10-row golden table, with a row id to keep the expected order."""
    from pyspark.sql import functions as F

    rows = [(i, *r) for i, r in enumerate(GOLDEN_ROWS)]
    return spark.createDataFrame(rows, "rid int, " + GOLDEN_SCHEMA).withColumn("rid", F.col("rid"))
