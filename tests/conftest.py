import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession, functions as F

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

SMALL = "/root/testdata/sf0.001"
EPOCH = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)

FLAT = ("event_id string, event_type string, ts timestamp, ingest_ts timestamp, user_id string, country string, "
        "device string, product_name string, category string, query string, amount decimal(18,2), copy int")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(seconds):
    return EPOCH + dt.timedelta(seconds=seconds)


@pytest.fixture
def events(spark):
    """Flat events from dicts: `at` is the arrival in seconds, the rest are columns."""

    def make(*rows):
        names = [c.split()[0] for c in FLAT.split(", ")]
        full = []
        for i, row in enumerate(rows):
            row = {"event_id": f"e_{i}", "event_type": "page_view", "user_id": "u_7", "copy": 0,
                   "country": "NO", "device": "kiosk", **row}
            arrival = row.pop("at", i)
            row["ingest_ts"] = at(arrival)
            row["ts"] = at(arrival - row.pop("latency", 0))
            full.append(tuple(row.get(n) for n in names))
        schema = FLAT.replace("amount decimal(18,2)", "amount double")
        return spark.createDataFrame(full, schema).withColumn("amount", F.col("amount").cast("decimal(18,2)"))

    return make


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
