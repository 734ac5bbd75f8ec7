import hashlib

import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventlens import functions as fn


@pytest.mark.parametrize("n", [1, 3, 4, 7, 8, 10, 1000, 2 ** 31 - 1])
def test_hash_partition_is_md5_modulo(spark, n):
    keys = [f"u_{i:04d}" for i in range(300)] + ["ключ", "a b"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = dict(rows(df.select("k", fn.hash_partition(F.col("k"), n))))
    assert got == {k: int(hashlib.md5(k.encode()).hexdigest(), 16) % n for k in keys}


def test_hash_partition_spreads_keys(spark):
    df = spark.range(50).select(fn.hash_partition(F.concat(F.lit("u_"), F.col("id").cast("string")), 4).alias("p"))
    assert df.distinct().count() > 1


def test_routing_key_falls_back_to_user(spark):
    df = spark.createDataFrame([("k", "u"), ("", "u"), (None, "u")], "partition_key string, user_id string")
    assert [r[0] for r in df.select(fn.routing_key()).collect()] == ["k", "u", "u"]


def test_presence_percent_and_labels(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "x string")
    assert [r[0] for r in df.select(fn.is_present("x")).collect()] == [True, False, False]
    one = spark.range(1)
    got = one.select(
        fn.percent(F.lit(1), F.lit(3)), fn.percent(F.lit(1), F.lit(0)),
        fn.category_label(F.lit("Home Garden")), fn.category_label(F.lit("Toys")),
    ).first()
    assert tuple(got) == (33.3, 0.0, "Home", "Toys")


@pytest.mark.parametrize("lag,pct,band", [
    (0, 0.0, "green"), (3000, 30.0, "green"), (3001, 30.01, "yellow"), (7000, 70.0, "yellow"),
    (7001, 70.01, "red"), (20000, 100.0, "red"),
])
def test_health_bands(spark, lag, pct, band):
    p = fn.lag_percent(F.lit(lag))
    got = spark.range(1).select(p, fn.health_band(p, 70, 30)).first()
    assert got[0] == pytest.approx(pct) and got[1] == band


def test_shared_folder(tmp_path):
    """The configured folder is used; only a local session may do without."""
    from types import SimpleNamespace as NS

    from eventlens.session import shared_dir

    def session(master, folder=None):
        return NS(conf=NS(get=lambda key, default: folder or default),
                  sparkContext=NS(master=master, applicationId=master))

    assert shared_dir(session("spark://h:7077", f"{tmp_path}/")) == str(tmp_path)
    assert shared_dir(session("local[2]")) == shared_dir(session("local[2]"))
    with pytest.raises(ValueError):
        shared_dir(session("spark://h:7077"))
