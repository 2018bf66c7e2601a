"""Heavy-hitter joins: the same rows as a plain join, and no task with far more rows than the others."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from spendmatch.operators.matching import Step, cascade
from spendmatch.operators.skew import hot_keys, skew_join


@pytest.fixture()
def plain_joins(spark):
    """No broadcast, no skew split by AQE, sixteen shuffle partitions that stay as they are."""
    want = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in want}
    for k, v in want.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _rows(spark, n=48_000):
    # a third of all rows on one key, equal rows among them, NULL keys, the rest on many keys
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 4001))
    return spark.range(n, numPartitions=24).select(key.alias("k"), (F.col("id") % 100).alias("v"))


def _dim(spark):
    return spark.range(4500).select(F.concat(F.lit("k"), F.col("id")).alias("d"), F.col("id").alias("x")).union(
        spark.createDataFrame([("hot", -1), ("hot", -2)], "d string, x long"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_a_plain_join(spark, plain_joins, how):
    left, right = _rows(spark), _dim(spark).where("x % 7 <> 1")
    want = Counter(map(tuple, left.join(right, F.col("k") == F.col("d"), how).collect()))
    assert Counter(map(tuple, skew_join(left, right, "k", "d", how).collect())) == want


def test_no_task_gets_the_hot_key_alone(spark, plain_joins):
    left = _rows(spark)
    hot = hot_keys(left, "k")
    assert list(hot) == ["hot"] and hot["hot"] >= 80

    def per_task(df):
        return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
    plain = per_task(left.join(_dim(spark), F.col("k") == F.col("d")))
    salted = per_task(skew_join(left, _dim(spark), "k", "d"))
    assert plain[-1] > 4 * plain[len(plain) // 2]
    assert salted[-1] <= 2 * salted[len(salted) // 2]


def test_cascade_with_hot_keys(spark, plain_joins):
    rows = _rows(spark).withColumn("name", F.concat(F.lit("k"), F.col("v")))
    steps = [Step("key", F.col("k"), _dim(spark).where("x % 2 <> 0"), "d"), Step("name", F.col("name"), _dim(spark), "d")]
    want, got = (Counter(map(tuple, cascade(rows, steps, ["x"], hot_share=s).collect())) for s in (None, 0.02))
    assert got == want and {m for *_, m in got} == {"key", "name"}


def test_nothing_hot(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    assert hot_keys(df, "k", 0.05) == {} and hot_keys(df.limit(0), "k", 0.05) == {}
    with pytest.raises(ValueError):
        skew_join(df, df.toDF("d"), "k", "d", "full_outer")
