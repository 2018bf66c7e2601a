"""Joins on keys that a large share of the rows hold.

A frequent-items sketch finds the hot keys, which is one small aggregate; a hot
key's rows are dealt over several salts and the rows they join are repeated for
each of them.  Every other key joins under salt 0, in the same join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"
PIECES = 8   # salts for each share of the rows: salts fall on partitions by chance, and many small ones even out


def hot_keys(rows: DataFrame, key: Column | str, share: float | None = None) -> dict:
    """Key -> number of salts, for keys that hold ``share`` of the rows or more.

    The default share is half a shuffle partition.  At most 1 / ``share`` keys
    can be hot, so what comes to the driver is bounded by that.  The sketch's
    counts are estimates, which only moves the cut between hot and plain keys.
    """
    key = F.col(key) if isinstance(key, str) else key
    share = share or 0.5 / int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = min(10_000, math.ceil(1 / share))
    found = rows.where(key.isNotNull()).select(key.alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {most}, {min(1_000_000, 10 * most)})").alias("top")).first()
    return {t["item"]: math.ceil(PIECES * t["count"] / (share * found.n)) for t in found.top or [] if t["count"] >= share * found.n}


def _salts(key: Column, hot: dict) -> Column:
    """How many salts the key has: looked up for hot keys only."""
    if not hot:
        return F.lit(1)
    table = F.create_map(*[F.lit(x) for item in hot.items() for x in item])
    return F.when(key.isin(list(hot)), F.element_at(table, key)).otherwise(F.lit(1))


def salt_rows(rows: DataFrame, key: Column, hot: dict, name: str = SALT) -> DataFrame:
    """The side with many rows a key: one salt for each row, by its content and partition.

    Both stay the same when a task runs again, so a retry deals rows as before;
    the partition parts rows that are equal.
    """
    n = _salts(key, hot)
    return rows.withColumn(name, F.when(n > 1, F.pmod(F.xxhash64(*rows.columns, F.spark_partition_id()), n)).otherwise(F.lit(0)).cast("int"))


def repeat_rows(rows: DataFrame, key: Column, hot: dict, name: str = SALT) -> DataFrame:
    """The other side: a row for each salt of its key."""
    return rows.withColumn(name, F.explode(F.sequence(F.lit(0), _salts(key, hot).cast("int") - 1)))


def skew_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner", share: float | None = None,
              hot: dict | None = None) -> DataFrame:
    """``left.join(right, left_key == right_key, how)`` with the left side's hot keys dealt over many tasks.

    ``how`` is inner, left, left_semi or left_anti: a left row has one salt and
    meets every right row of its key there, so no row is lost or made twice.
    Column names of the two sides must differ.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join cannot be {how!r}")
    hot = hot_keys(left, left_key, share) if hot is None else hot
    a = salt_rows(left, F.col(left_key), hot, "_salt_l")
    b = repeat_rows(right, F.col(right_key), hot, "_salt_r")
    return a.join(b, (F.col(left_key) == F.col(right_key)) & (F.col("_salt_l") == F.col("_salt_r")), how).drop("_salt_l", "_salt_r")
