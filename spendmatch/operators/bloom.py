"""A Bloom filter built by aggregation, as column expressions (for C4 / J16: hashes that may be in a set)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES = 4
BITS_PER_VALUE = 10
MOST_BITS = 1 << 26   # 8 MB: the filter is one value that every task gets, whatever the size of the set


def filter_bits(n_values: int) -> int:
    """Bits for ``n_values``: about ten each, a power of two, never over MOST_BITS (then it passes more that is not in the set)."""
    return min(MOST_BITS, max(1 << 10, 1 << (BITS_PER_VALUE * max(1, n_values) - 1).bit_length()))


def _positions(value: Column, bits: int) -> list[Column]:
    a, b = F.xxhash64(value), F.xxhash64(value, F.lit(1))
    # both hashes are cut below the number of bits first, so the sums never overflow
    return [F.pmod(F.pmod(a, F.lit(bits)) + i * F.pmod(b, F.lit(bits)), F.lit(bits)) for i in range(PROBES)]


def build(values: DataFrame, col: str, bits: int) -> DataFrame:
    """One row, one column: the filter over ``col`` as an array of 64-bit words.  NULL is not in the set."""
    spark = values.sparkSession
    at = values.where(F.col(col).isNotNull()).select(F.explode(F.array(*_positions(F.col(col), bits))).alias("at"))
    ones = at.groupBy(F.expr("at div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("ones"))
    every = spark.range(bits // 64).withColumnRenamed("id", "word").join(ones, "word", "left")
    words = F.array_sort(F.collect_list(F.struct("word", F.coalesce("ones", F.lit(0).cast("long")).alias("ones"))))
    return every.agg(F.transform(words, lambda x: x["ones"]).alias("words"))


def may_contain(words: Column, value: Column, bits: int) -> Column:
    """False only if ``value`` is certainly not in the set."""
    out = F.lit(True)
    for at in _positions(value, bits):
        out = out & (F.getbit(F.get(words, F.call_function("div", at, F.lit(64)).cast("int")), (at % 64).cast("int")) == 1)
    return out
