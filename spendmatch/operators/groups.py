"""Rows that are alone in their group, told apart without shuffling them.

Where most groups have one row, a grouped step over wide rows moves all of them
to find the few that belong together.  Here only 40 bits of a hash of the group go
through a shuffle; a Bloom filter of the hashes that occur again then says, in
the scan, which rows may share a group.  A hash that two groups share, or a false
positive, only sends a row the general way, so the split is exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendmatch.operators import bloom
from spendmatch.sources.fixedwidth import keep_rows

HASH_BITS = (1 << 40) - 1   # what is shuffled of a hash: of a billion rows one in a thousand meets another's by chance


def split_shared(rows: DataFrame, key: Column, keep: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(alone, several): the rows that no other row shares ``key`` with (a 64-bit hash; NULL is shared with none), and the rest.

    ``rows`` is read three times, so it should be stored; ``keep`` stores the hashes that occur again.
    """
    return find_shared(rows, key, keep)(rows)


def find_shared(rows: DataFrame, key: Column, keep: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], tuple[DataFrame, DataFrame]]:
    """The split of :func:`split_shared`, for any part of ``rows`` that has their columns.

    Rows are picked by a generator, not a filter, so that the hash is made once
    a row (:func:`spendmatch.sources.fixedwidth.keep_rows`).
    """
    key = key.bitwiseAND(F.lit(HASH_BITS))
    again = keep(rows.select(key.alias("k")).where("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
                     .where("n > 1").select("k"))
    n = again.count()
    if not n:
        return lambda part: (part, part.limit(0))
    bits = bloom.filter_bits(n)

    def split(part: DataFrame) -> tuple[DataFrame, DataFrame]:
        hit = bloom.may_contain(bloom.build(again, "k", bits).scalar(), F.col("_hash"), bits)
        marked = part.withColumn("_hash", key).withColumn("_shared", F.coalesce(hit, F.lit(False)))
        return keep_rows(marked, ~F.col("_shared"), part.columns), keep_rows(marked, F.col("_shared"), part.columns)

    return split
