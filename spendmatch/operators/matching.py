"""Entity matching: best vendor row, row ids and the priority cascade.

Scale notes
-----------
* ``best_vendor`` picks the winning directory row per key with ``min`` over an
  ordering struct instead of ``row_number`` over a window.  The aggregate is
  partial (map-side) + final, so a key holding a third of the directory never
  lands whole in one task.
* ``cascade`` needs no row ids: a row's fate at each step depends only on its
  own key values, so the steps are one chain of left joins over one scan, each
  keyed only for the rows no earlier step matched.  AQE turns a step into
  a broadcast join when the *measured* dimension size is below the adaptive
  threshold and splits skewed partitions otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendmatch.functions.text import (active_rank, blank_to_null, canon_name_a, cert_rank)

NO_TAX = "NO_TAX"
NO_B2G = "NO_B2G"
UNMATCHED = "unmatched"


def best_vendor(vendors: DataFrame, keys=("tax", "b2g", "name"), strip_suffix: bool = True,
                active_only: bool = True) -> DataFrame:
    """One best certification row per vendor identity, Active rows only.

    Identity = (tax id or 'NO_TAX', [vendor-system id or 'NO_B2G',] canonical
    name).  Order: Active first, then the certification hierarchy, then the
    certification text (NULL last) so ties resolve the same way on every run.
    Output columns: tax_id, [b2g_id,] canon_name, certification_type,
    certification_status.
    """
    v = vendors.select(
        blank_to_null("tax_id").alias("tax_id"),
        blank_to_null("b2gnow_vendor_number").alias("b2g_id"),
        canon_name_a("business_name", strip_suffix).alias("canon_name"),
        "certification_type", "certification_status")
    group = [F.coalesce("tax_id", F.lit(NO_TAX)).alias("_k_tax")]
    if "b2g" in keys:
        group.append(F.coalesce("b2g_id", F.lit(NO_B2G)).alias("_k_b2g"))
    group.append(F.col("canon_name").alias("_k_name"))
    order = F.struct(
        active_rank("certification_status").alias("a"),
        cert_rank("certification_type").alias("r"),
        F.col("certification_type").isNull().alias("n"),
        F.col("certification_type").alias("t"),
        F.col("certification_status").alias("s"),
        F.col("tax_id").alias("tax_id"),
        F.col("b2g_id").alias("b2g_id"))
    best = v.groupBy(*group).agg(F.min(order).alias("w"))
    cols = [F.col("w.tax_id").alias("tax_id")]
    if "b2g" in keys:
        cols.append(F.col("w.b2g_id").alias("b2g_id"))
    cols += [F.col("_k_name").alias("canon_name"), F.col("w.t").alias("certification_type"),
             F.col("w.s").alias("certification_status")]
    out = best.select(*cols)
    if active_only:
        out = out.filter(F.col("certification_status") == "Active")
    return out


def with_row_id(df: DataFrame, name: str = "row_id", order_by: list | None = None) -> DataFrame:
    """A stable id per row.

    With ``order_by`` the id is the dense 1-based position in that total order
    (a global sort, range-partitioned — no single-partition window).  Without
    it the id is ``monotonically_increasing_id`` made stable by writing the
    frame as a table in the shared checkpoint folder, since recomputation
    could otherwise renumber rows.
    """
    from spendmatch.session import materialize
    if order_by:
        # read twice (counts and rows): a written copy pins the sampled range
        # boundaries and ids so both reads agree even if a stage is recomputed
        ranked = materialize(df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
                               .withColumn("_pid", F.spark_partition_id())
                               .withColumn("_local", F.monotonically_increasing_id()))
        # offsets per partition from a tiny per-partition count table
        counts = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_first"))
        from pyspark.sql import Window as W
        counts = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
            W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        j = ranked.join(F.broadcast(counts.select("_pid", "_off", "_first")), "_pid")
        return j.withColumn(name, F.col("_off") + F.col("_local") - F.col("_first") + 1) \
                .drop("_pid", "_local", "_off", "_first")
    return materialize(df.withColumn(name, F.monotonically_increasing_id()))


def spread(key: Column | str, row: list[str]) -> Column:
    """The join key of a row; without one, a value that no dimension holds, dealt by the row's content.

    Rows with a NULL key match nothing, but an outer join would send them all
    to one task.  ``key`` must be a string.
    """
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(key, F.concat(F.lit("\x00"), F.pmod(F.xxhash64(*row), F.lit(4096)).cast("string")))


@dataclass
class Step:
    """One cascade step: rows whose ``row_key`` equals the dimension's ``dim_key``."""
    method: str
    row_key: Column
    dim: DataFrame
    dim_key: str


def cascade(rows: DataFrame, steps: list[Step], carry: list[str], method_col: str = "match_method",
            unmatched: str | None = UNMATCHED, hot_share: float | None = None) -> DataFrame:
    """Priority match cascade by row identity.

    Every input row comes out once per match of the first step that matches
    it (fan-out kept, T15), or once with NULL dimension columns and
    ``unmatched``.  ``carry`` names the dimension columns to attach (all
    dimensions of a cascade must expose them).  The dimension key must be
    non-NULL to match; NULL row keys never match (SQL ``=``).

    ``hot_share`` salts the row keys that hold that share of the rows or more
    (:mod:`spendmatch.operators.skew`), at the cost of one sketch per step;
    without it AQE splits the partitions of hot keys where it can.
    """
    from spendmatch.operators.skew import hot_keys, repeat_rows, salt_rows

    row_cols = rows.columns
    j, missed = rows, F.lit(True)
    carried: dict[str, list[Column]] = {c: [] for c in carry}
    methods: list[Column] = []
    for k, st in enumerate(steps):
        d = st.dim.filter(F.col(st.dim_key).isNotNull()).select(
            F.col(st.dim_key).alias(f"_dk{k}"), *[F.col(c).alias(f"_d{k}_{c}") for c in carry])
        # a row that an earlier step matched has no key here, so it passes through once
        key, same = spread(F.when(missed, st.row_key), row_cols), F.lit(True)
        if hot_share:
            hot = hot_keys(rows, st.row_key, hot_share)
            j = salt_rows(j, key, hot, f"_s{k}")
            d = repeat_rows(d, F.col(f"_dk{k}"), hot, f"_t{k}")
            same = F.col(f"_s{k}") == F.col(f"_t{k}")
        j = j.join(d, (key == F.col(f"_dk{k}")) & same, "left")
        hit = F.col(f"_dk{k}").isNotNull()
        for c in carry:
            carried[c].append(F.when(hit, F.col(f"_d{k}_{c}")))
        methods.append(F.when(hit, F.lit(st.method)))
        missed = missed & ~hit
    # at most one step has matched a row
    return j.select(*row_cols, *[F.coalesce(*carried[c]).alias(c) for c in carry],
                    F.coalesce(*methods, F.lit(unmatched)).alias(method_col))
