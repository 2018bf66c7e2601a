"""Data-quality reports over the marts.

Top-k reports keep their LIMIT (the limit is the feature) and add explicit
tie-break columns so every run returns the same rows; Spark executes them as
``TakeOrderedAndProject`` (per-partition top-k, then a final merge — never a
global sort of the input).  Window-style counts are computed as a grouped
aggregate joined back, so a hot key is pre-aggregated map-side instead of
being sorted whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendmatch.functions.text import blank_to_null, canon_name_a, pct

AGENCY_ROW_COLS = ["agency_number", "agency_name", "business_name", "tax_id"]


def _top(df: DataFrame, k: int, by: str, tie: list[str]) -> DataFrame:
    """ORDER BY ``by`` DESC NULLS LAST, then ``tie`` ASC NULLS LAST, LIMIT k (O1/O2)."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie]).limit(k)


def duplicate_business_rows(agency_cert: DataFrame) -> DataFrame:
    """Agency rows repeated on (agency number, agency, business, tax id)."""
    return (agency_cert.groupBy(*AGENCY_ROW_COLS).agg(F.count(F.lit(1)).alias("dup_count"))
                       .filter(F.col("dup_count") > 1))


def count_by(df: DataFrame, col: str, name: str = "rows") -> DataFrame:
    """Rows per value, ordered ascending with NULLs last."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(F.col(col).asc_nulls_last())


def top_unmatched_rows(agency_cert: DataFrame, k: int = 50) -> DataFrame:
    """D3: the k largest unmatched rows."""
    rows = agency_cert.filter(F.col("match_method") == "unmatched").select(*AGENCY_ROW_COLS, "total_amount")
    return _top(rows, k, "total_amount", AGENCY_ROW_COLS)


def coverage(agency_cert: DataFrame) -> DataFrame:
    """Total rows, matched rows and matched percentage."""
    matched = F.sum(F.when(F.col("match_method") != "unmatched", 1).otherwise(0))
    g = agency_cert.agg(F.count(F.lit(1)).alias("total_rows"), matched.cast("bigint").alias("matched_rows"))
    return g.select("total_rows", "matched_rows",
                    pct(F.col("matched_rows"), F.col("total_rows")).cast("double").alias("matched_pct"))


def _ids_differ(df: DataFrame) -> DataFrame:
    return df.filter(F.col("match_method").isin("tax_id", "name")
                     & blank_to_null("tax_id").isNotNull()
                     & blank_to_null("matched_tax_id").isNotNull()
                     & (F.trim(F.col("tax_id").cast("string")) != F.trim(F.col("matched_tax_id"))))


def tax_id_disagreements(agency_cert: DataFrame, k: int = 200) -> DataFrame:
    """Both sides carry a tax id but they differ (why a name matched)."""
    rows = _ids_differ(agency_cert).select(
        *AGENCY_ROW_COLS[:3], F.col("tax_id").alias("he_tax_id"), F.col("matched_tax_id").alias("vendor_tax_id"),
        "certification_type", "match_method", "total_amount")
    return _top(rows, k, "total_amount", ["agency_number", "agency_name", "business_name", "he_tax_id",
                                          "vendor_tax_id", "certification_type", "match_method"])


def tax_match_without_tax_id(agency_cert: DataFrame) -> DataFrame:
    """Tax-id matches whose own tax id is blank (expected 0)."""
    return (agency_cert.filter((F.col("match_method") == "tax_id") & blank_to_null("tax_id").isNull())
                       .agg(F.count(F.lit(1)).alias("tax_match_but_he_tax_missing")))


def name_matches_with_tax_id(agency_cert: DataFrame, k: int = 200) -> DataFrame:
    """Name matches although the row has a tax id."""
    rows = agency_cert.filter((F.col("match_method") == "name") & blank_to_null("tax_id").isNotNull()).select(
        *AGENCY_ROW_COLS, "matched_tax_id", "certification_type", "total_amount")
    return _top(rows, k, "total_amount", AGENCY_ROW_COLS + ["matched_tax_id", "certification_type"])


def name_matches_without_vendor_tax(agency_cert: DataFrame, k: int = 200) -> DataFrame:
    """Name matches whose vendor has no tax id.  The source's LIMIT has no
    ORDER BY (O3); we order by all columns so the sample is reproducible."""
    cols = AGENCY_ROW_COLS + ["matched_tax_id", "certification_type"]
    rows = agency_cert.filter((F.col("match_method") == "name") & F.col("matched_tax_id").isNull()).select(*cols)
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in cols]).limit(k)


def top_unmatched_vendors(agency_cert: DataFrame, k: int = 50) -> DataFrame:
    """Unmatched spend per (business, tax id), top k."""
    g = (agency_cert.filter(F.col("match_method") == "unmatched").groupBy("business_name", "tax_id")
                    .agg(F.sum("total_amount").alias("total_unmatched_amount"), F.count(F.lit(1)).alias("rows")))
    return _top(g, k, "total_unmatched_amount", ["business_name", "tax_id"])


def top_tax_disagreements(agency_cert: DataFrame, k: int = 50) -> DataFrame:
    """Spend at issue per (business, row tax id, vendor tax id), top k."""
    g = (_ids_differ(agency_cert)
         .select("business_name", F.col("tax_id").cast("string").alias("he_tax_id"), "matched_tax_id", "total_amount")
         .groupBy("business_name", "he_tax_id", "matched_tax_id")
         .agg(F.sum("total_amount").alias("amount_at_issue"), F.count(F.lit(1)).alias("rows")))
    return _top(g, k, "amount_at_issue", ["business_name", "he_tax_id", "matched_tax_id"])


def lookalike_transactions(agency_cert: DataFrame, strip_suffix: bool = True) -> DataFrame:
    """Rows sharing canonical name and amount with another row.

    ``COUNT(*) OVER (PARTITION BY canon, amount)`` as a grouped count joined
    back on the same keys (NULL-safe, as window partitions group NULLs).
    """
    a = agency_cert.withColumn("canon_name", canon_name_a("business_name", strip_suffix))
    counts = (a.groupBy(F.col("canon_name").alias("_c"), F.col("total_amount").alias("_t"))
               .agg(F.count(F.lit(1)).alias("dupe_count")).filter(F.col("dupe_count") > 1))
    j = a.join(counts, F.col("canon_name").eqNullSafe(F.col("_c")) & F.col("total_amount").eqNullSafe(F.col("_t")))
    return (j.drop("_c", "_t")
             .orderBy(F.col("canon_name").asc_nulls_last(), F.col("total_amount").asc_nulls_last(),
                      F.col("business_name").asc_nulls_last()))


def summary_sanity(summary: DataFrame, contract_summary: DataFrame) -> DataFrame:
    """Match counts of the prime summary + size of the contract summary."""
    mm = F.col("match_method")
    g = summary.agg(F.count_if(mm == "tax_id").alias("matched_by_tax_id"),
                    F.count_if(mm == "name").alias("matched_by_name"),
                    F.count_if(mm.isNull()).alias("no_match"),
                    F.count(F.lit(1)).alias("total_in_agency_higher_ed"))
    # uncorrelated scalar subquery, evaluated once
    n = contract_summary.select(F.count(F.lit(1))).scalar()
    return g.select("*", n.alias("total_in_contract_summary"))


def is_duplicate_combo(df: DataFrame, cols: list[str], name: str = "is_duplicate",
                       label: bool = False) -> DataFrame:
    """COUNTIFS(a, b) > 1 per row, as boolean or 'Duplicate'/'Unique'.

    Counted with a grouped aggregate joined back (NULL-safe), so no window
    sorts a hot combination in one task.
    """
    keys = [f"_k{i}" for i in range(len(cols))]
    counts = df.groupBy(*[F.col(c).alias(k) for c, k in zip(cols, keys)]).agg(F.count(F.lit(1)).alias("_n"))
    cond = None
    for c, k in zip(cols, keys):
        e = F.col(c).eqNullSafe(F.col(k))
        cond = e if cond is None else cond & e
    j = df.join(counts, cond)
    flag = F.col("_n") > 1
    if label:
        flag = F.when(flag, F.lit("Duplicate")).otherwise(F.lit("Unique"))
    return j.withColumn(name, flag).drop(*keys, "_n")


def count_repeated_values(df: DataFrame, col: str) -> DataFrame:
    """Number of distinct values that occur more than once.

    Spreadsheet ``COUNTIF`` compares case-insensitively, so values are
    upper-cased; blanks are ignored (T12).
    """
    v = F.upper(F.col(col).cast("string"))
    g = (df.filter(blank_to_null(col).isNotNull()).groupBy(v.alias("_v"))
           .agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1))
    return g.agg(F.count(F.lit(1)).alias("repeated_values"))


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Drop rows whose cells are all NULL or empty text."""
    keep = None
    for f in df.schema.fields:
        c = F.col(f.name)
        e = blank_to_null(c).isNotNull() if f.dataType.simpleString() == "string" else c.isNotNull()
        keep = e if keep is None else keep | e
    return df.filter(keep) if keep is not None else df


def paginate(df: DataFrame, group: str, order: list[str], n: int = 40, name: str = "page") -> DataFrame:
    """R2: page number (``ceil(row_number / n)``) of every row within its group.

    Rows are range-partitioned by (group, order) and numbered inside each
    partition; a per-(partition, group) count table gives each partition's
    offset within the group.  A group that spans many partitions (a hot
    group) is therefore numbered by many tasks, never gathered in one.
    """
    from pyspark.sql import Window as W

    from spendmatch.session import materialize
    keys = [group] + list(order)
    # the numbered frame is read twice (counts and rows); a written table
    # pins the range boundaries and ids so both reads agree
    r = materialize(
        df.repartitionByRange(*[F.col(k).asc_nulls_last() for k in keys])
          .sortWithinPartitions(*[F.col(k).asc_nulls_last() for k in keys])
          .withColumn("_pid", F.spark_partition_id())
          .withColumn("_mid", F.monotonically_increasing_id()))
    # rows of a group inside one partition are contiguous after the local sort,
    # so (_mid - first _mid of the group in that partition) is the local index
    firsts = (r.groupBy(F.col("_pid").alias("_p"), F.col(group).alias("_g"))
               .agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_cnt")))
    wo = W.partitionBy("_g").orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    offs = firsts.withColumn("_off", F.coalesce(F.sum("_cnt").over(wo), F.lit(0))).drop("_cnt")
    j = r.join(offs, (F.col("_pid") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    rn = F.col("_off") + F.col("_mid") - F.col("_first") + 1
    return (j.withColumn(name, F.ceil(rn / F.lit(n)).cast("bigint"))
             .drop("_pid", "_mid", "_first", "_off", "_p", "_g"))
