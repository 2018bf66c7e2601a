"""Domain tables derived from the TPC-H-style test data (FIXTURES.md §1).

The source system ships no data, so its inputs (certified-vendor directory,
contract payments, agency/college spend, the sheet-sync pair, geographical
districts, fixed-width lines) are derived with closed-form rules from the
driver's parquet tables.  Every recipe is a lazy DataFrame over the given
tables, so its size grows with the scale factor; the same rules are written
in DuckDB SQL in :mod:`spendmatch.oracle` for the correctness check.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendmatch.session import bounded_broadcast
from spendmatch.sources.tables import read_table

# Fixed values of the recipes (FIXTURES.md): the four business-name forms, the
# certification cycle (index 7 is NULL), and the vendor-type labels.
CERT_CYCLE = ["MBE", "MWBE", "WBE", "CBE", "SEDBE", "VOB", "DBE", None]
SOURCE_AGENCY = "Agency"
SOURCE_HIGHER_ED = "Higher Ed"
STATUS_EXPIRED = "Expired"
STATUS_ACTIVE = "Active"
PRIME_LABEL = " Prime "
SUB_LABEL = "sub"
SUBCONTRACTOR_LABEL = "Subcontractor"
PAYMENT_PRIME = "PRIME"
PAYMENT_SUB = "SUB"
EXTRA_NAME_PREFIX = "Other "
EXTRA_CERT = "WBE"
VENDOR_NUMBER_BASE = 5000
TAX_ID_BASE = 100000000
DISTRICT_PREFIX = "District "
SPLIT_CYCLE = [None, "Split", "Whole"]


_STORED: dict[tuple, DataFrame] = {}
RECIPES = {}


def stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A recipe's table written once per session and scale factor, then scanned.

    The derived inputs stand in for stored source tables (the synced sheets),
    so queries read them as tables instead of re-deriving the recipe joins in
    every plan.  The copy lives in the shared checkpoint folder.
    """
    from spendmatch.session import materialize
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        _STORED[key] = materialize(RECIPES[name](spark, sf_dir), name=f"src-{name}")
    return _STORED[key]


def name_form(name: Column, k: Column) -> Column:
    """Business-name variant ``k`` (0..3) of a supplier name."""
    return (F.when(k == 0, F.concat(name, F.lit(", LLC")))
            .when(k == 1, F.concat(name, F.lit(" Inc.")))
            .when(k == 2, F.upper(name))
            .otherwise(F.concat(F.lit("  "), name, F.lit(" "))))


def cert_of(k: Column) -> Column:
    expr = None
    for i, cert in enumerate(CERT_CYCLE):
        if cert is None:
            continue
        expr = F.when(k == i, cert) if expr is None else expr.when(k == i, cert)
    return expr


def supplier_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier key, name, vendor-system number and tax id as the directory has them."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    k = F.col("s_suppkey")
    return s.select(
        k, "s_name",
        F.when(k % 6 == 0, F.lit("")).otherwise((k + VENDOR_NUMBER_BASE).cast("string")).alias("vnum"),
        F.when(k % 5 == 0, F.lit(" ")).when(k % 11 == 0, F.lit(None).cast("string"))
         .otherwise((k + TAX_ID_BASE).cast("string")).alias("vtax"))


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Certified-vendor directory: one row per supplier plus extra certifications."""
    s = supplier_ids(spark, sf_dir)
    k = F.col("s_suppkey")
    base = s.select(
        F.concat(F.lit("U"), k.cast("string")).alias("uniqueid"),
        F.col("vnum").alias("b2gnow_vendor_number"),
        F.col("vtax").alias("tax_id"),
        name_form(F.col("s_name"), k % 4).alias("business_name"),
        cert_of(k % 8).alias("certification_type"),
        F.when(k % 3 == 0, F.lit(STATUS_EXPIRED)).otherwise(F.lit(STATUS_ACTIVE)).alias("certification_status"))
    second = s.filter(k % 7 == 0).select(
        F.concat(F.lit("U"), k.cast("string")), "vnum", "vtax", name_form(F.col("s_name"), k % 4),
        cert_of((k + 3) % 8), F.lit(STATUS_ACTIVE))
    third = s.filter(k % 13 == 0).select(
        F.concat(F.lit("U"), k.cast("string")), "vnum", "vtax", F.concat(F.lit(EXTRA_NAME_PREFIX), F.col("s_name")),
        F.lit(EXTRA_CERT), F.lit(STATUS_ACTIVE))
    return base.unionAll(second).unionAll(third)


UNKNOWN_TAX_BASE = 700000000
OUTSIDE_PRIME = "Harbor Works "


def _order_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order key and customer nation: joined before the lines, so these are shuffled once, with the columns they have."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return o.join(c, F.col("o_custkey") == c.c_custkey).select("o_orderkey", "c_nationkey")


def agency_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agency + college spend: one row per (customer nation, supplier) with lines."""
    # money is exact before the shuffle, where it is also shorter than a double
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("l_extendedprice"))
    lines = li.join(_order_nations(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
    spend = (lines.groupBy("c_nationkey", "l_suppkey")
                  .agg(F.sum("l_extendedprice").alias("amt")))
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    s = bounded_broadcast(supplier_ids(spark, sf_dir))
    j = (spend.join(n, spend.c_nationkey == n.n_nationkey)
              .join(s, spend.l_suppkey == s.s_suppkey))
    nk, sk = F.col("n_nationkey"), F.col("s_suppkey")
    return j.select(
        (nk.cast("bigint") * 1000000 + sk).alias("row_id"),
        F.when(nk % 2 == 0, F.lit(SOURCE_AGENCY)).otherwise(F.lit(SOURCE_HIGHER_ED)).alias("source"),
        F.when(nk % 12 == 11, F.lit(None).cast("string")).otherwise(nk.cast("string")).alias("agency_number"),
        F.col("n_name").alias("agency_name"),
        name_form(F.col("s_name"), (sk + nk) % 4).alias("business_name"),
        F.when((sk + nk) % 3 == 0, F.lit(""))
         # an id the directory does not have: the row matches by name and the two ids disagree
         .when((sk + nk) % 7 == 1, (sk + UNKNOWN_TAX_BASE).cast("string")).otherwise(F.col("vtax")).alias("tax_id"),
        F.when(sk % 29 == 0, F.lit(None).cast("decimal(28,2)")).otherwise(F.col("amt")).alias("total_amount"))


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract payments (prime and subcontractor rows) with natural duplicates."""
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    sup = supplier_ids(spark, sf_dir)
    line_sup = sup.select(F.col("s_suppkey").alias("ls_key"), F.col("s_name").alias("ls_name"),
                          F.col("vnum").alias("ls_vnum"), F.col("vtax").alias("ls_vtax"))
    prime_sup = sup.select(F.col("s_suppkey").alias("ps_key"), F.col("s_name").alias("ps_name"))
    # prime supplier = supplier number (order key mod supplier count); the count
    # is an uncorrelated scalar subquery evaluated once, not a cross join.
    n_sup = read_table(spark, sf_dir, "supplier").select(F.nullif(F.count(F.lit(1)), F.lit(0))).scalar()
    # what hangs on the order is joined to the orders, so the lines are shuffled once
    orders = _order_nations(spark, sf_dir)
    orders = (orders.join(n, orders.c_nationkey == n.n_nationkey)
                    .join(bounded_broadcast(prime_sup), F.pmod(F.col("o_orderkey"), n_sup) == F.col("ps_key"), "left")
                    .select("o_orderkey", "n_name", "ps_name"))
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(18,2)").alias("l_extendedprice"),
        "l_shipdate")
    j = (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(bounded_broadcast(line_sup), F.col("l_suppkey") == F.col("ls_key")))
    ln, pk = F.col("l_linenumber"), F.col("l_partkey")
    out = j.select(
        F.when(pk % 4 == 0, F.lit(" ")).otherwise(F.col("ls_vnum")).alias("b2gnow_id"),
        # some primes are no agency's vendor
        F.when(F.col("l_orderkey") % 31 == 7, F.concat(F.lit(OUTSIDE_PRIME), (F.col("l_orderkey") % 5).cast("string")))
         .otherwise(F.col("ps_name")).alias("prime_vendor"),
        F.col("n_name").alias("contract_holder"),
        F.when(ln == 1, F.col("ps_name")).otherwise(name_form(F.col("ls_name"), ln % 3)).alias("business_name"),
        F.when(ln == 1, F.lit(PRIME_LABEL)).when(ln == 2, F.lit(SUB_LABEL))
         .otherwise(F.lit(SUBCONTRACTOR_LABEL)).alias("vendor_type"),
        F.when(ln == 1, F.lit(PAYMENT_PRIME)).otherwise(F.lit(PAYMENT_SUB)).alias("payment_type"),
        F.when(pk % 50 == 0, F.lit(None).cast("decimal(18,2)"))
         .otherwise(F.col("l_extendedprice")).alias("amount_paid"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("audit_period"),
        F.when(pk % 3 == 0, F.lit("")).otherwise(F.col("ls_vtax")).alias("taxidnumber"),
        F.col("l_orderkey"))
    # exact copies of some rows: identical natural keys exercise the n^2 join
    copies = F.when(F.col("l_orderkey") % 97 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return out.select("*", F.explode(copies).alias("_copy")).drop("l_orderkey", "_copy")


# ---------------------------------------------------------------- sheet sync
SYNC_RUN_TS = "2025-01-02 03:04:05"      # the run's "now" in fixture runs
SYNC_OLD_TS = "2024-01-01 00:00:00"      # audit stamps already in the target
SYNC_DELETED_KEY_BASE = 1000000


def sync_incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming sheet rows; every 101st customer has a blank key (reject)."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        F.when(k % 101 == 0, F.lit("")).otherwise(k.cast("string")).alias("c_custkey"),
        "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def raw_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet as typed by hand: spaced headers, padded text, NaN, doubles for integers, some keys twice."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    last = c.select(
        F.when(k % 101 == 0, F.lit(" ")).otherwise(F.concat(F.lit(" "), k.cast("string"), F.lit("\t"))).alias(" C Custkey"),
        F.concat(F.col("c_name"), F.lit("  ")).alias("C Name"), F.col("c_nationkey").cast("double").alias("C Nationkey "),
        F.when(k % 9 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("c Acctbal"),
        F.concat(F.lit(" "), F.col("c_mktsegment")).alias("C MKTsegment"), F.lit(2).alias("Sheet Row"))
    first = last.filter(k % 11 == 0).withColumns({"C Name": F.lit("replaced"), "Sheet Row": F.lit(1)})
    return last.unionAll(first)


def sync_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing table state: some rows missing, some changed, stale and frozen rows."""
    from spendmatch.functions.hashing import row_hash
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    data_cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    kept = c.filter(k % 7 != 0).select(
        k.cast("string").alias("c_custkey"), "c_name", "c_nationkey",
        F.when(k % 5 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        "c_mktsegment", (k % 53 == 0).alias("_frozen"))
    stale = c.filter(k % 10 == 3).select(
        (k + SYNC_DELETED_KEY_BASE).cast("string").alias("c_custkey"), "c_name", "c_nationkey", "c_acctbal",
        "c_mktsegment", F.lit(False).alias("_frozen"))
    t = kept.unionAll(stale)
    h = row_hash(t, data_cols)
    return t.select(*data_cols,
                    F.lit(SYNC_OLD_TS).cast("timestamp_ntz").alias("created_at"),
                    F.lit(SYNC_OLD_TS).cast("timestamp_ntz").alias("updated_at"),
                    F.when(F.col("_frozen"), F.lit(None).cast("string")).otherwise(h).alias("row_hash"))


# ------------------------------------------------------------------ districts
def districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        F.concat(F.lit(DISTRICT_PREFIX), F.col("c_nationkey").cast("string")).alias("district"),
        k.cast("string").alias("zipcode"),
        F.when(k % 3 == 1, F.lit("Split")).when(k % 3 == 2, F.lit("Whole"))
         .otherwise(F.lit(None).cast("string")).alias("split_whole_combined"))


# ---------------------------------------------------------- fixed-width lines
def fixed_width_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """College payment report lines built from ``lineitem ⋈ supplier``.

    Five shapes by order key: spaced, packed with implied cents, missing the
    two-letter code (reject), padded with whitespace, and blank (skipped).
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey",
                                                      "l_extendedprice")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    j = li.join(s, li.l_suppkey == s.s_suppkey)
    college = F.lpad(F.col("l_linenumber").cast("string"), 4, "0")
    tax = F.lpad((F.col("s_suppkey") + TAX_ID_BASE).cast("string"), 9, "0")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    cents = F.lpad((price * 100).cast("decimal(18,0)").cast("string"), 13, "0")
    spaced = F.concat(F.lit("1"), college, F.col("s_name"), F.lit(" "), tax, F.lit(" AB "),
                      price.cast("string"), F.lit(" 2513"))
    shape = F.col("l_orderkey") % 5
    value = (F.when(shape == 0, spaced)
             .when(shape == 1, F.concat(F.lit("2"), college, F.col("s_name"), F.lit(" "), tax, F.lit("XY"),
                                        cents, F.lit("2513")))
             .when(shape == 2, F.concat(F.lit("1"), college, F.col("s_name"), F.lit(" "), tax, F.lit(" 99 "),
                                        price.cast("string"), F.lit(" 2513")))
             .when(shape == 3, F.concat(F.lit("  "), spaced, F.lit("\t ")))
             .otherwise(F.lit("")))
    return j.select(F.concat(F.lit("file_"), (F.col("l_orderkey") % 4).cast("string")).alias("file_stem"),
                    F.col("l_orderkey"), F.col("l_linenumber"), value.alias("value"))


RANGE_LINES = 500_000   # lines that one task sorts


def report_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The report lines as files ``<file_stem>.txt`` under ``folder``, in the order of order key, line number and text.

    Lines are sorted in ranges of about ``RANGE_LINES``, so what a task sorts does
    not grow with the reports; a report's ranges are then copied in their order into its file.
    """
    from concurrent.futures import ThreadPoolExecutor

    order = ["file_stem", "l_orderkey", "l_linenumber", "value"]
    lines = fixed_width_lines(spark, sf_dir)
    # a given number of ranges is neither merged nor bounded by the shuffle partitions
    ranges = max(spark.sparkContext.defaultParallelism, read_table(spark, sf_dir, "lineitem").count() // RANGE_LINES + 1)
    lines.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("file_stem", "value").write.partitionBy("file_stem").text(
        f"{folder}-parts")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(path(folder))
    parts: dict[str, list[str]] = {}
    for status in fs.globStatus(path(f"{folder}-parts/file_stem=*/part-*.txt")):
        stem = status.getPath().getParent().getName().removeprefix("file_stem=")
        parts.setdefault(stem, []).append(status.getPath().toString())

    def joined(stem: str) -> None:
        whole = reduce(DataFrame.unionAll, [spark.read.text(p) for p in sorted(parts[stem])])   # part numbers are the ranges' order
        whole.coalesce(1).write.text(f"{folder}-whole/{stem}")

    with ThreadPoolExecutor(4) as pool:   # four files at any scale
        list(pool.map(joined, parts))
    for stem in parts:
        for status in fs.globStatus(path(f"{folder}-whole/{stem}/part-*.txt")):
            fs.rename(status.getPath(), path(f"{folder}/{stem}.txt"))


RECIPES.update({"vendors": vendors, "contracts": contracts, "agency_spend": agency_spend,
                "sync_incoming": sync_incoming, "sync_target": sync_target, "districts": districts,
                "fixed_width_lines": fixed_width_lines})
