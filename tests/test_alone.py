"""Rows alone in their group stay out of the shuffles of M1 and of the totals; building the inputs shuffles the lines once."""

import glob
import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spendmatch.functions import text
from spendmatch.operators import groups
from spendmatch.plans import marts
from spendmatch.plans.pipeline import SpendMarts
from spendmatch.session import materialize, materialize_bucketed
from spendmatch.sources import fixtures as fx

VENDORS = ("uniqueid string, b2gnow_vendor_number string, tax_id string, business_name string, certification_type string, "
           "certification_status string")
CONTRACTS = ("b2gnow_id string, prime_vendor string, contract_holder string, business_name string, vendor_type string, "
             "payment_type string, amount_paid double, audit_period string, taxidnumber string")


def _vendors(spark):
    return spark.createDataFrame([
        ("U1", "51", "111", "Acme", "MBE", "Active"), ("U1", "51", "111", "Other Acme", "MBE", "Active"),
        ("U2", "52", " ", "Birch", "WBE", "Active"), ("U3", "", "333", "Birch", None, "Active"),
        ("U4", "54", "444", "Cedar", "DBE", "Expired")], VENDORS)


def _contracts(spark):
    rows = []
    for i, (b2g, name, tax) in enumerate((b, n, t) for b in ("51", "52", " ", None) for n in ("Acme, LLC", "Birch", "Cedar", None)
                                         for t in ("111", "333", "444", "", None)):
        rows.append((b2g, "Prime", "Agency", name, "sub", "SUB", float(i), "2024-01-01", tax))   # a natural key of its own
        rows.append((b2g, "Prime", "Agency", name, "sub", "SUB", 7.5, "2024-01-02", tax))        # one that others share
        rows.append((b2g, "Prime", None, name, "sub", "SUB", None if i % 2 else 1.5, None, tax))
    return spark.createDataFrame(rows, CONTRACTS).withColumns(
        {"amount_paid": F.col("amount_paid").cast("decimal(18,2)"), "audit_period": F.col("audit_period").cast("timestamp_ntz")})


def _bag(df):
    return Counter(map(tuple, df.select(*sorted(df.columns)).collect()))


def test_contract_cert_split_and_whole_agree(spark):
    vendors, contracts = _vendors(spark), _contracts(spark)
    whole = marts.contract_cert_weighted(vendors, contracts)
    split = marts.contract_cert_weighted(vendors, contracts, keep=materialize)
    assert split.schema.simpleString() == whole.schema.simpleString()
    assert _bag(split) == _bag(whole) and {r.match_method_cert for r in split.collect()} == {"tax_id", "b2g_id", "name", "unmatched"}
    for version in (1, 2):
        a, b = marts.contract_totals(whole, version), marts.contract_totals(materialize(split), version, keep=materialize)
        assert a.schema.simpleString() == b.schema.simpleString() and _bag(a) == _bag(b)


def _primes(spark):
    rows = [("Agency", str(n), f"Agency {n % 3}", f"Prime {n % 20}" if n % 7 else None, str(n) if n % 4 else None,
             "MBE" if n % 2 else None, "111", "name", float(n)) for n in range(60)]
    return spark.createDataFrame(rows, "source string, agency_number string, agency_name string, prime_vendor string, tax_id string, "
                                 "prime_certification_type string, matched_tax_id string, match_method string, prime_total_amount double")


def test_primes_and_subs_meet_in_buckets(spark):
    totals = spark.createDataFrame(
        [(str(n), f"prime {n % 23}, LLC" if n % 11 else None, f"Agency {n % 4}", f"Sub {n}", "SUB", "111" if n % 5 else None, "MBE" if n % 3 else None,
          None, None, "name", "2024-01-01", float(n)) for n in range(400)],
        "b2g_id string, prime_vendor string, agency_name string, business_name string, vendor_type string, tax_id string, "
        "certification_type string, matched_tax_id string, matched_b2g_id string, match_method_cert string, audit_period string, total_amount double")
    totals = totals.withColumns({"audit_period": F.col("audit_period").cast("timestamp_ntz"), "total_amount": F.col("total_amount").cast("decimal(38,2)")})
    p, s = marts.primes_canon(_primes(spark)), marts.subs_canon(totals)
    bp = materialize_bucketed(p, ["canon_prime_vendor", "canon_agency_name"], 5)
    bs = materialize_bucketed(s, ["s_canon_prime", "s_canon_agency"], 5)
    assert _bag(bp) == _bag(p) and _bag(bs) == _bag(s)                # rows without a name too
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("buckets_")]
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(old, ("-1", "false")):
            spark.conf.set(k, v)
        for mode in ("rows", "any_cert", "qualifying", "tax_then_name"):
            got = marts.prime_with_subs(bp, bs, mode)
            assert _bag(got) == _bag(marts.prime_with_subs(p, s, mode))
            if mode != "tax_then_name":                               # subs stay where they are
                assert "s_canon_prime" not in "".join(re.findall(r"Exchange [^\n]*", got._jdf.queryExecution().executedPlan().toString()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_marts_store_no_second_copy_of_the_contracts(spark):
    m = SpendMarts(_vendors(spark), _contracts(spark), spark.createDataFrame([], "agency_name string"))
    m.contract_totals.count()
    stored = [spark.read.parquet(t).columns for t in m._tables]
    assert not [c for c in stored if "canon_name" in c and "contract_holder" in c]
    m.release()


def _shared_key(spark, n):
    """n vendors, n prime rows and n subcontractor rows of one natural key each; the first rows also share their totals' group."""
    vendors = spark.createDataFrame([(f"U{k}", str(50 + k // 2), str(100 + k), f"Firm {k}", "MBE" if k % 2 else "WBE", "Active") for k in range(n)], VENDORS)
    rows = [(str(50 + k // 2) if k % 3 else None, "Firm 1", "Agency", "Firm 1" if kind == "PRIME" else "Firm 2, LLC", f" {kind.lower()} ", kind, 2.0,
             "2024-01-01", str(100 + k) if k % 2 else " ") for k in [*range(n), 0, 1] for kind in ("PRIME", "SUB")]
    rows += [(None, "Firm 1", "Agency", "Firm 1", "prime", "PRIME", amount, f"2024-0{month}-01", None) for amount in (2.0, 3.5, None) for month in (1, 2)]
    contracts = spark.createDataFrame(rows, CONTRACTS).withColumns(
        {"amount_paid": F.col("amount_paid").cast("decimal(18,2)"), "audit_period": F.col("audit_period").cast("timestamp_ntz")})
    spend = spark.createDataFrame([("Agency", "1", "Agency", f"Firm {k % 5}", str(100 + k), float(k)) for k in range(9)],
                                  "source string, agency_number string, agency_name string, business_name string, tax_id string, total_amount double")
    return vendors, contracts, spend.withColumn("total_amount", F.col("total_amount").cast("decimal(28,2)"))


def _stored_rows(spark, m):
    return max(spark.read.parquet(t).count() for t in m._tables)


def test_totals_of_a_shared_key_store_no_pairs(spark):
    n = 40
    inputs = _shared_key(spark, n)
    cert = materialize(marts.contract_cert_weighted(*inputs[:2]))
    m = SpendMarts(*inputs)
    for version, got in ((1, m.contract_totals_v1), (2, m.totals(2))):
        got = _bag(got)
        assert got == _bag(marts.contract_totals(cert, version)) and sum(got.values()) > n * n / 2
    assert _stored_rows(spark, m) < 5 * n                            # rows and matches, not the pairs of them
    m.release()


def test_marts_of_subcontractors_build_no_prime_totals(spark):
    n = 40
    vendors, contracts, spend = _shared_key(spark, n)
    contracts = materialize(contracts.where("payment_type = 'PRIME' or amount_paid is null or taxidnumber = '101'"))
    apart, table = SpendMarts(vendors, contracts, spend), SpendMarts(vendors, contracts, spend)
    assert table.contract_totals.count() > n * n / 2                 # a stored M3 is read where there is one
    for mart in (lambda m: m.prime_with_subs("any_cert"), lambda m: m.prime_cert_summary, lambda m: m.unmatched_contract_primes):
        got = _bag(mart(apart))
        assert got == _bag(mart(table))
    assert _stored_rows(spark, apart) < 10 * n
    apart.release()
    table.release()


def test_split_shared(spark):
    rows = materialize(spark.range(3000).select("id", F.when(F.col("id") < 2900, F.col("id")).when(F.col("id") < 2990, F.lit(7)).alias("k")))
    alone, several = groups.split_shared(rows, F.xxhash64("k") + F.when(F.col("k").isNotNull(), 0), materialize)
    assert _bag(alone.union(several)) == _bag(rows)
    assert Counter(r.k for r in several.collect())[7] == 91           # each that shares a key
    assert several.count() < 200                                      # and few others
    assert alone.where("k is null").count() == 10


@pytest.fixture()
def source(spark, tmpdir_path):
    n, part = 40, 7
    k = F.col("id")
    spark.range(3).select(k.cast("int").alias("n_nationkey"), F.concat(F.lit("N"), k).alias("n_name")).write.parquet(f"{tmpdir_path}/nation.parquet")
    spark.range(n).select(k.alias("s_suppkey"), F.concat(F.lit("Supplier "), k).alias("s_name")).write.parquet(f"{tmpdir_path}/supplier.parquet")
    spark.range(n).select(k.alias("c_custkey"), (k % 3).cast("int").alias("c_nationkey")).write.parquet(f"{tmpdir_path}/customer.parquet")
    spark.range(500).select(k.alias("o_orderkey"), (k % n).alias("o_custkey")).write.parquet(f"{tmpdir_path}/orders.parquet")
    spark.range(2000).select((k % 500).alias("l_orderkey"), k.alias("l_partkey"), (k % n).alias("l_suppkey"), (k % part).cast("int").alias(
        "l_linenumber"), (k + 0.5).alias("l_extendedprice"), F.lit("2024-01-01").cast("timestamp").alias("l_shipdate")).write.parquet(
        f"{tmpdir_path}/lineitem.parquet")
    return tmpdir_path


def test_lines_are_shuffled_once(spark, source):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(old, ("-1", "false")):
            spark.conf.set(k, v)
        for recipe, other in ((fx.contracts, 0), (fx.agency_spend, 1)):   # spend is then summed by nation and supplier
            plan = recipe(spark, source)._jdf.queryExecution().executedPlan().toString()
            assert len(re.findall(r"Exchange hashpartitioning\(l_orderkey", plan)) == 1
            assert len(re.findall(r"Exchange hashpartitioning\([^)]*l_suppkey", plan)) == other
            assert "BroadcastExchange" in plan                            # the suppliers, by their counted rows
        rows = fx.contracts(spark, source)
        assert rows.count() == 2000 + 6 * 4                               # orders 0, 97, ... come twice
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_report_files_are_sorted_in_ranges(spark, source):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(old, ("16", "false")):
            spark.conf.set(k, v)
        fx.report_files(spark, source, f"{source}/reports")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = {}
    for r in sorted(fx.fixed_width_lines(spark, source).collect(), key=lambda r: (r.l_orderkey, r.l_linenumber, r.value)):
        want.setdefault(f"{r.file_stem}.txt", []).append(r.value)
    got = {os.path.basename(p): open(p).read().split("\n")[:-1] for p in glob.glob(f"{source}/reports/*.txt")}
    assert got == want and len(got) == 4
    assert len(glob.glob(f"{source}/reports-parts/file_stem=file_1/part-*.txt")) > 1   # no task sorts a whole report


def test_ranges_grow_with_the_lines_not_with_their_bytes(spark, source, monkeypatch):
    monkeypatch.setattr(fx, "RANGE_LINES", 50, raising=False)
    fx.report_files(spark, source, f"{source}/reports")   # merging small shuffle partitions is on
    lines = Counter()
    for p in glob.glob(f"{source}/reports-parts/file_stem=*/part-*.txt"):
        lines[os.path.basename(p)[:10]] += len(open(p).read().split("\n")) - 1
    assert sum(lines.values()) == 2000 and max(lines.values()) <= 4 * 50   # bounds come from a sample


def test_inputs_that_no_mart_reads_are_not_built(spark, source, monkeypatch):
    built = []
    monkeypatch.setattr(fx, "stored", lambda spark, d, name: built.append(name) or materialize(fx.RECIPES[name](spark, d)))
    m = SpendMarts.from_tables(spark, source)
    assert m.agency_cert.count() > 0 and sorted(built) == ["agency_spend", "vendors"]
    assert m.contract_cert.count() > 0 and sorted(built) == ["agency_spend", "contracts", "vendors"]   # each once, when it is read
    m.release()


def test_names_lose_the_same_characters(spark):
    names = ["Acme, LLC", "a\x00b", "\u00e9 \u00df-x", "\u65e5\u672c Co., \U0001f600 ltd", "a\x7f\n\t~b_C#[]^`{}", "  two  spaces ", "", None,
             *map(chr, range(1, 400)), *[f"A{chr(c)}1 {chr(c)}z" for c in range(400)]]
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    whole = F.regexp_replace(text.norm_label("n"), text.CANON_A_KEEP, "")
    assert rows.where(~text._kept(text.norm_label("n")).eqNullSafe(whole)).count() == 0
    plain = F.regexp_replace(F.regexp_replace(whole, " {2,}", " "), text.CANON_A_SUFFIX, "")
    assert rows.where(~text.canon_name_a("n").eqNullSafe(plain)).count() == 0
