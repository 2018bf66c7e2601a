"""Registered queries: one per SURVEY §2 operator or mart, each with its oracle SQL.

Every query reads the driver's tables through :mod:`spendmatch.sources.fixtures`
(closed-form recipes over the TPC-H-style data), so its work grows with the
scale factor.  Names carry the SURVEY id as a prefix.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendmatch import oracle as O
from spendmatch.plans import marts
from spendmatch.plans.pipeline import SpendMarts
from spendmatch.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ helpers
def _m(spark: SparkSession, d: str, **kw) -> SpendMarts:
    """A fresh pipeline per query: every query stands alone over the given tables.

    Intermediates a query reads more than once are written once as tables in
    the shared checkpoint folder (measured faster than filling a cache here).
    """
    # SPENDMATCH_KEEP=none keeps every mart lazy (e.g. to explain whole plans)
    kw.setdefault("keep", os.environ.get("SPENDMATCH_KEEP", "table"))
    return SpendMarts.from_tables(spark, d, **kw)


@register("m6_agency_cert", O.query("SELECT * FROM agency_cert", ["agency_cert"]))
def m6_agency_cert(spark: SparkSession, d: str) -> DataFrame:
    return _m(spark, d).agency_cert


@register("m1_contract_cert", O.query("SELECT * FROM contract_cert", ["contract_cert"]))
def m1_contract_cert(spark, d):
    return _m(spark, d).contract_cert


@register("m1_contract_cert_row_id", O.query("SELECT * FROM contract_cert_rowid", ["contract_cert_rowid"]))
def m1_contract_cert_row_id(spark, d):
    return _m(spark, d, contract_mode="row_id").contract_cert


@register("m2_contract_totals_v1", O.query("SELECT * FROM contract_totals1", ["contract_totals1"]))
def m2_contract_totals_v1(spark, d):
    return _m(spark, d).contract_totals_v1


@register("m3_contract_totals_v2", O.query("SELECT * FROM contract_totals2", ["contract_totals2"]))
def m3_contract_totals_v2(spark, d):
    return _m(spark, d).totals(2)   # read once, so not stored


@register("m4_contract_subs_cert_spend", O.query("SELECT * FROM contract_subs_spend", ["contract_subs_spend"]))
def m4_contract_subs_cert_spend(spark, d):
    return _m(spark, d).contract_subs


@register("m5_contract_prime_summary", O.query("SELECT * FROM contract_prime_summary", ["contract_prime_summary"]))
def m5_contract_prime_summary(spark, d):
    return _m(spark, d).contract_prime_summary


@register("m7_agency_cert_no_source", O.query("SELECT * EXCLUDE (source) FROM agency_cert", ["agency_cert"]))
def m7_agency_cert_no_source(spark, d):
    return _m(spark, d).agency_cert_no_source


# \\x08 is the backspace that \\b means to an engine without word boundaries, so no suffix is found
_LITERAL_SUFFIX = O.query("SELECT * FROM agency_cert", ["agency_cert"]).replace("'\\b(", "'\\x08(").replace(")\\b'", ")\\x08'")


@register("m6_agency_cert_literal_suffix", _LITERAL_SUFFIX)
def m6_agency_cert_literal_suffix(spark, d):
    """The suffix step as a no-op."""
    return _m(spark, d, strip_suffix=False).agency_cert


_HOT_TAX = ("(SELECT * REPLACE (CASE WHEN row_id % 3 = 0 THEN (SELECT MIN(tax_id) FROM vendors WHERE TRIM(tax_id) <> '') "
            "ELSE tax_id END AS tax_id) FROM agency_spend)")


@register("j1_heavy_hitter_cascade", O.query("SELECT * FROM agency_cert", ["vendors", "agency_cert"]).replace(
    "AS canon_name FROM agency_spend", f"AS canon_name FROM {_HOT_TAX}"))
def j1_heavy_hitter_cascade(spark, d):
    """A third of the rows share one tax id, whose join is salted."""
    vendors, spend = fx.stored(spark, d, "vendors"), fx.stored(spark, d, "agency_spend")
    hot = vendors.where("trim(tax_id) <> ''").agg(F.min("tax_id").alias("t"))
    skewed = spend.withColumn("tax_id", F.when(F.col("row_id") % 3 == 0, hot.scalar()).otherwise(F.col("tax_id")))
    return marts.agency_cert(vendors, skewed, hot_share=0.01)


@register("m8_agency_cert_flags", O.query("SELECT * FROM agency_cert_flags", ["agency_cert_flags"]))
def m8_agency_cert_flags(spark, d):
    return _m(spark, d).flags


@register("m9_prime_totals", O.query("SELECT * FROM prime_totals", ["prime_totals"]))
def m9_prime_totals(spark, d):
    return _m(spark, d).prime_totals


@register("m10_certified_spend", O.query("SELECT * FROM certified_spend", ["certified_spend"]))
def m10_certified_spend(spark, d):
    return _m(spark, d).certified_spend


@register("m11_prime_with_subs_rows", O.prime_with_subs_sql("rows"))
def m11_prime_with_subs_rows(spark, d):
    return _m(spark, d).prime_with_subs("rows")


@register("m12_prime_with_subs_any_cert", O.prime_with_subs_sql("any_cert"))
def m12_prime_with_subs_any_cert(spark, d):
    return _m(spark, d).prime_with_subs("any_cert")


@register("m13_prime_with_subs_qualifying", O.prime_with_subs_sql("qualifying"))
def m13_prime_with_subs_qualifying(spark, d):
    return _m(spark, d).prime_with_subs("qualifying")


@register("m14_prime_with_subs_tax_then_name", O.prime_with_subs_sql("tax_then_name"))
def m14_prime_with_subs_tax_then_name(spark, d):
    return _m(spark, d).prime_with_subs("tax_then_name")


@register("m15_prime_cert_summary", O.query("SELECT * FROM prime_cert_summary", ["prime_cert_summary"]))
def m15_prime_cert_summary(spark, d):
    return _m(spark, d).prime_cert_summary


@register("m16_unmatched_contract_primes",
          O.query("SELECT * FROM unmatched_contract_primes ORDER BY certified_subs_spend DESC NULLS FIRST",
                  ["unmatched_contract_primes"]))
def m16_unmatched_contract_primes(spark, d):
    return _m(spark, d).unmatched_contract_primes


_EXCL = ", ".join("'" + n.replace("'", "''") + "'" for n in marts.EXCLUDED_AGENCIES)


@register("m17_agency_filter",
          O.query(f"SELECT * FROM prime_cert_summary WHERE agency_name NOT IN ({_EXCL})", ["prime_cert_summary"]))
def m17_agency_filter(spark, d):
    return _m(spark, d).agency_filter()


# ============================================================ data quality
from spendmatch.operators import quality as Q  # noqa: E402
from spendmatch.functions import text as TX  # noqa: E402

_AC = "agency_cert"
_ROW = {c: c for c in ("agency_number", "agency_name", "business_name", "tax_id")}


@register("d1_duplicate_business_rows", O.query(
    "SELECT agency_number, agency_name, business_name, tax_id, COUNT(*) AS dup_count FROM agency_cert "
    "GROUP BY agency_number, agency_name, business_name, tax_id HAVING COUNT(*) > 1", [_AC]))
def d1_duplicate_business_rows(spark, d):
    return Q.duplicate_business_rows(_m(spark, d).agency_cert)


@register("d2_rows_by_match_method", O.query(
    'SELECT match_method, COUNT(*) AS "rows" FROM agency_cert GROUP BY match_method ORDER BY match_method', [_AC]))
def d2_rows_by_match_method(spark, d):
    return Q.count_by(_m(spark, d).agency_cert, "match_method")


@register("d3_top_unmatched_rows", O.query(O.report(
    _ROW | {"total_amount": "total_amount"}, "agency_cert WHERE match_method = 'unmatched'", "total_amount", 50), [_AC]))
def d3_top_unmatched_rows(spark, d):
    return Q.top_unmatched_rows(_m(spark, d).agency_cert)


@register("d4_coverage", O.query(
    "SELECT total_rows, matched_rows, ROUND(100.0::DOUBLE * matched_rows / NULLIF(total_rows, 0), 2) AS matched_pct FROM "
    "(SELECT COUNT(*) AS total_rows, COUNT(NULLIF(match_method, 'unmatched')) AS matched_rows FROM agency_cert) x", [_AC]))
def d4_coverage(spark, d):
    return Q.coverage(_m(spark, d).agency_cert)


@register("d5_tax_id_disagreements", O.query(O.report(
    {c: c for c in ("agency_number", "agency_name", "business_name")} | {"he_tax_id": "tax_id", "vendor_tax_id": "matched_tax_id"}
    | {c: c for c in ("certification_type", "match_method", "total_amount")}, "two_tax_ids", "total_amount", 200),
    ["two_tax_ids"]))
def d5_tax_id_disagreements(spark, d):
    return Q.tax_id_disagreements(_m(spark, d).agency_cert)


@register("d6_tax_match_without_tax_id", O.query(
    "SELECT COUNT(*) AS tax_match_but_he_tax_missing FROM agency_cert "
    f"WHERE match_method = 'tax_id' AND {O.nb('tax_id')} IS NULL", [_AC]))
def d6_tax_match_without_tax_id(spark, d):
    return Q.tax_match_without_tax_id(_m(spark, d).agency_cert)


@register("d7_name_matches_with_tax_id", O.query(O.report(
    _ROW | {c: c for c in ("matched_tax_id", "certification_type", "total_amount")},
    f"agency_cert WHERE {O.nb('tax_id')} IS NOT NULL AND match_method = 'name'", "total_amount", 200), [_AC]))
def d7_name_matches_with_tax_id(spark, d):
    return Q.name_matches_with_tax_id(_m(spark, d).agency_cert)


@register("d8_certification_distribution", O.query(
    'SELECT certification_type, COUNT(*) AS "rows" FROM agency_cert GROUP BY certification_type', [_AC]))
def d8_certification_distribution(spark, d):
    return Q.count_by(_m(spark, d).agency_cert, "certification_type")


@register("d9_name_matches_without_vendor_tax", O.query(O.report(
    _ROW | {c: c for c in ("matched_tax_id", "certification_type")},
    "agency_cert WHERE matched_tax_id IS NULL AND match_method = 'name'", None, 200), [_AC]))
def d9_name_matches_without_vendor_tax(spark, d):
    return Q.name_matches_without_vendor_tax(_m(spark, d).agency_cert)


@register("d10_top_unmatched_vendors", O.query(O.report(
    {"business_name": "business_name", "tax_id": "tax_id", "total_unmatched_amount": "SUM(total_amount)", "rows": "COUNT(*)"},
    "agency_cert WHERE match_method = 'unmatched'", "total_unmatched_amount", 50, group=True), [_AC]))
def d10_top_unmatched_vendors(spark, d):
    return Q.top_unmatched_vendors(_m(spark, d).agency_cert)


@register("d11_top_tax_disagreements", O.query(O.report(
    {"business_name": "business_name", "he_tax_id": "tax_id", "matched_tax_id": "matched_tax_id",
     "amount_at_issue": "SUM(total_amount)", "rows": "COUNT(*)"}, "two_tax_ids", "amount_at_issue", 50, group=True),
    ["two_tax_ids"]))
def d11_top_tax_disagreements(spark, d):
    return Q.top_tax_disagreements(_m(spark, d).agency_cert)


@register("d12_lookalike_transactions", O.query(
    f"SELECT * FROM (SELECT a.*, {O.canon_a('a.business_name')} AS canon_name, "
    f"COUNT(*) OVER (PARTITION BY {O.canon_a('a.business_name')}, a.total_amount) AS dupe_count "
    "FROM agency_cert a) x WHERE dupe_count > 1", [_AC]))
def d12_lookalike_transactions(spark, d):
    return Q.lookalike_transactions(_m(spark, d).agency_cert)


@register("d13_summary_sanity", O.query(
    "SELECT (SELECT COUNT(*) FROM prime_cert_summary WHERE match_method = 'tax_id') AS matched_by_tax_id, "
    "(SELECT COUNT(*) FROM prime_cert_summary WHERE match_method = 'name') AS matched_by_name, "
    "(SELECT COUNT(*) - COUNT(match_method) FROM prime_cert_summary) AS no_match, "
    "(SELECT COUNT(*) FROM prime_cert_summary) AS total_in_agency_higher_ed, "
    "(SELECT COUNT(*) FROM contract_prime_summary) AS total_in_contract_summary",
    ["prime_cert_summary", "contract_prime_summary"]))
def d13_summary_sanity(spark, d):
    m = _m(spark, d)
    return Q.summary_sanity(m.prime_cert_summary, m.contract_prime_summary)


_AC_COLS = ["source", "agency_number", "agency_name", "business_name", "tax_id", "total_amount",
            "certification_type", "matched_tax_id", "match_method"]


@register("a19_duplicate_combo", O.query(
    "SELECT a.*, COUNT(*) OVER (PARTITION BY agency_name, business_name) > 1 AS is_duplicate FROM agency_cert a",
    [_AC]))
def a19_duplicate_combo(spark, d):
    return Q.is_duplicate_combo(_m(spark, d).agency_cert, ["agency_name", "business_name"])


@register("a20_repeated_values", O.query(
    "SELECT COUNT(*) AS repeated_values FROM (SELECT UPPER(business_name) AS v FROM contracts "
    f"WHERE {O.nb('business_name')} IS NOT NULL GROUP BY UPPER(business_name) HAVING COUNT(*) > 1) x",
    ["contracts"]))
def a20_repeated_values(spark, d):
    return Q.count_repeated_values(fx.contracts(spark, d), "business_name")


@register("r1_drop_blank_rows", O.query(
    "SELECT CAST(row_id AS VARCHAR) AS row_id, source, agency_number, agency_name, business_name, tax_id, "
    "CAST(total_amount AS VARCHAR) AS total_amount FROM agency_spend WHERE row_id % 17 <> 0", ["agency_spend"]))
def r1_drop_blank_rows(spark, d):
    """Every column counts: each 17th row of the sheet is blank, as NULLs or as spaces."""
    spend = fx.agency_spend(spark, d)
    blank = F.when(F.col("row_id") % 2 == 0, F.lit("  "))
    return Q.drop_blank_rows(spend.select(*[
        F.when(F.col("row_id") % 17 == 0, blank).otherwise(F.col(c).cast("string")).alias(c) for c in spend.columns]))


_R2_ORDER = [c for c in _AC_COLS if c != "agency_name"]


@register("r2_paginate", O.query(
    "SELECT a.*, CAST(CEIL(ROW_NUMBER() OVER (PARTITION BY agency_name ORDER BY "
    + ", ".join(f"{c} ASC NULLS LAST" for c in _R2_ORDER) + ") / 40.0) AS BIGINT) AS page FROM agency_cert a",
    [_AC]))
def r2_paginate(spark, d):
    return Q.paginate(_m(spark, d).agency_cert, "agency_name", _R2_ORDER, n=40)


# ================================================================== sync
from spendmatch.operators import stored_sync as SS  # noqa: E402
from spendmatch.operators import sync as S  # noqa: E402
from spendmatch.sources.stored import StoredTable, load_stored  # noqa: E402

_SYNC_KEYS = ["c_custkey"]


def _sync_parts(spark, d):
    prep = S.prepare_incoming(fx.sync_incoming(spark, d), _SYNC_KEYS, fx.SYNC_RUN_TS)
    return prep, fx.sync_target(spark, d)


@register("c5_sync_upsert_first", O.SYNC_UPSERT_FIRST)
def c5_sync_upsert_first(spark, d):
    prep, tgt = _sync_parts(spark, d)
    return S.sync(tgt, prep.rows, _SYNC_KEYS, fx.SYNC_RUN_TS, incoming_empty=prep.empty).table


@register("c6_sync_delete_first", O.SYNC_DELETE_FIRST)
def c6_sync_delete_first(spark, d):
    prep, tgt = _sync_parts(spark, d)
    return S.sync(tgt, prep.rows, _SYNC_KEYS, fx.SYNC_RUN_TS, order="delete_first", incoming_empty=prep.empty).table


@register("c3_upsert", O.SYNC_UPSERT_ONLY)
def c3_upsert(spark, d):
    prep, tgt = _sync_parts(spark, d)
    return S.upsert(tgt, prep.rows, _SYNC_KEYS, fx.SYNC_RUN_TS)


@register("c4_delete_stale", O.SYNC_DELETE_ONLY)
def c4_delete_stale(spark, d):
    prep, tgt = _sync_parts(spark, d)
    return S.delete_stale(tgt, prep.rows, prep.empty)


@register("c11_sync_stats", O.SYNC_STATS)
def c11_sync_stats(spark, d):
    prep, tgt = _sync_parts(spark, d)
    return S.sync_stats(prep, S.sync(tgt, prep.rows, _SYNC_KEYS, fx.SYNC_RUN_TS, incoming_empty=prep.empty))


_SHEET_SQL = O.query("""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, created_at, updated_at FROM (
  SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
    CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment,
    TIMESTAMP '2025-01-02 03:04:05' AS created_at, TIMESTAMP '2025-01-02 03:04:05' AS updated_at
  FROM customer WHERE c_custkey % 101 <> 0)""", [])


@register("c1_sync_sheet_new_target", _SHEET_SQL)
def c1_sync_sheet_new_target(spark, d):
    """A raw sheet into an absent target: headers with spaces, padded text, NaN, whole-number doubles, repeated keys (last wins)."""
    _, result = S.sync_sheet(spark, fx.raw_sheet(spark, d), None, _SYNC_KEYS, fx.SYNC_RUN_TS, on_duplicate_key="last",
                             order_col="sheet_row")
    return result.table.drop("row_hash")


def _store(spark, name: str) -> StoredTable:
    import uuid

    from spendmatch.session import checkpoint_dir
    return StoredTable(spark, f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}")


def _stored_sync(spark, d):
    """The stored target of an earlier load, synced with the sheet."""
    store = _store(spark, "customers")
    load_stored(store, fx.sync_target(spark, d), _SYNC_KEYS, hash_mode="canonical")
    return store, SS.sync_stored(store, fx.sync_incoming(spark, d), _SYNC_KEYS, fx.SYNC_RUN_TS)


@register("c5_stored_sync", O.SYNC_UPSERT_FIRST)
def c5_stored_sync(spark, d):
    """Bucketed target, narrow decision, changed buckets rewritten and committed, read back."""
    store, run = _stored_sync(spark, d)
    run.release()
    return store.read()


@register("c11_stored_sync_stats", O.SYNC_STATS)
def c11_stored_sync_stats(spark, d):
    _, run = _stored_sync(spark, d)
    run.release()
    return spark.createDataFrame(list(run.version.info["stats"].items()), "stat string, value bigint")


@register("s9_stored_rejects", O.query(
    "SELECT TRIM(c_custkey) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM sync_raw "
    "WHERE c_custkey IS NULL OR TRIM(c_custkey) = ''", ["sync_raw"]))
def s9_stored_rejects(spark, d):
    """All rejects of a run, from the place its commit names."""
    store, run = _stored_sync(spark, d)
    run.release()
    return spark.read.schema(run.rejected.schema).parquet(store.latest().info["rejects"])


@register("s8_guarded_load", O.query("SELECT * FROM sync_target", ["sync_target"]))
def s8_guarded_load(spark, d):
    """The first load stays, a second one is refused."""
    store, target = _store(spark, "guarded"), fx.sync_target(spark, d)
    loads = [load_stored(store, rows, _SYNC_KEYS) for rows in (target, target.withColumn("c_name", F.lit("second load")))]
    return store.read() if loads == [True, False] else store.read().limit(0)


def _rehashed(spark, d, mode: str):
    """The incoming rows stored under an older fingerprint rule, then synced with themselves."""
    store = _store(spark, f"hashed-{mode}")
    prep = S.prepare_incoming(fx.sync_incoming(spark, d), _SYNC_KEYS, fx.SYNC_OLD_TS, hash_mode=mode)
    load_stored(store, S.add_audit_columns(prep.rows, fx.SYNC_OLD_TS), _SYNC_KEYS, hash_mode=mode)
    SS.sync_stored(store, fx.sync_incoming(spark, d), _SYNC_KEYS, fx.SYNC_RUN_TS).release()
    return store.read()


_REHASHED = O.query("""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, TIMESTAMP '2024-01-01 00:00:00' AS created_at,
       TIMESTAMP '2024-01-01 00:00:00' AS updated_at, row_hash FROM sync_in""", ["sync_in"])


@register("f18_stored_rehash", _REHASHED)
def f18_stored_rehash(spark, d):
    """A target under the raw rule: no update, every fingerprint replaced."""
    return _rehashed(spark, d, "raw")


@register("f19_stored_rehash", _REHASHED)
def f19_stored_rehash(spark, d):
    """A target under the vectorised rule: no update, every fingerprint replaced."""
    return _rehashed(spark, d, "vectorized")


@register("c7_sync_sources", O.query("""
SELECT 'customer' AS dataset, 'synced' AS outcome, COUNT(*) AS rows_stored FROM customer
UNION ALL SELECT 'part', 'synced', COUNT(*) FROM part
UNION ALL SELECT 'supplier', 'failed', 0 UNION ALL SELECT 'absent', 'skipped', 0""", []))
def c7_sync_sources(spark, d):
    """Named sources, one missing and one without keys; the others commit."""
    keys = {"customer": ["c_custkey"], "part": ["p_partkey"], "supplier": [], "absent": ["id"]}
    root = _store(spark, "many").path
    runs = SS.sync_sources(spark, {t: f"{d}/{t}.parquet" for t in ("customer", "part", "supplier", "absent")}, root,
                           {t: {"keys": k, "buckets": 16} for t, k in keys.items()}, fx.SYNC_RUN_TS)
    parts = []
    for t, run in runs.items():
        outcome = "skipped" if run is None else "failed" if isinstance(run, Exception) else "synced"
        rows = StoredTable(spark, f"{root}/{t}").read() if outcome == "synced" else spark.range(0)
        parts.append(rows.agg(F.count(F.lit(1)).alias("rows_stored")).select(F.lit(t).alias("dataset"), F.lit(outcome).alias("outcome"), "rows_stored"))
    return reduce(DataFrame.unionByName, parts)


@register("f17_row_hash", O.query("SELECT * FROM sync_in", ["sync_in"]))
def f17_row_hash(spark, d):
    prep, _ = _sync_parts(spark, d)
    return prep.rows


@register("d14_rejected_keys", O.query(
    "SELECT TRIM(c_custkey) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM sync_raw "
    "WHERE c_custkey IS NULL OR TRIM(c_custkey) = ''", ["sync_raw"]))
def d14_rejected_keys(spark, d):
    prep, _ = _sync_parts(spark, d)
    return prep.rejected


@register("c2_duplicate_keys", O.query(
    "SELECT uniqueid, b2gnow_vendor_number, COUNT(*) AS key_count FROM vendors "
    "GROUP BY uniqueid, b2gnow_vendor_number HAVING COUNT(*) > 1", ["vendors"]))
def c2_duplicate_keys(spark, d):
    return S.duplicate_keys(fx.vendors(spark, d), ["uniqueid", "b2gnow_vendor_number"])


# ============================================================ keys (notes)
from spendmatch.functions import keys as K  # noqa: E402


@register("f20_surrogate_id", O.SURROGATE_IDS)
def f20_surrogate_id(spark, d):
    t = fx.districts(spark, d)
    return t.select("*", K.pad_start("zipcode").alias("zipcode5"),
                    K.surrogate_id("district", "zipcode", "split_whole_combined").alias("unique_id"))


# ========================================================== fixed width
from spendmatch.sources import fixedwidth as FW  # noqa: E402


def _fw_parsed(spark, d):
    return FW.parse_lines(fx.fixed_width_lines(spark, d))


@register("f22_fixed_width_parse", O.query(
    "SELECT file_stem, l_orderkey, l_linenumber, report_part, college_number, firm_name, firm_fed_id, sub_object, "
    "dollar_amount, fiscal_year, fiscal_month FROM fw_flagged WHERE is_parsed", ["fw_flagged"]))
def f22_fixed_width_parse(spark, d):
    return FW.converted_rows(_fw_parsed(spark, d))


@register("p17_fixed_width_rejects", O.query(
    "SELECT file_stem, l_orderkey, l_linenumber FROM fw_flagged WHERE NOT is_blank AND NOT is_parsed",
    ["fw_flagged"]))
def p17_fixed_width_rejects(spark, d):
    return FW.rejected_lines(_fw_parsed(spark, d)).select("file_stem", "l_orderkey", "l_linenumber")


@register("a21_fixed_width_stats", O.query(
    "SELECT file_stem, COUNT(*) FILTER (WHERE is_parsed) AS processed_lines, COUNT(*) AS total_lines "
    "FROM fw_flagged GROUP BY file_stem UNION ALL "
    "SELECT NULL, COUNT(*) FILTER (WHERE is_parsed), COUNT(*) FROM fw_flagged", ["fw_flagged"]))
def a21_fixed_width_stats(spark, d):
    return FW.run_statistics(_fw_parsed(spark, d))


_FW_TEXT = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in FW.FIELD_ORDER)


@register("s5_convert_folder", O.query(f"SELECT {_FW_TEXT} FROM fw_flagged WHERE is_parsed", ["fw_flagged"]))
def s5_convert_folder(spark, d):
    """Report files through the whole folder conversion and back: text files in, one CSV folder per file out."""
    import uuid

    from spendmatch.session import checkpoint_dir
    base = f"{checkpoint_dir(spark).rstrip('/')}/tables/reports-{uuid.uuid4().hex}"
    fx.fixed_width_lines(spark, d).select("value").write.text(f"{base}/in")
    FW.convert_folder(spark, f"{base}/in", f"{base}/out")
    csv = spark.read.option("header", True).csv(f"{base}/out")
    return csv.select(*[F.col(h).alias(c) for c, h in zip(FW.FIELD_ORDER, FW.CSV_HEADERS)])


def _report_survey(spark, d):
    import uuid

    from spendmatch.session import checkpoint_dir
    folder = f"{checkpoint_dir(spark).rstrip('/')}/tables/reports-{uuid.uuid4().hex}"
    fx.report_files(spark, d, folder)
    return folder, FW.survey_lines(spark, folder)


@register("p17_numbered_rejects", O.query(
    "SELECT file_stem, line_number, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY file_stem "
    "ORDER BY l_orderkey, l_linenumber, value) AS line_number FROM fw_flagged) x WHERE NOT is_blank AND NOT is_parsed",
    ["fw_flagged"]))
def p17_numbered_rejects(spark, d):
    """Report files in, unparsable lines with their numbers out."""
    return FW.numbered_rejects(_report_survey(spark, d)[1])


@register("a21_folder_statistics", ORACLE["a21_fixed_width_stats"])
def a21_folder_statistics(spark, d):
    """Run statistics of a folder of report files."""
    folder, survey = _report_survey(spark, d)
    return FW.run_statistics(survey, files=FW.list_files(spark, folder))


# ======================================================== profile / preview
from spendmatch.operators import profile as PR  # noqa: E402
from spendmatch.sources.tables import infer_types, read_table  # noqa: E402


@register("r4_profile_tables", O.profile_sql())
def r4_profile_tables(spark, d):
    return PR.profile_tables({t: read_table(spark, d, t) for t in O.PROFILE_TABLES})


@register("r3_preview_tables", O.preview_sql())
def r3_preview_tables(spark, d):
    return PR.preview_tables({t: read_table(spark, d, t) for t in O.PROFILE_TABLES})


@register("s2_infer_types", O.INFER_TYPES)
def s2_infer_types(spark, d):
    spend = fx.stored(spark, d, "agency_spend")
    as_sheet = spend.withColumns({c: F.col(c).cast("double") for c in ("row_id", "agency_number", "total_amount")})
    return infer_types(as_sheet)


# ============================================================ row ids
from spendmatch.operators.matching import with_row_id  # noqa: E402


@register("w3_row_id", "SELECT o_orderkey, o_custkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS row_id FROM orders")
def w3_row_id(spark, d):
    """Dense 1-based ids in key order: range sort + per-partition offsets, no single-partition window."""
    return with_row_id(read_table(spark, d, "orders").select("o_orderkey", "o_custkey"), order_by=["o_orderkey"])
