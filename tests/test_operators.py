"""Sources/sinks (S1, S6-S9), row ids (W3), hash modes (F18, F19), skew-safe
operators (W1, R2, A19) checked against brute force on skewed data."""

import os
from collections import Counter

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spendmatch.functions import hashing
from spendmatch.operators import matching, quality
from spendmatch.sources import tables


def test_read_tables_skips_missing_and_empty(spark, tmpdir_path):
    full = os.path.join(tmpdir_path, "full")
    empty = os.path.join(tmpdir_path, "empty")
    spark.range(3).write.parquet(full)
    spark.range(0).write.parquet(empty)
    got = tables.read_tables(spark, {"full": full, "empty": empty, "gone": os.path.join(tmpdir_path, "nope")},
                             wanted=["full", "empty", "gone", "unknown"])
    assert list(got) == ["full"] and got["full"].count() == 3


def test_ensure_target_initial_load_and_rejects(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "target")
    df = spark.createDataFrame([("1", "a")], "id string, name string")
    assert tables.ensure_target(spark, path, df.schema) is True
    assert tables.ensure_target(spark, path, df.schema) is False       # never dropped
    assert tables.initial_load(df, path) is True                       # empty -> bulk append
    assert tables.initial_load(df, path) is False                      # not empty any more
    assert spark.read.parquet(path).count() == 1
    rej = os.path.join(tmpdir_path, "rejects")
    tables.write_rejects(spark.range(250).withColumnRenamed("id", "k"), rej, limit=100)
    sample = spark.read.option("header", True).option("inferSchema", True).csv(f"{rej}/sample")
    assert sorted(r.k for r in sample.collect()) == list(range(100))     # the first by their values
    assert spark.read.parquet(f"{rej}/all").count() == 250               # none is dropped
    tables.refresh_mart(df, os.path.join(tmpdir_path, "mart"))
    tables.refresh_mart(df.union(df), os.path.join(tmpdir_path, "mart"))   # full refresh replaces
    assert spark.read.parquet(os.path.join(tmpdir_path, "mart")).count() == 2


def test_infer_types(spark):
    df = spark.createDataFrame([("1", "1.5", "true", "x", " "), ("22", None, "False", "y", None)],
                               "a string, b string, c string, d string, e string")
    assert tables.infer_types(df).schema == df.schema                    # text stays text
    out = tables.infer_types(df, parse_text=True)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "double", "boolean", "string",
                                                                      "string"]
    ids = spark.createDataFrame([("012345678", "00501", 3.0, 2.5, float("nan"))], "a string, z string, w double, d double, n double")
    got = tables.infer_types(ids, parse_text=True).first()
    assert (got.a, got.z, got.w, got.d) == ("012345678", "00501", 3, 2.5)
    whole = tables.infer_types(ids.union(ids.withColumn("w", F.lit(float("nan")))))
    assert [f.dataType.simpleString() for f in whole.schema.fields] == ["string", "string", "bigint", "double", "double"]
    assert sorted(r.w is None for r in whole.collect()) == [False, True]


def test_contract_cert_of_a_thousand_identical_rows(spark):
    """Literal M1 has n^2 rows for n copies; totals multiply counts and never make the pairs."""
    from spendmatch.plans import marts
    vendors = spark.createDataFrame([("U1", "", "111", "Acme", "MBE", "Active")],
                                    "uniqueid string, b2gnow_vendor_number string, tax_id string, business_name string, "
                                    "certification_type string, certification_status string")
    row = ("", "Prime", "Agency", "Acme", "sub", "SUB", 2.0, "2024-01-01", "111")
    schema = ("b2gnow_id string, prime_vendor string, contract_holder string, business_name string, vendor_type string, "
              "payment_type string, amount_paid double, audit_period string, taxidnumber string")
    contracts = spark.createDataFrame([row] * 1000 + [row[:8] + (None,)] * 3 + [row[:3] + (None,) + row[4:]], schema).withColumns(
        {"amount_paid": F.col("amount_paid").cast("decimal(18,2)"), "audit_period": F.col("audit_period").cast("timestamp_ntz")})
    weighted = marts.contract_cert_weighted(vendors, contracts)
    assert Counter(r._m for r in weighted.collect()) == {None: 1, 1000: 1003}
    assert marts.contract_cert(vendors, contracts).count() == 1_003_001
    total = marts.contract_totals(weighted).filter("tax_id = '111'").first().total_amount
    assert total == 2_000_000
    assert marts.contract_cert(vendors, contracts, mode="row_id").count() == 1004


def test_shared_folder_is_required_and_honoured(spark, tmpdir_path):
    from spendmatch import session

    class Context:
        def __init__(self, master, folder):
            self.master, self.folder = master, folder

        def getCheckpointDir(self):
            return self.folder

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

    s = Session()
    s.sparkContext = Context("spark://host:7077", None)
    with pytest.raises(RuntimeError):
        session.checkpoint_dir(s)
    s.sparkContext = Context("spark://host:7077", "hdfs://x/ckpt")
    assert session.checkpoint_dir(s) == "hdfs://x/ckpt"
    made = []
    assert session.materialize(spark.range(5), made=made).count() == 5
    session.drop_table(spark, made[0])
    assert not os.path.exists(made[0].removeprefix("file:"))


def test_blank_to_null_prints_numeric_ids(spark):
    from spendmatch.functions.text import blank_to_null
    df = spark.createDataFrame([(123456789.0, " 12 ", 7)], "d double, s string, i int")
    assert tuple(df.select(*[blank_to_null(c) for c in df.columns]).first()) == ("123456789", "12", "7")


def test_with_row_id_dense_and_ordered(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7 % 1000).alias("v"))
    out = matching.with_row_id(df, order_by=["v"]).collect()
    assert sorted((r.row_id, r.v) for r in out) == [(i + 1, i) for i in range(1000)]
    ids = matching.with_row_id(df).select("row_id").collect()
    assert len({r.row_id for r in ids}) == 1000


def test_hash_modes(spark):
    df = spark.createDataFrame([(" a ", 12345678901, None)], "s string, n long, d double")
    import hashlib
    raw = df.select(hashing.row_hash(df, mode="raw").alias("h")).first().h
    assert raw == hashlib.md5(" a |12345678901|<NA>".encode()).hexdigest()
    vec = df.select(hashing.row_hash(df, mode="vectorized").alias("h")).first().h
    assert vec == hashlib.md5(f"a|{12345678901:.10g}|".encode()).hexdigest()   # ints lose digits (F19)


def _skewed(spark, n=3000):
    # a third of all rows share one group / key
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 97).cast("string")).alias("g"),
        (F.col("id") * 7919 % 10007).alias("o"), F.col("id"))


def test_paginate_matches_row_number_on_hot_group(spark):
    df = _skewed(spark).repartition(9)
    got = {r.id: r.page for r in quality.paginate(df, "g", ["o", "id"], n=40).collect()}
    w = W.partitionBy("g").orderBy("o", "id")
    want = {r.id: r.page for r in df.select("id", F.ceil(F.row_number().over(w) / 40).alias("page")).collect()}
    assert got == want


def test_duplicate_combo_matches_window_with_nulls(spark):
    df = _skewed(spark).withColumn("g", F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("g")))
    got = {r.id: r.is_duplicate for r in quality.is_duplicate_combo(df, ["g"]).collect()}
    w = W.partitionBy("g")
    want = {r.id: r.d for r in df.select("id", (F.count(F.lit(1)).over(w) > 1).alias("d")).collect()}
    assert got == want


def test_best_vendor_picks_hierarchy_on_hot_key(spark):
    rows = [("111", "", "Acme", t, s) for t, s in
            [("VOB", "Active"), ("WBE", "Active"), ("MBE", "Expired"), (None, "Active"), ("MWBE", "Active")] * 50]
    rows.append(("222", "", "Beta", "MBE", "Expired"))
    v = spark.createDataFrame(rows, "tax_id string, b2gnow_vendor_number string, business_name string, "
                                    "certification_type string, certification_status string")
    out = {r.tax_id: r.certification_type for r in matching.best_vendor(v, keys=("tax", "name")).collect()}
    assert out == {"111": "MWBE"}        # Active first, then MWBE before WBE/VOB; Beta's best is Expired
