"""Sheet sync properties (SURVEY §5 (3)): idempotence, target == incoming,
created_at preserved / reset by order, empty snapshot never wipes, frozen rows."""

import pytest
from pyspark.sql import functions as F

from spendmatch.operators import ingest, sync

NOW1 = "2025-01-01 00:00:00"
NOW2 = "2025-02-01 00:00:00"
KEYS = ["id"]


def _incoming(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, amount double")


def _first_load(spark, rows, now=NOW1):
    empty = sync.add_audit_columns(_incoming(spark, []).limit(0), now)
    prep = sync.prepare_incoming(_incoming(spark, rows), KEYS, now)
    return sync.sync(empty, prep.rows, KEYS, now).table


def test_first_load_and_idempotence(spark):
    rows = [("1", "a", 1.0), ("2", "b", 2.5), (" 3 ", "c", None)]
    t1 = _first_load(spark, rows).cache()
    assert sorted(r.id for r in t1.collect()) == ["1", "2", "3"]
    assert {r.created_at.isoformat(" ") for r in t1.collect()} == {NOW1}
    prep = sync.prepare_incoming(_incoming(spark, rows), KEYS, NOW2)
    res = sync.sync(t1, prep.rows, KEYS, NOW2)
    ops = {r.op for r in res.changes.collect()}
    assert ops == {"unchanged"}                       # second run: zero changes
    assert sorted(map(tuple, res.table.collect())) == sorted(map(tuple, t1.collect()))


@pytest.mark.parametrize("order,created", [("upsert_first", NOW1), ("delete_first", NOW2)])
def test_update_insert_delete(spark, order, created):
    t1 = _first_load(spark, [("1", "a", 1.0), ("2", "b", 2.0), ("3", "c", 3.0)]).cache()
    prep = sync.prepare_incoming(_incoming(spark, [("1", "a", 1.0), ("2", "B", 2.0), ("4", "d", 4.0)]), KEYS, NOW2)
    res = sync.sync(t1, prep.rows, KEYS, NOW2, order=order)
    by_id = {r.id: r for r in res.table.collect()}
    assert sorted(by_id) == ["1", "2", "4"]
    assert by_id["2"].name == "B" and by_id["2"].updated_at.isoformat(" ") == NOW2
    assert by_id["2"].created_at.isoformat(" ") == created
    assert by_id["1"].updated_at.isoformat(" ") == NOW1        # same hash: untouched
    assert by_id["4"].created_at.isoformat(" ") == NOW2
    # after sync the table holds exactly the incoming data
    got = sorted((r.id, r.name, r.amount) for r in res.table.collect())
    assert got == [("1", "a", 1.0), ("2", "B", 2.0), ("4", "d", 4.0)]
    ops = {r.id: r.op for r in res.changes.collect()}
    assert ops == {"1": "unchanged", "2": "update", "3": "delete", "4": "insert"}


def test_empty_snapshot_never_wipes(spark):
    t1 = _first_load(spark, [("1", "a", 1.0)]).cache()
    prep = sync.prepare_incoming(_incoming(spark, []), KEYS, NOW2)
    res = sync.sync(t1, prep.rows, KEYS, NOW2)
    assert [r.id for r in res.table.collect()] == ["1"]
    assert sync.delete_stale(t1, prep.rows).count() == 1


def test_frozen_rows_never_update_nor_delete(spark):
    t1 = _first_load(spark, [("1", "a", 1.0), ("2", "b", 2.0)])
    t1 = t1.withColumn("row_hash", F.when(F.col("id") == "1", F.lit(None)).otherwise(F.col("row_hash"))).cache()
    prep = sync.prepare_incoming(_incoming(spark, [("1", "changed", 9.0)]), KEYS, NOW2)
    res = sync.sync(t1, prep.rows, KEYS, NOW2)
    by_id = {r.id: r for r in res.table.collect()}
    assert sorted(by_id) == ["1"] and by_id["1"].name == "a"


def test_rejected_keys_and_stats(spark):
    rows = [("1", "a", 1.0), ("", "x", 0.0), (None, "y", 0.0), ("2", "a", 1.0)]
    prep = sync.prepare_incoming(_incoming(spark, rows), KEYS, NOW1)
    assert prep.rejected.count() == 2
    empty = sync.add_audit_columns(_incoming(spark, []).limit(0), NOW1)
    res = sync.sync(empty, prep.rows, KEYS, NOW1)
    stats = {r.stat: r.value for r in sync.sync_stats(prep, res).collect()}
    assert stats["dropped"] == 2 and stats["upserted"] == 2 and stats["deleted"] == 0


def test_duplicate_keys(spark):
    df = _incoming(spark, [("1", "a", 1.0), ("1", "b", 2.0)])
    with pytest.raises(sync.DuplicateKeyError):
        sync.assert_unique(df, KEYS, "t")
    with pytest.raises(sync.DuplicateKeyError):
        sync.prepare_incoming(df, KEYS, NOW1)
    prep = sync.prepare_incoming(df.withColumn("pos", F.monotonically_increasing_id()), KEYS, NOW1, on_duplicate_key="last", order_col="pos")
    assert [r.name for r in prep.rows.collect()] == ["b"]
    last = sync.dedupe_last(df.withColumn("pos", F.monotonically_increasing_id()), KEYS, "pos")
    assert [r.name for r in last.collect()] == ["b"]


def test_schema_drift_is_an_error(spark):
    t1 = _first_load(spark, [("1", "a", 1.0)])
    extra = _incoming(spark, [("1", "a", 1.0)]).withColumn("new_col", F.lit(1))
    prep = sync.prepare_incoming(extra, KEYS, NOW2)
    with pytest.raises(ValueError):
        sync.sync(t1, prep.rows, KEYS, NOW2)


def test_sync_many_isolates_failures(spark):
    ok = {"target": _first_load(spark, [("1", "a", 1.0)]),
          "incoming": _incoming(spark, [("1", "a", 1.0)]), "keys": KEYS}
    bad = {"target": ok["target"], "incoming": ok["incoming"], "keys": None}
    out = sync.sync_many(spark, {"ok": ok, "bad": bad}, NOW2)
    assert isinstance(out["bad"], Exception) and isinstance(out["ok"], sync.SyncResult)


def test_normalize_columns():
    assert [ingest.normalize_column_name(c) for c in
            [" Business Name ", "B2GNow Vendor Number", "Certification  Date", "index"]] == \
        ["business_name", "b2gnow_vendor_number", "certification__date", "index"]
    assert ingest.normalize_column_name("Certification  Date!", readme_variant=True) == "certification_date"


def test_clean_keys_and_nan(spark):
    df = spark.createDataFrame([(123456789.0, float("nan"))], "k double, v double")
    out = ingest.nan_to_null(ingest.clean_keys(df, ["k"])).first()
    assert out.k == "123456789" and out.v is None


def test_sync_sheet(spark):
    """Headers, padding, NaN, rejects, repeated keys, an absent and an empty target."""
    sheet = spark.createDataFrame([(" 1 ", " a ", float("nan"), 1), ("2", "old", 2.0, 1), ("2", "new", 2.0, 2), (" ", "x", 1.0, 1)],
                                  ["Id ", " Full Name", "Some Value", "Row"])
    with pytest.raises(sync.DuplicateKeyError):
        sync.sync_sheet(spark, sheet, None, ["id"], NOW1)
    prep, res = sync.sync_sheet(spark, sheet, None, ["id"], NOW1, on_duplicate_key="last", order_col="row")
    first = res.table.cache()
    assert prep.rejected.count() == 1
    assert sorted((r.id, r.full_name, r.some_value) for r in first.collect()) == [("1", "a", None), ("2", "new", 2)]
    again = sheet.filter(F.col("Row") == 1).filter(F.trim("Id ") != "").drop("Row")
    _, res = sync.sync_sheet(spark, again, first, ["id"], NOW2)
    assert sorted((r.id, r.full_name, r.op) for r in res.classified.collect()) == [("1", "a", "unchanged"), ("2", "old", "update")]
    _, res = sync.sync_sheet(spark, again, first.limit(0), ["id"], NOW2)
    assert res.table.count() == 2
    with pytest.raises(sync.DuplicateKeyError):
        sync.sync_sheet(spark, again, first.union(first), ["id"], NOW2)
