"""Stored sync targets: parity with the frame sync, copy-on-write by bucket, guarded commits, one scan, rehash, datasets side by side."""

import random

import pytest
from pyspark.sql import functions as F

from spendmatch.operators import bloom, stored_sync as SS, sync
from spendmatch.session import materialize
from spendmatch.sources import stored
from spendmatch.sources.stored import CommitConflict, StoredTable, Version, bucket_of, load_stored

NOW1, NOW2 = "2025-01-01 00:00:00", "2025-02-01 00:00:00"
ROWS = "id string, name string, amount double"
KEYS = ["id"]


def _sheet(spark, rows, schema=ROWS):
    return spark.createDataFrame(rows, schema)


def _rows(df):
    return sorted(map(tuple, df.select("id", "name", "amount", "created_at", "updated_at", "row_hash").collect()), key=str)


@pytest.fixture()
def store(spark, tmpdir_path):
    return StoredTable(spark, f"{tmpdir_path}/t")


@pytest.mark.parametrize("order", ["upsert_first", "delete_first"])
def test_same_result_as_the_frame_sync(spark, store, order):
    rng = random.Random(3)
    first = [(str(i), rng.choice("ab"), rng.randrange(5) + 0.5) for i in range(60)]
    target = sync.prepare_incoming(_sheet(spark, first), KEYS, NOW1).rows
    target = sync.add_audit_columns(target, NOW1).withColumn("row_hash", F.when(F.col("id") % 7 != 0, F.col("row_hash")))
    target = materialize(target.select("id", "name", "amount", "created_at", "updated_at", "row_hash"))
    # a stale row whose content comes back under the same fingerprint as an incoming row is an orphan, not deleted
    second = [(str(i), "c" if i % 5 == 0 else n, a) for (_, n, a), i in zip(first, range(60)) if i % 3] + [(str(i), "new", 1.5) for i in range(100, 120)]
    orphan_hash = sync.prepare_incoming(_sheet(spark, second), KEYS, NOW1).rows.where("id = '100'").first().row_hash
    target = materialize(target.withColumn("row_hash", F.when(F.col("id") == "3", F.lit(orphan_hash)).otherwise(F.col("row_hash"))))
    sheet = _sheet(spark, [*second, (" ", "no key", 1.0), (None, "no key", 2.0)])
    prep = sync.prepare_incoming(sheet, KEYS, NOW2)
    want = sync.sync(target, prep.rows, KEYS, NOW2, order=order)
    assert load_stored(store, target, KEYS, 4)
    got = SS.sync_stored(store, sheet, KEYS, NOW2, order=order)
    assert _rows(store.read()) == _rows(want.table)
    assert sorted(map(tuple, got.changes.collect())) == sorted(map(tuple, want.changes.collect()))
    assert got.stats == {r.stat: r.value for r in sync.sync_stats(prep, want).collect()} and got.stats["orphan"] >= 1
    again = SS.sync_stored(store, _sheet(spark, second), KEYS, "2025-03-01 00:00:00", order=order)
    assert again.rewritten == [] and again.version == got.version       # nothing changed, nothing committed
    assert SS.sync_stored(store, _sheet(spark, []), KEYS, NOW2).rewritten == []   # an empty snapshot deletes nothing


def test_one_changed_row_rewrites_one_bucket(spark, store):
    rows = [(str(i), "a", 1.5) for i in range(200)]
    one = SS.sync_stored(store, _sheet(spark, rows), KEYS, NOW1, buckets=8)
    before = set(store.files(one.version, list(range(8))))
    two = SS.sync_stored(store, _sheet(spark, [*rows[:-1], ("199", "b", 1.5)]), KEYS, NOW2)
    after = set(store.files(two.version, list(range(8))))
    bucket = spark.createDataFrame([("199",)], "id string").select(bucket_of(KEYS, 8)).first()[0]
    assert two.rewritten == [bucket] and two.stats["update"] == 1
    assert len(before - after) == 1 and len(after - before) == 1
    assert store.read(one.version).where("name = 'b'").count() == 0 and store.read().where("name = 'b'").count() == 1
    assert store.vacuum(keep=1) >= 1 and store.read().count() == 200 and store.versions() == [two.version.number]


def test_reads_of_the_target_need_no_exchange(spark, store):
    rows = [(str(i), "a", 1.5) for i in range(50)]
    run = SS.sync_stored(store, _sheet(spark, rows), KEYS, NOW1, buckets=8)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        incoming = stored.write_bucketed(store.read().withColumn(stored.PART, F.lit("rows")), f"{store.path}/again", KEYS, 8).drop(stored.PART)
        plan = SS.merge_buckets(store, run.version, incoming, run.changes, list(range(8)), NOW2, "upsert_first")._jdf.queryExecution().executedPlan().toString()
        narrow = SS._decide(store.read(), incoming, 50, KEYS, 8, f"{store.path}/narrow")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for p in (plan, narrow):
        assert "SortMergeJoin" in p and "Bucketed: true" in p and "Exchange" not in p


def test_a_run_that_dies_leaves_the_old_version(spark, store, monkeypatch):
    rows = [(str(i), "a", 1.5) for i in range(20)]
    SS.sync_stored(store, _sheet(spark, rows), KEYS, NOW1, buckets=4)
    before = _rows(store.read())

    def dies(*_a, **_k):
        raise RuntimeError("killed before the commit")
    monkeypatch.setattr(store, "next", dies)
    with pytest.raises(RuntimeError):
        SS.sync_stored(store, _sheet(spark, [("1", "b", 2.5)]), KEYS, NOW2)
    monkeypatch.undo()
    assert _rows(store.read()) == before
    SS.sync_stored(store, _sheet(spark, [*rows[1:], ("0", "z", 1.5)]), KEYS, NOW2)
    assert store.read().where("name = 'z'").count() == 1 and store.read().count() == 20
    assert store.vacuum(keep=1) > 0 and store.read().count() == 20


def test_commits_and_loads_exclude_each_other(spark, store):
    df = _sheet(spark, [("1", "a", 1.5)])
    v, made = stored.ensure_stored(store, df.schema, KEYS, 4)
    assert made and stored.ensure_stored(store, df.schema, KEYS, 4) == (v, False)
    with pytest.raises(CommitConflict):
        store.commit(Version(1, df.schema, KEYS, 4, {}))
    # both loads have seen the empty table; the second commits late
    part = store.new_part(df, v)
    assert load_stored(store, df, KEYS, 4)
    with pytest.raises(CommitConflict):
        store.next(v, part, [0, 1, 2, 3])
    assert not load_stored(store, _sheet(spark, [("2", "b", 1.0)]), KEYS, 4)
    assert [r.id for r in store.read().collect()] == ["1"]
    with pytest.raises(FileNotFoundError):
        StoredTable(spark, store.path + "-none").read()


def test_the_sheet_is_read_once_and_all_rejects_stay(spark, store):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    n = 500
    sheet = spark.range(n).selectExpr("if(id % 3 = 0, ' ', cast(id as string)) as `Id `", "'a' as name", "cast(id as double) as amount")
    sheet = sheet.mapInPandas(count, sheet.schema)
    run = SS.sync_stored(store, sheet, KEYS, NOW1, buckets=4)
    assert seen.value == n
    assert store.read().schema["amount"].dataType.simpleString() == "bigint"          # typed by what was observed
    run.release()
    place = store.latest().info["rejects"]
    assert spark.read.parquet(place).count() == 167 == run.stats["dropped"]
    assert spark.read.option("header", True).csv(f"{place.split('/sheet/')[0]}/sample").count() == 100


def test_repeated_keys_headers_and_other_columns(spark, store):
    sheet = _sheet(spark, [(" 1 ", " a ", float("nan"), 1), ("2", "old", 2.0, 1), ("2", "new", 2.0, 2)], "`Id ` string, ` Name` string, Amount double, Row int")
    with pytest.raises(sync.DuplicateKeyError):
        SS.sync_stored(store, sheet, KEYS, NOW1, buckets=4)
    SS.sync_stored(store, sheet, KEYS, NOW1, on_duplicate_key="last", order_col="row", buckets=4)
    assert sorted((r.id, r.name, r.amount) for r in store.read().collect()) == [("1", "a", None), ("2", "new", 2)]
    with pytest.raises(ValueError):
        SS.sync_stored(store, _sheet(spark, [("1", "a", 1.5, 3)], ROWS + ", more int"), KEYS, NOW2)
    with pytest.raises(ValueError):
        SS.sync_stored(store, _sheet(spark, [("1", "a", 1.5)]), ["name"], NOW2)
    with pytest.raises(KeyError):
        SS.sync_stored(StoredTable(spark, store.path + "2"), _sheet(spark, [("1", "a", 1.5)]), ["nokey"], NOW2)


@pytest.mark.parametrize("mode", ["raw", "vectorized"])
def test_an_older_fingerprint_is_replaced_without_updates(spark, store, mode):
    wide, big = ROWS + ", n bigint", 12345678901   # eleven digits: the vectorised rule drops one
    rows = [("1", " padded ", None, big), ("2", None, 2.25, big), ("3", "x", 2.5, big), ("4", "gone", 1.0, big)]
    old = sync.add_audit_columns(sync.prepare_incoming(_sheet(spark, rows, wide), KEYS, NOW1, hash_mode=mode).rows, NOW1)
    load_stored(store, old, KEYS, 4, hash_mode=mode)
    frame = sync.prepare_incoming(_sheet(spark, [*rows[:2], ("3", "y", 2.5, big)], wide), KEYS, NOW2, accept=(mode,))
    ops = {r.id: r.op for r in sync.sync(store.read(), frame.rows, KEYS, NOW2).changes.collect()}
    assert ops == {"1": "rehash", "2": "rehash", "3": "update", "4": "delete"}
    sheet = _sheet(spark, [rows[1], ("3", "y", 2.5, big)], wide)
    run = SS.sync_stored(store, sheet, KEYS, NOW2)
    assert {r.id: r.op for r in run.changes.collect()} == {"1": "delete", "2": "rehash", "3": "update", "4": "delete"}
    kept = store.read().where("id = '2'").first()
    assert kept.updated_at.isoformat(" ") == NOW1 and store.latest().info["hash_mode"] == "canonical"
    assert SS.sync_stored(store, sheet, KEYS, NOW2).stats["unchanged"] == 2


def test_datasets_side_by_side(spark, tmpdir_path):
    for name, rows in (("good", [("1", "a", 1.5)]), ("twice", [("1", "a", 1.5), ("1", "b", 1.5)]), ("other", [("7", "z", 0.5)]), ("empty", [])):
        _sheet(spark, rows).write.parquet(f"{tmpdir_path}/in/{name}")
    sources = {n: f"{tmpdir_path}/in/{n}" for n in ("good", "twice", "other", "empty", "missing")}
    specs = {n: {"keys": KEYS, "buckets": 4} for n in (*sources, "unnamed")} | {"nokeys": {"buckets": 4}}
    out = SS.sync_sources(spark, sources, f"{tmpdir_path}/out", specs, NOW1)
    assert out["missing"] is None and out["empty"] is None and out["unnamed"] is None
    assert isinstance(out["twice"], sync.DuplicateKeyError) and isinstance(out["nokeys"], KeyError)
    for n, key in (("good", "1"), ("other", "7")):
        assert [r.id for r in StoredTable(spark, f"{tmpdir_path}/out/{n}").read().collect()] == [key]
    assert StoredTable(spark, f"{tmpdir_path}/out/twice").latest() is None


def test_bloom_filter_never_misses(spark):
    held = spark.range(3000).selectExpr("md5(cast(id as string)) as h")
    bits = bloom.filter_bits(3000)
    words = bloom.build(held.union(spark.createDataFrame([(None,)], "h string")), "h", bits)
    probe = spark.range(20000).selectExpr("id", "md5(cast(id as string)) as h")
    hit = probe.withColumn("hit", bloom.may_contain(words.scalar(), F.col("h"), bits))
    assert hit.where("id < 3000 and not hit").count() == 0
    assert hit.where("id >= 3000 and hit").count() < 17000 * 0.03
    assert bloom.filter_bits(10 ** 12) == bloom.MOST_BITS
