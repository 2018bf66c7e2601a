"""Sync of a sheet into a stored target.

The sheet is read once: cleaned rows and rejects are written in the target's
buckets, and what type inference needs to know is observed on the way.  From
then on every join and grouping is on the key between tables in the same
buckets, so nothing is shuffled but the few rows whose key the sheet lacks.
A narrow pass over keys and fingerprints decides what happens to each key; the
wide pass then reads and rewrites only the buckets that change.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendmatch.functions.hashing import AUDIT_COLUMNS
from spendmatch.operators import bloom
from spendmatch.operators.ingest import clean_keys, nan_to_null, normalize_columns, trim_strings, valid_keys_predicate
from spendmatch.operators.sync import (
    OTHER_HASH, assert_unique, dedupe_last, fingerprinted, incoming_hashes, merged_columns, present_op)
from spendmatch.session import drop_table
from spendmatch.sources.stored import PART, StoredTable, Version, bucket_of, ensure_stored, write_bucketed
from spendmatch.sources.tables import apply_types, read_tables, type_checks, write_reject_sample

CHANGES = ("insert", "update", "rehash", "delete")


@dataclass
class StoredSync:
    version: Version                 # what readers see now
    changes: DataFrame               # keys + op of every key
    rejected: DataFrame              # all rows without a usable key, as stored
    stats: dict[str, int]            # C11
    rewritten: list[int]             # the buckets that changed
    _store: StoredTable = field(repr=False, default=None)
    _work: list[str] = field(repr=False, default_factory=list)

    def release(self) -> None:
        """Delete the work tables of the run; ``changes`` cannot be read afterwards, the rejects can."""
        for path in self._work:
            drop_table(self._store.spark, path)


def _write_sheet(store: StoredTable, sheet: DataFrame, keys: list[str], buckets: int, path: str) -> tuple[DataFrame, DataFrame]:
    """(typed rows with keys, rejects): one scan of the sheet writes both and observes the types."""
    df = trim_strings(normalize_columns(sheet))
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise KeyError(f"conflict keys {missing} not in columns {df.columns}")
    floats = [f.name for f in df.schema.fields if f.name in keys and isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    df = clean_keys(df.withColumns({k: F.when(~F.isnan(k), F.col(k)) for k in floats}), keys)
    checks = type_checks(df.schema)
    seen = Observation(f"types-{uuid.uuid4().hex}")
    dealt = (df.observe(seen, *checks) if checks else df).repartition(buckets, *keys)
    part = F.when(F.coalesce(valid_keys_predicate(keys), F.lit(False)), F.lit("rows")).otherwise(F.lit("rejects"))
    stored = write_bucketed(dealt.withColumn(PART, part), path, keys, buckets)
    rows = stored.where(F.col(PART) == "rows").drop(PART)
    if checks and not stored.isEmpty():  # of an empty sheet nothing is observed
        rows = apply_types(rows, seen.get)
    return nan_to_null(rows), stored.where(F.col(PART) == "rejects").drop(PART)


def _prepare(rows: DataFrame, keys: list[str], buckets: int, path: str, on_duplicate_key: str, order_col: str | None, hash_mode: str,
             accept: tuple[str, ...]) -> DataFrame:
    """Fingerprinted rows with unique keys, written once in the target's buckets."""
    if on_duplicate_key == "last":
        if not order_col:
            raise ValueError("on_duplicate_key='last' needs order_col")
        rows = dedupe_last(rows, keys, order_col)
    elif on_duplicate_key != "error":
        raise ValueError(f"unknown on_duplicate_key {on_duplicate_key!r}")
    done = fingerprinted(rows, hash_mode, accept, order_col)
    done = write_bucketed(done.drop(order_col or "").withColumn(PART, F.lit("rows")), path, keys, buckets).drop(PART)
    if on_duplicate_key == "error":
        assert_unique(done, keys, "incoming")
    return done


def _on(keys: list[str], left: str = "t_", right: str = "i_"):
    return reduce(and_, [F.col(f"{left}{k}") == F.col(f"{right}{k}") for k in keys])


def _decide(target: DataFrame, incoming: DataFrame, n_incoming: int, keys: list[str], buckets: int, path: str) -> DataFrame:
    """(keys, op) for every key on either side, from keys and fingerprints alone.

    Only keys that the sheet lacks go through the hash test, and of those only
    the ones that a Bloom filter of the incoming fingerprints lets through.
    """
    accepted = [c for c in incoming.columns if c.startswith(OTHER_HASH)]
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in [*keys, "row_hash"]])
    i = incoming.select(*[F.col(c).alias(f"i_{c}") for c in [*keys, "row_hash", *accepted]])
    gone = F.col(f"i_{keys[0]}").isNull()
    op = F.when(gone & (F.col("t_row_hash").isNull() | F.lit(n_incoming == 0)), F.lit("orphan")).when(gone, F.lit("absent")).otherwise(
        present_op(keys, accepted))
    seen = t.join(i, _on(keys), "full_outer").withColumn("op", op).select(
        *[F.coalesce(f"t_{k}", f"i_{k}").alias(k) for k in keys], "op", F.when(F.col("op") == "absent", F.col("t_row_hash")).alias("hash"))
    seen = write_bucketed(seen.withColumn(PART, F.lit("seen")), f"{path}/seen", keys, buckets).drop(PART)
    bits = bloom.filter_bits(n_incoming)
    hashes = incoming_hashes(incoming)
    maybe = seen.where((F.col("op") == "absent") & bloom.may_contain(bloom.build(hashes, "row_hash", bits).scalar(), F.col("hash"), bits))
    kept = maybe.join(hashes, F.col("hash") == F.col("row_hash"), "left_semi").select(*[F.col(k).alias(f"k_{k}") for k in keys])
    named = kept.select(*[F.col(f"k_{k}").alias(k) for k in keys], F.lit("kept").alias(PART))
    kept = write_bucketed(named.repartition(buckets, *keys), f"{path}/kept", keys, buckets).drop(PART).toDF(*[f"k_{k}" for k in keys])
    found = seen.join(kept, reduce(and_, [F.col(k) == F.col(f"k_{k}") for k in keys]), "left")
    return found.select(*keys, F.when(F.col("op") != "absent", F.col("op")).when(F.col(f"k_{keys[0]}").isNotNull(), F.lit("orphan"))
                        .otherwise(F.lit("delete")).alias("op"))


def merge_buckets(store: StoredTable, base: Version, incoming: DataFrame, ops: DataFrame, changed: list[int], now, order: str) -> DataFrame:
    """The rows of the changed buckets after the sync; other buckets are not read."""
    keys, data = base.keys, [c for c in base.schema.fieldNames() if c not in AUDIT_COLUMNS]
    here = bucket_of(keys, base.buckets).isin(changed)
    doomed = ops.where((F.col("op") == "delete") & here).select(*[F.col(k).alias(f"d_{k}") for k in keys])
    t = store.read(base, changed).select(*[F.col(c).alias(f"t_{c}") for c in base.schema.fieldNames()])
    t = t.join(doomed, _on(keys, "t_", "d_"), "left_anti")
    rows = incoming.where(here)
    accepted = [c for c in rows.columns if c.startswith(OTHER_HASH)]
    i = rows.select(*[F.col(c).alias(f"i_{c}") for c in [*data, "row_hash", *accepted]])
    op = F.when(F.col(f"i_{keys[0]}").isNull(), F.lit("orphan")).otherwise(present_op(keys, accepted))
    return t.join(i, _on(keys), "full_outer").withColumn("op", op).select(*merged_columns(data, now, order))


def sync_stored(store: StoredTable, sheet: DataFrame, keys: list[str], now, on_duplicate_key: str = "error", order_col: str | None = None,
                order: str = "upsert_first", hash_mode: str = "canonical", buckets: int = 64) -> StoredSync:
    """One sheet into the stored target: clean, reject, type, fingerprint, create if absent, upsert, delete stale, commit.

    Semantics are those of :func:`spendmatch.operators.sync.sync`.  A target
    whose version names another fingerprint rule (``hash_mode`` of its commit)
    is compared by both, so equal content is stored under the new rule without
    counting as an update.  Rejects stay under the run's work folder, named by
    the commit, with a sample of 100 beside them.  A run that changes and
    rejects nothing commits nothing; one that finds its base version superseded raises
    :class:`~spendmatch.sources.stored.CommitConflict` and leaves no trace in the table.
    """
    if order not in ("upsert_first", "delete_first"):
        raise ValueError(f"unknown order {order!r}")
    base = store.latest()
    if base is not None and base.keys != list(keys):
        raise ValueError(f"{store.path} is keyed by {base.keys}, not {keys}")
    n = base.buckets if base else buckets
    stored_mode = base.info.get("hash_mode", hash_mode) if base else hash_mode
    run = f"{store.path}/runs/{uuid.uuid4().hex}"

    rows, rejected = _write_sheet(store, sheet, keys, n, f"{run}/sheet")
    incoming = _prepare(rows, keys, n, f"{run}/incoming", on_duplicate_key, order_col, hash_mode, (stored_mode,))
    data = [f for f in incoming.schema.fields if f.name not in AUDIT_COLUMNS and not f.name.startswith(OTHER_HASH)]
    if base is None:
        base, _ = ensure_stored(store, T.StructType([*data, T.StructField("created_at", T.TimestampNTZType()), T.StructField(
            "updated_at", T.TimestampNTZType()), T.StructField("row_hash", T.StringType())]), keys, n, hash_mode=hash_mode)
    names = [c for c in base.schema.fieldNames() if c not in AUDIT_COLUMNS]
    if sorted(names) != sorted(f.name for f in data):
        raise ValueError(f"the sheet has columns {sorted(f.name for f in data)}, the target {sorted(names)}")

    tally = incoming.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_hash").alias("h")).first()
    n_rejected = rejected.count()
    ops = _decide(store.read(base), incoming, tally.n, keys, n, run)
    counted = ops.groupBy("op", bucket_of(keys, n).alias("bucket")).count().collect()   # at most ops x buckets rows
    stats = {"dropped": n_rejected, "duplicate_hashes": tally.n - tally.h, "upserted": 0, "deleted": 0}
    for r in counted:
        stats[r.op] = stats.get(r.op, 0) + r["count"]
    stats["upserted"] = stats.get("insert", 0) + stats.get("update", 0)
    stats["deleted"] = stats.get("delete", 0)
    changed = sorted({r.bucket for r in counted if r.op in CHANGES})

    if n_rejected:
        write_reject_sample(rejected, run)
    if changed or n_rejected:
        part = store.new_part(merge_buckets(store, base, incoming, ops, changed, now, order), base) if changed else None
        # a bucket with a frozen or orphaned row may keep an older fingerprint, so the old rule stays accepted then
        mode = stored_mode if stored_mode != hash_mode and stats.get("orphan") else hash_mode
        base = store.next(base, part, changed, hash_mode=mode, stats=stats, rejects=f"{run}/sheet/{PART}=rejects")
    return StoredSync(base, ops, rejected, stats, changed, store, [f"{run}/{d}" for d in ("incoming", "seen", "kept", f"sheet/{PART}=rows")])


def sync_sources(spark: SparkSession, sources: dict[str, str], root: str, datasets: dict[str, dict], now, pool: int = 3,
                 fmt: str = "parquet") -> dict[str, StoredSync | Exception | None]:
    """The multi-sheet run (S1 + C7): each dataset read by name and synced into ``root/<name>``, ``pool`` at a time.

    ``datasets[name]`` holds the arguments of :func:`sync_stored` (``keys`` is
    required).  A source that is missing, unreadable or empty is skipped
    (None); a dataset that fails gives its exception and leaves its target
    alone; the others commit.  Each dataset has a session and work folders of
    its own, so settings and tables do not meet.
    """
    def one(name: str) -> StoredSync | Exception | None:
        try:
            own = spark.newSession()
            for k in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
                own.conf.set(k, spark.conf.get(k))
            spec = dict(datasets[name])
            if not spec.get("keys"):
                raise KeyError(f"no conflict keys defined for {name!r}")
            sheet = read_tables(own, sources, [name], fmt).get(name)
            return None if sheet is None else sync_stored(StoredTable(own, f"{root.rstrip('/')}/{name}"), sheet, now=now, **spec)
        except Exception as exc:  # noqa: BLE001 - one failing dataset does not stop the rest
            return exc
    with ThreadPoolExecutor(pool) as threads:
        return dict(zip(datasets, threads.map(one, datasets)))
