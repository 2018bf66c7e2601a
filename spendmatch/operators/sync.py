"""Change-data sync of a table against a new full snapshot.

Two joins on the conflict keys, over one shuffle of the table, classify every
key as ``insert`` / ``update`` / ``unchanged`` / ``rehash`` (same content under
an accepted older fingerprint) / ``frozen`` (stored hash NULL: never updated) /
``delete`` (stale) / ``orphan`` (absent key whose hash still occurs among the
incoming hashes, so the hash-based delete keeps it, T14).
The new table, the change list and the statistics all derive from that one
classified frame; nothing is collected to the driver except the small
statistics.  The result is written to a new location (never over the path
being read) by :func:`write_synced`.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendmatch.functions.hashing import AUDIT_COLUMNS, hash_columns, row_hash
from spendmatch.operators.ingest import clean_keys, nan_to_null, normalize_columns, split_valid_keys, trim_strings
from spendmatch.operators.matching import spread
from spendmatch.session import materialize

OPS = ("insert", "update", "unchanged", "rehash", "frozen", "delete", "orphan")
OTHER_HASH = "row_hash_"   # prefix of fingerprints made by rules that are accepted beside the current one


class DuplicateKeyError(ValueError):
    pass


def add_audit_columns(df: DataFrame, now=None) -> DataFrame:
    """Ensure ``created_at`` (defaults to now), ``updated_at`` and ``row_hash`` exist."""
    now_c = F.lit(now).cast("timestamp_ntz") if now is not None else F.localtimestamp()
    add = {}
    if "created_at" not in df.columns:
        add["created_at"] = now_c
    if "updated_at" not in df.columns:
        add["updated_at"] = F.lit(None).cast("timestamp_ntz")
    if "row_hash" not in df.columns:
        add["row_hash"] = F.lit(None).cast("string")
    return df.withColumns(add) if add else df


def duplicate_keys(df: DataFrame, keys: list[str], at_least: int = 2) -> DataFrame:
    """C2 report: key combinations that occur more than once (partial aggregation)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_count")).filter(F.col("key_count") >= at_least)


def assert_unique(df: DataFrame, keys: list[str], name: str = "table") -> None:
    """The ``uq_<table>_<keys>`` constraint as a check (reads until the first duplicate)."""
    if not duplicate_keys(df, keys).isEmpty():
        raise DuplicateKeyError(f"uq_{name}_{'_'.join(keys)} violated")


def dedupe_last(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """C9 ``last``: keep the row with the greatest ``order_col`` per key.

    ``max_by`` is a partial aggregate, so a hot key is reduced map-side.
    """
    others = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order_col)).alias("_w"))
    return g.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in others]).select(*df.columns)


@dataclass
class Prepared:
    rows: DataFrame        # valid, hashed incoming rows (+ updated_at = now)
    rejected: DataFrame    # rows with a missing/empty key (D14)
    empty: bool | None = None   # whether there are no rows, where that is known


def prepare_incoming(df: DataFrame, keys: list[str], now, hash_mode: str = "canonical",
                     on_duplicate_key: str = "error", order_col: str | None = None, accept: tuple[str, ...] = (),
                     keep: str = "table") -> Prepared:
    """Clean keys, NaN to NULL, split off rejects, fingerprint rows (F17), stamp ``updated_at``.

    Repeated keys raise :class:`DuplicateKeyError`, or with ``"last"`` the row
    with the greatest ``order_col`` is taken (C9); ``order_col`` is not part of
    the fingerprint.  ``accept`` names other fingerprint rules; each adds a
    column ``row_hash_<rule>`` (see :func:`present_op`).  The prepared rows are
    written once (``keep="table"``), as the sync reads them several times;
    ``keep="none"`` leaves them lazy.
    """
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise KeyError(f"conflict keys {missing} not in columns {df.columns}")
    df = nan_to_null(clean_keys(df, keys))
    ok, bad = split_valid_keys(df, keys)
    if on_duplicate_key == "last":
        if not order_col:
            raise ValueError("on_duplicate_key='last' needs order_col")
        ok = dedupe_last(ok, keys, order_col)
    elif on_duplicate_key != "error":
        raise ValueError(f"unknown on_duplicate_key {on_duplicate_key!r}")
    rows = fingerprinted(ok, hash_mode, accept, order_col).withColumn("updated_at", F.lit(now).cast("timestamp_ntz"))
    rows = materialize(rows, "incoming") if keep == "table" else rows
    if on_duplicate_key == "error":   # one job tells whether keys repeat and whether there are any
        most = duplicate_keys(rows, keys, at_least=1).agg(F.max("key_count")).first()[0]
        if (most or 0) > 1:
            raise DuplicateKeyError(f"uq_incoming_{'_'.join(keys)} violated")
        return Prepared(rows, bad, most is None)
    return Prepared(rows, bad)


def fingerprinted(df: DataFrame, hash_mode: str = "canonical", accept: tuple[str, ...] = (), order_col: str | None = None) -> DataFrame:
    """``row_hash`` by the current rule and ``row_hash_<rule>`` by each accepted one."""
    cols = [c for c in hash_columns(df) if c != order_col]
    return df.withColumns({"row_hash": row_hash(df, cols, mode=hash_mode)}
                          | {f"{OTHER_HASH}{m}": row_hash(df, cols, mode=m) for m in accept if m != hash_mode})


def classify(target: DataFrame, incoming: DataFrame, keys: list[str], now,
             order: str = "upsert_first", incoming_empty: bool | None = None) -> DataFrame:
    """One row per key with ``op`` and the resulting row values (``_keep`` false for deleted rows).

    ``incoming`` must carry ``row_hash``; ``target`` carries the audit columns.
    """
    data_cols = [c for c in target.columns if c not in AUDIT_COLUMNS]
    extra = [c for c in incoming.columns if c not in data_cols and c not in AUDIT_COLUMNS and not c.startswith(OTHER_HASH)]
    if extra:
        # the source's INSERT fails on a new column: there is no schema evolution
        raise ValueError(f"incoming has columns the target lacks: {extra}")
    accepted = [c for c in incoming.columns if c.startswith(OTHER_HASH)]
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns])
    i = incoming.select(*[F.col(c).alias(f"i_{c}") for c in [*data_cols, "row_hash", *accepted]])
    on_key = reduce(and_, [F.col(f"t_{k}") == F.col(f"i_{k}") for k in keys])
    # rows the snapshot has: compared by hash, key by key
    present = t.join(i, on_key, "right_outer").withColumn("op", present_op(keys, accepted))
    # rows it lacks, and only those: does their hash occur among the incoming hashes (J16)?
    i_keys = incoming.select(*[F.col(k).alias(f"i_{k}") for k in keys])
    absent = t.join(i_keys, on_key, "left_anti")
    if incoming_empty:
        absent = absent.withColumn("op", F.lit("orphan"))
    else:
        hashes = incoming_hashes(incoming).withColumnRenamed("row_hash", "_h")
        absent = absent.join(hashes, spread("t_row_hash", t.columns) == F.col("_h"), "left").withColumn(
            "op", F.when(F.col("t_row_hash").isNull() | F.col("_h").isNotNull(), F.lit("orphan")).otherwise(F.lit("delete")))
    kept = absent.select(*[F.col(f"t_{c}").alias(c) for c in data_cols], *[F.col(f"t_{c}").alias(c) for c in AUDIT_COLUMNS], "op")
    out = present.select(*merged_columns(data_cols, now, order), "op").unionByName(kept)
    return out.withColumn("_keep", F.col("op") != "delete")


def present_op(keys: list[str], accepted: list[str]) -> Column:
    """The op of a key that the snapshot has, from columns ``t_...`` and ``i_...``.

    A stored hash equal to one made by another rule (``accepted``) marks the
    same content under an old fingerprint: ``rehash`` stores the new one and
    changes nothing else.
    """
    th, ih = F.col("t_row_hash"), F.col("i_row_hash")
    old = reduce(or_, [th == F.col(f"i_{c}") for c in accepted], F.lit(False))
    return (F.when(F.col(f"t_{keys[0]}").isNull(), F.lit("insert")).when(th.isNull(), F.lit("frozen"))
            .when(th == ih, F.lit("unchanged")).when(old, F.lit("rehash")).otherwise(F.lit("update")))


def incoming_hashes(incoming: DataFrame) -> DataFrame:
    """The distinct fingerprints of the snapshot, by every rule that is accepted."""
    cols = ["row_hash", *[c for c in incoming.columns if c.startswith(OTHER_HASH)]]
    if len(cols) == 1:
        return incoming.select("row_hash").distinct()
    return incoming.select(F.explode(F.array(*cols)).alias("row_hash")).where("row_hash is not null").distinct()


def merged_columns(data_cols: list[str], now, order: str) -> list[Column]:
    """Values and audit columns of a row after the sync, from columns ``t_...``, ``i_...`` and ``op``."""
    now_c, op = F.lit(now).cast("timestamp_ntz"), F.col("op")
    take_new = op.isin("insert", "update")
    created_new = now_c if order == "delete_first" else F.col("t_created_at")
    return [*[F.when(take_new, F.col(f"i_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in data_cols],
            F.when(op == "insert", now_c).when(op == "update", created_new).otherwise(F.col("t_created_at")).alias("created_at"),
            F.when(take_new, now_c).otherwise(F.col("t_updated_at")).alias("updated_at"),
            F.when(take_new | (op == "rehash"), F.col("i_row_hash")).otherwise(F.col("t_row_hash")).alias("row_hash")]


@dataclass
class SyncResult:
    table: DataFrame       # the new target (same columns as the target)
    changes: DataFrame     # keys + op for every key that was touched or inspected
    classified: DataFrame


def sync(target: DataFrame, incoming: DataFrame, keys: list[str], now, order: str = "upsert_first",
         incoming_empty: bool | None = None) -> SyncResult:
    """C5 (``upsert_first``) / C6 (``delete_first``): new table after upsert + stale delete.

    * new key -> inserted, ``created_at = updated_at = now``;
    * same key, stored hash differs -> non-key columns replaced,
      ``updated_at = now``; ``created_at`` kept (C5) or reset to now (C6, the
      legacy delete-then-insert order);
    * same key and hash, or stored hash NULL -> row untouched;
    * key absent from the snapshot -> deleted when its (non-NULL) hash is not
      among the incoming hashes; an empty snapshot never deletes anything.
    """
    if order not in ("upsert_first", "delete_first"):
        raise ValueError(f"unknown order {order!r}")
    if incoming_empty is None:
        incoming_empty = incoming.isEmpty()
    c = classify(target, incoming, keys, now, order=order, incoming_empty=incoming_empty)
    table = c.filter("_keep").select(*target.columns)
    changes = c.select(*keys, "op")
    return SyncResult(table, changes, c)


def upsert(target: DataFrame, incoming: DataFrame, keys: list[str], now) -> DataFrame:
    """C3 alone: inserts and hash-gated updates; nothing is deleted."""
    c = classify(target, incoming, keys, now, incoming_empty=True)
    return c.select(*target.columns)


def delete_stale(target: DataFrame, incoming: DataFrame, incoming_empty: bool | None = None) -> DataFrame:
    """C4 alone: drop rows whose non-NULL hash is not among the incoming hashes.

    Hash set membership is one outer join on the hash (J16/U4), in which rows
    without a hash are spread and match nothing; an empty snapshot keeps the
    table as is.
    """
    if incoming_empty is None:
        incoming_empty = incoming.isEmpty()
    if incoming_empty:
        return target
    hashes = incoming.select(F.col("row_hash").alias("_h")).filter(F.col("_h").isNotNull()).distinct()
    found = target.join(hashes, spread("row_hash", target.columns) == F.col("_h"), "left")
    return found.filter(F.col("row_hash").isNull() | F.col("_h").isNotNull()).select(*target.columns)


def sync_stats(prepared: Prepared, result: SyncResult) -> DataFrame:
    """C11: run statistics as (stat, value) rows — dropped keys, duplicate
    hashes, upserted, deleted, and the count of every op that occurred."""
    def stat(name: str, value):
        return F.struct(F.lit(name).alias("stat"), value.cast("bigint").alias("value"))

    zero, n = F.lit(0), F.col("n")
    dropped = prepared.rejected.agg(F.count(F.lit(1)).alias("n")).select(
        F.inline(F.array(stat("dropped", n), stat("upserted", zero), stat("deleted", zero))))
    repeated = prepared.rows.agg((F.count(F.lit(1)) - F.count_distinct("row_hash")).alias("n")).select(
        F.inline(F.array(stat("duplicate_hashes", n))))
    # one pass over the classified rows: a count per op, which also adds up to the two totals
    op = F.col("op")
    total = F.when(op.isin("insert", "update"), F.lit("upserted")).when(op == "delete", F.lit("deleted"))
    ops = result.classified.groupBy("op").agg(F.count(F.lit(1)).alias("n")).select(
        F.inline(F.array(F.struct(op.alias("stat"), n.alias("value")), F.struct(total.alias("stat"), n.alias("value")))))
    summed = dropped.unionByName(repeated).unionByName(ops.filter("stat is not null"))
    return summed.groupBy("stat").agg(F.sum("value").alias("value"))


def write_synced(result: SyncResult, out_path: str) -> None:
    """Write the new table to ``out_path`` (a new version; the source path is never overwritten)."""
    result.table.write.mode("errorifexists").parquet(out_path)


def sync_sheet(spark, sheet: DataFrame, target: DataFrame | None, keys: list[str], now, on_duplicate_key: str = "error",
               order_col: str | None = None, order: str = "upsert_first", hash_mode: str = "canonical",
               accept: tuple[str, ...] = ()) -> tuple[Prepared, SyncResult]:
    """One sheet end to end: headers, strings, types, keys, rejects, target, audit columns, key check, upsert, stale delete.

    ``keys`` and ``order_col`` name normalised headers.  An absent target (None)
    is an empty one with the sheet's columns; a target without audit columns
    gets them.  ``order_col`` only orders repeated keys and is not stored.
    """
    from spendmatch.sources.tables import infer_types

    df = infer_types(trim_strings(normalize_columns(sheet)))
    if target is not None:
        target = add_audit_columns(target, now)
        assert_unique(target, keys, "target")
    prep = prepare_incoming(df, keys, now, hash_mode, on_duplicate_key, order_col, accept)
    if order_col:
        prep = Prepared(prep.rows.drop(order_col), prep.rejected, prep.empty)
    if target is None:
        data = [c for c in prep.rows.columns if c not in AUDIT_COLUMNS and not c.startswith(OTHER_HASH)]
        target = add_audit_columns(prep.rows.select(*data).limit(0), now)
    return prep, sync(target, prep.rows, keys, now, order=order, incoming_empty=prep.empty)


def sync_many(spark, datasets: dict, now, writer=None) -> dict[str, object]:
    """Sync every named dataset with its own keys; one failure does not stop the rest.

    ``datasets[name] = {"target": DataFrame, "incoming": DataFrame, "keys": [...]}``;
    a dataset without keys is an error for that dataset only.  Returns, per
    name, the :class:`SyncResult` or the exception raised.
    """
    out: dict[str, object] = {}
    for name, spec in datasets.items():
        try:
            keys = spec.get("keys")
            if not keys:
                raise KeyError(f"no conflict keys defined for {name!r}")
            _, res = sync_sheet(spark, spec["incoming"], spec["target"], keys, now, order=spec.get("order", "upsert_first"))
            if writer is not None:
                writer(name, res)
            out[name] = res
        except Exception as exc:  # noqa: BLE001 - isolate one failing dataset
            out[name] = exc
    return out

