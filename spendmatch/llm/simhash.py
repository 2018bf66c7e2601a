"""SimHash near-duplicates found by covering locality-sensitive hashing.

Structured bit masks (one per non-zero vector of F2^(r+1)) guarantee that two
fingerprints within ``radius`` differing bits agree on at least one masked key.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ._components import connected_components
from ._work import Work

BITS = 64
SEED = 42
SHINGLE_CHUNK = 1 << 16  # shingles whose bits are expanded at once


def words(text: bytes | None) -> list[bytes]:
    """Lower-case A-Z and split on the six ASCII white-space characters."""
    return text.lower().split() if text else []


def fingerprint(text: bytes | None, n: int = 3) -> int:
    """Majority bits of XXH64 over n-word shingles; zero for a text without words."""
    ws = words(text)
    if not ws:
        return 0
    line = b" ".join(ws)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    m = max(1, len(ws) - n + 1)
    first, last = starts[:m].tolist(), ends[min(n, len(ws)) - 1:].tolist()
    ones, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for i in range(0, m, SHINGLE_CHUNK):
        h = np.array([digest(line[a:b], SEED) for a, b in zip(first[i:i + SHINGLE_CHUNK], last[i:i + SHINGLE_CHUNK])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > m, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the 64-bit fingerprint as a signed long, one row per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(1).cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, fp long")


def covering_masks(radius: int) -> list[int]:
    """One mask per non-zero v of F2^(radius+1): the bits i whose vector m(i) is orthogonal to v.

    Any ``radius`` differing bits give that many linear conditions on v, so some
    non-zero v is orthogonal to all of them and its mask hides every difference.
    """
    top = 1 << (radius + 1)
    vec = [i % (top - 1) + 1 for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (vec[i] & v).bit_count() % 2 == 0) for v in range(1, top)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def links(distinct: DataFrame, work: Work, radius: int = 2, max_bucket: int = 256) -> DataFrame:
    """Pairs (fp_a < fp_b) of distinct fingerprints at ``radius`` differing bits or fewer.

    A bucket of more than ``max_bucket`` fingerprints is not paired inside:
    its members are matched exactly through the ball of half the radius (two
    fingerprints within the radius share a centre there, and a centre has few
    members), so a hot key never makes a quadratic number of pairs.
    """
    masks = covering_masks(radius)
    keys = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks)
    ])).alias("k")).select("fp", "k.t", "k.key")
    sizes = keys.groupBy("t", "key").count().where("count > 1")
    held = work.table(keys.join(sizes, ["t", "key"]), "buckets")
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= radius

    def pairs(rows: DataFrame, on: list[str]) -> DataFrame:
        a, b = rows.alias("a"), rows.alias("b")
        same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on]
        cond = same[0] if len(same) == 1 else same[0] & same[1]
        return a.join(b, cond & (F.col("a.fp") < F.col("b.fp")) & near).select(
            F.col("a.fp").alias("fp_a"), F.col("b.fp").alias("fp_b"))

    half = (radius + 1) // 2
    ball = [sum(1 << i for i in c) for r in range(half + 1) for c in combinations(range(BITS), r)]
    hot = held.where(F.col("count") > max_bucket).select("fp").distinct().select(
        "fp", F.explode(F.array(*[F.lit(_signed(x)) for x in ball])).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))
    return pairs(held.where(F.col("count") <= max_bucket), ["t", "key"]).union(pairs(hot, ["centre"])).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, max_bucket: int = 256,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest doc_id reachable through links of
    ``radius`` bits or fewer.  NULL, empty and blank texts have fingerprint
    zero and link like any other; equal texts share one fingerprint.  Rows are
    what links, not ids: a row without an id links too and takes the smallest id
    of its component (NULL if no row there has one), and rows that share an id
    each have the component of their own text.  Other columns are ignored.
    """
    work = Work(docs.sparkSession, "simhash")
    fps = work.table(fingerprints(docs, shingle, id_col, text_col), "fps")
    distinct = work.table(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    # components of fingerprints, each then named by the smallest id that any of its rows has
    ends = links(distinct, work, radius, max_bucket).select(F.col("fp_a").alias("u"), F.col("fp_b").alias("v"))
    comp = connected_components(work, ends)
    work.drop("buckets")
    placed = distinct.join(comp, distinct.fp == comp.vertex, "left").select("fp", "rep", F.coalesce("component", "fp").alias("component"))
    names = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = placed.join(names, "component").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
