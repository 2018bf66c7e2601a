"""Best-fit packing of token pieces into fixed-size training sequences.

Vector best-fit: a sequence has residual capacities for tokens, documents and
attention cost (the sum of squared piece lengths); a piece goes to the open
sequence that fits under all three and has the best weighted score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ._tokens import tokenizer
from ._work import Work

END = 0
PIECE = "doc_id {id}, piece int, start long, length long, ids_crc32 long, ids array<int>"


def pieces(docs: DataFrame, path: str, longest: int, keep_ids: bool = False, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Every text as token ids and an end id, cut into pieces of ``longest`` ids (the last may be shorter)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for b in batches:
            out = [[], [], [], [], [], []]
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.append(tok.ids(text), np.uint32(END)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), longest)):
                    part = ids[at:at + longest]
                    for col, v in zip(out, (doc, k, at, len(part), zlib.crc32(part.tobytes()), part.astype(np.int32) if keep_ids else None)):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], b.schema.field(0).type), pa.array(out[1], pa.int32()), *(pa.array(c, pa.int64()) for c in out[2:5]),
                 pa.array(out[5], pa.list_(pa.int32()))], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, PIECE.format(id=rows.schema["doc_id"].dataType.simpleString()))


def best_fit(lengths: np.ndarray, capacity: int, max_docs: int, max_attention: int,
             weights: tuple[float, float, float] = (1.0, 0.1, 0.1), rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece; pieces are placed from the longest down.

    ``rule="norm"`` takes the sequence whose weighted residual is smallest after
    the placement, ``"dot"`` the one whose residual has the largest weighted dot
    product with the piece.  Capacities are normalised to one; ties go to the
    oldest sequence.
    """
    n = len(lengths)
    seq, offset = np.empty(n, np.int64), np.empty(n, np.int64)
    size = np.array([capacity, max_docs, max_attention], float)
    w = np.asarray(weights, float)
    left = np.empty((n + 1, 3))  # residuals of the open sequences
    name = np.empty(n + 1, np.int64)
    opened = made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = np.array([lengths[i], 1, float(lengths[i]) ** 2])
        at = -1
        if opened:
            r = left[:opened]
            fits = np.flatnonzero((r[:, 0] >= need[0]) & (r[:, 1] >= need[1]) & (r[:, 2] >= need[2]))
            if len(fits):
                if rule == "dot":
                    at = fits[np.argmax((r[fits] / size) @ (w * need / size))]
                else:
                    after = (r[fits] - need) / size
                    at = fits[np.argmin((after * after) @ w)]
        if at < 0:
            at, opened = opened, opened + 1
            left[at], name[at], made = size, made, made + 1
        seq[i], offset[i] = name[at], capacity - left[at, 0]
        left[at] -= need
        if left[at].min() < 1:  # closed: the last open sequence takes its place
            opened -= 1
            left[at], name[at] = left[opened], name[opened]
    return seq, offset


def pack(docs: DataFrame, path: str, capacity: int = 2048, max_docs: int | None = None, max_attention: int | None = None,
         weights: tuple[float, float, float] = (1.0, 0.1, 0.1), rule: str = "norm", group_pieces: int = 20_000,
         keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if kept).

    Pieces that fill a sequence alone are done; the others are dealt evenly to
    groups of about ``group_pieces``, and each group is packed by
    :func:`best_fit`, so a group leaves at most its last few sequences short and
    no task sees more than its group.  ``max_docs`` and ``max_attention``
    default to bounds that ``capacity`` tokens cannot pass; a tighter attention
    bound also shortens the pieces.  NULL and empty texts are one piece holding
    the end id; repeated ids and texts are packed row by row; no rows give no
    pieces; other columns are ignored.
    """
    max_docs = capacity if max_docs is None else max_docs
    max_attention = capacity ** 2 if max_attention is None else max_attention
    longest = min(capacity, isqrt(max_attention))
    work = Work(docs.sparkSession, "packing")
    cut = pieces(docs, path, longest, keep_ids, id_col, text_col)
    if not keep_ids:
        cut = cut.drop("ids")
    cut = work.table(cut, "pieces").withColumn("__row", F.monotonically_increasing_id())
    whole = cut.where(F.col("length") == capacity).select(
        "*", (F.col("__row") + (1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset")).drop("__row")
    rest = cut.where(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group_pieces))

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        group = int(rows.pop("__group").iloc[0])
        rows = rows.sort_values("__row", ignore_index=True).drop(columns="__row")
        seq, offset = best_fit(rows["length"].to_numpy(), capacity, max_docs, max_attention, weights, rule)
        return rows.assign(sequence_id=(group << 32) + seq, offset=offset)

    packed = rest.withColumn("__group", F.pmod(F.xxhash64("__row"), F.lit(groups))).groupBy("__group").applyInPandas(
        fill, whole.schema)
    return whole.unionByName(packed)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences of ``pack(..., keep_ids=True)``; each holds at most its capacity."""
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))
