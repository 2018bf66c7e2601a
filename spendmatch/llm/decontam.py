"""Benchmark decontamination with a broadcast set of normalised test n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ._work import Work

# a word: digits, letters a-z after lower-casing A-Z, and everything outside ASCII
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_NORMAL).split() if text else []


class WindowSet:
    """The test windows of one block: word ids, and per window length a map to item ids."""

    def __init__(self, items: list[tuple[str, bytes]], n: int):
        self.ids: dict[bytes, int] = {}
        self.windows: dict[int, dict[bytes, list[str]]] = {}
        for item, text in items:
            ws = words(text)
            if not ws:
                continue
            row = np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in ws], np.int32)
            size = min(n, len(ws))
            held = self.windows.setdefault(size, {})
            for i in range(len(ws) - size + 1):
                owners = held.setdefault(row[i:i + size].tobytes(), [])
                if not owners or owners[-1] != item:
                    owners.append(item)
        self.heads = {k: np.unique([np.frombuffer(w, np.int32, 1)[0] for w in d]) for k, d in self.windows.items()}

    def scan(self, text: bytes | None) -> tuple[int, list[int], list[str]]:
        """(number of words, positions of hit words, ids of the items that occur)."""
        ws = words(text)
        n = len(ws)
        if not n:
            return 0, [], []
        row = np.fromiter(map(self.ids.get, ws, repeat(0)), np.int32, n)
        known = np.concatenate(([0], np.cumsum(row > 0)))
        cover, items = np.zeros(n + 1, np.int64), set()
        for size, held in self.windows.items():
            if size > n:
                continue
            # only windows made of test words throughout, and opened by a test window's first word, are looked up
            at = np.flatnonzero(known[size:] - known[:-size] == size)
            at = at[np.isin(row[at], self.heads[size])]
            for i in at.tolist():
                owners = held.get(row[i:i + size].tobytes())  # the key is the whole window: a find is a verified hit
                if owners:
                    cover[i] += 1
                    cover[i + size] -= 1
                    items.update(owners)
        return n, np.flatnonzero(np.cumsum(cover[:-1])).tolist(), sorted(items)


def cut(text: bytes, hit: list[int]) -> bytes:
    """The text without its hit words; a run of neighbouring hit words goes with what stands between them."""
    spans = [m.span() for m in WORD.finditer(text)]
    out, at, k = [], 0, 0
    while k < len(hit):
        j = k
        while j + 1 < len(hit) and hit[j + 1] == hit[j] + 1:
            j += 1
        out.append(text[at:spans[hit[k]][0]])
        at, k = spans[hit[j]][1], j + 1
    return b"".join([*out, text[at:]])


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, max_words: int) -> list[list[tuple[str, bytes]]]:
    """The test set in blocks of at most ``max_words`` words (or one item), each small enough to broadcast."""
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                            F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // (2 * max_words)))  # a word and its separator take two bytes or more
    return [[(r.item, r.text.encode()) for r in
             rows.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k).where("text is not null").toLocalIterator()]
            for k in range(n)] if n > 1 else [[(r.item, r.text.encode()) for r in rows.where("text is not null").collect()]]


FOUND = [T.StructField("n_words", T.LongType()), T.StructField("hit_words", T.ArrayType(T.IntegerType())),
         T.StructField("items", T.ArrayType(T.StringType()))]


def _scan_block(docs: DataFrame, block: list[tuple[str, bytes]], n: int, text_col: str, clean: bool) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(WindowSet(block, n))
    schema = T.StructType([*docs.schema.fields, *FOUND])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).cast(pa.binary()).to_pylist()
            found = [held.value.scan(t) for t in texts]
            cols = list(b.columns)
            if clean:
                cols[at] = pa.array([t if not f[1] else cut(t, f[1]) for t, f in zip(texts, found)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.int32())),
                 pa.array([f[2] for f in found], pa.list_(pa.string()))], names=schema.names)
    return docs.mapInArrow(run, schema)


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10, item_col: str = "item_id", text_col: str = "text",
         max_words: int = 2_000_000, remove: bool = False) -> DataFrame:
    """``docs`` with n_words, hit_words (positions) and items (ids of the test items that occur, sorted).

    A test window is ``n`` consecutive words of an item; an item of fewer words
    is one window, an item without words none.  Up to ``max_words`` words of
    the test set (its byte size is checked first) are broadcast at a time; a
    larger test set is matched block by block over all rows, with the same
    result.  ``remove=True`` cuts the hit words out of the text.

    NULL and empty texts have no words; a NULL item id counts as ''.  Repeated
    documents and items are handled row by row.  Input columns named n_words,
    hit_words or items are replaced.
    """
    docs = docs.drop("n_words", "hit_words", "items")
    blocks = _blocks(benchmark, item_col, text_col, max_words)
    if len(blocks) == 1:
        return _scan_block(docs, blocks[0], n, text_col, remove)
    work = Work(docs.sparkSession, "decontam")
    kept = work.table(docs.withColumn("__row", F.monotonically_increasing_id()), "docs")
    parts = [work.table(_scan_block(kept.select("__row", text_col), b, n, text_col, False).drop(text_col).where(
        F.size("hit_words") > 0), f"block{k}") for k, b in enumerate(blocks)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    found = rows.groupBy("__row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_words")))).alias("hit_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    out = kept.join(found, "__row", "left").drop("__row")
    empty = F.array().cast("array<int>")
    out = out.withColumn("hit_words", F.coalesce("hit_words", empty)).withColumn(
        "items", F.coalesce("items", F.array().cast("array<string>")))
    return _finish(out, docs, text_col, remove)


def _finish(rows: DataFrame, docs: DataFrame, text_col: str, clean: bool) -> DataFrame:
    """Count the words and, if asked, cut: the last step of the block-by-block way."""
    schema = T.StructType([*docs.schema.fields, *FOUND])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = {c: b.column(i) for i, c in enumerate(b.schema.names)}
            texts, hits = d[text_col].cast(pa.binary()).to_pylist(), d["hit_words"].to_pylist()
            d["n_words"] = pa.array([len(words(t)) for t in texts], pa.int64())
            if clean:
                d[text_col] = pa.array([t if not h else cut(t, h) for t, h in zip(texts, hits)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([d[c] for c in schema.names], names=schema.names)
    return rows.mapInArrow(run, schema)


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: what ``scan`` found, as counts and a digest of the item ids."""
    return found.select(
        F.col(id_col).alias("doc_id"), "n_words", F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"))
