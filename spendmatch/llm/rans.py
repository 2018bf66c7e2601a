"""Token ids in a binary format coded by a static range asymmetric numeral system.

One frequency table is shared by all files.  A block is coded by itself over
``LANES`` interleaved states and carries checkpoints (states and read position
every ``EVERY`` steps) and a checksum, so blocks, and the parts of a block, can
be decoded in parallel.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ._tokens import tokenizer
from ._work import Work

END = 0
MAGIC = b"RNS1"
HEADER = struct.Struct("<4sIIHHHI")  # magic, ids, words, lanes, steps a checkpoint, checkpoints, crc32 of the ids
PRECISION = 20  # the frequencies sum to 2^20
LOW = 1 << 31  # states stay in [2^31, 2^63)
LANES, EVERY, BLOCK = 1024, 64, 1 << 18


class Table:
    """Frequencies of the ids present, scaled to 2^PRECISION with at least one each."""

    def __init__(self, counts: dict[int, int]):
        total = 1 << PRECISION
        if len(counts) > total:
            raise ValueError("more distinct ids than the frequency table has places")
        ids = np.array(sorted(counts), np.int64)
        seen = np.array([counts[i] for i in ids.tolist()], float)
        freq = np.maximum(1, np.floor(seen * (total / seen.sum() if len(ids) else 1))).astype(np.int64)
        while len(ids) and (off := total - int(freq.sum())):  # what rounding left goes to or comes from the largest
            big = np.argsort(-freq, kind="stable")[:max(1, min(len(freq), abs(off)))]
            step = np.sign(off) * max(1, abs(off) // len(big))
            freq[big] = np.maximum(1, freq[big] + step) if abs(step) * len(big) <= abs(off) else freq[big]
        size = int(ids[-1]) + 1 if len(ids) else 1
        self.freq, self.start = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.freq[ids] = freq
        self.start[ids] = np.cumsum(freq) - freq
        self.symbol = np.repeat(ids, freq).astype(np.uint32)


def encode(ids: np.ndarray, table: Table, lanes: int = LANES, every: int = EVERY) -> bytes:
    """One block: id i belongs to lane i % lanes at step i // lanes; coded from the last step to the first."""
    n = len(ids)
    steps = -(-n // lanes)
    x = np.full(lanes, LOW, np.uint64)
    bits, word, low = np.uint64(PRECISION), np.uint64(32), np.uint64(0xFFFFFFFF)
    freq, start = table.freq[ids], table.start[ids]
    limit = freq << np.uint64(63 - PRECISION)
    words, marks = [None] * steps, {}
    for t in range(steps - 1, -1, -1):
        a, b = t * lanes, min(n, (t + 1) * lanes)
        y, f = x[:b - a], freq[a:b]
        over = y >= limit[a:b]
        words[t] = (y[over] & low).astype("<u4")
        y = np.where(over, y >> word, y)
        q = y // f
        x[:b - a] = (q << bits) + (y - q * f) + start[a:b]
        if t % every == 0:
            marks[t] = x.astype("<u8").tobytes()
    at = np.concatenate(([0], np.cumsum([len(w) for w in words], dtype=np.int64))) if steps else np.zeros(1, np.int64)
    points = [struct.pack("<I", at[t]) + marks[t] for t in sorted(marks)]
    body = b"".join([*points, *(w.tobytes() for w in words)])
    return HEADER.pack(MAGIC, n, int(at[-1]), lanes, every, len(points), zlib.crc32(ids.astype("<u4").tobytes())) + body


def decode(block: bytes, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids between checkpoints ``first`` and ``last`` (to the end without one); the whole block is checked by its checksum."""
    magic, n, n_words, lanes, every, points, crc = HEADER.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a block of this format")
    if not points:
        return np.empty(0, "<u4")
    size = 4 + 8 * lanes
    words = np.frombuffer(block, "<u4", n_words, HEADER.size + points * size).astype(np.uint64)
    head = HEADER.size + first * size
    pos = struct.unpack_from("<I", block, head)[0]
    x = np.frombuffer(block, "<u8", lanes, head + 4).astype(np.uint64)
    bits, slots, word = np.uint64(PRECISION), np.uint64((1 << PRECISION) - 1), np.uint64(32)
    end = n if last is None else min(n, last * every * lanes)
    begin = first * every * lanes
    out = np.empty(end - begin, "<u4")
    for a in range(begin, end, lanes):
        k = min(n - a, lanes)
        y = x[:k]
        slot = y & slots
        s = table.symbol[slot]
        out[a - begin:a - begin + k] = s
        y = table.freq[s] * (y >> bits) + slot - table.start[s]
        need = np.flatnonzero(y < LOW)
        y[need] = (y[need] << word) | words[pos:pos + len(need)]
        pos += len(need)
        x[:k] = y
    if first == 0 and end == n and zlib.crc32(out.tobytes()) != crc:
        raise ValueError("a block's ids do not match its checksum")
    return out


def _tokenized(docs: DataFrame, path: str, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, ids) in ascending id order, ids as little-endian bytes with the end id."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # the hash only deals rows of one id to several tasks
    rows = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for b in batches:
            ids = [np.append(tok.ids(t), np.uint32(END)).astype("<u4").tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.large_binary()).cast(pa.binary())], names=["doc_id", "ids"])
    return rows.mapInArrow(run, "doc_id long, ids binary")


def _counts(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            c = np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), "<u4"))
            if len(c) > len(total):
                total = np.concatenate((total, np.zeros(len(c) - len(total), np.int64)))
            total[:len(c)] += c
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])
    return rows.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


BLOCKS = "first_row long, doc_ids array<long>, lengths array<long>, n_ids long, payload binary"


def write(docs: DataFrame, path: str, work: Work, lanes: int = LANES, every: int = EVERY, block: int = BLOCK,
          id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Encode every text; returns (blocks, frequencies), both written tables.

    A block row holds whole documents, ``block`` ids or a little more, and its
    payload in the binary format; ``first_row`` orders the blocks.
    """
    held = work.table(_tokenized(docs, path, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id", "ids"), "ids")
    freq = work.table(_counts(held), "frequencies")  # one row per vocabulary id
    table = docs.sparkSession.sparkContext.broadcast(load(freq))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["first_row", "doc_ids", "lengths", "n_ids", "payload"]

        def made(rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
            ids = np.concatenate([r[2] for r in rows])
            return pa.RecordBatch.from_arrays(
                [pa.array([rows[0][0]], pa.int64()), pa.array([[r[1] for r in rows]], pa.list_(pa.int64())),
                 pa.array([[len(r[2]) for r in rows]], pa.list_(pa.int64())), pa.array([len(ids)], pa.int64()),
                 pa.array([encode(ids, table.value, lanes, every)], pa.binary())], names=names)

        open_rows, n = [], 0
        for b in batches:
            for row, doc, ids in zip(*(b.column(i).to_pylist() for i in range(3))):
                if open_rows and (n >= block or row != open_rows[-1][0] + 1):
                    yield made(open_rows)
                    open_rows, n = [], 0
                open_rows.append((row, doc, np.frombuffer(ids, "<u4")))
                n += len(open_rows[-1][2])
        if open_rows:
            yield made(open_rows)
    blocks = work.table(held.mapInArrow(run, BLOCKS), "blocks")
    work.drop("ids")
    return blocks, freq


def load(freq: DataFrame) -> Table:
    """The shared table from its written frequencies (one row per id of the vocabulary, so bounded)."""
    return Table({r.id: r.n for r in freq.collect()})


def read_back(blocks: DataFrame, freq: DataFrame) -> DataFrame:
    """Decode all blocks: one row per document with doc_id, start, n_tokens, ids_crc32."""
    table = blocks.sparkSession.sparkContext.broadcast(load(freq))
    # ids before a block: whole parts before its part (one total per written part), and blocks before it in the part
    part = F.shiftright("first_row", 33)
    totals = blocks.groupBy(part.alias("part")).agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    base, at = [], 0
    for r in totals:
        base.append((r.part, at))
        at += r.n
    from pyspark.sql import Window
    offsets = blocks.sparkSession.createDataFrame(base, "part long, base long")
    before = F.sum("n_ids").over(Window.partitionBy("part").orderBy("first_row")) - F.col("n_ids")
    order = blocks.select("first_row", "n_ids", part.alias("part")).withColumn("before", before).join(
        F.broadcast(offsets), "part").select("first_row", (F.col("base") + F.col("before")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, docs, lengths, payload in zip(*(b.column(i).to_pylist() for i in range(4))):
                ids = decode(payload, table.value)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                crc = [zlib.crc32(ids[a:e].tobytes()) for a, e in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first] * len(docs), pa.int64()), pa.array(docs, pa.int64()), pa.array(starts, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())],
                    names=["first_row", "doc_id", "within", "n_tokens", "ids_crc32"])
    rows = blocks.select("first_row", "doc_ids", "lengths", "payload").mapInArrow(
        run, "first_row long, doc_id long, within long, n_tokens long, ids_crc32 long")
    return rows.join(order, "first_row").select("doc_id", (F.col("at") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` in the format and read the files back: one row per document.

    NULL and empty texts are the end id alone; NULL ids come first and repeated
    ids keep one row each; no documents give no blocks and no rows; other
    columns are ignored.
    """
    work = Work(docs.sparkSession, "rans")
    return read_back(*write(docs, path, work, id_col=id_col, text_col=text_col))
