"""Fill-in-middle transformation with line units found by word-parallel arithmetic (SWAR).

The UTF-8 of many texts is viewed as 64-bit words.  One mask per word marks the
bytes that end a line, a population count per word gives running totals, a
search in those finds the word of the k-th line end, and clearing low bits finds
the byte inside it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SLAB = 16 << 20  # bytes indexed at once; a longer text is a slab of its own
_LOW7, _TOP, _EACH = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080), np.uint64(0x0101010101010101)
_ONE = np.uint64(1)


def byte_marks(byte: int) -> Callable[[np.ndarray], np.ndarray]:
    """Words with the top bit set in exactly the bytes equal to ``byte``."""
    def marks(words: np.ndarray) -> np.ndarray:
        x = words ^ (_EACH * np.uint64(byte))  # zero where equal
        return ~(((x & _LOW7) + _LOW7) | x | _LOW7)
    return marks


def continuation_marks(words: np.ndarray) -> np.ndarray:
    """Words with the top bit set in the bytes 10xxxxxx, which continue a code point."""
    return words & ~(words << _ONE) & _TOP


class Marked:
    """Rank and select over the marked bytes of a buffer."""

    def __init__(self, data: bytes, marks: Callable[[np.ndarray], np.ndarray]):
        size = len(data) // 8 * 8
        body, tail = np.frombuffer(data, "<u8", size // 8), np.frombuffer(data[size:].ljust(8, b"\0"), "<u8")
        self.words = marks(np.concatenate((body, tail)))
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes before each offset."""
        w, bits = at >> 3, ((at & 7) << 3).astype(np.uint64)
        return self.before[w] + np.bitwise_count(self.words[w] & ((_ONE << bits) - _ONE))

    def select(self, k: np.ndarray) -> np.ndarray:
        """Offset of the k-th marked byte, from 0."""
        w = np.searchsorted(self.before, k, side="right") - 1
        left, m = k - self.before[w], self.words[w]
        for i in range(7):  # clear the marks before the wanted one; a word holds eight at most
            m = np.where(left > i, m & (m - _ONE), m)
        return (w << 3) + (np.bitwise_count((m & (~m + _ONE)) - _ONE) >> 3).astype(np.int64)


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers below 2^32 from the id alone, so a rerun cuts alike."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in (0, 8, 16, 24)]


def cut(ids: list[int | None], texts: list[bytes], seed: int, rate: int, spm_rate: int) -> list[tuple]:
    """Per text (n, form, prefix_chars, middle_chars, output)."""
    data = b"".join(texts)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    starts = np.concatenate(([0], ends[:-1]))
    lines, inner = Marked(data, byte_marks(0x0A)), Marked(data, continuation_marks)
    first = lines.rank(starts)
    closed = lines.rank(ends) - first
    units = closed + [bool(t) and t[-1:] != b"\n" for t in texts]
    h = np.array([draws(i, seed) for i in ids], np.int64).reshape(-1, 4)
    marks = np.sort(h[:, :2] % (units + 1)[:, None], axis=1)

    def place(u: np.ndarray) -> np.ndarray:
        """Where the first u units of each text end."""
        at = np.where(u > closed, ends, starts)
        inside = (u > 0) & (u <= closed)
        at[inside] = lines.select((first + u - 1)[inside]) + 1
        return at

    a, b = place(marks[:, 0]), place(marks[:, 1])
    chars = [(y - x) - (inner.rank(y) - inner.rank(x)) for x, y in ((starts, a), (a, b))]
    spm = h[:, 3] % 100 < spm_rate
    plain = (starts == ends) | (h[:, 2] % 100 >= rate)
    out = []
    for i, t in enumerate(texts):
        if plain[i] or PREFIX in t or SUFFIX in t or MIDDLE in t:
            out.append((int(units[i]), "plain", None, None, t))
            continue
        x, y = int(a[i] - starts[i]), int(b[i] - starts[i])
        prefix, suffix = PREFIX + t[:x], SUFFIX + t[y:]
        head = (suffix, prefix) if spm[i] else (prefix, suffix)
        out.append((int(units[i]), "spm" if spm[i] else "psm", int(chars[0][i]), int(chars[1][i]), b"".join((*head, MIDDLE, t[x:y]))))
    return out


MADE = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())]


def _slabs(ids: list, texts: list[bytes]) -> Iterator[tuple[list, list[bytes]]]:
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > SLAB:
            yield ids[at:i], texts[at:i]
            at, size = i, 0
        size += len(t)
    yield ids[at:], texts[at:]


def transform(docs: DataFrame, seed: int = 7, rate: int = 100, spm_rate: int = 50, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``docs`` with n (lines), form, prefix_chars, middle_chars and output, the training text.

    A text of n lines is cut after two line counts drawn from its id and
    ``seed``; ``rate`` per cent of the texts are rearranged, ``spm_rate`` per
    cent of those with the suffix first.  Texts that are empty or hold a
    marker stay plain, with NULL lengths.

    NULL texts count as empty, with output ''.  A NULL id draws as ''; equal ids
    draw alike.  Rows are independent, so repeated ones repeat.  Input columns
    named like the five new ones are replaced.
    """
    docs = docs.drop(*[f.name for f in MADE])
    schema = T.StructType([*docs.schema.fields, *MADE])
    i, t = docs.columns.index(id_col), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or b"" for x in batch.column(t).cast(pa.binary()).to_pylist()]
            rows = [r for s in _slabs(batch.column(i).to_pylist(), texts) if s[1] for r in cut(*s, seed, rate, spm_rate)]
            n, form, prefix, middle, output = zip(*rows) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())], names=schema.names)
    return docs.mapInArrow(run, schema)


def restore(form: Column, output: Column) -> Column:
    """The text again, from the form and the output alone."""
    parts = F.split(output, "<[PSM]>", -1)
    order = F.when(form == "psm", F.array(parts[1], parts[3], parts[2])).otherwise(F.array(parts[2], parts[3], parts[1]))
    return F.when(form == "plain", output).otherwise(F.array_join(order, ""))


def report(done: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: form, lengths and digests of output and restored text."""
    return done.select(F.col(id_col).alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restore(F.col("form"), F.col("output")), 256).alias("restored_sha256"))
