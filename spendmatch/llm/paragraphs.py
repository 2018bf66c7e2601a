"""Substring dedup: paragraphs found again through MinHash banding, verified and clustered."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from . import _spans
from ._components import connected_components
from ._work import Work, session_conf

SHINGLE = 5
ANCHORS = 24  # of so many successive word places one is an anchor
MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xD6E8FEB86659FD93)
BLANK = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))  # of every byte
PLACE = 24  # low bits of a hash that give way to its place in the text
SLAB = 20_000  # rows held before they are handed on
FOUND = "doc_id long, paragraph int, start int, length int, n_words int, key binary, bands array<long>, inside boolean"


def tune_bands(threshold: float = 0.8, recall: float = 0.999, most: int = 64) -> tuple[int, int]:
    """(bands, rows): the most selective banding of at most ``most`` hashes that reaches ``recall`` at the threshold."""
    for rows in range(most, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows)) if threshold < 1 else 1
        if bands * rows <= most:
            return bands, rows
    raise ValueError("too few hashes for this recall")


def split(text: str, min_words: int, wrapped: bool = False) -> tuple[list[bytes], list[tuple[int, int, int, int, int]]]:
    """The lower-case words of a text, and (number, start, length, first word, end word) of its lines of ``min_words`` words or more.

    With ``wrapped`` also of the blocks of shorter lines, joined up to the next
    blank or long line; a block has the number of its first line.
    """
    words: list[bytes] = []
    out: list[tuple[int, int, int, int, int]] = []
    at = 0
    block: tuple[int, int, int, int, int] | None = None
    for k, (line, low) in enumerate(zip(text.split("\n"), text.encode().lower().split(b"\n"))):
        ws = low.split()
        m = len(words)
        words += ws
        if wrapped and 0 < len(ws) < min_words:
            number, start, _, first, _ = block or (k, at, 0, m, m)
            block = number, start, at + len(line) - start, first, len(words)
        elif block:
            if m - block[3] >= min_words:
                out.append(block)
            block = None
        if len(ws) >= min_words:
            out.append((k, at, len(line), m, len(words)))
        at += len(line) + 1
    if block and len(words) - block[3] >= min_words:
        out.append(block)
    return words, out


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """One hash for every ``n`` successive words, from the hashes of the words (fewer words: none)."""
    m = max(0, len(h) - n + 1)
    rolled = np.zeros(m, np.uint64)
    for j in range(n):
        rolled = (rolled ^ h[j:j + m]) * MIX
        rolled ^= rolled >> np.uint64(29)
    return rolled


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(h: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the n-word shingles of a paragraph with these word hashes (fewer words: the whole sequence)."""
    return np.unique(windows(h, min(n, len(h))))


def anchored(text: str, n: int, h: np.ndarray, rolled: np.ndarray, window: int = ANCHORS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers of the first word, starts, lengths) of passages of ``n`` words, whatever the lines.

    ``h`` are the hashes of the text's words and ``rolled`` those of its shingles.

    A passage starts at the place with the smallest hash of ``SHINGLE`` words
    among some ``window`` successive places, so any ``n + window - 1`` words hold
    one, and it is the same one wherever these words stand.
    """
    m = len(h) - n + 1
    if m < 1:
        return (np.empty(0, np.int64),) * 3
    mask = np.uint64((1 << max(PLACE, m.bit_length())) - 1)
    low = ((rolled[:m] if n >= SHINGLE else windows(h, n)) & ~mask) | np.arange(m, dtype=np.uint64)  # the leftmost of equal ones is smallest
    span = 1
    while span < min(window, m):  # the smallest of ``span`` successive places
        step = min(span, min(window, m) - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    at = (low & mask).astype(np.int64)
    at = at[np.diff(at, prepend=-1) > 0]  # never falls from one window to the next
    raw = np.frombuffer(text.encode(), np.uint8)
    edge = np.flatnonzero(np.diff(BLANK[raw], prepend=True, append=True))
    first, last = edge[::2][at], edge[1::2][at + n - 1]
    if len(raw) > len(text):  # bytes before to characters before
        chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
        first, last = chars[first], chars[last]
    return at, first, last - first


def passage_keys(h: np.ndarray, at: np.ndarray, n: int) -> pa.Array:
    """A 128-bit key for the ``n`` words from each of the places ``at``, from the hashes ``h`` of the words."""
    a, b = np.zeros(len(at), np.uint64), np.full(len(at), MIX)
    for j in range(n):
        w = h[at + j]
        a = (a ^ w) * MIX
        a ^= a >> np.uint64(29)
        b = (b + w) * MIX2
        b ^= b >> np.uint64(32)
    both = np.ascontiguousarray(np.stack((a, b), axis=1))
    return pa.Array.from_buffers(pa.binary(16), len(at), [None, pa.py_buffer(both)]).cast(pa.binary())


class MinHash:
    """Band keys: each mixes ``rows`` minima of multiply-add permutations of the shingle hashes."""

    def __init__(self, bands: int, rows: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)

    def minima(self, h: np.ndarray, rolled: np.ndarray, parts: list[tuple[int, int]], block: int = 4096) -> np.ndarray:
        """The minima of the paragraphs ``parts`` (first word, end word; ascending) of a text with word hashes ``h``.

        ``rolled`` are the hashes of the text's shingles, permuted ``block`` at a time.
        """
        lo, hi = np.array(parts).T
        low = np.full((len(parts), len(self.a)), np.uint64(0xFFFFFFFFFFFFFFFF))
        for k in np.flatnonzero(hi - lo < SHINGLE):  # the whole sequence
            low[k] = shingles(h[lo[k]:hi[k]])[0] * self.a + self.b
        hi = hi - SHINGLE + 1
        for i in range(0, len(rolled), block):
            x = self.a[:, None] * rolled[i:i + block]
            x += self.b[:, None]
            start, end = np.clip(lo - i, 0, x.shape[1]), np.clip(hi - i, 0, x.shape[1])
            some = np.flatnonzero(start < end)
            if len(some):
                cut = np.stack((start[some], end[some]), axis=1).ravel()  # every other part lies between paragraphs
                cut = cut[:-1] if cut[-1] == x.shape[1] else cut
                low[some] = np.minimum(low[some], np.minimum.reduceat(x, cut, axis=1)[:, ::2].T)
        return low

    def keys(self, minima: np.ndarray) -> np.ndarray:
        """(paragraphs, bands) keys of (paragraphs, bands * rows) minima; the band's number is mixed in."""
        low = minima.reshape(len(minima), self.bands, self.rows)
        key = np.broadcast_to(np.arange(1, self.bands + 1, dtype=np.uint64) * MIX, low.shape[:2])
        for r in range(self.rows):
            key = (key ^ low[:, :, r]) * MIX
            key = key ^ (key >> np.uint64(29))
        return key.view(np.int64)


def _found(docs: DataFrame, min_words: int, bands: int, rows: int, wrapped: bool = False, whole: bool = True,
           inside: bool = False) -> DataFrame:
    """One row per paragraph (with ``whole``) and per passage (with ``inside``), from one reading of each text."""
    names = [c.split()[0] for c in FOUND.split(", ")]
    digest = xxhash.xxh3_128_digest

    def made(hasher: MinHash | None, docs: list[int], sizes: list[int], places: list, keys: list, minima: list) -> pa.RecordBatch:
        n = sum(sizes)
        if hasher is None:  # keys holds the word hashes of each text: passages of all of them get theirs at once
            before = np.cumsum([0, *map(len, keys[:-1])])
            keys = passage_keys(np.concatenate(keys), np.concatenate([p[0] + b for p, b in zip(places, before)]), min_words)
        k, at, length, count = np.concatenate(places, axis=1).astype(np.int32)
        ids = pa.array(docs, pa.int64()).take(pa.array(np.repeat(np.arange(len(docs)), sizes)))
        held = pa.nulls(n, pa.list_(pa.int64())) if hasher is None else pa.ListArray.from_arrays(
            np.arange(n + 1, dtype=np.int32) * hasher.bands, hasher.keys(np.array(minima)).ravel())
        return pa.RecordBatch.from_arrays(
            [ids, *map(pa.array, (k, at, length, count)), pa.array(keys, pa.binary()), held, pa.array(np.full(n, hasher is None))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(bands, rows)
        lines, runs, held = ([], [], [], [], []), ([], [], [], [], []), 0  # held: passages in runs
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words, parts = split(text or "", min_words, wrapped)
                if not words or len(words) < min_words:
                    continue
                h = word_hashes(words)
                rolled = windows(h, SHINGLE)
                if whole and parts:
                    lines[0].append(doc)
                    lines[1].append(len(parts))
                    lines[2].append(np.array([(k, at, n, to - a) for k, at, n, a, to in parts]).T)
                    lines[3].extend(digest(b" ".join(words[a:to])) for *_, a, to in parts)
                    lines[4].extend(hasher.minima(h, rolled, [(a, to) for *_, a, to in parts]))
                if inside:
                    k, at, n = anchored(text, min_words, h, rolled)
                    runs[0].append(doc)
                    runs[1].append(len(k))
                    runs[2].append(np.stack((k, at, n, np.full(len(k), min_words))))
                    runs[3].append(h)
                    held += len(k)
                for own, with_bands in ((lines, hasher), (runs, None)):
                    if (held if with_bands is None else len(own[3])) >= SLAB:
                        yield made(with_bands, *own)
                        for part in own:
                            part.clear()
                        held = 0 if with_bands is None else held
        for own, with_bands in ((lines, hasher), (runs, None)):
            if own[3]:
                yield made(with_bands, *own)
    return docs.mapInArrow(run, FOUND)


def _survey(work: Work, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The paragraphs and the passages of ``_found``, written once; both kinds are open at a time, so no task sorts its rows."""
    with session_conf(work.spark, spark__sql__maxConcurrentOutputFileWriters="2"):
        held = work.table(found, "found", ["inside"])
    return held.where("not inside").drop("inside"), held.where("inside").drop("inside", "bands")


def _shingle_sets(docs: DataFrame, wanted: DataFrame, min_words: int, wrapped: bool) -> DataFrame:
    """(id, set) of the wanted paragraphs (id, doc_id, key), read again from their documents.

    Those that occur only in rows without an id (doc_id NULL) are found among all paragraphs of such rows, by key.
    """
    lists = wanted.where("doc_id is not null").groupBy("doc_id").agg(F.collect_list(F.struct("key", "id")).alias("want"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, sets = [], []
            for text, want in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                need = {w["key"]: w["id"] for w in want}
                words, parts = split(text or "", min_words, wrapped)
                for *_, a, to in parts:
                    i = need.pop(xxhash.xxh3_128_digest(b" ".join(words[a:to])), None)
                    if i is not None:
                        ids.append(i)
                        sets.append(shingles(word_hashes(words[a:to])).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["id", "set"])

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by = {}
            for text in b.column(0).to_pylist():
                words, parts = split(text or "", min_words, wrapped)
                by |= {xxhash.xxh3_128_digest(b" ".join(words[a:to])): words[a:to] for *_, a, to in parts}
            yield pa.RecordBatch.from_arrays([pa.array(by, pa.binary()), pa.array(
                [shingles(word_hashes(ws)).view(np.int64) for ws in by.values()], pa.list_(pa.int64()))], names=["key", "set"])
    named = docs.join(lists, "doc_id").select("text", "want").mapInArrow(run, "id long, set array<long>")
    loose = docs.where("doc_id is null").select("text").mapInArrow(run_all, "key binary, set array<long>").join(
        wanted.where("doc_id is null").select("key", "id"), "key").select("id", "set")
    return named.union(loose).dropDuplicates(["id"])


def _sharing_prefix(rows: DataFrame, sets: DataFrame, threshold: float, work: Work) -> DataFrame:
    """Pairs (u, v) of rows (id, c) of different components that can reach the threshold.

    Shingles are ordered from the rarest.  Two sets of that similarity share one
    of the first (1 - threshold) part of each, and near copies whose edits are
    their own have only shingles of their own there, so they meet nothing.
    """
    held = rows.join(sets, "id").select("id", "c", F.size("set").alias("n"), F.explode("set").alias("s"))
    often = held.groupBy("s").agg(F.count("*").alias("df"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    first = held.join(often, "s").groupBy("id", "c", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "s", (F.col("lo") < F.col("hi")).alias("open")))).alias("all"))
    size = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9).cast("int") + 1
    first = work.table(first.select("id", "c", "n", F.posexplode(F.slice("all", F.lit(1), size)).alias("i", "p")).where("p.open").select(
        "id", "c", "n", "i", "p.s"), "prefixes")
    x, y = first.alias("x"), first.alias("y")
    # the first shared shingle of a pair leaves room for the overlap that the threshold asks for in both sets
    need = threshold / (1 + threshold) * (F.col("x.n") + F.col("y.n")) - 1e-9
    fits = (F.col("x.n") - F.col("x.i") >= need) & (F.col("y.n") - F.col("y.i") >= need)
    return x.join(y, (F.col("x.s") == F.col("y.s")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.c") != F.col("y.c")) & fits).select(
        F.col("x.id").alias("u"), F.col("y.id").alias("v"))


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (u, v) whose shingle sets have an exact Jaccard similarity of ``threshold`` or more."""
    both = pairs.join(sets.select(F.col("id").alias("u"), F.col("set").alias("x")), "u").join(
        sets.select(F.col("id").alias("v"), F.col("set").alias("y")), "v")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(common >= threshold * (F.size("x") + F.size("y") - common)).select("u", "v")


def duplicates(docs: DataFrame, threshold: float = 0.8, min_words: int = 20, recall: float = 0.999,
               id_col: str = "doc_id", text_col: str = "text", wrapped: bool = False) -> DataFrame:
    """One row per paragraph that occurs again: doc_id, paragraph, start, length, n_words, component_id,
    component_paragraph, component_size, kept.

    A paragraph is a line of ``min_words`` words or more, and with ``wrapped``
    also a block of shorter lines of as many words together; other lines are not
    looked at (see ``repeats``).  Paragraphs with equal words, or five-word shingle sets of a
    Jaccard similarity of ``threshold`` or more, are linked, and linked ones
    form a component, named by its first copy (smallest doc_id, then paragraph),
    which alone is kept.

    Colliding paragraphs are first compared with the one of their bucket that
    has most exact copies (the likely original of near copies).  Where a bucket
    then still holds several components, members of different ones are compared
    if the rarest shingles of their sets allow the threshold, so a group of
    thousands of copies is not paired inside and no link is lost.  NULL and empty texts have no paragraphs; a NULL id
    sorts first; copies inside one document count; repeated ids are handled row
    by row; other columns are ignored.
    """
    work = Work(docs.sparkSession, "paragraphs")
    docs = _texts(docs, id_col, text_col)
    found, _ = _survey(work, _found(docs, min_words, *tune_bands(threshold, recall), wrapped))
    return _clustered(work, docs, found, threshold, min_words, wrapped)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _clustered(work: Work, docs: DataFrame, found: DataFrame, threshold: float, min_words: int, wrapped: bool) -> DataFrame:
    """The rows of ``duplicates`` from the paragraphs ``found`` in ``docs``."""
    first = F.struct("doc_id", "paragraph")
    distinct = work.table(found.groupBy("key").agg(F.min(first).alias("first"), F.min("doc_id").alias("holder"), F.count("*").alias("copies"),
                                                   F.max("bands").alias("bands")).withColumn("id", F.monotonically_increasing_id()), "distinct")
    keys = distinct.select("id", "copies", F.explode("bands").alias("band"))
    # one with most copies, whichever (a minimum over a struct would sort all keys); few bands are shared, so these are written first
    shared = work.table(keys.groupBy("band").agg(F.count("*").alias("n"), F.max_by("id", "copies").alias("low")).where("n > 1").select(
        "band", "low"), "shared")
    buckets = work.table(keys.join(shared, "band"), "buckets")
    wanted = buckets.select("id").distinct().join(distinct, "id").select(
        "id", F.col("holder").alias("doc_id"), "key")  # the smallest id that is not NULL
    sets = work.table(_shingle_sets(docs, wanted, min_words, wrapped), "sets")

    def compared(pairs: DataFrame, name: str) -> DataFrame:
        pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v").distinct()
        return work.table(_verified(pairs, sets, threshold), name)

    edges = compared(buckets.select(F.col("low").alias("u"), F.col("id").alias("v")), "star")
    comp = connected_components(work, edges, "round")
    members = buckets.join(comp, buckets.id == comp.vertex, "left").select("band", "id", F.coalesce("component", "id").alias("c"))
    mixed = members.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("band")
    rest = work.table(members.join(mixed, "band").select("id", "c").distinct(), "apart")
    edges = edges.union(compared(_sharing_prefix(rest, sets, threshold, work), "across"))
    whole = connected_components(work, edges, "whole")
    named = distinct.join(whole, distinct.id == whole.vertex, "left").select(
        "key", "first", "copies", F.coalesce("component", "id").alias("c"))
    of = named.groupBy("c").agg(F.min("first").alias("head"), F.sum("copies").alias("component_size")).where("component_size > 1")
    classes = work.table(named.join(of, "c").select("key", "head", "component_size"), "classes")
    work.drop("shared", "buckets", "sets", "star", "apart", "prefixes", "across", "distinct")
    return found.join(classes, "key").select(
        "doc_id", "paragraph", "start", "length", "n_words", F.col("head.doc_id").alias("component_id"),
        F.col("head.paragraph").alias("component_paragraph"), "component_size", (first.eqNullSafe(F.col("head"))).alias("kept"))


def passages(docs: DataFrame, min_words: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per passage of ``min_words`` words that occurs again, in the columns of ``duplicates``.

    Passages start at anchors (see ``anchored``) inside or across lines, and
    overlap; paragraph is the number of the first word.  Equal words link them.
    Any ``min_words + ANCHORS - 1`` words or more that two texts share hold a
    passage of both.  Banding would add next to nothing: passages of this
    length whose shingle sets reach 0.8 share all words but one at an end.
    """
    work = Work(docs.sparkSession, "passages")
    _, found = _survey(work, _found(_texts(docs, id_col, text_col), min_words, 1, 1, whole=False, inside=True))
    again = _equal(work, found)
    work.drop("found")
    return again


def _equal(work: Work, found: DataFrame) -> DataFrame:
    """The rows of ``passages`` from all the passages ``found``."""
    first = F.struct("doc_id", "paragraph")
    classes = work.table(found.groupBy("key").agg(F.min(first).alias("head"), F.count("*").alias("component_size")).where(
        "component_size > 1"), "repeated")
    again = work.table(found.join(classes, "key").select(
        "doc_id", "paragraph", "start", "length", "n_words", F.col("head.doc_id").alias("component_id"),
        F.col("head.paragraph").alias("component_paragraph"), "component_size", (first.eqNullSafe(F.col("head"))).alias("kept")), "again")
    work.drop("repeated")
    return again


def repeats(docs: DataFrame, threshold: float = 0.8, min_words: int = 20, recall: float = 0.999,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``duplicates`` for lines and blocks of short lines (kind paragraph) and of ``passages`` (kind passage).

    Both come from one reading of the texts; NULL and empty texts, ids, repeated
    rows and other columns are as there.
    """
    work = Work(docs.sparkSession, "repeats")
    docs = _texts(docs, id_col, text_col)
    whole, inside = _survey(work, _found(docs, min_words, *tune_bands(threshold, recall), wrapped=True, inside=True))
    inside = _equal(work, inside).withColumn("kind", F.lit("passage"))
    whole = _clustered(work, docs, whole, threshold, min_words, wrapped=True).withColumn("kind", F.lit("paragraph"))
    return whole.unionByName(inside)


def remove(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the paragraphs that ``found`` does not keep (with their line ends), and without the passages.

    ``found`` names places by id, so an id that stands for different texts, or
    none, cannot say which text a place is in: such rows stay as they are.
    Repeated rows of one text are cut alike.  NULL and empty texts stay; no
    rows give no rows; columns named ``__id``, ``__gone`` or ``__several`` must not occur.
    """
    lost = found.where(~F.col("kept") & F.col("doc_id").isNotNull())
    if "kind" in found.columns:
        end = F.col("start") + F.col("length") + (F.col("kind") == "paragraph").cast("int")
        gone = F.array_sort(F.collect_set(F.struct("start", end.alias("end"))))
        cut = _spans.redact(F.col(text_col), F.col("__gone"), "")
    else:
        gone = F.collect_set("paragraph")
        cut = F.array_join(F.filter(F.split(F.col(text_col), "\n", -1), lambda _, i: ~F.array_contains("__gone", i)), "\n")
    spans = lost.groupBy(F.col("doc_id").alias("__id")).agg(gone.alias("__gone"))
    h = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    several = docs.groupBy(F.col(id_col).alias("__several")).agg((F.min(h) != F.max(h)).alias("n")).where("n").select("__several")
    spans = spans.join(several, F.col("__id") == F.col("__several"), "left_anti")
    return docs.join(spans, F.col(id_col) == F.col("__id"), "left").withColumn(
        text_col, F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(cut)).drop("__id", "__gone")
