"""Source divergence audit: how far the word use of each source of a language is from that of the others.

The first pass counts documents per term exactly and keeps the frequent terms.
Their minimal perfect hashes, one per shard, are broadcast a bounded number of
bytes at a time; the second pass looks terms up, verifies them against the
stored ones and increments dense arrays of slots per (lang, source).
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import perfect_hash
from ._work import Work

SCALE = 1_000_000_000
SHARD_TERMS = 1 << 14
ROUND_BYTES = 64 << 20  # of terms broadcast at a time
FLUSH_TERMS = 1 << 20  # distinct terms that a task holds before it passes its counts on
FLUSH_BYTES = 128 << 20  # of slots
CELLS = 1 << 20  # sources x terms of one block of the pair sums
PIECE = 4 << 20  # bytes split into words at once

# bytes of letters a-z after lower-casing A-Z, and everything outside ASCII; the rest separates
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded piece at a time."""
    data, at = text.translate(_NORMAL), 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _clean(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in (
        (lang_col, "lang"), (source_col, "source"), (text_col, "text"))])


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, n): in how many of the task's documents a term occurs."""
    held: dict[str, Counter] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, c in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.binary()).cast(pa.string()),
                                              pa.array(list(c.values()), pa.int64())], ["lang", "term", "n"])
        held.clear()
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
            held[lang].update(set().union(*terms(text)))
        if sum(map(len, held.values())) > FLUSH_TERMS:
            yield from flush()
    yield from flush()


def frequent_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term) of the terms in at least ``min_docs`` documents of the language, counted exactly."""
    counted = docs.select("lang", "text").mapInArrow(_document_counts, "lang string, term string, n long")
    return counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("lang", "term")


SHARDS = "lang string, shard long, shards long, bits binary, sizes array<long>, terms array<string>, bytes long"


def build_shards(kept: DataFrame) -> DataFrame:
    """One row per shard: its perfect hash and its terms in slot order.  About SHARD_TERMS terms share a shard."""
    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        s = perfect_hash.Shard.of(table.column("term").cast(pa.binary()).to_pylist())
        return pa.Table.from_arrays(
            [pa.array([key[0].as_py()]), pa.array([key[1].as_py()]), pa.array([key[2].as_py()]), pa.array([s.bits.tobytes()]), pa.array([s.sizes], pa.list_(pa.int64())),
             pa.array([s.terms.cast(pa.string()).to_pylist()], pa.list_(pa.string())), pa.array([s.terms.nbytes + s.bits.nbytes])],
            names=["lang", "shard", "shards", "bits", "sizes", "terms", "bytes"])
    sizes = kept.groupBy("lang").agg(F.expr(f"cast(ceil(count(*) / {SHARD_TERMS}) as long)").alias("shards"))
    dealt = kept.join(sizes, "lang").withColumn("shard", F.expr("pmod(shiftrightunsigned(xxhash64(term), 20), shards)"))
    # dealt by shard: the join's own partitioning by lang would put a language into one task
    return dealt.repartition("lang", "shard").groupBy("lang", "shard", "shards").applyInArrow(build, SHARDS)


class Index:
    """The shards of one round: lang -> (number of its shards, those held here)."""

    def __init__(self) -> None:
        self.langs: dict[str, tuple[int, dict[int, perfect_hash.Shard]]] = {}

    def add(self, row) -> None:
        held = self.langs.setdefault(row.lang, (row.shards, {}))[1]
        held[row.shard] = perfect_hash.Shard(np.frombuffer(bytes(row.bits), "<u8"), list(row.sizes),
                                             pa.array([t.encode() for t in row.terms], pa.binary()))

    def find(self, lang: str, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(shard, slot) of each term; slot -1 for terms that are not held."""
        n, held = self.langs[lang]
        h = np.array([perfect_hash.term_hash(t) for t in found], np.uint64)
        shard = ((h >> np.uint64(20)) % np.uint64(n)).astype(np.int64)
        slots, array = np.full(h.size, -1, np.int64), pa.array(found, pa.binary())
        for k in np.unique(shard).tolist():
            if k in held:
                at = np.flatnonzero(shard == k)
                slots[at] = held[k].find(array.take(pa.array(at)), h[at])
        return shard, slots


SLOTS = "lang string, source string, shard long, slots array<int>, counts array<long>"


def _slot_counts(docs: DataFrame, index: Index) -> DataFrame:
    """Occurrences by slot, summed within tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, held = shared.value, {}

        def flush() -> pa.RecordBatch:
            keys, at = list(held), [np.flatnonzero(a) for a in held.values()]
            out = [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))]
            out += [pa.array(at, pa.list_(pa.int32())), pa.array([a[i] for a, i in zip(held.values(), at)], pa.list_(pa.int64()))]
            held.clear()
            return pa.RecordBatch.from_arrays(out, ["lang", "source", "shard", "slots", "counts"])
        for b in batches:
            texts: dict[tuple, list] = defaultdict(list)
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist()):
                if lang in index.langs:
                    texts[lang, source].append(text)
            counts = {g: Counter() for g in texts}
            for g, c in counts.items():
                for words in terms(b" ".join(texts.pop(g))):
                    c.update(words)
            for lang in {g[0] for g in counts}:
                own = {g: c for g, c in counts.items() if g[0] == lang}
                found = list(set().union(*own.values()))
                shard, slot = index.find(lang, found)
                place = dict(zip(found, range(len(found))))
                for (_, source), c in own.items():
                    at = np.fromiter(map(place.__getitem__, c), np.int64, len(c))
                    n = np.fromiter(c.values(), np.int64, len(c))
                    at, n = at[slot[at] >= 0], n[slot[at] >= 0]
                    for k in np.unique(shard[at]).tolist():
                        if (lang, source, k) not in held:
                            held[lang, source, k] = np.zeros(len(index.langs[lang][1][k]), np.int64)
                        mine = shard[at] == k
                        held[lang, source, k][slot[at][mine]] += n[mine]  # a term has one slot: no place twice
                if sum(a.nbytes for a in held.values()) > FLUSH_BYTES:
                    yield flush()
        yield flush()
    return docs.mapInArrow(run, SLOTS)


def _rounds(shards: DataFrame, most: int) -> Iterator[Index]:
    """The shards in rounds of ``most`` bytes (or one shard), so what is broadcast never grows with the data."""
    index, size = Index(), 0
    for row in shards.orderBy("lang", "shard").toLocalIterator():
        if size and size + row.bytes > most:
            yield index
            index, size = Index(), 0
        index.add(row)
        size += row.bytes
    if size:
        yield index


def term_counts(docs: DataFrame, shards: DataFrame, work: Work, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(lang, source, shard, slot, n) with n > 0: the second pass, one scan of a round's languages per round."""
    parts = []
    for index in _rounds(shards, round_bytes):
        rows = docs.where(F.col("lang").isin(list(index.langs))) if len(index.langs) <= 50 else docs
        counted = _slot_counts(rows, index).select("lang", "source", "shard", F.inline(F.arrays_zip("slots", "counts")))
        parts.append(work.table(counted.groupBy("lang", "source", "shard", F.col("slots").alias("slot")).agg(F.sum("counts").alias("n")),
                                f"counts{len(parts)}"))
    none = docs.sparkSession.createDataFrame([], "lang string, source string, shard long, slot int, n long")
    return reduce(DataFrame.unionByName, parts, none)


def _share(n: Column, total: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / total), exactly."""
    return F.expr("1L") + F.call_function("div", (n + 1).cast("decimal(20,0)") * F.lit(SCALE), total)


def _shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same in 64 bits: SCALE is multiplied in three steps of 1,000, as in long division."""
    out, rest = np.divmod((n + 1) * 1000, total)
    for _ in range(2):
        digits, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digits
    return out + 1


def _pair_sums(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the divergence of each source from each other one, over blocks of terms.

    A block holds at most CELLS counts (sources x terms), so its table of shares
    fits a task; only one row per pair and block leaves it.
    """
    def add(counts: pa.Table, groups: pa.Table) -> pa.Table:
        names = groups.column("source").to_pylist()
        total = groups.column("total").to_numpy()[:, None]
        row = {s: i for i, s in enumerate(names)}
        _, term = np.unique(np.stack([counts.column("shard").to_numpy(), counts.column("slot").to_numpy().astype(np.int64)]), axis=1, return_inverse=True)
        seen = np.zeros((len(names), int(term.max()) + 1), np.int64)
        seen[[row[s] for s in counts.column("source").to_pylist()], term] = counts.column("n").to_numpy()
        p = _shares(seen, total)
        sums = [((d := q - p) * d // p).sum(axis=1) for q in p]
        n = len(names)
        return pa.Table.from_arrays([pa.array([groups.column("lang")[0].as_py()] * (n * n)), pa.array(np.repeat(np.array(names, object), n).tolist()),
                                     pa.array(names * n), pa.array(np.concatenate(sums))], names=["lang", "source", "item", "value"])
    sizes = groups.where("kept > 0").groupBy("lang").agg(F.expr(f"greatest(1L, {CELLS} div count(*))").alias("per"))
    placed = counts.join(sizes, "lang").withColumn("block", F.expr("slot div per"))
    # a lang's blocks are (shard, block); its groups go to each of them
    blocks = placed.select("lang", "shard", "block").distinct()
    stats = blocks.join(groups, "lang")
    stats = stats.select(*[F.col(c).alias(c) for c in stats.columns])  # columns of its own beside those of ``placed``
    keys = ["lang", "shard", "block"]
    sums = placed.repartition(*keys).groupBy(*keys).cogroup(stats.repartition(*keys).groupBy(*keys)).applyInArrow(
        add, "lang string, source string, item string, value long")
    return sums.where("source <> item").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source) that occurs.

    A language keeps the terms in at least ``min_docs`` of its documents.  A
    group (a source, or the whole language) gives each kept term the share
    1 + floor(1e9 * (count + 1) / (N + V)), N being its occurrences of kept
    terms and V their number.  Two shares p and q differ by floor((p - q)^2 / q).
    Part ``pair`` ranks the other sources by the sum over all kept terms, part
    ``term`` the ``top`` terms that the source uses more than its language.

    NULL text, lang and source count as ''.  Every row is a document, so
    repeated rows count again; ids are not used.  Sources without kept terms
    have shares too; a language without kept terms gives pairs of value 0.
    Ties rank by item, in the order of its bytes.  No rows give no rows; other
    columns are ignored.
    """
    work = Work(docs.sparkSession, "divergence")
    rows = _clean(docs, text_col, lang_col, source_col)
    kept = work.table(frequent_terms(rows, min_docs), "kept")
    shards = work.table(build_shards(kept), "shards")
    counts = work.table(term_counts(rows, shards, work, round_bytes), "counts")

    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = work.table(
        rows.select("lang", "source").distinct().join(langs, "lang", "left").join(sums, ["lang", "source"], "left").na.fill(0, ["kept", "n"])
        .withColumn("total", F.col("n") + F.col("kept")), "groups")

    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = pairs.join(_pair_sums(counts, groups), ["lang", "source", "item"], "left").na.fill(0, ["value"]).withColumn("part", F.lit("pair"))

    whole = groups.groupBy("lang").agg(F.expr("sum(n) + max(kept)").alias("total"))
    names = shards.select("lang", "shard", F.posexplode("terms").alias("slot", "item"))
    usual = counts.groupBy("lang", "shard", "slot").agg(F.sum("n").alias("n")).join(whole, "lang").select(
        "lang", "shard", "slot", _share(F.col("n"), F.col("total")).alias("q"))
    own = counts.join(groups.select("lang", "source", "total"), ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total")))
    found = own.join(usual, ["lang", "shard", "slot"]).where("p > q").join(names, ["lang", "shard", "slot"]).select(
        "lang", "source", F.lit("term").alias("part"), "item", F.expr("(p - q) * (p - q) div q").alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [pairs.withColumn("rank", F.row_number().over(order)), found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)]
    return reduce(DataFrame.unionByName, [r.select("lang", "source", "part", "item", "value", "rank") for r in ranked])
