"""Katz backoff language-model scoring.

Texts are held as blocks of token streams.  A block asks for the counts of its
distinct n-grams, and for the backoff sums of its histories, with one request
per key and block, pre-counted inside the block; keys are dealt by hash to
buckets, whose owners add the requests up, write the model's tables and answer
every block.  A key that holds a third of all tokens is therefore one entry per
block.  N-grams are keyed by 64-bit hashes: among n distinct ones two collide
with a chance of about n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ._work import Work

K = 5  # counts up to K are discounted
START, END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
BLOCK_TOKENS, BUCKET_KEYS = 1 << 21, 1 << 22
BLOCK = "doc_ids array<long>, held array<boolean>, lengths array<long>, vocabulary binary, tokens binary"
REQUEST = "step int, bucket long, block long, keys binary, amounts binary"
ANSWER = "kind string, step int, bucket long, block long, keys binary, amounts binary, seen array<long>"


def tokens(text: bytes | None) -> list[bytes]:
    """Lower-case A-Z and split on the six ASCII white-space characters."""
    return text.lower().split() if text else []


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def blocks(docs: DataFrame, held, block_tokens: int, id_col: str, text_col: str) -> DataFrame:
    """Token streams of about ``block_tokens`` with a vocabulary of word hashes; every document ends with END."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_ids", "held", "lengths", "vocabulary", "tokens"]

        def made(ids: list, flags: list, streams: list, vocabulary: _Vocabulary) -> pa.RecordBatch:
            hashes = np.array([END, *(xxhash.xxh3_64_intdigest(w) for w in list(vocabulary)[1:])], np.uint64)
            return pa.RecordBatch.from_arrays([
                pa.array([ids], pa.list_(pa.int64())), pa.array([flags], pa.list_(pa.bool_())),
                pa.array([[len(s) for s in streams]], pa.list_(pa.int64())), pa.array([hashes.tobytes()], pa.binary()),
                pa.array([np.concatenate(streams).tobytes()], pa.binary())], names=names)

        ids, flags, streams, n, vocabulary = [], [], [], 0, _Vocabulary({b"": 0})
        for b in batches:
            for i, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist()):
                ws = tokens(t)
                streams.append(np.fromiter(map(vocabulary.__getitem__, ws + [b""]), np.int32, len(ws) + 1))
                ids.append(i)
                flags.append(h)
                n += len(ws) + 1
                if n >= block_tokens:
                    yield made(ids, flags, streams, vocabulary)
                    ids, flags, streams, n, vocabulary = [], [], [], 0, _Vocabulary({b"": 0})
        if ids:
            yield made(ids, flags, streams, vocabulary)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, BLOCK).withColumn("block", F.monotonically_increasing_id())


def _mix(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = history * np.uint64(0xFF51AFD7ED558CCD) ^ (history >> np.uint64(31))
        x = (x + word) * np.uint64(0xC4CEB9FE1A85EC53)
        x ^= x >> np.uint64(29)
        x = x * np.uint64(0x9FB21C651E98DF25)
        return x ^ (x >> np.uint64(32))


class Grams:
    """The n-grams that end at each token of a block, per order: distinct keys (sorted), and their index by token.

    A document is preceded by one START, which is a history but never a token.
    At its first tokens the long orders do not exist; ``valid`` says where they do.
    """

    def __init__(self, row: dict, order: int):
        words = np.frombuffer(row["vocabulary"], np.uint64)[np.frombuffer(row["tokens"], np.int32)]
        self.doc_ids, self.lengths = row["doc_ids"], np.array(row["lengths"], np.int64)
        self.n = len(words)
        begin = np.cumsum(self.lengths) - self.lengths
        self.begin = begin
        at = np.arange(self.n) - np.repeat(begin, self.lengths)
        self.train = ~np.repeat(np.array(row["held"], bool), self.lengths)
        self.keys, self.index, self.valid, raw = [], [], [], words
        for k in range(1, order + 1):
            valid = at >= k - 2
            if k > 1:
                history = np.empty_like(raw)
                history[1:] = raw[:-1]
                if k == 2:
                    history[at == 0] = START
                raw = _mix(history, words)
            keys, index = np.unique(raw[valid], return_inverse=True)
            full = np.full(self.n, -1)
            full[valid] = index
            self.keys.append(keys)
            self.index.append(full)
            self.valid.append(valid)

    def asked(self, k: int) -> np.ndarray:
        """How often each distinct n-gram of order k occurs in the block's training documents."""
        on = self.train & self.valid[k - 1]
        return np.bincount(self.index[k - 1][on], minlength=len(self.keys[k - 1])).astype(np.int64)

    def histories(self, k: int) -> np.ndarray:
        """Per token its history's index among the order k-1 n-grams; START is -1."""
        ctx = np.full(self.n, -1)
        ctx[1:] = self.index[k - 2][:-1]
        if k == 2:
            ctx[self.begin] = -1
        return ctx


def _pack(x: np.ndarray) -> bytes:
    """Non-negative whole numbers as byte planes, as many as the largest needs."""
    x = x.astype("<u8")
    width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + len(x).to_bytes(4, "little") + np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unpack(b: bytes) -> np.ndarray:
    width, n = b[0], int.from_bytes(b[1:5], "little")
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(b, np.uint8, width * n, 5).reshape(width, n).T
    return out.view("<u8")[:, 0]


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as their first and the differences."""
    return keys[:1].tobytes() + _pack(np.diff(keys))


def _unpack_keys(b: bytes) -> np.ndarray:
    return np.cumsum(np.concatenate((np.frombuffer(b, "<u8", 1), _unpack(b[8:]))), dtype=np.uint64)


def _pack_amounts(x: np.ndarray) -> bytes:
    return _pack(x) if x.dtype.kind == "i" else np.ascontiguousarray(x.T).tobytes()


def _unpack_amounts(b: bytes, counts: bool) -> np.ndarray:
    return _unpack(b).astype(np.int64) if counts else np.frombuffer(b, "<f8").reshape(2, -1).T


def _requests(step: int, block: int, keys: np.ndarray, amounts: np.ndarray, bits: int) -> Iterator[tuple]:
    """Sorted keys and their amounts (a count, or two sums, per key), cut by the keys' leading bits."""
    edges = np.searchsorted(keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64), np.arange((1 << bits) + 1))
    for b in np.flatnonzero(np.diff(edges)).tolist():
        a, e = edges[b], edges[b + 1]
        yield step, b, block, _pack_keys(keys[a:e]), _pack_amounts(amounts[a:e])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                                       pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.binary())],
                                      names=["step", "bucket", "block", "keys", "amounts"])


def _add_up(requests: DataFrame, counts: bool) -> DataFrame:
    """Sum the amounts of equal keys in each bucket: a model row with all keys, and an answer per request.

    An answer holds only the keys that other blocks asked for too; a block knows
    the rest itself.  A count's answer is 2 * count, plus 1 for the one request
    that stands for the key in later sums.
    """
    def run(t: pa.Table) -> pa.Table:
        step, bucket = t["step"][0].as_py(), t["bucket"][0].as_py()
        block = t["block"].to_pylist()
        keys = [_unpack_keys(k) for k in t["keys"].to_pylist()]
        amounts = np.concatenate([_unpack_amounts(a, counts) for a in t["amounts"].to_pylist()])
        ends = np.cumsum([len(k) for k in keys])
        every = np.concatenate(keys)
        uniq, at, inverse, times = np.unique(every, return_index=True, return_inverse=True, return_counts=True)
        seen = []
        if counts:
            sums = np.bincount(inverse, amounts, len(uniq)).astype(np.int64)
            one = np.zeros(len(every), np.int64)
            one[at] = 1
            answer, kept = 2 * sums[inverse] + one, sums > 0
            seen = [int(kept.sum()), *(int((sums == r).sum()) for r in range(1, K + 2))]
        else:
            sums = np.stack([np.bincount(inverse, amounts[:, c], len(uniq)) for c in (0, 1)], axis=1)
            answer, kept = sums[inverse], sums[:, 0] > 0
        shared = times[inverse] > 1
        replies = [len(m).to_bytes(4, "little") + np.packbits(m).tobytes() + _pack_amounts(a[m])
                   for a, m in zip(np.split(answer, ends[:-1]), np.split(shared, ends[:-1]))]
        n = len(block)
        return pa.table({
            "kind": pa.array(["answer"] * n + ["model"], pa.string()), "step": pa.array([step] * (n + 1), pa.int32()),
            "bucket": pa.array([bucket] * (n + 1), pa.int64()), "block": pa.array([*block, None], pa.int64()),
            "keys": pa.array([None] * n + [_pack_keys(uniq[kept]) if kept.any() else None], pa.binary()),
            "amounts": pa.array([*replies, _pack_amounts(sums[kept])], pa.binary()),
            "seen": pa.array([None] * n + [seen], pa.list_(pa.int64()))})
    return requests.groupBy("step", "bucket").applyInArrow(run, ANSWER)


def discounts(seen: list[int]) -> np.ndarray:
    """Good-Turing factors for counts 0..K from the numbers of n-grams seen 1..K+1 times (``seen[r]``).

    Where those cannot give factors in (0, 1] (a small or odd corpus), half a
    count is taken off instead.
    """
    half = np.array([0.0, *((r - 0.5) / r for r in range(1, K + 1))])
    if min(seen[1:K + 2]) <= 0:
        return half
    a = (K + 1) * seen[K + 1] / seen[1]
    if a >= 1:
        return half
    d = np.array([0.0, *(((r + 1) * seen[r + 1] / (r * seen[r]) - a) / (1 - a) for r in range(1, K + 1))])
    return d if (d[1:] > 0).all() and (d[1:] <= 1).all() and (d[1:] < 1).any() else half


class Model:
    """Numbers that the formulas need beside the tables: discounts by order, tokens and documents trained on."""

    def __init__(self, seen: dict[int, list[int]], n_tokens: int, n_docs: int, order: int):
        self.order, self.n_tokens, self.n_docs = order, n_tokens, n_docs
        empty = [0] * (K + 2)
        self.vocabulary = seen.get(1, empty)[0]
        self.d = {k: discounts(seen.get(k, empty)) for k in range(1, order + 1)}
        off = sum(seen.get(1, empty)[r] * r * (1 - self.d[1][r]) for r in range(1, K + 1))
        # a corpus without rare words leaves nothing for unknown ones; one more token is then assumed
        self.total = n_tokens if off > 0 or not n_tokens else n_tokens + 1
        self.unknown = (off if off > 0 else 1) / self.total if n_tokens else 1.0

    def kept(self, k: int, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        return counts * np.where(counts <= K, self.d[k][np.minimum(counts, K)], 1.0)

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        worth = self.kept(1, counts) if self.total == self.n_tokens else counts.astype(float)
        return np.where(counts > 0, worth / max(self.total, 1), self.unknown)


def _answers(rows: list[dict], step: int, own: np.ndarray) -> np.ndarray:
    """A block's answers of one step over what it asked with; buckets follow the order of the sorted keys."""
    out, at = own.copy(), 0
    for r in sorted((r for r in rows if r["step"] == step), key=lambda r: r["bucket"]):
        b = r["amounts"]
        n = int.from_bytes(b[:4], "little")
        size = 4 + (n + 7) // 8
        shared = np.unpackbits(np.frombuffer(b, np.uint8, size - 4, 4), count=n).astype(bool)
        out[at:at + n][shared] = _unpack_amounts(b[size:], own.dtype.kind == "i")
        at += n
    return out


class _Evaluation:
    """Katz probabilities of a block's tokens, order by order, from the answers received so far."""

    def __init__(self, grams: Grams, model: Model, answers: list[dict]):
        self.g, self.m, self.rows = grams, model, answers
        raw = [_answers(answers, k, 2 * grams.asked(k) + 1) for k in range(1, model.order + 1)]
        self.count, self.stands = [r >> 1 for r in raw], [(r & 1).astype(bool) for r in raw]
        self.p = model.unigram(self.count[0])[grams.index[0]]
        self.c1 = self.count[0][grams.index[0]]

    def history_counts(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        ctx = self.g.histories(k)
        return ctx, np.where(ctx >= 0, self.count[k - 2][np.maximum(ctx, 0)], self.m.n_docs)

    def sums(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """What the block adds to its histories: per distinct history (START last) kept counts and lower probabilities.

        An n-gram adds only in the block that stands for it, so each is added once.
        """
        g, idx = self.g, self.g.index[k - 1]
        ctx, _ = self.history_counts(k)
        tok = np.full(len(g.keys[k - 1]), -1)
        tok[idx[g.valid[k - 1]]] = np.flatnonzero(g.valid[k - 1])  # a token where each n-gram ends
        add = self.stands[k - 1] & (self.count[k - 1] > 0)
        size = len(g.keys[k - 2]) + 1
        where = ctx[tok[add]] % size  # START's -1 becomes the last place
        used = np.zeros(size, bool)
        used[ctx[g.valid[k - 1]] % size] = True
        return used, np.stack([np.bincount(where, self.m.kept(k, self.count[k - 1][add]), size),
                               np.bincount(where, self.p[tok[add]], size)], axis=1).astype(float)

    def step(self, k: int) -> None:
        """Raise ``p`` from order k-1 to order k."""
        g = self.g
        places, _, sums = self.history_request(k)
        back = np.zeros((len(g.keys[k - 2]) + 1, 2))
        back[places] = _answers(self.rows, 100 + k, sums)
        ctx, total = self.history_counts(k)
        kept, lower = back[ctx, 0], back[ctx, 1]
        left = total - kept
        # a history seen only with frequent words keeps all counts; one more count is then assumed for the rest
        thin = (total > 0) & (left <= 1e-9 * np.maximum(total, 1))
        norm = np.where(total > 0, total + thin, 1)
        left = np.where(thin, 1.0, left)
        c = np.where(g.valid[k - 1], self.count[k - 1][np.maximum(g.index[k - 1], 0)], 0)
        seen = np.where(thin, c, self.m.kept(k, c)) / norm
        backed = np.where(total > 0, left / norm / np.maximum(1 - lower, 1e-300), 1.0) * self.p
        self.p = np.where(g.valid[k - 1], np.where(c > 0, seen, backed), self.p)

    def history_request(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct histories in the order of their keys: places, keys and what the block adds to each."""
        used, sums = self.sums(k)
        places = np.flatnonzero(used)
        keys = np.append(self.g.keys[k - 2], START)[places]
        order = np.argsort(keys, kind="stable")
        return places[order], keys[order], sums[places][order]


def score(docs: DataFrame, held=None, order: int = 2, block_tokens: int = BLOCK_TOKENS, bucket_keys: int = BUCKET_KEYS,
          id_col: str = "doc_id", text_col: str = "text", work: Work | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model of ``order`` learns from the documents for which ``held`` is not
    true, and its tables (n-gram counts, and per history the kept counts and
    lower-order probabilities that give the backoff weight) stay in the work
    folder under ``counts`` and ``histories<k>`` in rows of kind ``model``.
    ``score`` is the log10 probability of the tokens and the end under it;
    ``base_score`` is the add-one unigram's.

    NULL and empty texts are the end alone.  Repeated ids and texts count row by
    row.  Without training documents every token is unknown with probability
    one.  Other columns are ignored.
    """
    spark = docs.sparkSession
    work = work or Work(spark, "katz")
    held = F.coalesce(held, F.lit(False)) if held is not None else F.lit(False)
    held_blocks = work.table(blocks(docs, held, block_tokens, id_col, text_col), "blocks")
    lengths = F.zip_with("lengths", "held", lambda n, h: F.when(h, 0).otherwise(n))
    size = held_blocks.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, n: s + n)),
                           F.sum(F.aggregate(lengths, F.lit(0).cast("long"), lambda s, n: s + n)),
                           F.sum(F.size(F.filter("held", lambda h: ~h)))).first()
    bits = max(0, (-(-(size[0] or 0) // bucket_keys) - 1).bit_length())

    def count_requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                g = Grams(row, order)
                for k in range(1, order + 1):
                    yield _batch(list(_requests(k, row["block"], g.keys[k - 1], g.asked(k), bits)))

    answers = work.table(_add_up(held_blocks.mapInArrow(count_requests, REQUEST), True), "counts", ["kind"])
    stats = answers.where("kind = 'model'").select("step", F.posexplode("seen").alias("r", "n")).groupBy("step", "r").agg(
        F.sum("n").alias("n")).collect()  # K + 2 rows an order
    seen: dict[int, list[int]] = {k: [0] * (K + 2) for k in range(1, order + 1)}
    for r in stats:
        seen[r.step][r.r] = r.n
    model = Model(seen, size[1] or 0, size[2] or 0, order)

    def of_block(extra: list[DataFrame]):
        rows = answers.where("kind = 'answer'").select("block", "step", "bucket", "amounts")
        for e in extra:
            rows = rows.union(e.where("kind = 'answer'").select("block", "step", "bucket", "amounts"))
        return held_blocks.groupBy("block").cogroup(rows.groupBy("block"))

    def raised(left: pa.Table, right: pa.Table, upto: int) -> tuple[int, _Evaluation]:
        row = left.to_pylist()[0]
        e = _Evaluation(Grams(row, order), model, right.to_pylist())
        for k in range(2, upto + 1):
            e.step(k)
        return row["block"], e

    def history_requests(k: int):
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            block, e = raised(left, right, k - 1)
            _, keys, sums = e.history_request(k)
            return pa.Table.from_batches([_batch(list(_requests(100 + k, block, keys, sums, bits)))])
        return run

    histories: list[DataFrame] = []
    for k in range(2, order + 1):
        asked = of_block(histories).applyInArrow(history_requests(k), REQUEST)
        histories.append(work.table(_add_up(asked, False), f"histories{k}", ["kind"]))

    n_train, vocabulary = model.n_tokens, model.vocabulary

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        held_flags = left["held"][0].as_py()
        _, e = raised(left, right, order)
        g = e.g
        base = np.log10((e.c1 + 1.0) / (n_train + vocabulary + 1.0))

        def by_doc(x: np.ndarray) -> np.ndarray:
            return np.add.reduceat(x, g.begin)
        return pa.table({
            "doc_id": pa.array(g.doc_ids, pa.int64()), "held_out": pa.array(held_flags, pa.bool_()), "n_tokens": pa.array(g.lengths),
            "n_known": pa.array(by_doc((e.c1 > 0).astype(np.int64))), "train_tokens": pa.array(np.full(len(g.lengths), n_train, np.int64)),
            "base_score": pa.array(by_doc(base)), "score": pa.array(by_doc(np.log10(e.p)))})

    return of_block(histories).applyInArrow(
        scored, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
