"""Minimal perfect hashes over sorted-out shards of terms, by cascaded collision-free bit arrays.

A level gives every term that is left a place; places with one term set their
bit, the others' terms go on to the next level.  A term's slot is the number of
set bits before its own.  Terms that were never in the set land on some slot
too, so the term stored there is compared before a slot counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SEED = 42  # as xxhash64 in SQL, so that shards are dealt there
ROOM = 2  # places per term and level
_U = np.uint64


def term_hash(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term, SEED)


def _places(h: np.ndarray, level: int, size: int) -> np.ndarray:
    """Another uniform place below ``size`` for every level."""
    x = h + _U((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return ((x ^ (x >> _U(31))) % _U(size)).astype(np.int64)


def build(hashes: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """(bits as 64-bit words, level sizes) for distinct hashes."""
    left, sizes, words = hashes, [], []
    while left.size:
        size = -(-ROOM * left.size // 64) * 64
        at = _places(left, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        left = left[~alone[at]]
        sizes.append(size)
    return np.concatenate(words) if words else np.empty(0, "<u8"), sizes


class Shard:
    """The slots of one shard's terms: those of the perfect hash, then terms whose hash another one has."""

    def __init__(self, bits: np.ndarray, sizes: list[int], terms: pa.Array):
        self.bits, self.sizes, self.terms = bits, sizes, terms
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)))
        self.twins = {t: int(self.before[-1]) + i for i, t in enumerate(terms[int(self.before[-1]):].to_pylist())}

    @classmethod
    def of(cls, terms: list[bytes]) -> Shard:
        """Over distinct terms; the terms are stored in slot order."""
        h = np.array([term_hash(t) for t in terms], np.uint64)
        first = np.zeros(len(terms), bool)
        first[np.unique(h, return_index=True)[1]] = True
        bits, sizes = build(h[first])
        out = cls(bits, sizes, pa.array([], pa.binary()))
        own, slots = np.flatnonzero(first), out.slots(h[first])
        order = [*own[np.argsort(slots)].tolist(), *np.flatnonzero(~first).tolist()]
        return cls(bits, sizes, pa.array([terms[i] for i in order], pa.binary()))

    def __reduce__(self):
        return Shard, (self.bits, self.sizes, self.terms)

    def __len__(self) -> int:
        return len(self.terms)

    def slots(self, h: np.ndarray) -> np.ndarray:
        """The slot each hash leads to, unverified; -1 where no level has it."""
        out, base = np.full(h.size, -1, np.int64), 0
        todo = np.arange(h.size)
        for level, size in enumerate(self.sizes):
            at = base + _places(h[todo], level, size)
            w, b = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.bits[w] >> b) & _U(1) == 1
            low = np.bitwise_count(self.bits[w] & ((_U(1) << b) - _U(1)))
            out[todo[hit]] = (self.before[w] + low)[hit]
            todo = todo[~hit]
            base += size
        return out

    def find(self, terms: pa.Array, h: np.ndarray) -> np.ndarray:
        """The slot of each term, -1 for terms that are not stored."""
        if not len(self):
            return np.full(h.size, -1, np.int64)
        out = self.slots(h)
        same = pc.equal(self.terms.take(pa.array(np.maximum(out, 0))), terms).to_numpy(zero_copy_only=False)
        out[~same] = -1
        if self.twins:
            for i in np.flatnonzero(out < 0).tolist():
                out[i] = self.twins.get(terms[i].as_py(), -1)
        return out
