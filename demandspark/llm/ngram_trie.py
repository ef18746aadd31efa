"""N-gram trie of Elias-Fano levels with quantised probabilities, in one memory-mapped file."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import BinaryIO

import numpy as np

ONE = np.uint64(1)
#: Log10 values are kept in 16 bits over [-LOWEST, 0].
LOWEST = 20.0


def quantise(log10p: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(-log10p / LOWEST, 0, 1) * 65_535).astype(np.uint16)


def restore(code: np.ndarray) -> np.ndarray:
    return code.astype(float) * (-LOWEST / 65_535)


def _select_in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th set bit of each 64-bit word, counting from 0, by halving."""
    place = np.zeros(len(word), np.uint64)
    k = k.astype(np.uint64)
    for width in (32, 16, 8, 4, 2, 1):
        low = np.bitwise_count(word & np.uint64((1 << width) - 1)).astype(np.uint64)
        up = k >= low
        k = k - np.where(up, low, np.uint64(0))
        step = np.where(up, np.uint64(width), np.uint64(0))
        word = word >> step
        place += step
    return place


@dataclass
class EliasFano:
    """An ascending sequence of integers: low bits packed, high parts as a bit vector with bucket ends as zeros."""
    n: int
    low_bits: int
    buckets: int
    low: np.ndarray
    high: np.ndarray
    zeros: np.ndarray  # zeros before each word of high

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // max(1, n)).bit_length() - 1)
        at = np.arange(n, dtype=np.uint64)
        low = np.zeros((n * bits + 63) // 64 + 1, np.uint64)
        if bits and n:
            part = values & np.uint64((1 << bits) - 1)
            first = at * np.uint64(bits)
            word, shift = (first >> np.uint64(6)).astype(np.int64), first & np.uint64(63)
            # Parts do not overlap, so those of one word are joined in one go; what runs over goes to the next.
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low[word[starts]] |= np.bitwise_or.reduceat(part << shift, starts)
            over = shift + np.uint64(bits) > np.uint64(64)
            low[word[over] + 1] |= part[over] >> (np.uint64(64) - shift[over])
        buckets = (top >> bits) + 1
        place = (values >> np.uint64(bits)) + at
        high = np.zeros((n + buckets + 63) // 64, np.uint64)
        if n:
            word = (place >> np.uint64(6)).astype(np.int64)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            high[word[starts]] = np.bitwise_or.reduceat(ONE << (place & np.uint64(63)), starts)
        zeros = np.concatenate([[0], np.cumsum(64 - np.bitwise_count(high).astype(np.int64))])
        return cls(n, bits, buckets, low, high, zeros)

    def _bucket_ends(self, bucket: np.ndarray) -> np.ndarray:
        """How many values lie in the buckets up to and including each one."""
        word = np.searchsorted(self.zeros, bucket, side="right") - 1
        word = np.minimum(word, len(self.high) - 1)
        inside = _select_in_word(~self.high[word], bucket - self.zeros[word])
        return (word * 64 + inside.astype(np.int64)) - bucket

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        first = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (first >> np.uint64(6)).astype(np.int64), first & np.uint64(63)
        value = self.low[word] >> shift
        over = shift > np.uint64(64 - self.low_bits)
        value[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return value & np.uint64((1 << self.low_bits) - 1)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first value at or above each x, n where there is none, and whether it equals x.

        The high part names the bucket; its few values are told apart by their low bits, by halving.
        """
        x = x.astype(np.uint64)
        if not self.n:
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        bucket = (x >> np.uint64(self.low_bits)).astype(np.int64)
        beyond = bucket >= self.buckets
        bucket = np.minimum(bucket, self.buckets - 1)
        end = self._bucket_ends(bucket)
        start = np.where(bucket > 0, self._bucket_ends(np.maximum(bucket - 1, 0)), 0)
        want = x & np.uint64((1 << self.low_bits) - 1) if self.low_bits else np.zeros(len(x), np.uint64)
        lo, hi = start.copy(), end.copy()
        while True:
            live = np.flatnonzero(lo < hi)
            if not len(live):
                break
            mid = (lo[live] + hi[live]) // 2
            below = self._low(mid) < want[live]
            lo[live[below]] = mid[below] + 1
            hi[live[~below]] = mid[~below]
        found = (lo < end) & ~beyond
        found[found] = self._low(lo[found]) == want[found]
        return np.where(beyond, self.n, lo), found

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at the indices ``i``."""
        i = np.asarray(i, np.int64)
        ones = np.arange(len(self.zeros)) * 64 - self.zeros
        word = np.searchsorted(ones, i, side="right") - 1
        place = word * 64 + _select_in_word(self.high[word], i - ones[word]).astype(np.int64)
        return ((place - i).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(i)


@dataclass
class Level:
    """Children of one level's nodes, in the order of their parents.

    A child is kept relative to its parent: parent number times ``stride`` plus its id, which ascends over
    the level. ``begin`` holds where each node's own children start on the next level, ascending too.
    """
    stride: int
    nodes: EliasFano
    begin: EliasFano
    logp: np.ndarray
    rest: np.ndarray


class Trie:
    """Levels of n-grams, first word first. ``logp`` is a node's log10 probability, ``rest`` what its unseen children share."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    @classmethod
    def build(cls, grams: list[np.ndarray], logp: list[np.ndarray], rest: list[np.ndarray]) -> Trie:
        """``grams[k]`` are the distinct (k+1)-grams as rows of ids, in ascending order; each one's prefix is in ``grams[k-1]``."""
        levels, rank = [], np.zeros(len(grams[0]), np.int64)
        parents = []
        for k, rows in enumerate(grams):
            if k:  # both are in order, so a prefix's number is the number of changes before it
                prefix = rows[:, :-1]
                changed = np.r_[False, (prefix[1:] != prefix[:-1]).any(1)] if len(rows) else np.zeros(0, bool)
                group = np.cumsum(changed)
                first = prefix[np.r_[True, changed[1:]]] if len(rows) else prefix
                if len(first) < len(grams[k - 1]):  # else every node has children, and the groups are the nodes
                    group = _positions(grams[k - 1], first)[group] if len(rows) else group
                rank = group
            parents.append(rank)
        for k, rows in enumerate(grams):
            stride = int(rows[:, -1].max()) + 1 if len(rows) else 1
            values = parents[k].astype(np.uint64) * np.uint64(stride) + rows[:, -1].astype(np.uint64)
            below = parents[k + 1] if k + 1 < len(grams) else np.zeros(0, np.int64)
            begin = np.searchsorted(below, np.arange(len(rows) + 1))
            levels.append(Level(stride, EliasFano.build(values), EliasFano.build(begin), quantise(logp[k]), quantise(rest[k])))
        return cls(levels)

    def find(self, grams: np.ndarray) -> np.ndarray:
        """For rows of ids, the node of the longest known prefix on each level; -1 where unknown."""
        out = np.full(grams.shape, -1, np.int64)
        at = np.zeros(len(grams), np.int64)
        live = np.arange(len(grams))
        for k in range(grams.shape[1]):
            level, ids = self.levels[k], grams[live, k].astype(np.int64)
            near = ids < level.stride  # larger ids would run into the next parent's children
            live, ids, at = live[near], ids[near], at[near]
            place, found = level.nodes.successor(at.astype(np.uint64) * np.uint64(level.stride) + ids.astype(np.uint64))
            live, at = live[found], place[found]
            out[live, k] = at
        return out

    def children(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the children of nodes begin and end on the next level."""
        begin = self.levels[level].begin
        return begin.access(node).astype(np.int64), begin.access(np.asarray(node) + 1).astype(np.int64)

    def write(self, file: BinaryIO) -> None:
        """All levels' arrays one after another, then their places as JSON, then its length."""
        places, at = [], file.tell()
        for level in self.levels:
            entry = {"stride": level.stride}
            for name in ("nodes", "begin"):
                ef = getattr(level, name)
                entry[name] = {"n": ef.n, "low_bits": ef.low_bits, "buckets": ef.buckets}
                for part in ("low", "high", "zeros"):
                    entry[name][part] = (at, str(getattr(ef, part).dtype), len(getattr(ef, part)))
                    at += file.write(getattr(ef, part).tobytes())
            for name in ("logp", "rest"):
                entry[name] = (at, str(getattr(level, name).dtype), len(getattr(level, name)))
                at += file.write(getattr(level, name).tobytes())
                at += file.write(b"\0" * (-at % 8))
            places.append(entry)
        head = json.dumps(places).encode()
        file.write(head + len(head).to_bytes(8, "little"))
        file.flush()

    @classmethod
    def open(cls, file: BinaryIO) -> Trie:
        """Map a written file; nothing is read before it is asked for."""
        mapped = np.memmap(file, np.uint8, "r")
        size = int.from_bytes(mapped[-8:].tobytes(), "little")
        array = lambda at, kind, n: mapped[at:at + n * np.dtype(kind).itemsize].view(kind)
        levels = []
        for entry in json.loads(mapped[-8 - size:-8].tobytes()):
            parts = {name: EliasFano(**{k: array(*v) if isinstance(v, list) else v for k, v in entry[name].items()}) for name in ("nodes", "begin")}
            levels.append(Level(entry["stride"], parts["nodes"], parts["begin"], array(*entry["logp"]), array(*entry["rest"])))
        return cls(levels)


def _positions(rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Numbers of the wanted rows among ascending rows; both in the same order, and every wanted one there."""
    if rows.shape[1] == 1:
        return np.searchsorted(rows[:, 0], wanted[:, 0])
    _, number = np.unique(np.concatenate([rows, wanted]), axis=0, return_inverse=True)
    return number.reshape(-1)[len(rows):]
