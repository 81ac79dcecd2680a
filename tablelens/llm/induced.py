"""Suffix sorting of one shard by induced sorting, with queues that spill to disk.

The shard is a sequence of strings, each followed by a separator (symbol 0;
bytes are 1 to 256).  As in external induced sorting, leftmost S-type (LMS)
substrings are named, their order is found on the reduced string of names, and
one pass over the symbols in ascending and one in descending order induce the
order of all L-type and S-type suffixes.  Each symbol's queue carries pairs
(position, common prefix with the entry before); entries arrive in their final
order, so a queue is read front to back and may lie on disk.  A common prefix is
1 + the least common prefix between the two entries that induced the pair.

A queue is handled a block at a time with numpy, never an entry at a time.
Common prefixes are cut at ``CAP``.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

CAP = 30_000
BLOCK = 1 << 18
SYMBOLS = 257


class Store:
    """Segments of the queues: in memory up to ``limit`` bytes in all, the rest appended to one unlinked temporary file."""

    def __init__(self, limit: int):
        self.limit, self.held, self.file, self.end = limit, 0, None, 0

    def put(self, pos: np.ndarray, lcp: np.ndarray):
        size = pos.nbytes + lcp.nbytes
        if self.held + size <= self.limit:
            self.held += size
            return pos, lcp
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(self.end)
        self.file.write(pos.tobytes())
        self.file.write(lcp.tobytes())
        at, self.end = self.end, self.end + size
        return at, len(pos)

    def get(self, ref) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(ref[0], np.ndarray):
            return ref
        at, n = ref
        self.file.seek(at)
        raw = self.file.read(n * 10)
        return np.frombuffer(raw, np.int64, n), np.frombuffer(raw, np.int16, n, 8 * n)

    def free(self, ref) -> None:
        if isinstance(ref[0], np.ndarray):
            self.held -= ref[0].nbytes + ref[1].nbytes

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Queues:
    """One first-in first-out queue for each symbol, with the least common prefix since its last entry."""

    def __init__(self, store: Store):
        self.store = store
        self.refs: list[list] = [[] for _ in range(SYMBOLS)]
        self.since = np.zeros(SYMBOLS, dtype=np.int16)

    def push(self, pos: np.ndarray, lcp: np.ndarray, target: np.ndarray, take: np.ndarray) -> None:
        """Entries pos[take] go to queue target; lcp is of all sources, each with the source before it."""
        if len(lcp) == 0:
            return
        least = lcp.min()
        where = np.flatnonzero(take)
        symbols = target[where]
        order = np.argsort(symbols, kind="stable")
        where, symbols = where[order], symbols[order]
        cuts = np.flatnonzero(np.diff(symbols)) + 1
        seen = np.zeros(SYMBOLS, dtype=bool)
        for at in np.split(where, cuts) if len(where) else []:
            c = int(target[at[0]])
            seen[c] = True
            bounds = np.concatenate([[0], at + 1])
            mins = np.minimum.reduceat(lcp[: bounds[-1]], bounds[:-1])
            mins[0] = min(mins[0], self.since[c])
            self.since[c] = lcp[bounds[-1] :].min() if bounds[-1] < len(lcp) else CAP
            self.refs[c].append(self.store.put(pos[at], np.minimum(mins + 1, CAP).astype(np.int16)))
        self.since[~seen] = np.minimum(self.since[~seen], least)


    def blocks(self, c: int, keep: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The entries of c front to back, also those that arrive meanwhile; segments are joined up to BLOCK entries.

        ``keep``: leave the joined segments in the queue (else they are freed).
        """
        first, done = True, []
        while self.refs[c]:
            taken, n = [], 0
            while self.refs[c] and (not taken or n + self._entries(self.refs[c][0]) <= BLOCK):
                taken.append(self.refs[c].pop(0))
                n += self._entries(taken[-1])
            parts = [self.store.get(r) for r in taken]
            pos, lcp = (np.concatenate(x) for x in zip(*parts, strict=True))
            if first:
                lcp[0], first = 0, False  # another first symbol before it
            for r in taken:
                self.store.free(r)
            if keep:
                done.append(self.store.put(pos, lcp))
            yield pos, lcp
        self.refs[c] = done

    @staticmethod
    def _entries(ref) -> int:
        return len(ref[0]) if isinstance(ref[0], np.ndarray) else ref[1]


def _types(t: np.ndarray) -> np.ndarray:
    """S-type flags; the last symbol (a separator) is S-type."""
    n = len(t)
    step = np.zeros(n, dtype=np.int8)
    step[:-1] = np.sign(t[1:].astype(np.int32) - t[:-1])
    step[-1] = 1
    at = np.where(step != 0, np.arange(n), n)
    nearest = np.minimum.accumulate(at[::-1])[::-1]
    return step[nearest] > 0


def _refine(rank: np.ndarray, idx: np.ndarray, key: np.ndarray) -> None:
    """Split tied groups: members idx (whole groups) get ranks by (rank, key); a rank is the number of smaller elements."""
    order = np.lexsort((key, rank[idx]))
    r, k = rank[idx][order], key[order]
    at = np.arange(len(r))
    new_r = np.concatenate([[True], r[1:] != r[:-1]])
    new_k = new_r | np.concatenate([[True], k[1:] != k[:-1]])
    group = np.maximum.accumulate(np.where(new_r, at, 0))
    rank[idx[order]] = r + np.maximum.accumulate(np.where(new_k, at, 0)) - group


def _tied(rank: np.ndarray, idx: np.ndarray) -> np.ndarray:
    """The members of idx whose rank another member shares."""
    order = np.argsort(rank[idx], kind="stable")
    r = rank[idx][order]
    same = np.zeros(len(r), dtype=bool)
    same[1:] = r[1:] == r[:-1]
    same[:-1] |= same[1:]
    return np.sort(idx[order[same]])


def sort_lms(t: np.ndarray, s_type: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The LMS suffixes in order (as positions): name LMS substrings, then double on the reduced string."""
    m = len(lms)
    nxt = np.append(lms[1:], len(t) - 1)
    length = nxt - lms + 1
    rank = np.zeros(m, dtype=np.int64)
    idx, off = np.arange(m), 0
    while len(idx):
        key = np.zeros(len(idx), dtype=np.int64)
        for j in range(off, off + 6):  # six symbols of ten bits: 2 * symbol + type + 1, 0 past the end
            p = lms[idx] + j
            ok = (j < length[idx]) & (p < len(t))
            sym = np.zeros(len(idx), dtype=np.int64)
            q = p[ok]
            sym[ok] = 2 * t[q].astype(np.int64) + s_type[q] + 1
            key = (key << 10) | sym
        _refine(rank, idx, key)
        off += 6
        idx = _tied(rank, idx)
        idx = idx[length[idx] > off]
    idx, width = _tied(rank, np.arange(m)), 1
    while len(idx):
        key = np.where(idx + width < m, rank[np.minimum(idx + width, m - 1)] + 1, 0)
        _refine(rank, idx, key)
        idx, width = _tied(rank, idx), width * 2
    out = np.empty(m, dtype=np.int64)
    out[rank] = lms
    return out


def common_prefixes(t: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of suffix pairs, up to cap, four symbols at a time for those still equal."""
    out = np.zeros(len(a), dtype=np.int64)
    alive = np.arange(len(a))
    last = len(t)  # reading stops at the shard's end, where both sides could agree on padding
    padded = np.concatenate([t, np.zeros(4, t.dtype)]).astype("<u2")
    words = np.ndarray(len(t) + 1, dtype="<u8", buffer=padded.data, strides=(2,))
    while len(alive):
        p, q = a[alive] + out[alive], b[alive] + out[alive]
        x = words[np.minimum(p, last)] ^ words[np.minimum(q, last)]
        got = np.full(len(alive), 4, dtype=np.int64)
        differs = x != 0
        y = x[differs]
        got[differs] = ((y & 0xFFFF) == 0).astype(np.int64) + ((y & 0xFFFFFFFF) == 0) + ((y & 0xFFFFFFFFFFFF) == 0)
        out[alive] += np.minimum(got, np.maximum(last - np.maximum(p, q), 0))
        alive = alive[~differs & (np.maximum(p, q) + 4 <= last) & (out[alive] < cap)]
    return np.minimum(out, cap)


def _pieces(pos: np.ndarray, lcp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for i in range(0, len(pos), BLOCK):
        yield pos[i : i + BLOCK], lcp[i : i + BLOCK]


def suffixes_descending(t: np.ndarray, memory: int, cap: int = CAP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes of t (uint16, ends with 0) in descending order: blocks of (positions, common prefix with the one before)."""
    s_type = _types(t)
    lms = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    seeds = sort_lms(t, s_type, lms)
    seed_lcp = np.zeros(len(seeds), dtype=np.int16)
    seed_lcp[1:] = common_prefixes(t, seeds[:-1], seeds[1:], cap)
    seed_cut = np.searchsorted(t[seeds], np.arange(SYMBOLS + 1))
    store = Store(memory)
    try:
        left = Queues(store)

        def feed(queues: Queues, pos: np.ndarray, lcp: np.ndarray, s: bool) -> None:
            before = np.maximum(pos - 1, 0)
            take = (pos > 0) & (s_type[before] == s)
            queues.push(before, lcp, t[before], take)

        last = -1
        for c in range(SYMBOLS):
            for pos, lcp in left.blocks(c, keep=True):
                feed(left, pos, lcp, False)
                last = int(pos[-1])
            lo, hi = seed_cut[c], seed_cut[c + 1]
            if lo < hi:
                x = seed_lcp[lo:hi].copy()
                x[0] = common_prefixes(t, np.array([last]), seeds[lo : lo + 1], cap)[0] if last >= 0 and t[last] == c else 0
                for p, y in _pieces(seeds[lo:hi], x):
                    feed(left, p, y, False)
                last = int(seeds[hi - 1])
        del seeds, seed_lcp
        right, last = Queues(store), -1
        for c in range(SYMBOLS - 1, -1, -1):
            for pos, lcp in right.blocks(c, keep=False):
                feed(right, pos, lcp, True)
                yield pos, lcp
                last = int(pos[-1])
            carried = None  # the common prefix of the entry below with the one above it
            for ref in reversed(left.refs[c]):
                pos, lcp = store.get(ref)
                down, x = pos[::-1], np.empty(len(pos), dtype=np.int16)
                if carried is None:
                    same = last >= 0 and t[last] == c
                    carried = common_prefixes(t, down[:1], np.array([last]), cap)[0] if same else 0
                x[0], x[1:] = carried, lcp[1:][::-1]
                carried = lcp[0]
                feed(right, down, x, True)
                yield down, x
                last = int(down[-1])
                store.free(ref)
    finally:
        store.close()


def repeated(t: np.ndarray, width: int, memory: int = 64 << 20) -> np.ndarray:
    """Positions from which ``width`` symbols are equal to those from another position."""
    out = np.zeros(len(t), dtype=bool)
    last = 0
    for pos, lcp in suffixes_descending(t, memory, cap=min(CAP, 2 * width)):
        hit = lcp >= width
        out[pos[hit]] = True
        out[pos[:-1][hit[1:]]] = True
        if len(hit) and hit[0]:
            out[last] = True
        last = int(pos[-1])
    return out


def join_strings(strings: list[bytes]) -> np.ndarray:
    """The strings as symbols 1 to 256, each followed by 0."""
    out = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8).astype(np.uint16) + 1
    ends = np.cumsum([len(s) + 1 for s in strings]) - 1
    out[ends] = 0
    return out
