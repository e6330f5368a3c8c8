"""Suffix sorting by induction with queues on disk: order and common-prefix values in one go.

Suffixes that start a rising run after a falling one (the seeds) are sorted first: their
substrings up to the next seed are named in order, and the string of names is sorted
by the same method, or by prefix doubling once it fits ``base_items``. All other suffixes
follow by induction: a scan in order puts each suffix's predecessor behind those already in
the queue of its first character. That queue is the priority queue of the method: within a
character, tuples arrive in order of rank, so first in is first out. Tuples carry the
common prefix with their forerunner, which is one more than the least value between the two
places that caused them.

Queues hold ``queue_bytes`` in memory and the rest in an unnamed temporary file, which the
system removes when the task ends in whatever way. Common prefixes stop at ``cap`` (255 at
most), and beyond ``cap`` characters the order of equal suffixes is open.
"""

from __future__ import annotations

import tempfile
from collections import defaultdict

import numpy as np

BASE_ITEMS = 1 << 22
QUEUE_BYTES = 96 << 20


class Queues:
    """A first-in first-out queue for each character, in memory up to a limit and then on disk."""

    def __init__(self, limit: int):
        self.limit, self.held, self.file = limit, 0, None
        self.memory: dict[int, list] = defaultdict(list)
        self.disk: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def add(self, c: int, places: np.ndarray, common: np.ndarray) -> None:
        self.memory[c].append((places, common))
        self.held += places.nbytes + common.nbytes
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for c, parts in self.memory.items():
            self.disk[c].append((self.file.tell(), sum(len(p) for p, _ in parts)))
            self.file.write(np.concatenate([p for p, _ in parts]).astype(np.int64).tobytes())
            self.file.write(np.concatenate([x for _, x in parts]).tobytes())
        self.memory.clear()
        self.held = 0

    def take(self, c: int) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for offset, n in self.disk.pop(c, ()):
            self.file.seek(offset)
            raw = self.file.read(9 * n)
            parts.append((np.frombuffer(raw, np.int64, n), np.frombuffer(raw, np.uint8, n, 8 * n)))
        for part in self.memory.pop(c, ()):
            parts.append(part)
            self.held -= part[0].nbytes + part[1].nbytes
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.uint8)
        return np.concatenate([p for p, _ in parts]), np.concatenate([x for _, x in parts])


class _Least:
    """Least values of ranges of one array."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 << (len(self.rows) - 1) <= len(values):
            last, step = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(last[:-step], last[step:]))

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Over low..high, both included."""
        level = np.log2(high - low + 1).astype(np.int64)
        out = np.empty(len(low), np.uint8)
        for k in np.unique(level).tolist():
            own = level == k
            out[own] = np.minimum(self.rows[k][low[own]], self.rows[k][high[own] - (1 << k) + 1])
        return out


def _rising(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is less than the next one; the end mark counts as rising."""
    n = len(t)
    differs = np.where(t[:-1] != t[1:], np.arange(n - 1), n)
    following = np.minimum.accumulate(differs[::-1])[::-1]
    out = np.ones(n, bool)
    out[:-1] = (t[:-1] < t[1:])[following]
    return out


class _Inducer:
    def __init__(self, t: np.ndarray, rising: np.ndarray, cap: int, queue_bytes: int, common: bool):
        self.t, self.rising, self.cap, self.limit, self.common = t, rising, cap, queue_bytes, common
        sigma = int(t.max()) + 1
        self.since, self.epoch, self.now = np.zeros(sigma, np.uint8), np.full(sigma, -1, np.int64), 0

    def _run(self, i: int) -> int:
        """How often the character at ``i`` repeats from there, up to the cap."""
        part = self.t[i : i + self.cap]
        other = np.flatnonzero(part != part[0])
        return int(other[0]) if len(other) else len(part)

    def _next_bucket(self) -> None:
        self.now += 1
        self.touched: list[np.ndarray] = []

    def _age(self, common: np.ndarray) -> None:
        """Lower what lies behind each character's last tuple by a part that was scanned."""
        if self.common and self.touched:
            seen = np.concatenate(self.touched)
            self.since[seen] = np.minimum(self.since[seen], common.min())

    def _scan(self, queue: Queues, places: np.ndarray, common: np.ndarray, rising: bool) -> None:
        """Queue the predecessors that are (or are not) rising, in the order of ``places``."""
        before = places - 1
        at = np.flatnonzero((places > 0) & (self.rising[before] == rising))
        n = len(places)
        if not len(at):
            self._age(common)
            return
        target = self.t[before[at]]
        order = np.argsort(target, kind="stable")
        at, target = at[order], target[order]
        cut = np.flatnonzero(target[1:] != target[:-1]) + 1
        begin, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(at)]])
        own = target[begin]
        gap = np.zeros(len(at), np.uint8)
        if self.common:
            least = _Least(common)
            low = np.zeros(len(at), np.int64)
            low[1:] = at[:-1] + 1
            low[begin] = 0
            gap = least(low, at)
            # The first of a target also spans what was scanned since its last one, another bucket at worst.
            known = self.epoch[own] == self.now
            gap[begin] = np.where(known, np.minimum(gap[begin], self.since[own]), 0)
            gap = np.minimum(gap.astype(np.int64) + 1, self.cap).astype(np.uint8)
            self._age(common)
            last = at[end - 1]
            rest = np.full(len(own), self.cap, np.uint8)
            more = last + 1 < n
            rest[more] = least(last[more] + 1, np.full(int(more.sum()), n - 1))
            self.since[own] = rest
            self.touched.append(own[~known])
            self.epoch[own] = self.now
        pushed = before[at]
        for c, i, j in zip(own.tolist(), begin.tolist(), end.tolist(), strict=True):
            queue.add(c, pushed[i:j], gap[i:j])

    def _drain(self, queue: Queues, c: int, rising: bool) -> tuple[np.ndarray, np.ndarray]:
        """Everything of one character; scanning it may add to its own queue."""
        places, common = [], []
        while True:
            p, x = queue.take(c)
            if not len(p):
                break
            if not places:
                x = x.copy()
                x[0] = 0
            self._scan(queue, p, x, rising)
            places.append(p)
            common.append(x)
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.uint8)
        return np.concatenate(places), np.concatenate(common)

    def _joint(self, a: np.ndarray, b: np.ndarray) -> int:
        """Common prefix of the last falling and the first rising suffix of a character."""
        return min(self._run(int(a[-1])), self._run(int(b[0]))) if len(a) and len(b) else 0

    def sort(self, seeds: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order and common prefixes of all suffixes from seeds that come ordered (at least by character)."""
        characters = np.unique(self.t).tolist()
        first = np.searchsorted(self.t[seeds], characters + [characters[-1] + 1])
        falling, queue = Queues(self.limit), Queues(self.limit)
        for k, c in enumerate(characters):
            self._next_bucket()
            places, x = self._drain(queue, c, False)
            if len(places):
                falling.add(c, places, x)
            own, y = seeds[first[k] : first[k + 1]], common[first[k] : first[k + 1]].copy()
            if len(own):
                y[0] = self._joint(places, own)
                self._scan(queue, own, y, False)
        out, queue = [], Queues(self.limit)
        for c in reversed(characters):
            self._next_bucket()
            up, up_x = self._drain(queue, c, True)
            down, down_x = falling.take(c)
            if c == 0:
                up, up_x = seeds[:1], np.zeros(1, np.uint8)
            if len(down):
                back = np.empty(len(down), np.uint8)
                back[0] = self._joint(down, up[::-1])
                back[1:] = down_x[:0:-1]
                self._scan(queue, down[::-1], back, True)
            if len(up):
                x = np.empty(len(up), np.uint8)
                x[0] = self._joint(down, up[::-1])
                x[1:] = up_x[::-1][:-1]
                out.append((up[::-1], x))
            out.append((down, down_x))
        return np.concatenate([p for p, _ in out[::-1]]), np.concatenate([x for _, x in out[::-1]])


def _same_prefix(t: np.ndarray, a: np.ndarray, b: np.ndarray, cap: np.ndarray) -> np.ndarray:
    """How many characters the suffixes at a and b share, each pair up to its own cap."""
    n, step = len(t), 4 if t.dtype == np.uint16 else 1
    words = t
    if step == 4:
        padded = np.concatenate([t, np.zeros(4, np.uint16)])
        words = np.ndarray((n,), "<u8", padded.tobytes(), strides=(2,))
    found, live, done = np.zeros(len(a), np.int64), np.arange(len(a)), 0
    while len(live):
        live = live[(a[live] + done < n) & (b[live] + done < n) & (done < cap[live])]
        x = words[a[live] + done] ^ words[b[live] + done]
        if step == 1:
            found[live[x == 0]] = done + 1
        else:
            low = x & (~x + np.uint64(1))
            found[live] = done + np.where(x == 0, 4, np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64) // 16)
        live, done = live[x == 0], done + step
    return np.minimum(found, cap)


def _double(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of ``names`` by prefix doubling, up to ``depth`` names."""
    n, h = len(names), 1
    order = np.argsort(names, kind="stable")
    rank = np.empty(n, np.int64)
    sorted_names = names[order]
    new = np.concatenate([[True], sorted_names[1:] != sorted_names[:-1]])
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while h < depth:
        size = np.bincount(rank, minlength=n)
        live = np.flatnonzero(size[rank] > 1)
        if not len(live):
            break
        then = np.where(live + h < n, rank[np.minimum(live + h, n - 1)] + 1, 0)
        by = np.lexsort((then, rank[live]))
        live, then = live[by], then[by]
        group = rank[live]
        starts = np.concatenate([[True], group[1:] != group[:-1]])
        new = starts | np.concatenate([[True], then[1:] != then[:-1]])
        at = np.arange(len(live))
        inside = at - np.maximum.accumulate(np.where(starts, at, 0))
        place = group + inside
        rank[live] = np.maximum.accumulate(np.where(new, place, 0))
        h *= 2
    return np.argsort(rank, kind="stable")


def suffixes(t: np.ndarray, cap: int, *, base_items: int = BASE_ITEMS, queue_bytes: int = QUEUE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Places of all suffixes of ``t`` in order, and what each shares with the one before it.

    ``t`` ends with 0, which occurs nowhere else.
    """
    if not 0 < cap <= 255:
        raise ValueError("cap must be within 1..255")
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64), np.zeros(1, np.uint8)
    rising = _rising(t)
    seeds = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    # First induction: seeds in any order sort the substrings between seeds.
    start = seeds[np.argsort(t[seeds], kind="stable")]
    rough, _ = _Inducer(t, rising, cap, queue_bytes, False).sort(start, np.zeros(len(start), np.uint8))
    is_seed = np.zeros(n, bool)
    is_seed[seeds] = True
    rough = rough[is_seed[rough]]
    number = np.empty(n, np.int64)
    number[seeds] = np.arange(len(seeds))
    length = np.append(np.diff(seeds) + 1, 1)[number[rough]]
    same = length[1:] == length[:-1]
    same[same] = _same_prefix(t, rough[:-1][same], rough[1:][same], length[1:][same]) == length[1:][same]
    names = np.empty(len(seeds), np.int64)
    names[number[rough]] = np.concatenate([[0], np.cumsum(~same)])
    if same.any():
        if len(names) > base_items:
            order, carried = suffixes(names, cap, base_items=base_items, queue_bytes=queue_bytes)
        else:
            order, carried = _double(names, cap // 2 + 2), None
    else:
        order, carried = np.argsort(names, kind="stable"), np.zeros(len(names), np.uint8)
    ordered = seeds[order]
    # Common names give common characters; the rest is within one substring, or is compared.
    known = np.zeros(len(ordered), np.int64)
    if carried is not None:
        ends = np.minimum(order[1:] + carried[1:], len(seeds) - 1)
        known[1:] = np.minimum(seeds[ends] - seeds[order[1:]], cap)
    rest = _same_prefix(t, ordered[:-1] + known[1:], ordered[1:] + known[1:], cap - known[1:])
    common = np.concatenate([[0], np.minimum(known[1:] + rest, cap)]).astype(np.uint8)
    return _Inducer(t, rising, cap, queue_bytes, True).sort(ordered, common)
