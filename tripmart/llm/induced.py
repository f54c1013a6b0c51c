"""Suffix order and common prefixes of one shard by external induced sorting.

A shard is a text of symbols ``byte + 1`` in which every body ends with the
separator 0; separators count as distinct, so nothing is compared beyond one.

* A suffix is of type S if it is smaller than the one after it, else of type
  L; an S after an L starts an LMS substring. Their substrings are named by
  rank, and the string of names is sorted, each time over names of three
  times the length, until all differ or agree on ``limit`` bytes.
* The sorted LMS suffixes induce the L suffixes from the smallest symbol up,
  and those the S suffixes from the largest down. The priority queue holds
  one tuple per suffix under its first symbol, in order of arrival: position,
  the symbols before it (so the text itself is rarely looked at), and the
  prefix it shares with the tuple before it. The shared prefix of an induced
  pair is one more than the least one between the two that induce it.
* Where only suffixes of ``limit`` bytes or more are asked for, LMS suffixes
  that induce none of them are left out once all are ranked.

Queues and arrays beyond ``memory`` bytes live in unnamed scratch files of
the task, so a shard may be far larger than memory. Work goes in blocks of
tuples, in array operations.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Bits of a symbol in a tuple, the mark that the carried symbols are used up, and how many are carried.
FIELD, USED_UP, CARRIED = 9, 511, 6
SYMBOLS, BLOCK = 257, 1 << 16

Tuples = tuple[np.ndarray, np.ndarray, np.ndarray]


def scratch(n: int, dtype, memory: int) -> np.ndarray:
    """A zeroed array, in an unnamed file if it is larger than ``memory``."""
    if n * np.dtype(dtype).itemsize <= memory:
        return np.zeros(n, dtype=dtype)
    with tempfile.TemporaryFile() as file:
        return np.memmap(file, dtype=dtype, shape=(n,), mode="w+")


class Buckets:
    """Disk-backed priority queue: tuples by first symbol, in order of arrival within it."""

    WIDTH = (np.dtype(np.int64), np.dtype(np.uint64), np.dtype(np.uint8))

    def __init__(self, memory: int):
        self.blocks: list[list] = [[] for _ in range(SYMBOLS)]
        self.held, self.memory, self.file = 0, memory, None

    def push(self, symbol: int, block: Tuples) -> None:
        self.blocks[symbol].append(block)
        self.held += sum(x.nbytes for x in block)
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        """Write all held blocks to the scratch file, those of a symbol as one."""
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for symbol, blocks in enumerate(self.blocks):
            kept = [b for b in blocks if isinstance(b[0], int)]
            for held in _runs([b for b in blocks if not isinstance(b[0], int)]):
                kept.append((self.file.tell(), len(held[0])))
                for column in held:
                    self.file.write(np.ascontiguousarray(column).data)
            self.blocks[symbol] = kept
        self.held = 0

    def _load(self, block: tuple) -> Tuples:
        if not isinstance(block[0], int):
            return block
        at, n = block
        self.file.seek(at)
        return tuple(np.frombuffer(self.file.read(n * t.itemsize), dtype=t) for t in self.WIDTH)

    def forward(self, symbol: int) -> Iterator[Tuples]:
        """Blocks of a symbol, those that arrive meanwhile included."""
        done = 0
        while True:
            at, n = 0, 0
            found = []
            for block in self.blocks[symbol]:
                count = block[1] if isinstance(block[0], int) else len(block[0])
                if at + count > done and n < BLOCK:
                    found.append(tuple(x[max(0, done - at) :] for x in self._load(block)))
                    n += len(found[-1][0])
                at += count
            if not n:
                return
            done += n
            yield from _runs(found)

    def backward(self, symbol: int) -> Iterator[Tuples]:
        """Tuples of a symbol from the last to the first; their prefixes shared with the one before in this order."""
        after = 0
        held: list[Tuples] = []
        for block in reversed(self.blocks[symbol]):
            held.insert(0, self._load(block))
            if sum(len(x[0]) for x in held) >= BLOCK:
                pos, prev, lcp = next(_runs(held))
                yield pos[::-1], prev[::-1], np.concatenate(([after], lcp[:0:-1])).astype(np.uint8)
                after, held = lcp[0], []
        for pos, prev, lcp in _runs(held):
            yield pos[::-1], prev[::-1], np.concatenate(([after], lcp[:0:-1])).astype(np.uint8)


def _runs(blocks: list[Tuples]) -> Iterator[Tuples]:
    if len(blocks) == 1:
        yield blocks[0]
    elif blocks:
        yield tuple(np.concatenate(columns) for columns in zip(*blocks))


def sorted_order(key: np.ndarray, memory: int) -> np.ndarray:
    """Positions of ``key`` in rising order, those of equal keys in any: sorted runs, merged block by block when there are several."""
    size = max(BLOCK // 16, memory // 32)
    if len(key) <= size:
        return np.argsort(key)
    runs = []
    for a in range(0, len(key), size):
        order = np.argsort(key[a : a + size])
        pair = [scratch(len(order), np.uint64, 0), scratch(len(order), np.int64, 0)]
        pair[0][:], pair[1][:] = np.asarray(key[a : a + size])[order], order + a
        runs.append(pair)
    out, done = scratch(len(key), np.int64, memory), 0
    at, step = [0] * len(runs), max(1, size // len(runs))
    while done < len(key):
        ends = [keys[min(p + step, len(keys)) - 1] for (keys, _), p in zip(runs, at) if p < len(keys)]
        bound = min(ends)
        keys_now, order_now = [], []
        for i, (keys, order) in enumerate(runs):
            stop = at[i] + int(np.searchsorted(keys[at[i] :], bound, "right"))
            # All keys up to the smallest block end, and no more of an equal key than one step at a time.
            stop = min(stop, at[i] + step)
            keys_now.append(keys[at[i] : stop])
            order_now.append(order[at[i] : stop])
            at[i] = stop
        order = np.concatenate(order_now)[np.argsort(np.concatenate(keys_now))]
        out[done : done + len(order)] = order
        done += len(order)
    return out


class Shard:
    """Suffixes of the bodies of one shard, compared on ``limit`` (at most 254) bytes."""

    def __init__(self, bodies: list[bytes], limit: int, memory: int = 1 << 30):
        self.limit, self.memory = limit, memory
        sizes = np.fromiter(map(len, bodies), dtype=np.int64, count=len(bodies))
        self.starts = np.cumsum(sizes + 1) - sizes
        self.n = int(sizes.sum() + len(sizes) + 1)
        self.text = scratch(self.n + 256, np.uint16, memory)
        #: Distance to the body's end, as far as the limit.
        self.left = scratch(self.n + 1, np.uint8, memory)
        down = np.minimum(np.arange(int(sizes.max(initial=0)), 0, -1), limit).astype(np.uint8)
        for a, body in zip(self.starts.tolist(), bodies):
            self.text[a : a + len(body)] = np.frombuffer(body, dtype=np.uint8)
            self.text[a : a + len(body)] += 1
            self.left[a : a + len(body)] = down[len(down) - len(body) :]

    # -- LMS suffixes ----------------------------------------------------------
    def _lms(self) -> np.ndarray:
        """Positions of S suffixes after L suffixes, the final separator included."""
        text = self.text[: self.n]
        change = np.flatnonzero(text[1:] != text[:-1])
        rising = text[change] < text[change + 1]
        small = np.repeat(rising, np.diff(change, prepend=-1))
        return np.flatnonzero(np.concatenate((small[1:], [True])) & ~small) + 1

    def _word(self, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Seven symbols from ``at`` on, those past ``end`` larger than any."""
        out, rest = np.zeros(len(at), dtype=np.uint64), end - at
        symbols = np.lib.stride_tricks.sliding_window_view(self.text, 7)[at]
        for k in range(7):
            out <<= np.uint64(FIELD)
            out |= np.where(rest >= k, symbols[:, k], np.uint16(USED_UP))
        return out

    def _names(self, lms: np.ndarray) -> np.ndarray:
        """Rank of each LMS substring: how many are smaller; separators are told apart by position."""
        end = np.append(lms[1:], lms[-1:])
        ranks = self._grouped(self._word(lms, end))
        at = 7
        while len(more := np.flatnonzero(end - lms >= at)):
            tail = np.full(len(lms), np.uint64((1 << 32) - 1))
            tail[more] = self._grouped(self._word(lms[more] + at, end[more])).astype(np.uint64)
            ranks = self._refined(ranks, np.flatnonzero(np.bincount(ranks, minlength=len(lms))[ranks] > 1), tail)
            at += 7
        parted = np.flatnonzero(self.text[lms] == 0)
        ranks[parted] = np.arange(len(parted))
        return ranks

    def _grouped(self, key: np.ndarray) -> np.ndarray:
        order = sorted_order(key, self.memory)
        return self._ranks(order, key[order], np.zeros(len(order), dtype=np.int64))

    def _ranks(self, order: np.ndarray, keys: np.ndarray, base: np.ndarray) -> np.ndarray:
        new = np.ones(len(order), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        out = np.empty(len(order), dtype=np.int64)
        out[order] = base + first
        return out

    def _refined(self, ranks: np.ndarray, tied: np.ndarray, second: np.ndarray, third: np.ndarray | None = None) -> np.ndarray:
        """Ranks with the tied ones told apart by one or two further numbers."""
        if not len(tied):
            return ranks
        old = ranks[tied]
        if third is not None and len(ranks) < 1 << 21:
            low = (second[tied].astype(np.uint64) << np.uint64(21)) | third[tied].astype(np.uint64)
            key = (old.astype(np.uint64) << np.uint64(42)) | low
        else:
            key = (old.astype(np.uint64) << np.uint64(32)) | second[tied].astype(np.uint64)
        order = sorted_order(key, self.memory)
        sorted_old = old[order]
        group = np.ones(len(order), dtype=bool)
        group[1:] = sorted_old[1:] != sorted_old[:-1]
        start = np.maximum.accumulate(np.where(group, np.arange(len(order)), 0))
        out = ranks.copy()
        out[tied] = self._ranks(order, key[order], sorted_old - start)
        return out

    def sorted_lms(self, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """LMS positions in suffix order, as far as ``limit`` bytes tell, with the prefix shared with the one before.

        With ``whole``, only those between which and the LMS position before them a suffix of ``limit`` bytes or more starts.
        """
        lms = self._lms()
        ranks, reach = self._names(lms), 1
        m = len(lms)
        while True:
            tied = np.flatnonzero(np.bincount(ranks, minlength=m)[ranks] > 1)
            covered = lms[np.minimum(tied + reach, m - 1)] - lms[tied]
            tied = tied[covered < self.limit]
            if not len(tied):
                break
            # A whole group is told apart at once: rows of one rank cover the same number of bytes.
            step = [np.append(ranks[k * reach :], np.zeros(min(k * reach, m), dtype=np.int64))[:m] for k in (1, 2)]
            three = m < 1 << 21
            ranks = self._refined(ranks, tied, step[0], step[1] if three else None)
            reach *= 3 if three else 2
        if whole:
            # An LMS position induces the suffixes from the one before it on, itself not included.
            known = np.concatenate(([0], np.cumsum(self.left[: self.n] >= self.limit, dtype=np.int64)))
            wanted = np.diff(known[lms], prepend=0) > 0
            lms, ranks = lms[wanted], ranks[wanted]
        order = lms[sorted_order(ranks.astype(np.uint64), self.memory)]
        return order, self._shared(order)

    def _shared(self, order: np.ndarray) -> np.ndarray:
        """Prefix that each suffix shares with the one before it, eight bytes at a time (none is looked at beyond a separator)."""
        out, raw = scratch(len(order), np.uint8, self.memory), scratch(self.n + 256, np.uint8, self.memory)
        for a in range(0, self.n, BLOCK):
            raw[a : a + BLOCK] = self.text[a : a + BLOCK]
        words = np.ndarray((self.n + 248,), dtype="<u8", buffer=raw, strides=(1,))
        for a in range(1, len(order), BLOCK):
            p, q = order[a - 1 : a - 1 + BLOCK][: len(order) - a], order[a : a + BLOCK]
            most = np.minimum(self.left[p], self.left[q]).astype(np.int64)
            same, live = most.copy(), np.flatnonzero(most)
            for r in range(0, self.limit, 8):
                x = words[p[live] + r] ^ words[q[live] + r]
                parted = x != 0
                x = x[parted]
                # The lowest bit set lies in the first byte that differs.
                same[live[parted]] = r + (np.frexp((x & (~x + np.uint64(1))).astype(np.float64))[1] - 1) // 8
                live = live[~parted & (most[live] > r + 8)]
                if not len(live):
                    break
            out[a : a + len(q)] = np.minimum(same, most)
        return out

    # -- induction -------------------------------------------------------------
    def _carry(self, pos: np.ndarray) -> np.ndarray:
        """The symbols before each position, nearest in the lowest bits, then the mark."""
        out = np.full(len(pos), USED_UP, dtype=np.uint64)
        for k in range(CARRIED, 0, -1):
            symbol = np.where(pos >= k, self.text[np.maximum(pos - k, 0)], 0)
            out = (out << np.uint64(FIELD)) | symbol.astype(np.uint64)
        return out

    def _before(self, pos: np.ndarray, prev: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol before each position, and the carried symbols, loaded anew where they are used up."""
        symbol = (prev & np.uint64(USED_UP)).astype(np.uint16)
        spent = np.flatnonzero(symbol == USED_UP)
        if len(spent):
            prev = prev.copy()
            prev[spent] = self._carry(pos[spent])
            symbol[spent] = prev[spent] & np.uint64(USED_UP)
        return symbol, prev

    def _induce(self, queue: Buckets, low: np.ndarray, block: Tuples, symbol: np.ndarray, chosen: np.ndarray) -> None:
        """Put the suffixes one symbol longer than the chosen ones into the queue, with their shared prefixes.

        ``low`` holds, for each symbol, the least shared prefix since the last arrival there.
        """
        pos, prev, lcp = block
        at = np.flatnonzero(chosen)
        least = np.minimum.accumulate(lcp)
        if not len(at):
            np.minimum(low, least[-1], out=low)
            return
        to = symbol[at]
        order = np.argsort(to, kind="stable")
        at, to = at[order], to[order]
        heads = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
        shared = np.empty(len(at), dtype=np.int64)
        shared[1:] = _least_between(lcp, at[:-1] + 1, at[1:])
        groups = to[heads]
        shared[heads] = np.minimum(low[groups], least[at[heads]])
        tails = np.append(heads[1:], len(at))
        later = np.append(np.minimum.accumulate(lcp[::-1])[::-1], self.limit)
        np.minimum(low, least[-1], out=low)
        low[groups] = later[at[tails - 1] + 1]
        new = pos[at] - 1, prev[at] >> np.uint64(FIELD), np.minimum(shared + 1, self.limit).astype(np.uint8)
        for a, b, g in zip(heads.tolist(), tails.tolist(), groups.tolist()):
            queue.push(g, tuple(x[a:b] for x in new))

    def _share_at(self, p: int, q: int) -> int:
        """Prefix shared by two suffixes, compared directly (once for each symbol)."""
        most = int(min(self.left[p], self.left[q]))
        differ = np.flatnonzero(self.text[p : p + most] != self.text[q : q + most])
        return int(differ[0]) if len(differ) else most

    def _large(self, seeds: np.ndarray, shared: np.ndarray) -> Buckets:
        """L suffixes in order, from the sorted LMS suffixes."""
        queue, low = Buckets(self.memory), np.full(SYMBOLS, -1, dtype=np.int64)
        edges = np.searchsorted(self.text[seeds], np.arange(SYMBOLS + 1))
        for symbol in range(SYMBOLS):
            last = None
            for pos, prev, lcp in queue.forward(symbol):
                before, prev = self._before(pos, prev)
                self._induce(queue, low, (pos, prev, lcp), before, before >= symbol)
                last = int(pos[-1])
            for a in range(edges[symbol], edges[symbol + 1], BLOCK):
                pos, lcp = seeds[a : min(a + BLOCK, edges[symbol + 1])], shared[a : min(a + BLOCK, edges[symbol + 1])].copy()
                if a == edges[symbol]:
                    lcp[0] = 0 if last is None else self._share_at(last, int(pos[0]))
                prev = self._carry(pos)
                before = (prev & np.uint64(USED_UP)).astype(np.uint16)
                self._induce(queue, low, (pos, prev, lcp), before, before > symbol)
        return queue

    def suffixes(self, whole: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All suffixes from the largest to the smallest, with the prefix each shares with the one before.

        With ``whole``, all of ``limit`` bytes or more and few others.
        """
        if self.n <= 1:
            return
        large = self._large(*self.sorted_lms(whole))
        queue, low = Buckets(self.memory), np.full(SYMBOLS, -1, dtype=np.int64)
        for symbol in range(SYMBOLS - 1, 0, -1):
            last = None
            for pos, prev, lcp in queue.forward(symbol):
                before, prev = self._before(pos, prev)
                self._induce(queue, low, (pos, prev, lcp), before, (before <= symbol) & (before > 0))
                last = int(pos[-1])
                yield pos, lcp
            first = True
            for pos, prev, lcp in large.backward(symbol):
                if first and last is not None:
                    lcp[0] = self._share_at(last, int(pos[0]))
                first = False
                before, prev = self._before(pos, prev)
                self._induce(queue, low, (pos, prev, lcp), before, (before < symbol) & (before > 0))
                yield pos, lcp

    def classes(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Starts of whole ``limit``-byte strings and the class of each, a class never split over two blocks."""
        held_pos, held_class, current = np.empty(0, np.int64), np.empty(0, np.int64), 0
        for pos, lcp in self.suffixes(whole=True):
            whole = self.left[pos] >= self.limit
            number = current + np.cumsum(lcp < self.limit)
            current = int(number[-1])
            held_pos = np.concatenate((held_pos, pos[whole]))
            held_class = np.concatenate((held_class, number[whole]))
            ready = int(np.searchsorted(held_class, current))
            if ready:
                yield held_pos[:ready], held_class[:ready]
                held_pos, held_class = held_pos[ready:], held_class[ready:]
        if len(held_pos):
            yield held_pos, held_class


def _least_between(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``min(x[a..b])`` for each pair, from minima over powers of two (pairs with ``b < a`` give anything)."""
    size = np.maximum(b - a + 1, 1)
    level = np.frexp(size.astype(np.float64))[1] - 1
    table = [x]
    for k in range(int(level.max(initial=0))):
        step, last = 1 << k, table[-1]
        table.append(np.minimum(last, np.append(last[step:], last[-1:].repeat(min(step, len(last))))[: len(last)]))
    flat, n = np.concatenate(table), len(x)
    second = np.maximum(b - (np.int64(1) << level) + 1, 0)
    return np.minimum(flat[level * n + np.minimum(a, n - 1)], flat[level * n + second])
