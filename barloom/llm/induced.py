"""Suffix sorting of one shard by induction, with common-prefix values carried along, through queues that spill to disk.

The order of all suffixes follows from that of the leftmost-S suffixes (those at which the text turns from falling to
rising): two passes over the buckets of first bytes, upwards and downwards, move suffix tuples (position, common prefix
with the one before) into the queue of the byte that stands to their left. The leftmost-S suffixes themselves are sorted
by the same induction over their substrings, whose ranks are named and paired, level by level, until a name stands for
as many bytes as matter. The queues are a priority queue whose key is a first byte: the least (or greatest) byte that has tuples is
served first, and tuples of one byte in the order in which they came, which is that of their suffixes. They are taken in
portions, and what is over the limit lies in a file of the task's own, so that a pass holds a few portions in memory.
"""

from __future__ import annotations

import collections
import tempfile

import numpy as np

#: Tuples that the queues of a pass hold in memory, and that are taken at once; more go to a file of the task's own, which
#: ends with it.
IN_MEMORY, PORTION = 1 << 17, 1 << 15
_KIND = np.dtype([("at", "<i8"), ("lcp", "<i4")])


class Queues:
    """One queue for each first byte. Tuples leave a queue in the order in which they came."""

    def __init__(self, n: int, in_memory: int | None = None):
        self.parts: list[collections.deque] = [collections.deque() for _ in range(n)]
        self.held, self.limit, self.file = 0, IN_MEMORY if in_memory is None else in_memory, None

    def push(self, key: int, part: np.ndarray) -> None:
        self.parts[key].append(part)
        self.held += len(part)
        if self.held > self.limit:
            self.spill()

    def spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for queue in self.parts:
            for i, part in enumerate(queue):
                if isinstance(part, np.ndarray):
                    queue[i] = (self.file.tell(), len(part))
                    self.file.write(part.tobytes())
        self.held = 0

    def _read(self, at: int, n: int) -> np.ndarray:
        self.file.seek(at)
        return np.frombuffer(self.file.read(n * _KIND.itemsize), _KIND)

    def pop(self, key: int, most: int | None = None) -> np.ndarray:
        """The first tuples of a queue, PORTION at most, or none if it is empty."""
        queue, out, room = self.parts[key], [], PORTION if most is None else most
        while queue and room:
            part = queue.popleft()
            if isinstance(part, tuple):
                at, n = part
                if n > room:
                    queue.appendleft((at + room * _KIND.itemsize, n - room))
                part = self._read(at, min(n, room))
            else:
                self.held -= min(len(part), room)
                if len(part) > room:
                    queue.appendleft(part[room:])
                    part = part[:room]
            out.append(part)
            room -= len(part)
        return np.concatenate(out) if out else np.zeros(0, _KIND)

    def backwards(self, key: int, most: int | None = None):
        """All tuples of a queue from the last to the first, in portions; the queue keeps them."""
        for part in reversed(self.parts[key]):
            n = part[1] if isinstance(part, tuple) else len(part)
            for z in range(n, 0, -(most or PORTION)):
                a = max(0, z - (most or PORTION))
                yield (self._read(part[0] + a * _KIND.itemsize, z - a) if isinstance(part, tuple) else part[a:z])[::-1]


def _range_min(values: np.ndarray):
    """A function for the least of values[a..b], for arrays of a <= b."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        d = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-d], table[-1][d:]))

    def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        k = np.frexp((b - a + 1).astype(float))[1] - 1
        out = np.empty(len(a), values.dtype)
        for level in np.unique(k).tolist():
            i = np.flatnonzero(k == level)
            out[i] = np.minimum(table[level][a[i]], table[level][b[i] - (1 << level) + 1])
        return out

    return least


def types(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each suffix is smaller than the next, positions of the leftmost such ones). text ends with its least symbol."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    ends = np.append(change, n - 1)  # of runs of one symbol
    rises = np.append(text[change] < text[change + 1], True)
    s = np.repeat(rises, np.diff(np.concatenate([[-1], ends])))
    return s, np.flatnonzero(s[1:] & ~s[:-1]) + 1


def _pass(text: np.ndarray, small: np.ndarray, seeds: Queues, up: bool, symbols: int, cap: int) -> Queues:
    """One pass of the induction: the suffixes of one type by bucket, each with the common prefix to the one taken before.

    Upwards, a bucket's own tuples are taken and then its seeds; every tuple sends the position to its left on if that
    is of the larger type. Downwards the same with the smaller type. `last` keeps, for each queue, the least common
    prefix met since its last tuple, so that what is carried is right across buckets."""
    queues = Queues(symbols)
    last = np.full(symbols, -1, np.int64)  # -1: the queue has had nothing, so there is nothing to have in common
    out = Queues(symbols)

    def send(part: np.ndarray) -> None:
        m = len(part)
        lcp = part["lcp"].astype(np.int64)
        at = part["at"] - 1
        ok = at >= 0
        ok[ok] = (small[at[ok]] != up) & ((text[at[ok]] >= text[at[ok] + 1]) if up else (text[at[ok]] <= text[at[ok] + 1]))
        k = np.flatnonzero(ok)
        to = text[at[k]]
        order = np.argsort(to, kind="stable")
        k, to = k[order], to[order]
        whole = lcp.min()
        new = np.full(len(k), 0, np.int64)
        if len(k):
            least = _range_min(lcp)
            head = np.concatenate([[True], to[1:] != to[:-1]])
            before = np.where(head, 0, np.concatenate([[0], k[:-1] + 1]))
            inside = least(before, k)
            old = last[to]
            new = np.where(head, np.where(old < 0, 0, np.minimum(old, inside) + 1), inside + 1)
            new = np.minimum(new, cap)
        seen = last >= 0
        last[seen] = np.minimum(last[seen], whole)
        if len(k):
            tail = np.flatnonzero(np.concatenate([to[1:] != to[:-1], [True]]))
            after = np.full(len(tail), cap, np.int64)
            more = k[tail] + 1 < m
            if more.any():
                after[more] = least(k[tail[more]] + 1, np.full(more.sum(), m - 1))
            last[to[tail]] = after
            tuples = np.empty(len(k), _KIND)
            tuples["at"], tuples["lcp"] = at[k], new
            cuts = np.append(np.flatnonzero(head), len(k))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                queues.push(int(to[a]), tuples[a:b])

    def cross(part: np.ndarray, before: int) -> np.ndarray:
        """The first tuple of a batch has nothing in common with another bucket's last one; with its own bucket's it has
        at least the symbol, and what is more is not known here: 0 is safe, as joins are compared afterwards."""
        part = part.copy()
        part["lcp"][0] = min(part["lcp"][0], before)
        return part

    for c in range(symbols) if up else range(symbols - 1, -1, -1):
        part = queues.pop(c)
        first = True
        while len(part):
            out.push(c, part)
            send(cross(part, 0) if first else part)
            first = False
            part = queues.pop(c)
        part = seeds.pop(c)
        first = True
        while len(part):
            send(cross(part, 0) if first else part)
            first = False
            part = seeds.pop(c)
    return out


def _turned(portions):
    """Portions of tuples in reverse order, with the common prefix that each then has with the one before it."""
    carried = 0
    for part in portions:
        part = part.copy()
        part["lcp"], carried = np.concatenate([[carried], part["lcp"][:-1]]), part["lcp"][-1]
        yield part


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of the suffixes at a and at b, up to cap, compared symbol by symbol while they are equal."""
    n = len(text)
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for d in range(cap):
        x, y = a[live] + d, b[live] + d
        live = live[(x < n) & (y < n)]
        live = live[text[a[live] + d] == text[b[live] + d]]
        if not len(live):
            break
        out[live] = d + 1
    return out


def _seeds(text: np.ndarray, at: np.ndarray, lcp: np.ndarray, symbols: int, downwards: bool) -> Queues:
    """Leftmost-S suffixes in their order, by first byte; downwards the other way round."""
    q = Queues(symbols)
    tuples = np.empty(len(at), _KIND)
    tuples["at"], tuples["lcp"] = at, lcp
    if downwards:
        tuples = tuples[::-1].copy()
        tuples["lcp"] = np.concatenate([[0], lcp[::-1][:-1]]) if len(lcp) else lcp
    first = text[tuples["at"]]
    cuts = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1], [True]])) if len(at) else np.zeros(0, np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        q.push(int(first[a]), tuples[a:b])
    return q


def _induce(text: np.ndarray, small: np.ndarray, at: np.ndarray, lcp: np.ndarray, symbols: int, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of all suffixes, common prefix with the one before) from the order of the leftmost-S ones."""
    large = _pass(text, small, _seeds(text, at, lcp, symbols, False), True, symbols, cap)
    # Downwards every bucket's larger suffixes come after its smaller ones, in reverse.
    seeds = Queues(symbols)
    for c in range(symbols):
        for part in _turned(large.backwards(c)):
            seeds.push(c, part)
    less = _pass(text, small, seeds, False, symbols, cap)
    out = []
    for c in range(symbols):
        out.append(large.pop(c, len(text)))
        out += _turned(less.backwards(c))
    both = np.concatenate(out)
    # The end stands to the right of nothing, so no pass sends it on: it is the first of all.
    return np.append(len(text) - 1, both["at"]), np.append(0, both["lcp"]).astype(np.int64)


def suffixes(text: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions of all suffixes in the order of their first `cap` symbols, common prefix of each with the one before).

    text: small non-negative integers. Common prefixes are right up to cap; suffixes that agree that far stand side by
    side in any order."""
    text = np.append(text.astype(np.int64) + 1, 0)  # the end is the least symbol
    symbols = int(text.max()) + 1
    small, lms = types(text)
    if len(lms) > 1:
        # Level 0: a name for what each leftmost-S suffix reads up to the next one, from an induction in text order.
        order, _ = _induce(text, small, lms[np.argsort(text[lms], kind="stable")], np.zeros(len(lms), np.int64), symbols, cap)
        is_lms = np.zeros(len(text), bool)
        is_lms[lms] = True
        order = order[is_lms[order]]
        index = np.empty(len(text), np.int64)
        index[lms] = np.arange(len(lms))
        span = np.append(np.diff(lms) + 1, 1)
        length = span[index[order]]
        same = np.zeros(len(order), bool)
        alike = np.flatnonzero(length[1:] == length[:-1]) + 1
        same[alike] = _equal(text, order[alike - 1], order[alike], length[alike])
        name = np.empty(len(lms), np.int64)
        name[index[order]] = np.cumsum(~same)
        # Further levels: names of pairs of names, until one stands for cap symbols or all differ.
        step, reach = 1, int((span - 1).min(initial=1))
        while name.max() < len(lms) and step * max(1, reach) < cap and step < len(lms):
            pair = name * (len(lms) + 2)
            pair[:-step] += name[step:] + 1
            _, name = np.unique(pair, return_inverse=True)
            name = name + 1
            step *= 2
        lms = lms[np.argsort(name, kind="stable")]
    common = np.zeros(len(lms), np.int64)
    if len(lms) > 1:
        common[1:] = _common(text, lms[:-1], lms[1:], cap)
    order, lcp = _induce(text, small, lms, common, symbols, cap)
    # A value is carried as a lower bound where batches of different origin meet; those below the cap are completed.
    open_ = np.flatnonzero(lcp < cap)
    open_ = open_[open_ > 0]
    more = _complete(text, order, lcp, open_, cap)
    lcp[open_] = more
    keep = order < len(text) - 1
    return order[keep], np.minimum(lcp[keep], cap)


def _equal(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    ok = np.ones(len(a), bool)
    live = np.arange(len(a))
    n = len(text)
    for d in range(int(length.max(initial=0))):
        live = live[length[live] > d]
        if not len(live):
            break
        x, y = np.minimum(a[live] + d, n - 1), np.minimum(b[live] + d, n - 1)
        bad = text[x] != text[y]
        ok[live[bad]] = False
        live = live[~bad]
    return ok


def _complete(text: np.ndarray, order: np.ndarray, lcp: np.ndarray, which: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of order[i - 1] and order[i], from the carried lower bounds on."""
    n = len(text)
    a, b, out = order[which - 1], order[which], lcp[which].copy()
    live = np.arange(len(which))
    while len(live):
        x, y = a[live] + out[live], b[live] + out[live]
        ok = (x < n) & (y < n) & (out[live] < cap)
        live = live[ok]
        same = text[a[live] + out[live]] == text[b[live] + out[live]]
        live = live[same]
        out[live] += 1
    return out
