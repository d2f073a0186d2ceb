"""External induced sorting of suffixes with common-prefix values.

``sort_suffixes`` sorts all suffixes of a set of sequences (each ended by its own
terminator) and gives the length of the common prefix of neighbours.  It is
induced sorting in external form: the leftmost S-type (LMS) suffixes are sorted by
naming their substrings and recursing on the names, then two scans induce the L-type
and the S-type suffixes.  The scans are driven by a priority queue over the first
symbol whose entries, (position, common prefix with the entry before), leave in the
order they came for equal symbols; as the entries of every symbol can be counted before,
it is one array with a place for each symbol, a file beyond a memory limit.  The common
prefix of two induced suffixes is one more than the least common prefix between the
suffixes that induced them.  Work on a block is vectorised.

Beyond the memory limit symbols, types, positions, names and results are files: the
names come from an external merge sort of the LMS substrings, the recursion writes
its order in blocks, and the queue and all values per symbol (of which the recursion has
as many as there are different names) are memory-mapped.  Memory then holds some blocks
and parts of the limit.  A level whose LMS suffixes fit the limit sorts
them in memory by prefix doubling, which is much faster; shards are best sized for that.
"""

from __future__ import annotations

import heapq
import os
import tempfile

import numpy as np

BLOCK = 1 << 18
MEMORY = 256 << 20
FAN_IN = 64
_FAR = np.int32(np.iinfo(np.int32).max)
_ENTRY = np.dtype([("pos", np.int64), ("lcp", np.int32)])


class Space:
    """Scratch files of one sort; arrays above an eighth of ``limit`` bytes (or ``most``) are memory-mapped."""

    def __init__(self, limit: int = MEMORY):
        self.limit, self.dir, self.made = limit, tempfile.TemporaryDirectory(prefix="induced-"), 0

    def path(self) -> str:
        self.made += 1
        return os.path.join(self.dir.name, str(self.made))

    def array(self, n: int, dtype, most: int | None = None) -> np.ndarray:
        if n * np.dtype(dtype).itemsize <= (self.limit // 8 if most is None else most):
            return np.zeros(n, dtype)
        return np.asarray(np.memmap(self.path(), dtype=dtype, mode="w+", shape=(n,)))

    def appended(self, parts, dtype) -> np.ndarray:
        """All parts as one array, collected in a file."""
        path, n = self.path(), 0
        with open(path, "wb") as f:
            for p in parts:
                p.astype(dtype).tofile(f)
                n += len(p)
        if n * np.dtype(dtype).itemsize <= self.limit // 8:
            out = np.fromfile(path, dtype)
            os.remove(path)
            return out
        return np.asarray(np.memmap(path, dtype=dtype, mode="r+", shape=(n,)))

    def close(self) -> None:
        self.dir.cleanup()


class Buckets:
    """Entries (position, common prefix with the entry before) by symbol, in the order they come.

    ``start[c]`` to ``start[c + 1]`` is the place of symbol c; ``end[c]`` is how far it is filled.
    """

    def __init__(self, space: Space, codes: np.ndarray, kind: np.ndarray, wanted: int, n_symbols: int):
        self.start, self.end = space.array(n_symbols + 1, np.int64), space.array(n_symbols, np.int64)
        for k in range(0, len(codes), BLOCK):
            c = np.asarray(codes[k:k + BLOCK])
            found, n = np.unique(c[(np.asarray(kind[k:k + BLOCK]) == wanted) & (c != 0)], return_counts=True)
            self.start[found.astype(np.int64) + 1] += n
        total = 0
        for k in range(0, n_symbols + 1, BLOCK):
            part = np.cumsum(self.start[k:k + BLOCK]) + total
            self.start[k:k + BLOCK] = part
            total = int(part[-1])
        self.end[:] = self.start[:-1]
        self.pos, self.lcp = space.array(total, np.int64, space.limit), space.array(total, np.int32, space.limit)

    def push(self, dest: np.ndarray, cuts: np.ndarray, pos: np.ndarray, lcp: np.ndarray) -> None:
        """``dest`` is ascending; ``cuts`` are the first places of its different symbols."""
        size, symbol = np.diff(np.r_[cuts, len(dest)]), dest[cuts]
        at = self.end[symbol]
        place = np.repeat(at - cuts, size) + np.arange(len(dest))
        self.pos[place], self.lcp[place] = pos, lcp
        self.end[symbol] = at + size

    def blocks(self, lo: int, hi: int):
        for k in range(lo, hi, BLOCK):
            yield np.array(self.pos[k:min(hi, k + BLOCK)]), np.array(self.lcp[k:min(hi, k + BLOCK)])

    def turned(self, symbol: int, edge: int):
        """The entries of a symbol from last to first, with the common prefix with the entry
        yielded before; ``edge`` is that of the first one yielded."""
        lo, hi = int(self.start[symbol]), int(self.end[symbol])
        for k in range(hi, lo, -BLOCK):
            p, x = np.array(self.pos[max(lo, k - BLOCK):k]), np.array(self.lcp[max(lo, k - BLOCK):k])
            yield p[::-1], np.r_[np.int32(edge), x[:0:-1]].astype(np.int32)
            edge = x[0]


def _range_min(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of every x[lo..hi] (inclusive, lo <= hi)."""
    out = np.empty(len(lo), x.dtype)
    level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
    for k in range(int(level.max(initial=-1)) + 1):  # x[i] is now the minimum of 2**k values from i on
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(x[lo[at]], x[hi[at] + 1 - (1 << k)])
        x = np.minimum(x[:-(1 << k)], x[1 << k:])
    return out


class _Scan:
    """Pushes what the entries of one bucket after another induce, with carried minima of common prefixes.

    For a symbol that got an entry from this bucket, ``tail`` is the least common prefix since then in
    that block of entries, and a stack of the minima of later blocks gives the rest.
    """

    def __init__(self, space: Space, out: Buckets, n_symbols: int):
        self.out, self.bucket = out, 0
        self.last, self.block = space.array(n_symbols, np.int64), space.array(n_symbols, np.int64)
        self.tail = space.array(n_symbols, np.int32)
        self.stack = np.empty((2, 64), np.int64)  # numbers and minima of blocks, both ascending

    def begin(self) -> None:
        self.bucket, self.blocks, self.top = self.bucket + 1, 0, 0

    def feed(self, pos: np.ndarray, lcp: np.ndarray, symbol: np.ndarray, wanted: np.ndarray) -> None:
        """``lcp[i]`` is the common prefix with the entry before."""
        picked = np.flatnonzero(wanted)
        if len(picked):
            at = picked[np.argsort(symbol[picked], kind="stable")]
            dest = symbol[at].astype(np.int64)
            head = np.r_[True, dest[1:] != dest[:-1]]
            cuts = np.flatnonzero(head)
            d, rest = dest[cuts], np.flatnonzero(~head)
            low = np.empty(len(at), np.int64)
            low[rest] = _range_min(lcp, at[rest - 1] + 1, at[rest])
            # The first of a symbol reaches back into earlier blocks; prefixes across buckets are 0.
            numbers, minima = self.stack[:, :self.top]
            later = np.r_[minima, _FAR][np.searchsorted(numbers, self.block[d], "right")]
            carried = np.where(self.last[d] == self.bucket, np.minimum(self.tail[d], later), 0)
            low[cuts] = np.minimum(np.minimum.accumulate(lcp)[at[cuts]], carried)
            value = low + 1
            value[cuts[self.out.end[d] == self.out.start[d]]] = 0
            self.out.push(dest, cuts, pos[at] - 1, value)
            final = at[np.r_[cuts[1:], len(dest)] - 1]
            self.last[d], self.block[d] = self.bucket, self.blocks
            self.tail[d] = np.r_[np.minimum.accumulate(lcp[::-1])[::-1], _FAR][final + 1]
        if len(lcp):
            least = int(lcp.min())
            self.top = int(np.searchsorted(self.stack[1, :self.top], least))
            if self.top == self.stack.shape[1]:
                self.stack = np.c_[self.stack, np.empty_like(self.stack)]
            self.stack[:, self.top] = self.blocks, least
            self.top += 1
        self.blocks += 1


def _types(codes: np.ndarray, space: Space) -> np.ndarray:
    """1 where the suffix is S-type; terminators (0) are S-type."""
    n = len(codes)
    kind = space.array(n, np.uint8)
    right, right_kind = -1, 1  # behind the end
    for hi in range(n, 0, -BLOCK):
        lo = max(0, hi - BLOCK)
        c = np.asarray(codes[lo:hi]).astype(np.int64)
        nxt = np.r_[c[1:], right]
        rel = np.where(nxt > c, 1, np.where(nxt < c, 0, 2)).astype(np.uint8)
        if right < 0:
            rel[-1] = 1
        if rel[-1] == 2:
            rel[-1] = right_kind
        # Equal neighbours take the type of the next decided position.
        decided = np.where(rel != 2, np.arange(len(rel)), len(rel))
        rel = rel[np.minimum.accumulate(decided[::-1])[::-1]]
        rel[c == 0] = 1
        kind[lo:hi] = rel
        right, right_kind = int(c[0]), int(rel[0])
    return kind


def _run_length(codes: np.ndarray, at: int) -> int:
    c, k = codes[at], at
    while k < len(codes) and codes[k] == c:
        step = np.flatnonzero(np.asarray(codes[k:k + 256]) != c)
        if len(step):
            return k + int(step[0]) - at
        k += 256
    return min(k, len(codes)) - at


def _symbol_lcp(codes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common prefix of the suffixes at a and b; terminators are all different."""
    out = np.zeros(len(a), np.int32)
    live = np.arange(len(a))
    a, b = a.copy(), b.copy()
    while len(live):
        x, y = codes[a], codes[b]
        same = (x == y) & (x != 0)
        live, a, b = live[same], a[same] + 1, b[same] + 1
        out[live] += 1
    return out


def _name_substrings(codes, lms: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rank of every LMS substring codes[lms..ends] (inclusive); terminators count as their number, below all."""
    # Six symbols at a time: ties among substrings that go on are broken by the next six.
    wide = int(codes.max(initial=0)) + 2
    take = max(1, min(6, int(62 // max(1, wide.bit_length()))))
    n = len(lms)
    rank = np.zeros(n, np.int64)
    live, depth = np.arange(n), 0
    while len(live):
        key = np.zeros(len(live), np.int64)
        for k in range(take):
            p = lms[live] + depth + k
            inside = p <= ends[live]
            sym = np.full(len(live), wide, np.int64)  # a proper prefix is the larger one
            sym[inside] = codes[p[inside]]
            key = key * (wide + 1) + sym
        order = np.lexsort((key, rank[live]))
        r, v = rank[live][order], key[order]
        head = np.r_[True, (r[1:] != r[:-1]) | (v[1:] != v[:-1])]
        at = np.arange(len(live))
        group = np.r_[True, r[1:] != r[:-1]]
        base = np.maximum.accumulate(np.where(group, at, 0))
        first = np.maximum.accumulate(np.where(head, at, 0))
        rank[live[order]] = r + (first - base)
        size = np.bincount(np.cumsum(head) - 1)
        tied = np.zeros(len(live), bool)
        tied[order] = size[np.cumsum(head) - 1] > 1
        depth += take
        live = live[tied & (lms[live] + depth <= ends[live] + 1)]  # one that just ended differs from one that goes on
    return rank


def _sort_in_memory(rank: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a sequence of ranks whose terminators are unique, by prefix doubling."""
    n = len(rank)
    rank = rank.copy()
    order = np.argsort(rank, kind="stable")
    r = rank[order]
    head = np.r_[True, r[1:] != r[:-1]]
    first = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank[order] = first
    size = np.bincount(np.cumsum(head) - 1)
    live = order[size[np.cumsum(head) - 1] > 1]
    h = 1
    while len(live):
        # Suffixes tied over h symbols have no terminator among them, so live + h is inside.
        key = rank[live] * np.int64(n) + rank[live + h]
        o = np.argsort(key, kind="stable")
        live, key = live[o], key[o]
        r = key // n
        at = np.arange(len(live))
        head = np.r_[True, key[1:] != key[:-1]]
        group = np.r_[True, r[1:] != r[:-1]]
        base = np.maximum.accumulate(np.where(group, at, 0))
        first = np.maximum.accumulate(np.where(head, at, 0))
        rank[live] = r + (first - base)
        size = np.bincount(np.cumsum(head) - 1)
        live = live[size[np.cumsum(head) - 1] > 1]
        h *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


def _names_in_memory(codes, lms, is_end: np.ndarray) -> np.ndarray:
    """Names (from 1) of the LMS substrings in their order, 0 for terminators."""
    ends = np.r_[lms[1:], lms[-1]]
    text = np.flatnonzero(~is_end)
    name = np.zeros(len(lms), np.int64)
    name[text] = _name_substrings(codes, lms[text], ends[text]) + 1
    return name


def _names_by_merging(codes, lms, space: Space) -> np.ndarray:
    """The same names by an external merge sort of the substrings."""

    def run(path):
        with open(path, "rb") as f:
            while head := f.read(12):
                yield f.read(int.from_bytes(head[:4], "big")), int.from_bytes(head[4:], "big")

    def written(keys) -> str:
        path = space.path()
        with open(path, "wb") as f:
            for symbols, i in keys:
                f.write(len(symbols).to_bytes(4, "big") + i.to_bytes(8, "big") + symbols)
        return path

    paths, keys, held, step = [], [], 0, max(16, min(BLOCK, space.limit // 256))
    for k in range(0, len(lms), step):
        part = np.asarray(lms[k:k + step + 1]).tolist()
        for i in range(min(step, len(lms) - k)):
            if codes[part[i]] == 0:
                continue
            # The end mark is larger than every symbol: a proper prefix is the larger substring.
            symbols = np.asarray(codes[part[i]:part[i + 1] + 1]).astype(">u8").tobytes() + b"\xff" * 8
            keys.append((symbols, k + i))
            held += len(symbols) + 128  # with the objects around it
            if held > space.limit // 2:
                keys.sort()
                paths.append(written(keys))
                keys, held = [], 0
    if keys:
        keys.sort()
        paths.append(written(keys))
        del keys
    while len(paths) > FAN_IN:  # no pass opens more files
        merged = []
        for k in range(0, len(paths), FAN_IN):
            merged.append(written(heapq.merge(*map(run, paths[k:k + FAN_IN]))))
            for path in paths[k:k + FAN_IN]:
                os.remove(path)
        paths = merged
    name, last, number = space.array(len(lms), np.int64), None, 0
    for symbols, i in heapq.merge(*map(run, paths)):
        if symbols != last:
            last, number = symbols, number + 1
        name[i] = number
    for path in paths:
        os.remove(path)
    return name


def _sort_lms(codes, lms: np.ndarray, space: Space) -> tuple[np.ndarray, np.ndarray]:
    """LMS positions in suffix order, with the common prefix with the one before.

    Terminators come first, in order of position, and share nothing with others.
    """
    if len(lms) * 8 * 6 <= space.limit:
        is_end = np.asarray(codes[lms]) == 0
        name = _names_in_memory(codes, lms, is_end)
        n_ends = int(is_end.sum())
        rank = np.where(is_end, np.cumsum(is_end) - 1, n_ends - 1 + name)
        order = _sort_in_memory(rank)
        prefix = np.zeros(len(order), np.int32)
        prefix[1:] = _symbol_lcp(name, order[:-1], order[1:])
        ordered = [(order, prefix)]
    else:
        name = _names_by_merging(codes, lms, space)
        ordered = _recurse(name, space)
    before = None

    def converted():
        # ``prefix`` equal names cover so many symbols; the differing substrings are compared directly.
        nonlocal before
        for order, prefix in ordered:
            for k in range(0, len(order), BLOCK):
                b, eq = order[k:k + BLOCK], prefix[k:k + BLOCK].astype(np.int64)
                a = np.r_[b[:1] if before is None else before, b[:-1]]
                eq = np.where(name[b] == 0, 0, eq)
                lcp = (lms[a + eq] - lms[a] + _symbol_lcp(codes, lms[a + eq], lms[b + eq])).astype(np.int32)
                if before is None:
                    lcp[0] = 0
                before = b[-1:]
                yield np.rec.fromarrays([lms[b], lcp], dtype=_ENTRY)

    out = space.appended(converted(), _ENTRY)
    return out["pos"], out["lcp"]


def _recurse(name: np.ndarray, space: Space):
    """Order of the LMS suffixes by sorting the suffixes of their names, in blocks.

    Sequences without a name are left out: their terminators come first anyway.
    """
    ends = (np.flatnonzero(np.asarray(name[k:k + BLOCK]) == 0) + k for k in range(0, len(name), BLOCK))
    for e in ends:
        yield e, np.zeros(len(e), np.int32)

    def kept_blocks():
        for k in range(0, len(name), BLOCK):
            block = np.asarray(name[max(0, k - 1):k + BLOCK])
            if k == 0:
                block = np.r_[0, block]
            yield np.flatnonzero((block[1:] != 0) | (block[:-1] != 0)) + k

    kept = space.appended(kept_blocks(), np.int64)
    if not len(kept):
        return
    reduced = space.appended((np.asarray(name[kept[k:k + BLOCK]]) for k in range(0, len(kept), BLOCK)), np.int64)
    for p, x in sort_suffixes(reduced, space):
        real = np.asarray(reduced[p]) != 0
        if real.any():
            yield np.asarray(kept[p[real]]), x[real]


def _seed_ranges(codes, pos: np.ndarray, n_symbols: int, space: Space) -> tuple[np.ndarray, np.ndarray]:
    """By symbol, the range of the sorted LMS suffixes that begin with it (0, 0 for none)."""
    low, high = space.array(n_symbols, np.int64), space.array(n_symbols, np.int64)
    for k in range(0, len(pos), BLOCK):
        first = np.asarray(codes[pos[k:k + BLOCK]]).astype(np.int64)
        cut = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
        c = first[cut]
        low[c] = np.where(high[c] > 0, low[c], k + cut)
        high[c] = k + np.r_[cut[1:], len(first)]
    return low, high


def sort_suffixes(codes: np.ndarray, space: Space):
    """Yield (positions, common prefix with the one before) of all suffixes in order.

    ``codes`` holds non-empty sequences of symbols >= 1, each followed by a 0; a 0 is
    smaller than every symbol, and of two the earlier one is smaller.
    """
    n = len(codes)
    kind = _types(codes, space)

    def lms_blocks():
        for lo in range(0, n, BLOCK):
            k = kind[max(0, lo - 1):min(n, lo + BLOCK)]
            if lo == 0:
                k = np.r_[np.uint8(1), k]  # position 0 has nothing before it
            yield np.flatnonzero((k[1:] == 1) & (k[:-1] == 0)) + lo

    pos, lcp = _sort_lms(codes, space.appended(lms_blocks(), np.int64), space)
    n_symbols = max((int(np.max(codes[k:k + BLOCK])) for k in range(0, n, BLOCK)), default=0) + 1
    low, high = _seed_ranges(codes, pos, n_symbols, space)

    def scan_bucket(c: int, scan: _Scan, wanted) -> int:
        """Feed the entries of bucket ``c``, with those it induces in itself (runs of c: the
        round number is the number of leading c).  Returns the number of rounds."""
        out, rounds = scan.out, 0
        lo, hi = int(out.start[c]), int(out.end[c])
        while lo < hi:
            rounds += 1
            if rounds > 1:
                out.lcp[lo] = rounds - 1
            for p, x in out.blocks(lo, hi):
                scan.feed(p, x, *wanted(p))
            lo, hi = hi, int(out.end[c])
        return rounds

    # Upward scan: L-type suffixes; they are kept for the downward scan.
    store, left = Buckets(space, codes, kind, 0, n_symbols), space.array(n_symbols, np.int32)
    scan = _Scan(space, store, n_symbols)

    def to_l(p):
        return np.asarray(codes[p - 1]), (p > 0) & (kind[p - 1] == 0)

    for c in range(n_symbols):
        scan.begin()
        left[c] = rounds = scan_bucket(c, scan, to_l)
        a, b = int(low[c]), int(high[c])
        for k in range(a, b, BLOCK):
            p, x = np.asarray(pos[k:min(b, k + BLOCK)]), np.array(lcp[k:min(b, k + BLOCK)])
            if k == a:
                x[0] = min(rounds, _run_length(codes, int(p[0]))) if rounds else 0
            scan.feed(p, x, *to_l(p))

    # Downward scan: S-type suffixes.
    done, edge = Buckets(space, codes, kind, 1, n_symbols), space.array(n_symbols, np.int32)
    scan = _Scan(space, done, n_symbols)

    def to_s(p):
        prev = np.asarray(codes[p - 1])
        return prev, (p > 0) & (prev != 0) & (kind[p - 1] == 1)

    for c in range(n_symbols - 1, 0, -1):
        scan.begin()
        edge[c] = min(scan_bucket(c, scan, to_s), int(left[c]))  # between the largest L-type and the smallest S-type suffix
        for p, x in store.turned(c, int(edge[c])):
            scan.feed(p, x, *to_s(p))

    # Ascending result: of each bucket the L-type entries, then the S-type ones turned around.
    for k in range(int(low[0]), int(high[0]), BLOCK):
        p = np.asarray(pos[k:min(int(high[0]), k + BLOCK)])
        yield p, np.zeros(len(p), np.int32)
    for c in range(1, n_symbols):
        first = True
        for p, x in store.blocks(int(store.start[c]), int(store.end[c])):
            if first:
                x[0], first = 0, False
            yield p, x
        yield from done.turned(c, int(edge[c]))


def repeated_windows(codes: np.ndarray, length: int, limit: int = MEMORY) -> np.ndarray:
    """1 at every position whose next ``length`` symbols also start somewhere else."""
    space = Space(limit)
    try:
        flag = space.array(len(codes), np.uint8)
        before = np.empty(0, np.int64)  # last position of the part before
        for p, x in sort_suffixes(codes, space):
            hit = np.flatnonzero(x >= length)
            if len(hit):
                flag[p[hit]] = 1
                inner = hit[hit > 0]
                flag[p[inner - 1]] = 1
                if hit[0] == 0:
                    flag[before] = 1
            before = p[-1:]
        return flag  # a mapped file stays readable after its name is gone
    finally:
        space.close()
