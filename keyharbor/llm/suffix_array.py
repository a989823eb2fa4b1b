"""Suffix arrays of byte strings by induced sorting, in vector steps.

Suffixes are S (smaller than the next one) or L. The leftmost S of each run (LMS) cut the text into substrings; those are sorted
by inducing, named, and the string of names is sorted in turn, by the same function; from the sorted LMS suffixes all others are induced,
bucket by bucket, in linear time. Neighbouring buckets whose suffixes induce none among themselves are worked at once, and so are the suffixes that
a bucket induces in itself: so Python's steps grow with the alphabet of bytes, and about with the root of a large alphabet of names.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Buckets beyond which several are worked at once.
MANY = 1000


def _types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is S. The last one (the sentinel) is S."""
    n = len(t)
    differs = np.flatnonzero(t[:-1] != t[1:])
    # Each place takes the comparison at the end of its run of equal characters.
    at = differs[np.minimum(np.searchsorted(differs, np.arange(n - 1)), len(differs) - 1)]
    return np.append(t[at] < t[at + 1], True)


def _placed(where: np.ndarray, chars: np.ndarray, edge: np.ndarray, sa: np.ndarray, step: int) -> None:
    """Puts places, in order, at the edges of the buckets of their characters, and moves the edges."""
    order = np.argsort(chars, kind="stable")
    c = chars[order]
    first = np.flatnonzero(np.append(True, c[1:] != c[:-1])[: len(c)])
    counts = np.diff(np.append(first, len(c)))
    rank = np.arange(len(c)) - np.repeat(first, counts)
    sa[edge[c] + step * rank - (step < 0)] = where[order]
    edge[c[first]] += step * counts


def _induced(t: np.ndarray, is_s: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The suffix array that the order of the LMS suffixes induces."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    sa = np.full(len(t), -1, np.int32)
    tails = ends.copy()
    _placed(lms[::-1], t[lms[::-1]], tails, sa, -1)
    first_lms = tails.copy()
    heads = starts.copy()
    used = np.flatnonzero(sizes)

    def push(batch: np.ndarray, s_type: bool, edge: np.ndarray, step: int) -> None:
        j = batch[batch > 0] - 1
        j = j[is_s[j] == s_type]
        if len(j):
            _placed(j, t[j], edge, sa, step)

    def ahead(part: np.ndarray, s_type: bool, bounds: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, int]:
        """Of some buckets in the order of the pass: what their suffixes induce, up to the first bucket that one of them induces into; how many buckets that are."""
        a, z = np.stack((bounds[0][part], bounds[2][part]), axis=1).ravel(), np.stack((bounds[1][part], bounds[3][part]), axis=1).ravel()
        n = z - a
        at = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
        of = np.repeat(np.arange(len(n)) // 2, n)
        if s_type:  # from the right: buckets, and suffixes within them, come in reverse
            at, of = at[::-1], len(part) - 1 - of[::-1]
        j = sa[at] - 1
        good = (j >= 0) & (is_s[np.maximum(j, 0)] == s_type)
        j, of = j[good], of[good]
        order = part[::-1] if s_type else part
        into = t[j]
        inside = into[(into >= order[-1]) if s_type else (into <= order[-1])]
        if not len(inside):
            return j, len(part)
        first = int(np.searchsorted(part, inside.max() if s_type else inside.min()))
        first = len(part) - 1 - first if s_type else first
        return j[of < first], first

    def swept(s_type: bool, edge: np.ndarray, bounds: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], one: Callable[[int], None]) -> None:
        """A pass over all buckets: several at once where they are many and so small."""
        step, k, least = -1 if s_type else 1, 0, 16 if len(used) >= MANY else 1
        order, width = used[::-1] if s_type else used, least
        while k < len(order):
            part = order[k : k + width]
            j, n = ahead(part[::-1] if s_type else part, s_type, bounds) if width > 1 else (sa[:0], 0)
            if n:
                if len(j):
                    _placed(j, t[j], edge, sa, step)
                k, width = k + n, width * 2 if n == len(part) else max(least, n)
            else:
                one(int(order[k]))
                k += 1

    # How many equal characters stand before a place.
    at = np.arange(len(t), dtype=np.int32)
    before = at - np.maximum.accumulate(np.where(np.append(True, t[1:] != t[:-1]), at, 0))

    def with_runs(batch: np.ndarray) -> np.ndarray:
        """The suffixes of a bucket that come from others, and those that they induce in their own bucket: places before them in the run of its character, one round after another."""
        n = before[batch]
        back = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + 1
        return np.concatenate((batch, (np.repeat(batch, n) - back)[np.argsort(back, kind="stable")].astype(batch.dtype)))

    def one_l(c: int) -> None:
        whole = with_runs(sa[starts[c] : heads[c]])
        heads[c] = starts[c] + len(whole)
        sa[starts[c] : heads[c]] = whole
        push(np.concatenate((whole[before[whole] == 0], sa[first_lms[c] : ends[c]])), False, heads, 1)

    swept(False, heads, (starts, heads, first_lms, ends), one_l)
    tails = ends.copy()

    def one_s(c: int) -> None:
        whole = with_runs(sa[tails[c] : ends[c]][::-1])
        tails[c] = ends[c] - len(whole)
        sa[tails[c] : ends[c]] = whole[::-1]
        push(np.concatenate((whole[before[whole] == 0], sa[starts[c] : heads[c]][::-1])), True, tails, -1)

    swept(True, tails, (starts, heads, tails, ends), one_s)
    # The sentinel, which nothing precedes, heads the array.
    sa[0] = len(t) - 1
    return sa


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Places of t's suffixes in order. t: small nonnegative integers; the last is 0 and no other is."""
    n = len(t)
    if n <= 2:
        return np.arange(n, dtype=np.int32)[::-1].copy()
    is_s = _types(t)
    sizes = np.bincount(t)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]).astype(np.int32) + 1
    if len(lms) > 1:
        found = _induced(t, is_s, lms, sizes)
        marked = np.zeros(n, bool)
        marked[lms] = True
        by_substring = found[marked[found]]
        # Neighbours are alike if their substrings (to the next LMS place, inclusive) are.
        length = np.zeros(n, np.int32)
        length[lms] = np.append(np.diff(lms), 0) + 1
        a, b = by_substring[:-1], by_substring[1:]
        same = length[a] == length[b]
        at = np.flatnonzero(same)
        k, width = 0, 4
        while len(at):
            # Some characters at a time; beyond its end, a substring's last one again.
            on = np.minimum(k + np.arange(width), length[a[at], None] - 1)
            good = (t[a[at, None] + on] == t[b[at, None] + on]).all(axis=1)
            same[at[~good]] = False
            k, width = k + width, min(2 * width, 1024)
            at = at[good & (length[a[at]] > k)]
        names = np.empty(n, np.int32)
        names[by_substring] = np.append(0, np.cumsum(~same))
        in_text = names[lms]
        # The sentinel's name is 0, and it is the last: the string of names is sorted like a text.
        lms = lms[suffix_array(in_text)] if same.any() else lms[np.argsort(in_text, kind="stable")]
    return _induced(t, is_s, lms, sizes)


def words64(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number (zeros follow the end)."""
    n = len(data)
    padded = np.concatenate((data, np.zeros(16, np.uint8)))
    out = np.empty(n + 8, np.uint64)
    for o in range(8):
        part = out[o::8]
        part[:] = np.frombuffer(padded, "<u8", count=len(part), offset=o)
    return out[:n]


def permuted_prefixes(data: np.ndarray, sa: np.ndarray, room: np.ndarray, least: int) -> np.ndarray:
    """By place: how many bytes the suffix shares with the one before it in the array, up to `least` (longer ones count as that). room: bytes that a place's text goes on for."""
    before = np.full(len(sa), -1, np.int64)
    before[sa[1:]] = sa[:-1]
    out = np.zeros(len(sa), np.int32)
    at = np.flatnonzero((room > 0) & (before >= 0))
    w = words64(data)
    # Eight bytes at a time; where they differ, the lowest byte that does ends the prefix.
    for o in range(0, least, 8):
        x = w[np.minimum(at + o, len(w) - 1)] ^ w[np.minimum(before[at] + o, len(w) - 1)]
        low = np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) // 8  # bytes below the lowest that differs; 8 if none does
        out[at] = o + low
        at = at[x == 0]
    return np.minimum(out, np.minimum(least, np.minimum(room, room[np.maximum(before, 0)])))
