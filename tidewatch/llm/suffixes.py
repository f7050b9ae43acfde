"""Suffix arrays by induced sorting and permuted common prefixes, in numpy.

Suffixes are classified, the leftmost-smaller substrings are brought into order
by one round of inducing and named by their characters, the string of names is
sorted by the same method, and its order induces all other suffixes.

Inducing reads the array from one end to the other.  A window of it is taken at
once as long as nothing that it places falls into the window itself, which is
what reading it one by one would do; where windows stay short (long runs), it is
read one by one.
"""

from __future__ import annotations

import numpy as np

#: Entries in a window at first and at most; entries read one by one after so many windows of so few.
WINDOW, MOST_WINDOW = 1024, 1 << 15
FEW, PATIENCE, SINGLES = 64, 8, 4096


def _types(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the last suffix is."""
    out = np.ones(s.size, bool)
    if s.size > 1:
        differs = np.flatnonzero(s[1:] != s[:-1])
        smaller = s[differs] < s[differs + 1]
        # the type of a run is decided where the run ends
        run = np.diff(np.append(-1, differs))
        out[: differs[-1] + 1] = np.repeat(smaller, run)
    return out


def _pass(s: np.ndarray, small: np.ndarray, sa: np.ndarray, edge: np.ndarray, upward: bool) -> None:
    """Induces the larger suffixes reading upwards, or the smaller ones reading downwards; ``edge`` is the open end of each bucket."""
    n, width, poor = sa.size, WINDOW, 0
    i = 0 if upward else n
    lists: tuple[list, list] | None = None
    entry, free = memoryview(sa), memoryview(edge)
    while i < n if upward else i > 0:
        if poor >= PATIENCE:
            poor = 0
            lists = lists or (s.tolist(), small.tolist())
            chars, types = lists
            if upward:
                for at in range(i, min(n, i + SINGLES)):
                    p = entry[at] - 1
                    if p >= 0 and not types[p]:
                        c = chars[p]
                        entry[free[c]] = p
                        free[c] += 1
                i = min(n, i + SINGLES)
            else:
                for at in range(i - 1, max(0, i - SINGLES) - 1, -1):
                    p = entry[at] - 1
                    if p >= 0 and types[p]:
                        c = chars[p]
                        free[c] = q = free[c] - 1
                        entry[q] = p
                i = max(0, i - SINGLES)
            continue
        if upward:
            window, at = sa[i : i + width], np.arange(i, min(n, i + width))
        else:
            low = max(0, i - width)
            window, at = sa[low:i][::-1], np.arange(i - 1, low - 1, -1)
        before = window - 1
        some = np.flatnonzero(before >= 0)
        some = some[small[before[some]] != upward]
        size = window.size
        if some.size:
            found, at = before[some], at[some]
            char = s[found]
            # nothing may fall on what the window has read: the nearest target of all entries up to each one
            if upward:
                nearest = np.minimum.accumulate(edge[char])
                k = int((nearest > at).sum())
                reach = min(i + size, int(nearest[k - 1]), int(at[k]) if k < at.size else n)
            else:
                nearest = np.maximum.accumulate(edge[char] - 1)
                k = int((nearest < at).sum())
                reach = max(i - size, int(nearest[k - 1]) + 1, int(at[k]) + 1 if k < at.size else 0)
            found, char = found[:k], char[:k]
            order = np.argsort(char.astype(np.uint16) if edge.size <= 1 << 16 else char, kind="stable")
            char, found = char[order], found[order]
            head = np.flatnonzero(np.append(True, char[1:] != char[:-1]))
            number = np.diff(np.append(head, char.size))
            rank = np.arange(char.size) - np.repeat(head, number)
            if upward:
                sa[edge[char] + rank] = found
                edge[char[head]] += number.astype(edge.dtype)
            else:
                sa[edge[char] - 1 - rank] = found
                edge[char[head]] -= number.astype(edge.dtype)
            done = abs(reach - i)
            poor = poor + 1 if done < FEW else 0
            width = min(MOST_WINDOW, max(256, 2 * done))
            i = reach
        else:
            i += size if upward else -size


def _induce(s: np.ndarray, small: np.ndarray, seeds: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The order induced from ``seeds`` (leftmost-smaller suffixes in the order wanted within each bucket)."""
    sa = np.full(s.size, -1, np.int32)
    char = s[seeds]
    # seeds stand at the end of their buckets
    counts = np.bincount(char, minlength=starts.size)
    order = np.argsort(char, kind="stable")
    char = char[order]
    place = ends[char] - counts[char] + np.arange(seeds.size) - (np.cumsum(counts) - counts)[char]
    sa[place] = seeds[order]
    _pass(s, small, sa, starts.copy(), True)
    # the seeds leave, and the smaller ones are induced from the larger
    sa[place] = -1
    tail = ends.copy()
    sa[0] = s.size - 1
    tail[0] = 0
    _pass(s, small, sa, tail, False)
    return sa


def _same_as_before(s: np.ndarray, ordered: np.ndarray, length: np.ndarray) -> np.ndarray:
    """For each substring in order, whether it equals the one before, character by character."""
    same = np.append(False, length[1:] == length[:-1])
    live = np.flatnonzero(same)
    at = 0
    while live.size > 64:
        a, b = ordered[live], ordered[live - 1]
        equal = s[a + at] == s[b + at]
        same[live[~equal]] = False
        live = live[equal]
        at += 1
        live = live[length[live] > at]
    for k in live.tolist():
        a, b, n = int(ordered[k]), int(ordered[k - 1]), int(length[k])
        same[k] = np.array_equal(s[a + at : a + n], s[b + at : b + n])
    return same


def _sort(s: np.ndarray, alphabet: int) -> np.ndarray:
    """The suffix array of a string whose last character is its only 0."""
    counts = np.bincount(s, minlength=alphabet)
    ends = np.cumsum(counts)
    starts = ends - counts
    small = _types(s)
    leftmost = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    if leftmost.size > 1:
        # leftmost-smaller substrings in order, up to and with the first character of the next
        rough = _induce(s, small, leftmost, starts, ends)
        length = np.zeros(s.size, np.int32)
        length[leftmost[:-1]] = np.diff(leftmost) + 1
        length[leftmost[-1]] = 1
        ordered = rough[length[rough] > 0]
        new = ~_same_as_before(s, ordered, length[ordered])
        names = int(new.sum())
        if names < ordered.size:
            name = np.zeros(s.size, np.int32)
            name[ordered] = np.cumsum(new) - 1
            ordered = leftmost[_sort(name[leftmost], names)]
        leftmost = ordered
    return _induce(s, small, leftmost, starts, ends)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of all suffixes of a byte array in order (a suffix precedes its extensions)."""
    text = np.asarray(text, np.uint8)
    if text.size < 2:
        return np.arange(text.size, dtype=np.int32)
    return _sort(np.append(text.astype(np.int32) + 1, np.int32(0)), 257)[1:]


def permuted_prefixes(text: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """For each position, the length it has in common with the suffix before it in order, at most ``limit``.

    The predecessor of each position is permuted back to text order, where a
    position has at least what one ``d`` before it has, less ``d``.  Every 64th
    position is compared first, then those half way between, each from what is
    known of the one before, so the work grows with the text and not with the
    lengths.
    """
    n = sa.size
    out = np.zeros(n, np.int32)
    if n < 2:
        return out
    padded = np.concatenate([np.asarray(text, np.uint8), np.zeros(limit + 16, np.uint8)])
    words = np.ndarray((padded.size - 7,), "<u8", padded, strides=(1,))
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    step = 64
    first = np.arange(0, n, step)
    while True:
        known = np.maximum(0, out[first - step] - step) if step < 64 else np.zeros(first.size, np.int32)
        if step < 64:
            known[first < step] = 0
        has = before[first] >= 0
        live, at = first[has], known[has]
        other = before[live]
        while live.size:
            x = words[live + at] ^ words[other + at]
            equal = x == 0
            low = x[~equal]
            out[live[~equal]] = at[~equal] + (np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)) >> 3)
            live, other, at = live[equal], other[equal], at[equal] + 8
            full = at >= limit
            out[live[full]] = limit
            live, other, at = live[~full], other[~full], at[~full]
        # nothing is common beyond the end
        room = n - np.maximum(first, before[first])
        out[first] = np.where(has, np.minimum(np.minimum(out[first], limit), room), 0)
        step //= 2
        if not step:
            return out
        first = np.arange(step, n, 2 * step)
