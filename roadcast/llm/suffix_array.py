"""Suffix arrays by induced sorting (SA-IS), and permuted common prefixes, in numpy.

Suffixes are classified into L and S types, the leftmost S suffixes (LMS) are sorted by
their substrings, recursively, and all others are induced from them in one pass up and
one pass down the buckets. A pass takes a bucket at a time: everything that its entries
induce is placed at once, in order. That pays as long as there are few buckets, so a
recursion whose alphabet (the names of the LMS substrings) has outgrown ``FEW`` is
ordered by rank doubling instead.
"""

from __future__ import annotations

import numpy as np

from roadcast.llm.fm_index import suffix_order

FEW = 2048
WORDS = 7  # of 8 bytes: common prefixes are measured up to 56


def suffix_types(s: np.ndarray) -> np.ndarray:
    """True for S suffixes: less than the suffix one on. The last, a unique least symbol, is S."""
    n = len(s)
    step = np.sign(np.diff(s.astype(np.int64)))
    # equal neighbours have the type of the next place that differs
    place = np.where(step != 0, np.arange(n - 1), n - 1)
    nearest = np.minimum.accumulate(place[::-1])[::-1]
    return np.append(step[np.minimum(nearest, max(n - 2, 0))] > 0, True) if n > 1 else np.ones(n, bool)


def _append(sa: np.ndarray, cursor: np.ndarray, chars: np.ndarray, suffixes: np.ndarray, step: int) -> None:
    """Put suffixes at their buckets' cursors, in order, and move the cursors."""
    order = np.argsort(chars, kind="stable")
    sorted_chars = chars[order]
    counts = np.bincount(sorted_chars, minlength=len(cursor))
    within = np.arange(len(order)) - (np.cumsum(counts) - counts)[sorted_chars]
    sa[cursor[sorted_chars] + step * within] = suffixes[order]
    cursor += step * counts


def _induce(s: np.ndarray, stype: np.ndarray, counts: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes in order, if ``lms`` gives the LMS suffixes in order."""
    sa = np.full(len(s), -1, np.int32)
    ends = np.cumsum(counts)
    heads = ends - counts
    s_counts = np.bincount(s[stype], minlength=len(counts))
    lms_counts = np.bincount(s[lms], minlength=len(counts))
    lms_at = np.cumsum(lms_counts) - lms_counts
    by_char = lms[np.argsort(s[lms], kind="stable")]
    present = np.flatnonzero(counts)

    cursor = heads.copy()
    for c in present:
        done = heads[c]
        while done < cursor[c]:
            stop = cursor[c]
            before = sa[done:stop] - 1
            done = stop
            before = before[before >= 0]
            before = before[~stype[before]]
            _append(sa, cursor, s[before], before, 1)
        if lms_counts[c]:
            before = by_char[lms_at[c] : lms_at[c] + lms_counts[c]] - 1
            before = before[before >= 0]
            _append(sa, cursor, s[before], before, 1)

    cursor = ends - 1
    for c in present[::-1]:
        done = ends[c] - 1
        while done > cursor[c]:
            stop = cursor[c]
            before = sa[stop + 1 : done + 1][::-1] - 1
            done = stop
            before = before[before >= 0]
            before = before[stype[before]]
            _append(sa, cursor, s[before], before, -1)
        if c == 0:
            sa[0] = len(s) - 1  # the sentinel alone
            before = sa[:1] - 1
        else:
            before = sa[heads[c] : ends[c] - s_counts[c]][::-1] - 1
        before = before[before >= 0]
        before = before[stype[before]]
        _append(sa, cursor, s[before], before, -1)
    return sa


def _names(s: np.ndarray, ordered: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Ranks of the LMS substrings of ``ordered`` suffixes; equal substrings share one."""
    a, b = ordered[:-1], ordered[1:]
    differ = length[a] != length[b]
    live = np.flatnonzero(~differ)
    offset = 0
    while len(live):
        unequal = s[a[live] + offset] != s[b[live] + offset]
        differ[live[unequal]] = True
        live = live[~unequal]
        offset += 1
        live = live[length[a[live]] > offset]
    return np.concatenate(([0], np.cumsum(differ)))


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``s``, whose last symbol must be its only 0."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int32)
    s = s.astype(np.uint16 if s.max() < 1 << 16 else np.int32)  # numpy sorts numbers of 16 bits by digits
    counts = np.bincount(s)
    stype = suffix_types(s)
    lms = np.flatnonzero(stype[1:] & ~stype[:-1]) + 1
    rough = _induce(s, stype, counts, lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = rough[is_lms[rough]]
    length = np.zeros(n, np.int32)  # of the substring up to and with the next LMS place
    length[lms] = np.append(np.diff(lms) + 1, 1)
    rank = np.empty(n, np.int64)
    rank[ordered] = _names(s, ordered, length)
    reduced = rank[lms]
    names = int(reduced.max()) + 1
    if names < len(lms):
        order = suffix_array(reduced) if names <= FEW else suffix_order(reduced)
        ordered = lms[order]
        return _induce(s, stype, counts, ordered)
    return rough if len(lms) == 0 else _induce(s, stype, counts, ordered)


def _words(text: np.ndarray) -> np.ndarray:
    """Eight bytes from every place as one number, first byte highest; past the end there are zeros."""
    padded = np.concatenate([text, np.zeros(8 * WORDS + 8, np.uint8)])
    return np.ndarray((len(padded) - 7,), ">u8", padded.data, strides=(1,)).astype(np.uint64)


def permuted_common_prefixes(text: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each place of ``text`` (bytes), the common prefix with the suffix before it in ``sa``, up to 56."""
    before = np.full(len(text), -1, np.int64)
    before[sa[1:]] = sa[:-1]
    words = _words(text)
    plcp = np.zeros(len(text), np.int32)
    live = np.flatnonzero(before >= 0)
    for step in range(WORDS):
        differing = words[live + 8 * step] ^ words[before[live] + 8 * step]
        same = differing == 0
        ended = live[~same]
        # bytes that agree in front of the highest differing bit
        top = np.frexp(differing[~same].astype(np.float64))[1]  # rounding up a power of two is mended below
        lead = (64 - np.minimum(top, 64)) // 8
        exact = differing[~same] >> (np.uint64(64) - np.uint64(8) * (lead + 1).clip(1, 8).astype(np.uint64))
        lead += exact == 0
        plcp[ended] = 8 * step + lead
        live = live[same]
    plcp[live] = 8 * WORDS
    return plcp
