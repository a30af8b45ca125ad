"""Anchors of byte texts, and maximal repeats from an enhanced suffix array, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Symbols that one comparison takes.
STRIDE = 7
# Random odd multipliers and a random value per byte for two rolling hashes.
BASES = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)


@lru_cache(maxsize=4)
def _power_table(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(count, base, dtype=np.uint64)
    down = np.full(count, pow(base, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def prefix_sums(data: np.ndarray, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums for :func:`range_hashes` and the powers they need."""

    up, down = _power_table(int(base), 1 << max(17, (len(data) + 1).bit_length()))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[data] * down[: len(data)], out=sums[1:])
    return sums, up


def range_hashes(sums: np.ndarray, up: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each range of bytes; equal ranges have equal hashes wherever they lie."""

    h = (sums[end] - sums[begin]) * up[begin]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(28))


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbouring values."""

    reach, out = 1, values
    while 2 * reach <= width:
        out = pick(out[:-reach], out[reach:])
        reach *= 2
    return pick(out[: len(out) - (width - reach)], out[width - reach :]) if width > reach else out


def anchors(data: np.ndarray, least: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of anchors of one text.

    In every stretch of ``least`` bytes, the ``gram``-byte strings with the smallest hash
    are anchors. Equal stretches have the same anchors at the same offsets.
    """

    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(data) < least:
        return none
    sums, up = prefix_sums(data, BASES[0])
    at = np.arange(len(data) - gram + 1)
    h = (sums[gram:] - sums[:-gram]) * up[: len(at)]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    h ^= h >> np.uint64(28)
    width = least - gram + 1
    lowest = _sliding(h, width, np.minimum)  # of the stretch that starts here
    # A string is lowest in one of the stretches around it if the largest of their minima is its own hash.
    padded = np.concatenate([np.zeros(width - 1, np.uint64), lowest, np.zeros(width - 1, np.uint64)])
    chosen = np.flatnonzero(_sliding(padded, width, np.maximum) == h)
    return chosen, h[chosen]


def packed_symbols(symbols: np.ndarray) -> np.ndarray:
    """The seven symbols from each place on, as one integer that sorts as they do; symbols are below 512."""

    padded = np.concatenate([symbols, np.zeros(STRIDE - 1, np.int64)])
    out = np.zeros(len(symbols), dtype=np.int64)
    for j in range(STRIDE):
        out = (out << 9) | padded[j : j + len(symbols)]
    return out


def sort_suffixes(packed: np.ndarray, start: np.ndarray, group: np.ndarray, offset: int, reach: int) -> np.ndarray:
    """Order of the suffixes at ``start``: by group, then by their symbols from ``offset`` to ``reach``.

    Seven symbols a round; a round sorts only what is still equal.
    """

    number, count = np.unique(group, return_inverse=True, return_counts=True)[1:]
    rank = (np.cumsum(count) - count)[number]  # how many sort before, as far as known
    while offset < reach:
        tied = np.flatnonzero(np.bincount(rank, minlength=len(rank))[rank] > 1)
        if not len(tied):
            break
        key = packed[np.minimum(start[tied] + offset, len(packed) - 1)]
        order = np.lexsort((key, rank[tied]))
        r, k = rank[tied][order], key[order]
        # Within its old rank a suffix moves up by those that sort before it.
        head = np.append(True, r[1:] != r[:-1])
        fresh = head | np.append(True, k[1:] != k[:-1])
        at = np.arange(len(r))
        rank[tied[order]] = r + np.maximum.accumulate(np.where(fresh, at, 0)) - np.maximum.accumulate(np.where(head, at, 0))
        offset += STRIDE
    return np.argsort(rank, kind="stable")


def common_prefixes(packed: np.ndarray, symbols: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b``, at most ``most``."""

    length = np.zeros(len(a), dtype=np.int64)
    for width, values in ((STRIDE, packed), (1, symbols)):
        going = np.arange(len(a))
        while len(going):
            i, j = a[going] + length[going], b[going] + length[going]
            same = (i < len(values)) & (j < len(values)) & (length[going] < most[going])
            same &= values[np.minimum(i, len(values) - 1)] == values[np.minimum(j, len(values) - 1)]
            going = going[same]
            length[going] += width
    return np.minimum(length, most)


def prefix_intervals(prefixes: list[int], left: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """Left-diverse intervals (length, first, last) of the common-prefix interval tree.

    ``prefixes[i]`` is the common prefix of suffixes i and i + 1 in sorted order and
    ``left[i]`` the symbol before suffix i (-1 for none, which differs from every other).
    One scan with a stack; each open interval keeps the one symbol seen before its
    suffixes, or that there were several.
    """

    several, unset = -1, -2

    def both(x: int, y: int) -> int:
        if x == unset:
            return y
        return x if y == unset or x == y else several

    stack: list[list[int]] = []  # length, first, symbol before
    for i, length in enumerate([*prefixes, 0]):
        first, before = i, left[i]
        while stack and stack[-1][0] > length:
            open_length, first, seen = stack.pop()
            before = both(seen, before)
            if open_length >= least and before == several:
                yield open_length, first, i
        if length < least:
            stack.clear()
        elif stack and stack[-1][0] == length:
            stack[-1][2] = both(stack[-1][2], before)
        else:
            stack.append([length, first, before])


def maximal_repeats(texts: list[bytes], least: int, identity: list[tuple[int, int]] | None = None):
    """Maximal repeats of at least ``least`` bytes: (length, [(text, position), ...]) with all occurrences.

    ``identity`` gives the (row, start) of each text in the corpus, for texts that are
    extracts and may overlap; a place of the corpus counts once, in one extract, and a
    repeat may then also be reported without its first bytes. Empty texts are fine.
    """

    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    plain = np.frombuffer(b"\0".join([*texts, b""]), dtype=np.uint8)  # a text ends in a zero, which no window covers
    bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
    # Suffixes whose first ``least`` bytes occur once are in no repeat.
    windows = np.maximum(sizes - least + 1, 0)
    if windows.sum() < 2:
        return
    start = np.arange(windows.sum()) + np.repeat(bounds[:-1] - (np.cumsum(windows) - windows), windows)
    sums, up = prefix_sums(plain, BASES[0])
    hashes = range_hashes(sums, up, start, start + least)
    ordered = np.sort(hashes)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(again):
        return
    likely = np.zeros(1 << 16, dtype=bool)
    likely[again >> np.uint64(48)] = True
    start, hashes = (v[likely[hashes >> np.uint64(48)]] for v in (start, hashes))
    at = np.minimum(np.searchsorted(again, hashes), len(again) - 1)
    repeated = again[at] == hashes
    start, group = start[repeated], at[repeated]
    symbols = plain.astype(np.int64) + 1
    symbols[bounds[1:] - 1] = 0
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    place = np.arange(len(symbols)) - bounds[owner]
    room = sizes[owner] - place
    if identity is not None:
        rows = np.unique([r for r, _ in identity], return_inverse=True)[1][owner[start]]
        absolute = np.array([s for _, s in identity])[owner[start]] + place[start]
        spot = rows * (int(absolute.max()) + 1) + absolute
        order = np.argsort(spot, kind="stable")
        kept = np.sort(order[np.append(True, spot[order][1:] != spot[order][:-1])])
        start, group = start[kept], group[kept]
    # A suffix whose predecessor is not in the array under the same extract counts as having none.
    held = np.zeros(len(symbols) + 1, dtype=bool)
    held[start + 1] = True
    before = np.where((place[start] > 0) & held[start], symbols[np.maximum(start, 1) - 1], -1)
    # Suffixes that share ``least`` bytes, and all follow one symbol, have no left-diverse interval among them.
    some = np.zeros(len(again), dtype=np.int64)
    some[group] = before
    differ = np.bincount(group, weights=(before != some[group]) | (before < 0), minlength=len(again)) > 0
    chosen = differ[group] & (np.bincount(group, minlength=len(again)) > 1)[group]
    start, group = start[chosen], group[chosen]
    if len(start) < 2:
        return
    packed = packed_symbols(symbols)
    suffixes = start[sort_suffixes(packed, start, group, least, int(room[start].max()))]
    a, b = suffixes[:-1], suffixes[1:]
    common = common_prefixes(packed, symbols, a, b, np.minimum(room[a], room[b]))
    together = np.sort(group)
    if ((common < least) & (together[1:] == together[:-1])).any():  # two contents with one hash: sort in full
        suffixes = start[sort_suffixes(packed, start, np.zeros(len(start), np.int64), 0, int(room[start].max()))]
        a, b = suffixes[:-1], suffixes[1:]
        common = common_prefixes(packed, symbols, a, b, np.minimum(room[a], room[b]))
    before = np.where((place[suffixes] > 0) & held[suffixes], symbols[np.maximum(suffixes, 1) - 1], -1)
    # Only stretches of suffixes that share enough are scanned.
    long = np.concatenate([[False], common >= least, [False]])
    opens, closes = np.flatnonzero(~long[:-1] & long[1:]), np.flatnonzero(long[:-1] & ~long[1:])
    for low, high in zip(opens.tolist(), closes.tolist()):
        for length, first, last in prefix_intervals(common[low:high].tolist(), before[low : high + 1].tolist(), least):
            members = suffixes[low + first : low + last + 1]
            yield length, list(zip(owner[members].tolist(), place[members].tolist()))
