"""Content-chosen anchors: which windows of a corpus can repeat at all, without listing them all.

A *window* is ``width`` consecutive items (bytes, or hashed words) of one document. Inside a
window the ``gram``-item substring with the smallest mixed hash (leftmost on ties) is its
*anchor*. The choice depends on the window's content alone, so equal windows have equal anchors
at equal offsets, and every window belongs to exactly one anchor occurrence. Consecutive windows
mostly share their anchor: an occurrence owns a run of windows ``[lo, hi]``, and the items
``[lo, hi + width)`` are its *context*. About ``2 / (width - gram + 2)`` of the positions are
anchors, which is what makes an exact search for repeats shuffle a hundredth of the positions.
"""

from __future__ import annotations

import numpy as np

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
#: Items handled at once; positions take the low bits of the winnowing key.
POSITION_BITS = 24
MAX_ITEMS = 1 << POSITION_BITS

_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, at least ``n`` of each."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
        with np.errstate(over="ignore"):
            for name, base in (("up", MULTIPLIER), ("down", inverse)):
                table = np.full(size, base, dtype=np.uint64)
                table[0] = 1
                _powers[name] = np.multiply.accumulate(table)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads polynomial hashes over all 64 bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(32))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] = the polynomial of values[i:j] times the multiplier's i-th power."""
    up, _ = _power_tables(len(values))
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up, out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of items [start, end) for each pair, equal for equal content at any place."""
    _, down = _power_tables(len(sums))
    with np.errstate(over="ignore"):
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hashes(values: np.ndarray, gram: int) -> np.ndarray:
    sums = prefix_sums(values)
    _, down = _power_tables(len(sums))
    with np.errstate(over="ignore"):
        return mix((sums[gram:] - sums[:-gram]) * down[: len(values) - gram + 1])


def sliding_min(keys: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every ``span`` consecutive keys, by doubling."""
    level, have = keys, 1
    while have * 2 <= span:
        level = np.minimum(level[:-have], level[have:])
        have *= 2
    rest = span - have
    return np.minimum(level[: len(level) - rest], level[rest:]) if rest else level


def winnow(values: np.ndarray, lengths: np.ndarray, width: int, gram: int):
    """Anchor occurrences of concatenated sequences (at most ``MAX_ITEMS`` items in all).

    Returns arrays (anchor hash, index of the sequence, first window, last window); the window
    positions count from the start of their sequence. A sequence shorter than ``width`` has none.
    """
    n = len(values)
    if n < width:
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 3
    hashes = gram_hashes(values, gram)
    low = np.uint64(MAX_ITEMS - 1)
    keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    at = (sliding_min(keys, width - gram + 1) & low).astype(np.int64)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    usable = np.zeros(n + 1, dtype=np.int8)
    long_enough = lengths >= width
    np.add.at(usable, begins[long_enough], 1)
    np.add.at(usable, ends[long_enough] - width + 1, -1)
    starts = np.flatnonzero(np.cumsum(usable[:n], dtype=np.int8)[: len(at)])
    if not len(starts):
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 3
    anchor = at[starts]
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    last = np.concatenate((first[1:] - 1, [len(starts) - 1]))
    lo, hi = starts[first], starts[last]
    owner = np.searchsorted(ends, lo, side="right")
    return hashes[anchor[first]], owner, lo - begins[owner], hi - begins[owner]
