"""Suffix-array dedup over bytes.

The contexts that can hold a repeated string (see ``repeats``) are dealt into shards. Each shard
gets a suffix array by Larsson-Sadakane refinement in numpy: suffixes are sorted by their first
seven bytes, then groups that are still unsorted, and only those, are refined by the rank of the
suffix ``h`` further on, ``h`` doubling. Kasai's pass gives the common prefixes of neighbours: the
length found at one text position, less one, holds at the next. The pass runs over many stretches
of the text at once, each stretch going from position to position as the serial pass does.
Neighbours that share ``width`` bytes are repeats of each other.

A shard ends after a number of bytes, also in the middle of an anchor's contexts. Such an anchor's
windows are kept as sorted runs, one of each shard, and merged when it ends: each run's windows
are found in the other runs by binary search.

Defined results: a null text counts as empty; a text shorter than ``width`` loses nothing; matches
never cross documents; repeated rows are repeats of each other; an empty table gives an empty
result. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import ROW, stable, with_row_id
from newsloom.llm.repeats import SHARD_BYTES, covered, repeated_spans

WIDTH, GRAM = 200, 32
#: Bytes packed into one sort key (9 bits each: 0 is the end of a context) and their bits.
PACK, BITS = 7, 9
LANE = 256


def packed_keys(symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The first seven symbols of every suffix as one integer; zeros follow the end of its context.

    ``left`` is the number of symbols before that end.
    """
    padded = np.concatenate((symbols, np.zeros(PACK, symbols.dtype))).astype(np.int64)
    key = np.zeros(len(symbols), dtype=np.int64)
    for j in range(PACK):
        key = (key << BITS) | padded[j:j + len(symbols)]
    short = np.flatnonzero(left < PACK)
    cut = BITS * (PACK - left[short])
    key[short] = np.where(left[short] > 0, key[short] >> cut << cut, 0)
    return key


def suffix_array(keys: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order. The ends of contexts differ from each other and are ordered
    by place, so suffixes that reach one within the first key are settled at once."""
    n = len(keys)
    order = np.argsort(keys)
    ending = np.flatnonzero(left[order] < PACK)
    tail = order[ending]
    order[ending] = tail[np.lexsort((tail, keys[tail]))]
    sorted_keys = keys[order]
    new = np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))
    new[ending] = True
    start = np.flatnonzero(new)
    size = np.diff(np.concatenate((start, [n])))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(start, size)
    open_at = np.flatnonzero(np.repeat(size > 1, size))  # places in the order that are not settled
    h = PACK
    while len(open_at):
        suffix = order[open_at]
        key = (rank[suffix] << 32) | rank[suffix + h]
        by = np.argsort(key)
        suffix, key = suffix[by], key[by]
        order[open_at] = suffix
        new = np.concatenate(([True], key[1:] != key[:-1]))
        start = np.flatnonzero(new)
        size = np.diff(np.concatenate((start, [len(key)])))
        rank[suffix] = np.repeat(open_at[start], size)
        open_at = open_at[np.repeat(size > 1, size)]
        h *= 2
    return order


def common_prefixes(keys: np.ndarray, left: np.ndarray, order: np.ndarray, cap: int, lane: int = LANE) -> np.ndarray:
    """Kasai: symbols that each suffix shares with the one before it in the order, or ``cap``."""
    n = len(order)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate((keys, np.zeros(PACK, np.int64)))
    found = np.zeros(n, dtype=np.int64)
    position = np.arange(0, n, lane)
    stop = np.minimum(position + lane, n)
    length = np.zeros(len(position), dtype=np.int64)
    while len(position):
        other = before[position]
        limit = np.where(other < 0, 0, np.minimum(np.minimum(left[position], left[other]), cap))
        gap = padded[position + length] ^ padded[np.maximum(other, 0) + length]
        same = np.zeros(len(gap), dtype=np.int64)
        for j in range(PACK):
            same += gap < (1 << (BITS * j))
        length = np.minimum(length + same, limit)
        settled = (same < PACK) | (length == limit)
        found[position[settled]] = length[settled]
        length[settled] = np.maximum(length[settled] - 1, 0)
        position = position + settled
        on = position < stop
        if not on.all():
            position, stop, length = position[on], stop[on], length[on]
    return found[order]


class Shard:
    """Suffix array of some contexts, and the classes of equal windows in it."""

    def __init__(self, contexts: list[bytes], weights: np.ndarray, windows: np.ndarray, width: int):
        self.width = width
        lengths = np.array([len(c) for c in contexts], dtype=np.int64)
        begins = np.cumsum(lengths + 1) - (lengths + 1)
        raw = np.frombuffer(b"\0".join(contexts) + b"\0", dtype=np.uint8)
        symbols = raw.astype(np.uint16) + np.uint16(1)
        symbols[begins + lengths] = 0  # the end of a context
        left = np.repeat(begins + lengths, lengths + 1) - np.arange(len(symbols))
        keys = packed_keys(symbols, left)
        order = suffix_array(keys, left)
        prefixes = common_prefixes(keys, left, order, width)
        owner = np.repeat(np.arange(len(windows)), windows)
        index = np.arange(len(owner))
        position = begins[owner] + index - (np.cumsum(windows) - windows)[owner]
        weight = np.zeros(len(symbols), dtype=np.int64)
        weight[position] = weights[owner]
        classes = np.cumsum(prefixes < width)
        total = np.bincount(classes, weights=weight[order])
        at = np.zeros(len(symbols), dtype=np.int64)
        at[order] = np.arange(len(order))
        self.raw, self.position, self.owner = raw, position, owner
        self.place = at[position]  # of each window in the suffix array
        self.marks = total[classes[self.place]] > 1
        self.weights = weights

    def sorted_run(self, first_context: int) -> tuple[np.ndarray, np.ndarray]:
        """The windows of the contexts from ``first_context`` on, in suffix order: (window, bytes)."""
        window = np.flatnonzero(self.owner >= first_context)
        window = window[np.argsort(self.place[window])]
        view = np.lib.stride_tricks.sliding_window_view(self.raw, self.width)
        return window, np.ascontiguousarray(view[self.position[window]]).view(f"S{self.width}").ravel()


def merge_runs(runs: list[np.ndarray]) -> list[np.ndarray]:
    """For sorted runs of windows, which of each run's windows occur in another run (binary search)."""
    marks = [np.zeros(len(r), dtype=bool) for r in runs]
    for i, run in enumerate(runs):
        for j, other in enumerate(runs):
            if i != j and len(run) and len(other):
                at = np.minimum(np.searchsorted(other, run), len(other) - 1)
                marks[i] |= other[at] == run
    return marks


def array_marks(contexts: list[bytes], weights: np.ndarray, windows: np.ndarray, anchor: np.ndarray,
                width: int = WIDTH, shard_bytes: int = SHARD_BYTES) -> np.ndarray:
    """Solver: cut the contexts into shards, solve each, and merge anchors that lie in several."""
    sizes = np.cumsum([len(c) + 1 for c in contexts])
    cuts = [0]
    while cuts[-1] < len(contexts):
        done = sizes[cuts[-1] - 1] if cuts[-1] else 0
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(sizes, done + shard_bytes, side="right"))))
    first_window = np.concatenate(([0], np.cumsum(windows)))
    marks = np.zeros(int(first_window[-1]), dtype=bool)
    open_runs: list[tuple[np.ndarray, np.ndarray]] = []  # windows and bytes of the anchor that goes on

    def close() -> None:
        for (window, _), hit in zip(open_runs, merge_runs([r for _, r in open_runs])):
            marks[window[hit]] = True
        open_runs.clear()

    for lo, hi in zip(cuts, cuts[1:]):
        shard = Shard(contexts[lo:hi], weights[lo:hi], windows[lo:hi], width)
        base = first_window[lo]
        marks[base:first_window[hi]] |= shard.marks
        goes_on = hi < len(contexts) and anchor[hi - 1] == anchor[hi]
        comes_in = lo > 0 and anchor[lo - 1] == anchor[lo]
        if comes_in:
            end = int(np.searchsorted(anchor[lo:hi], anchor[lo], side="right"))
            window, run = shard.sorted_run(0)
            mine = shard.owner[window] < end
            open_runs.append((window[mine] + base, run[mine]))
            if not (goes_on and end == hi - lo):
                close()
        if goes_on and not (comes_in and end == hi - lo):
            window, run = shard.sorted_run(int(np.searchsorted(anchor[lo:hi], anchor[hi - 1])))
            open_runs.append((window + base, run))
    close()
    return marks


def repeated_strings(docs: DataFrame, text_col: str = "text", width: int = WIDTH, gram: int = GRAM,
                     anchor_limit: int | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``_row``, ``spans``: byte ranges covered by strings of ``width`` bytes that start twice."""
    def solver(contexts, weights, windows, anchor):
        return array_marks(contexts, weights, windows, anchor, width, shard_bytes)

    return repeated_spans(docs, solver, "byte", width, min(gram, width), text_col, anchor_limit, 4 * shard_bytes)


def remove_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: ``id``, ``n_bytes``, ``n_removed``, ``kept`` (the remaining bytes),
    ``spans`` (maximal removed byte ranges)."""
    docs = stable(docs)
    spans = repeated_strings(docs, text_col, **options)
    source = with_row_id(docs, F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                total, removed, kept, runs = [], [], [], []
                for text, found in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                    raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
                    total.append(len(raw))
                    cover = covered(len(raw), np.array([s["first"] for s in found or ()], dtype=np.int64),
                                    np.array([s["end"] for s in found or ()], dtype=np.int64))
                    removed.append(int(cover.sum()))
                    kept.append(raw[~cover].tobytes())
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], cover.astype(np.int8), [0]))))
                    runs.append(edge.reshape(-1, 2).tolist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(kept, pa.binary()), pa.array(runs, pa.list_(pa.list_(pa.int64())))],
                    names=["id", "n_bytes", "n_removed", "kept", "spans"])

    return source.join(spans.hint("merge"), ROW, "left").select("id", "text", "spans").mapInArrow(
        run, f"id {id_type}, n_bytes long, n_removed long, kept binary, spans array<array<long>>")
