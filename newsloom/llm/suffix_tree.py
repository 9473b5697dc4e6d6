"""Substring dedup with prefix-partitioned suffix trees over words.

The suffixes that can match at all (see ``repeats``) are split by the content of their anchor into
groups of bounded memory. For each group a suffix tree is built top-down, all branches at once:
the leaves below a node read their next words together, over a range that grows as fewer leaves
are left, and split into child nodes where those words differ. Leaves that are alone under a node
are finished. A node that reaches the window's depth with two or more leaves is a deep internal
node: its path is a repeated passage, and all its leaves start one.

A document's words that some repeated window covers are removed; windows are judged on the input.

Defined results: a null or blank text has no words and an empty remainder; a text shorter than a
window loses nothing; repeated rows are repeats of each other; an empty table gives an empty
result. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import anchors
from newsloom.llm.common import ROW, stable, with_row_id
from newsloom.llm.repeats import SHARD_BYTES, Items, covered, repeated_spans

WINDOW_WORDS, GRAM_WORDS = 35, 8


@dataclass
class Subtree:
    """Suffix tree of some leaves (word positions), down to ``depth`` words."""

    leaves: np.ndarray  # positions, those below one node next to each other
    node_first: np.ndarray  # deep internal nodes: first leaf and number of leaves
    node_size: np.ndarray
    branches: list[tuple[int, int]]  # (depth in words, internal nodes there)


def build_subtree(values: np.ndarray, leaves: np.ndarray, depth: int) -> Subtree:
    """Split the leaves by their next words until ``depth`` words are read."""
    sums = anchors.prefix_sums(values)
    node = np.zeros(len(leaves), dtype=np.int64)
    at, step, branches = 0, 2, []
    while at < depth and len(leaves):
        step = min(step, depth - at)
        ahead = anchors.span_hashes(sums, leaves + at, leaves + at + step)
        order = np.lexsort((ahead, node))
        leaves, node, ahead = leaves[order], node[order], ahead[order]
        new = np.concatenate(([True], (node[1:] != node[:-1]) | (ahead[1:] != ahead[:-1])))
        node = np.cumsum(new) - 1
        inner = np.bincount(node)[node] > 1
        leaves, node = leaves[inner], node[inner]
        at += step
        step *= 2  # few leaves are left: read further ahead at once
        branches.append((at, len(np.unique(node))))
    first = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1]))) if len(node) else np.zeros(0, np.int64)
    return Subtree(leaves, first, np.diff(np.concatenate((first, [len(node)]))), branches)


def tree_marks(contexts: list[bytes], weights: np.ndarray, windows: np.ndarray, anchor: np.ndarray,
               width: int = WINDOW_WORDS) -> np.ndarray:
    """Solver: a window is repeated if its deep node has leaves of weight two or more in all."""
    block = Items("word")
    for k, context in enumerate(contexts):
        block.add(context, int(windows[k]) + width - 1, k, 0)
    block.close()
    lengths = np.array(block.lengths)
    owner = np.repeat(np.arange(len(windows)), windows)
    index = np.arange(int(windows.sum()))
    position = (np.cumsum(lengths) - lengths)[owner] + index - (np.cumsum(windows) - windows)[owner]
    marks = (weights > 1)[owner]  # equal contexts were collapsed: each of their windows occurs that often
    tree = build_subtree(block.values, position, width)
    if len(tree.leaves):
        back = np.zeros(int(lengths.sum()), dtype=np.int64)
        back[position] = index
        marks[back[tree.leaves]] = True  # two leaves at least below every deep node
    return marks


def repeated_passages(docs: DataFrame, text_col: str = "text", window: int = WINDOW_WORDS, gram: int = GRAM_WORDS,
                      anchor_limit: int | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``_row``, ``spans``: word ranges covered by passages of ``window`` words that occur twice."""
    def solver(contexts, weights, windows, anchor):
        return tree_marks(contexts, weights, windows, anchor, window)

    return repeated_spans(docs, solver, "word", window, min(gram, window), text_col, anchor_limit, shard_bytes)


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: ``id``, ``n_words``, ``n_removed``, ``kept`` (the remaining words joined by
    one space), ``spans`` (removed word ranges, merged)."""
    docs = stable(docs)
    spans = repeated_passages(docs, text_col, **options)
    source = with_row_id(docs, F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                total, removed, kept, runs = [], [], [], []
                for text, found in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                    words = (text or "").encode().split()
                    total.append(len(words))
                    cover = covered(len(words), np.array([s["first"] for s in found or ()], dtype=np.int64),
                                    np.array([s["end"] for s in found or ()], dtype=np.int64))
                    removed.append(int(cover.sum()))
                    kept.append(b" ".join(words if not found else [words[i] for i in np.flatnonzero(~cover)]))
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], cover.astype(np.int8), [0]))))
                    runs.append(edge.reshape(-1, 2).tolist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array([k.decode() for k in kept], pa.string()),
                     pa.array(runs, pa.list_(pa.list_(pa.int64())))],
                    names=["id", "n_words", "n_removed", "kept", "spans"])

    return source.join(spans.hint("merge"), ROW, "left").select("id", "text", "spans").mapInArrow(
        run, f"id {id_type}, n_words long, n_removed long, kept string, spans array<array<long>>")
