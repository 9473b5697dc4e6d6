"""Repeated windows of a corpus: the Spark plan shared by the suffix-tree and suffix-array operators.

A window is ``width`` consecutive items (bytes or words) of one document. It is repeated if its
content starts anywhere else too, in another document or in its own. The plan:

1. Every document is cut into *contexts* by content-chosen anchors (see ``anchors``); each window
   lies in exactly one context, and equal windows have equal anchors. One row per context: anchor
   hash, context hash, document row, first window, number of windows.
2. Anchors that occur once in the corpus cannot own a repeated window; their rows go.
3. Equal contexts collapse to one representative with a weight, so a group of copies costs one
   context, however large it is.
4. The representatives' items are fetched from their documents and dealt out by anchor, which
   splits all suffixes that may match into groups of bounded memory. A *solver* (suffix tree or
   suffix array) decides each group and marks the repeated windows.
5. An anchor whose different contexts have more than ``anchor_limit`` items (a frequent passage amid
   different text; by default what fills half a shard) is not held by one task: it is grown. Every window
   of such a group holds the anchor, and on one side of it or the other at least half of its remaining
   items; with those the anchor becomes a longer one that splits the group further, a context into at
   most two shorter ones. Equal contexts collapse again. This goes on until a group fits; the
   room beside the anchor halves each time, so after eight rounds or so anchors are whole windows and a
   group has one context. So prefixes (and what stands before them) are as long as a group's size asks for.
6. The marks go back, round by round, to all occurrences and are gathered per document as spans of items.

Nothing is sampled or capped, no group has to fit one task, and only sizes reach the driver. All groups
are decided by the solver. Contexts are collapsed on two independent 64-bit hashes. Joins that meet the
texts are sort-merge joins at every size, so work grows evenly; intermediate tables are deleted when
their last reader is written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import anchors
from newsloom.llm.common import ROW, discard, materialise, release, stable, with_row_id

#: Items put together for one pass of numpy; longer documents are cut into overlapping pieces.
PIECE_ITEMS = {"byte": 1 << 20, "word": 1 << 18}
SHARD_BYTES = 2 << 20
ANCHOR_LIMIT = {"byte": SHARD_BYTES // 2, "word": SHARD_BYTES // 16}

#: (contexts, weights, numbers of windows, anchor hashes) -> one mark per window, in order.
Solver = Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray], np.ndarray]


class Items:
    """Some texts (or pieces of them) one after the other, as items."""

    def __init__(self, unit: str):
        self.unit, self.payloads, self.lengths, self.rows, self.bases = unit, [], [], [], []
        self.total = 0

    def add(self, payload: bytes, items: int, row: int, base: int) -> None:
        self.payloads.append(payload)
        self.lengths.append(items)
        self.rows.append(row)
        self.bases.append(base)
        self.total += items

    def close(self) -> None:
        self.buffer = (b"" if self.unit == "byte" else b" ").join(self.payloads)
        raw = np.frombuffer(self.buffer, dtype=np.uint8)
        if self.unit == "byte":
            self.values, self.starts, self.ends = raw, None, None
        else:
            self.ends = np.concatenate((np.flatnonzero(raw == 32), [len(raw)]))
            self.starts = np.concatenate(([0], self.ends[:-1] + 1))
            self.values = anchors.span_hashes(anchors.prefix_sums(raw), self.starts, self.ends)

    def slices(self, first: np.ndarray, last: np.ndarray) -> Iterator[bytes]:
        """The bytes of items [first, last) for each pair."""
        if self.unit == "word":
            first, last = self.starts[first], self.ends[last - 1]
        return map(self.buffer.__getitem__, map(slice, first.tolist(), last.tolist()))


def document_items(text: str | None, unit: str) -> bytes | list[bytes]:
    raw = (text or "").encode()
    return raw if unit == "byte" else raw.split()


def item_blocks(texts: list[str | None], unit: str, width: int) -> Iterator[Items]:
    """Blocks of whole documents; a document longer than a piece is cut, windows staying whole."""
    limit = PIECE_ITEMS[unit]
    block = Items(unit)
    for row, text in enumerate(texts):
        items = document_items(text, unit)
        if len(items) < width:
            continue
        for base in range(0, len(items) - width + 1, limit):
            piece = items[base:base + limit + width - 1]
            block.add(piece if unit == "byte" else b" ".join(piece), len(piece), row, base)
            if block.total >= limit:
                block.close()
                yield block
                block = Items(unit)
    if block.total:
        block.close()
        yield block


def context_rows(docs: DataFrame, text_col: str, unit: str, width: int, gram: int) -> DataFrame:
    """``anchor``, ``context``, ``_row``, ``first`` (window), ``windows`` for every context."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(ROW).to_numpy()
            for block in item_blocks(batch.column("text").to_pylist(), unit, width):
                lengths = np.array(block.lengths)
                anchor, owner, lo, hi = anchors.winnow(block.values, lengths, width, gram)
                if not len(anchor):
                    continue
                offset = (np.cumsum(lengths) - lengths)[owner]
                digest = np.fromiter(map(xxhash.xxh3_64_intdigest, block.slices(offset + lo, offset + hi + width)),
                                     dtype=np.uint64, count=len(anchor))
                rows, bases = ids[np.array(block.rows)], np.array(block.bases)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(rows[owner]),
                     pa.array((bases[owner] + lo)), pa.array((hi - lo + 1).astype(np.int32))],
                    names=["anchor", "context", ROW, "first", "windows"])

    source = with_row_id(docs, F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"anchor long, context long, {ROW} long, first long, windows int")


def fetch_contexts(docs: DataFrame, text_col: str, wanted: DataFrame, unit: str, width: int) -> DataFrame:
    """The bytes of the wanted contexts: ``anchor, context, weight, windows, wide, items``."""
    per_row = wanted.groupBy(ROW).agg(F.collect_list(F.struct(
        "anchor", "context", "weight", "first", "windows", "wide")).alias("wanted"))
    source = with_row_id(docs, F.col(text_col).alias("text")).join(per_row.hint("merge"), ROW).select("text", "wanted")
    names = ["anchor", "context", "weight", "windows", "wide", "items"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column("wanted")
                rows = lists.flatten()
                count = np.diff(lists.offsets.to_numpy())
                first, windows = rows.field("first").to_numpy(), rows.field("windows").to_numpy()
                found, k = [], 0
                for text, n in zip(part.column("text").to_pylist(), count.tolist()):
                    lo, hi = first[k:k + n], first[k:k + n] + windows[k:k + n] + width - 1
                    block = Items(unit)
                    items = document_items(text, unit)
                    block.add(items if unit == "byte" else b" ".join(items), len(items), 0, 0)
                    block.close()
                    found.extend(block.slices(lo, hi))
                    k += n
                yield pa.RecordBatch.from_arrays(
                    [rows.field(c) for c in names[:-1]] + [pa.array(found, pa.binary())], names=names)

    return source.mapInArrow(run, "anchor long, context long, weight long, windows int, wide boolean, items binary")


def mark_runs(marks: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of marked windows inside each context: (context index, first, last)."""
    begins = np.cumsum(windows) - windows
    owner = np.repeat(np.arange(len(windows)), windows)
    at = np.flatnonzero(marks)
    if not len(at):
        return (np.zeros(0, np.int64),) * 3
    new = np.concatenate(([True], (np.diff(at) > 1) | (owner[at[1:]] != owner[at[:-1]])))
    first = at[new]
    last = at[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(at) - 1]))]
    return owner[first], first - begins[owner[first]], last - begins[owner[first]]


def solve_groups(contexts: DataFrame, solver: Solver, shard_bytes: int) -> DataFrame:
    """Run the solver over shards of whole anchors: ``anchor, context, lo, hi`` (marked windows)."""
    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        windows = rows.column("windows").to_numpy()
        anchor = rows.column("anchor").to_numpy()
        marks = solver(rows.column("items").to_pylist(), rows.column("weight").to_numpy(), windows, anchor)
        owner, lo, hi = mark_runs(marks, windows)
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor[owner]), pa.array(rows.column("context").to_numpy()[owner]),
             pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], names=["anchor", "context", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            while batch.num_rows:
                anchor = batch.column("anchor").to_numpy()
                weights = np.cumsum([len(x) + 1 for x in batch.column("items").to_pylist()])
                cut = int(np.searchsorted(weights, max(0, shard_bytes - size), side="right"))
                if cut >= batch.num_rows:
                    held.append(batch)
                    size += int(weights[-1])
                    break
                last = int(np.searchsorted(anchor, anchor[cut], side="right"))  # up to the end of its anchor
                if last >= batch.num_rows:  # which may go on in the next batch
                    held.append(batch)
                    size += int(weights[-1])
                    break
                held.append(batch.slice(0, last))
                yield solve(held)
                held, size, batch = [], 0, batch.slice(last)
        if held:
            yield solve(held)

    parts = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = contexts.repartition(parts, "anchor").sortWithinPartitions("anchor")
    return dealt.select("anchor", "context", "weight", "windows", "items").mapInArrow(
        run, "anchor long, context long, lo int, hi int")


def grow(width: int, windows: int, core_at: int, core: int) -> list[tuple[int, int, int, int]]:
    """The shorter contexts that a context falls into when its anchor is grown: (first window, number of
    windows, place of the new anchor, its length). The anchor of ``core`` items is at ``core_at``.

    A window in front of which at least half of the room lies left of the anchor takes that half in;
    any other one has more than the rest of the room on the right and takes that in.
    """
    room = width - core
    half = (room + 1) // 2
    out = []
    last = min(windows - 1, core_at - half)
    if last >= 0:
        out.append((0, last + 1, core_at - half, core + half))
    first = max(0, core_at - half + 1)
    if first < windows:
        out.append((first, windows - first, core_at - first, core + room - half + 1))
    return out


def anchor_place(values: np.ndarray, width: int, gram: int) -> int:
    """Where the anchor of a context stands: the smallest hash in its first window, leftmost on ties."""
    hashes = anchors.gram_hashes(values[:width], gram)
    return int(np.argmin(hashes & ~np.uint64(anchors.MAX_ITEMS - 1)))


GROWN = ("anchor long, context long, weight long, windows int, items binary, core_at int, core int, "
         "up_anchor long, up_context long, up_lo int")


def grown_contexts(wide: DataFrame, unit: str, width: int) -> DataFrame:
    """One round: the contexts of oversized anchors, cut by longer anchors, with the context they come from
    (``up_anchor``, ``up_context``) and their first window there (``up_lo``)."""
    names = [f.split()[0] for f in GROWN.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for up_anchor, up_context, weight, windows, raw, core_at, core in zip(*(batch.column(c).to_pylist() for c in names[:7])):
                block = Items(unit)
                block.add(raw, windows + width - 1, 0, 0)
                block.close()
                for lo, count, place, grown in grow(width, windows, core_at, core):
                    first, last = np.array([lo, lo + place]), np.array([lo + count + width - 1, lo + place + grown])
                    piece, middle = block.slices(first, last)
                    # the hash of an anchor of another length never meets it by content
                    key = xxhash.xxh3_64_intdigest(middle, seed=grown)
                    rows.append((key, xxhash.xxh3_64_intdigest(piece, seed=1), weight, count, piece, place, grown,
                                 up_anchor, up_context, lo))
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            signed = [np.array(columns[k], dtype=np.uint64).view(np.int64) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed[0]), pa.array(signed[1]), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int32()),
                 pa.array(columns[4], pa.binary()), pa.array(columns[5], pa.int32()), pa.array(columns[6], pa.int32()),
                 pa.array(columns[7], pa.int64()), pa.array(columns[8], pa.int64()), pa.array(columns[9], pa.int32())], names=names)

    return wide.select(*names[:7]).mapInArrow(run, GROWN)


def first_anchors(contexts: DataFrame, unit: str, width: int, gram: int) -> DataFrame:
    """Contexts with the place and length of the anchors that they were found by."""
    names = ["anchor", "context", "weight", "windows", "items"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = []
            for raw, windows in zip(batch.column("items").to_pylist(), batch.column("windows").to_pylist()):
                block = Items(unit)
                block.add(raw, windows + width - 1, 0, 0)
                block.close()
                places.append(anchor_place(block.values, width, gram))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(places, pa.int32()), pa.array([gram] * len(places), pa.int32())],
                names=[*names, "core_at", "core"])

    return contexts.select(*names).mapInArrow(
        run, "anchor long, context long, weight long, windows int, items binary, core_at int, core int")


def oversized(contexts: DataFrame, width: int, limit: int) -> DataFrame:
    """``anchor``, ``wide``: anchors with two or more contexts that have more than ``limit`` items in all."""
    sizes = contexts.groupBy("anchor").agg(F.sum(F.col("windows") + (width - 1)).alias("size"), F.count("*").alias("n"))
    return sizes.filter((F.col("size") > limit) & (F.col("n") > 1)).select("anchor", F.lit(True).alias("wide"))


def solve_wide(contexts: DataFrame, solver: Solver, unit: str, width: int, gram: int, limit: int,
               shard_bytes: int) -> DataFrame:
    """``anchor, context, lo, hi`` for the contexts of oversized anchors, by growing the anchors."""
    current = materialise(first_anchors(contexts, unit, width, gram), "repeat-wide-0")
    parents, marks = [], []
    for level in range(1, 64):
        children = materialise(grown_contexts(current, unit, width), f"repeat-grown-{level}")
        merged = children.groupBy("anchor", "context").agg(
            F.sum("weight").alias("weight"), *[F.first(c).alias(c) for c in ("windows", "items", "core_at", "core")])
        merged = materialise(merged, f"repeat-merged-{level}")
        discard(current)
        parents.append(children)
        wide = materialise(oversized(merged, width, limit), f"repeat-oversized-{level}")
        ready = merged.join(wide.select("anchor"), "anchor", "left_anti")
        marks.append(materialise(solve_groups(ready, solver, shard_bytes), f"repeat-solved-{level}"))
        current = materialise(merged.join(wide.select("anchor"), "anchor", "left_semi"), f"repeat-wide-{level}")
        discard(merged, wide)
        if current.isEmpty():
            discard(current)
            break
    found = None
    for children, solved in zip(reversed(parents), reversed(marks)):
        solved = solved if found is None else solved.union(found)
        links = children.select("anchor", "context", "up_anchor", "up_context", "up_lo")
        found = materialise(solved.join(links, ["anchor", "context"]).select(
            F.col("up_anchor").alias("anchor"), F.col("up_context").alias("context"),
            (F.col("lo") + F.col("up_lo")).alias("lo"), (F.col("hi") + F.col("up_lo")).alias("hi")), "repeat-back")
    discard(*parents, *marks)
    return found


def repeated_spans(docs: DataFrame, solver: Solver, unit: str, width: int, gram: int, text_col: str = "text",
                   anchor_limit: int | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``_row``, ``spans``: for every document with a repeated window, the item ranges [first, end)
    that its repeated windows cover (array of structs; they may overlap)."""
    spark = docs.sparkSession
    docs = stable(docs)
    every = materialise(context_rows(docs, text_col, unit, width, gram), "repeat-contexts")
    shared = materialise(every.groupBy("anchor").count().filter("count > 1").select("anchor"), "repeat-anchors")
    rows = materialise(every.join(shared.hint("merge"), "anchor"), "repeat-shared")
    discard(every, shared)
    release(spark)
    distinct = rows.groupBy("anchor", "context").agg(
        F.count("*").alias("weight"), F.min(F.struct(ROW, "first", "windows")).alias("at"))
    distinct = materialise(distinct.select("anchor", "context", "weight", "at.*"), "repeat-distinct")
    limit = ANCHOR_LIMIT[unit] if anchor_limit is None else anchor_limit
    wide = materialise(oversized(distinct, width, limit), "repeat-wide-anchors")
    wanted = distinct.join(wide, "anchor", "left").withColumn("wide", F.coalesce("wide", F.lit(False)))
    contexts = fetch_contexts(docs, text_col, wanted.filter("not wide"), unit, width)
    marked = materialise(solve_groups(contexts, solver, shard_bytes), "repeat-narrow")
    release(spark)
    if not wide.isEmpty():
        contexts = fetch_contexts(docs, text_col, wanted.filter("wide"), unit, width)
        marked = marked.union(solve_wide(contexts, solver, unit, width, gram, limit, shard_bytes))
    marked = marked.groupBy("anchor", "context").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    marked = materialise(marked, "repeat-marked")
    spans = (rows.join(marked, ["anchor", "context"]).select(ROW, "first", F.explode("runs").alias("run"))
             .select(ROW, (F.col("first") + F.col("run.lo")).alias("first"),
                     (F.col("first") + F.col("run.hi") + width).alias("end")))
    spans = materialise(spans.groupBy(ROW).agg(F.collect_list(F.struct("first", "end")).alias("spans")), "repeat-spans")
    discard(rows, distinct, wide, marked)
    release(spark)
    return spans


def covered(length: int, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``length`` items some span [first, end) covers."""
    change = np.zeros(length + 1, dtype=np.int32)
    np.add.at(change, first, 1)
    np.add.at(change, end, -1)
    return np.cumsum(change[:length]) > 0
