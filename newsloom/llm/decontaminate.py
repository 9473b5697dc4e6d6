"""Benchmark decontamination by a prefix-filtered set join over item-sized windows.

A benchmark item is the set of its windows (``window`` consecutive words; a shorter item is one
window), a window the set of its word shingles. A document contains a window only if it contains
all its shingles, so one *prefix token*, the window's rarest shingle, is necessary. Rarity is the
number of occurrences in all documents, counted in a first pass over them. In the second pass each
document's shingles are joined with the prefix tokens; a match at a document position fixes where
the window would start, which must leave room for the whole window (positional and length bounds);
then the words are compared one by one.

The benchmark is the stated query set. It is dealt into blocks of at most ``block_windows``
different windows; each block is small by construction, goes to every task, and meets all
documents. Document texts are never shuffled: only occurrences leave the scan.

Defined results: a null or wordless text has no words, is no item's window, and is not
contaminated; an item whose id is null is named by the empty string; repeated items count once by
id; repeated documents get the same answer each; empty tables give no occurrence. Columns other
than ids and texts are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import anchors
from newsloom.llm.common import ROW, drop_rows, materialise, stable, with_row_id
from newsloom.llm.repeats import covered

WINDOW, SHINGLE = 13, 3
BLOCK_WINDOWS = 200_000
#: Bytes of text handled by one pass of numpy.
PIECE_BYTES = 1 << 18
#: Rows whose texts are held as Python strings at once.
SLICE_ROWS = 256
#: Word characters: digits, letters (A-Z lowered), and everything beyond ASCII; others separate.
_WORD = bytes((b + 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128
              else 32 for b in range(256))


def normalised(text: str | None) -> bytes:
    return (text or "").encode().translate(_WORD)


class Words:
    """The words of a buffer of normalised bytes: places, and a hash of each."""

    def __init__(self, buffer: bytes):
        self.buffer = buffer
        raw = np.frombuffer(buffer, dtype=np.uint8)
        inside = np.concatenate(([0], (raw != 32).view(np.int8), [0]))
        step = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        self.values = anchors.span_hashes(anchors.prefix_sums(raw), self.starts, self.ends)

    def __len__(self) -> int:
        return len(self.starts)

    def text(self, first: int, last: int) -> bytes:
        """Words [first, last), joined by one space."""
        return b" ".join(self.buffer[self.starts[first]:self.ends[last - 1]].split())

    def shingles(self, size: int) -> np.ndarray:
        return anchors.gram_hashes(self.values, size) if len(self) >= size else np.zeros(0, np.uint64)


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``words`` (joined by one space), ``items`` (sorted ids as strings): the different windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, found = [], []
            for name, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                words = normalised(text).split()
                for at in range(max(1, len(words) - window + 1) if words else 0):
                    names.append(name)
                    found.append(b" ".join(words[at:at + window]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.binary())],
                                             names=["item", "words"])

    source = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                          F.col(text_col).alias("text"))
    rows = source.mapInArrow(run, "item string, words binary")
    return rows.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))


class Block:
    """A bounded number of windows, ready for lookups; picklable, sent to every task."""

    def __init__(self, rows: list[tuple[bytes, list[str]]], shingle: int):
        self.texts = [r[0] for r in rows]
        self.items = [r[1] for r in rows]
        words = Words(b" ".join(self.texts) + b" ")
        self.sizes = np.array([t.count(b" ") + 1 for t in self.texts], dtype=np.int64)
        begins = np.cumsum(self.sizes) - self.sizes
        # shingles of every window: its own (all words if it has fewer than a shingle)
        self.width = np.minimum(self.sizes, shingle)
        self.tokens: dict[int, np.ndarray] = {}  # by shingle size: sorted different shingles
        self.places: list[tuple[int, np.ndarray]] = []
        hashes = {int(k): words.shingles(int(k)) for k in np.unique(self.width)}
        for begin, size, k in zip(begins.tolist(), self.sizes.tolist(), self.width.tolist()):
            self.places.append((k, hashes[k][begin:begin + size - k + 1]))
        for k in hashes:
            self.tokens[k] = np.unique(np.concatenate([h for w, h in self.places if w == k]))

    def count(self, words: Words, bounds: np.ndarray) -> dict[int, np.ndarray]:
        """Occurrences of every shingle in a buffer of documents (bounds: first words of documents)."""
        found = {}
        for k, tokens in self.tokens.items():
            at, hit = self._matches(words, bounds, k, tokens)
            found[k] = np.bincount(hit, minlength=len(tokens))
        return found

    @staticmethod
    def _matches(words: Words, bounds: np.ndarray, k: int, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word positions and token numbers of shingles that lie in one document and are tokens."""
        shingles = words.shingles(k)
        if not len(shingles):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # a table over 16 bits of the hash passes few others, so most shingles cost one look
        table = np.zeros(1 << 16, dtype=bool)
        table[(tokens >> np.uint64(48)).astype(np.int64)] = True
        at = np.flatnonzero(table[(shingles >> np.uint64(48)).astype(np.int64)])
        place = np.minimum(np.searchsorted(tokens, shingles[at]), len(tokens) - 1)
        same = tokens[place] == shingles[at]
        at, place = at[same], place[same]
        whole = np.searchsorted(bounds, at, side="right") == np.searchsorted(bounds, at + k - 1, side="right")
        return at[whole], place[whole]

    def choose_prefixes(self, counts: dict[int, np.ndarray]) -> None:
        """The rarest shingle of every window (the first of equally rare ones) becomes its prefix token."""
        chosen: dict[int, dict[int, list[tuple[int, int]]]] = {k: {} for k in self.tokens}
        for number, (k, hashes) in enumerate(self.places):
            place = np.searchsorted(self.tokens[k], hashes)
            offset = int(np.argmin(counts[k][place]))
            chosen[k].setdefault(int(place[offset]), []).append((number, offset))
        self.prefixes = {}
        for k, by_token in chosen.items():
            kept = np.array(sorted(by_token), dtype=np.int64)
            self.prefixes[k] = (self.tokens[k][kept], [by_token[int(p)] for p in kept])
        self.places = []

    def occurrences(self, words: Words, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(first word, window size, window number) for every occurrence in a buffer of documents."""
        for k, (tokens, windows) in self.prefixes.items():
            at, hit = self._matches(words, bounds, k, tokens)
            document = np.searchsorted(bounds, at, side="right") - 1
            begin = bounds[document]
            end = np.concatenate((bounds[1:], [len(words)]))[document]
            for position, token, lo, hi in zip(at.tolist(), hit.tolist(), begin.tolist(), end.tolist()):
                for number, offset in windows[token]:
                    first, size = position - offset, int(self.sizes[number])
                    if lo <= first and first + size <= hi and words.text(first, first + size) == self.texts[number]:
                        yield first, size, number


def _pieces(texts: list[str | None], window: int) -> Iterator[tuple[Words, np.ndarray, list[int], list[int]]]:
    """Buffers of documents: words, first word of each part, its document, words in front of the part.

    A document longer than a piece is cut into parts that overlap by a window less one word.
    """
    parts, rows, size = [], [], 0
    for row, text in enumerate(texts):
        raw = normalised(text)
        if len(raw) > 4 * PIECE_BYTES:
            if parts:
                yield _joined(parts, rows)
                parts, rows, size = [], [], 0
            words = raw.split()
            step = PIECE_BYTES // 4
            for base in range(0, max(1, len(words) - window + 1), step):
                found = Words(b" ".join(words[base:base + step + window - 1]))
                yield found, np.zeros(1, np.int64), [row], [base]
            continue
        parts.append(raw)
        rows.append(row)
        size += len(raw)
        if size >= PIECE_BYTES:
            yield _joined(parts, rows)
            parts, rows, size = [], [], 0
    if parts:
        yield _joined(parts, rows)


def _joined(parts: list[bytes], rows: list[int]) -> tuple[Words, np.ndarray, list[int], list[int]]:
    words = Words(b" ".join(parts) + b" ")
    lengths = np.array([len(p) + 1 for p in parts])
    bounds = np.searchsorted(words.starts, np.cumsum(lengths) - lengths)
    return words, bounds, rows, [0] * len(rows)


def _count_pass(docs: DataFrame, block: Block, window: int) -> dict[int, np.ndarray]:
    """Occurrences of the block's shingles in all documents (a bounded number of sums)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {k: np.zeros(len(t), dtype=np.int64) for k, t in block.tokens.items()}
        for batch in _slices(batches):
            for words, bounds, _, _ in _pieces(batch.column("text").to_pylist(), window):
                for k, n in block.count(words, bounds).items():
                    totals[k] += n
        for k, n in totals.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k)), pa.array(at), pa.array(n[at])],
                                             names=["size", "token", "n"])

    counts = {k: np.zeros(len(t), dtype=np.int64) for k, t in block.tokens.items()}
    rows = docs.select("text").mapInArrow(run, "size long, token long, n long")
    for size, token, n in rows.groupBy("size", "token").agg(F.sum("n").alias("n")).collect():
        counts[size][token] = n
    return counts


HIT = pa.struct([("item", pa.string()), ("first", pa.int64()), ("end", pa.int64())])
HITS = "hits array<struct<item:string,first:long,end:long>>"


def _occurrence_pass(docs: DataFrame, block: Block, window: int, totals: bool) -> DataFrame:
    """``_row``, ``id``, ``n_words``, ``hits`` (item, first, end) of every document, for one block; with
    ``totals`` (the only block) also what ``_with_totals`` adds, by the same Python worker."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            n = batch.num_rows
            total = np.zeros(n, dtype=np.int64)
            spans: list[dict[str, list[list[int]]]] = [{} for _ in range(n)]
            for words, bounds, rows, bases in _pieces(batch.column("text").to_pylist(), window):
                sizes = np.diff(np.concatenate((bounds, [len(words)])))
                for row, base, size in zip(rows, bases, sizes.tolist()):
                    total[row] = max(total[row], base + size)
                for first, size, number in sorted(block.occurrences(words, bounds)):
                    part = int(np.searchsorted(bounds, first, side="right")) - 1
                    lo = first - int(bounds[part]) + bases[part]
                    for item in block.items[number]:
                        runs = spans[rows[part]].setdefault(item, [])
                        if runs and lo <= runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], lo + size)
                        else:
                            runs.append([lo, lo + size])
            hits = [[{"item": i, "first": a, "end": b} for i, runs in s.items() for a, b in runs] for s in spans]
            columns = [batch.column(ROW), batch.column("id"), pa.array(total), pa.array(hits, pa.list_(HIT))]
            names = [ROW, "id", "n_words", "hits"]
            if totals:
                columns, names = columns + _totals(hits, total.tolist()), names + ["n_hit", "items"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"{ROW} long, id {id_type}, n_words long, {HITS}"
                                + (", n_hit long, items array<string>" if totals else ""))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def _totals(hits: list[list[dict] | None], n_words: list[int]) -> list[pa.Array]:
    """Words inside an occurrence, and sorted item ids, of every document."""
    count, names = [], []
    for found, n in zip(hits, n_words):
        found = found or []
        names.append(sorted({h["item"] for h in found}))
        cover = covered(n, np.array([h["first"] for h in found], dtype=np.int64),
                        np.array([h["end"] for h in found], dtype=np.int64)) if found else np.zeros(1, bool)
        count.append(int(cover.sum()))
    return [pa.array(count, pa.int64()), pa.array(names, pa.list_(pa.string()))]


def _with_totals(rows: DataFrame) -> DataFrame:
    """Add ``n_hit`` (words inside an occurrence), ``items`` (sorted ids) from ``hits``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            added = _totals(batch.column("hits").to_pylist(), batch.column("n_words").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in (ROW, "id", "n_words", "hits")] + added,
                                             names=[ROW, "id", "n_words", "hits", "n_hit", "items"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"{ROW} long, id {id_type}, n_words long, {HITS}, n_hit long, items array<string>")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  shingle: int = SHINGLE, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per document: ``_row``, ``id``, ``n_words``, ``n_hit``, ``items`` (ids with a window in the
    document), ``hits`` (item, first word, end) and ``contaminated``."""
    source = with_row_id(stable(docs), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    windows = materialise(item_windows(items, item_id_col, item_text_col, window), "bench-windows")
    blocks = max(1, -(-windows.count() // block_windows))
    windows = windows.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks)))
    found = None
    for number in range(blocks):
        rows = windows.filter(F.col("block") == number).select("words", "items").collect()
        block = Block([(bytes(r["words"]), list(r["items"])) for r in rows], shingle) if rows else Block([], shingle)
        block.choose_prefixes(_count_pass(source, block, window) if rows else {})
        hits = _occurrence_pass(source, block, window, totals=blocks == 1)
        if blocks > 1:
            hits = materialise(hits if number == 0 else hits.filter(F.size("hits") > 0), f"bench-hits-{number}")
        found = hits if found is None else found.union(hits)
    if blocks > 1:
        found = found.groupBy(ROW).agg(F.first("id").alias("id"), F.max("n_words").alias("n_words"),
                                       F.flatten(F.collect_list("hits")).alias("hits"))
        found = _with_totals(found)
    return found.withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated rows; all columns are kept as they are."""
    docs = stable(docs)
    return drop_rows(docs, contamination(docs, items, **options).filter("contaminated"), "bench-bad")
