"""Target-distribution importance resampling over hashed word n-grams.

Every document is weighed by how much likelier its n-grams are in the target texts than in the corpus,
and documents are drawn without replacement with the Gumbel top-k trick: weight plus a Gumbel number
made of a hash of the id, highest first.

N-grams are counted by batch concatenation. The lower-cased texts of a batch are joined with a separator
sentinel (a byte that UTF-8 never contains), one regex pass finds the words of all of them, and a
``searchsorted`` of the document offsets tells each word's document; runs of words that would reach into
the next document are masked before ``bincount``. A run's bucket is the CRC-32 of its words joined by one
space, which is put together from the words' own checksums: the checksum of ``a + b`` is that of ``a``
shifted by the length of ``b``, exclusive-or that of ``b``. So no n-gram is ever built as a string.

Two passes read the corpus: the first adds up bucket counts (one array a task, summed by Spark), the
second sums the gains of each document. Only the gains (one number a bucket) travel to the tasks. The
draw is a range sort by score whose partitions are numbered with prefix sums.

Defined results: a null text has no words; a text without n-grams has weight 0; documents with fewer than
``min_words`` words are never drawn (rank null); ties in score go to the smaller id, a null id after all
others, rows that tie on both to the first in the input; a null id is hashed as an empty string; an
empty target or corpus has counts of 0; an empty table gives an empty result. Texts of any length are
read whole, ``BLOCK_WORDS`` words at a time. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import ROW, global_ranks, materialise, stable, with_row_id

BUCKETS, MAX_GRAM, MIN_WORDS = 10_000, 2, 20
#: Texts are joined up to this many bytes; words are handled this many at a time.
BATCH_BYTES, BLOCK_WORDS = 4 << 20, 1 << 19
SENTINEL = b"\xff"
WORD = re.compile(rb"[0-9a-z\x80-\xfe]+")
#: The reflected CRC-32 polynomial.
POLYNOMIAL = 0xEDB88320
#: Shift tables are kept for words of up to this many bytes; longer ones are shifted by repeated squaring.
TABLE_BYTES = 64


def _one_byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of 32-bit numbers, given by its values on each of their four bytes (4 x 256)."""
    return (tables[0][crc & 255] ^ tables[1][(crc >> 8) & 255] ^ tables[2][(crc >> 16) & 255] ^ tables[3][crc >> 24])


class Shifts:
    """Checksums moved in front of ``n`` further bytes."""

    def __init__(self):
        step, byte = _one_byte_table(), np.arange(256, dtype=np.uint32)
        tables = [np.stack([byte << np.uint32(8 * k) for k in range(4)])]  # by no byte
        for _ in range(TABLE_BYTES):
            last = tables[-1]
            tables.append(step[last & 255] ^ (last >> np.uint32(8)))
        self.tables = np.stack(tables)
        self.squares = [self.tables[1]]  # by 2 ** k bytes

    def _square(self, k: int) -> np.ndarray:
        while len(self.squares) <= k:
            self.squares.append(_apply(self.squares[-1], self.squares[-1]))
        return self.squares[k]

    def __call__(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        short = np.minimum(n, TABLE_BYTES)
        t = self.tables
        out = (t[short, 0, crc & 255] ^ t[short, 1, (crc >> 8) & 255] ^ t[short, 2, (crc >> 16) & 255] ^ t[short, 3, crc >> 24])
        for at in np.flatnonzero(n > TABLE_BYTES):
            one, left, k = crc[at:at + 1], int(n[at]), 0
            while left:
                if left & 1:
                    one = _apply(self._square(k), one)
                left, k = left >> 1, k + 1
            out[at] = one[0]
        return out


def joined_texts(texts: list[bytes | None]) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first document, number of documents, joined lower-cased texts, offset of each document)."""
    held, size, first = [], 0, 0
    for k, text in enumerate(texts):
        held.append((text or b"").lower())
        size += len(held[-1]) + 1
        if size >= BATCH_BYTES or k == len(texts) - 1:
            ends = np.cumsum([len(t) + 1 for t in held])
            yield first, len(held), SENTINEL.join(held), np.concatenate(([0], ends[:-1]))
            held, size, first = [], 0, k + 1


def gram_buckets(texts: list[bytes | None], shifts: Shifts, max_gram: int, buckets: int,
                 ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of words: (document of each n-gram, its bucket, document of each word)."""
    blank = np.array([zlib.crc32(b" ")], dtype=np.uint32)
    for first, _, blob, offsets in joined_texts(texts):
        found = WORD.finditer(blob)
        # the last words of a block are the beginnings of runs that end in the next one
        crc, size, doc = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        while True:
            block = [m.span() for m in islice(found, BLOCK_WORDS)]
            if not block:
                break
            span = np.array(block, dtype=np.int64)
            fresh = np.fromiter((zlib.crc32(blob[a:b]) for a, b in block), dtype=np.uint32, count=len(block))
            old = len(crc)
            crc = np.concatenate((crc, fresh))
            size = np.concatenate((size, span[:, 1] - span[:, 0]))
            doc = np.concatenate((doc, first + np.searchsorted(offsets, span[:, 0], side="right") - 1))
            owners, marks = [doc[old:]], [fresh % np.uint32(buckets)]
            run = crc  # checksum of the run of n words that starts at each word
            for n in range(2, max_gram + 1):
                ahead = np.arange(len(run) - 1) + n - 1  # the run's last word
                run = shifts(run[:len(ahead)], np.ones(len(ahead), np.int64)) ^ blank
                run = shifts(run, size[ahead]) ^ crc[ahead]
                whole = (doc[:len(ahead)] == doc[ahead]) & (ahead >= old)
                owners.append(doc[ahead][whole])
                marks.append(run[whole] % np.uint32(buckets))
            yield np.concatenate(owners), np.concatenate(marks).astype(np.int64), doc[old:]
            keep = max_gram - 1
            crc, size, doc = (x[len(x) - min(keep, len(x)):] for x in (crc, size, doc))


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def bucket_counts(texts: DataFrame, text_col: str, max_gram: int, buckets: int) -> DataFrame:
    """``bucket``, ``n``: how often each bucket occurs over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts, total = Shifts(), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, marks, _ in gram_buckets(_texts(batch), shifts, max_gram, buckets):
                total += np.bincount(marks, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["bucket", "n"])

    parts = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text_col: str, target_text_col: str, max_gram: int,
                 buckets: int) -> list[int]:
    """Log ratio of every bucket's share in the target to that in the corpus, in floored thousandths."""
    spark = docs.sparkSession
    corpus = materialise(bucket_counts(docs, text_col, max_gram, buckets).select("bucket", F.col("n").alias("s")), "dsir-corpus")
    wanted = materialise(bucket_counts(target, target_text_col, max_gram, buckets).select("bucket", F.col("n").alias("t")),
                         "dsir-target")
    all_s, all_t = (f.agg(F.coalesce(F.sum(c), F.lit(0))).first()[0] for f, c in ((corpus, "s"), (wanted, "t")))
    counts = (spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
              .join(corpus, "bucket", "left").join(wanted, "bucket", "left"))

    def plus_one(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0)).cast("double") + 1

    ratio = (plus_one("t") * F.lit(float(all_s + buckets))) / (plus_one("s") * F.lit(float(all_t + buckets)))
    rows = counts.select("bucket", F.floor(F.lit(1000) * F.log(ratio)).cast("long").alias("gain")).collect()  # one row a bucket
    gains = [0] * buckets
    for r in rows:
        gains[r["bucket"]] = r["gain"]
    return gains


def importance(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               target_text_col: str = "text", max_gram: int = MAX_GRAM, buckets: int = BUCKETS) -> DataFrame:
    """One row per input row: ``_row``, ``id``, ``n_words``, ``n_features`` and ``weight`` (the floored
    mean of the gains of the document's n-grams, in thousandths)."""
    docs = stable(docs)
    gains = np.array(bucket_gains(docs, target, text_col, target_text_col, max_gram, buckets), dtype=np.int64)
    source = with_row_id(docs, F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts = Shifts()
        for batch in batches:
            rows = batch.num_rows
            words, features, total = (np.zeros(rows, dtype=np.int64) for _ in range(3))
            for owner, marks, word_owner in gram_buckets(_texts(batch), shifts, max_gram, buckets):
                words += np.bincount(word_owner, minlength=rows)
                features += np.bincount(owner, minlength=rows)
                # thousandths of at most some millions: sums of doubles are exact
                total += np.bincount(owner, weights=gains[marks], minlength=rows).astype(np.int64)
            weight = np.where(features > 0, total // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW), batch.column("id"), pa.array(words), pa.array(features), pa.array(weight)],
                names=[ROW, "id", "n_words", "n_features", "weight"])

    return source.mapInArrow(run, f"{ROW} long, id {id_type}, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", seed: int = 7, percent: int = 25,
             min_words: int = MIN_WORDS, **options) -> DataFrame:
    """``importance`` with ``score`` (weight plus Gumbel noise, in thousandths) and ``rank`` (1, 2, 3, ...
    among the drawn documents; null for the others)."""
    weighed = importance(docs, target, id_col, **options)
    id_text = F.coalesce(F.col("id").cast("string"), F.lit(""))
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_text).cast("binary"), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000) * F.log(-F.log(uniform))).cast("long")
    scored = materialise(weighed.withColumn("score", F.col("weight") + noise), "dsir-scores")
    able = scored.filter(F.col("n_words") >= min_words)
    drawn = able.count() * percent // 100
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col(ROW).asc()]
    ranks = global_ranks(able.select("score", "id", ROW), order, "dsir-ranks").filter(F.col("rank") <= drawn)
    return scored.join(ranks.select(ROW, "rank"), ROW, "left")
