"""SimHash near-dedup with Golay-code fuzzy hashing.

A document's fingerprint is the bitwise majority of the 64-bit hashes of its word shingles.
Distinct fingerprints within ``max_bits`` (at most 3) bits are linked, and documents whose
fingerprints are connected form a class.

Candidate search. A fingerprint is cut into three segments (22, 21 and 21 bits, each padded with
zeros to the 23 bits of a Golay word). Three errors fall on the segments in one of two ways:

* some segment has none. Cyclically, one error-free segment is followed by a segment with at most
  two, so the key (segment exact, a near Golay index of the next one) is shared;
* every segment has exactly one. The first segments share a near Golay index, and one half of
  the second and one half of the third are free of errors: key (Golay index, half, half).

That is up to 18 + 24 keys a fingerprint, each fixing 33 or more bits, so a bucket of unrelated
fingerprints stays small at any corpus size this can meet. Every candidate pair is verified by
its bit distance. A key shared by more than ``bucket_limit`` fingerprints (a large group of near
copies) is split further by each of four 16-bit quarters, one of which must be free of errors, so
no link is lost. From a bucket, a task hands on a spanning tree of the links it verified (the
components are those of all links), never all pairs.

Defined results: null and empty texts, and texts without a word, have the fingerprint 0 and are
linked like any other; fewer words than a shingle make one shingle of all; repeated rows get the
same answer each; a null id takes part but is never the class id unless all ids are null; an
empty table gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import golay
from newsloom.llm.common import ROW, drop_rows, materialise, release, stable, with_row_id
from newsloom.llm.components import connected_components

SHINGLE_WORDS, SEED, MAX_BITS = 3, 42, 3
BUCKET_LIMIT = 4096
BLOCK = 1 << 16  # shingles of one document hashed at once
#: (shift, bits) of the three segments, and of the halves of the last two.
SEGMENTS = ((42, 22), (21, 21), (0, 21))
HALVES = (((31, 11), (21, 10)), ((10, 11), (0, 10)))


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Bit i is 1 if it is set in over half the shingle hashes (repeats count)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(last), BLOCK):
        spans = zip(starts[at:at + len(last[at:at + BLOCK])].tolist(), last[at:at + BLOCK].tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int((counts * 2 > len(last)) @ (np.uint64(1) << np.arange(64, dtype=np.uint64)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS,
                 seed: int = SEED) -> DataFrame:
    """``_row``, ``id``, ``fp`` (the fingerprint as a signed long)."""
    source = with_row_id(docs, F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle, seed) for t in batch.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW), batch.column("id"), pa.array(found.view(np.int64))], names=[ROW, "id", "fp"])

    id_type = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"{ROW} long, id {id_type}, fp long")


def bits_of(fps: np.ndarray, piece: tuple[int, int]) -> np.ndarray:
    shift, width = piece
    return ((fps >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the fingerprint, 64-bit key) for every key; fingerprints within 3 bits share one."""
    segments = [bits_of(fps, s) for s in SEGMENTS]
    near = [golay.near_indices(s) for s in segments]
    rows, keys = [], []

    def put(kind: int, exact: np.ndarray, indices: np.ndarray) -> None:
        at, column = np.nonzero(indices >= 0)
        rows.append(at)
        keys.append((np.int64(kind) << 40) | (exact[at] << 12) | indices[at, column])

    for i in range(3):
        put(i, segments[i], near[(i + 1) % 3])
    for i, second in enumerate(HALVES[0]):
        for j, third in enumerate(HALVES[1]):
            put(3 + 2 * i + j, (bits_of(fps, second) << 11) | bits_of(fps, third), near[0])
    return np.concatenate(rows), np.concatenate(keys)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def bucket_forest(members: np.ndarray, max_bits: int, block: int = 512) -> list[tuple[int, int]]:
    """Links (indices) of a spanning forest of the members within ``max_bits`` of each other."""
    parent = np.arange(len(members))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tree = []
    for lo in range(0, len(members), block):
        rows = members[lo:lo + block]
        for cut in range(lo, len(members), 8 * block):
            close = distances(rows[:, None], members[None, cut:cut + 8 * block]) <= max_bits
            for i, j in zip(*np.nonzero(close)):
                i, j = int(i) + lo, int(j) + cut
                if i < j and (a := root(i)) != (b := root(j)):
                    parent[max(a, b)] = min(a, b)
                    tree.append((i, j))
    return tree


def _bucket_links(keys: np.ndarray, fps: np.ndarray, max_bits: int, small: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Verified links inside runs of equal (sorted) keys."""
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    size = np.diff(np.concatenate((first, [len(keys)])))
    of_row = np.repeat(size, size)
    left, right = [], []
    for step in range(1, small):
        a, b = np.arange(len(keys) - step), np.arange(step, len(keys))
        same = (keys[a] == keys[b]) & (of_row[a] <= small)
        a, b = a[same], b[same]
        close = distances(fps[a], fps[b]) <= max_bits
        left.append(fps[a[close]])
        right.append(fps[b[close]])
    for at, n in zip(first[size > small].tolist(), size[size > small].tolist()):
        members = fps[at:at + n]
        tree = np.array(bucket_forest(members, max_bits), dtype=np.int64).reshape(-1, 2)
        left.append(members[tree[:, 0]])
        right.append(members[tree[:, 1]])
    return np.concatenate(left), np.concatenate(right)


def _links_of_buckets(keyed: DataFrame, key_cols: list[str], max_bits: int) -> DataFrame:
    """Links inside the buckets of a (key..., fp) table; buckets stream through sorted partitions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held_fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def emit(keys, fps):
            left, right = _bucket_links(keys, fps, max_bits)
            pairs = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(p.view(np.int64)) for p in pairs], names=["a", "b"])

        for batch in batches:
            keys = np.concatenate((held_keys, batch.column("key").to_numpy()))
            fps = np.concatenate((held_fps, batch.column("fp").to_numpy().view(np.uint64)))
            if not len(keys):
                continue
            done = int(np.searchsorted(keys, keys[-1]))  # the last bucket may go on in the next batch
            if done:
                yield emit(keys[:done], fps[:done])
            held_keys, held_fps = keys[done:], fps[done:]
        if len(held_keys):
            yield emit(held_keys, held_fps)

    key = F.xxhash64(*key_cols) if len(key_cols) > 1 else F.col(key_cols[0])
    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.select(key.alias("key"), "fp").repartition(parts, "key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(run, "a long, b long")


def fingerprint_links(distinct_fps: DataFrame, max_bits: int = MAX_BITS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) within ``max_bits`` bits, enough of
    them that their components are those of all such links."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the Golay keys find pairs of at most 3 differing bits")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            for at in range(0, len(fps), 4096):
                part = fps[at:at + 4096]
                rows, keys = fuzzy_keys(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], names=["key", "fp"])

    keyed = distinct_fps.select("fp").mapInArrow(expand, "key long, fp long")
    counts = keyed.groupBy("key").count().filter("count > 1")
    counts = materialise(counts.select("key", (F.col("count") > bucket_limit).alias("large")), "simhash-keys")
    shared = materialise(keyed.join(counts, "key"), "simhash-shared")
    links = _links_of_buckets(shared.filter("not large"), ["key"], max_bits)
    quarter = F.explode(F.sequence(F.lit(0), F.lit(3)))
    piece = F.expr("shiftrightunsigned(fp, 16 * q) & 65535L")
    split = shared.filter("large").select("key", "fp", quarter.alias("q")).withColumn("piece", piece)
    return links.union(_links_of_buckets(split, ["key", "q", "piece"], max_bits)).distinct()


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS,
                    seed: int = SEED, max_bits: int = MAX_BITS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """One row per input row: ``_row``, ``id``, ``fp``, ``component_id`` (the smallest id
    reachable) and ``root``, a fingerprint that names the class."""
    prints = materialise(fingerprints(docs, id_col, text_col, shingle, seed), "simhash-prints")
    distinct = materialise(prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    links = materialise(fingerprint_links(distinct, max_bits, bucket_limit), "simhash-links")
    release(docs.sparkSession)
    roots = connected_components(links, "a", "b").select(F.col("node").alias("fp"), "root")
    named = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = materialise(named, "simhash-roots")
    least = materialise(named.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-classes")
    classes = materialise(named.join(least, "root").select("fp", "component_id", "root"), "simhash-labels")
    return prints.join(classes, "fp").select(ROW, "id", "fp", "component_id", "root")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id (of equal ids, the first in the
    input); all columns are kept as they are."""
    docs = stable(docs)
    found = materialise(simhash_classes(docs, id_col, text_col, **options), "simhash-members")
    best = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", ROW)).alias("best"))
    kept = materialise(best.select(F.col(f"best.{ROW}").alias(ROW)), "simhash-kept")
    # the rows that go are far fewer than those that stay
    return drop_rows(docs, found.join(kept, ROW, "left_anti"), "simhash-dropped")
