"""Spelling variant grouping with PartEnum signatures.

Words are near if one inserted, deleted or replaced letter turns one into the other. Seen as letter
multisets (binary vectors with one dimension for the first 'a', one for the second 'a', and so on), near
words differ in at most two dimensions. PartEnum: the dimensions are dealt into ``parts`` partitions; two
differences spoil at most two of them, so for one choice at least of ``parts - 2`` partitions both words
agree on all of them. Every such choice gives a signature, and words that share one are joined.

The join key also holds the words' length class and a stretch of letters, for the edit spoils at most one
of three: before it all letters agree counted from the start, behind it counted from the end. With ``L``
the shorter length and ``a = L // 3``, the words agree on their first ``L - a`` letters (edit in the last
third), on their last ``L - a`` (first third), or on their first and last ``a``. A word takes part in
the classes ``L`` = its length and its length less one. Candidates are verified letter by letter. A pair is
met under several keys; it counts under the first kind of stretch and the first choice of partitions that
agree, so no pair is kept twice and pairs need no shuffle: each side's near words are aggregated where they
are met.

Words are counted per task before anything is shuffled; the join is a sort-merge join that AQE splits where
a key is hot. A word's form has at least ``ratio`` times its count, so a chain of forms ends after few steps;
roots are found by doubling the reach of each word's pointer.

Defined results: a null text has no words; a null id is hashed as an empty string; repeated rows count
each; words without near ones have no form and are their own root; an empty table gives an empty result.
Words of any length take part. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import discard, materialise

RUN = re.compile("[a-zÀ-ÿ]+")
MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
#: One of so many runs (by a hash of document and run) loses a letter.
DELETE_ONE_IN = 31
#: Letters that one edit changes in a multiset, and partitions of the dimensions.
DISTANCE, PARTS = 2, 3
#: Words counted in a task before their counts are handed on; letters handled at once.
HELD_WORDS, BLOCK_LETTERS = 200_000, 1 << 21


def lowered_runs(text: str | None) -> list[str]:
    """Maximal runs of letters, A-Z lower-cased."""
    return RUN.findall((text or "").encode().lower().decode())


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, delete_one_in: int = DELETE_ONE_IN) -> DataFrame:
    """``word``, ``n``: words of ``min_length`` letters that occur ``min_count`` times. The crc32 of
    ``<id>:<run>`` decides whether a run loses a letter, and which."""
    def counted(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                          names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for name, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                seed = zlib.crc32(f"{name}:".encode())
                for word, n in Counter(r for r in lowered_runs(text.as_py()) if len(r) >= min_length).items():
                    h = zlib.crc32(word.encode(), seed)
                    if h % delete_one_in == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                    held[word] += n
                if len(held) >= HELD_WORDS:
                    yield counted(held)
                    held.clear()
        if held:
            yield counted(held)

    source = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                         F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(
        F.col("n") >= min_count)


def mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def partition_bits(letters: np.ndarray, parts: int) -> np.ndarray:
    """The vector of each word (row), projected on every partition and hashed to ``64 // parts`` bits:
    one number a word, partition 0 in the lowest bits."""
    rows, length = letters.shape
    ordered = np.sort(letters, axis=1).astype(np.uint64)
    place = np.arange(length)
    new = np.ones((rows, length), dtype=bool)
    new[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    nth = (place - np.maximum.accumulate(np.where(new, place, 0), axis=1)).astype(np.uint64)  # 0 for a letter's first
    owner = (ordered + nth) % np.uint64(parts)
    dimension = mixed(((ordered << np.uint64(32)) | nth) + np.uint64(1))
    bits = 64 // parts
    out = np.zeros(rows, dtype=np.uint64)
    for k in range(parts):
        total = np.where(owner == k, dimension, np.uint64(0)).sum(axis=1, dtype=np.uint64)
        out |= (mixed(total + np.uint64(k)) >> np.uint64(64 - bits)) << np.uint64(bits * k)
    return out


def stretch_hash(letters: np.ndarray, salt: int) -> np.ndarray:
    weights = mixed(np.arange(1, letters.shape[1] + 1, dtype=np.uint64)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return mixed((letters.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64) + np.uint64(salt))


def choices(parts: int) -> list[int]:
    """Bit masks of all choices of ``parts - DISTANCE`` partitions."""
    return [sum(1 << k for k in c) for c in combinations(range(parts), parts - DISTANCE)]


def signature_rows(letters: np.ndarray, parts: int) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """(length class, kind of stretch, choice, key, partition bits) of words of one length."""
    length = letters.shape[1]
    packed = partition_bits(letters, parts)
    bits = 64 // parts
    for shorter in (length, length - 1):
        a = shorter // 3
        b = shorter - a
        stretches = (letters[:, :b], letters[:, length - b:],
                     np.concatenate((letters[:, :a], letters[:, length - a:]), axis=1))
        for kind, stretch in enumerate(stretches):
            held = stretch_hash(stretch, shorter * 3 + kind)
            for choice in choices(parts):
                mask = sum(((1 << bits) - 1) << (bits * k) for k in range(parts) if choice >> k & 1)
                with np.errstate(over="ignore"):
                    key = mixed(held + mixed((packed & np.uint64(mask)) + np.uint64(choice)))
                yield shorter, kind, choice, key, packed


def signatures(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """``key`` and the word's own columns, once for every length class, kind of stretch and choice."""
    names = ["key", "class", "kind", "choice", "bits", "word", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, n = batch.column("word"), batch.column("n")
            raw = word.to_pylist()
            sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
            for length in np.unique(sizes):
                mine = np.flatnonzero(sizes == length)
                step = max(1, BLOCK_LETTERS // max(1, int(length)))
                for at in range(0, len(mine), step):
                    some = mine[at:at + step]
                    joined = "".join(raw[i] for i in some)
                    letters = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).reshape(len(some), int(length))
                    taken = pa.array(some)
                    for shorter, kind, choice, key, packed in signature_rows(letters, parts):
                        same = len(some)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(key.view(np.int64)), pa.array(np.full(same, shorter, np.int32)),
                             pa.array(np.full(same, kind, np.int8)), pa.array(np.full(same, choice, np.int8)),
                             pa.array(packed.view(np.int64)), word.take(taken), n.take(taken)], names=names)

    return words.select("word", "n").mapInArrow(
        run, "key long, class int, kind byte, choice byte, bits long, word string, n long")


def _first_choice(agreeing: Column, parts: int) -> Column:
    """The lowest ``parts - DISTANCE`` of the agreeing partitions, as a mask; -1 if they are fewer."""
    def lowest(mask: int) -> int:
        held = [k for k in range(parts) if mask >> k & 1][:parts - DISTANCE]
        return sum(1 << k for k in held) if len(held) == parts - DISTANCE else -1

    return F.element_at(F.array(*[F.lit(lowest(m)) for m in range(1 << parts)]), agreeing + 1)


def near_words(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """``word``, ``n_near`` and ``best`` (count, negated, and spelling of the most frequent near word;
    of equal ones the smallest in code-point order) of every word that has a near one."""
    keys = materialise(signatures(words, parts), "spelling-keys")
    a, b = keys.alias("a"), keys.alias("b")
    shorter = F.col("a.class")
    third = F.floor(shorter / 3).cast("int")
    rest = shorter - third

    def same(cut) -> Column:
        return cut(F.col("a.word")) == cut(F.col("b.word"))

    ends = same(lambda w: F.left(w, third)) & same(lambda w: F.right(w, third))
    start, end = same(lambda w: F.left(w, rest)), same(lambda w: F.right(w, rest))
    first_kind = F.when(start, 0).when(end, 1).when(ends, 2)
    bits = 64 // parts
    differ = F.col("a.bits").bitwiseXOR(F.col("b.bits"))
    agreeing = sum((F.when(F.shiftrightunsigned(differ, bits * k).bitwiseAND((1 << bits) - 1) == 0, 1 << k).otherwise(0)
                    for k in range(parts)), F.lit(0))
    met = ((F.col("a.key") == F.col("b.key")) & (shorter == F.col("b.class"))
           & (F.col("a.kind") == F.col("b.kind")) & (F.col("a.choice") == F.col("b.choice"))
           & (F.col("a.word") < F.col("b.word"))
           # two words of the longer length meet in their own class
           & ((F.char_length("a.word") == shorter) | (F.char_length("b.word") == shorter)))
    pairs = a.join(b.hint("merge"), met).filter(
        (F.col("a.kind") == first_kind) & (F.col("a.choice") == _first_choice(agreeing.cast("int"), parts))
        & (F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1))

    def side(x: str, y: str) -> Column:
        return F.struct(F.col(f"{x}.word").alias("word"), F.struct((-F.col(f"{y}.n")).alias("less"),
                                                                   F.col(f"{y}.word").alias("form")).alias("other"))

    found = pairs.select(F.inline(F.array(side("a", "b"), side("b", "a"))))
    found = materialise(found.groupBy("word").agg(F.count("*").alias("n_near"), F.min("other").alias("best")),
                        "spelling-near")
    discard(keys)
    return found


def chain_ends(links: DataFrame) -> DataFrame:
    """``word``, ``root``: where the chain ``word -> form`` of each word ends. ``links`` has no loops."""
    links = materialise(links.select("word", F.col("form").alias("root")), "spelling-links-0")
    for k in range(1, 64):
        on = links.select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = links.join(on, F.col("root") == F.col("at"), "left")
        step = materialise(moved.select("word", F.coalesce("next", "root").alias("root"),
                                        F.col("next").isNotNull().alias("moved")), f"spelling-links-{k}")
        discard(links)
        links = step
        if step.filter("moved").isEmpty():
            break
    return links.select("word", "root")


def variant_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO,
                   parts: int = PARTS, **options) -> DataFrame:
    """One row per word: ``word``, ``n``, ``n_near``, ``form`` and ``form_n`` (the most frequent near word, if it
    has ``ratio`` times the count), ``root`` (the end of the chain of forms)."""
    words = materialise(word_counts(docs, id_col, text_col, **options), "spelling-words")
    near = near_words(words, parts)
    better = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    known = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(better, F.col("best.form")).alias("form"), F.when(better, -F.col("best.less")).alias("form_n"))
    known = materialise(known, "spelling-known")
    roots = chain_ends(known.filter(F.col("form").isNotNull()))
    return known.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
