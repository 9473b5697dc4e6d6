"""Language identification with a bidirectional gated recurrent network over bytes.

A text is lower-cased and cut at bytes that are no letters (ASCII letters and all bytes of other
scripts count). The network reads the bytes of each word in both directions, and labels every
position with a probability for each language; a document's probabilities are the mean over all
its positions. Equal words get equal labels, so a task runs the network once per different word.

Training is numpy backpropagation through time on the driver. Its input is a sample of rows: about
``sample_rows`` labelled rows (those with the smallest hashed ids) are read whole, their words are
counted per language on the executors, and all (word, language) pairs are collected, so every
language with a word in the sample is learned. Targets are the languages' shares of a word, with
languages weighted alike.

Defined results: null texts and texts without a letter get ``und`` and score 0; so does every text
if no labelled row may be learned from; rows whose label is null are not learned from; a null id is
treated as the empty string when rows are dealt into learning and held-out ones; repeated rows get
the same answer each; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm import anchors
from newsloom.llm.common import ROW, drop_rows, materialise, stable, with_all_columns, with_row_id

UNKNOWN = "und"
SAMPLE_ROWS = 3000
HIDDEN, STEPS, BATCH, RATE, SEED = 16, 200, 256, 0.01, 7
#: Longer words are read in pieces of this many bytes.
WORD_BYTES = 24
PIECE_BYTES = 1 << 20
CACHE_WORDS = 400_000
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class ByteNetwork:
    """Two gated recurrent units (left to right, right to left) and a softmax over both states."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(languages: list[str], hidden: int, rng: np.random.Generator) -> ByteNetwork:
        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        weights = {}
        for way in ("ahead", "back"):
            weights[f"input_{way}"] = normal(256, 3 * hidden, scale=0.3)
            weights[f"state_{way}"] = normal(hidden, 3 * hidden, scale=hidden ** -0.5)
        weights["out"] = normal(2 * hidden, len(languages), scale=hidden ** -0.5)
        weights["bias"] = np.zeros(len(languages), dtype=np.float32)
        return ByteNetwork(languages, weights)

    def _read(self, x: np.ndarray, way: str, trace: list | None) -> np.ndarray:
        """States after each of the steps of x (steps, words)."""
        inputs, state = self.weights[f"input_{way}"], self.weights[f"state_{way}"]
        n = state.shape[0]
        h = np.zeros((x.shape[1], n), dtype=np.float32)
        states = np.empty((*x.shape, n), dtype=np.float32)
        for t in range(len(x)):
            gx, gh = inputs[x[t]], h @ state
            gates = _sigmoid(gx[:, :2 * n] + gh[:, :2 * n])
            update, reset = gates[:, :n], gates[:, n:]
            new = np.tanh(gx[:, 2 * n:] + reset * gh[:, 2 * n:])
            if trace is not None:
                trace.append((h, update, reset, new, gh[:, 2 * n:]))
            h = new + update * (h - new)
            states[t] = h
        return states

    def probabilities(self, x: np.ndarray, traces: tuple[list, list] | tuple[None, None] = (None, None)
                      ) -> tuple[np.ndarray, np.ndarray]:
        """Of every position of the words x (steps, words): probabilities, and the states."""
        ahead = self._read(x, "ahead", traces[0])
        back = self._read(x[::-1], "back", traces[1])[::-1]
        states = np.concatenate((ahead, back), axis=2)
        logits = states @ self.weights["out"] + self.weights["bias"]
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(axis=2, keepdims=True), states

    def gradients(self, x: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy of all positions against the words' target shares."""
        traces: tuple[list, list] = ([], [])
        p, states = self.probabilities(x, traces)
        delta = ((p - target) / (x.shape[0] * x.shape[1])).astype(np.float32)
        n = states.shape[2] // 2
        out = {"out": np.tensordot(states, delta, axes=((0, 1), (0, 1))), "bias": delta.sum(axis=(0, 1))}
        wanted = delta @ self.weights["out"].T
        for way, trace, letters, d_states in (("ahead", traces[0], x, wanted[:, :, :n]),
                                              ("back", traces[1], x[::-1], wanted[::-1, :, n:])):
            state = self.weights[f"state_{way}"]
            d_input = np.zeros_like(self.weights[f"input_{way}"])
            d_state = np.zeros_like(state)
            carried = np.zeros_like(d_states[0])
            for t in range(len(letters) - 1, -1, -1):
                h, update, reset, new, inner = trace[t]
                d = d_states[t] + carried
                d_new = d * (1 - update) * (1 - new * new)
                d_update = d * (h - new) * update * (1 - update)
                d_reset = d_new * inner * reset * (1 - reset)
                np.add.at(d_input, letters[t], np.concatenate((d_update, d_reset, d_new), axis=1))
                d_gate = np.concatenate((d_update, d_reset, d_new * reset), axis=1)
                d_state += h.T @ d_gate
                carried = d * update + d_gate @ state.T
            out[f"input_{way}"], out[f"state_{way}"] = d_input, d_state
        return out


def train(counts: list[tuple[str, bytes, int]], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH,
          rate: float = RATE, seed: int = SEED) -> ByteNetwork | None:
    """Fit a network to (language, word, count) rows; None without any."""
    languages = sorted({language for language, _, _ in counts})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    network = ByteNetwork.fresh(languages, hidden, rng)
    if len(languages) == 1:
        return network
    number = {g: i for i, g in enumerate(languages)}
    totals = np.zeros(len(languages))
    for language, _, n in counts:
        totals[number[language]] += n
    # the pairs by length and word; the shares of word w are those of the pairs first[w] to first[w + 1]
    pairs = sorted(counts, key=lambda c: (len(c[1]), c[1], c[0]))
    place = np.array([number[language] for language, _, _ in pairs])
    value = np.array([n for _, _, n in pairs]) / totals[place]
    first = [i for i, c in enumerate(pairs) if not i or c[1] != pairs[i - 1][1]]
    size = np.array([len(pairs[i][1]) for i in first])
    first = np.array([*first, len(pairs)])
    lengths = np.unique(size).tolist()
    begin = {k: int(np.searchsorted(size, k)) for k in lengths}
    end = {k: int(np.searchsorted(size, k, side="right")) for k in lengths}
    letters = {k: np.frombuffer(b"".join(pairs[i][1] for i in first[begin[k]:end[k]]), dtype=np.uint8).reshape(-1, k).T
               for k in lengths}
    total_share = np.add.reduceat(value, first[:-1])

    def shares(words: np.ndarray) -> np.ndarray:
        out = np.zeros((len(words), len(languages)))
        for row, w in enumerate(words):
            out[row, place[first[w]:first[w + 1]]] = value[first[w]:first[w + 1]]
        return out

    # rare words are taken more often than they occur: there are many, and they generalise
    weight = {k: np.sqrt(total_share[begin[k]:end[k]]) for k in lengths}
    chance = np.array([weight[k].sum() * k for k in lengths])
    moments = {name: (np.zeros_like(w), np.zeros_like(w)) for name, w in network.weights.items()}
    for step in range(1, steps + 1):
        k = lengths[rng.choice(len(lengths), p=chance / chance.sum())]
        picked = rng.choice(len(weight[k]), size=batch, p=weight[k] / weight[k].sum())
        target = shares(begin[k] + picked)
        grads = network.gradients(letters[k][:, picked], target / target.sum(axis=1, keepdims=True))
        pace = rate * min(1.0, 3 * (1 - step / (steps + 1)))
        for name, g in grads.items():
            m, v = moments[name]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            network.weights[name] -= (pace * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return network


def letters_only(text: str | None) -> bytes:
    return (text or "").lower().encode().translate(_LETTERS)


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a buffer, long words in pieces."""
    step = np.diff(np.concatenate(([0], (raw != 32).view(np.int8), [0])))
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    pieces = -(-(ends - starts) // WORD_BYTES)
    if len(pieces) and pieces.max() > 1:
        number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts, ends = np.repeat(starts, pieces) + number * WORD_BYTES, np.repeat(ends, pieces)
        ends = np.minimum(ends, starts + WORD_BYTES)
    return starts, ends


def word_counts(rows: DataFrame) -> DataFrame:
    """``lang, word, n`` of rows with ``lang`` and ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, bytes], int] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for word in letters_only(text).split():
                    for at in range(0, len(word), WORD_BYTES):
                        key = (lang, word[at:at + WORD_BYTES])
                        found[key] = found.get(key, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.binary()),
                 pa.array(list(found.values()), pa.int64())], names=["lang", "word", "n"])

    return rows.select("lang", "text").mapInArrow(run, "lang string, word binary, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n"))


#: Rows whose texts are labelled at once.
SLICE_ROWS = 1024


def held_out(id_col: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_rows: int = SAMPLE_ROWS, **options) -> ByteNetwork | None:
    order = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    usable = ~held_out(F.col(id_col)) & F.col(lang_col).isNotNull()
    last = (docs.filter(usable).select(order.alias("order")).orderBy("order").limit(sample_rows)
            .agg(F.max("order")).first()[0])
    if last is None:
        return None
    sample = docs.filter(usable & (order <= F.lit(last))).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counts = word_counts(sample).toArrow()
    return train(list(zip(*(counts.column(c).to_pylist() for c in ("lang", "word", "n")))), **options)


class Labeller:
    """Sums of the position probabilities of words, each different word computed once."""

    def __init__(self, network: ByteNetwork):
        self.network = network
        self.known = np.zeros(0, dtype=np.uint64)
        self.sums = np.zeros((0, len(network.languages)), dtype=np.float32)

    def _compute(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.zeros((len(starts), len(self.network.languages)), dtype=np.float32)
        lengths = ends - starts
        for k in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == k)
            for lo in range(0, len(at), 4096):
                part = at[lo:lo + 4096]
                p, _ = self.network.probabilities(raw[starts[part][None, :] + np.arange(k)[:, None]])
                out[part] = p.sum(axis=0)
        return out

    def word_sums(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        values = anchors.span_hashes(anchors.prefix_sums(raw), starts, ends)
        words, first, inverse = np.unique(values, return_index=True, return_inverse=True)
        if len(self.known) > CACHE_WORDS:
            self.known, self.sums = self.known[:0], self.sums[:0]
        place = np.minimum(np.searchsorted(self.known, words), max(0, len(self.known) - 1))
        new = self.known[place] != words if len(self.known) else np.ones(len(words), dtype=bool)
        if new.any():
            found = self._compute(raw, starts[first[new]], ends[first[new]])
            merged = np.concatenate((self.known, words[new]))
            order = np.argsort(merged)
            self.known, self.sums = merged[order], np.concatenate((self.sums, found))[order]
        return self.sums[np.searchsorted(self.known, words)][inverse]

    def label(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        totals = np.zeros((len(texts), len(self.network.languages)), dtype=np.float64)
        parts, rows, size = [], [], 0

        def flush() -> None:
            nonlocal size
            raw = np.frombuffer(b" ".join(parts) + b" ", dtype=np.uint8)
            starts, ends = word_spans(raw)
            if len(starts):
                bounds = np.cumsum([len(p) + 1 for p in parts])
                row = np.array(rows)[np.searchsorted(bounds, starts, side="right")]
                sums = self.word_sums(raw, starts, ends)
                for c in range(totals.shape[1]):
                    totals[:, c] += np.bincount(row, weights=sums[:, c], minlength=len(texts))
            parts.clear()
            rows.clear()
            size = 0

        for row, text in enumerate(texts):
            raw = letters_only(text)
            at = 0
            while at < len(raw):  # a long text goes in pieces that end between words
                end = min(at + PIECE_BYTES, len(raw))
                if end < len(raw):
                    cut = raw.rfind(b" ", at + PIECE_BYTES // 2, end)
                    end = cut if cut > 0 else end
                parts.append(raw[at:end])
                rows.append(row)
                size += end - at
                at = end
                if size >= PIECE_BYTES:
                    flush()
        if parts:
            flush()
        weight = totals.sum(axis=1)
        best = totals.argmax(axis=1)
        names, scores = [], []
        for row, text in enumerate(texts):
            if weight[row] > 0 and has_letter(text):
                names.append(self.network.languages[best[row]])
                scores.append(float(min(1.0, totals[row, best[row]] / weight[row])))
            else:
                names.append(UNKNOWN)
                scores.append(0.0)
        return names, scores


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             network: ByteNetwork | None = None, **options) -> DataFrame:
    """One row per input row: ``_row``, ``id``, ``held_out``, ``lang_pred``, ``score``."""
    network = network or fit(docs, id_col, text_col, lang_col, **options)
    source = with_row_id(docs, F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"),
                         F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(network) if network else None
        for batch in batches:
            names, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            if labeller:
                names, scores = [], []
                for at in range(0, batch.num_rows, SLICE_ROWS):
                    some = labeller.label(batch.column("text").slice(at, SLICE_ROWS).to_pylist())
                    names, scores = names + some[0], scores + some[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW), batch.column("id"), batch.column("held_out"), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64())], names=[ROW, "id", "held_out", "lang_pred", "score"])

    id_type = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"{ROW} long, id {id_type}, held_out boolean, lang_pred string, score double")


def without_letters(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``_row`` of the rows whose text is null or has no letter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = pa.array([not has_letter(text) for text in batch.column("text").to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(ROW).filter(bad)], names=[ROW])

    return with_row_id(docs, F.col(text_col).alias("text")).mapInArrow(run, f"{ROW} long")


def drop_unidentified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      network: ByteNetwork | None = None, **options) -> DataFrame:
    """``docs`` without the rows whose language is ``und``; a null ``lang_col`` gets the predicted
    language, all other columns are kept as they are. If there is no labelled row to learn from, the
    rows whose text is null or has no letter go."""
    docs = stable(docs)
    network = network or fit(docs, id_col, text_col, lang_col, **options)
    if network is None:
        return drop_rows(docs, without_letters(docs, text_col), "lang-rejected")
    told = identify(docs, id_col, text_col, lang_col, network).select(ROW, "lang_pred")
    told = materialise(told, "lang-told")
    unlabelled = with_row_id(docs, F.col(lang_col).isNull().alias("unlabelled")).filter("unlabelled").select(ROW)
    # the rows that go or get a label are few next to those that are kept as they are
    verdicts = told.join(unlabelled, ROW, "left_semi").union(told.filter(F.col("lang_pred") == UNKNOWN)).distinct()
    rows, columns = with_all_columns(docs)
    stated = dict(zip(docs.columns, columns))[lang_col]
    filled = F.coalesce(stated, F.col("lang_pred").cast(docs.schema[lang_col].dataType)).alias(lang_col)
    rows = rows.join(materialise(verdicts, "lang-verdicts"), ROW, "left").filter(
        F.col("lang_pred").isNull() | (F.col("lang_pred") != UNKNOWN))
    return rows.select(*[filled if c == lang_col else column for c, column in zip(docs.columns, columns)])
