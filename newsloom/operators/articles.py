"""Article profile: sentence merge (J1/J2/F1), hourly scan (S8), tokens (M1),
vocabulary + IDF (A7/A8/A10), TF-IDF top-k (M2-M4/W1/J3), TextRank (M5/W2),
keyword weights (M6), topics (J5/A3) and the profile itself (M7)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import text as T
from newsloom.operators.topk import top_k

# Fixed value: CountVectorizer vocabSize of the reference. Terms past this rank have no IDF and
# are no keywords by definition; callers pass another size explicitly (``vocab_size``).
VOCAB_SIZE = 2000
#: Up to this many terms the vocabulary is broadcast; a larger one is joined like any table.
BROADCAST_VOCAB = 100_000
TOP_K = 20            # keywords kept per article (TF-IDF and TextRank)
TR_WINDOW = 5         # TextRank span: co-occurrence at token distance 1..4
TR_DAMPING = 0.85
TR_ROUNDS = 10
PIECE_TOKENS = 1 << 15 # tokens of the articles that are ranked at once


def merge_article_data(basic: DataFrame, content: DataFrame | None, channels: DataFrame) -> DataFrame:
    """J1 (inner on article_id) + J2 (left on channel_id) + F1 sentence.

    ``content=None`` means ``basic`` already carries the content column (one source
    table, no join). The channel dimension has one row per channel; AQE turns the
    join into a broadcast from the measured size, otherwise it stays a shuffle join.
    """
    if content is None:
        j = basic.select("article_id", "channel_id", "title", "content")
    else:
        j = basic.select("article_id", "channel_id", "title").join(content, "article_id")
    j = j.join(channels.select("channel_id", "channel_name"), "channel_id", "left")
    return j.select("article_id", "channel_id", "channel_name", "title", "content",
                    T.sentence(F.col("channel_name"), F.col("title"), F.col("content")).alias("sentence"))


def last_hour(articles: DataFrame, as_of: str, time_col: str = "update_time",
              status: int | None = 2) -> DataFrame:
    """Rows of the last full hour before ``as_of``, half-open
    [floor_hour(as_of) - 1h, floor_hour(as_of)), optionally with ``status``.
    The bounds are literals, so the predicate reaches the scan."""
    end = F.date_trunc("hour", F.to_timestamp(F.lit(as_of)))
    start = end - F.expr("INTERVAL 1 HOUR")
    cond = (F.col(time_col) >= start) & (F.col(time_col) < end)
    if status is not None:
        cond = cond & (F.col("status") == status)
    return articles.where(cond)


# --------------------------------------------------------------------------- tokens

def article_words(sentences: DataFrame, text_col: str = "sentence") -> DataFrame:
    """M1 tokens: strip tags, lower-case, letter runs of >= 2 (array per article)."""
    return sentences.select("article_id", "channel_id",
                            T.words(T.strip_html(F.col(text_col))).alias("words"))


def term_frequency(words: DataFrame, filtered: bool = True) -> DataFrame:
    """(article_id, channel_id, token, tf): bag of words per article.

    ``filtered`` applies the M1 rule (Latin tokens >= 3 letters, stopwords out);
    the stopword list is a fixed literal, so the test is a JVM-side IN-set.

    A row's tokens are counted where the row is read, and one row of lists per article is shuffled and
    sorted. Rows of the same article then follow each other and are added up, so no task holds a table
    of all the (article, token) it has seen.
    """
    kept = F.filter("words", T.keep_token) if filtered else F.col("words")
    types = {c: words.schema[c].dataType.simpleString() for c in ("article_id", "channel_id")}
    ids = f"article_id {types['article_id']}, channel_id {types['channel_id']}"
    lists = words.select("article_id", "channel_id", kept.alias("words")).mapInArrow(
        _count_rows, f"{ids}, tokens array<string>, tfs array<long>")
    keys = ["article_id", "channel_id"]
    return lists.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_add_rows, f"{ids}, token string, tf long")


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of the distinct words of every row and how often each is there."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            lists = part.column("words")
            coded = lists.flatten().dictionary_encode()
            owner, code, width = pc.list_parent_indices(lists).to_numpy(), coded.indices.to_numpy(), max(1, len(coded.dictionary))
            found, count = np.unique(owner.astype(np.int64) * width + code, return_counts=True)
            ends = pa.array(np.searchsorted(found, np.arange(part.num_rows + 1) * width).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("article_id"), part.column("channel_id"),
                 pa.ListArray.from_arrays(ends, coded.dictionary.take(pa.array(found % width))),
                 pa.ListArray.from_arrays(ends, pa.array(count.astype(np.int64)))],
                names=["article_id", "channel_id", "tokens", "tfs"])


def _add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a (article, channel, token) of rows sorted by article and channel; the rows of one article are added up."""
    names = ["article_id", "channel_id", "token", "tf"]
    key, held, types = None, None, None   # the last article seen: its rows may go on in the next batch

    def closed() -> Iterator[pa.RecordBatch]:
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([key[0]] * len(held), types[0]), pa.array([key[1]] * len(held), types[1]),
                                              pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        types = [batch.column(c).type for c in names[:2]]
        rows = list(zip(batch.column("article_id").to_pylist(), batch.column("channel_id").to_pylist()))
        alone = [i for i in range(1, len(rows) - 1) if rows[i - 1] != rows[i] != rows[i + 1]]
        for i in sorted(set(range(len(rows))) - set(alone)):
            if held is None or rows[i] != key:
                yield from closed()
                key, held = rows[i], Counter()
            for token, n in zip(batch.column("tokens")[i].as_py(), batch.column("tfs")[i].as_py()):
                held[token] += n
        if alone:
            part = batch.take(pa.array(alone))
            owner = pc.list_parent_indices(part.column("tokens"))
            yield pa.RecordBatch.from_arrays([part.column("article_id").take(owner), part.column("channel_id").take(owner),
                                              part.column("tokens").flatten(), part.column("tfs").flatten()], names=names)
    yield from closed()


def vocab_idf(tf: DataFrame, n_docs: int, vocab_size: int = VOCAB_SIZE) -> DataFrame:
    """A7 + A8 + A10 -> T9 (keyword, idf, index).

    Vocabulary: the ``vocab_size`` terms with the largest corpus count, ties by term;
    index is the rank (0-based). idf = ln((m + 1) / (df + 1)), m = number of documents.
    The top-N is a bounded TakeOrderedAndProject (N x partitions rows reach one task).
    """
    stats = tf.groupBy("token").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))
    return vocab_idf_of(stats, n_docs, vocab_size)


def vocab_idf_of(stats: DataFrame, n_docs: int, vocab_size: int = VOCAB_SIZE) -> DataFrame:
    """T9 from corpus counts (token, total, df)."""
    top = stats.orderBy(F.col("total").desc(), F.col("token").asc()).limit(vocab_size)
    w = Window.orderBy(F.col("total").desc(), F.col("token").asc())
    return top.select(
        F.col("token").alias("keyword"),
        F.log((F.lit(float(n_docs)) + 1.0) / (F.col("df") + 1.0)).alias("idf"),
        (F.row_number().over(w) - 1).cast("int").alias("index"),
    )


def _vocabulary_side(vocab: DataFrame, vocab_size: int) -> DataFrame:
    """The vocabulary as a join side: broadcast while its bound (``vocab_size`` rows) is small."""
    return F.broadcast(vocab) if vocab_size <= BROADCAST_VOCAB else vocab


def tfidf_top_k(tf: DataFrame, vocab: DataFrame, k: int = TOP_K, vocab_size: int = VOCAB_SIZE) -> DataFrame:
    """M2-M4 + W1 + J3: tf x idf over vocabulary terms, top ``k`` per article by
    tfidf desc then index asc, tfidf rounded to 4 places."""
    j = tf.join(_vocabulary_side(vocab.withColumnRenamed("keyword", "token"), vocab_size), "token")
    j = j.select("article_id", "channel_id", F.col("token").alias("keyword"), "index",
                 (F.col("tf") * F.col("idf")).alias("tfidf"))
    ranked = top_k(j, ["article_id"], [F.round("tfidf", 9).desc(), F.col("index").asc()], k)
    return ranked.select("article_id", "channel_id", "keyword", "index", F.round("tfidf", 4).alias("tfidf"))


# --------------------------------------------------------------------------- TextRank

def rank_words(words: list[str | None], k: int = TOP_K, window: int = TR_WINDOW, rounds: int = TR_ROUNDS,
               damping: float = TR_DAMPING) -> list[tuple[str, float]]:
    """``rank_lists`` of one article: its top ``k`` (word, score)."""
    _, found, score = rank_lists(pa.array([words], pa.list_(pa.string())), k, window, rounds, damping)
    return list(zip(found.to_pylist(), score.tolist()))


def rank_lists(lists: pa.Array, k: int = TOP_K, window: int = TR_WINDOW, rounds: int = TR_ROUNDS,
               damping: float = TR_DAMPING) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Weighted PageRank on the co-occurrence graph of each article (a list of words); (article, word, score)
    of the top ``k`` of each, best first. The graphs of all lists are ranked at once, side by side.

    A null is a rejected token that keeps its position. Two kept tokens at distance
    1..window-1 give an edge both ways: s(w) = (1-d) + d * sum_v c(w,v) / out(v) * s(v), start
    1/n, synchronous rounds, then scaled to (s - min/10) / (max - min/10). Ties by word.
    """
    coded = lists.flatten().dictionary_encode()
    row, kept = pc.list_parent_indices(lists).to_numpy(), coded.indices.is_valid().to_numpy(zero_copy_only=False)
    bits = max(1, len(coded.dictionary).bit_length())
    key = (row[kept].astype(np.int64) << bits) | coded.indices.drop_null().to_numpy()
    different, first, which = np.unique(key, return_index=True, return_inverse=True)
    n, turn = len(different), np.argsort(first)       # nodes are numbered as they come, article by article
    number = np.empty(n, np.int64)
    number[turn] = np.arange(n)
    owner, code = different[turn] >> bits, different[turn] & ((1 << bits) - 1)
    seq = np.full(len(row), -1, np.int64)
    seq[kept] = number[which]
    pairs = [(seq[:-d], seq[d:], (seq[:-d] >= 0) & (seq[d:] >= 0) & (row[:-d] == row[d:])) for d in range(1, window)]
    left = np.concatenate([a[there] for a, _, there in pairs])
    right = np.concatenate([b[there] for _, b, there in pairs])
    bits = max(1, n.bit_length())
    edge, count = np.unique(np.concatenate(((left << bits) | right, (right << bits) | left)), return_counts=True)
    src, dst = edge >> bits, edge & ((1 << bits) - 1)
    out = np.bincount(dst, weights=count, minlength=n)  # the graph is symmetric
    share = count / out[dst]
    nodes = np.flatnonzero(out)
    begin = np.flatnonzero(np.diff(owner[nodes], prepend=-1))   # of each article's nodes
    size = np.diff(np.append(begin, len(nodes)))
    score = np.zeros(n)
    score[nodes] = np.repeat(1.0 / size, size)
    base = round(1.0 - damping, 12)
    for _ in range(rounds if len(nodes) else 0):
        score = base + damping * np.bincount(src, weights=share * score[dst], minlength=n)
    score = score[nodes]
    if len(nodes):
        lo, hi = (np.repeat(f.reduceat(score, begin), size) for f in (np.minimum, np.maximum))
        score = (score - lo / 10.0) / (hi - lo / 10.0)
    place = np.empty(len(coded.dictionary), np.int64)
    place[pc.sort_indices(coded.dictionary).to_numpy()] = np.arange(len(place))
    owner, code = owner[nodes], code[nodes]
    order = np.lexsort((-score, owner))
    last = score[order[np.minimum(begin + k, begin + size) - 1]]
    order = order[score[order] >= np.repeat(last, size) - 1e-8]   # all that can be among the top k when rounded
    order = order[np.lexsort((place[code[order]], [-round(x, 9) for x in score[order].tolist()], owner[order]))]
    order = order[np.arange(len(order)) - np.searchsorted(owner[order], owner[order]) < k]
    return owner[order], coded.dictionary.take(pa.array(code[order])), score[order]


def _pieces(lists: pa.Array) -> Iterator[tuple[int, int]]:
    """Neighbouring rows (first, end) of at most ``PIECE_TOKENS`` tokens, or one row."""
    ends, at = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy()), 0
    while at < len(lists):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE_TOKENS, side="right")))
        yield at, to
        at = to


def textrank(sentences: DataFrame, k: int = TOP_K, window: int = TR_WINDOW, rounds: int = TR_ROUNDS,
             damping: float = TR_DAMPING, text_col: str = "sentence") -> DataFrame:
    """M5 + W2: (article_id, channel_id, keyword, textrank), top ``k`` per article.

    A graph never leaves its article, so each row is ranked where it is read: tokens by
    built-in expressions, the rounds on integer-indexed arrays in Arrow batches. There is no
    shuffle and nothing is written.
    """
    tokens = F.transform(T.words(F.col(text_col), T.WORD_ANY), lambda x: F.when(T.keep_token(x), x))
    rows = sentences.select("article_id", "channel_id", tokens.alias("words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in _pieces(batch.column("words")):
                part = batch.slice(at, to - at)
                owner, found, score = rank_lists(part.column("words"), k, window, rounds, damping)
                owner = pa.array(owner)
                yield pa.RecordBatch.from_arrays([part.column("article_id").take(owner), part.column("channel_id").take(owner), found, pa.array(score)],
                                                 names=["article_id", "channel_id", "keyword", "textrank"])

    types = {c: rows.schema[c].dataType.simpleString() for c in ("article_id", "channel_id")}
    return rows.mapInArrow(run, f"article_id {types['article_id']}, channel_id {types['channel_id']}, "
                                "keyword string, textrank double")


# --------------------------------------------------------------------------- profile

def keyword_weights(textrank_df: DataFrame, vocab: DataFrame, vocab_size: int = VOCAB_SIZE) -> DataFrame:
    """M6 = J4 (inner on keyword, Q3) + F20: weight = textrank x idf."""
    j = textrank_df.join(_vocabulary_side(vocab.select("keyword", "idf"), vocab_size), "keyword")
    return j.select("article_id", "channel_id", "keyword", (F.col("textrank") * F.col("idf")).alias("weight"))


def article_topics(tfidf_kw: DataFrame, textrank_kw: DataFrame, mode: str = "global") -> DataFrame:
    """J5 + A3 -> (article_id, topics).

    ``global`` (as coded in the reference): a TF-IDF keyword is a topic when it is a
    TextRank keyword of *any* article -- a left-semi join on the distinct keyword set,
    which avoids the keyword-only many-to-many blow-up. ``per_article``: when it is a
    TextRank keyword of the same article.
    """
    t = tfidf_kw.select("article_id", "keyword")
    if mode == "global":
        hit = t.join(textrank_kw.select("keyword").distinct(), "keyword", "left_semi")
    elif mode == "per_article":
        hit = t.join(textrank_kw.select("article_id", "keyword"), ["article_id", "keyword"], "left_semi")
    else:
        raise ValueError(mode)
    return hit.groupBy("article_id").agg(F.array_sort(F.collect_set("keyword")).alias("topics"))


def article_profile(weights: DataFrame, topics: DataFrame) -> DataFrame:
    """M7 = A2 + F13 + J6 -> T12 (article_id, channel_id, keywords map, topics).

    One struct per keyword is collected (Q3: keyword and weight never shift apart);
    keywords are unique per article, so map_from_entries sees no duplicate key.
    """
    kw = weights.groupBy("article_id").agg(
        F.min("channel_id").alias("channel_id"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("keyword", "weight")))).alias("keywords"))
    return kw.join(topics, "article_id").select("article_id", "channel_id", "keywords", "topics")
