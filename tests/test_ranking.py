"""TextRank of a batch at once, topic weights dealt before their topics are exploded, one pass of top-k."""

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from newsloom.operators import articles as A
from newsloom.operators import behavior as BH
from newsloom.operators.topk import top_k


def _plain(words, k, window=5, rounds=10, damping=0.85):
    out = {}
    for i, a in enumerate(words):
        for b in words[i + 1:i + window]:
            if a is not None and b is not None:
                for x, y in ((a, b), (b, a)):
                    out.setdefault(x, {}).setdefault(y, 0)
                    out[x][y] += 1
    if not out:
        return []
    total = {w: sum(c.values()) for w, c in out.items()}
    score = {w: 1 / len(out) for w in out}
    for _ in range(rounds):
        score = {w: 1 - damping + damping * sum(n / total[v] * score[v] for v, n in out[w].items()) for w in out}
    lo, hi = min(score.values()), max(score.values())
    scaled = {w: (x - lo / 10) / (hi - lo / 10) for w, x in score.items()}
    return sorted(scaled.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k]


def test_articles_are_ranked_side_by_side(monkeypatch):
    monkeypatch.setattr(A, "PIECE_TOKENS", 100)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)] + ["é", "ß", "日本"]
    texts = [[None if rng.random() < 0.2 else rng.choice(words) for _ in range(rng.choice((0, 1, 2, 7, 60, 150)))] for _ in range(80)]
    texts += [None, [], [None], ["a"], ["a", "a"], ["b", "a"], ["x", None, None, None, None, "y"]]
    lists, got, pieces = pa.array(texts, pa.list_(pa.string())), [[] for _ in texts], list(A._pieces(pa.array(texts, pa.list_(pa.string()))))
    assert len(pieces) > 10 and pieces[0][0] == 0 and pieces[-1][1] == len(texts) and all(a[1] == b[0] for a, b in zip(pieces, pieces[1:]))
    for at, to in pieces:
        owner, found, score = A.rank_lists(lists.slice(at, to - at), 8)
        for i, w, x in zip(owner.tolist(), found.to_pylist(), score.tolist()):
            got[at + i].append((w, x))
    for text, ranked in zip(texts, got):
        want = _plain(text or [], 8)
        assert [w for w, _ in ranked] == [w for w, _ in want]
        assert np.allclose([x for _, x in ranked], [x for _, x in want], atol=1e-12)
    assert A.rank_words(texts[5], 8) == got[5]


def test_topics_are_exploded_after_the_shuffle(spark):
    basic = spark.createDataFrame(
        [(1, 10, "2024-01-01 00:00:00"), (1, 11, "2024-01-03 00:00:00"), (1, 12, "2024-01-03 00:00:00"), (2, 10, "2024-01-02 00:00:00"),
         (None, 10, "2024-01-02 00:00:00"), (3, 99, "2024-01-02 00:00:00")], "user_id long, article_id long, action_time string"
    ).select("*", *[F.lit(True).alias(c) for c in ("shared", "clicked", "collected")], F.lit(2000).cast("long").alias("read_time"))
    topics = spark.createDataFrame([(10, 1, ["a", "b"]), (11, 1, ["b"]), (12, 2, ["b"]), (12, 1, ["b", "c"])], "article_id long, channel_id int, topics array<string>")
    found = BH.user_topic_weights(basic, topics, "2024-02-01 00:00:00")
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "Exchange" not in plan[:plan.index("Generate")]
    keys = sorted(((r["user_id"], r["channel_id"], r["topic"]) for r in found.collect()), key=str)
    assert keys == sorted([(1, 1, "a"), (1, 1, "b"), (1, 1, "c"), (1, 2, "b"), (2, 1, "a"), (2, 1, "b"), (None, 1, "a"), (None, 1, "b")], key=str)


def test_salted_top_k_ranks_once_where_groups_are_cut_before_the_shuffle(spark):
    rows = spark.range(400).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    windows = lambda f: len(re.findall(r"[+:]- Window \[", f._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]))
    once = top_k(rows, ["g"], [F.col("v").desc()], 5, salt=8)
    assert windows(once) == 1
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "3")
    try:
        twice = top_k(rows, ["g"], [F.col("v").desc()], 5, salt=8)
        assert windows(twice) == 2
        assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) and twice.count() == 15
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
