"""Top-N by inner product with lists finished in the task: equal to all pairs, ids and channels travel along."""

import re

import numpy as np
from pyspark.sql import functions as F

from newsloom.operators import products as P
from newsloom.operators import recall as RC
from newsloom.sources import tables as S
from tests.conftest import SF001

SCHEMA = "id int, name long, vec array<float>, channels array<int>"


def _frame(spark, matrix, channels=lambda i: [i % 5]):
    return spark.createDataFrame([(i, 1000 + i, [float(x) for x in v], channels(i)) for i, v in enumerate(matrix)], SCHEMA)


def _vectors():
    rng = np.random.default_rng(3)
    items = rng.standard_normal((900, 6)).astype(np.float32)
    items[100:300] = items[0]          # ties, more than a list holds
    items[7] = 0
    users = rng.standard_normal((70, 6)).astype(np.float32)
    users[3], users[4] = 0, items[0]   # a user to whom all are equal, and one whose best all tie
    return users, items


def _all_pairs(users, items, k):
    score = (users.astype(np.float64)[:, None, :] * items.astype(np.float64)).sum(axis=2)
    return {(u, p): (int(i), float(score[u, i])) for u in range(len(users))
            for p, i in enumerate(np.lexsort((np.arange(len(items)), np.round(-score[u], 9)))[:k])}


def test_equal_to_all_pairs_with_ties_and_null_vectors(spark):
    users, items = _vectors()
    for options in ({}, {"block_users": 16}, {"chunk_items": 200, "block_users": 40}):
        found, _ = P.top_products(_frame(spark, users), _frame(spark, items), 50, 6, **options)
        rows = found.collect()
        got = {(r["user"], r["pos"]): (r["item"], r["score"]) for r in rows}
        assert len(rows) == len(got) and got == _all_pairs(users, items, 50)
        assert all(r["user_name"] == 1000 + r["user"] and r["item_name"] == 1000 + r["item"] and r["channels"] == [r["item"] % 5] for r in rows)


def test_fewer_items_than_asked_and_no_users(spark):
    users, items = _vectors()
    found, _ = P.top_products(_frame(spark, users[:2]), _frame(spark, items[:3]), 50, 6)
    assert {(r["user"], r["pos"]): (r["item"], r["score"]) for r in found.collect()} == _all_pairs(users[:2], items[:3], 50)
    assert P.top_products(_frame(spark, users[:0]), _frame(spark, items[:3]), 50, 6)[0].count() == 0


def test_kernel_takes_many_tiles():
    rng = np.random.default_rng(5)
    items = (rng.standard_normal((20000, 4)) * 0.2 + [1, 0, 0, 0]).astype(np.float32)
    users = items[:30] * np.float32(0.5)
    numbers = np.arange(len(items), dtype=np.int32)
    user, item, score = (held := P.Items(numbers, numbers.astype(np.int64), items, np.ones(len(items), np.int32), numbers)).best(users, 20)
    want = _all_pairs(users, items, 20)
    assert {(int(u), p % 20): (int(held.ids[i]), float(s)) for p, (u, i, s) in enumerate(zip(user, item, score))} == want


def test_als_lists_are_not_joined_row_by_row(spark):
    """The lists leave the tasks whole: no join, sort or window over them; channels still come as many times as there are."""
    model, uidx, aidx = RC.fit_als(S.purchase_clicks(spark, SF001), seed=7, max_iter=2)
    channels = S.item_channel(spark, SF001)
    twice = channels.unionByName(channels.where(F.col("article_id") % 2 == 0)).where(F.col("article_id") % 5 != 0)
    rows = RC.als_recall(model, uidx, aidx, twice, n=8)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("MapInArrow")]
    assert not re.search("Join|Window|Exchange", above), above
    recs, _ = RC.top_items(model, 8)
    joined = recs.join(uidx, "als_user_id").join(aidx, "als_article_id").join(twice, "article_id")
    columns = ["user_id", "channel_id", "article_id", "score", "pos"]
    assert rows.columns == columns
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, joined.select(*columns).collect()))
