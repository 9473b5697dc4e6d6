"""Tiled exact search, list upkeep and pruned top-N against brute force in numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.operators import tiles as TL

SCHEMA = "article_id long, channel_id int, articleVector array<double>"


def clustered(n, dim=6, seed=0, spread=0.2):
    """Vectors of three channels (one with most rows) around few centres, with exact copies and a null."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim)) * 2
    rows = [(i, int(rng.choice([1, 1, 1, 1, 2, 3])), (centres[rng.integers(12)] + spread * rng.normal(size=dim)).tolist())
            for i in range(n)]
    rows += [(n + j, rows[j][1], rows[j][2]) for j in range(25)] + [(n + 30, 1, None), (n + 31, 9, rows[0][2])]
    return rows


def brute(rows, k, limit):
    rows = [r for r in rows if r[2] is not None]
    out = {}
    for i, channel, vec in rows:
        mine = []
        for j, other, w in rows:
            if j != i and other == channel:
                d = float(np.sqrt(((np.array(w) - np.array(vec)) ** 2).sum()))
                if d < limit:
                    mine.append((round(d, 9), j))
        out[i] = [j for _, j in sorted(mine)[:k]]
    return {i: x for i, x in out.items() if x}


def lists_of(df):
    out = {}
    for r in df.orderBy("article_id", "rank").collect():
        out.setdefault(r["article_id"], []).append(r["similar_id"])
    return out


@pytest.mark.parametrize("limit", [1.5, 0.4])
def test_similar_lists_are_the_true_ones(spark, limit):
    rows = clustered(400)
    v = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert lists_of(TL.similar_lists(v, 5, limit, tile_rows=16)) == brute(rows, 5, limit)


def test_far_tiles_are_not_sent(spark):
    rows = clustered(1500, dim=4, spread=0.05)
    v = spark.createDataFrame(rows, SCHEMA)
    named = TL._named(v, "article_id", "articleVector")
    found, counts = TL.best_partners(named, named, 5, TL.DISTANCE, 4, 2.0, tile_rows=16)
    c = counts.first()
    assert c["n_sent"] < 0.5 * c["n_pairs"]
    best = {}
    for r in found.orderBy("id", "rank").collect():
        best.setdefault(r["id"], []).append(r["partner"])
    assert best == brute(rows, 5, 2.0)


def test_chunks_of_a_large_group_are_merged(spark):
    rows = [(i, 1, v) for i, _, v in clustered(300) if v is not None]
    v = spark.createDataFrame(rows, SCHEMA)
    named = TL._named(v, "article_id", "articleVector")
    found, _ = TL.best_partners(named, named, 4, TL.DISTANCE, 6, 5.0, tile_rows=8, chunk_tiles=2)
    best = {}
    for r in found.orderBy("id", "rank").collect():
        best.setdefault(r["id"], []).append(r["partner"])
    assert best == brute(rows, 4, 5.0)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert TL.similar_lists(none, 5, 2.0).collect() == []
    one = spark.createDataFrame([(1, 1, [0.0, 1.0])], SCHEMA)
    assert TL.similar_lists(one, 5, 2.0).collect() == []


def test_hourly_updates_equal_a_full_run(spark):
    rows = clustered(240, seed=3)
    rng = np.random.default_rng(8)
    hours = [rows[:90], rows[90:100] + [rows[5][:2] + (rows[200][2],)], rows[100:], [(r[0], r[1], rng.normal(size=6).tolist()) for r in rows[:3]]]
    now, lists = {}, None
    for hour in hours:
        now.update({r[0]: r for r in hour})
        v = spark.createDataFrame(list(now.values()), SCHEMA)
        if lists is None:
            lists = TL.similar_lists(v, 4, 1.5, tile_rows=8)
        else:
            arrived = spark.createDataFrame([(r[0],) for r in hour], "article_id long")
            changed, replaced = TL.updated_lists(lists, v, arrived, 4, 1.5, tile_rows=8)
            lists = TL.replace_lists(lists, changed, replaced)
        lists = spark.createDataFrame(lists.collect(), lists.schema)
        assert lists_of(lists) == brute(list(now.values()), 4, 1.5)


def test_largest_inner_products(spark):
    rng = np.random.default_rng(4)
    users = [(i, 1, (rng.normal(size=5) * rng.choice([0.1, 1, 3])).tolist()) for i in range(60)] + [(60, 1, [0.0] * 5)]
    items = [(1000 + i, 1, (rng.normal(size=5) * rng.choice([0.1, 0.1, 0.1, 2])).tolist()) for i in range(300)]
    u, i = (spark.createDataFrame(x, "id long, group_id int, vec array<double>") for x in (users, items))
    found, counts = TL.best_partners(u, i, 7, TL.INNER, 5, tile_rows=16)
    got = {}
    for r in found.orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["partner"])
    want = {k: [j for _, j in sorted((-round(float(np.dot(v, w)), 9) + 0.0, j) for j, _, w in items)[:7]] for k, _, v in users}
    assert got == want
    c = counts.first()
    assert c["n_sent"] < c["n_pairs"]


def test_a_data_tile_is_sent_once_a_block(spark, monkeypatch):
    """Forty query tiles in two blocks meet forty data tiles: a tile travels for each block, not for each pair."""
    rng = np.random.default_rng(6)
    u, i = (spark.createDataFrame([(j, 1, rng.normal(size=3).tolist()) for j in range(320)], "id long, group_id int, vec array<double>")
            for _ in range(2))
    sent, send = [], TL._send
    monkeypatch.setattr(TL, "_send", lambda *a: sent.append(send(*a)) or sent[-1])
    found, counts = TL.best_partners(u, i, 3, TL.INNER, 3, tile_rows=8, block_tiles=24)
    users, items = ({r["id"]: r["vec"] for r in x.collect()} for x in (u, i))
    got = {}
    for r in found.orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["partner"])
    assert got == {k: [j for _, j in sorted((-round(float(np.dot(v, w)), 9) + 0.0, j) for j, w in items.items())[:3]]
                   for k, v in users.items()}
    c = counts.first()
    rest = sent[1].where("turn = 1")
    n_sent = c["n_sent"] - sent[0].where("turn = 1").selectExpr("sum(size(takers))").first()[0]
    assert rest.selectExpr("sum(size(takers))").first()[0] == n_sent and rest.count() <= 100 < n_sent


def test_farthest_below_the_limit(spark):
    rows = [(i, 1, v) for i, _, v in clustered(200) if v is not None]
    named = TL._named(spark.createDataFrame(rows, SCHEMA), "article_id", "articleVector")
    found, _ = TL.best_partners(named, named, 4, TL.FARTHEST, 6, 3.0, tile_rows=16, block_tiles=3)
    got = {}
    for r in found.orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["partner"])
    vecs = {i: np.array(v) for i, _, v in rows}
    want = {i: [j for _, j in sorted((-round(float(np.sqrt(((w - v) ** 2).sum())), 9), j) for j, w in vecs.items()
                                     if j != i and np.sqrt(((w - v) ** 2).sum()) < 3.0)[:4]] for i, v in vecs.items()}
    assert got == {i: x for i, x in want.items() if x}
