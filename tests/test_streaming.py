"""Online recall: stream = batch, for one and several micro-batches; replay adds nothing."""

import uuid

from pyspark.sql import functions as F

from newsloom.streaming import online as ON

SIM_ROWS = [(100, 7, 1), (100, 8, 2), (101, 7, 1), (101, 9, 2), (102, 5, 1)]


def _msgs(spark, events):
    rows = [(f"2024-01-0{d} 10:00:00", "", ch, (str(aid), "C2", act, str(uid))) for (d, uid, aid, ch, act) in events]
    ua = spark.createDataFrame(rows, "actionTime string, readTime string, channelId int, "
                                     "param struct<articleId:string, algorithmCombine:string, action:string, "
                                     "userId:string>")
    return ON.click_messages(ua)


def _run(spark, tmp_path, files):
    src = str(tmp_path / f"src-{uuid.uuid4().hex[:6]}")
    for i, f in enumerate(files):
        f.coalesce(1).write.mode("overwrite").text(f"{src}/part{i}")
    store, ckpt = str(tmp_path / f"store-{uuid.uuid4().hex[:6]}"), str(tmp_path / "ckpt" / uuid.uuid4().hex[:6])
    hist = spark.createDataFrame([(1, 3, 8, "2024-01-01")], "user_id long, channel_id int, article_id long, "
                                                            "version_ts string")
    ON.seed_history(hist, store)
    sim = spark.createDataFrame(SIM_ROWS, "article_id long, similar_id long, rank int")
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").text(src)
    q = ON.start_online_recall(stream, sim, store, ckpt, available_now=True)
    q.awaitTermination()
    return store, ckpt, stream, sim


EVENTS = [(1, 1, 100, 3, "click"), (1, 1, 101, 3, "share"), (2, 2, 102, 4, "collect"), (2, 2, 100, 4, "read"),
          (3, 3, 100, 5, "exposure")]


def test_parse_filters_actions_and_bad_json(spark):
    m = _msgs(spark, EVENTS).unionByName(spark.createDataFrame([("{not json",)], "value string"))
    got = sorted((r.user_id, r.article_id, r.action) for r in ON.parse_clicks(m).collect())
    assert got == [(1, 100, "click"), (1, 101, "share"), (2, 102, "collect")]


def test_stream_equals_batch_one_and_many_batches(spark, tmp_path):
    batch = {(1, 3, 7), (1, 3, 9), (2, 4, 5)}                  # (1,3,8) is in the history
    store, *_ = _run(spark, tmp_path, [_msgs(spark, EVENTS)])
    one = {tuple(r) for r in ON.read_recall(spark, store).select("user_id", "channel_id", "article_id").collect()}
    assert one == batch
    files = [_msgs(spark, [e]) for e in EVENTS]
    store2, ckpt2, stream, sim = _run(spark, tmp_path, files)
    rec = ON.read_recall(spark, store2)
    assert {tuple(r) for r in rec.select("user_id", "channel_id", "article_id").collect()} == batch
    assert rec.where(F.col("batch") >= 0).select("batch").distinct().count() >= 2
    # restart from the same checkpoint: nothing new to process, nothing duplicated
    n = rec.count()
    q = ON.start_online_recall(stream, sim, store2, ckpt2, available_now=True)
    q.awaitTermination()
    assert ON.read_recall(spark, store2).count() == n


def test_replay_before_commit_loses_nothing(spark, tmp_path):
    """A batch that has written its recall and history but was not committed runs again."""
    store = str(tmp_path / "replay-store")
    ON.seed_history(spark.createDataFrame([(1, 3, 8, "2024-01-01")], "user_id long, channel_id int, article_id long, "
                                                                     "version_ts string"), store)
    sim = spark.createDataFrame(SIM_ROWS, "article_id long, similar_id long, rank int")
    write = ON.make_batch_writer(sim, store)
    first, second = _msgs(spark, EVENTS[:1]), _msgs(spark, EVENTS)

    def stored():
        return sorted((r.batch, r.user_id, r.channel_id, r.article_id) for r in ON.read_recall(spark, store).collect())

    write(first, 0)
    write(second, 1)
    once = stored()
    assert once == [(0, 1, 3, 7), (1, 1, 3, 9), (1, 2, 4, 5)]
    write(second, 1)
    assert stored() == once
    write(first, 0)
    assert stored() == once
    write(spark.createDataFrame([], "value string"), 1)        # an empty replay clears its rows
    assert stored() == once[:1]


def test_hot_articles_topk(spark):
    clicks = spark.createDataFrame([(1, 5), (1, 5), (1, 6), (2, 7)] + [(1, 8)] * 3, "channel_id int, article_id long")
    got = [(r.channel_id, r.article_id, r.rank) for r in ON.hot_articles(clicks, k=2).orderBy("channel_id", "rank")
           .collect()]
    assert got == [(1, 8, 1), (1, 5, 2), (2, 7, 1)]


def test_online_recall_query_keeps_a_part_of_many_files_in_one_batch(spark, tmp_path, monkeypatch):
    import duckdb

    from newsloom.plans import catalog, oracle
    from tools.compare import TABLES, frame_hash
    sf_dir = "/root/testdata/sf0.001"
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: str(tmp_path / name))
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        found = catalog.q_online_recall(spark, sf_dir)
        got = frame_hash(found.columns, list(map(tuple, found.collect())))
    finally:
        spark.conf.set(name, before)
    assert all(len(list(p.glob("*.parquet"))) > 1 for p in (tmp_path / "online-events").iterdir())
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    wanted = con.execute(oracle.ORACLE["online_recall"])
    assert got == frame_hash([d[0] for d in wanted.description], wanted.fetchall())


def _clicks(spark, rows):
    """Messages of (day, hour, article) clicks of user 1 in channel 3."""
    rows = [(f"2024-01-{d:02d} {h:02d}:00:00", "", 3, (str(a), "C2", "click", "1")) for d, h, a in rows]
    return ON.click_messages(spark.createDataFrame(rows, "actionTime string, readTime string, channelId int, "
                             "param struct<articleId:string, algorithmCombine:string, action:string, userId:string>"))


def test_history_store_of_many_batches_reads_few_files(spark, tmp_path):
    store = str(tmp_path / "long")
    ON.seed_history(spark.createDataFrame([(0, 1, 999, "v")], "user_id long, channel_id int, article_id long, version_ts string"), store)
    want = {(0, 1, 999)}
    most = 0
    for batch in range(200):
        history = ON.HistoryStore(spark, store, compact_every=20)
        history.compact(batch)
        folders = list((tmp_path / "long" / "history").glob("batch=*"))
        most = max(most, len(folders))
        target = tmp_path / "long" / "history" / f"batch={batch}"
        target.mkdir()  # written without a Spark job: 200 of them would take minutes
        import pandas as pd
        pd.DataFrame({"user_id": [batch % 7], "channel_id": pd.array([1], dtype="int32"), "article_id": [batch // 2],
                      "version_ts": [f"online-{batch:012d}"]}).to_parquet(target / "p.parquet")
        want.add((batch % 7, 1, batch // 2))
    assert most <= 2 * 20 + 3
    history = ON.HistoryStore(spark, store, compact_every=20)
    got = history.read(200)
    assert {tuple(r) for r in got.select("user_id", "channel_id", "article_id").collect()} == want
    assert len(got.inputFiles()) <= 2 * 20 + 3 + ON.HISTORY_PARTS
    parts = [r[0] for r in spark.createDataFrame([(3,)], "user_id long").select(ON.history_part(F.col("user_id"))).collect()]
    mine = {tuple(r) for r in history.read(200, parts).select("user_id", "channel_id", "article_id").collect() if r[0] == 3}
    assert mine == {w for w in want if w[0] == 3}
    # a replay of the batch that compacted sees the same history, and compacts nothing again
    assert not history.compact(199) and len(history.snapshots.commits()) == 2


def test_history_keeps_the_newest_versions(spark, tmp_path):
    store = ON.HistoryStore(spark, str(tmp_path / "bounded"), compact_every=1, max_versions=2)
    for batch in range(4):
        store.write(spark.createDataFrame([(1, 1, batch, f"v{batch}")], "user_id long, channel_id int, article_id long, "
                                                                         "version_ts string"), batch)
    assert store.compact(4)
    assert {r["version_ts"] for r in store.read(4).collect()} == {"v2", "v3"}


def test_compaction_leaves_the_recall_as_it_is(spark, tmp_path):
    sim = spark.createDataFrame(SIM_ROWS, "article_id long, similar_id long, rank int")
    found = []
    for every in (100, 1):
        store = str(tmp_path / f"every-{every}")
        ON.seed_history(spark.createDataFrame([(1, 3, 8, "v")], "user_id long, channel_id int, article_id long, version_ts string"), store)
        write = ON.make_batch_writer(sim, store, compact_every=every)
        for number in range(5):
            write(_msgs(spark, EVENTS[number:] + EVENTS[:1]), number)
            write(_msgs(spark, EVENTS[number:] + EVENTS[:1]), number)   # every batch is replayed
        found.append(sorted(map(tuple, ON.read_recall(spark, store).select("batch", "user_id", "channel_id", "article_id").collect())))
    assert found[0] == found[1] != []


def _hot(spark, tmp_path, files, lateness="2 days"):
    src, store, ckpt = (str(tmp_path / uuid.uuid4().hex[:8]) for _ in range(3))
    for i, f in enumerate(files):
        f.coalesce(1).write.text(f"{src}/part{i}")
        stream = spark.readStream.schema("value string").option("recursiveFileLookup", "true").text(src)
        ON.start_hot_counts(stream, store, ckpt, lateness=lateness, available_now=True).awaitTermination()
    again = spark.readStream.schema("value string").option("recursiveFileLookup", "true").text(src)
    before = ON.hot_counts(spark, store).count()
    ON.start_hot_counts(again, store, ckpt, lateness=lateness, available_now=True).awaitTermination()  # a restart adds nothing
    rows = ON.hot_counts(spark, store).collect()
    assert len(rows) == before
    return {(r["window_start"].day, r["article_id"]): r["clicks"] for r in rows}


def test_hot_counts_stream_equals_batch_and_drops_late_rows(spark, tmp_path):
    rows = [(1, 5, 7), (1, 6, 7), (1, 23, 8), (2, 0, 7), (3, 1, 9), (3, 2, 9)]
    want = {(1, 7): 2, (1, 8): 1, (2, 7): 1, (3, 9): 2}
    assert _hot(spark, tmp_path, [_clicks(spark, rows)]) == want
    assert _hot(spark, tmp_path, [_clicks(spark, rows[:2]), _clicks(spark, rows[2:])]) == want
    # day 20 moves the watermark on: a click of day 2 comes too late, one of day 19 does not
    late = _hot(spark, tmp_path, [_clicks(spark, rows), _clicks(spark, [(20, 5, 7)]), _clicks(spark, [(2, 1, 7), (19, 1, 7)])])
    assert late == want | {(20, 7): 1, (19, 7): 1}


def test_new_articles_stream_equals_batch(spark, tmp_path):
    rows = [(c, a, f"2024-01-0{1 + a % 9} 00:00:0{c}") for c in (1, 2) for a in range(30)]
    schema = "channel_id int, article_id long, update_time string"
    frame = spark.createDataFrame(rows, schema).withColumn("update_time", F.to_timestamp("update_time"))
    want = sorted(map(tuple, ON.new_articles(frame, 5).collect()))
    src, store, ckpt = (str(tmp_path / f"new-{x}") for x in ("src", "store", "ckpt"))
    for part in range(3):
        frame.where(F.col("article_id") % 3 == part).coalesce(1).write.parquet(f"{src}/p{part}")
        stream = spark.readStream.schema(frame.schema).option("recursiveFileLookup", "true").parquet(src)
        ON.start_new_articles(stream, store, ckpt, k=5, available_now=True).awaitTermination()
    assert sorted(map(tuple, ON.new_lists(spark, store).select("channel_id", "article_id", "update_time", "rank").collect())) == want
