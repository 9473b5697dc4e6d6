"""End-to-end jobs on sf0.001: every sink written, re-runs replace, the hourly run equals the full one."""

from pyspark.sql import functions as F

from newsloom.plans import jobs as J
from newsloom.sources import sinks as K
from newsloom.sources import tables as S
from newsloom.sources.versions import VersionedTable
from tests.conftest import SF001

AS_OF = "2024-02-01 00:00:00"
HOUR = "2024-01-31 13:10:00"
EMPTY_HOUR = "2024-03-01 00:00:00"


def _rows(df, *cols):
    return sorted(map(str, df.select(*cols).collect()))


def test_jobs_end_to_end_idempotent(spark, tmp_path):
    out = str(tmp_path / "warehouse")
    inp = J.Inputs.from_dir(spark, SF001)
    J.update_article_profile(inp, out, AS_OF)
    J.update_article_profile(inp, out, AS_OF)                # same run again: replaced, not appended
    run = J._run_id(AS_OF)
    prof = K.read_partition(spark, f"{out}/article_profile", "run", run).drop("run")
    n_prof = prof.count()
    assert n_prof > 0 and prof.select("article_id").distinct().count() == n_prof
    toxic = S.read_table(spark, SF001, "labels").where("toxic = 1").select(F.col("doc_id").alias("article_id"))
    assert prof.join(toxic, "article_id").count() == 0       # only reviewed articles
    vectors = K.read_partition(spark, f"{out}/article_vector", "run", run).drop("run")
    assert vectors.count() > 0 and vectors.where(F.size("articleVector") != 100).count() == 0

    # the hourly run gives the same rows as the full run for its articles
    hour = J._run_id(HOUR)
    assert J.update_article_profile(inp, out, HOUR, incremental=True) == {"run": hour}
    ids = K.read_partition(spark, f"{out}/article_data", "run", hour).select("article_id")
    assert 0 < ids.count() < 40
    for table, cols in (("tfidf_keywords_values", ("article_id", "keyword", "tfidf")),
                        ("textrank_keywords_values", ("article_id", "keyword", F.round("textrank", 9))),
                        ("article_profile", ("article_id", "topics", F.map_keys("keywords"))),
                        ("article_similar", ("article_id", "similar_id", "distance", "rank"))):
        full = K.read_partition(spark, f"{out}/{table}", "run", run).join(ids, "article_id", "left_semi")
        now = K.read_partition(spark, f"{out}/{table}", "run", hour).join(ids, "article_id", "left_semi")
        assert _rows(full, *cols) == _rows(now, *cols), table
    # the hour's articles and all others have the lists of a full run
    cols = ("article_id", "similar_id", F.round("distance", 6), "rank")
    full = K.read_partition(spark, f"{out}/article_similar", "run", run).drop("distance").withColumnRenamed("exact_distance", "distance")
    assert _rows(K.read_similar(spark, f"{out}/article_similar"), *cols) == _rows(full, *cols)
    assert J.update_article_profile(inp, out, EMPTY_HOUR, incremental=True)["articles"] == "none"

    log = str(tmp_path / "log")
    inp.user_action.write.partitionBy("dt").parquet(log)
    assert J.update_user_profile(inp, prof, out, AS_OF, log_path=log, dt="2030-01-01")["log"] == "none"
    J.update_user_profile(inp, prof, out, HOUR, log_path=log, dt="2024-01-15")
    day = VersionedTable(spark, f"{out}/user_article_basic").read(hour)
    assert day.select(F.substring("action_time", 1, 10)).distinct().collect() == [("2024-01-15",)]
    J.update_user_profile(inp, prof, out, AS_OF)
    basic = VersionedTable(spark, f"{out}/user_article_basic").read()
    partial = K.read_partition(spark, f"{out}/user_profile_partial", "run", run).drop("run")
    assert basic.count() > 0 and partial.count() > 0

    sim = K.read_partition(spark, f"{out}/article_similar", "run", run)
    hist = spark.createDataFrame([], "user_id long, channel_id int, article_id long, version_ts string")
    J.update_user_recall(inp, basic, sim, hist, out, AS_OF)
    rec = spark.read.parquet(f"{out}/cb_recall")
    n_rec = rec.count()
    assert set(r.source for r in rec.select("source").distinct().collect()) == {"als", "content"}
    written = spark.read.parquet(f"{out}/history_recall")
    assert written.count() == n_rec
    # the run again, with the history it has written itself: nothing is lost
    J.update_user_recall(inp, basic, sim, written.withColumn("version_ts", F.col("version_ts").cast("string")), out, AS_OF)
    assert spark.read.parquet(f"{out}/cb_recall").count() == n_rec
    J.update_ctr_feature(partial, prof, vectors, out, AS_OF)
    u = spark.read.parquet(f"{out}/ctr_feature_user")
    assert u.where(F.size("weights") != 10).count() == 0
    assert u.count() == partial.select("user_id").distinct().count() * 25
    assert spark.read.parquet(f"{out}/ctr_feature_article").where(F.size("features") != 1 + 10 + 100).count() == 0


def test_empty_rerun_clears_the_partition(spark, tmp_path):
    path = str(tmp_path / "sink")
    rows = spark.createDataFrame([(1, "a")], "k long, v string")
    K.write_run_partition(rows, path, "run", "r1")
    K.write_run_partition(rows, path, "run", "r2")
    K.write_run_partition(rows.limit(0), path, "run", "r1")
    assert [r.run for r in spark.read.parquet(path).collect()] == ["r2"]
    similar = spark.createDataFrame([(1, 1, 2, 0.5, 1), (1, 3, 3, 0.0, 1)],
                                    "channel_id int, article_id long, similar_id long, distance double, rank int")
    K.write_similar(similar, f"{path}-similar", "r1")
    assert spark.read.parquet(f"{path}-similar").count() == 1   # a self pair is no row
    K.write_similar(similar.limit(0), f"{path}-similar", "r1")
    assert spark.read.parquet(f"{path}-similar").count() == 0
