"""The four batch jobs of the reference's scheduler, as Spark jobs over tables.

Each job reads its inputs (DataFrames), computes one Catalyst plan per output and
writes it through an idempotent sink. Scheduling (every 1/2/3/4 hours) belongs
to the deployer; each job takes ``as_of`` instead of reading the clock.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators import articles as A
from newsloom.operators import behavior as BH
from newsloom.operators import features as FT
from newsloom.operators import recall as RC
from newsloom.operators import similarity as SIM
from newsloom.operators import tiles as TL
from newsloom.operators import vectors as VEC
from newsloom.operators import vocabulary as VO
from newsloom.operators.topk import latest_by_key
from newsloom.functions import text as T
from newsloom.session import write_once
from newsloom.sources import ingest as I
from newsloom.sources import sinks as K
from newsloom.sources import tables as S
from newsloom.sources.versions import VersionedTable


APPROVED = 2     # fixed value: status of a reviewed article


@dataclass
class Inputs:
    """Input tables of the jobs (T1-T7 and the rating source)."""
    article_basic: DataFrame
    article_content: DataFrame
    channels: DataFrame
    user_action: DataFrame
    user_profile: DataFrame
    ratings: DataFrame
    item_channel: DataFrame
    n_documents: int

    @classmethod
    def from_dir(cls, spark: SparkSession, sf_dir: str) -> "Inputs":
        basic = S.news_article_review(spark, sf_dir)
        return cls(basic, S.news_article_content(spark, sf_dir), S.news_channel(spark, sf_dir),
                   S.user_action(spark, sf_dir), S.user_profile(spark, sf_dir), S.purchase_clicks(spark, sf_dir),
                   S.item_channel(spark, sf_dir), basic.where(F.col("status") == APPROVED).count())


def _run_id(as_of: str) -> str:
    return as_of.replace(" ", "T").replace(":", "")


def _written(df: DataFrame, path: str, run: str) -> DataFrame:
    """Write one run of a table and read it back."""
    K.write_run_partition(df, path, "run", run)
    return K.read_partition(df.sparkSession, path, "run", run).drop("run")


def update_article_profile(inp: Inputs, out: str, as_of: str, incremental: bool = False,
                           vocab_size: int = A.VOCAB_SIZE) -> dict[str, str]:
    """Article profile job over approved articles: T8 sentences, T9 vocabulary, T10/T11 keywords,
    T12 profile, T13 Word2Vec article vectors, K1 similar articles.

    The full run builds everything and saves the word-vector model. ``incremental`` takes the
    articles of the last full hour (S8): the vocabulary follows from the stored counts and the
    hour's changes, the saved model is reused, topics look at the keyword tables of all runs. The lists of the new articles are searched among all
    articles, and older articles' lists that a new article enters or leaves are written
    again, so the lists in force are those of a full run. An hour without articles writes an empty T8 run and stops (P10).
    """
    run, spark = _run_id(as_of), inp.article_basic.sparkSession
    basic = A.last_hour(inp.article_basic, as_of, status=APPROVED) if incremental \
        else inp.article_basic.where(F.col("status") == APPROVED)
    sent = _written(A.merge_article_data(basic, inp.article_content, inp.channels), f"{out}/article_data", run)
    if sent.isEmpty():
        return {"run": run, "articles": "none"}
    tf = write_once(A.term_frequency(A.article_words(sent)), "term-frequency")
    state = _vocabulary_state(spark, out, run, tf, sent, incremental)
    vocab = _written(VO.vocabulary(state, vocab_size), f"{out}/idf_keywords_values", run)
    tfidf = _written(A.tfidf_top_k(tf, vocab, vocab_size=vocab_size), f"{out}/tfidf_keywords_values", run)
    tr_path = f"{out}/textrank_keywords_values"
    tr = _written(A.textrank(sent), tr_path, run)
    all_tr = spark.read.parquet(tr_path).drop("run") if incremental else tr
    prof = _written(A.article_profile(A.keyword_weights(tr, vocab, vocab_size), A.article_topics(tfidf, all_tr)),
                    f"{out}/article_profile", run)
    model_path, vec_path = f"{out}/models/word2vec", f"{out}/article_vector"
    if incremental:
        model = VEC.load_word2vec(model_path)
    else:
        words = A.article_words(sent).select("article_id", F.filter("words", lambda t: T.keep_token(t)).alias("words"))
        model = VEC.train_word2vec(words, seed=SIM.SEED)
        VEC.save_model(model, model_path)
    vectors = _written(VEC.article_vectors(prof, VEC.word_vectors(model)), vec_path, run)
    if incremental:
        known = latest_by_key(spark.read.parquet(vec_path).withColumn("run", F.col("run").cast("string")),
                              ["article_id"], ["run"]).drop("run")
        lists = write_once(K.read_similar(spark, f"{out}/article_similar", before=run), "similar-before")
        changed, replaced = TL.updated_lists(lists, known, vectors, SIM.TOP_K, SIM.THRESHOLD)
        changed = write_once(changed, "similar-changed")
        emptied = replaced.join(changed, "article_id", "left_anti")
        sim = changed.unionByName(emptied, allowMissingColumns=True)
    else:
        sim = TL.similar_lists(vectors, SIM.TOP_K, SIM.THRESHOLD)
    K.write_similar(sim, f"{out}/article_similar", run)
    return {"run": run}


def _vocabulary_state(spark: SparkSession, out: str, run: str, tf: DataFrame, sent: DataFrame, incremental: bool) -> DataFrame:
    """Corpus counts after this run, a versioned table. Commit n of it goes with the term counts in
    ``term_counts/commit=n``, written before; those of a run that died in between are never read and
    written again. A version is named ``run@n`` with the commit n of the full run that it builds on."""
    store = VersionedTable(spark, f"{out}/vocabulary_state")
    seen, before = store.last_number(), store.current() if incremental else None
    articles = sent.select("article_id")
    counts = articles.join(tf, "article_id", "left").select("article_id", "token", "tf")   # also articles without a term
    base = seen + 1
    if before is None:
        state = VO.counts_of(tf, articles)
    else:
        base = int(before.version.split("@")[1])
        rows = spark.read.parquet(f"{out}/term_counts").where(F.col("commit").between(base, before.number))
        newest = rows.groupBy("article_id").agg(F.max("commit").alias("commit"))
        old = rows.join(newest, ["article_id", "commit"], "left_semi")
        state = VO.merge(store.read(before.version), VO.delta(tf, articles, old.where(F.col("token").isNotNull()), newest))
    folder = store.stage(state, run)
    K.write_run_partition(counts, f"{out}/term_counts", "commit", str(seen + 1))
    store.commit(f"{run}@{base}", folder, seen)
    store.expire()
    return store.read(f"{run}@{base}")


def update_user_profile(inp: Inputs, profile: DataFrame, out: str, as_of: str,
                        previous_basic: DataFrame | None = None, log_path: str | None = None,
                        dt: str | None = None) -> dict[str, str]:
    """User profile job: T7 merge (K-S2), K4 partial topic weights, K4 basic.

    With ``log_path`` only the day ``dt`` of the partitioned log is read, through the gate (S6):
    a day without data writes nothing.
    """
    run, action = _run_id(as_of), inp.user_action
    if log_path is not None:
        action = I.log_partition(profile.sparkSession, log_path, dt)
        if action is None:
            return {"run": run, "log": "none"}
    delta = BH.flatten_actions(action)
    parts = [previous_basic, delta] if previous_basic is not None else [delta]
    basic = K.replace_table(BH.merge_behavior(*parts), f"{out}/user_article_basic", run)
    K.write_run_partition(BH.user_topic_weights(basic, profile, as_of), f"{out}/user_profile_partial", "run", run)
    K.write_run_partition(BH.user_basic(inp.user_profile, as_of), f"{out}/user_profile_basic", "run", run)
    return {"run": run}


def update_user_recall(inp: Inputs, basic: DataFrame, similar: DataFrame, history: DataFrame, out: str,
                       as_of: str, seed: int = SIM.SEED, n: int = RC.ALS_TOP_N) -> dict[str, str]:
    """Recall job: ALS recall and content recall, each minus the history; both written
    to K2 (cb_recall) and K3 (history_recall) with the same version. Rows that this run
    has written to the history before are no history for it, so it can be run again."""
    run = _run_id(as_of)
    history = history.where(F.col("version_ts") != run)
    model, uidx, aidx = RC.fit_als(inp.ratings, seed=seed)
    als = RC.filter_history(RC.als_recall(model, uidx, aidx, inp.item_channel, n), history)
    content = RC.filter_history(
        RC.content_candidates(basic.where(F.col("clicked")), similar), history)
    rows = write_once(RC.versioned_rows(als.select("user_id", "channel_id", "article_id"), "als", run)
                      .unionByName(RC.versioned_rows(content, "content", run)), "recall-rows")
    K.write_run_partition(rows.drop("version_ts"), f"{out}/cb_recall", "version_ts", run)
    written = K.read_partition(rows.sparkSession, f"{out}/cb_recall", "version_ts", run)
    K.write_run_partition(written.select("user_id", "channel_id", "article_id"),
                          f"{out}/history_recall", "version_ts", run)
    return {"run": run}


def update_ctr_feature(partial: DataFrame, profile: DataFrame, vectors: DataFrame, out: str,
                       as_of: str) -> dict[str, str]:
    """Feature job: K5 user channel weights (25 x 10 per user), K6 article features."""
    run = _run_id(as_of)
    K.write_run_partition(FT.user_channel_arrays(partial),
                          f"{out}/ctr_feature_user", "run", run)
    K.write_run_partition(FT.article_features(FT.article_weights(profile), vectors),
                          f"{out}/ctr_feature_article", "run", run)
    return {"run": run}


def update_ctr_model(training: DataFrame, out: str, as_of: str, max_iter: int = 100) -> dict:
    """Model part of the feature job (M21, M22, P13): fit on the users that are not held out, save the model,
    reload it and judge it by the held-out users' rows; writes their scores and one row of figures."""
    run, spark = _run_id(as_of), training.sparkSession
    training = write_once(training, "ctr-training")
    apart = FT.held_out_users(training)
    path = f"{out}/models/ctr/run={run}"
    FT.fit_ctr(training.where(~apart), max_iter).write().overwrite().save(path)
    model = LogisticRegressionModel.load(path)
    K.write_run_partition(FT.ctr_scores(model, training.where(apart)), f"{out}/ctr_scores", "run", run)
    scores = K.read_partition(spark, f"{out}/ctr_scores", "run", run)
    K.write_run_partition(FT.rank_auc(scores), f"{out}/ctr_figures", "run", run)
    figures = K.read_partition(spark, f"{out}/ctr_figures", "run", run).first()
    return {"run": run, "model": path, "n_rows": figures["n_rows"], "n_clicked": figures["n_clicked"], "auc": figures["auc"]}
