"""Query catalogue: one entry per operator group of the survey.

Every query reads the given tables (through ``newsloom.sources.tables``) and
runs over them whole. Float outputs are rounded so that the SQL oracle in
``newsloom.plans.oracle`` can be compared value for value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators import behavior as BH
from newsloom.operators import embeddings as EM
from newsloom.operators import vocabulary as VO
from newsloom.sources import tables as S
from newsloom.sources.importer import IncrementalImport
from newsloom.session import ensure_checkpoint_dir, scratch_path, write_once
from newsloom.sources.tables import AS_OF, EVENT_SPLIT

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ shared building blocks

def flat_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return BH.flatten_actions(S.user_action(spark, sf_dir))


def behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 user_article_basic: the old table (log before the split) merged with the delta."""
    old = BH.flatten_actions(S.user_action(spark, sf_dir, before=EVENT_SPLIT))
    delta = BH.flatten_actions(S.user_action(spark, sf_dir, since=EVENT_SPLIT))
    return BH.merge_behavior(BH.merge_behavior(old), delta)


# ------------------------------------------------------------------ user side

@query("action_flatten")
def q_action_flatten(spark, sf_dir):
    return flat_actions(spark, sf_dir)


@query("behavior_merge")
def q_behavior_merge(spark, sf_dir):
    return behavior(spark, sf_dir)


@query("interest_weight")
def q_interest_weight(spark, sf_dir):
    w = BH.interest_weights(behavior(spark, sf_dir), AS_OF)
    return w.withColumn("weight", F.round("weight", 6))


@query("user_age")
def q_user_age(spark, sf_dir):
    return BH.user_basic(S.user_profile(spark, sf_dir), AS_OF)


# ------------------------------------------------------------------ articles

from newsloom.operators import articles as A  # noqa: E402
from newsloom.sources import ingest as I  # noqa: E402
from newsloom.functions import text as TX  # noqa: E402


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 article_data for the whole corpus (title and content come from one table,
    so one scan; ``article_sentence`` runs the general J1 join)."""
    return A.merge_article_data(S.news_article_with_content(spark, sf_dir), None, S.news_channel(spark, sf_dir))


def n_documents(spark: SparkSession, sf_dir: str) -> int:
    """m of the IDF formula (a parquet footer count, no data scan)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").count()


class ArticleFrames:
    """The article pipeline of one query, each intermediate built once so that a
    frame used twice (term counts feed both the vocabulary and TF-IDF) is one
    subtree whose shuffle Spark reuses, not two copies of the tokenizer."""

    def __init__(self, spark: SparkSession, sf_dir: str, vocab_size: int = A.VOCAB_SIZE):
        self.spark, self.sf_dir, self.vocab_size = spark, sf_dir, vocab_size
        self._c: dict[str, DataFrame] = {}

    def _get(self, key, build):
        if key not in self._c:
            self._c[key] = build()
        return self._c[key]

    def sentences(self) -> DataFrame:
        return self._get("sent", lambda: sentences(self.spark, self.sf_dir))

    def tf(self) -> DataFrame:
        """Term counts, written once and read by both consumers."""
        return self._get("tf", lambda: write_once(
            A.term_frequency(A.article_words(self.sentences()), filtered=True), "term-frequency"))

    def vocab(self) -> DataFrame:
        return self._get("vocab", lambda: A.vocab_idf(self.tf(), n_documents(self.spark, self.sf_dir), self.vocab_size))

    def tfidf(self) -> DataFrame:
        return self._get("tfidf", lambda: A.tfidf_top_k(self.tf(), self.vocab(), vocab_size=self.vocab_size))

    def textrank(self) -> DataFrame:
        """T11, written once: topics and keyword weights both read it."""
        return self._get("tr", lambda: write_once(A.textrank(self.sentences()), "textrank-keywords"))

    def topics(self, mode: str = "global") -> DataFrame:
        return self._get(f"topics-{mode}", lambda: A.article_topics(self.tfidf(), self.textrank(), mode))

    def weights(self) -> DataFrame:
        return self._get("weights", lambda: A.keyword_weights(self.textrank(), self.vocab(), self.vocab_size))

    def profile(self, mode: str = "global") -> DataFrame:
        return self._get(f"profile-{mode}", lambda: A.article_profile(self.weights(), self.topics(mode)))


def filtered_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ArticleFrames(spark, sf_dir).tf()


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ArticleFrames(spark, sf_dir).vocab()


def tfidf_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ArticleFrames(spark, sf_dir).tfidf()


def textrank_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.textrank(sentences(spark, sf_dir))


def profile(spark: SparkSession, sf_dir: str, mode: str = "global") -> DataFrame:
    """T12 article_profile: keyword map (TextRank x IDF) + topics."""
    return ArticleFrames(spark, sf_dir).profile(mode)


@query("last_hour_articles")
def q_last_hour_articles(spark, sf_dir):
    a = A.last_hour(S.news_article_review(spark, sf_dir), AS_OF)
    return a.select("article_id", "channel_id", "title", "status",
                    F.date_format("update_time", "yyyy-MM-dd HH:mm:ss").alias("update_time"))


@query("upsert_by_key")
def q_upsert_by_key(spark, sf_dir):
    u = I.upsert(S.orders_base(spark, sf_dir), S.orders_delta(spark, sf_dir), ["o_orderkey"], "update_time")
    return u.withColumn("update_time", F.date_format("update_time", "yyyy-MM-dd HH:mm:ss"))


@query("import_increments")
def q_import_increments(spark, sf_dir):
    """Four imports of a growing orders table; some rows come late, some share the mark's time, the
    last import is a replay. The target is that of one full import of base and changes."""
    base, delta = S.orders_base(spark, sf_dir), S.orders_delta(spark, sf_dir)
    late = (F.col("o_orderkey") % 50 == 0) & F.col("update_time").between(
        F.to_timestamp(F.lit("1994-12-01")), F.to_timestamp(F.lit("1995-01-01")))
    first = base.where((F.col("update_time") <= F.to_timestamp(F.lit("1995-01-01"))) & ~late)
    job = IncrementalImport(spark, scratch_path(spark, "import"), ["o_orderkey"], "update_time", lateness="40 years")
    target = None
    for number, source in enumerate((first, base, base.unionByName(delta), base.unionByName(delta))):
        target = job.run(source, str(number))
    return target.withColumn("update_time", F.date_format("update_time", "yyyy-MM-dd HH:mm:ss"))


@query("clean_title")
def q_clean_title(spark, sf_dir):
    b = S.news_article_basic(spark, sf_dir)
    return b.select("article_id", TX.clean_title(F.col("title")).alias("title"))


@query("strip_html")
def q_strip_html(spark, sf_dir):
    p = S.read_table(spark, sf_dir, "pages")
    return p.select("page_id", TX.strip_html(F.col("html")).alias("text"))


@query("drop_delims")
def q_drop_delims(spark, sf_dir):
    return I.clean_text_columns(S.news_article_content(spark, sf_dir), ["content"])


@query("article_sentence")
def q_article_sentence(spark, sf_dir):
    """J1 + J2 + F1 with T1 and T2 as separate tables."""
    m = A.merge_article_data(S.news_article_basic(spark, sf_dir), S.news_article_content(spark, sf_dir),
                             S.news_channel(spark, sf_dir))
    return m.select("article_id", "channel_id", "channel_name", "title", "sentence")


@query("tokens")
def q_tokens(spark, sf_dir):
    return A.term_frequency(A.article_words(sentences(spark, sf_dir)), filtered=False)


@query("token_filtered")
def q_token_filtered(spark, sf_dir):
    return filtered_tf(spark, sf_dir)


@query("vocab_idf")
def q_vocab_idf(spark, sf_dir):
    return vocabulary(spark, sf_dir).withColumn("idf", F.round("idf", 6))


@query("vocab_maintained")
def q_vocab_maintained(spark, sf_dir):
    """A7/A8/A10 kept up: the vocabulary after a first run over most articles (some with another text) and
    two hours of new and corrected ones; exactly that of a full recount."""
    sent = sentences(spark, sf_dir)
    hour = F.when(F.col("article_id") % 10 == 3, 1).when(F.col("article_id") % 10 == 7, 2).otherwise(0)
    early = F.when(F.col("article_id") % 20 == 1, F.substring("sentence", 1, 300)).otherwise(F.col("sentence"))
    hours = [sent.where(hour == 0).withColumn("sentence", early), sent.where(hour == 1),
             sent.where((hour == 2) | (F.col("article_id") % 20 == 1))]
    state = known = articles = None
    for number, rows in enumerate(hours):
        tf = write_once(A.term_frequency(A.article_words(rows)), f"hour-{number}-terms")
        if state is None:
            state, known, articles = VO.counts_of(tf, rows), tf, rows.select("article_id")
        else:
            state = VO.merge(state, VO.delta(tf, rows, known, articles))
            known = known.join(rows.select("article_id"), "article_id", "left_anti").unionByName(tf)
            articles = articles.union(rows.select("article_id")).distinct()
        state = write_once(state, f"hour-{number}-counts")
    return VO.vocabulary(state).withColumn("idf", F.round("idf", 6))


@query("cooccurrence_counts")
def q_cooccurrence_counts(spark, sf_dir):
    """M8's counts: how often two tokens of an article stand less than five tokens apart."""
    words = A.article_words(sentences(spark, sf_dir))
    kept = F.transform("words", lambda w: F.when(TX.keep_token(w), w))
    counts = EM.cooccurrence(words.select(kept.alias("words")))
    return counts.where(F.col("n") >= 3)


@query("tfidf_top20")
def q_tfidf_top20(spark, sf_dir):
    return tfidf_keywords(spark, sf_dir)


@query("textrank_top20")
def q_textrank_top20(spark, sf_dir):
    return textrank_keywords(spark, sf_dir).withColumn("textrank", F.round("textrank", 6))


@query("keyword_weights")
def q_keyword_weights(spark, sf_dir):
    return ArticleFrames(spark, sf_dir).weights().withColumn("weight", F.round("weight", 6))


def _topics_exploded(spark, sf_dir, mode):
    t = ArticleFrames(spark, sf_dir).topics(mode)
    return t.select("article_id", F.explode("topics").alias("topic"))


@query("article_topics_global")
def q_article_topics_global(spark, sf_dir):
    return _topics_exploded(spark, sf_dir, "global")


@query("article_topics_per_article")
def q_article_topics_per_article(spark, sf_dir):
    return _topics_exploded(spark, sf_dir, "per_article")


@query("article_profile_exploded")
def q_article_profile_exploded(spark, sf_dir):
    p = profile(spark, sf_dir)
    kw = p.select("article_id", "channel_id", F.lit("keyword").alias("kind"),
                  F.explode("keywords").alias("term", "weight")).withColumn("weight", F.round("weight", 6))
    tp = p.select("article_id", "channel_id", F.lit("topic").alias("kind"), F.explode("topics").alias("term"),
                  F.lit(None).cast("double").alias("weight"))
    return kw.unionByName(tp)


@query("user_topic_weight")
def q_user_topic_weight(spark, sf_dir):
    """Flagship: how much each user cares about each topic, per channel."""
    w = BH.user_topic_weights(behavior(spark, sf_dir), profile(spark, sf_dir), AS_OF)
    return w.withColumn("weight", F.round("weight", 6))


# ------------------------------------------------------------------ vectors and similarity

from newsloom.operators import similarity as SIM  # noqa: E402
from newsloom.operators import tiles as TL  # noqa: E402
from newsloom.operators import vectors as VEC  # noqa: E402

EMBED_DIM = 64


def similar(spark: SparkSession, sf_dir: str, order: str = "nearest") -> DataFrame:
    """K1 article_similar: top-10 similar articles per article (LSH, verified distances)."""
    return SIM.similar_top_k(S.article_vector(spark, sf_dir), order=order, dim=EMBED_DIM)


@query("ppmi_word_vectors")
def q_ppmi_word_vectors(spark, sf_dir):
    """M8 / M9: word vectors of the corpus from co-occurrence, 16 wide."""
    words = A.article_words(sentences(spark, sf_dir))
    kept = F.transform("words", lambda w: F.when(TX.keep_token(w), w))
    vectors = EM.word_vectors(words.select(kept.alias("words")), rank=16, rounds=2)
    return vectors.select("word", F.size("vec").alias("width"), F.round(F.aggregate(
        "vec", F.lit(0.0), lambda a, x: a + x * x), 4).alias("squared_norm"))


@query("similar_top10")
def q_similar_top10(spark, sf_dir):
    s = similar(spark, sf_dir)
    return s.select("article_id", "channel_id", "similar_id", F.round("distance", 6).alias("distance"), "rank")


@query("similar_exact_top10")
def q_similar_exact_top10(spark, sf_dir):
    """The true lists of the query set (ids divisible by 50) against all articles."""
    s = SIM.exact_top_k(S.article_vector(spark, sf_dir), query_step=SIM.QUERY_STEP)
    return s.select("article_id", "channel_id", "similar_id", F.round("distance", 6).alias("distance"), "rank")


@query("similar_lsh_recall")
def q_similar_lsh_recall(spark, sf_dir):
    return SIM.recall_against_exact(S.article_vector(spark, sf_dir), similar(spark, sf_dir))


@query("similar_tiled_top10")
def q_similar_tiled_top10(spark, sf_dir):
    """J12 exactly: the true lists of the query set by tiles; what cannot matter is skipped."""
    v = S.article_vector(spark, sf_dir)
    asked = v.where(F.col("article_id") % SIM.QUERY_STEP == 0)
    s = TL.similar_lists(v, SIM.TOP_K, SIM.THRESHOLD, of=asked, dim=EMBED_DIM)
    return s.select("article_id", "channel_id", "similar_id", F.round("distance", 6).alias("distance"), "rank")


@query("similar_hourly_top10")
def q_similar_hourly_top10(spark, sf_dir):
    """The lists of all articles after a full run over most of them and two hourly runs, the
    second of which also replaces some vectors. Every list is the true one of the end."""
    v = S.article_vector(spark, sf_dir)
    hour = F.when(F.col("article_id") % 10 == 3, 1).when(F.col("article_id") % 10 == 7, 2).otherwise(0)
    lists = None
    for now in range(3):
        there = v.where(hour <= now)
        if now < 2:   # until the last hour some articles have another vector
            early = F.when(F.col("article_id") % 20 == 1, F.reverse("articleVector")).otherwise(F.col("articleVector"))
            there = there.withColumn("articleVector", early)
        if lists is None:
            lists = TL.similar_lists(there, SIM.TOP_K, SIM.THRESHOLD, dim=EMBED_DIM)
        else:
            arrived = v.where((hour == now) | ((F.col("article_id") % 20 == 1) & F.lit(now == 2)))
            changed, replaced = TL.updated_lists(lists, there, arrived, SIM.TOP_K, SIM.THRESHOLD, dim=EMBED_DIM)
            lists = TL.replace_lists(lists, changed, replaced)
        lists = write_once(lists, f"similar-hour-{now}")
    return lists.select("article_id", "channel_id", "similar_id", F.round("distance", 6).alias("distance"), "rank")


@query("vector_recall_top10")
def q_vector_recall_top10(spark, sf_dir):
    """Recall by inner product: for every user the articles whose vectors have the largest product with
    the mean vector of the articles clicked."""
    v = S.article_vector(spark, sf_dir)
    clicked = clicked_articles(spark, sf_dir).select("user_id", "article_id").distinct()
    means = VEC.mean_vector(clicked.join(v, "article_id"), ["user_id"], "articleVector", "vec", EMBED_DIM)
    users = means.select(F.col("user_id").alias("id"), F.lit(0).alias("group_id"), "vec")
    items = v.select(F.col("article_id").alias("id"), F.lit(0).alias("group_id"), F.col("articleVector").alias("vec"))
    found, _ = TL.best_partners(users, items, 10, TL.INNER, EMBED_DIM)
    return found.select(F.col("id").alias("user_id"), F.col("partner").alias("article_id"),
                        F.round("value", 6).alias("score"), "rank")


@query("channel_centroid")
def q_channel_centroid(spark, sf_dir):
    m = VEC.mean_vector(S.article_vector(spark, sf_dir), ["channel_id"], "articleVector", "centroid", EMBED_DIM)
    return m.select("channel_id", F.posexplode("centroid").alias("pos", "value")) \
        .withColumn("value", F.round("value", 6))


@query("word2vec_article_vector")
def q_word2vec_article_vector(spark, sf_dir):
    words = A.article_words(sentences(spark, sf_dir)).select(
        "article_id", F.filter("words", lambda t: TX.keep_token(t)).alias("words"))
    model = VEC.train_word2vec(words, seed=SIM.SEED)
    return VEC.article_vectors(profile(spark, sf_dir), VEC.word_vectors(model))


@query("word2vec_mean_check")
def q_word2vec_mean_check(spark, sf_dir):
    """M10 checked: per article the vector's size, and whether every component is the mean over the
    article's keywords of weight x word vector, recomputed component by component with plain SQL."""
    frames = ArticleFrames(spark, sf_dir)
    words = A.article_words(frames.sentences()).select(
        "article_id", F.filter("words", lambda t: TX.keep_token(t)).alias("words"))
    vectors = write_once(VEC.word_vectors(VEC.train_word2vec(words, seed=SIM.SEED)), "word-vectors")
    prof = write_once(frames.profile(), "article-profile")
    found = VEC.article_vectors(prof, vectors).select("article_id", "articleVector")
    terms = prof.select("article_id", F.explode("keywords").alias("word", "weight")).join(vectors, "word")
    # one mean a component, side by side: no row per article, keyword and component
    plain = terms.groupBy("article_id").agg(F.array(*[
        F.avg(F.col("weight") * F.get("vector", F.lit(i))) for i in range(VEC.VECTOR_SIZE)]).alias("means"))
    same = F.zip_with("articleVector", "means", lambda x, y: F.coalesce(F.abs(x - y) < 1e-9, F.lit(False)))
    return found.join(plain, "article_id", "full").groupBy("article_id").agg(
        F.sum(F.greatest(F.size("articleVector"), F.size("means"))).cast("int").alias("dim"),
        F.min(F.coalesce(F.forall(same, lambda x: x), F.lit(False))).alias("is_mean"))


# ------------------------------------------------------------------ recall

from newsloom.operators import recall as RC  # noqa: E402
from newsloom.operators import features as FT  # noqa: E402
from newsloom.functions import arrays as AR  # noqa: E402
from newsloom.sources import sinks as K  # noqa: E402


def exposure_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 history_recall seed: articles already shown to a user in a channel, one
    version per day (pure exposures of the log)."""
    f = flat_actions(spark, sf_dir)
    return f.where(~(F.col("shared") | F.col("clicked") | F.col("collected"))).select(
        "user_id", "channel_id", "article_id", F.substring("action_time", 1, 10).alias("version_ts"))


def clicked_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behavior(spark, sf_dir).where(F.col("clicked")).select("user_id", "article_id", "channel_id")


@query("id_index")
def q_id_index(spark, sf_dir):
    o = S.read_table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"))
    return RC.dense_index(o, "user_id", "als_user_id")


@query("als_recall")
def q_als_recall(spark, sf_dir):
    model, uidx, aidx = RC.fit_als(S.purchase_clicks(spark, sf_dir), seed=SIM.SEED)
    rows = RC.als_recall(model, uidx, aidx, S.item_channel(spark, sf_dir))
    rows = RC.filter_history(rows, exposure_history(spark, sf_dir))
    return rows.select("user_id", "channel_id", "article_id", F.round("score", 6).alias("score"), "pos")


@query("als_list_sizes")
def q_als_list_sizes(spark, sf_dir):
    """M14 / W4 checked: before the history filter a rated user has min(N, items) items, none twice."""
    model, uidx, aidx = RC.fit_als(S.purchase_clicks(spark, sf_dir), seed=SIM.SEED)
    rows = RC.als_recall(model, uidx, aidx, S.item_channel(spark, sf_dir))
    # the lists are dealt by user once; both counts are made there
    return rows.repartition("user_id").groupBy("user_id").agg(F.count("*").alias("n_items"), F.countDistinct("article_id").alias("n_distinct"))


@query("recall_lists")
def q_recall_lists(spark, sf_dir):
    """The clicked articles of every (user, channel) as an ordered list."""
    clicks = clicked_articles(spark, sf_dir).withColumn("pos", F.col("article_id"))
    lists = RC.recall_lists(clicks)
    return lists.select("user_id", "channel_id", F.concat_ws(
        ",", F.transform("article_list", lambda x: x.cast("string"))).alias("article_list"))


@query("content_recall")
def q_content_recall(spark, sf_dir):
    cand = RC.content_candidates(clicked_articles(spark, sf_dir), similar(spark, sf_dir))
    return RC.filter_history(cand, exposure_history(spark, sf_dir))


@query("history_filter")
def q_history_filter(spark, sf_dir):
    cand = RC.content_candidates(clicked_articles(spark, sf_dir), similar(spark, sf_dir))
    return RC.filter_history(cand, exposure_history(spark, sf_dir), compat="skip_oldest")


@query("recall_latest")
def q_recall_latest(spark, sf_dir):
    """K2 store with one version per click day; the newest list per (user, source, channel)."""
    f = flat_actions(spark, sf_dir).where(F.col("clicked"))
    clicks = f.select("user_id", "article_id", "channel_id", F.substring("action_time", 1, 10).alias("day"))
    sim = similar(spark, sf_dir).where(F.col("rank") <= RC.CONTENT_TOP).select("article_id", "similar_id")
    rows = clicks.join(sim, "article_id").select(
        "user_id", "channel_id", F.col("similar_id").alias("article_id"), F.col("day").alias("version_ts")).distinct()
    store = RC.versioned_rows(rows, "content", F.col("version_ts"))
    return RC.latest_version(store)


# ------------------------------------------------------------------ features and CTR

def user_partial(spark: SparkSession, sf_dir: str, prof: DataFrame | None = None) -> DataFrame:
    """K4 partial weights (user, channel, topic, weight), written once because the feature
    queries read it twice."""
    prof = prof if prof is not None else profile(spark, sf_dir)
    return write_once(BH.user_topic_weights(behavior(spark, sf_dir), prof, AS_OF), "user-profile-partial")


@query("user_channel_features")
def q_user_channel_features(spark, sf_dir):
    w = FT.user_channel_weights(user_partial(spark, sf_dir))
    return w.withColumn("weight", F.round("weight", 6))


@query("article_features")
def q_article_features(spark, sf_dir):
    f = FT.article_features(FT.article_weights(profile(spark, sf_dir)), S.article_vector(spark, sf_dir))
    return f.select("article_id", F.posexplode("features").alias("pos", "value")) \
        .withColumn("value", F.round("value", 6))


def training_set(spark: SparkSession, sf_dir: str, one_hot_channels: int = 0) -> DataFrame:
    prof = write_once(profile(spark, sf_dir), "article-profile")   # T12, read twice
    return FT.ctr_training_set(behavior(spark, sf_dir), FT.user_channel_arrays(user_partial(spark, sf_dir, prof)),
                               S.article_vector(spark, sf_dir), FT.article_weights(prof), one_hot_channels)


@query("popularity_auc")
def q_popularity_auc(spark, sf_dir):
    """P13 on a plain score: how well the number of users who clicked an article tells the rows (user,
    article) that were clicked from those that were only shown."""
    rows = behavior(spark, sf_dir).select("user_id", "article_id", F.col("clicked").cast("int").alias("clicked"))
    clicks = rows.groupBy("article_id").agg(F.sum("clicked").alias("p_click"))
    found = FT.rank_auc(rows.join(clicks, "article_id"))
    return found.withColumn("auc", F.round("auc", 9))


@query("ctr_training_set_wide")
def q_ctr_training_set_wide(spark, sf_dir):
    """M20 in the planned layout: the channel as 25 columns of 0 and 1 in front."""
    t = training_set(spark, sf_dir, one_hot_channels=FT.N_CHANNELS)
    return t.select("user_id", "article_id", "clicked", "channel_id", F.posexplode("features").alias("pos", "value")) \
        .withColumn("value", F.round("value", 6))


@query("ctr_training_set")
def q_ctr_training_set(spark, sf_dir):
    t = training_set(spark, sf_dir)
    return t.select("user_id", "article_id", "clicked", "channel_id", F.posexplode("features").alias("pos", "value")) \
        .withColumn("value", F.round("value", 6))


@query("ctr_score")
def q_ctr_score(spark, sf_dir):
    # fit and scoring both read the training set: checkpoint it once (reliable folder)
    ensure_checkpoint_dir(spark)
    t = training_set(spark, sf_dir).checkpoint()
    model = FT.fit_ctr(t)
    return FT.ctr_scores(model, t).withColumn("p_click", F.round("p_click", 6))


@query("ctr_score_rows")
def q_ctr_score_rows(spark, sf_dir):
    """M22 / P13 checked: the scored rows and labels are the training rows, probabilities in [0, 1]."""
    return q_ctr_score(spark, sf_dir).select("user_id", "article_id", "clicked",
                                             F.col("p_click").between(0.0, 1.0).alias("in_range"))


@query("map_profile_prefix")
def q_map_profile_prefix(spark, sf_dir):
    """The T14 map ('channel:topic' -> weight) of every user, read by channel prefix."""
    entries = user_partial(spark, sf_dir).select(
        "user_id", F.struct(F.format_string("%d:%s", "channel_id", "topic").alias("k"), "weight").alias("e"))
    maps = entries.groupBy("user_id").agg(F.map_from_entries(F.collect_list("e")).alias("article_partial"))
    by_prefix = maps.select("user_id", AR.map_values_by_prefix(F.col("article_partial")).alias("by_prefix"))
    by_channel = by_prefix.select("user_id", "by_prefix",
                                  F.explode(F.sequence(F.lit(1), F.lit(FT.N_CHANNELS))).alias("channel_id"))
    found = F.try_element_at("by_prefix", F.col("channel_id").cast("string"))
    values = F.coalesce(found, F.array().cast("array<double>"))
    return by_channel.select("user_id", "channel_id", F.size(values).cast("long").alias("n_topics"),
                             F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query("log_partition_day")
def q_log_partition_day(spark, sf_dir):
    """The log written by day, one day read back through the gate."""
    path = scratch_path(spark, "user-action-log")
    S.user_action(spark, sf_dir).write.partitionBy("dt").parquet(path)
    day = I.log_partition(spark, path, "2024-01-15")
    if day is None:
        raise ValueError("the log has no rows of that day")
    return day.select("actionTime", "channelId", "param.userId", "param.action", F.col("dt").cast("string").alias("dt"))


@query("log_range_counts")
def q_log_range_counts(spark, sf_dir):
    """Rows per day from a date on."""
    path = scratch_path(spark, "user-action-log")
    S.user_action(spark, sf_dir).write.partitionBy("dt").parquet(path)
    return I.log_range(spark, path, "2024-01-20").groupBy(F.col("dt").cast("string").alias("dt")).agg(
        F.count("*").alias("n"))


@query("sink_round_trip")
def q_sink_round_trip(spark, sf_dir):
    """K-S1 / K-S2 / K-S5: written twice as a run and as a table version, read back."""
    path, basic = scratch_path(spark, "sink"), BH.user_basic(S.user_profile(spark, sf_dir), AS_OF)
    for _ in range(2):
        K.write_run_partition(basic, f"{path}/basic", "run", "r1")
    merged = K.replace_table(K.read_partition(spark, f"{path}/basic", "run", "r1").drop("run"), f"{path}/merged", "v1")
    return merged.select("user_id", "gender", "age")


@query("kv_export_keys")
def q_kv_export_keys(spark, sf_dir):
    """Profile rows in the key-value layout, and the id parsed back."""
    p = user_partial(spark, sf_dir).select(
        F.format_string("user:%d", "user_id").alias("row_key"),
        F.format_string("partial:%d:%s", "channel_id", "topic").alias("column_key"),
        F.format_string("%.6f", F.round("weight", 6)).alias("value"))
    b = BH.user_basic(S.user_profile(spark, sf_dir), AS_OF)
    g = b.select(F.format_string("user:%d", "user_id").alias("row_key"), F.lit("basic:gender").alias("column_key"),
                 F.lower(F.col("gender").cast("string")).alias("value"))
    a = b.select(F.format_string("user:%d", "user_id").alias("row_key"), F.lit("basic:birthday").alias("column_key"),
                 F.col("age").cast("string").alias("value"))
    u = p.unionByName(g).unionByName(a)
    return u.withColumn("user_id", F.split_part("row_key", F.lit(":"), F.lit(2)).cast("bigint"))


# ------------------------------------------------------------------ streaming

from newsloom.streaming import online as ON  # noqa: E402

ONLINE_PARTS = 4   # the events of days 1-8, 9-16, 17-24 and 25-31 arrive as one micro-batch each


@query("online_recall")
def q_online_recall(spark, sf_dir):
    """ST1-ST6: the click stream, four parts of the events drained as four ordered micro-batches; each
    row with the batch that recalled it first."""
    store, ckpt, source = (scratch_path(spark, f"online-{x}") for x in ("store", "ckpt", "events"))
    ON.seed_history(exposure_history(spark, sf_dir), store)
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    part = F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(ONLINE_PARTS - 1))
    sim = write_once(similar(spark, sf_dir), "article-similar")   # K1, read by every batch
    channels = write_once(S.article_channel(spark, sf_dir), "article-channel")   # read by every batch
    for number in range(ONLINE_PARTS):   # as many files as its size asks for; all that is there is one batch
        events.where(part == number).hint("rebalance").write.parquet(f"{source}/part-{number}")
        stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(source)
        messages = ON.click_messages(S.user_action_from(stream, channels))
        ON.start_online_recall(messages, sim, store, ckpt, available_now=True).awaitTermination()
    return ON.read_recall(spark, store).select("user_id", "channel_id", "article_id", "batch")


@query("hot_articles")
def q_hot_articles(spark, sf_dir):
    clicks = ON.parse_clicks(ON.click_messages(S.user_action(spark, sf_dir)))
    return ON.hot_articles(clicks)


@query("new_articles")
def q_new_articles(spark, sf_dir):
    n = ON.new_articles(S.news_article_basic(spark, sf_dir))
    return n.withColumn("update_time", F.date_format("update_time", "yyyy-MM-dd HH:mm:ss"))


@query("hot_articles_stream")
def q_hot_articles_stream(spark, sf_dir):
    """ST7 as a stream: the most clicked articles of every (day, channel), counted over four ordered
    micro-batches with a watermark."""
    store, ckpt, source = (scratch_path(spark, f"hot-{x}") for x in ("store", "ckpt", "events"))
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    part = F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(ONLINE_PARTS - 1))
    channels = write_once(S.article_channel(spark, sf_dir), "article-channel")
    for number in range(ONLINE_PARTS):
        events.where(part == number).hint("rebalance").write.parquet(f"{source}/part-{number}")
        stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(source)
        messages = ON.click_messages(S.user_action_from(stream, channels))
        ON.start_hot_counts(messages, store, ckpt, available_now=True).awaitTermination()
    found = ON.hot_of_windows(ON.hot_counts(spark, store))
    return found.withColumn("day", F.date_format("window_start", "yyyy-MM-dd")).select(
        "day", "channel_id", "article_id", "clicks", "rank")


@query("new_articles_stream")
def q_new_articles_stream(spark, sf_dir):
    """ST7 as a stream: the newest articles of every channel after three micro-batches of articles."""
    store, ckpt, source = (scratch_path(spark, f"new-{x}") for x in ("store", "ckpt", "articles"))
    articles = S.news_article_basic(spark, sf_dir).select("channel_id", "article_id", "update_time")
    for number in range(3):
        articles.where(F.col("article_id") % 3 == number).write.parquet(f"{source}/part-{number}")
        stream = spark.readStream.schema(articles.schema).option("recursiveFileLookup", "true").parquet(source)
        ON.start_new_articles(stream, store, ckpt, available_now=True).awaitTermination()
    return ON.new_lists(spark, store).withColumn("update_time", F.date_format("update_time", "yyyy-MM-dd HH:mm:ss"))
