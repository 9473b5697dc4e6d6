"""Article text pipeline: token rule, vocabulary, TF-IDF ties, TextRank vs a plain Python loop."""

import math
from collections import defaultdict

import regex
from pyspark.sql import functions as F

from newsloom.functions import text as T
from newsloom.operators import articles as A

DOCS = [
    (1, 1, "The market rallied as investors cheered strong earnings; market analysts expected earnings growth "
           "and investors bought shares while the market kept rising."),
    (2, 1, "Le marché est resté calme. Les investisseurs attendent les résultats du marché et des banques, "
           "car les banques publient leurs résultats."),
    (3, 2, "a b c"),                       # no token passes the rule
    (4, 2, "<p>Storm storm STORM warning</p> river river flood warning flood"),
]


def _sent(spark):
    return spark.createDataFrame(DOCS, "article_id long, channel_id int, sentence string")


def _keep(t):
    return len(t) >= 2 and not (regex.fullmatch("[a-z]+", t) and len(t) < 3) and t not in T.STOPWORDS


def _textrank_py(text, k=20, span=5, rounds=10, d=0.85):
    toks = regex.findall(r"\p{L}+", text.lower())
    w = defaultdict(float)
    for i, a in enumerate(toks):
        if not _keep(a):
            continue
        for j in range(i + 1, min(i + span, len(toks))):
            b = toks[j]
            if _keep(b):
                w[(a, b)] += 1
                w[(b, a)] += 1
    if not w:
        return []
    out = defaultdict(float)
    for (a, _), c in w.items():
        out[a] += c
    nodes = sorted(out)
    s = {n: 1.0 / len(nodes) for n in nodes}
    for _ in range(rounds):
        acc = defaultdict(float)
        for (a, b), c in w.items():
            acc[a] += c / out[b] * s[b]
        s = {n: round(1.0 - d, 12) + d * acc[n] for n in nodes}
    lo, hi = min(s.values()), max(s.values())
    sc = {n: (v - lo / 10.0) / (hi - lo / 10.0) for n, v in s.items()}
    return sorted(sc.items(), key=lambda kv: (-round(kv[1], 9), kv[0]))[:k]


def test_token_rule(spark):
    df = spark.createDataFrame([(t,) for t in ["ab", "abc", "éa", "a", "the", "über"]], "t string")
    got = [r[0] for r in df.select(T.keep_token(F.col("t"))).collect()]
    assert got == [False, True, True, False, False, True]


def test_words_strip_tags_and_lowercase(spark):
    w = A.article_words(_sent(spark)).where("article_id = 4").first().words
    assert w == ["storm", "storm", "storm", "warning", "river", "river", "flood", "warning", "flood"]


def test_vocab_and_tfidf_ties(spark):
    tf = A.term_frequency(A.article_words(_sent(spark)))
    vocab = A.vocab_idf(tf, n_docs=4, vocab_size=5)
    v = vocab.orderBy("index").collect()
    assert [r["index"] for r in v] == list(range(5))
    totals = {r.token: r.t for r in tf.groupBy("token").agg(F.sum("tf").alias("t")).collect()}
    ranked = sorted(totals.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    assert [r.keyword for r in v] == [t for t, _ in ranked]
    dfs = {r.token: r.df for r in tf.groupBy("token").agg(F.count("*").alias("df")).collect()}
    for r in v:
        assert abs(r.idf - math.log(5 / (dfs[r.keyword] + 1))) < 1e-12
    top = A.tfidf_top_k(tf, vocab, k=2).collect()
    per = defaultdict(list)
    for r in top:
        per[r.article_id].append(r)
    assert all(len(x) <= 2 for x in per.values())
    assert 3 not in per                                          # article with no tokens


def test_textrank_matches_python_loop(spark):
    got = defaultdict(list)
    for r in A.textrank(_sent(spark)).collect():
        got[r.article_id].append((r.keyword, r.textrank))
    for aid, _, text in DOCS:
        want = _textrank_py(text)
        have = sorted(got.get(aid, []), key=lambda kv: (-round(kv[1], 9), kv[0]))
        assert [w for w, _ in have] == [w for w, _ in want], aid
        for (_, a), (_, b) in zip(have, want):
            assert abs(a - b) < 1e-9


def test_topics_modes_and_profile(spark):
    tfidf = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (2, 1, "b"), (2, 1, "c")],
                                  "article_id long, channel_id int, keyword string")
    tr = spark.createDataFrame([(1, 1, "b", 1.0), (3, 1, "c", 0.5), (1, 1, "z", 0.2)],
                               "article_id long, channel_id int, keyword string, textrank double")
    g = {r.article_id: r.topics for r in A.article_topics(tfidf, tr, "global").collect()}
    p = {r.article_id: r.topics for r in A.article_topics(tfidf, tr, "per_article").collect()}
    assert g == {1: ["b"], 2: ["b", "c"]} and p == {1: ["b"]}
    vocab = spark.createDataFrame([("b", 2.0, 0), ("c", 1.0, 1)], "keyword string, idf double, index int")
    w = A.keyword_weights(tr, vocab)                             # 'z' is not in the vocabulary
    prof = A.article_profile(w, A.article_topics(tfidf, tr, "global")).collect()
    assert [(r.article_id, r.keywords, r.topics) for r in prof] == [(1, {"b": 2.0}, ["b"])]


def test_term_frequency_adds_up_rows_of_an_article_and_keeps_no_table_in_a_task(spark):
    from collections import Counter
    rng = __import__("random").Random(2)
    rows = [(rng.choice([None, 1, 2, 3, 50 + i]), rng.choice([None, 1, 2]),
             rng.choice([None, [], [rng.choice(["aa", "the", "bcd", "é", "zz top", "xyz"]) for _ in range(9)]])) for i in range(300)]
    words = spark.createDataFrame(rows, "article_id long, channel_id int, words array<string>").repartition(5)
    want = Counter((a, c, w) for a, c, ws in rows for w in ws or [])
    out = A.term_frequency(words, filtered=False)
    got = [((r.article_id, r.channel_id, r.token), r.tf) for r in out.collect()]
    assert len(got) == len(want) and dict(got) == want
    assert "HashAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    kept = {k: n for k, n in want.items() if k[2] in ("bcd", "xyz", "zz top")}
    assert {(r.article_id, r.channel_id, r.token): r.tf for r in A.term_frequency(words).collect()} == kept
    assert A.term_frequency(words.limit(0)).collect() == []
