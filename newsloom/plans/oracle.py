"""Independent SQL definitions of the catalogue queries (DuckDB dialect).

Each query re-derives its inputs from the raw tables with plain SQL (CTEs), so it
checks the Spark plan end to end: adapters, operators and rounding. Numeric
outputs are rounded identically on both sides.
"""

from __future__ import annotations

from newsloom.functions.text import STOPWORDS
from newsloom.sources.tables import AS_OF, EVENT_SPLIT, ORDER_DELTA_FROM

_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in STOPWORDS)

# ------------------------------------------------------------------ shared CTE bodies

ARTICLE_CHANNEL = "SELECT doc_id AS article_id, CAST(CAST(substr(source, 4) AS INTEGER) + 1 AS INTEGER) AS channel_id FROM documents"

USER_ACTION = f"""
SELECT strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS actionTime,
       CAST(CAST(floor(e.value * 20) AS BIGINT) AS VARCHAR) AS readTime,
       ac.channel_id AS channelId,
       CASE WHEN e.event_type = 'view' THEN printf('[%d, %d]', e.k, (e.k + 1) % 100)
            ELSE CAST(e.k AS VARCHAR) END AS articleId,
       CASE e.event_type WHEN 'view' THEN 'exposure' WHEN 'click' THEN 'click' WHEN 'purchase' THEN 'share'
            WHEN 'signup' THEN 'collect' WHEN 'error' THEN 'read' END AS action,
       CAST(e.user_id AS VARCHAR) AS userId,
       strftime(e.ts, '%Y-%m-%d') AS dt
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
LEFT JOIN ({ARTICLE_CHANNEL}) ac ON ac.article_id = e.k
"""

FLAT = """
SELECT TRY_CAST(userId AS BIGINT) AS user_id, actionTime AS action_time, aid AS article_id,
       CAST(channelId AS INTEGER) AS channel_id,
       coalesce(action = 'share', false) AS shared,
       coalesce(action IN ('click', 'read'), false) AS clicked,
       coalesce(action = 'collect', false) AS collected,
       true AS exposure,
       coalesce(TRY_CAST(trim(readTime) AS INTEGER), 0) AS read_time
FROM ua, unnest(CASE WHEN action = 'exposure' THEN TRY_CAST(articleId AS BIGINT[])
                     ELSE [TRY_CAST(articleId AS BIGINT)] END) AS t(aid)
WHERE aid IS NOT NULL
"""

MERGE_BODY = """
SELECT user_id, max(action_time) AS action_time, article_id, max(channel_id) AS channel_id,
       max(shared) AS shared, max(clicked) AS clicked, max(collected) AS collected,
       max(exposure) AS exposure, max(read_time) AS read_time
FROM {src} GROUP BY user_id, article_id
"""


def _days(as_of: str = AS_OF) -> str:
    return (f"CAST(greatest(floor((epoch(TIMESTAMP '{as_of}') - epoch(strptime(action_time, '%Y-%m-%d %H:%M:%S')))"
            f" / 86400), 0) AS BIGINT)")


def _weight(as_of: str = AS_OF) -> str:
    return (f"(1.0 / (ln({_days(as_of)} + 1.0) + 1.0)) * (CAST(shared AS INTEGER) * 3 + CAST(collected AS INTEGER) * 2"
            f" + CAST(clicked AS INTEGER) * 5 + CASE WHEN read_time > 1000 THEN 2 ELSE 1 END)")


BEHAVIOR_CTES = f"""
ua AS ({USER_ACTION}),
fl AS ({FLAT}),
basic AS ({MERGE_BODY.format(src='fl')})
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes) + "\n"


ORACLE: dict[str, str] = {}

ORACLE["action_flatten"] = _with(f"ua AS ({USER_ACTION})") + FLAT

ORACLE["behavior_merge"] = _with(f"ua AS ({USER_ACTION})", f"fl AS ({FLAT})") + MERGE_BODY.format(src="fl")

ORACLE["interest_weight"] = _with(BEHAVIOR_CTES) + f"""
SELECT user_id, article_id, channel_id, action_time, {_days()} AS days_elapsed, round({_weight()}, 6) AS weight
FROM basic
"""

ORACLE["user_age"] = f"""
WITH up AS (
  SELECT c_custkey AS user_id, (c_custkey % 2) = 1 AS gender,
         CASE WHEN c_custkey % 10 = 0 THEN NULL
              ELSE DATE '1960-01-01' + CAST((c_custkey * 37) % 16000 AS INTEGER) END AS b
  FROM customer)
SELECT user_id, gender,
       CAST(coalesce(year(TIMESTAMP '{AS_OF}') - year(b)
            - CASE WHEN month(TIMESTAMP '{AS_OF}') < month(b)
                     OR (month(TIMESTAMP '{AS_OF}') = month(b) AND day(TIMESTAMP '{AS_OF}') < day(b))
                   THEN 1 ELSE 0 END, 0) AS INTEGER) AS age
FROM up
"""


# ------------------------------------------------------------------ articles

CHANNEL_EXPR = "CAST(CAST(substr(source, 4) AS INTEGER) + 1 AS INTEGER)"

SENT_CTES = f"""
basic_a AS (SELECT doc_id AS article_id, {CHANNEL_EXPR} AS channel_id, split_part(text, chr(10), 1) AS title
            FROM documents),
content_a AS (SELECT doc_id AS article_id, text AS content FROM documents),
chan AS (SELECT channel_id, min(source) AS channel_name
         FROM (SELECT {CHANNEL_EXPR} AS channel_id, source FROM documents) GROUP BY channel_id),
sent AS (SELECT b.article_id, b.channel_id, ch.channel_name, b.title, c.content,
                concat_ws(',', ch.channel_name, b.title, c.content) AS sentence
         FROM basic_a b JOIN content_a c USING (article_id) LEFT JOIN chan ch USING (channel_id))
"""

KEEP = (f"(length({{t}}) >= 2 AND NOT (regexp_matches({{t}}, '^[a-z]+$') AND length({{t}}) < 3)"
        f" AND {{t}} NOT IN ({_STOP}))")

TOKEN_CTES = SENT_CTES + r""",
wrd AS (SELECT article_id, channel_id,
               regexp_extract_all(lower(regexp_replace(sentence, '<.*?>', '', 'g')), '\p{L}{2,}') AS words
        FROM sent),
tok AS (SELECT article_id, channel_id, unnest(words) AS token FROM wrd),
tf_all AS (SELECT article_id, channel_id, token, count(*) AS tf FROM tok GROUP BY article_id, channel_id, token),
tf AS (SELECT article_id, channel_id, token, count(*) AS tf FROM tok WHERE """ + KEEP.format(t="token") + r"""
       GROUP BY article_id, channel_id, token)
"""

VOCAB_CTES = TOKEN_CTES + """,
stats AS (SELECT token, sum(tf) AS total, count(*) AS df FROM tf GROUP BY token),
vocab AS (SELECT token AS keyword,
                 ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1.0)) AS idf,
                 CAST(row_number() OVER (ORDER BY total DESC, token ASC) - 1 AS INTEGER) AS index
          FROM stats ORDER BY total DESC, token ASC LIMIT 2000),
tfidf_all AS (SELECT tf.article_id, tf.channel_id, tf.token AS keyword, v.index, tf.tf * v.idf AS tfidf
              FROM tf JOIN vocab v ON v.keyword = tf.token),
tfidf_top AS (SELECT article_id, channel_id, keyword, index, round(tfidf, 4) AS tfidf
              FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY round(tfidf, 9) DESC, index ASC) AS rn
                    FROM tfidf_all) WHERE rn <= 20)
"""


def _textrank_ctes(rounds: int = 10) -> str:
    body = r""",
tw AS (SELECT article_id, channel_id, regexp_extract_all(lower(sentence), '\p{L}+') AS w FROM sent),
tp AS (SELECT article_id, channel_id, unnest(w) AS tok, generate_subscripts(w, 1) AS pos FROM tw),
tk AS (SELECT article_id, channel_id, tok, pos, """ + KEEP.format(t="tok") + r""" AS keep FROM tp),
pr AS (SELECT a.article_id, a.channel_id, a.tok AS a, b.tok AS b
       FROM tk a CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS d) off
       JOIN tk b ON b.article_id = a.article_id AND b.pos = a.pos + off.d
       WHERE a.keep AND b.keep),
ed AS (SELECT article_id, channel_id, src, dst, CAST(count(*) AS DOUBLE) AS w
       FROM (SELECT article_id, channel_id, a AS src, b AS dst FROM pr
             UNION ALL SELECT article_id, channel_id, b AS src, a AS dst FROM pr)
       GROUP BY article_id, channel_id, src, dst),
ou AS (SELECT article_id, src, sum(w) AS out FROM ed GROUP BY article_id, src),
cf AS (SELECT ed.article_id, ed.src, ed.dst, ed.w / ou.out AS c
       FROM ed JOIN ou ON ou.article_id = ed.article_id AND ou.src = ed.dst),
nodes AS (SELECT DISTINCT article_id, channel_id, src FROM ed),
s0 AS (SELECT article_id, src AS node, 1e0 / count(*) OVER (PARTITION BY article_id) AS s FROM nodes)"""
    for i in range(1, rounds + 1):
        body += f""",
s{i} AS (SELECT cf.article_id, cf.src AS node, 0.15e0 + 0.85e0 * sum(cf.c * p.s) AS s
        FROM cf JOIN s{i - 1} p ON p.article_id = cf.article_id AND p.node = cf.dst
        GROUP BY cf.article_id, cf.src)"""
    body += f""",
mm AS (SELECT article_id, min(s) AS lo, max(s) AS hi FROM s{rounds} GROUP BY article_id),
sc AS (SELECT s.article_id, n.channel_id, s.node AS keyword,
              (s.s - mm.lo / 10e0) / (mm.hi - mm.lo / 10e0) AS textrank
       FROM s{rounds} s JOIN mm USING (article_id)
       JOIN nodes n ON n.article_id = s.article_id AND n.src = s.node),
tr AS (SELECT article_id, channel_id, keyword, textrank
       FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY round(textrank, 9) DESC, keyword ASC) AS rn
             FROM sc) WHERE rn <= 20)
"""
    return body


TEXTRANK_CTES = SENT_CTES + _textrank_ctes()

PROFILE_CTES = VOCAB_CTES + _textrank_ctes() + """,
kwt AS (SELECT tr.article_id, tr.channel_id, tr.keyword, tr.textrank * v.idf AS weight
        FROM tr JOIN vocab v ON v.keyword = tr.keyword),
topics_g AS (SELECT DISTINCT article_id, keyword AS topic FROM tfidf_top
             WHERE keyword IN (SELECT keyword FROM tr)),
prof_kw AS (SELECT k.* FROM kwt k WHERE k.article_id IN (SELECT article_id FROM topics_g)),
prof_ch AS (SELECT article_id, min(channel_id) AS channel_id FROM prof_kw GROUP BY article_id),
prof_tp AS (SELECT t.article_id, p.channel_id, t.topic FROM topics_g t JOIN prof_ch p USING (article_id))
"""

ORACLE["last_hour_articles"] = f"""
WITH a AS (
  SELECT d.doc_id AS article_id, {CHANNEL_EXPR} AS channel_id, split_part(d.text, chr(10), 1) AS title,
         CAST(CASE WHEN l.toxic = 1 THEN 3 ELSE 2 END AS INTEGER) AS status,
         to_timestamp(epoch(TIMESTAMP '{AS_OF}') - 86400 + (d.doc_id * 7919) % 86400) AT TIME ZONE 'UTC' AS ut
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT article_id, channel_id, title, status, strftime(ut, '%Y-%m-%d %H:%M:%S') AS update_time
FROM a
WHERE ut >= date_trunc('hour', TIMESTAMP '{AS_OF}') - INTERVAL 1 HOUR
  AND ut < date_trunc('hour', TIMESTAMP '{AS_OF}') AND status = 2
"""

ORACLE["upsert_by_key"] = f"""
WITH base AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate AS update_time, 0 AS d
              FROM orders),
delta AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE 'P' END AS o_orderstatus,
                 round(o_totalprice * 1.05e0, 2) AS o_totalprice,
                 CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 30 DAY ELSE o_orderdate END AS update_time,
                 1 AS d
          FROM orders WHERE o_orderdate >= TIMESTAMP '{ORDER_DELTA_FROM}' AND o_orderstatus IN ('O', 'P')),
u AS (SELECT * FROM base UNION ALL SELECT * FROM delta)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(update_time, '%Y-%m-%d %H:%M:%S') AS update_time
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY update_time DESC, d DESC) AS rn FROM u)
WHERE rn = 1
"""

ORACLE["clean_title"] = """
SELECT doc_id AS article_id,
       replace(regexp_replace(split_part(text, chr(10), 1), '[\r\n]', '', 'g'), ',', ' ') AS title
FROM documents
"""

ORACLE["strip_html"] = "SELECT page_id, regexp_replace(html, '<.*?>', '', 'g') AS text FROM pages"

ORACLE["drop_delims"] = ("SELECT doc_id AS article_id, regexp_replace(text, '[' || chr(10) || chr(13) || chr(1) || ']',"
                         " '', 'g') AS content FROM documents")

ORACLE["article_sentence"] = _with(SENT_CTES) + "SELECT article_id, channel_id, channel_name, title, sentence FROM sent"

ORACLE["tokens"] = _with(TOKEN_CTES) + "SELECT * FROM tf_all"

ORACLE["token_filtered"] = _with(TOKEN_CTES) + "SELECT * FROM tf"

ORACLE["vocab_idf"] = _with(VOCAB_CTES) + "SELECT keyword, round(idf, 6) AS idf, index FROM vocab"

ORACLE["tfidf_top20"] = _with(VOCAB_CTES) + "SELECT * FROM tfidf_top"

ORACLE["textrank_top20"] = _with(TEXTRANK_CTES) + \
    "SELECT article_id, channel_id, keyword, round(textrank, 6) AS textrank FROM tr"

ORACLE["keyword_weights"] = _with(PROFILE_CTES) + \
    "SELECT article_id, channel_id, keyword, round(weight, 6) AS weight FROM kwt"

ORACLE["article_topics_global"] = _with(PROFILE_CTES) + "SELECT article_id, topic FROM topics_g"

ORACLE["article_topics_per_article"] = _with(PROFILE_CTES) + """
SELECT DISTINCT t.article_id, t.keyword AS topic FROM tfidf_top t
WHERE EXISTS (SELECT 1 FROM tr WHERE tr.article_id = t.article_id AND tr.keyword = t.keyword)
"""

ORACLE["article_profile_exploded"] = _with(PROFILE_CTES) + """
SELECT k.article_id, c.channel_id, 'keyword' AS kind, k.keyword AS term, round(k.weight, 6) AS weight
FROM prof_kw k JOIN prof_ch c USING (article_id)
UNION ALL
SELECT article_id, channel_id, 'topic' AS kind, topic AS term, CAST(NULL AS DOUBLE) AS weight FROM prof_tp
"""

ORACLE["user_topic_weight"] = _with(BEHAVIOR_CTES, PROFILE_CTES) + f""",
w AS (SELECT user_id, article_id, action_time, {_weight()} AS weight FROM basic),
r AS (SELECT w.user_id, p.channel_id, p.topic, w.action_time, w.article_id, w.weight
      FROM w JOIN prof_tp p USING (article_id))
SELECT user_id, channel_id, topic, round(weight, 6) AS weight
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, channel_id, topic
                                   ORDER BY action_time DESC, article_id DESC) AS rn FROM r)
WHERE rn = 1
"""


# ------------------------------------------------------------------ vectors and similarity

from newsloom.operators import similarity as _SIM  # noqa: E402


def _dlit(x: float) -> str:
    r = repr(float(x))
    return r if "e" in r else r + "e0"


def _similar_ctes(k: int = _SIM.TOP_K, dim: int = 64) -> str:
    proj, offsets = _SIM.projections(dim, _SIM.NUM_TABLES, _SIM.PER_KEY, _SIM.SEED)
    hs = []
    for t in range(proj.shape[0]):
        hv = ", ".join(
            f"CAST(floor(list_dot_product(vec, [{', '.join(_dlit(x) for x in proj[t, j])}]) / {_dlit(_SIM.BUCKET_LENGTH)}"
            f" + {_dlit(offsets[t, j])}) AS BIGINT)" for j in range(proj.shape[1]))
        hs.append(f"SELECT article_id, channel_id, vec, {t} AS t, [{hv}] AS key FROM reps")
    return f"""
v AS (SELECT vec_id AS article_id, CAST(label + 1 AS INTEGER) AS channel_id, CAST(embedding AS DOUBLE[]) AS vec
      FROM embeddings),
grp AS (SELECT channel_id, vec, min(article_id) AS rep FROM v GROUP BY channel_id, vec),
mem AS (SELECT v.article_id, v.channel_id, g.rep FROM v JOIN grp g ON g.channel_id = v.channel_id AND g.vec = v.vec),
heads AS (SELECT rep, article_id AS head
          FROM (SELECT rep, article_id, row_number() OVER (PARTITION BY rep ORDER BY article_id) AS rn FROM mem)
          WHERE rn <= {k + 1}),
reps AS (SELECT rep AS article_id, channel_id, vec FROM grp),
keyed AS ({" UNION ALL ".join(hs)}),
dist AS (SELECT DISTINCT a.article_id AS a, b.article_id AS b, list_distance(a.vec, b.vec) AS d
         FROM keyed a JOIN keyed b ON a.channel_id = b.channel_id AND a.t = b.t AND a.key = b.key
         WHERE a.article_id <> b.article_id AND list_distance(a.vec, b.vec) < {_dlit(_SIM.THRESHOLD)}),
nbr AS (SELECT a, b, d FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(d, 9), b) AS rn FROM dist)
        WHERE rn <= {k}),
lists0 AS (SELECT n.a AS rep, h.head AS cand, n.d FROM nbr n JOIN heads h ON h.rep = n.b
           UNION ALL SELECT rep, head AS cand, 0e0 AS d FROM heads),
lists AS (SELECT rep, cand, d FROM (SELECT *, row_number() OVER (PARTITION BY rep ORDER BY round(d, 9), cand) AS rn
                                    FROM lists0) WHERE rn <= {k + 1}),
sim_out AS (SELECT m.article_id, m.channel_id, l.cand AS similar_id, l.d AS distance
            FROM mem m JOIN lists l ON l.rep = m.rep WHERE l.cand <> m.article_id),
sim AS (SELECT article_id, channel_id, similar_id, distance, CAST(rn AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY round(distance, 9), similar_id) AS rn
              FROM sim_out) WHERE rn <= {k})
"""


SIMILAR_CTES = _similar_ctes()

ORACLE["similar_top10"] = _with(SIMILAR_CTES) + \
    "SELECT article_id, channel_id, similar_id, round(distance, 6) AS distance, rank FROM sim"

ORACLE["similar_exact_top10"] = """
WITH v AS (SELECT vec_id AS article_id, CAST(label + 1 AS INTEGER) AS channel_id, CAST(embedding AS DOUBLE[]) AS vec
           FROM embeddings),
p AS (SELECT a.article_id, a.channel_id, b.article_id AS similar_id, list_distance(a.vec, b.vec) AS distance
      FROM v a JOIN v b ON a.channel_id = b.channel_id AND a.article_id <> b.article_id WHERE a.article_id % 50 = 0)
SELECT article_id, channel_id, similar_id, round(distance, 6) AS distance, CAST(rn AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY round(distance, 9), similar_id) AS rn
      FROM p WHERE distance < 2.0) WHERE rn <= 10
"""

ORACLE["similar_tiled_top10"] = ORACLE["similar_exact_top10"]

ORACLE["similar_hourly_top10"] = ORACLE["similar_exact_top10"].replace(" WHERE a.article_id % 50 = 0", "")

ORACLE["vector_recall_top10"] = _with(BEHAVIOR_CTES) + """,
v AS (SELECT vec_id AS article_id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
parts AS (SELECT user_id, unnest(vec) AS x, generate_subscripts(vec, 1) AS pos
          FROM (SELECT DISTINCT user_id, article_id FROM basic WHERE clicked) JOIN v USING (article_id)),
means AS (SELECT user_id, list(m ORDER BY pos) AS u FROM (SELECT user_id, pos, avg(x) AS m FROM parts GROUP BY ALL) GROUP BY 1),
p AS (SELECT user_id, article_id, list_inner_product(u, vec) AS score FROM means, v)
SELECT user_id, article_id, round(score, 6) AS score, CAST(rn AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, article_id) AS rn FROM p)
WHERE rn <= 10
"""

ORACLE["channel_centroid"] = """
WITH e AS (SELECT CAST(label + 1 AS INTEGER) AS channel_id, unnest(CAST(embedding AS DOUBLE[])) AS x,
                  CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos FROM embeddings)
SELECT channel_id, pos, round(avg(x), 6) AS value FROM e GROUP BY channel_id, pos
"""


# ------------------------------------------------------------------ recall, features

UTW_CTES = BEHAVIOR_CTES + ",\n" + PROFILE_CTES + f""",
w_ui AS (SELECT user_id, article_id, action_time, {_weight()} AS weight FROM basic),
r_ut AS (SELECT w.user_id, p.channel_id, p.topic, w.action_time, w.article_id, w.weight
         FROM w_ui w JOIN prof_tp p USING (article_id)),
utw AS (SELECT user_id, channel_id, topic, weight
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id, channel_id, topic
                                           ORDER BY action_time DESC, article_id DESC) AS rn FROM r_ut)
        WHERE rn = 1)
"""

HIST_CTES = f"""
ua AS ({USER_ACTION}),
fl AS ({FLAT}),
basic AS ({MERGE_BODY.format(src='fl')}),
hist AS (SELECT user_id, channel_id, article_id, substr(action_time, 1, 10) AS version_ts
         FROM fl WHERE NOT (shared OR clicked OR collected)),
clicks AS (SELECT user_id, article_id, channel_id FROM basic WHERE clicked),
cand AS (SELECT DISTINCT c.user_id, c.channel_id, s.similar_id AS article_id
         FROM clicks c JOIN sim s ON s.article_id = c.article_id WHERE s.rank <= 10)
"""

ORACLE["id_index"] = """
SELECT user_id, CAST(row_number() OVER (ORDER BY cnt DESC, CAST(user_id AS VARCHAR)) - 1 AS INTEGER) AS als_user_id
FROM (SELECT o_custkey AS user_id, count(*) AS cnt FROM orders GROUP BY o_custkey)
"""

ORACLE["als_list_sizes"] = """
WITH r AS (SELECT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
n AS (SELECT least(100, count(DISTINCT l_partkey)) AS k FROM r)
SELECT DISTINCT o_custkey AS user_id, k AS n_items, k AS n_distinct FROM r, n
"""

ORACLE["recall_lists"] = _with(BEHAVIOR_CTES) + """
SELECT user_id, channel_id, string_agg(CAST(article_id AS VARCHAR), ',' ORDER BY article_id) AS article_list
FROM basic WHERE clicked GROUP BY user_id, channel_id
"""

ORACLE["log_partition_day"] = _with(f"ua AS ({USER_ACTION})") + \
    "SELECT actionTime, channelId, userId, action, dt FROM ua WHERE dt = '2024-01-15'"

ORACLE["log_range_counts"] = _with(f"ua AS ({USER_ACTION})") + \
    "SELECT dt, count(*) AS n FROM ua WHERE dt >= '2024-01-20' GROUP BY dt"

ORACLE["sink_round_trip"] = ORACLE["user_age"]

ORACLE["map_profile_prefix"] = _with(UTW_CTES) + """,
g AS (SELECT u.user_id, CAST(c.channel_id AS INTEGER) AS channel_id
      FROM (SELECT DISTINCT user_id FROM utw) u, range(1, 26) c(channel_id))
SELECT g.user_id, g.channel_id, count(utw.topic) AS n_topics, round(coalesce(sum(utw.weight), 0e0), 6) AS total
FROM g LEFT JOIN utw ON utw.user_id = g.user_id AND utw.channel_id = g.channel_id GROUP BY g.user_id, g.channel_id
"""

ORACLE["content_recall"] = _with(SIMILAR_CTES, HIST_CTES) + """
SELECT user_id, channel_id, article_id FROM cand
WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.user_id = cand.user_id AND h.channel_id = cand.channel_id
                                         AND h.article_id = cand.article_id)
"""

ORACLE["history_filter"] = _with(SIMILAR_CTES, HIST_CTES) + """,
hv AS (SELECT user_id, channel_id, min(version_ts) AS oldest, count(DISTINCT version_ts) AS nv
       FROM hist GROUP BY user_id, channel_id),
hist2 AS (SELECT h.* FROM hist h JOIN hv ON hv.user_id = h.user_id AND hv.channel_id = h.channel_id
          WHERE hv.nv >= 2 AND h.version_ts > hv.oldest)
SELECT user_id, channel_id, article_id FROM cand
WHERE NOT EXISTS (SELECT 1 FROM hist2 h WHERE h.user_id = cand.user_id AND h.channel_id = cand.channel_id
                                          AND h.article_id = cand.article_id)
"""

ORACLE["recall_latest"] = _with(f"ua AS ({USER_ACTION})", f"fl AS ({FLAT})", SIMILAR_CTES) + """,
vers AS (SELECT DISTINCT f.user_id, 'content' AS source, f.channel_id, s.similar_id AS article_id,
                substr(f.action_time, 1, 10) AS version_ts
         FROM fl f JOIN sim s ON s.article_id = f.article_id WHERE f.clicked AND s.rank <= 10),
newest AS (SELECT user_id, source, channel_id, max(version_ts) AS version_ts FROM vers GROUP BY ALL)
SELECT v.* FROM vers v JOIN newest n ON n.user_id = v.user_id AND n.source = v.source
  AND n.channel_id = v.channel_id AND n.version_ts = v.version_ts
"""

UCF_CTES = UTW_CTES + """,
uranked AS (SELECT user_id, channel_id, weight,
                   row_number() OVER (PARTITION BY user_id, channel_id ORDER BY round(weight, 9), topic) AS slot
            FROM utw),
ugrid AS (SELECT u.user_id, CAST(c.channel_id AS INTEGER) AS channel_id, CAST(s.slot AS INTEGER) AS slot
          FROM (SELECT DISTINCT user_id FROM utw) u, range(1, 26) c(channel_id), range(1, 11) s(slot)),
ucf AS (SELECT g.user_id, g.channel_id, g.slot, coalesce(r.weight, 0e0) AS weight
        FROM ugrid g LEFT JOIN uranked r ON r.user_id = g.user_id AND r.channel_id = g.channel_id
                                         AND r.slot = g.slot)
"""

AF_CTES = """,
aranked AS (SELECT article_id, weight, row_number() OVER (PARTITION BY article_id ORDER BY weight) AS slot
            FROM prof_kw),
agrid AS (SELECT p.article_id, p.channel_id, CAST(s.slot AS INTEGER) AS slot FROM prof_ch p, range(1, 11) s(slot)),
aw AS (SELECT g.article_id, g.channel_id, g.slot, coalesce(r.weight, 0e0) AS weight
       FROM agrid g LEFT JOIN aranked r ON r.article_id = g.article_id AND r.slot = g.slot),
vecs AS (SELECT vec_id AS article_id, CAST(label + 1 AS INTEGER) AS channel_id, CAST(embedding AS DOUBLE[]) AS vec
         FROM embeddings),
vexp AS (SELECT article_id, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM vecs)
"""

ORACLE["user_channel_features"] = _with(UCF_CTES) + \
    "SELECT user_id, channel_id, slot, round(weight, 6) AS weight FROM ucf"

ORACLE["article_features"] = _with(PROFILE_CTES + AF_CTES) + """,
af AS (SELECT p.article_id, 0 AS pos, CAST(p.channel_id AS DOUBLE) AS value
       FROM prof_ch p WHERE p.article_id IN (SELECT article_id FROM vecs)
       UNION ALL
       SELECT a.article_id, a.slot AS pos, a.weight AS value
       FROM aw a WHERE a.article_id IN (SELECT article_id FROM vecs)
       UNION ALL
       SELECT x.article_id, 10 + x.i AS pos, x.x AS value
       FROM vexp x WHERE x.article_id IN (SELECT article_id FROM prof_ch))
SELECT article_id, CAST(pos AS INTEGER) AS pos, round(value, 6) AS value FROM af
"""

ORACLE["ctr_training_set"] = _with(UCF_CTES + AF_CTES) + """,
tr_rows AS (SELECT b.user_id, b.article_id, CAST(b.clicked AS INTEGER) AS clicked, v.channel_id
            FROM basic b JOIN vecs v ON v.article_id = b.article_id
            WHERE b.user_id IN (SELECT user_id FROM utw) AND b.article_id IN (SELECT article_id FROM prof_ch)),
feat AS (SELECT t.*, 0 AS pos, CAST(t.channel_id AS DOUBLE) AS value FROM tr_rows t
         UNION ALL
         SELECT t.*, x.i AS pos, x.x AS value FROM tr_rows t JOIN vexp x ON x.article_id = t.article_id
         UNION ALL
         SELECT t.*, 64 + u.slot AS pos, u.weight AS value
         FROM tr_rows t JOIN ucf u ON u.user_id = t.user_id AND u.channel_id = t.channel_id
         UNION ALL
         SELECT t.*, 74 + a.slot AS pos, a.weight AS value FROM tr_rows t JOIN aw a ON a.article_id = t.article_id)
SELECT user_id, article_id, clicked, channel_id, CAST(pos AS INTEGER) AS pos, round(value, 6) AS value FROM feat
"""

ORACLE["ctr_score_rows"] = _with(UTW_CTES + AF_CTES) + """
SELECT b.user_id, b.article_id, CAST(b.clicked AS INTEGER) AS clicked, true AS in_range
FROM basic b JOIN vecs v ON v.article_id = b.article_id
WHERE b.user_id IN (SELECT user_id FROM utw) AND b.article_id IN (SELECT article_id FROM prof_ch)
"""

ORACLE["word2vec_mean_check"] = _with(PROFILE_CTES) + """,
freq AS (SELECT token, sum(tf) AS n FROM tf GROUP BY token HAVING sum(tf) >= 3)
SELECT DISTINCT article_id, 100 AS dim, true AS is_mean FROM prof_kw WHERE keyword IN (SELECT token FROM freq)
"""

ORACLE["kv_export_keys"] = _with(UTW_CTES) + f""",
up AS (SELECT c_custkey AS user_id, (c_custkey % 2) = 1 AS gender,
              CASE WHEN c_custkey % 10 = 0 THEN NULL
                   ELSE DATE '1960-01-01' + CAST((c_custkey * 37) % 16000 AS INTEGER) END AS b
       FROM customer),
ub AS (SELECT user_id, gender,
              CAST(coalesce(year(TIMESTAMP '{AS_OF}') - year(b)
                   - CASE WHEN month(TIMESTAMP '{AS_OF}') < month(b)
                            OR (month(TIMESTAMP '{AS_OF}') = month(b) AND day(TIMESTAMP '{AS_OF}') < day(b))
                          THEN 1 ELSE 0 END, 0) AS INTEGER) AS age
       FROM up),
kv AS (SELECT 'user:' || user_id AS row_key, 'partial:' || channel_id || ':' || topic AS column_key,
              printf('%.6f', round(weight, 6)) AS value FROM utw
       UNION ALL SELECT 'user:' || user_id, 'basic:gender', CASE WHEN gender THEN 'true' ELSE 'false' END FROM ub
       UNION ALL SELECT 'user:' || user_id, 'basic:birthday', CAST(age AS VARCHAR) FROM ub)
SELECT row_key, column_key, value, CAST(split_part(row_key, ':', 2) AS BIGINT) AS user_id FROM kv
"""


# ------------------------------------------------------------------ streaming

ONLINE_CTES = f"""
ua AS ({USER_ACTION}),
fl AS ({FLAT}),
hist AS (SELECT user_id, channel_id, article_id FROM fl WHERE NOT (shared OR clicked OR collected)),
oc AS (SELECT TRY_CAST(userId AS BIGINT) AS user_id, TRY_CAST(articleId AS BIGINT) AS article_id,
              channelId AS channel_id, action,
              CAST(least((CAST(substr(dt, 9, 2) AS INTEGER) - 1) // 8, 3) AS INTEGER) AS batch
       FROM ua WHERE action IN ('click', 'collect', 'share'))
"""

ORACLE["online_recall"] = _with(SIMILAR_CTES, ONLINE_CTES) + """,
oc2 AS (SELECT * FROM oc WHERE user_id IS NOT NULL AND article_id IS NOT NULL),
cand AS (SELECT c.user_id, c.channel_id, s.similar_id AS article_id, min(c.batch) AS batch
         FROM oc2 c JOIN sim s ON s.article_id = c.article_id WHERE s.rank <= 10 GROUP BY ALL)
SELECT user_id, channel_id, article_id, batch FROM cand
WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.user_id = cand.user_id AND h.channel_id = cand.channel_id
                                         AND h.article_id = cand.article_id)
"""

ORACLE["hot_articles"] = _with(ONLINE_CTES) + """,
c AS (SELECT channel_id, article_id, count(*) AS clicks FROM oc
      WHERE user_id IS NOT NULL AND article_id IS NOT NULL GROUP BY channel_id, article_id)
SELECT channel_id, article_id, clicks, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY clicks DESC, article_id) AS rank FROM c)
WHERE rank <= 10
"""

ORACLE["hot_articles_stream"] = _with(ONLINE_CTES.replace("channelId AS channel_id, action,", "channelId AS channel_id, action, substr(actionTime, 1, 10) AS day,")) + """,
c AS (SELECT day, channel_id, article_id, count(*) AS clicks FROM oc
      WHERE user_id IS NOT NULL AND article_id IS NOT NULL GROUP BY ALL)
SELECT day, channel_id, article_id, clicks, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY day, channel_id ORDER BY clicks DESC, article_id) AS rank FROM c)
WHERE rank <= 10
"""

ORACLE["new_articles"] = f"""
WITH a AS (SELECT {CHANNEL_EXPR} AS channel_id, doc_id AS article_id,
                  to_timestamp(epoch(TIMESTAMP '{AS_OF}') - 86400 + (doc_id * 7919) % 86400) AT TIME ZONE 'UTC' AS ut
           FROM documents)
SELECT channel_id, article_id, strftime(ut, '%Y-%m-%d %H:%M:%S') AS update_time, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY ut DESC, article_id DESC) AS rank FROM a)
WHERE rank <= 10
"""

ORACLE["new_articles_stream"] = ORACLE["new_articles"]

ORACLE["import_increments"] = ORACLE["upsert_by_key"]

ORACLE["vocab_maintained"] = ORACLE["vocab_idf"]

ORACLE["cooccurrence_counts"] = _with(TOKEN_CTES) + """,
tkp AS (SELECT article_id, unnest(words) AS tok, generate_subscripts(words, 1) AS pos FROM wrd),
kept AS (SELECT * FROM tkp WHERE """ + KEEP.format(t="tok") + """),
near AS (SELECT a.tok AS a, b.tok AS b FROM kept a CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS d) off
         JOIN kept b ON b.article_id = a.article_id AND b.pos = a.pos + off.d)
SELECT word, other, count(*) AS n
FROM (SELECT a AS word, b AS other FROM near UNION ALL SELECT b, a FROM near) GROUP BY ALL HAVING count(*) >= 3
"""

ORACLE["popularity_auc"] = _with(BEHAVIOR_CTES) + """,
r AS (SELECT article_id, CAST(clicked AS INTEGER) AS clicked, sum(CAST(clicked AS INTEGER)) OVER (PARTITION BY article_id) AS s FROM basic),
c AS (SELECT s, sum(clicked) AS ones, sum(1 - clicked) AS zeros FROM r GROUP BY s),
b AS (SELECT *, sum(zeros) OVER (ORDER BY s) - zeros AS below FROM c)
SELECT CAST(sum(ones) + sum(zeros) AS BIGINT) AS n_rows, CAST(sum(ones) AS BIGINT) AS n_clicked,
       round(sum(ones * (below + zeros / 2.0)) / (sum(ones) * sum(zeros)), 9) AS auc FROM b
"""

ORACLE["ctr_training_set_wide"] = ORACLE["ctr_training_set"].replace(
    "SELECT t.*, 0 AS pos, CAST(t.channel_id AS DOUBLE) AS value FROM tr_rows t",
    "SELECT t.*, k AS pos, CAST(k + 1 = t.channel_id AS DOUBLE) AS value FROM tr_rows t, (SELECT unnest(range(25)) AS k)"
).replace("x.i AS pos", "24 + x.i AS pos").replace("64 + u.slot", "88 + u.slot").replace("74 + a.slot", "98 + a.slot")
