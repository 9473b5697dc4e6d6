"""DuckDB SQL for the operators whose results SQL can express."""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, sha256({LOWERED}) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source),
r AS (  -- by the ratio of cap to weight: the level if exactly the sources before this one are at their cap
  SELECT *, 2 * source_size / w AS ratio,
         (1.5::DOUBLE * (SELECT sum(source_size) FROM s)
          - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY 2 * source_size / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv
  FROM s),
lev AS (SELECT lv AS l FROM r WHERE lv < ratio ORDER BY ratio, source LIMIT 1),
t AS (SELECT source, source_size, least((2 * source_size)::DOUBLE, (SELECT l FROM lev) * w) AS target FROM s),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN floor(floor(target) / source_size) * size
        + greatest(0, least(size, floor(target) - floor(floor(target) / source_size) * source_size - before)) ELSE 0 END)::BIGINT AS taken
FROM p
"""

_BASE32 = " || ".join(
    f"translate(to_base(CAST('0x' || substr(h, {at}, 10) AS BIGINT), 32, 8), '0123456789ABCDEFGHIJKLMNOPQRSTUV', "
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')" for at in (1, 11, 21, 31))

WARC = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, max(page_id) AS first_id FROM p GROUP BY h)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM p JOIN g USING (h)
"""

SUBSTRING_DEDUP = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT doc_id, i FROM win WHERE k IN (SELECT k FROM win GROUP BY k HAVING count(*) > 1)),
hit AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS p FROM rep),
word AS (SELECT doc_id, unnest(generate_series(1, len(w))) AS p, unnest(w) AS t FROM d),
kept AS (
  SELECT doc_id, string_agg(t, ' ' ORDER BY p) AS s, count(*) AS n
  FROM word ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(kept.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

DECONTAMINATION = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(lower_text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text FROM documents)),
b AS (
  SELECT item_id, coalesce(regexp_extract_all(lower_text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM (SELECT item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text FROM benchmark)),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
occ AS (SELECT doc_id, item_id, i, dw.n AS n FROM dw JOIN bw ON dw.n = bw.n AND dw.s = bw.s),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM occ) GROUP BY 1),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, coalesce(CAST(item_id AS VARCHAR), '') AS name FROM occ) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

# CRC-32, half a byte at a time; fixed values: the remainders of 0 to 15 under the polynomial 0xEDB88320
_NIBBLES = ("[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, "
            "3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]")


def _crc32(text: str) -> str:
    digits = f"hex(encode({text}))"
    # the low half of a byte goes first
    halves = (f"list_transform(range(octet_length(encode({text})) * 2), lambda k: CAST('0x' || "
              f"substr({digits}, (k + 1 + (CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END))::INT, 1) AS BIGINT))")
    return (f"xor(list_reduce(list_prepend(4294967295, {halves}), "
            f"lambda a, b: xor(a >> 4, {_NIBBLES}[(xor(a, b) & 15) + 1])), 4294967295)")


_GRAM_WORDS = r"regexp_extract_all({t}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _features(table: str, key: str) -> str:
    words = _GRAM_WORDS.format(t=LOWERED)
    return f"""
  SELECT r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g
  FROM (SELECT {key} AS r, {words} AS w FROM {table})"""


RESAMPLE = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
df AS (SELECT r, g, count(*) AS k FROM ({_features('docs', 'r')}) GROUP BY ALL),
bf AS (SELECT g, count(*) AS k FROM ({_features('benchmark', '0')}) GROUP BY ALL),
grams AS (SELECT g, {_crc32('g')} % 10000 AS bucket FROM (SELECT g FROM df UNION SELECT g FROM bf)),
s AS (SELECT bucket, sum(k) AS s FROM df JOIN grams USING (g) GROUP BY 1),
t AS (SELECT bucket, sum(k) AS t FROM bf JOIN grams USING (g) GROUP BY 1),
totals AS (SELECT coalesce((SELECT sum(s) FROM s), 0)::DOUBLE AS ss, coalesce((SELECT sum(t) FROM t), 0)::DOUBLE AS tt),
gains AS (
  SELECT b.bucket, floor(1000 * ln(((coalesce(t, 0)::DOUBLE + 1) * (ss + 10000)) / ((coalesce(s, 0)::DOUBLE + 1) * (tt + 10000))))::BIGINT AS gain
  FROM (SELECT unnest(range(10000)) AS bucket) b LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), totals),
w AS (SELECT r, sum(k)::BIGINT AS n_features, floor(sum(k * gain)::DOUBLE / sum(k)::DOUBLE)::BIGINT AS weight
      FROM df JOIN grams USING (g) JOIN gains USING (bucket) GROUP BY 1),
sc AS (
  SELECT d.r, doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         len({_GRAM_WORDS.format(t=LOWERED)}) AS words,
         CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM docs d LEFT JOIN w USING (r)),
scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM sc),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id ASC NULLS LAST, r) AS p, count(*) OVER () AS n
           FROM scored WHERE words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN p <= 25 * n // 100 THEN p END AS rank
FROM scored LEFT JOIN ranked USING (r)
"""

SPELLING = rf"""
WITH runs AS (
  SELECT doc_id, unnest(regexp_extract_all({LOWERED}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, k, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM counted),
cut AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, k
  FROM hashed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY 1 HAVING sum(k) >= 2),
gone AS (  -- every word without one of its letters
  SELECT DISTINCT word, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(length(word)))::INT AS i FROM words)),
blank AS (  -- every word with one of its letters blanked
  SELECT word, substr(word, 1, i) || '_' || substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(length(word)))::INT AS i FROM words)),
near AS (
  SELECT g.word AS a, g.rest AS b FROM gone g JOIN words w ON w.word = g.rest
  UNION SELECT g.rest, g.word FROM gone g JOIN words w ON w.word = g.rest
  UNION SELECT x.word, y.word FROM blank x JOIN blank y USING (rest) WHERE x.word <> y.word),
best AS (
  SELECT a AS word, count(*) AS n_near, arg_min(b, (-w.n, b)) AS form, max(w.n) AS form_n
  FROM near JOIN words w ON w.word = b GROUP BY a),
known AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form,
         CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  WITH RECURSIVE c(word, stop, depth) AS (
    SELECT word, word, 0 FROM known UNION ALL SELECT c.word, k.form, depth + 1 FROM c JOIN known k ON k.word = c.stop WHERE k.form IS NOT NULL)
  SELECT word, arg_max(stop, depth) AS root FROM c GROUP BY word)
SELECT word, n, n_near, form, form_n, root FROM known JOIN chain USING (word)
"""
