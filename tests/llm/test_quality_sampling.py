"""Importance resampling, quality classifier and spelling variants against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import quality, resample, spelling
from newsloom.llm.common import read_table

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def grams(text, n=2):
    words = WORD.findall((text or "").encode().lower())
    return words, [b" ".join(words[i:i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute_resample(docs, target, n=2, min_words=20, buckets=10_000):
    def counts(texts):
        return Counter(zlib.crc32(g) % buckets for t in texts for g in grams(t, n)[1])

    s, t = counts(x for _, x in docs), counts(target)
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for i, (k, text) in enumerate(docs):
        words, found = grams(text, n)
        weight = sum(gain[zlib.crc32(g) % buckets] for g in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        rows.append([k, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None,
                     len(words), i])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(able[:len(able) * 25 // 100]):
        r[4] = place + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def resampled(docs, target, **options):
    out = resample.resample(docs, target, **options).select("id", "n_features", "weight", "score", "rank")
    return sorted(map(tuple, out.collect()), key=str)


def test_shifted_checksums():
    rng = random.Random(1)
    words = [bytes(rng.choices(range(128, 255), k=k)) for k in [1, 2, 7, 63, 64, 65, 200, 5000]]
    shifts = resample.Shifts()
    for a in words:
        crc = np.full(len(words), zlib.crc32(a), dtype=np.uint32)
        moved = shifts(crc, np.array([len(w) for w in words]))
        assert [int(m) ^ zlib.crc32(w) for m, w in zip(moved, words)] == [zlib.crc32(a + w) for w in words]


@pytest.mark.parametrize("n", [1, 2, 4])
@pytest.mark.parametrize("sizes", [(4 << 20, 1 << 19), (100, 7)])
def test_buckets_stay_inside_documents(n, sizes, monkeypatch):
    monkeypatch.setattr(resample, "BATCH_BYTES", sizes[0])
    monkeypatch.setattr(resample, "BLOCK_WORDS", sizes[1])
    rng = random.Random(2)
    texts = [None, b"", b"\x00 !", "É é ß 10 Zz".encode(), b"one"] + [
        bytes(rng.choices(b"aB7 \n\xc3\xa9.", k=rng.choice([3, 50, 400]))) for _ in range(30)]
    found = [Counter() for _ in texts]
    for owner, marks, _ in resample.gram_buckets(texts, resample.Shifts(), n, 997):
        for d, b in zip(owner.tolist(), marks.tolist()):
            found[d][b] += 1
    for text, have in zip(texts, found):
        words = WORD.findall((text or b"").lower())
        assert have == Counter(zlib.crc32(b" ".join(words[i:i + k])) % 997
                               for k in range(1, n + 1) for i in range(len(words) - k + 1))


def test_resample_equals_brute_force(docs, save, empty_docs):
    target = [("a", "abc def " * 9), ("b", None), ("c", "")] + [(str(i), r["text"][:200]) for i, r in enumerate(
        docs.filter("doc_id < 6").orderBy("doc_id").collect())]
    items = save(target, "item_id string, text string")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert resampled(docs, items) == brute_resample(rows, [t for _, t in target])
    assert resampled(docs, items.limit(0)) == brute_resample(rows, [])
    assert resampled(empty_docs, items) == []
    ranks = [r[4] for r in resampled(docs, items) if r[4] is not None]
    assert sorted(ranks) == list(range(1, len(ranks) + 1))


def test_ranks_follow_a_total_order(spark):
    from newsloom.llm.common import global_ranks
    rng = random.Random(4)
    rows = [(rng.choice([1, 1, 1, 2, 50]), i) for i in range(2000)]
    frame = spark.createDataFrame(rows, "a int, b int")
    out = global_ranks(frame, [F.col("a").desc(), F.col("b").asc()], "ranks").orderBy("rank").collect()
    assert [(r["a"], r["b"], r["rank"]) for r in out] == [
        (*r, k + 1) for k, r in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])))]


def test_dual_descent_reaches_the_optimum():
    rng = np.random.default_rng(5)
    rows = [np.unique(rng.integers(0, 40, rng.integers(1, 12))) for _ in range(60)]
    labels = rng.integers(0, 2, 60)
    ratio = rng.normal(size=40)
    weight, constant, dual = quality.dual_descent(rows, labels, ratio, cost=0.5, epochs=3000)
    sign = np.where(labels > 0, 1.0, -1.0)
    x = np.zeros((60, 41))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r] / np.sqrt((ratio[r] ** 2).sum())
        x[i, 40] = 1
    full = np.append(weight, constant)
    assert np.allclose(full, (dual * sign) @ x)
    primal = full @ full / 2 + 0.5 * np.maximum(0, 1 - sign * (x @ full)).sum()
    assert primal - (dual.sum() - full @ full / 2) < 0.05  # the duality gap closes
    assert ((0 <= dual) & (dual <= 0.5)).all()


def test_log_count_ratios():
    ratio = quality.log_count_ratios([np.array([1, 2]), np.array([2]), np.array([3])], np.array([1, 1, 0]))
    size = 1 << quality.BITS
    p, q = size + 3, size + 1
    assert ratio[2] == pytest.approx(math.log((3 / p) / (1 / q))) and ratio[3] == pytest.approx(math.log((1 / p) / (2 / q)))


def test_indicators_do_not_depend_on_pieces(monkeypatch):
    text = "Grüße an alle, alle alle! " * 20 + "x"
    whole = quality.indicators(text)
    monkeypatch.setattr(quality, "PIECE", 7)
    assert quality.indicators(text).tolist() == whole.tolist()
    assert len(quality.indicators(None)) == len(quality.indicators("")) == 0


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    rows = quality.score_quality(docs, labels).filter("held_out").join(
        labels, F.col("id") == labels["doc_id"]).select("score", "predicted", "quality").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows) / len(rows)
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    ahead = np.mean([np.mean(np.array(bad) < g) for g in good])
    assert len(rows) > 500 and right > 0.985 and ahead > 0.995, (len(rows), right, ahead)


def test_quality_of_awkward_rows(docs, empty_docs, save, spark):
    schema = "doc_id long, quality int, doc_id_ int"
    labels = save([(i, i % 2, 1) for i in range(60)] + [(3, 0, 1), (None, 1, 1), (7, None, 1), (100, 5, 1)], schema)
    out = quality.score_quality(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    assert all(r["predicted"] == int(r["score"] >= 0.7) and r["held_out"] == (
        zlib.crc32(str("" if r["id"] is None else r["id"]).encode()) % 4 == 2) for r in out)
    assert quality.score_quality(empty_docs, labels).collect() == []
    one_class = quality.score_quality(docs, save([(1, 1, 1)], schema)).collect()
    assert len({r["score"] for r in one_class}) == 1
    assert {r["score"] for r in quality.score_quality(docs, save([], schema, 1)).collect()} == {0.5}
    # the bounds hold, whatever the number of labelled rows
    rows, known = quality.training_rows(quality.stable(docs), labels, "doc_id", "text", "doc_id", "quality", 10, 1 << 20)
    assert len(rows) == len(known) == 10
    assert len(quality.training_rows(quality.stable(docs), labels, "doc_id", "text", "doc_id", "quality", 10, 1)[0]) == 1


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(docs, delete_one_in=31, min_length=7):
    n = Counter()
    for k, text in docs:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in word)
            h = zlib.crc32(f"{'' if k is None else k}:{word}".encode())
            if h % delete_one_in == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            n[word] += 1
    n = {w: c for w, c in n.items() if len(w) >= min_length and c >= 2}
    out, form = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= 10 * n[w]:
            form[w] = best
        out[w] = [n[w], len(others)]
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] += [form.get(w), n.get(form.get(w)), root]
    return {w: tuple(v) for w, v in out.items()}


def variants(docs, **options):
    rows = spelling.variant_groups(docs, **options).collect()
    found = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}
    assert len(found) == len(rows)
    return found


def variant_rows(seed):
    """Words of few letters and their edits, with counts that make chains of forms."""
    rng = random.Random(seed)
    rows, base = [], ["".join(rng.choices("abcÀÿ×", k=rng.choice([7, 8, 9, 13]))) for _ in range(25)]
    words = list(base)
    for w in base:
        for _ in range(8):
            at, c = rng.randrange(len(w) + 1), rng.choice("abcÀ")
            words.append(rng.choice([w[:at] + c + w[at:], w[:at] + c + w[at + 1:], w[:at] + w[at + 1:]]))
    for i, w in enumerate(words):
        rows.append((i, " ".join([w] * rng.choice([1, 2, 3, 25, 300])) + ". " + w.upper(), 1, "x"))
    long = "ab" * 3000
    return rows + [(500, f"{long} {long}b", 1, "x"), (501, f"{long} {long}b {long}", 1, "x"), (502, None, 1, None), (503, "", 1, ""),
                   (None, base[0], 1, "x"), (1, rows[1][1], 1, "x"), (1, rows[1][1], 1, "x")]


@pytest.mark.parametrize("parts", [3, 4])
def test_variants_equal_brute_force(save, parts):
    docs = save(variant_rows(parts), "doc_id long, text string, word int, n string")
    want = brute_variants([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sum(v[2] is not None for v in want.values()) > 10
    assert any(v[2] is not None and v[4] != v[2] for v in want.values())  # a chain
    assert variants(docs, parts=parts) == want


def test_variants_of_deleted_letters_and_empty_tables(docs, empty_docs):
    want = brute_variants([(r["doc_id"], r["text"]) for r in docs.collect()], delete_one_in=2, min_length=4)
    assert variants(docs, delete_one_in=2, min_length=4) == want
    assert variants(empty_docs) == {}


def test_every_edit_shares_a_signature():
    rng = random.Random(6)
    for parts in (3, 4):
        for _ in range(200):
            w = "".join(rng.choices("aabcdéÿ", k=rng.choice([7, 8, 12])))
            at, c = rng.randrange(len(w)), rng.choice("abcz")
            for x in (w[:at] + c + w[at + 1:], w[:at] + c + w[at:], w[:at] + w[at + 1:]):
                if x == w:
                    continue
                keys = []
                for y in (w, x):
                    letters = np.frombuffer(y.encode("utf-32-le"), dtype=np.uint32).reshape(1, len(y))
                    keys.append({int(k[0]) for _, _, _, k, _ in spelling.signature_rows(letters, parts)})
                assert keys[0] & keys[1], (w, x)
