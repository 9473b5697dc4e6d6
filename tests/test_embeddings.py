"""Co-occurrence, PPMI, the distributed spectrum, maintained vocabulary and imports against brute force."""

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from newsloom.operators import articles as A
from newsloom.operators import embeddings as EM
from newsloom.operators import vocabulary as VO
from newsloom.sources.importer import IncrementalImport


def _texts(n=60, seed=1):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(25)]
    return [[None if rng.random() < 0.1 else rng.choice(words[k % 5 * 5:k % 5 * 5 + 8] or words) for _ in range(rng.randint(0, 30))]
            for k in range(n)]


def _brute_counts(texts, window):
    n = Counter()
    for t in texts:
        for i, a in enumerate(t):
            for b in t[i + 1:i + window]:
                if a is not None and b is not None:
                    n[a, b] += 1
                    n[b, a] += 1
    return n


def test_cooccurrence_and_ppmi(spark):
    texts = _texts()
    frame = spark.createDataFrame([(t,) for t in texts], "words array<string>")
    counts = EM.cooccurrence(frame, 4)
    got = {(r["word"], r["other"]): r["n"] for r in counts.collect()}
    assert got == _brute_counts(texts, 4)
    total = sum(got.values())
    margin = Counter()
    for (a, _), k in got.items():
        margin[a] += k
    want = {p: math.log(k * total / (margin[p[0]] * margin[p[1]])) for p, k in got.items()}
    values = {(r["word"], r["other"]): r["value"] for r in EM.ppmi(counts).collect()}
    assert values.keys() == {p for p, v in want.items() if v > 1e-12}
    assert all(abs(v - want[p]) < 1e-9 for p, v in values.items())


def test_spectrum_equals_numpy(spark):
    frame = spark.createDataFrame([(t,) for t in _texts(120, 5)], "words array<string>")
    matrix = EM.ppmi(EM.cooccurrence(frame))
    rows = matrix.collect()
    names = sorted({r["word"] for r in rows})
    dense = np.zeros((len(names), len(names)))
    for r in rows:
        dense[names.index(r["word"]), names.index(r["other"])] = r["value"]
    value, vectors = EM.spectrum(matrix, rank=4, rounds=12, oversample=8)
    true = np.linalg.eigvalsh(dense)
    true = true[np.argsort(-np.abs(true))][:4]
    assert np.allclose(np.abs(value), np.abs(true), rtol=1e-5)   # the singular values
    table = {r["word"]: r["vec"] for r in vectors.collect()}
    x = np.array([table[n] for n in names])
    assert np.allclose(x.T @ x, np.eye(4), atol=1e-8)
    assert np.allclose(dense @ x, x * value, atol=1e-2 * abs(value[0]))
    again, _ = EM.spectrum(matrix.repartition(7), rank=4, rounds=12, oversample=8)
    assert np.allclose(value, again, atol=1e-9)


def test_maintained_vocabulary_equals_a_recount(spark):
    rng = random.Random(3)
    articles, state = {}, None
    for hour in range(4):
        changed = {a: Counter(rng.choices("abcdefghij", k=rng.randint(0, 12))) for a in rng.sample(range(30), 9)}
        def frame(some):
            return spark.createDataFrame([(a, t, n) for a, c in some.items() for t, n in c.items()], "article_id long, token string, tf long")
        def names(some):
            return spark.createDataFrame([(a,) for a in some], "article_id long")
        change = VO.delta(frame(changed), names(changed), frame(articles), names(articles))
        state = change if state is None else VO.merge(state, change)
        state = spark.createDataFrame(state.collect(), VO.STATE)
        articles.update(changed)
        want = A.vocab_idf(frame(articles), len(articles), 6)
        assert sorted(map(tuple, VO.vocabulary(state, 6).collect())) == sorted(map(tuple, want.collect()))
        assert VO.merge(state, VO.negated(state)).where("token is not null").count() == 0


def test_imports_take_every_row_once(spark, tmp_path):
    def source(rows):
        return spark.createDataFrame(rows, "k int, v string, at string").withColumn("at", F.to_timestamp("at"))

    day = "2024-01-0{} 00:00:00".format
    first = [(1, "a", day(1)), (2, "b", day(3))]
    job = IncrementalImport(spark, str(tmp_path / "i"), ["k"], "at", lateness="2 days")
    assert job.run(source(first), "1").count() == 2
    second = first + [(3, "same time", day(3)), (4, "late", day(2)), (2, "b2", day(4))]
    assert sorted(r["k"] for r in job.fresh(source(second)).collect()) == [2, 3, 4]
    seen = job.state.current()
    target = job.run(source(second), "2")
    want = [(1, "a"), (2, "b2"), (3, "same time"), (4, "late")]
    assert sorted((r["k"], r["v"]) for r in target.collect()) == want
    assert job.fresh(source(second)).count() == 0        # nothing is new
    # the import dies after the target is written: the old state takes the rows again, the target stays right
    job.state._fs.delete(job.state._hadoop(f"{job.state.path}/_commits/{seen.number + 1:012d}"), False)
    assert job.fresh(source(second)).count() == 3
    assert sorted((r["k"], r["v"]) for r in job.run(source(second), "3").collect()) == want
    assert job.fresh(source(second).limit(0)).count() == 0


def test_products_and_counts_are_added_up_in_place(spark, monkeypatch):
    """No aggregate that sorts its rows, one shuffle of the pairs; pieces of a batch and empty lists count alike."""
    monkeypatch.setattr(EM, "PIECE_ROWS", 7)
    texts = _texts(40, 9) + [[], [None], ["w1"], ["w1", "w1"]]
    counts = EM.cooccurrence(spark.createDataFrame([(t,) for t in texts] + [(None,)], "words array<string>"), 3)
    assert {(r["word"], r["other"]): r["n"] for r in counts.collect()} == _brute_counts(texts, 3)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange") == 1
    vectors = spark.createDataFrame([("w1", [1.0, 2.0]), ("w2", [0.5, -1.0])], "word string, vec array<double>")
    matrix = spark.createDataFrame([("a", "w1", 2.0), ("a", "w2", 4.0), ("b", "w2", 1.0)], "word string, other string, value double")
    product = EM._times(matrix, vectors, 2)
    assert {r["word"]: r["vec"] for r in product.collect()} == {"a": [4.0, 0.0], "b": [0.5, -1.0]}
    plan = product._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "HashAggregate" in plan
