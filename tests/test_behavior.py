"""Behaviour: action flattening, merge, read time, decay, age (FIXTURES §4)."""

from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from newsloom.functions import behavior as B
from newsloom.operators import behavior as BH

AS_OF = "2024-02-01 00:00:00"


def _log(spark, rows):
    schema = ("actionTime string, readTime string, channelId int, "
              "param struct<articleId:string, algorithmCombine:string, action:string, userId:string>, dt string")
    return spark.createDataFrame(rows, schema)


def test_flatten_actions_flags_and_ids(spark):
    rows = [
        ("2024-01-01 10:00:00", "", 18, ("[1, 2, 3]", "C2", "exposure", "7"), "2024-01-01"),
        ("2024-01-01 10:00:00", "", 18, ("[4]", "C2", "exposure", "7"), "2024-01-01"),
        ("2024-01-01 10:00:00", "", 18, ("[]", "C2", "exposure", "7"), "2024-01-01"),
        ("2024-01-01 10:01:00", "1500", 18, ("5", "C2", "read", "7"), "2024-01-01"),
        ("2024-01-01 10:02:00", "abc", 18, ("6", "C2", "share", "7"), "2024-01-01"),
        ("2024-01-01 10:03:00", "12", 18, ("7", "C2", "collect", "7"), "2024-01-01"),
        ("2024-01-01 10:04:00", "12", 18, ("8", "C2", "dislike", "7"), "2024-01-01"),
        ("2024-01-01 10:05:00", "3", 18, ("9", "C2", "click", "3000000000"), "2024-01-01"),
    ]
    out = {(r.article_id): r for r in BH.flatten_actions(_log(spark, rows)).collect()}
    assert sorted(out) == [1, 2, 3, 4, 5, 6, 7, 8, 9]          # empty exposure list -> no row
    assert all(out[i].exposure and not (out[i].clicked or out[i].shared or out[i].collected) for i in (1, 2, 3, 4))
    assert out[5].clicked and out[5].read_time == 1500          # read counts as a click
    assert out[6].shared and out[6].read_time == 0              # non-numeric read time -> 0
    assert out[7].collected
    assert not (out[8].clicked or out[8].shared or out[8].collected) and out[8].exposure   # unknown action
    assert out[9].clicked and out[9].user_id == 3000000000      # ids above 2^31


def test_read_score_boundaries(spark):
    df = spark.createDataFrame([("",), ("999",), ("1000",), ("1001",), (" 7 ",), ("x",)], "t string")
    got = [r[0] for r in df.select(B.read_score(B.read_ms(F.col("t")))).collect()]
    assert got == [1, 1, 1, 2, 1, 1]


def test_elapsed_days_and_decay(spark):
    base = datetime(2024, 2, 1)
    times = [base - timedelta(hours=24), base - timedelta(hours=23, minutes=59), base + timedelta(hours=5),
             base - timedelta(days=10)]
    df = spark.createDataFrame([(t.strftime("%Y-%m-%d %H:%M:%S"),) for t in times], "t string")
    got = df.select(B.elapsed_days(AS_OF, F.col("t")).alias("d"),
                    B.decay(B.elapsed_days(AS_OF, F.col("t"))).alias("w")).collect()
    assert [r.d for r in got] == [1, 0, 0, 10]                  # whole days; future clamps to 0
    assert abs(got[1].w - 1.0) < 1e-12 and got[2].w == 1.0


def test_age_rules(spark):
    df = spark.createDataFrame([("null",), ("2000-02-01",), ("2000-02-02",), ("2000-02-29",), ("bad",)], "b string")
    got = [r[0] for r in df.select(B.age_at(AS_OF, F.col("b"))).collect()]
    assert got == [0, 24, 23, 23, 0]
    leap = spark.createDataFrame([("2000-02-29",)], "b string").select(B.age_at("2024-02-29 00:00:00", F.col("b")))
    assert leap.first()[0] == 24


def _basic(rows):
    return [Row(user_id=u, action_time=t, article_id=a, channel_id=c, shared=s, clicked=k, collected=o,
                exposure=True, read_time=r) for (u, t, a, c, s, k, o, r) in rows]


row_st = st.tuples(st.integers(1, 3), st.sampled_from(["2024-01-01 00:00:00", "2024-01-02 00:00:00"]),
                   st.integers(1, 3), st.integers(1, 25), st.booleans(), st.booleans(), st.booleans(),
                   st.integers(0, 2000))


@settings(max_examples=8, deadline=None)
@given(st.lists(row_st, min_size=1, max_size=12), st.lists(row_st, min_size=1, max_size=12))
def test_merge_is_idempotent_and_order_free(spark, base_rows, delta_rows):
    schema = "user_id long, action_time string, article_id long, channel_id int, shared boolean, " \
             "clicked boolean, collected boolean, exposure boolean, read_time int"
    base = spark.createDataFrame(_basic(base_rows), schema)
    delta = spark.createDataFrame(_basic(delta_rows), schema)
    once = BH.merge_behavior(BH.merge_behavior(base), delta)
    twice = BH.merge_behavior(once, delta)
    swapped = BH.merge_behavior(delta, base)
    key = lambda rows: sorted(tuple(r) for r in rows)
    assert key(once.collect()) == key(twice.collect()) == key(swapped.collect())


def test_merge_read_time_is_numeric(spark):
    schema = "user_id long, action_time string, article_id long, channel_id int, shared boolean, " \
             "clicked boolean, collected boolean, exposure boolean, read_time int"
    rows = _basic([(1, "2024-01-01 00:00:00", 1, 1, False, False, False, 999),
                   (1, "2024-01-01 00:00:00", 1, 1, False, False, False, 1000)])
    m = BH.merge_behavior(spark.createDataFrame(rows, schema)).first()
    assert m.read_time == 1000                                   # a string max would give '999'
