"""The mean of weight x word vector, checked without a row per component."""

from pyspark.sql import functions as F

from newsloom.plans.catalog import QUERIES
from tests.conftest import SF001


def test_mean_check_makes_no_row_a_component(spark):
    """At most the keywords of the articles are rows, not their 100 components each."""
    checked = QUERIES["word2vec_mean_check"](spark, SF001)
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "posexplode" not in plan
    rows = checked.collect()
    assert rows and {(r["dim"], r["is_mean"]) for r in rows} == {(100, True)}
    assert checked.agg(F.countDistinct("article_id")).first()[0] == len(rows)
