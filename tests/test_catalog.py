"""Driver contract: entry() smoke, catalogue/oracle key agreement, oracle checks at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tools.compare import TABLES, frame_hash

FAST = ["action_flatten", "behavior_merge", "interest_weight", "user_age", "upsert_by_key", "clean_title",
        "strip_html", "drop_delims", "article_sentence", "tokens", "token_filtered", "vocab_idf", "tfidf_top20",
        "last_hour_articles", "id_index", "channel_centroid", "hot_articles", "new_articles", "similar_top10",
        "similar_exact_top10", "recall_lists", "log_partition_day", "log_range_counts", "sink_round_trip", "online_recall",
        "similar_tiled_top10", "vector_recall_top10", "import_increments", "vocab_maintained", "popularity_auc",
        "new_articles_stream"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "channel_id", "topic", "weight"]
    assert df.count() >= 0


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert frame_hash(sdf.columns, srows)[0] == frame_hash(dcols, drows)[0]
