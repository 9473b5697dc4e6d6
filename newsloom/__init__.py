"""newsloom: a Spark-native data engine for a news feed.

Article profiles (tokens, TF-IDF, TextRank, topics, vectors), time-decayed user
interest profiles, similar-article search, recall lists (ALS, content, online),
CTR features and scoring. Every step is a DataFrame -> DataFrame function built
from Spark SQL expressions, so Catalyst plans it and it runs distributed.
"""

from newsloom.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
