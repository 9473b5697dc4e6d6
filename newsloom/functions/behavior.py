"""User behaviour column expressions: action flags, read time, decay, weights, age."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Behaviour weights of the interest formula (F8).
W_SHARE = 3
W_COLLECT = 2
W_CLICK = 5
W_READ_LONG = 2     # read time above READ_LONG_MS
W_READ_SHORT = 1
READ_LONG_MS = 1000
CLICK_ACTIONS = ("click", "collect", "share")   # P8 / ST3 allow-list


def article_ids(action: Column, article_id_text: Column) -> Column:
    """an exposure carries a JSON id list, every other action one id."""
    return F.when(action == "exposure", F.from_json(article_id_text, "array<bigint>")) \
        .otherwise(F.array(article_id_text.try_cast("bigint")))


def shared(action: Column) -> Column:
    return F.coalesce(action == "share", F.lit(False))


def clicked(action: Column) -> Column:
    """'read' counts as a click."""
    return F.coalesce(action.isin("click", "read"), F.lit(False))


def collected(action: Column) -> Column:
    return F.coalesce(action == "collect", F.lit(False))


def read_ms(read_time_text: Column) -> Column:
    """F7 parse: blank or non-numeric -> 0."""
    return F.coalesce(F.trim(read_time_text).try_cast("int"), F.lit(0))


def read_score(ms: Column) -> Column:
    """2 when read longer than 1000 ms, otherwise 1."""
    return F.when(ms > READ_LONG_MS, F.lit(W_READ_LONG)).otherwise(F.lit(W_READ_SHORT))


def elapsed_days(as_of: str, action_time: Column) -> Column:
    """whole elapsed days floor(seconds / 86400), clamped at 0 for future times (Q18)."""
    secs = F.unix_timestamp(F.lit(as_of)) - F.unix_timestamp(action_time)
    return F.greatest(F.floor(secs / F.lit(86400)), F.lit(0)).cast("bigint")


def decay(days: Column) -> Column:
    """1 / (ln(days + 1) + 1)."""
    return F.lit(1.0) / (F.log(days + F.lit(1.0)) + F.lit(1.0))


def interest_weight(as_of: str, action_time: Column, shared_c: Column, collected_c: Column,
                    clicked_c: Column, read_time_ms: Column) -> Column:
    """F8: decay x (3 shared + 2 collected + 5 clicked + read score)."""
    score = (shared_c.cast("int") * W_SHARE + collected_c.cast("int") * W_COLLECT
             + clicked_c.cast("int") * W_CLICK + read_score(read_time_ms))
    return decay(elapsed_days(as_of, action_time)) * score


def age_at(as_of: str, birthday_text: Column) -> Column:
    """completed years at ``as_of``; the text 'null' (or unparsable) -> 0.

    Year difference minus one while (month, day) of ``as_of`` precedes the birthday.
    """
    b = F.when(birthday_text != "null", F.try_to_timestamp(birthday_text, F.lit("yyyy-MM-dd")))
    t = F.to_timestamp(F.lit(as_of))
    before = (F.month(t) < F.month(b)) | ((F.month(t) == F.month(b)) & (F.dayofmonth(t) < F.dayofmonth(b)))
    years = F.year(t) - F.year(b) - F.when(before, F.lit(1)).otherwise(F.lit(0))
    return F.coalesce(years, F.lit(0)).cast("int")
