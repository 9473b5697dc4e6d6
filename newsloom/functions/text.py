"""Text column expressions (F1-F3, S3, S4, M1 token rules). All JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the reference's cleaning steps.
HTML_TAG = "(?d)<.*?>"          # lazy tag match; (?d) = only '\n' ends a line, as in the SQL oracle
WORD_2PLUS = r"\p{L}{2,}"       # tokens of two or more letters (M1)
WORD_ANY = r"\p{L}+"            # every letter run, used for TextRank positions (M5)
ASCII_WORD = "^[a-z]+$"         # a Latin ('eng') token after lower-casing
DELIMS = "[\n\r\u0001]"         # Hive import delimiters dropped by S4

# Stopword list (own choice; the reference reads its list from a file
# outside the tree). Common function words of the four corpus languages.
STOPWORDS = (
    "the and for are but not you all any can had her was one our out his has him how its may new now "
    "old see two way who did get let put say she too use that this with from they will would there their "
    "what about which when make like time just know take into year your some could them than then look only "
    "come over also back after work first well even want because these give most "
    "les des une est pas que qui dans pour sur par plus avec son ses aux ont elle mais comme tout nous vous "
    "ils sont cette fait peu "
    "der die das und ist nicht ein eine mit den dem des von auf für sich auch als wie aus bei nach oder "
    "noch wird sind hat "
    "los las del por con una para como pero sus más este esta son muy hay todo fue"
).split()


def strip_html(c: Column) -> Column:
    """remove tags (lazy ``<.*?>``; a tag broken by a newline is kept)."""
    return F.regexp_replace(c, HTML_TAG, "")


def clean_title(c: Column) -> Column:
    """Drop CR and LF, comma -> space."""
    return F.translate(F.regexp_replace(c, "[\r\n]", ""), ",", " ")


def drop_delims(c: Column) -> Column:
    """Drop newline, carriage return and \\x01 from a string column."""
    return F.regexp_replace(c, DELIMS, "")


def sentence(channel_name: Column, title: Column, content: Column) -> Column:
    """channel, title and content joined with ',' (nulls skipped)."""
    return F.concat_ws(",", channel_name, title, content)


def words(text: Column, pattern: str = WORD_2PLUS) -> Column:
    """Lower-cased letter runs of ``text`` in order (array<string>)."""
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def keep_token(tok: Column) -> Column:
    """M1 / M5 token rule: >= 2 letters, Latin-only tokens >= 3, not a stopword."""
    n = F.length(tok)
    return (n >= 2) & ((n >= 3) | ~tok.rlike(ASCII_WORD)) & ~tok.isin(*STOPWORDS)
