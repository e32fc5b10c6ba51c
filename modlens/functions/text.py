"""Text functions as ``Column`` expressions.

Character classes are written out instead of using ``\\s`` and ``\\w``: regex
engines disagree on those outside ASCII, and an explicit class is also faster
than switching the matcher to full Unicode mode.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from modlens.functions.lexicon import WORD_CLASS

# A link with its text, Unicode white space, and the emoji ranges removed from text.
MARKDOWN_LINK = r"\[([^\]]+)\]\([^)]+\)"
SPACE_CHARS = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
EMOJI_RANGES = {
    # "wide" is the historical class; its last range also covers CJK, kana and Hangul
    "wide": r"\x{1f600}-\x{1f64f}\x{1f300}-\x{1f5ff}\x{1f680}-\x{1f6ff}\x{1f1e0}-\x{1f1ff}"
    r"\x{2702}-\x{27b0}\x{24c2}-\x{1f251}",
    # "narrow" keeps those scripts
    "narrow": r"\x{1f600}-\x{1f64f}\x{1f300}-\x{1f5ff}\x{1f680}-\x{1f6ff}\x{1f170}-\x{1f251}"
    r"\x{2702}-\x{27b0}\x{24c2}",
}
# End of fixed values.

SPACES = f"[{SPACE_CHARS}]+"
URL = f"https?://[^{SPACE_CHARS}]+"
MENTION = f"@{WORD_CLASS}+"
TOKEN = f"{WORD_CLASS}{{2,}}"

# A short list of English function words; callers pass another for other needs.
STOP_WORDS = tuple(
    """a about above after again against all also am an and any are as at be because been before being below
    between both but by can cannot could did do does doing down during each few for from further had has have
    having he her here hers herself him himself his how i if in into is it its itself just me more most my myself
    no nor not now of off on once only or other our ours ourselves out over own same she should so some such than
    that the their theirs them themselves then there these they this those through to too under until up very was
    we were what when where which while who whom why will with would you your yours yourself yourselves""".split()
)


def collapse_spaces(text: Column) -> Column:
    """Every run of white space becomes one blank; ends are trimmed."""
    return F.trim(F.regexp_replace(text, SPACES, " "))


def strip_emoji(text: Column, emoji: str = "narrow") -> Column:
    """Remove emoji; ``emoji`` names the character class."""
    return F.regexp_replace(text, f"[{EMOJI_RANGES[emoji]}]+", "")


def clean_text(text: Column, emoji: str | None = None) -> Column:
    """Drop links and mentions (and emoji if asked), collapse white space; null gives ``""``."""
    out = F.regexp_replace(F.regexp_replace(text, URL, ""), MENTION, "")
    if emoji is not None:
        out = strip_emoji(out, emoji)
    return F.coalesce(collapse_spaces(out), F.lit(""))


def safe_text(text: Column) -> Column:
    """Replace markdown links by their text, drop bare links, collapse white space."""
    out = F.regexp_replace(F.regexp_replace(text, MARKDOWN_LINK, "$1"), URL, "")
    return F.coalesce(collapse_spaces(out), F.lit(""))


def text_hash(text: Column) -> Column:
    """SHA-256 of the lower-cased text."""
    return F.sha2(F.lower(text), 256)


def word_count(text: Column, collapsed: bool = False) -> Column:
    """Number of words; null and blank text have none.

    Counts blanks rather than building an array of words.  ``collapsed`` says the
    text already went through :func:`clean_text` or :func:`safe_text`.
    """
    flat = text if collapsed else collapse_spaces(text)
    blanks = F.octet_length(flat) - F.octet_length(F.replace(flat, F.lit(" "), F.lit("")))
    return F.when(F.coalesce(flat, F.lit("")) == "", 0).otherwise(blanks + 1).cast("int")


def tokens(text: Column, stop_words=STOP_WORDS) -> Column:
    """Lower-cased words of two or more characters, stop words removed."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))
    # array_except would also drop repeats, which term counts need
    return F.filter(found, lambda w: ~w.isin(*stop_words)) if stop_words else found


def unigrams_and_bigrams(words: Column) -> Column:
    """The words themselves followed by each adjacent pair joined by a blank."""
    pairs = F.zip_with(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.concat(words, pairs)


def epoch_to_timestamp(value: Column, default: Column | None = None) -> Column:
    """Epoch seconds (number or text) or an ISO text to a timestamp; anything else is null or ``default``.

    Session time zone must be UTC for texts without an offset.
    """
    seconds = value.try_cast("double")
    in_range = seconds.between(-62135596800, 253402300799)  # years 1 to 9999
    stamp = F.coalesce(
        F.when(in_range, F.timestamp_seconds(seconds)), F.try_to_timestamp(value.cast("string"))
    )
    return stamp if default is None else F.coalesce(stamp, default)


def first_int(text: Column) -> Column:
    """First signed integer in a text, else 0."""
    return F.coalesce(F.regexp_extract(text, r"-?\d+", 0).try_cast("bigint"), F.lit(0).cast("bigint"))


def long_or_zero(value: Column) -> Column:
    """Whole-number value of a JSON scalar held as text; fractions are cut, anything else is 0."""
    return F.coalesce(
        value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint")
    )


def query_param(url: Column, name: str) -> Column:
    """Raw value of a query parameter in a link, or null."""
    return F.nullif(F.regexp_extract(url, f"[?&]{re.escape(name)}=([^&]+)", 1), F.lit(""))


def absolute_url(url: Column, base: str) -> Column:
    """Prefix site-relative links with ``base``."""
    return F.when(F.startswith(url, F.lit("/")), F.concat(F.lit(base), url)).otherwise(url)
