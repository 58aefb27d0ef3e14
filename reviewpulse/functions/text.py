"""Column expressions over review text. All of them are built-in, code-generated functions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V

# Every character that counts as white space in Unicode text (plus the four ASCII separators):
# as a trim set and as a pattern class.
_SPACE_CODES = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
                *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACE_CHARS = "".join(map(chr, _SPACE_CODES))
SPACE_CLASS = r"\s\x1c-\x1f"


def strip(text: Column) -> Column:
    """Strip Unicode white space. A trim set stops at the first other character, so no regex scan."""
    return F.trim(text, F.lit(SPACE_CHARS))


def normalize_text(text: Column) -> Column:
    return strip(F.coalesce(text, F.lit("")))


def preprocess_text(text: Column) -> Column:
    """Lower-case, replace links by a space, collapse white space, strip last."""
    lowered = F.lower(text)
    url = "(?U)" + V.URL_PATTERN.replace(r"\S", f"[^{SPACE_CLASS}]")
    # Most texts hold no link; two substring searches are cheaper than the pattern.
    no_links = F.when(
        lowered.contains("://") | lowered.contains("www."), F.regexp_replace(lowered, url, " ")
    ).otherwise(lowered)
    return strip(F.regexp_replace(no_links, f"(?U)[{SPACE_CLASS}]+", " "))


def text_hash(clean: Column) -> Column:
    return F.md5(clean)


def collection_text_hash(content: Column) -> Column:
    """Hash taken at collection time: case kept, empty text stays empty."""
    return F.when(content == "", F.lit("")).otherwise(F.md5(content))


def has_text(text: Column) -> Column:
    return normalize_text(text) != ""


def at_most_two_symbols(text: Column) -> Column:
    """True when the text uses at most two different characters.

    Trims the first character off the left, then the first two; anything left over
    starts with a third character. Stops early on ordinary text.
    """
    first = F.substr(text, F.lit(1), F.lit(1))
    rest = F.ltrim(text, first)
    second = F.substr(rest, F.lit(1), F.lit(1))
    return (rest == "") | (F.ltrim(rest, F.concat(first, second)) == "")


def is_noise(clean: Column) -> Column:
    """Noise rule on the pre-processed (lower-cased, stripped) text."""
    return (
        ~clean.rlike(r"\p{L}")
        | ((F.length(clean) >= 6) & at_most_two_symbols(clean))
        | ((F.length(clean) <= 4) & clean.isin(V.LOW_INFORMATION_WORDS))
    )


def _mentions(text: Column, words: list[str], word_boundary: bool) -> Column:
    if word_boundary:
        return text.rlike(r"\b(?:" + "|".join(words) + r")\b")
    return reduce(or_, [text.contains(w) for w in words])


def sentiment_keyword(clean: Column, word_boundary: bool = False) -> Column:
    """Keyword label. Keywords match anywhere in the text unless ``word_boundary`` is set."""
    positive = _mentions(clean, V.POSITIVE_KEYWORDS, word_boundary)
    negative = _mentions(clean, V.NEGATIVE_KEYWORDS, word_boundary)
    return (
        F.when(positive & ~negative, "positive")
        .when(negative & ~positive, "negative")
        .otherwise("neutral")
    )


def inconsistent_rating(score: Column, sentiment: Column) -> Column:
    """Low stars with praise or high stars with complaints; an unknown score is never inconsistent."""
    return F.coalesce(
        ((score <= 2) & (sentiment == "positive")) | ((score >= 4) & (sentiment == "negative")),
        F.lit(False),
    )


def words(text: Column) -> Column:
    """Lower-cased runs of two or more ASCII letters, stop words still included."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z]{2,}"), F.lit(0))


def language_name(code: Column) -> Column:
    """English display name of a language code; the lookup table is a fixed 50-entry literal."""
    key = F.replace(F.lower(strip(code)), F.lit("_"), F.lit("-"))
    names = F.create_map(*[F.lit(x) for pair in V.LANGUAGE_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, key), F.concat(F.lit("Other language ("), key, F.lit(")")))
