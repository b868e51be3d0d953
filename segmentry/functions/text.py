"""Text expressions. White space and word characters mean the Unicode sets, not Java's ASCII default."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from segmentry import fixed_values as fv
from segmentry.functions.numeric import round_even

# All Unicode white space, including the four ASCII separators; word characters.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)
WORD = r"[\p{L}\p{N}_]"

# After ``blank_space`` a blank is the only white space left, which keeps the patterns cheap.
URL = r"https?://[^ ]+|www\.[^ ]+"
# An address match always covers a whole run of non-space, so it may only start where a run starts;
# without that anchor a long run would be scanned once per character.
EMAIL = r"(?<![^ ])[^ ]+@[^ ]+\.[^ ]+"
# Every character that composition can change, or combine with, lies at or above U+0300.
MAY_COMPOSE = "[^\\x{0}-\\x{2ff}]"


def nfc(text: Column) -> Column:
    """Canonical composition by the ICU library on Spark's own class path.

    Texts made only of characters below U+0300 are composed already and skip the call.
    """
    composed = F.java_method(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(False)
    )
    return F.when(text.rlike(MAY_COMPOSE), composed).otherwise(text)


def strip_space(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def blank_space(text: Column) -> Column:
    """Every white-space character becomes a blank."""
    return F.translate(text, SPACE_CHARS, " " * len(SPACE_CHARS))


def collapse_blanks(text: Column) -> Column:
    """Every run of blanks becomes one, none at the ends."""
    return F.trim(F.regexp_replace(text, " {2,}", " "))


def clean_text(
    text: Column,
    remove_urls: bool = True,
    remove_emails: bool = True,
    max_chars: int | None = None,
) -> Column:
    """Cleaned text: composed, tags, addresses and surplus white space removed; null gives "".

    ``max_chars`` cuts the finished text (``truncation_limit()`` gives the usual bound); by default
    the whole text is kept.
    """
    out = blank_space(nfc(F.coalesce(text, F.lit(""))))
    out = F.regexp_replace(out, fv.HTML_TAG, " ")
    if remove_urls:
        out = F.regexp_replace(out, URL, " ")
    if remove_emails:
        # Most texts hold no address; there a pattern that cannot match replaces the costly one. The
        # text itself appears once, so it is cleaned once.
        pattern = F.when(F.contains(text, F.lit("@")), F.lit(EMAIL)).otherwise(F.lit("@"))
        out = F.regexp_replace(out, pattern, F.lit(" "))
    out = collapse_blanks(out)
    return F.substring(out, 1, max_chars) if max_chars is not None else out


def truncation_limit(max_tokens: int = fv.MAX_TOKENS) -> int:
    return max_tokens * fv.CHARS_PER_TOKEN


def is_long_enough(clean: Column, min_length: int = fv.MIN_CLEAN_CHARS) -> Column:
    return F.length(clean) >= F.lit(min_length)


def fingerprint(clean: Column) -> Column:
    return F.sha2(clean.cast("binary"), 256)


def word_count(text: Column) -> Column:
    """White-space separated tokens; empty and blank texts have none."""
    spaced = F.ltrim(blank_space(F.coalesce(text, F.lit(""))))
    # Each token with the blanks behind it shrinks to one character.
    return F.length(F.regexp_replace(spaced, "[^ ]+ *", "x"))


def words(text: Column) -> Column:
    """Lower-case words in order, duplicates kept."""
    # Cutting at what is no word is several times as fast as collecting matches; ends that are no word leave empty pieces.
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), f"[^{WORD[1:-1]}]+"), "")


def _lexicon_hits(text: Column) -> Column:
    """The distinct lexicon words a text contains. Only lexicon words are materialised."""
    alternatives = "|".join(fv.POSITIVE_WORDS + fv.NEGATIVE_WORDS)
    pattern = f"(?<!{WORD})(?:{alternatives})(?!{WORD})"
    return F.array_distinct(
        F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(pattern), F.lit(0))
    )


def sentiment_proxy(text: Column) -> Column:
    """(p - n) / (p + n) over distinct positive and negative words, 0 without any; three places."""

    def add(seen: Column, word: Column) -> Column:
        sign = F.when(word.isin(fv.POSITIVE_WORDS), 1).otherwise(-1)
        return F.struct((seen["score"] + sign).alias("score"), (seen["words"] + 1).alias("words"))

    nothing = F.struct(F.lit(0).alias("score"), F.lit(0).alias("words"))
    return F.aggregate(
        _lexicon_hits(text),
        nothing,
        add,
        lambda seen: F.when(
            seen["words"] > 0, round_even(seen["score"] / F.nullif(seen["words"], F.lit(0)), 3)
        ).otherwise(F.lit(0.0)),
    )
