"""Cleaning and tokenising as Catalyst expressions. No function here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptorium.functions.profiles import ARABIC, UNICODE_BLANKS, TextProfile


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def strip_diacritics(text: Column | str, profile: TextProfile = ARABIC) -> Column:
    """Remove the vowel marks of the profile; NULL becomes the empty string."""
    return F.translate(_text(text), profile.stripped_marks, "")


def strip_tatweel(text: Column | str, profile: TextProfile = ARABIC) -> Column:
    """Remove the letter-stretching character."""
    return F.replace(_text(text), F.lit(profile.elongation), F.lit(""))


def fold_letters(text: Column | str, profile: TextProfile = ARABIC) -> Column:
    """Unify letter variants and drop the stretching character in one pass."""
    sources, targets = zip(*profile.folds)
    return F.translate(_text(text), "".join(sources) + profile.elongation, "".join(targets))


def _outside_script(profile: TextProfile) -> str:
    return f"[^{profile.range_first}-{profile.range_last}]+"


def keep_script_range(text: Column | str, profile: TextProfile = ARABIC) -> Column:
    """Everything outside the script becomes one space between words; the ends are trimmed."""
    return F.trim(F.regexp_replace(_text(text), _outside_script(profile), " "))


def remove_stopwords(text: Column | str, profile: TextProfile = ARABIC) -> Column:
    """Drop list members; the other words keep their order and repetitions."""
    words = F.split(F.translate(_text(text), UNICODE_BLANKS, " " * len(UNICODE_BLANKS)), " ")
    return F.array_join(F.filter(words, lambda w: ~w.isin("", *profile.stopwords)), " ")


def clean_tokens(text: Column | str, profile: TextProfile = ARABIC) -> Column:
    """The words that cleaning keeps: marks, folding, script range and stopwords in that order.

    One translate covers the marks, the stretching character and the folding. No blank lies inside the
    script range, so splitting at everything outside of it yields the words. The stopword list is
    matched as written against folded text.
    """
    sources, targets = zip(*profile.folds)
    dropped = profile.stripped_marks + profile.elongation
    folded = F.translate(_text(text), "".join(sources) + dropped, "".join(targets))
    words = F.split(folded, _outside_script(profile))
    return F.filter(words, lambda w: ~w.isin("", *profile.stopwords))


def preprocess_text(text: Column | str, profile: TextProfile = ARABIC) -> Column:
    """The full cleaning chain as text: the kept words joined by single spaces."""
    return F.array_join(clean_tokens(text, profile), " ")


def char_count(clean: Column | str) -> Column:
    return F.length(_col(clean))


def word_count(clean: Column | str) -> Column:
    """Number of whitespace-separated pieces; the empty string counts as one."""
    return F.size(F.split(_col(clean), r"\s+"))


def clean_words(clean: Column | str) -> Column:
    """Whitespace words of a text, without the empty piece that blanks at the ends leave."""
    return F.filter(F.split(_col(clean), r"\s+"), lambda w: w != "")


def ml_tokenize(text: Column | str) -> Column:
    """Lower-case and split on each single whitespace character, keeping empty tokens but those at the end."""
    lowered = F.lower(_col(text))
    kept = F.rtrim(lowered, F.lit(" \t\n\x0b\f\r"))
    none = F.array().cast("array<string>")
    return F.when((lowered != "") & (kept == ""), none).otherwise(F.split(kept, r"\s"))


def bigrams(tokens: Column | str) -> Column:
    """Adjacent token pairs joined by a space; fewer than two tokens give an empty array."""
    tokens = _col(tokens)
    pairs = F.zip_with(
        F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))),
        F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return pairs


def text_preview(text: Column | str, length: int = 80) -> Column:
    """The first characters of a text, for display."""
    return F.substring(_col(text), 1, length)
