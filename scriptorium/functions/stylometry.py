"""Stylometric counts over raw text, as Catalyst expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.profiles import ARABIC, UNICODE_BLANKS, TextProfile
from scriptorium.functions.text import _col, _text, char_count, clean_tokens

COUNT_COLUMNS = ("f_diacritics", "f_colons", "f_particles", "f_first_person")


def count_diacritics(text: Column | str, profile: TextProfile = ARABIC) -> Column:
    """Number of vowel marks, including the rarer ones that cleaning keeps."""
    return F.length(_text(text)) - F.length(F.translate(_text(text), profile.counted_marks, ""))


def count_colons(text: Column | str, profile: TextProfile = ARABIC) -> Column:
    """Number of colons, ASCII and full-width."""
    text = _text(text)

    def occurrences(mark: str) -> Column:
        lost = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))
        return (lost / len(mark.encode())).cast("int")

    return reduce(lambda a, b: a + b, map(occurrences, profile.colons))


def surface_text(text: Column | str, profile: TextProfile = ARABIC) -> Column:
    """The raw text without the marks that cleaning strips, every Unicode blank turned into a space."""
    return F.translate(_text(text), UNICODE_BLANKS + profile.stripped_marks, " " * len(UNICODE_BLANKS))


def surface_words(surface: Column | str) -> Column:
    """Words of a surface text, letters unfolded, punctuation attached.

    Empty pieces between blanks stay; no word list holds the empty word.
    """
    return F.split(_col(surface), " ")


def _diacritics_from_surface(text: Column | str, surface: Column | str, profile: TextProfile) -> Column:
    """Marks that `surface` lacks, plus the counted ones that it keeps, looked for only where there are any."""
    kept = "".join(m for m in profile.counted_marks if m not in profile.stripped_marks)
    rare = F.when(_col(surface).rlike(f"[{kept}]"), F.size(F.split(_col(surface), f"[{kept}]")) - 1).otherwise(0)
    return F.length(_text(text)) - F.length(_col(surface)) + rare


def count_particles_in(words: Column | str, profile: TextProfile = ARABIC) -> Column:
    return F.size(F.filter(_col(words), lambda w: w.isin(*profile.particles)))


def count_first_person_in(words: Column | str, profile: TextProfile = ARABIC) -> Column:
    """Pronouns, or words long enough that end in a first-person suffix.

    Folding is one letter to one letter, so instead of folding every word the few list entries are
    spelled out in all unfolded forms. A pronoun is too short to match a suffix as well.
    """
    pronouns = [s for p in profile.folded_pronouns() for s in profile.spellings(p)]
    suffixes = [s for x in profile.person_suffixes for s in profile.spellings(x)]

    def is_marker(w: Column) -> Column:
        has_suffix = reduce(lambda a, b: a | b, (F.endswith(w, F.lit(s)) for s in suffixes))
        return w.isin(*pronouns) | ((F.length(w) >= profile.person_min_length) & has_suffix)

    return F.size(F.filter(_col(words), is_marker))


def count_particles(text: Column | str, profile: TextProfile = ARABIC) -> Column:
    """Number of function words of the particle list, as written in the text."""
    return count_particles_in(surface_words(surface_text(text, profile)), profile)


def count_first_person(text: Column | str, profile: TextProfile = ARABIC) -> Column:
    """Number of first-person pronouns and first-person verb endings."""
    return count_first_person_in(surface_words(surface_text(text, profile)), profile)


def with_clean_text(df: DataFrame, text: str = "text", profile: TextProfile = ARABIC) -> DataFrame:
    """Add ``text_clean``, ``char_count`` and ``word_count``, each text being split once.

    As a text without words counts one, the word count is that of the kept words, or one.
    """

    def joined_and_counted(words: Column) -> Column:
        return F.struct(
            F.array_join(words, " ").alias("text_clean"), F.greatest(F.size(words), F.lit(1)).alias("word_count")
        )

    cleaned = F.transform(F.array(clean_tokens(text, profile)), joined_and_counted)
    return df.select("*", F.inline(cleaned)).withColumn("char_count", char_count("text_clean"))


def with_style_counts(df: DataFrame, text: str = "text", profile: TextProfile = ARABIC) -> DataFrame:
    """Add the four counts, which share the surface text and one split of it."""
    return (
        df.withColumn("__surface", surface_text(text, profile))
        .withColumn("__words", surface_words("__surface"))
        .withColumns(
            {
                "f_diacritics": _diacritics_from_surface(text, "__surface", profile),
                "f_colons": count_colons(text, profile),
                "f_particles": count_particles_in("__words", profile),
                "f_first_person": count_first_person_in("__words", profile),
            }
        )
        .drop("__surface", "__words")
    )
