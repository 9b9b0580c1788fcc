import random

import pytest
from pyspark.sql import functions as F

import restated
from scriptorium.functions import stylometry, text
from scriptorium.functions.profiles import ARABIC, UNICODE_BLANKS

EDGES = [
    None,
    "",
    "   ",
    "Latin only, 123",
    "ًٌْ",
    "ٰٕٓٔ",
    "كتـــاب",
    "في، البيت",
    "٣٤٥ ١",
    "a:b：c",
    "إلى الي من من بيت بيت بيت",
    "بيت في نحن",
    "  أنا كتبت هنا كتبنا انا",
    "بت بنا كبت كبنا ذهبت",
    "\U0001f600 بيت \U0001f600",
    "بيت\x1cفي\x85من　على",
]


def random_texts(n, seed=7):
    rng = random.Random(seed)
    letters = [chr(c) for c in range(0x621, 0x656)] + ["ٰ", "،", "١", "a", "Z", "7", ":", "：", "é", "\U0001f600"]
    words = list(ARABIC.stopwords + ARABIC.particles + ARABIC.pronouns)
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 12)):
            parts.append(rng.choice(words) if rng.random() < 0.3 else "".join(rng.choices(letters, k=rng.randint(1, 7))))
            parts.append(rng.choice(UNICODE_BLANKS) if rng.random() < 0.4 else " ")
        yield "".join(parts)


@pytest.fixture(scope="module")
def samples(spark):
    rows = EDGES + list(random_texts(2000))
    return spark.createDataFrame(list(enumerate(rows)), "i int, text string").repartition(8).cache()


@pytest.mark.parametrize(
    "make, expected",
    [
        (text.strip_diacritics, restated.bare),
        (text.preprocess_text, restated.cleaned),
        (stylometry.count_diacritics, restated.diacritics),
        (stylometry.count_colons, restated.colons),
        (stylometry.count_particles, restated.particles),
        (stylometry.count_first_person, restated.first_person),
    ],
)
def test_column_functions_follow_the_rules(samples, make, expected):
    for row in samples.select("text", make("text").alias("out")).collect():
        assert row.out == expected(row.text), repr(row.text)


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "text string").select(make("text").alias("out")).first().out


def test_normalisation_steps(spark):
    assert one(spark, "مِثَالٌ", text.strip_diacritics) == "مثال"
    assert one(spark, "كتـــاب", text.strip_tatweel) == "كتاب"
    assert one(spark, "إأآىؤئـ", text.fold_letters) == "ااايوي"
    assert one(spark, " abc بيت، 12 ٣ بيت\n", text.keep_script_range) == "بيت، ٣ بيت"
    assert one(spark, "من بيت إلى بيت\tمن", text.remove_stopwords) == "بيت بيت"
    for make in (text.strip_diacritics, text.strip_tatweel, text.fold_letters, text.keep_script_range, text.remove_stopwords):
        assert one(spark, None, make) == ""


def test_folded_text_escapes_unfolded_stopwords(spark):
    assert one(spark, "إلى على أن من", text.preprocess_text) == "الي علي ان"


def test_lengths_and_tokens(spark):
    assert one(spark, "", text.word_count) == 1
    assert one(spark, "a b", text.word_count) == 2
    assert one(spark, None, text.word_count) is None
    assert one(spark, " A  b", text.ml_tokenize) == ["", "a", "", "b"]
    assert one(spark, "", text.ml_tokenize) == [""]
    assert one(spark, "  a b ", text.clean_words) == ["a", "b"]
    pairs = lambda c: text.bigrams(text.ml_tokenize(c))
    assert one(spark, "a b c", pairs) == ["a b", "b c"]
    assert one(spark, "a", pairs) == []
    assert one(spark, "x" * 100, text.text_preview) == "x" * 80


def test_cleaning_is_planned_without_python_and_only_once(spark, sf_dir):
    from scriptorium.plans import tables

    plan = tables.styled_corpus(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert plan.count("[^؀-ۿ]+") == 1


def test_ml_tokens_lose_only_blanks_at_the_end(spark):
    assert one(spark, "a  b \t\n\x0b\f\r", text.ml_tokenize) == ["a", "", "b"]
    assert one(spark, " \r\n ", text.ml_tokenize) == []
    assert one(spark, "a\u00a0 \u2003", text.ml_tokenize) == ["a\u00a0", "\u2003"]
