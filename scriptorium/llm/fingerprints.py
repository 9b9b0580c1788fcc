"""Document fingerprints by consistent weighted sampling.

Each of `SAMPLES` samples draws, for every word of a text, gamma variables r and c of shape 2 and a
uniform b, all fixed by a hash of word and sample. A word of weight w (its count) gets t = floor(ln w / r
+ b) and a = c / (exp(r (t - b)) exp(r)). The sample is the pair of word and t of least a. Two texts
agree in a sample with the probability of their generalised Jaccard similarity, the sum of the smaller
weights over the sum of the larger ones. Everything is made of built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 64
# Samples drawn in one aggregate: two columns each, few enough for Spark to generate small methods.
DRAWN_TOGETHER = 16
RANGES_PER_PARTITION = 8
_NO_KEY = -(2**63)
_BLANKS = " \t\n\x0b\f\r"


def _uniform(bits: Column, shift: int, width: int) -> Column:
    """`width` bits of a hash as a number strictly between 0 and 1."""
    part = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1))
    return (part + F.lit(0.5)) * F.lit(1.0 / (1 << width))


def samples_of(word: Column, log_weights: list[Column], j: Column) -> list[Column]:
    """For each weight of a word, a long in the order of a whose low 32 bits name the word and its t.

    A gamma variable of shape 2 is minus the logarithm of a product of two uniform ones. A missing weight
    (a word that a text lacks) gives no sample.
    """
    bits = F.xxhash64(word, j)
    r = -F.log(_uniform(bits, 0, 12) * _uniform(bits, 12, 12))
    log_c = F.log(-F.log(_uniform(bits, 24, 14) * _uniform(bits, 38, 14)))
    b = _uniform(bits, 52, 12)
    out = []
    for log_weight in log_weights:
        t = F.floor(log_weight / r + b)
        log_a = log_c - r * (t - b) - r
        name = word.bitwiseXOR(F.shiftleft(t, 20)).bitwiseAND(F.lit((1 << 32) - 1))
        out.append(F.shiftleft(F.floor((log_a + 128) * F.lit(float(1 << 22))).cast("bigint"), 32).bitwiseOR(name))
    return out


def signatures(words: DataFrame, owner: list[str], samples: int = SAMPLES) -> DataFrame:
    """(owner…, signature, edited) from one row (owner…, kind, word bigint) per word; kind 1 is the edited text.

    A word that both texts of an owner have is one row, whose random variables are drawn once for both.
    """
    weight = lambda kind: F.log(F.nullif(F.count_if(F.col("kind") == kind), F.lit(0)).cast("double"))
    counts = words.groupBy(*owner, "word").agg(weight(0).alias("own"), weight(1).alias("new"))
    together = min(samples, DRAWN_TOGETHER)
    parts = -(-samples // together)
    drawn = counts.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    least = []
    for j in range(together):
        own, new = samples_of(F.col("word"), [F.col("own"), F.col("new")], F.lit(j) + F.lit(together) * F.col("part"))
        least += [F.min(own).alias(f"own{j}"), F.min(new).alias(f"new{j}")]
    low = lambda kind: F.array(*(F.col(f"{kind}{j}").bitwiseAND(F.lit((1 << 32) - 1)) for j in range(together)))
    by_part = drawn.groupBy(*owner, "part").agg(*least).select(*owner, "part", low("own").alias("own"), low("new").alias("new"))
    gathered = by_part.groupBy(*owner).agg(F.sort_array(F.collect_list(F.struct("part", "own", "new"))).alias("parts"))
    whole = lambda kind: F.slice(F.flatten(F.col(f"parts.{kind}")), 1, samples)
    return gathered.select(*owner, whole("own").alias("signature"), whole("new").alias("edited"))


def likeness(left: Column, right: Column) -> Column:
    """The share of samples in which two signatures agree."""
    same = F.aggregate(F.zip_with(left, right, lambda a, b: (a == b).cast("int")), F.lit(0), lambda n, x: n + x)
    return same / F.size(left)


def as_text(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def words_of(text: Column) -> Column:
    """The words of a text; an empty one for a text without words."""
    return F.split(F.trim(text, F.lit(_BLANKS)), r"[\x20\x09-\x0D]+")


def _neighbours(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(range, place, key, text, next, extra): rows in descending key order, each with the next row's text.

    Keys are cut into ranges at keys that exist, so the first row of a range is known beforehand; it is
    sent to the range above as well, as an extra row that follows the last one. The largest key follows
    the smallest. Every text is shuffled once, and no range is larger than its share.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(_NO_KEY)).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = partitions * RANGES_PER_PARTITION
    cuts, last = rows.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 20 * n), F.max("key")).first()
    cuts = sorted({c for c in cuts or () if c != last})
    own = F.lit(0)
    if cuts:
        bounds = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
        own = F.size(F.filter(bounds, lambda c: c < F.col("key")))
        also = F.when(F.array_contains(bounds, F.col("key")), F.array(F.struct((own + 1).alias("range"), F.col("key").alias("order"))))
    else:
        also = F.lit(None).cast("array<struct<range: int, order: bigint>>")
    first = F.when(F.col("key") == F.lit(last), F.array(F.struct(F.lit(0).alias("range"), F.lit(None).cast("bigint").alias("order"))))
    none = F.array().cast("array<struct<range: int, order: bigint>>")
    home = F.array(F.struct(own.alias("range"), F.col("key").alias("order")))
    places = F.posexplode(F.concat(home, F.coalesce(also, none), F.coalesce(first, none)))
    dealt = rows.select("key", "text", places.alias("extra", "at")).select("key", "text", (F.col("extra") > 0).alias("extra"), "at.*")
    dealt = dealt.repartition(partitions, "range")
    # The order names the key too, so that all readers ask for the same columns and share one shuffle of the texts.
    order = Window.partitionBy("range").orderBy("extra", F.desc_nulls_last("order"), F.xxhash64("text"), "key")
    return dealt.select(
        "range", "key", "text", "extra", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("next")
    )


def fingerprint_report(docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row.

    The edited text is the whole text with its last floor(n / 3) characters replaced by the first as many
    of the next text in descending key order; the largest key follows the smallest. A missing text counts
    as empty, and texts without words are all alike. A missing key is the smallest; equal keys follow in
    order of a hash of their texts, so repeated rows are neighbours; an empty table gives no rows.
    """
    near = _neighbours(docs, key, text)
    n, cut = F.char_length("text"), F.expr("char_length(text) div 3")
    edited = F.concat(F.substring("text", F.lit(1), (n - cut).cast("int")), F.substring("next", F.lit(1), cut.cast("int")))
    texts = F.when(F.col("extra"), F.array(F.col("text"))).otherwise(F.array(F.col("text"), edited))
    both = near.select("range", "place", F.posexplode(texts).alias("kind", "whole"))
    spelt = both.select("range", "place", "kind", F.explode(words_of(F.col("whole"))).alias("word"))
    words = spelt.select("range", "place", "kind", F.xxhash64("word").alias("word"))
    in_range = Window.partitionBy("range").orderBy("place")
    signed = signatures(words, ["range", "place"], samples)
    prints = signed.withColumn("next", F.lead("signature").over(in_range)).withColumnsRenamed({"range": "__range", "place": "__place"})
    facts = near.filter(~F.col("extra")).select("range", "place", "key", n.cast("bigint").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"))
    joined = facts.join(prints, (F.col("range") == F.col("__range")) & (F.col("place") == F.col("__place")))
    return joined.select(
        F.when(F.col("key") != _NO_KEY, F.col("key")).alias(key),
        "n_chars",
        "edited_sha256",
        as_text(F.col("signature")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next")).alias("near_next"),
    )
