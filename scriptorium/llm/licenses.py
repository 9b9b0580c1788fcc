"""Licences of files: their lines, paragraphs, headers and whole texts compared with templates by sparse TF-IDF, then
inherited along directories.

A paragraph is a run of lines with terms, wrapped or behind comment marks; a header is the comment that a source file
begins with; a licence file is one whose whole text, or enough of it, is a licence. Everything is made of built-in
expressions and joins.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.license_texts import TEMPLATES
from scriptorium.session import through_table

LEAST_COSINE = 0.8
LEAST_SHARE = 0.05
_TERM = "[a-z0-9]+"
PARAGRAPH_BREAK = r"\n[^A-Za-z0-9\n]*\n"
COMMENT_LINE = r"^[ \t\r]*(\z|#|//|/\*|\*|--|;|%)"
Templates = Sequence[tuple[str, str]]


def terms_of(text: Column) -> Column:
    """Runs of a-z and 0-9 in the lower-cased text."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({_TERM})"), F.lit(1))


def _line_terms(files: DataFrame) -> DataFrame:
    """(terms) of every line that has terms."""
    lines = files.select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.select(terms_of(F.col("line")).alias("terms")).filter(F.size("terms") > 0)


def template_weights(files: DataFrame, templates: Templates) -> tuple[list[tuple[str, int, str, float]], dict[str, float], float, dict[str, int]]:
    """Unit TF-IDF weights (licence, template, term, weight), the idf of each template term and of other terms,
    and the frequency of each template term.

    Frequencies are those among all lines. Other terms weigh like a term of one line.
    """
    counted = [Counter(re.findall(_TERM, text.lower())) for _, text in templates]
    known = sorted({t for c in counted for t in c})
    found = _line_terms(files).select(F.explode(F.concat(F.array_intersect("terms", F.array(*map(F.lit, known))), F.array(F.lit("")))).alias("term"))
    frequency = {row["term"]: row["count"] for row in found.groupBy("term").count().collect()}
    n = frequency.pop("", 0)
    idf = {t: math.log((1 + n) / (1 + frequency.get(t, 0))) + 1 for t in known}
    weights = []
    for i, ((name, _), counts) in enumerate(zip(templates, counted, strict=True)):
        raw = {t: c * idf[t] for t, c in counts.items()}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        weights += [(name, i, t, raw[t] / norm) for t in sorted(raw)]
    return weights, idf, math.log((1 + n) / 2) + 1, frequency


def telling_terms(weights: list[tuple[str, int, str, float]], frequency: dict[str, int], least: float) -> list[str]:
    """Terms of which a text needs one to reach the cosine `least` with some template, as rare ones as possible.

    The most frequent terms of a template, as long as the root of their summed squares stays below `least`,
    cannot reach it by themselves, whatever else the text has.
    """
    telling = set()
    by_template: dict[int, list[tuple[int, str, float]]] = {}
    for _, i, term, weight in weights:
        by_template.setdefault(i, []).append((-frequency.get(term, 0), term, weight))
    for entries in by_template.values():
        told = 0.0
        for _, term, weight in sorted(entries):
            told += weight * weight
            if math.sqrt(told) >= least * 0.999:
                telling.add(term)
    return sorted(telling)


def units_of(files: DataFrame, telling: list[str]) -> DataFrame:
    """(file, total, kind, place, terms): lines (0), paragraphs (1), headers (2) and whole texts (3) that have one of
    the terms `telling`; `total` counts the terms of the whole text.

    A header is the lines up to the first one that is neither blank nor begins with a comment mark.
    """
    wanted = F.array(*map(F.lit, telling))
    whole = files.select("file", "text", terms_of(F.col("text")).alias("all")).filter(F.arrays_overlap("all", wanted))
    lines = F.split("text", "\n")
    end = F.array_position(F.transform(lines, lambda line: F.rlike(line, F.lit(COMMENT_LINE))), False)
    header = F.when(end == 0, F.col("text")).otherwise(F.array_join(F.slice(lines, F.lit(1), (end - 1).cast("int")), "\n"))
    pieces = [lines, F.split("text", PARAGRAPH_BREAK), F.array(header), F.array("text")]

    def tagged(piece: Column, kind: int) -> Column:
        return F.transform(piece, lambda t, i: F.struct(F.lit(kind).alias("kind"), i.alias("place"), t.alias("t")))

    units = F.concat(*(tagged(piece, kind) for kind, piece in enumerate(pieces)))
    each = whole.select("file", F.size("all").alias("total"), F.explode(units).alias("unit"))
    named = each.select("file", "total", "unit.kind", "unit.place", terms_of(F.col("unit.t")).alias("terms"))
    return named.filter(F.arrays_overlap("terms", wanted))


def license_units(files: DataFrame, templates: Templates = TEMPLATES, least: float = LEAST_COSINE) -> DataFrame:
    """(file, total, kind, place, n_terms, license, score): the best template of every unit that reaches `least`.

    Ties go by name. A file that is there twice counts once, as doubled counts would leave its cosines as they are.
    """
    spark = files.sparkSession
    weights, idf, other, frequency = template_weights(files, templates)
    unit = ["file", "total", "kind", "place"]
    # Units are dealt out once, as whole rows; all that follows goes by unit and moves nothing.
    near = units_of(files, telling_terms(weights, frequency, least)).groupBy(*unit).agg(F.first("terms").alias("terms"))
    counts = near.select(*unit, F.size("terms").alias("n_terms"), F.explode("terms").alias("term")).groupBy(*unit, "n_terms", "term").agg(F.count("*").alias("tf"))
    known = spark.createDataFrame([*idf.items()], "term string, idf double")
    weighted = counts.join(F.broadcast(known), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(other)))
    told = F.collect_list(F.when(F.col("idf").isNotNull(), F.struct("term", "w"))).alias("told")
    gathered = weighted.groupBy(*unit, "n_terms").agg(F.sum(F.col("w") * F.col("w")).alias("square"), told)
    each = gathered.select(*unit, "n_terms", "square", F.explode("told").alias("t")).select(*unit, "n_terms", "square", "t.term", "t.w")
    table = spark.createDataFrame([(t, name, i, w) for name, i, t, w in weights], "term string, license string, template int, share double")
    met = each.join(F.broadcast(table), "term")
    dots = met.groupBy(*unit, "n_terms", "license", "template").agg(F.sum(F.col("w") * F.col("share")).alias("dot"), F.first("square").alias("square"))
    scored = dots.withColumn("score", F.round(F.col("dot") / F.sqrt("square"), 6))
    reached = through_table(scored.filter(F.col("score") >= least).drop("dot", "square"), "license-terms")
    best = Window.partitionBy(*unit).orderBy(F.desc("score"), "license")
    ranked = reached.withColumn("nth", F.row_number().over(best)).filter("nth = 1")
    return ranked.select(*unit, "n_terms", "license", "score")


def _ancestors(directory: Column) -> Column:
    """The directory and all above it, nearest first; the root is the empty string."""
    parts = F.split(directory, "/")
    return F.transform(F.sequence(F.size(parts), F.lit(0), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def scan_licenses(
    files: DataFrame,
    path: str = "path",
    text: str = "text",
    key: str = "doc_id",
    templates: Templates = TEMPLATES,
    least: float = LEAST_COSINE,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """(key, path, license, score, origin, from_dir) of each file.

    `origin` is `header` where a line, a paragraph, the header or the whole text of the file itself is a licence (the
    best one), `inherited` where the nearest directory at or above the file's has a licence file, else `none`. A
    licence file is one whose licence lines, or paragraphs, or header, or whole text hold at least `least_share` of its terms; of several in
    a directory the best counts, then the first by path. A missing or empty text has no licence of its own; a file without a
    path inherits nothing and passes nothing on; a missing key stays missing; repeated rows give repeated
    results; an empty table gives none.
    """
    named = files.select(F.col(key).alias("key"), F.col(path).alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    named = named.withColumn("file", F.struct(F.coalesce("path", F.lit("")).alias("path"), F.coalesce(F.col("key").cast("string"), F.lit("")).alias("key")))
    hashed = F.sha2(F.concat_ws("\u0001", "file.path", "file.key", F.xxhash64("text").cast("string")), 256)
    named = named.withColumn("file", F.unhex(hashed))
    directory = F.when(F.col("path").isNotNull(), F.regexp_replace("path", "/?[^/]*$", ""))
    units = through_table(license_units(named.select("file", "text"), templates, least), "license-units")

    best = Window.partitionBy("file").orderBy(F.desc("score"), "license", "kind", "place")
    held = units.groupBy("file", "kind").agg(F.sum("n_terms").alias("held")).groupBy("file").agg(F.max("held").alias("held"))
    own = units.withColumn("nth", F.row_number().over(best)).filter("nth = 1").join(held, "file")
    sized = named.select("file", "path", directory.alias("dir")).join(own.select("file", "total", "license", "score", "held"), "file")
    own = own.select("file", "license", "score")
    official = sized.filter(F.col("dir").isNotNull() & (F.col("held") >= least_share * F.col("total")))
    in_dir = Window.partitionBy("dir").orderBy(F.desc("score"), "path", "license")
    rules = official.withColumn("nth", F.row_number().over(in_dir)).filter("nth = 1").select(
        F.col("dir").alias("from_dir"), F.col("license").alias("dir_license"), F.col("score").alias("dir_score")
    )
    dirs = named.select(directory.alias("dir")).filter(F.col("dir").isNotNull()).distinct()
    above = dirs.select("dir", F.posexplode(_ancestors(F.col("dir"))).alias("up", "from_dir")).join(rules, "from_dir")
    nearest = Window.partitionBy("dir").orderBy("up")
    inherited = above.withColumn("nth", F.row_number().over(nearest)).filter("nth = 1").drop("nth", "up")

    joined = named.select("key", "path", "file", directory.alias("dir")).join(own, "file", "left").join(inherited, "dir", "left")
    header, above_it = F.col("license").isNotNull(), F.col("dir_license").isNotNull()
    return joined.select(
        F.col("key").alias(key),
        F.col("path").alias(path),
        F.coalesce("license", "dir_license").alias("license"),
        F.coalesce("score", "dir_score").alias("score"),
        F.when(header, "header").when(above_it, "inherited").otherwise("none").alias("origin"),
        F.when(~header, F.col("from_dir")).alias("from_dir"),
    )
