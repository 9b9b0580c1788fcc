"""Small documents with everything that is awkward: nulls, blanks, copies, long texts, clashing columns."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, n bigint, row string"


def rows(seed: int = 1, n: int = 80) -> list[tuple]:
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(900)]
    out = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, 800)
            words += base[at : at + rng.randint(3, 80)] if rng.random() < 0.6 else [f"x{rng.randint(0, 500)}," for _ in range(rng.randint(1, 60))]
        text = rng.choice([" ", "\n", "\t ", "  "]).join(words)
        if i % 9 == 0:
            text += "\nLicensed under the Apache License, Version 2.0.\n" + "same line\n" * rng.randint(0, 3)
        out.append((i * 3, text, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c"]), len(text)))
    text = out[5][1]
    long = " ".join(base * 12) + "\n" + "é" * 9000 + " 日本語 <|endoftext|> " + " " * 700 + "'s don't 12 345"
    out += [(1000, text, "en", "a", None), (1000, text, "en", "a", None), (1001, None, "en", "a", 0), (1002, "", None, None, 0)]
    out += [(1003, " \n\t ", "fr", "b", 4), (None, out[7][1], None, "c", None), (1004, long, "fr", "c", len(long)), (1005, "one Two", "en", None, 7)]
    out += [(1006, "!!! 123", "en", "a", 7)]
    return [(*r, "k", 7, "x") for r in out]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(found) -> list[tuple]:
    return sorted(map(tuple, found), key=str)
