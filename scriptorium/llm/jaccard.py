"""Exact Jaccard links between shingle sets by a token-group matrix, and the components they form.

1. Shingles that many documents of one batch share are counted (an order, not a filter). A set's tokens
   are ordered: uncommon ones by hash, then common ones from rare to frequent.
2. If two sets link, the first tokens of both share some. A set whose first tokens occur nowhere else
   often enough cannot link and is done.
3. The others are partitioned into groups of similar sets by their least token under a hash. Within a
   group, blocks of bounded size are compared and linked sets merged. One set of each merged group goes
   on to the next of `ROUNDS` rounds, with another hash.
4. The merged groups are the columns of the matrix: each has the union of its members' first tokens. A
   set's overlap with that union bounds its overlap with any member. Sizes and the places of a shared token in
   both orders bound the overlap already where token and group meet, so only groups that may reach what a link
   needs are opened: first their centre, for the visitor that shares most, then, if that does not link the two
   groups, all members in blocks, token by token.
5. Links between groups give the components.

A set is named by a 64-bit hash of its sorted tokens and its size. Equal sets are one set throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.batches import text_slices
from scriptorium.llm.words import full_grams, gram_hashes, mix, split_words, word_hashes
from scriptorium.session import through_table

SHINGLE = 5
BLOCK = 64
VISITORS = 256
ROUNDS = 4
COUNTED_TOKENS = 4_000_000
SEEN_OFTEN = 3
MOST_COMMON = 1_000_000
_NO_KEY = 2**63 - 1


def needed(size: np.ndarray) -> np.ndarray:
    """Least intersection of a set of this size with a set that it links with: ceil(3/4 size)."""
    return -(-3 * size // 4)


def extra(size: np.ndarray) -> np.ndarray:
    """How many first tokens a link has to share, for a set of this size."""
    return 1 + size // 16


def least_shared(size: np.ndarray) -> np.ndarray:
    """First tokens that a set shares with whatever it links with, whose size is 3/4 of its own at least."""
    return extra(needed(size))


def linked(left: np.ndarray, right: np.ndarray) -> bool:
    """Whether 100 · intersection >= 75 · union, for sorted arrays of distinct tokens."""
    small, large = sorted((left, right), key=len)
    if 4 * len(small) < 3 * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int(np.count_nonzero(large[at] == small))
    return 100 * both >= 75 * (len(small) + len(large) - both)


def shingle_sets(column: pa.Array, shingle: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words are one shingle, no words none."""
    words = split_words(column, lower=True)
    hashes = word_hashes(words)
    at, rows = full_grams(words.first, shingle)
    grams = gram_hashes(hashes, shingle)[at]
    bounds = np.searchsorted(rows, np.arange(len(words.first)))
    sets = []
    for i, n in enumerate(words.count()):
        if 0 < n < shingle:
            own = hashes[words.first[i] : words.first[i + 1]]
            sets.append(mix(gram_hashes(own, int(n)) + np.uint64(n)))
        else:
            sets.append(np.unique(grams[bounds[i] : bounds[i + 1]]))
    return sets


def set_name(tokens: np.ndarray) -> int:
    if not len(tokens):
        return 0
    places = np.arange(1, len(tokens) + 1, dtype=np.uint64)
    total = mix(tokens + mix(places)).sum(dtype=np.uint64)
    return int(mix(np.array([total + np.uint64(len(tokens))], np.uint64)).view(np.int64)[0])


def first_tokens(tokens: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The tokens that a link has to share some of, rare ones first; `common` has common tokens by frequency."""
    n = int(len(tokens) - needed(np.int64(len(tokens))) + extra(np.int64(len(tokens))))
    if not len(common[0]):
        return tokens[:n]
    at = np.minimum(np.searchsorted(common[0], tokens), len(common[0]) - 1)
    often = common[0][at] == tokens
    rare = tokens[~often]
    if len(rare) >= n:
        return rare[:n]
    rest = tokens[often][np.argsort(common[1][at[often]], kind="stable")]
    return np.concatenate([rare, rest[: n - len(rare)]])


def _often(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens that at least `SEEN_OFTEN` of the sets held have, and how many do."""
    tokens = np.sort(np.concatenate(held))
    begin = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])[: len(tokens)])
    n = np.diff(np.append(begin, len(tokens)))
    many = n >= SEEN_OFTEN
    return tokens[begin[many]].view(np.int64), n[many]


_DOCUMENT = "key bigint, digest bigint, n bigint, set bigint, token bigint"


def _named_and_counted(rows: DataFrame, shingle: int) -> DataFrame:
    """(key, digest, n, set) of each row, and (token, n) of shingles seen often by a task, from one reading.

    Every document is counted; a shingle counts where at least `SEEN_OFTEN` of the documents that a task holds
    at a time (`COUNTED_TOKENS` shingles) have it.
    """

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        tokens, n = _often(held)
        none = pa.nulls(len(tokens), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, pa.array(n), none, pa.array(tokens)], ["key", "digest", "n", "set", "token"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for part in text_slices(batch, "text"):
                sets = shingle_sets(part.column("text"), shingle)
                named = [pa.array([len(s) for s in sets], pa.int64()), pa.array([set_name(s) for s in sets], pa.int64())]
                columns = [part.column("key"), part.column("digest"), *named, pa.nulls(len(sets), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "digest", "n", "set", "token"])
                held.append(np.concatenate(sets))
                if sum(map(len, held)) >= COUNTED_TOKENS:
                    yield counted(held)
                    held = []
        if held:
            yield counted(held)

    return through_table(rows.mapInArrow(run, _DOCUMENT), "jaccard-documents")


def _common_tokens(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens of (token, n), sorted, with their place from rare to frequent.

    At most `MOST_COMMON` (16 MB) are kept; they only order tokens, so the result does not depend on them.
    """
    total = counts.groupBy("token").agg(F.sum("n").alias("n"))
    tokens = total.orderBy(F.desc("n"), "token").limit(MOST_COMMON).toArrow().column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.arange(len(tokens), 0, -1)[order]


def _sets_of(docs: DataFrame, common: tuple[np.ndarray, np.ndarray], shingle: int, asked: str | None = None) -> DataFrame:
    """(set, n, first) of each text that has words; with `asked`, the column of the set wanted, also its tokens and least hashes."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                sets = [(set_name(s), s) for s in shingle_sets(part.column("text"), shingle)]
                wanted = part.column(asked).to_pylist() if asked else [name for name, _ in sets]
                sets = [(name, s) for (name, s), w in zip(sets, wanted, strict=True) if len(s) and name == w]
                first = [first_tokens(s, shared.value).view(np.int64) for _, s in sets]
                columns = [pa.array([name for name, _ in sets], pa.int64()), pa.array([len(s) for _, s in sets], pa.int64())]
                columns.append(pa.array(first, pa.list_(pa.int64())))
                if asked:
                    keys = [[int(mix(s + np.uint64(i)).min().view(np.int64)) for i in range(ROUNDS)] for _, s in sets]
                    columns.append(pa.array([s.view(np.int64) for _, s in sets], pa.list_(pa.int64())))
                    columns.append(pa.array(keys, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["set", "n", "first", *["tokens", "keys"] * bool(asked)]
    schema = "set bigint, n bigint, first array<bigint>" + ", tokens array<bigint>, keys array<bigint>" * bool(asked)
    return docs.select("text", *[asked] * bool(asked)).mapInArrow(run, schema)


def _shared_enough(postings: DataFrame) -> DataFrame:
    """The sets of `postings` (token, set, need) that share at least `need` of their tokens with other sets."""
    tokens = Window.partitionBy("token")
    shared = postings.withColumn("__shared", F.min("set").over(tokens) != F.max("set").over(tokens)).filter("__shared")
    counts = shared.select("token", "set", "need").distinct().groupBy("set").agg(F.count("*").alias("shared"), F.max("need").alias("need"))
    return counts.filter("shared >= need").select("set")


def _merge_block(group: pd.DataFrame) -> pd.DataFrame:
    """(set, label): the centre of those that links within the block connect.

    The centre is the set that all blocks of the group share, else the one that stands for most others,
    then the one with most links.
    """
    group = group.sort_values(["n", "set"])
    tokens = [np.asarray(t, np.int64).view(np.uint64) for t in group["tokens"]]
    root = np.arange(len(tokens))
    links = np.zeros(len(tokens), np.int64)
    for i in range(len(tokens)):
        for j in range(i - 1, -1, -1):
            if 4 * len(tokens[j]) < 3 * len(tokens[i]):
                break
            if linked(tokens[i], tokens[j]):
                links[[i, j]] += 1
                root[root == root[i]] = root[j]
    found = pd.DataFrame({"set": group["set"].to_numpy(), "weight": group["weight"].to_numpy(), "links": links, "root": root})
    found["central"] = group["central"].to_numpy()
    best = found.sort_values(["central", "weight", "links", "set"], ascending=[False, False, False, True]).drop_duplicates("root").set_index("root")["set"]
    return pd.DataFrame({"set": found["set"], "label": best.loc[root].to_numpy()})


def _merge_groups(sets: DataFrame) -> DataFrame:
    """(set, label) after merging within groups of equal least hash, in rounds of bounded blocks.

    The set that stands for most others of its group joins every block of it. So near copies that link
    with a common source, but hardly with each other, gather around that source.
    """
    labels = through_table(sets.select("set", F.col("set").alias("label")), "jaccard-labels")
    in_group = Window.partitionBy("group")
    for i in range(ROUNDS):
        going = labels.groupBy("label").agg(F.count("*").alias("weight")).withColumnRenamed("label", "set")
        keyed = sets.select("set", "n", F.element_at("keys", i + 1).alias("group")).join(going, "set")
        centre = F.max(F.struct("weight", "set")).over(in_group)["set"]
        placed = keyed.withColumns({"size": F.count("*").over(in_group), "centre": centre}).filter("size > 1")
        place = F.expr(f"(row_number() OVER (PARTITION BY group ORDER BY n, set) - 1) div {BLOCK}")
        placed = through_table(placed.withColumn("block", place), "jaccard-blocks")
        own = placed.filter("set <> centre").select("set", "weight", "group", "block", F.lit(False).alias("central"))
        centres = own.select("group", "block").distinct().join(
            placed.filter("set = centre").select("set", "weight", "group", F.lit(True).alias("central")), "group"
        )
        members = own.unionByName(centres)
        blocks = members.join(sets.select("set", "n", "tokens"), "set")
        merged = blocks.groupBy("group", "block").applyInPandas(_merge_block, "set bigint, label bigint").filter("set <> label")
        step = through_table(merged.select(F.col("set").alias("label"), F.col("label").alias("next")), "jaccard-merged")
        labels = labels.join(step, "label", "left").select("set", F.coalesce("next", "label").alias("label"))
        labels = through_table(labels, "jaccard-labels")
    return labels


def _open_group(group: pd.DataFrame) -> pd.DataFrame:
    """(left, right): labels of visitors and of the group, once for each visitor that links with a member."""
    member = group["visits"].isna().to_numpy()
    tokens = [np.asarray(t, np.int64).view(np.uint64) for t in group["tokens"]]
    members = [t for t, m in zip(tokens, member, strict=True) if m]
    found: set[int] = set()
    labels = group["label"].to_numpy()
    for i in np.flatnonzero(~member):
        if labels[i] not in found and any(linked(tokens[i], t) for t in members):
            found.add(labels[i])
    return pd.DataFrame({"left": sorted(found), "right": group["opened"].iloc[0]}, columns=["left", "right"]).astype("int64")


def _linked_centres(best: DataFrame, sets: DataFrame) -> DataFrame:
    """(label, opened) of the visitors (set, label, opened) that link with the centre of the group opened.

    A group bears the name of its centre, which near copies of one source gather around.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, centre = (batch.column(c) for c in ("tokens", "centre"))
            keep = [linked(*(c[i].values.to_numpy().view(np.uint64) for c in (own, centre))) for i in range(batch.num_rows)]
            yield batch.select(["label", "opened"]).filter(pa.array(keep, pa.bool_()))

    centres = sets.select(F.col("set").alias("opened"), F.col("tokens").alias("centre"))
    pairs = best.join(sets.select("set", "tokens"), "set").join(centres, "opened").select("label", "opened", "tokens", "centre")
    return pairs.mapInArrow(run, "label bigint, opened bigint")


def _least_overlap(own: str, other: str) -> Column:
    """How many first tokens two sets of these sizes share at least if they link.

    They share 3/7 of both sizes together, and of those all but what lies behind the first tokens of the one whose
    first tokens end earlier. Between a group's least and greatest size the bound is least at one of them.
    """
    rest = lambda n: F.greatest(F.expr(f"(3 * {n} + 3) div 4 - 1 - {n} div 16"), F.lit(0))
    return F.expr(f"(3 * ({own} + {other}) + 6) div 7") - F.greatest(rest(own), rest(other))


def _links_between(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """(left, right): labels of merged groups that a link connects."""
    named = sets.join(labels, "set")
    # `rest` counts the first tokens of a set from this one on.
    postings = named.select("set", "label", "n", "need", F.size("first").alias("held"), F.posexplode("first").alias("place", "token"))
    postings = postings.withColumn("rest", F.col("held") - F.col("place")).drop("held", "place")
    tokens = Window.partitionBy("token")
    several = postings.withColumn("__several", F.min("label").over(tokens) != F.max("label").over(tokens)).filter("__several").drop("__several")
    several = through_table(several, "jaccard-postings")
    able = several.groupBy("set").agg(F.count("*").alias("shared"), F.max("need").alias("need")).filter("shared >= need").select("set")
    several = through_table(several.join(able, "set", "left_semi"), "jaccard-postings")
    unions = several.groupBy("token", F.col("label").alias("opened")).agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max("rest").alias("last")
    )
    sizes = (4 * F.col("n") >= 3 * F.col("least")) & (3 * F.col("n") <= 4 * F.col("most"))
    # Sets that link share so many first tokens that the first one shared has as many behind it in either set.
    enough = F.greatest(F.lit(1), F.least(_least_overlap("n", "least"), _least_overlap("n", "most")))
    ahead = (F.col("rest") >= enough) & (F.col("last") >= enough)
    met = several.join(unions, "token").filter((F.col("label") > F.col("opened")) & sizes & ahead)
    visits = through_table(met.groupBy("set", "label", "opened").agg(F.count("*").alias("shared")), "jaccard-visits")
    best = visits.groupBy("label", "opened").agg(F.max_by("set", F.struct("shared", "set")).alias("set"))
    best = through_table(best.select("set", "label", "opened"), "jaccard-best")
    near = through_table(_linked_centres(best, sets), "jaccard-links")
    # A group of one set is its centre, so whoever has met the centre is done with it.
    single = labels.groupBy(F.col("label").alias("opened")).agg(F.count("*").alias("size")).filter("size = 1").select("opened")
    done = best.join(single, "opened").select("set", "label", "opened")
    left = visits.drop("shared").join(near, ["label", "opened"], "left_anti").join(done, ["set", "label", "opened"], "left_anti")
    visits = through_table(left, "jaccard-visits")

    visiting = visits.withColumn("visits", F.expr(f"(row_number() OVER (PARTITION BY opened ORDER BY label, set) - 1) div {VISITORS}"))
    members = labels.join(visits.select(F.col("opened").alias("label")).distinct(), "label").select("set", F.col("label").alias("opened"))
    members = members.withColumn("block", F.expr(f"(row_number() OVER (PARTITION BY opened ORDER BY set) - 1) div {BLOCK}"))
    blocks = members.groupBy("opened").agg(F.max("block").alias("last"))
    turns = visiting.groupBy("opened").agg(F.max("visits").alias("last"))
    come = visiting.join(blocks, "opened").withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), "last"))).drop("last")
    stay = members.join(turns, "opened").withColumn("turn", F.explode(F.sequence(F.lit(0).cast("bigint"), "last"))).drop("last")
    none = F.lit(None).cast("bigint")
    both = come.select("set", "label", "opened", "block", F.col("visits").alias("turn"), "visits").unionByName(
        stay.select("set", none.alias("label"), "opened", "block", "turn", none.alias("visits"))
    )
    filled = both.join(sets.select("set", "tokens"), "set").withColumn("label", F.coalesce("label", F.lit(0)))
    far = filled.groupBy("opened", "block", "turn").applyInPandas(_open_group, "left bigint, right bigint")
    return near.select(F.col("label").alias("left"), F.col("opened").alias("right")).unionAll(far)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (left, right): the least node it is connected with.

    Labels pass along edges and then along labels, until none changes; every round is stored.
    """
    both = edges.select("left", "right").unionAll(edges.select(F.col("right").alias("left"), F.col("left").alias("right"))).distinct()
    both = through_table(both, "component-edges")
    labels = through_table(both.groupBy("left").agg(F.least(F.min("right"), F.col("left")).alias("label")), "component-labels")
    while True:
        near = both.join(labels.select(F.col("left").alias("right"), "label"), "right").groupBy("left").agg(F.min("label").alias("near"))
        jump = labels.select(F.col("left").alias("label"), F.col("label").alias("far"))
        stepped = labels.join(near, "left").join(jump, "label", "left")
        after = through_table(
            stepped.select("left", F.least("label", "near", "far").alias("label"), (F.least("near", "far") < F.col("label")).alias("moved")),
            "component-labels",
        )
        labels = after.select("left", "label")
        if after.filter("moved").isEmpty():
            return labels.select(F.col("left").alias("node"), F.col("label").alias("component"))


def _components_of(rows: DataFrame, shingle: int) -> DataFrame:
    """(key, digest, n, component) of each row of (key, digest, text); the component is one of its sets."""
    told = _named_and_counted(rows, shingle)
    named = told.filter(F.col("token").isNull()).drop("token")
    common = _common_tokens(told.filter(F.col("token").isNotNull()).select("token", "n"))
    need = F.expr("1 + (3 * n + 3) div 4 div 16")
    short = _sets_of(rows, common, shingle).select("set", need.alias("need"), F.explode("first").alias("token"))
    chosen = through_table(_shared_enough(short), "jaccard-chosen")
    speakers = named.filter("n > 0").join(chosen, "set").groupBy("set").agg(F.min(F.struct("key", "digest")).alias("speaker"))
    texts = rows.join(speakers.select("set", "speaker.*"), ["key", "digest"]).dropDuplicates(["key", "digest"])
    sets = through_table(_sets_of(texts, common, shingle, asked="set").withColumn("need", need), "jaccard-sets")
    labels = _merge_groups(sets)
    joined = components(_links_between(sets, labels))
    merged = labels.join(joined, F.col("label") == F.col("node"), "left").select("set", F.coalesce("component", "label").alias("component"))
    return named.join(merged, "set", "left").select("key", "digest", "n", F.coalesce("component", "set").alias("component"))


def _identity(key: str, text: str) -> list[Column]:
    """Key and text hash; a missing key is the largest."""
    digest = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    return [F.coalesce(F.col(key).cast("bigint"), F.lit(_NO_KEY)).alias("key"), digest.alias("digest")]


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, n_shingles, component_id) of each row's whole text.

    A text is lower-cased in A-Z and cut at ASCII blanks; its set holds its distinct `shingle`-word
    shingles, or with fewer words the whole sequence as one. Two documents link when 100 · intersection
    >= 75 · union; the component is the least key that links reach. A missing text or one without words
    has an empty set, links with nothing and is its own component. A row without a key links others
    through its text; its component is missing if it reaches no key. Repeated rows give repeated results;
    an empty table gives none.
    """
    whole = _components_of(docs.select(*_identity(key, text), F.col(text).alias("text")), shingle)
    least = whole.filter("n > 0").groupBy("component").agg(F.min("key").alias("least"))
    known = lambda c: F.when(F.col(c) != _NO_KEY, F.col(c))
    result = whole.join(least, "component", "left").select(
        known("key").alias("key"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, known("least")).otherwise(known("key")).alias("component_id")
    )
    return result.withColumnRenamed("key", key)


def keep_one_per_component(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The rows of `docs` that stay when each component keeps its row of least key, as they are.

    Rows without a key come last, equal keys go by text hash, and of equal rows one stays. Texts without
    words have no component and all stay.
    """
    named = docs.withColumns(dict(zip(("__key", "__digest"), _identity(key, text), strict=True)))
    whole = _components_of(named.select(F.col("__key").alias("key"), F.col("__digest").alias("digest"), F.col(text).alias("text")), shingle)
    stay = whole.filter("n > 0").groupBy("component").agg(F.min(F.struct("key", "digest")).alias("stay"))
    stay = stay.select(F.col("stay.key").alias("__key"), F.col("stay.digest").alias("__digest"))
    worded = F.coalesce(F.regexp_like(F.col(text), F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    kept = named.filter(worded).join(stay, ["__key", "__digest"], "left_semi").dropDuplicates(["__key", "__digest"])
    return kept.select(docs.columns).unionAll(named.filter(~worded).select(docs.columns))
