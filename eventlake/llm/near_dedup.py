"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

Texts with the same set of word n-grams are one class.  A class has a label of ``DEPTH`` MinHash values in each of ``TREES``
prefix tries; tries are kept as rows sorted by their labels, where a matched prefix is a run of rows.  Matching starts at
whole labels and shortens the prefix value by value.  At each length classes of a run that don't hang together yet
are compared on signature sketches; a run that hangs together is closed, so shortening goes on only where it can still bring
something.  It ends at the length at which the modelled recall at the threshold reaches its target.

A run of over ``BLOCK`` classes isn't shortened that far at first: it is cut by longer prefixes.  What a class loses by that
in recall is summed over its tries.  Classes that miss the target then are open, and their crowded runs are shortened to the end,
unless all classes in them hang together by now: classes apart from the run's largest cluster are compared with all of it, block by block.
Classes that hang together in this way form clusters.  Inside a cluster all classes
are compared exactly, again block by block, and only counts and a spanning forest leave a block, never its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, WordHashes, components, join_groups, mixed, runs, shingles, small_batches, tidy
from .repeats import grouped
from .sharding import keyed

WORDS, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 32, 8, 0.9999
#: Classes of a block; a task holds two blocks.
BLOCK = 512
#: Classes that stand in every block of a run that no label cuts.
LEADERS = 8
SIGN_SCHEMA = "key long, d1 long, d2 long, prefixes array<long>, sketch binary"


def prefix_depth(threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which a pair at the threshold meets in some tree with probability ``recall``."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    k = np.arange(1, 2 * n + 1, dtype=np.uint64)
    values = mixed(mixed(k))
    return values[:n] | np.uint64(1), values[n:]


def signature(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least value of every hash over the n-grams x."""
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(x), 256):
        np.minimum(least, (x[at : at + 256, None] * a + b).min(axis=0), out=least)
    return least


def signer(words: int, floor: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Two digests of the set, the shortest prefix of each tree's label as one number, and one byte of every value of the labels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        a, b = hash_family(TREES * DEPTH)
        tree = mixed(np.arange(1, TREES + 1, dtype=np.uint64))
        for batch in batches:
            out = []
            for key, text in zip(batch["key"], batch["text"], strict=True):
                x = shingles(text, hashes, words)
                if not len(x):
                    out.append((key, 0, 0, None, None))
                    continue
                d1 = int(mixed(x).sum(dtype=np.uint64).view(np.int64))
                d2 = int((mixed(x ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(x))).view(np.int64))
                least = mixed(signature(x, a, b)).reshape(TREES, DEPTH)
                prefix = tree.copy()
                for k in range(floor):
                    prefix = mixed(prefix + least[:, k])
                out.append((key, d1, d2, prefix.view(np.int64), (least & np.uint64(255)).astype(np.uint8).tobytes()))
            yield pd.DataFrame(out, columns=["key", "d1", "d2", "prefixes", "sketch"])

    return run


def spread(df: DataFrame, group: str, key: str, size: str) -> DataFrame:
    """Rows of ``df`` for each pair of blocks (i <= j) of their group that they take part in."""
    n = F.ceil(F.col(size) / BLOCK).cast("int")
    own = F.pmod(F.hash(key), n)
    parts = df.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), n - 1)))
    parts = parts.withColumns({"i": F.least("_own", "_other"), "j": F.greatest("_own", "_other"), "mine": F.col("_own")})
    return parts.drop("_own", "_other", size).repartition(group, "i", "j").sortWithinPartitions(group, "i", "j", key)


def block_groups(batches: Iterator[pd.DataFrame], group: str) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """(rows, places of block i, places of block j) for each pair of blocks."""
    stream = (b.assign(_g=mixed(b[group].to_numpy().view(np.uint64)) + (b["i"].to_numpy().astype(np.uint64) << np.uint64(20)) + b["j"].to_numpy().astype(np.uint64)) for b in batches)
    for rows in grouped(stream, "_g"):
        i, j, mine = (rows[c].to_numpy() for c in ("i", "j", "mine"))
        for s, e in runs(rows["_g"].to_numpy()):
            places = np.arange(s, e)
            if i[s] == j[s]:
                yield rows, places, places
            else:
                yield rows, places[mine[s:e] == i[s]], places[mine[s:e] == j[s]]


def forest(left: np.ndarray, right: np.ndarray, near: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the bipartite (or, left being right, plain) graph ``near``."""
    same = left is right
    nodes = left if same else np.concatenate([left, right])
    if same:
        adjacent = near
    else:
        adjacent = np.zeros((len(nodes), len(nodes)), bool)
        adjacent[: len(left), len(left) :] = near
        adjacent[len(left) :, : len(left)] = near.T
    fresh, edges = adjacent.any(axis=1), []
    for seed in np.flatnonzero(fresh):
        if not fresh[seed]:
            continue
        fresh[seed] = False
        queue = [seed]
        while queue:
            u = queue.pop()
            found = np.flatnonzero(adjacent[u] & fresh)
            fresh[found] = False
            edges += [(nodes[u], nodes[v]) for v in found]
            queue += found.tolist()
    return edges


def agreeing(x: np.ndarray, y: np.ndarray, cut: float) -> np.ndarray:
    """Which sketches of x and y agree in at least ``cut`` places."""
    return np.stack([(row == y).sum(axis=1) >= cut for row in x])


def bridges(near: np.ndarray, left: np.ndarray, right: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Edges (place in ``left``, place in ``right``) of the graph ``near`` that join different labels; ``label`` is brought up to date."""
    edges = []
    for i, row in zip(left.tolist(), near, strict=True):
        others = right[row]
        others = others[label[others] != label[i]]
        if len(others):
            found, at = np.unique(label[others], return_index=True)
            edges += [(i, int(j)) for j in others[at]]
            label[np.isin(label, found)] = label[i]
    return edges


def trie_edges(cut: float, floor: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Forest edges between classes of a unit's trie whose sketches agree in at least ``cut`` places, found from whole labels to the shortest prefix."""

    def climb(sketch: np.ndarray, labels: np.ndarray) -> list[tuple[int, int]]:
        # labels, sorted: one column for the bucket, then one for each value beyond it
        hang, edges = np.arange(len(sketch)), []
        for depth in range(labels.shape[1], 0, -1):
            new = np.concatenate([[True], (labels[1:, :depth] != labels[:-1, :depth]).any(axis=1), [True]])
            bounds = np.flatnonzero(new)
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                kinds, inverse, sizes = np.unique(hang[s:e], return_inverse=True, return_counts=True)
                if len(kinds) == 1:  # closed: looked into again only with others, under a shorter prefix
                    continue
                apart, whole = s + np.flatnonzero(inverse != sizes.argmax()), np.arange(s, e)
                edges += bridges(agreeing(sketch[apart], sketch[whole], cut), apart, whole, hang)
        return edges

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in grouped(batches, "unit"):
            key, unit = rows["key"].to_numpy(), rows["unit"].to_numpy()
            sketch = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), -1)
            tails = np.frombuffer(b"".join(rows["tail"]), np.uint8).reshape(len(rows), -1)
            labels = np.column_stack([rows["bucket"].to_numpy(), tails])
            bounds = np.concatenate([[0], np.flatnonzero(unit[1:] != unit[:-1]) + 1, [len(unit)]])
            size = np.diff(bounds)
            two = bounds[:-1][size == 2]
            near = ((sketch[two] == sketch[two + 1]).sum(axis=1) >= cut) & (labels[two, 0] == labels[two + 1, 0])
            edges = list(zip(key[two[near]].tolist(), key[two[near] + 1].tolist(), strict=True))
            for s, n in zip(bounds[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
                edges += [(key[s + a], key[s + b]) for a, b in climb(sketch[s : s + n], labels[s : s + n])]
            yield pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    return run


def crowded_edges(cut: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Edges between clusters, from a block of the classes apart (side 0) to a block of all (side 1) of a run."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in grouped(batches, "unit"):
            key, side = rows["key"].to_numpy(), rows["side"].to_numpy()
            root = np.unique(rows["root"].to_numpy(), return_inverse=True)[1]
            sketch = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), -1)
            edges = []
            for s, e in runs(rows["unit"].to_numpy()):
                left, right = np.flatnonzero(side[s:e] == 0), np.flatnonzero(side[s:e] == 1)
                if len(left) and len(right):
                    near = agreeing(sketch[s + left], sketch[s + right], cut)
                    edges += [(key[s + i], key[s + j]) for i, j in bridges(near, left, right, root[s:e].copy())]
            yield pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    return run


def units(spots: DataFrame, floor: int) -> DataFrame:
    """Crowded ``spots`` with the unit that each is compared in, the prefix ``length`` of the unit, 0 if no label cuts it to a block; leaders are repeated."""
    head = lambda k: F.expr(f"substring(tail, 1, {k})")
    for k in range(1, DEPTH - floor + 1):
        sizes = spots.groupBy("bucket", head(k).alias("_head")).agg(F.count("*").alias(f"n{k}"))
        spots = spots.withColumn("_head", head(k)).join(sizes, ["bucket", "_head"]).drop("_head")
    steps = range(1, DEPTH - floor + 1)
    length = F.coalesce(*[F.when(F.col(f"n{k}") <= BLOCK, floor + k) for k in steps], F.lit(0)) if DEPTH > floor else F.lit(0)
    last = F.col(f"n{DEPTH - floor}") if DEPTH > floor else F.col("size")
    spots = spots.withColumns({"length": length, "parts": F.ceil(last / BLOCK).cast("int")})
    cut = spots.where("length > 0").withColumn("unit", F.xxhash64("bucket", F.expr(f"substring(tail, 1, length - {floor})"), F.lit(-1)))
    dealt = spots.where("length = 0")
    ranks = [F.min(F.struct(F.xxhash64("key", F.lit(k)).alias("r"), F.col("key"))).getField("key") for k in range(LEADERS)]
    leaders = dealt.groupBy("bucket", "tail").agg(F.array_distinct(F.array(*ranks)).alias("_leaders"), F.max("parts").alias("_all"))
    places = leaders.select("bucket", "tail", F.explode("_leaders").alias("key"), F.sequence(F.lit(0), F.col("_all") - 1).alias("_in"))
    dealt = dealt.join(places, ["bucket", "tail", "key"], "left")
    own = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    dealt = dealt.withColumn("_part", F.explode(F.coalesce("_in", F.array(own)))).withColumn("unit", F.xxhash64("bucket", "tail", "_part"))
    wanted = ["unit", "bucket", "tail", "key", "sketch", "length"]
    return cut.select(wanted).unionByName(dealt.select(wanted))


def shortened(crowded: DataFrame, dealt: DataFrame, clusters: DataFrame, scratch: Scratch, threshold: float, recall: float, floor: int, cut: float) -> DataFrame | None:
    """Edges (a, b) of crowded runs that hold open classes and several clusters; nothing if there are no such runs."""
    # what a tree misses of pairs at the threshold: at a prefix of so many values, or all of them where blocks were dealt
    miss = lambda n: float(np.log1p(-(threshold**n)))
    lengths = dealt.select("key", "bucket", "length").distinct()
    lost = F.sum(F.when(F.col("length") == 0, 0.0).otherwise(F.log1p(-F.pow(F.lit(threshold), F.col("length"))))) - miss(floor) * F.count("*")
    open_ = lengths.groupBy("key").agg((lost + TREES * miss(floor)).alias("left")).where(F.col("left") > float(np.log1p(-recall))).select("key", F.lit(True).alias("open"))
    rows = crowded.join(clusters.withColumnRenamed("id", "key"), "key", "left").join(open_, "key", "left")
    rows = scratch.keep(rows.select("bucket", "key", "sketch", F.coalesce("root", "key").alias("root"), F.coalesce("open", F.lit(False)).alias("open")), "crowded-rows")
    kinds = rows.groupBy("bucket", "root").agg(F.count("*").alias("n"), F.max("open").alias("open"))
    runs_ = kinds.groupBy("bucket").agg(F.sum("n").alias("size"), F.max_by("root", F.struct("n", "root")).alias("most"), F.max("n").alias("largest"), F.max("open").alias("open"))
    runs_ = runs_.where((F.col("size") > F.col("largest")) & F.col("open")).select(
        "bucket", "size", "most", F.ceil((F.col("size") - F.col("largest")) / BLOCK).cast("int").alias("nl"), F.ceil(F.col("size") / BLOCK).cast("int").alias("nr"))
    runs_ = scratch.keep(runs_, "open-runs")
    if not runs_.limit(1).count():
        return None
    rows = join_groups(rows, runs_, ["bucket"], "size", rows.count(), "key")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    left = rows.where("root <> most").withColumn("j", every("nr")).withColumns({"i": own("nl"), "side": F.lit(0)})
    right = rows.withColumn("i", every("nl")).withColumns({"j": own("nr"), "side": F.lit(1)})
    both = left.unionByName(right).select(F.xxhash64("bucket", "i", "j").alias("unit"), "side", "key", "root", "sketch")
    return both.repartition("unit").sortWithinPartitions("unit", "side", "key").mapInPandas(tidy(crowded_edges(cut)), "a long, b long")


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections of two lists of sorted sets."""
    both = left if left is right else [*left, *right]
    values = np.concatenate(both)
    owner = np.repeat(np.arange(len(both)), [len(x) for x in both])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    total = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        s, e = np.searchsorted(column, [at, at + width])
        dense = np.zeros((len(both), width), np.float32)
        dense[owner[s:e], column[s:e] - at] = 1
        total += dense @ dense.T if left is right else dense[: len(left)] @ dense[len(left) :].T
    return total


def exact_links(threshold: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """(a, null, links) for what each class links to in a pair of blocks, and forest edges (a, b, null)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, left, right in block_groups(batches, "root"):
            if not len(left) or not len(right):
                continue
            key, copies = rows["key"].to_numpy(), rows["copies"].to_numpy()
            x = [np.frombuffer(rows["grams"].iloc[k], np.uint64) for k in left]
            y = x if left is right else [np.frombuffer(rows["grams"].iloc[k], np.uint64) for k in right]
            both = common(x, y)
            near = both >= threshold * (np.array([len(v) for v in x])[:, None] + np.array([len(v) for v in y])[None, :] - both) - 1e-6
            if left is right:
                np.fill_diagonal(near, False)
            ids = key[left]
            edges = forest(ids, ids if left is right else key[right], near)
            out = [(a, b, None) for a, b in edges]
            out += [(k, None, n) for k, n in zip(ids, near @ copies[right], strict=True) if n]
            if left is not right:
                out += [(k, None, n) for k, n in zip(key[right], copies[left] @ near, strict=True) if n]
            if out:
                found = pd.DataFrame(out, columns=["a", "b", "links"])
                yield found.astype({"a": "int64", "b": "Int64", "links": "Int64"})

    return run


def gram_sets(words: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            yield batch.drop(columns="text").assign(grams=[shingles(t, hashes, words).tobytes() for t in batch["text"]])

    return run


def candidates(classes: DataFrame, scratch: Scratch, threshold: float, recall: float) -> DataFrame:
    """(id, root): clusters of the classes (key, prefixes, sketch) that the forest links."""
    floor = prefix_depth(threshold, recall)
    values = TREES * DEPTH
    cut = values * (threshold - 4 * (threshold * (1 - threshold) / values) ** 0.5)
    places = classes.select("key", F.posexplode("prefixes").alias("tree", "bucket"))
    full = places.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    n = classes.count() * TREES
    tail = F.substring(F.col("sketch"), F.col("tree") * DEPTH + floor + 1, F.lit(DEPTH - floor))
    spots = join_groups(places, full, ["bucket"], "size", n, "key").join(classes.select("key", "sketch"), "key")
    spots = scratch.keep(spots.select("bucket", tail.alias("tail"), "key", "sketch", "size"), "spots")
    crowded = spots.where(F.col("size") > BLOCK)
    quiet = spots.where(F.col("size") <= BLOCK).select(F.col("bucket").alias("unit"), "bucket", "tail", "key", "sketch")
    any_crowded = crowded.limit(1).count() > 0
    if any_crowded:
        dealt = scratch.keep(units(crowded, floor), "units")
        quiet = quiet.unionByName(dealt.drop("length"))
    near = quiet.repartition("unit").sortWithinPartitions("unit", "bucket", "tail", "key").mapInPandas(tidy(trie_edges(cut, floor)), "a long, b long")
    clusters = scratch.keep(components(scratch, near, "near"), "clusters")
    if any_crowded:
        more = shortened(crowded, dealt, clusters, scratch, threshold, recall, floor, cut)
        if more is not None:
            both = clusters.select(F.col("id").alias("a"), F.col("root").alias("b")).union(more)
            clusters = scratch.keep(components(scratch, both, "nearer"), "all-clusters")
        scratch.drop("units", "crowded-rows", "open-runs")
    scratch.drop("spots")
    return clusters.where("id <> root").union(clusters.select("root", "root").distinct())


def classified(texts: DataFrame, scratch: Scratch, words: int, threshold: float, recall: float) -> DataFrame:
    """key, class (least key of it), class_size, n_links of ``texts`` (key, text) with words."""
    floor = prefix_depth(threshold, recall)
    signed = scratch.keep(texts.select("key", "text").mapInPandas(tidy(signer(words, floor)), SIGN_SCHEMA), "signed")
    some = signed.where("prefixes IS NOT NULL").select("key", "d1", "d2")
    total = some.count()
    sets = some.groupBy("d1", "d2").agg(F.min("key").alias("rep"), F.count("*").alias("copies"))
    members = scratch.keep(join_groups(some, sets, ["d1", "d2"], "copies", total, "key").select("key", "rep", "copies"), "members")
    reps = members.where("key = rep").select("rep", "copies")
    classes = scratch.keep(signed.join(reps.withColumnRenamed("rep", "key"), "key", "left_semi").select("key", "prefixes", "sketch"), "classes")
    scratch.drop("signed")
    clusters = candidates(classes, scratch, threshold, recall)
    clusters = scratch.keep(clusters, "clustered")
    scratch.drop("classes")
    sizes = clusters.groupBy("root").agg(F.count("*").alias("size"))
    clusters = join_groups(clusters, sizes, ["root"], "size", clusters.count(), "id")

    chosen = clusters.withColumnRenamed("id", "key").join(reps.withColumnRenamed("rep", "key"), "key")
    grams = texts.select("key", "text").join(chosen, "key").select("key", "root", "size", "copies", "text")
    grams = grams.mapInPandas(tidy(gram_sets(words)), "key long, root long, size long, copies long, grams binary")
    links = scratch.keep(spread(grams, "root", "key", "size").mapInPandas(tidy(exact_links(threshold)), "a long, b long, links long"), "links")
    linked = components(scratch, links.where("b IS NOT NULL").select("a", "b"), "link")
    count = links.where("links IS NOT NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    # first one row a class, then one a text: a class may have very many of either
    named = reps.join(linked.withColumnRenamed("id", "rep"), "rep", "left").join(count, "rep", "left")
    named = scratch.keep(named.select("rep", "copies", F.coalesce("root", "rep").alias("class"), F.coalesce("links", F.lit(0)).alias("links")), "named")
    whole = named.groupBy("class").agg(F.sum("copies").alias("class_size"), F.count("*").alias("_classes"))
    named = join_groups(named, whole, ["class"], "_classes", named.count(), "rep").drop("_classes", "copies")
    sized = named.join(reps, "rep")
    out = join_groups(members.select("key", "rep"), sized, ["rep"], "copies", total, "key")
    return scratch.keep(out.select("key", "class", "class_size", (F.col("links") + F.col("copies") - 1).alias("n_links")), "classified")


def near_duplicates(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, class_size, n_links, kept for every row of ``docs``.

    Documents link when their sets of ``words``-word shingles (lower case, runs of word characters) have a Jaccard
    similarity of at least ``threshold``; a text of fewer words is one shingle.  Shingles are compared by 64 bits of hash, and
    sets taken as the same by 128.  A class is a
    component of links, named by its least doc_id; ``kept`` marks that row.  n_links counts the other documents a document
    links to.  Null texts and texts without words link to nothing.  Rows that repeat a doc_id are documents of their
    own that may link; other columns are ignored; an empty table gives no rows.
    A link at the threshold is missed with probability below 1 - ``recall`` + 3e-5 (four deviations of
    the sketch); similar pairs above it less often.
    """
    scratch = Scratch(docs.sparkSession, "near-dedup")
    texts = keyed(docs, scratch)
    small_batches(docs.sparkSession)
    named = classified(texts, scratch, words, threshold, recall)
    ids = texts.select("doc_id", "key")
    heads = named.groupBy("class").agg(F.count("*").alias("_n")).join(ids.select(F.col("key").alias("class"), F.col("doc_id").alias("class_id")), "class")
    with_id = join_groups(named, heads, ["class"], "_n", named.count(), "key").drop("_n")
    out = ids.join(with_id, "key", "left")
    alone = F.col("class").isNull()
    return out.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), (alone | (F.col("key") == F.col("class"))).alias("kept"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each class, the one with the least doc_id, stays.

    Rows are told apart by a key of their own, so rows that repeat a doc_id or have none stay or go each by itself; texts without words stay; nulls in
    other columns, extra columns and columns named like those used inside come through; an empty table stays empty.
    """
    scratch = Scratch(spark, "near-stage")
    rows = keyed(docs, scratch, whole=True)
    small_batches(spark)
    dropped = classified(rows.select("key", "text"), scratch, WORDS, THRESHOLD, RECALL).where("key <> class").select("key")
    return rows.join(dropped, "key", "left_anti").select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
