"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints within ``NEAR`` differing bits agree in one of four blocks of bits.  So each distinct fingerprint is looked at in four
views, each with another block in front, and those that agree in it meet: the block is the upper node that they share.
Inside, fingerprints are sorted by Gray rank, which brings together those with the same leading bits; neighbours form leaves and
leaves form upper nodes, each with the bits that all below it share (mask and pattern).  A join walks down pairs of nodes, adds up the
differences among the bits that become shared, and drops a pair of whole groups once these pass ``NEAR``.

A group of over ``GROUP`` fingerprints is looked at in four further views of its remaining bits, up to ``LEVELS`` blocks deep; what is
still larger, a ball of near fingerprints, is dealt by parts, every two of which meet in a task.  Tasks hand on a spanning forest of their links.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, components, join_groups, small_batches, tidy
from .words import groups

WORDS, SEED, NEAR = 3, 42, 3
SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes of a text whose words are held at a time, about.
SLICE = 1 << 20
#: Fingerprints that meet in a task at most, those of a leaf, and nodes below a node.
GROUP, LEAF, FAN = 4096, 16, 8
VIEWS, LEVELS = 4, 3
#: Pairs of nodes that are opened at a time.
OPEN = 4096
LINKED = "a long, b long, path int, x long"


def word_lists(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, slice by slice; slices end at white space."""
    data, at = data.lower(), 0
    while len(data) - at > SLICE:
        end = SPACE.search(data, at + SLICE)
        if not end:
            break
        yield data[at : end.start()].split()
        at = end.end()
    yield data[at:].split()


def shingle_hashes(data: bytes) -> Iterator[np.ndarray]:
    """XXH64 of the runs of ``WORDS`` words, repeats included; fewer words are one run."""
    rest: list[bytes] = []
    any_run = False
    for words in word_lists(data):
        words = rest + words
        if len(words) >= WORDS:
            line = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words])
            starts = np.concatenate([[0], ends[: -WORDS]]).tolist()
            hashes = [xxhash.xxh64_intdigest(line[s:e], SEED) for s, e in zip(starts, (ends[WORDS - 1 :] - 1).tolist(), strict=True)]
            any_run = True
            yield np.array(hashes, np.uint64)
        rest = words[-(WORDS - 1) :]
    if rest and not any_run:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(rest), SEED)], np.uint64)


BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
BYTE_PLACE = (np.arange(8) * 256)[None, :]


def fingerprint(data: bytes) -> int:
    """64 bits, each 1 if it is set in over half of the hashes; 0 without words."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(data):
        each = np.bincount((hashes.astype(">u8").view(np.uint8).reshape(-1, 8) + BYTE_PLACE).ravel(), minlength=2048)
        ones += (each.reshape(8, 256) @ BYTE_BITS).ravel()
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(t) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["row"], pa.array(found, pa.int64())], names=["doc_id", "row", "fp"])


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each code word in the reflected Gray code."""
    for k in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(k))
    return x


class GrayIndex:
    """Fingerprints in Gray order under levels of nodes that know the bits shared below them."""

    def __init__(self, x: np.ndarray) -> None:
        self.order = np.argsort(gray_rank(x), kind="stable")
        self.x = x[self.order]
        self.root = np.arange(len(x))  # of the links found so far
        every, some = self.x, self.x
        self.levels, step = [], LEAF
        while not self.levels or len(every) > 1:
            starts = np.arange(0, len(every), step)
            every, some = np.bitwise_and.reduceat(every, starts), np.bitwise_or.reduceat(some, starts)
            self.levels.append((every, ~(every ^ some)))  # pattern and mask
            step = FAN

    def link(self) -> np.ndarray:
        """For each fingerprint, as given, the place of one that stands for all connected with it."""
        top = len(self.levels) - 1
        none = np.zeros(1, np.int64)
        todo = [(top, none, none, none.astype(np.uint64), none.astype(np.uint8))]
        while todo:
            level, a, b, seen, apart = todo.pop()
            if len(a) > OPEN:
                todo += [(level, a[k : k + OPEN], b[k : k + OPEN], seen[k : k + OPEN], apart[k : k + OPEN]) for k in range(0, len(a), OPEN)]
                continue
            pattern, mask = self.levels[level]
            both = mask[a] & mask[b]
            apart = apart + np.bitwise_count((pattern[a] ^ pattern[b]) & both & ~seen)
            near = apart <= NEAR
            a, b, both, apart = a[near], b[near], both[near], apart[near]
            if not len(a):
                continue
            if level == 0:
                self._leaves(a, b)
                continue
            width = len(self.levels[level - 1][0])
            x, y = (np.repeat(FAN * a, FAN * FAN) + np.tile(np.repeat(np.arange(FAN), FAN), len(a)), np.repeat(FAN * b, FAN * FAN) + np.tile(np.arange(FAN), FAN * len(b)))
            there = (x <= y) & (y < width)
            todo.append((level - 1, x[there], y[there], np.repeat(both, FAN * FAN)[there], np.repeat(apart, FAN * FAN)[there]))
        out = np.empty(len(self.x), np.int64)
        out[self.order] = self.order[self.root]
        return out

    def _leaves(self, a: np.ndarray, b: np.ndarray) -> None:
        starts = np.arange(0, len(self.x), LEAF)
        low, high = np.minimum.reduceat(self.root, starts), np.maximum.reduceat(self.root, starts)
        open_ = ~((low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b]))  # else all of both are connected already
        a, b = a[open_], b[open_]
        for k in range(0, len(a), OPEN // FAN):
            i = (LEAF * a[k : k + OPEN // FAN, None] + np.arange(LEAF))[:, :, None]
            j = (LEAF * b[k : k + OPEN // FAN, None] + np.arange(LEAF))[:, None, :]
            last = len(self.x) - 1
            hit = (np.bitwise_count(self.x[np.minimum(i, last)] ^ self.x[np.minimum(j, last)]) <= NEAR) & (i < j) & (j <= last)
            pair, p, q = np.nonzero(hit)
            self._connect(i[pair, p, 0], j[pair, 0, q])

    def _connect(self, i: np.ndarray, j: np.ndarray) -> None:
        root = self.root
        while True:
            a, b = root[i], root[j]
            new = a != b
            if not new.any():
                return
            i, j, a, b = i[new], j[new], a[new], b[new]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := root[root], root):
                root[:] = up


def linked(keys: list[str], most: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links a -> b inside each group of ``keys``; rows of groups of over ``most`` come back with their path instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for _, rows in groups(batches, keys, most):
            if isinstance(rows, pa.RecordBatch):  # a piece of a large group
                yield pa.RecordBatch.from_arrays([rows["fp"], rows["fp"], rows["path"], rows["x"]], names=["a", "b", "path", "x"])
            elif len(rows) > 1:
                fp = rows["fp"].to_numpy()
                to = GrayIndex(rows["x"].to_numpy().view(np.uint64)).link()
                moved = np.flatnonzero(to != np.arange(len(fp)))
                if len(moved):
                    found.append((fp[moved], fp[to[moved]]))
                    if len(found) > 1000:
                        yield links(found)
                        found = []
        if found:
            yield links(found)

    return run


def links(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.int64())], names=["a", "b", "path", "x"])


def views(rows: DataFrame, rest: int) -> DataFrame:
    """Each row of (path, x, fp) with each block of its last ``rest`` bits in turn in front of these; ``head`` is what stands up to there."""
    size, mask = rest // VIEWS, -1 if rest == 64 else (1 << rest) - 1
    seen = rows.withColumn("view", F.explode(F.array(*map(F.lit, range(VIEWS)))))
    turned = F.expr(f"shiftleft(x & {mask}L, view * {size}) | shiftrightunsigned(x & {mask}L, {rest} - view * {size})")
    seen = seen.withColumns({"path": F.expr(f"path * {VIEWS} + view"), "x": F.expr(f"x & {~mask}L").bitwiseOR(turned.bitwiseAND(F.lit(mask)))})
    return seen.select("path", F.shiftrightunsigned("x", rest - size).alias("head"), "x", "fp")


def met(rows: DataFrame, keys: list[str], most: int | None = None) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(tidy(linked(keys, most)), LINKED)


def forest(prints: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): links that connect just the fingerprints of the column ``fp`` that chains of links of ``NEAR`` bits connect."""
    rows, rest, found = prints.select(F.lit(0).alias("path"), F.col("fp").alias("x"), "fp"), 64, []
    for level in range(LEVELS):
        out = scratch.keep(met(views(rows, rest), ["path", "head"], GROUP), f"links{level}")
        rest -= rest // VIEWS
        found.append(out.where("path IS NULL").select("a", "b"))
        rows = out.where("path IS NOT NULL").select("path", "x", F.col("a").alias("fp"))
        if not rows.limit(1).count():
            break
    else:  # large groups that agree in all blocks so far: each part meets each other part
        head = rows.withColumn("head", F.shiftrightunsigned("x", rest))
        sizes = head.groupBy("path", "head").agg(F.count("*").alias("n"))
        dealt = join_groups(head, sizes, ["path", "head"], "n", head.count(), "fp").withColumn("parts", F.ceil(F.col("n") * 2 / GROUP).cast("int"))
        dealt = dealt.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("part <> other OR parts = 1")
        dealt = dealt.select("path", "head", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "x", "fp")
        found.append(scratch.keep(met(dealt, ["path", "head", "i", "j"]), "dense").select("a", "b"))
    edges = found[0]
    for more in found[1:]:
        edges = edges.union(more)
    return edges


def near_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id for every row: the smallest doc_id that links of at most ``NEAR`` differing bits reach.

    Null text counts as empty; texts without words have fingerprint zero and are linked by it like others, texts of under three words have one shingle.
    Rows with a null doc_id are linked too, and name a component only (with null) if it has no other; repeated rows stay rows; an empty table gives no rows.
    Other columns are ignored.  Texts are read whole, slice by slice.  Equal fingerprints are one node, however many rows have them, and rows of a
    fingerprint or component that many share are dealt to many tasks.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    rows = scratch.keep(texts.mapInArrow(tidy(fingerprints), "doc_id long, row long, fp long"), "rows")
    prints = scratch.keep(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "prints")
    roots = components(scratch, forest(prints, scratch), "round")
    roots = roots.union(roots.select(F.col("root").alias("id"), "root").distinct())  # a root stands for itself
    inside = scratch.keep(prints.join(roots, prints["fp"] == roots["id"]).select("fp", "first", "root"), "inside")
    least = inside.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("size"))
    named = join_groups(inside, least, ["root"], "size", inside.count(), "fp").select("fp", "component_id")
    ends = prints.join(named, "fp", "left").select("fp", "n", F.coalesce("component_id", "first").alias("component_id"))
    found = join_groups(rows, ends, ["fp"], "n", rows.count(), "row")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
