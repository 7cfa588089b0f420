"""What several operators share: the shared folder, written tables, word hashes, components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.session import shared_dir

WORD = re.compile(r"\w+")
#: Odd multipliers of the polynomial hashes and of the finalising mix.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class Scratch:
    """Intermediate tables of one call, written to the shared folder so that lineage is cut durably."""

    roots: list[str] = []

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.roots.append(self.root)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return the table as read back."""
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no later plan reads."""
        for name in names:
            delete(self.spark, f"{self.root}/{name}")


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def clean_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables of all calls so far, once their results have been written; returns how many calls."""
    n = len(Scratch.roots)
    for root in Scratch.roots:
        delete(spark, root)
    Scratch.roots.clear()
    return n


class WordHashes(dict):
    """word -> 64-bit hash, remembered per task up to a bound."""

    LIMIT = 200_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, hashes: WordHashes, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``n`` lower-case words; a shorter text is one run, one without words has none."""
    words = hashes.of(WORD.findall((text or "").lower()))
    if not len(words):
        return words
    n = min(n, len(words))
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        total = total * BASE + words[k : len(words) - n + 1 + k]
    return np.unique(mixed(total))


def runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of equal values."""
    if len(values):
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)], strict=True)


#: A group that holds over one row in so many is hot: its rows are salted, so there are fewer hot groups than this.
HOT = 1000
#: Edges that one task may hold: with fewer in all, the edges of a hub needn't be dealt out.
HUB = 1 << 20


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int, by: str) -> DataFrame:
    """Inner join of ``rows`` with one row a group, ``size`` rows each of ``total`` in all, that leaves no task a hot group.

    Rows of a hot group are dealt by their column ``by`` to as many salts as the group has thousandths of all rows, and the group's row
    is repeated for each.  Keys must not be null.  Fewer than ``HOT`` keys are broadcast.
    """
    limit = max(1, total // HOT)
    groups = groups.withColumn("_parts", F.ceil(F.col(size) / limit).cast("int"))
    hot = F.broadcast(groups.where(F.col(size) > limit).select(*keys, "_parts"))
    dealt = rows.join(hot, keys, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(by), F.col("_parts")).cast("int"), F.lit(0))).drop("_parts")
    each = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.when(F.col(size) > limit, F.col("_parts") - 1).otherwise(0)))).drop("_parts")
    return dealt.join(each, [*keys, "_salt"]).drop("_salt")


def components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """(id, root): the least id connected with each id of ``edges`` (a, b long), by alternating large-star and small-star steps.

    Each step is a shuffle of the edge list, in which the edges of a hub are dealt to many tasks once there are over ``HUB`` edges; what comes to the driver is one sum a round.
    Rounds go on until one changes nothing; every one lessens some end of an edge, so there is a last.
    """
    now = scratch.keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}0")
    before, k, n = None, 0, now.count()
    while True:
        both = now.union(now.select("b", "a"))
        # large star: every greater neighbour is linked to the least of the neighbourhood
        if 2 * n > HUB:
            least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
            big = join_groups(both, least, ["a"], "n", 2 * n, "b").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
            low = big.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
            with_least = join_groups(big, low, ["a"], "n", n, "b")  # hubs again: one with many lesser neighbours keeps them as rows here
        else:  # a neighbourhood fits a task: its least comes from a window, one shuffle a star
            around = Window.partitionBy("a")
            big = both.withColumn("m", F.least("a", F.min("b").over(around))).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            with_least = big.withColumn("m", F.min("b").over(around))
        # small star: the node itself and its lesser neighbours are linked to the least of these
        small = with_least.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        now = scratch.keep(small, f"{name}{k + 1}")
        scratch.drop(f"{name}{k}")
        k += 1
        sums = now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if sums == before:
            break
        before, n = sums, sums[0]
    return now.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("root"))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a context; they may lack it on their path."""
    sc = spark.sparkContext
    if getattr(sc, "_eventlake_sent", False):
        return
    root = Path(__file__).resolve().parents[1]
    at = Path(tempfile.mkdtemp(prefix="eventlake-")) / "eventlake.zip"
    with zipfile.ZipFile(at, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(at))
    sc._eventlake_sent = True


def small_batches(spark: SparkSession, size: int = 2 << 20) -> None:
    """Before Python work: bound what a worker holds at a time to about so many bytes a batch (texts may be very long), and ``ship``."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, after which the worker gives free memory back: workers outlive their tasks and stand beside the executor's heap."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # not every C library has it
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def by_bytes(texts: list[str], most: int = 1 << 20) -> Iterator[list[str]]:
    """Slices of ``texts`` with about ``most`` characters each."""
    start = total = 0
    for k, text in enumerate(texts):
        total += len(text)
        if total >= most:
            yield texts[start : k + 1]
            start, total = k + 1, 0
    if start < len(texts):
        yield texts[start:]
