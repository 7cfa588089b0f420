"""Collocations by growth of contiguous patterns, each frequent prefix in a task of its own.

Words that are frequent in their language, then pairs of neighbours, are counted first; filters of fixed size made from them tell which
occurrences can begin a frequent phrase, and how far it can reach.  The occurrences of a prefix (its words, and the up to four that follow)
are its projection: equal ones are summed up, and the task of the prefix extends it to the right, word by word and depth first, as long
as the occurrences that are left are frequent.  A prefix with over a thousandth of all rows is replaced by its extensions by one word.

Filters only leave out what can't be frequent; every count in the result is a sum over all occurrences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BASE, HOT, Scratch, mixed, small_batches, tidy
from .words import Cut, Cutter, Sums, groups, totals

LONGEST, LEAST, TOP = 5, 100, 2000
#: Bits of a filter (8 MB): its size doesn't depend on the data, only how much it leaves out does.
BITS = 1 << 26
#: Occurrences that a task hands on at a time.
PORTION = 1 << 16
PROJECTED = "lang string, prefix binary, rests array<binary>, times array<long>"
CUTTER = Cutter(b" \t", b".,;:!?\n\x0b\x0c\r")


def lang_of() -> Column:
    return F.coalesce("lang", F.lit("und")).alias("lang")


class Batch:
    """The words of a batch, and the language of each."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        self.cut: Cut = CUTTER(batch["text"].to_pylist())
        names = batch["lang"].dictionary_encode()
        self.langs, self.lang = names.dictionary.to_pylist(), names.indices.to_numpy()[self.cut.text].astype(np.int64)

    def names(self, at: np.ndarray) -> pa.Array:
        return pa.array(self.langs, pa.string()).take(pa.array(at))


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, word, n, summed up in the task."""
    sums = Sums(["lang", "word"], ["n"])
    for batch in batches:
        b = Batch(batch)
        v = max(1, len(b.cut.words))
        key, n = totals(b.lang * v + b.cut.code, np.ones(len(b.cut.code), np.int64))
        yield from sums.add(pa.table({"lang": b.names(key // v), "word": b.cut.words.take(pa.array(key % v)).cast(pa.binary()), "n": n}))
    yield from sums.rest()


def bit_filter(hashes: DataFrame) -> np.ndarray:
    """A bit for each value of the one column of ``hashes``, modulo ``BITS``: what comes to the driver is that many bits at most."""
    (c,) = hashes.columns
    at = hashes.select(F.col(c).bitwiseAND(F.lit(BITS - 1)).alias("at"))
    lanes = at.groupBy(F.shiftright("at", 6).alias("lane")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 AS int)))").alias("bits")).toArrow()
    out = np.zeros(BITS >> 6, np.int64)
    out[lanes["lane"].to_numpy()] = lanes["bits"].to_numpy()
    return out.view(np.uint64)


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(64 * len(bits) - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def pairs(b: Batch, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of neighbours in a piece that are both frequent, and a hash of each pair; word hashes are those of SQL's xxhash64(lang, word)."""
    if not len(b.cut.code):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    seeds = [xxhash.xxh64_intdigest(name, 42) for name in b.langs]
    key, place = np.unique(b.lang * len(b.cut.words) + b.cut.code, return_inverse=True)
    words = b.cut.words.to_pylist()
    each = np.array([xxhash.xxh64_intdigest(words[k % len(words)], seeds[k // len(words)]) for k in key.tolist()], np.uint64)
    known = passes(frequent, each)[place]
    at = np.flatnonzero(known[:-1] & known[1:] & ~b.cut.opens[1:])
    hashes = each[place]
    return at, mixed(hashes[at] * BASE + hashes[at + 1])


def count_pairs(frequent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(["pair"], ["n"], 1 << 21)
        for batch in batches:
            _, hashes = pairs(Batch(batch), frequent.value)
            key, n = totals(hashes.view(np.int64), np.ones(len(hashes), np.int64))
            yield from sums.add(pa.table({"pair": key, "n": n}))
        yield from sums.rest()

    return run


def alike(columns: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of distinct rows of ``columns`` (-1 is a value too; all are under ``width``) and how often each occurs."""
    if not len(columns[0]):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    high, low = np.zeros((2, len(columns[0])), np.int64)
    if (width + 1) ** 3 < 1 << 63:
        for c in columns[:3]:
            high = high * (width + 1) + c + 1
        for c in columns[3:]:
            low = low * (width + 1) + c + 1
    else:
        low = np.unique(np.column_stack(columns), axis=0, return_inverse=True)[1].ravel()
    order = np.lexsort((low, high))
    new = np.concatenate([[True], (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])])
    first = np.flatnonzero(new)
    return order[first], np.diff(np.append(first, len(order)))


def by_prefix(lang: pa.Array, prefix: pa.Array, rest: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    """One row for each (lang, prefix): what follows it in each of its occurrences, and how often."""
    lang_code, prefix_code = (x.dictionary_encode().indices.to_numpy().astype(np.int64) for x in (lang, prefix))
    key = lang_code * (prefix_code.max(initial=0) + 1) + prefix_code
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    offsets = pa.array(np.append(first, len(order)).astype(np.int32))
    head = pa.array(order[first])
    lists = [pa.ListArray.from_arrays(offsets, x) for x in (rest.take(pa.array(order)), pa.array(n[order]))]
    return pa.RecordBatch.from_arrays([lang.take(head), prefix.take(head), *lists], names=["lang", "prefix", "rests", "times"])


def portions(rows: pa.RecordBatch, most: int = PORTION) -> Iterator[pa.RecordBatch]:
    """``rows`` of ``by_prefix`` in slices of about ``most`` occurrences; a prefix stays whole.  What a task hands on lies in the executor's memory too."""
    held = np.cumsum(pc.list_value_length(rows["rests"]).to_numpy()) // most
    bounds = [0, *(np.flatnonzero(np.diff(held)) + 1).tolist(), len(rows)]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        yield rows.slice(a, b - a)


def next_word(rest: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The first word of each run, and what is left of it ('' if nothing)."""
    both = pc.split_pattern(rest, " ", max_splits=1)
    flat, offsets = both.flatten(), both.offsets.to_numpy()
    last = pa.array(offsets[:-1] + 1, mask=np.diff(offsets) < 2)
    return flat.take(pa.array(offsets[:-1])), pc.fill_null(flat.take(last), pa.scalar(b"", flat.type))


def project(frequent, common) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """lang, prefix, rests, times: each word's occurrences that can begin a frequent phrase, with the words after it as far as one can reach.

    Equal occurrences of a task are summed up; its rows hold all those of one first word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(["lang", "run"], ["n"], 700_000, 1 << 20)

        def packed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                if len(part):
                    yield from portions(by_prefix(part["lang"], *next_word(part["run"]), part["n"].to_numpy()))

        for batch in batches:
            b = Batch(batch)
            at, hashes = pairs(b, frequent.value)
            at = at[passes(common.value, hashes)]
            goes_on = np.zeros(len(b.cut.code) + LONGEST, bool)
            goes_on[at] = True
            there, columns = np.ones(len(at), bool), [b.lang[at], b.cut.code[at].astype(np.int64)]
            for k in range(1, LONGEST):
                there = there & goes_on[at + k - 1]
                code = np.full(len(at), -1, np.int64)
                code[there] = b.cut.code[at[there] + k]
                columns.append(code)
            place, n = alike(columns, max(len(b.cut.words), len(b.langs)))
            words = [b.cut.words.take(pa.array(c[place], mask=c[place] < 0)) for c in columns[1:]]
            runs = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary()), null_handling="skip")
            yield from packed(sums.add(pa.table({"lang": b.names(columns[0][place]), "run": runs.cast(pa.binary()), "n": n})))
        yield from packed(sums.rest())

    return run


def deepen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes longer by a word; occurrences that reach no further go."""
    for batch in batches:
        flat, n = batch["rests"].flatten(), batch["times"].flatten().to_numpy()
        parent = pc.list_parent_indices(batch["rests"]).to_numpy()
        on = np.flatnonzero(pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0)
        if len(on):
            at = pa.array(parent[on])
            word, rest = next_word(flat.take(pa.array(on)))
            yield from portions(by_prefix(batch["lang"].take(at), pc.binary_join_element_wise(batch["prefix"].take(at), word, pa.scalar(b" ")), rest, n[on]))


class Projection:
    """The occurrences of one prefix: the words after it by place as codes, -1 past the end of a run."""

    def __init__(self, rows: pa.Table, depth: int) -> None:
        self.depth, self.n = depth, rows["times"].combine_chunks().flatten().to_numpy()
        lists = pc.split_pattern(rows["rests"].combine_chunks().flatten(), " ")
        flat, offsets = lists.flatten().dictionary_encode(), lists.offsets.to_numpy().astype(np.int64)
        self.words, code = flat.dictionary, flat.indices.to_numpy().astype(np.int64)
        code[pc.binary_length(flat.dictionary).to_numpy(zero_copy_only=False)[code] == 0] = -1
        self.codes = []
        for k in range(LONGEST - depth):
            column = np.full(len(self.n), -1, np.int64)
            there = np.flatnonzero(np.diff(offsets) > k)
            column[there] = code[offsets[there] + k]
            self.codes.append(column)

    def grow(self, phrase: bytes, length: int, pointers: np.ndarray, least: int) -> Iterator[tuple[bytes, int]]:
        """The frequent phrases that begin with ``phrase``, whose occurrences ``pointers`` are, depth first."""
        if length == LONGEST:
            return
        codes = self.codes[length - self.depth]
        order = pointers[np.argsort(codes[pointers], kind="stable")]
        code = codes[order]
        first = np.flatnonzero(np.diff(code, prepend=-2))
        times = np.add.reduceat(self.n[order], first)
        ends = np.append(first[1:], len(code))
        for j in np.flatnonzero((times >= least) & (code[first] >= 0)).tolist():
            longer = phrase + b" " + self.words[int(code[first[j]])].as_py()
            yield longer, int(times[j])
            yield from self.grow(longer, length + 1, order[first[j] : ends[j]], least)


def grow(depth: int, least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """lang, phrase, a of the frequent phrases that begin with each prefix of ``depth`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (lang, prefix), rows in groups(batches, ["lang", "prefix"]):
            own = Projection(rows, depth)
            total = int(own.n.sum())
            if total < least:
                continue
            found = [(prefix, total)] * (depth > 1) + list(own.grow(prefix, depth, np.arange(len(own.n)), least))
            if found:
                phrases, times = zip(*found, strict=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(found), pa.string()), "phrase": pa.array(phrases, pa.binary()), "a": pa.array(times, pa.int64())})

    return run


def frequent_phrases(rows: DataFrame, scratch: Scratch, least: int) -> DataFrame:
    """lang, phrase, a of the phrases of two words or more with ``least`` occurrences; ``rows`` are projections by first word, read several times."""
    held = F.sum(F.size("rests"))
    limit, found = max(1, (rows.agg(held).first()[0] or 0) // HOT), []
    for depth in range(1, LONGEST):
        hot = None
        if depth < LONGEST - 1:
            sizes = rows.groupBy("lang", "prefix").agg(held.alias("held"), F.sum(F.aggregate("times", F.lit(0).cast("long"), lambda x, n: x + n)).alias("a"))
            hot = scratch.keep(sizes.where(F.col("held") > limit), f"hot{depth}")  # under HOT of them
        cold = rows if hot is None else rows.join(F.broadcast(hot), ["lang", "prefix"], "left_anti")
        found.append(cold.repartition("lang", "prefix").sortWithinPartitions("lang", "prefix").mapInArrow(tidy(grow(depth, least)), "lang string, phrase binary, a long"))
        if hot is None or not hot.limit(1).count():
            break
        if depth > 1:
            found.append(hot.where(F.col("a") >= least).select("lang", F.col("prefix").alias("phrase"), "a"))
        rows = scratch.keep(rows.join(F.broadcast(hot), ["lang", "prefix"], "left_semi").mapInArrow(tidy(deepen), PROJECTED), f"deeper{depth}")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.withColumn("phrase", F.col("phrase").cast("string"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of two to five words with ``least`` occurrences.

    Null text counts as empty, null lang as ``und``; texts without words count for nothing; repeated rows are texts of their own; an empty table gives no rows.
    Scores are those of the worst cut, in exact integers; phrases that a longer candidate holds at each occurrence are left out.  Other columns are ignored.
    A task holds one batch of whole texts, sums up to a bound, or the distinct projections of one prefix, a thousandth of all at most.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "phrases")
    small_batches(spark, 4 << 20)
    texts = docs.select(lang_of(), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    counted = texts.mapInArrow(tidy(count_words), "lang string, word binary, n long").groupBy("lang", F.col("word").cast("string").alias("word")).agg(F.sum("n").alias("n"))
    counted = scratch.keep(counted, "words")
    frequent = counted.where(F.col("n") >= least)
    known = spark.sparkContext.broadcast(bit_filter(frequent.select(F.xxhash64("lang", "word").alias("h"))))
    pair_counts = texts.mapInArrow(tidy(count_pairs(known)), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    common = spark.sparkContext.broadcast(bit_filter(pair_counts.where(F.col("n") >= least).select("pair")))
    projected = texts.mapInArrow(tidy(project(known, common)), PROJECTED)
    projected = scratch.keep(projected, "projections")
    small_batches(spark, 8 << 20)  # of rows by prefix: the more a batch holds, the fewer rows longer prefixes make
    phrases = scratch.keep(frequent_phrases(projected, scratch, least), "phrases")

    words = F.split("phrase", " ")
    size = F.size(words)
    times = phrases.unionByName(frequent.select("lang", F.col("word").alias("phrase"), F.col("n").alias("a")))
    part = lambda start, length: F.concat_ws(" ", F.slice(words, start, length))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, size - F.col("k")).alias("rest"))
    for side, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(times.select("lang", F.col("phrase").alias(side), F.col("a").alias(name)), ["lang", side])
    n = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    scored = cuts.join(n, "lang").withColumn("score", F.expr("CAST(1000 AS DECIMAL(4, 0)) * a * n div (CAST(l AS DECIMAL(19, 0)) * r)"))
    worst = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("c")).select("lang", "phrase", "c.*")

    places = F.expr("flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), s -> concat_ws(' ', slice(words, s, m)))))")
    held = phrases.withColumn("words", words).where(F.size("words") > 2).select("lang", "a", F.explode(places).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("held"))
    free = worst.join(held, ["lang", "phrase"], "left").where("held IS NULL OR held < a")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return free.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))
