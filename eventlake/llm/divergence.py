"""How far the word use of sources differs, within each language, by tiles of group blocks.

A group is a (lang, source).  Counts of kept terms are packed into vectors by vocabulary chunk and block of groups;
each block goes to the tiles that it takes part in, and a tile, the pair of two blocks, adds up its submatrix of
divergences over successive chunks.  All arithmetic is on integers: p = 1 + floor(10^9 (count + 1) / (N + V)) and
f = floor((p - q)^2 / q).
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, join_groups, small_batches, tidy
from .words import Cutter, Sums, groups, totals

#: What is no part of a term: ASCII other than letters.
OTHER = bytes(b for b in range(128) if not chr(b).isalpha())
ONE = 1_000_000_000
LEAST_DOCS, TOP = 3, 200
#: Counts (of one term in one group) in a vocabulary chunk, about.
CELLS = 1 << 18
#: Groups of a block, at least, and blocks of a language, at most: a vector goes to no more tiles than that.
BLOCK, BLOCKS = 8, 64
#: Pairs of counts that a tile works on at a time.
SLICE = 1 << 20
PACKED = "lang string, block int, blocks int, chunk int, n_terms int, packed binary"


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n, docs: occurrences and documents of each term, summed up in the task."""
    cut, sums = Cutter(OTHER), Sums(["lang", "source", "term"], ["n", "docs"])
    for batch in batches:
        found = cut(batch["text"].to_pylist())
        names = list(zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), strict=True))
        group = {name: k for k, name in enumerate(dict.fromkeys(names))}
        v = max(1, len(found.words))
        each, n = totals(found.text * v + found.code, np.ones(len(found.code), np.int64))
        of = np.array([group[name] for name in names], np.int64)[each // v]
        key, n, docs = totals(of * v + each % v, n, np.ones(len(each), np.int64))
        langs, sources = (pa.array([name[k] for name in group], pa.string()) for k in (0, 1))
        yield from sums.add(pa.table({"lang": langs.take(pa.array(key // v)), "source": sources.take(pa.array(key // v)), "term": found.words.take(pa.array(key % v)).cast(pa.binary()), "n": n, "docs": docs}))
    yield from sums.rest()


def shares(counts: np.ndarray, over: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (counts + 1) / over), by long division in three digits of a thousand, so that no product passes 64 bits."""
    if len(over) and over.max() >= 1 << 53:
        raise ValueError("counts of over 2^53 in one group")
    rest, out = counts + 1, 0
    for _ in range(3):
        rest = rest * 1000
        digit = rest // over
        out, rest = out * 1000 + digit, rest - digit * over
    return (out + 1).astype(np.uint64)


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A count matrix, groups by terms, for each block of a vocabulary chunk; blocks without counts are empty."""
    for (lang, chunk), rows in groups(batches, ["lang", "chunk"]):
        term = rows["term"].combine_chunks().dictionary_encode().indices.to_numpy()
        at, n = rows["at"].to_numpy(), rows["n"].to_numpy()
        blocks, size, width = rows["blocks"][0].as_py(), rows["size"][0].as_py(), int(term.max()) + 1
        order = np.argsort(at, kind="stable")
        at, n, term = at[order], n[order], term[order]
        ends = np.searchsorted(at, np.arange(blocks + 1) * size)
        for b in range(blocks):
            own = slice(ends[b], ends[b + 1])
            packed = b""
            if ends[b + 1] > ends[b]:
                matrix = np.zeros((size, width), np.min_scalar_type(int(n[own].max())))
                matrix[at[own] - b * size, term[own]] = n[own]
                packed = matrix.dtype.char.encode() + zlib.compress(matrix.tobytes(), 1)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang], pa.string()), "block": pa.array([b], pa.int32()), "blocks": pa.array([blocks], pa.int32()),
                "chunk": pa.array([chunk], pa.int32()), "n_terms": pa.array([width], pa.int32()), "packed": pa.array([packed], pa.binary())})


class Block:
    """One side of a tile: its groups and what their counts are divided by."""

    def __init__(self, head: bytes) -> None:
        about = json.loads(head)
        self.sources = [g.get("source", "") for g in about]
        self.over = np.array([g["total"] + g["kept"] for g in about], np.int64)[:, None]

    def p(self, packed: bytes, width: int) -> np.ndarray:
        if not packed:
            return np.broadcast_to(shares(np.zeros_like(self.over), self.over), (len(self.over), width))
        counts = np.frombuffer(zlib.decompress(packed[1:]), np.dtype(packed[:1].decode())).reshape(-1, width)
        return shares(counts[: len(self.over)].astype(np.int64), self.over)


class Tile:
    """The divergences of the groups of two blocks, both ways, added up chunk by chunk."""

    def __init__(self, lang: str, a: Block, b: Block) -> None:
        self.lang, self.a, self.b = lang, a, b
        self.there = np.zeros((len(a.sources), len(b.sources)), np.int64)
        self.back = np.zeros_like(self.there)

    def add(self, p: np.ndarray, q: np.ndarray) -> None:
        step = max(1, SLICE // self.there.size)
        for k in range(0, p.shape[1], step):
            x, y = p[:, None, k : k + step], q[None, :, k : k + step]
            square = np.where(x > y, x - y, y - x) ** 2
            self.there += (square // y).sum(-1).astype(np.int64)
            if self.a is not self.b:
                self.back += (square // x).sum(-1).astype(np.int64)

    def rows(self) -> Iterator[pa.RecordBatch]:
        ways = [(self.a, self.b, self.there)] + ([(self.b, self.a, self.back.T)] if self.a is not self.b else [])
        for a, b, sums in ways:
            for i, source in enumerate(a.sources):
                other = [j for j, s in enumerate(b.sources) if s != source]
                if other:
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([self.lang] * len(other), pa.string()), "source": pa.array([source] * len(other), pa.string()),
                        "item": pa.array([b.sources[j] for j in other], pa.string()), "value": pa.array(sums[i, other], pa.int64())})


def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles in turn, each with its heads (chunk -1) first and then its chunks."""
    tile = now = None
    for (lang, i, j, chunk), rows in groups(batches, ["lang", "i", "j", "chunk"]):
        sides = dict(zip(rows["block"].to_pylist(), rows["packed"].to_pylist(), strict=True))
        if now != (lang, i, j):
            if tile:
                yield from tile.rows()
            now, a = (lang, i, j), Block(sides[i])
            tile = Tile(lang, a, a if i == j else Block(sides[j]))
        if chunk >= 0:
            width = rows["n_terms"][0].as_py()
            p = tile.a.p(sides[i], width)
            tile.add(p, p if i == j else tile.b.p(sides[j], width))
    if tile:
        yield from tile.rows()


def divergences(docs: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: see the module, and for each group its terms that are most in excess over the language's.

    Null text, lang and source count as ''; an empty table gives no rows; repeated rows are documents of their own; a source that is alone in its language
    has no ``pair`` rows.  Kept are the terms in at least ``LEAST_DOCS`` documents of a language.  Other columns are ignored.  A task holds one batch of
    texts, sums up to a bound, a vocabulary chunk, or two blocks of one chunk; a term that all documents share is summed before it is shuffled.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "divergence")
    small_batches(spark, 8 << 20)
    named = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    partial = named.select("lang", "source", F.col("text").cast("binary")).mapInArrow(tidy(count_terms), "lang string, source string, term binary, n long, docs long")
    term = Window.partitionBy("lang", "term")
    summed = partial.withColumn("term", F.col("term").cast("string")).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    first = F.row_number().over(term.orderBy("source")) == 1
    kept = summed.select("lang", "source", "term", "n", F.sum("docs").over(term).alias("docs"), F.sum("n").over(term).alias("n_lang"), first.cast("long").alias("first"))
    kept = scratch.keep(kept.where(F.col("docs") >= LEAST_DOCS).drop("docs"), "kept")

    langs = kept.groupBy("lang").agg(F.sum("n").alias("total_lang"), F.sum("first").alias("kept"), F.count("*").alias("cells"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("rows"))
    every = named.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    in_lang = Window.partitionBy("lang")
    blocks = F.least(F.lit(BLOCKS), F.ceil(F.col("n_groups") / BLOCK)).cast("int")
    every = every.select("*", (F.row_number().over(in_lang.orderBy("source")) - 1).alias("at"), F.count("*").over(in_lang).alias("n_groups"))
    every = every.withColumns({"blocks": blocks, "chunks": F.ceil(F.col("cells") / CELLS).cast("int")}).withColumn("size", F.ceil(F.col("n_groups") / F.col("blocks")).cast("int"))
    every = scratch.keep(every.withColumn("block", F.expr("cast(at div size AS int)")), "groups")

    cells = join_groups(kept, every.where("rows > 0"), ["lang", "source"], "rows", kept.count(), "term")
    share = "1 + CAST(1000000000 AS DECIMAL(10, 0)) * ({0} + 1) div ({1} + kept)"
    excess = cells.selectExpr("lang", "source", "term AS item", f"{share.format('n', 'total')} AS p", f"{share.format('n_lang', 'total_lang')} AS q").where("p > q")
    terms = excess.selectExpr("lang", "source", "'term' AS part", "item", "(p - q) * (p - q) div q AS value")

    chunked = cells.select("lang", F.expr("cast(pmod(xxhash64(term), chunks) AS int)").alias("chunk"), "term", "at", "n", "blocks", "size")
    packed = chunked.repartition("lang", "chunk").sortWithinPartitions("lang", "chunk", "term").mapInArrow(tidy(pack), PACKED)
    about = F.to_json(F.array_sort(F.collect_list(F.struct("at", "source", "total", "kept")))).cast("binary")
    heads = every.groupBy("lang", "block", "blocks").agg(about.alias("packed")).select("lang", "block", "blocks", F.lit(-1).alias("chunk"), F.lit(0).alias("n_terms"), "packed")
    sides = packed.unionByName(heads).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sides = sides.select("lang", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "chunk", "block", "n_terms", "packed")
    tiles = sides.repartition("lang", "i", "j").sortWithinPartitions("lang", "i", "j", "chunk")
    pairs = tiles.mapInArrow(tidy(add_up), "lang string, source string, item string, value long").select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).where(F.col("rank") <= top))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(spark.read.parquet(f"{sf_dir}/documents.parquet"))
