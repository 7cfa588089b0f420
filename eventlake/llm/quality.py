"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network.

A text is two streams of tokens, its words and their forms (how each is written, and whether it was there before).  Either has vectors of its own from the
contexts in all documents, and pooled vectors are all that the network sees.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordHashes, mixed, small_batches, tidy

TOKEN = re.compile(r"\w+|[^\w\s]|\n+")
#: Words are hashed to so many rows of so many dimensions, and their forms to further ones, four for each of FORMS // 4 shapes: new in its text, met before
#: there, the same as the word before.  An index vector has SPARSE entries of +-1; contexts reach REACH tokens to each side.
WORDS, FORMS, DIMS, SPARSE, REACH = 8192, 1024, 64, 4, 2
ROWS = WORDS + FORMS
#: Rows of the table that are added up together.
SLAB = 128
#: Labelled rows that the network is fitted on, at most about so many, chosen by a hash of doc_id.
MAX_LABELLED = 20_000
#: Texts whose forms are pooled at a time.
TEXTS = 256
#: Pools of a text: the mean of its word vectors, and mean and spread of its form vectors.
POOLS = 3
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 3e-3, 1e-4
THRESHOLD = 0.3


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learned from; those without a doc_id too."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def shape(token: str) -> str:
    """The form of a token: how it is written and how long it is, or the mark that it is."""
    if not (token[0].isalnum() or token[0] == "_"):
        return token[:2]
    if token.islower():  # most are; no other case is looked at then
        kind = 0
    elif token[0].isupper() and token[1:].upper() != token[1:] or len(token) == 1 and token.isupper():
        kind = 1
    elif token.isupper():
        kind = 2
    elif token.isdigit():
        kind = 3
    else:
        kind = 4 if any(c.isdigit() for c in token) else 5
    return f"{kind}{'' if token.isascii() else '+'}:{min(len(token), 16)}"


@lru_cache(maxsize=1 << 16)
def shape_row(form: str) -> int:
    return xxhash.xxh64_intdigest(form) % (FORMS // 4)


class TokenRows(WordHashes):
    """token -> the row of its word, and its shape above 32 bits."""

    def __missing__(self, token: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[token] = xxhash.xxh64_intdigest(token.lower()) % WORDS | shape_row(shape(token)) << 32
        return value


def tokens(texts: list[str | None], rows: TokenRows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word rows and form rows of all texts, and where each text ends."""
    found = [rows.of(TOKEN.findall(t or "")).astype(np.int64) for t in texts]
    ends = np.cumsum([len(x) for x in found], dtype=np.int64)
    both = np.concatenate([*found, np.zeros(0, np.int64)])
    word = both & 0xFFFFFFFF
    key = np.repeat(np.arange(len(found)), np.diff(ends, prepend=0)) * WORDS + word
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), np.int64)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    again[1:][key[1:] == key[:-1]] = 2
    return word, WORDS + (both >> 32) * 4 + again, ends


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the sparse random index vector of every row."""
    k = np.arange(ROWS * SPARSE, dtype=np.uint64)
    bits = mixed(mixed(k + np.uint64(17)))
    return (bits % np.uint64(DIMS)).astype(np.int64).reshape(ROWS, SPARSE), np.where(bits >> np.uint64(63), 1.0, -1.0).reshape(ROWS, SPARSE)


def add_contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(slab, sums) of the context vectors, and of token counts in the last column, over a task's texts; words have words as context, forms forms."""
    known, (place, sign) = TokenRows(), index_vectors()
    places, signs = [np.ascontiguousarray(x[:WORDS].T) for x in (place, sign)]
    total, pairs = np.zeros((ROWS, DIMS + 1)), np.zeros(FORMS * FORMS)
    for batch in batches:
        words, forms, ends = tokens(list(batch["text"]), known)
        text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        total[:, DIMS] += np.bincount(words, minlength=ROWS) + np.bincount(forms, minlength=ROWS)
        near = [text[r:] == text[:-r] for r in range(1, REACH + 1)]
        for r, same in enumerate(near, 1):  # forms are few: pairs are counted, and meet the index vectors at the end
            pairs += np.bincount(((forms[:-r] - WORDS) * FORMS + forms[r:] - WORDS)[same], minlength=FORMS * FORMS)
        left, right = [np.concatenate(x) for x in zip(*[(words[:-r][same], words[r:][same]) for r, same in enumerate(near, 1)], strict=True)]
        of, by = np.concatenate([left, right]), np.concatenate([right, left])
        start = of * DIMS
        for k in range(SPARSE):  # the table is long, so all pairs of a batch are summed up at once
            total[:WORDS, :DIMS] += np.bincount(start + places[k][by], weights=signs[k][by], minlength=WORDS * DIMS).reshape(WORDS, DIMS)
    index = np.zeros((FORMS, DIMS))
    np.add.at(index, (np.arange(FORMS)[:, None], place[WORDS:]), sign[WORDS:])
    pairs = pairs.reshape(FORMS, FORMS)
    total[WORDS:, :DIMS] = (pairs + pairs.T) @ index  # whole numbers, so exact in any order
    slabs = [total[k : k + SLAB] for k in range(0, ROWS, SLAB)]
    yield pd.DataFrame({"slab": range(len(slabs)), "sums": [x.astype("<f8").tobytes() for x in slabs]})


def add_slabs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for slab, x in zip(batch["slab"], batch["sums"], strict=True):
            x = np.frombuffer(x, "<f8")
            sums[slab] = sums[slab] + x if slab in sums else x
    yield pd.DataFrame({"slab": list(sums), "sums": [x.tobytes() for x in sums.values()]}).astype({"slab": "int32"})


def word_vectors(docs: DataFrame) -> np.ndarray:
    """ROWS x DIMS vectors from the contexts in all of ``docs``; what reaches the driver is this table, of fixed size."""
    parts = docs.select("text").mapInPandas(tidy(add_contexts), "slab int, sums binary").repartition(ROWS // SLAB, "slab")
    table = np.zeros((ROWS, DIMS + 1))
    for row in parts.mapInPandas(tidy(add_slabs), "slab int, sums binary").collect():
        table[row.slab * SLAB : (row.slab + 1) * SLAB] = np.frombuffer(row.sums, "<f8").reshape(SLAB, DIMS + 1)
    vectors, counts = table[:, :DIMS], table[:, DIMS]
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    share = 2 * counts / max(1.0, counts.sum())  # of words, and of forms
    return (vectors * (1e-3 / (1e-3 + share))[:, None]).astype(np.float32)  # frequent words count for less


def features(texts: list[str | None], vectors: np.ndarray, known: TokenRows) -> np.ndarray:
    """The pooled vectors of each text; zeros for one without tokens."""
    words, forms, ends = tokens(texts, known)
    sizes = np.diff(ends, prepend=0)
    out = np.zeros((len(texts), POOLS * DIMS), np.float32)
    own = vectors[WORDS:].astype(np.float64)
    own = np.hstack([own, own * own])
    for k in range(0, len(texts), TEXTS):  # forms are few: their shares times their vectors
        n = sizes[k : k + TEXTS]
        end = ends[min(k + TEXTS, len(texts)) - 1]
        text = np.repeat(np.arange(len(n)), n)
        counts = np.bincount(text * FORMS + forms[end - n.sum() : end] - WORDS, minlength=len(n) * FORMS).reshape(len(n), FORMS)
        mean, square = np.hsplit(counts / np.maximum(n, 1)[:, None] @ own, 2)
        out[k : k + TEXTS, DIMS : 2 * DIMS] = mean
        out[k : k + TEXTS, 2 * DIMS :] = np.sqrt(np.maximum(square - mean * mean, 0))
    for k in np.flatnonzero(sizes):
        out[k, :DIMS] = vectors[words[ends[k] - sizes[k] : ends[k]]].mean(axis=0)
    return out


@dataclass
class Model:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(z, np.float64)))


def train(x: np.ndarray, y: np.ndarray, vectors: np.ndarray, seed: int = 1) -> Model:
    """Adam on the log loss of four fifths of the rows; the temperature on the fifth that is left."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    layers = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    model = Model(vectors, mean, scale, layers, 1.0)
    order = rng.permutation(len(y))
    aside, fit = order[: len(y) // 5], order[len(y) // 5 :]
    z = (x - mean) / scale
    m, v = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    step = 0
    for _ in range(EPOCHS):
        rng.shuffle(fit)
        for at in range(0, len(fit), BATCH):
            rows = fit[at : at + BATCH]
            h = np.tanh(z[rows] @ layers[0] + layers[1])
            d = (sigmoid(h @ layers[2] + layers[3]) - y[rows]) / len(rows)
            back = np.outer(d, layers[2]) * (1 - h * h)
            grads = [z[rows].T @ back + DECAY * layers[0], back.sum(axis=0), h.T @ d + DECAY * layers[2], np.array([d.sum()])]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                layers[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    if len(aside):
        logit, grid = model.logits(x[aside]), np.exp(np.linspace(np.log(0.25), np.log(8), 81))
        loss = [np.mean(np.logaddexp(0, np.where(y[aside] > 0, -logit, logit) / t)) for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
    return model


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """A model from the contexts of all ``docs`` and the quality labels that aren't held out."""
    small_batches(docs.sparkSession)
    vectors = word_vectors(docs)
    marked = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").cast("double").alias("quality")).where(~held_out(F.col("doc_id")))
    share = min(1.0, max_labelled / max(1, marked.count()))
    marked = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = TokenRows()
        for batch in batches:
            x = features(list(batch["text"]), vectors, known)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "quality": batch["quality"], "x": [row.tobytes() for row in x]})

    # the sample's ids have a bound, and so has what comes back: one row of under a kilobyte an id, however many texts share it
    sample = docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id").mapInPandas(tidy(run), "doc_id long, quality double, x binary")
    sample = sample.groupBy("doc_id").agg(F.min(F.struct("quality", "x")).alias("s")).select("doc_id", "s.*").toPandas()
    sample["x"] = sample["x"].map(bytes)
    sample = sample.sort_values(["doc_id", "x"])
    if not len(sample):
        width = POOLS * DIMS
        return Model(vectors, np.zeros(width), np.ones(width), [np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.zeros(1)], 1.0)
    x = np.frombuffer(b"".join(sample["x"]), np.float32).reshape(len(sample), -1).astype(np.float64)
    return train(x, sample["quality"].to_numpy(), vectors)


def scored(docs: DataFrame, model: Model, keep: list[str], column: str = "score") -> DataFrame:
    """Columns ``keep`` of ``docs``, as they are, and the score of each text."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model = TokenRows(), shared.value
        for batch in batches:
            score = model.scores(features(batch.column("text").to_pylist(), model.vectors, known))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(score, pa.float64())], [*keep, column])

    fields = {f.name: f for f in docs.schema.fields}
    out = type(docs.schema)([fields[c] for c in keep]).add(column, "double")
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(tidy(run), out)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Only the text is read for a score.  Null and empty texts get the score of a text without words;
    labels that are null, contradict (the greater holds), have no document or several (one is learnt from) don't stop the fit; without any the score
    is 0.5.  Repeated rows are scored each; other columns are ignored; an empty table gives no rows.
    """
    model = fit(docs, labels)
    out = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model, ["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = "_score"
    while score in docs.columns:
        score = "_" + score
    return scored(docs, model, docs.columns, score).where(F.col(score) >= THRESHOLD).drop(score).select(docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
