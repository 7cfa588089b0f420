"""Toxicity by a classifier chain over word and word-stem features.

Categories are predicted one after another by linear models; each model also reads the probabilities of the
categories before it.  In training these are out-of-fold predictions, so a later model sees them as
unsure as they will be on new documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, Scratch, small_batches, tidy
from .quality import held_out, sigmoid

#: Common English insults, which split labelled toxic texts into ``insult`` and ``coded`` (abuse in other words).
INSULTS = frozenset("asshole bastard bitch clown coward creep cretin damn disgusting dumb fool freak fuck garbage hate idiot imbecile jerk kill liar loser lunatic moron pathetic pig rat scum shit slut stupid sucker trash ugly vermin whore worthless".split())
CATEGORIES = ("insult", "coded", "toxic")
#: Word starts of these lengths are features, since abusive stems come with many endings.
STEMS = (4, 5, 6, 7)
#: At most about so many labelled rows are fitted on, chosen by a hash of doc_id; so many features, by the z score of their log odds ratio, which has to be large itself.
MAX_LABELLED, MAX_FEATURES, LEAST_Z, LEAST_ODDS, LEAST_DOCS = 16_000, 2048, 3.0, 2.0, 3
FOLDS, STEPS, RIDGE = 5, 300, 1e-4
THRESHOLD = 0.5


def traits(text: str | None) -> set[str]:
    """Distinct lower-case words, and their starts marked by a hyphen."""
    words = set(WORD.findall((text or "").lower()))
    out = set(words)
    for n in STEMS:
        out |= {w[:n] + "-" for w in words if len(w) >= n}
    return out


def count_traits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        toxic, clean = Counter(), Counter()
        for text, label in zip(batch["text"], batch["toxic"], strict=True):
            (toxic if label else clean).update(traits(text))
        yield pd.DataFrame([(t, toxic[t], clean[t]) for t in {*toxic, *clean}], columns=["trait", "bad", "good"])


def distinct(found: list[tuple[str, int, int]]) -> list[str]:
    """Traits without those that say the same: of a word and its starts with equal counts the shortest stays."""
    kept: dict[tuple[str, int, int], str] = {}
    for trait, bad, good in sorted(found, key=lambda x: len(x[0])):
        kept.setdefault((trait[: STEMS[0]], bad, good), trait)
    return sorted(kept.values())


@dataclass
class Chain:
    traits: list[str]
    models: list[tuple[np.ndarray, float]]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of every category for presence rows x."""
        out = np.zeros((len(x), 0))
        for w, b in self.models:
            out = np.column_stack([out, sigmoid(np.column_stack([x, out]) @ w + b)])
        return out

    def presence(self, texts: list[str | None]) -> np.ndarray:
        place = {t: k for k, t in enumerate(self.traits)}
        words = {t for t in place if not t.endswith("-")}
        stems = {n: {t[:-1] for t in place if t.endswith("-") and len(t) == n + 1} for n in STEMS}
        x = np.zeros((len(texts), len(place)), np.float32)
        for row, text in enumerate(texts):
            own = set(WORD.findall((text or "").lower()))
            found = [place[w] for w in own & words]
            for n, known in stems.items():
                found += [place[s + "-"] for s in {w[:n] for w in own} & known]
            x[row, found] = 1
        return x


def logistic(x: np.ndarray, earlier: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on sparse presence rows x and dense columns ``earlier``, by Nesterov's gradient steps.

    Columns are scaled to a mean square of one, so rare traits are learned as fast as frequent ones.
    """
    prior = np.clip(y.mean(), 1e-4, 1 - 1e-4) if len(y) else 0.5
    bias, width = np.log(prior / (1 - prior)), x.shape[1]
    if not len(y) or y.min() == y.max():
        return np.zeros(width + earlier.shape[1]), float(bias)
    row, col = np.nonzero(x)
    seen = np.bincount(col, minlength=width)
    scale = 1 / np.sqrt(np.maximum(seen, 1) / len(y))
    wide = np.column_stack([earlier, np.ones(len(y))])
    scale_wide = 1 / np.sqrt((wide**2).mean(axis=0) + 1e-6)
    wide = wide * scale_wide
    value = scale[col]

    def times(w: np.ndarray) -> np.ndarray:
        return np.bincount(row, weights=value * w[col], minlength=len(y)) + wide @ w[width:]

    def back(d: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(col, weights=value * d[row], minlength=width), wide.T @ d])

    v = np.ones(width + wide.shape[1])
    for _ in range(20):  # the largest eigenvalue of x'x / 4n, by power iteration, bounds the step
        v = back(times(v / np.linalg.norm(v)))
    rate = 1 / (np.linalg.norm(v) / (4 * len(y)) * 1.05 + RIDGE)
    w = np.append(np.zeros(width + earlier.shape[1]), bias / scale_wide[-1])
    penalty = np.append(np.full(len(w) - 1, RIDGE), 0)
    ahead = last = w
    for k in range(STEPS):
        w = ahead - rate * (back(sigmoid(times(ahead)) - y) / len(y) + penalty * ahead)
        ahead, last = w + k / (k + 3) * (w - last), w
    w = w * np.concatenate([scale, scale_wide])
    return w[:-1], float(w[-1])


def train(x: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> list[tuple[np.ndarray, float]]:
    """One model a category; labels has a column each."""
    earlier, models = np.zeros((len(x), 0)), []
    for k in range(labels.shape[1]):
        models.append(logistic(x, earlier, labels[:, k]))
        aside = np.zeros(len(x))
        for f in range(FOLDS):
            w, b = logistic(x[fold != f], earlier[fold != f], labels[fold != f, k])
            aside[fold == f] = sigmoid(np.column_stack([x[fold == f], earlier[fold == f]]) @ w + b)
        earlier = np.column_stack([earlier, aside])
    return models


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Chain:
    """A chain from labelled rows that aren't held out."""
    spark = docs.sparkSession
    small_batches(spark)
    marked = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("doc_id")))
    share = min(1.0, max_labelled / max(1, marked.count()))
    marked = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # the sample has a bound, one text an id; written once, since it is read for the traits and for their links
    sample = docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "toxic")).alias("s"))
    sample = Scratch(docs.sparkSession, "toxicity").keep(sample.select("doc_id", "s.*"), "sample")
    size = marked.groupBy("toxic").count().collect()
    n = {bool(r["toxic"]): r["count"] for r in size}
    bad, good = n.get(True, 0), n.get(False, 0)
    if not bad or not good:
        return Chain([], [(np.zeros(k), -20.0 if not bad else 20.0) for k in range(len(CATEGORIES))])
    counts = sample.mapInPandas(tidy(count_traits), "trait string, bad long, good long").groupBy("trait").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).where(F.col("bad") >= LEAST_DOCS)
    odds = F.log((F.col("bad") + 0.5) / (bad - F.col("bad") + 0.5)) - F.log((F.col("good") + 0.5) / (good - F.col("good") + 0.5))
    counts = counts.where(F.expr(f"bad <= {bad} AND good <= {good}"))
    z = odds / F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    best = counts.select("trait", "bad", "good", odds.alias("odds"), z.alias("z")).where((F.col("z") >= LEAST_Z) & (F.col("odds") >= LEAST_ODDS)).orderBy(F.desc("z"), "trait").limit(MAX_FEATURES).collect()
    chain = Chain(distinct([(r.trait, r.bad, r.good) for r in best]), [])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = chain.presence(list(batch["text"]))
            seed = [not INSULTS.isdisjoint(WORD.findall((t or "").lower())) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"].astype(int), "seed": seed, "found": [np.flatnonzero(r).tolist() for r in x]})

    rows = sample.mapInPandas(tidy(run), "doc_id long, toxic int, seed boolean, found array<int>").toPandas().sort_values("doc_id")
    x = np.zeros((len(rows), len(chain.traits)), np.float32)
    for k, found in enumerate(rows["found"]):
        x[k, np.asarray(found, int)] = 1
    toxic, seed = rows["toxic"].to_numpy() > 0, rows["seed"].to_numpy(bool)
    fold = (rows["doc_id"].to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(FOLDS)
    chain.models = train(x, np.column_stack([toxic & seed, toxic & ~seed, toxic]).astype(float), fold)
    return chain


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, p_insult, p_coded, p_toxic, toxic for every row of ``docs``.

    ``toxic`` is p_toxic >= ``threshold``.  Categories come from ``labels.toxic``: a toxic text with a word of
    INSULTS is an insult, another one coded.  Null and empty texts are read as having no words; null labels
    are skipped, contradicting ones count as toxic, of several texts with one id the least is learnt from; with one kind of label only, all are of that kind, and with none
    nothing is toxic.  Repeated rows are judged each; other columns are ignored; an empty table gives no rows.
    """
    chain = fit(docs, labels)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = shared.value.predict(shared.value.presence(batch["text"].to_pylist()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *[pa.array(p[:, k], pa.float64()) for k in range(len(CATEGORIES))]], names=["doc_id", *[f"p_{c}" for c in CATEGORIES]])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), "doc_id long, p_insult double, p_coded double, p_toxic double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "p_insult", "p_coded", "p_toxic", (F.col("p_toxic") >= threshold).alias("toxic"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
