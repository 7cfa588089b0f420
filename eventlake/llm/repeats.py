"""Removal of repeated byte strings by a depth-limited, most-significant-digit radix sort of suffixes.

A window is a suffix cut off after ``LENGTH`` bytes; equal groups of windows are the repeated strings.
Suffixes are refined by digits of growing depth, and whatever is alone after a pass is dropped:

1. *Anchor digit.*  Each window names the least-hashed of its ``DIGIT``-byte substrings.  Equal windows
   name equal substrings, so one row stands for the run of neighbouring windows with one anchor (about 3 rows
   for 100 bytes), and only rows that share an anchor go on.
2. *Run and context digits.*  Runs with the same bytes throughout are one group: all but the first are
   covered whole.  First runs go on only if half of the rest of a window, left or right of the anchor, is shared.
3. *Remaining digits.*  The windows of what is left are radix sorted in 8-byte digits to
   depth ``LENGTH``; in each group that is left every window but the first is covered.

A group of over ``GROUP`` rows with one anchor, such as the edges of a passage that very many texts share, is dealt to
several tasks, and the windows that are first in their task meet once more by 128 bits of hash, pre-aggregated.

Hashes otherwise only choose what to compare in passes 1 and 3; runs are taken as equal in pass 2 when 128 bits of hash,
their length and anchor place agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BASE, Scratch, mixed, small_batches, tidy
from .sharding import keyed

LENGTH, DIGIT = 100, 32
SPAN = LENGTH - DIGIT + 1  # places of an anchor in a window
HALF = (LENGTH - DIGIT) // 2
#: Rows of one anchor that a task of pass 3 sorts together; pass 2 holds ten times as many (slim) rows.
GROUP = 20_000
#: Bytes sorted at a time; a place in them has to fit PLACE bits.
CHUNK, PLACE = 2 << 20, 23
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * BASE)
DOC_SCHEMA = "h long, run long, context long, key long, start long, n int, place int, done boolean"
COVER_SCHEMA = "key long, start long, n int, h long, place int"
WINDOW_SCHEMA = "key long, start long, n int, w1 long, w2 long"


class Powers:
    """Powers of the base and its inverse, to any length asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                for name, base in (("up", BASE), ("down", INVERSE)):
                    p = np.full(n, base, np.uint64)
                    p[0] = 1
                    setattr(self, name, np.cumprod(p, dtype=np.uint64))
        return self.up, self.down


POWERS = Powers()


def run_rows(pieces: list[tuple[int, int, bytes]]) -> pd.DataFrame | None:
    """Runs of windows with one anchor in pieces (key, offset in the document, bytes); windows stay inside a piece."""
    pieces = sorted((p for p in pieces if len(p[2]) >= LENGTH), key=lambda p: p[:2])
    if not pieces:
        return None
    data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    sizes = np.array([len(p[2]) for p in pieces])
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    up, down = POWERS.to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTES[data] * up[: len(data)], out=sums[1:])

    def digit(s: np.ndarray, e: np.ndarray) -> np.ndarray:
        return mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))

    grams = mixed((sums[DIGIT:] - sums[:-DIGIT]) * down[: len(data) - DIGIT + 1] + np.uint64(DIGIT))
    low = np.uint64((1 << PLACE) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width * 2 <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (SPAN - width)], least[SPAN - width :])
    inside = np.zeros(len(data) + 1, np.int8)
    inside[begins] += 1
    np.subtract.at(inside, begins + sizes - LENGTH + 1, 1)
    p = np.flatnonzero(np.cumsum(inside)[: len(least)] > 0)
    anchor = (least[p] & low).astype(np.int64)
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (p[1:] != p[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(p)]]) - 1
    s, e, a = p[first], p[last], anchor[first]
    at = np.searchsorted(begins, s, side="right") - 1
    alone = mixed(np.arange(len(s), dtype=np.uint64) + mixed(np.uint64([pieces[0][0] & (2**63 - 1)])))  # shared with no other
    left = np.where(a - s >= HALF, digit(np.maximum(a - HALF, 0), a), alone)
    right = np.where(a - e <= HALF, digit(a + DIGIT, np.minimum(a + DIGIT + HALF, len(data))), ~alone)
    sixteen = np.uint64(0xFFFF)
    rows = pd.DataFrame({
        "h": grams[a].view(np.int64), "run": mixed(digit(s, e + LENGTH) + ((a - s) * 256 + e - s).astype(np.uint64)).view(np.int64),
        "context": ((left & sixteen) << np.uint64(16) | (right & sixteen)).astype(np.int64),
        "key": np.array([x[0] for x in pieces], np.int64)[at], "start": s - begins[at] + np.array([x[1] for x in pieces])[at],
        "n": (e - s + 1).astype(np.int32), "place": (a - s).astype(np.int32),
    })
    # Map-side: pieces are in order, so all but the first of equal runs are known to be covered; they are spread instead of meeting in one task.
    both = mixed(rows["h"].to_numpy().view(np.uint64)) ^ rows["run"].to_numpy().view(np.uint64)
    done = np.ones(len(rows), bool)
    done[np.unique(both, return_index=True)[1]] = False
    rows["done"] = done
    rows.loc[done, "h"] = mixed(alone[done]).view(np.int64)
    return rows


def emit_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    waiting, size = [], 0
    for batch in batches:
        for key, text in zip(batch["key"], batch["text"], strict=True):
            data = (text or "").encode()
            for at in range(0, max(1, len(data)), CHUNK):
                waiting.append((key, at, data[at : at + CHUNK + LENGTH - 1]))
                size += len(waiting[-1][2])
                if size >= CHUNK:
                    if (rows := run_rows(waiting)) is not None:
                        yield rows
                    waiting, size = [], 0
    if (rows := run_rows(waiting)) is not None:
        yield rows


def grouped(batches: Iterator[pd.DataFrame], key: str, most: int = 1 << 62) -> Iterator[pd.DataFrame]:
    """Whole groups of a stream sorted by ``key``, many at a time.

    A group of over ``most`` rows comes in pieces, all but the last marked by ``attrs["open"]``, the key.
    """
    rest: list[pd.DataFrame] = []
    held = 0

    def joined(parts: list[pd.DataFrame], is_open: bool = False) -> pd.DataFrame:
        out = pd.concat(parts, ignore_index=True)
        out.attrs["open"] = out[key].iloc[-1] if is_open else None
        return out

    for batch in batches:
        if not len(batch):
            continue
        values = batch[key].to_numpy()
        cut = int(np.flatnonzero(values != values[-1])[-1]) + 1 if values[0] != values[-1] else 0
        if cut:
            yield joined([*rest, batch.iloc[:cut]])
            rest, held = [], 0
        elif rest and rest[-1][key].iloc[-1] != values[0]:
            yield joined(rest)
            rest, held = [], 0
        rest.append(batch.iloc[cut:])
        held += len(rest[-1])
        if held > most:
            yield joined(rest, True)
            rest, held = [], 0
    if rest:
        yield joined(rest)


def shared(h: np.ndarray, digit: np.ndarray) -> np.ndarray:
    """Whether another row has the same (h, digit)."""
    _, inverse, counts = np.unique(mixed(h.view(np.uint64)) + digit.astype(np.uint64) * BASE, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def refine_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pass 2 on rows sorted by h, run, key, start: covered runs (place -1) and first runs to look into."""
    last = opened = None  # (h, run) of the row before, and the anchor of a group that goes on
    for rows in grouped(batches, "h", 10 * GROUP):
        done, h, run = rows["done"].to_numpy(), rows["h"].to_numpy(), rows["run"].to_numpy()
        before_h, before_run = np.append(h[:1], h[:-1]), np.append(run[:1], run[:-1])
        same = (h == before_h) & (run == before_run) & ~done & ~np.append(done[:1], done[:-1])
        same[0] = not done[0] and last == (h[0], run[0])
        last = None if done[-1] else (h[-1], run[-1])
        covered = rows.loc[same | done, ["key", "start", "n"]].assign(h=0, place=-1)
        reps = rows.loc[~(same | done)]
        h = reps["h"].to_numpy()
        # what is in pieces isn't known to be alone
        whole = ~np.isin(h, [x for x in (opened, rows.attrs["open"]) if x is not None])
        again = np.concatenate([[False], h[1:] == h[:-1]]) if len(h) else np.zeros(0, bool)
        reps = reps.loc[again | np.append(again[1:], False) | ~whole] if len(h) else reps
        if len(reps):
            h, context = reps["h"].to_numpy(), reps["context"].to_numpy()
            whole = ~np.isin(h, [x for x in (opened, rows.attrs["open"]) if x is not None])
            reps = reps.loc[shared(h, context >> 16) | shared(h, (context & 0xFFFF) + (1 << 32)) | ~whole]
        opened = rows.attrs["open"]
        yield pd.concat([covered, reps[["key", "start", "n", "h", "place"]]], ignore_index=True).astype({"n": "int32", "place": "int32"})


def cut_contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Bytes of the runs listed for each text."""
    for batch in batches:
        out = []
        for key, text, wanted in zip(batch["key"], batch["text"], batch["runs"], strict=True):
            data = (text or "").encode()
            out += [(x["g"], x["parts"], x["h"], key, x["start"], x["place"], data[x["start"] : x["start"] + x["n"] + LENGTH - 1]) for x in wanted]
        yield pd.DataFrame(out, columns=["g", "parts", "h", "key", "start", "place", "bytes"]).astype({"g": "int64", "parts": "int32", "h": "int64", "key": "int64", "start": "int64", "place": "int32"})


def window_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of the windows at the given places."""
    up, down = POWERS.to(len(data) + 1)
    out = []
    for table in (BYTES, mixed(BYTES)):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * up[: len(data)], out=sums[1:])
        out.append(mixed((sums[at + LENGTH] - sums[at]) * down[at]).view(np.int64))
    return out[0], out[1]


def sort_windows(h: np.ndarray, key: np.ndarray, start: np.ndarray, place: np.ndarray, parts: np.ndarray, texts: list[bytes]) -> pd.DataFrame:
    """Pass 3: windows of the given runs that also start earlier, as runs (key, start, n); and those that don't, one by one with their hashes, of groups dealt to several tasks."""
    data = np.frombuffer(b"".join(texts) + b"\0" * 8, np.uint8)
    sizes = np.array([len(t) for t in texts])
    n = sizes - LENGTH + 1
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    row = np.repeat(np.arange(len(n)), n)
    shift = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = begins[row] + shift
    words = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1))
    words = np.ascontiguousarray(words).view(">u8").ravel()  # the eight bytes from each place, most significant first
    group = mixed(h.view(np.uint64))[row] + (place[row] - shift).astype(np.uint64)  # equal windows have their anchor in one place
    live = np.arange(len(row))
    group = np.unique(group, return_inverse=True)[1]
    for depth in [*range(0, LENGTH - 7, 8), LENGTH - 8][: (LENGTH + 7) // 8]:
        digit = words[at[live] + depth]
        order = np.lexsort((digit, group))
        g, d = group[order], digit[order]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (d[1:] != d[:-1])])
        alone = new & np.append(new[1:], True)
        keep = ~alone
        live, group = live[order[keep]], np.cumsum(new)[keep]
        if not len(live):
            break
    first = np.lexsort((start[row[live]] + shift[live], key[row[live]], group)) if len(live) else live
    live, group = live[first], group[first]
    covered = np.sort(live[np.concatenate([[False], group[1:] == group[:-1]])]) if len(live) else live
    new = np.concatenate([[True], (covered[1:] != covered[:-1] + 1) | (row[covered[1:]] != row[covered[:-1]])]) if len(covered) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(covered)) - 1 if len(head) else head
    found = pd.DataFrame({"key": key[row[covered[head]]], "start": start[row[covered[head]]] + shift[covered[head]], "n": (covered[tail] - covered[head] + 1).astype(np.int32) if len(head) else np.zeros(0, np.int32), "w1": 0, "w2": 0})
    if (parts > 1).any():
        open_ = np.setdiff1d(np.flatnonzero(parts[row] > 1), covered, assume_unique=True)
        w1, w2 = window_hashes(data, at[open_])
        found = pd.concat([found, pd.DataFrame({"key": key[row[open_]], "start": start[row[open_]] + shift[open_], "n": np.int32(-1), "w1": w1, "w2": w2})], ignore_index=True)
    return found


def refine_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in grouped(batches, "g"):
        yield sort_windows(*(rows[c].to_numpy() for c in ("h", "key", "start", "place", "parts")), list(rows["bytes"]))


def apply_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch["text"].to_pylist(), batch["spans"].to_pylist(), strict=True):
            data = (text or "").encode()
            merged: list[list[int]] = []
            for x in sorted((x["start"], x["start"] + x["n"] + LENGTH - 1) for x in (() if spans is None else spans)):
                if merged and x[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], x[1])
                else:
                    merged.append([*x])
            kept, last = [], 0
            for s, e in merged:
                kept.append(data[last:s])
                last = e
            kept.append(data[last:])
            removed = sum(e - s for s, e in merged)
            out.append((len(data), removed, len(merged), hashlib.sha256(b"".join(kept)).hexdigest(), [{"start": s, "end": e} for s, e in merged]))
        kinds = [*[pa.int64()] * 3, pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, end byte) for every row of ``docs``.

    A byte goes if a ``LENGTH``-byte string over it also starts earlier: in a smaller doc_id, or before
    in the same document.  Null texts count as empty; texts under ``LENGTH`` bytes are kept whole; rows that
    repeat a doc_id (or have none: first in order) are documents of their own, in the order of their text's crc32,
    and identical rows in any order; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    small_batches(spark)
    texts = keyed(docs, scratch)
    rows = texts.select("key", "text").mapInPandas(tidy(emit_runs), DOC_SCHEMA)
    rows = rows.repartition("h").sortWithinPartitions("h", "run", "key", "start")
    refined = scratch.keep(rows.mapInPandas(tidy(refine_runs), COVER_SCHEMA), "refined")
    wanted = refined.where("place >= 0")
    large = wanted.groupBy("h").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts")).where("parts > 1")
    large = scratch.keep(large, "large")
    dealt = wanted.join(large, "h", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("g", F.when(F.col("parts") == 1, F.col("h")).otherwise(F.xxhash64("h", F.pmod(F.hash("key"), "parts"))))
    lists = dealt.groupBy("key").agg(F.collect_list(F.struct("g", "parts", "h", "start", "n", "place")).alias("runs"))
    contexts = texts.join(lists, "key").select("key", "text", "runs").mapInPandas(tidy(cut_contexts), "g long, parts int, h long, key long, start long, place int, bytes binary")
    windows = contexts.repartition("g").sortWithinPartitions("g").mapInPandas(tidy(refine_windows), WINDOW_SCHEMA)
    if large.limit(1).count():
        windows = scratch.keep(windows, "windows")
        ahead = windows.where("n < 0").select("w1", "w2", F.struct("key", "start").alias("at"))
        first = ahead.groupBy("w1", "w2").agg(F.min("at").alias("first"), F.count("*").alias("times")).where("times > 1")
        later = ahead.join(first, ["w1", "w2"]).where("at <> first").select("at.key", "at.start", F.lit(1).alias("n"))
        windows = windows.where("n > 0").select("key", "start", "n").union(later)
    covered = refined.where("place < 0").select("key", "start", "n").union(windows.select("key", "start", "n"))
    spans = covered.groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"
    return texts.join(spans, "key", "left").select("doc_id", "text", "spans").mapInArrow(tidy(apply_spans), out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")
