"""Words of many texts at once, by numpy and Arrow: bytes are classed, cut and looked up without a Python object for each word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: ASCII capitals, the only ones that are lower-cased.
CAPITALS = range(ord("A"), ord("Z") + 1)


@dataclass
class Cut:
    """Words of a list of texts in order: ``code`` points into the distinct ``words``, ``text`` is the text's place, ``opens`` marks the first word of a piece."""

    code: np.ndarray
    words: pa.Array
    text: np.ndarray
    opens: np.ndarray


class Cutter:
    """Cuts UTF-8 bytes at ``separators``; ``breaks`` part words too, and end a piece besides.  Line feeds have to be among them, since they part the texts.

    Works on all texts handed over at once, in about twelve times their size.
    """

    def __init__(self, separators: bytes, breaks: bytes = b"") -> None:
        self.kind = np.zeros(256, np.uint8)
        self.kind[list(separators)] = 1
        self.kind[list(breaks)] = 2
        if not self.kind[ord("\n")]:
            raise ValueError("texts are parted by line feeds, so words can't hold them")
        self.folded = np.arange(256, dtype=np.uint8)
        self.folded[list(CAPITALS)] += 32
        self.folded[self.kind > 0] = ord(" ")

    def __call__(self, texts: list[bytes]) -> Cut:
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        kind = self.kind[raw]
        inside = kind == 0
        edges = np.diff(inside.view(np.int8), prepend=np.int8(0))
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        inside[ends] = True  # one separator stays behind each word, so that words lie side by side
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts + 1, out=offsets[1:])
        data = self.folded[raw[inside]]
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
        breaks = np.cumsum(kind == 2, dtype=np.int64)[starts]
        opens = np.ones(len(starts), bool)
        opens[1:] = (breaks[1:] != breaks[:-1]) | (text[1:] != text[:-1])
        return Cut(words.indices.to_numpy(), pc.binary_slice(words.dictionary, 0, -1), text, opens)


def totals(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct ``keys`` and the sum of each of ``values`` for them."""
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return (keys[first], *[np.add.reduceat(v[order], first) for v in values])


class Sums:
    """Partial sums of a task by key columns, handed on once there are many: map-side aggregation in bounded memory."""

    def __init__(self, keys: list[str], values: list[str], most: int = 500_000, chunk: int = 50_000) -> None:
        self.keys, self.values, self.most, self.chunk, self.parts, self.n = keys, values, most, chunk, [], 0

    def add(self, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        self.parts.append(rows)
        self.n += len(rows)
        if self.n > 2 * self.most:
            self._join()
            if self.n > self.most:
                yield from self.rest()

    def _join(self) -> None:
        rows = pa.concat_tables(self.parts).group_by(self.keys, use_threads=False).aggregate([(v, "sum") for v in self.values])
        rows = rows.rename_columns([c.removesuffix("_sum") for c in rows.column_names]).select([*self.keys, *self.values])
        self.parts, self.n = [rows], len(rows)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self._join()
            yield from self.parts[0].combine_chunks().to_batches(max_chunksize=self.chunk)
        self.parts, self.n = [], 0


def groups(batches: Iterator[pa.RecordBatch], keys: list[str], most: int | None = None) -> Iterator[tuple[tuple, pa.Table | pa.RecordBatch]]:
    """Rows of equal ``keys`` in a stream sorted by them, one group at a time as a table; a group of over ``most`` rows comes in record batches."""
    key, held, n = None, [], 0
    for batch in batches:
        if not len(batch):
            continue
        new = np.zeros(len(batch), bool)
        for k in keys:
            code = batch[k].dictionary_encode(null_encoding="encode").indices.to_numpy()
            new[1:] |= code[1:] != code[:-1]
        bounds = [0, *np.flatnonzero(new).tolist(), len(batch)]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            part = batch.slice(a, b - a)
            this = tuple(part[k][0].as_py() for k in keys)
            if this != key:
                if held:
                    yield key, pa.Table.from_batches(held)
                key, held, n = this, [], 0
            held.append(part)
            n += len(part)
            if most and n > most:
                yield from ((key, p) for p in held)
                held = []
    if held:
        yield key, pa.Table.from_batches(held)
