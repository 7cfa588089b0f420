"""A tokenizers-library pipeline rebuilt from a SentencePiece model file."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain
from typing import Any

import numpy as np
from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

MARK = "▁"
#: Fixed values of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def fields(data: bytes) -> Iterator[tuple[int, Any]]:
    """(number, value) of a protobuf message: int, float or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            yield key >> 3, data[at : at + size]
            at += size
        elif kind == 5:
            yield key >> 3, struct.unpack_from("<f", data, at)[0]
            at += 4
        elif kind == 1:
            yield key >> 3, struct.unpack_from("<d", data, at)[0]
            at += 8
        else:
            raise ValueError(f"wire type {kind}")


@dataclass
class PieceModel:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        model = cls()
        for number, value in fields(data):
            if number == 1:
                one = dict(fields(value))
                model.pieces.append((one.get(1, b"").decode(), one.get(2, 0.0), one.get(3, NORMAL)))
            elif number == 2:
                spec = dict(fields(value))
                model.kind, model.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
            elif number == 3:
                spec = dict(fields(value))
                model.charsmap = spec.get(2, b"")
                model.dummy_prefix, model.trim, model.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        return model

    def unknown(self) -> int:
        return next(k for k, (_, _, kind) in enumerate(self.pieces) if kind == UNKNOWN)

    def merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces that join to a piece, best score of the joined piece first."""
        ids = {p: k for k, (p, _, kind) in enumerate(self.pieces) if kind == NORMAL}
        found = []
        for whole, k in ids.items():
            for cut in range(1, len(whole)):
                left, right = whole[:cut], whole[cut:]
                if left in ids and right in ids:
                    found.append((-self.pieces[k][1], ids[left], ids[right], left, right))
        return [(left, right) for *_, left, right in sorted(found)]

    def splits(self) -> list[str]:
        """Alternatives of a pattern by which a normalised text falls into runs that are encoded each alone; none where pieces cross words."""
        # Pieces cross a word's start only where a marker follows another character; if none does, words are independent and can be cached.
        normal = [p for p, _, kind in self.pieces if kind == NORMAL]
        splits = [f"{MARK}+[^{MARK}]*"] if not any(MARK in p.lstrip(MARK) for p in normal) else []
        # Runs of markers have equal scores, so the library joins the leftmost first where the backend would take the lower id.
        # Up to the longest such piece both agree; longer runs are cut there from the left.  One marker at least stays with what follows.
        longest = max((len(p) for p in normal if p and not p.strip(MARK)), default=0)
        if self.kind == BPE and longest > 1:
            splits.insert(0, f"{MARK}{{{longest}}}(?={MARK})")
        return splits

    def words(self) -> re.Pattern | None:
        """A pattern whose matches in a text, marked as ``marked`` does, are what the backend encodes each alone; None where it takes the backend to find them."""
        plain = self.dummy_prefix and self.escape and not self.trim and not self.charsmap and not any(kind == USER_DEFINED for *_, kind in self.pieces)
        splits = self.splits()
        return re.compile("|".join(splits)) if plain and f"{MARK}+[^{MARK}]*" in splits else None

    def surfaces(self) -> list[bytes]:
        """The bytes that each piece decodes to among others."""
        byte = re.compile("<0x([0-9A-Fa-f]{2})>")
        return [bytes.fromhex(m[1]) if (m := byte.fullmatch(p)) else (p.replace(MARK, " ") if self.escape else p).encode() for p, _, _ in self.pieces]

    def tokenizer(self) -> Tokenizer:
        if self.kind == UNIGRAM:
            tok = Tokenizer(models.Unigram([(p, s) for p, s, _ in self.pieces], self.unknown(), self.byte_fallback))
        elif self.kind == BPE:
            vocab = {p: k for k, (p, _, _) in enumerate(self.pieces)}
            unknown = self.pieces[self.unknown()][0]
            tok = Tokenizer(models.BPE(vocab=vocab, merges=self.merges(), unk_token=unknown, fuse_unk=True, byte_fallback=self.byte_fallback))
        else:
            raise ValueError(f"model kind {self.kind} is neither unigram nor BPE")
        steps: list[Any] = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.trim:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARK if self.escape else " "))
        if self.escape:
            steps.append(normalizers.Replace(" ", MARK))
        tok.normalizer = normalizers.Sequence(steps)
        splits = self.splits()
        if splits:
            tok.pre_tokenizer = pre_tokenizers.Split(Regex("|".join(splits)), "isolated")
        # User-defined pieces are matched first, leftmost and longest, and never merged.
        own = [AddedToken(p, normalized=True, special=False) for p, _, kind in self.pieces if kind == USER_DEFINED]
        if own:
            tok.add_tokens(own)
        ends: list[Any] = [decoders.Replace(MARK, " ")] if self.escape else []
        ends += [decoders.ByteFallback(), decoders.Fuse()]
        if self.dummy_prefix:
            ends.append(decoders.Strip(" ", 1, 0))
        tok.decoder = decoders.Sequence(ends)
        return tok


#: Threads of the library in a process.  Its default, one for each of the machine's cores, spends its time in contention when several workers share them.
THREADS = 2


@lru_cache(maxsize=4)
def parsed(path: str) -> PieceModel:
    with open(path, "rb") as f:
        return PieceModel.parse(f.read())


@lru_cache(maxsize=4)
def load(path: str) -> Tokenizer:
    """The tokenizer of a model file, built once a process."""
    os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))  # read when the library's pool starts
    return parsed(path).tokenizer()


def marked(text: str) -> str:
    """``text`` as the backend normalises it for a model that has ``words``."""
    return (MARK + text).replace(" ", MARK) if text else ""


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of so many items from each start on, one span after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class WordIds(dict):
    """word -> its row in a table of token ids: the backend encodes a word once, as long as it stays in the table; a full one keeps the half met most often."""

    WORDS, IDS = 300_000, 3_000_000

    def __init__(self, path: str, pattern: re.Pattern) -> None:
        self.pattern, self.backend = pattern, Tokenizer(load(path).model)  # the same model, without normalising and splitting
        self.lengths = np.array([1 if kind == BYTE else 1 << 32 if kind == UNKNOWN else len(p.encode()) for p, _, kind in parsed(path).pieces])  # an unknown one has no length
        self.new: list[str] = []
        self.ids, self.starts, self.sizes, self.met = np.zeros(0, np.int32), *[np.zeros(0, np.int64) for _ in range(3)]

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = row = len(self)
        return row

    def encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``words``, and how many each has."""
        ids = np.array(self.backend.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids, np.int32)
        ends = np.cumsum(self.lengths[ids])
        last = np.searchsorted(ends, cuts := np.cumsum([len(w.encode()) for w in words]))
        if len(ends) and ends[-1] == cuts[-1] and (ends[last] == cuts).all():  # pieces spell the words
            return ids, np.diff(last, prepend=-1)
        each = [x.ids for x in self.backend.encode_batch_fast(words, add_special_tokens=False)]  # some are unknown
        return np.array([i for x in each for i in x], np.int32), np.array([len(x) for x in each], np.int64)

    def thin(self) -> None:
        kept = np.argsort(-self.met, kind="stable")[: self.WORDS // 2]
        kept = kept[np.cumsum(self.sizes[kept]) <= self.IDS // 2]
        words = list(self)
        self.clear()
        self.update(zip([words[k] for k in kept.tolist()], range(len(kept)), strict=True))
        sizes = self.sizes[kept]
        self.ids = self.ids[spans(self.starts[kept], sizes)]
        self.starts, self.sizes, self.met = np.cumsum(sizes) - sizes, sizes, self.met[kept] // 2

    def of(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids (int32) of each text."""
        if len(self) > self.WORDS or len(self.ids) > self.IDS:
            self.thin()
        found = [self.pattern.findall(marked(t)) for t in texts]
        n_words = np.cumsum([0, *map(len, found)])
        row = np.fromiter(map(self.__getitem__, chain.from_iterable(found)), np.int64, n_words[-1])
        if self.new:
            ids, sizes = self.encoded(self.new)
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
            self.met = np.concatenate([self.met, np.zeros(len(sizes), np.int64)])
            self.new = []
        self.met += np.bincount(row, minlength=len(self))
        sizes = self.sizes[row]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return np.split(self.ids[spans(self.starts[row], sizes)], upto[n_words[1:-1]])
