"""Main-text extraction by a linear-chain conditional random field over the leaf blocks of pages."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, tidy
from .sample_pages import Page

#: Elements whose text is code; the parser skips to their end tag, or to the end of the page.
RAW = ("script", "style")
#: Other elements whose text is never part of a page's blocks.  They end with their own end tag or that of an element around them.
SILENT = frozenset("noscript template head title svg iframe textarea select canvas audio video annotation annotation-xml".split())
#: What may stand in a head, which any other element ends, as it does without its end tag.
HEAD = frozenset("title base link meta noscript template".split())
#: Elements that end a drawing left open.
BREAKOUT = frozenset("address article aside blockquote body center dd div dl dt footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table ul".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meter nobr output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr object"
    " math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What a start tag ends if open: itself a paragraph, or an item of its own list or table.
PARAGRAPH = frozenset(["p"])
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements that an implied end doesn't reach over.
SCOPE = frozenset("ul ol dl table article section div main aside nav header footer form body".split())
TAG = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
#: Attributes up to the end of a tag, of a usual one and of one of code, in which a quoted value may hold any sign.
ATTRS = re.compile(r"(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+")
CODE_ATTRS = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+")
COMMENT_END = re.compile(r"--!?>")
CODE_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
#: Open elements from either end whose features a block gets.
NEAREST = 64
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PARTS = re.compile(r"[a-z0-9]+")
PAGES, STEPS, RATE, RIDGE = 900, 300, 0.1, 1e-5


def markup(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, lower-case tag or nothing, whether it is an end tag, attributes) of each piece of markup, in time linear in the page.

    Comments and the text of scripts and styles are part of their piece, up to the page's end if nothing else ends them.  A < that no > follows is text.  Where quotes of a tag
    don't pair up before the tag ends, it ends at its first >; after vain searches over several times the page's length, quotes aren't looked at any more.
    """
    at, budget = 0, 4 * len(page)
    last = page.rfind(">")  # beyond it there are no tags
    while (start := page.find("<", at)) >= 0:
        at = start + 1
        if page.startswith("<!--", start):
            found = COMMENT_END.search(page, start + 4)
            at = found.end() if found else len(page)
            yield start, at, "", False, ""
            continue
        name = TAG.match(page, start)
        if start > last or not (name or page[at : at + 1] in ("!", "?", "/")):
            continue
        if not name:
            at = page.index(">", start) + 1
            yield start, at, "", False, ""
            continue
        tag, closing = name[1].lower(), page[at] == "/"
        code = CODE_END.get(tag) if not closing and page[name.end() : name.end() + 1] not in ("", *"abcdefghijklmnopqrstuvwxyz") else None
        end = name.end()
        if budget > 0:
            end = (CODE_ATTRS if code else ATTRS).match(page, end).end()
        usual = page[end : end + 1] == ">"
        if not usual:
            budget -= end - start
            end = page.index(">", start)
        at = end + 1
        if code:
            found = code.search(page, at)
            at = found.end() if found else len(page)
            yield start, at, "", False, ""
        else:
            yield start, at, tag if usual else "", closing, page[name.end() : end]


@dataclass
class Block:
    above: tuple[str, ...]  # features of the elements around it, outermost first
    text: str
    linked: int  # characters inside links


def names(attrs: str) -> list[str]:
    out = []
    for found in NAMED.finditer(attrs):
        value = (found[1] or found[2] or found[3] or "").lower()
        out += ["c:" + x for x in value.split()] + ["n:" + x for x in PARTS.findall(value)]
    return out


class Open:
    """The open block elements, innermost last, with what each scope holds; every question costs a constant."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, tuple[str, ...]]] = []
        self.tags: Counter[str] = Counter()
        self.scopes: list[Counter[str]] = [Counter()]  # of the elements since a scope began, itself included

    def push(self, tag: str, features: tuple[str, ...]) -> None:
        self.stack.append((tag, features))
        self.tags[tag] += 1
        if tag in SCOPE:
            self.scopes.append(Counter())
        self.scopes[-1][tag] += 1

    def close(self, tags: frozenset[str] | set[str]) -> None:
        """End the innermost element of ``tags`` and all in it."""
        while True:
            tag = self.stack.pop()[0]
            self.tags[tag] -= 1
            self.scopes[-1][tag] -= 1
            if tag in SCOPE:
                self.scopes.pop()
            if tag in tags:
                return

    def above(self) -> tuple[str, ...]:
        """Features of the outermost and the innermost ``NEAREST`` elements; pages nest deeper only in error."""
        near = self.stack if len(self.stack) <= 2 * NEAREST else [*self.stack[:NEAREST], *self.stack[-NEAREST:]]
        return tuple(x for _, features in near for x in features)


class Silent:
    """A silent element and what is open inside it."""

    def __init__(self) -> None:
        self.stack: list[str] = []
        self.tags: Counter[str] = Counter()

    def push(self, tag: str) -> None:
        self.stack.append(tag)
        self.tags[tag] += 1

    def close(self, tag: str) -> None:
        while self.stack:
            last = self.stack.pop()
            self.tags[last] -= 1
            if last == tag:
                return

    def clear(self) -> None:
        self.stack.clear()
        self.tags.clear()

    def ended_by(self, tag: str) -> bool:
        """Whether the start of ``tag`` ends it."""
        first = self.stack[0]
        return (
            (tag == "body" and first in ("head", "title"))
            or (first == "head" and len(self.stack) == 1 and tag not in HEAD)
            or (first == "svg" and tag in BREAKOUT and not self.tags["foreignobject"])
        )


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks in page order: texts between the starts and ends of block elements, references decoded, white space folded; in time linear in the page."""
    page = page or ""
    out: list[Block] = []
    elements, silent = Open(), Silent()
    above: tuple[str, ...] | None = ()  # not known until a text needs it
    parts: list[str] = []
    inline: Counter[str] = Counter()  # open inline elements
    linked = link = at = 0

    def flush() -> None:
        nonlocal linked, above
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                if above is None:
                    above = elements.above()
                out.append(Block(above, text, linked))
            linked = 0

    def read(text: str) -> None:
        nonlocal linked
        if silent.stack == ["head"] and text.strip():
            silent.clear()
        if text and not silent.stack:
            parts.append(text)
            if link:
                linked += len(text)

    for start, end, tag, closing, attrs in markup(page):
        read(page[at:start])
        at = end
        if not tag:
            continue
        empty = tag in VOID or attrs.endswith("/")
        if silent.stack and not closing:
            if silent.ended_by(tag):
                silent.clear()
            else:
                if not empty:
                    silent.push(tag)
                continue
        if silent.stack:
            if silent.tags[tag]:
                silent.close(tag)
                continue
            if not (inline[tag] if tag in INLINE else elements.tags[tag]):
                continue
            silent.clear()
        if tag in SILENT:
            if not closing and not empty:
                silent.push(tag)
            continue
        if tag in INLINE:
            if not empty:
                inline[tag] = max(0, inline[tag] + (-1 if closing else 1))
            if tag == "a":
                link = 0 if closing else 1
            elif tag == "br":
                parts.append(" ")
            continue
        flush()
        if closing:
            if elements.tags[tag]:
                elements.close({tag})
        else:
            closes = ENDS.get(tag, PARAGRAPH)
            if any(elements.scopes[-1][x] for x in closes):
                elements.close(closes)
            if tag not in VOID:
                elements.push(tag, ("t:" + tag, *(names(attrs) if attrs and "=" in attrs else ())))
        above = None
        link = 0
    read(page[at:])
    flush()
    return out


def text_features(block: Block, k: int, n: int) -> list[str]:
    words = block.text.count(" ") + 1
    size = len(block.text)
    density = block.linked / max(size, 1)
    return [
        "bias", f"words:{min(words.bit_length(), 7)}", "link:" + ("all" if density > 0.7 else "some" if density > 0.2 else "none"),
        "stop" if block.text[-1] in ".!?" else "open", *(["first"] if k == 0 else []), *(["last"] if k == n - 1 else []), *(["sign"] if "©" in block.text else []),
    ]


@dataclass
class Field:
    """Weights of the features for being article, of the transitions and of the two ends."""

    weights: dict[str, float]
    moves: np.ndarray
    start: np.ndarray
    known: dict[tuple[str, ...], float] = field(default_factory=dict)

    def around(self, above: tuple[str, ...], main: bool) -> float:
        if len(self.known) > 20_000:
            self.known.clear()
        key = (*above, main)
        if key not in self.known:
            self.known[key] = sum(self.weights.get(f, 0.0) for f in context(above, main))
        return self.known[key]

    def decode(self, page: list[Block]) -> list[bool]:
        """The most likely labelling (Viterbi)."""
        if not page:
            return []
        get, main = self.weights.get, has_main(page)
        (oo, ok), (ko, kk) = self.moves.tolist()
        back: list[tuple[bool, bool]] = []
        out, keep = self.start.tolist()
        n = len(page)
        for k, block in enumerate(page):
            score = self.around(block.above, main) + sum(get(f, 0.0) for f in text_features(block, k, n))
            if k:
                a, b, c, d = out + oo, keep + ko, out + ok, keep + kk
                back.append((b > a, d > c))
                out, keep = max(a, b), max(c, d)
            keep += score
        labels = [keep > out]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def has_main(page: list[Block]) -> bool:
    return any("t:article" in b.above or "t:main" in b.above for b in page)


def context(above: tuple[str, ...], main: bool) -> set[str]:
    """Features of the ancestors: tags, names, the innermost tag, and whether the block is inside the page's main element if there is one."""
    tags = [x for x in above if x.startswith("t:")]
    inside = "t:article" in above or "t:main" in above
    return {*above, "own:" + (tags[-1] if tags else ""), "main:" + ("in" if inside else "out" if main else "none")}


def train(pages: list[tuple[str, list[bool]]]) -> Field:
    """Maximum likelihood with a ridge by Adam; marginals by the forward-backward recursion over all pages at once."""
    ids: dict[str, int] = {}
    rows, cols, labels, lengths = [], [], [], []
    n = 0
    for source, kept in pages:
        page = blocks(source)
        if len(page) != len(kept):
            raise ValueError("labels don't match the blocks of a page")
        main = has_main(page)
        for k, block in enumerate(page):
            for f in {*context(block.above, main), *text_features(block, k, len(page))}:
                rows.append(n)
                cols.append(ids.setdefault(f, len(ids)))
            n += 1
        labels += kept
        lengths.append(len(page))
    row, col, y = np.array(rows), np.array(cols), np.array(labels, int)
    lengths = np.array(lengths)
    page_of = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    width = int(lengths.max())
    there = np.zeros((len(lengths), width), bool)
    there[page_of, place] = True
    truth = np.zeros((len(lengths), width), int)
    truth[page_of, place] = y
    both = there[:, 1:]
    counts = np.array([[(both & (truth[:, :-1] == a) & (truth[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)], float)
    begins = np.bincount(truth[:, 0], minlength=2).astype(float)
    w = [np.zeros(len(ids)), np.zeros((2, 2)), np.zeros(2)]
    m, v = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    for step in range(1, STEPS + 1):
        score = np.zeros((len(lengths), width, 2))
        score[page_of, place, 1] = np.bincount(row, weights=w[0][col], minlength=n)
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = score[:, 0] + w[2]
        for k in range(1, width):
            now = np.logaddexp(forward[:, k - 1, 0, None] + w[1][0], forward[:, k - 1, 1, None] + w[1][1]) + score[:, k]
            forward[:, k] = np.where(there[:, k, None], now, forward[:, k - 1])
        for k in range(width - 2, -1, -1):
            ahead = score[:, k + 1] + backward[:, k + 1]
            now = np.logaddexp(w[1][:, 0] + ahead[:, 0, None], w[1][:, 1] + ahead[:, 1, None])
            backward[:, k] = np.where(there[:, k + 1, None], now, 0)
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        keep = np.exp(forward[:, :, 1] + backward[:, :, 1] - total[:, None])[page_of, place]
        pairs = np.zeros((2, 2))
        for a in (0, 1):
            for b in (0, 1):
                p = forward[:, :-1, a] + w[1][a, b] + score[:, 1:, b] + backward[:, 1:, b] - total[:, None]
                pairs[a, b] = np.exp(p[both]).sum()
        first = np.exp(forward[:, 0] + backward[:, 0] - total[:, None]).sum(axis=0)
        grads = [np.bincount(col, weights=(y - keep)[row], minlength=len(ids)) / n - RIDGE * w[0], (counts - pairs) / n - RIDGE * w[1], (begins - first) / n - RIDGE * w[2]]
        for k, g in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] = w[k] + RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Field({f: float(w[0][k]) for f, k in ids.items()}, w[1], w[2])


@lru_cache(maxsize=1)
def default_model() -> Field:
    """Trained on ``PAGES`` labelled pages, a fixed number."""
    return train([Page(seed).build() for seed in range(PAGES)])


def main_text(model: Field, page: str | None) -> tuple[str, int, int]:
    """The article's blocks joined by line ends, the number of blocks, and how many were kept."""
    found = blocks(page)
    kept = [b.text for b, keep in zip(found, model.decode(found), strict=True) if keep]
    return "\n".join(kept), len(found), len(kept)


def extract(pages: DataFrame, model: Field | None = None) -> DataFrame:
    """page_id, url, text, n_chars, n_blocks, n_kept for every row of ``pages``.

    The whole html is read; null, empty and text-free html gives an empty text.  Null ids and urls and repeated rows
    come through as they are; other columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(text, len(text), blocks, kept) for text, blocks, kept in (main_text(shared.value, x) for x in batch["html"].to_pylist())]
            columns = [pa.array([x[k] for x in found], pa.int64() if k else pa.string()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], *columns], names=["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"])

    read = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return read.mapInArrow(tidy(run), "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
