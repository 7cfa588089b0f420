"""Benchmark decontamination by template canonicalisation (DataFrame and SQL functions only).

Numbers, units after numbers, and names become typed placeholders, so a question asked again with other values
keeps its template.  The smallest template windows, pairs of tokens that are neighbours or have one token between them, at
all places of all documents are hash-joined with those of the items: an alignment along which half of an item agrees
has many such pairs in common, wherever its edits are.  Each item looks up its rarer pairs, as counted over all documents, as many as
leave ``VOTES`` on every such alignment.  Each alignment found is checked: all tokens of the
item are compared and the values of its slots too: one value of the item has to stand for one value in the document and the other way round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, join_groups
from .sharding import keyed

#: Distances of the two tokens of a pair.
GAPS = (1, 2)
#: So many agreeing tokens in a row, or so large a part of an item, count as holding it.
RUN, COVERAGE = 13, 0.5
#: Least tokens of an item.
SHORTEST = 4
#: Common pairs that make an alignment a candidate.
VOTES = 3
#: Bytes of a side that may be broadcast.
MAX_BROADCAST = 64 << 20
#: Units that make a slot after a number.
UNITS = "km m cm mm mi ft kg g mg lb oz t l ml s sec ms min h hr hour hours minute minutes second seconds day days week weeks month months year years percent eur usd dollars euros cents mph kmh w kw v a hz mb gb tb"
#: Thai, Lao, Myanmar, Khmer, kana and Han, written without spaces: each character is a token.  Ranges are matched faster than scripts.
UNSPACED = r"฀-໿က-႟ក-៿々-〇぀-ヿㇰ-ㇿ㐀-䶿一-鿿豈-﫿\x{20000}-\x{3FFFF}"
LETTERS = rf"(?:[\p{{L}}\p{{M}}&&[\x00-෿]]++|[\p{{L}}\p{{M}}&&[^\x00-෿{UNSPACED}]])++"
TOKEN = LETTERS + rf"|[0-9]+(?:[.,][0-9]+)*|[.!?:;\n%€$£]|[\p{{L}}&&[{UNSPACED}]]\p{{M}}*"
MARKS, SIGNS = (".", "!", "?", ":", ";", "\n", "%", "€", "$", "£"), ("%", "€", "$", "£")
NUMBER, UNIT, NAME = "#n", "#u", "#p"


def number(x: Column) -> Column:
    return (x >= "0") & (x < ":")


def canonical(raw: Column, x: Column, k: Column) -> Column:
    """Canonical form of token x at place k of ``raw``; empty for punctuation.  Common cases come first."""
    before = F.get(raw, k - 1)
    units = F.array(*[F.lit(u) for u in UNITS.split()])
    plain = (x >= "a") & (F.lower(x) == x) & ~x.isin("€", "£") & ~F.coalesce(number(before), F.lit(False))
    unit = number(before) & (x.isin(*SIGNS) | F.array_contains(units, F.lower(x)))
    name = (k > 0) & ~before.isin(*MARKS) & x.rlike(r"^\p{Lu}\p{Ll}+$")
    return F.when(plain, x).when(number(x), NUMBER).when(unit, UNIT).when(x.isin(*MARKS), "").when(name, NAME).otherwise(F.lower(x))


def with_templates(df: DataFrame, written: bool = False) -> DataFrame:
    """``df`` with ``c``, the canonical tokens of its text, in place of the text; also ``w``, the tokens as written, if asked for.

    Steps are columns of their own that the next one reads more than once, so Spark evaluates each once a row.
    """
    raw = F.col("_raw")
    rest = [x for x in df.columns if x != "text"]
    out = df.select(*rest, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(TOKEN), F.lit(0)).alias("_raw"))
    out = out.select(*rest, "_raw", F.transform(raw, lambda x, k: canonical(raw, x, k)).alias("_c"))
    more = [F.filter(F.transform(raw, lambda x, k: F.when(F.get("_c", k) != "", F.lower(x))), lambda x: x.isNotNull()).alias("w")] * written
    return out.select(*rest, F.filter("_c", lambda x: x != "").alias("c"), *more)


def with_forms(items: DataFrame) -> DataFrame:
    """``items`` (item_id, text) as no, item_id, n (tokens), forms, w; an item that begins with a capitalised word has two forms, with that word as it stands and as a name.

    Where a sentence begins such a word says nothing, and within a document's sentence it reads as a name.
    """
    word = F.regexp_extract("text", r"[\p{L}\p{M}]+", 0)
    out = with_templates(items.select("item_id", "text", F.when(word.rlike(r"^\p{Lu}\p{Ll}+$"), F.lower(word)).alias("begin")), written=True)
    named = F.when(F.get("c", F.lit(0)) == F.col("begin"), F.concat(F.array(F.lit(NAME)), F.slice("c", 2, F.greatest(F.size("c"), F.lit(1)))))
    forms = F.filter(F.array(F.col("c"), named), lambda c: c.isNotNull())
    return out.select(F.monotonically_increasing_id().alias("no"), "item_id", F.size("c").alias("n"), forms.alias("forms"), "w")


def small(df: DataFrame, width: Column) -> DataFrame:
    """``df``, marked for broadcast if its rows, ``width`` bytes each, are within the bound; otherwise Spark joins it by a shuffle."""
    return F.broadcast(df) if (df.agg(F.sum(width)).first()[0] or 0) <= MAX_BROADCAST else df


def pairs(df: DataFrame, tokens: str) -> DataFrame:
    """``df`` with ``at`` (from 1) and ``h`` for each pair of ``tokens``, in their place; a pair that reaches over the end has a hash of its own."""
    rest = [x for x in df.columns if x != tokens]
    # Hashes once, then rows one by one in generated code.  No filter here: Spark would compute the steps of the tokens within each other for it.
    out = df.select(*rest, F.transform(tokens, lambda t: F.xxhash64(t)).alias("_t"))
    places = F.when(F.size("_t") > 1, F.sequence(F.lit(1), F.size("_t") - 1)).otherwise(F.array().cast("array<int>"))
    out = out.select(*rest, "_t", F.explode(places).alias("at"))
    out = out.select(*rest, "_t", "at", F.explode(F.array(*map(F.lit, GAPS))).alias("gap"))
    second = F.get("_t", F.col("at") - 1 + F.col("gap"))
    return out.select(*rest, "at", "gap", F.xxhash64(F.get("_t", F.col("at") - 1), F.coalesce(second, F.lit(0)), "gap").alias("h"))


def least(n: Column, coverage: float) -> Column:
    """The least number of tokens that have to agree of an item of n."""
    return F.greatest(F.lit(SHORTEST), F.ceil(n * coverage - 1e-9).cast("int"))


def sure(n: Column, coverage: float) -> Column:
    """Pairs in common along every alignment that holds an item of n tokens.

    m tokens that agree have m - 1 distances, n - 1 in all; if k of them are 1 or 2, the others are 3 at least: k + 3 (m - 1 - k) <= n - 1.
    A run of RUN has a pair at each of its tokens but the last for either distance, less one.
    """
    k = F.greatest(F.lit(1), F.ceil((3 * least(n, coverage) - n - 2) / 2).cast("int"))
    return F.when(n > 2 * RUN, F.least(k, F.lit(2 * RUN - 3))).otherwise(k)


def hits(docs: DataFrame, items: DataFrame, coverage: float, scratch: Scratch) -> DataFrame:
    """key, no, n, shift: alignments (document place minus item place) with ``VOTES`` common pairs among the rarer ones of the item, or all that it is sure to have."""
    forms = items.select("no", "n", F.explode("forms").alias("c"))
    known = pairs(forms, "c").where(F.col("at") + F.col("gap") <= F.col("n")).select("no", "n", F.col("at").alias("item_at"), "h").distinct()
    known = scratch.keep(known, "known")
    wanted = known.select("h").distinct()
    found = pairs(with_templates(docs.select("key", "text")), "c").select("key", "at", "h").join(small(wanted, F.lit(32)), "h", "left_semi")
    found = scratch.keep(found, "pairs")
    often = scratch.keep(found.groupBy("h").agg(F.count("*").alias("often")), "often")
    # an item looks up all its pairs but the most frequent ones, of which it can spare what it is sure to have beyond the votes
    rank = F.row_number().over(Window.partitionBy("no").orderBy(F.desc("often"), "item_at", "h"))
    votes = F.least(F.lit(VOTES), sure(F.col("n"), coverage))
    asked = known.join(often, "h").withColumns({"rank": rank, "votes": votes}).where(F.col("rank") > sure(F.col("n"), coverage) - F.col("votes")).drop("rank")
    asked = scratch.keep(asked, "asked")
    if (asked.count() * 64) <= MAX_BROADCAST:
        met = found.join(F.broadcast(asked.drop("often")), "h")
    else:
        lists = asked.groupBy("h").agg(F.first("often").alias("often"), F.collect_list(F.struct("no", "n", "item_at", "votes")).alias("at_items"))
        met = join_groups(found, lists, ["h"], "often", found.count(), "key").select("key", "at", F.explode("at_items").alias("i")).select("key", "at", "i.*")
    counted = met.groupBy("key", "no", "n", "votes", (F.col("at") - F.col("item_at")).alias("shift")).agg(F.count("*").alias("found"))
    return counted.where("found >= votes").select("key", "no", "n", "shift")


def held(docs: DataFrame, benchmark: DataFrame, coverage: float, scratch: Scratch) -> DataFrame:
    """key, doc_id, item_id and the figures of ``contaminated`` for every alignment that holds an item; ``docs``: key, doc_id, text."""
    if coverage < COVERAGE:
        raise ValueError(f"pairs are sure to be found for a coverage of at least {COVERAGE}")
    items = scratch.keep(with_forms(benchmark.select("item_id", "text")), "items").where(F.col("n") >= SHORTEST)
    found = scratch.keep(hits(docs, items, coverage, scratch), "hits")
    scratch.drop("pairs", "often", "known", "asked")
    per_doc = scratch.keep(found.groupBy("key").agg(F.collect_list(F.struct("no", "n", "shift")).alias("places")), "places")
    per_doc = small(per_doc, 32 + 24 * F.size("places"))
    d = docs.join(per_doc, "key").select("key", "doc_id", "text", "places")
    d = with_templates(d, written=True)
    # of each document only what stands along the item, with nulls where it sticks out
    skip = lambda p: F.greatest(-p["shift"], F.lit(0))
    cut = lambda name, p: F.concat(F.array_repeat(F.lit(None).cast("string"), skip(p)), F.slice(name, F.greatest(p["shift"], F.lit(0)) + 1, F.greatest(p["n"] - skip(p), F.lit(0))))
    along = F.transform("places", lambda p: F.struct(p["no"].alias("no"), p["shift"].alias("shift"), cut("c", p).alias("dc"), cut("w", p).alias("dw")))
    d = d.select("key", "doc_id", F.explode(along).alias("p")).select("key", "doc_id", "p.*")
    each = items.select("no", "item_id", F.explode("forms").alias("c"), "w")
    both = d.join(small(each, 64 + 2 * (F.octet_length(F.array_join("w", "")) + 32 * F.size("w"))), "no")
    compared = F.transform("c", lambda t, j: F.struct(
        F.coalesce(t == F.get("dc", j), F.lit(False)).alias("same"), t.startswith("#").alias("slot"), F.get("w", j).alias("a"), F.get("dw", j).alias("b")))
    both = both.select("key", "doc_id", "item_id", "shift", compared.alias("x"))
    slots = F.filter("x", lambda p: p["slot"] & p["same"])
    both = both.withColumn("slots", F.transform(slots, lambda p: F.struct(p["a"].alias("a"), p["b"].alias("b"))))
    one_to_one = (F.size(F.array_distinct("slots")) == F.size(F.array_distinct("slots.a"))) & (F.size(F.array_distinct("slots")) == F.size(F.array_distinct("slots.b")))
    agree = F.transform("x", lambda p: p["same"] & (~p["slot"] | F.col("fits")))
    run = F.aggregate("agree", F.struct(F.lit(0).alias("now"), F.lit(0).alias("best")), lambda s, x: F.struct(
        F.when(x, s["now"] + 1).otherwise(0).alias("now"), F.greatest(s["best"], F.when(x, s["now"] + 1).otherwise(0)).alias("best")), lambda s: s["best"])
    judged = both.withColumn("fits", one_to_one).withColumn("agree", agree).select(
        "key", "doc_id", "item_id", "shift", F.size("x").alias("n_tokens"), F.size(F.filter("agree", lambda a: a)).alias("n_matched"), run.alias("longest_run"),
        F.exists("x", lambda p: p["same"] & p["slot"] & F.col("fits") & (p["a"] != p["b"])).alias("reparameterised"))
    judged = scratch.keep(judged.withColumn("coverage", F.col("n_matched") / F.col("n_tokens")), "judged")
    return judged.where((F.col("n_matched") >= least(F.col("n_tokens"), coverage)) | (F.col("longest_run") >= RUN))


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, item_id, n_tokens, n_matched, longest_run, coverage, reparameterised: items that a document holds.

    An item counts as held when, along one alignment, at least ``coverage`` of its tokens (and ``SHORTEST``) agree or a run of ``RUN`` does;
    placeholders agree only if the item's slot values map one to one to the document's.  ``reparameterised``:
    some value differs.  Per document and item the alignment with most agreeing tokens, then the least shift is
    reported.  Null and empty texts hold nothing; items of fewer than ``SHORTEST`` tokens are too
    common to tell and never reported; of rows that repeat an id the best alignment is reported; other columns are ignored;
    an empty table on either side gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    judged = held(keyed(docs, scratch), benchmark, coverage, scratch)
    best = judged.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("n_tokens", "n_matched", "longest_run", "coverage", "reparameterised"), F.struct("n_matched", -F.col("shift"), "longest_run")).alias("b"))
    return best.select("doc_id", "item_id", "b.*")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go.

    Rows are judged each by itself, so a clean row stays though another one of its doc_id, or another one without a doc_id, goes.  Null and empty
    texts stay; extra columns and columns named like those used inside come through; an empty table stays empty.
    """
    scratch = Scratch(spark, "decontaminate-stage")
    rows = keyed(docs, scratch, whole=True)
    bad = scratch.keep(held(rows.select("key", "doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), COVERAGE, scratch).select("key").distinct(), "bad")
    return rows.join(small(bad, F.lit(32)), "key", "left_anti").select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
