"""Benchmark items inside documents, by size-partitioned MinHash containment search.

A sketch of a long document says little about a short passage in it, so sketches are of
the items: the shingles that the fewest items hold, and of these the ones with the least hashes. So
a preface that many items share leads to none of them. Items are partitioned by size, and for each
size band the sketch is long enough that a document with the wanted share of an item must hold
at least HITS shingles of its sketch: it can miss no more than the rest. So the search
compares documents with a small index and loses nothing; what it finds is verified by
counting the item's shingles in the document, as texts and not as hashes.

Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import digests, filled, kept

HITS = 4
BROADCAST_ROWS = 500_000  # an index of up to so many rows, 32 bytes each, goes to all executors; a larger one is joined by shuffle


def words_of(text: Column) -> Column:
    """The letter and digit runs of a text in small letters; an empty array if it has none."""
    spaced = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def _windows(words: Column, width: Column, make) -> Column:
    """``make`` of each window of ``width`` words."""
    last = F.size(words) - width
    some = F.transform(F.sequence(F.lit(0), last), lambda i: make(F.slice(words, i + 1, width)))
    none = F.array().cast("array<bigint>" if make is _hash else "array<string>")
    return F.when((width > 0) & (last >= 0), some).otherwise(none)


def _hash(window: Column) -> Column:
    return F.xxhash64(window)


def _tagged(hashes: Column, width: int) -> Column:
    return F.transform(hashes, lambda h: F.struct(F.lit(width).alias("width"), h.alias("h")))


def _plain(window: Column) -> Column:
    return F.array_join(window, " ")


def _items(benchmark: DataFrame, words: int, percent: int, text: str, item_id: str) -> DataFrame:
    """Items with words: id, name of their text (key), width of their shingles, the distinct shingles, and what they must share."""
    split = benchmark.select(F.col(item_id).alias("item"), words_of(filled(text)).alias("words"))
    split = split.withColumn("width", F.least(F.lit(words), F.size("words"))).where("width > 0")
    items = split.withColumn("shingles", F.array_distinct(_windows(F.col("words"), F.col("width"), _plain)))
    items = items.withColumn("n", F.size("shingles").cast("long"))
    items = items.withColumn("shingles", F.array_sort("shingles"))
    key = F.struct(F.xxhash64("width", "shingles"), F.xxhash64(F.lit("second"), "width", "shingles")).alias("key")
    # Repeated rows of one item are one item; different texts under one id, and items without one, are told apart by their shingles.
    return items.select("item", key, "width", "shingles", "n").distinct().withColumn("need", -F.floor(-F.col("n") * percent / 100))


def _sketches(items: DataFrame) -> DataFrame:
    """Per item the shingles (h) that the fewest items hold, those of least hash first, and how many of them a match must hold."""
    top = F.pow(2.0, F.ceil(F.log2(F.col("n").cast("double")))).cast("long")  # the largest size of the item's band
    length = F.least(F.col("n"), F.floor(top * (1 - F.col("need") / F.col("n"))) + HITS)
    hashed = F.transform("shingles", lambda s: F.xxhash64(F.split(s, " ")))
    each = items.select("key", "n", "need", "width", length.cast("int").alias("length"), F.explode(F.array_distinct(hashed)).alias("h"))
    held = each.groupBy("width", "h").agg(F.count("*").alias("items"))
    ranked = each.join(held, ["width", "h"]).groupBy("key", "n", "need", "width", "length")
    sketch = ranked.agg(F.sort_array(F.collect_list(F.struct("items", "h"))).alias("rarest")).withColumn("rarest", F.slice("rarest", F.lit(1), F.col("length")))
    hits = F.least(F.lit(HITS), F.size("rarest") - (F.col("n") - F.col("need")))
    return sketch.select("key", "n", "width", F.greatest(hits, F.lit(1)).alias("hits"), F.explode("rarest.h").alias("h"))


def matches(docs: DataFrame, benchmark: DataFrame, words: int = 5, percent: int = 80, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Texts that hold at least ``percent`` of the distinct shingles of an item: __t1, __t2 (name of the text), item, n, shared."""
    items = kept(_items(benchmark, words, percent, text, item_id), "items")
    named = items.drop("item").dropDuplicates(["key"])  # search and verification name items by their text, as ids may be null
    sketches = kept(_sketches(named), "item-sketches")
    small = sketches.count() <= BROADCAST_ROWS
    index = F.broadcast(sketches) if small else sketches
    widths = sorted(r.width for r in items.select("width").distinct().collect()) or [words]  # at most ``words`` of them

    one, two = digests(filled(text))
    texts = docs.select(filled(text).alias("text"), one.alias("t1"), two.alias("t2"))
    split = texts.select("t1", "t2", words_of(F.col("text")).alias("words"))
    grams = [_tagged(_windows(F.col("words"), F.lit(width), _hash), width) for width in widths]
    each = split.select("t1", "t2", F.explode(F.concat(*grams)).alias("g")).select("t1", "t2", F.col("g.width").alias("width"), F.col("g.h").alias("h"))
    found = each.join(index, ["width", "h"]).select("t1", "t2", "key", "n", "hits", "h")
    searched = found.groupBy("t1", "t2", "key", "n", "hits").agg(F.size(F.collect_set("h")).alias("got")).where("got >= hits")
    searched = kept(searched.groupBy("t1", "t2").agg(F.collect_set("key").alias("candidates")), "leak-candidates")

    # One text of each candidate is enough; equal ones give equal rows.
    suspects = texts.join(searched, ["t1", "t2"]).select("t1", "t2", F.explode("candidates").alias("key"), words_of(F.col("text")).alias("words"))
    pairs = suspects.join(named, "key")
    grams = pairs.withColumn("own", _windows(F.col("words"), F.col("width"), _plain))
    counted = grams.withColumn("shared", F.size(F.array_intersect("shingles", "own")).cast("long")).where("shared >= need")
    shared = counted.select(F.col("t1").alias("__t1"), F.col("t2").alias("__t2"), "key", "n", "shared").distinct()
    return shared.join(items.select("key", "item"), "key").drop("key")


def leaks(docs: DataFrame, benchmark: DataFrame, words: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """A row per document and item it holds: both ids, n_shingles of the item and n_shared.

    Words are runs of letters and digits, case aside. An item of fewer words than a shingle is one
    shingle of them all; an item or document without words, or a null text, matches nothing. An item without an
    id is matched as any other and listed with a null. Repeated
    documents are listed once per row; repeated items once. Empty tables give an empty one.
    """
    one, two = digests(filled(text))
    named = docs.select(F.col(doc_id).alias("__id"), one.alias("__t1"), two.alias("__t2"))
    found = named.join(kept(matches(docs, benchmark, words, percent, text, item_id), "leaks"), ["__t1", "__t2"])
    return found.select(F.col("__id").alias(doc_id), F.col("item").alias(item_id), F.col("n").alias("n_shingles"), F.col("shared").alias("n_shared"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, words: int = 5, percent: int = 80, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they were.

    Columns may have any name but those that begin with two underscores.
    """
    one, two = digests(filled(text))
    found = kept(matches(docs, benchmark, words, percent, text, item_id).select("__t1", "__t2").distinct(), "leaks")
    named = docs.withColumns({"__t1": one, "__t2": two})
    return named.join(found, ["__t1", "__t2"], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(docs, benchmark)
