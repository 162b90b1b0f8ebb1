"""Ranked lexical search: a K2-treap over the term-document grid of every shard of documents.

A *shard* is some thousands of documents in one row of an index table: their ids and lengths, the terms with their
numbers of documents, and the cells (term, document, frequency). Searching turns the cells of a shard into a
compressed quadtree: a node per square of the grid that holds a cell, numbered level by level from the root, so that
four bits and the number of its first child lead to the rest, each with the greatest impact in its square. The rows
of an item's terms go down together over ranges of documents: a range has one node per term, the sum of
their impacts times the terms' weights bounds every score in it, and the ranges with the greatest bounds
are halved first, until no bound reaches the least score that is still wanted.

Shards are made where the documents are read and never shuffled. A task hands on its best documents per item alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import bounded, kept

# Terms are runs of ASCII letters and digits and of all that is not ASCII, A-Z lower-cased; the weight's factor, and
# numerators and length shares of the impact.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
WEIGHT = 1000
IMPACT = 1_000_000_000
FREQUENCY_SCALE = 1000
LENGTH_SCALE = 8
LENGTH_SHARE = 90

TOP = 10
#: A shard is closed at so many documents or cells; a document is never split.
SHARD_DOCS = 4096
SHARD_CELLS = 1_000_000
#: Cells whose impacts are worked out at once.
CELLS_AT_ONCE = 1 << 18
#: Items of one row of the query table, on average, and ranges that are halved at once.
BLOCK_ITEMS = 256
RANGES = 64

SHARD = "docs array<bigint>, lengths array<bigint>, terms array<binary>, df array<int>, cells binary"
FOUND = "item bigint, item_id bigint, doc_id bigint, score bigint"

#: How many of a node's children come before a quadrant, by the node's four bits.
BEFORE = np.array([[bin(bits & ((1 << q) - 1)).count("1") for q in range(4)] for bits in range(16)], np.int32)


def terms_of(text: bytes) -> list[bytes]:
    return TERM.findall(text.lower())


def _binary(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_binary()) if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column


class _Shard:
    """Documents gathered for one row of the index."""

    def __init__(self) -> None:
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        self.numbers: dict[bytes, int] = {}
        self.rows: list[np.ndarray] = []
        self.frequencies: list[np.ndarray] = []
        self.cells = 0

    def add(self, doc: int | None, terms: list[bytes]) -> None:
        counts = Counter(terms)
        numbers = self.numbers
        self.rows.append(np.fromiter((numbers.setdefault(t, len(numbers)) for t in counts), np.int32, len(counts)))
        self.frequencies.append(np.fromiter(counts.values(), np.int32, len(counts)))
        self.docs.append(doc)
        self.lengths.append(len(terms))
        self.cells += len(counts)

    def full(self) -> bool:
        return len(self.docs) >= SHARD_DOCS or self.cells >= SHARD_CELLS

    def row(self) -> pa.RecordBatch:
        """Documents by id, terms from the most frequent on, cells by term and document."""
        order = sorted(range(len(self.docs)), key=lambda i: (self.docs[i] is not None, self.docs[i] or 0))
        rows = np.concatenate([self.rows[i] for i in order])
        frequencies = np.concatenate([self.frequencies[i] for i in order])
        columns = np.repeat(np.arange(len(order), dtype=np.int32), [len(self.rows[i]) for i in order])
        df = np.bincount(rows, minlength=len(self.numbers))
        by_df = np.argsort(-df, kind="stable")
        place = np.empty_like(by_df)
        place[by_df] = np.arange(len(by_df))
        cells = np.argsort(place[rows], kind="stable")
        terms = list(self.numbers)
        packed = zstandard.compress(np.stack([columns[cells], frequencies[cells]]).astype("<i4").tobytes(), 1)
        values = [[[self.docs[i] for i in order]], [[self.lengths[i] for i in order]], [[terms[i] for i in by_df]], [df[by_df].tolist()], [packed]]
        kinds = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["docs", "lengths", "terms", "df", "cells"])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard = _Shard()
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), _binary(batch.column(1)).to_pylist()):
            if text and (terms := terms_of(text)):
                shard.add(doc, terms)
                if shard.full():
                    yield shard.row()
                    shard = _Shard()
    if shard.docs:
        yield shard.row()


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per shard. Documents without a term are in none, as nothing can find them."""
    rows = bounded(docs).select(F.col(f"`{id_col}`").cast("bigint").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(_shards, SHARD)


def _spread(values: np.ndarray) -> np.ndarray:
    """The bits of 32-bit numbers at the even places of 64-bit ones."""
    x = values.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Treap:
    """The compressed quadtree of one shard's impacts."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray) -> None:
        # Narrow types, as a tree has several nodes per cell and every core of an executor holds one: impacts are below a million.
        codes = _spread(columns)
        codes |= _spread(rows) << np.uint64(1)
        order = np.argsort(codes)
        codes, greatest = codes[order], [impacts[order].astype(np.int32)]
        del order
        self.height = int(max(int(rows.max()), int(columns.max()), 1)).bit_length()
        bits, firsts = [np.zeros(len(codes), np.uint8)], [np.zeros(len(codes), np.int32)]
        for _ in range(self.height):
            quadrants = (codes & np.uint64(3)).astype(np.uint8)
            codes >>= np.uint64(2)
            starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            greatest.append(np.maximum.reduceat(greatest[-1], starts))
            bits.append(np.bitwise_or.reduceat(np.left_shift(np.uint8(1), quadrants), starts))
            codes = codes[starts]
            firsts.append(starts.astype(np.int32))
        del codes, quadrants, starts
        end = 0
        for level, starts in zip(reversed(greatest), reversed(firsts)):
            end += len(level)
            starts += end
        firsts[0][:] = 0
        # One more node stands for empty squares: no impact, no children.
        self.impact = np.concatenate([*reversed(greatest), [0]], dtype=np.int32)
        del greatest, level
        self.bits = np.concatenate([*reversed(bits), [0]], dtype=np.int8, casting="unsafe")
        del bits
        self.first = np.concatenate([*reversed(firsts), [0]], dtype=np.int32)
        self.empty = len(self.impact) - 1

    def halves(self, nodes: np.ndarray, levels: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of the lower and the upper half of ranges, for each of the rows."""
        lower = ((rows[None, :] >> (levels[:, None] - 1)) & 1) << 1
        bits, first = self.bits[nodes], self.first[nodes]

        def child(quadrant: np.ndarray) -> np.ndarray:
            return np.where((bits >> quadrant) & 1, first + BEFORE[bits, quadrant], self.empty)

        return child(lower), child(lower | 1)

    def best(self, rows: np.ndarray, weights: np.ndarray, ids: np.ndarray, known: list[tuple[int, int]], top: int) -> list[tuple[int, int]]:
        """``known`` and the columns of this tree, the best ``top`` as (-score, id), where ``ids`` ascend over the columns."""
        nodes = np.zeros((1, len(rows)), np.int64)
        levels, starts = np.array([self.height]), np.zeros(1, np.int64)
        bounds = self.impact[nodes] @ weights
        while len(bounds):
            if len(bounds) > RANGES:
                taken = np.zeros(len(bounds), bool)
                taken[np.argpartition(bounds, -RANGES)[-RANGES:]] = True
            else:
                taken = np.ones(len(bounds), bool)
            level = levels[taken]
            children = np.concatenate(self.halves(nodes[taken], level, rows))
            half = np.left_shift(1, level - 1)
            begin = np.concatenate([starts[taken], starts[taken] + half])
            level = np.concatenate([level, level]) - 1
            bound = self.impact[children] @ weights
            leaf = (level == 0) & (bound > 0)
            if leaf.any():
                known = sorted([*known, *zip((-bound[leaf]).tolist(), ids[begin[leaf]].tolist())])[:top]
            inner = (level > 0) & (bound > 0)
            rest = ~taken
            nodes = np.concatenate([nodes[rest], children[inner]])
            levels, starts = np.concatenate([levels[rest], level[inner]]), np.concatenate([starts[rest], begin[inner]])
            bounds = np.concatenate([bounds[rest], bound[inner]])
            if len(known) == top and len(bounds):
                # Of documents that score alike the least id counts, and the first of a range has the least of it.
                score, last = -known[-1][0], known[-1][1]
                wanted = (bounds > score) | ((bounds == score) & (ids[starts] < last))
                nodes, levels, starts, bounds = nodes[wanted], levels[wanted], starts[wanted], bounds[wanted]
        return known


NULL_ID = -(1 << 63)


def _treap_of(shard: dict, documents: int, length: int) -> tuple[Treap, np.ndarray, dict[bytes, int]]:
    columns, frequencies = np.frombuffer(zstandard.decompress(shard["cells"]), "<i4").reshape(2, -1)
    rows = np.repeat(np.arange(len(shard["df"]), dtype=np.int32), shard["df"])
    share = {n: 100 - LENGTH_SHARE + (LENGTH_SHARE * n * documents) // length for n in set(shard["lengths"])}
    m = np.array([share[n] for n in shard["lengths"]], np.int64)
    impacts = np.empty(len(rows), np.int32)
    for a in range(0, len(rows), CELLS_AT_ONCE):
        part = slice(a, a + CELLS_AT_ONCE)
        tf = frequencies[part].astype(np.int64)
        impacts[part] = (IMPACT * tf) // (FREQUENCY_SCALE * tf + LENGTH_SCALE * m[columns[part]])
    ids = np.array([NULL_ID if d is None else d for d in shard["docs"]], np.int64)
    return Treap(rows, columns, impacts), ids, {t: i for i, t in enumerate(shard["terms"])}


def _searched(documents: int, length: int, top: int):
    """A function of rows of a shard and a block of items, which gives the best documents of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int]]] = {}
        names: dict[int, int | None] = {}
        last, tree = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                if (shard := row.column("shard")[0].as_py()) != last:
                    tree = None  # the one before goes first
                    tree = _treap_of({c: row.column(c)[0].as_py() for c in ("docs", "lengths", "terms", "df", "cells")}, documents, length)
                    last = shard
                treap, ids, numbers = tree
                for item in row.column("items")[0].as_py():
                    known = [(numbers[t], w) for t, w in zip(item["terms"], item["weights"]) if t in numbers]
                    if known:
                        rows, weights = np.array(known, np.int64).T
                        names[item["item"]] = item["item_id"]
                        best[item["item"]] = treap.best(rows, weights, ids, best.get(item["item"], []), top)
        found = [(item, names[item], None if d == NULL_ID else d, -s) for item, docs in best.items() for s, d in docs]
        columns = list(zip(*found)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "item_id", "doc_id", "score"])

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [sorted(set(terms_of(t or b""))) for t in _binary(batch.column(2)).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(terms, pa.list_(pa.binary()))], ["item", "item_id", "terms"])


def search(index_rows: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item, item_id, rank, doc_id, score): the best ``top`` documents of the index for every row of ``items`` (item_id, text).

    The queries are put against all shards in blocks of some BLOCK_ITEMS items, each beside every shard.
    """
    size = index_rows.agg(F.sum(F.size("docs")), F.sum(F.expr("aggregate(lengths, 0L, (a, b) -> a + b)"))).first()
    documents, length = size[0] or 0, size[1] or 0
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("bigint").alias("item_id"), "text")
    asked = kept(bounded(rows).mapInArrow(_item_terms, "item bigint, item_id bigint, terms array<binary>"), "search-items")
    blocks = max(1, math.ceil(asked.count() / BLOCK_ITEMS))
    pairs = asked.select("item", "item_id", F.explode("terms").alias("term"))
    per_shard = index_rows.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.df").alias("df"))
    df = per_shard.join(pairs.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(F.lit(float(WEIGHT)) * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1)))
    weighted = pairs.join(df, "term").withColumn("weight", weight.cast("bigint")).where("weight > 0")
    per_item = weighted.groupBy("item", "item_id").agg(F.collect_list("term").alias("terms"), F.collect_list("weight").alias("weights"))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    in_blocks = per_item.groupBy(block.alias("block")).agg(F.collect_list(F.struct("item", "item_id", "terms", "weights")).alias("items"))
    beside = index_rows.withColumn("shard", F.monotonically_increasing_id()).crossJoin(kept(in_blocks.drop("block"), "search-blocks"))
    found = bounded(beside).mapInArrow(_searched(documents, length, top), FOUND)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def op13_treap_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Each item's ten best documents.

    A null text has no terms: such a document is never found and not counted, such an item finds none. Every row of a table is
    a document or an item of its own, rows of one id too. Null ids of documents come before the others where scores are equal.
    Texts of any length are read whole; a long one closes its shard. Other columns play no part.
    """
    return search(kept(index(docs), "search-index"), items).select("item_id", "rank", "doc_id", "score")
