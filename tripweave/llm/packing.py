"""Packing of tokenized documents into sequences of one length, by the histogram of lengths.

Documents are cut at every ``limit`` tokens; only the last piece of each can be shorter. The
number of pieces of each length, at most ``limit`` numbers, is all that the packing needs:
lengths are placed longest first, each into the packs that are shortest so far, and only
patterns of lengths with their counts are kept. Pieces find their place by their rank
among the pieces of their length. Ranks are counted in blocks, so no length, however
common, is ranked in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import bounded, filled, kept
from tripweave.llm.vocab import byte_bpe, default_path

BLOCK = 100_000  # pieces ranked together
_PIECES = "start long, length long, ids_crc32 long, doc_tokens long"


def pack_histogram(counts: dict[int, int], limit: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths, number of packs) that place ``counts[length]`` pieces of every length.

    Lengths go longest first into the open packs that are shortest so far, if they
    fit there, and else into new ones. Packs filled alike are one entry, so the work depends
    on the number of different lengths and not on that of pieces.
    """
    open_packs: dict[int, list[tuple[tuple, int]]] = {}  # by tokens so far
    full: list[tuple[tuple, int]] = []

    def put(pattern: tuple, size: int, packs: int) -> None:
        if size == limit:
            full.append((pattern, packs))
        else:
            open_packs.setdefault(size, []).append((pattern, packs))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            size = min(open_packs, default=limit)
            if size + length > limit:
                # Not even the shortest pack has room: as many pieces as fit share a new one.
                each = min(limit // length, left)
                packs = left // each
                put((None, length, each), length * each, packs)
                left -= packs * each
                continue
            pattern, packs = open_packs[size].pop()
            if not open_packs[size]:
                del open_packs[size]
            each = min((limit - size) // length, max(1, left // packs))
            used = min(packs, left // each)
            put((pattern, length, each), size + length * each, used)
            if used < packs:
                put(pattern, size, packs - used)
            left -= used * each
    patterns = []
    for pattern, packs in [*full, *(p for size in sorted(open_packs) for p in open_packs[size])]:
        lengths = []
        while pattern:
            pattern, length, each = pattern
            lengths += [length] * each
        patterns.append((lengths[::-1], packs))
    return patterns


def _cut(path: str, limit: int, end_id: int):
    """Token ids of every text and the end, cut into pieces: start, length, checksum of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = byte_bpe(path)
        for batch in batches:
            row, start, length, crc, tokens = [], [], [], [], []
            for r, text in enumerate(batch.column("text")):
                ids = np.append(ids_of(text.as_py() or ""), end_id).astype("<u4")
                for a in range(0, len(ids), limit):
                    piece = ids[a : a + limit]
                    row.append(r)
                    start.append(a)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    tokens.append(len(ids))
            columns = [batch.column("key").take(pa.array(row, pa.int64())), *(pa.array(c, pa.int64()) for c in (start, length, crc, tokens))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def pack(docs: DataFrame, path: str, limit: int = 1024, end_id: int = 0, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row per piece: the id, start, length, ids_crc32, doc_tokens, sequence_id and offset.

    Every token of a document, its end included, lies in one piece, and no sequence has more
    than ``limit`` tokens. Null and empty texts are just their end. Rows that are equal are
    packed each on its own; which of them comes first does not show. An empty table gives an
    empty one. Other columns of ``docs`` are not carried along, so none can clash.
    """
    spark = docs.sparkSession
    plain = bounded(docs).select(F.col(doc_id).alias("key"), filled(text).alias("text"))
    kind = plain.schema["key"].dataType.simpleString()
    pieces = kept(plain.mapInArrow(_cut(path, limit, end_id), f"key {kind}, {_PIECES}"), "pieces")

    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``limit`` rows
    rows, base, ranked = [], 0, dict.fromkeys(counts, 0)
    for lengths, packs in pack_histogram(counts, limit):
        offset = 0
        for length in lengths:
            rows.append((length, ranked[length], ranked[length] + packs, base, offset))
            ranked[length] += packs
            offset += length
        base += packs
    slots = spark.createDataFrame(rows, "slot_length long, low long, high long, base long, offset long")

    blocks = max(1, sum(counts.values()) // BLOCK)
    blocked = pieces.withColumn("block", F.pmod(F.xxhash64("key", "start", "ids_crc32"), F.lit(blocks)))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocked.groupBy("length", "block").agg(F.count("*").alias("n"))
    sizes = sizes.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    own = Window.partitionBy("length", "block").orderBy("key", "start", "ids_crc32")
    ranks = blocked.withColumn("nth", F.row_number().over(own) - 1).join(sizes, ["length", "block"])
    ranks = ranks.withColumn("rank", F.col("ahead") + F.col("nth"))
    # A few slots for each of at most ``limit`` lengths, whatever the number of documents.
    here = (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    placed = ranks.join(F.broadcast(slots), here)
    sequence = (F.col("base") + F.col("rank") - F.col("low")).alias("sequence_id")
    return placed.select(F.col("key").alias(doc_id), "start", "length", "ids_crc32", "doc_tokens", sequence, "offset")


def op8_packing(docs: DataFrame, path: str | None = None) -> DataFrame:
    return pack(docs.select("doc_id", "text"), path or default_path("byte_bpe_50k.json"))
