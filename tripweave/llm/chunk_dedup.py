"""Substring de-duplication by content-defined chunks.

A gear hash rolls over the bytes of each text, and a chunk ends where some of its bits
are zero. Those bits depend on the last WINDOW bytes alone, so an insertion moves only the
chunk boundaries next to it, and a passage is cut alike wherever it stands. Chunks are
compared by a 128-bit digest. All but one occurrence of a chunk are copies, and a run of
copies of at least ``least`` bytes is removed; shorter ones are phrases that texts share by
chance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm import bytescan as bs
from tripweave.llm.common import bounded, digests, filled, kept

WINDOW = 16
MASK = 31  # a chunk ends at one byte in 32 on average
LONGEST = 1 << 12  # where nothing in the content ends a chunk
LEAST = 100
_GEAR = (bs.table_of(11) >> bs.U64(48)).astype(np.uint16)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: h = 2 h + gear[byte] modulo 2^16, so that older bytes have left it."""
    h = _GEAR[data]
    reach = 1
    while reach < WINDOW:
        more = h.copy()
        more[reach:] += h[:-reach] << np.uint16(reach)
        h, reach = more, reach * 2
    return h


def chunk_ends(data: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Where chunks end. ``opens`` has the start of every text, and hashes do not reach back over one."""
    h = gear(data)
    # The top bits have seen all of the window, unless it begins before its text does.
    cut = (h >> np.uint16(11)) & np.uint16(MASK) == 0
    place = np.flatnonzero(cut)
    text = np.searchsorted(opens, place, "right") - 1
    place = place[place - opens[text] >= WINDOW - 1] + 1
    ends = np.union1d(place, np.append(opens[opens > 0], len(data)))
    ends = ends[ends > 0]
    gap = np.diff(np.append(0, ends))
    if (gap > LONGEST).any():
        starts = ends - gap
        extra = [np.arange(a + LONGEST, b, LONGEST) for a, b in zip(starts[gap > LONGEST], ends[gap > LONGEST])]
        ends = np.union1d(ends, np.concatenate(extra))
    return ends


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = bs.buffer_of(batch.column("text"))
        t1, t2 = batch.column("t1").to_numpy(), batch.column("t2").to_numpy()
        for i, j in bs.blocks(at):
            a, b = int(at[i]), int(at[j])
            if a == b:
                continue
            opens = at[i:j] - a
            ends = chunk_ends(raw[a:b], opens[np.append(np.diff(opens) > 0, opens[-1] < b - a)])
            starts = np.append(0, ends[:-1])
            row = np.searchsorted(at[i + 1 : j + 1] - a, starts, "right") + i
            view = memoryview(raw[a:b])
            both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(view[x:y]) for x, y in zip(starts.tolist(), ends.tolist())), ">i8").reshape(-1, 2)
            pos = (starts + a - at[row]) * (2 * LONGEST) + (ends - starts)
            columns = (both[:, 0].astype(np.int64), both[:, 1].astype(np.int64), t1[row], t2[row], pos)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h1", "h2", "t1", "t2", "pos"])


_RESULT = pa.struct(
    [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()),
     ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
)


def _copies(found: pa.StructArray) -> np.ndarray:
    """Places of a text's chunks that stand earlier too. Chunks whose first text this is have a name, and stay once."""
    pos, own = found.field("pos").to_numpy(), found.field("own")
    order = np.argsort(pos)
    named = own.is_valid().to_numpy(zero_copy_only=False)[order]
    names = own.fill_null(0).to_numpy()[order]
    copy = ~named
    later = np.ones(len(pos), bool)
    later[np.flatnonzero(named)[np.unique(names[named], return_index=True)[1]]] = False
    return pos[order][copy | later]


def _without(least: int):
    @F.arrow_udf("struct<n_bytes: long, n_removed: long, n_spans: long, kept: binary, spans: array<struct<start: long, end: long>>>")
    def without(text: pa.Array, copies: pa.Array, later: pa.Array) -> pa.Array:
        raw, at = bs.buffer_of(text)
        out = []
        for r, (own, again) in enumerate(zip(copies, later)):
            data = raw[at[r] : at[r + 1]].tobytes()
            spans = []
            if again.as_py():
                spans = [(0, len(data))] if data else []
            elif own.is_valid and len(pos := _copies(own.values)):
                start, size = pos // (2 * LONGEST), pos % (2 * LONGEST)
                head = np.append(True, start[1:] != (start + size)[:-1])
                first = start[head]
                last = (start + size)[np.append(np.flatnonzero(head)[1:] - 1, len(pos) - 1)]
                spans = [(a, b) for a, b in zip(first.tolist(), last.tolist()) if b - a >= least]
            edges = [0, *(x for span in spans for x in span), len(data)]
            rest = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out.append((len(data), len(data) - len(rest), len(spans), rest, [{"start": a, "end": b} for a, b in spans]))
        return pa.array([dict(zip(("n_bytes", "n_removed", "n_spans", "kept", "spans"), x)) for x in out], _RESULT)

    return without


def without_copies(docs: DataFrame, least: int = LEAST, text: str = "text", doc_id: str = "doc_id", into: str = "copies") -> DataFrame:
    """``docs`` with a struct column ``into``: n_bytes, n_removed, n_spans, kept and spans.

    Of every chunk the first occurrence in one text stays, the one with the least hash, so that passages stay
    whole in one text whatever the order of rows; runs of other occurrences of at least ``least`` bytes go. Of equal texts the row with the least id
    keeps what its text keeps, and the others lose all of theirs if they have ``least`` bytes; rows equal in
    id and text too count as that same row. Null texts count as empty. An empty table gives
    an empty one. Other columns pass through, whatever their names but ``into`` and those
    that begin with two underscores.
    """
    one, two = digests(filled(text))
    named = bounded(docs).withColumns({"__t1": one, "__t2": two})
    texts = named.select(filled(text).alias("text"), F.col("__t1").alias("t1"), F.col("__t2").alias("t2"))
    chunks = texts.mapInArrow(_chunks, "h1 long, h2 long, t1 long, t2 long, pos long")
    # Equal texts give equal rows here, so these differ only if a chunk really lies in two places.
    ends = [F.min("t1").alias("first"), F.max("t1").alias("last"), F.min("pos").alias("low"), F.max("pos").alias("high")]
    shared = chunks.groupBy("h1", "h2").agg(*ends).where("first < last or low < high").select("h1", "h2", "first")
    shared = kept(shared, "chunks-shared")
    copies = chunks.join(shared, ["h1", "h2"]).withColumn("own", F.when(F.col("t1") == F.col("first"), F.col("h1")))
    copies = copies.groupBy("t1", "t2").agg(F.collect_set(F.struct("pos", "own")).alias("__copies"))
    first = named.groupBy("__t1", "__t2").agg(F.min(doc_id).alias("__least"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
    marks = first.join(copies.select(F.col("t1").alias("__t1"), F.col("t2").alias("__t2"), "__copies"), ["__t1", "__t2"], "full")
    joined = named.join(kept(marks, "chunks-marks"), ["__t1", "__t2"], "left")
    again = F.col("__least").isNotNull() & ~F.col(doc_id).eqNullSafe(F.col("__least")) & (F.octet_length(filled(text)) >= least)
    result = _without(least)(filled(text), F.col("__copies"), again)
    return joined.withColumn(into, result).drop("__t1", "__t2", "__copies", "__least")


def op1_chunk_dedup(docs: DataFrame) -> DataFrame:
    done = without_copies(docs.select("doc_id", "text"))
    fields = [F.col(f"copies.{c}").alias(c) for c in ("n_bytes", "n_removed", "n_spans")]
    return done.select("doc_id", *fields, F.sha2(F.col("copies.kept"), 256).alias("kept_sha256"))
