"""Exact repeats of long strings, found by most-significant-digit passes over suffixes.

Suffixes are ordered only as deep as ``length`` bytes, and only as far as needed to
tell which of them agree that deep: a pass groups suffixes by their next digit, and a
suffix left alone in its group is dropped. Suffixes that agree in the last digit begin
the repeated strings.

Digits are chosen so that one row stands for many suffixes:

1. *Anchor.* The first digit of a suffix is the minimiser of its first ``length``
   bytes, the ANCHOR-byte string with the least hash. Neighbouring suffixes mostly
   share one, so a pass takes a row per run of them, not per byte. A run all of whose
   bytes occur elsewhere is finished here.
2. *Step.* Runs with a shared anchor that differ further out are cut, in step with
   the anchor, into stretches of STEP suffixes. Their digit is what the stretch has
   in common; a stretch all of whose bytes occur elsewhere is finished.
3. *Whole string.* What is left at the edges of repeats is told apart one suffix at a
   time.

A group of any size is only ever counted, never gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm import bytescan as bs
from tripweave.llm.common import Steps, bounded, digests, filled, kept

ANCHOR = 64
STEP = 16
_SLOT = 1 << 10  # room for the number of suffixes of a run, and for an anchor's place in it
_RUNS = "g long, h1 long, h2 long, t1 long, t2 long, pos long"


def _pack(start: np.ndarray, n: np.ndarray, left: np.ndarray) -> np.ndarray:
    return (start * _SLOT + n) * _SLOT + left


def _unpack(pos):
    return pos // (_SLOT * _SLOT), pos // _SLOT % _SLOT, pos % _SLOT


def _segments(at: np.ndarray, overlap: int) -> Iterator[tuple[int, int, int, int]]:
    """Rows [i, j) and bytes [a, b): many short texts at once, or a part of a long one."""
    for i, j in bs.blocks(at):
        lo, hi = int(at[i]), int(at[j])
        if j - i > 1 or hi - lo <= bs.BLOCK:
            yield i, j, lo, hi
            continue
        for a in range(lo, max(lo + 1, hi - overlap), bs.BLOCK):
            yield i, j, a, min(hi, a + bs.BLOCK + overlap)


def _runs_of(length: int, anchor: int):
    """Runs of suffixes with one anchor: its hash, two hashes of all bytes, and the place."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = bs.BLOCK + length
        one, two = bs.Rolling(1, size), bs.Rolling(2, size)
        bits = bs.U64(22)
        low = (bs.U64(1) << bits) - bs.U64(1)
        for batch in batches:
            raw, at = bs.buffer_of(batch.column("text"))
            t1, t2 = batch.column("t1").to_numpy(), batch.column("t2").to_numpy()
            for i, j, a, b in _segments(at, length - 1):
                data = raw[a:b]
                if len(data) < length:
                    continue
                p1, p2 = one.prefix(data), two.prefix(data)
                grams = bs.mix(one.windows(p1, anchor))
                ranked = (grams & ~low) | np.arange(len(grams), dtype=bs.U64)
                place = (bs.sliding_min(ranked, length - anchor + 1) & low).astype(np.int64)
                rows = np.repeat(np.arange(i, j), np.minimum(at[i + 1 : j + 1], b) - np.maximum(at[i:j], a))[: len(place)]
                whole = a + np.arange(len(place)) + length <= at[rows + 1]
                first = np.ones(len(place), bool)
                first[1:] = (place[1:] != place[:-1]) | (rows[1:] != rows[:-1]) | (whole[1:] != whole[:-1])
                start = np.flatnonzero(first)
                n = np.diff(np.append(start, len(place)))
                good = whole[start]
                start, n = start[good], n[good]
                if not len(start):
                    continue
                row, end = rows[start], start + n + length - 1
                columns = (
                    bs.signed(grams[place[start]]),
                    bs.signed(bs.mix(one.spans(p1, start, end))),
                    bs.signed(bs.mix(two.spans(p2, start, end))),
                    t1[row],
                    t2[row],
                    _pack(start + a - at[row], n, place[start] - start),
                )
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["g", "h1", "h2", "t1", "t2", "pos"])

    return scan


def _strings_of(length: int):
    """The bytes of open runs, cut out of their texts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = bs.buffer_of(batch.column("text"))
            places = batch.column("places")
            bounds, values = places.offsets.to_numpy(), places.values.to_numpy()
            strings, pos, row = [], [], []
            for r in range(len(batch)):
                own = values[bounds[r] : bounds[r + 1]]
                start, n, _ = _unpack(own)
                strings += [raw[at[r] + s : at[r] + s + m + length - 1].tobytes() for s, m in zip(start, n)]
                pos.append(own)
                row.append(np.full(len(own), r))
            pick = np.concatenate(row) if row else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(batch.column("t1").to_numpy()[pick]),
                    pa.array(batch.column("t2").to_numpy()[pick]),
                    pa.array(np.concatenate(pos) if pos else np.empty(0, np.int64), pa.int64()),
                    pa.array(strings, pa.binary()),
                ],
                names=["t1", "t2", "pos", "string"],
            )

    return cut


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int, int]]:
    raw, at = bs.buffer_of(batch.column("string"))
    for i, j in bs.blocks(at):
        yield raw[at[i] : at[j]], at[i:j] - at[i], batch.column("pos").to_numpy()[i:j], i, j


def _steps_of(length: int, step: int):
    """Stretches of at most ``step`` suffixes: the digit they share, and two hashes of all bytes.

    A stretch cut short by the end of its run has hashes of its own, so it stays open.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = bs.BLOCK + 2 * length + 1
        one, two = bs.Rolling(1, size), bs.Rolling(2, size)
        for batch in batches:
            ids, t1, t2 = (batch.column(c).to_numpy() for c in ("id", "t1", "t2"))
            for data, base, pos, i, j in _slices(batch):
                p1, p2 = one.prefix(data), two.prefix(data)
                begin, n, left = _unpack(pos)
                top, bottom = left // step, (left - n + 1) // step
                count = top - bottom + 1
                run = np.repeat(np.arange(j - i), count)
                nth = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
                stretch = bottom[run] + nth
                anchor = base[run] + left[run]
                most = np.minimum(stretch * step + step - 1, left[run])
                least = np.maximum(stretch * step, left[run] - n[run] + 1)
                common = anchor - stretch * step
                g = one.spans(p1, common, common + length - step + 1) ^ bs.mix(stretch.astype(bs.U64) + bs.U64(1))
                full = most - least + 1 == step
                lo, hi = anchor - most, anchor - least + length
                own = bs.mix(ids[i:j].view(bs.U64)[run] + stretch.astype(bs.U64))
                h1 = np.where(full, bs.mix(one.spans(p1, lo, hi)), own)
                h2 = np.where(full, bs.mix(two.spans(p2, lo, hi)), bs.U64(0))
                place = _pack(begin[run] + left[run] - most, most - least + 1, most)
                columns = (bs.signed(bs.mix(g)), bs.signed(h1), bs.signed(h2), bs.signed(own), ids[i:j][run], t1[i:j][run], t2[i:j][run], place)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["g", "h1", "h2", "id", "run", "t1", "t2", "pos"])

    return scan


def _windows_of(length: int):
    """Single suffixes of open stretches: two hashes of their first ``length`` bytes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = bs.BLOCK + 2 * length + 1
        one, two = bs.Rolling(1, size), bs.Rolling(2, size)
        for batch in batches:
            places = batch.column("places")
            bounds, values = places.offsets.to_numpy(), places.values.to_numpy()
            bounds = bounds[: len(batch) + 1]
            t1, t2 = batch.column("t1").to_numpy(), batch.column("t2").to_numpy()
            for data, base, pos, i, j in _slices(batch):
                p1, p2 = one.prefix(data), two.prefix(data)
                own = values[bounds[i] : bounds[j]]
                run = np.repeat(np.arange(j - i), np.diff(bounds[i : j + 1]))
                start, n, _ = _unpack(own)
                begin = _unpack(pos)[0][run]
                each = np.repeat(np.arange(len(own)), n)
                nth = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
                absolute = start[each] + nth
                lo = base[run][each] + absolute - begin[each]
                a, b = t1[i:j][run][each], t2[i:j][run][each]
                ident = bs.mix(a.view(bs.U64) + bs.mix(b.view(bs.U64) + absolute.astype(bs.U64)))
                columns = (
                    bs.signed(bs.mix(one.spans(p1, lo, lo + length))),
                    bs.signed(bs.mix(two.spans(p2, lo, lo + length))),
                    bs.signed(ident),
                    a,
                    b,
                    _pack(absolute, np.ones_like(absolute), np.zeros_like(absolute)),
                )
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h1", "h2", "id", "t1", "t2", "pos"])

    return scan


def _several(column: str) -> Column:
    return F.min(column) < F.max(column)


def repeated_spans(texts: DataFrame, length: int = 200, anchor: int = ANCHOR, step: int = STEP) -> DataFrame:
    """Where the repeated strings of ``length`` bytes lie.

    ``texts`` has text, t1 and t2 (hashes that name the text) and tie (any value that tells
    copies of a text apart). The result has a row per text with repeats: t1, t2 and places,
    packed as (start, number of suffixes).
    """
    anchor = min(anchor, length)
    texts = bounded(texts).select("text", "t1", "t2", "tie")
    runs = texts.select("text", "t1", "t2").mapInArrow(_runs_of(length, anchor), _RUNS)

    # First digit: the anchor. Digits shared are written before they are joined, so that Spark can split a frequent one.
    steps = Steps(texts.sparkSession)
    shared = runs.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g")
    candidates = steps.kept(runs.join(steps.kept(shared, "suffix-shared"), "g", "left_semi"), "suffix-runs")
    kinds = candidates.groupBy("g", "h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("t1", "t2", "pos")).alias("one"))
    kinds = steps.kept(kinds, "suffix-kinds")
    finished = candidates.join(kinds.where("n > 1"), ["g", "h1", "h2"], "left_semi").select("t1", "t2", "pos")
    open_groups = kinds.where("n = 1").select("g").distinct()
    again = kinds.join(steps.kept(open_groups, "suffix-open"), "g", "left_semi").select("one.*")

    # The bytes of the runs still open, each from one copy of its text.
    one_copy = texts.groupBy("t1", "t2").agg(F.min("tie").alias("tie"))
    wanted = again.groupBy("t1", "t2").agg(F.collect_list("pos").alias("places")).join(one_copy, ["t1", "t2"])
    a, b = texts.alias("a"), wanted.alias("b")
    same = (F.col("a.t1") == F.col("b.t1")) & (F.col("a.t2") == F.col("b.t2")) & F.col("a.tie").eqNullSafe(F.col("b.tie"))
    strings = a.join(b, same).select("a.text", "a.t1", "a.t2", "b.places")
    strings = strings.mapInArrow(_strings_of(length), "t1 long, t2 long, pos long, string binary")
    strings = steps.kept(strings.withColumn("id", F.xxhash64("t1", "t2", "pos")), "suffix-strings")

    # Second digit: what a stretch of suffixes has in common.
    stretched = strings.select("string", "id", "t1", "t2", "pos").mapInArrow(
        _steps_of(length, step), "g long, h1 long, h2 long, id long, run long, t1 long, t2 long, pos long"
    )
    shared = stretched.groupBy("g").agg(_several("id").alias("several")).where("several").select("g")
    stretches = steps.kept(stretched.join(steps.kept(shared, "suffix-shared"), "g", "left_semi"), "suffix-stretches")
    kinds = stretches.groupBy("g", "h1", "h2").agg(_several("id").alias("several"), F.min("id").alias("id"))
    kinds = steps.kept(kinds, "suffix-stretch-kinds")
    finished_steps = stretches.join(kinds.where("several"), ["g", "h1", "h2"], "left_semi").select("t1", "t2", "pos")
    open_groups = kinds.where("not several").select("g").distinct()
    again = kinds.join(steps.kept(open_groups, "suffix-open"), "g", "left_semi").select("g", "id")
    places = stretches.join(steps.kept(again, "suffix-again"), ["g", "id"], "left_semi").groupBy("run").agg(F.collect_set("pos").alias("places"))

    # Last digit: the whole string.
    windows = strings.join(places, strings.id == places.run).select("string", "t1", "t2", "pos", "places")
    windows = windows.mapInArrow(_windows_of(length), "h1 long, h2 long, id long, t1 long, t2 long, pos long")
    windows = steps.kept(windows, "suffix-windows")
    shared = windows.groupBy("h1", "h2").agg(_several("id").alias("several")).where("several").select("h1", "h2")
    single = windows.join(steps.kept(shared, "suffix-shared"), ["h1", "h2"], "left_semi").select("t1", "t2", "pos")

    found = finished.union(finished_steps).union(single)
    places = kept(found.groupBy("t1", "t2").agg(F.collect_set("pos").alias("places")), "suffix-places")
    steps.clear()
    return places


def _remaining(length: int):
    @F.arrow_udf("struct<n_bytes: long, n_removed: long, n_spans: long, kept: binary, spans: array<struct<start: long, end: long>>>")
    def remaining(text: pa.Array, places: pa.Array) -> pa.Array:
        raw, at = bs.buffer_of(text)
        out = []
        for r, own in enumerate(places):
            data = raw[at[r] : at[r + 1]]
            start = end = np.empty(0, np.int64)
            if own.is_valid and len(own):
                first, n, _ = _unpack(np.sort(own.values.to_numpy()))
                last = np.maximum.accumulate(first + n - 1 + length)
                head = np.ones(len(first), bool)
                head[1:] = first[1:] > last[:-1]
                start = first[head]
                end = last[np.append(np.flatnonzero(head)[1:] - 1, len(last) - 1)]
            edges = [0, *np.column_stack([start, end]).ravel().tolist(), len(data)]
            rest = b"".join(data[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2]))
            spans = [{"start": a, "end": b} for a, b in zip(start.tolist(), end.tolist())]
            out.append({"n_bytes": len(data), "n_removed": len(data) - len(rest), "n_spans": len(spans), "kept": rest, "spans": spans})
        return pa.array(out, remaining_type)

    remaining_type = pa.struct(
        [
            ("n_bytes", pa.int64()),
            ("n_removed", pa.int64()),
            ("n_spans", pa.int64()),
            ("kept", pa.binary()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ]
    )
    return remaining


def without_repeats(docs: DataFrame, length: int = 200, text: str = "text", tie: str = "doc_id", into: str = "repeats") -> DataFrame:
    """``docs`` with a struct column ``into``: n_bytes, n_removed, n_spans, kept and spans.

    ``kept`` holds the bytes of the text not covered by any string of ``length`` bytes that
    also starts elsewhere, in this text or another; ``spans`` the maximal runs taken out.
    Null texts count as empty; texts shorter than ``length`` keep everything; rows that are
    equal, and rows with equal or null ids, are documents of their own. An empty table gives
    an empty one. Other columns pass through, whatever their names but ``into`` and those
    that begin with two underscores.
    """
    one, two = digests(filled(text))
    named = docs.withColumns({"__t1": one, "__t2": two})
    texts = named.select(filled(text).alias("text"), F.col("__t1").alias("t1"), F.col("__t2").alias("t2"), F.col(tie).alias("tie"))
    places = repeated_spans(texts, length).select(F.col("t1").alias("__t1"), F.col("t2").alias("__t2"), F.col("places").alias("__places"))
    joined = named.join(places, ["__t1", "__t2"], "left")
    return joined.withColumn(into, _remaining(length)(filled(text), F.col("__places"))).drop("__t1", "__t2", "__places")


def op2_suffix_dedup(docs: DataFrame) -> DataFrame:
    done = without_repeats(docs.select("doc_id", "text"))
    return done.select(
        "doc_id",
        F.col("repeats.n_bytes").alias("n_bytes"),
        F.col("repeats.n_removed").alias("n_removed"),
        F.col("repeats.n_spans").alias("n_spans"),
        F.sha2(F.col("repeats.kept"), 256).alias("kept_sha256"),
    )


def as_text(value: Column) -> Column:
    """UTF-8 bytes as text, without the rest of characters that were cut."""

    @F.arrow_udf("string")
    def decoded(values: pa.Array) -> pa.Array:
        return pa.array([None if v.as_py() is None else v.as_py().decode("utf-8", "ignore") for v in values], pa.string())

    return decoded(value)
