"""Text quality by a small convolutional network over bytes, in numpy.

Bytes have learned embeddings; learned filters pass over overlapping chunks that cover the whole
text, so every window a filter can see lies in some chunk; each filter's greatest response in a
chunk is kept. The mean of these over the chunks, weighted by their bytes, and their maximum are
combined into one probability. Nothing but the text is an input.

The network is fitted on a bounded sample of labelled rows, and scoring is one narrow pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm import bytescan as bs
from tripweave.llm.common import bounded, filled

CHUNK = 1024
WIDTH = 8  # bytes under a filter
STRIDE = 4
EMBEDDING = 8
FILTERS = 32
SAMPLE_ROWS = 2000  # of each label
SAMPLE_CHUNKS = 8  # of each text of the sample
EPOCHS = 12
BATCH = 32
AT_ONCE = 256  # chunks in memory while scoring
_PAD = 256
_OVERLAP = WIDTH - STRIDE
_STEP = CHUNK - _OVERLAP


def chunks_of(data: np.ndarray) -> np.ndarray:
    """Overlapping chunks of a text as rows, the last one padded; none for an empty text."""
    n = max(1, -(-(len(data) - _OVERLAP) // _STEP)) if len(data) else 0
    padded = np.full((n - 1) * _STEP + CHUNK if n else 0, _PAD, np.int16)
    padded[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::_STEP] if n else padded.reshape(0, CHUNK)


def weights_of(n_bytes: int, chunks: int) -> np.ndarray:
    covered = np.full(chunks, float(_STEP))
    if chunks:
        covered[-1] = max(1, n_bytes - (chunks - 1) * _STEP)
    return covered / max(1.0, covered.sum())


@dataclass
class Net:
    embedding: np.ndarray  # one row per byte, the last for padding
    filters: np.ndarray  # (WIDTH * EMBEDDING, FILTERS)
    shift: np.ndarray
    dense: np.ndarray  # (2 * FILTERS,)
    bias: float

    def windows(self, chunks: np.ndarray) -> np.ndarray:
        e = self.embedding[chunks].reshape(len(chunks), -1)
        return np.lib.stride_tricks.sliding_window_view(e, WIDTH * EMBEDDING, axis=1)[:, :: STRIDE * EMBEDDING]

    def pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The greatest response of each filter in each chunk, and where it is."""
        seen = self.windows(chunks)
        out = (seen.reshape(-1, WIDTH * EMBEDDING) @ self.filters).reshape(len(chunks), -1, FILTERS)
        where = out.argmax(axis=1)
        best = np.take_along_axis(out, where[:, None, :], 1)[:, 0]
        return np.maximum(best + self.shift, 0), where

    def score(self, data: np.ndarray) -> float:
        rows = chunks_of(data)
        mean, most = np.zeros(FILTERS), np.zeros(FILTERS)
        weights = weights_of(len(data), len(rows))
        for a in range(0, len(rows), AT_ONCE):
            best, _ = self.pooled(rows[a : a + AT_ONCE])
            mean += weights[a : a + AT_ONCE] @ best
            most = np.maximum(most, best.max(axis=0))
        logit = float(np.concatenate([mean, most]) @ self.dense + self.bias)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def fit(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, prior: float, seed: int = 1) -> Net:
    """Fit to (chunks, weights) of texts by stochastic gradients; ``prior`` is the true share of label 1."""
    rng = np.random.default_rng(seed)
    net = Net(
        rng.normal(0, 0.5, (257, EMBEDDING)).astype(np.float32),
        rng.normal(0, 1 / math.sqrt(WIDTH * EMBEDDING), (WIDTH * EMBEDDING, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        np.zeros(2 * FILTERS, np.float32),
        0.0,
    )
    net.embedding[_PAD] = 0
    parts = [net.embedding, net.filters, net.shift, net.dense, np.zeros(1, np.float32)]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    share = max(1e-3, min(1 - 1e-3, float(np.mean(labels)) if len(labels) else 0.5))
    balance = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    usable = [i for i, (chunks, _) in enumerate(texts) if len(chunks)]
    step, reach = 0, np.arange(WIDTH)
    for epoch in range(EPOCHS):
        rate = 0.01 * (1 - epoch / EPOCHS)
        for batch in np.array_split(rng.permutation(usable), max(1, len(usable) // BATCH)):
            if not len(batch):
                continue
            chunks = np.concatenate([texts[i][0] for i in batch])
            weights = np.concatenate([texts[i][1] for i in batch])
            owner = np.repeat(np.arange(len(batch)), [len(texts[i][0]) for i in batch])
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best, where = net.pooled(chunks)
            mean = np.add.reduceat(best * weights[:, None], starts)
            most = np.maximum.reduceat(best, starts)
            both = np.concatenate([mean, most], axis=1)
            p = 1 / (1 + np.exp(-np.clip(both @ net.dense + parts[4][0], -30, 30)))
            g = (p - labels[batch]) * balance[batch] / len(batch)
            g_dense = both.T @ g + 1e-4 * net.dense
            back = g[owner][:, None] * (weights[:, None] * net.dense[:FILTERS] + (best == most[owner]) * net.dense[FILTERS:]) * (best > 0)
            seen = np.take_along_axis(net.windows(chunks), where[:, :, None], 1)
            g_filters = np.einsum("bcf,bc->fc", seen, back)
            g_embedding = np.zeros_like(net.embedding)
            inside = chunks[np.arange(len(chunks))[:, None, None], where[:, :, None] * STRIDE + reach]
            spread = back[:, :, None] * net.filters.T[None]
            np.add.at(g_embedding, inside.ravel(), spread.reshape(-1, EMBEDDING))
            g_embedding[_PAD] = 0
            step += 1
            for k, grad in enumerate((g_embedding, g_filters, back.sum(0), g_dense, np.array([g.sum()]))):
                first[k] += 0.1 * (grad - first[k])
                second[k] += 0.001 * (grad * grad - second[k])
                parts[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    # The classes were balanced in the fit; the score is for texts as they come.
    net.bias = float(parts[4][0]) + math.log(prior / (1 - prior))
    return net


def _sampled(n_chunks: int):
    @F.arrow_udf("struct<bytes: binary, n: long>")
    def pick(texts: pa.Array) -> pa.Array:
        raw, at = bs.buffer_of(texts)
        out = []
        for r in range(len(at) - 1):
            rows = chunks_of(raw[at[r] : at[r + 1]])
            some = np.unique(np.linspace(0, len(rows) - 1, n_chunks).astype(int)) if len(rows) else []
            out.append({"bytes": rows[some].astype("<i2").tobytes() if len(rows) else b"", "n": int(at[r + 1] - at[r])})
        return pa.array(out, pa.struct([("bytes", pa.binary()), ("n", pa.int64())]))

    return pick


def held_out(doc_id: Column) -> Column:
    """A third of all rows, by id, that no label is learned from; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", doc_id: str = "doc_id", rows: int = SAMPLE_ROWS) -> Net | float:
    """A network fitted to at most ``rows`` labelled rows of each class, those with the least hash of their id.

    Rows that are held out, unlabelled or null do not count. Where a class is missing, the share
    of label 1 (a half if there is none at all) stands for every score.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).alias("y")).where(F.col("id").isNotNull() & F.col("y").isin(0, 1))
    known = known.where(~held_out(F.col("id")))
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return counts.get(1, 0) / total if total else 0.5
    chosen = None
    for y in (0, 1):
        some = known.where(F.col("y") == y).dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").limit(rows)
        chosen = some if chosen is None else chosen.union(some)
    # At most 2 * rows ids.
    texts = docs.select(F.col(doc_id).alias("id"), filled(text).alias("text")).join(F.broadcast(chosen), "id")
    found = texts.select("id", "y", _sampled(SAMPLE_CHUNKS)("text").alias("s")).dropDuplicates(["id"]).orderBy("id").collect()
    prepared = []
    for r in found:
        chunks = np.frombuffer(r.s.bytes, "<i2").astype(np.int16).reshape(-1, CHUNK)
        real = (chunks != _PAD).sum(axis=1).astype(float)
        prepared.append((chunks, real / max(1.0, real.sum())))
    return fit(prepared, np.array([r.y for r in found]), counts[1] / total)


def scorer(net: Net | float):
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        raw, at = bs.buffer_of(texts)
        if isinstance(net, float):
            return pa.array([net] * (len(at) - 1), pa.float64())
        return pa.array([net.score(raw[at[r] : at[r + 1]]) for r in range(len(at) - 1)], pa.float64())

    return score


def with_quality(docs: DataFrame, net: Net | float, text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from a half on).

    Null texts count as empty, and an empty text has the score of a network that sees nothing.
    Equal texts have equal scores. Other columns pass through; score and predicted are replaced.
    """
    scored = bounded(docs).withColumn("score", scorer(net)(filled(text)))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_quality_net(docs: DataFrame, labels: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    scored = with_quality(docs, train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
