"""Quality rules: multivariate outliers by minimum covariance determinants per language and source.

Every text gives a short vector of transformed statistics. For each group the centre and
scatter of its densest COVER share are found by concentration steps: take the share of texts with the
least Mahalanobis distance, estimate again, repeat. The steps begin at the estimates of all texts, at
medians, and at a few drawn texts, and those that end with the least determinant hold, so that
anything but half of a group may be unusual. Copies of a text count once in the estimates. Each step is one
aggregate over the table of vectors; medians, and the distance up to which texts count, come from histograms,
so no group is ever sorted or gathered, whatever its size. Texts beyond the CHANCE
quantile of the distance are rejected.

Coordinates are multiples of 2^-12, so that their sums and products add up exactly and
the order of addition does not show in groups of up to some ten million rows.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm import bytescan as bs
from tripweave.llm.common import bounded, digests, filled, kept
from tripweave.llm.shingles import Words

#: Least spread of each coordinate, below which differences mean nothing: log word length, and the square
#: roots of symbols per word, the share of repeated lines, that of repeated words, that of capitals
#: among A-Z a-z, and marks per word.
FLOOR = (0.1, 0.1, 0.15, 0.15, 0.1, 0.15)
COVER = 0.5
STEPS = 12
SEEDS = 3  # starts from about DRAWN drawn texts each, besides those from all texts and from medians
DRAWN = 14
FINE = 256  # medians are found to within 1 / FINE
LEAST_ROWS = 60  # a group with fewer distinct texts joins the rest of its language; a rest with fewer the largest group there, or the rest of all
CHANCE = 1e-4  # of a normal vector to be rejected
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of words

_DIMS = len(FLOOR)
_KEY = ["g1", "g2", "start"]
_SYMBOLS = b"#*$%&|<>"
_MARKS = b".,!?;:"
_BLANKS = b" \t\n\v\f\r"
_NAMES = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()
_STATS = T.StructType([*(T.StructField(c, T.LongType()) for c in _NAMES), T.StructField("vector", T.ArrayType(T.DoubleType()))])


def tail(x: float, dims: int) -> float:
    """The chance of a chi-square of an even number of dimensions to exceed x."""
    return math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))


def quantile(chance: float, dims: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if tail(middle, dims) > chance else (low, middle)
    return high


def _repeated_words(rows: np.ndarray, words: np.ndarray, i: int, j: int) -> np.ndarray:
    """Per row, the words inside three-word windows found at least twice."""
    step = bs.U64(0xD6E8FEB86659FD93)
    if len(words) < 3:
        return np.zeros(j - i, np.int64)
    h = bs.mix(bs.mix(words[:-2] * step + words[1:-1]) * step + words[2:])
    at = np.flatnonzero(rows[:-2] == rows[2:])
    order = at[np.lexsort((h[at], rows[at]))]
    same = (h[order][1:] == h[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[order[again] + k] = True
    return np.bincount(rows[covered] - i, minlength=j - i)


def _repeated_lines(data: bytes) -> tuple[int, int]:
    lines = [line for line in data.split(b"\n") if line.strip(_BLANKS)]
    return len(lines), len(lines) - len(set(lines))


@F.arrow_udf(_STATS)
def text_stats(texts: pa.Array) -> pa.Array:
    """The counts of each text, and its vector."""
    raw, at = bs.buffer_of(texts)
    n = len(at) - 1
    count = np.zeros((n, 256), np.int64)
    lines = np.zeros((n, 2), np.int64)
    for r in range(n):
        data = raw[at[r] : at[r + 1]]
        for a in range(0, len(data), bs.BLOCK):
            count[r] += np.bincount(data[a : a + bs.BLOCK], minlength=256)
        lines[r] = _repeated_lines(data.tobytes())
    n_words, repeated = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, j, rows, words in Words(lower=False).of(raw, at):
        n_words[i:j] = np.bincount(rows - i, minlength=j - i)
        repeated[i:j] = _repeated_words(rows, words, i, j)
    among = lambda which: count[:, list(which)].sum(axis=1)
    chars = count.sum(axis=1) - count[:, 0x80:0xC0].sum(axis=1) - among(_BLANKS)
    symbols, marks = among(_SYMBOLS), among(_MARKS)
    capitals, small = count[:, 65:91].sum(axis=1), count[:, 97:123].sum(axis=1)
    share = lambda a, b: np.sqrt(a / np.maximum(b, 1))
    vector = np.column_stack(
        [
            np.log(np.maximum(chars, 1) / np.maximum(n_words, 1)),
            share(symbols, n_words),
            share(lines[:, 1], lines[:, 0]),
            share(repeated, n_words),
            share(capitals, capitals + small),
            share(marks, n_words),
        ]
    )
    vector = np.round(vector * 4096) / 4096
    vectors = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * _DIMS, pa.int32()), pa.array(vector.ravel()))
    return pa.StructArray.from_arrays([pa.array(c) for c in (n_words, chars, symbols, lines[:, 1], repeated)] + [vectors], [*_NAMES, "vector"])


def base_failed(n_words: Column, repeated: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEATED * n_words)


def _distance(vector: Column, centre: Column, inverse: Column) -> Column:
    """Squared Mahalanobis distance, null without a centre."""
    x = [vector[i] - centre[i] for i in range(_DIMS)]
    terms = [x[i] * x[j] * inverse[i * _DIMS + j] * (1.0 if i == j else 2.0) for i in range(_DIMS) for j in range(i, _DIMS)]
    return reduce(operator.add, terms)


def _estimates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Centre, inverse scatter and size (logarithm of the determinant) of each group and start from its sums."""
    # A covariance of the inner share is too small by a known factor where vectors are normal.
    inner = quantile(1 - COVER, _DIMS)
    narrow = (1 - tail(inner, _DIMS + 2)) / COVER
    floor = np.diag(np.square(FLOOR))
    kind = pa.list_(pa.float64())
    for batch in batches:
        n = batch.column("n").to_numpy().astype(float)
        centre = batch.column("one").flatten().to_numpy().reshape(-1, _DIMS) / n[:, None]
        scatter = batch.column("two").flatten().to_numpy().reshape(-1, _DIMS, _DIMS) / n[:, None, None] - centre[:, :, None] * centre[:, None, :]
        scatter = scatter / narrow + floor
        inverse = np.linalg.inv(scatter)
        inverse = (inverse + inverse.transpose(0, 2, 1)) / 2
        found = [pa.array([x.ravel().tolist() for x in part], kind) for part in (centre, inverse)]
        found.append(pa.array(np.linalg.slogdet(scatter)[1]))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _KEY), *found], names=[*_KEY, "centre", "inverse", "size"])


def _fit(rows: DataFrame) -> DataFrame:
    """Centre, inverse scatter and size of groups of (g1, g2, start, vector)."""
    one = [F.sum(F.col("vector")[i]) for i in range(_DIMS)]
    two = [F.sum(F.col("vector")[i] * F.col("vector")[j]) for i in range(_DIMS) for j in range(i, _DIMS)]
    sums = rows.groupBy(*_KEY).agg(F.count("*").alias("n"), F.array(*one).alias("one"), F.array(*two).alias("half"))
    at = {pair: k for k, pair in enumerate((i, j) for i in range(_DIMS) for j in range(i, _DIMS))}
    both = [F.col("half")[at[min(i, j), max(i, j)]] for i in range(_DIMS) for j in range(_DIMS)]
    sums = sums.select(*_KEY, "n", "one", F.array(*both).alias("two"))
    shape = "g1 string, g2 string, start int, centre array<double>, inverse array<double>, size double"
    return kept(sums.mapInArrow(_estimates, shape), "rules-estimates")


def _middles(rows: DataFrame, values: Column) -> DataFrame:
    """The median of each coordinate of ``values`` by (g1, g2), as an array ``middle``."""
    one = rows.select("g1", "g2", F.posexplode(values).alias("dim", "value"))
    bins = one.groupBy("g1", "g2", "dim", F.floor(F.col("value") * FINE).alias("bin")).agg(F.count("*").alias("n"))
    line = Window.partitionBy("g1", "g2", "dim")
    upto = F.sum("n").over(line.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    upper = bins.withColumns({"upto": upto, "all": F.sum("n").over(line)}).where(2 * F.col("upto") >= F.col("all"))
    middle = upper.groupBy("g1", "g2", "dim").agg(((F.min("bin") + 0.5) / FINE).alias("middle"))
    both = middle.groupBy("g1", "g2").agg(F.sort_array(F.collect_list(F.struct("dim", "middle"))).alias("by_dim"))
    return kept(both.select("g1", "g2", F.col("by_dim.middle").alias("middle")), "rules-medians")


def _starts(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Estimates to begin at, of (g1, g2, t1, t2, vector): 0 of all texts, 1 of medians, and of drawn texts.

    They are written, so that Spark knows how few they are: it would send every vector to the task of its group to meet a
    table whose size it can only guess.
    """
    drawn = rows.join(sizes, ["g1", "g2"])
    mark = lambda k: F.pmod(F.xxhash64(F.lit(k), "t1", "t2"), F.col("n")) < DRAWN
    starts = F.array(F.lit(0), *(F.when(mark(k), F.lit(k)) for k in range(2, 2 + SEEDS)))
    fitted = _fit(drawn.select("g1", "g2", F.explode(F.array_compact(starts)).alias("start"), "vector"))

    medians = _middles(rows, F.col("vector"))
    apart = F.zip_with("vector", "middle", lambda x, m: F.abs(x - m))
    spread = _middles(rows.join(medians, ["g1", "g2"]), apart).withColumnRenamed("middle", "apart")
    # The median of a normal coordinate's distances is 0.6745 of its deviation.
    variance = [F.pow(F.col("apart")[i] / 0.6745, 2.0) + FLOOR[i] ** 2 for i in range(_DIMS)]
    inverse = F.array(*(1 / variance[i] if i == j else F.lit(0.0) for i in range(_DIMS) for j in range(_DIMS)))
    plain = medians.join(spread, ["g1", "g2"])
    of_medians = plain.select("g1", "g2", F.lit(1).alias("start"), F.col("middle").alias("centre"), inverse.alias("inverse"))
    return kept(fitted.drop("size").union(of_medians), "rules-starts")


def _measured(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    joined = rows.join(estimates.select(*_KEY, "centre", "inverse"), ["g1", "g2"])
    return joined.withColumn("d2", _distance(*map(F.col, ("vector", "centre", "inverse")))).drop("centre", "inverse")


def _groups(rows: DataFrame) -> DataFrame:
    """The group of estimates that each pair of language and source belongs to: l, s, g1, g2.

    ``rows`` has every text of a pair once. The texts "=" and "*" before a value tell a value from a null and from the rest.
    """
    by_source = kept(rows.groupBy("l", "s").agg(F.count("*").alias("n")), "rules-groups")
    large = F.col("n") >= LEAST_ROWS
    small = rows.join(by_source.where(~large).drop("n"), ["l", "s"], "left_semi").select("l", "t1", "t2").distinct()
    small = small.groupBy("l").agg((F.count("*") >= LEAST_ROWS).alias("enough"))
    largest = by_source.groupBy("l").agg(F.max(F.when(large, F.struct("n", "s"))).alias("largest"))
    rest = largest.join(small, "l", "left").withColumnRenamed("l", "rl")
    joined = by_source.join(rest, F.col("l") == F.col("rl"))
    enough = F.coalesce("enough", F.lit(False))
    g1 = F.when(large | enough | F.col("largest").isNotNull(), F.col("l")).otherwise("*")
    g2 = F.when(large, F.col("s")).when(enough, F.lit("*")).otherwise(F.coalesce("largest.s", F.lit("*")))
    return kept(joined.select("l", "s", g1.alias("g1"), g2.alias("g2")), "rules-members")


def _label(name: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("null"))


def fit_rules(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups and their estimates, from rows (l, s, t1, t2, vector) that pass the base rules."""
    rows = kept(rows.groupBy("l", "s", "t1", "t2").agg(F.first("vector").alias("vector")), "rules-texts")
    groups = _groups(rows)
    rows = rows.join(groups, ["l", "s"]).groupBy("g1", "g2", "t1", "t2").agg(F.first("vector").alias("vector"))
    rows = kept(rows, "rules-vectors")
    sizes = kept(rows.groupBy("g1", "g2").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_ROWS), "rules-sizes")
    estimates = _starts(rows, sizes)
    for _ in range(STEPS):
        measured = _measured(rows.drop("t1", "t2"), estimates).withColumn("bin", F.floor(32 * F.log(F.col("d2") + 1e-9)))
        bins = measured.groupBy(*_KEY, "bin").agg(F.count("*").alias("n"))
        group = Window.partitionBy(*_KEY)
        upto = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
        before = F.coalesce(upto, F.lit(0))
        inside = bins.withColumns({"before": before, "all": F.sum("n").over(group)}).where(F.col("before") < F.ceil(COVER * F.col("all")))
        last = kept(inside.groupBy(*_KEY).agg(F.max("bin").alias("last")), "rules-cover")
        estimates = _fit(measured.join(last, _KEY).where("bin <= last"))
    best = estimates.groupBy("g1", "g2").agg(F.min(F.struct("size", "start", "centre", "inverse")).alias("best"))
    best = best.select("g1", "g2", "best.centre", "best.inverse").join(sizes.drop("n"), ["g1", "g2"])
    return groups, kept(best, "rules-estimates")


def _judged(rows: DataFrame, groups: DataFrame, estimates: DataFrame) -> DataFrame:
    """Rows with __stats, and __l and __s, gain __kept."""
    g = groups.select(F.col("l").alias("__l"), F.col("s").alias("__s"), F.col("g1").alias("__g1"), F.col("g2").alias("__g2"))
    e = estimates.select(F.col("g1").alias("__g1"), F.col("g2").alias("__g2"), F.col("centre").alias("__centre"), F.col("inverse").alias("__inverse"))
    fitted = kept(g.join(e, ["__g1", "__g2"]).drop("__g1", "__g2"), "rules-fitted")
    joined = rows.join(fitted, ["__l", "__s"], "left")
    d2 = _distance(F.col("__stats.vector"), F.col("__centre"), F.col("__inverse"))
    failed = base_failed(F.col("__stats.n_words"), F.col("__stats.n_repeat_words"))
    return joined.withColumn("__d2", d2).withColumn("__kept", ~failed & (F.coalesce("__d2", F.lit(0.0)) <= quantile(CHANCE, _DIMS)))


def _named(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    # Called non-deterministic so that Spark does not copy the function into filters and run it twice.
    stats = text_stats.asNondeterministic()(filled(text))
    one, two = digests(filled(text))
    return bounded(docs).withColumns({"__stats": stats, "__l": _label(lang), "__s": _label(source), "__t1": one, "__t2": two})


def _fit_on(named: DataFrame) -> tuple[DataFrame, DataFrame]:
    sound = named.where(~base_failed(F.col("__stats.n_words"), F.col("__stats.n_repeat_words")))
    names = [F.col(f"__{c}").alias(c) for c in ("l", "s", "t1", "t2")]
    return fit_rules(sound.select(*names, F.col("__stats.vector").alias("vector")))


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """Per document: id, the counts, base_failed, kept and distance (squared; null where no group was large enough).

    Null texts count as empty, and fail the base rules. Null languages and sources are a group of their own.
    Estimates come from all texts that pass the base rules, copies counted once, and judge every row; a pair of language and
    source with fewer than LEAST_ROWS of them joins the rest of its language; a rest with fewer joins the largest group of its language, or
    the rest of all where it has no group, and if even this is too small the base rules alone decide. Repeated rows are each listed. An empty table gives an empty one.
    """
    slim = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    stats = kept(_named(slim, "text", "lang", "source").select("__id", "__stats", "__l", "__s", "__t1", "__t2"), "rules-stats")
    judged = _judged(stats, *_fit_on(stats))
    counts = [F.col(f"__stats.{c}").alias(c) for c in _NAMES]
    failed = base_failed(F.col("__stats.n_words"), F.col("__stats.n_repeat_words"))
    return judged.select(F.col("__id").alias(doc_id), *counts, failed.alias("base_failed"), F.col("__kept").alias("kept"), F.col("__d2").alias("distance"))


def passing(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, all columns as they were.

    Texts are read twice, which costs less than shuffling them by an id that need not be unique.
    Columns may have any name but those that begin with two underscores.
    """
    named = _named(docs, text, lang, source)
    fitted = _fit_on(kept(named.select("__stats", "__l", "__s", "__t1", "__t2"), "rules-stats"))
    return _judged(named, *fitted).where("__kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_quality_rules(docs: DataFrame) -> DataFrame:
    return judge(docs).drop("distance")
