"""Exact Jaccard self-join of documents on word shingles, and its connected classes.

Candidates come from a pigeonhole over a partition of the universe of shingles. In a band
of set sizes, two sets with the wanted similarity differ in at most H shingles. Shingles are
hashed into m > H segments, so such sets agree in a segment whole, or almost whole:

* every non-empty segment of a set is indexed by the hash of its subset of shingles;
* empty segments are never indexed, since they would agree everywhere. A set that has
  more than H non-empty segments is found by them alone. Any other set also indexes the
  one-deletion neighbourhood of each of its segments, which counts as a second unit of
  difference there. Sets too lopsided even for that share one bucket of their band;
* m is allocated by cost: of all m > H it is the one with the fewest index rows expected,
  weighing segments against the deletion rows of the sets that would need them.

Equal sets are one node from the start, and a bucket is never expanded into all its pairs. One
member of each bucket, the one that lies in most buckets, meets the others; sets found similar are
merged into classes, and a bucket whose other members are of one class is done. Members of the
rest are not similar to the middle of their group: texts from one template, say, that each fill it in
otherwise. They are indexed a second time, by what few of them hold (a shingle is *rare* if RARE of them have it at most):

* Two sets that share a rare shingle have one among the rarest of both, as many as a set can miss of a similar one and
  one more. These are indexed as they are, and their buckets hold RARE sets at most.
* Two sets that share none differ in all the rare shingles of both, which uses up most of what they may differ in.
  Their other shingles are hashed into segments for what is left, on a level for each number of rare
  shingles, and subsets of several segments are indexed, of as many as leave a bounded number of rows: with little
  left to differ in, nearly all of the set must agree.

In these buckets a number of leaders that grows by the round meets the
members of other classes, until each bucket is of one class. So near copies cost one
comparison each, texts of one template that are not similar seldom meet, and no pair of different classes that could be
similar is left unverified.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm import bytescan as bs
from tripweave.llm.common import Steps, bounded, filled, kept
from tripweave.llm.components import components
from tripweave.llm.shingles import Words, shingle_sets

BAND_RATIO = 1.5  # of the first index; a set lies in two bands at most
FIRST_SLOTS = 256  # leaders that a bucket of rare shingles has at most in the first round
MORE_SLOTS = 8  # times as many in each round after
RARE = 32  # sets that have a shingle which counts as rare
SUBSETS = 32  # rows of a set on one level of the second index, where one segment each would be fewer
NARROW = 1.05  # size bands of the second index
TEAM = 1000  # members compared with one leader in one task
_DEEP = bs.U64(0x5851F42D4C957F2D)


class Bands:
    """Size bands, and for each of the first index (no ``ratio`` given) the number of segments."""

    def __init__(self, percent: int, ratio: float | None = None) -> None:
        self.percent = percent
        self._allocates = ratio is None
        self._ratio = ratio or max(BAND_RATIO, 110 / percent)
        self.low = [1]
        self.segments: list[int] = []

    def reach(self, size: int) -> None:
        while self.low[-1] <= size:
            low = self.low[-1]
            self.low.append(max(low + 1, math.ceil(low * self._ratio)))
            if self._allocates:
                self.segments.append(self._allocate(self.low[-1] - 1))

    def most_apart(self, size, partner):
        return (100 - self.percent) * (size + partner) // (100 + self.percent)

    def _allocate(self, size: int) -> int:
        """The number of segments for which a set of ``size`` has the fewest rows expected."""
        least = self.most_apart(size, size) + 1
        best, at = math.inf, least
        for m in range(least, least + 8 + least // 4):
            empty = m * math.exp(-size / m)
            spare, term, fit = m - least, math.exp(-empty), 0.0
            for k in range(spare + 1):
                fit += term
                term *= empty / (k + 1)
            cost = m - empty + max(0.0, 1 - fit) * size
            if cost < best:
                best, at = cost, m
        return at


def _set_names(row: np.ndarray, h: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size of each set, and a hash of it that does not depend on order."""
    size = np.bincount(row - i, minlength=j - i)
    total = np.zeros(j - i, bs.U64)
    some = np.flatnonzero(size)
    if len(some):
        total[some] = np.add.reduceat(bs.mix(h ^ _DEEP), (np.cumsum(size) - size)[some])
    return size, bs.mix(total + bs.mix(size.astype(bs.U64))), some


def _names(words: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Words()
        for batch in batches:
            raw, at = bs.buffer_of(batch.column("text"))
            tie, t = batch.column("tie"), batch.column("t")
            for i, j, rows, hashes in finder.of(raw, at):
                size, name, _ = _set_names(*shingle_sets(rows, hashes, i, j, words), i, j)
                yield pa.RecordBatch.from_arrays(
                    [tie.slice(i, j - i), t.slice(i, j - i), pa.array(size.astype(np.int64)), pa.array(bs.signed(name))],
                    names=["tie", "t", "n", "s"],
                )

    return scan


def _index(words: int, percent: int):
    """Index rows (key, s) of every non-empty set."""

    def rows_of(row, h, i, j, bands: Bands):
        size, name, _ = _set_names(row, h, i, j)
        bands.reach(int(size.max(initial=0)) * 2 + 2)
        low, segments = np.array(bands.low), np.array(bands.segments)
        band = np.searchsorted(low, size, "right") - 1
        partner = size * 100 // percent
        first = np.cumsum(size) - size
        own = np.flatnonzero(size)
        over = own[partner[own] >= low[band[own] + 1]]
        doc = np.concatenate([own, over])
        if not len(doc):
            return None
        in_band = np.concatenate([band[own], band[over] + 1])
        m, n = segments[in_band], size[doc]
        each = np.repeat(np.arange(len(doc)), n)
        token = h[np.repeat(first[doc], n) + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)]
        cell = each * (1 << 32) + ((token >> bs.U64(16)) % m[each].astype(bs.U64)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        cell, token, each = cell[order], bs.mix(token[order]), each[order]
        head = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        count = np.diff(np.append(head, len(cell)))
        total = np.add.reduceat(token, head)
        whose = each[head]
        salt = bs.mix(in_band[whose].astype(bs.U64) * bs.U64(1 << 32) + (cell[head] & 0xFFFFFFFF).astype(bs.U64))
        key = [bs.mix(total + salt)]
        s = [name[doc[whose]]]
        filled_segments = np.bincount(whose, minlength=len(doc))
        units = filled_segments + np.bincount(whose, weights=count > 1, minlength=len(doc)).astype(np.int64)
        most = bands.most_apart(n, np.minimum(partner[doc], low[in_band + 1] - 1))
        needs = filled_segments <= most
        if needs.any():
            cells = np.repeat(np.arange(len(head)), count)
            less = needs[each] & (count[cells] > 1)
            key.append(bs.mix(total[cells[less]] - token[less] + salt[cells[less]]))
            s.append(name[doc[each[less]]])
            deep = np.flatnonzero(units <= most)
            key.append(bs.mix(_DEEP + in_band[deep].astype(bs.U64)))
            s.append(name[doc[deep]])
        return bs.signed(np.concatenate(key)), bs.signed(np.concatenate(s))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, bands = Words(), Bands(percent)
        for batch in batches:
            raw, at = bs.buffer_of(batch.column("text"))
            for i, j, rows, hashes in finder.of(raw, at):
                found = rows_of(*shingle_sets(rows, hashes, i, j, words), i, j, bands)
                if found is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["key", "s"])

    return scan


def _verify(words: int, percent: int):
    """Compare each member with its leader, which comes first in its team."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, team, lead = Words(), None, None
        for batch in batches:
            raw, at = bs.buffer_of(batch.column("text"))
            leader, salt, s = (batch.column(c).to_numpy() for c in ("leader", "salt", "s"))
            a, b = [], []
            for i, j, rows, hashes in finder.of(raw, at):
                row, h = shingle_sets(rows, hashes, i, j, words)
                cut = np.searchsorted(row, np.arange(i, j + 1))
                for r in range(i, j):
                    own = h[cut[r - i] : cut[r - i + 1]]
                    if s[r] == leader[r]:
                        team, lead = (leader[r], salt[r]), own
                        continue
                    if team != (leader[r], salt[r]):
                        raise RuntimeError("a member came before its leader")
                    if 100 * min(len(own), len(lead)) < percent * max(len(own), len(lead)):
                        continue
                    place = np.searchsorted(lead, own)
                    place[place == len(lead)] = 0
                    common = int((lead[place] == own).sum())
                    if 100 * common >= percent * (len(own) + len(lead) - common):
                        a.append(leader[r])
                        b.append(s[r])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int, steps: Steps) -> DataFrame:
    """Pairs (leader, s) whose sets are similar enough. Large followings are split into teams."""
    teams = steps.kept(pairs.groupBy("leader").agg(F.ceil(F.count("*") / TEAM).alias("teams")), "sets-teams")
    members = pairs.join(teams, "leader").withColumn("salt", F.pmod(F.xxhash64("s", "leader"), "teams")).drop("teams")
    leaders = members.select("leader", F.col("leader").alias("s"), "salt").distinct()
    seats = members.select("leader", "s", "salt").union(leaders)
    seated = seats.join(texts, "s")
    order = ["leader", "salt", F.col("s") != F.col("leader"), "s"]
    placed = seated.repartition("leader", "salt").sortWithinPartitions(*order).select("leader", "salt", "s", "text")
    return placed.mapInArrow(_verify(words, percent), "a long, b long")


def _tokens(words: int):
    """The shingles of each set."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Words()
        for batch in batches:
            raw, at = bs.buffer_of(batch.column("text"))
            names = batch.column("s").to_numpy()
            for i, j, rows, hashes in finder.of(raw, at):
                row, h = shingle_sets(rows, hashes, i, j, words)
                n = np.bincount(row - i, minlength=j - i)
                yield pa.RecordBatch.from_arrays([pa.array(names[row]), pa.array(n[row - i]), pa.array(bs.signed(h))], names=["s", "n", "h"])

    return scan


def _subsets(budget: int) -> tuple[int, np.ndarray]:
    """Segments for sets that differ in ``budget`` of them at most, and the subsets of segments of which they agree in one."""
    together = 1  # sets that may not differ at all agree in the one segment there is
    while budget and math.comb(budget + together + 1, together + 1) <= SUBSETS:
        together += 1
    segments = budget + together
    return segments, np.array(list(combinations(range(segments), together)))


def _levels(rare: np.ndarray | int) -> np.ndarray | int:
    """The level of a number of rare shingles: the number itself, and ever wider steps beyond 32."""
    wide = np.floor(np.log(np.maximum(rare, 32) / 32) / math.log(1.1)).astype(int)
    return np.where(np.asarray(rare) < 32, rare, 32 + wide)


def _least_rare(level: int) -> int:
    return level if level < 32 else math.ceil(32 * 1.1 ** (level - 32) - 1e-9)


def _common_segments(percent: int, owned: dict[int, list[int]]):
    """Index rows (key, s, n, i, leads, owns) by the shingles of a set that are not rare.

    A pair without a shared rare shingle meets in the size band of the larger set, which leads there, on the level of the one
    with fewer rare shingles, which owns it. ``owned`` has the levels that occur in each band.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, plans = Bands(percent, NARROW), {}
        for batch in batches:
            names, sizes, rares = (batch.column(c).to_numpy() for c in ("s", "n", "r"))
            common = batch.column("common")
            flat, at = common.values.to_numpy(), common.offsets.to_numpy()
            bands.reach(int(sizes.max(initial=1)) * 100 // percent + 1)
            low = np.array(bands.low)
            first = np.searchsorted(low, sizes, "right") - 1
            last = np.searchsorted(low, sizes * 100 // percent, "right") - 1
            levels = _levels(rares)
            key, who, lead, own = [], [], [], []
            for x in range(batch.num_rows):
                token = flat[at[x] : at[x + 1]].astype(np.int64).view(bs.U64)
                for b in range(first[x], last[x] + 1):
                    top = int(low[b + 1]) - 1
                    for level in owned.get(b, ()):
                        if level > levels[x]:
                            break
                        fewest = _least_rare(level)
                        most = bands.most_apart(top, min(top, int(sizes[x]) * 100 // percent))
                        budget = bands.most_apart(top, top) - 2 * fewest
                        if budget < 0 or most < fewest + rares[x]:
                            continue
                        if budget not in plans:
                            plans[budget] = _subsets(budget)
                        segments, subsets = plans[budget]
                        salt = bs.mix(np.array([b * 4096 + level], bs.U64))
                        cell = ((token >> bs.U64(16)) % bs.U64(segments)).astype(np.int64)
                        total = np.zeros(segments, bs.U64)
                        np.add.at(total, cell, bs.mix(token + salt))
                        found = bs.mix(total[subsets].sum(axis=1, dtype=bs.U64) + bs.mix(np.arange(len(subsets), dtype=bs.U64) + salt))
                        # Subsets without a shingle would agree everywhere; a set that has them is beside all others that do.
                        some = np.bincount(cell, minlength=segments)[subsets].sum(axis=1) > 0
                        found = found[some]
                        if not some.all():
                            found = np.append(found, bs.mix(salt + _DEEP))
                        key.append(found)
                        who.append(np.full(len(found), x))
                        lead.append(np.full(len(found), b == first[x]))
                        own.append(np.full(len(found), level == levels[x]))
            if key:
                who = np.concatenate(who)
                columns = [bs.signed(np.concatenate(key)), names[who], sizes[who], rares[who].astype(np.int64) + 1, np.concatenate(lead), np.concatenate(own)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "s", "n", "i", "leads", "owns"])

    return run


def _second_index(texts: DataFrame, words: int, percent: int, steps: Steps) -> DataFrame:
    """Index rows (key, s, n, i, leads, owns) of the sets that the first round left: ``i`` - 1 of a set's shingles are not shared with those it meets here.

    Shingles of one set alone come first among the rarest; nothing meets there, so they are only counted.
    """
    tokens = texts.mapInArrow(_tokens(words), "s long, n long, h long")
    often = steps.kept(tokens.groupBy("h").agg(F.count("*").alias("f")).where("f > 1"), "sets-often")
    ordered = tokens.join(often, "h", "left").groupBy("s", "n")
    ordered = ordered.agg(F.sort_array(F.collect_list(F.when(F.col("f").isNotNull(), F.struct("f", "h")))).alias("held"))
    ordered = ordered.withColumn("alone", F.col("n") - F.size("held"))
    ordered = steps.kept(ordered.withColumn("r", F.col("alone") + F.size(F.filter("held", lambda t: t["f"] <= RARE))), "sets-ordered")

    length = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - F.col("alone")
    prefix = ordered.select("s", "n", "alone", F.posexplode(F.slice("held", F.lit(1), F.greatest(length, F.lit(0)).cast("int"))).alias("i", "t"))
    rare = prefix.where(F.col("t.f") <= RARE).select(F.col("t.h").alias("key"), "s", "n", (F.col("alone") + F.col("i") + 1).alias("i"))

    common = ordered.select("s", "n", "r", F.transform(F.filter("held", lambda t: t["f"] > RARE), lambda t: t["h"]).alias("common"))
    # A band has as many levels as its sets may differ in, there are as many bands as the sizes have digits, times fifty.
    owned: dict[int, set[int]] = {}
    bands = Bands(percent, NARROW)
    # The set of a pair that has fewer rare shingles has no more than half of what the larger may differ in.
    half = F.col("r") * percent * (100 + percent) <= F.col("n") * 100 * (100 - percent)
    for row in ordered.where(half).groupBy("n").agg(F.collect_set("r").alias("r")).toLocalIterator():
        bands.reach(row.n * 100 // percent + 1)
        low = np.array(bands.low)
        for b in range(int(np.searchsorted(low, row.n, "right")) - 1, int(np.searchsorted(low, row.n * 100 // percent, "right"))):
            owned.setdefault(b, set()).update(int(_levels(r)) for r in row.r)
    levels = {b: sorted(x) for b, x in owned.items()}
    rows = common.mapInArrow(_common_segments(percent, levels), "key long, s long, n long, i long, leads boolean, owns boolean")
    rows = steps.kept(rows, "sets-segments")
    met = rows.groupBy("key").agg((F.bool_or("leads") & F.bool_or("owns") & (F.min("s") < F.max("s"))).alias("open")).where("open").select("key")
    both = F.lit(True)
    return rare.withColumns({"leads": both, "owns": both}).unionByName(rows.join(steps.kept(met, "sets-met"), "key", "left_semi"))


def _with_class(rows: DataFrame, classes: DataFrame | None) -> DataFrame:
    """Rows with p, the class of their set."""
    if classes is None:
        return rows.withColumn("p", F.col("s"))
    named = classes.select(F.col("u").alias("s"), F.col("p").alias("q"))
    return rows.join(named, "s", "left").withColumn("p", F.coalesce("q", "s")).drop("q")


def linked_sets(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Names of the sets of all documents, and the class of every set that is linked with another.

    ``docs`` has text, tie (tells documents apart) and t (a hash of the text). The first result has
    tie, t, n (set size) and s (set name); the second u (set name) and p (least set name of its class).
    """
    steps = Steps(docs.sparkSession)
    docs = bounded(docs).select("text", "tie", "t")
    names = docs.mapInArrow(_names(words), f"tie {docs.schema['tie'].dataType.simpleString()}, t long, n long, s long")
    names = kept(names, "sets-names")
    index = docs.select("text").mapInArrow(_index(words, percent), "key long, s long")
    shared = index.groupBy("key").agg((F.min("s") < F.max("s")).alias("several")).where("several").select("key")
    bucket = steps.kept(index.join(steps.kept(shared, "sets-shared"), "key", "left_semi").distinct(), "sets-buckets")

    one = names.groupBy("s").agg(F.min(F.struct("tie", "t")).alias("one")).join(bucket.select("s").distinct(), "s", "left_semi")
    one = one.select(F.col("s").alias("one_s"), F.col("one.tie").alias("one_tie"), F.col("one.t").alias("one_t"))
    found = docs.join(one, F.col("tie").eqNullSafe(F.col("one_tie")) & (F.col("t") == F.col("one_t")))
    texts = steps.kept(found.select(F.col("one_s").alias("s"), "text"), "sets-texts")

    # First round: the member of each bucket that lies in most buckets, and so nearest to the middle of its group, meets the others.
    degree = bucket.groupBy("s").agg(F.count("*").alias("d"))
    ranked = steps.kept(bucket.join(degree, "s"), "sets-ranked")
    leaders = steps.kept(ranked.groupBy("key").agg(F.max(F.struct("d", "s")).alias("l")).select("key", F.col("l.s").alias("leader")), "sets-leaders")
    met = ranked.join(leaders, "key").where("s <> leader")
    pairs = steps.kept(met.select("leader", "s").distinct(), "sets-pairs")
    classes = components(steps.kept(_verified(pairs, texts, words, percent, steps), "sets-links"))
    rest = _with_class(met.select("key", "s"), classes)
    several = rest.groupBy("key").agg((F.min("p") < F.max("p")).alias("several")).where("several").select("key")
    hard = rest.join(steps.kept(several, "sets-open"), "key", "left_semi").select("s").distinct()

    # What is left is indexed again, by what few of it hold, and compared bucket by bucket.
    bucket = steps.kept(_second_index(steps.kept(texts.join(hard, "s", "left_semi"), "sets-hard"), words, percent, steps), "sets-prefixes")
    seen, slots = pairs, FIRST_SLOTS
    while True:
        bucket = _with_class(bucket, classes)
        several = bucket.groupBy("key").agg((F.bool_or("leads") & F.bool_or("owns") & (F.min("p") < F.max("p"))).alias("several")).where("several").select("key")
        bucket = steps.kept(bucket.join(steps.kept(several, "sets-open"), "key", "left_semi"), "sets-buckets")
        if bucket.isEmpty():
            break
        slot = F.pmod(F.xxhash64("s", "key"), F.lit(slots))
        chosen = bucket.where("leads").groupBy("key", slot.alias("slot")).agg(F.min(F.struct("s", "p", "n", "i", "owns")).alias("l"))
        chosen = chosen.select("key", F.col("l.s").alias("leader"), F.col("l.p").alias("lp"), F.col("l.n").alias("ln"), F.col("l.i").alias("li"), F.col("l.owns").alias("lowns"))
        chosen = steps.kept(chosen, "sets-leaders")
        # Where this is the first shingle two sets share, they share no more than follow it in both.
        enough = (F.least(F.col("n") - F.col("i"), F.col("ln") - F.col("li")) + 1) * (100 + percent) >= percent * (F.col("n") + F.col("ln"))
        leading = chosen.select("key", F.col("leader").alias("s"))
        # A pair of two leaders is met from both sides: keep one.
        met = bucket.join(chosen, "key").where((F.col("lp") != F.col("p")) & (F.col("owns") | F.col("lowns")) & enough)
        met = met.join(leading.withColumn("leading", F.lit(True)), ["key", "s"], "left").where("leading is null or leader < s")
        done = seen.union(seen.select(F.col("s").alias("leader"), F.col("leader").alias("s")))
        pairs = steps.kept(met.select("leader", "s").distinct().join(done, ["leader", "s"], "left_anti"), "sets-pairs")
        if not pairs.isEmpty():
            seen = seen.union(pairs)
            links = steps.kept(_verified(pairs, texts, words, percent, steps), "sets-links")
            classes = classes if links.isEmpty() else components(links, classes)
        # The leaders have met everyone.
        bucket = steps.kept(bucket.join(leading, ["key", "s"], "left_anti").drop("p"), "sets-rest")
        slots *= MORE_SLOTS
    classes = kept(classes, "sets-classes")
    steps.clear()
    return names, classes


def with_components(docs: DataFrame, words: int = 3, percent: int = 90, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: its id, n_shingles, component_id (least id linked with it, itself included) and t.

    Documents link when 100 times the shingles they share is at least ``percent`` times those of either.
    A text of fewer words than a shingle has one shingle of them all; one without words, or a null,
    links with nothing and is its own component. Rows with the same id are documents of their own;
    null ids count as larger than any other. An empty table gives an empty one.
    """
    plain = docs.select(filled(text).alias("text"), F.col(doc_id).alias("tie"), F.xxhash64(filled(text)).alias("t"))
    names, classes = linked_sets(plain, words, percent)
    root = F.when(F.col("n") > 0, F.coalesce("p", "s"))
    rooted = names.join(classes, names.s == classes.u, "left").select("tie", "t", "n", root.alias("root"))
    least = kept(rooted.where("root is not null").groupBy("root").agg(F.min("tie").alias("least")), "sets-least")
    out = rooted.join(least, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("tie")).otherwise(F.col("least"))
    return out.select(F.col("tie").alias(doc_id), "t", F.col("n").alias("n_shingles"), component.alias("component_id"), "root")


def op10_ngram_join(docs: DataFrame) -> DataFrame:
    return with_components(docs.select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class the document with the least id stays.

    Documents without words are no duplicates of each other and all stay. Of rows equal in id and
    text one stays. All columns pass through, whatever their names but those that begin with two underscores.
    """
    found = with_components(docs, words, percent, text, doc_id)
    keep = found.where("root is not null").groupBy("root").agg(F.min(F.struct(F.col(doc_id), F.col("t"))).alias("one")).select("one.*")
    keep = keep.select(F.col(doc_id).alias("__id"), F.col("t").alias("__t"))
    named = docs.withColumn("__hash", F.xxhash64(filled(text)))
    worded = named.where(F.regexp_like(filled(text), F.lit(r"[^\x20\x09-\x0D]")))
    wordless = named.where(~F.regexp_like(filled(text), F.lit(r"[^\x20\x09-\x0D]")))
    same = F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__t"))
    stays = worded.join(keep, same).drop("__id", "__t")
    copies = Window.partitionBy(doc_id, "__hash").orderBy("__hash")
    stays = stays.withColumn("__copy", F.row_number().over(copies)).where("__copy = 1").drop("__copy")
    return stays.unionByName(wordless).drop("__hash")
