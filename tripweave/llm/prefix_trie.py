"""The trie of conversations' beginnings, with totals of its subtrees by time-forward processing.

A node is named by its depth and two 64-bit sums over its turns, each of a hash of depth, role and text. Sums can be carried
from one stretch of a conversation to the next, so a conversation of any length is read by many tasks
(``tripweave.operators.slices``).

Totals. A node with one member is the top of a path, whose totals are known. Of the other, *shared*, nodes
those with at most SHARD_ROWS turns below them, counted by members, are *light*. A light node whose parent is not light is
the root of a shard. Shards go to tasks whole and are read in reverse level order, sorted outside memory: each
node takes what its children sent from a priority queue that spills to disk, and sends its totals to its parent,
which comes later. The totals of shard roots are added up per parent and enter the nodes above, which
are read in the same way by one task. On each level there are at most (turns of all conversations) / SHARD_ROWS of these.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import digests, filled, kept
from tripweave.operators.slices import SLICE, all_columns, in_order, sliced

# How conversations are rebuilt.
SHARING = 5
HEADS = 9

#: A shard holds at most so many turns, counted once for each conversation.
SHARD_ROWS = 100_000
#: Messages that a queue holds in memory, and those read back at once.
HELD = 200_000
READ_BACK = 4096

KEY = ["depth", "k1", "k2"]
PARENT = ["p1", "p2"]
LANE = (1 << 32) - 1


def _carried(cut: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Totals over each conversation's rows in earlier slices, for those that began there: at most one per slice."""
    parts = cut.groupBy(SLICE, "c").agg(*[v.alias(name) for name, v in sums.items()], F.count_if(all_columns(cut)).alias("rows"))
    before = Window.partitionBy("c").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    earlier = parts.select(SLICE, "c", *[F.sum(name).over(before).alias(f"{name}_before") for name in sums], F.sum("rows").over(before).alias("rows_before"))
    return F.broadcast(earlier.where("rows_before > 0"))


def _placed(conversations: DataFrame) -> DataFrame:
    """(c, i, d1, d2, bytes): turns with their place i in their conversation, from 1, and digests of role and text."""
    turn = F.struct(filled("role"), filled("text"))
    d1, d2 = digests(turn)
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("c"), F.col("turn"), d1.alias("d1"), d2.alias("d2"), F.octet_length(filled("text")).cast("bigint").alias("bytes")
    )
    cut = sliced(rows, ["c", "turn", "d1", "d2"])
    placed = cut.withColumn("i", F.row_number().over(in_order(["turn", "d1", "d2"], "c")).cast("bigint"))
    placed = placed.join(_carried(cut, {}), [SLICE, "c"], "left")
    return placed.select("c", (F.col("i") + F.coalesce("rows_before", F.lit(0))).alias("i"), "d1", "d2", "bytes")


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: (c, length) of each, and (c, length, depth, d1, d2, bytes) of their turns."""
    sizes = turns.groupBy("c").agg(F.max("i").alias("size"))
    heads = F.crc32(F.col("c").cast("string")) % HEADS
    base = F.col("c") - F.col("c") % SHARING
    convs = sizes.select("c", "size", heads.alias("h"), base.alias("base")).join(sizes.select(F.col("c").alias("base"), F.col("size").alias("base_size")), "base", "left")
    convs = convs.withColumn("taken", F.least("h", F.coalesce("base_size", F.lit(0))))
    convs = kept(convs.select("c", "h", "base", "taken", (F.col("taken") + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("length")), "trie-convs")
    own = turns.join(convs, "c").where(F.col("i") > F.col("h")).withColumn("depth", F.col("i") - F.col("h") + F.col("taken"))
    first = turns.where(F.col("i") < HEADS).withColumnRenamed("c", "base")
    shared = convs.where("taken > 0").join(first, "base").where(F.col("i") <= F.col("taken")).withColumn("depth", F.col("i"))
    columns = ["c", "length", "depth", "d1", "d2", "bytes"]
    return convs.select("c", "length"), own.select(columns).unionByName(shared.select(columns))


def _paths(rebuilt: DataFrame) -> DataFrame:
    """Every turn of a rebuilt conversation with the names of its node and of the node above."""
    a, b = F.xxhash64("depth", "d1", "d2"), F.xxhash64(F.lit("second"), "depth", "d1", "d2")
    lanes = {"a0": a.bitwiseAND(LANE), "a1": F.shiftrightunsigned(a, 32), "b0": b.bitwiseAND(LANE), "b1": F.shiftrightunsigned(b, 32)}
    cut = sliced(rebuilt.withColumns(lanes).drop("d1", "d2"), ["c", "depth"])
    so_far = in_order(["depth"], "c").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = cut.withColumns({f"{x}_sum": F.sum(x).over(so_far) for x in lanes}).join(_carried(cut, {x: F.sum(x) for x in lanes}), [SLICE, "c"], "left")

    def name(low: str, high: str, without_own: bool) -> Column:
        def lane(x: str) -> Column:
            up_to = F.col(f"{x}_sum") + F.coalesce(f"{x}_before", F.lit(0))
            return (up_to - F.col(x) if without_own else up_to).bitwiseAND(LANE)

        return F.shiftleft(lane(high), 32).bitwiseOR(lane(low))

    return summed.select(
        "c", "length", "depth", "bytes",
        name("a0", "a1", False).alias("k1"), name("b0", "b1", False).alias("k2"),
        name("a0", "a1", True).alias("p1"), name("b0", "b1", True).alias("p2"),
    )


def _nodes(convs: DataFrame, paths: DataFrame) -> DataFrame:
    """Every node with its members counted, its children, and the turns below it."""
    zero = F.lit(0).cast("bigint")
    root = convs.select("c", "length", zero.alias("depth"), zero.alias("bytes"), zero.alias("k1"), zero.alias("k2"), zero.alias("p1"), zero.alias("p2"))
    members = paths.unionByName(root)
    nodes = members.groupBy(*KEY).agg(
        F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.sum(F.col("length") - F.col("depth")).alias("below"),
    )
    nodes = kept(nodes, "trie-nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") > 1).alias("n_shared"))
    joined = nodes.join(children, KEY, "left").withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("n_children", "n_shared")})
    return kept(joined, "trie-nodes")


class SpillingQueue:
    """A priority queue of tuples, least first, that keeps at most ``held`` of them in memory besides what it reads back."""

    def __init__(self, held: int = HELD) -> None:
        self._held = held
        self._heap: list[tuple] = []
        self._runs: list[tuple] = []
        self._numbers = itertools.count()

    def push(self, item: tuple) -> None:
        heapq.heappush(self._heap, item)
        if len(self._heap) > self._held:
            run = tempfile.TemporaryFile()
            items = sorted(self._heap)
            for i in range(0, len(items), READ_BACK):
                pickle.dump(items[i : i + READ_BACK], run)
            run.seek(0)
            self._heap = []
            self._advance(self._read(run))

    @staticmethod
    def _read(run) -> Iterator[tuple]:
        with run:
            while True:
                try:
                    yield from pickle.load(run)
                except EOFError:
                    return

    def _advance(self, rest: Iterator[tuple]) -> None:
        if (first := next(rest, None)) is not None:
            heapq.heappush(self._runs, (first, next(self._numbers), rest))

    def least(self) -> tuple | None:
        heads = [x[0] for x in (self._heap, [r[0] for r in self._runs[:1]]) if x]
        return min(heads, default=None)

    def pop(self) -> tuple:
        if self._runs and (not self._heap or self._runs[0][0] < self._heap[0]):
            first, _, rest = heapq.heappop(self._runs)
            self._advance(rest)
            return first
        return heapq.heappop(self._heap)


TOTALS = "depth bigint, k1 bigint, k2 bigint, leaves bigint, saved bigint"


def _time_forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of nodes that come in reverse level order, all nodes below one before it unless they are counted in it already."""
    queue = SpillingQueue()
    for batch in batches:
        rows = batch.to_pydict()
        leaves, saved = rows["leaves"], rows["saved"]
        for i, (depth, k1, k2, p1, p2, top) in enumerate(zip(*(rows[c] for c in ("depth", "k1", "k2", "p1", "p2", "top")))):
            here = (-depth, k1, k2)
            while (message := queue.least()) is not None and message[:3] == here:
                queue.pop()
                leaves[i] += message[3]
                saved[i] += message[4]
            if not top:
                queue.push((1 - depth, p1, p2, leaves[i], saved[i]))
        yield pa.RecordBatch.from_arrays([pa.array(rows[c], pa.int64()) for c in ("depth", "k1", "k2", "leaves", "saved")], ["depth", "k1", "k2", "leaves", "saved"])


def _totals(nodes: DataFrame, paths: DataFrame, shard_rows: int) -> DataFrame:
    """Leaves and saved tokens below every shared node, itself included."""
    own_leaves = F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_children") - F.col("n_shared"))
    shared = nodes.where("n_convs > 1").select(
        *KEY, *PARENT, "conv_id", (F.col("below") <= shard_rows).alias("light"), own_leaves.cast("bigint").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")
    )
    light, above = shared.where("light"), shared.where("not light")
    # The shard of a light node is named by the first light node on the way to it, which its least member passes too.
    owners = light.select(F.col("conv_id").alias("c")).distinct()
    first = paths.select("c", *KEY).join(owners, "c", "left_semi").join(light.select(*KEY), KEY).groupBy("c").agg(F.min(F.struct(*KEY)).alias("first"))
    root_is_light = nodes.where("depth = 0").select(F.col("below") <= shard_rows).scalar()
    root = F.struct(*[F.lit(0).cast("bigint").alias(c) for c in KEY])
    in_shards = light.join(first.withColumnRenamed("c", "conv_id"), "conv_id", "left").withColumn("shard", F.when(root_is_light, root).otherwise(F.col("first")))
    in_shards = in_shards.withColumn("top", F.struct(*KEY) == F.col("shard"))
    order = [F.desc("depth"), F.asc("k1"), F.asc("k2")]
    read = [*KEY, *PARENT, "leaves", "saved", "top"]
    shards = in_shards.repartition("shard").sortWithinPartitions(*order).select(read).mapInArrow(_time_forward, TOTALS)
    shards = kept(shards, "trie-shards")
    roots = in_shards.where("top").select(*KEY, *PARENT).join(shards, KEY)
    sent = roots.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    above = above.join(sent, KEY, "left").withColumns({c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("leaves", "saved")})
    across = above.withColumn("top", F.col("depth") == 0).select(read).repartition(1).sortWithinPartitions(*order).mapInArrow(_time_forward, TOTALS)
    return shards.unionByName(across)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, joined by commas; a node's pieces come one after another."""
    key, digest = None, None
    for batch in batches:
        done = []
        for *name, piece in zip(*(batch.column(c).to_pylist() for c in (*KEY, "piece"))):
            if name != key:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = name, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(piece.encode())
        yield _digests(done)
    if key is not None:
        yield _digests([(*key, digest.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 4
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*KEY, "ends_sha256"])


def _ends(convs: DataFrame, paths: DataFrame) -> DataFrame:
    """The digest of the conversations that end at a node. Slices write their ids out, and one task per node joins one piece of each slice."""
    zero = F.lit(0).cast("bigint")
    turnless = convs.where("length = 0").select("c", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"))
    ends = paths.where(F.col("depth") == F.col("length")).select("c", *KEY).unionByName(turnless)
    cut = sliced(ends, [*KEY, "c"])
    ids = F.transform(F.sort_array(F.collect_list("c")), lambda c: c.cast("string"))
    pieces = cut.groupBy(SLICE, *KEY).agg(F.array_join(ids, ",").alias("piece"))
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, SLICE).select(*KEY, "piece").mapInArrow(_hashed, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per node; see ``op12_prefix_trie``."""
    turns = kept(_placed(conversations), "trie-turns")
    convs, rebuilt = _rebuilt(turns)
    paths = kept(_paths(rebuilt), "trie-paths")
    nodes = _nodes(convs, paths)
    totals = _totals(nodes, paths, shard_rows)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    rows = nodes.join(parents, ["depth", "p1", "p2"], "left").join(totals, KEY, "left").join(_ends(convs, paths), KEY, "left")
    return rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.coalesce("leaves", F.lit(1)).cast("bigint").alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).cast("bigint").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def op12_prefix_trie(conversations: DataFrame) -> DataFrame:
    """All nodes of the trie of rebuilt conversations, with totals of their subtrees.

    Null roles and texts are empty. Turns without a conversation belong to none. Turns of one number, null being the least, go by a digest of
    role and text, and equal rows each count. Texts of any length enter by digest and size. A table without conversations has no
    node, not even a root. Other columns play no part.
    """
    return prefix_trie(conversations)
