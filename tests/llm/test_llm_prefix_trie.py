"""The trie of conversations against plain dictionaries."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tripweave.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows: list[tuple]) -> list[tuple]:
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    members = defaultdict(list)
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        built[c] = turns.get(base, [])[:h] + own[h:]
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    kids = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, convs in members.items():
        cost = (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += cost
            leaves[node[:d]] += kids[node] == 0
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(built[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(node), parent, len(convs), kids[node], leaves[node], saved[node], sha))
    return sorted(out, key=str)


def found(spark, rows, **options) -> list[tuple]:
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    return sorted((tuple(r) for r in trie.prefix_trie(df, **options).collect()), key=str)


def conversations(seed: int, n: int = 120) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if c % 17 == 3:
            continue
        opening = [("user", f"hello {rng.randrange(3)}"), ("bot", "what is it, é?"), ("user", f"it is {rng.randrange(2)}")]
        own = opening[: rng.randrange(4)] + [("user", f"{c} says {rng.randrange(4)}") for _ in range(rng.randrange(12))]
        rows += [(c, t, role, text) for t, (role, text) in enumerate(own or [("user", "only")])]
    return rows


@pytest.mark.parametrize("shard_rows", [3, 100_000])
def test_equals_dictionaries(spark, shard_rows):
    rows = conversations(1)
    assert found(spark, rows, shard_rows=shard_rows) == brute(rows)


def test_copies_and_a_very_long_conversation(spark):
    """A third of all rows is one conversation, a third copies of another; both span several slices."""
    rows = [(700, t, "user", f"turn {t}") for t in range(2000)]
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(200) for t in range(10)]
    rows += conversations(2, 60)
    assert found(spark, rows, shard_rows=500) == brute(rows)


def test_nulls_ties_and_other_columns(spark):
    rows = [(1, None, None, None), (1, 1, "user", "b"), (1, 2, "user", "c"), (None, 1, "user", "x"), (-7, 1, "user", "é"), (-5, 2, None, "q")]
    rows += [(10, 1, "user", "same")] * 12 + [(11, t, "user", "same") for t in range(12)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA + ", depth int, k1 string")
    result = trie.op12_prefix_trie(df)
    assert sorted((tuple(r) for r in result.collect()), key=str) == brute(rows)
    assert dict(result.dtypes) == {c: "string" if c == "ends_sha256" else "bigint" for c in result.columns}


def test_no_conversation(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []


def test_long_text(spark):
    long = "word " * 500_000
    rows = [(0, 0, "user", long), (5, 0, "user", long), (10, 0, "user", long + "!")]
    assert found(spark, rows) == brute(rows)


def test_queue_spills_and_stays_in_order():
    rng = random.Random(3)
    items = [(rng.randrange(1000), i) for i in range(20_000)]
    queue = trie.SpillingQueue(held=500)
    for item in items[:15_000]:
        queue.push(item)
    out = []
    for _ in range(5_000):
        assert queue.least() == (least := queue.pop())
        out.append(least)
    assert out == sorted(items[:15_000])[:5_000]
    for item in items[15_000:]:
        queue.push(item)
    rest = []
    while queue.least() is not None:
        rest.append(queue.pop())
    assert rest == sorted(sorted(items[:15_000])[5_000:] + items[15_000:])
    assert len(queue._heap) <= 500
