"""Ranked search against scores of all documents."""

from __future__ import annotations

import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from tripweave.llm import treap_search as ts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n_docs, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c, n in counted:
            m = 100 - 90 + (90 * n * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c
            )
            if score > 0:
                scored.append((-score, d is not None, d))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(scored[:top])]
    return sorted(out, key=str)


def found(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    b = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    return sorted((tuple(r) for r in ts.op13_treap_search(d, b).collect()), key=str)


def corpus(seed, n=400):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefghij" for b in ("la", "Xo", "é", "7", "漢字", "rum")] + ["the"] * 30
    docs = [(i * 3 - 50, " ".join(rng.choices(words, k=rng.randrange(60))) + rng.choice(["", ".", "\n-"])) for i in range(n)]
    docs += [(5000 + i, docs[7][1]) for i in range(60)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 20)))) for i in range(40)] + [(100, docs[7][1]), (101, "nothing_like"), (102, "the THE the")]
    return docs, items


@pytest.mark.parametrize("shard", [7, 8192])
def test_equals_scores_of_all_documents(spark, monkeypatch, shard):
    monkeypatch.setattr(ts, "SHARD_DOCS", shard)
    monkeypatch.setattr(ts, "BLOCK_ITEMS", 16)
    docs, items = corpus(shard)
    assert found(spark, docs, items) == brute(docs, items)


def test_nulls_ties_repeated_rows_and_empty_tables(spark):
    docs = [(None, "apple pie"), (None, "apple"), (4, None), (5, ""), (6, "apple pie"), (6, "apple pie"), (7, "Pie, APPLE"), (8, "...")]
    items = [(1, "apple"), (1, "pie"), (None, "apple pie"), (3, None), (4, ""), (2, "apple"), (2, "apple")]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == []
    assert found(spark, [(1, None)], items) == []


def test_long_text_and_other_columns(spark):
    rng = random.Random(4)
    long = " ".join(f"w{rng.randrange(50_000)}" for _ in range(300_000))
    docs = [(1, long), (2, "w1 w2 w3"), (3, "w3 " * 400_000), (4, "x")]
    items = [(1, "w1 w2 w3 w49999"), (2, long[:4000])]
    d = spark.createDataFrame([(*r, 1, "q") for r in docs], "doc_id long, text string, rank int, item_id string")
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, score int")
    result = ts.op13_treap_search(d, b)
    assert sorted((tuple(r) for r in result.collect()), key=str) == brute(docs, items)
    assert dict(result.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}


def test_memory_of_a_full_shard_is_bounded():
    """Every core of an executor holds the tree of one shard: from the cells to the tree, a full one takes 200 MB at most."""
    rng = np.random.default_rng(3)
    shard = ts._Shard()
    for doc in range(400):
        shard.add(doc, [b"%d" % t for t in rng.zipf(1.3, 600) % 30_000])
    row = shard.row().to_pylist()[0]
    tracemalloc.start()
    tree, _, _ = ts._treap_of(row, 400, sum(row["lengths"]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert tree.impact[0] > 0 and peak / shard.cells * ts.SHARD_CELLS < 200e6


def test_ranges_without_a_chance_are_not_opened(monkeypatch):
    """Of 4096 documents only some hold the rare terms asked for; most ranges are never halved."""
    rng = np.random.default_rng(0)
    rows = np.concatenate([np.zeros(4096, np.int64), rng.integers(1, 3000, 20_000)])
    columns = np.concatenate([np.arange(4096), rng.integers(0, 4096, 20_000)])
    cells = np.unique(np.stack([rows, columns]), axis=1)
    tree = ts.Treap(cells[0], cells[1], rng.integers(1, 1000, cells.shape[1]))
    opened = 0
    halves = ts.Treap.halves

    def counted(self, nodes, levels, rows):
        nonlocal opened
        opened += len(nodes)
        return halves(self, nodes, levels, rows)

    monkeypatch.setattr(ts.Treap, "halves", counted)
    asked = np.array([0, 17, 18, 19, 20]), np.array([1, 900, 900, 900, 900])
    best = tree.best(*asked, np.arange(4096), [], 10)
    assert 0 < opened < 4096
    monkeypatch.undo()
    scores = np.zeros(4096, np.int64)
    impacts = dict(zip(zip(*cells.tolist()), tree_values(tree, cells)))
    for r, w in zip(*(a.tolist() for a in asked)):
        for c in range(4096):
            scores[c] += w * impacts.get((r, c), 0)
    assert best == sorted((-s, i) for i, s in enumerate(scores.tolist()) if s)[:10]


def tree_values(tree, cells):
    """The impacts of the cells, read back by going down to each."""
    nodes = np.zeros((cells.shape[1], 1), np.int64)
    for level in range(tree.height, 0, -1):
        out = [tree.halves(nodes[i : i + 1], np.array([level]), cells[0, i : i + 1])[int(cells[1, i] >> (level - 1) & 1)] for i in range(cells.shape[1])]
        nodes = np.concatenate(out)
    return tree.impact[nodes[:, 0]].tolist()
