"""Winnowing against a loop over all windows."""

from __future__ import annotations

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import Row
from pyspark.sql import functions as F

from tripweave.llm import winnow
from tripweave.llm.winnow import GRAM, GUARANTEE, HASH_BITS, PLACE_BITS, WINDOW


def brute_picks(text: str) -> list[tuple[int, int]]:
    data = text.encode()
    if not data:
        return []
    hashes = [
        (xxhash.xxh64_intdigest(data[i : i + GRAM], seed=42) >> PLACE_BITS) % (1 << HASH_BITS) for i in range(max(1, len(data) - GRAM + 1))
    ]
    found = set()
    for start in range(max(1, len(hashes) - WINDOW + 1)):
        window = hashes[start : start + WINDOW]
        least = min(window)
        found.add(start + max(i for i, h in enumerate(window) if h == least))
    return [(i, hashes[i]) for i in sorted(found)]


def brute_text(picks) -> str:
    return " ".join(f"{h:08X}@{i}" for i, h in picks)


def brute_likeness(a, b) -> float:
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(docs: list[tuple[int, str]]) -> dict[int, tuple]:
    docs = sorted(docs)
    out = {}
    for k, (doc, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, cut, nxt = brute_picks(text), brute_picks(edited), brute_picks(after)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out[doc] = (len(text), sha, brute_text(own), brute_text(cut), brute_likeness(own, cut), brute_likeness(own, nxt))
    return out


def texts() -> list[str]:
    rng = random.Random(5)
    letters = "abcdefgh  \n"
    sizes = [0, 1, 2, 15, 16, 17, 46, 47, 48, 90, 95, 150, 300, 377, 700, 4095, 4142, 4143, 4200, 9000]
    plain = ["".join(rng.choices(letters, k=n)) for n in sizes]
    wide = ["".join(rng.choices("äéß漢字かなab ", k=n)) for n in sizes]
    same = ["a" * 500, "ab" * 3000, "x" * 20, " " * 10_000]
    return [*plain, *wide, *same, plain[-1], plain[-1]]


def as_rows(rows) -> dict[int, tuple]:
    return {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in rows}


@pytest.mark.parametrize("shuffled", [0, 1])
def test_equals_a_loop_over_all_windows(spark, shuffled):
    found = texts()
    random.Random(shuffled).shuffle(found)
    docs = [(10 * i - 70, t) for i, t in enumerate(found)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert as_rows(winnow.op11_winnowing(df).collect()) == brute(docs)


def test_long_text_in_blocks(spark):
    rng = random.Random(1)
    long = "".join(rng.choices("abcdé ", k=600_000))
    docs = [(1, long), (2, long[:300_000] + "!" + long[300_000:])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = as_rows(winnow.op11_winnowing(df).collect())
    assert rows == brute(docs)
    assert rows[1][5] > 0.99


def test_shared_strings_share_a_fingerprint(spark):
    rng = random.Random(2)
    shared = "".join(rng.choices("abcdefghij", k=GUARANTEE))
    docs = [(i, "".join(rng.choices("klmnop", k=rng.randrange(200))) + shared + "".join(rng.choices("qrstuv", k=rng.randrange(200)))) for i in range(20)]
    rows = winnow.op11_winnowing(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert all(r.near_next > 0 for r in rows)


def test_nulls_ties_repeated_rows_and_other_columns(spark):
    words = "one two three four five six seven eight nine ten eleven twelve "
    docs = [Row(doc_id=None, text=words, fingerprint="x", __slice=1), Row(doc_id=3, text=None, fingerprint="x", __slice=1)]
    docs += [Row(doc_id=5, text=words, fingerprint=None, __slice=2)] * 3 + [Row(doc_id=5, text=words * 2, fingerprint=None, __slice=2)]
    schema = "doc_id long, text string, fingerprint string, __slice int"
    df = spark.createDataFrame([tuple(d) for d in docs], schema)
    rows = winnow.op11_winnowing(df).collect()
    assert len(rows) == len(docs)
    empty = next(r for r in rows if r.doc_id == 3)
    assert (empty.n_chars, empty.fingerprint, empty.edited_fingerprint, empty.near_edited, empty.near_next) == (0, "", "", 1.0, 0.0)
    assert len({r.fingerprint for r in rows if r.n_chars == len(words)}) == 1
    assert sum(r.near_next == 1.0 for r in rows) >= 2


def test_one_document_and_none(spark):
    df = spark.createDataFrame([(1, "alone in the table, with nothing else beside it at all")], "doc_id long, text string")
    assert as_rows(winnow.op11_winnowing(df).collect()) == brute([(1, "alone in the table, with nothing else beside it at all")])
    assert winnow.op11_winnowing(df.where(F.lit(False))).collect() == []


def test_fingerprints_need_no_shuffle(spark):
    plan = winnow.fingerprints(spark.createDataFrame([(1, "a b c")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_texts_are_shuffled_once(spark):
    df = spark.createDataFrame([(i, f"text {i} " * 30) for i in range(200)], "doc_id long, text string")
    out = winnow.op11_winnowing(df)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "shufflepartitionid" in line]
    assert sum("ReusedExchange" not in line for line in dealt) == 1, plan
    assert "Python" not in plan and "Arrow" not in plan
