import hashlib
import random
from collections import Counter

import brute
from pyspark.sql import functions as F

from tripweave.llm import suffix_dedup

SHAPE = "doc_id long, text string"


def rows_of(seed):
    rng = random.Random(seed)
    words = ["ab", "cde", "f", "ghij", "é", "kl"]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 300))) for _ in range(20)]
    rows = []
    for i in range(80):
        x, y = rng.choice(base), rng.choice(base)
        a, b = rng.randint(0, len(x)), rng.randint(0, len(y))
        middle = "".join(rng.choice("xyz ") for _ in range(rng.randint(0, 40)))
        rows.append((i, x[a : a + rng.randint(0, 900)] + middle + y[b : b + rng.randint(0, 700)]))
    # Null and empty texts, rows that are equal, null ids, texts that repeat themselves.
    return rows + [(500, None), (501, ""), (None, base[3]), (None, base[3]), (7, rows[7][1]), (502, "a" * 1000), (503, "ab" * 90), (504, "ab" * 400)]


def test_removes_just_the_repeated_strings(spark):
    rows = rows_of(5)
    got = suffix_dedup.op2_suffix_dedup(spark.createDataFrame(rows, SHAPE).repartition(5))
    want = Counter((d, *r) for (d, _), r in zip(rows, brute.repeats([t for _, t in rows], 200)))
    assert Counter(map(tuple, got.collect())) == want


def test_long_texts_are_scanned_in_parts_that_agree(spark):
    rng = random.Random(1)
    noise = "".join(rng.choices("abcdefgh ", k=1_300_000))
    passage = noise[1_048_400:1_048_900]  # lies over the end of a part
    rows = [(1, noise), (2, "start " + passage + " end")]
    got = {r.doc_id: r for r in suffix_dedup.op2_suffix_dedup(spark.createDataFrame(rows, SHAPE)).collect()}
    assert got[1].n_removed == got[2].n_removed == 500
    assert got[1].kept_sha256 == hashlib.sha256((noise[:1_048_400] + noise[1_048_900:]).encode()).hexdigest()


def test_other_columns_pass_through_and_empty_tables_stay_empty(spark):
    docs = spark.createDataFrame([(1, "x" * 300, 1, 2, "g"), (2, "short", 3, 4, "h")], "doc_id long, text string, t1 long, pos long, places string")
    out = suffix_dedup.without_repeats(docs).orderBy("doc_id").collect()
    assert [(r.t1, r.pos, r.places) for r in out] == [(1, 2, "g"), (3, 4, "h")]
    assert out[0].repeats.n_removed == 300 and out[1].repeats.kept == b"short"
    assert suffix_dedup.op2_suffix_dedup(docs.where("false").select("doc_id", "text")).count() == 0


def test_a_cut_character_is_dropped(spark):
    df = spark.createDataFrame([(bytearray("aé".encode()[:2]),), (None,)], "b binary")
    assert [r[0] for r in df.select(suffix_dedup.as_text(F.col("b"))).collect()] == ["a", None]
