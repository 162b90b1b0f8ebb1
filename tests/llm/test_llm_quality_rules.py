import math
import random
from collections import Counter

import brute
import numpy as np

from tripweave.llm import quality_rules as rules

SHAPE = "doc_id long, text string, lang string, source string"


def test_counts_and_base_rules_over_the_given_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = [(9001, None, "en", "a"), (9002, "", None, None), (9003, " \n\t ", "en", "a"), (9004, "é è x # <|> \x0b\x0c b\r\nb\r\nb", "fr", None)]
    odd += [(9005, "one two three\none two three\n\none two three four", "en", "a")] * 2
    docs = docs.select("doc_id", "text", "lang", "source").union(spark.createDataFrame(odd, SHAPE))
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rules.op4_quality_rules(docs).collect())
    want = Counter()
    for r in docs.collect():
        c = brute.counts(r.text)
        want[(r.doc_id, *c, c[0] < 50 or 100 * c[4] > 50 * c[0])] += 1
    assert got == want


def judged_long_way(vectors):
    """The concentration steps over all rows of one group at once."""
    d = len(rules.FLOOR)
    narrow = (1 - rules.tail(rules.quantile(1 - rules.COVER, d), d + 2)) / rules.COVER
    inside = np.ones(len(vectors), bool)
    for _ in range(rules.STEPS + 1):
        centre = vectors[inside].mean(0)
        scatter = np.cov(vectors[inside].T, bias=True) / narrow + np.diag(np.square(rules.FLOOR))
        x = vectors - centre
        d2 = np.einsum("ni,ij,nj->n", x, np.linalg.inv(scatter), x)
        bins = np.floor(32 * np.log(d2 + 1e-9))
        last = np.sort(bins)[math.ceil(rules.COVER * len(bins)) - 1]
        inside = bins <= last
    return d2


def test_verdicts_are_those_of_all_rows_at_once(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(3000)]
    rows = []
    for k in range(300):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(60, 200)))
        if k % 10 == 0:
            text = "*** ".join(text.split())
        if k % 10 == 1:
            text = text.upper().replace(" ", "!! ")
        rows.append((k, text, "xx", "s"))
    docs = spark.createDataFrame(rows, SHAPE).repartition(4)
    got = {r.doc_id: r for r in rules.judge(docs).collect()}
    stats = {r.doc_id: r.s.vector for r in docs.select("doc_id", rules.text_stats("text").alias("s")).collect()}
    want = judged_long_way(np.array([stats[k] for k in range(300)]))
    assert np.allclose([got[k].distance for k in range(300)], want, rtol=1e-6)
    assert all(got[k].kept == (k % 10 > 1) for k in range(300))


def test_copies_and_many_unusual_texts_do_not_pull_the_estimates(spark):
    rng = random.Random(5)
    text = lambda: " ".join("".join(rng.choices("abcdefg", k=rng.randint(3, 7))) for _ in range(80))
    junk = lambda: text().upper().replace(" ", "### ") + " !!!"
    copied = junk()
    # A third of a source are copies of one text; of another source two fifths are unusual, each in its own words.
    rows = [(k, text(), "en", "a") for k in range(100)] + [(200 + k, copied, "en", "a") for k in range(60)] + [(300, junk(), "en", "a")]
    rows += [(400 + k, text(), "en", "b") for k in range(90)] + [(500 + k, junk(), "en", "b") for k in range(60)]
    got = {r.doc_id: r.kept for r in rules.judge(spark.createDataFrame(rows, SHAPE).repartition(3)).collect()}
    assert {k for k, kept in got.items() if kept} == {*range(100), *range(400, 490)}


def test_small_groups_join_the_rest_and_too_small_tables_have_base_rules_only(spark):
    rng = random.Random(4)
    text = lambda: " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(80))
    rows = [(k, text(), "en", f"s{k}") for k in range(80)] + [(900, text().replace(" ", "### "), "en", None)]
    got = {r.doc_id: r for r in rules.judge(spark.createDataFrame(rows, SHAPE)).collect()}
    assert not got[900].kept and got[900].distance is not None and all(got[k].kept for k in range(80))
    few = spark.createDataFrame([(1, text(), "en", "a"), (2, text(), None, None), (3, "short", "en", "a"), (4, None, None, "a")], SHAPE)
    got = {r.doc_id: (r.kept, r.distance) for r in rules.judge(few).collect()}
    assert got == {1: (True, None), 2: (True, None), 3: (False, None), 4: (False, None)}
    assert rules.op4_quality_rules(few.where("false")).count() == 0


def test_passing_keeps_columns_and_agrees(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumnsRenamed({"n_chars": "vector"})
    out = rules.passing(docs)
    assert out.columns == docs.columns
    want = sorted(r.doc_id for r in rules.judge(docs).where("kept").collect())
    assert sorted(r.doc_id for r in out.collect()) == want


def test_chi_square_quantiles():
    assert abs(rules.tail(rules.quantile(0.05, 6), 6) - 0.05) < 1e-9 and abs(rules.quantile(0.05, 6) - 12.5916) < 1e-3
