import random
from collections import Counter

import brute
import pytest

from tripweave.llm import ngram_join
from tripweave.llm.ngram_join import Bands

SHAPE = "doc_id long, text string"


def rows_of(seed, groups=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 8, 12, 20, 40, 100, 400]))]
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy if rng.random() < 0.7 else copy[: max(1, len(copy) * 19 // 20)])))
    # A chain of sets, each linked with the next only; a large group of near copies.
    chain = [f"c{i}" for i in range(140)]
    rows += [(1000 + k, " ".join(chain[2 * k : 2 * k + 100])) for k in range(20)]
    long = [f"g{i}" for i in range(120)]
    for k in range(60):
        copy = list(long)
        copy[rng.randrange(120)] = f"x{k}"
        rows.append((2000 + k, " ".join(copy)))
    return rows + [(9999, None), (9998, ""), (9997, " \n"), (9996, "W1 w2"), (9995, "w1\nw2"), (9994, "w1 w2"), (9994, "w1 w2")]


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80)])
def test_components_are_those_of_all_pairs(spark, words, percent):
    rows = rows_of(words)
    docs = spark.createDataFrame(rows, SHAPE).repartition(5)
    got = ngram_join.with_components(docs, words, percent).select("doc_id", "n_shingles", "component_id").collect()
    want = brute.components(rows, words, percent)
    assert Counter(map(tuple, got)) == Counter(want)


def test_one_document_of_each_class_stays(spark):
    text = " ".join(f"t{i}" for i in range(60))
    rows = [(3, text, "a", 1), (5, text + " more", "b", 2), (3, text, "a", 1), (8, "other words here", "c", 3), (9, None, "d", 4), (10, "", "e", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root string, n long")
    out = ngram_join.one_of_each(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.root, r.n) for r in out.collect()) == [(3, "a", 1), (8, "c", 3), (9, "d", 4), (10, "e", 5)]
    assert ngram_join.one_of_each(docs.where("false")).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 90, 100])
def test_similar_sets_meet_in_a_band(percent):
    bands = Bands(percent)
    bands.reach(5000)
    band = lambda n: max(i for i, low in enumerate(bands.low) if low <= n)
    for size in range(1, 2000):
        partner = size * 100 // percent
        assert band(partner) <= band(size) + 1
        assert bands.segments[band(size)] > bands.most_apart(size, min(partner, bands.low[band(size) + 1] - 1))


def filled_in(seed, n, changes, length=120, templates=3, letters=400):
    """Texts of a few templates, each with some words put in their place."""
    rng = random.Random(seed)
    bases = [[f"w{rng.randrange(letters)}" for _ in range(length)] for _ in range(templates)]
    rows = []
    for d in range(n):
        words = list(rng.choice(bases))
        for place in rng.sample(range(length), rng.choice(changes)):
            words[place] = f"w{rng.randrange(letters)}"
        rows.append((d, " ".join(words[: length - rng.choice([0, 0, 0, 3, 10])])))
    return rows


@pytest.mark.parametrize("rare, words, percent", [(2, 3, 90), (32, 2, 80)])
def test_texts_of_one_template_equal_all_pairs(spark, monkeypatch, rare, words, percent):
    monkeypatch.setattr(ngram_join, "RARE", rare)
    rows = filled_in(rare, 150, (1, 2, 3, 4, 5, 6))
    got = ngram_join.with_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), words, percent)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == sorted(brute.components(rows, words, percent))


def test_dissimilar_texts_of_one_template_seldom_meet(spark, monkeypatch):
    """Five words in three hundred apart, so none are similar: all would meet if all were compared that agree somewhere."""
    compared, real = [], ngram_join._verified
    monkeypatch.setattr(ngram_join, "_verified", lambda pairs, *a: compared.append(pairs.count()) or real(pairs, *a))
    for n in (300,):
        rows = filled_in(n, n, (5,), length=300, templates=1, letters=3000)
        compared.clear()
        got = ngram_join.op10_ngram_join(spark.createDataFrame([(d, t) for d, t in rows if len(t.split()) == 300], "doc_id long, text string")).collect()
        assert len({r.component_id for r in got}) == len(got) and sum(compared) < 30 * len(got)
