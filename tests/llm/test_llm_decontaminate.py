import random
import re
from collections import Counter

from helpers import plan_of

from tripweave.llm import decontaminate
from tripweave.llm.queries import registered

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def long_way(docs, items, n=5, percent=80):
    out = Counter()
    known = set()
    for item, text in items:
        w = words(text)
        width = min(n, len(w))
        own = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if w else set()
        if not own or (item, frozenset(own)) in known:
            continue
        known.add((item, frozenset(own)))
        for doc, body in docs:
            b = words(body)
            shared = len(own & {tuple(b[i : i + width]) for i in range(len(b) - width + 1)})
            if 100 * shared >= percent * len(own):
                out[(doc, item, len(own), shared)] += 1
    return out


def test_leaks_are_those_of_all_pairs(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    items = [(i, " ".join(text(rng.choice([1, 2, 4, 5, 6, 9, 15, 40, 200])))) for i in range(40)]
    items += [(100, None), (101, ""), (102, "?!"), (3, items[3][1]), (None, " ".join(text(12)))]
    docs = []
    for k in range(80):
        body = text(rng.randint(0, 300))
        for _ in range(rng.randint(0, 2)):
            passage = words(rng.choice(items)[1])
            for _ in range(rng.randint(0, 2)):
                if passage:
                    passage[rng.randrange(len(passage))] = "changed"
            at = rng.randint(0, len(body))
            body[at:at] = [w.upper() + "," for w in passage]
        docs.append((k, "  ".join(body)))
    docs += [(500, None), (501, ""), (7, docs[7][1]), (None, " ".join(words(items[30][1]) * 2))]
    got = decontaminate.leaks(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(items, ITEMS))
    assert Counter(map(tuple, got.collect())) == long_way(docs, items)


def test_both_ways_to_join_agree(spark, sf_dir, monkeypatch):
    query = registered()["op6_decontaminate"]
    small = sorted(map(tuple, query(spark, sf_dir).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, query(spark, sf_dir).collect())) == small


def test_clean_documents_stay_as_they_are(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [(1, "so " + item + " it goes", 1, "a"), (2, "alpha beta gamma delta", 2, "b"), (3, None, 3, "c"), (2, "alpha beta gamma delta", 2, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item long, t1 string")
    items = spark.createDataFrame([(1, item)], ITEMS)
    out = decontaminate.without_leaks(docs, items)
    assert out.columns == docs.columns and sorted((r.doc_id, r.item, r.t1) for r in out.collect()) == [(2, 2, "b"), (2, 2, "b"), (3, 3, "c")]
    assert decontaminate.without_leaks(docs, items.where("false")).count() == 4
    assert decontaminate.leaks(docs.where("false"), items).count() == 0


def test_items_without_an_id_are_found(spark):
    item, other = "alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven"
    docs = spark.createDataFrame([(1, "so " + item + " it goes"), (2, "alpha beta gamma delta"), (3, other), (None, item)], DOCS)
    items = spark.createDataFrame([(None, item), (None, other), (7, item), (None, item)], ITEMS)
    got = Counter(map(tuple, decontaminate.leaks(docs, items).collect()))
    assert got == Counter([(1, None, 4, 4), (1, 7, 4, 4), (None, None, 4, 4), (None, 7, 4, 4), (3, None, 3, 3)])
    assert [r.doc_id for r in decontaminate.without_leaks(docs, items.where("item_id is null")).collect()] == [2]


def test_runs_no_python(spark, sf_dir):
    for name in ("op5_quote_links", "op6_decontaminate"):
        plan = plan_of(registered()[name](spark, sf_dir))
        assert not [n for n in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop", "ExistingRDD") if n in plan]


def test_a_preface_that_many_items_share_leads_to_none_of_them(spark, monkeypatch):
    """As many documents as items begin with the same 24 words; no document holds an item."""
    candidates, real = [], decontaminate.kept

    def counted(df, label):
        out = real(df, label)
        if label == "leak-candidates":
            candidates.append(out.selectExpr("coalesce(sum(size(candidates)), 0)").first()[0])
        return out

    monkeypatch.setattr(decontaminate, "kept", counted)
    rng = random.Random(3)
    preface = " ".join(f"p{i}" for i in range(24))
    text = lambda k: " ".join(f"w{rng.randrange(5000)}" for _ in range(k))
    for n in (50, 100):
        items = [(i, f"{preface} {text(30)}") for i in range(n)]
        docs = [(i, f"{preface} {text(100)}") for i in range(n)] + [(1000, "so " + items[7][1])]
        got = decontaminate.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
        assert [(r.doc_id, r.item_id) for r in got] == [(1000, 7)]
        assert candidates.pop() <= 2


def test_a_text_beyond_one_block(spark):
    rng = random.Random(8)
    body = [f"w{rng.randrange(9000)}" for _ in range(120_000)]
    item = " ".join(f"i{k}" for k in range(40))
    docs = [(1, " ".join([*body[:90_000], item, *body[90_000:]])), (2, " ".join(body))]
    items = [(5, item), (6, " ".join(body[50_000:50_030])), (7, "not here at all in any text")]
    got = decontaminate.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert Counter(map(tuple, got.collect())) == long_way(docs, items)
