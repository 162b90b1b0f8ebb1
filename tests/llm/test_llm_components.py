import random

from tripweave.llm.components import components


def by_hand(links):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent if root(x) != x}


def test_components_of_chains_stars_and_random_links(spark):
    rng = random.Random(1)
    order = rng.sample(range(100), 100)
    links = list(zip(order, order[1:]))  # a chain in no order
    links += [(200, k) for k in range(201, 260)] + [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)] + [(5, 5), (500, 499), (499, 500)]
    got = {r.u: r.p for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == by_hand(links)
    more = [(150, 240), (301, 99), (77, 500)]
    first = components(spark.createDataFrame(links, "a long, b long"))
    got = {r.u: r.p for r in components(spark.createDataFrame(more, "a long, b long"), first).collect()}
    assert got == by_hand(links + more)
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0
