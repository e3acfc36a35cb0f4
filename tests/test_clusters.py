"""Clusters: links go by keys that nodes have in common, not by nodes."""

import random

from tessera.operators import components


def expected(members):
    least = {a: a for a, _ in members}
    while True:
        of = {}
        for a, key in members:
            of[key] = min(of.get(key, a), least[a])
        new = dict(least)
        for a, key in members:
            new[a] = min(new[a], of[key])
        if new == least:
            return least
        least = new


def test_links_dont_grow_with_nodes_of_the_same_keys(spark, monkeypatch):
    seen, state = [], components.state_of
    monkeypatch.setattr(components, "state_of", lambda links: seen.append(state(links)) or seen[-1])
    members = [(n, k) for n in range(300) for k in (n % 3, n % 3 + 1, 10 + n % 3)]
    got = {r.a: r.cluster for r in components.clusters(spark.createDataFrame(members, "a long, k int"), "a", "k").collect()}
    assert got == {n: 0 for n in range(300)} and seen[0][0] <= 6


def test_chains_trees_and_single_nodes(spark):
    rng = random.Random(4)
    members = [(n, rng.randrange(400)) for n in rng.sample(range(1000), 300) for _ in range(rng.randrange(1, 4))] + [(2000, None), (1999, None), (3000, 5000)]
    members += [(7, 900), (8, 900), (7, 901), (3, 901), (3, 902), (9, 902), (9, 903)]  # the least node of one key has a lesser one elsewhere
    got = {r.a: r.cluster for r in components.clusters(spark.createDataFrame(members, "a long, k int"), "a", "k").collect()}
    assert got == expected(members)
