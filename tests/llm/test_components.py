"""Connected components against union by hand."""

import random

import pytest

from seispark.llm.components import components


@pytest.mark.parametrize("links", [[], [(1, 1)], [(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 200)] + [(300, 301), (301, 300), (300, 301)]])
def test_chains_stars_and_nothing(spark, links):
    got = sorted(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    root = {}
    for a, b in links:
        if a != b:
            for x in (a, b):
                root.setdefault(x, x)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    assert got == sorted(root.items())


def test_random_links(spark):
    rng = random.Random(8)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    for a, b in links:
        assert a == b or got[a] == got[b]
    groups = {}
    for node, root in got.items():
        groups.setdefault(root, []).append(node)
    assert all(min(g) == r for r, g in groups.items())
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for r, g in groups.items():
        seen, todo = {r}, [r]
        while todo:
            for y in near[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        assert seen == set(g)
