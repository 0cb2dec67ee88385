"""Connected components and gapless numbers against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tradescribe.llm import components as module
from tradescribe.llm.components import components, contracted
from tradescribe.llm.tables import numbered, stored


def slow_components(links):
    smallest = {x: x for link in links for x in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(smallest[a], smallest[b])
            for x in (a, b):
                if smallest[x] != least:
                    smallest[x], changed = least, True
    return smallest


def graphs():
    random.seed(3)
    chain = list(range(40))
    random.shuffle(chain)
    yield "chain", list(zip(chain, chain[1:]))
    yield "hub", [(500, x) for x in range(300)] + [(x, 1_000 + x) for x in range(50)]
    yield "random", [(random.randrange(200), random.randrange(200)) for _ in range(130)]
    yield "repeated", [(2, 1), (1, 2), (2, 1), (-5, 2)]
    yield "none", []


@pytest.mark.parametrize("name, links", list(graphs()))
@pytest.mark.parametrize("partitions", [1, 7])
def test_components(spark, name, links, partitions):
    odd = [(None, 1), (1, None), (None, None), (90_000, 90_000)]
    rows = spark.createDataFrame(links + odd, "a long, b long").repartition(partitions)
    found = components(rows).collect()
    links = [(a, b) for a, b in links if a != b]
    assert sorted((r.id, r.component_id) for r in found) == sorted(slow_components(links).items())


def test_contraction_by_parts_keeps_the_components():
    links = [(a, b) for a, b in dict(graphs())["random"] if a != b]
    ends = np.array(links)
    u, v = contracted(ends[:, 0], ends[:, 1])
    whole = slow_components(links)
    assert {x: whole[x] for x in u.tolist()} == dict(zip(u.tolist(), v.tolist()))
    parts = [contracted(part[:, 0], part[:, 1]) for part in np.array_split(ends, 9)]
    again = [(int(a), int(b)) for us, vs in parts for a, b in zip(us, vs)]
    assert slow_components(again) == whole


def test_small_contractions(spark, monkeypatch):
    monkeypatch.setattr(module, "CONTRACTED", 1)
    links = dict(graphs())["chain"]
    found = components(spark.createDataFrame(links, "a long, b long").repartition(3)).collect()
    assert {r.id: r.component_id for r in found} == slow_components(links)


@pytest.mark.parametrize("unique", [False, True])
def test_numbers_are_gapless(spark, unique):
    rows = [(None, 1), (None, 2)] + [("a", x) for x in range(500)] + [("b", 7)]
    rows += [] if unique else [("a", 3)] * 20
    df = stored(spark.createDataFrame(rows, "g string, x long"), "numbers")
    found = numbered(df, ["g"], ["x"], "n", size="m", unique=unique).collect()
    assert sorted((r.g or "", r.x) for r in found) == sorted((g or "", x) for g, x in rows)
    for group in {g for g, _ in rows}:
        mine = [r for r in found if r.g == group]
        assert sorted(r.n for r in mine) == list(range(len(mine))) and {r.m for r in mine} == {len(mine)}
