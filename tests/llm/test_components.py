import random

import pytest

from flowlab.llm.components import components


def expected(links):
    near: dict = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = {}
    for v in near:
        seen, todo = {v}, [v]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        out[v] = min(seen)
    return out


def shapes():
    r = random.Random(4)
    ids = list(range(400))
    r.shuffle(ids)
    yield list(zip(ids[:150], ids[1:151], strict=True))  # a chain in random order
    yield [(ids[0], i) for i in ids[1:200]]  # a star
    yield [(r.choice(ids), r.choice(ids)) for _ in range(250)]  # many, with loops and repeats
    yield [(i, i + 1) for i in range(120)]


@pytest.mark.parametrize("links", list(shapes()))
def test_equals_search(spark, links):
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.id: r.component for r in found} == expected(links)


def test_empty(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
