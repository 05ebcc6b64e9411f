import random

import pytest
from pyspark.sql import functions as F

from ludex.llm import components as cc


def brute(links):
    lead = {}

    def top(x):
        while lead.setdefault(x, x) != x:
            x = lead[x]
        return x

    for a, b in links:
        one, two = sorted((top(a), top(b)))
        lead[two] = one
    return sorted((x, top(x)) for x in lead if any(x in link for link in links if link[0] != link[1]))


def star(n, at=0):
    return [(at, at + k) for k in range(1, n)]


def chain(n, at=0):
    return [(at + k, at + k + 1) for k in range(n)]


def shuffled(links, seed):
    names = sorted({x for link in links for x in link})
    new = dict(zip(names, random.Random(seed).sample(names, len(names)), strict=True))
    return [(new[a], new[b]) for a, b in links]


CASES = {
    "star of the least": star(300), "star of the largest": [(1000, k) for k in range(300)],
    "rising chain": chain(200), "mixed chain": shuffled(chain(200), 1),
    "two hubs": [(h, k) for h in (1, 500) for k in range(100, 400)],
    "several": shuffled(star(90) + chain(60, 100) + [(200, 201), (201, 200), (202, 202), (0, 100)]
                        + [(300 + k, 300 + k // 2) for k in range(1, 128)], 2),
}


@pytest.mark.parametrize("case", CASES)
def test_least_node_reachable(spark, case):
    links = CASES[case]
    found = cc.connected_components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert sorted(tuple(r) for r in found.collect()) == brute(links)


def test_no_links(spark):
    assert cc.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_edges_inside_a_component_are_not_read_again(spark, monkeypatch):
    """A group whose nodes have two hubs each, beside a chain that takes
    several rounds: only the first round reads the edges of the group."""
    links = shuffled([(h, k) for h in (0, 1) for k in range(2, 1200)] + chain(40, 5000), 3)
    read, write = spark.sparkContext.accumulator(0), cc.stage_table

    @F.udf("boolean")
    def counted(_):
        read.add(1)
        return True

    def stage_table(df, label="stage"):
        out = write(df, label)
        return out.where(counted("a")) if label == "edges" else out

    monkeypatch.setattr(cc, "stage_table", stage_table)
    found = cc.connected_components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert sorted(tuple(r) for r in found.collect()) == brute(links)
    assert read.value < 6 * len(links)
