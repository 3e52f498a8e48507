import random

from asksift.llm import components
from asksift.llm.components import connected_components


def check(spark, edges):
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    expected = {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}
    rows = [(r.node, r.component) for r in got.collect()]
    assert len(rows) == len(set(rows)) and dict(rows) == expected


def test_random_graphs(spark):
    rng = random.Random(1)
    check(spark, [(rng.randrange(300), rng.randrange(300)) for _ in range(200)])
    check(spark, [(i, i + 1) for i in range(40)] + [(100, 100), (7, 7), (3, 2)])


def test_star_and_nothing(spark):
    check(spark, [(500, i) for i in range(60)])
    check(spark, [])


def test_long_paths_over_many_tasks(spark, monkeypatch):
    """Paths whose edges are dealt out one by one do not shrink by trees alone."""
    monkeypatch.setattr(components, "TREE_EDGES", 1)
    used = []
    stars = components._by_stars
    monkeypatch.setattr(components, "_by_stars", lambda *x: used.append(1) or stars(*x))
    rng = random.Random(3)
    names = rng.sample(range(1000), 120)
    check(spark, [e for low in (0, 60) for e in zip(names[low : low + 60], names[low + 1 : low + 60])])
    assert used


def test_a_hot_node_among_small_groups(spark):
    rng = random.Random(4)
    edges = [(5, 1000 + i) for i in range(400)] + [(i, i + rng.randrange(1, 4)) for i in range(2000, 2300)]
    rng.shuffle(edges)
    check(spark, edges)


def test_what_is_left_of_a_dealt_graph_is_joined_in_one_task(spark, monkeypatch):
    """Edges of every component lie in several tasks; the second level has all that is left."""
    written = []
    counted = components.counted_stage
    monkeypatch.setattr(components, "counted_stage", lambda df, path, **m: written.append(path) or counted(df, path, **m))
    rng = random.Random(5)
    edges = [(100 * g + i, 100 * g + rng.randrange(i)) for g in range(40) for i in range(1, 60)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(12)
    small = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        rows = connected_components(df).collect()
    finally:
        for key in small:
            spark.conf.unset(key)
    assert sorted((r.node, r.component) for r in rows) == [(100 * g + i, 100 * g) for g in range(40) for i in range(60)]
    assert len(written) == 2
