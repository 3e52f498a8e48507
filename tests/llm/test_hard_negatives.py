import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from asksift.llm import hard_negatives as h
from asksift.llm.vectors import LARGEST

SCHEMA = "score string, vec_id long, embedding array<float>, label int, row int"


def brute_force(rows, scale=256, most=5):
    """``vec_id, vector, label`` to the result rows, in plain numbers."""
    kept = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, [math.floor(scale * float(np.float32(x))) for x in vector], label))

    def score(a, b):
        return sum(x * y for x, y in zip(a[1], b[1]))

    order = lambda s, r: (-s, r[0] is not None, r[0] or 0)
    out = []
    for i, anchor in enumerate(kept):
        if anchor[0] is None or anchor[0] % 10:
            continue
        others = [(score(anchor, r), r) for k, r in enumerate(kept) if k != i]
        same = sorted((x for x in others if x[1][2] == anchor[2]), key=lambda x: order(*x))[:most]
        for s, positive in same:
            there = [x for x in others if x[1][2] != anchor[2] and 80 * s <= 100 * x[0] <= 100 * s]
            for rank, (t, negative) in enumerate(sorted(there, key=lambda x: order(*x))[:most]):
                out.append((anchor[0], positive[0], rank + 1, negative[0], s, t))
    return sorted(out, key=str)


def mined(spark, rows, parts=3):
    df = spark.createDataFrame([("x", i, v, y, 1) for i, v, y in rows], SCHEMA).repartition(parts)
    return h.mine_hard_negatives(df, F.col("vec_id") % 10 == 0)


def run(spark, rows):
    return sorted(map(tuple, mined(spark, rows).collect()), key=str)


def vectors(seed, n, width=12, labels=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(width)] for _ in range(labels)]
    common = [rng.gauss(0.2, 0.2) for _ in range(width)]
    rows = []
    for i in range(n):
        label = rng.randrange(labels)
        v = [c + rng.gauss(0, 0.3) for c in centres[label]]
        rows.append((i, list(common) if i % 4 == 0 else v, label))
    return rows


@pytest.mark.parametrize("tile", [1 << 13, 16])
def test_against_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(h, "TILE_ROWS", tile)
    monkeypatch.setattr(h, "SMALL_BLOCK", 40)
    monkeypatch.setattr(h, "TILE_ANCHORS", 3)
    rows = vectors(1, 160)
    rows += [(500, None, 1), (510, rows[0][1], None), (520, [0.1, None] * 6, 1), (530, [math.nan] * 12, 0)]
    rows += [(540, [math.inf] * 12, 0), (550, [], 1), (560, [0.5, -0.25], 0), (10, rows[10][1], rows[10][2])]
    rows += [(10, rows[11][1], rows[11][2])]
    expected = brute_force(rows)
    assert len(expected) > 100 and run(spark, rows) == expected


def test_rows_without_an_id_are_partners(spark):
    rows = vectors(2, 60) + [(None, [0.3] * 12, 1), (None, [0.3] * 12, 2)]
    assert run(spark, rows) == brute_force(rows)


def test_small_tables(spark):
    assert mined(spark, []).collect() == []
    assert run(spark, [(1, [0.5], 0), (2, [0.5], 1)]) == []
    assert run(spark, [(10, [0.5], 0), (3, [1.0], 0), (4, [1.0], 1)]) == [(10, 3, 1, 4, 128 * 256, 128 * 256)]


def test_components_out_of_range(spark):
    with pytest.raises(Exception, match="component beyond"):
        mined(spark, [(10, [1e30], 0), (3, [1.0], 0)]).collect()


@pytest.mark.parametrize("width, size", [(1, LARGEST), (64, 300), (700, 4000), (9000, 200)])
def test_products_are_exact(width, size):
    rng = np.random.default_rng(width)
    a, b = rng.integers(-size, size + 1, (7, width)), rng.integers(-size, size + 1, (9, width))
    a[0], b[0] = size, size
    b[1] = -size
    primes = h.choose_primes(width, int(max((a * a).sum(1).max(), (b * b).sum(1).max())))
    assert all(min(width, h.PIECE) * (p // 2) ** 2 < h.EXACT for p in primes) and len(set(primes)) == len(primes)
    got = h.products(h.residues(a, primes), h.residues(b, primes), primes)
    assert (got == a @ b.T).all()


def test_scores_too_large_for_the_primes():
    with pytest.raises(ValueError, match="2\\^51"):
        h.choose_primes(64, 1 << 51)


def test_labels_of_any_type(spark):
    rows = vectors(3, 80)
    df = spark.createDataFrame([(i, v, f"label {y}") for i, v, y in rows], "vec_id long, embedding array<double>, label string")
    got = h.mine_hard_negatives(df, F.col("vec_id") % 10 == 0).select("anchor_id", "positive_id", "rank").collect()
    float32 = [(i, [float(x) for x in v], y) for i, v, y in rows]
    assert len(got) > 20 and {r.anchor_id for r in got} <= {i for i, _, _ in float32 if i % 10 == 0}
