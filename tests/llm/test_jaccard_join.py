import random

import numpy as np
import pyarrow as pa
import pytest

from asksift.llm import jaccard_join as j
from asksift.llm.verification import intersections, similar
from tests.llm.test_fingerprints import jaccard, shingles

SCHEMA = "class_id string, text string, doc_id long"


def variants(seed, groups, most):
    """Texts in groups: copies, near copies at several distances, and others
    that only share a long line."""
    rng = random.Random(seed)
    line = " ".join(f"common{i}" for i in range(12))
    out = []
    for g in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(1, 120))]
        for _ in range(rng.randrange(1, most)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                text[rng.randrange(len(text))] = f"new{rng.randrange(9999)}"
            out.append((line + " " if g % 3 == 0 else "") + " ".join(text))
    rng.shuffle(out)
    return out


def brute_force(rows):
    n = len(rows)
    near = [[a != b and jaccard(rows[a][1] or "", rows[b][1] or "") >= 0.8 for b in range(n)] for a in range(n)]
    same = [[shingles(rows[a][1] or "") == shingles(rows[b][1] or "") for b in range(n)] for a in range(n)]
    key = lambda i: (i is not None, i or 0)
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            x = todo.pop()
            for y in range(n):
                if near[x][y] and y not in seen:
                    seen.add(y)
                    todo.append(y)
        other = {frozenset(shingles(rows[b][1] or "")) for b in range(n) if near[a][b] and not same[a][b]}
        out.append((
            rows[a][0], min((rows[b][0] for b in seen), key=key), min((rows[b][0] for b in range(n) if same[a][b]), key=key),
            sum(near[a]), len(other),
        ))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([("x", t, i) for i, t in rows], SCHEMA).repartition(3)
    got = j.jaccard_join(df).collect()
    return sorted(((r.doc_id, r.class_id, r.set_id, r.n_links, r.n_linked_sets) for r in got), key=str)


@pytest.mark.parametrize("small", [64, 2])
def test_against_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(j, "SMALL_NODE", small)
    rows = list(enumerate(variants(1, 30, 8)))
    rows += [(900, ""), (901, None), (902, "..."), (None, rows[0][1]), (903, "a b c"), (904, "a b c"), (904, "a b c"), (905, "long " * 20000)]
    assert run(spark, rows) == brute_force(rows)


def test_no_documents(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, "only one text here")]) == [(1, 1, 1, 0, 0)]


def test_one_of_each_group_stays(spark):
    texts = variants(2, 10, 5)
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    docs = spark.createDataFrame([("x", t, i) for i, t in rows], SCHEMA)
    kept = j.keep_one_of_each_group(docs)
    assert kept.columns == docs.columns
    expected = sorted({r[1] for r in brute_force(rows)})
    assert sorted(r.doc_id for r in kept.collect()) == expected


def test_runs_reach_the_recall():
    assert j.runs_needed(0.5) == 1 < j.runs_needed(0.9999) < j.runs_needed(1 - 1e-12)
    rng = np.random.default_rng(3)
    met = 0
    for _ in range(300):
        both = rng.integers(0, 1 << 63, 160, dtype=np.uint64)
        a, b = np.sort(both[:144]), np.sort(both[16:])  # similarity 0.8
        for run in range(j.runs_needed()):
            nodes_a, nodes_b = [j._RUN[run]], [j._RUN[run]]
            for _ in range(j.MAX_DEPTH):
                nodes_a = [c for n in nodes_a for c in j.children(a, n)]
                nodes_b = [c for n in nodes_b for c in j.children(b, n)]
                common = set(map(int, nodes_a)) & set(map(int, nodes_b))
                nodes_a = nodes_b = [np.uint64(c) for c in common]
            if common:
                met += 1
                break
    assert met >= 299


def test_intersections_in_blocks():
    rng = np.random.default_rng(4)
    left = [np.unique(rng.integers(0, 9000, rng.integers(0, 4000)).astype(np.uint64)) for _ in range(20)]
    right = [np.unique(rng.integers(0, 9000, rng.integers(0, 4000)).astype(np.uint64)) for _ in range(9)]
    plain = [[len(set(a.tolist()) & set(b.tolist())) for b in right] for a in left]
    assert intersections(left, right).tolist() == plain
    empty = np.zeros(0, np.uint64)
    assert similar([empty], [empty, left[3]], 8).tolist() == [[True, len(left[3]) == 0]]


def test_equal_sets_have_equal_names():
    a, b = j.token_sets(pa.array(["a b c d e f", "A b. c d E f!"]))
    assert j.set_key(a) == j.set_key(b) > 0 and j.set_key(a[:0]) == j.EMPTY_SET


def test_documents_without_an_id_of_their_own_stay(spark):
    texts = [" ".join(f"d{k}w{i}" for i in range(40)) for k in range(8)]
    near = " ".join(texts[0].split()[:-1])
    rows = [(None, t) for t in texts[:4]] + [(7, t) for t in texts[4:]]
    rows += [(7, texts[4]), (None, texts[1]), (9, texts[2]), (None, near), (8, texts[5] + " more")]
    docs = spark.createDataFrame([("x", t, i) for i, t in rows], SCHEMA).repartition(5)
    kept = [(r.doc_id, r.text) for r in j.keep_one_of_each_group(docs).collect()]
    first = [r for r in kept if r[1] in (texts[0], near)]
    assert len(first) == 1 and first[0][0] is None
    others = sorted((r for r in kept if r not in first), key=str)
    assert others == sorted([(None, t) for t in texts[1:4]] + [(7, t) for t in texts[4:]], key=str)


def test_sets_and_children_are_not_moved_to_be_made_distinct(spark):
    """Repeated rows go before their sets are made, and a set's children differ anyway:
    behind the Python there is no shuffle."""
    texts = [(i % 5, f"a b c d e f g h {i % 5}") for i in range(10)]
    docs = spark.createDataFrame([("x", t, i) for i, t in texts], SCHEMA)
    named = j.named_texts(docs).groupBy("name").agg(j.F.min(j.F.struct("doc_id", "name")).alias("rep"))
    sets = j._sets_of_classes(docs, named.withColumnRenamed("name", "class"), 5)
    rows = spark.createDataFrame([], "node long, class long, sketch binary")
    for made in (sets, j._split(rows, sets, 8)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan[: plan.index("MapInArrow")]
    assert sets.count() == 5
