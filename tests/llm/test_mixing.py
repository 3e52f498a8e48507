import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from asksift.llm import mixing as m

SCHEMA = "epoch int, text string, source string, doc_id long"


def docs_of(spark, rows):
    return spark.createDataFrame([(0, t, s, i) for i, s, t in rows], SCHEMA).repartition(3)


ROWS = [(i, "big" if i % 3 else ("mid" if i % 2 else "small"), "t " * (i % 7 + 1)) for i in range(300)]
ROWS += [(400, None, "a b"), (401, "", "c"), (402, "big", None), (403, "none", ""), (404, "none", " ")]


def shares_of(rows):
    tokens = Counter()
    for _, s, t in rows:
        tokens[s or ""] += len((t or "").split())
    total = sum(tokens.values())
    return {s: n / total for s, n in tokens.items() if n}, tokens


def test_exponent_meets_the_entropy(spark):
    shares, _ = shares_of(ROWS)
    found = m.find_exponent(m.source_shares(m.count_tokens(docs_of(spark, ROWS))), 0.9, None)
    z = sum(p**found for p in shares.values())
    entropy = -sum(p**found / z * math.log(p**found / z) for p in shares.values())
    assert entropy == pytest.approx(0.9 * math.log(len(shares)), abs=1e-6)


def test_exponent_keeps_the_repetition_limit(spark):
    shares, _ = shares_of(ROWS)
    table = m.source_shares(m.count_tokens(docs_of(spark, ROWS)))
    found = m.find_exponent(table, 0.999, 1.5)
    z = sum(p**found for p in shares.values())
    assert max(p ** (found - 1) / z for p in shares.values()) == pytest.approx(1.5, abs=1e-4)
    with pytest.raises(ValueError):
        m.find_exponent(table, None, 1.0, 2.0)
    assert m.find_exponent(table, None, 1.0) == pytest.approx(1.0)


@pytest.mark.parametrize("tokens", [1 << 16, 30])
def test_draws_are_budgeted_permutations(spark, monkeypatch, tokens):
    monkeypatch.setattr(m, "BLOCK_TOKENS", tokens)
    rows = m.mix_sources(docs_of(spark, ROWS), 0.97, 3.0).collect()
    shares, total = shares_of(ROWS)
    size = {i: len((t or "").split()) for i, _, t in ROWS}
    by_source = defaultdict(list)
    for r in rows:
        assert r.n_tokens == size[r.doc_id] and 0 <= r["at"] < 1
        by_source[r.source].append(r)
    assert set(by_source) == set(shares)
    for source, drawn in by_source.items():
        drawn.sort(key=lambda r: (r.epoch, r.start, r.n_tokens))
        members = {i for i, s, _ in ROWS if (s or "") == source}
        epochs = Counter(r.epoch for r in drawn)
        for epoch in range(max(epochs)):
            assert {r.doc_id for r in drawn if r.epoch == epoch} == members
        last = [r.doc_id for r in drawn if r.epoch == max(epochs)]
        assert len(last) == len(set(last)) and set(last) <= members
        at = 0
        for r in drawn:
            assert r.start == at
            at += r.n_tokens
        assert max(epochs) < 3
    budget = sum(total.values())
    assert sum(r.n_tokens for r in rows) == pytest.approx(budget, abs=8 * len(shares))
    if tokens == 30:
        blocks = {r.block for r in by_source["big"]}
        assert len(blocks) > 5
        for epoch in {r.epoch for r in by_source["big"]}:
            order = [r.block for r in by_source["big"] if r.epoch == epoch and r.n_tokens]
            assert len(set(order)) == 1 + sum(a != b for a, b in zip(order, order[1:]))


def test_no_documents(spark):
    assert m.mix_sources(docs_of(spark, [])).count() == 0
    assert m.mix_sources(docs_of(spark, [(1, "a", None)])).count() == 0
    one = m.mix_sources(docs_of(spark, [(1, "a", "x y")])).collect()
    assert [(r.doc_id, r.epoch, r.start) for r in one] == [(1, 0, 0)]


def test_repeated_rows_are_drawn_one_by_one(spark):
    rows = m.mix_sources(docs_of(spark, [(1, "a", "x y"), (1, "a", "x y")])).collect()
    assert sorted(r.start for r in rows) == [0, 2]


def test_texts_are_not_shuffled(spark):
    plan = m.count_tokens(docs_of(spark, ROWS).where(F.lit(True)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
