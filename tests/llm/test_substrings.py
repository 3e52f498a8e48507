import hashlib
import random

import pytest

from asksift.llm import substrings as s

SCHEMA = "text string, extra int, doc_id long"


def check(spark, rows, length=100):
    docs = spark.createDataFrame([(t, 1, i) for i, t in rows], SCHEMA).repartition(3)
    got = {
        r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest())
        for r in s.dedupe_substrings(docs, length).collect()
    }
    assert got == s.brute_force(rows, length)
    return got


def passages(seed, n, size):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdé f\x00") for _ in range(size)) for _ in range(n)]


@pytest.mark.parametrize("many, hot, listed", [(512, 1 << 20, 9), (1, 1 << 20, 9), (512, 300, 1 << 20), (1, 0, 1)])
def test_against_brute_force(spark, monkeypatch, many, hot, listed):
    """``hot`` and ``listed``: gathered, some windows spread with a list that is
    broadcast, and all of them with one that is joined."""
    monkeypatch.setattr(s, "MANY_CONTEXTS", many)
    monkeypatch.setattr(s, "HOT_BYTES", hot)
    monkeypatch.setattr(s, "HOT_KEYS", listed)
    rng = random.Random(2)
    shared = passages(3, 6, 150)
    rows = []
    for i in range(60):
        parts = [rng.choice(shared)[rng.randrange(60) :] if rng.random() < 0.6 else p for p in passages(i, 4, 120)]
        rows.append((i, "".join(parts)))
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, ""), (103, None), (104, "x" * 500), (105, "x" * 99), (106, "x" * 100)]
    got = check(spark, rows)
    assert got[100][1] == got[100][0] and got[104][1] == 499 and got[105][1] == 0 and got[106][1] == 100


def test_a_long_text_is_taken_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(s, "PIECE_BYTES", 4096)
    (a,) = passages(5, 1, 9000)
    check(spark, [(1, a), (2, a[2000:8000]), (3, "start" + a[3990:4200])])


def test_other_lengths_and_empty_tables(spark):
    a, b = passages(6, 2, 400)
    check(spark, [(1, a), (2, b + a[100:170]), (3, b)], 64)
    docs = spark.createDataFrame([], SCHEMA)
    assert s.dedupe_substrings(docs).count() == 0
    with pytest.raises(ValueError):
        s.repeated_ranges(docs, 20)


def test_repeated_rows_and_null_ids(spark):
    a, b = passages(7, 2, 300)
    docs = spark.createDataFrame([(a, 1, 1), (a, 1, 1), (b, 1, None), (b, 1, 5)], SCHEMA)
    rows = [(r.doc_id, r.n_removed) for r in s.dedupe_substrings(docs).collect()]
    n = len(b.encode())
    assert sorted(rows, key=str) == sorted([(1, 0), (1, 0), (None, 0), (5, n)], key=str)


def test_a_passage_of_many_documents_is_not_gathered(spark, monkeypatch):
    """Passages of 90 to 130 bytes in unlike surroundings meet under one key."""
    monkeypatch.setattr(s, "HOT_BYTES", 4000)
    groups = s.groups_in_order

    def seen(batches, keys):
        for table in groups(batches, keys):
            if keys == ["key"]:
                assert table.column("bytes").nbytes <= 3 * 4000
            yield table

    monkeypatch.setattr(s, "groups_in_order", seen)
    (a,) = passages(8, 1, 130)
    rows = []
    for i in range(150):
        rng = random.Random(i)
        around = ["".join(rng.choice("ghijklmn ") for _ in range(160)) for _ in range(2)]
        rows.append((i, around[0] + a[: rng.randrange(90, 131)] + around[1]))
    got = check(spark, rows)
    assert sum(x[1] > 0 for x in got.values()) > 100
