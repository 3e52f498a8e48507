import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from asksift.llm import fingerprints as f
from tests.llm.test_words import plain_words

SCHEMA = "extra int, text string, doc_id long"


def shingles(text):
    p = plain_words(text)
    return {tuple(p[i : i + 5]) for i in range(max(len(p) - 4, min(len(p), 1)))}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def words(seed, n):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(1000)}" for _ in range(n))


def sketch(text, k=f.SKETCH_SIZE):
    return f.sketches(pa.array([text]), k)[0]


def test_small_texts_are_exact():
    a, b = words(1, 60), words(1, 60) + " " + words(2, 30)
    assert f.resemblance(sketch(a), sketch(b)) == pytest.approx(jaccard(a, b))
    assert f.containment(sketch(a), sketch(b)) == 1.0
    assert f.distinct_shingles(sketch(a)) == len(shingles(a))


@pytest.mark.parametrize("share", [0.1, 0.5, 0.9])
def test_estimates_of_large_texts(share):
    common, n = words(3, int(4000 * share)), 4000 - int(4000 * share)
    a, b = common + " " + words(4, n), common + " " + words(5, n)
    x, y = sketch(a, 1024), sketch(b, 1024)
    assert f.resemblance(x, y, 1024) == pytest.approx(jaccard(a, b), abs=0.06)
    assert f.distinct_shingles(x, 1024) == pytest.approx(len(shingles(a)), rel=0.12)
    inside = len(shingles(a) & shingles(b)) / len(shingles(a))
    assert f.containment(x, y, 1024) == pytest.approx(inside, abs=0.1)


def test_sketches_merge():
    a, b = sketch(words(6, 900)), sketch(words(7, 900))
    whole = np.unique(np.concatenate([a, b]))[: f.SKETCH_SIZE]
    assert (f.merged(a, b) == whole).all()
    assert (f.from_text(f.as_text(a)) == a).all() and len(f.from_text("")) == 0
    assert f.resemblance(sketch(""), sketch(" .")) == 1.0 and f.resemblance(sketch(""), a) == 0.0


def test_parts_merge_into_the_sketch_of_all(spark):
    parts = [(g, words(g * 10 + i, 120)) for g in range(3) for i in range(4)] + [(None, "a b"), (7, None)]
    df = spark.createDataFrame(parts, "g int, text string")
    got = {r.g: r.sketch for r in f.merge_sketches(f.fingerprint_texts(df), ["g"]).collect()}
    for g in {g for g, _ in parts}:
        each = [sketch(t or "") for h, t in parts if h == g]
        assert got[g] == np.unique(np.concatenate(each))[: f.SKETCH_SIZE].tolist()
    with pytest.raises(ValueError):
        f.fingerprint_texts(df, into="g")


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc, text) in enumerate(rows):
        text, follow = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + follow[:half]
        a, b, c = sketch(text), sketch(edited), sketch(follow)
        out.append((
            doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), f.as_text(a), f.as_text(b),
            f.resemblance(a, b), f.resemblance(a, c),
        ))
    return sorted(out, key=str)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_edited_texts(spark, ranges):
    rng = random.Random(8)
    rows = [(i * 7 - 50, words(i, rng.randrange(40)) + "é" * (i % 3)) for i in range(50)]
    rows += [(1000, None), (1001, ""), (None, "no id at all"), (5000, words(9, 30000)), (5000, words(9, 30000)), (5001, "x")]
    rng.shuffle(rows)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        df = spark.createDataFrame([(1, t, i) for i, t in rows], SCHEMA).repartition(3)
        got = sorted(map(tuple, f.fingerprint_edits(df).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == expected(rows)


def test_few_documents(spark):
    one = spark.createDataFrame([(1, "a b c d e f", 3)], SCHEMA)
    assert sorted(map(tuple, f.fingerprint_edits(one).collect()), key=str) == expected([(3, "a b c d e f")])
    assert f.fingerprint_edits(spark.createDataFrame([], SCHEMA)).count() == 0
