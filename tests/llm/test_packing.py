import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from asksift.llm import packing as p
from asksift.llm.queries import op11_packing

tokenizers = pytest.importorskip("tokenizers")
files = pytest.importorskip("public_tokenizers")
PATH = files.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


def ids_of(texts):
    whole = tokenizers.Tokenizer.from_file(PATH)
    return [whole.encode(x or "", add_special_tokens=False).ids for x in texts]


def check(rows, expected, limits, padding_share, free=None, whole=False):
    """Every id once, sequences gapless and within the limits, little padding."""
    by_key, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length > 0 and r.ids_crc32 == zlib.crc32(r.ids)
        by_key[r.doc_id].append((r.start, ids.tolist()))
        assert r.doc_tokens == len(expected[r.doc_id])
        n = (free or {}).get(r.doc_id, 1)
        assert r.loss == r.start + r.length - min(max(n, r.start), r.start + r.length)
        sequences[r.sequence_id].append((r.offset, r.length, r.loss))
    assert by_key.keys() == expected.keys()
    for key, parts in by_key.items():
        parts.sort()
        assert [s for s, _ in parts] == np.cumsum([0, *[len(x) for _, x in parts]])[:-1].tolist()
        assert sum((x for _, x in parts), []) == expected[key]
        if whole and len(expected[key]) <= limits.tokens:
            assert len(parts) == 1
    total = padded = 0
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _, _ in parts] == np.cumsum([0, *[n for _, n, _ in parts]])[:-1].tolist()
        size = sum(n for _, n, _ in parts)
        assert size <= limits.tokens and len(parts) <= limits.segments and sum(x for _, _, x in parts) <= limits.loss
        total += size
        padded += p.padded_tokens(size, limits.tokens)
    assert padded - total <= padding_share * padded
    return len(sequences)


def corpus(seed, n):
    rng = random.Random(seed)
    return [" ".join(f"word{rng.randrange(500)}" for _ in range(rng.choice([0, 1, 3, 30, 200, 900]))) for _ in range(n)]


@pytest.mark.parametrize("limits", [p.Limits(), p.Limits(256, 3, 200), p.Limits(64, 64, 7)])
def test_all_ids_once_within_the_limits(spark, limits):
    texts = [*corpus(1, 120), None, "", "long text " * 6000, "<|endoftext|> x"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "offset int, doc_id long, text string")
    got = p.pack_examples(df.repartition(3), PATH, limits=limits, with_ids=True, window=16)
    expected = {i: ids + [0] for i, ids in enumerate(ids_of(texts))}
    check(got.collect(), expected, limits, 0.0)


def test_prompts_bear_no_loss(spark):
    rng = random.Random(2)
    asked, told = corpus(3, 80), corpus(4, 80)
    rows = [(f"k{i}", a if rng.random() < 0.9 else None, b) for i, (a, b) in enumerate(zip(asked, told))]
    df = spark.createDataFrame(rows, "doc_id string, prompt string, text string").coalesce(2)
    limits = p.Limits(512, 8, 300)
    got = p.pack_examples(df, PATH, prompt="prompt", limits=limits, with_ids=True, end_id=50256).collect()
    a, b = ids_of([r[1] for r in rows]), ids_of([r[2] for r in rows])
    expected = {r[0]: x + y + [50256] for r, x, y in zip(rows, a, b)}
    check(got, expected, limits, 0.0, free={r[0]: len(x) for r, x in zip(rows, a)})


def test_whole_examples_leave_little_room(spark):
    rng = random.Random(5)
    texts = [" ".join(f"word{rng.randrange(500)}" for _ in range(rng.randrange(1, 150))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = p.pack_examples(df, PATH, cut=False, with_ids=True).collect()
    expected = {i: ids + [0] for i, ids in enumerate(ids_of(texts))}
    n = check(got, expected, p.Limits(), 0.02, whole=True)
    assert n <= 1.02 * sum(map(len, expected.values())) / 1024 + 1


def test_balance_of_two_limits():
    """Long prompts and long answers go together, which filling by tokens alone
    does not do."""
    ids = np.zeros(512, np.uint32)
    examples = [p.Piece(i, 512, 0, ids, 448 if i % 2 else 64) for i in range(64)]
    packer = p.Packer(p.Limits(1024, 8, 512), cut=False, window=8)
    sequences = [s for e in examples for s in packer.add(e)] + list(packer.pack())
    assert len(sequences) == 32
    for sequence in sequences:
        assert sorted(x.free for x in sequence) == [64, 448]


def test_small_tables_and_clashes(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert p.pack_examples(df, PATH).collect() == []
    df = spark.createDataFrame([(None, "a", "b"), (None, None, "b"), (3, "a", "b"), (3, "a", "b")], "doc_id long, text string, key string")
    got = p.pack_examples(df.coalesce(1), PATH).collect()
    assert sorted((str(r.doc_id), r.start, r.doc_tokens) for r in got if r.start == 0) == [("3", 0, 2)] * 2 + [("None", 0, 1), ("None", 0, 2)]
    assert sum(r.length for r in got) == 7
    with pytest.raises(ValueError, match="start"):
        p.pack_examples(df.withColumn("start", df["doc_id"]), PATH, key="start")


def test_query_against_the_tokenizer(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = op11_packing(spark, SF).collect()
    expected = {d.doc_id: ids + [0] for d, ids in zip(docs, ids_of([d.text for d in docs]))}
    seen = defaultdict(list)
    sequences = defaultdict(int)
    for r in rows:
        mine = np.array(expected[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(mine.tobytes()) and r.doc_tokens == len(expected[r.doc_id])
        seen[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id] += r.length
    assert {k: sum(n for _, n in v) for k, v in seen.items()} == {k: len(v) for k, v in expected.items()}
    assert sum(p.padded_tokens(n, 1024) for n in sequences.values()) == sum(map(len, expected.values()))
