import random

import pyarrow as pa
import pytest

from asksift.llm import tokens as t

tokenizers = pytest.importorskip("tokenizers")
files = pytest.importorskip("public_tokenizers")


def ids_of(name, texts):
    whole = tokenizers.Tokenizer.from_file(files.path(name))
    return [whole.encode(x or "", add_special_tokens=False).ids for x in texts]


def check(name, texts):
    ids, places = t.Encoder(files.path(name)).encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(places[:-1], places[1:])] == ids_of(name, texts)


ODD = [
    "", None, " ", "\n\n", "a", " a", "a ", "a\n\n b\t c", "it's we'll 'sa '' 're", "x  y   z", "tab\tb", "é è b  c", "日本語 テキスト。 次",
    "<|endoftext|>", "a <|endoftext|>b <|endoft", "word " * 3000, "a" * 5000 + " b", " " * 5000, "-" * 3000 + "\n", "1234567890 12 3",
    "\x00\x01 \x7f b", "​﻿ x", "é áb", "🙂🙂 🙂", "\r\n a\r\nb",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_odd_texts(name):
    check(name, ODD)


def test_random_texts(monkeypatch):
    monkeypatch.setattr(t, "RUN_BYTES", 700)
    monkeypatch.setattr(t, "MEMO_PIECES", 40)
    rng = random.Random(1)
    small = "aab -.'s \n\t  éß×÷ÿ1=_<|>Ü\u0300"
    texts = ["".join(rng.choice(small) for _ in range(rng.randrange(200))) for _ in range(300)]
    texts += ["".join(rng.choice("aa==--__  ") * rng.randrange(1, 40) for _ in range(20)) for _ in range(200)]
    texts += ["".join(chr(rng.randrange(1, 0x3000)) for _ in range(50)) for _ in range(100)]
    check("byte_bpe_50k.json", texts)


def test_which_tokenizers_are_read_in_pieces():
    assert t.Encoder(files.path("byte_bpe_50k.json")).words is not None
    assert t.Encoder(files.path("word_bpe_49k.json")).words is None
