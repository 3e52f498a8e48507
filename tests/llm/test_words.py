import random
import re

import numpy as np
import pyarrow as pa

from asksift.llm import words as w

WORD = re.compile("[0-9a-z\u0080-\U0010ffff]+")


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def all_words(texts):
    data, offsets = w.text_buffers(pa.array(texts, pa.string()))
    return w.word_hashes(data, offsets)


TEXTS = ["", None, "One two, THREE", "one TWO three", "  ", "été à l'École", "x" * 3000, "a-b_c", "日本 go", "one"]


def test_words_are_those_of_the_pattern():
    hashes, firsts = all_words(TEXTS)
    plain = [plain_words(t) for t in TEXTS]
    assert np.diff(firsts).tolist() == [len(p) for p in plain]
    names = {}
    for word, h in zip([x for p in plain for x in p], hashes.tolist()):
        assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)


def test_long_words_differ_by_place():
    hashes, _ = all_words(["a" * 2000 + "b", "a" * 1999 + "ba"])
    assert len(set(hashes.tolist())) == 2


def test_shingles_stay_inside_their_text():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcde") for _ in range(rng.randrange(12))) for _ in range(200)]
    hashes, places = w.shingle_hashes(*all_words(texts), 3)
    names = {}
    for text, a, b in zip(texts, places[:-1], places[1:]):
        p = text.split()
        grams = [tuple(p[i : i + 3]) for i in range(max(len(p) - 2, min(len(p), 1)))]
        assert len(grams) == b - a
        for gram, h in zip(grams, hashes[a:b].tolist()):
            assert names.setdefault(gram, h) == h
    assert len(set(names.values())) == len(names)
    sets, ends = w.shingle_sets(hashes, places)
    for a, b, c, d in zip(places[:-1], places[1:], ends[:-1], ends[1:]):
        assert sets[c:d].tolist() == sorted(set(hashes[a:b].tolist()))


def test_runs_of_texts_cover_everything_once():
    offsets = np.array([0, 5, 5, 20, 21, 90, 91])
    runs = list(w.runs_of_texts(offsets, 16))
    assert [a for a, _ in runs] == [0, *[b for _, b in runs[:-1]]] and runs[-1][1] == 6
    assert all(b - a == 1 or offsets[b] - offsets[a] <= 16 for a, b in runs)
    assert list(w.runs_of_texts(np.array([0]))) == []


def test_slices_of_a_column():
    column = pa.array(["aa", None, "b c", "d"]).slice(1, 2)
    data, offsets = w.text_buffers(column)
    assert bytes(data) == b"b c" and offsets.tolist() == [0, 0, 3]
