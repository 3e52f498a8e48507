import os
import random
import re
from itertools import accumulate

import pytest

from asksift.llm import paragraphs as p
from asksift.llm.oracles import paragraphs
from tests.llm.test_fingerprints import jaccard
from tests.llm.test_words import all_words, plain_words

SCHEMA = "line int, text string, doc_id long, other string"


def corpus(seed):
    rng = random.Random(seed)
    shared = [[f"s{k}w{rng.randrange(500)}" for _ in range(rng.randrange(28, 70))] for k in range(5)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            words = list(rng.choice(shared)) if rng.random() < 0.5 else [f"u{rng.randrange(9999)}" for _ in range(rng.randrange(50))]
            if words and rng.random() < 0.4:
                words[rng.randrange(len(words))] = "edit"
            lines.append(" ".join(words))
        rows.append((i, "\n".join(lines)))
    return rows


def brute_force(rows):
    found = [
        (doc, n, line)
        for doc, text in rows
        for n, line in enumerate((text or "").split("\n"))
        if len(plain_words(line)) >= p.MIN_WORDS
    ]
    found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    label = list(range(len(found)))
    for a in range(len(found)):
        for b in range(a):
            if jaccard(found[a][2], found[b][2]) >= 0.8:
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    gone = {}
    for i, (doc, n, _) in enumerate(found):
        if (doc, n) != found[label[i]][:2]:
            gone.setdefault(doc, set()).add(n)
    return {
        doc: (sorted(gone.get(doc, [])), text if doc not in gone else
              "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone[doc]))
        for doc, text in rows
    }


def run(spark, rows):
    docs = spark.createDataFrame([(1, t, i, "x") for i, t in rows], SCHEMA).repartition(3)
    out = p.dedupe_paragraphs(docs)
    assert out.columns == [*docs.columns, "removed_lines", "removed_words"]
    return {r.doc_id: (r.removed_lines, r.text) for r in out.collect()}


def parts_by_force(text):
    """First line, number of lines and text of every paragraph or block."""
    lines, out, held = (text or "").split("\n"), [], []
    for n, line in enumerate([*lines, ""]):
        words = len(plain_words(line))
        if 0 < words < p.MIN_WORDS:
            held.append(n)
            continue
        if held:
            out.append((held[0], len(held)))
            held = []
        if words:
            out.append((n, 1))
    return [(n, h, "\n".join(lines[n : n + h])) for n, h in out]


def whole_by_force(rows, size=p.MIN_RUN_WORDS):
    """What ``dedupe_paragraphs`` leaves of documents with different ids: removed
    lines and text, by both steps and to the word."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    found = [(d, n, h, x) for d, t in rows for n, h, x in parts_by_force(t) if len(plain_words(x)) >= p.MIN_WORDS]
    label = list(range(len(found)))
    sets = [set(zip(*(plain_words(x)[i:] for i in range(5)))) for *_, x in found]
    for a in range(len(found)):
        for b in range(a):
            if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    gone = {d: set() for d, _ in rows}
    for i, (d, n, h, _) in enumerate(found):
        if label[i] != i:
            gone[d].update(range(n, n + h))
    seen, cut = {}, {}
    for doc, text in rows:
        words = [(n, w) for n, line in enumerate((text or "").split("\n")) for w in plain_words(line)]
        cut[doc] = set()
        for at in range(len(words) - size + 1):
            run = words[at : at + size]
            if any(n in gone[doc] for n, _ in run):
                continue
            first = seen.setdefault(tuple(w for _, w in run), (doc, at))
            if first != (doc, at):
                cut[doc].update(range(max(at, first[1] + size) if first[0] == doc else at, at + size))
    out = {}
    for doc, text in rows:
        if text is None:
            out[doc] = ([], None)
            continue
        kept, word = [], 0
        for n, line in enumerate(text.split("\n")):
            starts = [m.start() for m in re.finditer("[0-9A-Za-z\u0080-\U0010ffff]+", line)]
            mine = [word + i in cut[doc] for i in range(len(starts))]
            word += len(starts)
            if n in gone[doc]:
                continue
            if any(mine):
                edges = [0, *starts[1:], len(line)]
                line = "".join(line[a:b] for a, b, x in zip(edges, edges[1:], mine) if not x)
                line = line.rstrip() if mine[-1] else line
                if all(mine):
                    continue
            kept.append(line)
        out[doc] = (sorted(gone[doc]), "\n".join(kept))
    return out


@pytest.mark.parametrize("seed", [21, 22])
def test_both_steps_against_brute_force(spark, seed):
    """Near copies of lines and of blocks, and passages inside and across lines."""
    rng = random.Random(seed)
    shared = [[f"s{k}w{rng.randrange(500)}" for _ in range(rng.randrange(20, 90))] for k in range(8)]
    rows = []
    for i in range(50):
        words = []
        for _ in range(rng.randrange(1, 5)):
            part = list(rng.choice(shared)) if rng.random() < 0.6 else unlike(rng, rng.randrange(60))
            if part and rng.random() < 0.3:
                part[rng.randrange(len(part))] = "edit"
            words += part[rng.randrange(3) :]
        lines = []
        while words:
            n = rng.choice([4, 9, 28, 60, 100])
            lines += [" ".join(words[:n]) + rng.choice(["", ".", " -"])] + [""] * rng.randrange(2)
            words = words[n:]
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, rows[0][1]), (None, rows[1][1]), (104, "word " * 3000)]
    expected = whole_by_force(rows)
    assert sum(bool(x[0]) for x in expected.values()) > 3
    assert run(spark, rows) == expected


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(p, "MIN_RUN_WORDS", 1 << 30)
    rows = corpus(1)
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, rows[0][1]), (None, rows[1][1]), (104, "word " * 30000)]
    assert run(spark, rows) == brute_force(rows)


def test_passages_inside_paragraphs(spark):
    rng = random.Random(7)
    passage = [f"p{i}" for i in range(60)]

    def words(n):
        return [f"u{rng.randrange(10**6)}" for _ in range(n)]

    heading = "A heading of ten words that many documents do share"
    rows = []
    for i in range(12):
        inside = words(rng.randrange(5, 60)) + (passage if i % 2 else []) + words(rng.randrange(5, 60))
        rows.append((i, f"{heading}\n{' '.join(words(40))}.\n{' '.join(inside)}"))
    got = run(spark, rows)
    for i, text in rows:
        if i % 2 == 0 or i == 1:
            assert got[i] == ([], text)
        else:
            left = got[i][1]
            assert not set(passage) & set(left.split()) and len(left.split()) == len(text.split()) - 60
            assert left.startswith(heading) and left.split()[-1] == text.split()[-1]


def test_pieces_of_a_passage_are_cut_alike():
    rng = random.Random(8)
    passage = [f"p{rng.randrange(999)}" for _ in range(60)]
    found = []
    for _ in range(2):
        line = [f"u{rng.randrange(999)}" for _ in range(30)] + passage + [f"u{rng.randrange(999)}" for _ in range(9)]
        hashes, _, start, size = p.pieces_of(*all_words([" ".join(line)]))
        assert start.tolist() == [0, *accumulate(size.tolist())][:-1] and sum(size) == len(line)
        found.append(dict(zip(hashes.tolist(), size.tolist())))
    # All pieces that begin inside, but for those near its ends, are the same.
    assert sum(n for h, n in found[0].items() if h in found[1]) >= 60 - 2 * (p.SEED_WORDS + p.SEED_GAP - 1)


def test_lines_match_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    path = "/root/testdata/sf0.001/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables")
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    expected = connection.sql(f"WITH RECURSIVE {paragraphs()} SELECT doc_id, line FROM removed").fetchall()
    got = p.repeated_paragraphs(spark.read.parquet(path)).where("removed").select("doc_id", "line").collect()
    assert sorted(map(tuple, got)) == sorted(expected) and expected


def test_small_tables(spark):
    assert run(spark, []) == {}
    line = " ".join(f"w{i}" for i in range(60))
    assert run(spark, [(2, f"short\n{line}"), (1, line)]) == {1: ([], line), 2: ([1], "short")}


def test_repeated_rows_keep_one_paragraph(spark):
    line = " ".join(f"w{i}" for i in range(60))
    assert run(spark, [(1, line), (1, line), (4, line)]) == {1: ([], line), 4: ([0], "")}


def test_bands_reach_the_recall():
    for recall in (0.9, 0.9999):
        bands, rows = p.tune_bands(0.8, recall)
        assert 1 - (1 - 0.8**rows) ** bands >= recall and bands <= p.MAX_BANDS


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a", 1)], "doc_id long, text string, removed_lines int")
    with pytest.raises(ValueError, match="removed_lines"):
        p.dedupe_paragraphs(docs)


def runs_by_force(rows, size=20):
    """The words that stay of each document: not those in runs of words which
    stand earlier, where repeats that overlap their first place count behind it."""
    seen, left = {}, {}
    for doc, text in sorted(rows):
        words = plain_words(text)
        gone = set()
        for at in range(len(words) - size + 1):
            first = seen.setdefault(tuple(words[at : at + size]), (doc, at))
            if first != (doc, at):
                low = max(at, first[1] + size) if first[0] == doc else at
                gone.update(range(low, at + size))
        left[doc] = [w for i, w in enumerate(words) if i not in gone]
    return left


def unlike(rng, n):
    return [f"u{rng.randrange(10**6)}" for _ in range(n)]


def test_passage_of_a_removed_copy_goes_elsewhere(spark):
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(40)]
    line = " ".join(unlike(rng, 100) + passage + unlike(rng, 100))
    rows = [(1, line), (2, line)]
    for i in range(3, 9):
        rows.append((i, " ".join(unlike(rng, 50) + passage + unlike(rng, 50))))
    # One task has the removed copy and later documents, not the first one.
    docs = spark.createDataFrame([(1, t, i, "x") for i, t in rows[:1]], SCHEMA).coalesce(1)
    docs = docs.union(spark.createDataFrame([(1, t, i, "x") for i, t in rows[1:]], SCHEMA).coalesce(1))
    got = {r.doc_id: r for r in p.dedupe_paragraphs(docs).collect()}
    assert got[1].text == line and got[2].removed_lines == [0]
    for i, text in rows[2:]:
        assert plain_words(got[i].text) == [w for w in plain_words(text) if w not in passage]


def test_passage_whose_first_place_goes_as_a_near_copy(spark):
    rng = random.Random(12)
    head, passage = unlike(rng, 300), [f"p{i}" for i in range(25)]
    near = head[:150] + passage + head[150:]
    rows = [(1, " ".join(head)), (2, " ".join(near))]
    for i in range(3, 8):
        rows.append((i, " ".join(unlike(rng, 50) + passage + unlike(rng, 50))))
    got = run(spark, rows)
    assert got[2] == ([0], "") and got[3] == ([], rows[2][1])
    for i, text in rows[3:]:
        assert plain_words(got[i][1]) == [w for w in plain_words(text) if w not in passage]


def test_passages_over_several_lines_go(spark):
    rng = random.Random(13)
    verse = [unlike(rng, 8) for _ in range(9)]
    rows = []
    for i in range(6):
        body = [unlike(rng, 12), *verse, unlike(rng, 12)] if i % 2 else [sum(verse, [])[:60]] * (i == 0) + [unlike(rng, 45)]
        rows.append((i, "\n\n".join(" ".join(line) for line in body)))
    got = run(spark, rows)
    assert got[0] == ([], rows[0][1]) and got[2] == ([], rows[2][1])
    assert plain_words(got[1][1]) == plain_words(rows[1][1])[:12] + plain_words(rows[1][1])[72:]
    for i in (3, 5):
        lines = rows[i][1].split("\n\n")
        assert plain_words(got[i][1]) == plain_words(lines[0] + " " + lines[-1])


def test_near_copies_of_blocks_of_short_lines_go(spark):
    rng = random.Random(14)
    block = [unlike(rng, 10) for _ in range(40)]
    near = [list(line) for line in block]
    for k in range(0, 40, 7):
        near[k][k % 10] = "edit"
    text = lambda lines: "\n".join(map(" ".join, lines))
    rows = [(1, f"Head\n\n{text(block)}"), (2, f"{text([unlike(rng, 35)])}\n{text(near)}\n\nend")]
    got = run(spark, rows)
    assert got[1] == ([], rows[0][1])
    assert got[2] == ([*range(1, 41)], rows[1][1].split("\n")[0] + "\n\nend")
    docs = spark.createDataFrame([(1, t, i, "x") for i, t in rows], SCHEMA)
    assert p.repeated_paragraphs(docs).count() == 0


@pytest.mark.parametrize("seed", [15, 16])
def test_runs_against_brute_force(spark, seed):
    rng = random.Random(seed)
    shared = [f"s{rng.randrange(400)}" for _ in range(600)]
    rows = [(900, "word " * 3000), (901, None), (902, "a b c " * 30)]
    for i in range(60):
        words = unlike(rng, 45)
        for _ in range(rng.randrange(3)):
            at = rng.randrange(570)
            words += shared[at : at + rng.randrange(5, 80)] + unlike(rng, rng.randrange(60))
        words += unlike(rng, 30)
        if i % 2:
            lines = []
            while words:
                n = rng.randrange(1, 29)
                lines.append(" ".join(words[:n]))
                words = words[n:]
            rows.append((i, "\n\n".join(lines)))
        else:
            rows.append((i, " ".join(words)))
    expected = runs_by_force([(i, t or "") for i, t in rows])
    assert sum(map(len, expected.values())) < sum(len(plain_words(t or "")) for _, t in rows) - 1000
    docs = spark.createDataFrame([(1, t, i, "x") for i, t in rows], SCHEMA).repartition(3)
    for r in p.dedupe_paragraphs(docs).collect():
        assert r.removed_lines == [] and plain_words(r.text or "") == expected[r.doc_id], r.doc_id


def test_parts_that_stand_in_different_places_are_no_passage(spark):
    rng = random.Random(17)
    words = unlike(rng, 60)
    rows = [(i, " ".join(unlike(rng, 30) + words[5 * i : 5 * i + 19] + unlike(rng, 30))) for i in range(12)]
    rows.append((50, " ".join(unlike(rng, 30) + words + unlike(rng, 30))))
    assert run(spark, rows) == {i: ([], text) for i, text in rows}


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    rng = random.Random(18)
    passage, clean = [f"p{i}" for i in range(40)], unlike(rng, 150)
    texts = [" ".join(unlike(rng, 40) + passage + unlike(rng, 40)) for _ in range(2)] + [" ".join(clean)]
    for doc_id in (None, 7):
        docs = spark.createDataFrame([("x", t, doc_id, 1) for t in texts], "__name string, text string, doc_id long, __id int")
        got = [plain_words(r.text) for r in p.dedupe_paragraphs(docs.repartition(3)).collect()]
        assert sum(set(passage) <= set(words) for words in got) == 1
        assert sorted(map(len, got)) == [80, 120, 150]
        line = " ".join(clean)
        same = [("x", f"{t}\n{line}", doc_id, 1) for t in texts[:2]] * 2
        docs = spark.createDataFrame(same, "__name string, text string, doc_id long, __id int")
        got = [r.text for r in p.dedupe_paragraphs(docs.repartition(3)).collect()]
        assert sum(line in t for t in got) == 2 and len(set(got)) == 2
