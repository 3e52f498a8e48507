import numpy as np
import pytest

from asksift.llm import licences as lic

SCHEMA = "statement string, text string, doc_id long"
BACKGROUND = [" ".join(f"w{(i * j) % 97}" for j in range(20)) for i in range(60)] + [
    "The green river and the old stone.", "They came by the long road of the hills.",
]


@pytest.fixture(scope="module")
def model():
    return lic.fit_licences(BACKGROUND)


def plain(model, line):
    """The same decision, one line at a time in plain Python."""
    grams = {g for g in lic.grams_of(lic.words_of(line), set(model.vocabulary))} & set(model.grams)
    if not grams:
        return None
    rows = [model.grams.index(g) for g in grams]
    logits = (model.weights[rows].sum(0) + model.intercept) / model.temperature
    chance = np.exp(logits - logits.max())
    chance /= chance.sum()
    best = model.classes[int(chance.argmax())]
    if best == lic.NONE:
        return None
    family = best if best != lic.UNKNOWN and chance.max() >= model.threshold else lic.UNKNOWN
    own = set()
    words = lic.words_of(line)
    for size in (1, 2, 3):
        own |= {" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}
    shares = [
        len(own & grams) / len(grams)
        for text in lic.STATEMENTS.get(family, [])
        for grams in [lic.grams_of(lic.words_of(text), set(lic.words_of(text)))]
    ]
    return family, round(float(chance.max()), 9), round(max(shares, default=0.0), 9)


def scan(spark, model, texts):
    df = spark.createDataFrame([("x", t, i) for i, t in enumerate(texts)], SCHEMA).repartition(2)
    return lic.scan_licences(df, model)


def test_against_plain_python(spark, model):
    texts = ["\n".join(g) for g in lic.STATEMENTS.values()] + lic.OTHER_STATEMENTS + lic.PLAIN_SENTENCES
    texts += [None, "", "\n\n", "no licence here\nReleased under the MIT License.", "word " * 5000 + "All rights reserved."]
    expected = {}
    for i, text in enumerate(texts):
        for n, line in enumerate((text or "").split("\n")):
            if (found := plain(model, line)) is not None:
                expected[i, n] = found
    rows = scan(spark, model, texts).collect()
    got = {(r.doc_id, r.paragraph): (r.family, round(r.probability, 9), round(r.overlap, 9)) for r in rows if r.lines == 1}
    assert got == expected
    for r in rows:
        if r.lines > 1:
            assert r.confirmed and r.text == "\n".join(texts[r.doc_id].split("\n")[r.paragraph : r.paragraph + r.lines])
            inside = [expected.get((r.doc_id, r.paragraph + i)) for i in range(r.lines)]
            assert all(x is None or x[0] != r.family or x[2] < round(r.overlap, 9) for x in inside)


def wrapped(text, width):
    words, lines = text.split(), [""]
    for w in words:
        if lines[-1] and len(lines[-1]) + len(w) >= width:
            lines.append("")
        lines[-1] = f"{lines[-1]} {w}".strip()
    return "\n".join(lines)


def test_wrapped_statements_are_found_and_confirmed(spark, model):
    long = [(f, t) for f, group in lic.STATEMENTS.items() for t in group if len(t) > 120]
    texts = [f"Some text here.\n\n{wrapped(t, 45)}\n \nMore text, of rivers and stones." for _, t in long]
    rows = scan(spark, model, texts).where("lines > 1").collect()
    found = {r.doc_id: r for r in rows}
    assert len(long) >= 3 and len(rows) == len(found)
    for i, (family, text) in enumerate(long):
        assert found[i].family == family and found[i].confirmed and found[i].paragraph == 2
        assert found[i].text == wrapped(text, 45) and found[i].overlap == 1.0


def test_statements_are_found_and_confirmed(spark, model):
    lines = [(f, s) for f, group in lic.STATEMENTS.items() for s in group]
    rows = {r.doc_id: r for r in scan(spark, model, [s for _, s in lines]).collect()}
    right = [rows[i].family == f and rows[i].confirmed for i, (f, _) in enumerate(lines) if i in rows]
    assert sum(right) >= 0.95 * len(lines)


def test_plain_sentences_are_left_alone(spark, model):
    assert scan(spark, model, lic.PLAIN_SENTENCES + BACKGROUND).where("family <> 'unknown'").count() == 0


def test_main_path_has_no_python(spark, model):
    plan = scan(spark, model, ["All rights reserved."])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_repeated_rows_and_empty_table(spark, model):
    df = spark.createDataFrame([("x", "All rights reserved.", 1)] * 3, SCHEMA)
    rows = lic.scan_licences(df, model).collect()
    assert len(rows) == 3 and len({r.probability for r in rows}) == 1
    assert lic.scan_licences(df.limit(0), model).count() == 0
