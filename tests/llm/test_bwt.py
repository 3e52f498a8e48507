import numpy as np
import pytest

from asksift.llm.bwt import repeats_of_length


@pytest.mark.parametrize("seed", range(40))
def test_classes_are_the_distinct_strings(seed):
    rng = np.random.default_rng(seed)
    length = int(rng.integers(2, 9))
    parts = [rng.integers(1, 4, rng.integers(1, 30)) for _ in range(rng.integers(1, 6))]
    parts += [parts[0]] * (seed % 3)
    text = np.concatenate([np.append(p, 0) for p in parts]).astype(np.uint8)
    order, new = repeats_of_length(text, length)
    assert sorted(order.tolist()) == list(range(len(text)))
    raw, found = text.tobytes(), {}
    for kind, place in zip(np.cumsum(new).tolist(), order.tolist()):
        piece = raw[place : place + length]
        if len(piece) == length and 0 not in piece:
            found.setdefault(kind, set()).add(piece)
    whole = {raw[i : i + length] for i in range(len(raw) - length + 1)}
    assert all(len(v) == 1 for v in found.values())
    assert {x for v in found.values() for x in v} == {x for x in whole if 0 not in x}
    assert len(found) == len({x for x in whole if 0 not in x})
