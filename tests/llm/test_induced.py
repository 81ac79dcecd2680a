import random

import numpy as np
import pytest

from tablelens.llm import induced


def plain_order(t):
    return sorted(range(len(t)), key=lambda i: tuple(t[i:].tolist()), reverse=True)


def prefix(t, a, b):
    k = 0
    while max(a, b) + k < len(t) and t[a + k] == t[b + k]:
        k += 1
    return k


@pytest.mark.parametrize("seed", range(40))
@pytest.mark.parametrize("memory", [0, 1 << 20])
def test_order_and_common_prefixes(seed, memory, monkeypatch):
    rnd = random.Random(seed)
    monkeypatch.setattr(induced, "BLOCK", 7 if seed % 2 else 1 << 18)
    alphabet = bytes(range(1 + seed % 5)) + b"\xff"
    strings = [bytes(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 40))) for _ in range(rnd.randrange(1, 8))]
    strings += [strings[0], b"a" * 30, strings[0][:5] + strings[-1]]
    t = induced.join_strings(strings)
    got = list(induced.suffixes_descending(t, memory))
    pos = np.concatenate([p for p, _ in got]).tolist()
    lcp = np.concatenate([x for _, x in got]).tolist()
    order = plain_order(t)
    if order[-1] not in pos:  # the closing separator, smallest of all, induces nothing
        order = order[:-1]
    assert pos == order
    assert lcp[1:] == [prefix(t, a, b) for a, b in zip(pos, pos[1:])]


def test_repeated_windows():
    rnd = random.Random(1)
    shared = bytes(rnd.randrange(256) for _ in range(60))
    strings = [bytes(rnd.randrange(256) for _ in range(80)) + shared[rnd.randrange(20) :] for _ in range(30)]
    t = induced.join_strings(strings)
    width = 25
    found = induced.repeated(t, width)
    seen = {}
    for i in range(len(t) - width + 1):
        seen.setdefault(t[i : i + width].tobytes(), []).append(i)
    exp = np.zeros(len(t), dtype=bool)
    for at in seen.values():
        if len(at) > 1:
            exp[at] = True
    assert (found == exp).all()
