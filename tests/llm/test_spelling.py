import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tablelens.llm import spelling

LETTERS = "abcdefghijklmnopqrstuvwxyzéß÷À"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs):
    found = Counter()
    for k, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if k is None else k}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            found[w] += 1
    n = {w: c for w, c in found.items() if len(w) >= 7 and c >= 2}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, docs_of, seed):
    rnd = random.Random(seed)

    def changed(w):
        at = rnd.randrange(len(w) + 1)
        return rnd.choice([w[:at] + rnd.choice(LETTERS) + w[at:], w[:at] + w[at + 1 :], w[:at] + rnd.choice(LETTERS) + w[at + 1 :]])

    bases = ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(5, 12))) for _ in range(25)]
    words = bases * 30 + [changed(b) for b in bases for _ in range(12)] * 2 + [changed(changed(b)) for b in bases] * 2
    words += ["chainsword"] * 300 + ["chainswore"] * 20 + ["chainswure"] * 2
    words = [w.upper() if rnd.random() < 0.1 and w.isascii() else w for w in words]
    rnd.shuffle(words)
    docs = [(i, rnd.choice([" ", "-", "1", "ř"]).join(words[i::60])) for i in range(60)]
    docs += [(7, docs[7][1]), (None, docs[3][1]), (70, None), (71, ""), (72, "ab CD"), (73, "A" * 5000 + " " + "a" * 4999), (74, "A" * 5000 + " " + "a" * 4999)]
    want = brute(docs)
    assert got(spelling.variants(docs_of(docs, ["word string", "n int", "reduced int"]))) == want
    assert any(r[1] != r[2] for r in want if r[1])  # some chain has two steps


def test_neighbourhood_is_whole_and_without_repeats():
    words = ["aabbcab", "zzzzzzz", "thstion", "ébéable"]
    table = spelling.symbol_table(3)

    def reduced(w):
        return [int(table[ord(c)]) for c in w]

    def hashed(symbols):
        up = spelling._powers(spelling._BASE, len(symbols))
        return int(spelling.mix(((np.array(symbols, dtype=np.uint64) + np.uint64(1)) * up).sum(keepdims=True))[0])

    made = {i: [] for i in range(len(words))}
    for rows, h in spelling.neighbourhood(words, 3):
        for r, x in zip(rows.tolist(), h.tolist(), strict=True):
            made[r].append(x)
    for i, w in enumerate(words):
        s = reduced(w)
        want = {tuple(s)} | {(*s[:j], *s[j + 1 :]) for j in range(len(s))}
        want |= {(*s[:j], c, *s[j + 1 :]) for j in range(len(s)) for c in range(3)} | {(*s[:j], c, *s[j:]) for j in range(len(s) + 1) for c in range(3)}
        assert len(made[i]) == len(set(made[i])) and set(made[i]) == {hashed(x) for x in want}


def test_pieces_of_long_words(monkeypatch):
    words = ["abcdefghijklmnop" * 3, "qrstuvwxyz" * 5]
    whole = sorted((r, x) for rows, h in spelling.neighbourhood(words) for r, x in zip(rows.tolist(), h.tolist(), strict=True))
    monkeypatch.setattr(spelling, "CELLS", 100)
    assert sorted((r, x) for rows, h in spelling.neighbourhood(words) for r, x in zip(rows.tolist(), h.tolist(), strict=True)) == whole


def test_empty_table(spark, docs_of):
    assert spelling.variants(docs_of(["a b"]).filter("false")).count() == 0
    assert spelling.variants(docs_of(["abcdefg", None])).count() == 0
