import random
from fractions import Fraction

import pytest

from tablelens.llm import mixing


def fill(sizes):
    """Water filling by repeated resharing; sizes by source in order."""
    weights = {s: [5, 2, 1][i % 3] for i, s in enumerate(sizes)}
    total, capped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in sizes if s not in capped]
        w = sum(weights[s] for s in open_)
        if not w:
            return capped
        level = Fraction(total - sum(capped.values()), w)
        above = [s for s in open_ if weights[s] * level > 3 * sizes[s]]
        if not above:
            return capped | {s: weights[s] * level for s in open_}
        capped |= {s: 3 * sizes[s] for s in above}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_budgets(spark, docs_of, seed):
    rnd = random.Random(seed)
    sources = ["a", "B", "é", "東", "z1", "z2", None][: 3 + 2 * seed]
    docs = []
    for i in range(200):
        s = rnd.choice([sources[0], sources[0], *sources])
        docs.append((i, " ".join("w" for _ in range(rnd.choice([0, 1, 5, 40]))), "en", s))
    docs += [(7, "x y", "en", "a"), (None, "p q r", "en", "a"), (500, None, "en", "empty"), (501, "", "en", "empty")]
    rows = mixing.mix(docs_of(docs, ["size int", "target string", "_key int"])).collect()
    sizes = {}
    for _, t, _, s in docs:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    sizes = dict(sorted(sizes.items(), key=lambda x: (x[0] is None, (x[0] or "").encode())))
    exp = fill(sizes)
    assert len(rows) == len(docs)
    for s in sizes:
        mine = [r for r in rows if r.source == s]
        assert all(abs(r.target - float(exp[s])) < 1e-6 and r.source_size == sizes[s] for r in mine)
        assert sum(r.taken for r in mine) == int(exp[s] + Fraction(1, 2))
        assert all(r.epochs * r["size"] <= r.taken <= min((r.epochs + 1), 3) * r["size"] for r in mine)
    again = mixing.mix(docs_of(docs, ["size int"])).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert mixing.mix(docs_of(docs).filter("false")).count() == 0


def test_cut_texts_take_what_the_mix_says(spark, docs_of):
    docs = docs_of([(i, " ".join(f"w{j}" for j in range(10 + i)), "en", "ab"[i % 2]) for i in range(20)])
    mixed = mixing.mix(docs)
    got = {}
    for r in mixing.cut_texts(docs, mixed).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.split())
    assert got == {r.doc_id: r.taken for r in mixed.collect() if r.taken}


def test_cut_texts_with_null_and_repeated_ids(spark, docs_of):
    rows = [(i % 3, " ".join(f"w{j}" for j in range(4 + i % 5)), "en", "ab"[i % 2]) for i in range(12)]
    rows += [(None, "p q r", "en", "a"), (None, "s t u", "en", "a"), (None, "x y", "en", None), (1, "p q", "en", "a"), (1, "p q", "en", "a")]
    docs = docs_of(rows)
    mixed = mixing.mix(docs)
    taken, got = {}, {}
    for r in mixed.collect():
        taken[r.source] = taken.get(r.source, 0) + r.taken
    found = mixing.cut_texts(docs, mixed).collect()
    for r in found:
        got[r.source] = got.get(r.source, 0) + len(r.text.split())
    assert got == taken and any(r.doc_id is None for r in found)
