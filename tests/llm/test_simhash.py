import random

import numpy as np
import pytest
import xxhash

from tablelens.llm import simhash
from tests.llm.conftest import EDGE_TEXTS


def plain(t):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def components(ids, fps):
    comp = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = comp[i], comp[j]
                comp = [min(a, b) if c in (a, b) else c for c in comp]
    least = {}
    for c, i in zip(comp, ids):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return [least.get(c) for c in comp]


def test_masks_cover_every_pair_within_the_radius():
    ms = simhash.masks()
    assert len(ms) == 7
    for i in range(64):
        for j in range(64):
            assert any(not (1 << i | 1 << j) & m for m in ms)


def test_equals_brute_force(spark, docs_of):
    rnd = random.Random(3)
    docs = [(i, t) for i, t in enumerate(EDGE_TEXTS)]
    base = [" ".join(rnd.choice("abcdefgh") * 2 + str(rnd.randrange(99)) for _ in range(150)) for _ in range(12)]
    for k, b in enumerate(base):
        for j in range(5):
            w = b.split(" ")
            w[rnd.randrange(len(w))] = "changed" if j else w[0]
            docs.append((100 + 10 * k + j, " \n".join(w) if j % 2 else " ".join(w).upper()))
    docs += [(101, base[0]), (None, base[1]), (None, "alone here now")]
    out = simhash.near_duplicates(docs_of(docs, ["fp int", "component_id string"])).collect()
    fps = [plain(t) for _, t in docs]
    exp = sorted(((i, f"{f:016x}", c) for (i, _), f, c in zip(docs, fps, components([i for i, _ in docs], fps))), key=str)
    assert sorted((tuple(r) for r in out), key=str) == exp
    assert simhash.near_duplicates(docs_of(docs).filter("false")).count() == 0


@pytest.mark.parametrize("seed", [5])
def test_links_find_every_close_pair(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 40)
    fps = set(int(c) for c in centres)
    for c in centres:
        for _ in range(12):
            f = int(c)
            for b in rng.integers(0, 64, rng.integers(1, 4)):
                f ^= 1 << int(b)
            fps.add(f - (1 << 64) if f >> 63 else f)
    fps = sorted(fps)
    found = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    rows = [(r.a, r.b) for r in found.collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in rows)
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in rows:
        parent[root(a)] = root(b)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
                assert root(a) == root(b)
