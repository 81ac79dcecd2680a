"""The k nearest rows of a block: exact, in bounded memory."""

import tracemalloc

import numpy as np
import pytest

from tablelens.operators import models as MD


def _plain(xq, xt, k):
    d = np.zeros((len(xq), len(xt)))
    for j in range(xq.shape[1]):
        d += (xq[:, j][:, None] - xt[:, j][None, :]) ** 2
    at = np.argsort(d, axis=1, kind="stable")[:, :k]
    rows = np.repeat(np.arange(len(xq)), at.shape[1])
    return rows, at.reshape(-1), d[rows, at.reshape(-1)]


def _cases():
    rnd = np.random.default_rng(3)
    x, t = rnd.standard_normal((70, 16)), rnd.standard_normal((900, 16))
    yield "plain", x, t
    yield "far from the origin", x * 1e-3 + 1e6, t * 1e-3 + 1e6  # a matrix product alone cannot order these
    yield "ties", rnd.integers(0, 2, (70, 3)).astype(float), rnd.integers(0, 2, (900, 3)).astype(float)
    yield "copies", x, np.repeat(t[:300], 3, axis=0)
    yield "constant", np.full((70, 2), 1.5), np.full((900, 2), 1.5)
    odd = t.copy()
    odd[5, 3], odd[9, 1] = np.nan, np.inf
    yield "not finite", x, odd
    yield "huge", x * 1e200, t * 1e200
    yield "few rows", x, t[:4]
    yield "no column", np.zeros((5, 0)), np.zeros((20, 0))
    yield "wide range", x * 10.0 ** rnd.integers(-8, 8, (70, 1)), t * 10.0 ** rnd.integers(-8, 8, (900, 1))


@pytest.mark.parametrize("name, xq, xt", list(_cases()), ids=lambda v: v if isinstance(v, str) else "")
@pytest.mark.parametrize("cells", [1 << 19, 2000])
def test_equals_all_distances_sorted(monkeypatch, name, xq, xt, cells):
    monkeypatch.setattr(MD, "PAIR_CELLS", cells)
    with np.errstate(over="ignore", invalid="ignore"):
        for got, want in zip(MD.nearest_rows(xq, xt, 7), _plain(xq, xt, 7), strict=True):
            np.testing.assert_array_equal(got, want)


@pytest.mark.parametrize("same", [False, True])
def test_a_block_takes_little_memory(same):
    rnd = np.random.default_rng(4)
    x = np.ones((4096, 2)) if same else rnd.standard_normal((4096, 16))
    tracemalloc.start()
    MD.nearest_rows(x, x, 7)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6  # 4096 x 4096 distances alone are 134 MB


def test_most_distances_are_never_summed(monkeypatch):
    rnd = np.random.default_rng(5)
    monkeypatch.setattr(MD, "_distances", lambda *a: pytest.fail("all distances summed"))
    MD.nearest_rows(rnd.standard_normal((100, 64)), rnd.standard_normal((4096, 64)), 7)
