"""The tile kernels of the pair comparison against full matrices of doubles, without Spark."""

import numpy as np
import pytest

from neardup.config import SIM_DECIMALS
from neardup.operators import pairs


def sorted_rows(n, dim, seed, spread=0.01):
    rng = np.random.default_rng(seed)
    rows = np.abs(rng.normal(size=(n, dim)))
    # Near ties, beyond what single precision tells apart, and exact ones.
    rows[n // 2 :] = rows[: n - n // 2] + spread * rng.normal(size=(n - n // 2, dim))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    rows[n // 3 : n // 3 + 5] = rows[0] + 1e-9 * rng.normal(size=(5, dim))
    rows[n // 3 + 5 : n // 3 + 8] = rows[1]
    return rows


@pytest.mark.parametrize("scale", [1.0, 1e-30, 1e30, 1e-120])
def test_quick_tiles_stay_within_their_margin(scale):
    rows = sorted_rows(700, 64, 1) * scale * np.logspace(0, 6, 700)[:, None]
    products = pairs._Products(rows)
    assert products.quick.dtype == (np.float64 if scale == 1e-120 else np.float32)
    a, b = np.arange(300), np.arange(200, 700)
    quick, margin = products.tile(a, b)
    off = np.abs(quick.astype(np.float64) * products.square - rows[a] @ rows[b].T)
    assert off.max() <= margin * products.square


@pytest.mark.parametrize("spread", [0.01, 1e-7, 0.0])
@pytest.mark.parametrize("turned", [False, True])
def test_raised_finds_the_exact_maximum_and_its_first_row(spread, turned):
    rows = sorted_rows(600, 48, 2, spread)
    products = pairs._Products(rows)
    a, b = np.arange(250), np.arange(250, 600)
    sims = np.round(rows[a] @ rows[b].T, SIM_DECIMALS)
    quick, margin = products.tile(b, a) if turned else products.tile(a, b)
    quick = quick.T if turned else quick
    best = np.full(len(b), -np.inf)
    best[::3] = 0.99
    at, row, value = products.raised(quick, margin, a, b, best, SIM_DECIMALS)
    above = sims.max(axis=0) > best + 2e-12
    assert set(np.flatnonzero(above)) <= set(at)
    assert np.abs(value - sims.max(axis=0)[at]).max() <= 2e-12
    near = sims[:, at] >= sims[:, at].max(axis=0) - 2e-12
    assert near[row, np.arange(len(at))].all()
    low = np.full(len(b), -np.inf)
    at, _, value = products.raised(quick, margin, a, b, low, sign=-1)
    assert len(at) == len(b) and np.allclose(-value, (rows[a] @ rows[b].T).min(axis=0), atol=1e-14)


@pytest.mark.parametrize("same", [True, False])
def test_sums_extremes_and_counts_equal_full_matrices(monkeypatch, same):
    import pyarrow as pa

    monkeypatch.setattr(pairs, "_TILE", 128)
    rows = sorted_rows(500, 32, 3)
    n = np.random.default_rng(4).integers(1, 4, 500)
    every = np.arange(500)
    left, right = (every, every) if same else (every[::2], every[1::2])
    products, eps = pairs._Products(rows), [0.01, 0.03, 0.07, 0.6]
    sums = pairs._SumsOverOthers(pa.table({"_n": n}), products, left, right, same, eps)
    for a, b, diagonal in pairs._tiles(left, right, same):
        sums.tile(a, b, *products.tile(a, b), diagonal)
    sims = rows @ rows.T
    weight = np.tile(n, (500, 1)) - (np.eye(500, dtype=int) if same else 0)
    if not same:
        weight = weight * ((every[:, None] + every) % 2)
    assert np.allclose(sums.total, (sims * weight).sum(axis=1), atol=1e-9)
    assert np.allclose(sums.squares, (sims * sims * weight).sum(axis=1), atol=1e-9)
    assert np.allclose(sums.top, np.where(weight > 0, sims, -np.inf).max(axis=1), atol=1e-14)
    assert np.allclose(sums.low, np.where(weight > 0, sims, np.inf).min(axis=1), atol=1e-14)
    for e, value in enumerate(eps):
        want = (weight * (np.round(sims, SIM_DECIMALS) > 1 - value)).sum(axis=1)
        assert (sums.over[e] == want).all()
