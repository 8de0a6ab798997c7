"""The order choice of the autoregressive model against a plain grid on simulated series."""

import numpy as np
import pytest

from gridstone.operators.models import autoregression, bounded, chosen_order


def plain_order(d, e, long, most):
    """AIC of every order by normal equations, row by row, on the observations that all of them have."""
    start, found = long + most, []
    for p in range(most + 1):
        for q in range(most + 1):
            if p + q == 0:
                continue
            rows = [[1.0, *[d[t - j] for j in range(1, p + 1)], *[e[t - j] for j in range(1, q + 1)]] for t in range(start, len(d))]
            x, y = np.array(rows), np.array(d[start:])
            beta = np.linalg.pinv(x.T @ x) @ x.T @ y
            found.append((len(y) * np.log(np.mean((y - x @ beta) ** 2)) + 2 * (p + q + 1), p, q))
    return min(found)[1:]


@pytest.mark.parametrize("seed", range(6))
def test_orders_are_compared_on_the_same_observations(seed):
    rng = np.random.default_rng(seed)
    d, e = [0.0] * 3, rng.normal(size=203)
    for t in range(3, 203):
        d.append((0.7 if seed % 2 else 0.2) * d[t - 1] + (-0.5 if seed > 2 else 0.0) * d[t - 2] + e[t] + 0.4 * e[t - 1])
    d, long = np.array(d), 4

    def fitted(p, q, rows):
        seen.append((rows[0], len(rows)))
        x = np.column_stack([np.ones(len(rows)), *[d[rows - j] for j in range(1, p + 1)], *[e[rows - j] for j in range(1, q + 1)]])
        beta = np.linalg.lstsq(x, d[rows], rcond=None)[0]
        return beta, d[rows] - x @ beta

    seen = []
    assert chosen_order(len(d), long, 3, fitted) == plain_order(d, e, long, 3)
    assert len(seen) == 15 and len(set(seen)) == 1


def test_short_and_steady_series():
    assert autoregression(np.array([1.0, 2.0]), 3) is None and autoregression(np.array([5.0]), 1) is None
    for n in (8, 9, 12, 40):
        out = autoregression(10.0 + 2.0 * np.arange(n), 3)
        assert out == pytest.approx(10.0 + 2.0 * np.arange(n, n + 3), abs=1e-6)


def test_explosive_coefficients_are_drawn_in():
    rng = np.random.default_rng(3)
    for _ in range(50):
        beta = rng.normal(size=3)
        for sign in (1, -1):
            roots, new = np.roots([1.0, *(-sign * beta)]), np.roots([1.0, *(-sign * bounded(beta, sign))])
            want = roots if np.abs(roots).max() <= 1 else roots * 0.98 / np.abs(roots).max()
            assert np.poly(new) == pytest.approx(np.poly(want))
    assert len(bounded(np.array([]), 1)) == 0
    y = np.cumsum(np.cumsum(1.5 ** np.arange(14)) + rng.normal(size=14))
    assert autoregression(y, 60).max() < 1000 * y.max()
