"""Beta and chi-square distribution functions on numpy arrays."""

from __future__ import annotations

import math

import numpy as np

_TINY = 1e-300
TERMS = 20_000  #: of the continued fraction; it takes about as many as the root of the larger parameter


def _lgamma(x: np.ndarray) -> np.ndarray:
    return np.array([math.lgamma(v) for v in np.ravel(x)]).reshape(np.shape(x))


def _log_beta(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log B(a, b). For a large argument the difference of two log-gammas comes from Stirling's series, term by term,
    as the log-gammas themselves agree in most of their digits."""
    small, large = np.minimum(a, b), np.maximum(a, b)
    direct = _lgamma(large) - _lgamma(small + large)
    z = np.maximum(large, 20.0)

    def rest(v):
        return 1 / (12 * v) - 1 / (360 * v ** 3) + 1 / (1260 * v ** 5) - 1 / (1680 * v ** 7)

    series = small - (z - 0.5) * np.log1p(small / z) - small * np.log(z + small) + rest(z) - rest(z + small)
    return _lgamma(small) + np.where(large > 20.0, series, direct)


def beta_cdf(x, a, b):
    """Regularised incomplete beta I_x(a, b), by its continued fraction; an error where it does not converge."""
    x, a, b = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (x, a, b)))
    # the complement converges sooner beyond the mean, but where x is tiny and b huge it has lost the digits of x
    swap = (x > (a + 1.0) / (a + b + 2.0)) & ~((x < 1e-3) & ((a + b) * x < 30.0))
    y = np.where(swap, 1.0 - x, x)
    p, q = np.where(swap, b, a), np.where(swap, a, b)
    inside = (y > 0) & (y < 1)
    y_in = np.where(inside, y, 0.5)
    # both logs from x itself: 1 - y has lost the digits of a small x
    x_in = np.where(inside, x, 0.5)
    log_x, log_rest = np.log(x_in), np.log1p(-x_in)
    log_front = p * np.where(swap, log_rest, log_x) + q * np.where(swap, log_x, log_rest) - _log_beta(p, q)

    c = np.ones_like(y_in)
    d = 1.0 - (p + q) * y_in / (p + 1.0)
    d = 1.0 / np.where(np.abs(d) < _TINY, _TINY, d)
    total = d.copy()
    for m in range(1, TERMS):
        before = total.copy()
        even = m * (q - m) * y_in / ((p + 2 * m - 1) * (p + 2 * m))
        odd = -(p + m) * (p + q + m) * y_in / ((p + 2 * m) * (p + 2 * m + 1))
        for step in (even, odd):
            d = 1.0 + step * d
            d = 1.0 / np.where(np.abs(d) < _TINY, _TINY, d)
            c = 1.0 + step / c
            c = np.where(np.abs(c) < _TINY, _TINY, c)
            total = total * c * d
        # a nan stays one
        if np.all((np.abs(total - before) <= 2e-15 * np.abs(total)) | np.isnan(total)):
            break
    else:
        raise ArithmeticError("the continued fraction of the incomplete beta function did not converge")
    value = np.exp(log_front) * total / p
    value = np.where(inside, value, np.where(np.isnan(y), np.nan, np.where(y <= 0, 0.0, 1.0)))
    return np.where(swap, 1.0 - value, value)


def beta_quantile(prob, a, b):
    """Inverse of ``beta_cdf`` by Newton steps kept inside a bracket; nan where a or b is not positive."""
    prob, a, b = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (prob, a, b)))
    valid = (a > 0) & (b > 0)
    a, b = np.where(valid, a, 1.0), np.where(valid, b, 1.0)
    log_norm = -_log_beta(a, b)
    low, high = np.zeros(a.shape), np.ones(a.shape)
    x = a / (a + b)
    for _ in range(100):
        gap = beta_cdf(x, a, b) - prob
        low, high = np.where(gap < 0, x, low), np.where(gap < 0, high, x)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            step = x - gap / np.exp(log_norm + (a - 1) * np.log(x) + (b - 1) * np.log1p(-x))
        inside = (step > low) & (step < high)
        following = np.where(inside, step, 0.5 * (low + high))
        done = np.abs(following - x) <= 1e-13 * x
        x = following
        if done.all():
            break
    return np.where(valid, x, np.nan)


def chi2_tail(x: float, df: float) -> float:
    """P(X > x) for a chi-square variable, from the incomplete gamma function."""
    if x <= 0:
        return 1.0
    s, z = df / 2.0, x / 2.0
    front = math.exp(s * math.log(z) - z - math.lgamma(s))
    if z < s + 1.0:
        term = total = 1.0 / s
        for k in range(1, 10000):
            term *= z / (s + k)
            total += term
            if term < total * 1e-16:
                break
        return max(0.0, 1.0 - front * total)
    b = z + 1.0 - s
    c, d = 1.0 / _TINY, 1.0 / b
    total = d
    for k in range(1, 10000):
        a = -k * (k - s)
        b += 2.0
        d = a * d + b
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = b + a / c
        c = c if abs(c) > _TINY else _TINY
        total *= c * d
        if abs(c * d - 1.0) < 1e-16:
            break
    return front * total
