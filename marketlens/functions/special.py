"""Logarithm of the gamma function and its derivative, on numpy arrays of positive numbers."""

from __future__ import annotations

import numpy as np

# The series of Stirling's formula (Bernoulli numbers over k (k - 1), and over k, for k = 2, 4, ...).
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)
HARMONIC = (1 / 12, -1 / 120, 1 / 252, -1 / 240, 1 / 132, -691 / 32760)
#: Smaller arguments are moved up to this by the recurrence; the series is right to about 1e-14 from there.
LEAST = 10.0


def log_gamma(x) -> np.ndarray:
    x = np.array(x, np.float64, ndmin=1)
    moved = np.zeros_like(x)
    while (low := x < LEAST).any():
        moved[low] += np.log(x[low])
        x = np.where(low, x + 1.0, x)
    r = 1.0 / (x * x)
    series = np.polyval(STIRLING[::-1], r) / x
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + series - moved


def digamma(x) -> np.ndarray:
    x = np.array(x, np.float64, ndmin=1)
    moved = np.zeros_like(x)
    while (low := x < LEAST).any():
        moved[low] += 1.0 / x[low]
        x = np.where(low, x + 1.0, x)
    r = 1.0 / (x * x)
    return np.log(x) - 0.5 / x - r * np.polyval(HARMONIC[::-1], r) - moved
