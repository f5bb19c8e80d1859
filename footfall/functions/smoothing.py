"""Seasonal-trend decomposition by loess for one reduced series.

Follows the method published by Cleveland, Cleveland, McRae and Terpenning (1990)
with local linear fits at every point. It is called per series inside a grouped
Spark job, on hourly totals.
"""

from __future__ import annotations

import math

import numpy as np


class LocalLine:
    """Local linear regression with tricube weights at fixed evaluation points.

    Windows and distances depend only on the number of points, so they are worked
    out once and reused for every pass over the data.
    """

    def __init__(self, n: int, span: int, at: np.ndarray):
        width = min(span, n)
        left = np.clip(at - (span - 1) // 2, 0, n - width)
        self.index = left[:, None] + np.arange(width)
        self.offset = self.index - at[:, None]
        reach = np.maximum(at - left, left + width - 1 - at) + max(0, (span - n) // 2)
        nearness = np.abs(self.offset) / np.maximum(reach, 1)[:, None]
        self.kernel = np.where(nearness <= 0.999, (1 - np.minimum(nearness, 1) ** 3) ** 3, 0.0)
        self.kernel[nearness <= 0.001] = 1.0
        self.flat = (0.001 * (n - 1)) ** 2

    def __call__(self, y: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
        w = self.kernel if weight is None else self.kernel * weight[self.index]
        total = w.sum(axis=1, keepdims=True)
        w = w / np.where(total > 0, total, 1.0)
        centre = (w * self.offset).sum(axis=1, keepdims=True)
        deviation = self.offset - centre
        spread = (w * deviation**2).sum(axis=1, keepdims=True)
        tilt = np.where(spread > self.flat, -centre / np.where(spread > 0, spread, 1.0), 0.0)
        fitted = (w * (1 + tilt * deviation) * y[self.index]).sum(axis=1)
        # with no weight left in a window the observation itself stands
        own = y[np.clip(self.index[:, 0] - self.offset[:, 0], 0, len(y) - 1)]
        return np.where(total[:, 0] > 0, fitted, own)


def moving_average(y: np.ndarray, width: int) -> np.ndarray:
    return np.convolve(y, np.full(width, 1.0 / width), mode="valid")


def _odd(value: float) -> int:
    whole = math.ceil(value)
    return whole if whole % 2 else whole + 1


def bisquare(residual: np.ndarray) -> np.ndarray:
    """Weights that fade out residuals of up to six median absolute residuals."""
    size = np.abs(residual)
    limit = 6.0 * np.median(size)
    if limit == 0:
        return np.ones_like(size)
    weight = (1 - np.minimum(size / limit, 1) ** 2) ** 2
    weight[size <= 0.001 * limit] = 1.0
    weight[size > 0.999 * limit] = 0.0
    return weight


def robust_stl(
    y: np.ndarray, period: int, seasonal_span: int = 7, inner: int = 2, outer: int = 15
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trend, seasonal component and robustness weights of an evenly spaced series."""
    n = len(y)
    trend_span = _odd(1.5 * period / (1 - 1.5 / seasonal_span))
    trend_line = LocalLine(n, trend_span, np.arange(n))
    low_line = LocalLine(n, _odd(period + 1), np.arange(n))
    phases = [np.arange(start, n, period) for start in range(period)]
    lines = {
        size: LocalLine(size, seasonal_span, np.arange(-1, size + 1))
        for size in {len(p) for p in phases}
    }
    trend, seasonal, weight = np.zeros(n), np.zeros(n), None
    for passes in range(outer + 1):
        for _ in range(inner):
            detrended = y - trend
            # each phase is smoothed and continued by one period at both ends
            cycle = np.empty(n + 2 * period)
            for start, where in enumerate(phases):
                smooth = lines[len(where)](
                    detrended[where], None if weight is None else weight[where]
                )
                cycle[start :: period][: len(smooth)] = smooth
            level = moving_average(moving_average(moving_average(cycle, period), period), 3)
            seasonal = cycle[period : period + n] - low_line(level)
            trend = trend_line(y - seasonal, weight)
        if passes < outer:
            weight = bisquare(y - trend - seasonal)
    return trend, seasonal, np.ones(n) if weight is None else weight
