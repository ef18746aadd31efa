"""Seasonal-trend decomposition by LOESS (Cleveland, Cleveland, McRae, Terpenning 1990)."""

from __future__ import annotations

import numpy as np

SEASONAL_SPAN = 7
INNER_LOOPS, OUTER_LOOPS = 2, 15
#: A residual below this share of the values is rounding and takes no weight away.
NOISE = 1e-9


def _odd(n: int) -> int:
    return n if n % 2 else n + 1


def loess(y: np.ndarray, span: int, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Local linear fits of the rows of ``y`` (series, n) at the positions ``at``."""
    n = y.shape[1]
    width = min(span, n)
    first = np.clip(at - (width - 1) // 2, 0, n - width)
    near = first[:, None] + np.arange(width)
    offset = near - at[:, None]
    reach = np.abs(offset).max(1) + (span - n) // 2 * (span > n)
    u = np.abs(offset) / np.maximum(reach, 1)[:, None]
    kernel = np.where(u <= 0.001, 1.0, np.where(u > 0.999, 0.0, (1 - u ** 3) ** 3))
    w = kernel * weights[:, near]
    total = w.sum(2)
    usable = total > 0
    w = w / np.where(usable, total, 1.0)[..., None]
    # Weighted centre and spread of the positions, measured from the fitted point.
    centre = (w * offset).sum(2)
    spread = (w * (offset - centre[..., None]) ** 2).sum(2)
    tilted = np.sqrt(spread) > 0.001 * (n - 1)
    slope = np.where(tilted, -centre / np.where(tilted, spread, 1.0), 0.0)
    fitted = (w * (1 + slope[..., None] * (offset - centre[..., None])) * y[:, near]).sum(2)
    return np.where(usable, fitted, y[:, np.clip(at, 0, n - 1)])


def _moving_average(x: np.ndarray, width: int) -> np.ndarray:
    total = np.cumsum(np.concatenate([[0.0], x]))
    return (total[width:] - total[:-width]) / width


def _cycle_smooth(detrended: np.ndarray, weights: np.ndarray, period: int) -> np.ndarray:
    """Smooth each phase's subseries, one step beyond both ends."""
    n = len(detrended)
    out = np.empty(n + 2 * period)
    for length in {len(range(p, n, period)) for p in (0, period - 1)}:
        phases = np.array([p for p in range(period) if len(range(p, n, period)) == length])
        cells = phases[:, None] + period * np.arange(length)
        smooth = loess(detrended[cells], SEASONAL_SPAN, np.arange(-1, length + 1), weights[cells])
        out[phases[:, None] + period * np.arange(length + 2)] = smooth
    return out


def stl(y: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Robust trend, seasonal and residual of one evenly spaced series."""
    n = len(y)
    if n < 2 * period:
        raise ValueError(f"{n} values are fewer than two periods of {period}")
    if not np.isfinite(y).all():
        raise ValueError("the series has missing or infinite values")
    trend_span = _odd(int(np.ceil(1.5 * period / (1 - 1.5 / SEASONAL_SPAN))))
    low_span = _odd(period + 1)
    here, ones = np.arange(n), np.ones((1, n))
    trend, seasonal, weights = np.zeros(n), np.zeros(n), np.ones(n)
    for outer in range(OUTER_LOOPS + 1):
        for _ in range(INNER_LOOPS):
            cycle = _cycle_smooth(y - trend, weights, period)
            level = _moving_average(_moving_average(_moving_average(cycle, period), period), 3)
            low = loess(level[None], low_span, here, ones)[0]
            seasonal = cycle[period:-period] - low
            trend = loess((y - seasonal)[None], trend_span, here, weights[None])[0]
        rest = np.abs(y - trend - seasonal)
        if outer < OUTER_LOOPS:
            limit = 6 * np.median(rest)
            u = rest / limit if limit > NOISE * np.abs(y).max() else np.zeros(n)
            weights = np.where(u <= 0.001, 1.0, np.where(u > 0.999, 0.0, (1 - u ** 2) ** 2))
    return trend, seasonal, y - trend - seasonal


class LocalLines:
    """Local linear fits at fixed positions as banded matrices, for any number of equally long series.

    With kernel k and offset d of a position from the fitted one, the sums of k, k d and k d d over the weights and
    of k and k d over the weighted values are products with three matrices, from which centre, spread and
    fit follow. Without robustness weights the fit itself is one matrix.
    """

    def __init__(self, n: int, span: int, at: np.ndarray):
        width = min(span, n)
        first = np.clip(at - (width - 1) // 2, 0, n - width)
        offset = np.arange(n) - at[:, None]
        inside = (np.arange(n) >= first[:, None]) & (np.arange(n) < (first + width)[:, None])
        reach = np.abs(np.where(inside, offset, 0)).max(1) + (span - n) // 2 * (span > n)
        u = np.abs(offset) / np.maximum(reach, 1)[:, None]
        kernel = np.where(inside, np.where(u <= 0.001, 1.0, np.where(u > 0.999, 0.0, (1 - u ** 3) ** 3)), 0.0)
        self.products = tuple((kernel * offset ** i).T.copy() for i in (0, 1, 2))
        self.n, self.own = n, np.clip(at, 0, n - 1)

    def fit(self, y: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        """Fits of the rows of ``y``."""
        weights = np.ones((1, self.n)) if weights is None else weights
        zero, one, two = self.products
        weighted = y * weights
        total = weights @ zero
        usable = total > 0
        total = np.where(usable, total, 1.0)
        centre = weights @ one / total
        spread = np.maximum(weights @ two / total - centre ** 2, 0.0)
        tilted = np.sqrt(spread) > 0.001 * (self.n - 1)
        slope = np.where(tilted, -centre / np.where(tilted, spread, 1.0), 0.0)
        level = weighted @ zero / total
        fitted = level + slope * (weighted @ one / total - centre * level)
        return np.where(usable, fitted, y[:, self.own])


def _mean_of(x: np.ndarray, width: int) -> np.ndarray:
    total = np.cumsum(np.column_stack([np.zeros(len(x)), x]), axis=1)
    return (total[:, width:] - total[:, :-width]) / width


def stl_batch(y: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Robust trend, seasonal and residual of the rows of ``y``, as ``stl`` gives them one by one."""
    m, n = y.shape
    if n < 2 * period:
        raise ValueError(f"{n} values are fewer than two periods of {period}")
    if not np.isfinite(y).all():
        raise ValueError("the series has missing or infinite values")
    trend_span = _odd(int(np.ceil(1.5 * period / (1 - 1.5 / SEASONAL_SPAN))))
    here = np.arange(n)
    long_lines, low_lines = LocalLines(n, trend_span, here), LocalLines(n, _odd(period + 1), here)
    phases = []
    for length in sorted({len(range(p, n, period)) for p in (0, period - 1)}):
        own = np.array([p for p in range(period) if len(range(p, n, period)) == length])
        phases.append((np.arange(-1, length + 1), own[:, None] + period * np.arange(length), own[:, None] + period * np.arange(length + 2)))
    trend, seasonal, weights = np.zeros((m, n)), np.zeros((m, n)), np.ones((m, n))
    for outer in range(OUTER_LOOPS + 1):
        for _ in range(INNER_LOOPS):
            detrended, cycle = y - trend, np.empty((m, n + 2 * period))
            for steps, cells, wide in phases:
                shape = (-1, cells.shape[1])
                smooth = loess(detrended[:, cells].reshape(shape), SEASONAL_SPAN, steps, weights[:, cells].reshape(shape))
                cycle[:, wide] = smooth.reshape(m, *wide.shape)
            level = _mean_of(_mean_of(_mean_of(cycle, period), period), 3)
            seasonal = cycle[:, period:-period] - low_lines.fit(level)
            trend = long_lines.fit(y - seasonal, weights)
        if outer < OUTER_LOOPS:
            rest = np.abs(y - trend - seasonal)
            limit = 6 * np.median(rest, axis=1, keepdims=True)
            u = np.divide(rest, limit, out=np.zeros_like(rest), where=limit > NOISE * np.abs(y).max(1, keepdims=True))
            weights = np.where(u <= 0.001, 1.0, np.where(u > 0.999, 0.0, (1 - u ** 2) ** 2))
    return trend, seasonal, y - trend - seasonal
