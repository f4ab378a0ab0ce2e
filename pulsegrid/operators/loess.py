"""Seasonal-trend decomposition by local regression, for one evenly spaced series.

After Cleveland, Cleveland, McRae and Terpenning (1990), "STL: A Seasonal-Trend Decomposition
Procedure Based on Loess", without the robustness pass and with local lines throughout.

On an even grid a loess smoother is linear and depends only on (length, span): away from the
ends every point has the same symmetric weights, so the smoother is one convolution plus one
matrix per end, or for long spans its rows a few at a time. Smoothers are built once per
(length, span) and shared by the series a task fits.
"""

from __future__ import annotations

import numpy as np


#: Up to so many weights of one end are kept as a matrix; more are computed as they are used.
MATRIX = 1 << 20
#: Weights computed at a time.
SLICE = 1 << 16


def tricube(at: np.ndarray, points: np.ndarray, span: int, length: int) -> np.ndarray:
    """Weights of ``points`` (along rows) around each ``at``, by their distance alone."""
    at, points = at[:, None], points[None, :]
    reach = np.maximum(np.abs(at - points[:, :1]), np.abs(at - points[:, -1:]))
    reach = reach + max(0, (span - length) // 2)
    distance = np.abs(at - points)
    part = np.minimum(distance / reach, 1.0)
    weights = 1.0 - part * part * part
    weights *= weights * weights
    weights[distance <= 0.001 * reach] = 1.0
    weights[distance > 0.999 * reach] = 0.0
    return weights


def line_weights(at: np.ndarray, points: np.ndarray, span: int, length: int) -> np.ndarray:
    """Weights that give the local line's value at each ``at`` from the values at ``points``."""
    at, points = at.astype(float), points.astype(float)
    weights = tricube(at, points, span, length)
    at, points = at[:, None], points[None, :]
    weights /= weights.sum(axis=1, keepdims=True)
    centre = (weights * points).sum(axis=1, keepdims=True)
    spread = (weights * (points - centre) ** 2).sum(axis=1, keepdims=True)
    # With all weight on one spot there is no line to fit; the weighted mean stands.
    sloped = np.sqrt(spread) > 0.001 * (length - 1)
    tilt = np.where(sloped, (at - centre) / np.where(sloped, spread, 1.0), 0.0)
    return weights * (1.0 + tilt * (points - centre))


class Lines:
    """Local lines at ``at`` through values at ``points``; memory grows with their number.

    Few weights are kept as a matrix. Many are computed a slice of rows at a time, and only the
    moments that a line needs are kept of them: the results are the same.
    """

    def __init__(self, at: np.ndarray, points: np.ndarray, span: int, length: int):
        self.at, self.points = at.astype(float), points.astype(float)
        self.span, self.length = span, length
        self.matrix = None
        if len(at) * len(points) <= MATRIX:
            self.matrix = line_weights(at, points, span, length)

    @property
    def kept(self) -> int:
        return 0 if self.matrix is None else self.matrix.size

    def __matmul__(self, values: np.ndarray) -> np.ndarray:
        if self.matrix is not None:
            return self.matrix @ values
        table = values.reshape(len(values), -1)
        middle = self.points.mean()
        x = (self.points - middle)[:, None]
        moments = np.hstack([np.ones_like(x), x, x * x, table, x * table])
        wide, step = table.shape[1], max(1, SLICE // len(x))
        out = np.empty((len(self.at), wide))
        for first in range(0, len(self.at), step):
            at = self.at[first : first + step]
            sums = tricube(at, self.points, self.span, self.length) @ moments
            sums /= sums[:, :1]
            centre = sums[:, 1:2]
            spread = np.maximum(sums[:, 2:3] - centre * centre, 0.0)
            sloped = np.sqrt(spread) > 0.001 * (self.length - 1)
            mean = sums[:, 3 : 3 + wide]
            slope = (sums[:, 3 + wide :] - centre * mean) / np.where(sloped, spread, 1.0)
            rise = np.where(sloped, slope * (at[:, None] - middle - centre), 0.0)
            out[first : first + step] = mean + rise
        return out.reshape(-1, *values.shape[1:])


class Smoother:
    """Loess of ``span`` points over columns of ``length`` values.

    With ``extend`` the result carries one extrapolated value before and after.
    """

    def __init__(self, length: int, span: int, extend: bool = False):
        extra = 1 if extend else 0
        self.kernel = None
        if span >= length:
            self.whole = Lines(np.arange(-extra, length + extra), np.arange(length), span, length)
            self.kept = self.whole.kept
            return
        half = (span - 1) // 2
        self.span = span
        self.head = Lines(np.arange(-extra, half), np.arange(span), span, length)
        self.kernel = line_weights(np.array([half]), np.arange(span), span, length)[0]
        tail_points = np.arange(length - span, length)
        self.tail = Lines(np.arange(length - half, length + extra), tail_points, span, length)
        self.kept = self.head.kept + self.tail.kept + span

    def __call__(self, values: np.ndarray) -> np.ndarray:
        if self.kernel is None:
            return self.whole @ values
        head = self.head @ values[: self.span]
        tail = self.tail @ values[-self.span :]
        if values.ndim == 1:
            middle = np.convolve(values, self.kernel[::-1], "valid")
        else:
            middle = np.stack(
                [np.convolve(column, self.kernel[::-1], "valid") for column in values.T], axis=1
            )
        return np.concatenate([head, middle, tail])


_smoothers: dict[tuple[int, int, bool], Smoother] = {}


def smoother(length: int, span: int, extend: bool = False) -> Smoother:
    key = (length, span, extend)
    if key not in _smoothers:
        if sum(s.kept for s in _smoothers.values()) >= 4 * MATRIX:
            _smoothers.clear()
        _smoothers[key] = Smoother(length, span, extend)
    return _smoothers[key]


def moving_average(values: np.ndarray, width: int) -> np.ndarray:
    return np.convolve(values, np.full(width, 1.0 / width), "valid")


def smooth_cycles(values: np.ndarray, period: int, span: int) -> np.ndarray:
    """Smooth each phase of the cycle across cycles; one cycle longer at either end."""
    cycles, rest = divmod(len(values), period)
    table = values[: cycles * period].reshape(cycles, period)
    longer = np.vstack([table[:, :rest], values[cycles * period :]])
    out = np.empty((cycles + 2, period))
    out[:, rest:] = smoother(cycles, span, True)(table[:, rest:])
    if not rest:
        return out.ravel()
    smoothed = smoother(cycles + 1, span, True)(longer)
    out[:, :rest] = smoothed[:-1]
    return np.concatenate([out.ravel(), smoothed[-1]])


def decompose(
    values: np.ndarray,
    period: int,
    seasonal_span: int,
    trend_span: int,
    low_pass_span: int | None = None,
    passes: int = 5,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trend, seasonal, residual) of a series of at least two periods."""
    size = len(values)
    if low_pass_span is None:
        low_pass_span = period + 1 + period % 2
    trend = np.zeros(size)
    seasonal = np.zeros(size)
    for _ in range(passes):
        cycle = smooth_cycles(values - trend, period, seasonal_span)
        level = moving_average(moving_average(moving_average(cycle, period), period), 3)
        seasonal = cycle[period : period + size] - smoother(size, low_pass_span)(level)
        trend = smoother(size, trend_span)(values - seasonal)
    return trend, seasonal, values - trend - seasonal
