"""L-BFGS on the driver, step for step as Spark ML's optimiser (Breeze) takes it: ten corrections, strong Wolfe line search.

Works on one flat parameter array; what a point costs is asked of a function, so rows never come here.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

# (parameters) -> (value, gradient).
Cost = Callable[[np.ndarray], tuple[float, np.ndarray]]
CORRECTIONS, ZOOMS, TRIES = 10, 10, 10
ENOUGH, FLAT = 1e-4, 0.9
VALUES_KEPT = 20


class NoStep(Exception):
    """No step that improves enough was found from here."""


def minimise(cost: Cost, start: np.ndarray, max_iter: int, tolerance: float = 1e-6) -> tuple[np.ndarray, list[float]]:
    """The parameters after at most `max_iter` steps and the values on the way, that of the start first.

    Ends earlier when the last values or the gradient say so. Without a step the corrections are forgotten once, then it ends.
    """
    x, failed, steps = np.array(start, dtype=float), False, 0
    value, slope = cost(x)
    history, values, first, known = [], [value], value, [np.inf]
    while not (steps >= max_iter or _settled(value, known, tolerance * first)
               or _norm(slope) <= max(tolerance * value, 1e-8)):
        try:
            way = _direction(slope, history)
            size, new, (new_value, new_slope) = _line_search(cost, x, value, slope, way, 1.0 if steps else 1.0 / _norm(way))
            if size * _norm(slope) < 1e-10:
                raise NoStep
        except NoStep:
            if failed:
                break
            failed, history = True, []
            continue
        history = [(new - x, new_slope - slope), *history][:CORRECTIONS]
        x, value, slope, failed, steps = new, new_value, new_slope, False, steps + 1
        values.append(value)
        known = [*known, value][-VALUES_KEPT:]
    return x, values


def _norm(v: np.ndarray) -> float:
    return float(np.sqrt(v @ v))


def _settled(value: float, known: list[float], margin: float) -> bool:
    return len(known) >= 2 and abs(value - max(known)) <= margin


def _direction(slope: np.ndarray, history: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The two-loop recursion; `history` has (step, change of slope), the latest first."""
    way, scale, used = slope.copy(), 1.0, []
    if history:
        step, change = history[0]
        along = float(step @ change)
        if not along >= 0:
            raise NoStep
        scale = along / float(change @ change) if along else 0.0
    for step, change in history:
        rho = float(step @ change)
        a = float(step @ way) / rho if rho else np.nan
        if np.isnan(a):
            raise NoStep
        way -= a * change
        used.append((a, rho))
    way *= scale
    for (step, change), (a, rho) in zip(reversed(history), reversed(used)):
        way += (a - float(change @ way) / rho) * step
    return -way


def _line_search(cost: Cost, x, value, slope, way, t: float):
    """(size, point, what it costs) of a step along `way` that satisfies the strong Wolfe conditions."""
    found = {}

    def at(size):
        point = x + way * size
        found[size] = point, cost(point)
        of, gradient = found[size][1]
        return size, of, float(gradient @ way)

    def chosen(size):
        return size, *found[size]

    _, start, fall = low = 0.0, value, float(slope @ way)
    if fall > 0:
        raise NoStep

    def zoom(low, high):
        for _ in range(ZOOMS):
            here = at(_between(high, low) if low[0] > high[0] else _between(low, high))
            if here[1] > start + ENOUGH * here[0] * fall or here[1] >= low[1]:
                high = here
            else:
                if abs(here[2]) <= FLAT * abs(fall):
                    return chosen(here[0])
                if here[2] * (high[0] - low[0]) >= 0:
                    high = low
                low = here
        raise NoStep

    for i in range(TRIES):
        here = at(t)
        if not np.isfinite(here[1]):
            t /= 2.0
            continue
        if here[1] > start + ENOUGH * t * fall or (here[1] >= low[1] and i > 0):
            return zoom(low, here)
        if abs(here[2]) <= FLAT * abs(fall):
            return chosen(t)
        if here[2] >= 0:
            return zoom(here, low)
        low, t = here, t * 1.5
    raise NoStep


def _between(left, right) -> float:
    """Where the cubic through both ends is least, kept a tenth of the way off either."""
    (a, fa, da), (b, fb, db) = left, right
    d1 = da + db - 3 * (fa - fb) / (a - b)
    inner = d1 * d1 - da * db
    d2 = np.sqrt(inner) if inner >= 0 else np.nan
    t = b - (b - a) * (db + d2 - d1) / (db - da + 2 * d2)
    low, high = a + 0.1 * (b - a), a + 0.9 * (b - a)
    return float(low if t < low else high if t > high else t)
