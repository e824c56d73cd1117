"""Sparse rows and a solver for linear models with an L1 term, for samples that fit on the driver."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: A step is this much shorter than the largest curvature found allows: power iteration nears it from below.
MARGIN = 1.1


class Rows:
    """A sparse matrix by rows: `ends` of the rows in `cols` and, unless all are one, `values`."""

    def __init__(self, sizes: np.ndarray, cols: np.ndarray, values: np.ndarray | None, width: int):
        self.height, self.width, self.cols, self.values = len(sizes), width, cols, values
        self.row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.full = np.flatnonzero(sizes)
        self.starts = (np.cumsum(sizes) - sizes)[self.full]

    def restrict(self, columns: np.ndarray) -> Rows:
        """The matrix of some of the columns, given in order."""
        place = np.full(self.width, -1)
        place[columns] = np.arange(len(columns))
        cols = place[self.cols]
        known = cols >= 0
        values = None if self.values is None else self.values[known]
        return Rows(np.bincount(self.row[known], minlength=self.height), cols[known], values, len(columns))

    def times(self, w: np.ndarray) -> np.ndarray:
        """The product with a vector of the columns: one number a row."""
        out = np.zeros(self.height)
        if len(self.cols):
            x = w[self.cols]
            if self.values is not None:
                x *= self.values
            out[self.full] = np.add.reduceat(x, self.starts)
        return out

    def back(self, g: np.ndarray) -> np.ndarray:
        """The product with a vector of the rows: one number a column."""
        x = g[self.row]
        if self.values is not None:
            x *= self.values
        return np.bincount(self.cols, x, self.width)


def proximal(gradient: Callable, curvature: Callable, diagonal: np.ndarray, l1: np.ndarray, start: np.ndarray | None = None, rounds: int = 3000, tolerance: float = 1e-5) -> np.ndarray:
    """The minimiser of a smooth convex function plus l1 . |w|, by accelerated proximal gradient.

    `curvature(v)` is the product of v with a bound on the function's second derivative and `diagonal`
    that bound's diagonal, which scales the coordinates; the step comes from the largest eigenvalue of the
    scaled bound, all terms of the function included. Momentum starts again where it points against the
    step. Rounds end when the proximal gradient, in scaled coordinates, is below `tolerance`.
    """
    scale = np.sqrt(np.maximum(diagonal, 1e-12))
    v = np.random.default_rng(1).random(len(scale)) + 0.5
    largest = 1.0
    for _ in range(50):
        v = curvature(v / scale) / scale
        largest = float(np.linalg.norm(v)) or 1.0
        v = v / largest
    pace = MARGIN * largest
    step = 1 / (pace * scale * scale)
    w = lead = np.zeros(len(scale)) if start is None else start
    t = 1.0
    for _ in range(rounds):
        new = lead - step * gradient(lead)
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
        move = scale * (lead - new)
        if pace * float(np.abs(move).max(initial=0.0)) < tolerance:
            return new
        if t > 1 and float(move @ (scale * (new - w))) > 0:
            lead, w, t = new, new, 1.0
            continue
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        lead, w, t = new + (t - 1) / t_next * (new - w), new, t_next
    return w


def sparse(loss, l1: float, most: int = 200) -> np.ndarray:
    """The minimiser of `loss` plus l1 times the absolute weights, the last coordinate (a bias) left out.

    Few weights of the minimum aren't zero, so it is found on a growing set of columns: those whose
    gradient at the minimum so far exceeds l1, the largest first, join it until there is none. `loss` has
    gradient, curvature, diagonal and restrict(columns), a loss of these columns and the bias.
    """
    w = np.zeros(loss.width + 1)
    active = np.zeros(0, dtype=np.int64)
    while True:
        part = loss.restrict(active)
        at = np.append(active, loss.width)
        w[at] = proximal(part.gradient, part.curvature, part.diagonal(), np.append(np.full(len(active), l1), 0.0), w[at])
        pull = np.abs(loss.gradient(w)[:-1])
        pull[active] = 0
        above = np.flatnonzero(pull > 1.01 * l1)
        if not len(above):
            return w
        above = above[np.argsort(-pull[above], kind="stable")[: max(most, len(active))]]
        active = np.sort(np.concatenate([active, above]))
