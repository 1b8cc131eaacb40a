"""Support vector machines with squared hinge loss, by Newton steps for many settings at once (ML13-ML16).

Objective of a setting: ``|w|^2 / 2 + C * sum(max(0, 1 - y * z'w)^2)`` over its training rows, where z is the row's random Fourier map
(kernel ``exp(-sigma |x - x'|^2)``) or the row itself, with a constant.  Every turn is one pass over the rows for all settings
that are not done: it sums the losses at several step lengths and, at the whole step, gradients, the dual's terms and what changes in
the Hessian, which are the products of the rows that became active or no longer are.  Where the whole step is not the best, one more pass
takes the slopes at the best.  At the start all rows are active, so that costs share one Hessian per map and fold.  Blocks of sums
are added up by setting; the driver solves one small system for each.  A setting is done when its duality gap is below ``tol`` of
its objective, and the gap is reported: it bounds the distance to the optimum.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditspark.operators.cache import persist, release
from creditspark.operators.models import fourier_matrix
from creditspark.operators.trees import HIST, _added, kappa

STEPS = np.array([1.0, 0.5, 0.25, 0.125, 0.0625, 0.015625, 0.001])


@dataclass(frozen=True)
class Map:
    """Random Fourier features of kernel width ``sigma`` (None: the features themselves), and a constant."""
    n_features: int
    sigma: float | None = None
    n_components: int = 256
    seed: int = 1

    @property
    def size(self) -> int:
        return (self.n_features if self.sigma is None else self.n_components) + 1

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.sigma is not None:
            w, b = fourier_matrix(self.n_features, self.sigma, self.n_components, self.seed)
            x = math.sqrt(2.0 / self.n_components) * np.cos(x @ w + b)
        return np.hstack([x, np.ones((len(x), 1))])


@dataclass
class Setting:
    """One model: its map, cost, and the fold that it does not see (-1: none)."""
    map: Map
    cost: float
    fold: int = -1
    w: np.ndarray = field(default=None)
    objective: float = math.inf
    gap: float = math.inf
    turns: int = 0

    def __post_init__(self):
        if self.w is None:
            self.w = np.zeros(self.map.size)


def design(df: DataFrame, features: list[str], label: str, fold: Column | None = None) -> DataFrame:
    """(x, y, fold) of the rows without NULLs; y is -1 or 1."""
    df = df.dropna(subset=[*features, label])
    return df.select(F.array(*[F.col(f).cast("double") for f in features]).alias("x"), (2 * F.col(label).cast("int") - 1).cast("double").alias("y"),
                     (F.lit(0) if fold is None else fold).cast("int").alias("fold"))


#: Rows that are mapped at a time, for the cache.
ROWS = 2048


def _passed(data: DataFrame, todo: dict[int, Setting], sums) -> dict[int, np.ndarray]:
    """``sums(map, z, y, fold)`` yields (setting index, sums) for the settings of one map; they are added up over all rows."""
    maps = list(dict.fromkeys(s.map for s in todo.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(0).flatten().to_numpy().reshape(b.num_rows, -1)
            y, fold = b.column(1).to_numpy(), b.column(2).to_numpy()
            for first in range(0, len(x), ROWS):
                rows = slice(first, first + ROWS)
                for m in maps:
                    for i, own in sums(m, m(x[rows]), y[rows], fold[rows]):
                        total[i] = np.add(total[i], own, out=total[i]) if i in total else own
        yield pa.RecordBatch.from_pydict({"tree": pa.array(list(total), pa.int64()), "hist": pa.array([v.tobytes() for v in total.values()], pa.binary())})

    return _added(data.mapInArrow(run, HIST), HIST)


@dataclass
class Turn:
    """What the next pass does for a setting: the step to try (None: slopes at ``w`` alone) and where its Hessian is known
    (``base``, None: nowhere; ``leader``: the setting that counts it for all of one map and fold)."""
    step: np.ndarray | None = None
    base: np.ndarray | None = None
    hess: np.ndarray | None = None
    leader: int = -1


def _product(z: np.ndarray, rows: np.ndarray) -> np.ndarray:
    z = z[rows]
    return z.T @ z


def _turned(settings: dict[int, Setting], turns: dict[int, Turn]):
    """For every setting at ``w`` plus its whole step: squared losses, the dual variables' sum and squares, their sum with the rows; the
    losses at all STEPS; and the products of the rows that became active, less those that no longer are."""
    def sums(m: Map, z: np.ndarray, y: np.ndarray, fold: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        own = [i for i, s in settings.items() if s.map == m]
        zero = np.zeros(m.size)
        step = [zero if turns[i].step is None else turns[i].step for i in own]
        weights = [x for i, d in zip(own, step) for x in (settings[i].w + d, settings[i].w, d, zero if turns[i].base is None else turns[i].base)]
        margins = (z @ np.stack(weights, axis=1)) * y[:, None]
        train = np.stack([fold != settings[i].fold for i in own], axis=1)
        slack = np.where(train, np.maximum(0.0, 1 - margins[:, ::4]), 0.0)
        rows = z.T @ (slack * y[:, None])
        for j, i in enumerate(own):
            s, t, on = settings[i], turns[i], slack[:, j] > 0
            line = np.zeros(len(STEPS))
            if t.step is not None:
                at, along = margins[train[:, j], 4 * j + 1], margins[train[:, j], 4 * j + 2]
                line = np.array([(np.maximum(0.0, 1 - at - x * along) ** 2).sum() for x in STEPS])
            squares = (slack[:, j] ** 2).sum()
            parts = [[squares, 2 * s.cost * slack[:, j].sum(), 4 * s.cost ** 2 * squares], 2 * s.cost * rows[:, j], line]
            if t.leader == i:
                if t.base is None:
                    hess = _product(z, np.flatnonzero(on))
                else:
                    was = train[:, j] & (margins[:, 4 * j + 3] < 1)
                    hess = _product(z, np.flatnonzero(on & ~was)) - _product(z, np.flatnonzero(was & ~on))
                parts.append(hess.ravel())
            yield i, np.concatenate(parts)

    return sums


def fit(data: DataFrame, settings: list[Setting], tol: float = 1e-8, max_turns: int = 60) -> list[Setting]:
    """Train all settings; those not done after ``max_turns`` are reported by a warning and keep their gap."""
    data = persist(data)
    todo, first = dict(enumerate(settings)), {}
    turns = {i: Turn(leader=i if s.w.any() else first.setdefault((s.map, s.fold), i)) for i, s in todo.items()}
    late = 0
    while todo:
        got = _passed(data, todo, _turned(todo, turns))
        known = {}
        for i, s in list(todo.items()):
            t, k = turns[i], s.map.size
            v = got.get(i, np.zeros(3 + k + len(STEPS) + k * k))
            slopes, line, hess = v[:3 + k], v[3 + k:3 + k + len(STEPS)], v[3 + k + len(STEPS):]
            if t.step is not None:
                along = [s.w + x * t.step for x in STEPS]
                best = int(np.argmin([w @ w / 2 + s.cost * x for w, x in zip(along, line)]))
                s.w, t.step, s.turns = along[best], None, s.turns + 1
                if best:  # a shorter step: its slopes come with the next pass
                    continue
            known[i] = hess.reshape(k, k) if t.leader == i else known[t.leader]
            t.hess = known[i] if t.base is None else t.hess + known[i]
            t.base, t.leader = s.w, i
            s.objective = float(s.w @ s.w / 2 + s.cost * slopes[0])
            u = slopes[3:]
            s.gap = float(s.objective - (slopes[1] - u @ u / 2 - slopes[2] / (4 * s.cost)))
            if s.gap <= tol * max(s.objective, 1e-300):
                del todo[i]
            elif s.turns >= max_turns:
                del todo[i]
                late += 1
            else:
                t.step = -np.linalg.solve(np.eye(k) + 2 * s.cost * t.hess, s.w - u)
    release(data)
    if late:
        warnings.warn(f"{late} of {len(settings)} SVM settings had a duality gap after {max_turns} turns", stacklevel=2)
    return settings


def grid(train: DataFrame, features: list[str], label: str, fold: Column, costs: list[float], sigmas: list[float | None],
         folds: int = 2, n_components: int = 256) -> tuple[list[tuple], tuple[float, float | None]]:
    """([(cost, sigma, accuracy, kappa, largest duality gap)], (best cost, best sigma)): means over the folds; ties go to the first."""
    data = persist(design(train, features, label, fold))
    pairs = [(c, s) for s in sigmas for c in costs]
    settings = fit(data, [Setting(Map(len(features), s, n_components), c, f) for c, s in pairs for f in range(folds)])

    def confusion(m, z, y, fold):
        for i, s in enumerate(settings):
            if s.map == m:
                rows = fold == s.fold
                yield i, np.bincount(2 * (z[rows] @ s.w >= 0) + (y[rows] > 0), minlength=4).astype(float)

    got = _passed(data, dict(enumerate(settings)), confusion)
    release(data)
    rows = []
    for j, (c, s) in enumerate(pairs):
        own = [(got[i].tolist(), settings[i].gap) for i in range(j * folds, (j + 1) * folds) if i in got and got[i].sum()]
        rows.append((float(c), s, float(np.mean([(m[0] + m[3]) / sum(m) for m, _ in own])), float(np.mean([kappa(*m) for m, _ in own])), float(max(g for _, g in own))))
    best = max(rows, key=lambda t: t[2])
    return rows, (best[0], best[1])


def classify(df: DataFrame, features: list[str], key: str, s: Setting) -> DataFrame:
    """(key, pred) of the rows without NULL features."""
    model = df.sparkSession.sparkContext.broadcast(s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([b.column(i + 1).to_numpy() for i in range(len(features))], axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array((model.value.map(x) @ model.value.w >= 0).astype(np.int32))], [key, "pred"])

    rows = df.dropna(subset=features).select(key, *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    return rows.mapInArrow(run, f"{df.schema[key].simpleString().replace(':', ' ', 1)}, pred int")
