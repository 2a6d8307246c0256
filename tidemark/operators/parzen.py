"""Search of parameters by tree-structured Parzen estimators: small driver-side arithmetic over trials.

Finished trials are parted into good and other ones. For every parameter both parts give a density, a mixture of
truncated normals around the tried values with a wide one as prior. Candidates are drawn from the good density, and the
one whose good density is largest against the other is tried next. Parameters are taken as independent.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple

#: Trials drawn at random before the first estimate.
STARTUP = 8
#: Candidates drawn per suggestion.
CANDIDATES = 32
#: Share of the trials that count as good.
GOOD_SHARE = 0.2


@dataclass(frozen=True)
class Dim:
    """A parameter between ``low`` and ``high``: on a log scale, and in whole steps, if so declared."""

    name: str
    low: float
    high: float
    log: bool = False
    step: float | None = None

    def inside(self, value: float) -> float:
        return math.log(value) if self.log else float(value)

    def outside(self, x: float) -> float | int:
        value = math.exp(x) if self.log else x
        if self.step is not None:
            value = self.low + round((value - self.low) / self.step) * self.step
        value = min(max(value, self.low), self.high)
        return int(value) if isinstance(self.step, int) else value

    @property
    def span(self) -> tuple[float, float]:
        """The bounds on the scale of the search; a stepped value owns half a step to both sides."""
        half = self.step / 2 if self.step is not None and not self.log else 0.0
        return self.inside(self.low) - half, self.inside(self.high) + half

    def draw(self, rng: random.Random) -> float | int:
        return self.outside(rng.uniform(*self.span))


def _phi(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


class Kernel(NamedTuple):
    center: float
    width: float


class Density:
    """Equal parts of normals around the points and one around the middle as wide as the span, cut off at its ends."""

    def __init__(self, dim: Dim, values: Sequence[float]) -> None:
        self.dim = dim
        low, high = dim.span
        points = sorted(dim.inside(v) for v in values)
        # A point is as wide as the larger gap beside it, within bounds that narrow as points come.
        least = (high - low) / min(100.0, 1.0 + len(points))
        self.kernels = [Kernel((low + high) / 2, high - low)]
        for i, p in enumerate(points):
            left = p - (points[i - 1] if i else low)
            right = (points[i + 1] if i + 1 < len(points) else high) - p
            self.kernels.append(Kernel(p, min(max(left, right, least), high - low)))

    def draw(self, rng: random.Random) -> float | int:
        low, high = self.dim.span
        center, width = rng.choice(self.kernels)
        while True:
            x = rng.gauss(center, width)
            if low <= x <= high:
                return self.dim.outside(x)

    def at(self, value: float) -> float:
        """The density of a value; of a stepped one, the mass of its step."""
        low, high = self.dim.span
        x = self.dim.inside(value)
        total = 0.0
        for center, width in self.kernels:
            kept = _phi((high - center) / width) - _phi((low - center) / width)
            if self.dim.step is not None and not self.dim.log:
                half = self.dim.step / 2
                a, b = max(low, x - half), min(high, x + half)
                total += (_phi((b - center) / width) - _phi((a - center) / width)) / kept
            else:
                total += math.exp(-0.5 * ((x - center) / width) ** 2) / (width * math.sqrt(2 * math.pi) * kept)
        return total / len(self.kernels)


def n_good(trials: int) -> int:
    return max(1, math.ceil(GOOD_SHARE * trials))


def suggest(dims: Sequence[Dim], trials: Sequence[tuple[Mapping[str, float], float]], rng: random.Random) -> dict[str, float]:
    """The parameters to try next, given finished trials as (parameters, loss)."""
    if len(trials) < STARTUP:
        return {d.name: d.draw(rng) for d in dims}
    ranked = sorted(trials, key=lambda t: t[1])
    cut = n_good(len(ranked))
    chosen = {}
    for d in dims:
        good, other = (Density(d, [p[d.name] for p, _ in part]) for part in (ranked[:cut], ranked[cut:]))
        candidates = [good.draw(rng) for _ in range(CANDIDATES)]
        chosen[d.name] = max(candidates, key=lambda v: math.log(good.at(v)) - math.log(other.at(v)))
    return chosen


def minimise(
    dims: Sequence[Dim], run: Callable[[list[dict[str, float]]], list[float]], trials: int, seed: int = 42, parallel: int = 1
) -> list[tuple[dict[str, float], float]]:
    """All trials as (parameters, loss) in the order tried.

    ``run`` takes up to ``parallel`` parameter sets and gives their losses. Of sets that are tried together, those
    already chosen count as bad for the choice of the next, so they differ.
    """
    rng = random.Random(seed)
    done: list[tuple[dict[str, float], float]] = []
    while len(done) < trials:
        batch: list[dict[str, float]] = []
        worst = max((loss for _, loss in done), default=0.0)
        for _ in range(min(parallel, trials - len(done))):
            batch.append(suggest(dims, [*done, *[(p, worst) for p in batch]], rng))
        done += zip(batch, run(batch), strict=True)
    return done
