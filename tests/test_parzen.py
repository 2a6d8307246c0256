import math
import random

import pytest

from tidemark.operators import parzen as P

DIMS = [P.Dim("x", -5.0, 5.0), P.Dim("rate", 1e-4, 1.0, log=True), P.Dim("n", 1, 40, step=1), P.Dim("trees", 100, 800, step=50)]


def objective(p):
    return (p["x"] - 1.7) ** 2 / 10 + (math.log10(p["rate"]) + 2) ** 2 + ((p["n"] - 23) / 15) ** 2 + ((p["trees"] - 450) / 400) ** 2


def random_best(seed, trials):
    rng = random.Random(seed)
    return min(objective({d.name: d.draw(rng) for d in DIMS}) for _ in range(trials))


def test_beats_random_search_at_thirty_trials():
    seeds = range(60)
    ours = [min(loss for _, loss in P.minimise(DIMS, lambda b: [objective(p) for p in b], 30, seed)) for seed in seeds]
    theirs = [random_best(1000 + seed, 30) for seed in seeds]
    assert sum(ours) < 0.75 * sum(theirs)
    assert sorted(ours)[30] < 0.75 * sorted(theirs)[30]
    assert sum(a < b for a, b in zip(ours, theirs, strict=True)) > 0.6 * len(seeds)


def test_trials_side_by_side_differ_and_still_learn():
    seen = []

    def run(batch):
        seen.append(len(batch))
        return [objective(p) for p in batch]

    together = [min(loss for _, loss in P.minimise(DIMS, run, 30, seed, parallel=4)) for seed in range(40)]
    theirs = [random_best(1000 + seed, 30) for seed in range(40)]
    assert sum(together) < 0.85 * sum(theirs) and seen[:8] == [4] * 7 + [2]
    done = P.minimise(DIMS, run, 20, 7, parallel=4)
    assert len({tuple(p.items()) for p, _ in done}) == 20
    assert done == P.minimise(DIMS, run, 20, 7, parallel=4)


@pytest.mark.parametrize("dim", DIMS)
def test_densities_against_plain_integration(dim):
    """A mixture summed kernel by kernel on a fine grid: the same shape, and a whole of one."""
    rng = random.Random(3)
    values = [dim.draw(rng) for _ in range(9)]
    density = P.Density(dim, values)
    low, high = dim.span
    steps = 20_000
    grid = [low + (high - low) * (i + 0.5) / steps for i in range(steps)]
    weight = (high - low) / steps

    def kernel(c, w, x):
        return math.exp(-0.5 * ((x - c) / w) ** 2)

    masses = [sum(kernel(c, w, x) for x in grid) * weight for c, w in density.kernels]

    def plain(x):
        return sum(kernel(c, w, x) / m for (c, w), m in zip(density.kernels, masses, strict=True)) / len(masses)

    if dim.step is None:
        for x in grid[::1999]:
            value = math.exp(x) if dim.log else x
            assert density.at(value) == pytest.approx(plain(x), rel=1e-4)
    else:
        values = [dim.low + i * dim.step for i in range(int((dim.high - dim.low) / dim.step) + 1)]
        assert sum(density.at(v) for v in values) == pytest.approx(1, rel=1e-6)
        for v in values[::5]:
            want = sum(plain(x) for x in grid if abs(x - v) <= dim.step / 2) * weight
            assert density.at(v) == pytest.approx(want, rel=2e-2)
    assert len(density.kernels) == 10 and all(0 < k.width <= high - low for k in density.kernels)


def test_draws_keep_their_bounds():
    rng = random.Random(5)
    for dim in DIMS:
        drawn = [P.Density(dim, [dim.low, dim.high, dim.draw(rng)]).draw(rng) for _ in range(300)]
        assert all(dim.low <= v <= dim.high for v in drawn)
        if dim.step:
            assert all((v - dim.low) % dim.step == 0 and isinstance(v, int) for v in drawn)
            assert {dim.low, dim.high} <= set(drawn)


def test_the_good_part():
    assert [P.n_good(n) for n in (1, 5, 6, 30)] == [1, 1, 2, 6]
