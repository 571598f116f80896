"""Tail probabilities as column expressions, and the exact distribution of the
rank-sum statistic of small groups."""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import combinations

from pyspark.sql import functions as F

#: Coefficients of Lanczos' approximation of the gamma function (g = 7).
LANCZOS = [0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
           12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7]
#: Beyond this erfc comes from the continued fraction; terms of both, and of the gamma function's.
SPLIT, ERFC_TERMS, TERMS = 2.5, 45, 120
#: The smaller group's rows up to which the rank-sum distribution is exact.
EXACT_ROWS = 8


def _down(n) -> F.Column:
    return F.sequence(n, F.lit(1), F.lit(-1))


def erfc(x: F.Column) -> F.Column:
    """Complementary error function, right to about 1e-12 of its value: plain
    arithmetic, written out term by term."""
    a = F.abs(x)
    series, fraction = F.lit(1.0), a
    for k in range(ERFC_TERMS, 0, -1):
        series = 1.0 + 2.0 * a * a / (2.0 * k + 1.0) * series
        fraction = a + k / 2.0 / fraction
    near = 1.0 - 2.0 / math.sqrt(math.pi) * a * F.exp(-a * a) * series
    far = F.exp(-a * a) / math.sqrt(math.pi) / fraction
    tail = F.when(a < SPLIT, near).otherwise(far)
    return F.when(x >= 0, tail).otherwise(2.0 - tail)


def normal_two_sided_p(z: F.Column) -> F.Column:
    """2 * P(Z > z) for z >= 0 (clipped to [0, 1])."""
    return F.least(F.greatest(erfc(z / math.sqrt(2.0)), F.lit(0.0)), F.lit(1.0))


def log_gamma(a: F.Column) -> F.Column:
    """ln Gamma(a) for a >= 0.5."""
    total = F.lit(LANCZOS[0])
    for k, c in enumerate(LANCZOS[1:], 1):
        total = total + c / (a - 1.0 + k)
    t = a + 6.5
    return 0.5 * math.log(2 * math.pi) + (a - 0.5) * F.log(t) - t + F.log(total)


def gamma_tail(a: F.Column, x: F.Column) -> F.Column:
    """The regularised upper incomplete gamma function Q(a, x), a >= 0.5,
    x >= 0: a series up to x = a + 1, a continued fraction beyond."""
    n = (TERMS + 10 * F.sqrt(a)).cast("int")
    scale = F.exp(a * F.log(x) - x - log_gamma(a))
    series = F.aggregate(_down(n), F.lit(1.0), lambda h, k: 1.0 + x / (a + k) * h)
    fraction = F.aggregate(_down(n), x + 2.0 * n + 1.0 - a, lambda h, k: x + 2.0 * k - 1.0 - a - k * (k - a) / h)
    return F.when(x <= 0, 1.0).when(x < a + 1.0, 1.0 - scale * series / a).otherwise(scale / fraction)


def chi_square_tail(statistic: F.Column, dof: F.Column) -> F.Column:
    """P(X >= statistic) for ``dof`` >= 1 degrees of freedom."""
    return gamma_tail(dof.cast("double") / 2.0, statistic / 2.0)


@lru_cache(maxsize=EXACT_ROWS)
def _partitions(k: int) -> tuple[int, list[int]]:
    """The period of, and enough values of, the number of multisets with sum at
    most m of parts 1..k: a polynomial of degree k on each residue class."""
    period = math.lcm(*range(1, k + 1))
    ways = [1] + [0] * (period * (k + 1) - 1)
    for part in (1, *range(1, k + 1)):
        for m in range(part, len(ways)):
            ways[m] += ways[m - part]
    return period, ways


def _partitions_up_to(k: int, m: int) -> int:
    if m < 0:
        return 0
    period, ways = _partitions(k)
    t, r = divmod(m, period)
    if t <= k:
        return ways[m]
    column, total = ways[r::period], 0
    for j in range(k + 1):  # Newton's forward differences, in whole numbers
        total += math.comb(t, j) * column[0]
        column = [b - a for a, b in zip(column, column[1:])]
    return total


def rank_sum_p(n0: int, n1: int, u: float) -> float:
    """Exact two-sided p of the rank-sum statistic ``u`` of groups without ties,
    for a smaller group of at most ``EXACT_ROWS`` rows and any larger one.

    The number of arrangements with a statistic up to u has the generating
    function prod (1 - q^(n+i)) / ((1 - q) prod (1 - q^i)); its numerator is
    expanded over subsets, the rest is a count of partitions."""
    k, n = sorted((int(n0), int(n1)))
    below = int(min(u, n0 * n1 - u))
    count = 0
    for size in range(k + 1):
        for chosen in combinations(range(1, k + 1), size):
            count += (-1) ** size * _partitions_up_to(k, below - sum(n + i for i in chosen))
    return min(1.0, 2 * count / math.comb(n + k, k))
