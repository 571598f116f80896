"""Tails, rank-sum distribution, isotonic blocks against closed forms and enumeration."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayframe.operators import compare as G
from stayframe.operators import distributions as D
from stayframe.operators import evaluate as E
from stayframe.operators.isotonic import pooled_blocks
from stayframe.operators.model import calibrate_isotonic


def test_normal_tail_far_out(spark):
    zs = [0.0, 1e-9, 0.5, 1.96, 2.4999, 2.5001, 3.6, 5.0, 8.0, 12.0, 25.0]
    got = [r[0] for r in spark.createDataFrame([(z,) for z in zs], "z double").select(D.normal_two_sided_p(F.col("z"))).collect()]
    assert got == pytest.approx([math.erfc(z / math.sqrt(2)) for z in zs], rel=1e-10)
    assert spark.range(1).select(D.erfc(F.lit(-1.3))).first()[0] == pytest.approx(math.erfc(-1.3), rel=1e-12)


def slow_chi(x, dof):
    y = x / 2
    if dof % 2 == 0:
        return math.fsum(math.exp(j * math.log(y) - y - math.lgamma(j + 1)) for j in range(dof // 2))
    return math.erfc(math.sqrt(y)) + math.fsum(math.exp((j - 0.5) * math.log(y) - y - math.lgamma(j + 0.5)) for j in range(1, (dof - 1) // 2 + 1))


def test_chi_square_tail(spark):
    rows = [(x, k) for k in (1, 2, 3, 4, 7, 20, 51, 400, 3000) for x in (1e-6, 0.3, 1.0, 0.5 * k, float(k), 1.3 * k, k + 20.0, 3.0 * k + 30)]
    got = [r[0] for r in spark.createDataFrame(rows, "x double, k int").coalesce(1).select(D.chi_square_tail(F.col("x"), F.col("k"))).collect()]
    assert got == pytest.approx([slow_chi(x, k) for x, k in rows], rel=1e-8, abs=1e-300)
    assert max(abs(g - slow_chi(x, k)) for g, (x, k) in zip(got, rows)) < 1e-9


def test_rank_sum_distribution_against_enumeration():
    for n0, n1 in ((1, 1), (1, 9), (3, 4), (8, 5), (2, 13)):
        us = [sum(r) - n0 * (n0 + 1) // 2 for r in itertools.combinations(range(1, n0 + n1 + 1), n0)]
        for u in range(n0 * n1 + 1):
            far = max(u, n0 * n1 - u)
            want = min(1.0, 2 * sum(v >= far for v in us) / len(us))
            assert D.rank_sum_p(n0, n1, u) == pytest.approx(want, rel=1e-14)


def test_rank_sum_distribution_of_a_huge_larger_group():
    k, n = 3, 4000  # by the counting recurrence, one row after another
    ways = [1] + [0] * (k * n)
    for i in range(1, k + 1):
        for m in range(n + i, k * n + 1)[::-1]:
            ways[m] -= ways[m - n - i]
        for m in range(i, k * n + 1):
            ways[m] += ways[m - i]
    assert sum(ways) == math.comb(n + k, k)
    for u in (0, 17, 3000, 5990, 6000):
        assert D.rank_sum_p(k, n, u) == pytest.approx(min(1.0, 2 * sum(ways[:u + 1]) / sum(ways)), rel=1e-13)
    assert D.rank_sum_p(1, 10**9, 5) == pytest.approx(2 * 6 / (10**9 + 1))


def test_mann_whitney_takes_the_exact_p_without_ties(spark):
    rows = [("small", float(v), v in (1, 2, 9)) for v in range(1, 12)] + [("tied", float(v // 2), v % 3 == 0) for v in range(12)]
    rows += [("large", float(v), v % 2 == 0) for v in range(40)]
    got = {r["feature"]: r for r in G.mann_whitney(spark.createDataFrame(rows, "feature string, value double, grp boolean")).collect()}
    assert got["small"]["p_value"] == pytest.approx(D.rank_sum_p(8, 3, got["small"]["u_statistic"]), rel=1e-14)
    for f in ("tied", "large"):
        assert got[f]["p_value"] == pytest.approx(min(1.0, math.erfc(got[f]["z"] / math.sqrt(2))), rel=1e-10)


def test_comparison_of_several_targets_in_one_job(spark):
    rng = random.Random(3)
    rows = [(rng.random() < 0.4, rng.random() < 0.5 if k % 5 else None, rng.gauss(0, 1), rng.gauss(0, 1) if k % 7 else None) for k in range(200)]
    df = spark.createDataFrame(rows, "a boolean, b boolean, x double, y double")
    got = {(r["target"], r["feature"]): r for r in G.compare_continuous(df, ["a", "b"], ["x", "y"]).collect()}
    assert len(got) == 4
    for (t, f), r in got.items():
        one = G.mann_whitney(df.select(F.lit(f).alias("feature"), F.col(f).alias("value"), F.col(t).alias("grp"))).first()
        assert (r["n0"], r["n1"], r["u_statistic"], r["p_value"]) == (one["n0"], one["n1"], one["u_statistic"], pytest.approx(one["p_value"]))
        assert r["p_adj"] == pytest.approx(min(1.0, 2 * r["p_value"])) and r["significant"] == (r["p_value"] <= 0.025)


def slow_isotonic(points):
    """The max-min formula over distinct scores."""
    xs = sorted({x for x, _ in points})
    s = [sum(y for x, y in points if x == v) for v in xs]
    n = [sum(x == v for x, _ in points) for v in xs]
    mean = lambda a, b: sum(s[a:b + 1]) / sum(n[a:b + 1])
    return {xs[i]: max(min(mean(a, b) for b in range(i, len(xs))) for a in range(i + 1)) for i in range(len(xs))}


@pytest.mark.parametrize("parts", [1, 3, 16, 130])
def test_isotonic_blocks_whatever_the_ranges(spark, parts):
    rng = random.Random(parts)
    points = [(rng.randint(0, 40) / 40, int(rng.random() < 0.2 + 0.5 * rng.random())) for _ in range(150)]
    points += [(0.5, 1), (0.5, 0), (2.0, 0)]
    df = spark.createDataFrame([*points, (None, 1), (0.1, None)], "p_raw double, y int").repartition(3)
    blocks = pooled_blocks(df, "p_raw", "y", parts).collect()
    want = slow_isotonic(points)
    for x, v in want.items():
        own = [b for b in blocks if b["lo"] <= x <= b["hi"]]
        assert len(own) == 1 and own[0]["value"] == pytest.approx(v, abs=1e-12)
    assert sum(b["weight"] for b in blocks) == len(points)
    assert [b["value"] for b in sorted(blocks, key=lambda b: b["lo"])] == sorted({b["value"] for b in blocks})
    model = calibrate_isotonic(df, "y")
    found = model.transform(spark.createDataFrame([(x,) for x in want], "p_raw double")).collect()
    assert {r["p_raw"]: r["p_cal"] for r in found} == {x: pytest.approx(v, abs=1e-12) for x, v in want.items()}


def test_group_report_lists_every_group(spark):
    preds = spark.createDataFrame([(k, k % 2, (k * 7 % 10) / 10) for k in range(20)], "subject_id long, y_true int, y_pred double")
    people = spark.createDataFrame([(k, "F" if k % 3 else "M", None if k == 5 else f"g{k // 10}") for k in range(40)], "subject_id long, gender string, eth string")
    got = {(r["grouping"], r["grp"]): r for r in E.group_report(preds, people, {"gender": None, "eth": ["g0", "g1", "none"]}).collect()}
    assert set(got) == {("gender", "F"), ("gender", "M"), ("eth", "g0"), ("eth", "g1"), ("eth", "none")}
    assert (got["eth", "none"]["count"], got["eth", "none"]["average_precision"]) == (0, None) and got["eth", "g0"]["count"] == 9
    for (grouping, grp), r in got.items():
        own = E.average_precision(preds.join(people, "subject_id").where(F.col(grouping) == grp)).first()
        assert r["average_precision"] == (pytest.approx(own["average_precision"]) if own and own["average_precision"] is not None else None)
