"""Student's t from the incomplete beta function."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.functions.numeric import log_gamma, regularised_beta, student_two_sided_p

# Two-sided 5 % and 1 % points of Student's t from printed tables, by degrees of freedom.
POINTS = {4: (2.776445, 4.604095), 5: (2.570582, 4.032143), 10: (2.228139, 3.169273), 30: (2.042272, 2.749996), 60: (2.000298, 2.660283),
          120: (1.979930, 2.617421)}


def test_tabled_points(spark):
    rows = [(float(d), t, p) for d, ts in POINTS.items() for t, p in zip(ts, (0.05, 0.01))]
    got = spark.createDataFrame(rows, "d double, t double, p double").select("p", student_two_sided_p(F.col("t"), F.col("d")).alias("q")).collect()
    assert all(abs(r.p - r.q) < 1e-6 for r in got)


def test_closed_forms_and_quadrature(spark):
    """One and two degrees have closed forms; others are integrated numerically."""
    rows, want = [], []
    for d in (1.0, 2.0, 3.7, 4.0, 9.2, 77.7, 400.0, 5000.0):
        for t in (0.0, 1e-6, 0.3, 1.0, 2.5, 8.0, 40.0):
            rows.append((d, t))
            u = np.linspace(0, math.atan(t / math.sqrt(d)), 20_001)
            y = np.cos(u) ** (d - 1)
            area = (y[0] + y[-1] + 4 * y[1::2].sum() + 2 * y[2:-1:2].sum()) * (u[1] - u[0]) / 3
            want.append(1 - 2 * math.exp(math.lgamma((d + 1) / 2) - math.lgamma(d / 2)) / math.sqrt(math.pi) * area)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, d double, t double")
    got = [r.p for r in df.select("i", student_two_sided_p(F.col("t"), F.col("d")).alias("p")).orderBy("i").collect()]
    assert got == pytest.approx(want, abs=1e-9)
    both = df.select(student_two_sided_p(-F.col("t"), F.col("d")) - student_two_sided_p(F.col("t"), F.col("d"))).collect()
    assert all(r[0] == 0 for r in both)
    cauchy = [1 - 2 * math.atan(t) / math.pi for d, t in rows if d == 1.0]
    assert got[:len(cauchy)] == pytest.approx(cauchy, abs=1e-9)


def test_gamma_and_beta(spark):
    zs = [0.25, 0.5, 1.0, 1.5, 2.0, 7.3, 100.0, 12345.6]
    got = [r[0] for r in spark.createDataFrame([(z,) for z in zs], "z double").select(log_gamma(F.col("z"))).collect()]
    assert got == pytest.approx([math.lgamma(z) for z in zs], abs=1e-9, rel=1e-12)
    xs = [0.0, 0.1, 0.5, 0.9, 1.0]
    line = spark.createDataFrame([(x,) for x in xs], "x double").select(regularised_beta(F.lit(1.0), F.lit(1.0), F.col("x"))).collect()
    assert [r[0] for r in line] == pytest.approx(xs, abs=1e-12)
