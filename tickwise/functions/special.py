"""Special functions as Column expressions (Spark has no ``erf``/``erfc``)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rational approximation of erf (Abramowitz & Stegun 7.1.26),
# absolute error below 1.5e-7.
AS_P = 0.3275911
AS_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def erfc_nonneg(x: Column) -> Column:
    """erfc(x) for x >= 0 as a JVM-side expression (|error| < 1.5e-7)."""
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(AS_P) * x)
    poly = F.lit(0.0)
    for a in reversed(AS_A):
        poly = (poly + F.lit(a)) * t
    return poly * F.exp(-(x * x))


def two_sided_normal_p(z: Column) -> Column:
    """2 * P(Z > |z|) for a standard normal Z."""
    return erfc_nonneg(F.abs(z) / F.lit(math.sqrt(2.0)))


def erfc_sql(x: str) -> str:
    """The same approximation as SQL text (for the independent oracle)."""
    t = f"(1.0 / (1.0 + {AS_P} * ({x})))"
    poly = "0.0"
    for a in reversed(AS_A):
        poly = f"(({poly}) + {a}) * {t}"
    return f"(({poly}) * exp(-(({x}) * ({x}))))"


def two_sided_normal_p_sql(z: str) -> str:
    return erfc_sql(f"abs({z}) / sqrt(2.0)")
