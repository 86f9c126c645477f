"""Scalar column helpers.  All are built-in expressions (JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from volpanel.schemas import ANNUALISE, LOG_EPS


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is zero or NULL (never a DIVIDE_BY_ZERO error)."""
    return F.try_divide(num, den)


def safe_sqrt(x: Column) -> Column:
    """NULL → NULL; x ≤ 0 → 0.0; else sqrt(x)."""
    return F.when(x > 0, F.sqrt(x)).when(x.isNotNull(), F.lit(0.0))


def annualise(x: Column) -> Column:
    """Daily volatility → annualised percent: x · √252 · 100."""
    return x * F.lit(ANNUALISE)


def to_log(y: Column, eps: float = LOG_EPS) -> Column:
    return F.ln(y + F.lit(eps))


def from_log(p: Column) -> Column:
    """Back-transform of a log-space prediction (ε is not subtracted again)."""
    return F.exp(p)


NUMBER = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf|infinity|nan)\s*$"


def to_double(x: Column) -> Column:
    """Tolerant cast to double: text that is not a plain decimal number (or inf / nan) gives NULL,
    also where the engine's own cast would take a type suffix such as ``1.5d``."""
    return F.when(x.cast("string").rlike(NUMBER), x.try_cast("double"))


def dot(coef: list[float] | Column, xs: list[Column] | Column, intercept: float | Column) -> Column:
    """intercept + Σ coefᵢ·xᵢ, positional over an ordered feature list.

    With Python lists this unrolls to a plain column sum; with array columns it
    folds ``zip_with`` by ``aggregate``.
    """
    if isinstance(coef, Column):
        prods = F.zip_with(coef, xs, lambda c, x: c * x)
        return F.aggregate(prods, intercept if isinstance(intercept, Column) else F.lit(float(intercept)), lambda a, b: a + b)
    total = intercept if isinstance(intercept, Column) else F.lit(float(intercept))
    for c, x in zip(coef, xs):
        total = total + (c if isinstance(c, Column) else F.lit(float(c))) * x
    return total


def rounded_error(pred: Column, actual: Column, k: int = 2) -> Column:
    """Signed error of rounded operands, rounded again: round(round(p)−round(a))."""
    return F.round(F.round(pred, k) - F.round(actual, k), k)
