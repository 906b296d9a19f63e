"""Threshold ladders: one ``CASE WHEN`` chain builder shared by every level column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(value: Column, steps: Sequence[tuple[float, str]], default: str) -> Column:
    """Label of the first ``(threshold, label)`` step with ``value > threshold``.

    Steps are tried in the order given (highest first for the usual ladders);
    a null ``value`` matches no step and falls to ``default``. The result is a
    single ``CASE WHEN`` expression, so it stays inside whole-stage codegen.
    """
    if not steps:
        return F.lit(default)
    (first_t, first_label), *rest = steps
    expr = F.when(value > F.lit(first_t), F.lit(first_label))
    for threshold, label in rest:
        expr = expr.when(value > F.lit(threshold), F.lit(label))
    return expr.otherwise(F.lit(default))
