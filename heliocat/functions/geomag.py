"""Kp to Ap by steps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from heliocat.constants import KP_AP_DEFAULT, KP_AP_STEPS, KP_STEP_MARGIN


def kp_to_ap(kp: Column) -> Column:
    """Ap of the first step that covers ``kp``; the default above the last one."""
    return F.when(
        kp.isNotNull(),
        reduce(
            lambda rest, step: F.when(kp <= step[0] + KP_STEP_MARGIN, step[1]).otherwise(rest),
            reversed(KP_AP_STEPS),
            F.lit(KP_AP_DEFAULT),
        ),
    ).cast("int")


def step_lookup(value: Column, steps: list[tuple], default) -> Column:
    """First result of ``steps`` (upper bound, result) whose bound is not below ``value``.

    The steps travel as one literal array, so a lookup needs no join.
    """
    table = F.array(*[F.struct(F.lit(b).alias("bound"), F.lit(r).alias("result")) for b, r in steps])
    hit = F.get(F.filter(table, lambda s: value <= s["bound"]), F.lit(0))
    return F.when(value.isNotNull(), F.coalesce(hit["result"], F.lit(default)))
