"""Price arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

GALLONS_PER_BARREL = 42.0
SLOPE_CLIP = 0.03


def round_to_05(x: Column) -> Column:
    """Nearest 0.05; halves go to the even twentieth."""
    return F.bround(x * 20.0, 0) / 20.0


def surprise(actual: Column, consensus: Column) -> Column:
    return actual - consensus


def jump(new: Column, previous: Column) -> Column:
    """Relative move; no or zero reference is no move."""
    usable = F.when(previous != 0, previous)
    return F.coalesce(F.abs((new - usable) / usable), F.lit(0.0))


def soft_clip(x: Column, limit: float = SLOPE_CLIP) -> Column:
    return F.tanh(x / limit) * limit


def recency_weight(age_days: Column, half_life: int = 90) -> Column:
    return F.exp(age_days * F.lit(-math.log(2.0) / max(1, half_life)))


def per_barrel(rbob: Column) -> Column:
    return rbob * GALLONS_PER_BARREL


def crack_spread(rbob: Column, wti: Column) -> Column:
    return per_barrel(rbob) - wti
