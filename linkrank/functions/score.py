"""Column functions of the damped random-surfer score. Without pages, ``n`` is 0 and there is
no row to compute for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAMPING = 0.85


def initial_rank(n: int) -> Column:
    """Every page starts with the same share of one."""
    return F.lit(1.0) / F.lit(float(max(n, 1)))


def contribution(pr: Column, degree: Column, copies: Column) -> Column:
    """What a page sends along one edge, times the copies of that edge."""
    return pr / degree * copies


def damped_rank(received: Column, n: int, damping: float = DAMPING) -> Column:
    """New rank from the sum received; a page that received nothing gets the base."""
    base = (1.0 - damping) / max(n, 1)
    return F.lit(base) + F.lit(damping) * F.coalesce(received, F.lit(0.0))
