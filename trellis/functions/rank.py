"""Column expressions for ranking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rank update: new = BASE + DAMPING * sum(contributions).
BASE = 0.15
DAMPING = 0.85


def damp(x: Column | str, base: float = BASE, damping: float = DAMPING) -> Column:
    """``base + damping * x``."""
    x = F.col(x) if isinstance(x, str) else x
    return F.lit(base) + F.lit(damping) * x
