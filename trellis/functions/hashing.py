"""A portable integer hash, written the same way in Spark and in SQL.

Java's ``Random`` is not reproduced; instead every seeded generator uses one
closed-form formula that any SQL engine evaluates identically.  Ids and
positions are reduced by the modulus first, so for any 64-bit value every
intermediate product fits a signed 64-bit value and ANSI mode never overflows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the hash: a Mersenne prime modulus and three multipliers.
PRIME = 2147483647
MUL_I = 1103515245
MUL_J = 12345
MUL_J2 = 48271


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def mix(i, j, seed) -> Column:
    """With i and j reduced by PRIME: ``x = (i*MUL_I + j*MUL_J + seed) % PRIME;
    (x*x + MUL_J2*j + i) % PRIME``."""
    i, j, seed = (_c(v).cast("bigint") for v in (i, j, seed))
    i, j = i % F.lit(PRIME), j % F.lit(PRIME)
    x = (i * F.lit(MUL_I) + j * F.lit(MUL_J) + seed) % F.lit(PRIME)
    return (x * x + F.lit(MUL_J2) * j + i) % F.lit(PRIME)


def mix_sql(i: str, j: str, seed: str) -> str:
    """The same formula as SQL text."""
    i, j = f"(({i}) % {PRIME})", f"(({j}) % {PRIME})"
    x = f"({i} * {MUL_I} + {j} * {MUL_J} + ({seed})) % {PRIME}"
    return f"(({x}) * ({x}) + {MUL_J2} * {j} + {i}) % {PRIME}"
