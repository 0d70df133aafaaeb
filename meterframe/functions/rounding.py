"""Deterministic decimal rounding of doubles.

``F.round(x, n)`` rounds the shortest decimal string of ``x`` half-up, so a
value printed as 0.78875 but stored as 0.78874999... rounds up.  Rounding
here scales the binary value by 10**n (one IEEE multiplication), rounds half
away from zero to an integer and scales back: the same rule many SQL engines
use, so results agree with them bit for bit, ties included.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rnd(c, n: int = 0) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    if n == 0:
        return F.round(x, 0)
    scale = float(10**n)  # a Python scalar: the literal is made JVM-side, no extra round trip
    return F.round(x * scale, 0) / scale
