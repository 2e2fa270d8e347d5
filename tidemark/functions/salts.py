"""Salt keys that spread one hot key over ``n`` groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def random_salt(prefix: Column | str, n: int = 8, seed: int | None = None) -> Column:
    """``prefix`` and a random number below ``n``.

    Redrawn if a lost task is run again over rows in another order; use
    :func:`hashed_salt` behind a shuffle.
    """
    return _joined(prefix, F.floor(F.rand(seed) * n).cast("int"))


def hashed_salt(prefix: Column | str, *columns: str | Column, n: int = 8) -> Column:
    """Same, from a hash of ``columns``: every attempt draws the same salt."""
    return _joined(prefix, F.pmod(F.xxhash64(*columns), F.lit(n)))


def numbered_salt(prefix: Column | str, number: Column, n: int = 8) -> Column:
    """Same, from a row number or id."""
    return _joined(prefix, F.pmod(number, F.lit(n)))


def _joined(prefix: Column | str, salt: Column) -> Column:
    head = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(head, salt.cast("string"))
