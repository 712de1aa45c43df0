"""Folds and bootstrap weights computed from a row's key.

Both depend on the key alone, so they stay the same under any partitioning, any
retry and any rerun. Row ids and ``sample(seed=...)`` change with the partitions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPAN = 2**32


def key_text(key: str | Sequence[str]) -> Column:
    """The key columns as one string. Nulls are skipped, so the text itself is never null."""
    names = [key] if isinstance(key, str) else list(key)
    return F.concat_ws("|", *[F.col(n).cast("string") for n in names])


def _hash32(text: Column) -> Column:
    """The first 32 bits of the md5 as a bigint."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_fold(key: str | Sequence[str], k: int) -> Column:
    return (_hash32(key_text(key)) % F.lit(k)).cast("int")


def poisson_cuts(rate: float) -> list[int]:
    """Integer cut points c0 < c1 < ... of a 32-bit draw: a draw in [c(n-1), c(n)) gives n copies.

    The list ends where the remaining tail is less than one draw in 2**32.
    """
    if not 0 < rate <= 20:
        raise ValueError("rate must be in (0, 20]")
    cuts: list[int] = []
    term, total, n = math.exp(-rate), 0.0, 0
    while True:
        total += term
        cut = min(round(total * _SPAN), _SPAN)
        if cuts and cut == cuts[-1] and n > rate:
            return cuts
        cuts.append(cut)
        if cut == _SPAN:
            return cuts
        n += 1
        term *= rate / n


def poisson_weight(key: str | Sequence[str], draw: int, seed: int, rate: float = 1.0) -> Column:
    """How often the row occurs in bootstrap number ``draw``: Poisson(``rate``), as a double."""
    value = _hash32(F.concat_ws("|", F.lit(str(seed)), F.lit(str(draw)), key_text(key)))
    cuts = poisson_cuts(rate)
    weight = F.when(value < cuts[0], 0.0)
    for n, cut in enumerate(cuts[1:], start=1):
        weight = weight.when(value < cut, float(n))
    return weight.otherwise(float(len(cuts)))
