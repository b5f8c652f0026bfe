"""Repeatable randomness: a hash of the row's key, not of its partition.

The same row gets the same draw whatever the number of partitions or retries, so
recomputing a lost task never changes a result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPAN = 4294967296.0  # 2**32, the range of eight hexadecimal digits


def _digits(seed: int | str, keys: tuple[Column | str, ...], digits: int = 8) -> Column:
    parts = [F.lit(str(seed))] + [
        (F.col(key) if isinstance(key, str) else key).cast("string") for key in keys
    ]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, digits), 16, 10).cast("long")


def uniform(seed: int | str, *keys: Column | str) -> Column:
    """A number in [0, 1) that depends on the seed and the key only."""
    return _digits(seed, keys) / F.lit(_SPAN)


def open_uniform(seed: int | str, *keys: Column | str) -> Column:
    """A number in (0, 1], safe to take the logarithm of."""
    return (_digits(seed, keys) + F.lit(1)) / F.lit(_SPAN)


def fine_uniform(seed: int | str, *keys: Column | str) -> Column:
    """The same in steps of 2**-52, for draws that choose among very many things."""
    return _digits(seed, keys, 13) / F.lit(float(1 << 52))


def fine_open_uniform(seed: int | str, *keys: Column | str) -> Column:
    return (_digits(seed, keys, 13) + F.lit(1)) / F.lit(float(1 << 52))


def normal(seed: int | str, *keys: Column | str) -> Column:
    """Standard normal draw by the Box-Muller transform of two uniform draws."""
    radius = F.sqrt(F.lit(-2.0) * F.log(open_uniform(f"{seed}#1", *keys)))
    return radius * F.cos(F.lit(2.0 * math.pi) * uniform(f"{seed}#2", *keys))


def gamma_whole_shape(seed: int | str, shape: int, scale: float, *keys: Column | str) -> Column:
    """Gamma draw for a whole-number shape: the sum of that many exponentials."""
    total = F.lit(0.0)
    for step in range(1, shape + 1):
        total = total + F.log(open_uniform(f"{seed}#{step}", *keys))
    return F.lit(-scale) * total
