"""Seeded random draws as pure functions of (seed, key, tag) (F-9).

``rand``/``randn`` depend on partitioning; these depend only on their inputs, so a
re-run, a retried task or a different cluster size draws the same numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCALE = float(2 ** 52)


def uniform(seed: int, key: Column, tag) -> Column:
    """u in (0, 1) from the first 52 bits of md5("seed:key:tag")."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"), tag if isinstance(tag, Column) else F.lit(str(tag))))
    return (F.conv(F.substring(h, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(_SCALE)


def gaussian(seed: int, key: Column, tag) -> Column:
    """Standard normal by Box-Muller from two independent uniforms."""
    tag = tag if isinstance(tag, Column) else F.lit(str(tag))
    u1 = uniform(seed, key, F.concat(F.lit("g1:"), tag))
    u2 = uniform(seed, key, F.concat(F.lit("g2:"), tag))
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
