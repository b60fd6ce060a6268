"""Reproducible draws: every random choice is a hash of a seed and a row key.

The draws do not depend on partitioning or on retries, so lost tasks can be run again. They match a
sequential generator in distribution, not row for row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCALE = float(16**13)


def u(seed: int | str, *keys: Column | str) -> Column:
    """Uniform draw in [0, 1) from the first 52 bits of ``md5(seed:key:...)``."""
    parts = [F.lit(str(seed))]
    parts += [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(_SCALE)


def draw_index(n: Column | int, seed: int | str, *keys: Column | str) -> Column:
    """Uniform integer in [0, n)."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.floor(u(seed, *keys) * n).cast("long")
