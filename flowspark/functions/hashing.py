"""Keyed pseudo-random decisions.

The decision for a row depends on its key and the seed alone, not on partitioning or
row order, so it is the same on every cluster and after every retry, and Catalyst may
push it below casts and into the scan's stage.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = 2**32


def key_digest(key: Column, seed: int, purpose: str | None = None) -> Column:
    """Hex md5 of ``key:seed`` or ``key:purpose:seed``.

    Decisions taken one after the other on the same key need different purposes:
    under equal digests a 10 % sample would lie wholly inside an 80 % split. A NULL key
    fails the job: rows that share one would be kept or lost together.
    """
    suffix = f":{purpose}:{seed}" if purpose else f":{seed}"
    known = F.coalesce(key.cast("string"), F.raise_error("a row to draw has no key").cast("string"))
    return F.md5(F.concat(known, F.lit(suffix)))


def digest_below(digest: Column, fraction: float) -> Column:
    """Whether the digest's first 32 bits are below ``floor(fraction * 2^32)``.

    Lower-case hex of fixed width sorts like the number it spells, so the digest is
    compared as text and never converted.
    """
    threshold = math.floor(fraction * _SPACE)
    if threshold >= _SPACE:
        return F.lit(True)
    if threshold <= 0:
        return F.lit(False)
    return digest < F.lit(f"{threshold:08x}")
