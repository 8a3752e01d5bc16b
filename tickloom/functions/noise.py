"""Repeatable pseudo-random columns.

`rand(seed)` depends on partitioning and row order, so a retried task or
another cluster size changes it. These depend on key values only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = 13  # 52 bits, exact in a double


def hash_text(*parts: Column | str | int) -> Column:
    """MD5 in hex over the parts joined by `|`."""
    columns = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws("|", *columns))


def uniform(*parts: Column | str | int) -> Column:
    """A number in (0, 1]."""
    digits = F.substring(hash_text(*parts), 1, _DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 1) / F.lit(float(16**_DIGITS))


def normal(*parts: Column | str | int) -> Column:
    """A standard normal number (Box-Muller)."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(uniform(*parts, "u")))
    return radius * F.cos(F.lit(2.0) * F.pi() * uniform(*parts, "v"))
