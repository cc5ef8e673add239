"""Random draws that depend on a row's id, a seed and a name only.

``rand(seed)`` depends on how rows are partitioned; these do not, so generated data is the
same on any cluster and after any retry.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(row_id: Column, seed: int, name: str) -> Column:
    """Uniform in (0, 1), from the first 52 bits of an MD5 digest, which any engine can compute."""
    digest = F.md5(F.concat_ws(":", row_id.cast("string"), F.lit(str(seed)), F.lit(name)))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    return (bits + F.lit(0.5)) * F.lit(2.0**-52)


def between(row_id: Column, seed: int, name: str, low: float, high: float) -> Column:
    return F.lit(float(low)) + uniform(row_id, seed, name) * F.lit(float(high - low))


def integer(row_id: Column, seed: int, name: str, low: int, high: int) -> Column:
    """Whole number from low to high, both included."""
    return (F.lit(low) + F.floor(uniform(row_id, seed, name) * (high - low + 1))).cast("long")


def choice(row_id: Column, seed: int, name: str, values: Sequence) -> Column:
    index = integer(row_id, seed, name, 1, len(values)).cast("int")
    return F.element_at(F.array(*(F.lit(v) for v in values)), index)


def normal(row_id: Column, seed: int, name: str) -> Column:
    """Standard normal (Box-Muller)."""
    radius = F.sqrt(F.lit(-2.0) * F.log(uniform(row_id, seed, f"{name}/r")))
    return radius * F.cos(F.lit(2 * math.pi) * uniform(row_id, seed, f"{name}/a"))


def uuid_of(row_id: Column, seed: int) -> Column:
    """A stable identifier in UUID form."""
    digest = F.md5(F.concat_ws(":", F.lit("txn"), F.lit(seed).cast("string"), row_id.cast("string")))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *(F.substring(digest, start, length) for start, length in cuts))
