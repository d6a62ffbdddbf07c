"""Mergeable device sketches (A1, A4): distinct devices without the pair table.

A sketch is a column of its own per (Contract, source_file); sketches of the
same keys merge by union, whatever batches, files or streams they come from, so
state grows with contracts and files, not with devices. An estimate's relative
standard error is about 1.04 / sqrt(2 ** LG_K), 1.6 % here; up to some hundred
devices per contract the sketch holds them exactly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C

LG_K = 12
SKETCH = "device_sketch"
#: Four standard errors, and at least one device.
BOUND = 4 * 1.04 / math.sqrt(2**LG_K)


def device_sketches(bronze: DataFrame, keys: Sequence[str] = (C.CONTRACT, C.SOURCE_FILE)) -> DataFrame:
    """One sketch of the distinct devices (NULL is none) per key."""
    return bronze.groupBy(*keys).agg(F.hll_sketch_agg(C.MAC, F.lit(LG_K)).alias(SKETCH))


def merged(sketches: DataFrame, keys: Sequence[str] = (C.CONTRACT,)) -> DataFrame:
    """The union of the sketches per key."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg(SKETCH, F.lit(False)).alias(SKETCH))


def estimate(sketch: Column | str = SKETCH) -> Column:
    return F.hll_sketch_estimate(sketch)


def within_bound(estimated: Column, exact: Column) -> Column:
    """Whether an estimate lies within ``BOUND`` of the exact count."""
    return F.abs(estimated - exact) <= F.greatest(F.lit(1.0), F.lit(BOUND) * exact)
