"""Ranges of a key: bounds from an approximate quantile of all rows, and the range each key falls into.

Used where rows that come out of Python code are to be dealt out in key order: Spark's own range partitioning would run
that code once more for its sample.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands for a NULL key inside the operators, so that keys stay whole numbers in Python and come first in order.
LEAST = -(1 << 63)


def known_key(key: Column) -> Column:
    return F.coalesce(key.cast("long"), F.lit(LEAST))


def real_key(key: Column) -> Column:
    return F.nullif(key, F.lit(LEAST))


def range_bounds(rows: DataFrame, key: str, ranges: int) -> np.ndarray:
    """At most `ranges` - 1 bounds; keys below the first are in range 0."""
    steps = [k / ranges for k in range(1, ranges)]
    found = rows.agg(F.percentile_approx(key, steps, 100 * ranges).alias("b")).first()["b"] if steps else None
    return np.unique(np.array(found if found else [], np.int64))


def range_of(keys: pd.Series, bounds: np.ndarray) -> np.ndarray:
    """Number of the range of each key."""
    return np.searchsorted(bounds, keys.to_numpy(np.int64), side="right").astype(np.int32)
