"""Comparing two frames in one shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import as_col


def frame_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose multiplicities differ, with both counts.

    Both sides are counted in one aggregate (NULLs equal, copies combined
    map-side), where two ``except`` calls would shuffle each side twice.
    """
    sides = left.withColumns({"_l": F.lit(1), "_r": F.lit(0)}).unionByName(
        right.withColumns({"_l": F.lit(0), "_r": F.lit(1)})
    )
    counted = sides.groupBy(*[as_col(c) for c in left.columns]).agg(
        F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows")
    )
    return counted.where("left_rows <> right_rows")


def frames_equal(left: DataFrame, right: DataFrame, bag: bool = True) -> bool:
    """Same rows; as bags, or as sets when ``bag`` is false."""
    if left.columns != right.columns:
        return False
    diff = frame_diff(left, right)
    if not bag:
        diff = diff.where("left_rows = 0 OR right_rows = 0")
    return diff.isEmpty()
