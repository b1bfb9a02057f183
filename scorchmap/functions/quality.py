"""Quality layers into one code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..settings import ADJACENT, CLOUD, FILL, SHADOW, SNOW, WATER


def qa_code(variant: str = "raster") -> Column:
    """0 for a clear look, else the code of the weightiest of the six quality layers that is set.

    The point variant gives shadow and adjacent cloud each other's codes and lets shadow win.
    """
    order = [("qa_fill", FILL), ("qa_cloud", CLOUD)]
    if variant == "point":
        order += [("qa_shadow", ADJACENT), ("qa_adjacent", SHADOW)]
    elif variant == "raster":
        order += [("qa_adjacent", ADJACENT), ("qa_shadow", SHADOW)]
    else:
        raise ValueError(f"no such variant: {variant}")
    code = F
    for name, value in [*order, ("qa_snow", SNOW), ("qa_water", WATER)]:
        code = code.when(F.col(name) > 0, F.lit(value))
    return code.otherwise(F.lit(0)).cast("int")


def good_look(qa: str = "qa") -> Column:
    return F.col(qa) >= 0


def product_code(probability: Column, qa: str = "qa") -> Column:
    """A probability in percent, rounded half up; bad looks and fill by their sentinels."""
    q = F.col(qa)
    return F.when(q == FILL, F.lit(FILL)).when(q < 0, F.lit(-9998)).otherwise(F.floor(probability * 100 + 0.5)).cast("short")
