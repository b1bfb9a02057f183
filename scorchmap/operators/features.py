"""The 50 features of a look: its own bands and indices, the year before it, and changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.indices import feature_index
from ..settings import BANDS, FILL, INDICES, MEASURES, SEASONS, pixel_keys

SEASONAL = tuple(f"{s}_{m}" for s in SEASONS for m in MEASURES)
MAXIMA = tuple(f"max_{i}" for i in INDICES)
DELTAS = tuple(f"d{i}" for i in INDICES)
FEATURES = (*BANDS, *INDICES, *SEASONAL, *MAXIMA, *DELTAS)


def previous_year(looks: DataFrame, wide: DataFrame, maxima: DataFrame, check_years: bool = True, seen: DataFrame | None = None) -> DataFrame:
    """Joins the seasonal means and maxima of the year before; what is missing is fill, and no look is dropped.

    With check_years, a look whose previous year has no maxima at all in its stack is an error. seen: path, row, year of the looks that
    maxima are made of, where that is cheaper to list than the maxima.
    """
    if check_years:
        have = (maxima if seen is None else seen).select("path", "row", (F.col("year") + 1).alias("year")).distinct()
        if looks.select("path", "row", "year").distinct().join(have, ["path", "row", "year"], "left_anti").limit(1).count():
            raise ValueError("scenes of a year without annual maxima in the year before")
    keys = [*pixel_keys(looks.columns), "year"]
    means = wide.select(*keys[:-1], (F.col("season_year") + 1).alias("year"), *SEASONAL)
    best = maxima.select(*keys[:-1], (F.col("year") + 1).alias("year"), *(F.col(i).alias(f"max_{i}") for i in INDICES))
    out = looks.join(means, keys, "left").join(best, keys, "left")
    return out.withColumns({c: F.coalesce(c, F.lit(FILL).cast("short")) for c in (*SEASONAL, *MAXIMA)})


def features(joined: DataFrame) -> DataFrame:
    """All FEATURES as doubles, in order, after the other columns of a look."""
    rest = ["`" + c.replace("`", "``") + "`" for c in joined.columns if c not in FEATURES]
    own = {i: feature_index(i) for i in INDICES}
    delta = {f"d{i}": F.when(F.col("qa") == FILL, F.lit(float(FILL))).otherwise(own[i] - F.col(f"max_{i}")) for i in INDICES}
    values = {**{b: F.col(b) for b in BANDS}, **own, **{c: F.col(c) for c in (*SEASONAL, *MAXIMA)}, **delta}
    return joined.select(*rest, *(values[f].cast("double").alias(f) for f in FEATURES))
