"""Spectral indices as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..settings import FILL

#: Bands of the normalised differences.
NORMALISED = {"ndvi": ("b4", "b3"), "ndmi": ("b4", "b5"), "nbr": ("b4", "b7"), "nbr2": ("b5", "b7")}


def _band(name: str) -> Column:
    return F.col(name).cast("double")


def ratio(a: str, b: str) -> Column:
    """(a - b) / (a + b), 0 where that has no value."""
    total = _band(a) + _band(b)
    return F.when(total == 0, F.lit(0.0)).otherwise((_band(a) - _band(b)) / F.nullif(total, F.lit(0.0)))


def to_int16(value: Column) -> Column:
    """Rounded half away from zero and held within 16 bits."""
    return F.greatest(F.least(F.round(value), F.lit(32767.0)), F.lit(-32768.0)).cast("short")


def stored_index(name: str, qa: str = "qa") -> Column:
    """A normalised difference times 1000 as products hold it; fill for bad looks and where a band is fill."""
    a, b = NORMALISED[name]
    bad = (F.col(qa) < 0) | (F.col(a) == FILL) | (F.col(b) == FILL)
    return F.when(bad, F.lit(FILL).cast("short")).otherwise(to_int16(ratio(a, b) * 1000))


def feature_index(name: str, qa: str = "qa") -> Column:
    """A normalised difference times 1000 as the model takes it: not rounded, not masked for clouds, 0 for fill."""
    return F.when(F.col(qa) == FILL, F.lit(0.0)).otherwise(ratio(*NORMALISED[name]) * 1000)


def _guarded(value: Column, *bands: str, divisor: Column | None = None, empty: float = FILL) -> Column:
    bad = F.lit(False)
    for b in bands:
        bad = bad | (F.col(b) == FILL)
    out = F.when(bad, F.lit(float(FILL)))
    if divisor is not None:
        out = out.when(divisor == 0, F.lit(float(empty)))
        value = value / F.nullif(divisor, F.lit(0.0))
    return out.otherwise(value)


def _distance(a: str, x: float, b: str, y: float) -> Column:
    return (_band(a) - x) * (_band(a) - x) + (_band(b) - y) * (_band(b) - y)


def further_index(name: str) -> Column:
    """CSI, MIRBI, BAI, BAIM, BAIM2, SAVI, EVI and EVI2, unscaled; fill where a band is fill, 0 (burn area indices: fill) for a zero divisor."""
    b1, b3, b4, b5, b7 = map(_band, ("b1", "b3", "b4", "b5", "b7"))
    one = F.lit(1.0)
    if name == "csi":
        return _guarded(b4, "b4", "b5", divisor=b5, empty=0.0)
    if name == "mirbi":
        return _guarded(10 * b7 - 9.5 * b5 + 2, "b5", "b7")
    if name == "bai":
        return _guarded(one, "b3", "b4", divisor=_distance("b4", 0.06, "b3", 0.1))
    if name == "baim":
        return _guarded(one, "b4", "b5", divisor=_distance("b4", 0.05, "b5", 0.2))
    if name == "baim2":
        return _guarded(one, "b4", "b7", divisor=_distance("b4", 0.05, "b7", 0.2))
    if name == "savi":
        return _guarded(1.5 * (b4 - b3), "b3", "b4", divisor=b4 + b3 + 0.5, empty=0.0)
    if name == "evi":
        return _guarded(2.5 * (b4 - b3), "b1", "b3", "b4", divisor=b4 + 6 * b3 - 7.5 * b1 + 1, empty=0.0)
    if name == "evi2":
        return _guarded(2.5 * (b4 - b3), "b3", "b4", divisor=b4 + 2.4 * b3 + 1, empty=0.0)
    raise ValueError(f"no such index: {name}")


FURTHER = ("csi", "mirbi", "bai", "baim", "baim2", "savi", "evi", "evi2")
