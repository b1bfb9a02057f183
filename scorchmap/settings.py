"""Fixed values and options shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

#: Sentinels that are ordinary numbers in products and features.
FILL, BAD_LOOK = -9999, -9998
#: Quality codes of masked looks.
WATER, SNOW, SHADOW, ADJACENT, CLOUD = -3, -4, -5, -6, -7
SEASONS = ("winter", "spring", "summer", "fall")
INDICES = ("ndvi", "ndmi", "nbr", "nbr2")
MEASURES = ("b3", "b4", "b5", "b7", *INDICES)
BANDS = ("b1", "b2", "b3", "b4", "b5", "b7")
PIXEL = ("path", "row", "y", "x")
#: Columns that a table has once it is dealt by tile; grouping and joining by them too keeps it where it is.
TILE = ("tile_y", "tile_x")
FIRST_MISSION_YEAR = 1984


def pixel_keys(columns: list[str]) -> list[str]:
    """The columns that name a pixel, with its tile where a table has it."""
    return [*PIXEL, *(c for c in TILE if c in columns)]


@dataclass(frozen=True)
class ScreenOptions:
    exclude_l1g: bool = True
    exclude_rmse: bool = True
    exclude_cloudy: bool = True
    max_rmse: float = 10.0
    max_cloud_cover: float = 80.0


@dataclass(frozen=True)
class RegionOptions:
    seed_threshold: float = 97.5
    seed_size: int = 5
    grow_threshold: float = 75.0
