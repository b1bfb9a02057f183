"""Column expressions on scene names and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scene_id_parts(scene_id: str = "scene_id") -> dict[str, Column]:
    """sensor, path, row, year as a scene id such as LT50170391984072XXX07 has them."""
    s = F.col(scene_id)
    return {"sensor": s.substr(1, 3), "path": s.substr(4, 3).cast("int"), "row": s.substr(7, 3).cast("int"), "year": s.substr(10, 4).cast("int")}


#: A year of up to four digits, a month and a day of up to two; what follows them, such as a time, is not looked at.
_DATE = r"^\s*(\d{1,4})-\s*(\d{1,2})-\s*(\d{1,2})"


def acquisition_date(text: str = "acq_date") -> Column:
    """The date that a string such as 1999-07-04, 1999-7-4 or 1999-07-04T18:02:11Z begins with, else null.

    Its year is from 1900 to 2400, and it exists in the calendar.
    """
    s = F.col(text)
    parts = [F.lpad(F.regexp_extract(s, _DATE, k), n, "0") for k, n in ((1, 4), (2, 2), (3, 2))]
    day = F.when(s.rlike(_DATE), F.try_to_date(F.concat_ws("-", *parts), "yyyy-MM-dd"))
    return F.when(F.year(day).between(1900, 2400), day)


def season(month: str | Column = "month") -> Column:
    """Meteorological season; winter is December to February."""
    m = F.col(month) if isinstance(month, str) else month
    return F.when(m.isin(12, 1, 2), "winter").when(m.between(3, 5), "spring").when(m.between(6, 8), "summer").otherwise("fall")


def season_year(year: str = "year", month: str = "month") -> Column:
    """December belongs to the winter of the next year."""
    return F.col(year) + (F.col(month) == 12).cast("int")


def date_parts(text: str = "acq_date") -> dict[str, Column]:
    """year, month, day, julian (day of year) and season; null for dates that are rejected."""
    day = acquisition_date(text)
    return {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day), "julian": F.dayofyear(day), "season": F.when(day.isNotNull(), season(F.month(day)))}
